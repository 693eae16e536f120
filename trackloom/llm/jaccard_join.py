"""Near-duplicate documents by the Jaccard similarity of their word n-grams, with adaptive multi-match prefixes.

A document's set holds 64-bit hashes of its distinct shingles. Sets are ordered by a global order (rarest first). Two sets of n and m
shingles that reach the threshold share at least ``alpha(n, m)``, so for every l at least l of the shared ones are among the first
``n - alpha + l`` of the one and ``m - alpha + l`` of the other. A longer prefix costs more rows, but asks for more shared
shingles before a pair is verified, so each document chooses the l for which its estimated candidates are fewest for the rows spent; a
pair uses the smaller l of its two documents.

How the work stays in proportion to the input:

* documents of equal sets form one class, and only classes are compared;
* the order comes from a sketch of fixed size that counts all shingles, so no table of all shingles is shuffled;
* a prefix shingle of many documents is dealt over several salted groups;
* a class is first compared with the most central class of each group that it shares; these links already join most of a dense group of
  near copies. Only classes that are then still apart are paired with each other, and those of a shingle's largest component only meet
  the others, so a large group of copies never gives its own pairs, while no link between different components is lost. A shingle of many
  classes that stay apart is paired block by block, over as many tasks as that takes;
* a pair has to share its l prefix shingles before its sets are compared: pairs of classes that stay apart are counted in the join, those with
  a centre, which meet in one group, when their texts are at hand;
* before a pair leaves the join, the parity bitmaps of both sets bound their difference from below, which drops nearly all pairs
  of similar but unlinked classes and never a link;
* texts of candidate classes alone are moved, compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.common import NOT_SPACE, components, materialize, mixed, word_slices

#: Counters of the sketch of shingle frequencies.
SKETCH_SLOTS = 1 << 18
#: Longest prefix extension a document may choose.
MAX_MATCHES = 4
#: Members of a salted group of one prefix shingle, as estimated by the sketch.
GROUP_ROWS = 4096
#: Bits of the filter of documents whose texts are fetched (a multiple of 32768).
FILTER_BITS = 1 << 23
#: Classes on each side of a block of pairs.
BLOCK_ROWS = 4096
#: Bytes of shingle sets that a task keeps while it verifies pairs.
KEPT_BYTES = 16 << 20
#: Classes of more than this share of all rows are named in a broadcast, so at most as many are.
HOT_SHARE = 4096
#: Rows of two numbers that may be broadcast (16 MB).
SMALL_ROWS = 1_000_000
#: 64-bit words of a set's parity bitmap.
BITMAP = 8
_BITS = [f"b{k}" for k in range(BITMAP)]
_SALT_BITS = 20


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its word shingles."""
    for first, last, words in word_slices(column, NOT_SPACE):
        h, empty = words.hashes, np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            rolled = np.zeros(max(0, len(h) - width + 1), np.uint64)
            for k in range(width):
                rolled = rolled * np.uint64(0x9FB21C651E98DF25) + h[k : len(h) - width + 1 + k] if len(rolled) else rolled
            rolled = mixed(rolled, 3)
            for i in range(last - first):
                s, e = words.bounds[i], words.bounds[i + 1]
                if e - s >= width:
                    yield np.unique(rolled[s : e - width + 1])
                elif e > s:
                    whole = np.uint64(e - s)
                    for x in h[s:e]:
                        whole = whole * np.uint64(0xC2B2AE3D27D4EB4F) + x
                    yield mixed(np.array([whole], np.uint64), 4)
                else:
                    yield empty


def set_key(s: np.ndarray) -> np.int64:
    """One 64-bit key for a set; 0 for the empty set only."""
    with np.errstate(over="ignore"):
        key = mixed(np.array([mixed(s, 5).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64), 6)[0]
    return (key | np.uint64(1)).view(np.int64) if len(s) else np.int64(0)


def slots_of(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SKETCH_SLOTS.bit_length() + 1)).astype(np.int64)


def prefix_of(s: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, int, float]:
    """The prefix shingles of a set, their estimated frequencies, the chosen l, and how common the whole set is."""
    n = len(s)
    est = counts[slots_of(s)]
    order = np.lexsort((s, est))
    base = n - -(-n * percent // 100)
    need = n - base
    reach = min(base + MAX_MATCHES, n)
    load = np.cumsum(est[order[:reach]])
    best, least = 1, np.inf
    for l in range(1, min(MAX_MATCHES, need) + 1):
        # Rows of the prefix, and pairs that share l of its shingles: the matches fall off as l grows.
        cost = (base + l) + load[base + l - 1] / l**2
        if cost < least:
            best, least = l, cost
    order = order[: base + best]
    return s[order], est[order], best, float(np.log2(est + 1.0).mean()) if n else 0.0


def bitmap(s: np.ndarray) -> np.ndarray:
    """Each shingle flips one bit, so two bitmaps differ in at most as many bits as the sets do in shingles."""
    flips = np.bincount((s & np.uint64(64 * BITMAP - 1)).astype(np.int64), minlength=64 * BITMAP) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.int64)


def _signatures(width: int):
    """A row for each text, and one at the end of each task with its counters of shingles."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "class", *_BITS, "sketch"]
        counts = np.zeros(SKETCH_SLOTS, np.int64)
        for batch in batches:
            sizes, keys, maps, open_, size = [], [], [], [], 0
            for s in shingle_sets(batch.column("text"), width):
                sizes.append(len(s))
                keys.append(set_key(s))
                maps.append(bitmap(s))
                open_.append(slots_of(s))
                size += len(s)
                if size > 1 << 20:
                    counts += np.bincount(np.concatenate(open_), minlength=SKETCH_SLOTS)
                    open_, size = [], 0
            if open_:
                counts += np.bincount(np.concatenate(open_), minlength=SKETCH_SLOTS)
            maps = np.array(maps, np.int64).reshape(-1, BITMAP)
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), *(pa.array(maps[:, k].copy()) for k in range(BITMAP)), pa.nulls(len(sizes), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)
        yield pa.RecordBatch.from_arrays([*(pa.nulls(1, pa.int64()) for _ in names[:-1]), pa.array([counts.tobytes()], pa.binary())], names)

    return work


def _counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column("sketch").to_pylist():
            counts = np.frombuffer(packed, np.int64)
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["slot", "n"])


def _prefixes(width: int, percent: int, sketch):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = sketch.value, set()
        for batch in batches:
            rows = []
            for s in shingle_sets(batch.column("text"), width):
                key = int(set_key(s))
                if not len(s) or key in seen:
                    continue
                seen.add(key)
                tokens, est, matches, common = prefix_of(s, counts, percent)
                parts = np.minimum((est // GROUP_ROWS + 1).astype(np.int64), (1 << _SALT_BITS) - 1)
                salt = (key >> 8) % parts
                groups = np.where(salt > 0, tokens ^ mixed(salt.astype(np.uint64), 9), tokens).view(np.int64)
                size = np.full(len(tokens), len(s), np.int64)
                rows.append((tokens.view(np.int64), groups, np.full(len(tokens), key, np.int64), (size << 32) | np.arange(len(tokens)), np.full(len(tokens), (int(common * 256) << 8) | matches, np.int64) | (parts > 1).astype(np.int64) << 7))
            if rows:
                token, group, key, place, kind = (np.concatenate(c) for c in zip(*rows))
                # The token is the group itself unless it is salted.
                yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(key), pa.array(place), pa.array(kind), pa.array(token, mask=token == group)], ["grp", "class", "place", "kind", "token"])

    return work


def _spot(doc_id):
    """The place of a document in the filter; that of a null id is 0."""
    return F.coalesce(F.pmod(F.xxhash64(doc_id), F.lit(FILTER_BITS)), F.lit(0))


def _texts(width: int, bits):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, codec, seen = bits.value, pa.Codec("zstd", 3), set()
        for batch in batches:
            spot = batch.column("spot").to_numpy()
            texts = batch.column("text").filter(pa.array((wanted[spot >> 3] >> (spot & 7).astype(np.uint8) & 1).astype(bool)))
            keys, packed = [], []
            for text, s in zip(texts, shingle_sets(texts, width)):
                key = int(set_key(s))
                if key and key not in seen:
                    seen.add(key)
                    raw = text.as_buffer()
                    keys.append(key)
                    packed.append(len(raw).to_bytes(8, "little") + codec.compress(raw, asbytes=True))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(packed, pa.binary())], ["class", "packed"])

    return work


def shared_in_prefix(x: tuple[np.ndarray, int, int], y: tuple[np.ndarray, int, int], percent: int) -> bool:
    """Whether two sets, each given by its prefix in order, its l and its size, share l shingles where linked sets would."""
    (px, lx, n), (py, ly, m), l = x, y, min(x[1], y[1])
    alpha = (percent * (n + m) + 99 + percent) // (100 + percent)
    return len(np.intersect1d(px[: max(0, n - alpha + l)], py[: max(0, m - alpha + l)], assume_unique=True)) >= l


def _verify(width: int, percent: int, sketch):
    class Kept:
        """The sets and prefixes of the texts last seen, up to a bound in bytes; a single set may exceed it."""

        def __init__(self):
            self.sets, self.size, self.codec = {}, 0, pa.Codec("zstd")

        def get(self, packed: bytes) -> tuple[np.ndarray, tuple[np.ndarray, int, int]]:
            if packed not in self.sets:
                text = self.codec.decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True)
                found = next(shingle_sets(pa.array([text.decode()], pa.string()), width))
                if self.size > KEPT_BYTES:
                    self.sets, self.size = {}, 0
                tokens, _, l, _ = prefix_of(found, sketch.value, percent)
                self.sets[packed] = found, (tokens, l, len(found))
                self.size += found.nbytes + tokens.nbytes + len(packed)
            return self.sets[packed]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = Kept(), Kept()
        for batch in batches:
            good = []
            for p, q in zip(batch.column("text_a"), batch.column("text_b")):
                (x, prefix_x), (y, prefix_y) = kept[0].get(p.as_py()), kept[1].get(q.as_py())
                if not shared_in_prefix(prefix_x, prefix_y, percent):
                    good.append(False)
                    continue
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                shared = int((large[at] == small).sum())
                good.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return work


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int, sketch) -> DataFrame:
    """Those of the class pairs ``(a, b)`` whose sets reach the threshold; their texts are read again."""
    spark = docs.sparkSession
    keys = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    spots = classes.join(keys, "class", "left_semi").select("spot")
    maps = spots.groupBy(F.floor(F.col("spot") / 32768).alias("bucket")).agg(F.expr("bitmap_construct_agg(spot % 32768)").alias("bits"))
    wanted = np.zeros(FILTER_BITS // 8, np.uint8)  # a bit for each spot, as it comes
    for row in maps.collect():  # at most FILTER_BITS / 32768 rows of 4 kB
        wanted[row.bucket * 4096 : row.bucket * 4096 + len(row.bits)] = np.frombuffer(bytes(row.bits), np.uint8)
    if not wanted.any():
        return pairs
    texts = docs.select(_spot(F.col("doc_id")).alias("spot"), "text").mapInArrow(_texts(width, spark.sparkContext.broadcast(wanted)), "class long, packed binary")
    texts = materialize(texts.groupBy("class").agg(F.first("packed").alias("packed")))
    side = lambda c: texts.select(F.col("class").alias(c), F.col("packed").alias(f"text_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    return materialize(both.mapInArrow(_verify(width, percent, sketch), "a long, b long"))


def _small(df: DataFrame) -> DataFrame:
    """Marked for a broadcast if it has at most SMALL_ROWS rows; beyond that the join is left to shuffle."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def _alpha(n: Column, m: Column, percent: int) -> Column:
    """The least number of shared shingles of two linked sets."""
    return F.floor((percent * (n + m) + 99 + percent) / (100 + percent))


def _may_link(percent: int, n: tuple[Column, Column], at: tuple[Column, Column], l: Column) -> Column:
    """Whether a shared shingle at these places may be one of the first l shared ones of linked sets."""
    alpha = _alpha(*n, percent)
    return (alpha <= F.least(*n)) & (at[0] < n[0] - alpha + l) & (at[1] < n[1] - alpha + l)


def _differ_little(percent: int, n: tuple[Column, Column], bits: list[tuple[Column, Column]]) -> Column:
    """False only for sets that cannot be linked, by their bitmaps."""
    apart = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in bits), F.lit(0))
    return apart <= n[0] + n[1] - 2 * _alpha(*n, percent)


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 90) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row; links are pairs with ``100 * shared >= percent * union``.

    Words are runs of anything but ASCII white space, with A-Z lower-cased; a text of fewer than ``width`` words is one shingle, a null
    text or one without words has an empty set and is its own component. Repeated ids are kept row by row and count as one node in
    ``component_id``; a null id takes part with its text and is never the least of a component that has another id.
    Extra columns are ignored.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = materialize(docs.mapInArrow(_signatures(width), f"doc_id long, n long, class long, {', '.join(f'{b} long' for b in _BITS)}, sketch binary"))
    counted = rows.where("sketch IS NOT NULL").select("sketch").mapInArrow(_counters, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # a row object for each would take 140 MB
    counts = np.zeros(SKETCH_SLOTS, np.float64)  # bounded by SKETCH_SLOTS, whatever the input
    counts[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    signed = rows.where("sketch IS NULL").drop("sketch")
    firsts = [F.first(c).alias(c) for c in ("n", *_BITS)]
    names = [F.min("doc_id").alias("least"), F.count("*").alias("rows"), F.min(_spot(F.col("doc_id"))).alias("spot")]
    classes = materialize(signed.where("n > 0").groupBy("class").agg(*names, *firsts))

    sketch = spark.sparkContext.broadcast(counts)
    prefix = docs.select("text").mapInArrow(_prefixes(width, percent, sketch), "grp long, class long, place long, kind long, token long")
    group = Window.partitionBy("grp")
    prefix = prefix.repartition("grp").dropDuplicates(["grp", "class"])
    centre = F.max(F.struct(F.shiftright("kind", 8).alias("common"), F.col("class"), F.col("place"), F.col("kind"))).over(group)
    shared = prefix.withColumn("members", F.count("*").over(group)).withColumn("centre", centre)
    salted = F.col("kind").bitwiseAND(128) > 0
    shared = shared.where((F.col("members") > 1) | salted).select(F.coalesce("token", "grp").alias("token"), "class", "place", "kind", F.col("centre.class").alias("centre"), F.col("centre.place").alias("centre_place"), F.col("centre.kind").alias("centre_kind"))
    shared = materialize(shared)
    size, at, need = (lambda c: F.shiftright(c, 32)), (lambda c: F.col(c).bitwiseAND(0xFFFFFFFF)), (lambda c: F.col(c).bitwiseAND(127))
    possible = lambda p, q, k, m: _may_link(percent, (size(p), size(q)), (at(p), at(q)), F.least(need(k), need(m)))
    # A salted shingle has a centre for each of its groups; these meet in the most central of them.
    tops = shared.where(salted).where(F.col("class") == F.col("centre")).select("token", "class", "place", "kind")
    top = tops.groupBy("token").agg(F.max(F.struct("kind", "class", "place")).alias("top"))
    tops = tops.join(top, "token").select("class", "place", "kind", F.col("top.class").alias("centre"), F.col("top.place").alias("centre_place"), F.col("top.kind").alias("centre_kind"))
    stars = shared.drop("token").unionByName(tops).where(F.col("class") != F.col("centre")).where(possible("place", "centre_place", "kind", "centre_kind"))
    stars = stars.select(F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b")).distinct()
    known = lambda k: classes.select(F.col("class").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in ("n", *_BITS)])
    little = lambda x, y: _differ_little(percent, (F.col(f"n_{x}"), F.col(f"n_{y}")), [(F.col(f"{b}_{x}"), F.col(f"{b}_{y}")) for b in _BITS])
    stars = materialize(stars.join(known("a"), "a").join(known("b"), "b").where(little("a", "b")).select("a", "b"))
    links = _confirmed(stars, classes, docs, width, percent, sketch)
    joined = components(links)

    # Classes that share l shingles and are still apart.
    placed = shared.select("token", "class", "place", "kind").join(_small(joined.withColumnRenamed("node", "class")), "class", "left").withColumn("component", F.coalesce("component", "class"))
    # A dense group mostly is one component already: only the others meet it and each other, never its members among themselves.
    parts = placed.groupBy("token", "component").agg(F.count("*").alias("members"))
    parts = parts.groupBy("token").agg(F.count("*").alias("parts"), F.max_by("component", F.struct("members", "component")).alias("main"), F.sum("members").alias("all"), F.max("members").alias("most")).where("parts > 1")
    blocks = lambda n: F.ceil(n / BLOCK_ROWS).cast("int")
    parts = parts.select("token", "main", blocks(F.col("all") - F.col("most")).alias("blocks_x"), blocks(F.col("all")).alias("blocks_y"))
    placed = placed.join(parts, "token").join(classes.drop("n", "spot", "least", "rows"), "class")
    placed = placed.select("token", "class", "component", (F.col("component") == F.col("main")).alias("main"), size("place").alias("n"), at("place").alias("at"), need("kind").alias("l"), *_BITS, "blocks_x", "blocks_y")
    fields = [c for c in placed.columns if c not in ("token", "blocks_x", "blocks_y")]
    own = lambda n: F.pmod(F.xxhash64("class"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = placed.where("NOT main").select("token", *(F.col(c).alias(f"{c}_x") for c in fields), own("blocks_x").alias("bx"), every("blocks_y").alias("by"))
    y = placed.select("token", *(F.col(c).alias(f"{c}_y") for c in fields), own("blocks_y").alias("by"), every("blocks_x").alias("bx"))
    within = _may_link(percent, (F.col("n_x"), F.col("n_y")), (F.col("at_x"), F.col("at_y")), F.least("l_x", "l_y"))
    once = F.col("main_y") | (F.col("class_x") < F.col("class_y"))
    apart = x.join(y, ["token", "bx", "by"]).where(once & (F.col("component_x") != F.col("component_y")) & within & little("x", "y"))
    apart = apart.groupBy(F.least("class_x", "class_y").alias("a"), F.greatest("class_x", "class_y").alias("b")).agg(F.count("*").alias("m"), F.first(F.least("l_x", "l_y")).alias("l")).where("m >= l").select("a", "b")
    more = _confirmed(materialize(apart.join(stars, ["a", "b"], "left_anti")), classes, docs, width, percent, sketch)

    # The last components are over the classes' least ids, so each is named by the least id of all; classes without one come last.
    name = F.struct(F.col("least").isNull().cast("int").alias("none"), F.coalesce("least", "class").alias("id"))
    named = classes.select("class", name.alias("name"))
    edges = joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
    edges = edges.join(named.withColumnsRenamed({"class": "a", "name": "name_a"}), "a").join(named.withColumnsRenamed({"class": "b", "name": "name_b"}), "b")
    joined = components(edges.select(F.col("name_a").alias("a"), F.col("name_b").alias("b")))
    least = classes.withColumn("name", name).join(joined.withColumnRenamed("node", "name"), "name", "left").withColumn("of", F.coalesce("component", "name"))
    least = materialize(least.select("class", "rows", F.when(F.col("of.none") == 0, F.col("of.id")).alias("component_id")))
    # A class of many copies is looked up in a broadcast of at most HOT_SHARE rows; the others are joined.
    total = least.agg(F.sum("rows")).first()[0] or 0
    hot = F.broadcast(least.where(F.col("rows") > max(1, total // HOT_SHARE)).drop("rows"))
    full = signed.where("n > 0").select("doc_id", "n", "class")
    out = full.join(hot, "class").unionByName(full.join(hot.select("class"), "class", "left_anti").join(least.drop("rows"), "class", "left"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.unionByName(signed.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
