"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of documents inside a task. Its words become symbols of the benchmark's vocabulary, and stretches of other words,
or too short to hold any test phrase, become one separator: no phrase can occur there, so nothing is lost and the index stays small.
The shard's suffix array gives its Burrows-Wheeler transform, held as a wavelet matrix. All test phrases are searched backwards at once
by ranks, their occurrences are located by walking to the next sampled suffix position, and the located spans are merged per document.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import ALNUM, materialize, word_slices

#: Symbols after which a shard is closed (at the end of a document).
SHARD_SYMBOLS = 1 << 18
#: Every so many text positions the suffix array is sampled.
SAMPLE = 8
#: Test phrases are dealt into passes of so many bytes of benchmark text; a larger benchmark takes more passes.
MAX_BROADCAST = 8 << 20
_END, _GAP, _FIRST = 0, 1, 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; the last symbol must be the least and occur once."""
    n = len(text)
    rank, step = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while True:
        key = rank * (n + 1)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])])
        rank = new
        if rank[order[-1]] == n - 1:
            return order
        step *= 2
        if step >= n:
            return order


class WaveletMatrix:
    """Ranks over a sequence of small integers, for many positions at once."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bit = (symbols >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]))
            self.zeros.append(len(symbols) - int(self.ones[-1][-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        low = np.zeros_like(at)
        for k, level in enumerate(reversed(range(self.levels))):
            bit = (symbol >> level) & 1
            a, b = self.ones[k][at], self.ones[k][low]
            at, low = np.where(bit, self.zeros[k] + a, at - a), np.where(bit, self.zeros[k] + b, low - b)
        return at - low

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at positions."""
        out = np.zeros(len(at), np.int64)
        for k in range(self.levels):
            a = self.ones[k][at]
            bit = self.ones[k][at + 1] - a
            out = out * 2 + bit
            at = np.where(bit, self.zeros[k] + a, at - a)
        return out


class FMIndex:
    def __init__(self, text: np.ndarray, size: int):
        """``text`` holds symbols from 1 to size - 1; an end symbol is added."""
        text = np.append(text, _END).astype(np.int64)
        order = suffix_array(text)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))]).astype(np.int64)
        self.bwt = WaveletMatrix(text[order - 1], size)
        self.n = len(text)
        sampled = order % SAMPLE == 0
        self.marks = np.concatenate([[0], np.cumsum(sampled)])
        self.sampled, self.samples = sampled, order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(phrase, low, high)`` of those of equal length that occur; the rows of the index from low up to high start with it."""
        phrase = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for k in reversed(range(phrases.shape[1])):
            c = phrases[phrase, k]
            low, high = self.before[c] + self.bwt.rank(c, low), self.before[c] + self.bwt.rank(c, high)
            some = low < high
            phrase, low, high = phrase[some], low[some], high[some]
        return phrase, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the index."""
        at, steps, out, open_ = rows.copy(), 0, np.zeros(len(rows), np.int64), np.arange(len(rows))
        while len(open_):
            done = self.sampled[at]
            out[open_[done]] = self.samples[self.marks[at[done]]] + steps
            open_, at = open_[~done], at[~done]
            c = self.bwt.access(at)
            at = self.before[c] + self.bwt.rank(c, at)
            steps += 1
        return out


class Phrases:
    """Distinct windows of ``width`` consecutive words of benchmark items, as symbols, with the items of each."""

    def __init__(self, items: list[tuple[object, str]], width: int):
        words = list(_word_lists([t for _, t in items]))
        self.items = [i for i, _ in items]
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *words]))
        parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for k, w in enumerate(words):
            if len(w):
                n = min(len(w), width)
                rows = np.lib.stride_tricks.sliding_window_view((np.searchsorted(self.vocabulary, w) + _FIRST).astype(np.int32), n)
                parts.setdefault(n, []).append((rows, np.full(len(rows), k)))
        #: (length, distinct windows, the owner set of each). A window's owners are the items that hold it; windows of equal owners share a set.
        self.windows, self._sets = [], {}
        for n, found in sorted(parts.items()):
            distinct, which = np.unique(np.concatenate([r for r, _ in found]), axis=0, return_inverse=True)
            pairs = np.unique(np.stack([which.ravel(), np.concatenate([o for _, o in found])], 1), axis=0)
            starts = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
            sets = [self._sets.setdefault(pairs[a:b, 1].astype(np.int32).tobytes(), len(self._sets)) for a, b in zip(starts, starts[1:])]
            self.windows.append((n, distinct.astype(np.int64), np.array(sets, np.int64)))
        self.sets = [np.frombuffer(owners, np.int32) for owners in self._sets]
        del self._sets
        self.least = min(parts, default=0)

    def owners(self, sets: np.ndarray) -> np.ndarray:
        """The numbers of the items of some owner sets together, in order."""
        if len(sets) == 1:
            return self.sets[sets[0]]
        found = np.zeros(len(self.items), bool)
        for k in sets:
            found[self.sets[k]] = True
        return np.flatnonzero(found)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + _FIRST, _GAP)


def _word_lists(texts: list[str]) -> Iterator[np.ndarray]:
    for first, last, words in word_slices(pa.array(texts, pa.string()), ALNUM):
        for i in range(last - first):
            yield words.hashes[words.bounds[i] : words.bounds[i + 1]]


def _stretches(symbols: np.ndarray, bounds: np.ndarray, least: int) -> np.ndarray:
    """Word numbers to index: those in runs of known words of one text that can hold a phrase."""
    known = symbols != _GAP
    cut = np.zeros(len(symbols) + 1, bool)
    cut[bounds] = True
    starts = np.flatnonzero(known & (~np.concatenate([[False], known[:-1]]) | cut[:-1]))
    ends = np.flatnonzero(known & (~np.concatenate([known[1:], [False]]) | cut[1:])) + 1
    long = ends - starts >= least
    flags = np.zeros(len(symbols) + 1, np.int8)
    flags[starts[long]] = 1
    np.subtract.at(flags, ends[long], 1)
    return np.flatnonzero(np.cumsum(flags[:-1]))


def _occurrences(symbols: np.ndarray, bounds: np.ndarray, phrases: Phrases) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """``(first words, length, owner sets)`` of all occurrences in a run of texts, shard by shard; each occurrence is one row, whoever owns it."""
    words = _stretches(symbols, bounds, phrases.least)
    owner = np.searchsorted(bounds, words, "right")
    begin = 0
    while begin < len(words):
        # A shard ends with a text.
        end = begin + SHARD_SYMBOLS
        end = len(words) if end >= len(words) else int(np.searchsorted(owner, owner[end], "left"))
        if end <= begin:
            end = int(np.searchsorted(owner, owner[begin], "right"))
        part, own = words[begin:end], owner[begin:end]
        # One separator wherever words are left out or the text changes.
        jump = np.concatenate([[0], np.cumsum((np.diff(part) > 1) | (np.diff(own) > 0))])
        place = np.arange(len(part)) + jump
        text = np.full(place[-1] + 1, _GAP, np.int64)
        text[place] = symbols[part]
        word_at = np.zeros(len(text), np.int64)
        word_at[place] = part
        index = FMIndex(text, len(phrases.vocabulary) + _FIRST)
        for length, windows, sets in phrases.windows:
            phrase, low, high = index.search(windows)
            if len(phrase):
                rows = np.repeat(low - np.concatenate([[0], np.cumsum(high - low)[:-1]]), high - low) + np.arange((high - low).sum())
                first = word_at[index.locate(rows)]
                yield first, length, np.repeat(sets[phrase], high - low)
        begin = end


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
#: Columns that the passes hand on; their names get a suffix of their own.
_WORKING = {"n_words": "long", "words": "array<struct<start:bigint,end:bigint>>", "spans": "array<struct<start:bigint,end:bigint>>", "items": "array<{}>"}
#: A batch of results ends once it lists so many items.
MAX_LISTED = 1 << 20


def _pass(phrases, text_col: str, item_type: pa.DataType, names: dict[str, str]):
    """``names`` has the working columns' names."""

    def results(batch: pa.RecordBatch, first: int, n_words: list, words: list, spans: list, items: list) -> pa.RecordBatch:
        part = batch.slice(first, len(n_words))
        kept = [c for c in batch.schema.names if c not in names.values()]
        listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(i) for i in items])]), pa.int32()), pa.array(np.concatenate(items) if items else [], item_type))
        arrays = [part.column(c) for c in kept] + [pa.array(n_words, pa.int64()), pa.array(words, _SPANS), pa.array(spans, _SPANS), listed]
        return pa.RecordBatch.from_arrays(arrays, [*kept, *(names[c] for c in _WORKING)])

    def judged(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        p: Phrases = phrases.value
        ids = np.array(p.items, object if item_type == pa.string() else np.int64)
        none = ids[:0]
        column, old_words, old_items = batch.column(text_col), batch.column(names["words"]), batch.column(names["items"])
        for first, last, words in word_slices(column, ALNUM):
            bounds = words.bounds
            cover = np.zeros(len(words.hashes) + 1, np.int64)
            pairs = [np.zeros((0, 2), np.int64)]
            if len(words.hashes) and len(p.vocabulary):
                for at, length, sets in _occurrences(p.symbols(words.hashes), bounds, p):
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + length, -1)
                    pairs.append(np.unique(np.stack([np.searchsorted(bounds, at, "right") - 1, sets], 1), axis=0))
            covered = np.cumsum(cover) > 0
            pairs = np.unique(np.concatenate(pairs), axis=0)
            cuts = np.searchsorted(pairs[:, 0], np.arange(last - first + 1))
            known_sets: dict[bytes, np.ndarray] = {}  # texts of equal sets share one array of items
            begin, listed, out = first, 0, ([], [], [], [])
            for i in range(last - first):
                known, mine = old_words[first + i].as_py() or [], pairs[cuts[i] : cuts[i + 1], 1]
                items = none
                if len(mine):
                    key = mine.tobytes()
                    if key not in known_sets:
                        known_sets[key] = np.unique(ids[p.owners(mine)])
                    items = known_sets[key]
                if known:
                    before = np.array(old_items[first + i].as_py(), ids.dtype)
                    items = np.unique(np.concatenate([before, items])) if len(items) else before
                edge = char_edge = np.zeros((0, 2), np.int64)
                if known or len(mine):
                    base, n = bounds[i], bounds[i + 1] - bounds[i]
                    hit = np.concatenate([[False], covered[base : base + n], [False]])
                    for s in known:
                        hit[s["start"] + 1 : s["end"] + 1] = True
                    edge = np.flatnonzero(hit[1:] != hit[:-1]).reshape(-1, 2)
                    start = words.offsets[i]
                    chars = np.concatenate([[0], np.cumsum((words.data[start : words.offsets[i + 1]] & 0xC0) != 0x80)])
                    char_edge = np.stack([chars[words.starts[base + edge[:, 0]] - start], chars[words.ends[base + edge[:, 1] - 1] - start]], 1)
                for column_, value in zip(out, (int(bounds[i + 1] - bounds[i]), [{"start": a, "end": b} for a, b in edge.tolist()], [{"start": a, "end": b} for a, b in char_edge.tolist()], items)):
                    column_.append(value)
                listed += len(items)
                if listed >= MAX_LISTED:
                    yield results(batch, begin, *out)
                    begin, listed, out = first + i + 1, 0, ([], [], [], [])
            if out[0]:
                yield results(batch, begin, *out)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from judged(batch)

    return work


def contamination(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 10, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``df`` with ``contamination``: a struct of ``n_words``, ``n_hit``, ``items`` (ids found, in order), ``words`` and ``spans`` (merged
    ranges of hit words, and of code points of the text).

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A window is ``width`` words of an item, or all of a
    shorter one. Null and empty texts, on either side, have no words; items with a null id are left out. Repeated rows are judged alike.
    Other columns pass through untouched, whatever their names; a column ``contamination`` is replaced. A benchmark of more
    than ``max_broadcast`` bytes of text is dealt into as many passes as hold it, each bounded by that size (or by one item's); passes are
    parted by checkpoints, so that neither the driver nor a task ever holds the phrases of two.
    """
    df = df.drop("contamination")
    suffix = uuid.uuid4().hex
    names = {c: f"{c}_{suffix}" for c in _WORKING}
    spark = df.sparkSession
    kind = benchmark.schema[item_col].dataType.simpleString()
    arrow_kind = pa.int64() if kind in ("bigint", "int", "smallint", "tinyint") else pa.string()
    item = F.col(item_col).cast("bigint" if arrow_kind == pa.int64() else "string")
    tests = benchmark.where(F.col(item_col).isNotNull() & F.col(item_text_col).isNotNull()).select(item.alias("item"), F.col(item_text_col).alias("text"))
    bytes_ = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-bytes_ // max_broadcast))
    types = {c: t.format("bigint" if arrow_kind == pa.int64() else "string") for c, t in _WORKING.items()}
    schema = ", ".join(f"{names[c]} {t}" for c, t in types.items())
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    out = df.select("*", *[F.lit(None).cast(t).alias(names[c]) for c, t in types.items()])
    for k in range(passes):
        rows = tests.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == k).orderBy("item", "text").collect()
        phrases = spark.sparkContext.broadcast(Phrases([(r.item, r.text) for r in rows], width))
        out = out.mapInArrow(_pass(phrases, text_col, arrow_kind, names), f"{fields}, {schema}")
        if k < passes - 1:
            out = materialize(out)
            phrases.unpersist()
    n_hit = F.aggregate(names["words"], F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    found = F.struct(F.col(names["n_words"]).alias("n_words"), n_hit.alias("n_hit"), *(F.col(names[c]).alias(c) for c in ("items", "words", "spans")))
    return out.select(*df.columns, found.alias("contamination"))


def without_spans(text: Column, spans: Column) -> Column:
    """The text without its (merged) removal spans."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    piece = lambda a, end: F.expr("''") if end is None else F.substring(text, (a["at"] + 1).cast("int"), (end - a["at"]).cast("int"))
    cut = F.aggregate(spans, start, lambda a, s: F.struct(s["end"].alias("at"), F.concat(a["out"], piece(a, s["start"])).alias("out")), lambda a: F.concat(a["out"], piece(a, F.char_length(text).cast("long"))))
    return F.when(F.size(spans) > 0, cut).otherwise(text)


def report(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` for every row; see ``contamination``."""
    c = contamination(df.select(F.col(id_col).alias("doc_id"), "text"), benchmark, **kw)
    names = F.array_join(F.array_sort(F.transform("contamination.items", lambda x: x.cast("string"))), ",")
    return c.select("doc_id", "contamination.n_words", "contamination.n_hit", F.size("contamination.items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.col("contamination.n_hit") > 0).alias("contaminated"))
