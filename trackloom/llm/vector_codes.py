"""Codes of vectors by parts: each part of a vector is the number of the nearest entry of that part's codebook.

Codebooks are moved for some rounds. Between rounds each part of each row keeps its b closest other entries with lower bounds on their distances, in
order, and one outer bound that holds for all further entries; bounds fall by how far entries have moved. A part whose exact distance to its entry lies
below all bounds stays; otherwise only the listed entries that their bounds cannot exclude are measured, and all entries only where the outer
bound fails. Every distance that decides is an exact integer. b follows, round by round, how deep lists had to be read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import discard, join_groups, matrix, stored, usable, usual_length

#: Components become floor(SCALE * x).
SCALE = 1024
#: Integers from here on in size have squared distances that may not fit a long.
BOUND = 2.0**26
#: The number of listed entries: at first, at least and at most.
START, LEAST, MOST = 8, 2, 32
#: Rows that are worked on at once.
ROWS = 4096
#: A list length grows when more than this share of parts had to measure all entries, and else covers all but this share of the readings.
FAILED, DEEP = 0.1, 0.01
_STATE = "id {}, label {}, x array<int>, code binary, near binary, low array<float>, outer array<float>, depth binary, error long"


def _down(x: np.ndarray) -> np.ndarray:
    """float32 values that are not above the given ones (to a few roundings of double precision); infinite ones stay."""
    return np.where(np.isinf(x), x.astype(np.float32), np.nextafter(x.astype(np.float32), np.float32(-np.inf)))


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points and entries; as products of doubles where those are exact."""
    top = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    p, e = (points.astype(np.float64), entries.astype(np.float64)) if 4 * top * top * points.shape[1] < 2**53 else (points, entries)
    return ((p * p).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e * e).sum(axis=1)).astype(np.int64)


class PartState:
    """Of the rows of a batch and one part: the entry, the listed others with bounds, the outer bound, the depth of the last reading, the distance."""

    def __init__(self, n: int, b: int):
        self.entry, self.near = np.zeros(n, np.int64), np.zeros((n, b), np.int64)
        self.low, self.outer = np.full((n, b), np.inf, np.float32), np.full(n, -np.inf, np.float32)
        self.depth, self.distance = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def resize(self, b: int) -> None:
        """Lists of b entries: what is cut off falls under the outer bound; added places are empty, of an infinite bound."""
        n, old = self.near.shape
        if old > b:
            self.outer = np.minimum(self.outer, self.low[:, b])
            self.near, self.low = self.near[:, :b], self.low[:, :b]
        elif old < b:
            self.near = np.concatenate([self.near, np.zeros((n, b - old), np.int64)], axis=1)
            self.low = np.concatenate([self.low, np.full((n, b - old), np.inf, np.float32)], axis=1)

    def sort(self) -> None:
        order = np.argsort(self.low, axis=1, kind="stable")
        self.near, self.low = np.take_along_axis(self.near, order, 1), np.take_along_axis(self.low, order, 1)


def scan(points: np.ndarray, entries: np.ndarray, b: int, state: PartState, rows: np.ndarray) -> None:
    """Measures all entries for some rows and lists the b next ones."""
    d = distances(points[rows], entries)
    best = d.argmin(axis=1)  # the first of equals
    at = np.arange(len(rows))
    state.entry[rows], state.distance[rows] = best, d[at, best]
    d = d.astype(np.float64)
    d[at, best] = np.inf
    if b < len(entries) - 1:
        first = np.argpartition(d, b, axis=1)[:, : b + 1]
        value = np.take_along_axis(d, first, 1)
        order = np.argsort(value, axis=1, kind="stable")
        first, value = np.take_along_axis(first, order, 1), np.take_along_axis(value, order, 1)
        state.near[rows], state.low[rows], state.outer[rows] = first[:, :b], _down(np.sqrt(value[:, :b])), _down(np.sqrt(value[:, b]))
    else:
        first = np.argsort(d, axis=1, kind="stable")[:, : len(entries) - 1]
        state.near[rows], state.low[rows], state.outer[rows] = 0, np.inf, np.inf
        state.near[rows[:, None], np.arange(first.shape[1])], state.low[rows[:, None], np.arange(first.shape[1])] = first, _down(np.sqrt(np.take_along_axis(d, first, 1)))


def reassign(points: np.ndarray, entries: np.ndarray, moved: np.ndarray, b: int, state: PartState) -> None:
    """Moves each row to its nearest entry (the lowest of equals), after the entries have moved by ``moved``."""
    kept = state.near.shape[1]
    with np.errstate(invalid="ignore"):
        state.low = _down(state.low.astype(np.float64) - moved[state.near])
        state.outer = _down(state.outer.astype(np.float64) - moved.max(initial=0.0))
    state.sort()
    state.distance = ((points - entries[state.entry]) ** 2).sum(axis=1)
    reach = np.sqrt(state.distance.astype(np.float64)) * (1 + 1e-12)
    open_ = state.low <= reach[:, None]
    state.depth = open_.sum(axis=1)
    failed = state.outer <= reach
    rows = np.flatnonzero((state.depth > 0) & ~failed)
    if len(rows):
        deep = int(state.depth[rows].max())
        near, looked = state.near[rows, :deep], open_[rows, :deep]
        d = ((points[rows][:, None, :] - entries[near]) ** 2).sum(axis=2)
        top = np.iinfo(np.int64).max
        d[~looked] = top
        best = d.min(axis=1)
        winner = np.where(d == best[:, None], near, len(entries)).min(axis=1)
        old, was = state.entry[rows], state.distance[rows]
        better = (best < was) | ((best == was) & (winner < old))
        low = np.where(looked, _down(np.sqrt(d.astype(np.float64))), state.low[rows, :deep])
        # The entry that is left takes the place of the one that wins.
        place = better[:, None] & looked & (near == winner[:, None])
        state.near[rows, :deep] = np.where(place, old[:, None], near)
        state.low[rows, :deep] = np.where(place, _down(np.sqrt(was.astype(np.float64)))[:, None], low)
        state.entry[rows], state.distance[rows] = np.where(better, winner, old), np.where(better, best, was)
        state.sort()
    state.resize(b)
    rows = np.flatnonzero(failed)
    state.depth[rows] = kept + 1
    for part in np.array_split(rows, max(1, -(-len(rows) // ROWS))):
        if len(part):
            scan(points, entries, b, state, part)


def _pass(books: np.ndarray, moved: np.ndarray | None, parts: int, width: int, kept: int, b: int):
    """One assignment of all parts. ``books`` is (parts, entries, width of a part)."""

    def chunk(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        x = np.zeros((n, books.shape[2] * parts), np.int64)
        x[:, :width] = matrix(batch.column("x"), width)
        x = x.reshape(n, parts, -1)
        code, depth, error = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.uint8), np.zeros(n, np.int64)
        near, low, outer = np.zeros((n, parts, b), np.uint8), np.zeros((n, parts, b), np.float32), np.zeros((n, parts), np.float32)
        if moved is not None:
            bytes_ = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8)
            old = bytes_("code").reshape(n, parts), bytes_("near").reshape(n, parts, kept), matrix(batch.column("low"), parts * kept).reshape(n, parts, kept) if kept else np.zeros((n, parts, 0), np.float32), matrix(batch.column("outer"), parts)
        for p in range(parts):
            state = PartState(n, b if moved is None else kept)
            if moved is None:
                scan(x[:, p], books[p], b, state, np.arange(n))
            else:
                state.entry, state.near, state.low, state.outer = old[0][:, p].astype(np.int64), old[1][:, p].astype(np.int64), old[2][:, p].astype(np.float32), old[3][:, p].astype(np.float32)
                reassign(x[:, p], books[p], moved[p], b, state)
            code[:, p], near[:, p], low[:, p], outer[:, p], depth[:, p] = state.entry, state.near, state.low, state.outer, state.depth
            error += state.distance
        lists = lambda a: pa.FixedSizeListArray.from_arrays(pa.array(a.ravel(), pa.float32()), a[0].size).cast(pa.list_(pa.float32())) if a[0].size else pa.array([[]] * n, pa.list_(pa.float32()))
        raw = lambda a: pa.array([r.tobytes() for r in a], pa.binary())
        arrays = [batch.column("id"), batch.column("label"), batch.column("x"), raw(code), raw(near), lists(low), lists(outer), raw(depth), pa.array(error)]
        return pa.RecordBatch.from_arrays(arrays, ["id", "label", "x", "code", "near", "low", "outer", "depth", "error"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                yield chunk(batch.slice(k, ROWS))

    return work


def _totals(parts: int, entries: int, width: int, part_width: int):
    """Of a task's rows: count and sums for each entry of each part, and (as entries from -1 down) how often lists were read to each depth."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, part_width), np.int64)
        read = np.zeros(256, np.int64)
        for batch in batches:
            x = np.zeros((batch.num_rows, part_width * parts), np.int64)
            x[:, :width] = matrix(batch.column("x"), width)
            x = x.reshape(batch.num_rows, parts, part_width)
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
            read += np.bincount(np.frombuffer(b"".join(batch.column("depth").to_pylist()), np.uint8), minlength=256)
            for p in range(parts):
                cell = p * entries + code[:, p].astype(np.int64)
                n += np.bincount(cell, minlength=len(n))
                np.add.at(s, cell, x[:, p])
        cells, deep = np.flatnonzero(n), np.flatnonzero(read)
        cell = np.concatenate([cells, -1 - deep])
        sums = np.concatenate([s[cells], np.zeros((len(deep), part_width), np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.concatenate([n[cells], read[deep]])), *(pa.array(c) for c in sums.T)], ["cell", "n", *(f"s{k}" for k in range(part_width))])

    return work


def _next_length(b: int, read: dict[int, int], most: int) -> int:
    """How many entries to list: twice as many where too many parts had to measure all, else as many as nearly all readings needed."""
    total = sum(read.values())
    if total and read.get(b + 1, 0) > FAILED * total:
        b *= 2
    elif total:
        rest = total - read.get(b + 1, 0)
        seen = 0
        for depth in range(b + 1):
            seen += read.get(depth, 0)
            if seen >= (1 - DEEP) * rest:
                b = depth
                break
    return min(max(b, LEAST), MOST, most)


def encode(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = None, parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[DataFrame, np.ndarray]:
    """``(id, label, code, error)`` for every usable row, and the final codebooks (part, entry, place).

    ``code`` is one byte a part, ``error`` the sum of the parts' squared distances to their entries, in units of 1/1024 squared. Vectors that are null
    or empty, that hold null or non-finite components or such of 2^16 and more in size, or that have another length than most, are
    dropped. Ids may repeat or be null (nulls come last where the least ids start the codebooks; equal ids by their vectors); each row counts. Fewer rows
    than ``entries`` give shorter codebooks, an empty table an empty one. Where the length is no multiple of ``parts``, zeros are added
    at the end. Extra columns are ignored. Rows never move: only sums by entry are shuffled, so no copies or labels can gather in a task.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's number is a byte")
    spark = df.sparkSession
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    rows = df.select(F.col(id_col).alias("id"), label.alias("label"), F.col(vector_col).alias("vector")).where(usable(F.col("vector"), SCALE, BOUND))
    width = usual_length(rows, "vector")
    rows = rows.where(F.size("vector") == width).select("id", "label", F.transform("vector", lambda c: F.floor(c.cast("double") * SCALE).cast("int")).alias("x"))
    first = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    part_width = -(-width // parts)
    start = np.zeros((len(first), part_width * parts), np.int64)
    if len(first):
        start[:, :width] = [r.x for r in first]
    books = start.reshape(len(first), parts, part_width).transpose(1, 0, 2).copy()
    schema = _STATE.format(*(rows.schema[c].dataType.simpleString() for c in ("id", "label")))
    if not len(first):
        return spark.createDataFrame([], f"{schema}").select("id", "label", "code", "error"), books
    state, folder, moved = rows, None, None
    kept = b = min(START, len(first) - 1)
    for turn in range(rounds + 1):
        old = folder
        state, folder = stored(state.mapInArrow(_pass(books, moved, parts, width, kept, b), schema), f"codes-{turn}")
        if old:
            discard(spark, old)
        if turn == rounds:
            break
        kept = b
        sums = ", ".join(f"s{k} long" for k in range(part_width))
        found = state.select("x", "code", "depth").mapInArrow(_totals(parts, len(first), width, part_width), f"cell long, n long, {sums}")
        found = found.groupBy("cell").agg(F.sum("n").alias("n"), *[F.sum(f"s{k}").alias(f"s{k}") for k in range(part_width)]).collect()
        after = books.copy()
        for r in found:
            if r.cell >= 0:
                after[r.cell // len(first), r.cell % len(first)] = [s // r.n for s in r[2:]]
        if turn:
            b = _next_length(b, {-1 - r.cell: r.n for r in found if r.cell < 0}, len(first) - 1)
        moved = np.sqrt(((after - books) ** 2).sum(axis=2).astype(np.float64)) * (1 + 1e-12)
        books = after
    return state.select("id", "label", "code", "error"), books


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def code_report(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **kw) -> DataFrame:
    """``(id, code, error, label_error, codebooks_sha256)``: codes in hex, and the errors summed over equal labels, nulls together; see ``encode``."""
    coded, books = encode(df, id_col, vector_col, label_col, **kw)
    labels, _ = stored(coded.groupBy("label").agg(F.count("*").alias("rows"), F.sum("error").alias("label_error")), "labels")
    total = labels.agg(F.sum("rows")).first()[0] or 0
    out = join_groups(coded, labels, ["label"], "rows", total)
    return out.select("id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
