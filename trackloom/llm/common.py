"""Session helpers and vectorised word hashing shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.operators.graph import components, cut_lineage, shared_root  # noqa: F401  components is used by the operators

#: Word characters of the two tokenisations, by UTF-8 byte. Bytes from 0x80 belong to non-ASCII code points.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: A-Z to a-z, every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
#: Texts are tokenised in slices of about so many bytes, so that memory does not depend on the batch.
SLICE_BYTES = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


#: Checkpoints in the shared folder of ``spark.checkpoint.dir``.
materialize = cut_lineage


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet in the shared folder and read again, and where it lies."""
    spark = df.sparkSession
    folder = f"{shared_root(spark, 'spark-llm-')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


def discard(spark: SparkSession, folder: str) -> None:
    """Deletes a table of ``stored`` that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def usable(vector: Column, scale: float, bound: float) -> Column:
    """Whether a vector is neither null nor empty and all its components are finite, with ``scale`` times each below ``bound`` in size."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * scale) >= bound))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def usual_length(df: DataFrame, vector: str) -> int:
    """The most frequent length of the vectors, the least of equally frequent ones; 0 without vectors."""
    found = df.groupBy(F.size(vector).alias("length")).count().orderBy(F.desc("count"), "length").first()
    return found.length if found else 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """An Arrow list column of equally long rows as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def join_groups(rows: DataFrame, groups: DataFrame, on: Sequence[str], size: str, total: int, parts: int = 1000) -> DataFrame:
    """``rows`` with the columns of ``groups``, of which each row of a key (nulls are equal) has one; ``size`` is a group's number of rows.

    Groups that hold at least one ``parts``-th of the ``total`` rows are at most ``parts``, so they are broadcast; no key of the join of
    the rest has more rows than that, so a key that holds a third of all rows loads no task. ``groups`` should be cheap to read.
    """
    names = {c: f"{c}_{uuid.uuid4().hex}" for c in on}
    groups = groups.withColumnsRenamed(names)
    hot = groups.where(F.col(size) * parts >= total)
    cold = groups.where(F.col(size) * parts < total)
    same = lambda: reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in names.items()])
    some = [kind.isEmpty() for kind in (hot, cold)]
    if some[0]:
        return rows.join(cold, same()).drop(*names.values())
    near = rows.join(F.broadcast(hot), same()).drop(*names.values())
    if some[1]:
        return near
    rest = rows.join(F.broadcast(hot.select(*names.values())), same(), "left_anti")
    return near.unionByName(rest.join(cold, same()).drop(*names.values()))


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply) over unsigned integers."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x632BE59BD9B4E019 * (seed + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
        return x ^ (x >> np.uint64(32))


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return _powers[kind][:n]


class Words:
    """The words of a run of texts: byte offsets, owning text and 64-bit hash of each, in order."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray):
        #: The bytes themselves, and where each text begins in them.
        self.data, self.offsets = data, offsets
        data = LOWER[data]
        inside = word_bytes[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        before, after = np.empty_like(inside), np.empty_like(inside)
        before[:1], before[1:] = False, inside[:-1]
        after[-1:], after[:-1] = False, inside[1:]
        self.starts = np.flatnonzero(inside & (~before | first[:-1]))
        self.ends = np.flatnonzero(inside & (~after | first[1:])) + 1
        #: Words of text i are those from bounds[i] up to bounds[i + 1].
        self.bounds = np.searchsorted(self.starts, offsets)
        with np.errstate(over="ignore"):
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, len(data)), out=total[1:])
            raw = (total[self.ends] - total[self.starts]) * _power("down", _BASE_INV, len(data) + 1)[self.starts]
        self.hashes = mixed(raw)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def word_slices(column: pa.Array, word_bytes: np.ndarray) -> Iterator[tuple[int, int, Words]]:
    """``(first, last, words)`` over slices of a column of whole texts; a text is never cut."""
    data, offsets = texts_of(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
        last = min(last, n)
        base = offsets[first]
        yield first, last, Words(data[base : offsets[last]], offsets[first : last + 1] - base, word_bytes)
        first = last
