"""Whitening of embeddings by their weighted covariance.

Equal integer vectors are one row with their number; that number (or one) is the weight in the fit. Sums are exact, deviations from the mean are
multiplied as matrices in the tasks, and only sums of products, a square of the dimension, reach the driver. Each distinct
vector is whitened once, and the result is joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import discard, join_groups, matrix, stored, usable, usual_length

#: Components are turned into integers: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Integers from here on in size do not fit the sums of a long.
BOUND = 2.0**52
#: Partial sums of tasks meet in so many groups first, so that the last sum has a bounded number of terms.
FAN_IN = 64


@dataclass
class Fit:
    """The mean as exact sums, and the components: unit vectors as columns, by falling variance."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    variances: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean, to double precision: the whole part of the mean goes as an integer."""
        whole, part = _mean(self.sums, self.n)
        return (x - whole).astype(np.float64) - part


def _mean(sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.array([s // n for s in sums], np.int64), np.array([(s % n) / n for s in sums])


def _sums_of(width: int, weight: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * width, 0
        for batch in batches:
            x, w = matrix(batch.column("x"), width), batch.column(weight).to_numpy()
            if len(w):
                fits = int(np.abs(x).max()) * int(w.sum()) < 2**62
                s = w @ x if fits else w.astype(object) @ x.astype(object)
                total, n = [a + int(b) for a, b in zip(total, s)], n + int(w.sum())
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, width), pa.int32()), pa.array([str(v) for v in (n, *total)])], ["place", "s"])

    return work


def exact_sums(distinct: DataFrame, width: int, weight: str) -> tuple[int, list[int]]:
    """The number of rows of the fit list and its sums by dimension."""
    rows = distinct.mapInArrow(_sums_of(width, weight), "place int, s string").groupBy("place").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    found = {r.place: int(r.s) for r in rows}
    return found.get(-1, 0), [found.get(k, 0) for k in range(width)]


def products(df: DataFrame, column: str, weight: str, width: int, prepare) -> tuple[np.ndarray, np.ndarray]:
    """The weighted sum of ``prepare(rows)`` and of its outer products, by one matrix product a batch.

    Tasks give one row a dimension; rows are added up in two steps, in the order of the tasks.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for batch in batches:
            x, w = prepare(matrix(batch.column(column), width)), batch.column(weight).to_numpy().astype(np.float64)
            total[0] += w @ x
            total[1:] += (x * w[:, None]).T @ x
        rows = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), width).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(range(width + 1), pa.int32()), rows], ["i", "v"])

    def added(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("task")
        return pd.DataFrame({"i": [group.i.iloc[0]], "task": [group.task.iloc[0]], "v": [np.stack(group.v.to_numpy()).sum(axis=0)]})

    parts = df.select(column, weight).mapInArrow(work, "i int, v array<double>").withColumn("task", F.spark_partition_id())
    for key in (F.pmod("task", F.lit(FAN_IN)), F.lit(0)):
        parts = parts.groupBy("i", key.alias("part")).applyInPandas(added, "i int, task int, v array<double>")
    found = {r.i: np.array(r.v) for r in parts.collect()}
    zero = np.zeros(width)
    return found.get(0, zero), np.stack([found.get(k + 1, zero) for k in range(width)])


def fit(distinct: DataFrame, width: int, weight: str, components: int) -> Fit | None:
    """None where there is nothing to fit. Components of no variance, up to rounding, cannot be scaled to one and are left out."""
    n, sums = exact_sums(distinct, width, weight)
    if not n:
        return None
    out = Fit(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0)
    _, gram = products(distinct, "x", weight, width, out.centred)
    covariance = (gram + gram.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    some = values > width * np.finfo(float).eps * max(values[0], 0)
    out.trace, out.variances, out.vectors = float(np.trace(covariance)), values[some][:components], vectors[:, some][:, :components]
    # A sign for each: its largest entry is positive.
    k = np.arange(out.vectors.shape[1])
    out.vectors = out.vectors * np.where(out.vectors[np.abs(out.vectors).argmax(axis=0), k] < 0, -1.0, 1.0)
    return out


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum of (n * x - S)^2, exactly; None beyond a long."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    y = x - whole
    if len(y) and (n * (int(np.abs(y).max()) + 1)) ** 2 * x.shape[1] >= 2**62:
        found = ((n * y.astype(object) - rest.astype(object)) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in found]
    return ((n * y - rest) ** 2).sum(axis=1).tolist()


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32, weights: str = "count") -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)``: a row for each vector and component.

    ``weights`` is ``count`` (every row is in the fit list) or ``one`` (every distinct vector is, once). Vectors that are null or empty, that hold null
    or non-finite components or such whose integer would be 2^52 or more, or that have another length than most, are dropped; ids
    may repeat or be null, and each row counts. Components of equal variance come in any order; those without variance are left out, so
    equal vectors alone give no rows, as does an empty table. ``deviation`` is null where it does not fit a long. Extra columns are ignored.
    A vector that a third of all rows share is one row of the fit, and is joined back by broadcast.
    """
    if weights not in ("count", "one"):
        raise ValueError("weights is count or one")
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    vectors = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    vectors = vectors.where(usable(F.col("vector"), SCALE, BOUND))
    width = usual_length(vectors, "vector")
    integer = F.transform("vector", lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(SHIFT).cast("long"))
    rows = vectors.where(F.size("vector") == width).select("id", integer.alias("x"))
    distinct, folder = stored(rows.groupBy("x").agg(F.count("*").alias("rows")).withColumn("one", F.lit(1).cast("long")), "distinct")
    weight = "rows" if weights == "count" else "one"
    fitted = fit(distinct, width, weight, components)
    k = len(fitted.variances) if fitted else 0
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not k:
        discard(spark, folder)
        return spark.createDataFrame([], schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scaled = fitted.vectors / np.sqrt(fitted.variances)
        for batch in batches:
            x = matrix(batch.column("x"), width)
            z = pa.FixedSizeListArray.from_arrays(pa.array((fitted.centred(x) @ scaled).ravel()), k).cast(pa.list_(pa.float64()))
            deviation = pa.array(_deviations(x, fitted.n, fitted.sums), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("rows"), batch.column("one"), deviation, z], ["x", "rows", "one", "deviation", "z"])

    white, _ = stored(distinct.mapInArrow(work, "x array<long>, rows long, one long, deviation long, z array<double>"), "whitened")
    discard(spark, folder)
    total, gram = products(white, "z", weight, k, lambda z: z)
    error = float(np.abs(gram / fitted.n - np.outer(total, total) / fitted.n**2 - np.eye(k)).max())
    count = fitted.n if weights == "count" else white.agg(F.sum("rows")).first()[0]
    shares = F.array(*[F.lit(float(v / fitted.trace)) for v in fitted.variances])
    out = join_groups(rows, white.drop("one"), ["x"], "rows", count).select("id", "deviation", F.posexplode("z").alias("place", "whitened"))
    return out.select("id", (F.col("place") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"))
