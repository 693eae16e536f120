"""Near-duplicate embeddings: int8 tile products with a proven error bound for every vector.

A unit vector u is stored as scale * q + e with q in int8. The length of e is measured, so the product of the
quantised vectors differs from the true cosine by at most |u'||e_v| + |e_u||v'| + |e_u||e_v|. Pairs below the threshold
by more than that are dropped, pairs above it by more are links, and the rest are computed again in double precision.

Vectors are cut into blocks of at most ``block`` rows, and each pair of blocks is one task: its work and memory are
bounded whatever the groups are, a group of near copies is spread over the grid, and only link counts and a spanning
forest leave a task, never the pairs. Equal vectors are one row of a block with their number as weight, so exact copies cost no
products, however many there are. Blocks that hold cells of nearby vectors are skipped as a pair where the distance of
their centres proves that no pair can reach the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import components, join_groups, materialize

#: Side of the sub-tiles that are multiplied at once.
TILE = 1024


def slack_of(dim: int) -> float:
    """A bound on what float32 adds to the error of a tile product of unit vectors: ``dim`` roundings of 2^-24 each, twice, and a few of the scales.

    Up to 1040 components the products of the codes are exact sums; beyond, the bound grows with the dimension, so more pairs are computed again.
    """
    return max(1e-6, (2 * dim + 8) * 2.0**-24)


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes (held as float32, in which their products are exact up to 1040 components), scales, lengths of the
    quantised vectors and of the errors."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    back = codes * scale[:, None]
    return codes.astype(np.float32), scale, np.linalg.norm(back, axis=1), np.linalg.norm(unit - back, axis=1)


def linked(a: np.ndarray, b: np.ndarray, threshold: float, qa=None, qb=None) -> np.ndarray:
    """Which pairs of the unit vectors ``a`` and ``b`` have a cosine of at least ``threshold``, exactly."""
    (ca, sa, la, ea), (cb, sb, lb, eb) = qa or quantise(a), qb or quantise(b)
    near = (ca @ cb.T) * sa.astype(np.float32)[:, None]
    near *= sb.astype(np.float32)[None, :]
    slack = slack_of(a.shape[1])
    worst = float((la.max() * eb.max()) + ea.max() * lb.max() + ea.max() * eb.max()) + slack
    hit = near >= np.float32(threshold - worst - slack)
    i, j = np.nonzero(hit)
    if len(i):
        bound = la[i] * eb[j] + ea[i] * lb[j] + ea[i] * eb[j] + 4 * slack
        value = near[i, j].astype(np.float64)
        hit[i, j] = value - bound >= threshold
        open_ = np.flatnonzero((value + bound >= threshold) & (value - bound < threshold))
        for part in np.array_split(open_, max(1, len(open_) // 200_000)):
            hit[i[part], j[part]] = np.einsum("ij,ij->i", a[i[part]], b[j[part]]) >= threshold
    return hit


def forest(hit: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Edges that join the same rows and columns as all links of ``hit`` do: each to the least of its component."""
    row, col = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
    hit, rows, cols = hit[np.ix_(row, col)], rows[row], cols[col]
    top = np.iinfo(np.int64).max
    x, y = rows.copy(), cols.copy()
    while True:
        y2 = np.minimum(y, np.where(hit, x[:, None], top).min(axis=0))
        x2 = np.minimum(x, np.where(hit, y2[None, :], top).min(axis=1))
        if (x2 == x).all() and (y2 == y).all():
            return np.unique(np.concatenate([np.stack([rows, x], 1), np.stack([cols, y], 1)]), axis=0)
        x, y = x2, y2


def _block_pair(threshold: float):
    def work(frame: pd.DataFrame) -> pd.DataFrame:
        same = frame.i.iloc[0] == frame.j.iloc[0]
        sides = [frame[frame.side == s] for s in (0, 1)]
        if same:
            sides[1] = sides[0]
        elif not (len(sides[0]) and len(sides[1])):
            return pd.DataFrame({"id": [], "other": [], "n": []}).astype("int64")
        ids, units, sizes = [], [], []
        for s in sides:
            x = np.stack(s.vector.to_numpy()).astype(np.float64)
            x /= np.abs(x).max(axis=1)[:, None]
            ids.append(s.id.to_numpy())
            sizes.append(s["size"].to_numpy())
            units.append(x / np.linalg.norm(x, axis=1)[:, None])
        cuts = [[slice(k, k + TILE) for k in range(0, len(u), TILE)] for u in units]
        quantised = [[quantise(u[c]) for c in cut] for u, cut in zip(units, cuts)]
        counts, edges = [np.zeros(len(u), np.int64) for u in units], []
        for i, ci in enumerate(cuts[0]):
            for j, cj in enumerate(cuts[1]):
                if same and j < i:
                    continue
                hit = linked(units[0][ci], units[1][cj], threshold, quantised[0][i], quantised[1][j])
                if same and i == j:
                    np.fill_diagonal(hit, False)
                if not hit.any():
                    continue
                counts[0][ci] += hit @ sizes[1][cj]
                if not (same and i == j):
                    counts[0 if same else 1][cj] += sizes[0][ci] @ hit
                edges.append(forest(hit, ids[0][ci], ids[1][cj]))
        out = [pd.DataFrame({"id": ids[k], "other": ids[k], "n": counts[k]})[counts[k] > 0] for k in ((0,) if same else (0, 1))]
        if edges:
            e = np.unique(np.concatenate(edges), axis=0)
            e = e[e[:, 0] != e[:, 1]]
            out.append(pd.DataFrame({"id": e[:, 0], "other": e[:, 1], "n": np.zeros(len(e), np.int64)}))
        return pd.concat(out)

    return work


def _cells(pivots: np.ndarray):
    """Adds the nearest pivot (cell) and its angle to each vector."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x = np.stack(frame.vector.to_numpy()).astype(np.float64)
                x /= np.abs(x).max(axis=1)[:, None]
                x /= np.linalg.norm(x, axis=1)[:, None]
                cos = np.clip(x @ pivots.T, -1, 1)
                yield frame.assign(cell=cos.argmax(axis=1), angle=np.arccos(cos.max(axis=1)))

    return work


def near_vectors(df: DataFrame, id_col: str, vector_col: str, threshold: float = 0.95, block: int = 8192, pivots: int = 64) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every distinct id of ``df``.

    Vectors that are null, empty or zero, or that hold null or non-finite components, link with nothing; vectors of different
    lengths never link. Repeated rows of an id count once (of differing vectors the least is taken). A null id gives one row without
    links and with a null component. Extra columns are ignored. Equal vectors are linked for any threshold up to 1. ``pivots`` vectors, the least hashes of ids, shape the cells; they
    only affect which pairs of blocks can be skipped, never the links.
    """
    spark = df.sparkSession
    kind = "array<float>" if df.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("vector"))
    rows = rows.groupBy("id").agg(F.min("vector").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = F.col("id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & ~bad & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    vectors, alone = rows.where("sound").drop("sound"), rows.where("NOT sound")
    alone = alone.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    good = materialize(vectors.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("size")).withColumn("dim", F.size("vector")))
    parts = []
    # One dimension is the rule; each further one is a grid of its own. Their number is that of the models behind the table.
    for dim in [r.dim for r in good.select("dim").distinct().collect()]:
        of = good.where(F.col("dim") == dim).drop("dim")
        sample = of.orderBy(F.xxhash64("id"), "id").limit(pivots).toPandas()
        p = np.stack(sample.vector.to_numpy())
        p = p / np.abs(p).max(axis=1)[:, None]
        p /= np.linalg.norm(p, axis=1)[:, None]
        celled = materialize(of.mapInPandas(_cells(p), f"vector {kind}, id long, size long, cell int, angle double"))
        # A cell is cut into blocks by hash; cells smaller than a block share one, so blocks follow the rows and not the cells.
        sizes = celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("angle")).orderBy("cell").toPandas()
        blocks, small, load = [], [], 0
        for c in sizes.itertuples():
            if c.n >= block:
                k = math.ceil(c.n / block)
                blocks.append({"cells": [c.cell], "parts": k})
            else:
                small.append(c.cell)
                load += c.n
                if load >= block // 2:
                    blocks.append({"cells": small, "parts": 1})
                    small, load = [], 0
        if small:
            blocks.append({"cells": small, "parts": 1})
        limit = math.acos(min(1.0, threshold)) + 1e-9
        radius = dict(zip(sizes.cell, sizes.angle))
        angles = np.arccos(np.clip(p @ p.T, -1, 1))
        near = lambda x, y: any(angles[s, t] - radius[s] - radius[t] <= limit for s in x["cells"] for t in y["cells"])
        first, total = [], 0
        for b in blocks:
            first.append(total)
            total += b["parts"]
        #: (block, group of blocks that it may meet, first and number of their parts): at most pivots ** 2 rows.
        meets = [(cell, first[i], blocks[i]["parts"], first[j], blocks[j]["parts"]) for i in range(len(blocks)) for j in range(len(blocks)) if near(blocks[i], blocks[j]) for cell in blocks[i]["cells"]]
        table = F.broadcast(spark.createDataFrame(meets, "cell int, own int, own_parts int, other int, other_parts int"))
        mine = F.col("own") + F.pmod(F.xxhash64("id", F.lit(7)), F.col("own_parts")).cast("int")
        spread = celled.join(table, "cell").withColumn("mine", mine).withColumn("their", F.explode(F.sequence(F.col("other"), F.col("other") + F.col("other_parts") - 1)))
        spread = spread.select(F.least("mine", "their").alias("i"), F.greatest("mine", "their").alias("j"), (F.col("mine") > F.col("their")).cast("int").alias("side"), "id", "size", "vector")
        parts.append(spread.groupBy("i", "j").applyInPandas(_block_pair(threshold), "id long, other long, n long"))
    if not parts:
        return alone
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = materialize(found)
    counts = found.where("n > 0").groupBy("id").agg(F.sum("n").alias("n"))
    joined = components(found.where("id <> other").select(F.col("id").alias("a"), F.col("other").alias("b")))
    classes = good.join(counts, "id", "left").join(joined.withColumnRenamed("node", "id"), "id", "left")
    # The copies of a vector are linked with each other and with what it is linked with.
    classes = materialize(classes.select("id", "vector", "size", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    answer = lambda of: of.select("id", F.col("n_links").cast("long").alias("n_links"), "component_id", (F.col("component_id") == F.col("id")).alias("kept"))
    out, several = answer(classes.where("size = 1")).unionByName(alone), classes.where("size > 1").drop("id")
    total = several.agg(F.sum("size")).first()[0]
    # Only what has copies is looked up by its vector.
    return out.unionByName(answer(join_groups(vectors, several, ["vector"], "size", total))) if total else out
