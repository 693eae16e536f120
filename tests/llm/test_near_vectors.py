import numpy as np
from helpers import components, rows
from pyspark.sql import functions as F

from trackloom.llm import near_vectors as N


def brute(vectors, threshold):
    ok = {k: np.array(v, float) for k, v in vectors.items() if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ok = {k: v / np.abs(v).max() for k, v in ok.items()}  # so that squares stay finite
    links = [(a, b) for a in ok for b in ok if a != b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / np.sqrt(ok[a] @ ok[a]) / np.sqrt(ok[b] @ ok[b]) >= threshold]
    root = components(vectors, links)
    return sorted((k, sum(a == k for a, _ in links), root[k], root[k] == k) for k in vectors)


def test_matches_brute_force_over_many_blocks(spark):
    r = np.random.default_rng(0)
    base = r.normal(size=(6, 16))
    x = {k: (base[k % 6] * r.uniform(0.1, 9) + r.normal(size=16) * r.choice([0.05, 0.2, 0.3])).tolist() for k in range(300)}
    x |= {300 + k: r.normal(size=16).tolist() for k in range(60)}
    x |= {400: None, 401: [], 402: [0.0] * 16, 403: [float("nan")] + [1.0] * 15, 404: [float("inf")] + [1.0] * 15, 405: [None] + [1.0] * 15, 406: [1.0, 0.0], 407: [2.0, 0.0], 408: [1e300, 0.0], 409: [-1.0, 0.0]}
    df = spark.createDataFrame(list(x.items()), "vec_id long, embedding array<double>").withColumn("n_links", F.lit("clash"))
    for block, pivots in ((64, 4), (10_000, 64), (37, 1)):
        assert rows(N.near_vectors(df, "vec_id", "embedding", 0.95, block, pivots)) == sorted(brute(x, 0.95), key=repr)


def test_bound_holds_for_every_pair():
    r = np.random.default_rng(1)
    u = r.normal(size=(400, 64)) * r.exponential(size=(400, 64))
    u /= np.linalg.norm(u, axis=1)[:, None]
    codes, scale, length, error = N.quantise(u)
    near = (codes @ codes.T) * scale[:, None] * scale[None, :]
    bound = np.outer(length, error) + np.outer(error, length) + np.outer(error, error)
    assert (np.abs(near - u @ u.T) <= bound + 1e-6).all()
    hit = N.linked(u, u, 0.3)
    assert (hit == (np.einsum("ik,jk->ij", u, u) >= 0.3)).all()


def test_repeated_rows_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01]), (None, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert rows(N.near_vectors(df, "vec_id", "embedding")) == sorted([(1, 1, 1, True), (2, 1, 1, False), (None, 0, None, True)], key=repr)
    assert N.near_vectors(df.limit(0), "vec_id", "embedding").collect() == []


def test_copies_cost_no_products(spark):
    """A third of all rows are one vector: results are those of all pairs, and the tiles see it once."""
    r = np.random.default_rng(3)
    base = r.normal(size=(4, 8))
    x = {k: (base[k % 4] + r.normal(size=8) * 0.1).tolist() for k in range(120)}
    x |= {200 + k: [1.0, 0.0 if k % 2 else -0.0, 0.5] + [0.0] * 5 for k in range(60)}
    x |= {300 + k: x[k] for k in range(0, 120, 5)} | {400: [1.0, 0.01, 0.5] + [0.0] * 5, 401: None}
    df = spark.createDataFrame(list(x.items()), "vec_id long, embedding array<double>")
    assert rows(N.near_vectors(df, "vec_id", "embedding", 0.95, 32, 4)) == sorted(brute(x, 0.95), key=repr)
    many = spark.range(40_000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 40 == 0, F.array(F.lit(1.0), (F.col("id") / 40).cast("double"))).otherwise(F.array(F.lit(0.0), F.lit(-1.0))).alias("embedding"))
    got = N.near_vectors(many, "vec_id", "embedding").where("id % 40 <> 0").groupBy("n_links", "component_id").count().collect()
    assert [tuple(g) for g in got] == [(38_999, 1, 39_000)]
