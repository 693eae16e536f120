import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.llm import whitening as W


def brute(vectors, k=32, weight="count"):
    """n, deviations, whitened (up to sign), shares, straight from the rows."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    fitted = x if weight == "count" else [list(v) for v in dict.fromkeys(map(tuple, x))]
    n, sums = len(fitted), [sum(c) for c in zip(*fitted)]
    dev = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    centre = lambda rows: np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in rows])
    c = centre(fitted)
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1], axes[:, ::-1]
    some = values > values[0] * 1e-12
    return n, dev, centre(x) @ axes[:, some][:, :k] / np.sqrt(values[some][:k]), (values / values.sum())[some][:k]


def check(spark, data, **kw):
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("component", F.lit("clash")).withColumn("rows", F.lit(1)).repartition(5)
    found = W.whiten(df, **kw).toPandas()
    good = {i: v for i, v in data if v and len(v) == len(data[0][1]) and all(c is not None and np.isfinite(c) for c in v)}
    n, dev, z, share = brute(list(good.values()), weight=kw.get("weights", "count"))
    assert len(found) == len(good) * z.shape[1] and set(found.n) == {n}
    wide = found.pivot(index="id", columns="component", values="whitened").loc[list(good)].to_numpy()
    sign = np.sign((wide * z).sum(axis=0))
    assert np.allclose(wide * sign, z, atol=1e-8) and found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9
    assert found.groupby("id").deviation.first().loc[list(good)].tolist() == dev
    assert np.allclose(found.groupby("component").explained.first(), share, rtol=1e-9)


def test_matches_brute_force_with_copies_and_bad_rows(spark):
    r = np.random.default_rng(0)
    base = r.normal(size=(120, 40)) * np.linspace(0.1, 2, 40)
    data = [(k, base[k % 90 if k < 200 else 7].tolist()) for k in range(300)]
    data += [(900, None), (901, []), (902, [float("nan")] * 40), (903, [float("-inf")] + [0.0] * 39), (904, [None] + [0.0] * 39), (905, [1.0, 2.0])]
    check(spark, data)
    check(spark, data, weights="one")
    check(spark, [(k, (base[k, :5] * 1e5).tolist()) for k in range(100)])  # far from the mean


def test_no_variance_few_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(k, [0.5, 1.0]) for k in range(4)], "vec_id long, embedding array<float>")
    assert W.whiten(df).collect() == [] and W.whiten(df.limit(0)).collect() == []
    flat = spark.createDataFrame([(k % 2, [float(k), 2.0 * k, 3.0]) for k in range(6)] + [(None, [7.0, 14.0, 3.0])], "vec_id long, embedding array<float>")
    found = W.whiten(flat).collect()  # one direction of variance; repeated and null ids keep their rows
    assert len(found) == 7 and {r.component for r in found} == {1} and abs(sum(r.whitened**2 for r in found) / 7 - 1) < 1e-12
    with pytest.raises(ValueError):
        W.whiten(flat, weights="other")


def test_deviations_beyond_a_machine_word_are_exact_or_null():
    x = np.array([[2**40, 5], [0, 7]])
    sums = [2**40, 12]
    assert W._deviations(x, 2, sums) == [None, None]
    x = np.array([[2**31, 5], [0, 7]])
    assert W._deviations(x, 2, [2**31, 12]) == [(2 * a - 2**31) ** 2 + (2 * b - 12) ** 2 for a, b in x.tolist()]


def test_a_vector_of_a_third_of_all_rows_is_joined_by_broadcast(spark):
    from trackloom.llm.common import join_groups

    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("x"), F.lit("a").alias("size"))
    groups = rows.groupBy("x").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    for parts in (2, 10, 10_000):
        found = join_groups(rows, groups, ["x"], "n", 3000, parts)
        assert found.columns == ["id", "x", "size", "n", "top"]
        assert sorted(found.select("id", "top").collect()) == [(k, 2997 if k % 3 == 0 else k) for k in range(3000)]
