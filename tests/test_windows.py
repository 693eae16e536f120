import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trackloom.operators import windows as W


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("cuts", "total", "expected"), [
    ([], 10, [(0, 0, 9)]),
    ([0], 10, [(0, 0, 9)]),
    ([3, 3, 7], 10, [(0, 0, 2), (1, 3, 6), (2, 7, 9)]),
    ([25, -4], 10, [(0, 0, 8), (1, 9, 9)]),
    ([4], 0, []),
])
def test_segments_cover_the_span(spark, cuts, total, expected):
    b = spark.createDataFrame([(1, c) for c in cuts], "g int, frame long")
    s = spark.createDataFrame([(1, total)], "g int, total_frames long")
    assert rows(W.segments(b, s, "g").drop("g")) == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 120), max_size=12), st.integers(1, 100))
def test_segments_are_contiguous(spark, cuts, total):
    b = spark.createDataFrame([(1, c) for c in cuts], "g int, frame long")
    out = rows(W.segments(b, spark.createDataFrame([(1, total)], "g int, total_frames long"), "g").select("segment_index", "start_frame", "end_frame"))
    assert out[0][1] == 0 and out[-1][2] == total - 1
    assert all(a[2] + 1 == b[1] for a, b in zip(out, out[1:]))
    assert len(out) == 1 + len({min(max(c, 0), total - 1) for c in cuts} - {0})


def test_islands_treat_null_as_a_label(spark):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(["a", "a", None, None, "a", "b"])], "t int, label string").withColumn("g", F.lit(1))
    assert [r.island for r in W.islands(df, ["g"], ["t"], "label").orderBy("t").collect()] == [1, 1, 2, 2, 3, 4]


def test_local_median_leaves_itself_out(spark):
    speeds = [10, 0, 30, 1000, 50, 60, -3, 80]
    df = spark.createDataFrame([(1, k, v) for k, v in enumerate(speeds)], "g int, t int, v int")
    got = {r.t: (r.reference, r.reference_kind) for r in W.local_median(df, ["g"], ["t"], "v", reach=2).collect()}
    for k in range(len(speeds)):
        near = [v for j, v in enumerate(speeds) if j != k and abs(j - k) <= 2 and v > 0]
        expected = (statistics.median(near), "local") if len(near) >= 2 else (statistics.median([v for v in speeds if v > 0]), "global")
        assert got[k] == expected


def test_active_window_keeps_interior_rows_of_other_kinds(spark):
    kinds = ["ENGINE", "WAGON", "ENGINE", "WAGON", "BRAKE_VAN"]
    df = spark.createDataFrame([(1, k, v) for k, v in enumerate(kinds)], "g int, t int, kind string")
    got = [(r.position, r.unit_index) for r in W.active_window(df, ["g"], "t", "kind").orderBy("t").collect()]
    assert got == [("LEADING", None), ("INTERIOR", 1), ("INTERIOR", 2), ("INTERIOR", 3), ("TRAILING", None)]


def test_even_subsample_has_both_ends(spark):
    df = spark.range(100).withColumn("g", F.lit(1))
    assert [r.id for r in W.even_subsample(df, ["g"], ["id"], 4).orderBy("id").collect()] == [0, 33, 66, 99]
    assert W.even_subsample(df, ["g"], ["id"], 100).count() == 100


def test_interpolation_clamps_outside(spark):
    hits = spark.createDataFrame([(1, 10, 0.0), (1, 20, 100.0)], "g int, f int, v double")
    ask = spark.createDataFrame([(1, 5), (1, 10), (1, 15), (1, 30)], "g int, f int")
    assert rows(W.interpolate(hits, ask, ["g"], "f", "v").select("f", "v")) == [(5, 0.0), (10, 0.0), (15, 50.0), (30, 100.0)]


def test_footage_is_cut_as_by_its_spans(spark):
    rng = random.Random(5)
    rows = [(g, rng.randint(0, 40) + 100 * g, rng.choice([True, False, None])) for g in range(12) for _ in range(rng.randint(1, 12))] + [(99, None, True)]
    df = spark.createDataFrame(rows, "g int, f long, cut boolean")
    spans = df.where("f IS NOT NULL").groupBy("g").agg(F.min("f").alias("f0"), (F.max("f") - F.min("f") + 1).alias("total_frames"))
    cuts = df.where("cut AND f IS NOT NULL").join(spans, "g").select("g", (F.col("f") - F.col("f0")).alias("frame"))
    want = W.segments(cuts, spans.drop("f0"), "g").join(spans.select("g", "f0"), "g").select("g", "segment_index", "start_frame", "end_frame", "f0")
    got = W.footage_segments(df, "g", "f", F.col("cut"))
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert W.footage_segments(df.limit(0), "g", "f", F.col("cut")).count() == 0
