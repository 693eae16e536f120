"""Copies of all sensors under other ids: what joins give must grow with the rows, not with their square."""

import os
import random

import pytest
from pyspark.sql import functions as F

from trackloom.operators import joins
from trackloom.plans import catalog, relational

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")
TIMES = 8


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("copies"))
    k = F.explode(F.sequence(F.lit(0), F.lit(TIMES - 1)))
    e = spark.read.parquet(f"{SF}/events.parquet").withColumn("k", k)
    e.withColumn("event_id", F.col("event_id") + F.col("k") * 1_000_000).withColumn("user_id", F.col("user_id") + F.col("k") * 100_000).drop("k").write.parquet(f"{folder}/events.parquet")
    spark.read.parquet(f"{SF}/embeddings.parquet").write.parquet(f"{folder}/embeddings.parquet")
    return folder


def joined(df):
    """The rows that all joins of a query gave."""
    df.collect()

    def walk(plan):
        name = plan.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(plan.executedPlan())
        if "QueryStage" in name:
            return walk(plan.plan())
        own = plan.metrics().apply("numOutputRows").value() if "Join" in name else 0
        return own + sum(walk(plan.children().apply(i)) for i in range(plan.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("name", [
    "identity_components", "match_counts", "merged_identities", "nearest_match_with_leftovers", "pattern_penalty", "point_in_interval_label",
])
def test_joins_grow_with_the_rows(spark, copies, name):
    query = catalog.queries()[name]
    assert joined(query(spark, copies)) <= 1.5 * TIMES * joined(query(spark, SF))


def test_equal_segments_meet_the_units_once(spark):
    """A thousand segments of one span and a thousand units are a thousand pairs, each met twice, not a million."""
    local = spark.range(1000).selectExpr("1 AS g", "concat('L', id) AS local_id", "0L AS start", "2000L AS end")
    units = spark.range(1000).selectExpr("1 AS g", "concat('U', id) AS unit_id", "2 * id AS unit_start", "2 * id + 1 AS unit_end")
    out = joins.overlap_mapping(local, units, ["g"], 720)
    assert joined(out) <= 10_000
    assert {(r.unit_id, r.overlap, r.candidates, r.kind) for r in out.collect()} == {("U0", 1, 1000, "MANY_TO_ONE")}


def test_kinds_count_the_segments(spark, copies):
    """Copies of the sensors share their units: every camera has its segments as often, and what each overlaps."""
    count = lambda folder: {c: (n, o) for c, n, o in catalog.queries()["overlap_mapping_kinds"](spark, folder).groupBy("camera").agg(F.sum("n"), F.sum("overlap")).collect()}
    assert count(copies) == {c: (TIMES * n, TIMES * o) for c, (n, o) in count(SF).items()}


def test_cores_are_parts_of_identities(spark):
    """Random crowded tracks: every two of a core are linked through pairs, by plain union."""
    r = random.Random(5)
    rows = [(c, 1000 * c + k, s := r.randint(0, 400), s + r.choice([0, 0, 3, 40, 200]), r.randint(0, 300)) for c in range(2) for k in range(150)]
    t = spark.createDataFrame(rows, "camera int, track_id long, start_frame long, end_frame long, x_start long").withColumn("hour", F.floor(F.col("start_frame") / 60))
    root = {x[1]: x[1] for x in rows}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for p in relational.identity_pairs(t).collect():
        a, b = sorted((find(p.track_id), find(p.track_id_b)))
        root[b] = a
    cores = relational.identity_cores(t).collect()
    assert len({c.core for c in cores}) < len(cores) == len(rows)
    assert all(find(c.track_id) == find(c.core) for c in cores)
    assert all(c.cored == sum(d.core == c.core for d in cores) for c in cores)


def test_looks_are_not_joined_to_pairs(spark, copies):
    """The pairs themselves grow with the square, so nothing but the join that makes them may give as many rows."""
    df = catalog.queries()["identity_looks"](spark, copies)
    assert joined(df) <= 2 * df.count()


def test_costs_half_way_are_rounded_as_in_sql(spark, tmp_path):
    """Two tracks whose cost ends in half a unit of the ninth digit, in a double just below it: found among the given rows of two such tracks."""
    import duckdb

    e = spark.read.parquet("/root/testdata/sf0.1/events.parquet").where("user_id IN (1, 157, 1020, 1244, 1054, 1222)")
    e.write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = sorted(con.sql(catalog.oracle_sql()["match_costs"]).fetchall())
    assert sorted(map(tuple, catalog.queries()["match_costs"](spark, str(tmp_path)).collect())) == want and want
