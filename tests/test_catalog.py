"""Every named query of the catalogue against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__
from trackloom.operators import stateful
from trackloom.plans import catalog, ordered, stage

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in os.listdir(SF):
        path = f"{SF}/{name}"
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(df: pd.DataFrame) -> list:
    """Rows as tuples of comparable values, in order."""

    def show(v: object) -> str:
        if pd.api.types.is_scalar(v) and pd.isna(v):
            return ""
        return f"{v:.12g}" if pd.api.types.is_number(v) and not isinstance(v, bool) else str(v)

    return sorted(tuple(map(show, row)) for row in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, sql, name):
    got, want = catalog.queries()[name](spark, SF).toPandas(), sql.sql(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


#: Columns that carry an operator: none may have one value only, or no query would notice a wrong branch.
CARRYING = {
    "ratio_vote": ["state"], "priority_pick": ["label"], "provenance": ["supporting", "missing"], "set_operations": ["present", "absent", "together"], "damage_camera_sets": ["cameras"],
    "completion_rollup": ["idle", "partial"], "overall_status": ["status"], "assembled_units": ["fallback"], "roster_grid": ["n", "reason"], "missing_and_unexpected": ["problem"],
    "snapshot_scores": ["edge", "score"], "camera_window_map": ["batch", "on_camera"], "match_costs": ["cost", "cost_by_sigma"], "usable_offsets": ["status", "delta"], "sequence_alignment": ["op", "residual"],
    "offset_sweep": ["offset", "margin"], "alias_offsets": ["place"], "evidence_attach": ["op", "reason", "residual"], "evidence_times": ["n_support"], "class_dedup": ["kept"], "context_similarity": ["alike"],
    "rejection_report": ["ref_kind", "motion_paused", "class", "train_state", "nearest_prev_s", "nearest_next_s", "recovery", "detail"], "static_lines": ["lines", "still", "reflection"], "gap_evolution": ["gap_trend", "gap_slope"], "structured_motion": ["structured_ratio", "directed_ratio", "motion"], "look_steadiness": ["steadiness", "drift"], "look_verdicts": ["reflection", "strength", "decision", "adjusted"],
    "identity_looks": ["alike"], "track_look_summary": ["look_size", "opened"], "stream_ready_batches": ["kind", "names"], "inserted_boundaries": ["source"], "fused_units": ["how", "leading_source", "label"], "fusion_invariants": ["broken"],
}
LARGER = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="the given tables are not here")
@pytest.mark.parametrize("name", sorted(CARRYING))
def test_no_carrying_column_is_constant(name):
    con = duckdb.connect()
    for file in os.listdir(LARGER):
        con.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{LARGER}/{file}'")
    rows = con.sql(catalog.oracle_sql()[name]).df()
    assert [c for c in CARRYING[name] if rows[c].map(repr).nunique() < 2] == []


def test_clock_offsets_are_resolved_and_refused(spark):
    """``camera_offsets`` has no SQL: the search is tested against full sweeps, and here both outcomes must occur."""
    rows = catalog.queries()["camera_offsets"](spark, LARGER if os.path.isdir(LARGER) else SF).collect()
    assert {r.status for r in rows} == {"RESOLVED", "UNRESOLVED"} and all((r.usable == r.delta) if r.status == "RESOLVED" else r.usable == 0 for r in rows)
    # The clock that the query gives to a sensor is found again wherever the search is certain.
    found = [abs(r.delta + (r.sensor * 7 % 41 - 20)) for r in rows if r.status == "RESOLVED"]
    assert sum(d < 1 for d in found) >= 0.95 * len(found)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_fold_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_stream_settles_what_the_batch_does(spark):
    """Rows that the stream settles carry the labels that a batch over all rows gives them."""
    e = spark.read.parquet(f"{SF}/events.parquet")
    rows = e.select("user_id", "event_id", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").alias("at"), "event_type", (F.col("value") / 20).alias("d"), F.least(F.lit(1.0), F.col("value") / 25).alias("c"))
    rows = rows.withColumn("at", F.row_number().over(Window.partitionBy("user_id").orderBy("at", "event_id")))
    batch = {(r.user_id, r.at): r.stable_label for r in stateful.hysteresis(rows, ["user_id"], "at", "event_type", "d", "c").collect()}
    place = {r.event_id: (r.user_id, r.at) for r in rows.collect()}
    stream = catalog.queries()["stream_stable_labels"](spark, SF).collect()
    assert stream and all(batch[place[r.event_id]] == r.stable_label for r in stream)


@pytest.fixture
def midnight(spark, tmp_path):
    """Two sensors of one camera that are seen together before and after a midnight, and once more two days on."""
    at = ["2024-01-01 22:30:00", "2024-01-01 23:30:00", "2024-01-02 00:30:00", "2024-01-02 01:30:00", "2024-01-04 12:00:00"]
    rows = [(10 * s + i, t, 4 * s, "view", 50.0 + s) for i, t in enumerate(at) for s in (1, 2) if not (s == 2 and i < 2)]
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double").withColumn("ts", F.to_timestamp_ntz("ts")).withColumn("props", F.lit("{}"))
    df.write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_duplicates_meet_over_midnight(spark, midnight):
    got = {r.track_id: r.duplicate_of for r in catalog.queries()["pair_dedup"](spark, midnight).collect()}
    a, b = 4 * stage.SESSIONS, 8 * stage.SESSIONS
    assert got == {a: None, b: a, a + 1: b + 1, b + 1: None}


def test_tracks_go_on_over_midnight(spark, midnight):
    got = {r.key: (r.day, r.island, r.track) for r in catalog.queries()["optimal_tracks"](spark, midnight).collect()}
    first, later = (0, 1), (3, 1)
    assert got == {**{k: (*first, 1) for k in (10, 11, 12, 13)}, 22: (*first, 2), 23: (*first, 2), 14: (*later, 1), 24: (*later, 2)}


def test_cuts_change_nothing_for_a_camera(spark):
    """The queries cut a camera's rows where nothing can cross; the operators without any cut give the same."""
    t = ordered.tracks(spark, SF)
    whole = stateful.suppress_duplicates(t, ["camera"], "track_id", "start_frame", "end_frame", "x_start", "hits", "conf_sum", 0.30, 120).toPandas()
    assert plain(catalog.queries()["pair_dedup"](spark, SF).toPandas()) == plain(whole)
    rows = ordered.events(spark, SF).select("camera", F.floor(F.col("frame") / 60).alias("frame"), "x", F.col("conf").alias("y"), F.col("event_id").alias("key"))
    cut, whole = catalog.queries()["optimal_tracks"](spark, SF), stateful.track_optimal(rows, ["camera"], 200.0, 6, 2)
    # The names of tracks differ, the rows that belong together do not.
    together = lambda df, *track: sorted(tuple(sorted(r.keys)) for r in df.groupBy("camera", *track).agg(F.collect_list("key").alias("keys")).collect())
    assert together(cut, "day", "island", "track") == together(whole, "track")
