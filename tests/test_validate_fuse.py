from pyspark.sql import functions as F

from trackloom.operators import aggregates as A
from trackloom.operators import fuse as U
from trackloom.operators import validate as V


def hits(spark, tracks):
    rows = [("A", k, f, float(x), 0.9) for k, points in tracks.items() for f, x in points]
    df = spark.createDataFrame(rows, "camera string, track_id long, frame long, x double, c double")
    confidence = df.groupBy("camera", "track_id").agg(F.avg("c").alias("confidence"))
    return A.motion_features(df, ["camera", "track_id"], "frame", "x", 15.0).join(confidence, ["camera", "track_id"])


def moving(start, step=20, n=12):
    return [(start + k, 100 + step * k) for k in range(n)]


def test_cascade_accounts_for_every_track(spark):
    tracks = {k: moving(40 * k) for k in range(1, 7)} | {10: [(400, 5), (401, 6)], 11: [(500 + k, 300) for k in range(12)], 12: moving(600, -20), 13: [(700 + k, 100 + 40 * (k % 2) + 2 * k) for k in range(12)], 14: [(800, 0), (860, 500), (861, 520)]}
    features = hits(spark, tracks)
    out = {r.track_id: (r.reason, r.severity) for r in V.cascade(features, ["camera"], "track_id").collect()}
    assert set(out) == set(tracks)
    assert all(out[k] == (None, None) for k in range(1, 7))
    assert [out[k][0] for k in (10, 11, 12, 13, 14)] == ["TOO_SHORT", "STATIC", "WRONG_DIRECTION", "INCONSISTENT_TRAJECTORY", "DETECTION_GAP"]


def test_stalled_tracks_need_company(spark):
    tracks = {k: moving(40 * k) for k in range(1, 7)} | {20: [(500 + k, 300 + k % 2) for k in range(12)], 21: [(505 + k, 600 + k % 2) for k in range(12)], 22: [(900 + k, 300) for k in range(12)]}
    out = {r.track_id: (r.reason, r.paused) for r in V.cascade(hits(spark, tracks), ["camera"], "track_id").collect()}
    assert out[20] == (None, True) and out[21] == (None, True) and out[22] == ("STATIC", False)


def test_rejected_rows_tell_all(spark):
    tracks = {k: moving(40 * k) for k in range(1, 7)} | {10: [(400, 5), (401, 6)], 11: [(130 + k, 300) for k in range(12)], 12: [(145 + k, 900 + 40 * (k % 2) + 3 * k) for k in range(12)], 13: [(20 + k, 500) for k in range(12)]}
    features = hits(spark, tracks).withColumn("min_confidence", F.col("confidence") - 0.25)
    judged = V.cascade_tail(V.cascade(features, ["camera"], "track_id"), ["camera"], "track_id").withColumn("lo", F.lit(30)).withColumn("hi", F.lit(300))
    back = spark.createDataFrame([("A", 12, True)], "camera string, track_id long, recovered boolean")
    out = V.rejection_report(judged, back, ["camera"], "track_id", 10.0)
    assert len(out.columns) == 26
    rows = {r.track_id: r for r in out.collect()}
    assert set(rows) == {10, 11, 12, 13}
    assert [(rows[k].reason, rows[k]["class"], rows[k].train_state, rows[k].detail) for k in (10, 11, 13)] == [("TOO_SHORT", "HARD", "POST_WAGON", "track_frames=2"), ("STATIC", "HARD", "WAGON_ACTIVE", "displacement=0"), ("STATIC", "HARD", "PRE_WAGON", "displacement=0")]
    assert (rows[12].reason, rows[12].train_state, rows[12].ref_kind) == ("INCONSISTENT_TRAJECTORY", "WAGON_ACTIVE", "-")
    # Accepted tracks begin at 40, 80, ..., 240 frames, ten a second.
    assert [(rows[k].nearest_prev_s, rows[k].nearest_next_s) for k in (10, 11, 12, 13)] == [(24.0, None), (12.0, 16.0), (12.0, 16.0), (None, 4.0)]
    assert [rows[k].recovery for k in (10, 11, 13)] == ["-", "blocked: hard reason", "-"]
    assert (rows[11].frames, rows[11].time_s, rows[11].duration_s, round(rows[11].min_conf, 2), rows[11].speed_px_s) == ("130-141", 13.0, 1.2, 0.65, 0.0)


def test_recovery_never_lifts_hard_reasons(spark):
    rows = [(1, "A", "LOW_CONFIDENCE", "SOFT", 50, 60, 90.0, 0.9, 1, 0.9, 5, 0.4), (2, "A", "STATIC", "HARD", 50, 60, 90.0, 0.9, 1, 0.9, 5, 0.9), (3, "A", "LOW_MOTION", "SOFT", 500, 600, 90.0, 0.9, 1, 0.9, 5, 0.9), (4, "A", "LOW_MOTION", "SOFT", 50, 60, 2.0, 0.9, 1, 0.9, 5, 0.9)]
    df = spark.createDataFrame(rows, "track_id long, camera string, reason string, severity string, start_frame long, end_frame long, displacement double, path_efficiency double, direction int, monotonic double, n_steps long, confidence double")
    spans = spark.createDataFrame([("A", 0, 100)], "camera string, lo long, hi long")
    assert {r.track_id: r.outcome for r in V.recoverable(df, spans, ["camera"]).collect()} == {1: "CANDIDATE", 2: "BLOCKED", 3: "OUTSIDE", 4: "BLOCKED"}


def test_roster_problems(spark):
    rows = [("A", "GW_1", 1, 0, 9), ("A", "GW_2", 2, 10, 5), ("A", "GW_9", 3, 4, 20)]
    df = spark.createDataFrame(rows, "camera string, unit_id string, unit_index int, start_frame long, end_frame long")
    assert sorted((r.unit_id, r.problem) for r in V.roster_problems(df, ["camera"]).collect()) == [("GW_2", "span runs backwards"), ("GW_9", "id does not match the index"), ("GW_9", "span overlaps the one before")]


def test_fingerprint_ignores_row_order_and_sees_changes(spark):
    df = spark.createDataFrame([("A", k, f"v{k}") for k in range(9)], "g string, k int, v string")
    f = lambda d: A.ordered_fingerprint(d, ["g"], "k", [F.col("k").cast("string"), F.col("v")]).first().fingerprint
    assert f(df) == f(df.orderBy(F.desc("k"))) != f(df.withColumn("v", F.when(F.col("k") == 4, "x").otherwise(F.col("v"))))


def test_repeated_evidence_beats_one_confident_outlier(spark):
    rows = [(1, "CLOSED", f, 0.6) for f in range(5)] + [(1, "OPEN", 9, 0.99), (2, "OPEN", 1, 0.9)]
    df = spark.createDataFrame(rows, "u int, state string, frame int, c double")
    assert {r.u: (r.state, r.reason) for r in A.resolve_state(df, ["u"], "state", "frame", "c").collect()} == {1: ("CLOSED", None), 2: (None, "insufficient_frame_support")}


def test_anomalies_in_order(spark):
    a = U.unit_anomalies(F.lit("WAGON"), F.lit("open"), F.lit("PARTIAL_OPEN"), F.lit(True), F.lit(None).cast("string"), F.lit("NO_DATA"))
    assert spark.range(1).select(a).first()[0] == ["LEFT DOOR OPEN", "PARTIAL DOOR", "DAMAGE", "NO IDENTIFIER", "NO LOAD DATA"]
    a = U.unit_anomalies(F.lit("ENGINE"), F.lit("CLOSED"), F.lit("CLOSED"), F.lit(False), F.lit(None).cast("string"), F.lit(None).cast("string"))
    assert spark.range(1).select(a).first()[0] == []


def test_loaded_units_hide_one_kind_only(spark):
    seen = spark.createDataFrame([(1, "floor_damage"), (1, "dent"), (2, "floor_damage"), (3, "floor_damage"), (1, None)], "u int, kind string")
    loads = spark.createDataFrame([(1, "LOADED"), (2, "EMPTY")], "u int, state string")
    out = U.suppress_for_loaded(seen, loads, "u", "kind", "state")
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, "dent"), (2, "floor_damage"), (3, "floor_damage"), (1, None)], key=repr)
