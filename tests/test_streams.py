from datetime import datetime, timedelta

from trackloom.streaming import streams as T

START = datetime(2024, 1, 1)


def put(spark, folder, rows):
    data = [(k, START + timedelta(minutes=m), u, e, v) for k, m, u, e, v in rows]
    spark.createDataFrame(data, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").coalesce(1).write.mode("append").parquet(folder)


def test_a_second_run_reads_only_what_is_new(spark, tmp_path):
    source, folder = f"{tmp_path}/events", f"{tmp_path}/work"
    put(spark, source, [(1, 0, 7, "view", 1.0), (2, 1, 7, "view", 1.0)])
    once = lambda: T.run(T.emit_once(T.detection_stream(spark, source), ["user_id", "event_type"]), folder=folder)
    assert [tuple(r) for r in once().collect()] == [(7, "view")]
    put(spark, source, [(3, 2, 7, "view", 1.0), (4, 3, 7, "click", 1.0)])
    assert sorted(map(tuple, once().collect())) == [(7, "click"), (7, "view")]


def test_open_challenge_survives_between_batches(spark, tmp_path):
    source, folder = f"{tmp_path}/events", f"{tmp_path}/work"
    put(spark, source, [(1, 0, 7, "view", 24.0), (2, 1, 7, "click", 19.0)])
    labels = lambda: {r.event_id: (r.stable_label, r.held) for r in T.run(T.stable_labels(T.detection_stream(spark, source)), folder=folder).collect()}
    assert labels() == {1: ("view", False)}
    put(spark, source, [(3, 2, 7, "click", 19.0)])
    assert labels() == {1: ("view", False), 2: ("click", False), 3: ("click", False)}


def test_late_rows_do_not_reopen_closed_windows(spark, tmp_path):
    source, folder = f"{tmp_path}/events", f"{tmp_path}/work"
    put(spark, source, [(1, 0, 7, "view", 1.0)])
    counts = lambda: sorted((r.start, r.n) for r in T.run(T.window_counts(T.detection_stream(spark, source), "1 hour"), folder=folder).collect())
    assert counts() == []
    put(spark, source, [(2, 600, 7, "view", 1.0)])
    assert counts() == [(START, 1)]
    put(spark, source, [(3, 5, 7, "view", 1.0), (4, 1200, 7, "view", 1.0)])
    assert counts() == [(START, 1), (START + timedelta(hours=10), 1)]


def test_keys_are_forgotten_after_a_silence(spark, tmp_path):
    """State of a key goes with the watermark; a key that comes again later is told again, one that goes on is not."""
    source, folder = f"{tmp_path}/events", f"{tmp_path}/work"
    told = lambda: sorted(map(tuple, T.run(T.emit_once(T.detection_stream(spark, source), ["user_id", "event_type"], forget="2 hours"), folder=folder).collect()))
    put(spark, source, [(1, 0, 7, "view", 1.0), (2, 1, 8, "view", 1.0)])
    assert told() == [(7, "view"), (8, "view")]
    put(spark, source, [(3, 100, 8, "view", 1.0)])
    assert told() == [(7, "view"), (8, "view")]
    put(spark, source, [(4, 190, 9, "view", 1.0)])
    assert told() == [(7, "view"), (8, "view"), (9, "view")]
    put(spark, source, [(5, 200, 7, "view", 1.0), (6, 201, 8, "view", 1.0)])
    assert told() == [(7, "view"), (7, "view"), (8, "view"), (9, "view")]


def test_windows_in_update_mode_are_whole_and_end_with_the_watermark(spark, tmp_path):
    source, folder = f"{tmp_path}/events", f"{tmp_path}/work"
    counts = lambda: sorted((r.start, r.n) for r in T.run(T.window_counts(T.detection_stream(spark, source), "1 hour"), "update", folder, ["start", "event_type"]).collect())
    put(spark, source, [(1, 0, 7, "view", 1.0)])
    assert counts() == [(START, 1)]
    put(spark, source, [(2, 10, 7, "view", 1.0), (3, 600, 7, "view", 1.0)])
    assert counts() == [(START, 2), (START + timedelta(hours=10), 1)]
    put(spark, source, [(4, 5, 7, "view", 1.0)])
    assert counts() == [(START, 2), (START + timedelta(hours=10), 1)]
