from datetime import datetime, timedelta

import pytest
from test_tracking import frames

from trackloom.operators import tracking as K
from trackloom.streaming import streams as T
from trackloom.streaming import trackers as R

START = datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def store(spark):
    with R.keyed_state(spark):
        yield


def put(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("cfg", [K.BoxConfig(max_missed=5), K.BoxConfig(max_missed=4, sightings=3, revive_frames=20)])
def test_a_stream_over_restarts_equals_the_batch(spark, tmp_path, cfg):
    schema = "camera int, ts timestamp_ntz, frame long, x1 double, y1 double, x2 double, y2 double, look array<double>, key long"
    data = [(g, START + timedelta(seconds=f), f, *b[1:6], g * 10_000 + b[0]) for g in range(3) for f, seen in frames(g, 40) for b in seen]
    source, folder = f"{tmp_path}/boxes", f"{tmp_path}/work"
    # Three runs, each from the state of the one before; within the delay rows come out of order. The last row moves the watermark past all.
    for part in range(3):
        rows = [r for r in data if (r[2] + (r[8] % 3 == 0) * 2) * 3 // 45 == part]
        put(spark, source, rows + ([(9, START + timedelta(days=1), 10**6, 0.0, 0.0, 1.0, 1.0, None, -1)] if part == 2 else []), schema)
        out = T.run(R.box_tracks(T.detection_stream(spark, source, "5 seconds"), cfg, "2 days"), folder=folder)
    got = sorted((r.camera, r.frame, r.key, r.track, r.event) for r in out.where("camera < 9").na.fill(-1).collect())
    want = K.track_boxes(spark.createDataFrame(data, schema), ["camera"], cfg).na.fill(-1)
    assert got == sorted((r.camera, r.frame, r.key, r.track, r.event) for r in want.collect()) and len(got) > 300


def test_a_silent_camera_begins_anew(spark, tmp_path):
    schema = "camera int, ts timestamp_ntz, frame long, x1 double, y1 double, x2 double, y2 double, look array<double>, key long"
    source, folder = f"{tmp_path}/boxes", f"{tmp_path}/work"
    row = lambda c, minute, key: (c, START + timedelta(minutes=minute), minute, 0.0, 0.0, 50.0, 50.0, None, key)
    run = lambda: sorted((r.camera, r.key, r.track, r.event) for r in T.run(R.box_tracks(T.detection_stream(spark, source, "1 minute"), K.BoxConfig(max_missed=10**6, tentative=10**6), "2 hours"), folder=folder).where("camera < 9").collect())
    put(spark, source, [row(1, 0, 10), row(2, 0, 20), row(2, 5, 21), row(9, 60, 90)], schema)
    assert run() == [(1, 10, 1, "NEW"), (2, 20, 1, "NEW"), (2, 21, 1, "MATCH")]
    put(spark, source, [row(2, 100, 22), row(9, 200, 91)], schema)
    run()
    put(spark, source, [row(1, 201, 11), row(2, 202, 23), row(9, 300, 92)], schema)
    assert run()[-5:] == [(1, 11, 1, "NEW"), (2, 20, 1, "NEW"), (2, 21, 1, "MATCH"), (2, 22, 1, "MATCH"), (2, 23, 1, "MATCH")]


def test_batches_wait_for_their_cameras(spark, tmp_path):
    source, folder = f"{tmp_path}/arrivals", f"{tmp_path}/work"
    row = lambda b, c, m: (b, c, START + timedelta(minutes=m))
    ms = lambda m: int((START - datetime(1970, 1, 1)).total_seconds() * 1000) + m * 60_000
    schema = "batch_key string, camera string, ts timestamp_ntz"

    def run():
        stream = R.ready_batches(T.detection_stream(spark, source, "5 minutes"), ["a", "b", "c"], "30 minutes", "1 day")
        return sorted(map(tuple, T.run(stream, folder=folder).where("batch_key <> 'clock'").collect()))

    put(spark, source, [row("full", "a", 0), row("full", "b", 3), row("full", "c", 20), row("part", "a", 1), row("part", "a", 2), row("part", "x", 2), row("edge", "b", 10), row("edge", "a", 40), row("edge", "c", 41)], schema)
    full = [("full", "FULL", 3, "", ms(20))]
    # "edge" has passed its deadline by what is seen already: c came a minute after it. "part" has until minute 31.
    first = run()
    assert [r for r in first if r[0] == "full"] == full and len([r for r in first if r[0] == "part"]) <= 1
    put(spark, source, [row("clock", "a", 60), row("part", "b", 55)], schema)  # b is late, but not too late to be read
    run()
    put(spark, source, [row("clock", "b", 61), row("full", "a", 61)], schema)
    again = run()
    assert again == run()  # nothing new, nothing again
    assert again == sorted([*full, ("part", "PARTIAL", 1, "b,c", ms(31)), ("part", "LATE", 1, "b", ms(55)), ("edge", "PARTIAL", 2, "c", ms(40)), ("edge", "LATE", 1, "c", ms(41))])
