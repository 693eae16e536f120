from pyspark.sql import functions as F

from trackloom.sources import store as S


def test_tracks_round_trip(spark, tmp_path):
    row = ("CAM", 1, 0, 9, 0.5, 3, 15.0, 1.0, "gap", [1.0, 2.0], [0, 9], [(0.0, 1.0, 2.0, 3.0)])
    df = spark.createDataFrame([row], S.TRACK)
    S.write_tracks(df, f"{tmp_path}/t")
    assert [tuple(r) for r in S.read_tracks(spark, f"{tmp_path}/t").select(*df.columns).collect()] == [tuple(r) for r in df.collect()]


def test_documents_are_read_with_defaults(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text('{"schema":"v1","master_camera":"A","fps":{"A":15.0,"B":0.0},"offsets":{"A":{"delta":0.0,"status":"REFERENCE"},"B":{"delta":3.0,"status":"UNRESOLVED"}}}\nbroken {\n{"master_camera":null}\n')
    df = S.read_json(spark, str(path), S.STATE, {"schema": "v0", "master_camera": "A"})
    assert sorted(r.schema for r in df.select("schema").collect()) == ["v0", "v1"]
    assert [tuple(r) for r in S.camera_rates(df).collect()] == [("A", 15.0)]
    assert sorted(map(tuple, S.usable_offsets(df).collect())) == [("A", 0.0), ("B", 0.0)]


def test_lifecycle(spark):
    states = [*S.LIFECYCLE, "FAILED", "odd"]
    df = spark.createDataFrame([(a, b) for a in states for b in states], "a string, b string")
    ok = {(r.a, r.b) for r in df.where(S.advance(F.col("a"), F.col("b"))).collect()}
    assert ok == {*zip(S.LIFECYCLE, S.LIFECYCLE[1:]), *((s, "FAILED") for s in S.LIFECYCLE[:-1])}


def test_batches_wait_for_every_camera(spark):
    rows = [("b1", "A", "SEALED"), ("b1", "B", "FAILED"), ("b2", "A", "FAILED"), ("b2", "B", "SEALED"), ("b3", "A", "SEALED"), ("b3", "B", "TRACKING")]
    df = spark.createDataFrame(rows, "batch string, camera string, state string")
    assert {r.batch: (r.ready, r.failed) for r in S.ready_to_assemble(df, "batch", "camera", "state", "A").collect()} == {"b1": (True, 1), "b2": (False, 1), "b3": (False, 0)}


def test_units_replace_only_their_batch(spark, tmp_path):
    path = f"{tmp_path}/u"
    S.write_units(spark.createDataFrame([("b1", 1), ("b2", 2)], "batch_key string, n int"), path)
    S.write_units(spark.createDataFrame([("b2", 3)], "batch_key string, n int"), path)
    assert sorted((r.batch_key, r.n) for r in spark.read.parquet(path).collect()) == [("b1", 1), ("b2", 3)]


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("A", 1)], "camera string, n int")
    S.write_csv(df, f"{tmp_path}/c")
    assert spark.read.option("header", "true").csv(f"{tmp_path}/c").first().camera == "A"
    assert S.as_documents(df, "report.v1", "camera").first().document == '{"schema":"report.v1","camera":"A","n":1}'


def test_files_become_batches(spark, tmp_path):
    names = ["yard_20240101_120000_left.mp4", "yard_20240101_120000_right.mp4", "yard_20240102_080000_left.mp4", "yard_20240101_120000_left.txt", "odd.mp4", "yard_20240101_120000_roof.mp4"]
    (tmp_path / "deep").mkdir()
    for k, n in enumerate(names):
        ((tmp_path / "deep" if k % 2 else tmp_path) / n).write_bytes(b"x" * (k + 1))
    files = S.find_files(spark, str(tmp_path))
    assert sorted((r.camera_id or "", r.batch_key or "", r.length) for r in files.collect()) == [("", "", 5), ("left", "20240101_120000", 1), ("left", "20240102_080000", 3), ("right", "20240101_120000", 2), ("roof", "20240101_120000", 6)]
    got = {r.batch_key: (sorted(r.files), r.missing, r.complete) for r in S.local_batches(files, ["left", "right"]).collect()}
    assert got == {"20240101_120000": (["left", "right"], [], True), "20240102_080000": (["left"], ["right"], False)}


def test_json_lines_by_batch(spark, tmp_path):
    df = spark.createDataFrame([("b1", "detect", 1.5), ("b1", "fuse", 0.5), ("b2", "detect", 2.0)], "batch string, stage string, seconds double")
    S.write_json(df, f"{tmp_path}/t", "batch")
    assert sorted((r.batch, r.stage, r.seconds) for r in spark.read.json(f"{tmp_path}/t").collect()) == [("b1", "detect", 1.5), ("b1", "fuse", 0.5), ("b2", "detect", 2.0)]
