"""Named queries over boxes: trackers in batch and as streams, duplicates of a class, looks of tracks, and batches that wait for cameras."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.functions import scalars as S
from trackloom.operators import tracking
from trackloom.operators.stateful import StreakConfig
from trackloom.plans.relational import _SAME, identity_pairs, identity_tracks
from trackloom.plans.stage import BATCH, EV, SESS, events, query, sessions, table
from trackloom.streaming import streams as T
from trackloom.streaming import trackers

#: Frames of the box trackers: six hours.
STEP = 360


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box for each detection: its place and confidence on a picture of 848 by 480, its look the shares of its last digits."""
    e = events(spark, sf_dir)
    x, y = (F.col("x") % 848).cast("double"), (F.col("conf") % 480).cast("double")
    look = F.array(*[(F.col("conf") % k).cast("double") for k in (7, 11, 13)])
    return e.select("camera", "batch", "sensor", F.timestamp_seconds(F.col("t") + 1704067200).alias("ts"), F.floor(F.col("frame") / STEP).alias("frame"), (x - 100).alias("x1"), (y - 100).alias("y1"), (x + 100).alias("x2"), (y + 100).alias("y2"), F.when(F.col("label") != "error", look).alias("look"), F.col("event_id").alias("key"), "label", (F.col("conf") / 1000).alias("confidence"), F.col("frame").alias("minute"))


TRACKS = tracking.BoxConfig(min_hits=2, max_missed=8, min_iou=0.01, tentative=4, revive_frames=40, revive_iou=0.1)


@query()
def box_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sensor's boxes as tracks: by distance, overlap and look, against the direction only by a little, with exits and revivals."""
    return tracking.track_boxes(_boxes(spark, sf_dir), ["sensor"], TRACKS)


@query()
def stream_box_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tracker as a stream with keyed state; what the watermark has not passed waits in its state."""
    e = T.detection_stream(spark, f"{sf_dir}/events.parquet")
    tenths = lambda c: (c * 10).cast("long")
    conf = tenths(F.least(F.greatest("value", F.lit(0.0)), F.lit(100.0)))
    x, y = (tenths(F.col("value")) % 848).cast("double"), (conf % 480).cast("double")
    look = F.array(*[(conf % k).cast("double") for k in (7, 11, 13)])
    frame = F.floor((F.unix_timestamp("ts") - 1704067200) / (60 * STEP))
    rows = e.select(F.col("user_id").alias("camera"), "ts", frame.alias("frame"), (x - 100).alias("x1"), (y - 100).alias("y1"), (x + 100).alias("x2"), (y + 100).alias("y2"), F.when(F.col("event_type") != "error", look).alias("look"), F.col("event_id").alias("key"))
    with trackers.keyed_state(spark):
        return T.run(trackers.box_tracks(rows, TRACKS, "60 days"))


@query()
def door_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doors of every sensor: tracks, their states by streaks and the evidence, over all steps of its footage, the empty ones included."""
    b = _boxes(spark, sf_dir)
    names = F.create_map(*[F.lit(v) for v in ("view", "open", "click", "closed", "signup", "partial_closed", "error", "damage", "purchase", "open")])
    rows = b.select("sensor", F.col("frame").alias("step"), F.col("minute").alias("frame"), "key", "x1", "y1", "x2", "y2", "look", names[F.col("label")].alias("label"), "confidence")
    ends = rows.groupBy("sensor").agg(F.min("step").alias("a"), F.max("step").alias("b"))
    steps = ends.select("sensor", F.explode(F.sequence("a", "b")).alias("step")).join(rows.select("sensor", "step").distinct(), ["sensor", "step"], "left_anti")
    nothing = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns[3:]]
    empty = steps.select("sensor", "step", (F.col("step") * STEP).alias("frame"), *nothing)
    return tracking.door_run(rows.unionByName(empty), ["sensor"], TRACKS, StreakConfig(open_confidence=0.1, closed_confidence=0.1, open_rows=2, closed_rows=2))


_CLASSES = EV + """, bx AS (SELECT {'b': batch, 'c': camera, 'l': label} AS g, row_number() OVER (PARTITION BY batch, camera, label ORDER BY conf DESC, t % 5 DESC, event_id) AS i,
  {'k': event_id, 'x1': (x % 848 - 20 - t % 80)::DOUBLE, 'y1': (conf % 480 - 20 - t % 60)::DOUBLE, 'x2': (x % 848 + 20 + t % 80)::DOUBLE, 'y2': (conf % 480 + 20 + t % 60)::DOUBLE} AS r FROM ev),
f(g, i, kept, k, stays) AS (SELECT g, 1::BIGINT, [r], r.k, true FROM bx WHERE i = 1
  UNION ALL SELECT g, i, CASE WHEN clash THEN kept ELSE list_append(kept, r) END, r.k, NOT clash FROM (SELECT n.g, n.i, n.r, f.kept, len(list_filter(f.kept, lambda s: ((s.x1 + s.x2 - n.r.x1 - n.r.x2) / 2) ** 2 + ((s.y1 + s.y2 - n.r.y1 - n.r.y2) / 2) ** 2 < 10000
    OR (least(s.x2, n.r.x2) > greatest(s.x1, n.r.x1) AND least(s.y2, n.r.y2) > greatest(s.y1, n.r.y1) AND (least(s.x2, n.r.x2) - greatest(s.x1, n.r.x1)) * (least(s.y2, n.r.y2) - greatest(s.y1, n.r.y1))
      / greatest(1, (s.x2 - s.x1) * (s.y2 - s.y1) + (n.r.x2 - n.r.x1) * (n.r.y2 - n.r.y1) - (least(s.x2, n.r.x2) - greatest(s.x1, n.r.x1)) * (least(s.y2, n.r.y2) - greatest(s.y1, n.r.y1))) >= 0.2))) > 0 AS clash FROM f JOIN bx n ON n.g = f.g AND n.i = f.i + 1))"""


@query(f"WITH RECURSIVE {_CLASSES} SELECT g.b AS batch, g.c AS camera, k AS track_id, stays AS kept FROM f")
def class_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a batch's boxes of one class that are near each other or overlap, the most confident stays."""
    x, y, t = F.col("x") % 848, F.col("conf") % 480, F.col("t")
    rows = events(spark, sf_dir).select("batch", "camera", F.col("event_id").alias("track_id"), F.col("label").alias("class"), *[c.cast("double").alias(n) for n, c in (("x1", x - 20 - t % 80), ("y1", y - 20 - t % 60), ("x2", x + 20 + t % 80), ("y2", y + 20 + t % 60))], F.col("conf").alias("confidence"), (t % 5).alias("hits"))
    return tracking.suppress_alike(rows, ["batch", "camera"])


_LOOK_SQL = """CASE WHEN len({a}) > 0 AND len({a}) = len({b}) THEN (list_inner_product(list_transform({a}, lambda x: x::DOUBLE - list_avg({a}::DOUBLE[])), list_transform({b}, lambda x: x::DOUBLE - list_avg({b}::DOUBLE[])))
  / sqrt(list_inner_product(list_transform({a}, lambda x: x::DOUBLE - list_avg({a}::DOUBLE[])), list_transform({a}, lambda x: x::DOUBLE - list_avg({a}::DOUBLE[]))) * list_inner_product(list_transform({b}, lambda x: x::DOUBLE - list_avg({b}::DOUBLE[])), list_transform({b}, lambda x: x::DOUBLE - list_avg({b}::DOUBLE[])))) + 1) / 2 ELSE 0.5 END"""


@query(f"""WITH v AS (SELECT vec_id, embedding AS e, trunc(embedding[1]::DOUBLE * 1000)::BIGINT AS x, trunc(embedding[2]::DOUBLE * 1000)::BIGINT AS y FROM embeddings)
SELECT a.vec_id AS a, b.vec_id AS b, round({_LOOK_SQL.format(a="a.e", b="b.e")}, 6) AS alike FROM v a JOIN v b ON a.vec_id < b.vec_id AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 900""")
def context_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that lie within 30 of each other, found by neighbouring cells, and how alike their histograms are; what a histogram needs is worked out once a row."""
    at = lambda k: (F.col("embedding")[k].cast("double") * 1000).cast("long")
    v = table(spark, sf_dir, "embeddings").select("vec_id", at(0).alias("x"), at(1).alias("y"), S.look_of(F.col("embedding")).alias("look"))
    return tracking.alike_within(v, "vec_id", "x", "y", "look", 30).withColumn("alike", F.round("alike", 6))


_SUMMARY = SESS + """, summ AS (SELECT track_id, min(frame) AS first_frame, max(frame) AS last_frame, count(*) AS total_hits, arg_max(label, (t, event_id)) AS final_state, round(avg(conf), 4) AS confidence, bool_or(label = 'purchase') AS opened,
  round(avg(x), 4) AS center_x, round(avg(conf), 4) AS center_y, arg_min(event_id, (-conf, event_id)) AS snapshot FROM sess GROUP BY track_id)"""


def track_looks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is kept of a track to tell whether another one is the same: its span, state and place, its best snapshot and that one's histogram, if there is one."""
    s = sessions(spark, sf_dir).groupBy("track_id").agg(
        F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"), F.count("*").alias("total_hits"), F.max_by("label", F.struct("t", "event_id")).alias("final_state"), F.round(F.avg("conf"), 4).alias("confidence"),
        F.bool_or(F.col("label") == "purchase").alias("opened"), F.round(F.avg("x"), 4).alias("center_x"), F.round(F.avg("conf"), 4).alias("center_y"), F.min_by("event_id", F.struct(-F.col("conf"), F.col("event_id"))).alias("snapshot"))
    return s.join(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("snapshot"), F.col("embedding").alias("look")), "snapshot", "left")


@query(f"WITH {_SUMMARY} SELECT summ.*, coalesce(len(embedding), 0)::INT AS look_size FROM summ LEFT JOIN embeddings ON vec_id = snapshot")
def track_look_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return track_looks(spark, sf_dir).withColumn("look_size", F.coalesce(F.size("look"), F.lit(0))).drop("look")


@query(f"""WITH RECURSIVE {_SAME}, {_SUMMARY.split("summ AS", 1)[1].join(["summ AS", ""])}
SELECT p.a, p.b, round({_LOOK_SQL.format(a="ea.embedding", b="eb.embedding")}, 6) AS alike FROM p JOIN summ sa ON sa.track_id = p.a JOIN summ sb ON sb.track_id = p.b LEFT JOIN embeddings ea ON ea.vec_id = sa.snapshot LEFT JOIN embeddings eb ON eb.vec_id = sb.snapshot""")
def identity_looks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How alike the looks of tracks are that may be one; 0.5 where one of them has none."""
    # A track takes its look along, so the pairs, as many as there are, go out as they are met.
    t = identity_tracks(spark, sf_dir).join(track_looks(spark, sf_dir).select("track_id", "look"), "track_id")
    return identity_pairs(t).select(F.col("track_id").alias("a"), F.col("track_id_b").alias("b"), F.round(S.alike(F.col("look"), F.col("look_b")), 6).alias("alike"))


LABELS = ("click", "error", "purchase", "signup", "view")


@query("""WITH a AS (SELECT user_id % 4 || ':' || (epoch_us(ts) // 1000000 - 1704067200) // 21600 AS batch_key, event_type AS label, min(epoch_us(ts) // 1000) AS tm FROM events GROUP BY ALL),
d AS (SELECT batch_key, min(tm) + 7200000 AS deadline FROM a GROUP BY batch_key),
w AS (SELECT max(epoch_us(ts)) // 1000 - 1800000 AS mark FROM events),
r AS (SELECT batch_key, deadline, count(*) FILTER (tm <= deadline) AS n, max(tm) FILTER (tm <= deadline) AS last, list(label) FILTER (tm <= deadline) AS there FROM a JOIN d USING (batch_key) GROUP BY ALL)
SELECT batch_key, CASE n WHEN 5 THEN 'FULL' ELSE 'PARTIAL' END AS kind, n AS cameras, array_to_string(list_filter(['click', 'error', 'purchase', 'signup', 'view'], lambda l: NOT list_contains(there, l)), ',') AS names, CASE n WHEN 5 THEN last ELSE deadline END AS "at" FROM r, w WHERE n = 5 OR deadline < mark
UNION ALL SELECT a.batch_key, 'LATE', 1, a.label, a.tm FROM a JOIN r USING (batch_key), w WHERE a.tm > r.deadline AND r.deadline < mark""")
def stream_ready_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters of a day of each camera, let go when all kinds of events are there, or two hours after the first came."""
    e = T.detection_stream(spark, f"{sf_dir}/events.parquet")
    key = F.concat_ws(":", (F.col("user_id") % 4).cast("string"), F.floor((F.unix_timestamp("ts") - 1704067200) / 21600).cast("string"))
    with trackers.keyed_state(spark):
        return T.run(trackers.ready_batches(e.select(key.alias("batch_key"), F.col("event_type").alias("camera"), "ts"), LABELS, "2 hours", "60 days"))
