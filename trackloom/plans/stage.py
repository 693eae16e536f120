"""Inputs of the named queries: the given tables in the roles of detections, tracks, units and readings.

Measures are integers (tenths), so that sums do not depend on their order. Each stage has its SQL twin for the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EPOCH = 1704067200  # 2024-01-01
SESSION_S = 43_200
#: Track ids of a sensor: a session takes half a day at least, so a million of them span more than 1300 years.
SESSIONS = 1_000_000
#: Frames (minutes) of a batch: one day's recording. What a camera sees is judged batch by batch.
BATCH = 1440
Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        CATALOG[f.__name__] = (f, sql)
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections: sensor, camera (0 to 3), batch, label, seconds and minutes since the epoch, confidence and place in tenths."""
    e = table(spark, sf_dir, "events")
    t = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)") - EPOCH
    tenths = lambda c: (c * 10).cast("long")
    return e.select("event_id", F.col("user_id").alias("sensor"), (F.col("user_id") % 4).alias("camera"), F.col("event_type").alias("label"), t.alias("t"), F.floor(t / 60).alias("frame"), F.floor(t / 86_400).alias("batch"), tenths(F.least(F.greatest("value", F.lit(0.0)), F.lit(100.0))).alias("conf"), tenths(F.col("value")).alias("x"), "props")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections with their sensor's session: half a day without any ends one. ``track_id`` is unique over sensors."""
    w = Window.partitionBy("sensor").orderBy("t", "event_id")
    e = events(spark, sf_dir).withColumn("gap", F.col("t") - F.lag("t").over(w))
    n = F.sum(F.when(F.col("gap") > SESSION_S, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return e.withColumn("track_id", F.col("sensor") * SESSIONS + n).drop("gap")


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions as tracks; one belongs to the batch in which it begins."""
    return sessions(spark, sf_dir).groupBy("camera", "sensor", "track_id").agg(F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame"), F.count("*").alias("hits"), F.sum("conf").alias("conf_sum"), F.min_by("x", F.struct("t", "event_id")).alias("x_start"), F.max_by("x", F.struct("t", "event_id")).alias("x_end"), F.floor(F.min("frame") / BATCH).alias("batch"))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("sensor").agg(F.min("frame").alias("f0"), (F.max("frame") - F.min("frame") + 1).alias("total_frames"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eleven-digit identifiers read from orders, some with a slip in the last digits, some too short."""
    o = table(spark, sf_dir, "orders")
    number = F.lit(10_000_000_000) + F.col("o_custkey") * 271_828_183 % 30_000_000_000 + F.when(F.col("o_orderkey") % 5 == 0, 3).otherwise(0)
    text = F.when(F.col("o_orderkey") % 11 == 0, F.substring(number.cast("string"), 1, 9)).otherwise(number.cast("string"))
    return o.select("o_orderkey", F.col("o_custkey").alias("unit"), text.alias("number"), (F.col("o_orderkey") % 97 + 1).alias("weight"))


EV = f"""ev AS (SELECT event_id, user_id AS sensor, user_id % 4 AS camera, event_type AS label, epoch_us(ts) // 1000000 - {EPOCH} AS t, (epoch_us(ts) // 1000000 - {EPOCH}) // 60 AS frame, (epoch_us(ts) // 1000000 - {EPOCH}) // 86400 AS batch,
  trunc(least(greatest(value, 0.0), 100.0) * 10)::BIGINT AS conf, trunc(value * 10)::BIGINT AS x, props FROM events)"""
SESS = EV + f""",
gaps AS (SELECT *, t - lag(t) OVER (PARTITION BY sensor ORDER BY t, event_id) AS gap FROM ev),
sess AS (SELECT * EXCLUDE (gap), sensor * {SESSIONS} + sum(CASE WHEN gap > {SESSION_S} THEN 1 ELSE 0 END) OVER (PARTITION BY sensor ORDER BY t, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS track_id FROM gaps)"""
TRK = SESS + f""",
trk AS (SELECT camera, sensor, track_id, min(frame) // {BATCH} AS batch, min(frame) AS start_frame, max(frame) AS end_frame, count(*) AS hits, sum(conf)::BIGINT AS conf_sum, arg_min(x, (t, event_id)) AS x_start, arg_max(x, (t, event_id)) AS x_end FROM sess GROUP BY ALL)"""
SPANS = "spans AS (SELECT sensor, min(frame) AS f0, max(frame) - min(frame) + 1 AS total_frames FROM ev GROUP BY sensor)"
READ = """rd AS (SELECT o_orderkey, o_custkey AS unit, CASE WHEN o_orderkey % 11 = 0 THEN substr(n::VARCHAR, 1, 9) ELSE n::VARCHAR END AS number, o_orderkey % 97 + 1 AS weight
  FROM (SELECT *, 10000000000 + o_custkey * 271828183 % 30000000000 + CASE WHEN o_orderkey % 5 = 0 THEN 3 ELSE 0 END AS n FROM orders))"""
