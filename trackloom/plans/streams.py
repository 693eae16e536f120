"""Named queries that run as streams to the end of the given events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.plans.stage import query
from trackloom.streaming import streams as T


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.detection_stream(spark, f"{sf_dir}/events.parquet")


def _plain(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as seconds, which do not depend on the session's time zone."""
    for c in columns:
        df = df.withColumn(c, F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST({c} AS TIMESTAMP_NTZ))"))
    return df


@query("SELECT epoch_us(time_bucket(INTERVAL 6 HOUR, ts)) // 1000000 AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of windows, the open ones as they stand; a window's state goes once the watermark has passed it."""
    return _plain(T.run(T.window_counts(_events(spark, sf_dir), "6 hours"), "update", keys=["start", "event_type"]), "start")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM g)
SELECT user_id, epoch_us(min(ts)) // 1000000 AS first_ts, count(*) AS hits FROM s GROUP BY user_id, n HAVING max(ts) + INTERVAL 12 HOUR <= (SELECT max(ts) - INTERVAL 30 MINUTE FROM events)""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that have ended, half an hour of late rows allowed for; the others are held in state until they do."""
    return _plain(T.run(T.sessions(_events(spark, sf_dir), "12 hours")), "first_ts")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_emit_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.run(T.emit_once(_events(spark, sf_dir), ["user_id", "event_type"]))


@query()
def stream_stable_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the stream has settled; challenges that are open when the events end stay in its state, and so give no row."""
    return T.run(T.stable_labels(_events(spark, sf_dir)))
