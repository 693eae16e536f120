"""Streams of detections: windows, sessions, emit-once events and hysteresis with keyed state.

Every stream runs with a watermark, so state is dropped as event time passes; a run to the end of the input uses ``availableNow``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from trackloom.operators.graph import shared_root
from trackloom.operators.stateful import Hysteresis, HysteresisConfig


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see."""
    return f"{shared_root(spark, 'spark-streams-')}/{name}-{uuid.uuid4().hex}"


def detection_stream(spark: SparkSession, path: str, delay: str = "30 minutes") -> DataFrame:
    """The detections of a Parquet file or folder as a stream; new files are read as they come.

    The path is given as a pattern that only it matches, since the stream source takes a plain path for a folder.
    """
    schema = spark.read.parquet(path).schema
    rows = spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")
    return rows.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)


def run(stream: DataFrame, mode: str = "append", folder: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Runs over all that is there now and gives the sink's content. In append mode windows and sessions come when the watermark has passed them, and
    their state goes; those still open stay in state. In update mode each batch adds the rows that changed, and the latest row of each of ``keys``
    is given; in complete mode a batch replaces all, and all state is kept.

    With the ``folder`` of an earlier run it goes on from there: what was read is not read again, and state is kept.
    """
    spark = stream.sparkSession
    folder = folder or shared_folder(spark, "stream")

    def write(batch: DataFrame, number: int) -> None:
        if mode == "complete":
            batch.write.mode("overwrite").parquet(f"{folder}/out")
        else:
            batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")  # a repeated batch replaces itself

    stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    if mode == "update" and keys:
        rows = spark.read.schema(stream.schema).parquet(f"{folder}/out")
        latest = F.max_by(F.struct(*[c for c in stream.columns if c not in keys]), "batch").alias("latest")
        return rows.groupBy(*keys).agg(latest).select(*keys, "latest.*").select(*stream.columns)
    return spark.read.schema(stream.schema).parquet(f"{folder}/out").select(*stream.columns)


def window_counts(stream: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """Rows by event type in tumbling, or sliding, windows."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return stream.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(stream: DataFrame, gap: str) -> DataFrame:
    """A sensor's runs of detections without a pause of ``gap``."""
    return stream.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("hits")).select("user_id", F.col("w.start").alias("first_ts"), "hits")


def emit_once(stream: DataFrame, keys: list[str], forget: str | None = None) -> DataFrame:
    """The first time that a key is seen, as a row of keys; later ones are dropped by state.

    With ``forget`` a key's state goes once the watermark is so far past its last sighting that was let through, and a key that comes again later is told again.
    Without it every key is held: their number is that of the sensors and events, and does not grow with time.
    """
    if forget is None:
        return stream.select(*keys).dropDuplicates(keys)

    def work(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = max(int(f["ts"].max().timestamp() * 1000) for f in frames)
        seen = state.get[0] if state.exists else None
        if seen is None:
            yield pd.DataFrame([key], columns=keys)
        state.update((max(last, seen or 0),))
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs() + 1, max(last, seen or 0) + hold))

    hold = int(pd.Timedelta(forget).total_seconds() * 1000)
    kinds = ", ".join(f"{k} {stream.schema[k].dataType.simpleString()}" for k in keys)
    return stream.groupBy(*keys).applyInPandasWithState(work, kinds, "last long", "append", GroupStateTimeout.EventTimeTimeout)


def stable_labels(stream: DataFrame, cfg: HysteresisConfig = HysteresisConfig()) -> DataFrame:
    """``(user_id, event_id, stable_label, held)`` as rows are settled: a challenge is held in state until it is decided.

    Rows of a batch are taken in event time; a sensor silent for a day gives up its open challenge and its state. What is open when the input ends is
    held, not lost: it is emitted when the sensor's next rows or its silence decide it.
    """

    def work(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        stable, pending = state.get if state.exists else (None, [])
        fold = Hysteresis(cfg, stable, [tuple(p) for p in pending])
        out = []
        if state.hasTimedOut:
            out += fold.finish()
            state.remove()
        else:
            rows = pd.concat(list(frames)).sort_values(["ts", "event_id"], kind="stable")
            for label, value, event in zip(rows["event_type"], rows["value"], rows["event_id"]):
                out += fold.feed(label, float(value) / 20, min(1.0, float(value) / 25), int(event))
            state.update((fold.stable, [list(p) for p in fold.pending]))
            state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), int(rows["ts"].max().timestamp() * 1000)) + 86_400_000)
        yield pd.DataFrame([(key[0], e, s, h) for e, s, h in out], columns=["user_id", "event_id", "stable_label", "held"])

    pending = "array<struct<label:string,duration:double,confidence:double,tag:bigint>>"
    return stream.groupBy("user_id").applyInPandasWithState(work, "user_id long, event_id long, stable_label string, held boolean", f"stable string, pending {pending}", "append", GroupStateTimeout.EventTimeTimeout)
