"""Typed readers and sinks for tracks, state documents, evidence bundles and reports.

Schemas are declared, never inferred, and missing fields become typed defaults. Paths are the caller's: nothing is hard-wired.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DETECTION = "camera_id string, frame_idx long, label string, confidence double, x1 double, y1 double, x2 double, y2 double"
TRACK = "camera_id string, track_id long, start_frame long, end_frame long, confidence double, hit_count long, fps double, consistency double, label string, trajectory array<double>, hit_frames array<long>, boxes array<struct<x1:double,y1:double,x2:double,y2:double>>"
SEGMENT = "camera_id string, local_id string, index long, start_frame long, end_frame long, start_time double, end_time double, label string, confidence double"
ROSTER = "batch_key string, unit_id string, unit_index long, start_frame long, end_frame long, start_time double, end_time double, kind string, confidence double, supporting array<string>"
STATE = f"schema string, master_camera string, fps map<string,double>, offsets map<string,struct<delta:double,status:string>>, roster array<struct<{ROSTER.replace(' ', ':').replace(',:', ',')}>>"
#: The steps of a camera's bundle, in order; FAILED may follow any step but the last (fixed values).
LIFECYCLE = ("CREATED", "TRACKING", "TRACKED", "CLASSIFIED", "MATERIALIZED", "EVIDENCE_READY", "SEALED")


def read_json(spark: SparkSession, path: str, schema: str, defaults: Mapping[str, object] | None = None, tolerant: bool = True) -> DataFrame:
    """JSON with a declared schema. ``tolerant`` drops rows that don't parse; missing fields take the defaults."""
    df = spark.read.schema(schema).option("mode", "DROPMALFORMED" if tolerant else "FAILFAST").option("multiLine", "false").json(path)
    return df.na.fill(dict(defaults or {}))


def camera_rates(states: DataFrame) -> DataFrame:
    """``(camera_id, fps)`` of state documents, one row a camera; rates that are not positive are left out."""
    return states.select(F.explode("fps").alias("camera_id", "fps")).where("fps > 0").distinct()


def usable_offsets(states: DataFrame) -> DataFrame:
    """``(camera_id, delta)``: clock offsets of reference and resolved cameras, 0 for the others, which are never guessed."""
    rows = states.select(F.explode("offsets").alias("camera_id", "o"))
    return rows.select("camera_id", F.when(F.col("o.status").isin("REFERENCE", "RESOLVED"), F.coalesce("o.delta", F.lit(0.0))).otherwise(0.0).alias("delta"))


def window_value(*spellings: Column) -> Column:
    """The first historical spelling of a field that has a value."""
    return F.coalesce(*spellings)


def write_tracks(df: DataFrame, path: str) -> None:
    """Tracks by camera, typed and lossless."""
    df.write.mode("overwrite").partitionBy("camera_id").parquet(path)


def read_tracks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRACK).parquet(path)


def write_units(df: DataFrame, path: str, batch: str = "batch_key") -> None:
    """Fused units, one folder a batch; a run again replaces only its own batches."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(batch).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A flat report with a header; nested columns are refused by the format."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def as_documents(df: DataFrame, schema_tag: str, *keys: str) -> DataFrame:
    """One JSON document a row, tagged with its schema, beside its keys."""
    return df.select(*keys, F.to_json(F.struct(F.lit(schema_tag).alias("schema"), *df.columns)).alias("document"))


def advance(current: Column, wanted: Column) -> Column:
    """Whether a bundle may go from one state to the other: forward by exactly one, or to FAILED from any state before the last."""
    steps = F.array(*[F.lit(s) for s in LIFECYCLE])
    a, b = F.array_position(steps, current), F.array_position(steps, wanted)
    return ((a > 0) & (b == a + 1)) | ((wanted == "FAILED") & (a > 0) & (a < len(LIFECYCLE)))


def ready_to_assemble(manifests: DataFrame, batch: str, camera: str, state: str, master: str) -> DataFrame:
    """Batches whose master is SEALED and whose other cameras have ended, one way or the other."""
    done = F.bool_and(F.col(state).isin("SEALED", "FAILED"))
    sealed = F.bool_or((F.col(camera) == master) & (F.col(state) == "SEALED"))
    return manifests.groupBy(batch).agg(F.coalesce(done & sealed, F.lit(False)).alias("ready"), F.count_if(F.col(state) == "FAILED").alias("failed"))


def feature_or_null(units: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Units with their feature row, null where it is missing: absence is data, not an error."""
    return units.join(features, key, "left")


def find_files(spark: SparkSession, folder: str, pattern: str = "*.mp4") -> DataFrame:
    """``(path, camera_id, batch_key, length, modified)`` of the files under a folder, their content unread; empty files are left out.

    A name holds its batch as ``YYYYMMDD_HHMMSS`` and ends in its camera: ``<anything>_<batch>_<camera>.<suffix>``; what it lacks is null.
    """
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    name = F.regexp_extract("path", r"([^/]+)\.[^./]*$", 1)
    batch, camera = F.regexp_extract(name, r"(\d{8}_\d{6})", 1), F.regexp_extract(name, r"\d{8}_\d{6}_(.+)$", 1)
    return rows.select("path", F.nullif(camera, F.lit("")).alias("camera_id"), F.nullif(batch, F.lit("")).alias("batch_key"), "length", F.col("modificationTime").alias("modified"))


def local_batches(files: DataFrame, cameras: list[str]) -> DataFrame:
    """``(batch_key, files, missing, complete)``: the latest file of each camera of a batch, and the cameras that lack one."""
    wanted = F.array(*[F.lit(c) for c in sorted(cameras)])
    latest = files.where(F.col("batch_key").isNotNull() & F.col("camera_id").isin(*cameras)).groupBy("batch_key", "camera_id").agg(F.max_by("path", F.struct("modified", "path")).alias("path"))
    out = latest.groupBy("batch_key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("camera_id", "path")))).alias("files"))
    return out.withColumn("missing", F.array_except(wanted, F.map_keys("files"))).withColumn("complete", F.size("missing") == 0)


def write_json(df: DataFrame, path: str, *partitions: str) -> None:
    """Evidence metadata or stage timings as JSON lines, one folder for each value of the partitions."""
    df.write.mode("overwrite").partitionBy(*partitions).json(path)
