"""What is told about units: evidence picks, defaults, severities, view rows, snapshots and fallbacks, as tables in and tables out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions import scalars
from trackloom.operators import aggregates

Names = Sequence[str]
#: Severities in the order of reports (fixed values).
SEVERITIES = ("HIGH", "MEDIUM", "LOW")


def severity_of(item: Column) -> Column:
    """HIGH for damage and open doors, MEDIUM for partly open ones, LOW for what is only missing; null for anything else."""
    low = F.lower(item)
    return F.when(low.contains("partial"), "MEDIUM").when(low.contains("damage") | low.contains("open"), "HIGH").when(low.startswith("no "), "LOW")


def report_items(units: DataFrame, keys: Names, anomalies: str) -> DataFrame:
    """``(keys, place, item, severity)``: one row for each anomaly of a unit, in its order."""
    rows = units.select(*keys, F.posexplode(anomalies).alias("place", "item"))
    return rows.withColumn("severity", severity_of(F.col("item")))


def by_severity(items: DataFrame, group: Names) -> DataFrame:
    """``(group, severity, rank, n, units)`` with a severity's place in the report; severities that do not occur give no row."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severity"))
    return items.where("severity IS NOT NULL").groupBy(*group, "severity").agg(F.count("*").alias("n")).withColumn("rank", rank)


def overall_status(units: DataFrame, group: Names, anomalous: Column) -> DataFrame:
    """NOT OK if any unit of the group is anomalous."""
    return units.groupBy(*group).agg(F.when(F.bool_or(F.coalesce(anomalous, F.lit(False))), "NOT OK").otherwise("OK").alias("status"), F.count("*").alias("units"))


def evidence_pick(rows: DataFrame, group: Names, state: str, reported: str, score: str, key: str) -> DataFrame:
    """The best row of the reported state, or the best of all where none has it: ``(group, key, picked_state, matches)``. Ties go to the lesser key."""
    by = F.struct(F.when(F.col(state) == F.col(reported), 1).otherwise(0).alias("m"), F.col(score).alias("s"), (-F.col(key)).alias("k"))
    top = rows.groupBy(*group).agg(F.max(F.struct(by.alias("by"), F.col(key).alias("key"), F.col(state).alias("state"))).alias("top"))
    return top.select(*group, F.col("top.key").alias(key), F.col("top.state").alias("picked_state"), (F.col("top.by.m") == 1).alias("matches"))


def door_default(state: Column, confidence: Column, frames: Column) -> tuple[Column, Column]:
    """CLOSED with no confidence where frames were seen and no state was accepted; null where nothing was seen."""
    return F.coalesce(state, F.when(frames > 0, "CLOSED")), F.when(state.isNotNull(), confidence).when(frames > 0, 0.0)


def first_with_data(*values: Column, missing: str = "NO_DATA") -> Column:
    """The first value that is data, by the authority of its camera."""
    return F.coalesce(*[F.nullif(v, F.lit(missing)) for v in values], F.lit(missing))


def top_class(rows: DataFrame, frame: Names, label: str, confidence: str, key: str) -> DataFrame:
    """One label a frame: that of the most confident row, of equal ones the least key's."""
    return aggregates.best(rows, frame, [F.desc(confidence), F.asc(key)]).select(*frame, label, confidence)


def best_reading(rows: DataFrame, group: Names, number: str, confidence: str, key: str, digits: int = 11) -> DataFrame:
    """The reading to show: a full number counts ten more than its confidence; ties go to the lesser key."""
    score = F.when(F.length(scalars.digits(F.col(number))) == digits, 10.0).otherwise(0.0) + F.col(confidence)
    return aggregates.best(rows.withColumn("score", score), group, [F.desc("score"), F.asc(key)]).select(*group, number, "score", key)


def text_rows(boxes: DataFrame, group: Names, y: str, text: str, confidence: str, key: str) -> DataFrame:
    """Boxes of text from top to bottom as one text, with their mean confidence."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(y).alias("y"), F.col(key).alias("k"), F.col(text).alias("t"))))
    return boxes.groupBy(*group).agg(ordered.alias("rows"), F.avg(confidence).alias("confidence")).select(*group, F.array_join(F.transform("rows", lambda r: r["t"]), "").alias("text"), "confidence")


def view_rows(units: DataFrame, keys: Names, sides: Mapping[str, str]) -> DataFrame:
    """``(keys, side, state)``: one row for each side that is anomalous; ``sides`` names the state column of each side."""
    rows = units.select(*keys, F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias("state")) for s, c in sides.items()])).alias("v")).select(*keys, "v.*")
    low = F.lower(F.coalesce("state", F.lit("")))
    return rows.where(low.contains("damage") | low.contains("open"))


def raised_by(*cameras: tuple[str, Column]) -> Column:
    """The cameras whose own authority raised an anomaly, in the given order."""
    return F.array_compact(F.array(*[F.when(raised, name) for name, raised in cameras]))


def own_tracks(tracks: DataFrame, camera: str, confidence: str, key: str) -> DataFrame:
    """A camera's own tracks in the order of its report: adds ``place`` by falling confidence, then key; per batch if it has one."""
    group = [c for c in ("batch", camera) if c in tracks.columns]
    return tracks.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(confidence), key)))


def best_snapshot(tracks: DataFrame, group: Names, confidence: str, key: str, exists: Column) -> DataFrame:
    """The track of the highest confidence that has a snapshot; null where none has."""
    by = F.when(exists, F.struct(F.col(confidence).alias("c"), (-F.col(key)).alias("k")))
    return tracks.groupBy(*group).agg(F.max_by(key, by).alias(key), F.count_if(exists).alias("with_snapshot"))


def mid_frame(frames: DataFrame, group: Names, frame: str) -> DataFrame:
    """The frame in the middle of those listed (the upper of two), and the middle of their span, which need not be listed."""
    w = Window.partitionBy(*group)
    rows = frames.select(*group, frame).distinct().withColumn("__at", F.row_number().over(w.orderBy(frame)) - 1).withColumn("__n", F.count("*").over(w))
    middle = F.max(F.when(F.col("__at") == F.floor(F.col("__n") / 2), F.col(frame)))
    return rows.groupBy(*group).agg(middle.alias("by_place"), F.floor((F.min(frame) + F.max(frame)) / 2).alias("by_span"))


def count_or(count: Column, fallback: Column) -> Column:
    """A count of the roster, or where it has none the one that came with the window."""
    return F.coalesce(F.nullif(count, F.lit(0)), fallback, F.lit(0))


def usable_offset(delta: Column, status: Column) -> Column:
    """Offsets of reference and resolved cameras; 0 for the others, which are never guessed."""
    return F.when(status.isin("REFERENCE", "RESOLVED"), F.coalesce(delta, F.lit(0.0))).otherwise(0.0)


def window_map(units: DataFrame, cameras: Sequence[tuple[str, float, float, int]], t0: Column, t1: Column, keep_outside: bool = False) -> DataFrame:
    """Units on every camera's own frames ``(camera, start, end)``; ``cameras`` lists name, clock offset, rate and frames, so the product is an explode."""
    listed = F.array(*[F.struct(F.lit(n).alias("camera"), F.lit(float(d)).alias("delta"), F.lit(float(f)).alias("fps"), F.lit(int(total)).alias("total")) for n, d, f, total in cameras])
    rows = units.withColumn("__c", F.explode(listed))
    start, end = scalars.local_range(t0, t1, F.col("__c.delta"), F.col("__c.fps"), F.col("__c.total"))
    rows = rows.withColumn("on_camera", F.col("__c.camera")).withColumn("start", start).withColumn("end", end).drop("__c")
    return rows if keep_outside else rows.where("start IS NOT NULL")


def assembled_or_master(fused: DataFrame, master: DataFrame, batch: Names) -> DataFrame:
    """Fused units, and for batches where fusion gave none the master's own, flagged as ``fallback``."""
    alone = master.join(fused.select(*batch).distinct(), list(batch), "left_anti")
    return fused.withColumn("fallback", F.lit(False)).unionByName(alone.withColumn("fallback", F.lit(True)))


def merge_identities(tracks: DataFrame, root: str, key: str, score: str, confidence: str, state: str) -> DataFrame:
    """One row for each identity: how many tracks it merges, the best snapshot's, the most confident state (OPEN wins), the highest confidence."""
    state_ = F.when(F.bool_or(F.col(state) == "OPEN"), "OPEN").otherwise(F.min_by(state, F.struct(-F.col(confidence), key)))
    return tracks.groupBy(root).agg(F.count("*").alias("merged"), F.max(confidence).alias("confidence"), F.min_by(key, F.struct(-F.col(score), key)).alias("snapshot_of"), state_.alias("state"))


def track_decision(state: Column, majority: Column, hits: Column, confidence: Column, least_hits: int = 3, sure: float = 0.80) -> Column:
    """Few hits follow the majority; an opening that is not sure is told as a partial one."""
    return F.when(hits < least_hits, majority).when((state == "OPEN") & (confidence < sure), "PARTIAL_OPEN").otherwise(state)


def buffer_stats(rows: DataFrame, group: Names, order: Names, open_: Column, confidence: str, size: int = 30, recent: int = 5) -> DataFrame:
    """Adds ``open_ratio`` of the last ``size`` rows and ``recent_confidence``, the mean of the last ``recent``."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("open_ratio", F.avg(F.when(open_, 1.0).otherwise(0.0)).over(w.rowsBetween(1 - size, 0))).withColumn("recent_confidence", F.avg(confidence).over(w.rowsBetween(1 - recent, 0)))


def decayed_mean(rows: DataFrame, group: Names, order: Names, value: str, decay: float = 0.85, size: int = 30) -> DataFrame:
    """Adds ``decayed``: the mean of the last ``size`` values, each older one weighing ``decay`` times the next."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(1 - size, 0)
    values = F.collect_list(F.col(value).cast("double")).over(w)
    weighed = F.aggregate("__v", F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("w")), lambda a, v: F.struct((a["s"] * decay + v).alias("s"), (a["w"] * decay + 1).alias("w")), lambda a: a["s"] / a["w"])
    return rows.withColumn("__v", values).withColumn("decayed", weighed).drop("__v")


def resolved_limits(cameras: DataFrame, seconds: Mapping[str, float], widths: Mapping[str, float]) -> DataFrame:
    """Thresholds of each camera ``(camera, width, fps)`` in its own frames and pixels; without either, 848 pixels and 15 frames a second."""
    w, f = F.when(F.col("width") > 0, F.col("width")).otherwise(848.0), F.when(F.col("fps") > 0, F.col("fps")).otherwise(15.0)
    return cameras.select("camera", *[F.greatest(F.bround(F.lit(s) * f).cast("long"), F.lit(1)).alias(n) for n, s in seconds.items()], *[F.round(F.lit(r) * w, 6).alias(n) for n, r in widths.items()])
