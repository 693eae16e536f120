"""Operators over ordered rows: segments, islands, local references, positions, bounded buffers.

All partition by the caller's group columns, so their work is spread by group; none collects a group into Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Names = Sequence[str]


def median_of(values: Column) -> Column:
    """Median of an array of numbers, the mean of the two middle ones for an even count; null if empty."""
    ordered, n = F.array_sort(values), F.size(values)
    at = lambda k: F.get(ordered, k.cast("int")).cast("double")
    return F.when(n > 0, (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2)


def segments(boundaries: DataFrame, spans: DataFrame, group: str, frame: str = "frame", total: str = "total_frames") -> DataFrame:
    """Boundaries cut ``[0, total - 1]`` into contiguous segments ``(group, segment_index, start_frame, end_frame)``, ends inclusive.

    Boundaries are rounded half to even and clamped into the span; those at frame 0 cut nothing. A group without boundaries is one segment, one
    without frames gives none.
    """
    at = F.least(F.greatest(F.bround(F.col(frame).cast("double")).cast("long"), F.lit(0)), F.col(total) - 1)
    cuts = boundaries.join(spans, group).select(group, at.alias("start_frame"), total).where("start_frame > 0")
    starts = cuts.unionByName(spans.where(F.col(total) > 0).select(group, F.lit(0).cast("long").alias("start_frame"), total)).distinct()
    w = Window.partitionBy(group).orderBy("start_frame")
    end = F.coalesce(F.lead("start_frame").over(w), F.col(total)) - 1
    return starts.select(group, (F.row_number().over(w) - 1).alias("segment_index"), "start_frame", end.alias("end_frame"))


def footage_segments(rows: DataFrame, group: str, frame: str, boundary: Column) -> DataFrame:
    """``segments`` of rows that are their own footage: ``(group, segment_index, start_frame, end_frame, f0)`` in one shuffle.

    A group's footage runs from its first frame ``f0`` to its last; ``boundary`` tells which rows cut it (null: not). Frames are whole; rows without one are ignored.
    """
    every, w = Window.partitionBy(group), Window.partitionBy(group).orderBy(frame)
    seen = rows.where(F.col(frame).isNotNull()).select(group, F.col(frame).alias("__f"), F.coalesce(boundary, F.lit(False)).alias("__cut"), F.min(frame).over(every).alias("f0"), F.max(frame).over(every).alias("__last"), F.row_number().over(w).alias("__n"))
    # The first row opens the first segment, whether or not it is a boundary.
    starts = seen.where("__cut OR __n = 1").groupBy(group, "f0", "__last", (F.col("__f") - F.col("f0")).alias("start_frame")).agg(F.count("*").alias("__n"))
    w = Window.partitionBy(group).orderBy("start_frame")
    end = F.coalesce(F.lead("start_frame").over(w), F.col("__last") - F.col("f0") + 1) - 1
    return starts.select(group, (F.row_number().over(w) - 1).alias("segment_index"), "start_frame", end.alias("end_frame"), "f0")


def islands(df: DataFrame, group: Names, order: Names, label: str) -> DataFrame:
    """Adds ``island``: the number, from 1, of each maximal run of equal labels (null equals null)."""
    w = Window.partitionBy(*group).orderBy(*order)
    change = F.when(F.row_number().over(w) == 1, 1).when(F.col(label).eqNullSafe(F.lag(label).over(w)), 0).otherwise(1)
    return df.withColumn("__change", change).withColumn("island", F.sum("__change").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__change")


def time_islands(df: DataFrame, group: Names, start: str, end: str, reach: float = 0, width: float = 1440) -> DataFrame:
    """Adds ``day`` and ``island``: the stretch of rows that a row belongs to, cut where a span starts more than ``reach`` after all earlier ones have ended.

    A group's rows need not fit a task: they are judged within stretches of ``width`` of the start (days), and what goes on from earlier ones comes from a
    small table with a row for each. A stretch is named by the day in which it begins and its number there.
    """
    day = F.floor(F.col(start) / width).cast("long")
    rows = df.withColumn("__day", day)
    past = Window.partitionBy(*group).orderBy("__day")
    tops = rows.groupBy(*group, "__day").agg(F.max(end).alias("__top"))
    tops = tops.select(*group, "__day", F.max("__top").over(past.rowsBetween(Window.unboundedPreceding, -1)).alias("__carry"))
    rows = rows.join(tops, [*group, "__day"])
    w = Window.partitionBy(*group, "__day").orderBy(start)
    pause = F.col(start) - F.greatest(F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("__carry"))
    rows = rows.withColumn("__change", F.when(pause.isNull() | (pause > reach), 1).otherwise(0))
    # Over a range, spans of one start get one island, in whatever order they came.
    rows = rows.withColumn("__n", F.sum("__change").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    # A row before its day's first cut belongs to the last stretch of the days before.
    lasts = rows.groupBy(*group, "__day").agg(F.sum("__change").alias("__cuts"))
    held = F.when(F.col("__cuts") > 0, F.struct("__day", "__cuts"))
    lasts = lasts.select(*group, "__day", F.last(held, True).over(past.rowsBetween(Window.unboundedPreceding, -1)).alias("__last"))
    rows = rows.join(lasts, [*group, "__day"])
    own = F.col("__n") > 0
    rows = rows.withColumn("day", F.when(own, F.col("__day")).otherwise(F.col("__last.__day"))).withColumn("island", F.when(own, F.col("__n")).otherwise(F.col("__last.__cuts")))
    return rows.drop("__day", "__carry", "__change", "__n", "__last")


def stable_run(df: DataFrame, group: Names, order: Names, label: str, duration: str) -> DataFrame:
    """Adds ``run_duration``: the running sum of durations back to the last change of label."""
    w = Window.partitionBy(*group, "island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return islands(df, group, order, label).withColumn("run_duration", F.sum(duration).over(w))


def missed_run_max(df: DataFrame, group: Names, frame: str) -> DataFrame:
    """The longest run of frames without a hit inside each track, 0 for a single hit."""
    w = Window.partitionBy(*group).orderBy(frame)
    gap = F.col(frame) - F.lag(frame).over(w) - 1
    return df.withColumn("__gap", gap).groupBy(*group).agg(F.greatest(F.coalesce(F.max("__gap"), F.lit(0)), F.lit(0)).alias("max_missed"))


def renumber(df: DataFrame, group: Names, order: Names, name: str = "track_id") -> DataFrame:
    """Ids become ranks, from 1, in order."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def local_median(df: DataFrame, group: Names, order: Names, value: str, reach: int = 5, least: int = 2) -> DataFrame:
    """Adds ``reference`` and ``reference_kind``: the median of the positive values of up to ``reach`` neighbours on each side, the row itself
    left out; with fewer than ``least`` of them the group's median."""
    w = Window.partitionBy(*group).orderBy(*order)
    positive = F.when(F.col(value) > 0, F.col(value).cast("double"))
    near = F.concat(F.collect_list(positive).over(w.rowsBetween(-reach, -1)), F.collect_list(positive).over(w.rowsBetween(1, reach)))
    overall = F.median(positive).over(Window.partitionBy(*group))
    df = df.withColumn("__near", near).withColumn("__all", overall)
    local = F.size("__near") >= least
    return df.withColumn("reference", F.when(local, median_of(F.col("__near"))).otherwise(F.col("__all"))).withColumn("reference_kind", F.when(local, "local").otherwise("global")).drop("__near", "__all")


def interval_diagnostics(df: DataFrame, group: Names, time: str, reach: int = 6, short: float = 0.5, long: float = 1.6) -> DataFrame:
    """Implausible spacings ``(group, start, end, interval, base, ratio, flag, implied_missing)`` against the local median, itself included."""
    w = Window.partitionBy(*group).orderBy(time)
    rows = df.select(*group, F.col(time).alias("start"), F.lead(time).over(w).alias("end")).where(F.col("end").isNotNull()).withColumn("interval", F.col("end") - F.col("start"))
    near = Window.partitionBy(*group).orderBy("start").rowsBetween(-reach, reach)
    rows = rows.withColumn("base", median_of(F.collect_list("interval").over(near))).withColumn("ratio", F.when(F.col("base") > 0, F.col("interval") / F.col("base")).otherwise(F.lit(float("inf"))))
    flag = F.when(F.col("ratio") <= short, "SUSPICIOUSLY_SHORT").when(F.col("ratio") >= long, "POSSIBLE_MISSING_GAP")
    implied = F.when(F.col("ratio") >= long, F.greatest(F.lit(1), F.bround("ratio").cast("long") - 1)).otherwise(0)
    return rows.withColumn("flag", flag).where(F.col("flag").isNotNull()).withColumn("implied_missing", implied.cast("long"))


def percent_positions(df: DataFrame, keys: Names, start: str, end: str, percents: Sequence[float] = (0.2, 0.4, 0.6, 0.8)) -> DataFrame:
    """Planned frames at shares of a span ``(keys, percent, frame, available)``; a frame planned before is not available again."""
    at = F.explode(F.array(*[F.lit(float(p)) for p in percents])).alias("percent")
    span = F.col(end) - F.col(start)
    rows = df.select(*keys, start, end, at).withColumn("frame", F.least(F.greatest(F.col(start) + F.bround(F.col("percent") * span).cast("long"), F.col(start)), F.col(end)))
    first = F.row_number().over(Window.partitionBy(*keys, "frame").orderBy("percent")) == 1
    return rows.select(*keys, "percent", "frame", first.alias("available"))


def stable_interior(df: DataFrame, group: Names, order: Names, nth: int = 1, share: float = 0.05, least: int = 3, most: int = 12) -> DataFrame:
    """Drops a share of rows at both ends (clamped; none of a group too short for it) and keeps every ``nth`` of the rest, the first included."""
    w = Window.partitionBy(*group).orderBy(*order)
    n = F.count("*").over(Window.partitionBy(*group))
    k = F.least(F.greatest(F.floor(n * share), F.lit(least)), F.lit(most))
    rows = df.withColumn("__at", F.row_number().over(w) - 1).withColumn("__n", n).withColumn("__k", F.when(n <= 2 * k, 0).otherwise(k))
    inside = (F.col("__at") >= F.col("__k")) & (F.col("__at") < F.col("__n") - F.col("__k"))
    return rows.where(inside & ((F.col("__at") - F.col("__k")) % nth == 0)).drop("__at", "__n", "__k")


def even_subsample(df: DataFrame, group: Names, order: Names, k: int) -> DataFrame:
    """``k`` rows of each group at evenly spaced places, both ends included; groups of at most ``k`` rows stay whole."""
    w = Window.partitionBy(*group).orderBy(*order)
    rows = df.withColumn("__at", F.row_number().over(w) - 1).withColumn("__n", F.count("*").over(Window.partitionBy(*group)))
    places = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (F.col("__n") - 1).cast("double") / max(1, k - 1)).cast("long"))
    return rows.where((F.col("__n") <= k) | F.array_contains(places, F.col("__at").cast("long"))).drop("__at", "__n")


def active_window(df: DataFrame, group: Names, order: str, label: str, core: str = "WAGON") -> DataFrame:
    """Adds ``position`` (LEADING, INTERIOR or TRAILING, null in a group without the core label), and for interior rows their
    rank ``unit_index`` from 1. Other labels inside the window stay and count, as rows to be reported."""
    p = Window.partitionBy(*group)
    first, last = (f(F.when(F.col(label) == core, F.col(order))).over(p) for f in (F.min, F.max))
    rows = df.withColumn("__first", first).withColumn("__last", last)
    position = F.when(F.col(order) < F.col("__first"), "LEADING").when(F.col(order) > F.col("__last"), "TRAILING").when(F.col("__first").isNotNull(), "INTERIOR")
    rows = rows.withColumn("position", position).drop("__first", "__last")
    rank = F.row_number().over(Window.partitionBy(*group, "position").orderBy(order))
    return rows.withColumn("unit_index", F.when(F.col("position") == "INTERIOR", rank))


def motion_state(df: DataFrame, group: Names, order: Names, speed: str, band: float = 0.15) -> DataFrame:
    """``(group, early, late, state)`` from the medians of both halves; of an odd number of rows the middle one counts in neither."""
    w = Window.partitionBy(*group)
    rows = df.withColumn("__at", F.row_number().over(w.orderBy(*order)) - 1).withColumn("__half", F.floor(F.count("*").over(w) / 2)).withColumn("__n", F.count("*").over(w))
    early = F.median(F.when(F.col("__at") < F.col("__half"), F.col(speed).cast("double")))
    late = F.median(F.when(F.col("__at") >= F.col("__n") - F.col("__half"), F.col(speed).cast("double")))
    out = rows.groupBy(*group).agg(early.alias("early"), late.alias("late"))
    state = F.when(F.col("early").isNull() | (F.col("early") <= 0), "UNKNOWN").when(F.col("late") > F.col("early") * (1 + band), "ACCELERATING").when(F.col("late") < F.col("early") * (1 - band), "DECELERATING").otherwise("CONSTANT")
    return out.withColumn("state", state)


def bounded_vote(df: DataFrame, group: Names, order: Names, label: str, weight: str, size: int = 30) -> DataFrame:
    """Adds ``voted``: the label of most weight among the last ``size`` rows, of equal ones that seen first in the buffer."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(-(size - 1), 0)
    buffer = F.collect_list(F.struct(F.col(label).alias("v"), F.col(weight).alias("w"))).over(w)
    total = lambda v: F.aggregate(F.filter("__buffer", lambda s: s["v"] == v), F.lit(0.0), lambda a, s: a + s["w"])
    values = F.array_distinct(F.transform("__buffer", lambda s: s["v"]))
    ranked = F.transform(values, lambda v, i: F.struct(total(v).alias("total"), (-i).alias("place"), v.alias("v")))
    return df.withColumn("__buffer", buffer).withColumn("voted", F.array_max(ranked)["v"]).drop("__buffer")


def interpolate(hits: DataFrame, wanted: DataFrame, group: Names, frame: str, value: str) -> DataFrame:
    """``(group, frame, value)`` at the wanted frames: linear between the neighbouring hits, the nearest hit's outside them."""
    rows = wanted.select(*group, frame, F.lit(None).cast("double").alias("v"), F.lit(1).alias("ask")).unionByName(hits.select(*group, frame, F.col(value).cast("double").alias("v"), F.lit(0).alias("ask")))
    back = Window.partitionBy(*group).orderBy(frame, "ask").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*group).orderBy(F.desc(frame), "ask").rowsBetween(Window.unboundedPreceding, 0)
    known = F.when(F.col("ask") == 0, F.struct(F.col(frame).alias("f"), "v"))
    rows = rows.withColumn("__a", F.last(known, True).over(back)).withColumn("__b", F.last(known, True).over(ahead)).where("ask = 1")
    a, b, f = F.col("__a"), F.col("__b"), F.col(frame)
    lerp = F.when(a["f"] == b["f"], a["v"]).otherwise(a["v"] + (b["v"] - a["v"]) * (f - a["f"]) / (b["f"] - a["f"]))
    return rows.select(*group, frame, F.when(a.isNull(), b["v"]).when(b.isNull(), a["v"]).otherwise(lerp).alias(value))
