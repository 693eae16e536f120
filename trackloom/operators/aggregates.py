"""Votes, evidence, priorities and rollups. Ties are broken as stated in each function, never left to the engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Names = Sequence[str]


def best(df: DataFrame, group: Names, order: Sequence[Column]) -> DataFrame:
    """The first row of each group in the order."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where("__rank = 1").drop("__rank")


def majority_vote(df: DataFrame, group: Names, value: str, weight: str) -> DataFrame:
    """``(group, value, mean_weight, n)``: most rows, then higher mean weight, then lesser value."""
    counts = df.groupBy(*group, value).agg(F.count("*").alias("n"), F.avg(weight).alias("mean_weight"))
    return best(counts, group, [F.desc("n"), F.desc("mean_weight"), F.asc(value)]).select(*group, value, "mean_weight", "n")


def weighted_vote(df: DataFrame, group: Names, value: str, weight: str) -> DataFrame:
    """``(group, value, total_weight, n)``: most weight, then higher mean weight, then lesser first letter, then lesser value."""
    sums = df.groupBy(*group, value).agg(F.sum(weight).alias("total_weight"), F.avg(weight).alias("mean_weight"), F.count("*").alias("n"))
    return best(sums, group, [F.desc("total_weight"), F.desc("mean_weight"), F.substring(value, 1, 1).asc(), F.asc(value)]).select(*group, value, "total_weight", "n")


def segment_vote(units: DataFrame, samples: DataFrame, key: str, value: str, weight: str, default: str = "wagon") -> DataFrame:
    """Most samples, then lesser first letter, then lesser value; a unit without samples gets the default with no weight."""
    counts = samples.groupBy(key, value).agg(F.count("*").alias("n"), F.avg(weight).alias("mean_weight"))
    top = best(counts, [key], [F.desc("n"), F.substring(value, 1, 1).asc(), F.asc(value)])
    return units.join(top, key, "left").select(key, F.coalesce(value, F.lit(default)).alias(value), F.coalesce("mean_weight", F.lit(0.0)).alias("mean_weight"), F.coalesce("n", F.lit(0)).alias("n"))


def ratio_vote(df: DataFrame, group: Names, positive: Column, negative: Column, weight: str, threshold: float = 0.35, names: tuple[str, str] = ("LOADED", "EMPTY")) -> DataFrame:
    """The first name if its share of all rows, unknown ones included, exceeds the threshold; else the second if it occurs; else NO_DATA."""
    out = df.groupBy(*group).agg(F.count("*").alias("used"), F.count_if(positive).alias("positive"), F.count_if(negative).alias("negative"), F.avg(F.when(positive, F.col(weight))).alias("positive_weight"), F.avg(F.when(negative, F.col(weight))).alias("negative_weight"))
    state = F.when(F.col("positive") / F.col("used") > threshold, names[0]).when(F.col("negative") > 0, names[1]).otherwise("NO_DATA")
    out = out.withColumn("state", state)
    weight_of = F.when(F.col("state") == names[0], F.col("positive_weight")).when(F.col("state") == names[1], F.col("negative_weight")).otherwise(0.0)
    return out.select(*group, "state", weight_of.alias("mean_weight"), "used", "positive", "negative")


def state_evidence(df: DataFrame, group: Names, state: str, frame: str, weight: str) -> DataFrame:
    """Distinct frames, mean and greatest weight of each state in a group."""
    return df.groupBy(*group, state).agg(F.countDistinct(frame).alias("frames"), F.avg(weight).alias("mean_weight"), F.max(weight).alias("max_weight"))


def resolve_state(df: DataFrame, group: Names, state: str, frame: str, weight: str, least_frames: int = 2, least_share: float = 0.34) -> DataFrame:
    """The state of most distinct frames (then higher mean weight, then name), if it has enough of them; support comes before weight, so one
    confident outlier never overrides repeated evidence."""
    total = df.groupBy(*group).agg(F.countDistinct(frame).alias("total_frames"))
    top = best(state_evidence(df, group, state, frame, weight), group, [F.desc("frames"), F.desc("mean_weight"), F.asc(state)]).join(total, list(group))
    few, thin = F.col("frames") < least_frames, F.col("frames") / F.col("total_frames") < least_share
    return top.select(*group, F.when(~few & ~thin, F.col(state)).alias("state"), F.when(~few & ~thin, F.col("mean_weight")).otherwise(0.0).alias("mean_weight"), "frames", "total_frames", F.when(few, "insufficient_frame_support").when(thin, "insufficient_support_fraction").alias("reason"))


def best_observation(df: DataFrame, group: Names, score: str, weight: str, frame: str, key: str) -> DataFrame:
    """The row of the highest score, then weight, then the earliest frame, then the least key."""
    return best(df, group, [F.desc(score), F.desc(weight), F.asc(frame), F.asc(key)])


def priority_pick(df: DataFrame, group: Names, state: str, priority: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row a group: that of the foremost state in ``priority``, and of its rows the first in the order."""
    place = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col(state))
    return best(df.where(place > 0), group, [place.asc(), *order])


def fraction_with(df: DataFrame, group: Names, predicate: Column) -> DataFrame:
    """Share of rows for which the predicate holds; null counts as not."""
    return df.groupBy(*group).agg((F.count_if(predicate) / F.count("*")).alias("fraction"), F.count("*").alias("n"))


def dominant_direction(df: DataFrame, group: Names, displacement: str, hits: str, least_tracks: int = 3) -> DataFrame:
    """``(group, by_hits, by_count)``: the sign that most hits, or tracks, move in; by hits 0 with too few tracks."""
    sign = F.signum(F.col(displacement).cast("double"))
    out = df.groupBy(*group).agg(F.count("*").alias("n"), F.sum(sign * F.col(hits)).alias("h"), F.sum(sign).alias("c"))
    return out.select(*group, F.when(F.col("n") >= least_tracks, F.signum("h")).otherwise(0.0).cast("int").alias("by_hits"), F.signum("c").cast("int").alias("by_count"))


def median_spacing(df: DataFrame, group: Names, time: str) -> DataFrame:
    """Median of the positive steps between consecutive times, 0 without any."""
    w = Window.partitionBy(*group).orderBy(time)
    steps = df.withColumn("__step", F.col(time) - F.lag(time).over(w))
    return steps.groupBy(*group).agg(F.coalesce(F.median(F.when(F.col("__step") > 0, F.col("__step").cast("double"))), F.lit(0.0)).alias("spacing"))


def pattern_penalty(pairs: DataFrame, group: Names, master: str, support: str) -> DataFrame:
    """Sum over consecutive matched pairs of how much their spacings differ, relative to the larger."""
    w = Window.partitionBy(*group).orderBy(master)
    rows = pairs.withColumn("__m", F.col(master) - F.lag(master).over(w)).withColumn("__s", F.col(support) - F.lag(support).over(w))
    part = F.when((F.col("__m") > 0) & (F.col("__s") > 0), F.abs(F.col("__m") - F.col("__s")) / F.greatest("__m", "__s"))
    return rows.groupBy(*group).agg(F.coalesce(F.sum(part), F.lit(0.0)).alias("penalty"))


def weighted_time(df: DataFrame, group: Names, time: str, weight: str) -> DataFrame:
    return df.groupBy(*group).agg((F.sum(F.col(time) * F.col(weight)) / F.sum(weight)).alias("weighted_time"))


def motion_features(df: DataFrame, group: Names, frame: str, x: str, fps: float, **extra: Column) -> DataFrame:
    """Per track of at least two hits: displacement, path, efficiency, direction, monotonic share, longest blind run, speeds.

    Expects one row a hit. Steps without time are left out of speeds and signs. ``extra`` names further aggregates of a track's hits.
    """
    w = Window.partitionBy(*group).orderBy(frame)
    rows = df.withColumn("__f", F.lag(frame).over(w)).withColumn("__x", F.lag(x).over(w))
    df_, dx = F.col(frame) - F.col("__f"), F.col(x) - F.col("__x")
    moved = F.when(df_ > 0, dx / (df_ / fps))
    out = rows.groupBy(*group).agg(
        F.min(frame).alias("start_frame"), F.max(frame).alias("end_frame"), F.count("*").alias("hits"),
        F.greatest(F.coalesce(F.max(df_ - 1), F.lit(0)), F.lit(0)).alias("max_missed"),
        F.min_by(x, frame).alias("x_start"), F.max_by(x, frame).alias("x_end"), F.coalesce(F.sum(F.abs(dx)), F.lit(0)).alias("path"),
        F.count(moved).alias("n_steps"), F.count_if(moved > 0).alias("n_pos"), F.count_if(moved < 0).alias("n_neg"), F.median(moved).alias("step_speed"), *[c.alias(n) for n, c in extra.items()],
    ).where("hits >= 2")
    track = F.greatest(F.lit(1), F.col("end_frame") - F.col("start_frame") + 1)
    displacement = F.col("x_end") - F.col("x_start")
    return out.select(
        *group, "start_frame", "end_frame", "hits", track.alias("track_frames"), "max_missed", F.least(F.lit(1.0), F.col("hits") / track).alias("coverage"), "x_start", displacement.alias("displacement"),
        F.when(F.col("path") > 0, F.abs(displacement) / F.col("path")).otherwise(0.0).alias("path_efficiency"), (F.abs(displacement) / (track / fps)).alias("speed"), "n_steps",
        F.when(F.col("n_pos") > F.col("n_neg"), 1).when(F.col("n_neg") > F.col("n_pos"), -1).otherwise(0).alias("direction"),
        F.when(F.col("n_steps") > 0, F.greatest("n_pos", "n_neg") / F.col("n_steps")).otherwise(0.0).alias("monotonic"), "step_speed", *extra,
    )


def merge_fragments(df: DataFrame, chain: str, track: str, frame: str, x: str, weight: str, hits: str) -> DataFrame:
    """Fragments of a chain as one track: the least id, a frame's value from its first writer, hits-weighted confidence, ordered arrays."""
    frames = best(df, [chain, frame], [F.asc(track)])
    path = frames.groupBy(chain).agg(F.array_sort(F.collect_list(F.struct(F.col(frame).alias("f"), F.col(x).alias("x")))).alias("hits"))
    parts = df.groupBy(chain, track).agg(F.first(hits).alias("h"), F.first(weight).alias("w"))
    merged = parts.groupBy(chain).agg(F.min(track).alias("track_id"), (F.sum(F.col("h") * F.col("w")) / F.sum("h")).alias("confidence"), F.count("*").alias("fragments"))
    return merged.join(path, chain).select(chain, "track_id", "confidence", "fragments", F.transform("hits", lambda s: s["f"]).alias("frames"), F.transform("hits", lambda s: s["x"]).alias("trajectory"))


def number_candidates(df: DataFrame, group: Names, number: str, weight: str, frame: str, least: int = 2) -> DataFrame:
    """Readings of a number that occur at least ``least`` times, with their mean weight, span and ordinal by first frame."""
    out = df.groupBy(*group, number).agg(F.count("*").alias("n"), F.avg(weight).alias("mean_weight"), F.min(frame).alias("first_frame"), F.max(frame).alias("last_frame")).where(F.col("n") >= least)
    return out.withColumn("ordinal", F.row_number().over(Window.partitionBy(*group).orderBy("first_frame", number)))


def digit_vote(df: DataFrame, group: Names, number: str) -> DataFrame:
    """The commonest digit at each place if all readings are equally long (of equal ones the lesser), else the commonest reading."""
    sizes = df.groupBy(*group).agg(F.min(F.length(number)).alias("lo"), F.max(F.length(number)).alias("hi"))
    digits = df.join(sizes.where("lo = hi"), list(group)).select(*group, F.posexplode(F.split(number, "(?!^)")).alias("place", "digit"))
    tops = best(digits.groupBy(*group, "place", "digit").count(), [*group, "place"], [F.desc("count"), F.asc("digit")])
    voted = tops.groupBy(*group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "digit"))), lambda s: s["digit"]), "").alias("number"))
    other = df.join(sizes.where("lo <> hi"), list(group)).groupBy(*group, number).count()
    return voted.unionByName(best(other, group, [F.desc("count"), F.asc(number)]).select(*group, F.col(number).alias("number")))


def identifier_pick(df: DataFrame, group: Names, text: str, n: str, weight: str, length: int = 11) -> DataFrame:
    """The best reading (full length, then most observations, weight, least text); the identifier is null unless it is full."""
    full = (F.length(text) == length).cast("int")
    top = best(df, group, [full.desc(), F.desc(n), F.desc(weight), F.asc(text)])
    return top.select(*group, F.when(full == 1, F.col(text)).alias("identifier"), F.when(full == 1, F.col(weight)).otherwise(0.0).alias("confidence"))


def ordered_fingerprint(df: DataFrame, group: Names, order: str, fields: Sequence[Column]) -> DataFrame:
    """SHA-256 over the rows of a group in order; any change of a row, or of the order, changes it."""
    line = F.concat_ws("|", *fields)
    rows = df.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("line")))).alias("rows"))
    return rows.select(*group, F.sha2(F.array_join(F.transform("rows", lambda s: s["line"]), "\n"), 256).alias("fingerprint"), F.size("rows").cast("long").alias("n"))


def provenance(df: DataFrame, key: str, source: str, universe: Sequence[str]) -> DataFrame:
    """Sources that saw a unit, sorted, and those of the universe that did not."""
    seen = F.array_sort(F.collect_set(source))
    return df.groupBy(key).agg(seen.alias("supporting")).withColumn("missing", F.array_except(F.array(*[F.lit(u) for u in universe]), F.col("supporting")))


def combined_confidence(*parts: str) -> Column:
    """Mean of the positive values; 0 without any."""
    positive = F.filter(F.array(*[F.coalesce(F.col(p).cast("double"), F.lit(0.0)) for p in parts]), lambda v: v > 0)
    return F.when(F.size(positive) > 0, F.aggregate(positive, F.lit(0.0), lambda a, v: a + v) / F.size(positive)).otherwise(0.0)


def cluster_quorum(df: DataFrame, cluster: Names, camera: str, time: str, weight: str, masters: DataFrame, master_group: Names, master_time: str, least: int = 2, spread: float = 1.5, least_weight: float = 0.4, clear: float = 1.0) -> DataFrame:
    """Clusters seen by enough cameras, narrow, confident and clear of every master time."""
    out = df.groupBy(*cluster).agg(F.countDistinct(camera).alias("cameras"), (F.max(time) - F.min(time)).alias("spread"), F.avg(weight).alias("mean_weight"), F.avg(time).alias("center"))
    out = out.where((F.col("cameras") >= least) & (F.col("spread") <= spread) & (F.col("mean_weight") >= least_weight))
    near = masters.select(*master_group, F.col(master_time).alias("__m"))
    close = out.join(near, list(master_group)).where(F.abs(F.col("center") - F.col("__m")) < clear).select(*cluster).distinct()
    return out.join(close, list(cluster), "left_anti")
