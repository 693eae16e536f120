"""Evidence for and against a state from how a track looks over time: lines that do not move, a gap that widens, structured motion, steady features.

A group is a track's window of looks, one row a frame; the pictures themselves are measured elsewhere and come as arrays of numbers by column. Every analysis
is array expressions within a row and sums over a group, so no group is held in one place. Rows whose profile is null or empty are no frames.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Names = Sequence[str]


@dataclass(frozen=True)
class LookLimits:
    """Thresholds of the analyses and of the decision (fixed values for pictures of 64 columns and 256 levels)."""

    least_frames: int = 8
    bright: float = 220.0
    tolerance: int = 3
    persistence: float = 0.75
    uniform_texture: float = 0.25
    moving_edges: float = 2.0
    edge_strength: float = 30.0
    least_gap: float = 2.0
    widening: float = 0.3
    narrowing: float = -0.3
    slack: float = 0.5
    dark: float = 0.7
    least_change: float = 8.0
    structured: float = 0.4
    moving_share: float = 0.3
    directed_share: float = 0.5
    decay: float = 0.85
    steady: float = 0.15
    most_reduction: float = 0.35
    boost: float = 0.05


def _let(value: Column, then) -> Column:
    """Names a value, so that it is worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)


def mean_of(x: Column) -> Column:
    """Null for an empty array."""
    return F.when(F.size(x) > 0, _total(x) / F.size(x))


def deviation_of(x: Column) -> Column:
    """The standard deviation of all values of an array; null for an empty one."""
    return _let(mean_of(x), lambda m: F.sqrt(mean_of(F.transform(x, lambda v: (v - m) * (v - m)))))


def texture_of(x: Column) -> Column:
    """How much the sizes of an array's values vary, as a share of their mean; 0 where they are all next to nothing."""
    return _let(F.transform(x, F.abs), lambda a: _let(mean_of(a), lambda m: F.when(m >= 1e-6, deviation_of(a) / m).otherwise(0.0)))


def centre_of(x: Column) -> Column:
    """The column about which the sizes of the values lie; null without any."""
    return _let(F.transform(x, F.abs), lambda a: _let(_total(a), lambda s: F.when(s > 0, _total(F.transform(a, lambda v, i: v * i)) / s)))


def gap_width(edges: Column, strength: float) -> Column:
    """The distance of the two strongest columns above ``strength``; 0 where there are fewer. Of equally strong ones the later come first."""
    found = F.filter(F.transform(edges, lambda v, i: F.struct((-v).alias("v"), (-i).alias("i"))), lambda e: -e["v"] > strength)
    return _let(F.array_sort(found), lambda e: F.when(F.size(e) > 1, F.abs(F.get(e, F.lit(0))["i"] - F.get(e, F.lit(1))["i"]).cast("double")).otherwise(0.0))


def darkness_of(profile: Column) -> Column:
    """Brightness of the middle third over that of the outer ones; 1 for fewer than six columns or dark outer ones."""
    third = F.floor(F.size(profile) / 3).cast("int")
    part = lambda start, length: mean_of(F.slice(profile, start, length))
    outer = (part(F.lit(1), third) + part(2 * third + 1, F.size(profile) - 2 * third)) / 2
    return F.when(F.size(profile) < 6, 1.0).otherwise(_let(outer, lambda o: F.when(o < 1e-6, 1.0).otherwise(part(third + 1, third) / o)))


def _slope(value: Column, place: Column, parts: Column) -> Column:
    """The aggregate slope of ``value / parts`` by place, with the spread of a sample over that of all rows; null for one place only.

    Sums and one division: for whole numbers it is the double nearest to the true slope, in whatever order the rows come, so a slope that lies on a limit is not beyond it.
    """
    x, y = F.when(value.isNotNull(), place).cast("double"), value.cast("double")
    n = F.count(y).cast("double")
    return F.try_divide((n * F.sum(x * y) - F.sum(x) * F.sum(y)) * F.count("*"), (n * F.sum(x * x) - F.sum(x) * F.sum(x)) * (F.count("*") - 1) * parts)


def _frames(looks: DataFrame, group: Names, order: Names, column: str) -> DataFrame:
    """Rows that are frames, with their place ``__i`` from 0."""
    return looks.where(F.size(column) > 0).withColumn("__i", F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1)


def reflections(looks: DataFrame, group: Names, order: Names, profile: str, texture: str, centre: str, l: LookLimits = LookLimits()) -> DataFrame:
    """``(group, lines, still, line_ratio, displacement, reflection, line_strength)``: are bright columns those of a reflection?

    ``lines`` are the columns that are bright in any frame, ``still`` those with a bright column within the tolerance in most frames. Uniform texture
    makes a reflection of one still line, varied texture unmakes all but clear ones, and edges that move unmake any. Fewer than three
    frames show nothing.
    """
    step = Window.partitionBy(*group).orderBy(*order)
    rows = _frames(looks, group, order, profile).withColumn("__step", F.abs(F.col(centre) - F.lag(centre).over(step)))
    bright = F.filter(F.transform(profile, lambda v, i: F.when(v > l.bright, i)), lambda i: i.isNotNull())
    frames = rows.groupBy(*group).agg(F.count("*").alias("__n"), F.avg(texture).alias("__texture"), F.coalesce(F.avg("__step"), F.lit(0.0)).alias("displacement"))
    near = F.array_distinct(F.flatten(F.transform("__bright", lambda c: F.sequence(c - l.tolerance, c + l.tolerance))))
    seen = rows.select(*group, bright.alias("__bright")).select(*group, "__bright", F.explode(near).alias("__c"))
    columns = seen.groupBy(*group, "__c").agg(F.count("*").alias("__k"), F.bool_or(F.array_contains("__bright", F.col("__c"))).alias("__line")).where("__line")
    both = columns.join(frames.select(*group, "__n"), list(group))
    lines = both.groupBy(*group).agg(F.count("*").alias("lines"), F.count_if(F.col("__k") / F.col("__n") >= l.persistence).alias("still"))
    out = frames.join(lines, list(group), "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("lines", "still")})
    out = out.withColumn("line_ratio", F.when(F.col("lines") > 0, F.col("still") / F.col("lines")).otherwise(0.0))
    clear = ((F.col("still") >= 2) & (F.col("line_ratio") > 0.5)) | ((F.col("still") >= 1) & (F.col("line_ratio") > 0.7))
    uniform = F.coalesce(F.col("__texture") < l.uniform_texture, F.lit(False))
    judged = F.when(uniform, clear | (F.col("still") >= 1)).otherwise(clear & (F.col("line_ratio") >= 0.8))
    enough = F.col("__n") >= 3
    out = out.withColumn("reflection", enough & judged & (F.col("displacement") <= l.moving_edges))
    strength = F.when(enough, F.least(F.lit(1.0), F.col("line_ratio") * F.col("still") / F.greatest(F.col("lines"), F.lit(1)))).otherwise(0.0)
    return out.select(*group, F.col("__n").alias("frames"), "lines", "still", "line_ratio", "displacement", "reflection", strength.alias("line_strength"))


def gap_evolution(looks: DataFrame, group: Names, order: Names, widths: str, darkness: str, l: LookLimits = LookLimits()) -> DataFrame:
    """``(group, gap_trend, gap_slope, slice_spread, gap_darkness)``: does the gap widen?

    ``widths`` holds a row's width by slice, the same number of slices in all rows. The trend is WIDENING only where the slices agree, NO_GAP where no width reaches
    the least or where the gap is as bright as what is beside it, and STABLE for fewer than three frames. Slopes are by frame, with the spread of a sample over that of all frames.
    """
    rows = _frames(looks, group, order, widths)
    at = F.col("__i")
    slices = rows.select(*group, "__i", F.posexplode(widths).alias("__s", "__w")).groupBy(*group, "__s").agg(_slope(F.col("__w"), at, F.lit(1)).alias("__b"))
    spread = slices.groupBy(*group).agg(deviation_of(F.array_sort(F.collect_list("__b"))).alias("slice_spread"))
    whole = rows.groupBy(*group).agg(F.count("*").alias("__n"), F.max(mean_of(F.col(widths))).alias("__most"), _slope(_total(F.col(widths)), at, F.max(F.size(widths))).alias("gap_slope"), F.avg(darkness).alias("gap_darkness"))
    out = whole.join(spread, list(group))
    some = (F.col("__n") >= 3) & (F.col("__most") >= l.least_gap)
    out = out.withColumn("gap_slope", F.when(some, F.col("gap_slope")).otherwise(0.0))
    agree = F.col("slice_spread") < F.abs("gap_slope") + l.slack
    bright = ~F.coalesce(F.col("gap_darkness") < l.dark, F.lit(False))
    trend = F.when(F.col("__n") < 3, "STABLE").when(~some, "NO_GAP").when((F.col("gap_slope") > l.widening) & agree, "WIDENING").when(bright, "NO_GAP").when(F.col("gap_slope") < l.narrowing, "NARROWING").otherwise("STABLE")
    return out.select(*group, trend.alias("gap_trend"), "gap_slope", "slice_spread", "gap_darkness")


def structured_motion(looks: DataFrame, group: Names, order: Names, picture: str, directed: str | None = None, l: LookLimits = LookLimits()) -> DataFrame:
    """``(group, changes, structured_ratio, directed_ratio, motion)``: do frames differ in places, as things that move do, or all over, as light does?

    ``picture`` holds a frame's values; frames of another size than the one before are no change. ``directed`` tells whether what moved since
    the frame before moved along the track; without it, nothing did.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    rows = _frames(looks, group, order, picture).withColumn("__before", F.lag(picture).over(w))
    same = F.size("__before") == F.size(picture)
    rows = rows.withColumn("__d", F.when(same, F.zip_with(picture, "__before", lambda a, b: F.abs(a - b))))
    rows = rows.withColumn("__m", mean_of(F.col("__d"))).withColumn("__cv", deviation_of(F.col("__d")) / (F.col("__m") + 1e-6))
    changed = F.col("__m") > l.least_change
    along = F.col(directed) if directed else F.lit(False)
    out = rows.groupBy(*group).agg(F.count_if(changed).alias("changes"), F.count_if(changed & (F.col("__cv") > l.structured)).alias("__s"), F.count_if(changed & along).alias("__a"))
    ratio = lambda c: F.when(F.col("changes") > 0, F.col(c) / F.col("changes")).otherwise(0.0)
    out = out.withColumn("structured_ratio", ratio("__s")).withColumn("directed_ratio", ratio("__a"))
    moves = (F.col("changes") >= 2) & ((F.col("structured_ratio") > l.moving_share) | (F.col("directed_ratio") > l.directed_share))
    return out.select(*group, "changes", "structured_ratio", "directed_ratio", moves.alias("motion"))


def steadiness(looks: DataFrame, group: Names, order: Names, features: str, l: LookLimits = LookLimits()) -> DataFrame:
    """``(group, steadiness, drift)``: 1 where features do not change over a window, in which later frames weigh more; 0.5 for fewer than three frames.

    All rows of a group have the same number of features. ``drift`` is the mean distance between frames that follow each other.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    rows = _frames(looks, group, order, features).withColumn("__before", F.lag(features).over(w))
    rows = rows.withColumn("__n", F.count("*").over(Window.partitionBy(*group))).withColumn("__w", F.pow(F.lit(l.decay), F.col("__n") - 1 - F.col("__i")))
    far = F.when(F.size("__before") == F.size(features), F.sqrt(_total(F.zip_with(features, "__before", lambda a, b: (a - b) * (a - b)))))
    drift = rows.groupBy(*group).agg(F.max("__n").alias("__n"), F.coalesce(F.avg(far), F.lit(0.0)).alias("drift"))
    cells = rows.select(*group, "__w", F.posexplode(features).alias("__k", "__v"))
    mean = F.sum(F.col("__w") * F.col("__v")) / F.sum("__w")
    spread = cells.groupBy(*group, "__k").agg((F.sum(F.col("__w") * F.col("__v") * F.col("__v")) / F.sum("__w") - mean * mean).alias("__s"))
    spread = spread.groupBy(*group).agg(F.sqrt(F.greatest(F.avg("__s"), F.lit(0.0))).alias("__s"), F.count("*").alias("__dim"))
    score = F.when(F.col("__n") < 3, 0.5).otherwise(1 - F.least(F.lit(1.0), F.col("__s") / (0.3 * F.sqrt("__dim"))))
    return drift.join(spread, list(group)).select(*group, score.alias("steadiness"), "drift")


def verify(evidence: DataFrame, confidence: str, l: LookLimits = LookLimits()) -> DataFrame:
    """Adds ``strength``, ``decision`` and ``adjusted`` to rows that hold the columns of the four analyses.

    NOT_READY below the least number of frames. Evidence against the state adds up; enough of it, a reflection without a gap, or neither gap nor motion
    override it, unless something confirms it: a widening gap, motion with a gap, or changing features. Anything else passes through.
    """
    gone = F.col("gap_trend") == "NO_GAP"
    strength = F.when(F.col("reflection"), 0.3).otherwise(0.0) + F.when(F.col("gap_trend").isin("NO_GAP", "STABLE"), 0.25).otherwise(0.0) + F.when(~F.col("motion"), 0.2).otherwise(0.0) + F.when(F.col("steadiness") > 1 - l.steady, 0.25).otherwise(0.0)
    rows = evidence.withColumn("__s", F.round(strength, 6))
    rows = rows.withColumn("strength", F.when(F.col("__s") >= 0.7, F.col("__s")).when(F.col("reflection") & gone, F.greatest("__s", F.lit(0.6))).when(gone & ~F.col("motion"), F.greatest("__s", F.lit(0.5))).otherwise(F.col("__s")))
    against = (F.col("__s") >= 0.7) | (gone & (F.col("reflection") | ~F.col("motion")))
    confirms = (F.col("gap_trend") == "WIDENING") | (F.col("motion") & ~gone) | (F.col("steadiness") < l.steady)
    decision = F.when(F.col("frames") < l.least_frames, "NOT_READY").when(confirms, "CONFIRMED").when(against, "OVERRIDDEN").otherwise("PASS_THROUGH")
    less = F.greatest(F.lit(0.1), F.col(confidence) - l.most_reduction * F.least(F.lit(1.0), F.col("strength")))
    adjusted = F.when(F.col("decision") == "OVERRIDDEN", less).when(F.col("decision") == "CONFIRMED", F.least(F.lit(1.0), F.col(confidence) + l.boost)).otherwise(F.col(confidence))
    return rows.withColumn("decision", decision).withColumn("adjusted", adjusted).drop("__s")
