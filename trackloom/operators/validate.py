"""The validation cascade: why a track is no boundary, which rejections are soft, and what may be recovered.

Everything is a column expression or a window, except the suppression of duplicates, the separation and the recovery, whose choices
depend on earlier ones: ``stateful`` folds those in groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.operators import graph, joins, stateful, windows

Names = Sequence[str]

#: Reasons that no context lifts, and those that it may (fixed values).
HARD = ("TOO_SHORT", "DETECTION_GAP", "STATIC", "WRONG_DIRECTION", "DUPLICATE", "MIN_SEPARATION", "NO_TRAJECTORY")
SOFT = ("LOW_CONFIDENCE", "LOW_MOTION", "IMPLAUSIBLE_SPEED", "INCONSISTENT_TRAJECTORY", "TRAIN_MOTION_MISMATCH")


#: Thresholds in seconds, and in widths of the frame (speeds: widths a second); fixed values.
SECONDS = {"min_track": 0.27, "max_missed": 1.33, "separation": 0.67}
WIDTHS = {"static_motion": 0.0047, "min_motion": 0.0142, "min_speed": 0.0094, "max_speed": 2.36, "duplicate_distance": 0.1415}


@dataclass(frozen=True)
class Limits:
    """Thresholds in frames and pixels, already resolved for a camera."""

    min_track_frames: int = 4
    min_hits: int = 3
    max_missed: int = 20
    min_coverage: float = 0.20
    min_confidence: float = 0.45
    static_motion: float = 4.0
    min_motion: float = 12.0
    min_speed: float = 8.0
    max_speed: float = 2000.0
    min_monotonic: float = 0.60
    min_steps: int = 3
    stopped_fraction: float = 0.10
    stop_tracks: int = 2
    speed_band: float = 4.0
    least_tracks: int = 5
    reach: int = 5
    recover_efficiency: float = 0.40
    recover_monotonic: float = 0.45
    recover_confidence: float = 0.30
    duplicate_overlap: float = 0.30
    duplicate_distance: float = 120.0
    separation: int = 10

    @classmethod
    def resolve(cls, width: float, fps: float, overrides: Mapping[str, float] | None = None) -> Limits:
        """Seconds and shares of the frame's width become frames and pixels; a camera without either is taken for 848 pixels at 15 a second.

        ``overrides`` are absolute values, taken as they are; unknown names are refused.
        """
        w, f = (width if width and width > 0 else 848.0), (fps if fps and fps > 0 else 15.0)
        frames = lambda seconds, least: max(least, round(seconds * f))
        s = SECONDS
        out = cls(min_track_frames=frames(s["min_track"], 2), max_missed=frames(s["max_missed"], 1), separation=frames(s["separation"], 1), static_motion=WIDTHS["static_motion"] * w, min_motion=WIDTHS["min_motion"] * w, min_speed=WIDTHS["min_speed"] * w, max_speed=WIDTHS["max_speed"] * w, duplicate_distance=WIDTHS["duplicate_distance"] * w)
        unknown = sorted(set(overrides or {}) - {x.name for x in fields(cls)})
        if unknown:
            raise ValueError(f"unknown thresholds: {', '.join(unknown)}")
        return replace(out, **{k: type(getattr(out, k))(v) for k, v in (overrides or {}).items() if v is not None})


def first_reason(l: Limits, paused: Column) -> Column:
    """The first test that a track fails, in order; null if it passes all. A paused track is excused from the motion tests."""
    moved = F.abs(F.col("displacement"))
    return (
        F.when((F.col("track_frames") < l.min_track_frames) | (F.col("hits") < l.min_hits), "TOO_SHORT")
        .when((F.col("max_missed") > l.max_missed) | (F.col("coverage") < l.min_coverage), "DETECTION_GAP")
        .when(F.col("confidence") < l.min_confidence, "LOW_CONFIDENCE")
        .when(paused, None)
        .when(moved <= l.static_motion, "STATIC")
        .when(moved < l.min_motion, "LOW_MOTION")
        .when((F.col("speed") < l.min_speed) | (F.col("speed") > l.max_speed), "IMPLAUSIBLE_SPEED")
        .when((F.col("n_steps") >= l.min_steps) & (F.col("monotonic") < l.min_monotonic), "INCONSISTENT_TRAJECTORY")
    )


def paused_tracks(features: DataFrame, group: Names, key: str, l: Limits) -> DataFrame:
    """Adds ``paused``: tracks far slower than their group's median that overlap another such track in time."""
    median = F.median(F.when(F.col("speed") > 0, F.col("speed"))).over(Window.partitionBy(*group))
    stalled = F.coalesce(F.col("speed") <= F.col("__m") * l.stopped_fraction, F.lit(False))
    rows = features.withColumn("__m", median).withColumn("__stalled", stalled).drop("__m")
    return joins.with_company(rows, group, "start_frame", "end_frame", key, "__stalled", "paused", l.stop_tracks).drop("__stalled")


def cascade(features: DataFrame, group: Names, key: str, l: Limits = Limits()) -> DataFrame:
    """Adds ``reason`` (null: accepted), ``severity``, ``paused`` and the ``reference`` speed with its kind to motion features with a ``confidence``.

    After the tests of a track by itself come those against its group: a direction against the majority of at least ``least_tracks``
    survivors, and a speed outside the band around the local median of theirs, unless it is paused with others.
    """
    rows = paused_tracks(features, group, key, l).withColumn("reason", first_reason(l, F.col("paused")))
    p = Window.partitionBy(*group)
    alive = F.col("reason").isNull()
    rows = rows.withColumn("__n", F.count_if(alive).over(p)).withColumn("__flow", F.signum(F.sum(F.when(alive, F.col("direction")).otherwise(0)).over(p)))
    against = alive & (F.col("__n") >= l.least_tracks) & (F.col("__flow") != 0) & (F.col("direction") != 0) & (F.col("direction") != F.col("__flow"))
    rows = rows.withColumn("reason", F.when(against, "WRONG_DIRECTION").otherwise(F.col("reason"))).drop("__n", "__flow")
    # Survivors are a part of their group's window, so nothing is read twice; the reference of a rejected row is not theirs.
    own, alive = [*group, "__alive"], F.col("__alive")
    rows = windows.local_median(rows.withColumn("__alive", F.col("reason").isNull()), own, ["start_frame", key], "speed", l.reach, 2)
    rows = rows.withColumns({c: F.when(alive, F.col(c)) for c in ("reference", "reference_kind")}).withColumn("__n", F.count("*").over(Window.partitionBy(*own)))
    outside = alive & (F.col("__n") >= l.least_tracks) & F.col("reference").isNotNull() & ~F.col("speed").between(F.col("reference") / l.speed_band, F.col("reference") * l.speed_band) & ~F.col("paused")
    out = rows.withColumn("reason", F.when(outside, "TRAIN_MOTION_MISMATCH").otherwise(F.col("reason"))).drop("__n", "__alive")
    return out.withColumn("severity", F.when(F.col("reason").isin(*HARD), "HARD").when(F.col("reason").isin(*SOFT), "SOFT"))


def cascade_tail(judged: DataFrame, group: Names, key: str, l: Limits = Limits()) -> DataFrame:
    """The last steps of the cascade, over what it left standing: of duplicates the better evidenced track stays, and so it does of two
    that are too close in time and place. ``judged`` holds the rows of ``cascade`` with ``x_start``; reason and severity are filled in, with the
    track that a row lost to in ``lost_to`` for duplicates. The judged rows are checkpointed, as they are read several times."""
    judged = graph.cut_lineage(judged)
    standing = judged.where("reason IS NULL")
    first = stateful.suppress_duplicates(standing, group, key, "start_frame", "end_frame", "x_start", "hits", "confidence", l.duplicate_overlap, l.duplicate_distance).withColumnRenamed("duplicate_of", "lost_to")
    standing = standing.join(first, [*group, key])
    left = standing.where("lost_to IS NULL").withColumn("__centre", F.bround((F.col("start_frame") + F.col("end_frame")) / 2))
    second = stateful.min_separation(left, group, key, "__centre", "x_start", "hits", "confidence", l.separation, l.duplicate_distance)
    standing = standing.join(second, [*group, key], "left")
    reason = F.when(F.col("lost_to").isNotNull(), "DUPLICATE").when(~F.col("kept"), "MIN_SEPARATION")
    standing = standing.withColumn("reason", reason).withColumn("severity", F.when(reason.isNotNull(), "HARD")).drop("kept")
    return standing.unionByName(judged.where("reason IS NOT NULL").withColumn("lost_to", F.lit(None).cast("long")))


def no_trajectory(tracks: DataFrame, features: DataFrame, group: Names, key: str) -> DataFrame:
    """Tracks without motion features, which a track of a single hit has none of: ``(group, key, reason, severity)``."""
    return tracks.select(*group, key).join(features.select(*group, key), [*group, key], "left_anti").withColumns({"reason": F.lit("NO_TRAJECTORY"), "severity": F.lit("HARD")})


def recoverable(rejected: DataFrame, spans: DataFrame | None, group: Names, l: Limits = Limits()) -> DataFrame:
    """Adds ``outcome`` to rejected tracks: OUTSIDE the group's active span ``(lo, hi)``, BLOCKED by a hard reason or a safety floor, or CANDIDATE.

    Without ``spans`` the rows hold ``lo`` and ``hi`` themselves. A candidate may still clash with accepted tracks, see ``stateful.recover``.
    """
    rejected = rejected if spans is None else rejected.join(spans, list(group), "left")
    centre = F.bround((F.col("start_frame") + F.col("end_frame")) / 2)
    steps = F.col("n_steps") >= l.min_steps
    floor = (F.abs(F.col("displacement")) <= l.static_motion) | (steps & (F.col("path_efficiency") < l.recover_efficiency)) | (steps & (F.col("monotonic") < l.recover_monotonic)) | (F.col("confidence") < l.recover_confidence) | (F.col("direction") == 0)
    outcome = F.when(F.col("lo").isNull() | ~centre.between(F.col("lo"), F.col("hi")), "OUTSIDE").when((F.col("severity") == "HARD") | floor, "BLOCKED").otherwise("CANDIDATE")
    return rejected.withColumn("outcome", outcome).drop("lo", "hi")


def position_of(frame: Column, lo: Column, hi: Column) -> Column:
    return F.when(lo.isNull() | hi.isNull(), "UNKNOWN").when(frame < lo, "PRE").when(frame > hi, "POST").otherwise("ACTIVE")


#: Column of a rejected row that tells why, by reason, and what it is multiplied by to be shown as a whole number.
MEASURES = {"TOO_SHORT": ("track_frames", 1), "DETECTION_GAP": ("max_missed", 1), "LOW_CONFIDENCE": ("confidence", 1), "STATIC": ("displacement", 1), "LOW_MOTION": ("displacement", 1), "IMPLAUSIBLE_SPEED": ("speed", 1000), "INCONSISTENT_TRAJECTORY": ("monotonic", 1000), "WRONG_DIRECTION": ("direction", 1), "TRAIN_MOTION_MISMATCH": ("reference", 1000), "DUPLICATE": ("lost_to", 1)}


def rejection_report(judged: DataFrame, recovered: DataFrame, group: Names, key: str, fps: float, l: Limits = Limits()) -> DataFrame:
    """One flat row for each rejected track, with all that a reader needs to judge the rejection.

    ``judged`` holds the rows of ``cascade_tail`` with the active span ``(lo, hi)``, ``recovered`` those of ``stateful.recover``. Beside the features there are the span as text and in
    seconds, the reference speed (``-`` for its kind where that test was not reached), the class of the reason, where the track lies in the active span, the
    nearest accepted tracks (the one before begins earlier, the next one not), what became of its recovery (``-``: not looked at) and the measure
    that failed, in whole numbers (speeds and shares in thousandths).
    """
    w = Window.partitionBy(*group)
    accepted = F.when(F.col("reason").isNull(), F.col("start_frame"))
    back, ahead = w.orderBy("start_frame").rangeBetween(Window.unboundedPreceding, -1), w.orderBy(F.desc("start_frame")).rangeBetween(Window.unboundedPreceding, 0)
    rows = judged.withColumn("__before", F.max(accepted).over(back)).withColumn("__after", F.min(accepted).over(ahead)).where("reason IS NOT NULL")
    at = position_of(F.col("start_frame"), F.col("lo"), F.col("hi"))
    rows = rows.withColumn("train_state", F.when(at == "ACTIVE", "WAGON_ACTIVE").when(at == "UNKNOWN", at).otherwise(F.concat(at, F.lit("_WAGON"))))
    rows = recoverable(rows, None, group, l).join(recovered.select(*group, key, "recovered"), [*group, key], "left")
    blocked = F.when(F.col("severity") == "HARD", "blocked: hard reason").otherwise("blocked: safety floor")
    fate = F.when(F.col("outcome") == "BLOCKED", blocked).when(F.col("outcome") == "OUTSIDE", "-").when(F.col("recovered"), "recovered").otherwise("blocked: near an accepted track")
    seconds = lambda frame: F.round(frame / fps, 2)
    detail = F.lit("")
    for reason, (column, scale) in MEASURES.items():
        detail = F.when(F.col("reason") == reason, F.concat(F.lit(f"{column}="), F.floor(F.col(column) * scale).cast("string"))).otherwise(detail)
    return rows.select(
        *group, key, F.concat_ws("-", "start_frame", "end_frame").alias("frames"), F.col("start_frame").alias("frame_start"), seconds(F.col("start_frame")).alias("time_s"), seconds(F.col("track_frames")).alias("duration_s"), "hits", "coverage", "confidence",
        F.col("min_confidence").alias("min_conf"), F.col("displacement").alias("displacement_px"), (F.col("speed") * fps).alias("speed_px_s"), (F.col("reference") * fps).alias("ref_speed_px_s"), F.coalesce("reference_kind", F.lit("-")).alias("ref_kind"), F.col("paused").alias("motion_paused"),
        "direction", "monotonic", "path_efficiency", F.col("max_missed").alias("max_det_gap"), "reason", F.coalesce("severity", F.lit("?")).alias("class"), "train_state", seconds(F.col("__before")).alias("nearest_prev_s"), seconds(F.col("__after")).alias("nearest_next_s"), fate.alias("recovery"), detail.alias("detail"))


def roster_problems(roster: DataFrame, group: Names, unit: str = "unit_id", index: str = "unit_index") -> DataFrame:
    """Violations of the roster's contract ``(group, unit, problem)``: ids are ``GW_<index>``, indexes are 1..n, spans do not run backwards."""
    w = Window.partitionBy(*group).orderBy(index, unit)
    checks = F.array_compact(F.array(
        F.when(F.col(unit) != F.concat(F.lit("GW_"), F.col(index).cast("string")), "id does not match the index"),
        F.when(F.col(index) != F.row_number().over(w), "index is not the position"),
        F.when(F.col("end_frame") < F.col("start_frame"), "span runs backwards"),
        F.when(F.col("start_frame") <= F.lag("end_frame").over(w), "span overlaps the one before"),
    ))
    return roster.withColumn("__p", checks).select(*group, unit, F.explode("__p").alias("problem"))
