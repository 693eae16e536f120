"""Support cameras on the master's clock: their offsets, and what each of them says about every master boundary.

Master rows are ``(group, key, time, confidence)``, support rows ``(group, camera, key, time, confidence)`` on the camera's own clock.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate
from operator import itemgetter
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.operators import reports, stateful
from trackloom.operators.stateful import AlignConfig

Names = Sequence[str]


def _sides(masters: DataFrame, supports: DataFrame, group: Names, camera: str, delta: Column | None = None) -> DataFrame:
    """Rows of both sides for ``align``, once for each camera of a group that has supports or is listed by them."""
    cameras = supports.select(*group, camera).distinct()
    time = F.col("time").cast("double")
    fields = [*group, camera, "side", "time", "confidence", "key"]
    m = masters.join(cameras, list(group)).withColumn("side", F.lit("M")).withColumn("time", time)
    s = supports.withColumn("side", F.lit("S")).withColumn("time", time if delta is None else time + delta)
    return m.select(*fields).unionByName(s.select(*fields))


def attach(masters: DataFrame, supports: DataFrame, cameras: DataFrame, group: Names, camera: str = "camera", cfg: AlignConfig = AlignConfig()) -> DataFrame:
    """``(group, camera, master_key, op, reason, support_key, residual)``: one row for each master and camera, and one for each extra support.

    ``cameras`` is ``(group, camera, delta, status, fps, t0, total_frames)``: clock offset and its status, rate, time of frame 0 on its own clock, and
    number of frames; a row for each camera of a group. MATCH has the support and its time less the master's; MISSING is a master that the camera's footage covers;
    OUT_OF_RANGE one that it does not; UNAVAILABLE all masters of a camera without usable footage or offset. EXTRA supports never make masters; those
    of a camera that is not synchronised are all extra. Masters are taken as they are: none is added, dropped or moved.
    """
    known = cameras.select(*group, camera, "delta", "status", "fps", "t0", "total_frames")
    on = [*group, camera]
    usable = (F.col("fps") > 0) & (F.col("total_frames") > 0)
    reason = F.when(~usable | F.col("fps").isNull() | F.col("total_frames").isNull(), "NO_METADATA").when(F.coalesce(F.col("status") == "UNRESOLVED", F.lit(True)), "OFFSET_UNRESOLVED")
    known = known.withColumn("reason", reason)
    synced = known.where("reason IS NULL")
    mine = supports.join(synced.select(*on, "delta"), on)
    rows = masters.join(synced.select(*on), list(group)).select(*on, F.lit("M").alias("side"), F.col("time").cast("double").alias("time"), "confidence", "key")
    rows = rows.unionByName(mine.select(*on, F.lit("S").alias("side"), (F.col("time") + F.col("delta")).cast("double").alias("time"), "confidence", "key"))
    found = stateful.align(rows, on, cfg)
    # Whether footage covers a master that has no match.
    missing = found.where("op = 'MISSING'").drop("op").join(masters.select(*group, F.col("key").alias("master_key"), "time"), [*group, "master_key"]).join(synced.drop("reason"), on)
    frame = F.round((F.col("time") - F.col("delta") - F.col("t0")) * F.col("fps"))
    covered = (frame >= 0) & (frame <= F.col("total_frames") - 1)
    none = F.lit(None).cast("string")
    fields = [*on, "master_key", "op", "reason", "support_key", "residual"]
    missing = missing.withColumn("op", F.when(covered, "MISSING").otherwise("OUT_OF_RANGE")).withColumn("reason", F.when(~covered, "OUT_OF_RANGE"))
    out = found.where("op <> 'MISSING'").withColumn("reason", none).select(*fields).unionByName(missing.select(*fields))
    left = known.where("reason IS NOT NULL").select(*on, "reason")
    nothing = [F.lit(None).cast("long").alias("support_key"), F.lit(None).cast("double").alias("residual")]
    away = masters.join(left, list(group)).select(*on, F.col("key").alias("master_key"), F.lit("UNAVAILABLE").alias("op"), "reason", *nothing)
    loose = supports.join(left, on).select(*on, F.lit(None).cast("long").alias("master_key"), F.lit("EXTRA").alias("op"), "reason", F.col("key").alias("support_key"), nothing[1])
    return out.unionByName(away).unionByName(loose)


def evidence_times(masters: DataFrame, supports: DataFrame, attached: DataFrame, group: Names, camera: str = "camera") -> DataFrame:
    """``(group, key, n_support, weighted_time)``: the mean of a master's time and those of its matches, by confidence; null without confidence.

    A diagnosis only: the master's own time stands.
    """
    seen = attached.where("op = 'MATCH'").select(*group, camera, "master_key", F.col("support_key").alias("key"), "residual").join(supports.select(*group, camera, "key", "confidence"), [*group, camera, "key"])
    own = masters.select(*group, F.col("key").alias("master_key"), F.lit(0.0).alias("residual"), "confidence", F.lit(0).alias("support"))
    rows = own.unionByName(seen.select(*group, "master_key", "residual", "confidence", F.lit(1).alias("support")))
    # Residuals are small, so their mean loses no digits of a long clock.
    mean = rows.groupBy(*group, "master_key").agg(F.sum("support").alias("n_support"), F.try_divide(F.sum(F.col("residual") * F.col("confidence")), F.sum("confidence")).alias("__r"))
    at = masters.select(*group, F.col("key").alias("master_key"), "time")
    return at.join(mean, [*group, "master_key"]).select(*group, F.col("master_key").alias("key"), "n_support", (F.col("time") + F.col("__r")).alias("weighted_time"))


@dataclass(frozen=True)
class OffsetConfig:
    """In units of ``time``. ``separation`` 0 takes the masters' median spacing; ``fine_step`` is one frame of the camera."""

    align: AlignConfig = AlignConfig(gate=1.5, tolerance=0.5, pattern_weight=2.0)
    search: float = 35.0
    step: float = 0.25
    fine_window: float = 1.0
    fine_step: float = 0.04
    min_margin: float = 0.10
    min_match: float = 0.30
    separation: float = 0.0
    first: int = 8


def _votes(rows: Iterable[tuple], cfg: OffsetConfig) -> tuple[list[int], list[int]]:
    """How many masters, and how many supports, an offset of the search can bring into the gate of another; rows are ``(time, side, ...)`` in order of time.

    The steps that a pair votes for move one way as a row's partners go by, so what is new of them is what reaches beyond those it has.
    """
    steps, gate = int(round(2 * cfg.search / cfg.step)), cfg.align.gate
    counts = {"M": [0] * (steps + 2), "S": [0] * (steps + 2)}
    open_: dict[str, deque] = {"M": deque(), "S": deque()}
    for t, side, *_ in rows:
        own = [t, steps + 1 if side == "M" else -1]
        for waiting in open_.values():
            while waiting and waiting[0][0] < t - cfg.search - gate - cfg.step:
                waiting.popleft()
        for other in open_["S" if side == "M" else "M"]:
            m, s = (own, other) if side == "M" else (other, own)
            far = m[0] - s[0]
            low = max(math.ceil((far - gate + cfg.search) / cfg.step - 1e-9), 0)
            high = min(math.floor((far + gate + cfg.search) / cfg.step + 1e-9), steps)
            if low > high:
                continue
            for row, name, first, last in ((m, "M", low, min(high, m[1] - 1)), (s, "S", max(low, s[1] + 1), high)):
                if first <= last:
                    counts[name][first] += 1
                    counts[name][last + 1] -= 1
            m[1], s[1] = min(m[1], low), max(s[1], high)
        open_[side].append(own)
    return list(accumulate(counts["M"]))[: steps + 1], list(accumulate(counts["S"]))[: steps + 1]


def _bounds(rows: Sequence[tuple], cfg: OffsetConfig) -> tuple[list[tuple[float, float, bool]], int, int]:
    """``(offset, bound, voted)`` of each step, and how many masters and supports there are."""
    nm = sum(r[1] == "M" for r in rows)
    ns = len(rows) - nm
    most = [min(pair) for pair in zip(*_votes(rows, cfg))]
    return [(k * cfg.step - cfg.search, float((nm - n) * cfg.align.missing + (ns - n) * cfg.align.extra), n > 0) for k, n in enumerate(most)], nm, ns


def offset_bounds(masters: DataFrame, supports: DataFrame, on: Names, group: Names, cfg: OffsetConfig) -> DataFrame:
    """``(group, camera, step, offset, bound, voted)`` for every offset of the search: no alignment there can score less than ``bound``.

    The time differences of all pairs within reach vote for the offsets that bring them into the gate; masters and supports that no pair
    reaches stay unmatched, and each costs its full price. An offset without votes scores exactly its bound.
    """

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        found, nm, _ = _bounds(list(rows), cfg)
        if nm:
            yield from ((k, *row) for k, row in enumerate(found))

    (camera,) = [c for c in on if c not in group]
    return stateful._fold(_sides(masters, supports, group, camera), on, ["time", "side", "key"], ["time", "side"], {"step": "int", "offset": "double", "bound": "double", "voted": "boolean"}, work)


def _score(sides: DataFrame, offsets: DataFrame, on: Names, cfg: OffsetConfig) -> DataFrame:
    """The scores of given offsets, each a group of its own."""
    return stateful.offset_curve(sides.join(offsets.select(*on, "offset").distinct(), list(on)), on, "offset", cfg.align)


def _search(rows: list[tuple], cfg: OffsetConfig) -> tuple | None:
    """The search of ``estimate_offsets`` over one camera's rows ``(time, side, confidence, key)`` in order of time."""
    bounds, nm, ns = _bounds(rows, cfg)
    if not nm:
        return None

    def scored(offset: float) -> tuple:
        moved = sorted(((t + (offset if side == "S" else 0.0), side, c, t, k) for t, side, c, k in rows), key=lambda r: (r[0], r[1], r[4]))
        return stateful.curve_score(moved, cfg.align)

    # Without votes nothing can match, so those offsets need no alignment.
    known = {o: (b, 0, nm, ns) for o, b, voted in bounds if not voted}
    order = lambda o: (known[o][0], abs(o), o)
    times = [t for t, side, *_ in rows if side == "M"]
    positive = [b - a for a, b in zip(times, times[1:]) if b > a]
    spacing = median(positive) if positive else 0.0
    apart = max((cfg.separation or spacing or 1.0) * 0.75, 2 * cfg.align.gate)
    wave = [o for _, _, o in sorted((b, abs(o), o) for o, b, voted in bounds if voted)[: cfg.first]]
    while True:
        known |= {o: scored(o) for o in wave}
        best = min(known, key=order)
        rival = min((o for o in known if abs(o - best) >= apart), key=order, default=None)
        limit = math.inf if rival is None else known[rival][0]
        wave = [o for o, b, voted in bounds if voted and b <= limit and o not in known]
        if not wave:
            break
    # The fine pass takes the first strictly better score; then the winner is shifted by whole spacings.
    low = best - cfg.fine_window
    tried = [(*scored(o), o) for o in (low + k * cfg.fine_step for k in range(int(round(2 * cfg.fine_window / cfg.fine_step)) + 1))]
    score, n_match, n_missing, n_extra, offset = min([(*known[best], best), *tried], key=itemgetter(0))
    alias = min(((scored(offset + k * spacing)[0], abs(k), k) for k in (-1, 0, 1)), default=None) if spacing > 0 else (None, None, None)
    return offset, score, n_match, n_missing, n_extra, rival, None if rival is None else known[rival][0], alias[2], alias[0], nm, ns


def estimate_offsets(masters: DataFrame, supports: DataFrame, group: Names, camera: str = "camera", cfg: OffsetConfig = OffsetConfig()) -> DataFrame:
    """``(group, camera, delta, score, n_match, n_missing, n_extra, runner_up, margin, alias_k, status, reason, usable)`` for each camera with supports.

    The search is exact: it gives the offset of least score (of equals the least shift, then the lesser) over all of ``-search, -search + step, ...``, and the best
    rival at least three quarters of a spacing away, but aligns only offsets whose bound (``offset_bounds``) is not above what is already found: first the
    most promising, then, wave by wave, those that could still win or be the rival. A fine pass of ``fine_step`` around the winner takes the first strictly better
    score. UNRESOLVED are TOO_FEW matches, an ALIAS (a shift by one median spacing of the masters scores better) and an AMBIGUOUS margin between winner
    and rival; NO_MASTERS where a group has none. ``usable`` is the offset where it is resolved, else 0.

    A camera's rows of a group are dealt once and searched where they are, so they have to fit a task; neither votes nor candidates are rows.
    """
    on = [*group, camera]

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        found = _search(list(rows), cfg)
        if found:
            yield found

    kinds = {"offset": "double", "score": "double", "n_match": "bigint", "n_missing": "bigint", "n_extra": "bigint", "runner_up": "double", "rival": "double", "k": "int", "alias_score": "double", "__nm": "bigint", "__ns": "bigint"}
    out = stateful._fold(_sides(masters, supports, group, camera), on, ["time", "side", "key"], ["time", "side", "confidence", "key"], kinds, work)
    margin = F.when(F.col("rival").isNull(), F.lit(float("inf"))).otherwise((F.col("rival") - F.col("score")) / F.greatest(F.abs("score"), F.abs("rival"), F.lit(1.0)))
    least = F.greatest(F.ceil(cfg.min_match * F.least("__nm", "__ns")), F.lit(1))
    reason = F.when(F.col("n_match") < least, "TOO_FEW").when((F.col("k") != 0) & (F.col("alias_score") < F.col("score")), "ALIAS").when(margin < cfg.min_margin, "AMBIGUOUS")
    out = out.withColumn("reason", reason).withColumn("margin", margin).withColumn("status", F.when(F.col("reason").isNull(), "RESOLVED").otherwise("UNRESOLVED"))
    none = supports.select(*on).distinct().join(masters.select(*group).distinct(), list(group), "left_anti")
    fields = [*on, F.col("offset").alias("delta"), "score", "n_match", "n_missing", "n_extra", "runner_up", "margin", F.col("k").alias("alias_k"), "status", "reason", reports.usable_offset(F.col("offset"), F.col("status")).alias("usable")]
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("delta", "double"), ("score", "double"), ("n_match", "long"), ("n_missing", "long"), ("n_extra", "long"), ("runner_up", "double"), ("margin", "double"), ("alias_k", "int"))]
    return out.select(*fields).unionByName(none.select(*on, *empty, F.lit("UNRESOLVED").alias("status"), F.lit("NO_MASTERS").alias("reason"), F.lit(0.0).alias("usable")))
