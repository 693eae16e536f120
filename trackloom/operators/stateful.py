"""Operators whose rows depend on earlier decisions: folds over the rows of a group, in order.

Spark deals the rows by group and sorts them; each task then walks its Arrow batches row by row. A group is a sensor, or a camera of one batch. Most folds
hold only what is open (tracks, a challenge, a stretch without a pause), however long the group is; ``recover``, ``track_remembering`` and the chains of
fragments hold their group, so there the key has to be fine enough. A window or join cannot express these, because a greedy choice changes
what later rows may choose.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby, islice
from operator import itemgetter
from statistics import median

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Names = Sequence[str]
_ARROW = {"array<double>": pa.list_(pa.float64()), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}


#: Rows of a batch that a fold gives.
PIECE = 8192


def _fold(df: DataFrame, group: Names, order: Names, columns: Names, out: dict[str, str], work: Callable[[Iterator[tuple]], Iterable[tuple]]) -> DataFrame:
    """``(group, out)``: the rows that ``work`` gives for each group's rows, which it gets as tuples of ``columns`` in order, one by one.

    Neither the rows of a group nor what it gives are held here: a fold's memory is what ``work`` keeps.
    """
    kinds = {g: df.schema[g].dataType.simpleString() for g in group} | out
    names, types, width = list(kinds), [_ARROW[k] for k in kinds.values()], len(group)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in (*group, *columns))))
        for key, mine in groupby(rows, lambda row: row[:width]):
            for row in work(r[width:] for r in mine):
                yield (*key, *row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = results(batches)
        while piece := list(islice(found, PIECE)):
            yield packed(piece)

    dealt = df.select(*dict.fromkeys([*group, *order, *columns])).repartition(*group).sortWithinPartitions(*group, *order)
    return dealt.mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in kinds.items()))


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


class MotionFilter:
    """Constant-velocity Kalman filter of one coordinate; any number of frames is predicted in closed form.

    The covariance is held as its three entries. A prediction over k frames adds the process noise of each frame, carried on by the frames
    after it, which sums to polynomials in k.
    """

    def __init__(self, x: float, process: float = 4.0, measure: float = 9.0, start: float = 100.0):
        self.x, self.v = x, 0.0
        self.xx, self.xv, self.vv = start, 0.0, start
        self.process, self.measure = process, measure

    def predict(self, k: int = 1) -> float:
        s1, s2 = k * (k - 1) / 2, (k - 1) * k * (2 * k - 1) / 6
        self.x += k * self.v
        self.xx += 2 * k * self.xv + k * k * self.vv + self.process * (k + s2)
        self.xv += k * self.vv + self.process * s1
        self.vv += self.process * k
        return self.x

    def update(self, z: float) -> None:
        spread, miss = self.xx + self.measure, z - self.x
        gain_x, gain_v = self.xx / spread, self.xv / spread
        self.x, self.v = self.x + gain_x * miss, self.v + gain_v * miss
        self.xx, self.xv, self.vv = self.xx * (1 - gain_x), self.xv * (1 - gain_x), self.vv - gain_v * self.xv


@dataclass(frozen=True)
class TrackerConfig:
    match_distance: float = 80.0
    max_missed: int = 30
    min_hits: int = 3


def track(detections: DataFrame, group: Names, cfg: TrackerConfig = TrackerConfig()) -> DataFrame:
    """Greedy nearest-neighbour tracks over ``(frame, x, confidence, event_id)``.

    In each frame detections go by x to the free open track whose predicted place is nearest, within the distance (of equal ones the older);
    others open tracks. A track closes once it has missed ``max_missed`` frames and counts with ``min_hits`` hits. Frames without detections
    count as missed. Gives ``(group, track_id, start_frame, end_frame, hits, confidence, consistency)``, ids ranked by first and last frame.
    """

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        open_: list[dict] = []
        done: list[tuple] = []
        number = 0
        for f, seen in groupby(rows, itemgetter(0)):
            keep = []
            for t in open_:
                if f - 1 - t["last"] < cfg.max_missed:
                    keep.append(t)
                elif t["hits"] >= cfg.min_hits:
                    done.append((t["first"], t["last"], t["hits"], t["conf"]))
            if done and len(keep) < len(open_):  # closed tracks that began before all open ones have their numbers
                since = min((t["first"] for t in keep), default=f)
                done.sort(key=itemgetter(0, 1))
                ready = bisect.bisect_left(done, since, key=itemgetter(0))
                for number, t in enumerate(done[:ready], number + 1):
                    yield number, *t[:3], t[3] / t[2], min(1.0, t[2] / (t[1] - t[0] + 1))
                done = done[ready:]
            open_, used = keep, set()
            for t in open_:
                t["filter"].predict(f - t["at"])
                t["at"] = f
            for _, x, c in seen:
                free = [(abs(x - t["filter"].x), i) for i, t in enumerate(open_) if i not in used and abs(x - t["filter"].x) <= cfg.match_distance]
                if free:
                    i = min(free)[1]
                    open_[i]["filter"].update(x)
                else:
                    i = len(open_)
                    open_.append({"first": f, "at": f, "hits": 0, "conf": 0.0, "filter": MotionFilter(x)})
                used.add(i)
                t = open_[i]
                t.update(last=f, hits=t["hits"] + 1, conf=t["conf"] + c)
        done += [(t["first"], t["last"], t["hits"], t["conf"]) for t in open_ if t["hits"] >= cfg.min_hits]
        for number, t in enumerate(sorted(done, key=itemgetter(0, 1)), number + 1):
            yield number, *t[:3], t[3] / t[2], min(1.0, t[2] / (t[1] - t[0] + 1))

    out = {"track_id": "bigint", "start_frame": "bigint", "end_frame": "bigint", "hits": "bigint", "confidence": "double", "consistency": "double"}
    return _fold(detections, group, ["frame", "x", "event_id"], ["frame", "x", "confidence"], out, work)


@dataclass(frozen=True)
class StreakConfig:
    open_confidence: float = 0.5
    closed_confidence: float = 0.5
    open_rows: int = 5
    closed_rows: int = 5


class Streaks:
    """A door's state by streaks of confident predictions, one prediction at a time; ``state``, ``streak`` and ``opened`` are all there is to store.

    A confident row lengthens its kind's streak and ends the others'; a weak one, or one of no kind, shortens all by one. OPEN is left only by twice the usual
    streak. Damage ends the other streaks but is no state.
    """

    def __init__(self, cfg: StreakConfig = StreakConfig(), state: str = "UNKNOWN", streak: dict[str, int] | None = None, opened: bool = False):
        self.cfg, self.state, self.streak, self.opened = cfg, state, streak or {}, opened
        usual, slow = cfg.closed_rows, 2 * cfg.closed_rows
        # From each state: the states that may follow, in the order of their tests, with the streak that each needs.
        self.follow = {
            "UNKNOWN": (("OPEN", cfg.open_rows), ("PARTIAL_CLOSED", usual), ("CLOSED", usual)),
            "CLOSED": (("OPEN", cfg.open_rows), ("PARTIAL_CLOSED", usual)),
            "PARTIAL_CLOSED": (("OPEN", cfg.open_rows), ("CLOSED", usual)),
            "OPEN": (("CLOSED", slow), ("PARTIAL_CLOSED", slow)),
        }

    def kind(self, name: str | None, c: float) -> str | None:
        name = (name or "").lower()
        if "damage" in name:
            found, least = "DAMAGE", self.cfg.closed_confidence
        elif "partial" in name:
            found, least = "PARTIAL_CLOSED", self.cfg.closed_confidence
        elif "open" in name:
            found, least = "OPEN", self.cfg.open_confidence
        elif "closed" in name or name == "other":
            found, least = "CLOSED", self.cfg.closed_confidence
        else:
            return None
        return found if c >= least else None

    def feed(self, name: str | None, c: float) -> str | None:
        """DOOR_OPEN at the first opening, else None."""
        k = self.kind(name, c)
        self.streak = {k: self.streak.get(k, 0) + 1} if k else {s: max(0, n - 1) for s, n in self.streak.items()}
        for target, least in self.follow[self.state]:
            if self.streak.get(target, 0) >= least:
                self.state = target
                if target == "OPEN" and not self.opened:
                    self.opened = True
                    return "DOOR_OPEN"
                break
        return None


def streak_states(df: DataFrame, group: Names, order: str | Names, label: str, confidence: str, cfg: StreakConfig = StreakConfig()) -> DataFrame:
    """``(group, order, state, event)``: the state after each row, and DOOR_OPEN at the first opening; see ``Streaks``."""
    order = [order] if isinstance(order, str) else order

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        door = Streaks(cfg)
        for name, c, *at in rows:
            event = door.feed(name, c)
            yield *at, door.state, event

    return _fold(df, group, order, [label, confidence, *order], {o: _kind(df, o) for o in order} | {"state": "string", "event": "string"}, work)


@dataclass(frozen=True)
class HysteresisConfig:
    min_challenge: float = 0.50
    min_switch: float = 0.75
    min_duration: float = 1.0
    persistence: int = 3


class Hysteresis:
    """The label in force: a challenger takes over only with agreement, confidence and persistence; what it needed is relabelled then.

    A mixed challenge stays open until the stable label resumes. Feed ``(label, duration, confidence, tag)``; each call returns the rows that are
    settled by it, as ``(tag, stable, held)``.
    """

    def __init__(self, cfg: HysteresisConfig = HysteresisConfig(), stable: str | None = None, pending: list | None = None):
        self.cfg, self.stable, self.pending = cfg, stable, pending or []

    def _accepts(self) -> bool:
        labels = {p[0] for p in self.pending}
        confidences = [p[2] for p in self.pending]
        if len(labels) != 1 or min(confidences) < self.cfg.min_challenge or sum(confidences) / len(confidences) < self.cfg.min_switch:
            return False
        return sum(p[1] for p in self.pending) >= self.cfg.min_duration or len(self.pending) >= self.cfg.persistence

    def _settle(self) -> list[tuple]:
        out = [(p[3], self.stable, p[0] != self.stable) for p in self.pending]
        self.pending = []
        return out

    def feed(self, label: str, duration: float, confidence: float, tag: object) -> list[tuple]:
        if self.stable is None:
            self.stable = label
        if label == self.stable:
            return [*self._settle(), (tag, self.stable, False)]
        self.pending.append((label, duration, confidence, tag))
        if self._accepts():
            self.stable = self.pending[0][0]
            return self._settle()
        return []

    def finish(self) -> list[tuple]:
        if self.pending and self._accepts():
            self.stable = self.pending[0][0]
        return self._settle()


def hysteresis(df: DataFrame, group: Names, order: str | Names, label: str, duration: str, confidence: str, cfg: HysteresisConfig = HysteresisConfig()) -> DataFrame:
    """``(group, order, raw_label, stable_label, held)`` for every row."""
    order = [order] if isinstance(order, str) else order

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        state = Hysteresis(cfg)
        for l, d, c, *at in rows:
            for (at_, raw), stable, held in state.feed(l, float(d), float(c), (at, l)):
                yield *at_, raw, stable, held
        for (at_, raw), stable, held in state.finish():
            yield *at_, raw, stable, held

    return _fold(df, group, order, [label, duration, confidence, *order], {o: _kind(df, o) for o in order} | {"raw_label": "string", "stable_label": "string", "held": "boolean"}, work)


def running_mean_clusters(df: DataFrame, group: Names, order: Names, time: str, key: str, spread: float) -> DataFrame:
    """Sweep clusters ``(group, key, cluster)``: a row joins the current cluster within ``spread`` of its running mean, else opens the next."""

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        k, total, n = 0, 0.0, 0
        for id_, t in rows:
            if n and abs(t - total / n) <= spread:
                total, n = total + t, n + 1
            else:
                k, total, n = k + 1, float(t), 1
            yield id_, k

    return _fold(df, group, order, [key, time], {key: _kind(df, key), "cluster": "bigint"}, work)


def min_separation(df: DataFrame, group: Names, key: str, time: str, x: str, hits: str, confidence: str, least: float, near: float) -> DataFrame:
    """``(group, key, kept)``: against the last kept row, one closer than ``least`` in time and ``near`` in place loses to the better evidenced."""

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        last = None
        for row in rows:
            if last and row[1] - last[1] < least and abs(row[2] - last[2]) <= near:
                lost = row
                if (last[3], last[4]) < (row[3], row[4]):
                    lost, last = last, row
                yield lost[0], False
            else:
                if last:
                    yield last[0], True
                last = row
        if last:
            yield last[0], True

    return _fold(df, group, [time, key], [key, time, x, hits, confidence], {key: _kind(df, key), "kept": "boolean"}, work)


def suppress_duplicates(df: DataFrame, group: Names, key: str, start: str, end: str, x: str, hits: str, confidence: str, least_overlap: float, near: float) -> DataFrame:
    """``(group, key, duplicate_of)``: of tracks that overlap by a share of the shorter and start near each other, the better evidenced stays.

    Each row meets the kept set in order; the first clash decides, and a better newcomer takes that place's end of the line.
    """

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        kept: list = []
        for row in rows:
            if any(k[2] < row[1] for k in kept):  # by start, so these meet no later row
                yield from ((k[0], None) for k in kept if k[2] < row[1])
                kept = [k for k in kept if k[2] >= row[1]]
            for i, k in enumerate(kept):
                shared = min(row[2], k[2]) - max(row[1], k[1]) + 1
                shorter = max(1, min(row[2] - row[1], k[2] - k[1]) + 1)
                if shared > 0 and shared / shorter >= least_overlap and abs(row[3] - k[3]) <= near:
                    if (row[4], row[5]) > (k[4], k[5]):
                        yield k[0], row[0]
                        del kept[i]
                        kept.append(row)
                    else:
                        yield row[0], k[0]
                    break
            else:
                kept.append(row)
        yield from ((k[0], None) for k in kept)

    return _fold(df, group, [start, key], [key, start, end, x, hits, confidence], {key: "bigint", "duplicate_of": "bigint"}, work)


def recover(accepted: DataFrame, candidates: DataFrame, group: Names, key: str, start: str, end: str, x: str, least: float, near: float) -> DataFrame:
    """``(group, key, recovered)`` for every candidate, by start: one that clashes with an accepted track, or with one recovered before it, stays out.

    Two tracks clash that start within ``near`` of each other in place and either overlap in time or have centres less than ``least`` frames
    apart. Accepted tracks come first, whatever their place in the order.
    """

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        centre = lambda r: round((r[1] + r[2]) / 2)
        rows = list(rows)
        live = [r for r in rows if r[4]]
        for r in rows:
            if r[4]:
                continue
            clash = any(abs(a[3] - r[3]) <= near and ((a[1] <= r[2] and r[1] <= a[2]) or abs(centre(a) - centre(r)) < least) for a in live)
            if not clash:
                live.append(r)
            yield r[0], not clash

    fields = [*group, key, start, end, x]
    both = accepted.select(*fields, F.lit(True).alias("accepted")).unionByName(candidates.select(*fields, F.lit(False).alias("accepted")))
    return _fold(both, group, [start, key], [key, start, end, x, "accepted"], {key: _kind(accepted, key), "recovered": "boolean"}, work)


@dataclass(frozen=True)
class EvidenceConfig:
    stride: int = 1
    width: float = 848.0
    drift_per_frame: float = 0.045
    total_drift: float = 0.60
    min_iou: float = 0.30
    max_steps: int = 4


def group_evidence(df: DataFrame, group: Names, cfg: EvidenceConfig = EvidenceConfig()) -> DataFrame:
    """Observations ``(frame, confidence, x1, y1, x2, y2, key)`` become candidates ``(group, key, candidate)``.

    By frame, then falling confidence and x, each goes to the candidate of least cost whose last sighting is compatible: cost 0 by overlap, else the
    drift relative to the width within what the elapsed frames allow. A candidate never takes two rows of one frame.
    """

    def iou(a, b) -> float:
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        inter = max(0.0, w) * max(0.0, h)
        union = sum(max(0.0, s[2] - s[0]) * max(0.0, s[3] - s[1]) for s in (a, b)) - inter
        return inter / union if union > 0 else 0.0

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        last: dict[int, tuple] = {}  # candidates that were seen recently enough to be met again, in the order of their numbers
        number = 0
        for f, seen in groupby(rows, itemgetter(0)):
            last = {i: at for i, at in last.items() if max(1, (f - at[0]) // cfg.stride) <= cfg.max_steps}
            for _, _, *box, key in sorted(seen, key=lambda r: (-r[1], r[2], r[6])):
                best, least = None, float("inf")
                for i in last:
                    gap = f - last[i][0]
                    if gap <= 0:
                        continue
                    cost = 0.0
                    if iou(box, last[i][1]) < cfg.min_iou:
                        cost = abs((box[0] + box[2]) - (last[i][1][0] + last[i][1][2])) / 2 / cfg.width
                        if cost > min(cfg.drift_per_frame * max(1, gap), cfg.total_drift):
                            continue
                    if cost < least:
                        best, least = i, cost
                if best is None:
                    number += 1
                    best = number
                last[best] = (f, box)
                yield key, best

    return _fold(df, group, ["frame"], ["frame", "confidence", "x1", "y1", "x2", "y2", "key"], {"key": "bigint", "candidate": "bigint"}, work)


@dataclass(frozen=True)
class AlignConfig:
    gate: float = 1.0
    tolerance: float = 1.0
    missing: float = 1.0
    extra: float = 1.0
    confidence_weight: float = 0.25
    pattern_weight: float = 1.0


def pair_cost(d: float, mc: float, sc: float, cfg: AlignConfig) -> float:
    return d / max(cfg.tolerance, 1e-9) * (1 + cfg.confidence_weight * max(0.0, 1 - (mc + sc) / 2))


def align_sequences(mt: Sequence[float], mc: Sequence[float], st: Sequence[float], sc: Sequence[float], cfg: AlignConfig) -> tuple[float, list[tuple[int, int]]]:
    """Cheapest order-preserving pairing of two rising sequences. Of equal costs a missing master comes before an extra support, and that
    before a match.

    Costs are counted from that of no pair at all, so they only change inside the gate: each master visits the supports within it, and the values of
    the last master's stretch (the frontier) are all that is needed of the masters before. To the left of a stretch values stay, to the right they
    are its last one.
    """
    n, m = len(mt), len(st)
    none = cfg.missing + cfg.extra
    front, at = [0.0], 0  # values for the first ``at``, at + 1, ... supports after the masters so far
    value = lambda j: front[min(max(j - at, 0), len(front) - 1)]
    lows, steps, ends = [], [], [0.0]
    low = high = 0
    for i in range(n):
        while low < m and st[low] < mt[i] - cfg.gate:
            low += 1
        high = max(high, low)
        while high < m and st[high] <= mt[i] + cfg.gate:
            high += 1
        row, ops = [value(low)], bytearray()
        for j in range(low, high):
            best, op = value(j + 1), 0
            if row[-1] < best:
                best, op = row[-1], 1
            matched = value(j) + pair_cost(abs(mt[i] - st[j]), mc[i], sc[j], cfg) - none
            if matched < best:
                best, op = matched, 2
            row.append(best)
            ops.append(op)
        front, at = row, low
        lows.append(low)
        steps.append(ops)
        ends.append(row[-1])
    pairs, i, j = [], n, m
    while i and j:
        low, ops = lows[i - 1], steps[i - 1]
        if j > low + len(ops):  # beyond the stretch both values are the last ones of their masters
            op = 0 if ends[i - 1] == ends[i] else 1
        else:
            op = ops[j - 1 - low] if j > low else 0
        if op == 2:
            pairs.append((i - 1, j - 1))
        i, j = i - (op != 1), j - (op != 0)
    return float(n * cfg.missing + m * cfg.extra + ends[n]), pairs[::-1]


def _aligned(rows: Iterator[tuple], cfg: AlignConfig) -> Iterator[tuple[float, list[tuple], list[tuple], list[tuple[int, int]]]]:
    """``(cost, masters, supports, pairs)`` of each stretch of rows ``(time, side, ...)``, in order of time: no pair reaches over a pause longer than the gate."""

    def solved(masters: list[tuple], supports: list[tuple]) -> tuple:
        cost, pairs = align_sequences([r[0] for r in masters], [r[2] for r in masters], [r[0] for r in supports], [r[2] for r in supports], cfg)
        return cost, masters, supports, pairs

    held: dict[str, list[tuple]] = {"M": [], "S": []}
    last = None
    for row in rows:
        if last is not None and row[0] - last > cfg.gate:
            yield solved(held["M"], held["S"])
            held = {"M": [], "S": []}
        held[row[1]].append(row)
        last = row[0]
    if last is not None:
        yield solved(held["M"], held["S"])


def align(df: DataFrame, group: Names, cfg: AlignConfig = AlignConfig()) -> DataFrame:
    """Rows ``(side, time, confidence, key)``, side ``M`` or ``S``, become ``(group, op, master_key, support_key, residual)``: MATCH, MISSING, EXTRA.

    ``residual`` is the support's time less the master's. A group is solved stretch by stretch, so it may be of any length.
    """

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, masters, supports, pairs in _aligned(rows, cfg):
            used_m, used_s = {i for i, _ in pairs}, {j for _, j in pairs}
            yield from (("MATCH", masters[i][3], supports[j][3], supports[j][0] - masters[i][0]) for i, j in pairs)
            yield from (("MISSING", r[3], None, None) for i, r in enumerate(masters) if i not in used_m)
            yield from (("EXTRA", None, r[3], None) for j, r in enumerate(supports) if j not in used_s)

    kinds = {"op": "string", "master_key": "bigint", "support_key": "bigint", "residual": "double"}
    rows = df.withColumn("time", F.col("time").cast("double"))
    return _fold(rows, group, ["time", "side", "key"], ["time", "side", "confidence", "key"], kinds, work)


def curve_score(rows: Iterable[tuple], cfg: AlignConfig) -> tuple[float, int, int, int]:
    """``(score, n_match, n_missing, n_extra)`` of rows ``(at, side, confidence, time)`` in order of ``at``, the time on the common clock."""
    cost = penalty = 0.0
    n_match = n_missing = n_extra = 0
    last = None
    for part, masters, supports, pairs in _aligned(iter(rows), cfg):
        cost += part
        n_match, n_missing, n_extra = n_match + len(pairs), n_missing + len(masters) - len(pairs), n_extra + len(supports) - len(pairs)
        for i, j in pairs:
            here = masters[i][0], supports[j][3]
            if last:
                dm, ds = here[0] - last[0], here[1] - last[1]
                if dm > 0 and ds > 0:
                    penalty += abs(dm - ds) / max(dm, ds)
            last = here
    return float(cost + cfg.pattern_weight * penalty), n_match, n_missing, n_extra


def offset_curve(df: DataFrame, group: Names, offset: str, cfg: AlignConfig = AlignConfig()) -> DataFrame:
    """Score of each candidate clock offset: alignment cost plus how much the spacings of matched pairs disagree.

    ``df`` holds the rows of ``align`` once for each candidate in ``offset``, so that candidates spread over tasks. Gives ``(group, offset, score, n_match,
    n_missing, n_extra)``.
    """

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        yield curve_score(rows, cfg)

    kinds = {"score": "double", "n_match": "bigint", "n_missing": "bigint", "n_extra": "bigint"}
    shifted = df.withColumn("__at", F.col("time").cast("double") + F.when(F.col("side") == "S", F.col(offset).cast("double")).otherwise(0.0))
    return _fold(shifted, [*group, offset], ["__at", "side", "key"], ["__at", "side", "confidence", "time"], kinds, work)


def assign_optimal(cost: np.ndarray) -> list[tuple[int, int]]:
    """Least-cost one-to-one assignment by shortest augmenting paths; infinite entries are never chosen."""
    n, m = cost.shape
    if n > m:
        return sorted((j, i) for i, j in assign_optimal(cost.T))
    big = (np.max(cost[np.isfinite(cost)], initial=0.0) + 1) * (n + 1)
    c = np.where(np.isfinite(cost), cost, big)
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, way, used = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            slack = np.concatenate([[np.inf], c[match[j0] - 1] - u[match[j0]] - v[1:]])
            better = ~used & (slack < least)
            least[better], way[better] = slack[better], j0
            j1 = int(np.argmin(np.where(used, np.inf, least)))
            delta = least[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    return sorted((int(match[j]) - 1, j - 1) for j in range(1, m + 1) if match[j] and np.isfinite(cost[match[j] - 1, j - 1]))


def transport(cost: np.ndarray, supply: Sequence[int], capacity: Sequence[int]) -> list[tuple[int, int, int]]:
    """``(row, column, units)`` of the least-cost flow of as many units as can be; infinite entries are never used. With units of one this is ``assign_optimal``.

    Each row fills its cheapest columns first; what is left goes by shortest augmenting paths, as many units at once as a path can take.
    """
    n, m = cost.shape
    left, room = np.array(supply, int), np.array(capacity, int)
    if left.sum() > room.sum():
        return sorted((i, j, k) for j, i, k in transport(cost.T, capacity, supply))
    finite = np.isfinite(cost)
    if not finite.any():
        return []
    c = np.where(finite, cost, (np.max(cost[finite]) + 1) * (left.sum() + 1))
    u, v, flow = c.min(axis=1), np.zeros(m), np.zeros((n, m), int)

    def push(i: int, j: int, k: int) -> None:
        flow[i, j] += k
        left[i] -= k
        room[j] -= k

    for i in range(n):
        for j in np.flatnonzero(c[i] == u[i]):
            push(i, j, min(left[i], room[j]))
    for i in range(n):
        while left[i]:
            least, way, done = np.full(m, np.inf), np.zeros(m, int), np.zeros(m, bool)
            came, far, fresh = {i: (-1, 0.0)}, 0.0, [i]  # rows reached: by which column, and how far
            while True:
                for r in fresh:
                    slack = c[r] - u[r] - v + far
                    better = ~done & (slack < least)
                    least[better], way[better] = slack[better], r
                j = int(np.argmin(np.where(done, np.inf, least)))
                far, done[j] = least[j], True
                if room[j]:
                    break
                fresh = [r for r in np.flatnonzero(flow[:, j]).tolist() if r not in came]
                came |= {r: (j, far) for r in fresh}
            for r, (_, d) in came.items():
                u[r] += far - d
            v[done] -= far - least[done]
            path, r, k = [], int(way[j]), min(left[i], room[j])
            end = j
            while True:
                back = came[r][0]
                path.append((r, end, back))
                if back < 0:
                    break
                k = min(k, flow[r, back])
                end, r = back, int(way[back])
            for r, end, back in path:
                flow[r, end] += k
                if back >= 0:
                    flow[r, back] -= k
            left[i] -= k
            room[j] -= k
    return [(i, j, int(flow[i, j])) for i, j in np.argwhere((flow > 0) & finite).tolist()]


def track_optimal(detections: DataFrame, group: Names, gate: float = 200.0, max_missed: int = 30, min_hits: int = 3, tentative: int = 3) -> DataFrame:
    """Tracks ``(group, key, track)`` over ``(frame, x, y, key)`` by optimal assignment of each frame to the open tracks, within a gate.

    A track is tentative until ``min_hits`` hits, and then dies after ``tentative`` missed frames, a confirmed one after ``max_missed``. Detections of one place are
    alike to the assignment, and so are tracks, so it is between different places.
    """

    def placed(places: Iterable[tuple[float, float]]) -> tuple[np.ndarray, list[list[int]]]:
        """The different places, and who is at each."""
        at: dict[tuple[float, float], list[int]] = {}
        for i, place in enumerate(places):
            at.setdefault(place, []).append(i)
        return np.array(list(at), float).reshape(len(at), 2), list(at.values())

    def assigned(seen: list[tuple], open_: list[dict]) -> dict[int, int]:
        (points, mine), (places, theirs) = placed((float(x), float(y)) for _, x, y, _ in seen), placed(t["at"] for t in open_)
        cost = np.hypot(points[:, None, 0] - places[None, :, 0], points[:, None, 1] - places[None, :, 1])
        rows, columns = [iter(w) for w in mine], [iter(w) for w in theirs]
        return {next(rows[i]): next(columns[j]) for i, j, k in transport(np.where(cost > gate, np.inf, cost), [len(w) for w in mine], [len(w) for w in theirs]) for _ in range(k)}

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        open_, new = [], 0
        for f, seen in groupby(rows, itemgetter(0)):
            seen = list(seen)
            open_ = [t for t in open_ if f - t["last"] - 1 < (max_missed if t["hits"] >= min_hits else tentative)]
            chosen = assigned(seen, open_) if open_ else {}
            for i, (_, x, y, key) in enumerate(seen):
                if i in chosen:
                    t = open_[chosen[i]]
                else:
                    new += 1
                    t = {"id": new, "hits": 0}
                    open_.append(t)
                t.update(at=(float(x), float(y)), last=f, hits=t["hits"] + 1)
                yield key, t["id"]

    return _fold(detections, group, ["frame", "x", "key"], ["frame", "x", "y", "key"], {"key": "bigint", "track": "bigint"}, work)


@dataclass(frozen=True)
class MemoryConfig:
    gate: float = 200.0
    max_missed: int = 30
    revive_frames: int = 60
    min_iou: float = 0.40
    min_alike: float = 0.60
    pending_reach: float = 200.0
    pending_gap: int = 2
    sightings: int = 8


def _iou(a: Sequence[float], b: Sequence[float]) -> float:
    shared = max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    union = sum(max(0.0, s[2] - s[0]) * max(0.0, s[3] - s[1]) for s in (a, b)) - shared
    return shared / union if union > 0 else 0.0


def track_remembering(detections: DataFrame, group: Names, cfg: MemoryConfig = MemoryConfig()) -> DataFrame:
    """``(group, key, track, how)`` over ``(frame, x1, y1, x2, y2, look, key)``: tracks that come back keep their id, and new ids wait.

    Each frame is assigned optimally to the open tracks by the distance of centres, within the gate (MATCH). What is left over revives the best track that
    was closed a short while ago, if boxes overlap and looks, numbers from 0 to 1, are alike (REVIVED). Else it lengthens the nearest pending
    sighting, or begins one (PENDING, without a track); after enough sightings it opens a track (NEW).
    """

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        open_, gone, pending, new = [], [], [], 0
        for f, seen in groupby(rows, itemgetter(0)):
            seen = list(seen)
            for t in open_:
                if f - t["last"] - 1 >= cfg.max_missed:
                    gone.append(t | {"closed": t["last"] + cfg.max_missed + 1})
            open_ = [t for t in open_ if f - t["last"] - 1 < cfg.max_missed]
            gone = [t for t in gone if f - t["closed"] <= cfg.revive_frames]
            pending = [p for p in pending if f - p["last"] <= cfg.pending_gap + 1]
            centre = lambda b: ((b[0] + b[2]) / 2, (b[1] + b[3]) / 2)
            far = lambda a, b: float(np.hypot(a[0] - b[0], a[1] - b[1]))
            cost = np.array([[far(centre(r[1:5]), centre(t["box"])) for t in open_] for r in seen]).reshape(len(seen), len(open_))
            chosen = dict(assign_optimal(np.where(cost > cfg.gate, np.inf, cost))) if open_ else {}
            matched = {i: open_[j] for i, j in chosen.items()}
            for i, (_, *box, look, key) in enumerate(seen):
                t, how = matched.get(i), "MATCH"
                if t is None:
                    alike = [(0.5 * _iou(box, g["box"]) + 0.5 * (1 - abs(look - g["look"])), -k) for k, g in enumerate(gone) if _iou(box, g["box"]) >= cfg.min_iou and 1 - abs(look - g["look"]) >= cfg.min_alike]
                    if alike:
                        t, how = gone.pop(-max(alike)[1]), "REVIVED"
                        open_.append(t)
                if t is None:
                    near = [(far(centre(box), centre(p["box"])), k) for k, p in enumerate(pending) if far(centre(box), centre(p["box"])) < cfg.pending_reach]
                    p = pending.pop(min(near)[1]) if near else None
                    n = p["n"] + 1 if p and f - p["last"] <= cfg.pending_gap else 1
                    if n < cfg.sightings:
                        pending.append({"box": box, "last": f, "n": n})
                        yield key, None, "PENDING"
                        continue
                    new += 1
                    t, how = {"id": new}, "NEW"
                    open_.append(t)
                t.update(box=box, look=look, last=f)
                yield key, t["id"], how

    return _fold(detections, group, ["frame", "x1", "key"], ["frame", "x1", "y1", "x2", "y2", "look", "key"], {"key": "bigint", "track": "bigint", "how": "string"}, work)


@dataclass(frozen=True)
class SeamConfig:
    """In frames and pixels, already resolved for a camera."""

    max_seam: int
    tolerance: float = 3.5
    floor: float = 10.0
    cap: float = 300.0
    min_hits: int = 2
    reference_hits: int = 3
    reference_tracks: int = 3
    reference_window: int = 5


#: Why two fragments are not one track, in the order of the tests (fixed values).
SEAM_REASONS = ("TOO_FEW_HITS", "OVERLAP", "AGAINST_FLOW", "NOT_AHEAD", "NO_REFERENCE", "JUMP", "CAP")
_FRAGMENT = ["track_id", "start_frame", "end_frame", "x_start", "x_end", "hits", "direction"]


class _Reference:
    """Advance per frame near a place: the median over the nearest fragments that are long enough to be measured."""

    def __init__(self, rows: list[tuple], cfg: SeamConfig):
        self.cfg = cfg
        pool = [((r[1] + r[2]) / 2, k, abs(r[4] - r[3]) / (r[2] - r[1])) for k, r in enumerate(rows) if r[5] >= cfg.reference_hits and r[2] > r[1] and r[4] != r[3]]
        # Of equal distances the earlier fragment is nearer, so the list that is read backwards has them the other way round.
        self.ahead, self.back = sorted(pool), sorted(pool, key=lambda p: (p[0], -p[1]))

    def at(self, frame: float) -> float | None:
        if len(self.ahead) < self.cfg.reference_tracks:
            return None
        n, cut = self.cfg.reference_window, bisect.bisect_left(self.ahead, (frame,))
        near = self.back[max(0, cut - n) : cut] + self.ahead[cut : cut + n]
        return median(v for _, _, v in sorted((abs(c - frame), k, v) for c, k, v in near)[:n])


def _seams(rows: list[tuple], cfg: SeamConfig) -> tuple[dict[int, int], list[tuple]]:
    """For each fragment, by start, the next one of its track; and the seams that were refused, with the reason."""
    votes = sum(int(np.sign(r[6])) * r[5] for r in rows)
    flow = int(np.sign(votes)) if len(rows) >= 3 else 0
    reference, after, taken, refused = _Reference(rows, cfg), {}, set(), []

    def verdict(a: tuple, b: tuple) -> str | None:
        seam, jump = b[1] - a[2], b[3] - a[4]
        if a[5] < cfg.min_hits or b[5] < cfg.min_hits:
            return "TOO_FEW_HITS"
        if seam < 1:
            return "OVERLAP"
        if np.sign(a[6]) != flow or np.sign(b[6]) != flow:
            return "AGAINST_FLOW"
        if jump == 0 or (jump > 0) != (flow > 0):
            return "NOT_AHEAD"
        advance = reference.at((a[2] + b[1]) / 2)
        if advance is None:
            return "NO_REFERENCE"
        if abs(jump) > max(advance * seam, cfg.floor) * cfg.tolerance:
            return "JUMP"
        return "CAP" if abs(jump) > cfg.cap else None

    for i, a in enumerate(rows) if flow else ():
        for j in range(i + 1, len(rows)):
            if rows[j][1] - a[2] > cfg.max_seam:
                break  # by start, so no later one follows closely enough
            if j in taken:
                continue
            reason = verdict(a, rows[j])
            if reason is None:
                after[i] = j
                taken.add(j)
                break
            refused.append((a[0], rows[j][0], rows[j][1] - a[2], reason))
    return after, refused


def link_fragments(df: DataFrame, group: Names, cfg: SeamConfig) -> DataFrame:
    """Fragments ``(track_id, start_frame, end_frame, x_start, x_end, hits, direction)`` become chains ``(group, track_id, chain)``.

    By start, each fragment takes the first later one that follows within the seam, moves with the group's dominant direction, lies ahead, and
    is no farther than what the local advance predicts, with a tolerance and a cap; each later one is taken once.
    """

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        rows = list(rows)
        after, head = _seams(rows, cfg)[0], {}
        for i, r in enumerate(rows):
            head.setdefault(i, r[0])
            if i in after:
                head[after[i]] = head[i]
            yield r[0], head[i]

    return _fold(df, group, ["start_frame", "track_id"], _FRAGMENT, {"track_id": "bigint", "chain": "bigint"}, work)


def refused_seams(df: DataFrame, group: Names, cfg: SeamConfig) -> DataFrame:
    """``(group, track_id, other_id, seam, reason)``: pairs that ``link_fragments`` looked at and did not link."""
    return _fold(df, group, ["start_frame", "track_id"], _FRAGMENT, {"track_id": "bigint", "other_id": "bigint", "seam": "bigint", "reason": "string"}, lambda rows: _seams(list(rows), cfg)[1])
