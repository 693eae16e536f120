"""Boxes to tracks: sparse optimal assignment with a composite cost, lifecycles that can be stored, and duplicates among finished tracks."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.operators.graph import NotConverged, cut_lineage
from trackloom.operators.stateful import MotionFilter, StreakConfig, Streaks, _fold, _iou, assign_optimal

Names = Sequence[str]
Box = tuple[float, float, float, float]


@dataclass(frozen=True)
class BoxConfig:
    """Distances in pixels, times in frames. ``sightings`` 1 opens a track at once, ``revive_frames`` 0 never revives one."""

    reach: float = 150.0
    distance_weight: float = 0.5
    iou_weight: float = 0.5
    context_weight: float = 0.2
    min_iou: float = 0.1
    new_iou: float = 0.05
    slow: float = 2.0
    backwards: float = 10.0
    max_cost: float = 1.0
    min_hits: int = 3
    max_missed: int = 30
    tentative: int = 3
    width: float = 848.0
    exit_margin: float = 20.0
    sightings: int = 1
    pending_gap: int = 2
    revive_frames: int = 0
    revive_iou: float = 0.40
    revive_alike: float = 0.60


def alike(a: Sequence[float] | None, b: Sequence[float] | None) -> float:
    """Correlation of two histograms from 0 to 1; 0.5 where one is missing or empty, 1 where one does not vary."""
    if not a or not b or len(a) != len(b):
        return 0.5
    x, y = np.array(a, float), np.array(b, float)
    x, y = x - x.mean(), y - y.mean()
    spread = float((x @ x) * (y @ y))
    return ((float(x @ y) / spread**0.5 if spread > 2.0**-52 else 1.0) + 1) / 2


def sparse_assignment(pairs: Iterable[tuple[int, int, float]]) -> list[tuple[int, int]]:
    """Least-cost one-to-one assignment over the given pairs, as many as can be: each connected part of their graph is solved by itself."""
    parent: dict[tuple, tuple] = {}

    def find(x: tuple) -> tuple:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    pairs = list(pairs)
    for i, j, _ in pairs:
        parent[find((0, i))] = find((1, j))
    parts = defaultdict(list)
    for pair in pairs:
        parts[find((0, pair[0]))].append(pair)
    out = []
    for part in parts.values():
        if len(part) == 1:
            out.append(part[0][:2])
            continue
        left, right = sorted({p[0] for p in part}), sorted({p[1] for p in part})
        row, column = {v: k for k, v in enumerate(left)}, {v: k for k, v in enumerate(right)}
        cost = np.full((len(left), len(right)), np.inf)
        for i, j, c in part:
            cost[row[i], column[j]] = c
        out += [(left[i], right[j]) for i, j in assign_optimal(cost)]
    return sorted(out)


class BoxTracker:
    """Open, recently closed and pending tracks of one camera; ``step`` takes a frame's boxes. The state is plain data (``dump``, ``load``)."""

    def __init__(self, cfg: BoxConfig = BoxConfig(), state: str | None = None):
        self.cfg = cfg
        held = json.loads(state) if state else {"open": [], "closed": [], "pending": [], "number": 0}
        self.open, self.closed, self.pending, self.number = held["open"], held["closed"], held["pending"], held["number"]
        for t in self.open:
            t["fx"], t["fy"] = (self._filter(v) for v in (t["fx"], t["fy"]))

    @staticmethod
    def _filter(values: list[float]) -> MotionFilter:
        f = MotionFilter(values[0])
        f.x, f.v, f.xx, f.xv, f.vv = values
        return f

    def dump(self) -> str:
        packed = lambda f: [f.x, f.v, f.xx, f.xv, f.vv]
        return json.dumps({"open": [t | {"fx": packed(t["fx"]), "fy": packed(t["fy"])} for t in self.open], "closed": self.closed, "pending": self.pending, "number": self.number})

    def _close(self, frame: int) -> Iterator[tuple]:
        """Tracks that have been away too long before this frame."""
        keep = []
        for t in self.open:
            if frame - t["last"] - 1 >= (self.cfg.max_missed if t["hits"] >= self.cfg.min_hits else self.cfg.tentative):
                yield None, t["id"], "LOST" if t["hits"] >= self.cfg.min_hits else "DROPPED"
                if self.cfg.revive_frames:
                    self.closed.append({k: t[k] for k in ("id", "hits", "box", "look", "last")} | {"closed": frame})
            else:
                keep.append(t)
        self.open = keep
        self.closed = [t for t in self.closed if frame - t["closed"] <= self.cfg.revive_frames]

    def candidates(self, boxes: list[Box], looks: list, places: list[Box]) -> tuple[list[tuple[int, int, float]], list[float]]:
        """``(track, box, cost)`` of all pairs inside the gates, and each box's greatest overlap with any track; pairs meet by a spatial hash.

        Cells are as large as the reach and the largest box, so pairs that are near or overlap lie in neighbouring cells.
        """
        cfg = self.cfg
        middle = lambda b: ((b[0] + b[2]) / 2, (b[1] + b[3]) / 2)
        side = max([cfg.reach, 1.0, *(b[2] - b[0] for b in (*boxes, *places)), *(b[3] - b[1] for b in (*boxes, *places))])
        cells = defaultdict(list)
        for i, b in enumerate(places):
            x, y = middle(b)
            cells[int(x // side), int(y // side)].append(i)
        pairs, most = [], [0.0] * len(boxes)
        for j, b in enumerate(boxes):
            x, y = middle(b)
            cx, cy = int(x // side), int(y // side)
            for i in (i for a in (-1, 0, 1) for c in (-1, 0, 1) for i in cells.get((cx + a, cy + c), ())):
                iou = _iou(places[i], b)
                most[j] = max(most[j], iou)
                px, py = middle(places[i])
                far, v = float(np.hypot(x - px, y - py)), self.open[i]["fx"].v
                back = abs(v) > cfg.slow and ((v > 0 and x - px < -cfg.backwards) or (v < 0 and x - px > cfg.backwards))
                if far > cfg.reach or iou < cfg.min_iou or back:
                    continue
                cost = cfg.distance_weight * min(far / cfg.reach, 1.0) + cfg.iou_weight * (1 - iou)
                if looks[j] is not None:
                    cost = (1 - cfg.context_weight) * cost + cfg.context_weight * (1 - alike(self.open[i]["look"], looks[j]))
                if cost < cfg.max_cost:
                    pairs.append((i, j, cost))
        return pairs, most

    def step(self, frame: int, seen: list[tuple]) -> Iterator[tuple]:
        """``(key, track, event)`` for boxes ``(key, x1, y1, x2, y2, look)``: MATCH, REVIVED, NEW, PENDING (no track yet) or NEAR (beside a track, so no
        new one); and for tracks, without a key: EXIT, LOST and DROPPED (never confirmed)."""
        cfg = self.cfg
        yield from self._close(frame)
        places = []
        for t in self.open:
            gap = frame - t["at"]
            x, y = t["fx"].predict(gap), t["fy"].predict(gap)
            t["at"] = frame
            w, h = t["box"][2] - t["box"][0], t["box"][3] - t["box"][1]
            places.append((x - w / 2, y - h / 2, x + w / 2, y + h / 2))
        boxes, looks = [tuple(map(float, s[1:5])) for s in seen], [s[5] for s in seen]
        pairs, most = self.candidates(boxes, looks, places)
        match = {j: i for i, j in sparse_assignment(pairs)}
        matched = set(match.values())
        gone = set()
        for i, t in enumerate(self.open):
            x, v = t["fx"].x, t["fx"].v
            if i not in matched and ((x > cfg.width - cfg.exit_margin and v > 0) or (x < cfg.exit_margin and v < 0)):
                gone.add(i)
                yield None, t["id"], "EXIT"
        for j, (key, *_, look) in enumerate(seen):
            if j in match:
                t = self.open[match[j]]
                self._hit(t, frame, boxes[j], look)
                yield key, t["id"], "MATCH"
            elif most[j] >= cfg.new_iou:
                yield key, None, "NEAR"
            else:
                yield (key, *self._unmatched(frame, boxes[j], look))
        self.open = [t for i, t in enumerate(self.open) if i not in gone]

    @staticmethod
    def _hit(t: dict, frame: int, box: Box, look) -> None:
        t["fx"].update((box[0] + box[2]) / 2)
        t["fy"].update((box[1] + box[3]) / 2)
        t.update(box=list(box), last=frame, hits=t["hits"] + 1, look=look if look is not None else t["look"])

    def _start(self, id_: int, hits: int, frame: int, box: Box, look) -> None:
        self.open.append({"id": id_, "hits": hits, "at": frame, "last": frame, "box": list(box), "look": look, "fx": MotionFilter((box[0] + box[2]) / 2), "fy": MotionFilter((box[1] + box[3]) / 2)})

    def _unmatched(self, frame: int, box: Box, look) -> tuple[int | None, str]:
        cfg = self.cfg
        again = [(_iou(t["box"], box), -k) for k, t in enumerate(self.closed) if _iou(t["box"], box) >= cfg.revive_iou and alike(t["look"], look) >= cfg.revive_alike]
        if again:
            t = self.closed.pop(-max(again)[1])
            self._start(t["id"], t["hits"] + 1, frame, box, look)
            return t["id"], "REVIVED"
        if cfg.sightings > 1:
            self.pending = [p for p in self.pending if frame - p["last"] <= cfg.pending_gap]
            at = ((box[0] + box[2]) / 2, (box[1] + box[3]) / 2)
            near = [(float(np.hypot(p["x"] - at[0], p["y"] - at[1])), k) for k, p in enumerate(self.pending) if p["last"] < frame]
            if near and min(near)[0] <= cfg.reach:
                p = self.pending[min(near)[1]]
                p.update(x=at[0], y=at[1], last=frame, n=p["n"] + 1)
            else:
                p = {"x": at[0], "y": at[1], "last": frame, "n": 1}
                self.pending.append(p)
            if p["n"] < cfg.sightings:
                return None, "PENDING"
            self.pending.remove(p)
        self.number += 1
        self._start(self.number, 1, frame, box, look)
        return self.number, "NEW"


def track_boxes(boxes: DataFrame, group: Names, cfg: BoxConfig = BoxConfig()) -> DataFrame:
    """``(group, frame, key, track, event)`` over ``(frame, x1, y1, x2, y2, look, key)``; see ``BoxTracker.step``. ``look`` is an array of numbers or null.

    A group's open tracks are what is held. Tracks that are open when a group ends give no closing event.
    """

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        tracker = BoxTracker(cfg)
        for f, seen in groupby(rows, itemgetter(0)):
            for key, track, event in tracker.step(f, [(r[6], *r[1:6]) for r in seen]):
                yield f, key, track, event

    kinds = {"frame": "bigint", "key": "bigint", "track": "bigint", "event": "string"}
    return _fold(boxes, group, ["frame", "key"], ["frame", "x1", "y1", "x2", "y2", "look", "key"], kinds, work)


def door_run(frames: DataFrame, group: Names, cfg: BoxConfig = BoxConfig(), streaks: StreakConfig = StreakConfig()) -> DataFrame:
    """One row a track that was confirmed: ``(group, track, first_frame, last_frame, hits, state, opened_at, evidence_key, evidence_frame, evidence_confidence,
    ended)`` over ``(step, frame, key, x1, y1, x2, y2, look, label, confidence)``.

    ``step`` counts the frames that were looked at, and is the tracker's clock; ``frame`` is the absolute frame of a step, which is what is reported. A step without
    any box has one row with a null ``key``, so that tracks age. Each track has a streak machine of its own; the evidence is its best row of the
    state that it ends in (of equal confidence the earliest), null if it was in no row. ``ended`` is EXIT, LOST or OPEN_END.
    """

    def summary(t: dict, ended: str) -> tuple:
        c, step, frame, key = t["best"].get(t["door"].state, (None, None, None, None))
        return t["id"], t["first"], t["last"], t["hits"], t["door"].state, t["opened"], key, frame, None if c is None else -c, ended

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        tracker, doors = BoxTracker(cfg), {}
        for step, seen in groupby(rows, itemgetter(0)):
            seen = list(seen)
            boxes = {r[2]: r for r in seen if r[2] is not None}
            for key, track, event in tracker.step(step, [(k, *r[3:7], r[7]) for k, r in boxes.items()]):
                if key is None:
                    if event != "LOST" or not cfg.revive_frames:  # a lost one may come back
                        t = doors.pop(track, None)
                        if t and t["hits"] >= cfg.min_hits:
                            yield summary(t, event)
                elif track is not None:
                    frame, label, confidence = boxes[key][1], *boxes[key][8:10]
                    t = doors.setdefault(track, {"id": track, "first": frame, "hits": 0, "door": Streaks(streaks), "opened": None, "best": {}})
                    if t["door"].feed(label, confidence):
                        t["opened"] = frame
                    kind = t["door"].kind(label, confidence)
                    if kind:
                        t["best"][kind] = min(t["best"].get(kind, (0.0, 0, 0, 0)), (-confidence, step, frame, key)) if kind in t["best"] else (-confidence, step, frame, key)
                    t.update(last=frame, hits=t["hits"] + 1)
            if cfg.revive_frames:
                alive = {t["id"] for t in tracker.open} | {t["id"] for t in tracker.closed}
                for track in [k for k in doors if k not in alive]:
                    t = doors.pop(track)
                    if t["hits"] >= cfg.min_hits:
                        yield summary(t, "LOST")
        for t in doors.values():
            if t["hits"] >= cfg.min_hits:
                yield summary(t, "OPEN_END")

    kinds = {"track": "bigint", "first_frame": "bigint", "last_frame": "bigint", "hits": "bigint", "state": "string", "opened_at": "bigint", "evidence_key": "bigint", "evidence_frame": "bigint", "evidence_confidence": "double", "ended": "string"}
    return _fold(frames, group, ["step", "key"], ["step", "frame", "key", "x1", "y1", "x2", "y2", "look", "label", "confidence"], kinds, work)


def suppress_alike(tracks: DataFrame, group: Names, key: str = "track_id", near: float = 100.0, least_iou: float = 0.20, max_rounds: int = 200) -> DataFrame:
    """``(group, key, kept)`` over ``(group, class, x1, y1, x2, y2, confidence, hits)``: of tracks of a class whose centres are nearer than ``near``, or whose boxes
    overlap by ``least_iou`` (of at least one square pixel), the one of more confidence, then hits, then the lesser key stays.

    The greedy choice in rounds: a track stays once no better undecided one conflicts with it, and those that conflict with it go. In each round only the
    best of a small square (whose members all conflict) can stay, so few rows of a place meet the others, whatever a place holds; pairs meet in grid
    cells that their boxes, grown by half of ``near``, cover. Null boxes conflict with nothing and stay.
    """
    on = [*group, "__class"]
    box = ["x1", "y1", "x2", "y2"]
    centre = lambda p: ((F.col(f"{p}x1") + F.col(f"{p}x2")) / 2, (F.col(f"{p}y1") + F.col(f"{p}y2")) / 2)
    rows = tracks.select(*group, F.col("class").alias("__class"), F.col(key).alias("__key"), *box, F.struct(F.col("confidence").alias("c"), F.col("hits").alias("h"), (-F.col(key)).alias("k")).alias("__rank"))
    whole = F.col("x1").isNotNull() & F.col("y1").isNotNull() & F.col("x2").isNotNull() & F.col("y2").isNotNull()
    free = rows.where(~whole)
    home = [F.floor(c / (near * 0.7)).cast("long") for c in centre("")]
    undecided = cut_lineage(rows.where(whole).withColumn("__home", F.struct(*home)))
    side = 2 * near
    cells = lambda low, high: F.sequence(F.floor((F.col(low) - near / 2) / side).cast("long"), F.floor((F.col(high) + near / 2) / side).cast("long"))

    def spread(df: DataFrame) -> DataFrame:
        return df.withColumn("__cx", F.explode(cells("x1", "x2"))).withColumn("__cy", F.explode(cells("y1", "y2")))

    def conflict(p: str, q: str):
        (ax, ay), (bx, by) = centre(p), centre(q)
        a, b = ([F.col(f"{s}{c}") for c in box] for s in (p, q))
        w, h = F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.least(a[3], b[3]) - F.greatest(a[1], b[1])
        area = lambda s: (s[2] - s[0]) * (s[3] - s[1])
        shared = w * h
        close = (ax - bx) * (ax - bx) + (ay - by) * (ay - by) < near * near
        return close | ((w > 0) & (h > 0) & (shared / F.greatest(F.lit(1.0), area(a) + area(b) - shared) >= least_iou))

    kept = []
    for _ in range(max_rounds):
        if undecided.isEmpty():
            break
        best = undecided.groupBy(*on, "__home").agg(F.max_by(F.struct("__key", *box, "__rank"), "__rank").alias("b")).select(*on, *[F.col(f"b.{c}").alias(f"b_{c}") for c in ("__key", *box, "__rank")])
        at = best.withColumnsRenamed({f"b_{c}": c for c in box})
        others = spread(undecided.drop("__home"))
        tops = spread(at).withColumnsRenamed({c: f"b_{c}" for c in box})
        met = tops.join(others, [*on, "__cx", "__cy"]).where((F.col("__rank") > F.col("b___rank")) & conflict("", "b_"))
        stays = cut_lineage(best.join(met.select(*on, "b___key").distinct(), [*on, "b___key"], "left_anti"))
        kept.append(stays.select(*group, F.col("b___key").alias(key)))
        now = spread(stays.withColumnsRenamed({f"b_{c}": c for c in box})).withColumnsRenamed({c: f"b_{c}" for c in box})
        hit = now.join(others, [*on, "__cx", "__cy"]).where((F.col("__key") == F.col("b___key")) | conflict("", "b_"))
        undecided = cut_lineage(undecided.join(hit.select(*on, "__key").distinct(), [*on, "__key"], "left_anti"))
    else:
        raise NotConverged(f"duplicates are not decided after {max_rounds} rounds")
    ids = free.select(*group, F.col("__key").alias(key))
    for part in kept:
        ids = ids.unionByName(part)
    return tracks.select(*group, key).join(ids.withColumn("kept", F.lit(True)), [*group, key], "left").select(*group, key, F.coalesce("kept", F.lit(False)).alias("kept"))


def alike_within(looks: DataFrame, key: str, x: str, y: str, look: str, reach: int, block: int = 1024) -> DataFrame:
    """``(a, b, alike)``: all pairs of rows that lie within ``reach`` of each other, the lesser key first, and how alike their looks (``look_of``) are.

    A row goes to its own cell and to the four after it, so that a pair of cells meets once. A task holds the rows of one cell and takes those that come to it block by
    block; pairs go out as they are found.
    """
    to = lambda i, j: F.struct((F.floor(F.col(x) / reach) + i).alias("cx"), (F.floor(F.col(y) / reach) + j).alias("cy"), F.lit(0 if i == j == 0 else 1).alias("away"))
    cells = F.explode(F.array(*[to(i, j) for i, j in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))]))
    rows = looks.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(key).cast("long").alias("key"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), F.col(f"{look}.c").alias("c"), F.col(f"{look}.q").alias("q"), cells.alias("to"))
    rows = rows.select("to.*", "key", "x", "y", "c", "q")

    def arrays(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """Keys, places, looks filled up with zeros, their sizes (-1 without any) and squares."""
        lists = part.column("c").to_pylist()
        size = np.array([-1 if c is None else len(c) for c in lists])
        values = np.zeros((len(lists), max(size.max(initial=0), 1)))
        for i, c in enumerate(lists):
            if c:
                values[i, : len(c)] = c
        column = lambda n: part.column(n).to_numpy(zero_copy_only=False)
        return column("key"), column("x"), column("y"), values, size, column("q").astype(float)

    def pairs(home: tuple[np.ndarray, ...], come: tuple[np.ndarray, ...], own: bool) -> Iterator[pa.RecordBatch]:
        near = (home[1][:, None] - come[1]) ** 2 + (home[2][:, None] - come[2]) ** 2 <= reach * reach
        near &= (home[0][:, None] < come[0]) if own else (home[0][:, None] != come[0])
        i, j = np.nonzero(near)
        wide = min(home[3].shape[1], come[3].shape[1])
        for at in range(0, len(i), 65_536):
            a, b = i[at : at + 65_536], j[at : at + 65_536]
            spread, same = home[5][a] * come[5][b], (home[4][a] == come[4][b]) & (home[4][a] > 0)
            with np.errstate(invalid="ignore", divide="ignore"):
                alike = np.where(spread <= 2.0**-52, 1.0, np.einsum("ij,ij->i", home[3][a, :wide], come[3][b, :wide]) / np.sqrt(spread))
            alike = np.where(same, (alike + 1) / 2, 0.5)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(home[0][a], come[0][b])), pa.array(np.maximum(home[0][a], come[0][b])), pa.array(alike)], ["a", "b", "alike"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, home = None, []
        for batch in batches:
            cx, cy, away = (batch.column(n).to_numpy() for n in ("cx", "cy", "away"))
            cuts = np.flatnonzero((np.diff(cx) != 0) | (np.diff(cy) != 0) | (np.diff(away) != 0)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(cx)]):
                if (cx[low], cy[low]) != cell:
                    cell, home = (cx[low], cy[low]), []
                for at in range(low, high, block):
                    come = arrays(batch.slice(at, min(block, high - at)))
                    for part in home:
                        # Rows of the cell itself meet those before them, in either order of their keys.
                        yield from pairs(part, come, False)
                    if not away[low]:
                        yield from pairs(come, come, True)
                        home.append(come)

    return rows.repartition("cx", "cy").sortWithinPartitions("cx", "cy", "away").mapInArrow(run, "a long, b long, alike double")
