"""Keyed streams that keep state between batches: trackers of boxes, and batches that wait for their cameras.

State is held by ``transformWithStateInPandas`` in the RocksDB store. Rows wait in a list until the watermark has passed them, so they are taken in
order of event time whatever order they come in; timers drain the lists, release what has waited long enough, and clear keys that fell silent.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from trackloom.operators.tracking import BoxConfig, BoxTracker

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_BOX = ["frame", "x1", "y1", "x2", "y2", "look", "key"]


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams that begin inside use the store that this kind of state needs; the session's own choice comes back after."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, STORE)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _millis(ts: pd.Series) -> list[int]:
    return ts.astype("datetime64[ms]").astype("int64").tolist()


class _BoxStream(StatefulProcessor):
    """A camera's tracker as a value, its waiting rows as a list, and one timer: at the oldest waiting row, else at the end of its patience."""

    def __init__(self, cfg: BoxConfig, forget: int):
        self.cfg, self.forget = cfg, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tracker = handle.getValueState("tracker", "state string, last long")
        self.waiting = handle.getListState("waiting", "at long, frame long, x1 double, y1 double, x2 double, y2 double, look array<double>, key long")

    def _timer(self, at: int) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old[0] if isinstance(old, tuple) else old)
        self.handle.registerTimer(at)

    def _drain(self, group: Any, now: int, fresh: list[tuple]) -> Iterator[pd.DataFrame]:
        """Takes all waiting rows up to the watermark, frame by frame, and sets the next timer."""
        held = [tuple(r) for r in self.waiting.get()] + fresh
        state, last = self.tracker.get() if self.tracker.exists() else (None, None)
        # A row that is older than what was taken already has come too late for its frame.
        due = sorted((r for r in held if r[0] <= now and (last is None or r[0] > last)), key=lambda r: (r[1], r[7]))
        rest = [r for r in held if r[0] > now]
        if due:
            tracker, out = BoxTracker(self.cfg, state), []
            for frame in dict.fromkeys(r[1] for r in due):
                seen = [(r[7], *r[2:6], None if r[6] is None else list(r[6])) for r in due if r[1] == frame]
                out += [(*group, frame, key, track, event) for key, track, event in tracker.step(frame, seen)]
            last = max(r[0] for r in due)
            self.tracker.update((tracker.dump(), last))
            if out:
                frame = pd.DataFrame(out, columns=["camera", "frame", "key", "track", "event"])
                yield frame.astype({"key": "Int64", "track": "Int64"})
        if rest:
            self.waiting.put(rest)
            self._timer(max(now + 1, min(r[0] for r in rest)))
        else:
            self.waiting.clear()
            self._timer(max(now + 1, (last if last is not None else now) + self.forget))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        look = lambda v: None if v is None else [float(x) for x in v]
        fresh = [(at, int(f), float(a), float(b), float(c), float(d), look(v), int(k)) for df in rows for at, (f, a, b, c, d, v, k) in zip(_millis(df["ts"]), df[_BOX].itertuples(index=False, name=None))]
        yield from self._drain(key, timerValues.getCurrentWatermarkInMs(), fresh)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        last = self.tracker.get()[1] if self.tracker.exists() else None
        if not list(self.waiting.get()) and (last is None or last + self.forget <= now):
            self.tracker.clear()
            self.waiting.clear()
        else:
            yield from self._drain(key, now, [])

    def close(self) -> None:
        pass


def box_tracks(stream: DataFrame, cfg: BoxConfig = BoxConfig(), forget: str = "1 day") -> DataFrame:
    """``(camera, frame, key, track, event)`` as ``track_boxes`` gives them, over a stream ``(camera, ts, frame, x1, y1, x2, y2, look, key)`` with a watermark.

    Frames rise with ``ts``. A frame is taken once the watermark has passed it; a row that comes for a frame taken before is late and dropped. A
    camera silent for ``forget`` gives up its tracker, and begins anew.
    """
    hold = int(pd.Timedelta(forget).total_seconds() * 1000)
    kind = stream.schema["camera"].dataType.simpleString()
    schema = f"camera {kind}, frame long, key long, track long, event string"
    return stream.groupBy("camera").transformWithStateInPandas(_BoxStream(cfg, hold), schema, "Append", "EventTime")


class _BatchStream(StatefulProcessor):
    """Cameras of a batch as a list with their first times, the deadline and whether the batch is out as a value, and a timer at the deadline."""

    def __init__(self, expected: Sequence[str], wait: int, forget: int):
        self.expected, self.wait, self.forget = list(expected), wait, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cameras = handle.getListState("cameras", "camera string, at long")
        self.status = handle.getValueState("status", "deadline long, released boolean")

    def _release(self, group: Any, arrivals: list[tuple[str, int]], deadline: int, at: int) -> pd.DataFrame:
        """The batch, and after it those that were late for it."""
        there = [c for c, t in arrivals if t <= deadline]
        rows = [(*group, "PARTIAL" if len(there) < len(self.expected) else "FULL", len(there), ",".join(c for c in self.expected if c not in there), at)]
        rows += [(*group, "LATE", 1, c, t) for c, t in arrivals if t > deadline]
        return pd.DataFrame(rows, columns=["batch_key", "kind", "cameras", "names", "at"])

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        known = dict(tuple(r) for r in self.cameras.get())
        before = set(known)
        for df in rows:
            for camera, at in zip(df["camera"], _millis(df["ts"])):
                if camera in self.expected:
                    known[camera] = min(at, known.get(camera, at))
        if not known:
            return
        deadline, released = self.status.get() if self.status.exists() else (None, False)
        arrivals = sorted(known.items(), key=lambda a: (a[1], a[0]))
        if released:
            new = [(c, t) for c, t in arrivals if c not in before]
            if new:
                yield pd.DataFrame([(*key, "LATE", 1, c, t) for c, t in new], columns=["batch_key", "kind", "cameras", "names", "at"])
        else:
            deadline = arrivals[0][1] + self.wait  # an earlier row moves it forward
            if len([c for c, t in arrivals if t <= deadline]) == len(self.expected):
                released = True
                yield self._release(key, arrivals, deadline, arrivals[-1][1])
        self.cameras.put(arrivals)
        self.status.update((deadline, released))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old[0] if isinstance(old, tuple) else old)
        self.handle.registerTimer(max(timerValues.getCurrentWatermarkInMs() + 1, deadline + (self.forget if released else 0)))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if not self.status.exists():
            return
        deadline, released = self.status.get()
        if released:
            self.cameras.clear()
            self.status.clear()
            return
        arrivals = sorted((tuple(r) for r in self.cameras.get()), key=lambda a: (a[1], a[0]))
        self.status.update((deadline, True))
        self.handle.registerTimer(max(timerValues.getCurrentWatermarkInMs() + 1, deadline + self.forget))
        yield self._release(key, arrivals, deadline, deadline)

    def close(self) -> None:
        pass


def ready_batches(stream: DataFrame, expected: Sequence[str], wait: str = "30 minutes", forget: str = "7 days") -> DataFrame:
    """``(batch_key, kind, cameras, names, at)`` over a stream ``(batch_key, camera, ts)`` with a watermark: each batch is let go once.

    FULL when all ``expected`` cameras are there, at the last one's time; PARTIAL with those that came within ``wait`` of the first, once the watermark is
    past that time, and ``names`` are the missing. A camera that comes after is told as LATE and lets nothing go again. Repeated rows of a camera count once, cameras
    that are not expected do not. A batch is forgotten ``forget`` after its deadline.
    """
    ms = lambda s: int(pd.Timedelta(s).total_seconds() * 1000)
    kind = stream.schema["batch_key"].dataType.simpleString()
    schema = f"batch_key {kind}, kind string, cameras long, names string, at long"
    rows = stream.select("batch_key", F.col("camera").cast("string").alias("camera"), "ts")
    return rows.groupBy("batch_key").transformWithStateInPandas(_BatchStream(expected, ms(wait), ms(forget)), schema, "Append", "EventTime")
