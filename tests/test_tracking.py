import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.functions import scalars
from trackloom.operators import tracking as K
from trackloom.operators.stateful import StreakConfig, _iou, assign_optimal


def test_parts_give_the_dense_optimum():
    r = random.Random(1)
    for _ in range(200):
        n, m = r.randint(1, 7), r.randint(1, 7)
        cost = np.array([[r.random() if r.random() < 0.3 else np.inf for _ in range(m)] for _ in range(n)])
        pairs = [(i, j, cost[i, j]) for i in range(n) for j in range(m) if np.isfinite(cost[i, j])]
        got, want = K.sparse_assignment(pairs), assign_optimal(cost)
        assert len(got) == len(want) and sum(cost[i, j] for i, j in got) == pytest.approx(sum(cost[i, j] for i, j in want))
        assert len({i for i, _ in got}) == len({j for _, j in got}) == len(got)


def frames(seed, n=60, things=6, misses=0.15):
    r = random.Random(seed)
    at = [[r.uniform(0, 800), r.uniform(0, 400), r.uniform(-9, 9), r.uniform(30, 160), [r.random() for _ in range(4)]] for _ in range(things)]
    out, key = [], 0
    for f in range(n):
        seen = []
        for t in at:
            t[0] += t[2]
            if r.random() > misses and -50 < t[0] < 900:
                x, y, s = t[0] + r.gauss(0, 2), t[1] + r.gauss(0, 2), t[3] / 2
                seen.append((key, x - s, y - s, x + s, y + s, r.choice([None, t[4], []])))
                key += 1
        if seen:
            out.append((f, seen))
    return out


class Dense(K.BoxTracker):
    """All tracks with all boxes, by the definition of the cost and the gates."""

    def candidates(self, boxes, looks, places):
        c, out, most = self.cfg, [], [0.0] * len(boxes)
        for j, b in enumerate(boxes):
            for i, p in enumerate(places):
                iou = _iou(p, b)
                most[j] = max(most[j], iou)
                dx, dy = (b[0] + b[2] - p[0] - p[2]) / 2, (b[1] + b[3] - p[1] - p[3]) / 2
                far, v = float(np.hypot(dx, dy)), self.open[i]["fx"].v
                cost = c.distance_weight * min(far / c.reach, 1) + c.iou_weight * (1 - iou)
                if looks[j] is not None:
                    cost = (1 - c.context_weight) * cost + c.context_weight * (1 - K.alike(self.open[i]["look"], looks[j]))
                if far <= c.reach and iou >= c.min_iou and not (v > c.slow and dx < -10) and not (v < -c.slow and dx > 10) and cost < 1:
                    out.append((i, j, cost))
        return out, most


@pytest.mark.parametrize("cfg", [K.BoxConfig(max_missed=5), K.BoxConfig(max_missed=4, sightings=3, revive_frames=20), K.BoxConfig(reach=40.0, max_missed=8, min_hits=2)])
def test_the_hash_finds_what_all_pairs_do_and_state_can_be_stored(cfg):
    seen = set()
    for seed in range(25):
        plain, dense, stored = K.BoxTracker(cfg), Dense(cfg), None
        for f, boxes in frames(seed, misses=0.35):
            want = list(dense.step(f, boxes))
            assert list(plain.step(f, boxes)) == want
            again = K.BoxTracker(cfg, stored)
            assert list(again.step(f, boxes)) == want
            stored = again.dump()
            seen |= {e for *_, e in want}
    assert {"MATCH", "NEW", "LOST", "DROPPED", "EXIT", "NEAR"} - seen <= ({"DROPPED"} if cfg.sightings > 1 else set())
    assert cfg.sightings == 1 or {"PENDING", "REVIVED"} <= seen


def test_a_thousand_boxes_a_frame():
    r = random.Random(4)
    spots = [(r.uniform(0, 8000), r.uniform(0, 5000)) for _ in range(1000)]
    tracker = K.BoxTracker(K.BoxConfig(width=1e9))
    for f in range(3):
        boxes = [(k, x + f, y, x + f + 60, y + 60, None) for k, (x, y) in enumerate(spots)]
        begin = time.process_time()
        list(tracker.step(f, boxes))
        assert time.process_time() - begin < 1


def test_direction_and_exit():
    t = K.BoxTracker(K.BoxConfig(width=200.0, exit_margin=30.0))
    box = lambda x: [(0, x, 0.0, x + 60, 60.0, None)]
    assert [e for f, x in enumerate((0, 20, 40, 60, 80)) for *_, e in t.step(f, box(x))] == ["NEW"] + ["MATCH"] * 4
    assert [e for *_, e in t.step(5, box(60))] == ["NEAR"]  # it moves right, so a box behind it is not it
    assert [e for *_, e in t.step(8, [(0, 0.0, 300.0, 10.0, 310.0, None)])] == ["EXIT", "NEW"]


def test_as_a_table(spark):
    data = [(g, f, *b[1:5], b[5], g * 10_000 + b[0]) for g in range(3) for f, seen in frames(g) for b in seen]
    df = spark.createDataFrame(data, "g int, frame long, x1 double, y1 double, x2 double, y2 double, look array<double>, key long")
    got = sorted(map(tuple, K.track_boxes(df, ["g"]).collect()), key=repr)
    want = [(g, f, None if k is None else g * 10_000 + k, t, e) for g in range(3) for tracker in [K.BoxTracker()] for f, seen in frames(g) for k, t, e in tracker.step(f, seen)]
    assert got == sorted(want, key=repr)
    assert K.track_boxes(df.limit(0), ["g"]).collect() == []


def greedy(rows, near=100.0, least=0.2):
    kept = []
    for r in sorted(rows, key=lambda r: (-r[6], -r[7], r[1])):
        def clash(s):
            if r[8] != s[8] or None in (*r[2:6], *s[2:6]):
                return False
            if ((r[2] + r[4] - s[2] - s[4]) / 2) ** 2 + ((r[3] + r[5] - s[3] - s[5]) / 2) ** 2 < near**2:
                return True
            w, h = min(r[4], s[4]) - max(r[2], s[2]), min(r[5], s[5]) - max(r[3], s[3])
            area = lambda b: (b[4] - b[2]) * (b[5] - b[3])
            return w > 0 and h > 0 and w * h / max(1.0, area(r) + area(s) - w * h) >= least

        if not any(clash(s) for s in kept if s[0] == r[0]):
            kept.append(r)
    return {(r[0], r[1]) for r in kept}


def test_duplicates_equal_the_sequential_choice(spark):
    r, data = random.Random(7), []
    for g in range(5):
        for k in range(90):
            x, y, w, h = r.uniform(0, 848), r.uniform(0, 480), r.choice([5, 60, 400]), r.choice([5, 60, 300])
            data.append((g, k, x, y, x + w, y + h, r.choice([0.5, 0.7, 0.9]), r.randint(1, 4), r.choice("ab")))
    data += [(9, k, 60.0 * k, 0.0, 60.0 * k + 10, 10.0, 0.5 + k / 100, 1, "a") for k in range(12)]  # a chain: each better than the one before
    data += [(8, k, 1.0, 1.0, 2.0, 2.0, 0.5, 1, "a") for k in range(40)] + [(8, 99, None, 0.0, 1.0, 1.0, 0.1, 1, "a")]
    df = spark.createDataFrame(data, "g int, track_id long, x1 double, y1 double, x2 double, y2 double, confidence double, hits int, class string").withColumn("kept", F.lit("clash"))
    found = K.suppress_alike(df, ["g"]).collect()
    assert len(found) == len(data) and {(r.g, r.track_id) for r in found if r.kept} == greedy(data)
    assert K.suppress_alike(df.limit(0), ["g"]).collect() == []


def test_alike():
    assert K.alike(None, [1.0]) == K.alike([], []) == K.alike([1.0], [1.0, 2.0]) == 0.5
    assert K.alike([1.0, 1.0], [2.0, 5.0]) == 1.0 and K.alike([1.0, 2.0], [2.0, 4.0]) == 1.0 and K.alike([1.0, 2.0], [2.0, 1.0]) == 0.0


def test_alike_as_a_column(spark):
    r = random.Random(5)
    some = [None, [], [1.0], [1.0, 1.0], [2.0, 5.0], [2.0, 4.0], [4.0, 2.0], *[[r.gauss(0, 1) for _ in range(8)] for _ in range(4)], [1e6 + r.random() for _ in range(8)]]
    data = [(a, b) for a in some for b in some]
    df = spark.createDataFrame(data, "a array<double>, b array<float>").select("a", "b", scalars.alike(F.col("a"), F.col("b")).alias("c"))
    for x in df.collect():
        assert x.c == pytest.approx(K.alike(x.a, x.b), abs=1e-6)


@pytest.mark.parametrize("cfg", [K.BoxConfig(max_missed=5, min_hits=2), K.BoxConfig(max_missed=4, min_hits=2, revive_frames=20, sightings=2)])
def test_door_runs_from_the_whole_history(spark, cfg):
    """Each door's rows are gathered first; its state, its first opening and its evidence follow from them by definition."""
    streaks = StreakConfig(0.4, 0.4, 2, 2)
    r, data, want = random.Random(6), [], []
    for g in range(4):
        seen, tracker, doors, ended = dict(frames(g, 50, misses=0.4)), K.BoxTracker(cfg), {}, {}
        for step in range(50):
            boxes = [(*b, r.choice(["open", "closed", "partial", "damage", "other", "x"]), round(r.random(), 2)) for b in seen.get(step, [])]
            data += [(g, step, step * 3 + 100, *b) for b in boxes] or [(g, step, step * 3 + 100, *[None] * 8)]
            rows = {b[0]: b for b in boxes}
            for key, track, event in tracker.step(step, [b[:6] for b in boxes]):
                if key is None:
                    ended[track] = event
                elif track is not None:
                    ended.pop(track, None)
                    doors.setdefault(track, []).append((step * 3 + 100, key, *rows[key][6:8]))
        for track, history in doors.items():
            if len(history) < 2:
                continue
            kinds = [{"open": "OPEN", "closed": "CLOSED", "other": "CLOSED", "partial": "PARTIAL_CLOSED", "damage": "DAMAGE"}.get(n) if c >= 0.4 else None for _, _, n, c in history]
            state, opened = "UNKNOWN", None
            for n in range(1, len(kinds) + 1):
                streak = {}
                for k in kinds[:n]:
                    streak = {k: streak.get(k, 0) + 1} if k else {s: max(0, v - 1) for s, v in streak.items()}
                need = {"UNKNOWN": [("OPEN", 2), ("PARTIAL_CLOSED", 2), ("CLOSED", 2)], "CLOSED": [("OPEN", 2), ("PARTIAL_CLOSED", 2)], "PARTIAL_CLOSED": [("OPEN", 2), ("CLOSED", 2)], "OPEN": [("CLOSED", 4), ("PARTIAL_CLOSED", 4)]}[state]
                state = next((s for s, least in need if streak.get(s, 0) >= least), state)
                if state == "OPEN" and opened is None:
                    opened = history[n - 1][0]
            mine = [(-c, f, k) for (f, k, _, c), kind in zip(history, kinds) if kind == state]
            c, f, k = min(mine) if mine else (None, None, None)
            want.append((g, track, history[0][0], history[-1][0], len(history), state, opened, k, f, None if c is None else -c, ended.get(track, "OPEN_END")))
    df = spark.createDataFrame(data, "g int, step long, frame long, key long, x1 double, y1 double, x2 double, y2 double, look array<double>, label string, confidence double")
    got = [tuple(x) for x in K.door_run(df, ["g"], cfg, streaks).collect()]
    # With revival a lost track that is still remembered when the rows end may be told as lost or as open.
    told = lambda rows: sorted((row[:-1] if cfg.revive_frames else row for row in rows), key=repr)
    assert told(got) == told(want) and len(want) > 20 and {"OPEN", "CLOSED"} <= {w[5] for w in want}
    assert K.door_run(df.limit(0), ["g"], cfg, streaks).collect() == []


def test_alike_within_by_every_pair(spark):
    """Crowded places, looks of several sizes, flat, empty, missing and with what is no number, in blocks of seven, against every pair."""
    r = random.Random(11)
    look = lambda: r.choice([None, [], [1.0, 1.0, 1.0], [1.0, float("nan"), 2.0], [r.random() for _ in range(3)], [r.random() for _ in range(5)]])
    rows = [(k, r.randint(-60, 60), r.randint(-60, 60), look()) for k in range(150)] + [(900, None, 3, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "id long, x long, y long, e array<double>").withColumn("look", scalars.look_of(F.col("e")))
    got = {(p.a, p.b): p.alike for p in K.alike_within(df, "id", "x", "y", "look", 30, block=7).collect()}
    near = [(a, b) for a in rows[:150] for b in rows[:150] if a[0] < b[0] and (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 <= 900]
    assert set(got) == {(a[0], b[0]) for a, b in near} and len(near) > 1000
    sides = spark.createDataFrame([(a[0], b[0], a[3], b[3]) for a, b in near], "a long, b long, ea array<double>, eb array<double>")
    want = {(p.a, p.b): p.alike for p in sides.select("a", "b", scalars.alike(F.col("ea"), F.col("eb")).alias("alike")).collect()}
    assert all(got[k] == pytest.approx(v, nan_ok=True) for k, v in want.items())
