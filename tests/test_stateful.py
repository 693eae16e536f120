import itertools
import random
import time

import numpy as np
import pytest

from trackloom.operators import stateful as S


def settled(labels):
    h, out = S.Hysteresis(), {}
    for k, (label, duration, confidence) in enumerate(labels):
        out.update({t: s for t, s, _ in h.feed(label, duration, confidence, k)})
    out.update({t: s for t, s, _ in h.finish()})
    return [out[k] for k in range(len(labels))]


@pytest.mark.parametrize(("labels", "stable"), [
    ([("W", 1, 0.9), ("E", 0.33, 0.62), ("W", 1, 0.9)], "WWW"),
    ([("W", 1, 0.9), ("E", 0.4, 0.9), ("E", 0.4, 0.9), ("E", 0.4, 0.9)], "WEEE"),
    ([("W", 1, 0.9), ("E", 2, 0.9), ("W", 1, 0.9)], "WEW"[:2] + "W"),
    ([("W", 1, 0.9), ("E", 0.1, 0.3), ("B", 2, 0.9), ("B", 2, 0.9), ("B", 2, 0.9)], "WWWWW"),
    ([("W", 1, 0.9), ("E", 0.1, 0.9), ("E", 0.1, 0.9)], "WWW"),
])
def test_hysteresis(labels, stable):
    got = settled(labels)
    if labels[1] == ("E", 2, 0.9):
        # One long confident observation takes over; the way back is a challenge too, of one second.
        assert got == ["W", "E", "W"]
    else:
        assert "".join(got) == stable


def test_optimal_assignment_is_the_cheapest():
    r = np.random.default_rng(1)
    for n, m in [(1, 1), (2, 4), (4, 3), (5, 5)]:
        for _ in range(20):
            cost = r.integers(1, 30, (n, m)).astype(float)
            pairs = S.assign_optimal(cost)
            small, large = min(n, m), max(n, m)
            c = cost if n <= m else cost.T
            best = min(sum(c[i, p[i]] for i in range(small)) for p in itertools.permutations(range(large), small))
            assert len(pairs) == small and sum(cost[i, j] for i, j in pairs) == best


def test_gated_pairs_are_never_assigned():
    assert S.assign_optimal(np.array([[np.inf, np.inf], [1.0, np.inf]])) == [(1, 0)]


def test_alignment_is_monotone_and_complete():
    r = random.Random(5)
    for _ in range(30):
        m = np.array(sorted(r.uniform(0, 40) for _ in range(r.randint(0, 9))))
        s = np.array(sorted(r.uniform(0, 40) for _ in range(r.randint(0, 9))))
        cost, pairs = S.align_sequences(m, np.ones(len(m)), s, np.ones(len(s)), S.AlignConfig())
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))
        assert all(abs(m[i] - s[j]) <= 1 for i, j in pairs)

        def best(i, j):
            if i == len(m) or j == len(s):
                return float(len(m) - i + len(s) - j)
            d = abs(m[i] - s[j])
            return min(1 + best(i + 1, j), 1 + best(i, j + 1), (d if d <= 1 else 99) + best(i + 1, j + 1))

        assert cost == pytest.approx(best(0, 0))


def test_tracker_closes_after_misses(spark):
    rows = [(1, f, 100.0 + f, 0.9, f) for f in range(5)] + [(1, f, 104.0, 0.8, f) for f in range(40, 44)] + [(1, 2, 500.0, 0.5, 99)]
    df = spark.createDataFrame(rows, "g int, frame long, x double, confidence double, event_id long")
    got = [(r.track_id, r.start_frame, r.end_frame, r.hits) for r in S.track(df, ["g"]).orderBy("track_id").collect()]
    assert got == [(1, 0, 4, 5), (2, 40, 43, 4)]


def test_shuffled_input_gives_the_same_tracks(spark):
    r = random.Random(2)
    rows = [(k % 3, r.randint(0, 60), float(r.randint(0, 600)), 0.5, k) for k in range(150)]
    schema = "g int, frame long, x double, confidence double, event_id long"
    out = [sorted(map(tuple, S.track(spark.createDataFrame(x, schema), ["g"]).collect())) for x in (rows, r.sample(rows, len(rows)))]
    assert out[0] == out[1]


def test_duplicates_keep_the_better_track(spark):
    rows = [(1, 1, 0, 10, 50, 5, 0.5), (1, 2, 2, 12, 60, 9, 0.5), (1, 3, 3, 9, 400, 2, 0.9), (1, 4, 50, 60, 50, 1, 0.1)]
    df = spark.createDataFrame(rows, "g int, k long, s long, e long, x long, h long, c double")
    got = {r.k: r.duplicate_of for r in S.suppress_duplicates(df, ["g"], "k", "s", "e", "x", "h", "c", 0.3, 120).collect()}
    assert got == {1: 2, 2: None, 3: None, 4: None}


def test_evidence_never_joins_rows_of_one_frame(spark):
    rows = [(1, 0, 0.9, 0.0, 0.0, 50.0, 50.0, 1), (1, 0, 0.8, 2.0, 0.0, 52.0, 50.0, 2), (1, 1, 0.9, 3.0, 0.0, 53.0, 50.0, 3), (1, 9, 0.9, 3.0, 0.0, 53.0, 50.0, 4)]
    df = spark.createDataFrame(rows, "g int, frame long, confidence double, x1 double, y1 double, x2 double, y2 double, key long")
    assert {r.key: r.candidate for r in S.group_evidence(df, ["g"]).collect()} == {1: 1, 2: 2, 3: 1, 4: 3}


FRAGMENT = "g int, track_id long, start_frame long, end_frame long, x_start double, x_end double, hits long, direction double"


def test_fragments_link_forward_only(spark):
    rows = [(1, 1, 0, 5, 0.0, 50.0, 5, 1.0), (1, 2, 7, 12, 60.0, 110.0, 5, 1.0), (1, 3, 8, 12, 20.0, 70.0, 5, 1.0), (1, 4, 60, 66, 0.0, 60.0, 5, 1.0)]
    df, cfg = spark.createDataFrame(rows, FRAGMENT), S.SeamConfig(max_seam=4, floor=5.0, cap=100.0)
    assert {r.track_id: r.chain for r in S.link_fragments(df, ["g"], cfg).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    # Track 3 was looked at only after track 2 had been taken by track 1, and overlaps that.
    assert [(r.track_id, r.other_id, r.reason) for r in S.refused_seams(df, ["g"], cfg).collect()] == [(2, 3, "OVERLAP")]


def plain_seams(rows, cfg):
    """The tests of a seam one after the other, with the local advance found by looking at every fragment."""
    rows = sorted(rows, key=lambda r: (r[1], r[0]))
    flow = np.sign(sum(np.sign(r[6]) * r[5] for r in rows)) if len(rows) >= 3 else 0
    links, refused, taken = {}, [], set()
    if not flow:
        return links, refused
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if j <= i or j in taken or i in links:
                continue
            seam, jump = b[1] - a[2], b[3] - a[4]
            if seam > cfg.max_seam:
                continue
            pool = [(abs((r[1] + r[2]) / 2 - (a[2] + b[1]) / 2), k, abs(r[4] - r[3]) / (r[2] - r[1])) for k, r in enumerate(rows) if r[5] >= cfg.reference_hits and r[2] > r[1] and r[4] != r[3]]
            near = [v for _, _, v in sorted(pool)[: cfg.reference_window]]
            tests = [
                ("TOO_FEW_HITS", a[5] < cfg.min_hits or b[5] < cfg.min_hits), ("OVERLAP", seam < 1), ("AGAINST_FLOW", np.sign(a[6]) != flow or np.sign(b[6]) != flow), ("NOT_AHEAD", jump * flow <= 0),
                ("NO_REFERENCE", len(pool) < cfg.reference_tracks), ("JUMP", len(pool) >= cfg.reference_tracks and abs(jump) > max(np.median(near) * seam, cfg.floor) * cfg.tolerance), ("CAP", abs(jump) > cfg.cap),
            ]
            why = next((name for name, failed in tests if failed), None)
            if why:
                refused.append((a[0], b[0], seam, why))
            else:
                links[i] = j
                taken.add(j)
    return {rows[i][0]: rows[j][0] for i, j in links.items()}, refused


def test_seams_by_brute_force(spark):
    """Random fragments against the plain version: the same links, and every refusal with its reason."""
    r, cfg, seen = random.Random(3), S.SeamConfig(max_seam=12, tolerance=2.0, floor=3.0, cap=15.0), set()
    groups, data = {}, []
    for g in range(60):
        rows = []
        for k in range(r.randint(0, 14)):
            start, size = r.randint(0, 60), r.randint(0, 8)
            x, step = float(r.randint(0, 60)), r.choice([-2, 0, 1, 2, 3])
            rows.append((k, start, start + size, x, x + step * size, r.randint(1, 6), float(np.sign(step))))
        groups[g] = plain_seams(rows, cfg)
        data += [(g, *row) for row in rows]
    df = spark.createDataFrame(data, FRAGMENT)
    chains = {(x.g, x.track_id): x.chain for x in S.link_fragments(df, ["g"], cfg).collect()}
    got = sorted((x.g, x.track_id, x.other_id, x.seam, x.reason) for x in S.refused_seams(df, ["g"], cfg).collect())
    assert got == sorted((g, *row) for g, (_, refused) in groups.items() for row in refused)
    seen = {x[4] for x in got}
    assert seen == set(S.SEAM_REASONS)
    for g, (links, _) in groups.items():
        head = {}
        for row in sorted((d[1:] for d in data if d[0] == g), key=lambda d: (d[1], d[0])):
            head.setdefault(row[0], row[0])
            if row[0] in links:
                head[links[row[0]]] = head[row[0]]
        assert {t: c for (k, t), c in chains.items() if k == g} == head


def test_offset_curve_by_brute_force(spark):
    """Cost and penalty of each offset from an alignment over all monotone pairings."""
    r, cfg, want, data = random.Random(9), S.AlignConfig(), {}, []
    for g in range(12):
        m, s = (sorted(round(r.uniform(0, 8), 2) for _ in range(r.randint(0, 4))) for _ in range(2))
        for offset in (-1, 0, 1):
            data += [(g, "M", t, 0.5, 10 + k, offset) for k, t in enumerate(m)] + [(g, "S", t, 0.5, 20 + k, offset) for k, t in enumerate(s)]
            best = None
            for n in range(min(len(m), len(s)) + 1):
                for i in itertools.combinations(range(len(m)), n):
                    for j in itertools.combinations(range(len(s)), n):
                        d = [abs(m[a] - s[b] - offset) for a, b in zip(i, j)]
                        if all(x <= cfg.gate for x in d):
                            cost = sum(x * 1.125 for x in d) + len(m) + len(s) - 2 * n
                            best = cost if best is None else min(best, cost)
            if m or s:
                want[g, offset] = best
    df = spark.createDataFrame(data, "g int, side string, time double, confidence double, key long, offset int")
    for x in S.offset_curve(df, ["g"], "offset", cfg).collect():
        assert x.score >= want[x.g, x.offset] - 1e-9
    flat = {(x.g, x.offset): x.score for x in S.offset_curve(df, ["g"], "offset", S.AlignConfig(pattern_weight=0.0)).collect()}
    assert flat == {k: pytest.approx(v) for k, v in want.items()}


def test_optimal_tracks_by_brute_force(spark):
    """Each frame's assignment is the cheapest of all, found by trying them; lifecycles from the definition."""
    r, data, want = random.Random(4), [], {}
    for g in range(20):
        rows = sorted({(f, float(r.randint(0, 300)), float(r.randint(0, 50))) for f in range(12) for _ in range(r.choice([0, 1, 1, 2, 3]))})
        rows = [(f, x, y, 1000 * g + k) for k, (f, x, y) in enumerate(rows)]
        data += [(g, *row) for row in rows]
        open_, new = [], 0
        for f in sorted({row[0] for row in rows}):
            now = sorted((row for row in rows if row[0] == f), key=lambda row: (row[1], row[3]))
            open_ = [t for t in open_ if f - t["last"] - 1 < (5 if t["hits"] >= 2 else 3)]
            pairs = [(i, j, float(np.hypot(a[1] - t["at"][0], a[2] - t["at"][1]))) for i, a in enumerate(now) for j, t in enumerate(open_)]
            pairs = [p for p in pairs if p[2] <= 60]
            best = (0, 0.0, ())
            for n in range(len(pairs) + 1):
                for chosen in itertools.combinations(pairs, n):
                    if len({p[0] for p in chosen}) == n == len({p[1] for p in chosen}):
                        key = (-n, round(sum(p[2] for p in chosen), 9))
                        if key < best[:2] or best[2] == ():
                            best = (*key, chosen)
            match = {i: open_[j] for i, j, _ in best[2]}
            for i, a in enumerate(now):
                t = match.get(i)
                if t is None:
                    new += 1
                    t = {"id": new, "hits": 0}
                    open_.append(t)
                t.update(at=(a[1], a[2]), last=f, hits=t["hits"] + 1)
                want[a[3]] = t["id"]
    df = spark.createDataFrame(data, "g int, frame long, x double, y double, key long")
    assert {x.key: x.track for x in S.track_optimal(df, ["g"], 60.0, 5, 2).collect()} == want


def test_evidence_by_brute_force(spark):
    """Random sightings against a version that compares with every candidate."""
    r, cfg, data, want = random.Random(6), S.EvidenceConfig(), [], {}
    for g in range(25):
        rows = [(r.randint(0, 25), r.choice([0.5, 0.9]), float(x := r.randint(0, 300)), 0.0, float(x + 40), 50.0, 100 * g + k) for k in range(r.randint(0, 25))]
        data += [(g, *row) for row in rows]
        last = []
        for f, _, *box, key in sorted(rows, key=lambda row: (row[0], -row[1], row[2], row[6])):
            options = []
            for i, (pf, p) in enumerate(last):
                w = max(0.0, min(box[2], p[2]) - max(box[0], p[0])) * 50
                union = 2 * 40 * 50 - w
                cost = 0.0 if w / union >= cfg.min_iou else abs(box[0] - p[0]) / cfg.width
                allowed = cost == 0.0 and w / union >= cfg.min_iou or cost <= min(cfg.drift_per_frame * max(1, f - pf), cfg.total_drift)
                if 0 < f - pf <= cfg.max_steps and allowed:
                    options.append((cost, i))
            k = min(options)[1] if options else len(last)
            last[k : k + 1] = [(f, box)]
            want[key] = k + 1
    df = spark.createDataFrame(data, "g int, frame long, confidence double, x1 double, y1 double, x2 double, y2 double, key long")
    assert {x.key: x.candidate for x in S.group_evidence(df, ["g"], cfg).collect()} == want


def test_greedy_tracks_by_brute_force(spark):
    """The tracker against a version with the matrix form of the filter, frame by frame."""
    r, data, want = random.Random(12), [], []
    step, h = np.array([[1.0, 1.0], [0.0, 1.0]]), np.array([[1.0, 0.0]])
    cfg = S.TrackerConfig(60.0, 4, 2)
    for g in range(12):
        rows = [(r.randint(0, 20), float(r.randint(0, 200)), 0.5, 1000 * g + k) for k in range(r.randint(1, 25))]
        data += [(g, *row) for row in rows]
        tracks = []
        for f in range(21):
            for t in tracks:
                if t["open"]:
                    t["open"] = f - 1 - t["last"] < cfg.max_missed or f <= t["last"]
                    t["x"], t["p"] = step @ t["x"], step @ t["p"] @ step.T + 4 * np.eye(2)
            now = sorted((row for row in rows if row[0] == f), key=lambda row: (row[1], row[3]))
            used = set()
            for _, x, c, _ in now:
                free = [(abs(x - t["x"][0]), i) for i, t in enumerate(tracks) if t["open"] and i not in used and abs(x - t["x"][0]) <= cfg.match_distance]
                if free:
                    i = min(free)[1]
                    t = tracks[i]
                    gain = t["p"] @ h.T / (h @ t["p"] @ h.T + 9)
                    t["x"], t["p"] = t["x"] + gain[:, 0] * (x - t["x"][0]), (np.eye(2) - gain @ h) @ t["p"]
                else:
                    i = len(tracks)
                    tracks.append({"open": True, "x": np.array([x, 0.0]), "p": np.eye(2) * 100, "first": f, "hits": 0})
                used.add(i)
                tracks[i].update(last=f, hits=tracks[i]["hits"] + 1)
        want += [(g, t["first"], t["last"], t["hits"]) for t in tracks if t["hits"] >= cfg.min_hits]
    df = spark.createDataFrame(data, "g int, frame long, x double, confidence double, event_id long")
    got = [(x.g, x.start_frame, x.end_frame, x.hits) for x in S.track(df, ["g"], cfg).collect()]
    assert sorted(got) == sorted(want)


def test_recovery_protects_accepted_and_recovered_tracks(spark):
    schema = "g int, k long, s long, e long, x double"
    accepted = spark.createDataFrame([(1, 1, 50, 60, 100.0)], schema)
    rows = [(1, 10, 0, 5, 100.0), (1, 11, 4, 9, 100.0), (1, 12, 4, 9, 900.0), (1, 13, 58, 70, 150.0), (1, 14, 62, 63, 100.0), (1, 15, 90, 95, 100.0), (2, 16, 50, 60, 100.0)]
    got = {r.k: r.recovered for r in S.recover(accepted, spark.createDataFrame(rows, schema), ["g"], "k", "s", "e", "x", 10, 120).collect()}
    assert got == {10: True, 11: False, 12: True, 13: False, 14: False, 15: True, 16: True}


def test_filter_matches_the_matrix_form():
    f, x, p = S.MotionFilter(3.0), np.array([3.0, 0.0]), np.eye(2) * 100
    step, h = np.array([[1.0, 1.0], [0.0, 1.0]]), np.array([[1.0, 0.0]])
    for k, z in [(1, 5.0), (4, 12.0), (1, 14.5), (30, 70.0)]:
        f.predict(k)
        for _ in range(k):
            x, p = step @ x, step @ p @ step.T + 4 * np.eye(2)
        assert np.allclose([f.x, f.v, f.xx, f.xv, f.vv], [*x, p[0, 0], p[0, 1], p[1, 1]])
        gain = p @ h.T / (h @ p @ h.T + 9)
        x, p = x + gain[:, 0] * (z - x[0]), (np.eye(2) - gain @ h) @ p
        f.update(z)
        assert np.allclose([f.x, f.v, f.xx, f.xv, f.vv], [*x, p[0, 0], p[0, 1], p[1, 1]])


def test_streaks(spark):
    seen = ["open"] * 2 + ["weak"] + ["open"] * 2 + ["closed"] * 2 + ["damage"] + ["closed"] * 3 + ["partial_closed"] * 2 + ["open"] * 3
    rows = [(1, k, v, 0.2 if v == "weak" else 0.9) for k, v in enumerate(seen)]
    df = spark.createDataFrame(rows, "g int, t int, label string, c double")
    out = S.streak_states(df, ["g"], ["t"], "label", "c", S.StreakConfig(open_rows=3, closed_rows=2)).orderBy("t").collect()
    # Two openings, shortened by the weak row, then two more: three in a row are reached at the fifth row.
    assert [r.state for r in out[:5]] == ["UNKNOWN"] * 4 + ["OPEN"]
    assert {r.state for r in out[5:13]} == {"OPEN"}
    assert [r.event for r in out if r.event] == ["DOOR_OPEN"] and out[4].event == "DOOR_OPEN"


def test_tracks_come_back_and_new_ids_wait(spark):
    """A new id needs three sightings; a track that was closed is revived by a box in its place that looks alike, and by no other."""
    box = lambda x: (float(x), 0.0, float(x + 50), 50.0)
    rows = [(1, f, *box(100 + f), 0.5, f) for f in range(4)]  # pending twice, new, matched
    rows += [(1, 12, *box(104), 0.55, 12), (1, 13, *box(105), 0.55, 13)]  # closed at frame 7, revived at 12, matched
    rows += [(1, 30, *box(105), 0.0, 30), (1, 32, *box(600), 0.5, 32), (1, 36, *box(600), 0.5, 36), (1, 37, *box(602), 0.5, 37), (1, 38, *box(604), 0.5, 38)]
    df = spark.createDataFrame(rows, "g int, frame long, x1 double, y1 double, x2 double, y2 double, look double, key long")
    cfg = S.MemoryConfig(gate=60.0, max_missed=3, revive_frames=20, min_iou=0.4, min_alike=0.6, pending_reach=100.0, pending_gap=2, sightings=3)
    got = {r.key: (r.track, r.how) for r in S.track_remembering(df, ["g"], cfg).collect()}
    assert got == {
        0: (None, "PENDING"), 1: (None, "PENDING"), 2: (1, "NEW"), 3: (1, "MATCH"), 12: (1, "REVIVED"), 13: (1, "MATCH"),
        30: (None, "PENDING"), 32: (None, "PENDING"), 36: (None, "PENDING"), 37: (None, "PENDING"), 38: (2, "NEW"),
    }


def test_transport_is_the_assignment_of_its_units():
    """Small flows, gated in places, against the assignment of single units."""
    r = np.random.default_rng(7)
    for _ in range(300):
        n, m = r.integers(1, 6, 2)
        cost = np.where(r.random((n, m)) < 0.3, np.inf, r.integers(0, 12, (n, m)).astype(float))
        supply, capacity = r.integers(1, 5, n), r.integers(1, 5, m)
        units = np.repeat(np.repeat(cost, supply, axis=0), capacity, axis=1)
        got, want = S.transport(cost, supply, capacity), S.assign_optimal(units)
        assert all(k > 0 and np.isfinite(cost[i, j]) for i, j, k in got)
        assert all(sum(k for i, _, k in got if i == x) <= supply[x] for x in range(n)) and all(sum(k for _, j, k in got if j == x) <= capacity[x] for x in range(m))
        assert (sum(k for *_, k in got), sum(k * cost[i, j] for i, j, k in got)) == (len(want), sum(units[i, j] for i, j in want))


def test_crowded_frames_are_assigned_by_place(spark):
    """Frames of 4000 detections on 40 places: single units would need a matrix of 16 million distances for each frame."""
    df = spark.range(4 * 4000).selectExpr("1 AS g", "id DIV 4000 AS frame", "CAST(id % 40 * 7 + id DIV 4000 AS double) AS x", "0D AS y", "id AS key")
    start = time.time()
    got = S.track_optimal(df, ["g"], 60.0, 5, 2).collect()
    assert len({x.track for x in got}) == 4000 and time.time() - start < 30
