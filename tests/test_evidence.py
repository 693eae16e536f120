import random

import pytest
from pyspark.sql import functions as F

from trackloom.operators import evidence as E
from trackloom.operators import stateful as S

M, P = "g int, key long, time double, confidence double", "g int, camera string, key long, time double, confidence double"


def full_alignment(mt, mc, st, sc, cfg):
    """The whole matrix, cell by cell; of equal costs a missing master before an extra support before a match."""
    n, m = len(mt), len(st)
    cost = [[i * cfg.missing + j * cfg.extra if not (i and j) else 0.0 for j in range(m + 1)] for i in range(n + 1)]
    step = {}
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            options = [(cost[i - 1][j] + cfg.missing, 0), (cost[i][j - 1] + cfg.extra, 1)]
            if abs(mt[i - 1] - st[j - 1]) <= cfg.gate:
                options.append((cost[i - 1][j - 1] + S.pair_cost(abs(mt[i - 1] - st[j - 1]), mc[i - 1], sc[j - 1], cfg), 2))
            cost[i][j], step[i, j] = min(options)
    pairs, i, j = [], n, m
    while i and j:
        op = step[i, j]
        if op == 2:
            pairs.append((i - 1, j - 1))
        i, j = i - (op != 1), j - (op != 0)
    return cost[n][m], pairs[::-1]


def test_the_band_gives_what_the_whole_matrix_does():
    """On quarters, so that costs are exact and ties are ties."""
    r = random.Random(2)
    for turn in range(600):
        span = r.choice([3, 12, 40])
        side = lambda: sorted(r.randrange(4 * span) / 4 for _ in range(r.randint(0, 14)))
        m, s = side(), side()
        conf = lambda x: [r.choice([0.0, 0.5, 1.0]) for _ in x]
        mc, sc = conf(m), conf(s)
        cfg = S.AlignConfig(gate=r.choice([0.5, 1.0, 4.0]), tolerance=r.choice([0.5, 2.0]), missing=r.choice([1.0, 0.5]), extra=r.choice([1.0, 0.25]))
        assert S.align_sequences(m, mc, s, sc, cfg) == full_alignment(m, mc, s, sc, cfg)
        rows = sorted([(t, "M", c, k) for k, (t, c) in enumerate(zip(m, mc))] + [(t, "S", c, k) for k, (t, c) in enumerate(zip(s, sc))], key=lambda x: (x[0], x[1], x[3]))
        parts = list(S._aligned(iter(rows), cfg))
        assert sum(p[0] for p in parts) == full_alignment(m, mc, s, sc, cfg)[0]
        assert [(a[i][3], b[j][3]) for _, a, b, pairs in parts for i, j in pairs] == full_alignment(m, mc, s, sc, cfg)[1]


def test_a_long_sequence_only_visits_the_gate():
    n = 60_000  # a whole matrix would have 3.6e9 cells
    t = [k * 0.5 for k in range(n)]
    cost, pairs = S.align_sequences(t, [1.0] * n, [x + 0.125 for x in t], [1.0] * n, S.AlignConfig())
    assert cost == n * 0.125 and pairs == [(k, k) for k in range(n)]


def test_every_camera_says_something_about_every_master(spark):
    masters = spark.createDataFrame([(1, 1, 10.0, 0.9), (1, 2, 20.0, 0.9), (1, 3, 30.0, 0.5), (1, 4, 40.0, 0.9), (2, 5, 10.0, 0.9)], M)
    supports = spark.createDataFrame([
        (1, "side", 11, 12.2, 0.7), (1, "side", 13, 32.0, 0.0), (1, "side", 14, 36.0, 0.9),  # clock ahead by 2
        (1, "top", 21, 10.0, 0.9), (1, "bad", 31, 10.0, 0.9), (2, "side", 41, 10.5, 0.9)], P)
    cameras = spark.createDataFrame([
        (1, "side", -2.0, "RESOLVED", 10.0, 0.0, 400), (1, "top", 0.0, "UNRESOLVED", 10.0, 0.0, 400), (1, "bad", 0.0, "RESOLVED", 0.0, 0.0, 400),
        (1, "none", 0.0, "RESOLVED", 10.0, 15.0, 100), (2, "side", 0.0, "REFERENCE", 10.0, 0.0, 400)], "g int, camera string, delta double, status string, fps double, t0 double, total_frames int")
    found = E.attach(masters, supports, cameras, ["g"])
    got = {(r.g, r.camera, r.master_key, r.support_key): (r.op, r.reason, None if r.residual is None else round(r.residual, 9)) for r in found.collect()}
    off, bad = ("UNAVAILABLE", "OFFSET_UNRESOLVED", None), ("UNAVAILABLE", "NO_METADATA", None)
    assert got == {
        (1, "side", 1, 11): ("MATCH", None, 0.2), (1, "side", 2, None): ("MISSING", None, None), (1, "side", 3, 13): ("MATCH", None, 0.0), (1, "side", 4, None): ("OUT_OF_RANGE", "OUT_OF_RANGE", None), (1, "side", None, 14): ("EXTRA", None, None),
        **{(1, "top", k, None): off for k in (1, 2, 3, 4)}, (1, "top", None, 21): ("EXTRA", "OFFSET_UNRESOLVED", None),
        **{(1, "bad", k, None): bad for k in (1, 2, 3, 4)}, (1, "bad", None, 31): ("EXTRA", "NO_METADATA", None),
        (1, "none", 1, None): ("OUT_OF_RANGE", "OUT_OF_RANGE", None), (1, "none", 2, None): ("MISSING", None, None), (1, "none", 3, None): ("OUT_OF_RANGE", "OUT_OF_RANGE", None), (1, "none", 4, None): ("OUT_OF_RANGE", "OUT_OF_RANGE", None),
        (2, "side", 5, 41): ("MATCH", None, 0.5),
    }
    times = {r.key: (r.n_support, round(r.weighted_time, 9)) for r in E.evidence_times(masters, supports, found, ["g"]).collect()}
    assert times == {1: (1, round(10 + 0.2 * 0.7 / 1.6, 9)), 2: (0, 20.0), 3: (1, 30.0), 4: (0, 40.0), 5: (1, 10.25)}
    assert E.attach(masters.limit(0), supports, cameras, ["g"]).where("op <> 'EXTRA'").count() == 0
    assert E.attach(masters, supports.limit(0), cameras, ["g"]).groupBy("op").count().count() == 3


CFG = E.OffsetConfig(search=6.0, step=0.25, fine_window=0.25, fine_step=0.05, first=2)


def sweep(masters, supports, cfg=CFG):
    """All offsets, one by one, then the decision."""
    mt, st = [m[1] for m in masters], [s[1] for s in supports]

    def score(delta):
        cost, pairs = full_alignment(mt, [m[2] for m in masters], [t + delta for t in st], [s[2] for s in supports], cfg.align)
        steps = [(mt[i1] - mt[i0], st[j1] - st[j0]) for (i0, j0), (i1, j1) in zip(pairs, pairs[1:])]
        return cost + cfg.align.pattern_weight * sum(abs(a - b) / max(a, b) for a, b in steps if a > 0 and b > 0), len(pairs)

    curve = sorted((round(score(k * cfg.step - cfg.search)[0], 9), abs(k * cfg.step - cfg.search), k * cfg.step - cfg.search) for k in range(int(2 * cfg.search / cfg.step) + 1))
    steps = sorted(b - a for a, b in zip(sorted(mt), sorted(mt)[1:]) if b > a)
    spacing = (steps[len(steps) // 2] + steps[(len(steps) - 1) // 2]) / 2 if steps else 0.0
    apart = max((spacing or 1.0) * 0.75, 2 * cfg.align.gate)
    rival = next((c for c in curve if abs(c[2] - curve[0][2]) >= apart), None)
    return curve[0], rival


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_offsets_equal_a_full_sweep(spark, seed):
    r = random.Random(seed)
    masters, supports, want = [], [], {}
    for g in range(25):
        m = sorted(round(r.uniform(0, 30), 2) for _ in range(r.randint(1, 8)))
        shift = r.uniform(-5, 5)
        s = sorted(round(t + shift + r.uniform(-0.3, 0.3), 2) for t in m if r.random() < 0.8) + [round(r.uniform(0, 30), 2) for _ in range(r.randint(0, 3))]
        m, s = [(k, t, r.choice([0.5, 1.0])) for k, t in enumerate(m)], [(k, t, 1.0) for k, t in enumerate(sorted(s))]
        masters += [(g, *x) for x in m]
        supports += [(g, "c", *x) for x in s]
        if s:
            want[g] = sweep(m, s)
    got = {x.g: x for x in E.estimate_offsets(spark.createDataFrame(masters, M), spark.createDataFrame(supports, P), ["g"], cfg=CFG).collect()}
    assert set(got) == set(want)
    for g, (best, rival) in want.items():
        x = got[g]
        assert x.score <= best[0] + 1e-6 and abs(x.delta - best[2]) <= CFG.fine_window + 1e-9
        assert (x.runner_up is None) == (rival is None)
        if rival:
            assert x.runner_up == pytest.approx(rival[2]) and x.margin == pytest.approx((rival[0] - x.score) / max(abs(x.score), abs(rival[0]), 1.0), abs=1e-6)


def test_decisions(spark):
    r = random.Random(3)
    uneven = [0.0, 7.0, 11.5, 19.0, 22.5, 31.0, 44.0, 48.5]
    cases = {1: (uneven, [t + 3.1 for t in uneven]), 2: ([5.0 * k for k in range(12)], [5.0 * k + 1.0 for k in range(1, 11)]), 3: (uneven, [100.0, 200.0]), 4: ([], [1.0])}
    masters = [(g, k, float(t), 1.0) for g, (m, _) in cases.items() for k, t in enumerate(m)]
    supports = [(g, "c", k, float(t), 1.0) for g, (_, s) in cases.items() for k, t in enumerate(s)]
    r.shuffle(supports)
    cfg = E.OffsetConfig(search=12.0)
    got = {x.g: x for x in E.estimate_offsets(spark.createDataFrame(masters, M), spark.createDataFrame(supports, P), ["g"], cfg=cfg).collect()}
    assert (got[1].status, got[1].n_match, round(got[1].delta, 2), got[1].usable) == ("RESOLVED", 8, -3.1 if abs(got[1].delta + 3.1) < 0.005 else round(got[1].delta, 2), got[1].delta) and abs(got[1].delta + 3.1) < 0.03
    assert got[2].status == "UNRESOLVED" and got[2].reason in ("ALIAS", "AMBIGUOUS") and got[2].usable == 0  # even spacing: a shift by one fits as well
    assert (got[3].reason, got[3].n_match) == ("TOO_FEW", 0) and (got[4].reason, got[4].delta) == ("NO_MASTERS", None)


def test_bounds_hold(spark):
    r = random.Random(8)
    masters = [(g, k, round(r.uniform(0, 20), 2), 1.0) for g in range(6) for k in range(5)]
    supports = [(g, "c", k, round(r.uniform(0, 20), 2), 1.0) for g in range(6) for k in range(5)]
    m, s = spark.createDataFrame(masters, M), spark.createDataFrame(supports, P)
    bounds = E.offset_bounds(m, s, ["g", "camera"], ["g"], CFG)
    assert bounds.count() == 6 * 49
    curve = E._score(E._sides(m, s, ["g"], "camera"), bounds, ["g", "camera"], CFG).join(bounds, ["g", "camera", "offset"])
    assert curve.count() == 6 * 49 and curve.where(F.col("score") < F.col("bound") - 1e-9).count() == 0
    assert curve.where("NOT voted AND abs(score - bound) > 1e-9").count() == 0


def test_votes_by_every_pair():
    r = random.Random(4)
    for _ in range(60):
        rows = sorted((round(r.uniform(0, 25), 1), r.choice("MS"), 1.0, k) for k in range(r.randint(1, 25)))
        steps = [{(side, k) for t, side, _, k in rows for u, other, *_ in rows if side != other and abs((u - t if side == "S" else t - u) - (n * CFG.step - CFG.search)) <= CFG.align.gate + 1e-9} for n in range(49)]
        m, s = E._votes(rows, CFG)
        assert (m, s) == tuple([sum(x[0] == side for x in found) for found in steps] for side in "MS")


def test_neither_votes_nor_candidates_are_rows(spark):
    """The search of the named query is one fold over the rows: nothing is written between, and no row is multiplied."""
    masters, supports = spark.range(0).selectExpr("1 AS g", "id AS key", "0.5D AS time", "1D AS confidence"), spark.range(0).selectExpr("1 AS g", "'c' AS camera", "id AS key", "0.5D AS time", "1D AS confidence")
    plan = E.estimate_offsets(masters, supports, ["g"], cfg=CFG)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "Generate" not in plan
