"""Evidence of looks against plain versions over random windows."""

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.operators import looks as L

LIMITS = L.LookLimits(bright=200.0, tolerance=1, persistence=0.6, uniform_texture=0.5, moving_edges=1.5, edge_strength=60.0, least_gap=4.0, widening=0.2, narrowing=-0.2, slack=0.8, dark=1.0, least_change=40.0, structured=0.7, moving_share=0.4, steady=0.95)


def windows(seed):
    """Windows of 0 to 14 looks of 18 columns: noise, and in some a steady line, a widening gap or a common light."""
    rng = np.random.default_rng(seed)
    out = {}
    for g in range(60):
        n = int(rng.integers(1, 15))
        p = rng.integers(0, 255 if g % 3 else 120, (n, 18)).astype(float)
        if g % 4 == 0:
            p[:, 5], p[:, 12] = 240, 230
        if g % 5 == 0:
            p = np.tile(p[0], (n, 1)) + rng.integers(0, 3, (n, 18))
        if g % 7 == 0:
            p += np.arange(n)[:, None] * 50
        out[g] = p
    return out


@pytest.fixture(scope="module")
def given(spark):
    data = windows(1)
    rows = [(g, i, [float(v) for v in p], 5) for g, w in data.items() for i, p in enumerate(w)]
    rows += [(0, 99, None, 5), (3, -1, [], 5), (1000, 0, None, 5), (1001, 0, [], 5)]
    df = spark.createDataFrame(rows, "g int, i int, profile array<double>, lines int")
    widths = F.array(*[L.gap_width(F.slice("profile", 1 + 6 * k, 6), LIMITS.edge_strength) for k in range(3)])
    wide = F.when(F.size("profile") > 0, widths)
    return data, df.withColumns({"texture": L.texture_of(F.col("profile")), "centre": L.centre_of(F.col("profile")), "widths": wide, "darkness": L.darkness_of(F.col("profile"))}).cache()


def texture(p):
    return p.std() / p.mean() if p.mean() >= 1e-6 else 0.0


def width(p):
    best = sorted(((v, i) for i, v in enumerate(p) if v > LIMITS.edge_strength), reverse=True)[:2]
    return float(abs(best[0][1] - best[1][1])) if len(best) == 2 else 0.0


def test_measures_of_a_row(given):
    data, df = given
    for r in df.where("size(profile) > 0").collect():
        p = data[r.g][r.i]
        assert r.texture == pytest.approx(texture(p)) and r.centre == pytest.approx(np.average(np.arange(18), weights=p))
        assert r.widths == [width(p[6 * k : 6 * k + 6]) for k in range(3)]
        assert r.darkness == pytest.approx(p[6:12].mean() / ((p[:6].mean() + p[12:].mean()) / 2))


def plain_lines(w):
    bright = [set(np.flatnonzero(p > LIMITS.bright).tolist()) for p in w]
    lines = set().union(*bright)
    still = sum(sum(any(abs(c - d) <= LIMITS.tolerance for d in b) for b in bright) / len(w) >= LIMITS.persistence for c in lines)
    ratio = still / len(lines) if lines else 0.0
    centres = [np.average(np.arange(18), weights=p) for p in w]
    moved = float(np.mean(np.abs(np.diff(centres)))) if len(w) > 1 else 0.0
    answer = (still >= 2 and ratio > 0.5) or (still >= 1 and ratio > 0.7)
    if np.mean([texture(p) for p in w]) < LIMITS.uniform_texture:
        answer = answer or still >= 1
    elif ratio < 0.8:
        answer = False
    return len(lines), still, ratio, moved, bool(answer and moved <= LIMITS.moving_edges and len(w) >= 3)


def test_reflections(given):
    data, df = given
    got = {r.g: r for r in L.reflections(df, ["g"], ["i"], "profile", "texture", "centre", LIMITS).collect()}
    assert set(got) == set(data)
    for g, w in data.items():
        lines, still, ratio, moved, answer = plain_lines(w)
        r = got[g]
        assert (r.frames, r.lines, r.still, r.reflection) == (len(w), lines, still, answer)
        assert (r.line_ratio, r.displacement) == (pytest.approx(ratio), pytest.approx(moved))
    assert {r.reflection for r in got.values()} == {True, False}


def plain_gap(w):
    each = np.array([[width(p[6 * k : 6 * k + 6]) for k in range(3)] for p in w])
    whole, x = each.mean(axis=1), np.arange(len(w), dtype=float)
    if len(w) < 3:
        return "STABLE", 0.0
    if whole.max() < LIMITS.least_gap:
        return "NO_GAP", 0.0
    slope = lambda y: np.cov(x, y)[0, 1] / np.var(x)
    b, spread = slope(whole), np.std([slope(each[:, k]) for k in range(3)])
    dark = np.mean([p[6:12].mean() / ((p[:6].mean() + p[12:].mean()) / 2) for p in w]) < LIMITS.dark
    trend = "WIDENING" if b > LIMITS.widening and spread < abs(b) + LIMITS.slack else "NARROWING" if b < LIMITS.narrowing else "STABLE"
    return ("NO_GAP" if not dark and trend != "WIDENING" else trend), b


def test_gap_evolution(given):
    data, df = given
    got = {r.g: r for r in L.gap_evolution(df, ["g"], ["i"], "widths", "darkness", LIMITS).collect()}
    assert set(got) == set(data)
    for g, w in data.items():
        trend, slope = plain_gap(w)
        assert (got[g].gap_trend, got[g].gap_slope) == (trend, pytest.approx(slope, abs=1e-9))
    assert {r.gap_trend for r in got.values()} >= {"WIDENING", "STABLE", "NO_GAP"}


def test_structured_motion(given):
    data, df = given
    got = {r.g: r for r in L.structured_motion(df.withColumn("on", F.col("i") % 3 > 0), ["g"], ["i"], "profile", "on", LIMITS).collect()}
    for g, w in data.items():
        d = [(i, np.abs(w[i] - w[i - 1])) for i in range(1, len(w))]
        changed = [(i, x) for i, x in d if x.mean() > LIMITS.least_change]
        s = sum(x.std() / (x.mean() + 1e-6) > LIMITS.structured for _, x in changed)
        a = sum(i % 3 > 0 for i, _ in changed)
        n = len(changed)
        assert (got[g].changes, got[g].motion) == (n, n >= 2 and (s / n > LIMITS.moving_share or a / n > LIMITS.directed_share))
        assert got[g].structured_ratio == pytest.approx(s / n if n else 0)
    assert {r.motion for r in got.values()} == {True, False}


def test_steadiness(given):
    data, df = given
    got = {r.g: r for r in L.steadiness(df.withColumn("f", F.transform("profile", lambda v: v / 255)), ["g"], ["i"], "f", LIMITS).collect()}
    for g, w in data.items():
        w = w / 255
        weights = LIMITS.decay ** np.arange(len(w) - 1, -1, -1.0)
        mean = np.average(w, axis=0, weights=weights)
        std = np.sqrt(np.average((w - mean) ** 2, axis=0, weights=weights).mean())
        assert got[g].steadiness == pytest.approx(0.5 if len(w) < 3 else 1 - min(1, std / (0.3 * np.sqrt(18))), abs=1e-6)
        assert got[g].drift == pytest.approx(np.mean(np.linalg.norm(np.diff(w, axis=0), axis=1)) if len(w) > 1 else 0.0)


@pytest.mark.parametrize(
    ("frames", "reflection", "trend", "motion", "steady", "decision", "adjusted"),
    [
        (7, True, "NO_GAP", False, 0.99, "NOT_READY", 0.6),
        (8, True, "NO_GAP", False, 0.99, "OVERRIDDEN", 0.25),  # all four against it
        (8, True, "NO_GAP", True, 0.5, "OVERRIDDEN", 0.6 - 0.35 * 0.6),  # a reflection without a gap
        (8, False, "NO_GAP", False, 0.5, "OVERRIDDEN", 0.6 - 0.35 * 0.5),  # neither gap nor motion
        (8, True, "WIDENING", False, 0.99, "CONFIRMED", 0.65),
        (8, False, "STABLE", True, 0.5, "CONFIRMED", 0.65),
        (8, True, "NO_GAP", False, 0.1, "CONFIRMED", 0.65),  # changing features
        (8, False, "STABLE", False, 0.5, "PASS_THROUGH", 0.6),
    ],
)
def test_verdicts(spark, frames, reflection, trend, motion, steady, decision, adjusted):
    row = spark.createDataFrame([(frames, reflection, trend, motion, steady, 0.6)], "frames int, reflection boolean, gap_trend string, motion boolean, steadiness double, confidence double")
    got = L.verify(row, "confidence").first()
    assert (got.decision, got.adjusted) == (decision, pytest.approx(adjusted))


def test_no_looks(given):
    _, df = given
    none = df.limit(0)
    assert L.reflections(none, ["g"], ["i"], "profile", "texture", "centre").count() == 0 and L.gap_evolution(none, ["g"], ["i"], "widths", "darkness").count() == 0
    assert L.structured_motion(none, ["g"], ["i"], "profile").count() == 0 and L.steadiness(none, ["g"], ["i"], "profile").count() == 0


def test_slopes_on_the_limit_are_not_beyond_it(spark):
    """Windows of whole widths whose true slope is three tenths, up or down: it is given as that, in whatever order the frames come."""
    r, rows, want = random.Random(3), [], {}
    while len(want) < 40:
        n = r.choice([9, 11])
        w = [[r.randint(0, 9) for _ in range(3)] for _ in range(n)]
        slope = sum((Fraction(i) - Fraction(n - 1, 2)) * Fraction(sum(v), 3) for i, v in enumerate(w)) / sum((Fraction(i) - Fraction(n - 1, 2)) ** 2 for i in range(n)) * Fraction(n, n - 1)
        if slope.denominator <= 160 and abs(slope) == Fraction(3, 10) or slope.denominator == 128:
            rows += [(len(want), i, [float(x) for x in v], 0.5) for i, v in enumerate(w)]
            want[len(want)] = float(slope)
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, i int, widths array<double>, darkness double").repartition(3)
    got = L.gap_evolution(df, ["g"], ["i"], "widths", "darkness", L.LookLimits(least_gap=1.0, slack=99.0)).collect()
    assert {x.g: x.gap_slope for x in got} == want
    on = {g for g, b in want.items() if abs(b) == 0.3}
    assert len(on) > 20 and {x.gap_trend for x in got if x.g in on} == {"STABLE"}
