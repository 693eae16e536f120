import random

import pytest

from trackloom.operators import graph
from trackloom.operators import joins as J


def spans(spark, data, names):
    return spark.createDataFrame(data, names)


def test_overlap_pairs_match_the_product(spark):
    r = random.Random(3)
    a = [(1, k, s, s + r.randint(1, 40)) for k, s in enumerate(r.randint(0, 300) for _ in range(40))]
    b = [(1, k, s, s + r.randint(1, 40)) for k, s in enumerate(r.randint(0, 300) for _ in range(40))]
    x = spans(spark, a, "g int, i int, a0 long, a1 long")
    y = spans(spark, b, "g int, j int, b0 long, b1 long")
    for inclusive in (False, True):
        got = sorted((p.i, p.j) for p in J.overlap_pairs(x, y, ["g"], ("a0", "a1"), ("b0", "b1"), 25, inclusive).collect())
        want = sorted((p[1], q[1]) for p in a for q in b if (p[2] <= q[3] and q[2] <= p[3] if inclusive else p[2] < q[3] and q[2] < p[3]))
        assert got == want


def test_mapping_kinds(spark):
    units = spans(spark, [(1, f"GW_{k + 1}", 4 * k, 4 * k + 4) for k in range(5)], "g int, unit_id string, unit_start long, unit_end long")
    local = [(1, "exact", 0, 4), (1, "two", 4, 12), (1, "half_a", 12, 14), (1, "half_b", 14, 16), (1, "none", 90, 95)]
    got = {r.local_id: (r.unit_id, r.kind) for r in J.overlap_mapping(spans(spark, local, "g int, local_id string, start long, end long"), units, ["g"], 4).collect()}
    assert got == {"exact": ("GW_1", "EXACT"), "two": ("GW_2", "ONE_TO_MANY"), "half_a": ("GW_4", "MANY_TO_ONE"), "half_b": ("GW_4", "MANY_TO_ONE"), "none": (None, "UNMATCHED")}


def test_every_segment_has_one_mapping_row(spark):
    units = spans(spark, [(1, "GW_1", 0, 4), (1, "GW_2", 4, 8)], "g int, unit_id string, unit_start long, unit_end long")
    local = spans(spark, [(1, f"L{k}", k, k + 2) for k in range(20)], "g int, local_id string, start long, end long")
    out = J.overlap_mapping(local, units, ["g"], 4)
    assert out.count() == 20 == out.select("local_id").distinct().count()


def test_asof_is_strict_before_and_inclusive_after(spark):
    points = spark.createDataFrame([(1, 1, 5), (1, 2, 10), (1, 3, 99)], "g int, k int, t int")
    known = spark.createDataFrame([(1, 5), (1, 10)], "g int, t int")
    got = {r.k: (r.previous, r.next) for r in J.asof_neighbours(points, known, ["g"], "t", "k").collect()}
    assert got == {1: (None, 5), 2: (5, 10), 3: (10, None)}


def test_label_falls_back_to_the_nearest_end(spark):
    spans_ = spark.createDataFrame([(1, 0, 10, "A"), (1, 20, 30, "B")], "g int, start int, end int, label string")
    points = spark.createDataFrame([(1, 1, 5), (1, 2, 13), (1, 3, 17), (1, 4, 10), (2, 5, 0)], "g int, k int, t int")
    got = {r.k: (r.label, r.how) for r in J.label_at(points, spans_, ["g"], "t", "k", 8).collect()}
    assert got == {1: ("A", "inside"), 2: ("A", "nearest"), 3: ("B", "nearest"), 4: ("A", "nearest"), 5: ("UNKNOWN", "none")}


def test_authority_merge_never_multiplies_units(spark):
    roster = spark.createDataFrame([(1,), (2,)], "u int")
    door = spark.createDataFrame([(1, "OPEN"), (1, "CLOSED")], "u int, state string")
    got = {r.u: r.door for r in J.authority_merge(roster, "u", {"door": door}).collect()}
    assert got[1].state == "CLOSED" and got[2] is None


def test_components(spark):
    pairs = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (9, 8), (7, 7), (20, 10), (20, 2)], "a long, b long")
    got = {r.node: r.root for r in graph.least_member(pairs, "a", "b").collect()}
    assert got == {2: 2, 3: 2, 4: 2, 5: 2, 10: 2, 20: 2, 8: 8, 9: 8}


def test_local_advance_takes_the_nearest_fragments(spark):
    import statistics

    r = random.Random(4)
    fragments = [(g, 100 * g + k, float(r.randint(0, 400)), float(r.randint(1, 50))) for g in (1, 2) for k in range(14)] + [(3, 301, 5.0, 2.0)]
    seams = [(g, k, float(r.randint(0, 400))) for g in (1, 2, 3) for k in range(12)]
    df = spark.createDataFrame(fragments, "g int, track_id long, center double, advance double")
    got = {(x.g, x.k): x.reference for x in J.local_advance(df, spark.createDataFrame(seams, "g int, k int, at double"), ["g"], "at", "k").collect()}
    for g, k, at in seams:
        near = sorted((abs(c - at), i, v) for h, i, c, v in fragments if h == g)[:5]
        assert got[g, k] == (statistics.median(v for _, _, v in near) if len(near) >= 3 else None)


@pytest.mark.parametrize("seed", [1, 2])
def test_company_by_pairs(spark, seed):
    rng = random.Random(seed)
    rows = [(g, k, a, a + rng.randint(0, 12), rng.random() < 0.6 or None, f"{g}{k}") for g in "AB" for k in range(60) for a in [rng.randint(0, 200)]]
    df = spark.createDataFrame(rows, "g string, k int, s int, e int, still boolean, more string")
    got = {(r.g, r.k): r for r in J.with_company(df, ["g"], "s", "e", "k", "still", "paused", 3).collect()}
    assert len(got) == len(rows)
    for g, k, s, e, still, more in rows:
        met = sum(1 for q in rows if q[0] == g and q[4] and q[2] <= e and s <= q[3])
        assert (got[g, k].paused, got[g, k].more, got[g, k].still) == (bool(still) and met >= 3, more, still)
    assert J.with_company(df.limit(0), ["g"], "s", "e", "k", "still", "paused").count() == 0


def test_segments_without_spans_stay(spark):
    local = spark.createDataFrame([("A", "x", 0, 10), ("A", "y", None, 10), ("A", "z", 50, 60), (None, "n", 0, 10)], "g string, local_id string, start int, end int")
    units = spark.createDataFrame([("A", "u", 5, 20), ("A", "v", None, 70), (None, "w", 0, 10)], "g string, unit_id string, unit_start int, unit_end int")
    got = {r.local_id: (r.unit_id, r.overlap, r.candidates, r.kind) for r in J.overlap_mapping(local, units, ["g"], 8).collect()}
    assert got == {"x": ("u", 5, 1, "EXACT"), "y": (None, None, 0, "UNMATCHED"), "z": (None, None, 0, "UNMATCHED"), "n": (None, None, 0, "UNMATCHED")}


def test_nearest_match_by_brute_force(spark):
    """Short spans on a coarse clock, many of them equal, against every pair."""
    r = random.Random(8)
    span = lambda: (s := r.randint(0, 40), s + r.choice([0, 1, 5, 12]))
    support, master = [(g, k, *span()) for g in range(3) for k in range(60)], [(g, 1000 + k, *span()) for g in range(2) for k in range(60)]

    def best(g, s0, s1):
        found = []
        for h, k, m0, m1 in master:
            iou = max(min(s1, m1) - max(s0, m0), 0) / (max(s1, m1) - min(s0, m0)) if s1 > s0 and m1 > m0 else 0.0
            dt = abs((s0 + s1) / 2 - (m0 + m1) / 2)
            if g == h and (iou >= 0.2 or dt <= 1.5):
                found.append((-max(iou, max(0.0, 1 - dt / 1.5)), m0, k))
        return (min(found)[2], -min(found)[0]) if found else (None, None)

    a, b = spans(spark, support, "g int, support_id long, s_start long, s_end long"), spans(spark, master, "g int, master_id long, m_start long, m_end long")
    got = {(x.g, x.support_id): (x.master_id, x.score) for x in J.nearest_match(a, b, ["g"], 1.5).collect()}
    assert got == {(g, k): best(g, s0, s1) for g, k, s0, s1 in support}


def test_label_at_by_brute_force(spark):
    """Nested, equal and empty spans against every span for each point."""
    r = random.Random(9)
    rows = [(g, s := r.randint(0, 60), s + r.choice([0, 1, 4, 9, 30]), r.choice("abc")) for g in range(3) for _ in range(25)] + [(0, None, 9, "n"), (0, 9, None, "n")]
    points = [(g, 100 * g + t, t) for g in range(4) for t in range(-2, 95)]

    def label(g, t):
        mine = [x[1:] for x in rows if x[0] == g]
        inside = sorted((s, e, n) for s, e, n in mine if s is not None and e is not None and s <= t < e)
        before, after = [(e, n) for _, e, n in mine if e is not None and e <= t], [(s, n) for s, _, n in mine if s is not None and s >= t]
        if inside:
            return inside[0][2], "inside"
        if not before and not after:
            return "UNKNOWN", "none"
        a, b = max(before, default=None), min(after, default=None)
        return (a if b is None or a and t - a[0] <= b[0] - t else b)[1], "nearest"

    got = {x.k: (x.label, x.how) for x in J.label_at(spans(spark, points, "g int, k long, t long"), spans(spark, rows, "g int, start long, end long, label string"), ["g"], "t", "k").collect()}
    assert got == {k: label(g, t) for g, k, t in points}
