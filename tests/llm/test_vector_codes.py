import hashlib
import math

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from trackloom.llm import vector_codes as C


def brute(data, parts=4, entries=256, rounds=4):
    """The rounds with all distances."""
    good = [(i, label, [math.floor(1024 * x) for x in v]) for i, v, label in data if v and len(v) == len(data[0][1]) and all(x is not None and np.isfinite(x) for x in v)]
    if not good:
        return []
    x = np.array([v for *_, v in good], object).reshape(len(good), parts, -1)
    order = sorted(range(len(good)), key=lambda k: (good[k][0] is None, good[k][0] or 0, good[k][2]))[:entries]
    books = [[x[k, p].tolist() for k in order] for p in range(parts)]
    far = lambda a, b: sum((int(s) - int(t)) ** 2 for s, t in zip(a, b))
    for turn in range(rounds + 1):
        code = [[min(range(len(order)), key=lambda e: (far(v[p], books[p][e]), e)) for p in range(parts)] for v in x]
        if turn < rounds:
            for p in range(parts):
                for e in range(len(order)):
                    mine = [x[k, p] for k in range(len(good)) if code[k][p] == e]
                    if mine:
                        books[p][e] = [int(sum(c)) // len(mine) for c in zip(*mine)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    error = [sum(far(v[p], books[p][c[p]]) for p in range(parts)) for v, c in zip(x, code)]
    return sorted([(i, bytes(c).hex(), e, sum(f for (_, m, _), f in zip(good, error) if m == label), digest) for (i, label, _), c, e in zip(good, code, error)], key=repr)


@pytest.mark.parametrize("start", [1, 3, 8, 64])
@pytest.mark.parametrize("kind", ["spread", "ties"])
def test_matches_all_distances(spark, monkeypatch, start, kind):
    monkeypatch.setattr(C, "START", start)
    monkeypatch.setattr(C, "ROWS", 50)
    r = np.random.default_rng(start)
    value = (lambda: r.normal(size=8)) if kind == "spread" else (lambda: r.integers(-2, 3, size=8) / 1024)  # many equal distances
    data = [(int(k), value().tolist(), [None, 1, 2][k % 3]) for k in range(150)]
    data += [(3, data[3][1], 1), (None, value().tolist(), 2), (900, None, 1), (901, [], 1), (902, [float("nan")] * 8, 1), (903, [1.0] * 4, 1), (904, [float("inf")] * 8, None)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").withColumn("code", F.lit("clash")).repartition(3)
    assert rows(C.code_report(df, entries=20)) == brute(data, entries=20)


def test_far_groups_are_decided_by_bounds(spark):
    r = np.random.default_rng(5)
    centres = r.normal(size=(12, 8)) * 50
    data = [(k, (centres[k % 12] + r.normal(size=8)).tolist(), k % 2) for k in range(400)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    assert rows(C.code_report(df, entries=12)) == brute(data, entries=12)
    entries = (centres * 1024).astype(np.int64)[:, :4]
    points = np.repeat(entries, 20, axis=0) + r.integers(-900, 900, size=(240, 4))
    state = C.PartState(240, 3)
    C.scan(points, entries, 3, state, np.arange(240))
    C.reassign(points, entries + 3, np.full(12, 6.0), 3, state)
    assert (state.depth == 0).mean() > 0.9 and (state.entry == C.distances(points, entries + 3).argmin(axis=1)).all()


def test_bounds_never_exceed_the_distances():
    r = np.random.default_rng(2)
    points, entries = r.integers(-500, 500, size=(300, 4)), r.integers(-500, 500, size=(30, 4))
    state = C.PartState(300, 4)
    C.scan(points, entries, 4, state, np.arange(300))
    for b in (4, 2, 6, 6, 3):
        after = entries + r.integers(-15, 16, size=entries.shape)
        C.reassign(points, after, np.sqrt(((after - entries) ** 2).sum(axis=1)), b, state)
        entries = after
        true = np.sqrt(C.distances(points, entries))
        assert (state.entry == true.argmin(axis=1)).all()
        listed = np.isfinite(state.low)
        assert (state.low <= np.take_along_axis(true, state.near, 1))[listed].all() and (np.diff(np.where(listed, state.low, 1e30), axis=1) >= 0).all()
        true[np.arange(300), state.entry] = np.inf
        for k in range(300):
            true[k, state.near[k][listed[k]]] = np.inf
        assert (state.outer <= true.min(axis=1)).all()


def test_large_integers_and_few_rows(spark):
    data = [(k, [60_000.0 * (-1) ** k, 0.001 * k, -3.5, 1e4], None) for k in range(5)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    assert rows(C.code_report(df)) == brute(data)
    assert rows(C.code_report(df.where("vec_id = 0"))) == brute(data[:1])
    assert C.code_report(df.limit(0)).collect() == []
    coded, books = C.encode(df.withColumn("embedding", F.slice("embedding", 1, 3)), parts=2)
    assert books.shape == (2, 5, 2) and (books[1, :, 1] == 0).all() and coded.count() == 5
    assert coded.columns == ["id", "label", "code", "error"]


def test_list_length_follows_the_readings():
    assert C._next_length(8, {0: 80, 9: 20}, 200) == 16
    assert C._next_length(8, {0: 950, 3: 45, 5: 5}, 200) == 3
    assert C._next_length(8, {0: 1000}, 200) == C.LEAST and C._next_length(8, {}, 200) == 8 and C._next_length(2, {0: 5}, 1) == 1
