import random

import pytest

from trackloom.operators import graph as G


def roots(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def path(r, n, start=0):
    ids = list(range(start, start + n))
    r.shuffle(ids)
    return list(zip(ids, ids[1:]))


@pytest.mark.parametrize("seed", [1, 2])
def test_long_shuffled_paths_stars_and_loops(spark, seed):
    r = random.Random(seed)
    pairs = path(r, 1000) + [(5000, 5001 + k) for k in range(300)] + [(9000 - k, 8000) for k in range(50)] + [(7000, 7000)] + path(r, 37, 20_000)
    pairs += [(r.randrange(30_000, 30_400), r.randrange(30_000, 30_400)) for _ in range(250)]
    r.shuffle(pairs)
    got = {x.node: x.root for x in G.least_member(spark.createDataFrame(pairs, "p long, q long"), "p", "q").collect()}
    assert got == roots([p for p in pairs if p[0] != p[1]])


def test_no_rows_and_null_ends(spark):
    assert G.least_member(spark.createDataFrame([], "p long, q long"), "p", "q").collect() == []
    got = G.least_member(spark.createDataFrame([(1, None), (3, 2), (3, 2)], "p long, q long"), "p", "q").collect()
    assert sorted((x.node, x.root) for x in got) == [(2, 2), (3, 2)]


def test_too_few_rounds_raise(spark):
    with pytest.raises(G.NotConverged):
        G.components(spark.createDataFrame(path(random.Random(3), 300), "a long, b long"), max_rounds=2)


@pytest.mark.parametrize("pairs, rounds", [([(5, k) for k in range(6, 40)] + [(1, 2)], 0), ([(9, k) for k in range(1, 9)] + [(20, 9)], 2), ([], 0)])
def test_no_round_is_spent_on_settled_edges(spark, monkeypatch, pairs, rounds):
    """Each round takes shuffles, and each of those a thread of the driver for a while."""
    made, cut = [], G.cut_lineage
    monkeypatch.setattr(G, "cut_lineage", lambda df: made.append(df) or cut(df))
    got = {x.node: x.component for x in G.components(spark.createDataFrame(pairs, "a long, b long"), max_rounds=rounds).collect()}
    assert got == roots(pairs)
    assert len(made) <= 1 + rounds


def test_a_temporary_folder_only_for_local_masters(spark):
    class Other:
        conf = spark.conf

        class sparkContext:
            master = "spark://somewhere:7077"

    assert G.shared_root(spark, "spark-test-")
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            G.shared_root(Other, "spark-test-")
