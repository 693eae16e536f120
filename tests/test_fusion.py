import random

import pytest
from pyspark.sql import functions as F

from trackloom.operators import fusion as U


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_places_in_two_levels(spark, width):
    r = random.Random(width)
    data = [(g, k, r.randrange(60)) for g in range(4) for k in range(r.randint(0, 80))]
    got = U.ranked(spark.createDataFrame(data, "g int, k int, f int").repartition(5), ["g"], "f", ["k"], "place", width).collect()
    for g in range(4):
        order = sorted((f, k) for h, k, f in data if h == g)
        assert {(x.f, x.k): x.place for x in got if x.g == g} == {v: n for n, v in enumerate(order, 1)}


def test_clusters_go_in_by_frame_with_negative_ids(spark):
    masters = spark.createDataFrame([(1, 11, 100), (1, 12, 300), (1, 13, None), (2, 21, 5)], "g int, key int, frame long")
    clusters = spark.createDataFrame([(1, 7, 300), (1, 3, 250), (1, 9, 50), (3, 1, 40)], "g int, cluster long, frame long")
    got = sorted(map(tuple, U.insert_boundaries(masters, clusters, ["g"], 100).collect()))
    assert got == [(1, 1, -1, "fused", 50), (1, 2, 11, "master", 100), (1, 3, -2, "fused", 250), (1, 4, -3, "fused", 300), (1, 5, 12, "master", 300), (2, 1, 21, "master", 5), (3, 1, -1, "fused", 40)]


def plain(cuts, labels, total):
    """Units by looking at all boundaries and all labels each time."""
    cuts = [(min(max(f, 0), total - 1), n, k, s) for n, k, s, f in cuts]
    cuts.sort()
    edges = [0] + sorted({c[0] for c in cuts if c[0] > 0})
    labels = sorted(labels)
    for n, start in enumerate(edges, 1):
        end = (edges[n] if n < len(edges) else total) - 1
        middle = (start + end) // 2
        inside = [x for x in labels if x[0] <= middle <= x[1]]
        near = min(labels, key=lambda x: min(abs(x[0] - middle), abs(x[1] - middle)), default=None)
        label, how = (inside[0][2], "inside") if inside else (near[2], "nearest") if near else ("UNKNOWN", "none")
        lead = [c for c in cuts if c[0] <= start]
        trail = [c for c in cuts if c[0] > end]
        yield (n, start, end, label, how, *(lead[-1][2:] if lead else (None, None)), *(trail[0][2:] if trail else (None, None)))


def test_units_from_their_definition(spark):
    r = random.Random(4)
    cuts, labels, spans, want = [], [], [], []
    for g in range(120):
        total = r.choice([1, 20, 100])
        mine = [(n, r.choice([-n, n]), r.choice(["master", "fused"]), f) for n, f in enumerate(sorted(r.randint(-5, total + 5) for _ in range(r.randint(0, 9))), 1)]
        # Labels do not nest, so that the nearest end is the nearest span.
        starts = sorted(r.randint(-10, total + 10) for _ in range(r.randint(0, 6)))
        named = [(s, s + r.randint(0, 15), f"{s}-{k}") for k, s in enumerate(starts)]
        named = [x for k, x in enumerate(named) if k == 0 or x[1] >= max(y[1] for y in named[:k])]
        cuts += [(g, *x) for x in mine]
        labels += [(g, *x) for x in named]
        spans.append((g, total))
        want += [(g, *u) for u in plain(mine, named, total)]
    c = spark.createDataFrame(cuts, "g int, number long, key long, source string, frame long").withColumn("unit", F.lit("clash"))
    n = spark.createDataFrame(labels, "g int, start long, end long, label string")
    s = spark.createDataFrame([*spans, (999, 0), (998, None)], "g int, total_frames long")
    assert sorted(map(tuple, U.fused_units(c, n, s, ["g"]).collect()), key=repr) == sorted(want, key=repr)
    assert U.fused_units(c.limit(0), n.limit(0), s.limit(0), ["g"]).collect() == []
