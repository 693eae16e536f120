import random

from helpers import rows

from trackloom.llm import mixing as M


def filled(sizes, weights=(5, 2, 1), share=1.5, repeats=2):
    """Deal the budget by weight, stop full sources, deal the rest again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= repeats * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in open_}
        target |= {s: repeats * sizes[s] for s in full}
        left -= sum(repeats * sizes[s] for s in full)
        open_ -= full
    return target


def test_targets_and_taken_words(spark, monkeypatch):
    monkeypatch.setattr(M, "PART_ROWS", 16)
    r = random.Random(4)
    docs = [(k, " ".join("x" * r.randint(0, 30)), r.choice(["hot"] * 6 + ["b", "C", "é", None])) for k in range(900)]
    docs += [(2000, None, "b"), (2001, "", "empty"), (7, docs[7][1], docs[7][2]), (3000, "a\tb\n\vc\u00a0d", "b")]
    out = M.mix_sources(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    assert len(out) == len(docs)
    sizes, taken, biggest = {}, {}, {}
    for row in out:
        sizes[row.source] = sizes.get(row.source, 0) + row.size
        taken[row.source] = taken.get(row.source, 0) + row.taken
        biggest[row.source] = max(biggest.get(row.source, 0), row.size)
        assert row.taken in (0, row.size, 2 * row.size)
    assert {r.source_size for r in out if r.source == "hot"} == {sizes["hot"]}
    target = filled(sizes)
    for row in out:
        assert abs(row.target - target[row.source]) < 1e-6
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 2 * biggest[s]
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    assert next(r.size for r in out if r.doc_id == 3000) == 3


def test_reruns_agree_and_the_schedule_is_sorted(spark):
    docs = spark.createDataFrame([(k, "w " * (k % 17), "abc"[k % 3]) for k in range(200)], "doc_id long, text string, source string").repartition(5)
    a, b = M.mix_sources(docs), M.mix_sources(docs.repartition(3))
    assert rows(a) == rows(b)
    times = [r.time for r in M.schedule(a).collect()]
    assert times == sorted(times) and len(times) == sum(len(r.finish) for r in a.collect())


def test_empty_tables_and_texts(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.mix_sources(docs).collect() == []
    docs = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in M.mix_sources(docs).collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_clashing_columns_and_null_ids(spark):
    """Columns named like those that the mix adds are ignored; rows without an id are dealt over places by their text."""
    docs = spark.createDataFrame([(None if k % 2 else k, "w " * (k % 5 + 1) + f"x{k}", "ab"[k % 2]) for k in range(60)], "doc_id long, text string, source string")
    plain = rows(M.mix_sources(docs))
    for name in ("size", "place", "name", "part", "ahead", "cum", "times", "target", "taken", "finish", "source_no", "source_size", "n_docs"):
        docs = docs.selectExpr("*", f"'mine' AS `{name}`")
    assert rows(M.mix_sources(docs)) == plain
    assert sum(r[5] for r in plain) > 0 and len(plain) == 60
