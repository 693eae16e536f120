import hashlib
import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from helpers import rows, words
from pyspark.sql import functions as F

from trackloom.llm import decontaminate as D


def brute(docs, items, width=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + width]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(p) for p in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        names = ",".join(sorted(map(str, found)))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("seed", "shard", "limit"), [(1, 1 << 18, 32 << 20), (2, 50, 32 << 20), (3, 1 << 18, 300)])
def test_matches_brute_force(spark, monkeypatch, seed, shard, limit):
    monkeypatch.setattr(D, "SHARD_SYMBOLS", shard)
    r = random.Random(seed)
    vocabulary = ["a", "b", "c", "dd", "é", "9"]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.choice([1, 3, 10, 14, 25])))) for k in range(2, 14)] + [(99, None), (98, ""), (97, "a b, C")]
    docs = []
    for k in range(120):
        w = [r.choice([*vocabulary, "zz", "yy"]) for _ in range(r.randint(0, 60))]
        if k % 3 == 0:
            at = r.randint(0, len(w))
            w[at:at] = words(r.choice(items)[1])
        docs.append((k, r.choice([" ", "-", "\n"]).join(w).upper()))
    docs += [(500, None), (501, ""), (502, "..."), (7, docs[7][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("contamination", F.lit(1))
    assert rows(D.report(df, bench, max_broadcast=limit)) == brute(docs, items)


def test_spans_cut_the_text(spark):
    df = spark.createDataFrame([(1, "Vör: one two three, four! end", "keep"), (2, None, None)], "doc_id long, text string, items string")
    bench = spark.createDataFrame([(1, "ONE two"), (2, "two three four")], "item_id long, text string")
    c = D.contamination(df, bench)
    got = {r.doc_id: (r.left, r.items) for r in c.select("doc_id", "items", D.without_spans(F.col("text"), F.col("contamination.spans")).alias("left")).collect()}
    assert got == {1: ("Vör: ! end", "keep"), 2: (None, None)}


def test_index_finds_what_a_scan_does():
    r = np.random.default_rng(3)
    text = r.integers(1, 5, 400)
    index = D.FMIndex(text, 5)
    phrases = r.integers(1, 5, (60, 4))
    phrase, low, high = index.search(phrases)
    found = {tuple(phrases[p]): sorted(index.locate(np.arange(a, b)).tolist()) for p, a, b in zip(phrase, low, high)}
    for p in map(tuple, phrases):
        want = [i for i in range(len(text) - 3) if tuple(text[i : i + 4]) == p]
        assert found.get(p, []) == want


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert rows(D.report(df, bench)) == brute([(1, "a b")], [])
    assert D.report(df.limit(0), bench).collect() == []


def test_a_column_of_the_same_name_is_replaced(spark):
    df = spark.createDataFrame([(1, "one two", "old")], "doc_id long, text string, contamination string")
    out = D.contamination(df, spark.createDataFrame([(1, "ONE two")], "item_id long, text string"))
    assert out.columns == ["doc_id", "text", "contamination"] and out.first().contamination.n_hit == 2


def test_a_line_of_all_items_in_all_texts_takes_bounded_memory():
    n, line = 5000, "answer the following question with one of the given letters and nothing else"
    phrases = D.Phrases([(k, f"{line} item{k}") for k in range(n)], 10)
    assert len(phrases.sets) <= n + 1  # the windows of the line share one set
    names = {c: c for c in D._WORKING}
    texts = pa.array([f"{line} text{k}" for k in range(n)])
    none = [pa.nulls(n, pa.int64()), pa.nulls(n, D._SPANS), pa.nulls(n, D._SPANS), pa.nulls(n, pa.list_(pa.int64()))]
    batch = pa.RecordBatch.from_arrays([texts, *none], ["text", *D._WORKING])
    tracemalloc.start()
    seen = listed = most = 0
    for out in D._pass(SimpleNamespace(value=phrases), "text", pa.int64(), names)(iter([batch])):
        seen, listed, most = seen + out.num_rows, listed + len(out["items"].flatten()), max(most, out.nbytes)
        assert all(len(w.as_py()) == 1 for w in out["words"])
    assert (seen, listed) == (n, n * n) and most < 20 << 20
    assert tracemalloc.get_traced_memory()[1] < 150 << 20
    tracemalloc.stop()


def test_many_items_and_passes_match_brute_force_with_text_ids(spark):
    line = "answer the following question with one of the letters"
    items = [(f"i{k}", f"{line} {k % 7} {k}") for k in range(40)] + [("i3", "other words of the same item")]
    docs = [(k, f"x {line} {k % 9} {k} the other words of the same item") for k in range(30)] + [(99, line)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("__items", F.lit("kept")).withColumn("__words", F.lit(1))
    bench = spark.createDataFrame(items, "item_id string, text string")
    for limit in (1 << 20, 400):
        assert rows(D.report(df, bench, max_broadcast=limit)) == brute(docs, items)
        out = D.contamination(df, bench, max_broadcast=limit)
        assert out.columns == ["doc_id", "text", "__items", "__words", "contamination"] and {r[0] for r in out.select("__items").collect()} == {"kept"}
