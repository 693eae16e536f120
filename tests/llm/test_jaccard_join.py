import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import components, rows, shingles
from pyspark.sql import functions as F

from trackloom.llm import jaccard_join as J


def brute(texts, percent=90):
    s = {k: shingles(t) for k, t in texts.items()}
    links = [(a, b) for a in s for b in s if a < b and s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b])]
    root = components(texts, links)
    return sorted((k, len(s[k]), root[k]) for k in texts)


def corpus(seed, n=160):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    base = [[r.choice(vocabulary) for _ in range(r.choice([4, 12, 30, 80, 200]))] for _ in range(12)]
    common = [r.choice(vocabulary) for _ in range(60)]
    out = {}
    for k in range(n):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
            w[r.randrange(len(w))] = f"x{r.randrange(9)}"
        out[k] = (" \n".join(w) if k % 5 else " ".join(w).upper()) + (" " + " ".join(common) if k % 7 == 0 else "")
    return out | {n: None, n + 1: "", n + 2: " \t\n", n + 3: "one", n + 4: "ONE", n + 5: "one two", n + 6: "é ü", n + 7: "É ü"}


@pytest.mark.parametrize(("seed", "group_rows", "block_rows"), [(1, 4096, 4096), (2, 8, 3), (3, 4096, 2)])
def test_matches_brute_force(spark, monkeypatch, seed, group_rows, block_rows):
    monkeypatch.setattr(J, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(J, "BLOCK_ROWS", block_rows)
    texts = corpus(seed)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("class", F.lit(1)).withColumn("token", F.lit("x"))
    assert rows(J.jaccard_components(df)) == sorted(brute(texts), key=repr)


def test_prefixes_of_linked_sets_share_enough():
    r = np.random.default_rng(0)
    counts = r.integers(1, 50, J.SKETCH_SLOTS).astype(float)
    for _ in range(200):
        n = int(r.integers(10, 300))
        x = np.unique(r.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        drop = int(len(x) * r.uniform(0, 0.08))
        y = np.unique(np.concatenate([x[drop:], r.integers(0, 2**63, max(0, drop // 2)).astype(np.uint64)]))
        shared, union = len(np.intersect1d(x, y)), len(np.union1d(x, y))
        if 100 * shared < 90 * union:
            continue
        px, _, lx, _ = J.prefix_of(x, counts, 90)
        py, _, ly, _ = J.prefix_of(y, counts, 90)
        l, alpha = min(lx, ly), (90 * (len(x) + len(y)) + 189) // 190
        assert len(np.intersect1d(px[: len(x) - alpha + l], py[: len(y) - alpha + l])) >= l
        assert J.shared_in_prefix((px, lx, len(x)), (py, ly, len(y)), 90)
        ham = sum(int(v).bit_count() for v in (J.bitmap(x) ^ J.bitmap(y)).view(np.uint64))
        assert ham <= len(np.setxor1d(x, y)) <= len(x) + len(y) - 2 * alpha


def test_long_texts_are_whole():
    text = " ".join(f"w{k}" for k in range(300_000))
    (s,) = J.shingle_sets(pa.array([text]), 3)
    assert len(s) == 299_998


def test_repeated_rows_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, None)], "doc_id long, text string")
    assert rows(J.jaccard_components(df)) == sorted([(5, 2, 5), (5, 2, 5), (None, 2, 5), (None, 0, None)], key=repr)
    assert J.jaccard_components(df.limit(0)).collect() == []


def test_links_that_miss_the_centre(spark):
    """Windows sliding over one long text: each links with its nearest only, so most links are found after the stars; some groups are dense."""
    words = [f"w{k}" for k in range(140)]
    texts = {k: " ".join(words[k : k + 60]) for k in range(0, 80, 2)}
    texts |= {100 + k: " ".join([*words[:59], f"x{k}"]) for k in range(30)} | {200 + k: " ".join([f"y{k}", f"z{k}", *words[20:70]]) for k in range(12)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert rows(J.jaccard_components(df)) == sorted(brute(texts), key=repr)


def test_one_shingle_of_ten_thousand_unlinked_classes(spark, monkeypatch):
    """Short texts that share a rare-looking phrase, and are apart otherwise: pairs are dealt over blocks, and the few links are found."""
    monkeypatch.setattr(J, "BLOCK_ROWS", 1024)
    n = 10_000
    texts = {k: f"one common phrase a{k} b{k} c{k} d{k}" for k in range(n)}
    texts |= {n + k: f"one common phrase a{k} b{k} c{k} d{k} one common phrase a{k}" for k in range(0, 50)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in J.jaccard_components(df, percent=60).collect()}
    s = {k: shingles(t) for k, t in texts.items()}
    assert all(100 * len(s[k] & s[n + k]) >= 60 * len(s[k] | s[n + k]) for k in range(50))
    assert got == {k: k if k < n else k - n for k in texts}


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d"), (2, "a b c d")], "doc_id long, text string")
    for name in ("n", "class", "spot", "least", "rows", "token", "grp", "component", "component_id", "n_shingles", "name", "sketch", "b0"):
        df = df.selectExpr("*", f"'mine' AS `{name}`")
    assert rows(J.jaccard_components(df)) == [(1, 2, 1), (2, 2, 1)]


def test_kept_sets_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(J, "KEPT_BYTES", 0)
    pack = lambda t: len(t.encode()).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(t.encode(), asbytes=True)
    x, y, z = "a b c d e f g h i j k", "a b c d e f g h i j l", "q r s t"
    batch = pa.RecordBatch.from_arrays([pa.array([1, 1, 2]), pa.array([1, 2, 3]), pa.array([pack(x), pack(x), pack(y)]), pa.array([pack(x), pack(y), pack(z)])], ["a", "b", "text_a", "text_b"])
    class Sketch:
        value = np.ones(J.SKETCH_SLOTS)

    (out,) = J._verify(3, 75, Sketch)(iter([batch]))
    assert out.to_pydict() == {"a": [1, 1], "b": [1, 2]}


def test_the_filter_of_texts_goes_out_as_bits(spark, monkeypatch):
    sizes, texts_ = [], J._texts
    monkeypatch.setattr(J, "_texts", lambda width, bits: sizes.append(bits.value.nbytes) or texts_(width, bits))
    texts = corpus(5, 60)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert rows(J.jaccard_components(df)) == sorted(brute(texts), key=repr)
    assert sizes and max(sizes) <= J.FILTER_BITS // 8


def test_the_sketch_comes_without_row_objects(spark, monkeypatch):
    """Without Arrow a full sketch of 2^18 counters took 140 MB of the driver's Python for a moment."""

    def refused(*_):
        raise AssertionError("rows of the sketch as objects")

    texts = {1: "a b c d e", 2: "A b c d e", 3: "another text of words", 4: None}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(type(df), "toPandas", refused)
    assert rows(J.jaccard_components(df)) == sorted(brute(texts), key=repr)
    assert rows(J.jaccard_components(df.where("false"))) == []
