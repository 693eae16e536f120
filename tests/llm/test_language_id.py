import random

import pytest
from pyspark.sql import functions as F

from trackloom.llm import language_id as L

WORDS = {"en": ["the", "and", "this", "that", "with", "from", "house", "light", "night", "which"], "de": ["der", "und", "nicht", "schule", "haus", "zwischen", "straße", "licht", "über"], "ru": ["дом", "ночь", "свет", "который", "между"]}


def text(r, lang, n):
    return " ".join(r.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    r = random.Random(0)
    rows = [(k, text(r, lang, 40), lang) for k, lang in enumerate(list(WORDS) * 40)]
    df = spark.createDataFrame([*rows, (900, "x", None), (901, None, "en")], "doc_id long, text string, lang string")
    return L.train(df, F.col("text"), F.col("lang"))


def test_held_out_accuracy_and_edge_cases(spark, model):
    r = random.Random(1)
    docs = [(k, text(r, lang, 15), lang) for k, lang in enumerate(list(WORDS) * 20)]
    df = spark.createDataFrame([*docs, (800, None, "x"), (801, "12 ... !", "y"), (802, "", "z"), docs[0]], "doc_id long, text string, lang_pred string")
    out = L.identify(df, model).collect()
    assert all(r.lang_pred == lang and 0.9 <= r.lang_score <= 1 for r in out for k, _, lang in docs if k == r.doc_id)
    assert all((r.lang_pred, r.lang_score) == ("und", 0.0) for r in out if r.doc_id >= 800)
    assert len(out) == len(docs) + 4


def test_spans_of_mixed_text(spark, model):
    r = random.Random(2)
    parts = [text(r, "en", 30), text(r, "ru", 20), text(r, "de", 30)]
    whole = " ".join(parts)
    row = L.identify(spark.createDataFrame([(whole,)], "text string"), model, with_spans=True).first()
    assert [s.lang for s in row.lang_spans] == ["en", "ru", "de"]
    assert whole[row.lang_spans[1].start : row.lang_spans[1].end] == parts[1]


def test_paths_match_a_plain_search(model):
    r = random.Random(3)
    texts = [" ".join(text(r, r.choice(list(WORDS)), r.randint(1, 4)) for _ in range(r.randint(0, 6))) for _ in range(25)] + ["", "."]
    scores, _, _, _, bounds = L.word_scores(texts, model)
    label = L.best_paths(scores, bounds, 12.0)
    for i in range(len(texts)):
        s = scores[bounds[i] : bounds[i + 1]]
        value = lambda path, s=s: sum(s[k][p] for k, p in enumerate(path)) - 12.0 * sum(a != b for a, b in zip(path, path[1:]))
        best = None
        if 0 < len(s) <= 8:
            import itertools

            best = max(value(p) for p in itertools.product(range(3), repeat=len(s)))
            assert value(label[bounds[i] : bounds[i + 1]]) == pytest.approx(best, rel=1e-5)


def test_without_training_rows(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    m = L.train(df, F.col("text"), F.col("lang"))
    assert [(r.lang_pred, r.lang_score) for r in L.identify(df, m).collect()] == [("und", 0.0)]
    assert L.identify(df.limit(0), m).collect() == []


def test_very_long_text(spark, model):
    long = text(random.Random(4), "de", 60_000)
    assert L.identify(spark.createDataFrame([(long,), ("the house",)], "text string"), model).first().lang_pred == "de"
