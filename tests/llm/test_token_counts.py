import json
import random

import public_tokenizers
import pytest
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trackloom.llm import token_counts as T

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return T.vocabulary(PATH)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_every_code_point_is_split_as_the_library_does(vocabulary):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 50_000):
        text = "".join(f"a{c}a1{c}1-{c}- {c} {c}a" for c in map(chr, points[k : k + 50_000]))
        ends, at = [], 0
        for piece in vocabulary.split(text):
            ends.append((at, at + len(piece)))
            at += len(piece)
        assert ends == [span for _, span in LIBRARY.pre_tokenizer.pre_tokenize_str(text)]


def test_random_texts_count_as_in_the_library(vocabulary):
    counts, r = T._Counts(vocabulary), random.Random(0)
    some = ["'s", " the", "ing", "<|endoftext|>", "<|endo", "\r\n", " ", "日本", "é", "\U0001f600", "՘", *"abcdefgh  \n\t.,'0123ABC"]
    for _ in range(1500):
        text = "".join(r.choice(some) for _ in range(r.randint(0, 60)))
        assert counts.of(text) == library(text), text


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_any_text_counts_as_in_the_library(text):
    assert T._Counts(T.vocabulary(PATH)).of(text) == library(text)


def test_slices_and_a_full_memory_change_nothing(vocabulary, monkeypatch):
    text = " ".join(f"word{k} it's, {k * 7}.\n\n  x" for k in range(3000)) + "z" * 5000
    assert "".join(T.slices(text, 100)) == text and len(list(T.slices(text, 100))) > 100
    monkeypatch.setattr(T, "PACKED", 3)
    monkeypatch.setattr(T, "REMEMBERED", 10)
    monkeypatch.setattr(T.slices, "__defaults__", (100,))
    assert T._Counts(vocabulary).of(text) == library(text)


def test_long_runs_without_a_break(vocabulary):
    for text in ("ab" * 50_000, "é" * 50_000, "日" * 30_000, " " * 40_000, "a" * 100_001):
        assert T._Counts(vocabulary).of(text) == library(text)


def test_edge_rows(spark, vocabulary):
    texts = [(1, "Hello world", "x"), (1, "Hello world", "x"), (None, "a<|endoftext|>b", "y"), (2, None, None), (3, "", ""), (4, "ab " * 3000, "z")]
    df = spark.createDataFrame(texts, "doc_id long, text string, n_tokens string").withColumn("n_bytes", F.lit("clash"))
    assert rows(T.count_tokens(df, vocabulary)) == sorted([(i, len((t or "").encode()), library(t), library(t) > 1024) for i, t, _ in texts], key=repr)
    assert T.count_tokens(df.limit(0), vocabulary).collect() == []


def test_whole_documents_count_as_in_the_library(spark):
    from trackloom.llm.queries import op12_token_counts

    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    found = op12_token_counts(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(docs) and all(r.n_tokens == library(docs[r.doc_id]) for r in found)


def test_other_kinds_of_files_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"]["continuing_subword_prefix"] = "##"
    (tmp_path / "other.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="plain byte-level"):
        T.Vocabulary(str(tmp_path / "other.json"))
    with pytest.raises(ValueError, match="plain byte-level"):
        T.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
