"""A training-data pipeline of five operators over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept; its result is written as Parquet
in the shared folder and read again. All but the last return the columns of their input, whatever their names: columns that are called like
an operator's own are put aside and come back. An empty table gives an empty one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm import decontaminate, jaccard_join, language_id, mixing, secrets
from trackloom.llm.common import read_table
from trackloom.operators.graph import shared_root

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns of these names renamed, and how to name them again."""
    taken = [c for c in docs.columns if c in names]
    new = {c: f"own_{uuid.uuid4().hex}" for c in taken}
    return docs.withColumnsRenamed(new), {v: k for k, v in new.items()}


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or with under 40 % of their letters in any one language, go: those are several texts in one.

    A null or empty text has no letters. Texts are judged whole, however long; of equal shares the first language by name counts, which decides nothing
    here. Repeated rows are judged alike. Rows without a language or an id train nothing, but are judged.
    """
    model = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"))), F.col("text"), F.col("lang"), F.col("doc_id"))
    rows, back = _aside(docs, "lang_pred", "lang_score")
    judged = language_id.identify(rows, model)
    return judged.where((F.col("lang_pred") != "und") & (F.col("lang_score") >= 0.4)).select(rows.columns).withColumnsRenamed(back)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays; of repeated rows of it, one.

    Documents link from a similarity of 0.8 of their five-word shingles on, which takes in copies with a paragraph more or less. A null or empty
    text links with nothing, so its document stays; a document without an id stays only in a group where none has one. Rows that share an
    id but not their text are different documents: those of a kept id all stay, one of each text. Long texts are compared whole.
    """
    groups = jaccard_join.jaccard_components(docs, width=5, percent=80)
    name = f"kept_{uuid.uuid4().hex}"
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias(name)).agg(F.count("*").alias("rows"))
    out = docs.join(kept.select(name), F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")
    if kept.where("rows > 1").isEmpty():
        return out
    text = f"text_{uuid.uuid4().hex}"
    return out.withColumn(text, F.xxhash64("text")).dropDuplicates(["doc_id", text]).drop(text)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    Null and empty texts have no words, so they stay; so do all where the benchmark is empty. Whole texts are searched; repeated rows and ties
    make no difference, as each row is judged by itself.
    """
    rows, back = _aside(docs, "contamination", "__n_words", "__words", "__spans", "__items")
    judged = decontaminate.contamination(rows, read_table(spark, sf_dir, "benchmark", "item_id", "text"))
    return judged.where(F.col("contamination.n_hit") == 0).select(rows.columns).withColumnsRenamed(back)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; ``n_chars`` follows. All documents stay.

    A null text stays null, and so does its ``n_chars``; an empty one has none. Overlapping secrets are masked as one. Whole texts are scanned;
    repeated rows are masked alike.
    """
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns) if "n_chars" in docs.columns else masked


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what is left: how many words of each document it takes.

    A null or empty text has no words and gives none; a null source is a source, the last. Ties of places are broken by id and size, and
    repeated rows queue one after the other. Long texts are taken whole or not at all. Extra columns are left out.
    """
    return mixing.mix_sources(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("mixing", mix),
]

#: The first stage predicts with a fitted model, which SQL can't express; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_root(spark, 'spark-pipeline-')}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
