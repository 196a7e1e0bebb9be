"""A training-data pipeline: documents in, piece ids out, each stage on what the one before kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brooklet.llm.common import SMALL_BATCHES, settings, written
from brooklet.llm.decontaminate import decontaminate
from brooklet.llm.jaccard_join import one_of_each
from brooklet.llm.secrets import find_secrets, redacted
from brooklet.llm.sentence_pieces import encode
from brooklet.llm.toxicity import THRESHOLD, toxicity

#: A document whose words lie in benchmark items by this share or more goes; of others the spans are cut.
MOST_HIT = 0.5


#: The column that holds all columns of a document that a stage does not touch, whatever their names.
REST = "rest"


def _packed(docs: DataFrame, *own: str) -> DataFrame:
    """``own`` columns, and all others as one, so that they cannot clash with those of an operator."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    return docs.select(*own, F.struct(*(others or [F.lit(None).cast("int").alias("none")])).alias(REST))


def _unpacked(rows: DataFrame, docs: DataFrame, **own: Column) -> DataFrame:
    """The columns of ``docs``: those in ``own`` as given, the others as they were."""
    return rows.select(*[(own[c] if c in own else F.col(REST)[c]).alias(c) for c in docs.columns])


def _length(text: Column) -> Column:
    """Characters of a text; of a null one what the document says."""
    return F.when(text.isNotNull(), F.length(text)).otherwise(F.col(REST)["n_chars"]).cast("long")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of toxicity.

    Null and empty texts score as texts without features and stay, repeated rows are judged one by one,
    and an empty table stays empty. The classifier learns from the labels of the documents given.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity(_packed(docs, "doc_id", "text"), labels, carry=["text", REST]).where(F.col("score") < THRESHOLD)
    return _unpacked(scored, docs, doc_id=F.col("doc_id"), text=F.col("text"))


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones.

    Null texts and texts without words are in no group and stay, each row of them; of rows that are
    equal one stays; an empty table stays empty.
    """
    return one_of_each(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of benchmark items; those that are mostly such passages go.

    Null texts stay null, texts without such passages stay as they are, repeated rows are cut one
    by one, and an empty table, or an empty benchmark, changes nothing.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate(_packed(docs, "doc_id", "text"), benchmark, cut=True, carry=[REST])
    found = found.where(F.col("n_hit") < F.greatest(F.lit(1), F.col("n_words") * MOST_HIT))
    kept = F.col("kept")
    return _unpacked(found, docs, doc_id=F.col("doc_id"), text=kept, n_chars=_length(kept))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a mark in place of each secret.

    Null texts stay null, texts without secrets stay as they are, repeated rows are searched one by
    one, and an empty table stays empty.
    """
    found = find_secrets(_packed(docs, "doc_id", "text"), [REST]).withColumn("text", redacted(F.col("text"), F.col("spans")))
    return _unpacked(found, docs, doc_id=F.col("doc_id"), text=F.col("text"), n_chars=_length(F.col("text")))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the texts' pieces, in place of the texts, and their number, behind the documents' other columns.

    Null and empty texts have no ids; repeated rows are encoded one by one; an empty table stays empty. A column of the documents
    that is called like one of the two has an underscore behind its name.
    """
    encoded = encode(_packed(docs, "doc_id", "text"), carry=[REST])
    others = [F.col(REST)[c].alias(f"{c}_" if c in ("ids", "n_ids") else c) for c in docs.columns if c not in ("doc_id", "text")]
    return encoded.select("doc_id", *others, "ids", F.size("ids").alias("n_ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_similar),
    ("benchmark_decontamination", cut_benchmark),
    ("secret_scans", redact_secrets),
    ("sentencepiece", piece_ids),
]

#: SQL cannot express the trained classifier or the piece ids; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each stage's result but the last is a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with settings(spark, **SMALL_BATCHES):
        for name, stage in STAGES[:-1]:
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
