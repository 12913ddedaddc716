"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last keep the columns of ``documents``.  ``run`` writes the result of each
stage to the shared folder and reads it again as the next stage's input.
Stages that change a text also set ``n_chars`` to its new length.

Defined cases.  An empty table gives no rows, whatever the stage.  Null and
empty texts are never toxic by their words, link with nothing, hold neither
passages nor secrets, and pack as their one end id.  Rows that repeat a
``doc_id`` are one document to the near-duplicate stage (they stay or go
together, and links of any of their texts count) and rows of their own to the
others.  Rows with a null ``doc_id`` are no one's copies and stay.  Other columns come
through the first four stages untouched, whatever their names; ties go to the
smaller ``doc_id``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.llm import minhash_dedup, packing, secret_scan, substring_dedup, toxicity
from stockroom.llm.kernels import stash


#: Similarity of near duplicates in the stage; op3 takes 85.
NEAR_PERCENT = 80


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that are scored toxic."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").select("doc_id", "toxic")
    return toxicity.drop_toxic(docs, labels)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group
    (similarity of at least 0.8)."""
    return minhash_dedup.drop_near_duplicates(docs, NEAR_PERCENT)


def _with_text(docs: DataFrame, text) -> DataFrame:
    out = docs.withColumn("text", text)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else out


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of 50 words and more that a document with a smaller
    id holds too; documents without such a passage keep their text as it is."""
    done = substring_dedup.remove_repeats(docs)
    return _with_text(done, F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))) \
        .select(*docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by ``[SECRET]``; no document is dropped."""
    return _with_text(secret_scan.redact(docs), F.col("text")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens."""
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", substring_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the nearest-example votes nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
