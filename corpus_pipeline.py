"""The training-data pipeline: quality, near-duplicates, repeated passages, leaked tests, tokens.

Each stage takes (spark, docs, sf_dir) and works on every row that the stage before kept. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm import decontamination, near_duplicates, quality, suffix_dedup, tables, tree_bpe

VOCABULARY = "byte_bpe_50k.json"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality.train(docs, tables.read(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.keep(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the least id stays."""
    return near_duplicates.first_of_class(docs)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also stand in a document with a smaller id are cut out; the document stays."""
    rest = [c for c in docs.columns if c != "text"]
    whole = docs.select("doc_id", "text", F.struct(*rest).alias("whole_row"))
    cut = suffix_dedup.dedup(whole, ["whole_row"], suffix_dedup.remaining, suffix_dedup.REMAINING)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return cut.select(*(new.get(c, F.col("whole_row").getField(c)).alias(c) for c in docs.columns))


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, even edited, go."""
    return decontamination.without_leaks(docs, tables.read(spark, sf_dir, "benchmark", "item_id", "text"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, as counts and digests, with the digest of the text decoded from them."""
    return tree_bpe.encoded_digests(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("passages", passage_stage),
    ("leaks", leak_stage),
    ("tokens", token_stage),
]

# Trained scores and tokens are beyond SQL; tests/llm/test_pipeline.py compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = tables.written(docs)
    return docs
