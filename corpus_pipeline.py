"""A training corpus from raw documents, stage by stage.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.bpe import round_trip
from foliospark.llm.common import materialize, with_row
from foliospark.llm.line_dedup import dedup_lines
from foliospark.llm.mixing import mix_rows
from foliospark.llm.near_dedup import drop_near_copies
from foliospark.llm.quality_rules import apply_quality_rules

NEAR_PERCENT = 80


def _again(out: DataFrame, columns: list[str]) -> DataFrame:
    """(id, row, new_text) with the columns of documents; n_chars, if there is one, is the new text's."""
    new = {"doc_id": F.col("id"), "text": F.col("new_text"), "n_chars": F.length("new_text").cast("long")}
    return out.select(*(new.get(c, F.col("row")[c]).alias(c) for c in columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, and so do frequent lines of the others."""
    rows = with_row(docs, "doc_id", "text", "source").withColumn("row", F.struct("row.*", "source"))
    out = apply_quality_rules(rows, keep=("row",)).filter("kept")
    return _again(out.withColumnRenamed("kept_text", "new_text"), docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks that an earlier document has go; so does a document of which nothing is left."""
    out = dedup_lines(with_row(docs, "doc_id", "text"), keep=("row",)).filter("n_removed = 0 or n_removed < n_lines")
    return _again(out.withColumnRenamed("kept_text", "new_text"), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, of a similarity of ``NEAR_PERCENT`` and more, stays."""
    return drop_near_copies(docs, percent=NEAR_PERCENT)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mix_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    return round_trip(docs.select("doc_id", "source", "lang", "text"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixing),
    ("bpe", tokens),
]

#: SQL can neither align lines by patience diff nor encode byte pairs: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
