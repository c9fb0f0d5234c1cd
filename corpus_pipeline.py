"""From raw documents to packed training windows: five stages, each on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents. Where a stage changes a text, n_chars follows.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm.line_dedup import dedup_lines
from millwright.llm.packing import pack
from millwright.llm.pii import fit_tagger, mask_pii
from millwright.llm.quality import fit_quality, judge
from millwright.llm.simhash import drop_near_duplicates
from millwright.session import ensure_checkpoint_dir, scratch


def _like(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of ``docs``, with n_chars counted again where there is such a column."""
    counted = F.char_length("text").cast("long")
    return changed.select(*[counted.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the likelihood ratio keep."""
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, model).where("kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand in a document with a smaller id."""
    return _like(docs, dedup_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints of three-word shingles that differ in at most two bits."""
    return drop_near_duplicates(docs, size=3, radius=2)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked."""
    return _like(docs, mask_pii(docs, fit_tagger(docs)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 1024 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("pii", pii), ("packing", packing)]

#: SQL expresses neither the trained stages nor the fingerprints; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        with scratch(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{name}")
    return docs
