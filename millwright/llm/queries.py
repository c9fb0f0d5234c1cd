"""Registered queries: each operator over its whole table, with the digest columns of its result."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm.bpe import round_trip
from millwright.llm.curves import nearest
from millwright.llm.hard_negatives import hard_negatives
from millwright.llm.licenses import scan_licenses
from millwright.llm.line_dedup import dedup_lines
from millwright.llm.packing import pack
from millwright.llm.pages import main_text
from millwright.llm.pii import KINDS, find_pii, fit_tagger
from millwright.llm.quality import fit_quality, judge
from millwright.llm.runs import periodic_runs
from millwright.llm.sharding import balanced_shards
from millwright.llm.simhash import near_duplicates
from millwright.llm.substrings import remove_repeats

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _equals(value: str) -> Callable[[Column], Column]:
    return lambda x: x == value


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = balanced_shards(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    judged = judge(docs, fit_quality(docs, _table(spark, sf_dir, "labels")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source is its directory."""
    path = F.concat_ws("/", F.col("source"), F.col("doc_id").cast("string"))
    found = scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"), path)
    return found.select("doc_id", "license", F.round("score", 6).alias("score"), "n_notices", "license_from")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = find_pii(docs, fit_tagger(docs))
    base = F.filter("spans", lambda s: s["base"])
    joined = lambda spans: F.concat_ws(",", F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    ))
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _equals(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = round_trip(F.col("text"), RANKS, public_tokenizers.PATTERN)
    return _table(spark, sf_dir, "documents").select("doc_id", digest.alias("d")).select("doc_id", "d.*")


def op9_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), TOKENIZER)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are every hundredth id; every seventh id first moves to the next of ten labels."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, moved)


def _repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth id by its checksum gets a tail that repeats a few of its words; a null id never does."""
    checksum = zlib.crc32(str(doc_id).encode())
    if doc_id is None or checksum % 10 or not words:
        return words
    g, n = checksum // 10, len(words)
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    unit = words[start : start + period]
    return words[:start] + (unit * (1 + (n - start) // period))[: n - start]


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_table(spark, sf_dir, "documents"), prepare=_repeated_tail)
    # A run is better if its length times the other's period is greater: exact, without a quotient.
    better = lambda a, b: F.when(
        a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b
    ).otherwise(a)
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")]), F.lit("\n")))
    return found.select("doc_id", "runs", "collapsed", F.aggregate("runs", none, better).alias("best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.expr("1000 * best.length div best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes in strings of 100 bytes that start earlier go."""
    kept = remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_line_dedup, op3_sharding, op4_quality, op5_licenses, op6_pii, op7_nearest, op8_bpe, op9_pages, op10_packing,
        op11_hard_negatives, op12_runs, op13_substrings,
    )
}
