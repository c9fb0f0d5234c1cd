"""Drop lines that many documents share, keeping each in the first document that holds it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.words import LOWER, SPACE, UPPER, fields, whole_row
from millwright.session import materialize


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dedup_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """``docs`` with its text replaced by the kept lines, and the added columns n_lines and n_dropped.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of at least ``min_chars``
    code points found in at least ``min_docs`` distinct doc_ids lose all lines except in the smallest doc_id holding
    the key. A null or empty text is one empty line, so its result is empty. Rows with the same doc_id count as one
    document; null counts as one more id, after all others. Other columns stay as they are; existing columns of the
    added names are replaced.

    Keys travel as 128 bits of hash. Counting first folds (key, document), then the key, each before its shuffle,
    so a line in a third of all documents costs one row per task. Only positions of dropped lines come back to the
    documents: whole texts are shuffled once.
    """
    key = F.btrim(F.translate(F.col("line"), UPPER, LOWER), F.lit(SPACE))
    lines = (
        docs.select("doc_id", F.xxhash64("text").alias("_text"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
        .select("doc_id", "_text", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("doc_id", "_text", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), F.col("key")).alias("h2"))
    )
    lines = materialize(lines)
    per_document = lines.select("h1", "h2", "doc_id").distinct()
    shared = (
        per_document.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("home"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "home")
    )
    dropped = lines.join(shared, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("home")))
    # Bounded by the lines of one document; rows that repeat a document repeat its positions.
    places = dropped.groupBy(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash")).agg(
        F.array_sort(F.collect_set("pos")).alias("_gone")
    )
    keyed = docs.select(whole_row(docs), F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_text"))
    same = F.col("own_id").eqNullSafe(F.col("_id")) & (F.col("own_text") == F.col("_hash"))
    joined = keyed.join(places, same, "left").withColumn("_lines", _lines(F.col("doc.text")))
    bounds = F.concat(F.array(F.lit(-1)), F.col("_gone"), F.array(F.size("_lines")))
    runs = F.transform(
        F.sequence(F.lit(1), F.size("_gone") + 1),
        lambda i: F.slice("_lines", F.element_at(bounds, i) + 2, F.element_at(bounds, i + 1) - F.element_at(bounds, i) - 1),
    )
    kept = F.when(F.col("_gone").isNull(), F.coalesce("doc.text", F.lit(""))).otherwise(
        F.concat_ws("\n", F.flatten(runs))
    )
    own = fields(docs, "text", "n_lines", "n_dropped")
    return joined.select(
        *own, kept.alias("text"), F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
