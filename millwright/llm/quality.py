"""Quality rules: counted base measures, and a hashed n-gram likelihood ratio between trusted and raw text.

Two multinomials over hashed byte n-grams are counted: one over all documents, one over documents labelled good. A
document's score is the mean log ratio of its n-grams. The threshold is set once, on all labelled documents that the
trusted counts have not seen, and every document is judged by it alone. No label is left out: half of the good ones
are counted, the other half and all bad ones set the threshold.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.words import SPACE, byte_words, chunks, fields, whole_row
from millwright.ml.metrics import score_curve
from millwright.operators.sizing import SINGLE_TASK_ROWS, dimension
from millwright.session import materialize

#: The characters counted as symbols.
SYMBOLS = "#*$%&|<>"
ORDERS = (2, 3)
BUCKETS = 1 << 14
BYTES_AT_ONCE = 1 << 20
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text, the first one included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    total, covered = 0, 0
    for i, window in enumerate(windows):
        if found[window] > 1:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text; zeros for null."""
    words = byte_words(text)
    if not words:
        return 0, 0, 0, 0, 0
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def buckets(text: str | None) -> Iterator[np.ndarray]:
    """Hashed n-grams of the text's bytes, each order in its own range; long texts come in pieces."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    for lo, hi in chunks(len(data), BYTES_AT_ONCE):
        for k, n in enumerate(ORDERS):
            piece = data[lo : hi + n - 1].astype(np.uint32)
            if len(piece) < n:
                continue
            mixed = np.zeros(len(piece) - n + 1, np.uint32)
            for i in range(n):
                mixed = (mixed ^ piece[i : len(mixed) + i]) * np.uint32(0x9E3779B1)
            yield (mixed >> np.uint32(18)).astype(np.int32) + k * BUCKETS


def score(text: str | None, weights: np.ndarray) -> float:
    """Mean log ratio over all n-grams; 0 for a text without any."""
    total, n = 0.0, 0
    for found in buckets(text):
        total += float(weights[found].sum())
        n += len(found)
    return total / n if n else 0.0


@dataclass(frozen=True)
class QualityModel:
    """Log ratio per bucket, and the least score of a document that is kept."""

    weights: np.ndarray
    threshold: float


def _labelled(labels: DataFrame) -> DataFrame:
    """doc_id, good and fit (counted as trusted, else held out) of every labelled document; of several labels the worst."""
    usable = labels.where("doc_id is not null and quality is not null")
    one = usable.groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))
    half = F.pmod(F.xxhash64(F.lit("fit"), F.col("doc_id")), F.lit(2)) == 0
    return materialize(one.select("doc_id", "good", (F.col("good") & half).alias("fit")))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros(BUCKETS * len(ORDERS), np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            for found in buckets(text):
                totals += np.bincount(found, minlength=len(totals))
    used = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], ["bucket", "n"])


def _bucket_counts(texts: DataFrame) -> np.ndarray:
    """n-grams of all texts per bucket."""
    out = np.zeros(BUCKETS * len(ORDERS))
    for bucket, n in texts.select("text").mapInArrow(_count, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def _scores(text: Column, weights: np.ndarray) -> Column:
    shared = weights.astype(np.float32)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([score(t, shared) for t in batch], dtype="float64")

    return scores(text)


def pick_threshold(found: DataFrame, keep_share: float, max_rows: int = SINGLE_TASK_ROWS) -> float:
    """Where to cut ``found`` (score, good) so that at least ``keep_share`` of the good documents stay.

    Among such cuts, the one with the largest difference between the shares of bad and of good documents it rejects,
    moved half-way down to the next lower score, so that good documents a little below the known ones stay too.
    -infinity if no cut rejects more bad than good ones, or one of the two kinds is missing.
    """
    curve = score_curve(found.select("score", F.col("good").cast("int").alias("good")), "score", "good", max_rows=max_rows)
    good, bad = curve.agg(F.max("tp"), F.max("fp")).first()
    if not good or not bad:
        return -np.inf
    # Rejected by a cut is what the curve has not reached at its score; shares are compared in whole numbers.
    lost, caught = F.lit(good) - F.col("tp"), F.lit(bad) - F.col("fp")
    gain = caught.cast("decimal(19,0)") * F.lit(good) - lost.cast("decimal(19,0)") * F.lit(bad)
    cuts = curve.where(lost <= int((1 - keep_share) * good)).select("score", gain.alias("gain"))
    best = cuts.orderBy(F.desc("gain"), "score").first()
    if best.gain <= 0:
        return -np.inf
    return (best.score + curve.where(F.col("score") < F.lit(best.score)).agg(F.max("score")).first()[0]) / 2


def fit_quality(docs: DataFrame, labels: DataFrame, keep_share: float = 0.998, smoothing: float = 1.0) -> QualityModel:
    """Count both multinomials over whole texts and set the threshold.

    Raw counts cover every row of ``docs``, and every label is used: half of the good ones are the trusted text, all
    others set the threshold. To the driver go the bucket counts (two orders of BUCKETS) and the cut. Only the trusted
    texts meet their labels; for the threshold, ids and scores do. Without usable labels nothing is rejected by the model.
    """
    known = _labelled(labels)
    trusted = _bucket_counts(docs.select("doc_id", "text").join(dimension(known.where("fit"), "doc_id"), "doc_id"))
    if not trusted.any():
        return QualityModel(np.zeros(len(trusted)), -np.inf)
    each = np.stack([_bucket_counts(docs), trusted]).reshape(2, len(ORDERS), BUCKETS) + smoothing
    logs = np.log(each / each.sum(axis=2, keepdims=True))
    weights = (logs[1] - logs[0]).reshape(-1)
    scored = docs.select("doc_id", _scores(F.col("text"), weights).alias("score"))
    held_out = scored.join(dimension(known.where("NOT fit"), "doc_id", "good"), "doc_id")
    return QualityModel(weights, pick_threshold(held_out, keep_share))


def judge(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with the base measures, base_failed, score and kept added (existing columns of those names go).

    A null or empty text has no words and fails the base rules. Every row is judged by itself, so repeated rows and
    null ids make no difference; an empty table stays empty.
    """
    weights, threshold = model.weights.astype(np.float32), model.threshold

    @F.pandas_udf(f"{MEASURES}, score double")
    def all_measures(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in MEASURES.split(", ")]
        for batch in batches:
            found = pd.DataFrame([measures(t) for t in batch], columns=names, dtype="int64")
            yield found.assign(score=np.array([score(t, weights) for t in batch], dtype=float))

    failed = (F.col("_m.n_words") < MIN_WORDS) | (100 * F.col("_m.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_m.n_words"))
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept"]
    return (
        docs.select(whole_row(docs), all_measures(F.col("text")).alias("_m"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("_m.score") >= F.lit(float(threshold))))
        .select(*fields(docs, *added), "_m.*", "base_failed", "kept")
    )
