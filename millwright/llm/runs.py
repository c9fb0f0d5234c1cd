"""Periodic runs of words, found by block convolution.

A run is a stretch of words with smallest period q that no neighbouring word extends, of at least ``min_words`` words and
``min_times`` periods. At each dyadic scale s the text is cut into blocks of s words. A run of period q between s and
2s - 1 (from 1 on at the smallest scale) holds a whole block together with its repetition q words later: a run spans at
least three periods, and of 2s - 1 words in a row one block is complete. So it is enough to find, for each block, the
distances below 2s at which it occurs again.

The mismatch at distance d is the sum of squared differences of word numbers. Sums of squares come from prefix sums, the
products from one number-theoretic transform per block, exact modulo a prime. A sum that is zero modulo the prime gives
a seed; the words themselves decide while the seed is extended to both sides. A block one of whose words does not occur
again within reach cannot repeat and needs no transform. Distances are taken in ascending order, and what lies in
a known run at a multiple of its period is passed over, so the smallest period of each stretch is found first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.words import byte_words, fields, whole_row

PRIME = 2013265921  # 15 * 2^27 + 1: transforms of up to 2^27 places, products below 2^62
ROOT = 31
SMALLEST = 8
AT_ONCE = 1 << 20


@dataclass(frozen=True)
class RunRule:
    """``min_words`` is at least 24 and ``min_times`` at least 3: the blocks rely on both."""

    min_words: int = 24
    min_times: int = 3

    def __post_init__(self) -> None:
        if self.min_words < 3 * SMALLEST or self.min_times < 3:
            raise ValueError("runs of fewer than 24 words or three periods are not covered by the blocks")


@lru_cache(maxsize=64)
def _powers(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 * half."""
    step = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
    if inverse:
        step = pow(step, PRIME - 2, PRIME)
    out = np.ones(half, np.int64)
    done = 1
    while done < half:
        out[done : 2 * done] = out[:done] * pow(step, done, PRIME) % PRIME
        done *= 2
    return out


def transform(rows: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of each row (a power of two long); the result is in bit-reversed order."""
    n = rows.shape[1]
    out, half = rows % PRIME, n // 2
    while half:
        parts = out.reshape(len(rows), -1, 2, half)
        left, right = parts[:, :, 0], parts[:, :, 1]
        out = np.stack([(left + right) % PRIME, (left - right) % PRIME * _powers(half, False) % PRIME], axis=2)
        half //= 2
    return out.reshape(len(rows), n)


def inverse_transform(rows: np.ndarray) -> np.ndarray:
    """The inverse of ``transform``, from bit-reversed order."""
    n = rows.shape[1]
    out, half = rows, 1
    while half < n:
        parts = out.reshape(len(rows), -1, 2, half)
        left, right = parts[:, :, 0], parts[:, :, 1] * _powers(half, True) % PRIME
        out = np.stack([(left + right) % PRIME, (left - right) % PRIME], axis=2)
        half *= 2
    return out.reshape(len(rows), n) * pow(n, PRIME - 2, PRIME) % PRIME


def _next_same(x: np.ndarray) -> np.ndarray:
    """Distance from each word to the next equal one; the length of the text and more if there is none."""
    order = np.argsort(x, kind="stable")
    out = np.full(len(x), len(x) + 1)
    same = x[order[1:]] == x[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def _zero_mismatches(x: np.ndarray, starts: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of the blocks of s words whose squared differences sum to zero modulo the prime."""
    n, span = len(x), 4 * s
    padded = np.concatenate([x, np.zeros(3 * s, np.int64)])
    squares = np.concatenate([[0], np.cumsum(padded * padded % PRIME) % PRIME])
    inside = np.arange(3 * s)
    distances = np.arange(1 if s == SMALLEST else s, 2 * s)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    step = max(1, AT_ONCE // span)
    for lo in range(0, len(starts), step):
        at = starts[lo : lo + step]
        window = np.zeros((len(at), span), np.int64)
        window[:, : 3 * s] = padded[at[:, None] + inside]
        block = np.zeros((len(at), span), np.int64)
        block[:, :s] = window[:, s - 1 :: -1] if s < span else window[:, ::-1]
        products = inverse_transform(transform(window) * transform(block) % PRIME)[:, s - 1 + distances]
        shifted = at[:, None] + distances
        own = (squares[at + s] - squares[at])[:, None]
        mismatch = (own + squares[shifted + s] - squares[shifted] - 2 * products) % PRIME
        row, col = np.nonzero((mismatch == 0) & (shifted + s <= n))
        found.append((at[row], distances[col]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _matching(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning."""
    n, done, step = min(len(a), len(b)), 0, 64
    while done < n:
        wrong = np.flatnonzero(a[done : done + step] != b[done : min(n, done + step)][: len(a[done : done + step])])
        if len(wrong):
            return done + int(wrong[0])
        done, step = done + step, step * 2
    return n


def _stretch(x: np.ndarray, start: int, end: int, d: int) -> tuple[int, int]:
    """The widest [left, right) around [start, end) in which words d apart are equal."""
    right = end + _matching(x[end:], x[end - d :][: len(x) - end])
    left = start - _matching(x[:start][::-1], x[d : start + d][::-1])
    return left, right


def find_runs(x: np.ndarray, rule: RunRule = RunRule()) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of an array of word numbers, by start, then period."""
    n = len(x)
    runs: list[tuple[int, int, int]] = []
    if n < rule.min_words:
        return []
    following = _next_same(x)
    s = SMALLEST
    while s == SMALLEST or s * rule.min_times <= n:
        whole = n // s
        reach = following[: whole * s].reshape(whole, s).max(axis=1)
        starts = np.flatnonzero(reach < 2 * s) * s
        if len(starts):
            at, d = _zero_mismatches(x, starts, s)
            order = np.lexsort((at, d))
            at, d = at[order], d[order]
            for l, length, q in runs:
                open_ = ~((at >= l) & (at + s + d <= l + length) & (d % q == 0))
                at, d = at[open_], d[open_]
            while len(at):
                start, q = int(at[0]), int(d[0])
                if not np.array_equal(x[start : start + s], x[start + q : start + q + s]):
                    at, d = at[1:], d[1:]
                    continue
                left, right = _stretch(x, start, start + s + q, q)
                wide = right - left >= max(rule.min_words, rule.min_times * q)
                if wide:
                    runs.append((left, right - left, q))
                open_ = ~((at >= left) & (at + s + d <= right) & (d % q == 0 if wide else d == q))
                at, d = at[open_], d[open_]
        s *= 2
    return sorted(runs, key=lambda r: (r[0], r[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without what a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def periodic_runs(docs: DataFrame, rule: RunRule = RunRule(), prepare: Prepare | None = None) -> DataFrame:
    """``docs`` with the runs of each whole text and the text that is left when each run keeps its first period.

    Adds n_words, runs (structs of start, length and period, by start, then period) and collapsed (kept words joined by
    one space); existing columns of these names are replaced, all others stay. Words are runs of anything but ASCII
    white space. A null, empty or blank text has no words, no runs and an empty collapsed text. Rows are handled one
    by one, so repeated rows are all returned; there is no shuffle. ``prepare(doc_id, words)`` can change the
    words first; a null doc_id reaches it as None. Memory is bounded by the longest text.
    """

    @F.pandas_udf("n_words long, start array<long>, length array<long>, period array<long>, collapsed string")
    def scan(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, texts in batches:
            rows = []
            for number, text in zip(ids, texts):
                words = byte_words(text)
                if prepare is not None:
                    words = prepare(None if number is None else int(number), words)
                runs = find_runs(numbered(words), rule)
                left = b" ".join(collapse(words, runs)).decode()
                rows.append((len(words), *([r[k] for r in runs] for k in range(3)), left))
            yield pd.DataFrame(rows, columns=["n_words", "start", "length", "period", "collapsed"])

    own = docs.select(whole_row(docs))
    # As text, so that ids beyond the integers of a double stay exact beside nulls.
    found = own.select("doc", scan(F.col("doc.doc_id").cast("string"), F.col("doc.text")).alias("r"))
    runs = F.transform(F.arrays_zip("r.start", "r.length", "r.period"), lambda z: F.struct(
        z["start"].alias("start"), z["length"].alias("length"), z["period"].alias("period")
    ))
    added = {"n_words": F.col("r.n_words"), "runs": runs, "collapsed": F.col("r.collapsed")}
    return found.select(*fields(docs, *added), *[c.alias(n) for n, c in added.items()])
