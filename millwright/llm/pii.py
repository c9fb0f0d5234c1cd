"""Personal data in whole texts: exact rules, and a character tagger trained from labelled spans.

The rules give the base spans. Windows around them, from a bounded sample of the texts, are the labelled spans that
the tagger is trained on, some of them rewritten to other spellings of the same datum. Windows without any span hold
the digits that are not personal: versions, keys, years.

Every window of a text that holds a digit or an @ is scored; no datum of the four kinds is without one. Windows
overlap by half. Their tag scores are averaged, weighted towards the middle of each window, and each maximal stretch
of windows is decoded once, so a datum on a window's edge gets one consistent answer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.tagger import PAD, Tagger, classes, train
from millwright.session import materialize

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 64, 32
CONTEXT = 24
#: At most so many labelled windows for each kind, and twice as many without a span.
LABELLED_WINDOWS = 200
WINDOWS_AT_ONCE = 2048
MIN_CONFIDENCE = 0.9

#: The base patterns, in forms that take linear time on any text.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")

SPAN = "array<struct<kind: string, start: int, end: int, base: boolean>>"


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        # What was read once needs no second look: it ends before this @.
        done = found.end() if found else at + 1
        if found:
            yield start, done
        at = text.find("@", done)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for run in _DOTTED.finditer(text):
        parts, at = run[0].split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + len(".".join(four))
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                yield at, end
            at = end + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by start and kind, of all base spans of a whole text."""
    if not _TRIGGER.search(text):
        return []
    spans = [(a, 0, b) for a, b in _emails(text)] + [(a, 1, b) for a, b in _ips(text)]
    for found in _CARD.finditer(text):
        digits = _digits(found[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((found.start(), 2, found.end()))
    for found in _PHONE.finditer(text):
        if 10 <= len(_digits(found[0])) <= 15:
            spans.append((found.start(), 3, found.end()))
    return sorted(spans)


def plausible(kind: int, text: str) -> bool:
    """What a span of the tagger must satisfy besides its confidence."""
    digits = _digits(text)
    if kind == 0:
        return re.fullmatch(r"\S+@\S+", text) is not None
    if kind == 1:
        parts = re.split(r"[.:]", text)
        return len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits) and re.fullmatch(r"[0-9][0-9 .-]+[0-9]", text) is not None
    return 10 <= len(digits) <= 15 and re.fullmatch(r"[+(]?[0-9][ ()./0-9-]+[0-9]", text) is not None and not digits == text


# Training


def labelled_windows(text: str) -> Iterator[tuple[str, str, list[tuple[int, int, int]]]]:
    """(label, chunk, spans in it) around each span, and around other digits; chunks have at most WINDOW characters."""
    spans = base_spans(text)
    done = 0
    for start, kind, end in spans:
        if start < done or end - start > WINDOW - 8:
            continue
        lo = max(done, start - CONTEXT)
        hi = min(len(text), lo + WINDOW)
        if end > hi:
            continue
        inside = [(a - lo, k, b - lo) for a, k, b in spans if a >= lo and b <= hi]
        yield KINDS[kind], text[lo:hi], inside
        done = hi
    at = 0
    for found in _TRIGGER.finditer(text):
        if found.start() < at:
            continue
        lo, hi = max(0, found.start() - CONTEXT), min(len(text), found.start() - CONTEXT + WINDOW)
        at = found.start() + WINDOW
        if not any(a < hi and b > lo for a, _, b in spans):
            yield "none", text[lo:hi], []


def _respell(kind: int, text: str, way: int) -> str:
    """Another spelling of the same datum; way 0 keeps it."""
    digits = _digits(text)
    if kind == 3 and way and len(digits) >= 10:
        area, middle, rest = digits[-10:-7], digits[-7:-4], digits[-4:]
        return [f"({area}) {middle}-{rest}", f"{area}-{middle}-{rest}", f"{area}.{middle}.{rest}", f"+{digits[:-10]} {area} {middle} {rest}"][way - 1]
    if kind == 2 and way in (1, 2) and len(digits) == 16:
        return " -"[way - 1].join(digits[i : i + 4] for i in range(0, 16, 4))
    if kind == 0 and way == 1:
        return text.split("@")[0] + "@localhost"
    return text


def examples(windows: list[tuple[str, list[tuple[int, int, int]]]], seed: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Character classes and tags of the windows: each as it is, and those with spans once more respelled."""
    rng = np.random.default_rng(seed)
    xs, ys = [], []

    def add(text: str, spans: list[tuple[int, int, int]]) -> None:
        x, y = np.full(WINDOW, PAD), np.zeros(WINDOW, np.int64)
        found = classes(text[:WINDOW])
        x[: len(found)] = found
        for start, kind, end in spans:
            if end <= WINDOW:
                y[start:end] = 2 * kind + 2
                y[start] = 2 * kind + 1
        xs.append(x), ys.append(y)

    for text, spans in windows:
        add(text, spans)
        apart = all(a[2] <= b[0] for a, b in zip(spans, spans[1:]))
        if spans and apart:
            out, moved, at = "", [], 0
            for start, kind, end in spans:
                out += text[at:start]
                new = _respell(kind, text[start:end], int(rng.integers(1, 5)))
                moved.append((len(out), kind, len(out) + len(new)))
                out, at = out + new, end
            add(out + text[at:], moved)
    return np.stack(xs), np.stack(ys)


def fit_tagger(docs: DataFrame, labelled: int = LABELLED_WINDOWS) -> Tagger | None:
    """Train on at most ``labelled`` windows of each kind, and twice as many without a span, by smallest hash.

    Windows are cut where the texts are; only the sample comes to the driver. None if no text holds a base span.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (label, chunk, ",".join(f"{a}:{k}:{b}" for a, k, b in spans))
                for text in batch.text if text and _TRIGGER.search(text) for label, chunk, spans in labelled_windows(text)
            ]
            yield pd.DataFrame(rows, columns=["label", "chunk", "spans"])

    windows = docs.select("text").where(F.col("text").rlike("[0-9@]")).mapInPandas(cut, "label string, chunk string, spans string")
    windows = materialize(windows)
    parts = [
        windows.where(F.col("label") == label).distinct().orderBy(F.xxhash64("chunk"), "chunk").limit(labelled * (2 if label == "none" else 1))
        for label in (*KINDS, "none")
    ]
    rows = reduce(DataFrame.unionByName, parts).orderBy("label", F.xxhash64("chunk"), "chunk").collect()
    if not any(r.spans for r in rows):
        return None
    sample = [(r.chunk, [tuple(map(int, s.split(":"))) for s in r.spans.split(",") if s]) for r in rows]
    return train(*examples(sample), tags=2 * len(KINDS) + 1)


# Decoding


def stretches(text: str) -> list[tuple[int, int]]:
    """First window and one past the last, of each run of windows in which a digit or an @ stands."""
    hit: list[int] = []
    for found in _TRIGGER.finditer(text):
        w = found.start() // STRIDE
        for k in (w - 1, w):
            if k >= 0 and (not hit or k > hit[-1]):
                hit.append(k)
    runs = []
    for _, group in groupby(enumerate(hit), lambda p: p[1] - p[0]):
        numbers = [k for _, k in group]
        runs.append((numbers[0], numbers[-1] + 1))
    return runs


_NEAR_MIDDLE = (np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)) / (WINDOW / 2)).astype(np.float32)


def tagged_spans(texts: list[str], tagger: Tagger) -> list[list[tuple[int, int, int]]]:
    """Spans the tagger finds in each text, whatever the rules say."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    jobs = [(i, first, last) for i, text in enumerate(texts) for first, last in stretches(text)]
    held, size = [], 0
    for n, job in enumerate(jobs):
        held.append(job)
        size += job[2] - job[1]
        if size >= WINDOWS_AT_ONCE or n == len(jobs) - 1:
            _decode(texts, held, tagger, out)
            held, size = [], 0
    return out


def _decode(texts: list[str], jobs: list[tuple[int, int, int]], tagger: Tagger, out: list[list[tuple[int, int, int]]]) -> None:
    pieces = [texts[i][first * STRIDE : (last + 1) * STRIDE] for i, first, last in jobs]
    windows = []
    for (_, first, last), piece in zip(jobs, pieces):
        x = np.full((last - first + 1) * STRIDE, PAD)
        x[: len(piece)] = classes(piece)
        windows += [x[k * STRIDE : k * STRIDE + WINDOW] for k in range(last - first)]
    x = np.stack(windows)
    scores = np.concatenate([tagger.scores(x[lo : lo + 512]) for lo in range(0, len(x), 512)])
    at = 0
    for (i, first, last), piece in zip(jobs, pieces):
        total = np.zeros(((last - first + 1) * STRIDE, tagger.tags), np.float32)
        weight = np.zeros(len(total), np.float32)
        for k in range(last - first):
            total[k * STRIDE : k * STRIDE + WINDOW] += scores[at + k] * _NEAR_MIDDLE[:, None]
            weight[k * STRIDE : k * STRIDE + WINDOW] += _NEAR_MIDDLE
        at += last - first
        mean = (total / weight[:, None])[: len(piece)]
        if not (mean.argmax(axis=1) > 0).any():
            continue
        tags = tagger.decode(mean)
        sure = np.exp(mean - mean.max(axis=1, keepdims=True))
        sure = (sure / sure.sum(axis=1, keepdims=True))[np.arange(len(tags)), tags]
        t = 0
        while t < len(tags):
            tag, start = int(tags[t]), t
            t += 1
            if tag == 0:
                continue
            kind = (tag - 1) // 2
            while t < len(tags) and tags[t] == 2 * kind + 2:
                t += 1
            if sure[start:t].mean() >= MIN_CONFIDENCE and plausible(kind, piece[start:t]):
                out[i].append((first * STRIDE + start, kind, first * STRIDE + t))


def find_all(texts: list[str | None], tagger: Tagger | None) -> list[list[tuple[int, int, int, bool]]]:
    """(start, kind, end, base) per text: all base spans, and those of the tagger that touch none of them."""
    whole = [t or "" for t in texts]
    base = [base_spans(t) for t in whole]
    added = tagged_spans(whole, tagger) if tagger else [[] for _ in whole]
    out = []
    for rules, more in zip(base, added):
        spans = [(*s, True) for s in rules]
        spans += [(*s, False) for s in more if not any(s[0] < b and a < s[2] for a, _, b in rules)]
        out.append(sorted(spans))
    return out


def find_pii(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``docs`` with the added column spans: kind, start, end (code points, end exclusive), base; by start, then kind.

    A null or empty text has none. Rows are independent, so repeated rows, null ids and empty tables need no care; an
    existing column of that name is replaced.
    """

    @F.pandas_udf(SPAN)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = find_all(batch.tolist(), tagger)
            yield pd.Series([[{"kind": KINDS[k], "start": a, "end": b, "base": base} for a, k, b, base in row] for row in found])

    own = [F.col(f"`{c}`") for c in docs.columns if c != "spans"]
    return docs.select(*own, spans(F.col("text")).alias("spans"))


def mask(text: str | None, spans: list[tuple[int, int, int, bool]]) -> str | None:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first names all."""
    if not spans:
        return text
    out, at, shown = [], 0, -1
    for start, kind, end, _ in spans:
        if start >= shown:
            out += [text[at:start], f"[{KINDS[kind]}]"]
            at = shown = end
        else:
            at = shown = max(shown, end)
    return "".join([*out, text[at:]])


def mask_pii(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``docs`` with every span of its texts masked; all columns and rows stay."""

    @F.pandas_udf("string")
    def masked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = batch.tolist()
            yield pd.Series([mask(t, s) for t, s in zip(texts, find_all(texts, tagger))], dtype=object)

    return docs.withColumn("text", masked(F.col("text")))
