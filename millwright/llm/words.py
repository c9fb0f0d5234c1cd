"""Small helpers on whole texts shared by the operators of this package."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The ASCII white space that separates words, and the two alphabets of the lower-casing.
SPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SPACES = re.compile(r"\s\s")


def byte_words(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, as UTF-8 (``bytes.split`` knows exactly those six characters)."""
    return text.encode().split() if text else []


def spans_of(words: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by single spaces, with every word's start and end in it."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    return b" ".join(words), ends - lengths, ends


def chunks(n: int, size: int) -> Iterator[tuple[int, int]]:
    for start in range(0, n, size):
        yield start, min(n, start + size)


def pieces_of(text: str) -> tuple[str, list[str]] | None:
    """A text cut before each space and line break, for pre-tokenisers that start a new piece at both.

    Returns the first part and the rest; a part that begins with a line break stands for itself, any other for a
    space and itself. None if white space meets white space: then a piece can reach over such a place.
    """
    if SPACES.search(text):
        return None
    first, *rest = text.replace("\n", " \n").split(" ")
    return first, rest


def spelled(part: str) -> str:
    return part if part[:1] == "\n" else " " + part


def whole_row(df: DataFrame) -> Column:
    """All columns in one struct named doc, out of the way of columns that an operator adds."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc")


def fields(df: DataFrame, *without: str) -> list[Column]:
    """The columns of ``df`` out of its ``whole_row``, but for some."""
    return [F.col("doc").getField(c).alias(c) for c in df.columns if c not in without]
