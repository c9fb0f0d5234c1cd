"""Byte-level BPE encoding and decoding by merge ranks.

One pre-token is merged with a segment tree over its byte positions. A leaf holds the rank of the pair that starts
there; an inner node holds the smallest rank below it, the leftmost on ties. Each merge takes the root, joins two
live neighbours and updates the two pairs it touches, each in logarithmic time, so a pre-token of a million letters
is no trouble.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from millwright.llm.words import pieces_of, spelled

NONE = 1 << 62
#: Latin letters, then ASCII signs, perhaps after a line break.
_WORD = re.compile(r"(\n?)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\[-`{-~]*)")
CACHED = 300_000
LONG_BYTES = 128
ROWS_AT_ONCE = 4096
CHARS_AT_ONCE = 4_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Merge ranks: one line for each token, its bytes in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    shift = n.bit_length()
    place = (1 << shift) - 1
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    get = ranks.get
    # rank << shift | position: the minimum is the smallest rank, leftmost on ties.
    tree = [NONE] * (2 * size)
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank << shift | i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (low := tree[1]) != NONE:
        i = low & place
        gone = after[i]
        follows = after[gone]
        after[i] = follows
        # The merged pair, the one that started at the swallowed neighbour, and the one that ends in the new token.
        changes = []
        if follows < n:
            before[follows] = i
            rank = get(piece[i : after[follows]])
            changes.append((gone, NONE))
            changes.append((i, NONE if rank is None else rank << shift | i))
        else:
            changes.append((i, NONE))
        left = before[i]
        if left >= 0:
            rank = get(piece[left:follows])
            changes.append((left, NONE if rank is None else rank << shift | left))
        for at, value in changes:
            k = size + at
            if tree[k] == value:
                continue
            tree[k] = value
            while k > 1:
                other = tree[k ^ 1]
                if other < value:
                    value = other
                k >>= 1
                if tree[k] == value:
                    break
                tree[k] = value
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Merger:
    """``merge`` for many short pre-tokens at once: one segment tree per row of an array, all rows step together."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.keys = np.fromiter(sorted(pairs), np.int64, len(pairs))
        self.values = np.fromiter((pairs[k] for k in self.keys.tolist()), np.int64, len(pairs))
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def _values(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaves for adjacent tokens: rank and position, or NONE."""
        key = left << 32 | right
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[found] == key, self.values[found] << 8 | at, NONE)

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each pre-token of 2 to LONG_BYTES bytes."""
        out: list[bytes] = [b""] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        levels = np.ceil(np.log2(np.maximum(2, lengths - 1))).astype(int)
        for level in np.unique(levels).tolist():
            rows = np.flatnonzero(levels == level)
            for lo in range(0, len(rows), ROWS_AT_ONCE):
                part = rows[lo : lo + ROWS_AT_ONCE]
                for k, ids in zip(part.tolist(), self._merge([pieces[k] for k in part.tolist()], lengths[part], level)):
                    out[k] = ids
        return out

    def _merge(self, pieces: list[bytes], lengths: np.ndarray, level: int) -> list[bytes]:
        rows, size = len(pieces), 1 << level
        width = size + 1
        data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(rows, width)
        at = np.arange(width)
        ids, alive = self.single[data], at < lengths[:, None]
        after, before = np.tile(at + 1, (rows, 1)).ravel(), np.tile(at - 1, (rows, 1)).ravel()
        tree = np.full((rows, 2 * size), NONE, np.int64)
        tree[:, size:] = np.where(alive[:, 1:], self._values(ids[:, :-1], ids[:, 1:], at[:-1]), NONE)
        for d in range(level - 1, -1, -1):
            below = tree[:, 2 << d : 4 << d]
            tree[:, 1 << d : 2 << d] = np.minimum(below[:, ::2], below[:, 1::2])
        # From here on flat: a row's positions begin at r * width, its tree nodes at r * 2 * size.
        ids, alive, tree = ids.ravel(), alive.ravel(), tree.ravel()
        r = np.arange(rows)
        while True:
            low = tree.take(r * (2 * size) + 1)
            open_rows = low != NONE
            if not open_rows.all():
                r, low = r[open_rows], low[open_rows]
            if not len(r):
                break
            base, root = r * width, r * (2 * size)
            i = low & 255
            gone = after.take(base + i)
            follows = after.take(base + gone)
            token = low >> 8
            ids[base + i], alive[base + gone], after[base + i] = token, False, follows
            more = follows < lengths.take(r)
            before[(base + follows)[more]] = i[more]
            right = np.where(more, self._values(token, ids.take(base + np.minimum(follows, width - 1)), i), NONE)
            left = before.take(base + i)
            first = left < 0
            left = np.where(first, i, left)
            leftward = np.where(first, right, self._values(ids.take(base + left), token, left))
            # The last position starts no pair and has no leaf; its write goes to a leaf that is written next.
            leaves = np.concatenate([np.where(gone >= size, i, gone), i, left]) + size + np.tile(root, 3)
            tree[leaves] = np.concatenate([np.full(len(r), NONE), right, leftward])
            node, root = leaves - np.tile(root, 3), np.tile(root, 3)
            for _ in range(level):
                node >>= 1
                child = root + 2 * node
                tree[root + node] = np.minimum(tree.take(child), tree.take(child + 1))
        packed = ids[alive].astype("<u4").tobytes()
        ends = np.cumsum(alive.reshape(rows, width).sum(axis=1) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]


class Bpe:
    """Encoder and decoder for one rank file. Words and pieces that recur are looked up, in caches of bounded size.

    Ids are handed on as machine integers in bytes, four for each id.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.tokens = {i: t for t, i in ranks.items()}
        self.merger = Merger(ranks)
        self.pieces: dict[str, bytes] = {}
        self.names = [str(i) for i in range(max(self.tokens) + 1)]
        # Parts met since the last change of generation, and those of the generation before.
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _cut(self, part: str) -> list[str]:
        """Pieces of one part. Its commonest shape, letters and then signs, needs no search."""
        simple = _WORD.fullmatch(part)
        if simple is None:
            return self.find(spelled(part))
        start, letters, signs = simple.groups()
        pieces = ["\n", letters] if start else [" " + letters]
        if signs:
            pieces.append(signs)
        return pieces

    def _learn(self, pieces: Iterable[str]) -> None:
        """Put pieces that are new into the cache."""
        new = [p for p in set(pieces) if p not in self.pieces]
        if len(self.pieces) + len(new) > CACHED:
            self.pieces = {}
            new = list(set(pieces))
        many = []
        for piece in new:
            data = piece.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                self.pieces[piece] = _pack([whole])
            elif len(data) > LONG_BYTES:
                self.pieces[piece] = _pack(merge(data, self.ranks))
            else:
                many.append((piece, data))
        self.pieces.update(zip([p for p, _ in many], self.merger.merge_all([d for _, d in many])))

    def _search(self, text: str) -> bytes:
        pieces = self.find(text)
        self._learn(pieces)
        return b"".join(map(self.pieces.__getitem__, pieces))

    def _encode_some(self, texts: list[str]) -> Iterator[array]:
        cuts = [pieces_of(t) for t in texts]
        absent = {p for cut in cuts if cut for p in cut[1]}.difference(self.parts)
        new = []
        for part in absent:
            known = self.older.get(part)
            if known is None:
                new.append(part)
            else:
                self.parts[part] = known
        for lo in range(0, len(new), CACHED // 8):
            words = [(p, self._cut(p)) for p in new[lo : lo + CACHED // 8]]
            self._learn([p for _, pieces in words for p in pieces])
            known = self.pieces.__getitem__
            self.parts.update((p, b"".join(map(known, pieces))) for p, pieces in words)
        for text, cut in zip(texts, cuts):
            if cut is None:
                yield array("I", self._search(text))
            else:
                yield array("I", self._search(cut[0]) + b"".join(map(self.parts.__getitem__, cut[1])))
        if len(self.parts) > CACHED:
            self.parts, self.older = {}, self.parts

    def encode_all(self, texts: Iterable[str]) -> Iterator[array]:
        """Ids of whole texts, in order. Texts are taken together up to CHARS_AT_ONCE, so new words meet in one merge."""
        held, chars = [], 0
        for text in texts:
            held.append(text)
            chars += len(text)
            if chars >= CHARS_AT_ONCE:
                yield from self._encode_some(held)
                held, chars = [], 0
        yield from self._encode_some(held)

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text])).tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _pack(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Bpe:
    """One encoder for each worker process; the vocabulary file is at the same path on every machine."""
    return Bpe(read_ranks(path), pattern)


def per_text(text: Column, path: str, pattern: str, schema: str, make: Callable[[Bpe, array], tuple]) -> Column:
    """A struct column made from the encoder and the ids of each whole text (null: empty).

    The pattern must start a new piece at a single space or line break between other characters, as those of the
    public vocabularies do.
    """

    @F.pandas_udf(schema)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = encoder(path, pattern)
        names = [field.split()[0] for field in schema.split(", ")]
        for batch in batches:
            rows = [make(bpe, ids) for ids in bpe.encode_all(t or "" for t in batch)]
            yield pd.DataFrame(rows, columns=names)

    return apply(text)


def encoded(text: Column, path: str, pattern: str) -> Column:
    """Token ids of every text; an array, empty for a null or empty text."""
    return per_text(text, path, pattern, "ids array<int>", lambda bpe, ids: (ids.tolist(),))["ids"]


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """Bytes of every id array (null: none). Unknown ids are an error."""

    @F.pandas_udf("binary")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = encoder(path, pattern)
        for batch in batches:
            yield pd.Series([bpe.decode([] if x is None else x) for x in batch], dtype=object)

    return apply(ids)


def _digest(bpe: Bpe, ids: array) -> tuple[int, str, str]:
    joined = ",".join(map(bpe.names.__getitem__, ids)).encode()
    return len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """n_tokens, ids_sha256 and decoded_sha256: each text encoded, its ids decoded again, both in one pass."""
    return per_text(text, path, pattern, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digest)
