"""Lexical retrieval packing: documents share a window with documents that BM25 finds close to them.

Documents are tokenised once and stored as ids. A locality key (the least hash of their token runs) brings likely
neighbours together; the rows are range-partitioned by it, so that a group of copies of any size is spread over as
many index shards as it needs. Each shard builds its own inverted index and packs its own documents.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from public_tokenizers import PATTERN

from millwright.llm.words import SPACES
from millwright.session import materialize

WINDOW = 1024
END_ID = 0
SHARD_TOKENS = 2_000_000
#: What a document counts in a shard besides its tokens: it bounds the documents that a query of the index looks at.
DOCUMENT_COST = 128
QUERY_TERMS = 24
K1, B = 1.2, 0.75
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class TokenIds:
    """Ids of the byte-level BPE in a ``tokenizers`` file.

    The file's vocabulary is in merge order, so it is also a rank table, and a rank encoder gives the library's own
    ids in a quarter of its time (the tests hold both against each other). The pattern's look-ahead only matters
    where white space meets white space; other texts take the pattern without it, which is searched faster.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        of_char = {c: b for b, c in enumerate(_byte_chars())}
        ranks = {bytes(map(of_char.__getitem__, t)): i for t, i in vocabulary.items() if t != "<|endoftext|>"}
        plain = PATTERN.replace(r"\s+(?!\S)|\s+", r"\s+")
        self.full, self.plain = (
            tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            for name, pattern in (("full", PATTERN), ("plain", plain))
        )

    def encode(self, text: str) -> list[int]:
        return (self.full if SPACES.search(text) else self.plain).encode_ordinary(text)


def _byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


@lru_cache(maxsize=2)
def token_ids(path: str) -> TokenIds:
    """One for each worker process; the vocabulary file is at the same path on every machine."""
    return TokenIds(path)


def _locality(ids: np.ndarray, run: int = 5) -> int:
    """The least hash over all runs of ids: equal for copies, mostly equal for near copies."""
    mixed = ids[: max(1, len(ids) - run + 1)].astype(np.uint64)
    for i in range(1, min(run, len(ids))):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) ^ ids[i : i + len(mixed)]
    mixed = mixed * np.uint64(0xBF58476D1CE4E5B9)
    return int((mixed ^ (mixed >> np.uint64(31))).min() >> np.uint64(1))


def tokenised(text: Column, path: str) -> Column:
    """Struct of ids (compact bytes, see ``_narrow``), n and locality.

    A document is its text's ids and the end id; a null text is empty, so it is the end id alone.
    """

    @F.pandas_udf("ids binary, n long, locality long")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = token_ids(path).encode
        for batch in batches:
            rows = []
            for text in batch:
                found = encode(text or "")
                found.append(END_ID)
                ids = np.array(found, "<u4")
                rows.append((_narrow(ids), len(ids), _locality(ids)))
            yield pd.DataFrame(rows, columns=["ids", "n", "locality"])

    return apply(text)


def _narrow(ids: np.ndarray) -> bytes:
    """A first byte of 2 or 4, and the ids in as many bytes each."""
    return b"\x02" + ids.astype("<u2").tobytes() if int(ids.max()) < 1 << 16 else b"\x04" + ids.astype("<u4").tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype("<u4")


class Bm25:
    """Inverted index of one shard over token ids. Weights are final, so a query adds up postings.

    A shard holds about ``SHARD_TOKENS`` tokens, or one document if that is longer, and at most
    2 * ``SHARD_TOKENS`` / ``DOCUMENT_COST`` documents, however short.
    """

    def __init__(self, docs: list[np.ndarray]):
        n = len(docs)
        lengths = np.fromiter(map(len, docs), np.int64, n)
        tokens = np.concatenate(docs)
        bits = int(tokens.max()).bit_length()
        small = n.bit_length() + bits <= 32
        pairs = np.repeat(np.arange(n, dtype=np.uint32 if small else np.uint64) << bits, lengths) | tokens
        pairs.sort()
        starts = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
        counts = np.diff(np.append(starts, len(pairs)))
        doc, self.term = (pairs[starts] >> bits).astype(np.int64), (pairs[starts] & ((1 << bits) - 1)).astype(np.int64)
        df = np.bincount(self.term, minlength=1 << bits)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lengths / lengths.mean())
        self.weight = idf[self.term] * counts * (K1 + 1) / (counts + norm[doc])
        self.start = np.searchsorted(doc, np.arange(n + 1))
        by_term = np.argsort(self.term.astype(np.uint16) if bits <= 16 else self.term, kind="stable")
        self.posting_doc, self.posting_weight = doc[by_term], self.weight[by_term]
        self.term_start = np.concatenate([[0], np.cumsum(df)])
        self.n = n

    def neighbours(self, doc: int, used: np.ndarray, most: int) -> np.ndarray:
        """Unused documents by falling score for the document's strongest terms, ties by position."""
        own = slice(self.start[doc], self.start[doc + 1])
        terms, weights = self.term[own], self.weight[own]
        if len(terms) > QUERY_TERMS:
            terms = terms[np.argpartition(-weights, QUERY_TERMS)[:QUERY_TERMS]]
        lists = [slice(a, b) for a, b in zip(self.term_start[terms].tolist(), self.term_start[terms + 1].tolist())]
        found = np.concatenate([self.posting_doc[x] for x in lists])
        scores = np.bincount(found, np.concatenate([self.posting_weight[x] for x in lists]), self.n)
        scores[used] = 0
        near = np.flatnonzero(scores > 0)
        if len(near) > most:
            cut = np.partition(scores[near], len(near) - most)[len(near) - most]
            near = near[scores[near] >= cut]
        return near[np.argsort(-scores[near], kind="stable")][:most]


def pack_order(docs: list[np.ndarray], window: int = WINDOW) -> Iterator[int]:
    """The order in which a shard's documents are laid into windows: seeds, each followed by its neighbours.

    A seed's neighbours follow while they start in the seed's window; the document that crosses the window's end is
    cut there, and the next seed is found from it. Without an unused neighbour the next document in order is it.
    """
    index, used, filled, following = Bm25(docs), np.zeros(len(docs), bool), 0, 0
    seed = 0
    while seed is not None:
        used[seed] = True
        yield seed
        filled = (filled + len(docs[seed])) % window
        room, last = window - filled, seed
        for near in index.neighbours(seed, used, 32).tolist():
            if room <= 0:
                break
            used[near] = True
            yield near
            filled = (filled + len(docs[near])) % window
            room -= len(docs[near])
            last = near
        nearest = index.neighbours(last, used, 1) if last != seed else np.empty(0, np.int64)
        if len(nearest):
            seed = int(nearest[0])
            continue
        while following < len(docs) and used[following]:
            following += 1
        seed = following if following < len(docs) else None


def _pack(window: int, shard_tokens: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sequence = TaskContext.get().partitionId() << 33
        ids, docs, offset = [], [], 0

        def packed() -> pa.RecordBatch:
            nonlocal sequence, offset
            rows = []
            for k in pack_order(docs, window):
                start, total = 0, len(docs[k])
                while start < total:
                    length = min(window - offset, total - start)
                    crc = zlib.crc32(docs[k][start : start + length].tobytes())
                    rows.append((ids[k], start, length, crc, total, sequence, offset))
                    start, offset = start + length, offset + length
                    if offset == window:
                        sequence, offset = sequence + 1, 0
            ids.clear(), docs.clear()
            return pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=[f.split()[0] for f in PIECES.split(", ")]).astype({"doc_id": "Int64"}), preserve_index=False)

        held = 0
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id), docs.append(_wide(data))
                held += len(docs[-1]) + DOCUMENT_COST
                if held >= 2 * shard_tokens:  # an uneven range: another index, which goes on in the open window
                    yield packed()
                    held = 0
        if docs:
            yield packed()

    return pack


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of ``docs`` is packed whole; a null or empty text is the end id alone. Repeated rows and null ids are
    packed like others, an empty table gives no rows, other columns are ignored. Only a shard's last window can be
    short. ``sequence_id`` is the shard's number and a count within it.
    """
    token = tokenised(F.col("text"), tokenizer).alias("t")
    stored = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), token).select("doc_id", "t.*"))
    total = stored.agg(F.sum(F.col("n") + DOCUMENT_COST)).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))
    near = stored.repartitionByRange(shards, "locality", F.xxhash64("doc_id", "n"), "doc_id")
    ordered = near.sortWithinPartitions("locality", F.xxhash64("doc_id", "n"), "doc_id", "ids")
    return ordered.select("doc_id", "ids").mapInArrow(_pack(window, shard_tokens), PIECES)
