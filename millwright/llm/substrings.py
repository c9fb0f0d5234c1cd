"""Removal of byte strings that stand earlier, across all documents, by suffix arrays of shards.

Every string of ``length`` bytes has a minimizer: its leftmost substring of a quarter of the length whose hash is
smallest. Equal strings have equal minimizers at equal places, so strings with one minimizer can be compared apart
from all others. Neighbouring strings with the same minimizer form one segment, and a row stands for each segment:

1. Rows meet by minimizer. Of equal segments only the first in (document, place) stays; all bytes of the others go.
   Strings that two other segments share hold the minimizer and at least half of the other bytes on one side of it. So
   a segment holds nothing else that repeats, unless another one of its minimizer has the same bytes on one side; these
   are told by a byte of hash for each side, which can only let too many segments through.
2. The remaining segments are cut out of the texts and dealt to shards by minimizer. A shard's text lies on the disk of
   its task; its suffixes are sorted by external induction with their common prefixes (``induced``). Neighbours that share
   ``length`` bytes are equal strings: the first stays, the bytes of the others go.
3. The places to remove return to the documents, one row per stretch.

Segments that repeat inside a batch of documents are settled before any shuffle, so a passage in a third of all
documents sends one row per batch. Substrings that many documents of a sample share are made minimizers only where a
string has no other, so that such a phrase in ever other surroundings does not draw all of them into one shard. Which
substrings these are changes the grouping, not the result.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.induced import DiskList, SuffixSorter
from millwright.llm.words import fields, whole_row
from millwright.operators.ordering import row_index
from millwright.session import materialize

PIECE_BYTES = 1 << 20
CUT_BYTES = 1 << 17  # a piece whose hashes stay in the processor's cache
SAMPLE = 64
COMMON_SHARE = 500
COMMON_LEAST = 20
COMMON_KEPT = 100_000
SHARD_ROWS = 60_000
HELD_ROWS = 1 << 16
_RANDOM = np.random.default_rng(13)
_BYTES = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _RANDOM.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

Piece = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def rolling_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every substring of ``size`` bytes, from hashes of lengths that are powers of two."""
    power, level, length, done, out = _BYTES[data], 0, 1, 0, None
    n = len(data) - size + 1
    while True:
        if size & length:
            part = power[done : done + n]
            out = part if out is None else out * _FACTORS[level] + part
            done += length
        if 2 * length > size:
            break
        power = power[:-length] * _FACTORS[level + 32] + power[length:]
        length, level = 2 * length, level + 1
    out = (out ^ (out >> np.uint64(31))) * _FACTORS[63]
    return out ^ (out >> np.uint64(29))


def window_minima(values: np.ndarray, size: int, bits: int) -> np.ndarray:
    """Place of the least value of every window, the leftmost of equals; the ``bits`` lowest bits do not count.

    They hold the place meanwhile.
    """
    mask, done = np.uint64((1 << bits) - 1), 1
    least = (values & ~mask) | np.arange(len(values), dtype=np.uint64)
    while done < size:
        step = min(done, size - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    return (least & mask).view(np.int64)


def _one_of(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the sorted known ones; a table over some bits settles most of the others."""
    if not len(known):
        return np.zeros(len(values), bool)
    table = np.zeros(1 << 20, bool)
    table[known >> np.uint64(44)] = True
    found = table[values >> np.uint64(44)]
    some = np.flatnonzero(found)
    near = np.minimum(np.searchsorted(known, values[some]), len(known) - 1)
    found[some] = known[near] == values[some]
    return found


def _sides(data: np.ndarray, first: np.ndarray, at: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """A byte for the left and a byte for the right of each segment's minimizer; 0 for a side that is too short.

    A string in the segment has ``length`` - ``size`` bytes beside the minimizer, hence at least ``half`` on one side.
    """
    size = max(1, length // 4)
    half = (length - size + 1) // 2
    if not half:
        return np.full(len(first), 0x0101, np.uint64)
    hashes = rolling_hashes(data, half)
    kinds = [(at - first >= half, at - half), (end - at - size >= half, at + size)]
    left, right = (
        np.where(long, hashes[np.clip(place, 0, len(hashes) - 1)] % np.uint64(255) + np.uint64(1), np.uint64(0)) for long, place in kinds
    )
    return (left << np.uint64(8)) | right


def _pieces(numbers: np.ndarray, texts: pa.Array, length: int, most: int | None = None) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Whole texts in pieces of about ``most`` bytes (PIECE_BYTES): bytes, and per text its number, first byte in the piece, and place there.

    A longer text comes in pieces that overlap, so that each string of ``length`` bytes begins in one of them.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = memoryview(texts.buffers()[2] or b"")
    most = most or PIECE_BYTES
    parts, size = [], 0
    for number, lo, hi in zip(numbers.tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
        for begin in range(lo, max(lo + 1, hi - length + 1), most):
            end = min(hi, begin + most + length - 1)
            if size and size + end - begin > most:
                yield _joined(parts, data)
                parts, size = [], 0
            parts.append((number, begin, end, begin - lo))
            size += end - begin
    if parts:
        yield _joined(parts, data)


def _joined(parts: list[tuple[int, int, int, int]], data: memoryview) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    rows = np.array(parts, np.int64)
    sizes = rows[:, 2] - rows[:, 1]
    return b"".join(data[b:e] for _, b, e, _ in parts), rows[:, 0], np.append(0, np.cumsum(sizes)), rows[:, 3]


def segments(numbers: np.ndarray, texts: pa.Array, length: int, common: np.ndarray) -> Iterator[dict[str, np.ndarray]]:
    """Rows of minimizer, content hash, document number, place and size for all segments of the texts.

    The minimizer stands in the upper 48 bits, the bytes of ``_sides`` below. The hashes in ``common`` (sorted) are chosen
    last.
    """
    size = max(1, length // 4)
    bits = (PIECE_BYTES + length).bit_length()  # the same for all pieces
    for data, docs, begins, places in _pieces(numbers, texts, length, min(CUT_BYTES, PIECE_BYTES)):
        if len(data) < length:
            continue
        bytes_ = np.frombuffer(data, np.uint8)
        hashes = rolling_hashes(bytes_, size)
        if len(common):
            hashes = (hashes >> np.uint64(1)) | (_one_of(hashes, common).astype(np.uint64) << np.uint64(63))
        at = window_minima(hashes, length - size + 1, bits)
        text = np.repeat(np.arange(len(docs)), np.diff(begins))[: len(at)]
        inside = np.arange(len(at)) + length <= begins[text + 1]
        change = np.ones(len(at), bool)
        change[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
        # A segment ends before the next one, or where no string of the text begins any more.
        cut = np.append(np.flatnonzero(change), len(at))
        first = cut[:-1][inside[cut[:-1]]]
        counts = np.append(0, np.cumsum(inside))
        width = (counts[cut[1:]] - counts[cut[:-1]])[inside[cut[:-1]]]
        end = first + width + length - 1
        digest = xxhash.xxh3_64_intdigest
        content = np.fromiter((digest(data[a:b]) for a, b in zip(first.tolist(), end.tolist())), np.uint64, len(first))
        minimizer = hashes[at[first]] & ~np.uint64(0xFFFF)
        yield {
            "m": (minimizer | _sides(bytes_, first, at[first], end, length)).view(np.int64), "c": content.view(np.int64), "doc": docs[text[first]],
            "pos": places[text[first]] + first - begins[text[first]], "size": end - first,
        }


SEGMENT = "m long, c long, doc long, pos long, size long, gone boolean"
SETTLED = "m long, doc long, pos long, size long, first boolean"
STRETCH = "doc long, start long, end long"


def _frame(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})


def _combined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Segments of a batch; those that repeat an earlier one of the batch are marked gone, and dealt by place."""
    col = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    order = np.argsort(col["c"])
    same = col["c"][order[1:]] == col["c"][order[:-1]]
    some = order[np.append(False, same) | np.append(same, False)]  # equal hashes: put these in order
    order = some[np.lexsort((col["pos"][some], col["doc"][some], col["m"][some], col["c"][some]))]
    same = (col["m"][order[1:]] == col["m"][order[:-1]]) & (col["c"][order[1:]] == col["c"][order[:-1]])
    gone = np.zeros(len(col["m"]), bool)
    gone[order[1:][same]] = True
    col["m"] = np.where(gone, ((col["doc"] << 20) ^ col["pos"]) << 16, col["m"])
    return {**col, "gone": gone}


def _segments(base: DataFrame, length: int) -> DataFrame:
    common = _common(base, length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy(zero_copy_only=False)
            parts = list(segments(numbers, batch.column(1).cast(pa.binary()), length, common))
            if parts:
                yield _frame(_combined(parts))

    return base.select("number", F.coalesce("text", F.lit(""))).mapInArrow(cut, SEGMENT)


def _common(base: DataFrame, length: int) -> np.ndarray:
    """Hashes of the substrings that more than a share of sampled documents hold: a bounded number of the commonest."""
    size = max(1, length // 4)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, docs, begins, _ in _pieces(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).cast(pa.binary()), length):
                if len(data) >= size:
                    hashes = rolling_hashes(np.frombuffer(data, np.uint8), size)
                    text = np.repeat(np.arange(len(docs)), np.diff(begins))[: len(hashes)]
                    order = np.lexsort((text, hashes))
                    hashes, text = hashes[order], text[order]
                    new = np.append(True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1]))
                    found, n = np.unique(hashes[new], return_counts=True)
                    # In a piece of few documents nothing tells a common substring; in one of many, two do.
                    held = n > max(1, len(docs) // (2 * COMMON_SHARE))
                    yield _frame({"h": found[held].view(np.int64), "n": n[held].astype(np.int64)})

    sample = base.where(F.pmod(F.xxhash64("number"), F.lit(SAMPLE)) == 0).select("number", F.coalesce("text", F.lit("")).alias("text"))
    docs = sample.count()
    counts = sample.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    often = counts.where(F.col("n") > max(COMMON_LEAST, docs / COMMON_SHARE)).orderBy(F.desc("n"), "h").limit(COMMON_KEPT)
    return np.sort(np.array([r.h for r in often.select("h").collect()], np.int64).view(np.uint64))


def _changes(values: np.ndarray) -> np.ndarray:
    return np.append(True, values[1:] != values[:-1])[: len(values)]


def _comparable(m: np.ndarray) -> np.ndarray:
    """Which of the different segments (sorted by ``m``) have a side like another one with the same minimizer."""
    out, group = np.zeros(len(m), bool), np.cumsum(_changes(m >> 16))
    for side in ((m >> 8) & 0xFF, m & 0xFF):
        at = np.flatnonzero(side)
        key = (group[at] << 8) | side[at]
        order = np.argsort(key, kind="stable")
        new = _changes(key[order])
        out[at[order[~(new & np.append(new[1:], True)[: len(new)])]]] = True
    return out


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted segments to those that repeat an earlier one, and the first ones that need a comparison.

    Holds the different segments of the last minimizer until the next one shows up; beyond ``HELD_ROWS`` all of that
    minimizer's are compared.
    """
    names = ("m", "doc", "pos", "size")
    held: dict[str, np.ndarray] | None = None
    last, whole = None, None  # minimizer and content of the last row; the minimizer of which all are compared

    def made(col: dict[str, np.ndarray], rows: np.ndarray, first: bool) -> pa.RecordBatch:
        out = {k: col[k][rows] for k in names}
        return _frame({**out, "m": out["m"] >> 16, "first": np.full(len(out["m"]), first)})

    for batch in batches:
        col = {k: batch.column(i).to_numpy(zero_copy_only=False) for i, k in enumerate(("m", "c", "doc", "pos", "size", "gone"))}
        gone = col.pop("gone")
        if gone.any():
            yield made(col, gone, False)
            col = {k: v[~gone] for k, v in col.items()}
        if not len(col["m"]):
            continue
        other = _changes(col["m"]) | _changes(col["c"])
        other[0] = last != (col["m"][0], col["c"][0])
        last = (col["m"][-1], col["c"][-1])
        yield made(col, ~other, False)
        col = {k: col[k][other] for k in names}
        if whole is not None:
            rest = (col["m"] >> 16) != whole
            yield made(col, ~rest, True)
            col = {k: v[rest] for k, v in col.items()}
        if held is not None:
            col = {k: np.concatenate([held[k], col[k]]) for k in names}
        if not len(col["m"]):
            continue
        minimizer = col["m"] >> 16
        ends = int(np.flatnonzero(_changes(minimizer))[-1])
        yield made(col, np.flatnonzero(_comparable(col["m"][:ends])), True)
        held, whole = {k: v[ends:] for k, v in col.items()}, None
        if len(held["m"]) > HELD_ROWS:
            yield made(held, np.arange(len(held["m"])), True)
            held, whole = None, minimizer[-1]
    if held is not None:
        yield made(held, np.flatnonzero(_comparable(held["m"])), True)


def _settled(base: DataFrame, length: int) -> DataFrame:
    """Segments to remove (first is false), and those to compare with others of their minimizer (true)."""
    parts = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _segments(base, length).repartition(parts, F.shiftright("m", 16)).sortWithinPartitions("m", "c", "doc", "pos")
    return materialize(dealt.mapInArrow(_settle, SETTLED))


def _bytes_of(lengths: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """begins[i], begins[i] + 1, ... for lengths[i] places, for all i in turn."""
    jump = begins - np.append(0, np.cumsum(lengths)[:-1])
    return np.repeat(jump, lengths) + np.arange(int(lengths.sum()))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their chosen segments to (m, doc, pos, the segment's bytes)."""
    for whole in batches:
        for lo in range(0, whole.num_rows, 1000):
            batch = whole.slice(lo, 1000)
            texts, lists = batch.column(1).cast(pa.binary()), batch.column(2)
            begin = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            counts = np.diff(lists.offsets.to_numpy())
            m, pos, size = (f.to_numpy(zero_copy_only=False) for f in lists.flatten().flatten())
            row = np.repeat(np.arange(len(counts)), counts)
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[_bytes_of(size, begin[row] + pos)]
            offsets = np.append(0, np.cumsum(size)).astype(np.int32)
            cut = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            numbers = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_pydict({"m": pa.array(m), "doc": pa.array(numbers[row]), "pos": pa.array(pos), "data": cut})


def _spelled(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The segments as one text, and the end of each in it: a byte is two more than itself, 1 ends a segment."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    ends = offsets[1:] - offsets[0] + np.arange(1, len(column) + 1)
    text = np.empty(len(data) + len(column), np.uint16)
    inside = np.ones(len(text), bool)
    inside[ends - 1] = False
    text[inside], text[ends - 1] = data.astype(np.uint16) + 2, 1
    return text, ends


def _mark_later(text: np.ndarray, folder: str, length: int) -> np.ndarray:
    """For each place whether the string that begins there begins at a smaller place too."""
    later = np.memmap(f"{folder}/later", np.uint8, "w+", shape=(len(text),))
    least = None  # the first place of the string at hand
    for at, prefix in SuffixSorter(text, 258, folder, length).descending():
        begins = prefix < length
        if least is None:
            begins[0] = True
        else:
            at, begins = np.append(least, at), np.append(True, begins)
        group = np.flatnonzero(begins)
        lowest = np.minimum.reduceat(at, group)
        # An earlier slice may have marked nothing yet where a smaller place turns up now.
        marks = at != np.repeat(lowest, np.diff(np.append(group, len(at))))
        later[at[marks]] = 1
        least = lowest[-1]
    return later


def _repeats(length: int):
    """Segments of a shard, by document and place, to the stretches whose bytes stand earlier in the shard."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:  # the scratch of one task, as that of Spark's own sorts
            text, docs, places, ends = DiskList(folder, np.uint16), DiskList(folder), DiskList(folder), DiskList(folder)
            for batch in batches:
                spelled, bounds = _spelled(batch.column(3))
                ends.append(bounds + text.size)
                text.append(spelled)
                docs.append(batch.column(1).to_numpy(zero_copy_only=False))
                places.append(batch.column(2).to_numpy(zero_copy_only=False))
            if not docs.size:
                return
            text.append(np.zeros(1))
            later = _mark_later(text.array(), folder, length)
            doc, place, end = docs.array(), places.array(), ends.array()
            begin = 0
            for lo in range(0, len(end), 4096):
                stop = np.array(end[lo : lo + 4096])
                flags = np.array(later[begin : stop[-1]])
                row = np.repeat(np.arange(len(stop)), np.diff(np.append(begin, stop)))
                # No string begins in the last places of a segment: they part the stretches of neighbours.
                flags[begin + np.arange(len(flags)) + length >= stop[row]] = 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], flags, [0]]).astype(np.int8)))
                first, past = edge[::2], edge[1::2]
                own = row[first]
                zero = np.append(begin, stop)[own] - begin
                at = np.array(place[lo : lo + 4096])[own]
                yield _frame({
                    "doc": np.array(doc[lo : lo + 4096])[own], "start": at + first - zero, "end": at + past - zero + length - 1,
                })
                begin = int(stop[-1])

    return sort


def _numbered(docs: DataFrame) -> DataFrame:
    """(number, text, doc): the doc_id if all are there and differ, else positions by doc_id and text."""
    rows, named, repeated = (
        docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
        .agg(F.sum("n"), F.count("doc_id"), F.count_if(F.col("n") > 1)).first()
    )
    base = docs.select(whole_row(docs), F.col("text").alias("text"))
    if rows == named and not repeated:
        return base.select(F.col("doc.doc_id").cast("long").alias("number"), "text", "doc")
    return materialize(row_index(base, [F.col("doc.doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("text")], "number").select("number", "text", "doc"))


def _apply(spans: Column, text: Column) -> Column:
    """Bytes of the text, the stretches joined where they meet, and the remaining bytes."""

    @F.pandas_udf("n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
    def apply(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, places in batches:
            out = []
            for text, found in zip(texts, places):
                data, joined = (text or "").encode(), []
                for p in sorted((p["start"], p["end"]) for p in (found if found is not None else ())):
                    if joined and p[0] <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], p[1])
                    else:
                        joined.append(list(p))
                edges = [0, *(e for span in joined for e in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(data), len(data) - len(kept), [{"start": a, "end": b} for a, b in joined], kept))
            yield pd.DataFrame(out, columns=["n_bytes", "n_removed", "spans", "kept"])

    return apply(text, spans)


def remove_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """``docs`` with n_bytes, n_removed, spans (structs of start and end, in bytes) and kept (the bytes left).

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document with a smaller
    doc_id, or in the same document at a smaller place. Strings are judged on the input, and never reach over the end of
    a document. ``docs`` needs doc_id and text; existing columns of the added names are replaced, others stay. A null
    or empty text has no bytes. Rows that share a doc_id are documents of their own, in the order of their texts' hashes;
    rows without doc_id come last. Of rows equal in both, one keeps its bytes. An empty table gives no rows.

    ``kept`` is binary, since a cut can fall inside a character.
    """
    base = _numbered(docs)
    settled = _settled(base, length)
    gone = settled.where("NOT first").select("doc", F.col("pos").alias("start"), (F.col("pos") + F.col("size")).alias("end"))
    compare = settled.where("first").groupBy(F.col("doc").alias("number")).agg(
        F.collect_list(F.struct("m", "pos", "size")).alias("chosen")  # bounded by the segments of one text
    )
    cut = base.join(compare, "number").select("number", F.coalesce("text", F.lit("")), "chosen").mapInArrow(_cut, "m long, doc long, pos long, data binary")
    spark = docs.sparkSession
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), settled.where("first").count() // SHARD_ROWS + 1)
    dealt = cut.repartition(shards, "m").sortWithinPartitions("doc", "pos")
    places = gone.unionByName(dealt.mapInArrow(_repeats(length), STRETCH))
    of_doc = places.groupBy(F.col("doc").alias("number")).agg(F.collect_list(F.struct("start", "end")).alias("_places"))
    joined = base.join(of_doc, "number", "left").select("doc", _apply(F.col("_places"), F.col("doc.text")).alias("r"))
    added = ("n_bytes", "n_removed", "spans", "kept")
    return joined.select(*fields(docs, *added), *[F.col(f"r.{c}").alias(c) for c in added])
