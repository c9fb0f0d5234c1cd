"""Hard negatives for every anchor and positive, by a secondary sort of packed scores.

Rows are dealt by hash into blocks of bounded size. A block of rows meets the blocks of anchors in sort order: the key
is (block, turn), the rows come first, so a task holds one block of rows and streams the anchors past it. Two such
rounds are needed, since what counts as a hard negative depends on the score of the positive:

1. each meeting yields an anchor's best rows of its own label, merged per anchor before and after the shuffle;
2. with the scores of its positives an anchor yields, per meeting, the first negatives inside each window. No later row
   of the same block can be among the first of that window, so nothing is lost.

Positives and negatives are then packed into (anchor, descending score, kind, id) keys and sorted within partitions by
``repartitionAndSortWithinPartitions``. One iterator streams through the sorted pairs: a positive opens a window, a
negative goes to every open window that it lies in, a window closes when it is full or passed. It holds the open
windows of one anchor and nothing else, however many pairs an anchor has.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.session import materialize

BLOCK_ROWS = 2048
SCALE_BITS = 8
FLOAT_EXACT = 1 << 53
LONG = (1 << 63) - 1
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass(frozen=True)
class Mining:
    """How many positives and negatives, and the share of the positive's score that a negative must reach."""

    positives: int = 5
    negatives: int = 5
    low_percent: int = 80


def _integers(vectors: list[np.ndarray]) -> np.ndarray:
    """floor(256 * x) of every component; Python integers if any product could leave the exact doubles."""
    x = np.array(vectors, np.float64).reshape(len(vectors), -1)
    scaled = np.floor(np.ldexp(x, SCALE_BITS)) if x.size else x
    if not x.size or np.abs(scaled).max() < math.sqrt(FLOAT_EXACT / x.shape[1]):
        return scaled
    exact = [[int(v) << SCALE_BITS if abs(v) > 1e18 else math.floor(v * 2**SCALE_BITS) for v in row] for row in x.tolist()]
    return np.array(exact, dtype=object).reshape(x.shape)


def _pack(rows: pd.DataFrame) -> bytes:
    """A block as bytes, its rows in the order of their ids (null ids last)."""
    rows = rows.sort_values(["unnamed", "id"], kind="stable")
    return pickle.dumps({
        "uid": rows["uid"].to_numpy(np.int64), "id": rows["id"].to_numpy(np.int64), "unnamed": rows["unnamed"].to_numpy(bool),
        "label": rows["label"].to_numpy(np.int64), "x": _integers(list(rows["v"])),
        "wanted": [[int(s) for s in w] for w in rows["wanted"]] if "wanted" in rows else None,
    })


def usable(rows: DataFrame, label: Column) -> DataFrame:
    """(uid, id, unnamed, label, v, dims): rows with a label and a vector of finite numbers only."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    named = rows.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(0)).alias("id"), F.col("vec_id").isNull().alias("unnamed"),
        label.cast("long").alias("label"), v.alias("v"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = named.where("label is not null and v is not null").where(finite)
    return good.select(F.monotonically_increasing_id().alias("uid"), "*", F.size("v").alias("dims"))


def _blocks(rows: DataFrame, count: int) -> DataFrame:
    """(dims, block, data): rows dealt by the hash of their number into ``count`` blocks for each vector length."""

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"dims": [key[0]], "block": [key[1]], "data": [_pack(group)]})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(count)).cast("int"))
    return dealt.groupBy("dims", "block").applyInPandas(pack, "dims int, block int, data binary")


def _meetings(rows: DataFrame, anchors: DataFrame, blocks: int, found: Callable[[dict, dict], Iterable]):
    """``found(rows, anchors)`` for each block of rows and of anchors of one length, as an RDD."""
    parts = max(1, min(blocks, 20 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    first = rows.rdd.map(lambda r: ((r.dims, r.block, 0, 0), bytes(r.data)))
    dealt = anchors.rdd.flatMap(lambda a: (((a.dims, b, 1, a.block), bytes(a.data)) for b in range(blocks)))
    met = first.union(dealt).repartitionAndSortWithinPartitions(parts, lambda k: k[1])

    def stream(pairs: Iterator) -> Iterator:
        held, at = None, None
        for (dims, block, turn, _), data in pairs:
            if not turn:
                held, at = pickle.loads(data), (dims, block)
            elif at == (dims, block):
                yield from found(held, pickle.loads(data))

    return met.mapPartitions(stream)


def _scores(rows: dict, anchors: dict) -> Iterator[tuple[slice, np.ndarray, int]]:
    """Slices of anchors, their integer scores with all rows, and a number below every score."""
    x, a = rows["x"], anchors["x"]
    dims = x.shape[1]
    top = lambda m: int(np.abs(m).max()) if m.size else 0
    bound = top(x) * top(a) * dims
    plain = bound < FLOAT_EXACT and x.dtype != object and a.dtype != object
    if not plain:
        x, a = x.astype(object), a.astype(object)
        for m in (x, a):
            m[...] = np.vectorize(int, otypes=[object])(m) if m.size else m
    for lo in range(0, len(a), 256):
        at = slice(lo, min(lo + 256, len(a)))
        if not dims:
            yield at, np.zeros((at.stop - lo, len(x)), np.int64), -1
        else:
            made = a[at] @ x.T
            yield at, made.astype(np.int64) if plain else made, -bound - 1


def _best_first(scores: np.ndarray) -> np.ndarray:
    """Column numbers by descending score; equal scores keep the order of the ids."""
    return np.argsort(-scores, axis=1, kind="stable")


def _positives(wanted: int) -> Callable[[dict, dict], Iterator]:
    def found(rows: dict, anchors: dict) -> Iterator:
        for at, scores, low in _scores(rows, anchors):
            own = anchors["label"][at, None] == rows["label"]
            other = anchors["uid"][at, None] != rows["uid"]
            scores = np.where(own & other, scores, low)
            order = _best_first(scores)[:, :wanted]
            for i, uid in enumerate(anchors["uid"][at].tolist()):
                best = [
                    (-int(scores[i, j]), bool(rows["unnamed"][j]), int(rows["id"][j])) for j in order[i].tolist() if scores[i, j] > low
                ]
                if best:
                    yield uid, best

    return found


def _negatives(cfg: Mining) -> Callable[[dict, dict], Iterator]:
    def found(rows: dict, anchors: dict) -> Iterator:
        for at, scores, low in _scores(rows, anchors):
            scores = np.where(anchors["label"][at, None] != rows["label"], scores, low)
            order = _best_first(scores)
            ranked = np.take_along_axis(scores, order, axis=1)
            wanted, ids = anchors["wanted"][at], anchors["id"][at].tolist()
            taken = [set() for _ in wanted]
            for place in range(cfg.positives):
                # An anchor without a positive at this place gets a score whose window is empty.
                goal = [w[place] if place < len(w) else -1 for w in wanted]
                goal = np.array(goal, dtype=object if max(map(abs, goal)) * 100 > LONG else ranked.dtype)[:, None]
                begin = (ranked > goal).sum(axis=1)
                for step in range(cfg.negatives):
                    col = np.minimum(begin + step, ranked.shape[1] - 1)
                    score = np.take_along_axis(ranked, col[:, None], axis=1)
                    inside = (begin + step < ranked.shape[1])[:, None] & (score > low) & (score * 100 >= goal * cfg.low_percent)
                    for i in np.flatnonzero(inside[:, 0].astype(bool)).tolist():
                        taken[i].add(int(col[i]))
            for i, uid in enumerate(anchors["uid"][at].tolist()):
                for col in taken[i]:
                    j = order[i, col]
                    yield (uid, -int(ranked[i, col]), 1, bool(rows["unnamed"][j]), int(rows["id"][j])), ids[i]

    return found


def _windows(cfg: Mining) -> Callable[[Iterator], Iterator]:
    """Pairs in key order to result rows; holds the open windows of one anchor."""
    fit = lambda n: max(-LONG - 1, min(LONG, n))

    def stream(pairs: Iterator) -> Iterator:
        current, windows = None, []
        for (uid, below, kind, unnamed, number), anchor in pairs:
            score, name = -below, None if unnamed else number
            if uid != current:
                current, windows = uid, []
            if kind == 0:
                windows.append([score, name, 0])
                continue
            windows = [w for w in windows if w[2] < cfg.negatives and cfg.low_percent * w[0] <= 100 * score]
            for w in windows:
                w[2] += 1
                yield anchor, w[1], w[2], name, fit(w[0]), fit(score)

    return stream


def hard_negatives(rows: DataFrame, anchors: Column, label: Column, cfg: Mining = Mining()) -> DataFrame:
    """Per anchor row and each of its positives the first negatives of another label within the window.

    ``rows`` needs vec_id and embedding; ``anchors`` is a condition on id (vec_id) and unnamed, ``label`` an expression
    over the input columns; other columns are ignored. A row without label or vector, or with a null or non-finite
    component, takes no part. Every row stands for itself: rows that repeat an id, or a whole row, are anchors,
    positives and negatives of their own, and only the anchor's own row is left out. A null vec_id is no anchor and
    comes after all ids among equal scores. Vectors are compared with those of the same length; an empty one scores 0
    with another empty one. Scores are exact at any magnitude, and saturate at the ends of a long in the result.
    An anchor without positives, or a positive without negatives, has no row; an empty table gives none.
    """
    spark = rows.sparkSession
    held = materialize(usable(rows, label))
    chosen = held.where(anchors & ~F.col("unnamed"))
    n_blocks = max(1, math.ceil(held.count() / BLOCK_ROWS))
    n_anchors = max(1, math.ceil(chosen.count() / BLOCK_ROWS))
    packed = materialize(_blocks(held, n_blocks))
    k = cfg.positives
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    best = _meetings(packed, _blocks(chosen, n_anchors), n_blocks, _positives(k)).reduceByKey(
        lambda a, b: heapq.nsmallest(k, a + b), parts
    )
    # Scores travel as text here: they may lie beyond a long.
    listed = best.map(lambda p: (p[0], [str(-s) for s, _, _ in p[1]], [u for _, u, _ in p[1]], [i for _, _, i in p[1]]))
    positives = materialize(spark.createDataFrame(listed, "uid long, wanted array<string>, nameless array<boolean>, ids array<long>"))
    with_scores = chosen.join(positives, "uid")
    negatives = _meetings(packed, _blocks(with_scores, n_anchors), n_blocks, _negatives(cfg))
    opened = with_scores.select("uid", "id", "wanted", "nameless", "ids").rdd.flatMap(
        lambda r: (((r.uid, -int(s), 0, u, i), r.id) for s, u, i in zip(r.wanted, r.nameless, r.ids))
    )
    pairs = opened.union(negatives).repartitionAndSortWithinPartitions(parts, lambda key: key[0])
    return spark.createDataFrame(pairs.mapPartitions(_windows(cfg)), RESULT)
