"""Nearest neighbours through shifted space-filling curves.

Every curve projects the vectors onto a few random directions, scales each by quantiles of a bounded sample, shifts
the cells and orders the points along a Hilbert curve. Spark sorts each ordering over range partitions; a query meets
the candidates within a window of positions around its own, and the results of all curves are merged and reranked by
the exact inner product. The window is set from data: for a bounded sample of queries the true neighbours are searched
among all vectors, and the window is the distance along the best curve that reaches the wanted share of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millwright.llm.hilbert import hilbert_index
from millwright.operators.ordering import row_index
from millwright.session import materialize

SAMPLE_VECTORS = 10_000
SAMPLE_QUERIES = 256
BLOCK_ROWS = 16_384


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.zeros((0, 1))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, added from the first component to the last."""
    return np.cumsum(a * b, axis=1)[:, -1]


def usable(vectors: DataFrame) -> DataFrame:
    """(id, v) with v as doubles: one row per vec_id, without null, zero or non-finite vectors.

    A vec_id that comes with several vectors keeps one of them (smallest hash); a null vec_id takes no part. If
    lengths differ, the commonest one counts (the longer of equals).
    """
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(good)
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    common = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    rows = rows.where(F.size("v") == (common[0] if common else 0))
    # -0.0 and 0.0 are one value, so that equal vectors have equal hashes.
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    return rows.groupBy("id").agg(F.min_by("v", F.xxhash64("v")).alias("v"))


class Curves:
    """The projections, scales and shifts of all curves; a function of the seed and a bounded sample."""

    def __init__(self, sample: np.ndarray, radius: float, curves: int, dims: int, bits: int, seed: int = 20):
        rng = np.random.default_rng(seed)
        self.radius, self.bits = radius, bits
        width = sample.shape[1] + 1
        dims = min(dims, width)
        points = self.lift(sample, as_query=False)
        self.axes = [np.linalg.qr(rng.normal(size=(width, dims)))[0] for _ in range(curves)]
        grid = np.linspace(0, 1, (1 << bits) + 1)[1:-1]
        self.edges = [np.quantile(points @ axes, grid, axis=0) for axes in self.axes]
        self.shifts = [rng.integers(0, 1 << bits, dims) for _ in range(curves)]

    def lift(self, x: np.ndarray, as_query: bool) -> np.ndarray:
        """One more component puts all vectors on one sphere, where the largest inner product is the nearest point."""
        norms = np.linalg.norm(x, axis=1)
        if as_query:
            return np.column_stack([x * (self.radius / norms)[:, None], np.zeros(len(x))])
        return np.column_stack([x, np.sqrt(np.maximum(0, self.radius**2 - norms**2))])

    def keys(self, x: np.ndarray, as_query: bool) -> np.ndarray:
        """Hilbert positions, one column per curve."""
        points = self.lift(x, as_query)
        out = []
        for axes, edges, shift in zip(self.axes, self.edges, self.shifts):
            y = points @ axes
            cells = np.column_stack([np.searchsorted(edges[:, d], y[:, d]) for d in range(y.shape[1])])
            out.append(hilbert_index(cells + shift, self.bits + 1))
        return np.column_stack(out)


def _ordered(points: DataFrame, curves: Curves) -> DataFrame:
    """(curve, pos, key's vid, query, v) for all points on all curves; pos counts from 0 on each curve."""

    @F.pandas_udf("array<long>")
    def keys(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for v, query in batches:
            x, q = _matrix(v), query.to_numpy(bool)
            found = np.zeros((len(x), len(curves.axes)), np.int64)
            for flag in (False, True):
                if (q == flag).any():
                    found[q == flag] = curves.keys(x[q == flag], flag)
            yield pd.Series(list(found))

    each = points.select("vid", "query", "v", F.posexplode(keys("v", "query")).alias("curve", "key"))
    ranked = row_index(each, [F.col("curve"), F.col("key"), F.col("query"), F.col("vid")], "index")
    total = ranked.where("curve = 0").count()
    return ranked.select("curve", (F.col("index") - F.col("curve") * F.lit(total)).alias("pos"), "vid", "query", "v")


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Column numbers of the k largest scores in each row, in no order."""
    if scores.shape[1] <= k:
        return np.tile(np.arange(scores.shape[1]), (len(scores), 1))
    return np.argpartition(-scores, k - 1, axis=1)[:, :k]


def _window(points: DataFrame, ordered: DataFrame, k: int, recall: float) -> int:
    """Positions to look at on both sides, from the true neighbours of a bounded sample of queries."""
    sample = points.where("query").orderBy(F.xxhash64("vid"), "vid").limit(SAMPLE_QUERIES).select("vid", "v").toPandas()
    q, ids = _matrix(sample.v), sample.vid.to_numpy()

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), BLOCK_ROWS):
                part = batch.iloc[lo : lo + BLOCK_ROWS]
                scores, vids = q @ _matrix(part.v).T, part.vid.to_numpy()
                scores[ids[:, None] == vids[None, :]] = -np.inf
                best = _best(scores, k)
                rows = np.repeat(np.arange(len(q)), best.shape[1])
                yield pd.DataFrame({"qid": ids[rows], "vid": vids[best.ravel()], "score": scores[rows, best.ravel()]})

    found = points.where("not query").select("vid", "v").mapInPandas(search, "qid long, vid long, score double")
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "vid"))
    true = found.where(F.col("score") > float("-inf")).withColumn("rank", rank).where(F.col("rank") <= k).select("qid", "vid")
    places = ordered.select("curve", "pos", "vid", "query")
    of_query = places.where("query").select("curve", F.col("vid").alias("qid"), F.col("pos").alias("qpos"))
    at = F.broadcast(true).join(places.where("not query"), "vid").join(of_query, ["curve", "qid"])
    gaps = at.groupBy("qid", "vid").agg(F.min(F.abs(F.col("pos") - F.col("qpos"))).alias("gap")).toPandas().gap
    return int(np.quantile(gaps, recall, method="higher")) + 1 if len(gaps) else 1


def _search_blocks(ordered: DataFrame, reach: int, k: int) -> DataFrame:
    """(qid, vid, score): the best candidates of every query in every block that its window touches."""
    size = min(BLOCK_ROWS, max(1024, reach))
    block = lambda pos: F.floor(pos / F.lit(size)).cast("long")
    blocks = F.sequence(block(F.greatest(F.col("pos") - reach, F.lit(0))), block(F.col("pos") + reach))
    spread = ordered.withColumn("block", F.explode(F.when(F.col("query"), blocks).otherwise(F.array(block(F.col("pos"))))))

    def search(part: pd.DataFrame) -> pd.DataFrame:
        q, c = part[part["query"]], part[~part["query"]].sort_values(["pos", "vid"])
        out = [pd.DataFrame({"qid": [], "vid": [], "score": []}).astype({"qid": "int64", "vid": "int64", "score": "float64"})]
        if len(c) and len(q):
            x, y, cpos, vids = _matrix(q.v), _matrix(c.v), c.pos.to_numpy(), c.vid.to_numpy()
            qpos, qids = q.pos.to_numpy(), q.vid.to_numpy()
            for lo in range(0, len(x), 256):
                hi = min(len(x), lo + 256)
                scores = x[lo:hi] @ y.T
                scores[np.abs(qpos[lo:hi, None] - cpos[None, :]) > reach] = -np.inf
                best = _best(scores, k + 4)
                rows, cols = np.repeat(np.arange(hi - lo), best.shape[1]), best.ravel()
                seen = scores[rows, cols] > -np.inf
                rows, cols = rows[seen], cols[seen]
                out.append(pd.DataFrame({"qid": qids[lo:hi][rows], "vid": vids[cols], "score": inner(x[lo:hi][rows], y[cols])}))
        return pd.concat(out)

    return spread.groupBy("curve", "block").applyInPandas(search, "qid long, vid long, score double")


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, curves: int = 8, dims: int = 4, bits: int = 8, recall: float = 0.95
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows found for each query row, its own row left out.

    ``vectors`` has vec_id and embedding, ``is_query`` is a condition on vec_id; other columns are ignored. See
    ``usable`` for the rows that take no part. Equal scores go to the smaller vec_id. Equal vectors are searched
    once: only their k + 1 smallest ids can ever be among the best, and every query row gets its vector's list, so a
    vector that fills a third of the table costs one row. An empty table or one without queries gives no rows.
    """
    rows = materialize(usable(vectors).withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit("second"), F.col("v"))))
    order = Window.partitionBy("h1", "h2").orderBy("id")
    low = rows.select("id", "h1", "h2").withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    ids = low.groupBy("h1", "h2").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    groups = materialize(ids.withColumn("vid", F.element_at("ids", 1)))
    asked = materialize(rows.withColumnRenamed("id", "vec_id").where(is_query).select("vec_id", "h1", "h2").join(
        groups.select("h1", "h2", "vid"), ["h1", "h2"]).select("vec_id", "vid"))
    distinct = groups.select("vid").join(rows.select(F.col("id").alias("vid"), "v"), "vid")
    wanted = distinct.join(asked.select("vid").distinct(), "vid", "left_semi")
    points = materialize(distinct.withColumn("query", F.lit(False)).unionByName(wanted.withColumn("query", F.lit(True))))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    radius = points.agg(F.max(norm)).first()[0]
    if radius is None:
        return points.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = points.where("not query").orderBy(F.xxhash64("vid"), "vid").limit(SAMPLE_VECTORS).select("v").toPandas()
    ordered = materialize(_ordered(points, Curves(_matrix(sample.v), radius, curves, dims, bits)))
    reach = _window(points, ordered, k, recall)
    found = _search_blocks(ordered, reach, k + 1).groupBy("qid", "vid").agg(F.max("score").alias("score"))
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vid")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    lists = found.join(groups.select("vid", "ids"), "vid").select("qid", "score", F.explode("ids").alias("id"))
    by_id = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    lists = lists.withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= k + 1)
    lists = lists.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("best"))
    other = F.filter("best", lambda x: x["id"] != F.col("vec_id"))
    each = asked.join(lists, asked.vid == lists.qid).select(F.col("vec_id").alias("query_id"), F.posexplode(F.slice(other, 1, k)).alias("at", "x"))
    return each.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))
