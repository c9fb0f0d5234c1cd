"""Isolation forest on the five sensors (Liu, Ting and Zhou, 2008).

Each tree sees at most 256 readings, picked by hash, so fitting moves a bounded number of rows; the trees are
grown in parallel tasks. The finished forest has at most ``trees * 2 * 256`` nodes, which bounds what scoring
broadcasts, whatever the size of the telemetry.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millwright.config import DEFAULT, Config
from millwright.functions import half_even
from millwright.operators.sampling import hash_order, hash_sample
from millwright.operators.stats import exact_quantile
from millwright.schemas import SENSORS
from millwright.session import materialize

_NODES = "tree int, node int, feature int, split double, low int, high int, depth int, size int"


@dataclass(frozen=True)
class Forest:
    nodes: DataFrame  # one row per tree node
    scaler: dict[str, tuple[float, float]]  # sensor -> (mean, population std)
    sample_size: int

    def save(self, path: str) -> None:
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        rows = [(s, m, d, self.sample_size) for s, (m, d) in self.scaler.items()]
        frame = spark.createDataFrame(rows, "sensor string, mean double, std double, sample_size int")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        rows = spark.read.parquet(f"{path}/scaler").collect()  # one row per sensor
        scaler = {r["sensor"]: (r["mean"], r["std"]) for r in rows}
        return Forest(spark.read.parquet(f"{path}/nodes"), scaler, rows[0]["sample_size"])


def fit_scaler(readings: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per sensor; a constant sensor keeps scale 1."""
    aggs = [f(s).alias(f"{n}_{s}") for s in SENSORS for n, f in (("m", F.avg), ("d", F.stddev_pop))]
    row = readings.agg(*aggs).first()
    return {s: (row[f"m_{s}"] or 0.0, row[f"d_{s}"] or 1.0) for s in SENSORS}


def scaled(readings: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    return readings.withColumns({s: (F.col(s) - F.lit(m)) / F.lit(d) for s, (m, d) in scaler.items()})


def expected_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, float)
    beyond = np.maximum(n - 1.0, 1.0)
    long = 2.0 * (np.log(beyond) + np.euler_gamma) - 2.0 * beyond / np.maximum(n, 1.0)
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def _tree_samples(valid: DataFrame, trees: int, size: int, seed: int) -> DataFrame:
    """``size`` distinct rows for each tree, by one rule for tables of any size.

    The trees * size rows with the smallest hash, or all rows if there are fewer, stand in hash order; the trees
    take ``size`` rows in turn and go round again when the rows run out. Both counts are model parameters.
    """
    pool = hash_sample(valid, "_id", trees * size, seed)
    order = Window.orderBy(hash_order("_id", seed), "_id", *SENSORS)
    pool = pool.withColumns({"_at": F.row_number().over(order) - 1, "_pool": F.count(F.lit(1)).over(Window.partitionBy())})
    turns = F.sequence(F.col("_at").cast("long"), F.lit(trees * size - 1).cast("long"), F.col("_pool"))
    dealt = pool.withColumn("_rank", F.explode(turns))
    return dealt.withColumn("tree", F.floor(F.col("_rank") / F.lit(size)).cast("int")).drop("_at", "_pool")


def _grower(size: int, seed: int):
    limit = math.ceil(math.log2(max(size, 2)))
    columns = list(SENSORS)

    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        tree = int(sample["tree"].iloc[0])
        x = sample.sort_values("_rank")[columns].to_numpy(float)
        rng = np.random.default_rng([seed, tree])
        nodes: list[list] = []
        pending = [(np.arange(len(x)), 0, -1, 0)]
        while pending:
            rows, depth, parent, side = pending.pop()
            number = len(nodes)
            if parent >= 0:
                nodes[parent][4 + side] = number
            spread = np.ptp(x[rows], axis=0) > 0 if len(rows) > 1 else np.zeros(len(columns), bool)
            if depth >= limit or not spread.any():
                nodes.append([tree, number, -1, 0.0, -1, -1, depth, len(rows)])
                continue
            feature = int(rng.choice(np.flatnonzero(spread)))
            values = x[rows, feature]
            split = float(rng.uniform(values.min(), values.max()))
            nodes.append([tree, number, feature, split, -1, -1, depth, len(rows)])
            below = values <= split
            pending.append((rows[~below], depth + 1, number, 1))
            pending.append((rows[below], depth + 1, number, 0))
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "split", "low", "high", "depth", "size"])

    return grow


def fit(readings: DataFrame, cfg: Config = DEFAULT, id_col: str = "telemetry_id") -> Forest:
    """Train on every reading with all five sensors present."""
    conf = cfg.models.anomaly
    row_id = F.col(id_col).cast("string") if id_col in readings.columns else F.sha2(
        F.concat_ws("|", *[F.col(c).cast("string") for c in readings.columns]), 256)
    valid = readings.na.drop(subset=list(SENSORS)).select(row_id.alias("_id"), *SENSORS)
    rows = valid.count()
    if rows == 0:
        raise ValueError("no reading has all five sensors")
    scaler = fit_scaler(valid)
    size = min(conf.max_samples, rows)
    samples = _tree_samples(scaled(valid, scaler), conf.n_estimators, size, conf.random_state)
    nodes = samples.groupBy("tree").applyInPandas(_grower(size, conf.random_state), _NODES)
    return Forest(materialize(nodes), scaler, size)


def _padded(nodes: pd.DataFrame) -> dict[str, np.ndarray]:
    trees, width = int(nodes["tree"].max()) + 1, int(nodes["node"].max()) + 1
    nodes = nodes.assign(path=nodes["depth"] + expected_path(nodes["size"].to_numpy()))
    out = {}
    for name, kind in (("feature", np.int8), ("split", float), ("low", np.int32), ("high", np.int32), ("path", float)):
        grid = np.zeros((trees, width), kind)
        grid[nodes["tree"], nodes["node"]] = nodes[name]
        out[name] = grid
    return out


def with_raw_score(readings: DataFrame, forest: Forest) -> DataFrame:
    """Add ``_raw``: minus two to the power of minus the normalised mean path; 0 if a sensor is missing."""
    grids = readings.sparkSession.sparkContext.broadcast(_padded(forest.nodes.toPandas()))
    depth = math.ceil(math.log2(max(forest.sample_size, 2)))
    norm = float(expected_path(forest.sample_size)) or 1.0

    @F.pandas_udf("double")
    def raw(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        g = grids.value
        for columns in parts:
            x = np.column_stack([c.to_numpy(float) for c in columns])
            row = np.arange(len(x))
            total = np.zeros(len(x))
            for feature, split, low, high, path in zip(g["feature"], g["split"], g["low"], g["high"], g["path"]):
                at = np.zeros(len(x), np.int32)
                for _ in range(depth):
                    f = feature[at]
                    child = np.where(x[row, np.maximum(f, 0)] <= split[at], low[at], high[at])
                    at = np.where(f >= 0, child, at)
                total += path[at]
            yield pd.Series(-np.power(2.0, -(total / len(g["feature"])) / norm))

    present = F.lit(True)
    for sensor in SENSORS:
        present = present & F.col(sensor).isNotNull()
    inputs = [(F.col(s).cast("double") - F.lit(m)) / F.lit(d) for s, (m, d) in forest.scaler.items()]
    return readings.withColumn("_raw", F.when(present, raw(*inputs)))


def score(readings: DataFrame, forest: Forest, cfg: Config = DEFAULT, mode: str = "threshold") -> DataFrame:
    """Add ``anomaly_score`` and ``anomaly_flag``.

    ``threshold`` flags raw scores below the configured value; ``contamination`` flags the lowest share of
    scores instead. Readings with a missing sensor score 0 and are not flagged.
    """
    scored = with_raw_score(readings, forest)
    cut = cfg.kpis.anomaly_score_threshold
    if mode == "contamination":
        scored = materialize(scored)
        cut = exact_quantile(scored, "_raw", cfg.models.anomaly.contamination, "cut").first()["cut"]
    elif mode != "threshold":
        raise ValueError(f"unknown mode {mode!r}")
    return scored.withColumns({
        "anomaly_score": F.coalesce(half_even("_raw", 4), F.lit(0.0)),
        "anomaly_flag": F.coalesce(F.col("_raw") < F.lit(cut), F.lit(False)),
    }).drop("_raw")
