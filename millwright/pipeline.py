"""The stages in running order, with parquet folders between them.

``ingest -> validate -> features -> train -> score -> kpis -> views -> reports``. Tables, snapshots and views are published
versions under ``tables``. Features run before scoring, so the anomaly flags they read are those of the previous scoring;
a missing flag counts as no anomaly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.config import DEFAULT, Config
from millwright.ml import anomaly, attribution, importance, metrics, risk
from millwright.plans import features, kpis, refresh, validation
from millwright.plans.reports import scorecard
from millwright.plans.reports.stored import report_datasets
from millwright.schemas import KPI_SNAPSHOTS
from millwright.session import materialize, scratch
from millwright.sources.load import load_csvs
from millwright.sources.merge import stage_merge, stage_replace
from millwright.sources.readers import conform, read_parquet, read_published, read_tables
from millwright.sources.versions import latest, publish, stage
from millwright.sources.writers import as_stored, write_csv, write_metrics, write_parquet


@dataclass(frozen=True)
class Pipeline:
    """All stages over one root folder that every executor can reach."""

    spark: SparkSession
    root: str
    cfg: Config = DEFAULT

    def _at(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def _tables(self):
        return read_tables(self.spark, self._at("tables"))

    def ingest(self, csv_dir: str) -> dict[str, int]:
        return load_csvs(self.spark, csv_dir, self._at("tables"), self.cfg.load)

    def validate(self) -> DataFrame:
        """Store all check results and the unknown statuses, then stop the run if a check is critical."""
        path = self._at("reports", "validation")
        tables = self._tables()
        write_parquet(validation.validate_all(tables, self.cfg.validation), path)
        write_parquet(validation.invalid_statuses(tables.work_orders), self._at("reports", "invalid_statuses"))
        results = read_parquet(self.spark, path)
        validation.gate(results)
        return results

    def build_features(self) -> DataFrame:
        t = self._tables()
        matrix = features.feature_matrix(t.work_orders, t.machines, t.machine_telemetry, self.cfg.features)
        write_parquet(matrix, self._at("features"))
        return read_parquet(self.spark, self._at("features"))

    def train(self) -> DataFrame:
        """Fit and save the anomaly forest and the risk ensemble; returns the metrics record.

        The evaluation on the hold-out (metrics, confusion, ROC of each model) and the importances are stored too.
        """
        anomaly.fit(self._tables().machine_telemetry, self.cfg).save(self._at("models", "anomaly"))
        matrix = read_parquet(self.spark, self._at("features"))
        trained = risk.train(matrix, self.cfg)
        trained.models.save(self._at("models", "risk"))
        record = materialize(trained.metrics)
        write_metrics(record, self._at("reports", "model_metrics"))
        called = F.col("proba") >= self.cfg.kpis.high_risk_score_threshold
        evaluation = {
            "metrics_table": scorecard.metrics_table(record),
            "confusion": metrics.confusion_matrix(trained.held_out, features.TARGET, called),
            "roc": risk.roc_by_model(trained.held_out),
            "permutation_importance": importance.permutation_importance(matrix, trained.models, self.cfg),
            "attribution": attribution.attribution_summary(matrix, trained.models.a, self.cfg),
            "tree_importance": importance.tree_importance(trained.models, matrix),
        }
        for name, rows in evaluation.items():
            write_parquet(rows, self._at("reports", "evaluation", name))
        return record

    def score(self) -> None:
        """Store the scores, and merge both models' results into the tables; only buckets that change are written."""
        root, t = self._at("tables"), self._tables()
        base = latest(self.spark, root)
        models = risk.RiskModels.load(self._at("models", "risk"))
        scores = risk.score(read_parquet(self.spark, self._at("features")), models, self.cfg)
        write_parquet(scores, self._at("scores", "risk"))
        scores = read_parquet(self.spark, self._at("scores", "risk"))
        write_csv(scores, self._at("scores", "risk_csv"))
        forest = anomaly.Forest.load(self.spark, self._at("models", "anomaly"))
        flags = materialize(
            anomaly.score(t.machine_telemetry, forest, self.cfg).select("telemetry_id", "anomaly_score", "anomaly_flag"))
        results = {
            "work_orders": (scores, ["risk_score", "risk_label"]),
            "machine_telemetry": (flags, ["anomaly_score", "anomaly_flag"]),
        }
        merged = {
            name: stage_merge(self.spark, root, base, name, rows, columns)
            for name, (rows, columns) in results.items() if name in base.tables
        }
        publish(self.spark, root, base, merged)

    def build_kpis(self) -> DataFrame:
        """Publish the snapshots; of an earlier run's, only the days that differ are replaced."""
        root, t = self._at("tables"), self._tables()
        base = latest(self.spark, root)
        rows = kpis.daily_snapshots(t.work_orders, t.machines, t.machine_telemetry, self.cfg.kpis)
        rows = materialize(as_stored(rows, refresh.KPIS).select(*KPI_SNAPSHOTS.names))
        if refresh.KPIS in base.tables:
            days = materialize(refresh.changed_days(self.spark, root, conform(rows, KPI_SNAPSHOTS)))
            new = rows.join(days, "snapshot_date", "left_semi")
            table = stage_replace(self.spark, root, base, refresh.KPIS, days, new)
        else:
            table = stage(rows, root, refresh.KPIS, ["snapshot_date"], self.cfg.load.buckets)
        publish(self.spark, root, base, {refresh.KPIS: table})
        stored = self._snapshots()
        constraints = validation.constraint_checks({"kpi_snapshots": stored, "plants": t.plants})
        write_parquet(constraints, self._at("reports", "kpi_constraints"))
        return stored

    def _snapshots(self) -> DataFrame:
        return read_published(self.spark, self._at("tables"), refresh.KPIS, KPI_SNAPSHOTS)

    def refresh_views(self) -> None:
        t = self._tables()
        refresh.refresh_views(self.spark, self._at("tables"), t.work_orders, t.plants, t.machines)

    def build_reports(self) -> None:
        """Store every dataset behind the report pages."""
        for name, rows in report_datasets(self._tables(), self._snapshots(), self.cfg).items():
            write_parquet(rows, self._at("reports", "pages", name))

    def run(self, csv_dir: str) -> None:
        """All stages; intermediate tables of a stage go when it has stored its results."""
        stages = (
            lambda: self.ingest(csv_dir), self.validate, self.build_features, self.train, self.score, self.build_kpis,
            self.refresh_views, self.build_reports,
        )
        for stage in stages:
            with scratch(self.spark):
                stage()
