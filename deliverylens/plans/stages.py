"""The batch pipeline: raw tables -> cleaned tables -> KPI tables.

Stages are written on first use and read back, each at most once per
application, like a scheduled batch would leave them on shared storage.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from deliverylens.operators.observed import Counters
from deliverylens.plans import cleaning, cube, features, kpi, risk
from deliverylens.session import StageStore
from deliverylens.sources.driver_tables import RAW_LOADERS


class Lazy(Mapping):
    """A mapping that builds its entries on access."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)


def raw_tables(spark: SparkSession, sf_dir: str) -> Lazy:
    return Lazy({name: (lambda load=load: load(spark, sf_dir)) for name, load in RAW_LOADERS.items()})


def delivery_tables(spark: SparkSession, raw: Mapping[str, DataFrame], label: str) -> Lazy:
    """Cleaned, KPI, feature and model tables and filter cells over a raw set, and its cleaning audit.

    Each call has stages of its own; ``label`` only names their folder.
    """
    store = StageStore(spark, label)
    counters = Counters()
    tables = Lazy({})
    stages: dict[str, Callable[[], DataFrame]] = {
        **{
            name: (lambda clean=clean, name=name: clean(raw[name], counters=counters))
            for name, clean in cleaning.CLEANERS.items()
        },
        "cleaning_audit": lambda: cleaning.cleaning_audit(tables, counters),
        "kpi_team_summary": lambda: kpi.team_kpis(tables),
        "kpi_project_health": lambda: kpi.project_health(tables),
        "kpi_developer_workload": lambda: kpi.developer_workload(tables),
        "kpi_developer_productivity": lambda: kpi.productivity(tables, tables["kpi_developer_workload"]),
        "release_risk_scores": lambda: risk.risk_scores(tables),
        "release_delay_features": lambda: features.release_features(tables),
        **{name: (lambda build=build: build(tables)) for name, build in cube.CELLS.items()},
    }
    for name, build in stages.items():
        tables._builders[name] = lambda name=name, build=build: store.get(name, build)
    for name in ("model_comparison", "feature_importance"):
        tables._builders[name] = lambda name=name: _model_table(store, tables, name)
    return tables


def _model_table(store: StageStore, tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """The models are fitted once and leave both of their tables."""
    from deliverylens.plans.models import train_delay_models

    def fit() -> DataFrame:
        fitted = train_delay_models(tables["release_delay_features"])
        outputs = {"model_comparison": fitted.comparison(), "feature_importance": fitted.importance()}
        for other, df in outputs.items():
            if other != name:
                store.get(other, lambda df=df: df)
        return outputs[name]

    return store.get(name, fit)


_samples: dict[tuple[str, str], Lazy] = {}


def sample_tables(spark: SparkSession, sf_dir: str) -> Lazy:
    """The pipeline over the delivery-shaped sample tables of a directory, one set for
    each directory and application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _samples:
        _samples[key] = delivery_tables(spark, raw_tables(spark, sf_dir), "sample")
    return _samples[key]
