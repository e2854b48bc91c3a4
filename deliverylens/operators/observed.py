"""Counters taken by the very jobs that write tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


class Counters:
    """Named sums over the rows of tables on their way into storage.

    Watch a frame where its rows go straight to the writer, behind the last shuffle: there
    a task's counts are taken when its output is, once, whatever attempts failed before
    and whichever executors were lost.
    """

    def __init__(self) -> None:
        self._seen: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, table: str, **metrics: Column) -> DataFrame:
        """``df``, whose next written copy also leaves these metrics."""
        seen = Observation(f"{table}-{uuid.uuid4().hex}")
        self._seen.append((table, seen))
        return df.observe(seen, *[metric.cast("double").alias(name) for name, metric in metrics.items()])

    def found(self, tables) -> list[tuple[str, str, float | None]]:
        """(table, metric, value) of the named tables, which must have been written; the
        metrics of no rows at all are 0 for counts and NULL for others."""
        return [
            (table, metric, value)
            for table, seen in self._seen
            if table in tables
            for metric, value in seen.get.items()
        ]

    def frame(self, spark: SparkSession, tables) -> DataFrame:
        """table_name, metric, value."""
        return spark.createDataFrame(self.found(tables), "table_name string, metric string, value double")
