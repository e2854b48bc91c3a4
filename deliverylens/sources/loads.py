"""Repeatable loads into catalog tables.

Every row of a loaded table carries the id of its load, by which the table is partitioned. A
log names the loads that are complete. A load that is repeated, whether it had failed half
way or not, replaces its own partitions and nothing else, and readers see the rows of logged
loads only: a load shows whole, once, or not at all.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from deliverylens.schema import TABLES

LOAD_ID = "load_id"
LOG = "load_log"


def parents_first(names) -> list[str]:
    """The named tables so that every table comes after those it refers to."""
    left, ordered = list(names), []
    while left:
        ready = [n for n in left if not any(p in left and p != n for p in TABLES[n].references.values())]
        if not ready:
            raise ValueError(f"tables refer to each other in a circle: {left}")
        ordered += ready
        left = [n for n in left if n not in ready]
    return ordered


def _replace_load(df: DataFrame, target: str, load_id: str) -> None:
    """The partition of one load, in place of an earlier try at it. Columns bind by name."""
    spark = df.sparkSession
    marked = df.withColumn(LOAD_ID, F.lit(load_id))
    if not spark.catalog.tableExists(target):
        marked.write.partitionBy(LOAD_ID).saveAsTable(target)
        return
    quoted = load_id.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({LOAD_ID} = '{quoted}')")
    marked.select(*spark.table(target).columns).write.insertInto(target)


def complete_loads(spark: SparkSession, database: str) -> DataFrame:
    """The log: load_id, table_name, row_count; a load without a row is not complete."""
    target = f"{database}.{LOG}"
    if spark.catalog.tableExists(target):
        return spark.table(target).select(LOAD_ID, "table_name", "row_count")
    return spark.createDataFrame([], f"{LOAD_ID} string, table_name string, row_count bigint")


def load_tables(tables: Mapping[str, DataFrame], database: str, load_id: str) -> bool:
    """Load tables into ``database`` under an id; False if that load is complete already.

    Parents are written before the tables that refer to them, and the log last, in one
    file, so that it names all tables of a load or none. Loads of different ids do not
    touch each other's rows. Two tries at one id must not run at the same time.
    """
    spark = next(iter(tables.values())).sparkSession
    if not complete_loads(spark, database).filter(F.col(LOAD_ID) == load_id).isEmpty():
        return False
    for name in parents_first(tables):
        _replace_load(tables[name], f"{database}.{name}", load_id)
    counts = None
    for name in tables:
        loaded = spark.table(f"{database}.{name}").filter(F.col(LOAD_ID) == load_id)
        row = loaded.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = row if counts is None else counts.unionAll(row)
    _replace_load(counts.coalesce(1), f"{database}.{LOG}", load_id)
    return True


def loaded_table(spark: SparkSession, database: str, name: str) -> DataFrame:
    """The rows of complete loads. Partitions of other loads are not read."""
    ids = [row[0] for row in complete_loads(spark, database).select(LOAD_ID).distinct().collect()]
    return spark.table(f"{database}.{name}").filter(F.col(LOAD_ID).isin(*ids) if ids else F.lit(False)).drop(LOAD_ID)


def save_view(spark: SparkSession, name: str, query: str) -> None:
    """Create or replace a view that the catalog keeps, for all sessions, over catalog tables."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
