"""Facts laid out in buckets, so that work by their key needs no shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from deliverylens.schema import TABLES

# facts of a project lie together; within a bucket they are sorted
BUCKET_KEY = "project_id"
BUCKETED = tuple(name for name, spec in TABLES.items() if BUCKET_KEY in spec.references)
ROWS_A_BUCKET = 5_000_000


def bucket_count(rows: int, rows_a_bucket: int = ROWS_A_BUCKET) -> int:
    """Buckets for a set of tables whose largest has so many rows: a power of two, so that
    tables of other sets, with fewer or more buckets, can still be read together."""
    count = 8
    while count * rows_a_bucket < rows:
        count *= 2
    return count


def write_bucketed(tables: Mapping[str, DataFrame], database: str, buckets: int) -> None:
    """Every fact table of the mapping as ``database.<name>``, in ``buckets`` by project. Rows
    are dealt out by bucket before they are written, so a bucket is one file and is sorted
    once; a project with a large share of all rows makes its bucket as large. NULL projects
    share a bucket. Tables without a project are written as they are."""
    for name, df in tables.items():
        if name in BUCKETED:
            order = [BUCKET_KEY, *[c for c in ("sprint_id",) if c in df.columns]]
            writer = df.repartition(buckets, BUCKET_KEY).write.bucketBy(buckets, BUCKET_KEY).sortBy(*order)
            writer.mode("overwrite").saveAsTable(f"{database}.{name}")
        else:
            df.write.mode("overwrite").saveAsTable(f"{database}.{name}")


def catalog_set(spark: SparkSession, database: str, names) -> dict[str, DataFrame]:
    """Tables of a database by name."""
    return {name: spark.table(f"{database}.{name}") for name in names}
