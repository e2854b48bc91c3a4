"""Connected components of a graph given as links between numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deliverylens.llm.storage import drop_folders, folders_made, written

PART_ROWS = 500_000  # of links in one task that writes them


def _large_star(links: DataFrame, parts: int) -> DataFrame:
    """Each vertex hands its larger neighbours to its smallest one."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = written(least.coalesce(parts), "stars")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame, parts: int) -> DataFrame:
    """Each vertex hands itself and its smaller neighbours to the smallest of them.
    Here every link runs from the larger to the smaller number."""
    least = written(links.groupBy("a").agg(F.min("b").alias("m")).coalesce(parts), "stars")
    return (
        links.join(least, "a")
        .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        .where("a <> b")
    )


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) of every number in ``links`` (columns a, b): component is the
    smallest number reachable. Links to itself and null ends count for nothing, except
    that such a lone number is left out; no links give an empty result.

    Large and small stars alternate until every vertex points at its component's
    smallest one. Each round is written to the shared folder, so its cost is that of
    the links at hand and a lost executor costs a re-read. Only row counts and a sum
    come to the driver.
    """
    spark, mark = links.sparkSession, folders_made()
    links = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    state = None
    # rounds never make links more than there are, so tasks that write them follow their number
    parts = 1 + links.count() // PART_ROWS
    while True:
        links = written(_large_star(links, parts).distinct().coalesce(parts), "links")
        links = written(_small_star(links, parts).distinct().coalesce(parts), "links")
        # stars only ever lower the ends of links, so equal sums mean that nothing moved
        now = links.agg(
            F.count(F.lit(1)), F.sum(F.col("b").cast("decimal(38,0)")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        # what went before the links at hand has been read for the last time
        drop_folders(spark, mark, keep=1)
        if now == state:
            break
        state = now
    smallest = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(smallest)
