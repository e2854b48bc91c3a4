"""Key, reference, range and domain checks."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from deliverylens.schema import TABLES


def orphan_counts(child: DataFrame, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Child rows whose reference is missing or NULL, per column: column_name, orphans.

    The child is read once for all of its references; each value is counted before it
    is looked up, so the anti joins see it once however many rows carry it.
    """
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("_ref")) for c in parents]
    used = (
        child.select(F.inline(F.array(*cells)))
        .groupBy("column_name", "_ref")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    known = None
    for column, (parent, key) in parents.items():
        keys = parent.select(F.lit(column).alias("column_name"), F.col(key).cast("string").alias("_ref"))
        known = keys if known is None else known.unionAll(keys)
    lost = used.join(known, ["column_name", "_ref"], "left_anti")
    return lost.groupBy("column_name").agg(F.sum("_rows").cast("bigint").alias("orphans"))


def validate_references(tables: Mapping[str, DataFrame], references) -> DataFrame:
    """One row per reference: reference, orphans, status."""
    columns: dict[str, list[str]] = {}
    for child, column in references:
        columns.setdefault(child, []).append(column)
    checks = None
    for child, names in columns.items():
        spec = TABLES[child]
        parents = {c: (tables[spec.references[c]], TABLES[spec.references[c]].primary_key) for c in names}
        named = [
            F.struct(F.lit(c).alias("column_name"), F.lit(f"{child}.{c} -> {spec.references[c]}").alias("reference"))
            for c in names
        ]
        all_names = tables[child].sparkSession.range(1).select(F.inline(F.array(*named)))
        check = all_names.join(orphan_counts(tables[child], parents), "column_name", "left").select(
            "reference", F.coalesce("orphans", F.lit(0)).cast("bigint").alias("orphans")
        )
        checks = check if checks is None else checks.unionAll(check)
    return checks.withColumn("status", F.when(F.col("orphans") == 0, "OK").otherwise("FAIL"))


def require_references(checks: DataFrame) -> None:
    """Fail fast when any reference check failed."""
    broken = [row.reference for row in checks.filter(F.col("orphans") > 0).collect()]
    if broken:
        raise ValueError("broken references: " + ", ".join(broken))


def primary_key_checks(tables: Mapping[str, DataFrame], names) -> DataFrame:
    """Duplicate and NULL key counts per table."""
    checks = None
    for name in names:
        key = TABLES[name].primary_key
        per_key = tables[name].groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_c"))
        check = per_key.agg(
            F.coalesce(F.count_if(F.col("_k").isNotNull() & (F.col("_c") > 1)), F.lit(0)).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_c"))), F.lit(0)).alias("null_keys"),
        ).select(F.lit(name).alias("table_name"), "duplicate_keys", "null_keys")
        checks = check if checks is None else checks.unionAll(check)
    return checks


@dataclass(frozen=True)
class Rule:
    """A condition that marks broken rows; ``null_breaks`` says whether an unknown one does."""

    name: str
    rows: DataFrame
    broken: Column
    null_breaks: bool = False


def violations(rules: list[Rule]) -> DataFrame:
    """Rows breaking each rule: rule, violations."""
    result = None
    for r in rules:
        broken = F.coalesce(r.broken, F.lit(r.null_breaks))
        row = r.rows.agg(F.count_if(broken).alias("violations")).select(F.lit(r.name).alias("rule"), "violations")
        result = row if result is None else result.unionAll(row)
    return result


def row_counts(tables: Mapping[str, DataFrame], names) -> DataFrame:
    result = None
    for name in names:
        row = tables[name].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        result = row if result is None else result.unionAll(row)
    return result


def output_presence(found: Mapping[str, DataFrame], expected, spark: SparkSession) -> DataFrame:
    """One row per expected table: table_name, present, row_count (0 where absent)."""
    result = None
    for name in expected:
        if name in found:
            row = found[name].agg(F.count(F.lit(1)).alias("row_count"))
        else:
            row = spark.range(1).select(F.lit(0).cast("bigint").alias("row_count"))
        row = row.select(F.lit(name).alias("table_name"), F.lit(name in found).alias("present"), "row_count")
        result = row if result is None else result.unionAll(row)
    return result
