"""Readers and writers for the table set."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from deliverylens.schema import TABLES, TableSpec


# quotes within a value are doubled, as other tools read and write them
QUOTING = {"quote": '"', "escape": '"'}
# exports keep all six places of a second
EXACT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_csv_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A CSV with header, every column as text. Columns are named by the header.

    ``multi_line`` also reads values with line breaks; each file is then one task, since
    a file cannot be split where a break may stand within a value.
    """
    reader = spark.read.options(**QUOTING).option("header", True).option("inferSchema", False)
    return reader.option("multiLine", multi_line).csv(path)


def _whole_number(column: Column, f) -> Column:
    """Whole numbers, also when written with a fraction of zero ("120.0"); any other
    fraction is unreadable."""
    value = column.try_cast("double")
    whole = F.when(value == F.floor(value), value.try_cast(f.type))
    exact = column.try_cast(f.type)
    return F.coalesce(exact, whole) if f.lenient else F.coalesce(exact, whole, column.cast(f.type))


def typed_columns(spec: TableSpec, processed: bool) -> list[Column]:
    """The table's columns by name. Strict ones fail on unreadable text, lenient ones become NULL."""
    columns = []
    for f in spec.columns(processed):
        text = F.col(f.name)
        if f.type in ("int", "bigint"):
            value = _whole_number(text, f)
        else:
            value = text.try_cast(f.type) if f.lenient else text.cast(f.type)
        columns.append(value.alias(f.name))
    return columns


def read_csv_table(
    spark: SparkSession,
    path: str,
    table: str,
    processed: bool = False,
    with_arrival: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """One table from CSV. ``with_arrival`` adds the file order of the rows for keep-first rules."""
    columns = typed_columns(TABLES[table], processed)
    if with_arrival:
        # ids grow along a file block, so the triple follows the order of the lines
        columns.append(
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"),
            ).alias("arrival")
        )
    return read_csv_text(spark, path, multi_line).select(*columns)


def read_csv_set(spark: SparkSession, folder: str, names=None, processed: bool = False) -> dict[str, DataFrame]:
    """Every table of a folder of ``<table>.csv`` exports; raw sets carry an arrival order."""
    return {
        name: read_csv_table(spark, f"{folder}/{name}.csv", name, processed, with_arrival=not processed)
        for name in (names or TABLES)
    }


def write_csv_table(df: DataFrame, path: str, packed: bool = False) -> None:
    """CSV with header and doubled quotes. Values with line breaks need ``multi_line`` when
    read; Parquet keeps every value and stays splittable. ``packed`` files are compressed
    (gzip) and one task each when read."""
    writer = df.write.mode("overwrite").options(**QUOTING, **EXACT_TIMES).option("header", True)
    if packed:
        writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.csv(path)


def write_parquet_set(tables: Mapping[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def read_parquet_set(spark: SparkSession, folder: str, names) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def tables_in(spark: SparkSession, folder: str, names) -> dict[str, DataFrame]:
    """Those of the named Parquet tables that a folder holds."""
    found = {}
    for name in names:
        try:
            found[name] = spark.read.parquet(f"{folder}/{name}")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return found


def append_tables(tables: Mapping[str, DataFrame], database: str) -> None:
    """Append every table to the catalog; columns are matched by name."""
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        target = f"{database}.{name}"
        if spark.catalog.tableExists(target):
            df.select(*spark.table(target).columns).write.mode("append").saveAsTable(target)
        else:
            df.write.saveAsTable(target)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_report(sheets: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    """One directory per report sheet."""
    for name, df in sheets.items():
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.options(**QUOTING, **EXACT_TIMES).option("header", True)
        writer.format(fmt).save(f"{folder}/{name}")
