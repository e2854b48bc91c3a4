"""The folder that driver and executors share, and files in it."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from deliverylens.session import remove_folder, scratch_dir

_made: list[str] = []  # folders of this application that are still there

# Other names that Hadoop has for file systems which Arrow opens
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder of ``spark.checkpoint.dir``."""
    _made.append(f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def folders_made() -> int:
    """A mark for ``drop_folders``."""
    return len(_made)


def drop_folders(spark: SparkSession, since: int, keep: int = 0) -> None:
    """Delete the folders made after a mark, but for the last ``keep`` ones. Frames that still
    read them can no longer be used."""
    gone = _made[since : len(_made) - keep]
    del _made[since : len(_made) - keep]
    for path in gone:
        remove_folder(spark, path)


def written(df: DataFrame, name: str) -> DataFrame:
    """A table written to the shared folder and read back: lineage ends there."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address, and its path there."""
    scheme, colon, rest = uri.partition(":")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}{colon}{rest}")


def small_batches(batches: Iterator[pa.RecordBatch], size: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in slices of about ``size`` bytes of a text column, so
    that a task works on little at a time however many rows a batch brings."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths) // size
        edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(part) else []
        for first, end in zip(edges[:-1], edges[1:], strict=True):
            yield batch.slice(int(first), int(end - first))
    pa.default_memory_pool().release_unused()
