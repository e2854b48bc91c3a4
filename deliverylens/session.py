"""Session settings and the shared scratch area."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_scratch: str | None = None
_interim: list[str] = []


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("deliverylens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder. On a cluster
    the setting is required, since a folder of one machine is no shared place.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="deliverylens-")
        atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_local_scratch)
    return _local_scratch


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


# Spark's setting; without it the files stay until the driver happens to collect its garbage
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Whatever is run within deletes its shuffle files when it ends."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


class StageStore:
    """Written stages of one table set, each built once.

    Every store has a folder of its own, so sets never see each other's stages,
    whatever they are called.
    """

    def __init__(self, spark: SparkSession, label: str):
        self._spark = spark
        self._folder = f"{scratch_dir(spark)}/staged/{label}-{uuid.uuid4().hex}"
        self._written: dict[str, DataFrame] = {}

    def get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Write a stage on first use and read it back.

        The reader sees real file sizes, so the planner's broadcast decision rests
        on measured bytes, and a lost executor only costs a re-read. Interim
        results of the stage are deleted once it is written.
        """
        if name not in self._written:
            before = len(_interim)
            df = build()
            path = f"{self._folder}/{name}"
            df.write.parquet(path)
            self._written[name] = self._spark.read.schema(df.schema).parquet(path)
            clear_interim(self._spark, before)
        return self._written[name]


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to a fresh scratch path and read it back.

    Cuts lineage, and lets the planner choose joins by the size really written.
    """
    path = f"{scratch_dir(df.sparkSession)}/interim/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _interim.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialized_in_turn(frames: Iterable[DataFrame], name: str) -> DataFrame:
    """``materialized`` over frames of one schema, written one after the other; the shuffle
    files of each are deleted before the next."""
    path = None
    for df in frames:
        if path is None:
            spark, schema = df.sparkSession, df.schema
            path = f"{scratch_dir(spark)}/interim/{name}-{uuid.uuid4().hex}"
            _interim.append(path)
        with shuffles_dropped(spark):
            df.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def clear_interim(spark: SparkSession, since: int = 0) -> None:
    """Delete intermediate results, all of them or those written after the first ``since``.
    Frames that still read them can no longer be used."""
    while len(_interim) > since:
        remove_folder(spark, _interim.pop())
