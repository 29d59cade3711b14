"""Session settings and the one place that cuts lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "segmentry", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job relies on (UTC, AQE, Arrow)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the shared folder named in ``spark.checkpoint.dir``.

    A temporary folder is only ever used on a local master, where driver and
    executors are the same machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix=f"segmentry-{os.getpid()}-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage through a reliable checkpoint.

    The files live in shared storage, so a lost executor costs a re-read rather
    than a recomputation of every earlier round.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows of a task where the same rows are passed over many times.
ROWS_PER_TASK = 2_048


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """The ``rows`` rows of a cached frame in no more partitions than they fill.

    A loop runs its passes over these partitions, and near-empty ones cost a task each time.  There are never
    more of them than before, and rows enough leave them as they are.
    """
    return df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs inside go when it ends, and not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class RoundTables:
    """Tables of a loop whose rounds build on each other, written as Parquet below one shared folder.

    A file has its real size, where a checkpoint carries on the estimate of the plan that made it: estimates of joins
    multiply, and in a loop the numbers get so long that planning takes longer than the work.  The folder goes
    at the end of the ``with`` block; what is needed afterwards has to be materialized before.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.count, self.folder = spark, 0, new_folder(spark, name)

    def __enter__(self) -> RoundTables:
        return self

    def __exit__(self, *_) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def write(self, df: DataFrame, *by: str) -> DataFrame:
        """``df`` as a table, in a folder per value of ``by``."""
        self.count += 1
        path = f"{self.folder}/{self.count}"
        df.write.partitionBy(*by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
