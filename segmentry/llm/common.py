"""Shared folders, tables and ranged reads of the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share (``spark.checkpoint.dir``)."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that are ``written`` inside are removed at the end, but those that are asked to stay.

    Whatever is to be read later has to be written to a table that stays before the end.
    """
    paths: list[str] = []
    outer = _PASSING.set(paths)
    try:
        yield
    finally:
        _PASSING.reset(outer)
        remove(spark, paths)


def remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: Has Spark remove the shuffle files of a query when it ends; a written table needs them no more.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that go to a Python worker at a time where they hold whole texts: executor and worker each have a batch in memory.
_BATCH, TEXTS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_024


def written(df: DataFrame, name: str, folder: str | None = None, stays: bool = False, texts: bool = False) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage: a lost executor costs a re-read.  As a file scan, the result has
    a known size, so Catalyst only broadcasts it while it is below the configured threshold.
    ``texts`` says that Python workers read whole texts for it, which they get in batches of ``TEXTS_PER_BATCH`` at most.
    """
    spark = df.sparkSession
    path = folder or shared_folder(spark, name)
    if not stays and _PASSING.get() is not None:
        _PASSING.get().append(path)
    held = {_CLEANUP: "true"}
    if texts:
        rows = int(spark.conf.get(_BATCH))
        held[_BATCH] = str(min(rows, TEXTS_PER_BATCH) if rows > 0 else TEXTS_PER_BATCH)
    before = {key: spark.conf.get(key) for key in held}
    for key, value in held.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> F.Column:
    return F.coalesce(F.col(col), F.lit(""))


def open_ranged(path: str):
    """A seekable binary file on any file system that driver and executors share."""
    parts = urlparse(path)
    if parts.scheme in ("", "file"):
        return open(unquote(parts.path), "rb")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def files_below(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, length)`` of the part files in ``folder``, listed by Spark; no content is read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "length")


def write_bytes(rows: DataFrame, folder: str) -> None:
    """Write a binary column ``value`` as files: the rows of a partition in order, each followed by a newline.

    Spark's text sink writes a string's bytes as they are, and its commit protocol makes
    the files of lost or repeated attempts disappear, on every file system Spark can write.
    """
    rows.select(F.col("value").cast("string").alias("value")).write.text(folder)


#: Bytes of rows that are broadcast at most.
BROADCAST_BYTES = 32 << 20


def sized(keys: DataFrame) -> DataFrame:
    """Written rows, broadcast if they are summed up to be at most ``BROADCAST_BYTES``; else joined by shuffle."""
    wide = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c, kind in keys.dtypes if kind in ("string", "binary")]
    width = sum(wide, F.lit(16 * len(keys.columns)))
    size = keys.agg(F.sum(width.cast("bigint"))).first()[0] or 0
    return F.broadcast(keys) if size <= BROADCAST_BYTES else keys
