"""Intermediate tables in the folder that all executors share.

The folder is the session's ``spark.checkpoint.dir``.  A written table survives
the loss of executors, which a cached or locally checkpointed one does not.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch of whole pages.
PAGES_BYTES = 8_000_000


def shared_folder(spark: SparkSession) -> str:
    """The shared folder's URI; a temporary one is made only for an unset local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="trawl-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def delete(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another."""
    delete(spark, target)
    jpath, to = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (source, target))
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).rename(jpath, to):
        raise OSError(f"{source} can't be moved to {target}")


def exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def bucketed(df: DataFrame, keys: list[str], buckets: int, placed: bool = False) -> DataFrame:
    """`df` written once in buckets of `keys`: joins and aggregates by them don't move its rows again.

    `placed` says that its partitions are the buckets already.
    The table's name is dropped at once; what has been read by it, and the files, stay.
    """
    spark = df.sparkSession
    path = new_path(spark, "buckets")
    name = f"trawl_{uuid.uuid4().hex}"
    rows = df if placed else df.repartition(buckets, *keys)
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """`df` written once as Parquet and read again: its lineage ends at the files."""
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def page_batches(df: DataFrame) -> Iterator[DataFrame]:
    """What is run in it sends whole pages to Python in batches of few bytes, however many rows a task has."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(key)
    own = int(df.sparkSession._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch())
    conf.set(key, str(min(own, PAGES_BYTES) if own > 0 else PAGES_BYTES))
    try:
        yield df
    finally:
        conf.set(key, before)
