"""Reading the corpus tables and cutting lineage through the cluster's shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; on a single machine without one, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        return _own_folder()
    return folder.rstrip("/")


@cache
def _own_folder() -> str:
    """One temporary folder for this process, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="duepulse-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


#: Tables and folders that this process has written and not removed, in their order.
_made: list[str] = []


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs within go when a job ends, not at some later collection of garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the rows to the shared folder and reads them again, which cuts the lineage.

    The table goes when the process ends, or by :func:`remove_since`. What was shuffled for it is
    of no use once it is written, and goes at once.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_remove_all)
    if not folder:
        _made.append(path)
    with _shuffles_go(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def made() -> int:
    """How many tables this process has written so far, for :func:`remove_since`."""
    return len(_made)


def remove_since(spark: SparkSession, mark: int, but_last: int = 0) -> None:
    """Removes the tables written since a call of :func:`made`, without the last ones."""
    end = len(_made) - but_last
    for folder in _made[mark:end]:
        _remove(spark, folder)
    del _made[mark:end]


def _remove_all() -> None:
    """As the process ends; a session that is stopped by then leaves its tables."""
    spark = SparkSession.getActiveSession()
    with suppress(Exception):
        if spark and spark.sparkContext._jsc:
            remove_since(spark, 0)


class Scratch:
    """Written tables that are removed once a result made from them is written itself."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"

    def stored(self, df: DataFrame) -> DataFrame:
        return stored(df, self.folder)

    def settled(self, df: DataFrame) -> DataFrame:
        """The rows, written outside the scratch folder, which goes."""
        result = stored(df)
        self.remove()
        return result

    def remove(self) -> None:
        _remove(self.spark, self.folder)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[list[pa.Array]]:
    """The columns of the batches, some rows at a time, so that few texts are Python objects at once.

    After the last, what the worker has freed goes back to the system.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows).columns
    release()


def release() -> None:
    """Gives freed memory back; with Arrow's system pool that is all of the process's, not Arrow's alone."""
    pa.default_memory_pool().release_unused()


def fold(key: Column) -> Column:
    """Fold of a document: crc32 of its id as text, modulo 4. Null for a null id."""
    return F.crc32(key.cast("string").cast("binary")) % 4


def held_out(key: Column) -> Column:
    """Whether the fold is the one that no model learns from; false for a null id."""
    return F.coalesce(fold(key) == 2, F.lit(False))


def shuffle_width(df: DataFrame) -> int:
    """Partitions of a shuffle as the session has them."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
