"""Cutting lineage with written tables that survive the loss of executors."""

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Tables made in the scopes that are open, innermost last.
_scopes: list[list[str]] = []
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a session on one machine (tests) may leave it unset and gets a temporary folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("slatemill.shared.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        found = "file://" + tempfile.mkdtemp(prefix="slatemill-")
        spark.conf.set("slatemill.shared.dir", found)
        atexit.register(shutil.rmtree, found[len("file://") :], True)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Writes df to a table in the shared folder and reads it from there.

    The files are replicated by the file system, so a lost executor costs no recomputation of what came before.
    """
    spark = df.sparkSession
    path = _written(df)
    remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def lent(df: DataFrame) -> Iterator[DataFrame]:
    """As ``cut``, but the table is removed when the block ends: what is made from it must be written inside."""
    spark = df.sparkSession
    path = _written(df)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _remove(spark, path)


def _written(df: DataFrame) -> str:
    """The path of a new table of df. What was shuffled for it alone is removed with the end of the write, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path, kept = f"{shared_dir(spark)}/slatemill-{uuid.uuid4().hex}", spark.conf.get(_FREE, "false")
    spark.conf.set(_FREE, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_FREE, kept)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A scope whose tables are removed at its end: results must be written or collected inside it. A long session opens one for each query."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _remove(spark, path)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Results are lazy, so what they read stays until the scope or, without one, the driver ends."""
    if _scopes:
        _scopes[-1].append(path)
    else:
        atexit.register(_remove, spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session is already stopped: the folder's owner clears it
        pass
