"""Cut lineage by writing a stage to the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only where it is unset and all runs on this machine."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        where = "file://" + tempfile.mkdtemp(prefix="strandloom-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


_made: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path that no other run uses; removed when the JVM ends, if not before (see ``release``)."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


#: Deletes the shuffle files of a plan once it has run; without it they stay until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Plans that run inside leave no shuffle files; the session's setting comes back after them."""
    was = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if was is None else spark.conf.set(_CLEANUP, was)


def snapshot(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The task commit protocol makes this safe when an executor is lost, and
    later stages restart from the files instead of the whole lineage. As they
    do, the shuffle files of the write go with it.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mark() -> int:
    """How many paths there were so far, for ``release``."""
    return len(_made)


def release(spark: SparkSession, since: int, keep: int = 1) -> None:
    """Delete what was written after ``since`` but the newest path (or ``keep``): call it when that has all that is still needed."""
    jvm = spark.sparkContext._jvm
    end = len(_made) - keep
    for path in _made[since:end]:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    del _made[since:end]
