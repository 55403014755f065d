"""Tables kept between the steps of a plan, in the folder that all executors share."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session, or the folder that setCheckpointDir() named. Where neither is, a temporary folder
    if there are no other machines, as in tests, and else an error: executors would each write to a disk of their own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="kinmatch-shared-")
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """df written as Parquet to the shared folder and read back: computed once however many branches read it, with a short
    plan, and safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kinmatch-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kinmatch_path = path
    return out


def _file_system(spark: SparkSession, path: str) -> tuple:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def drop(*tables: DataFrame) -> None:
    """Deletes tables of staged() that no later job reads."""
    for df in tables:
        system, at = _file_system(df.sparkSession, df._kinmatch_path)
        system.delete(at, True)


def tidy(spark: SparkSession) -> None:
    """Lets go of the shuffle files of jobs that are over: Spark deletes them once the driver has collected its garbage,
    which it else puts off for as long as its memory lasts. The scheduler and listeners name a job until they have seen
    another, so a job of nothing is run and waited for first."""
    spark.range(0, 1, 1, 1).collect()
    with contextlib.suppress(Py4JJavaError):  # a busy listener: the files go later
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def version(spark: SparkSession, *paths: str) -> tuple:
    """What tells whether files were written anew: their times and sizes."""
    found = []
    for path in paths:
        system, at = _file_system(spark, path)
        if system.exists(at):
            status = system.getFileStatus(at)
            found.append((path, status.getModificationTime(), system.getContentSummary(at).getLength()))
    return tuple(found)


_known: dict[tuple, DataFrame | tuple[DataFrame, ...]] = {}


def once(spark: SparkSession, key: tuple, make: Callable[[], DataFrame | tuple[DataFrame, ...]]) -> DataFrame | tuple[DataFrame, ...]:
    """make()'s tables, kept for the application under a key that names all they depend on."""
    full = (spark.sparkContext.applicationId, *key)
    if full not in _known:
        _known[full] = make()
    return _known[full]
