"""Written intermediate results that outlive the executors that made them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _is_local(master: str) -> bool:
    """Driver and executors are one process."""
    return master == "local" or master.startswith("local[")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside the block the shuffle files of a write go when it ends.

    Else they stay until the driver happens to collect its garbage, and those of a chain of jobs add up. A frame whose
    shuffles are gone makes them anew when it is used again.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, else one in the warehouse.

    On a cluster a ``file:`` warehouse lies on the driver's machine alone, as Spark's default does; without a
    checkpoint folder that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not _is_local(spark.conf.get("spark.master", None) or "") and (warehouse or "file:").startswith("file:"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that driver and executors share")
        folder = f"{warehouse.rstrip('/')}/_staged"
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/siltstone/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write the frame once and read it back, so that later steps share one result."""
    folder = new_folder(df.sparkSession, label)
    return _written(df, folder, partition_by)


def _written(df: DataFrame, folder: str, partition_by: Sequence[str], compression: str | None = None) -> DataFrame:
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    with shuffles_freed(df.sparkSession):
        writer.parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder).select(*df.columns)


@contextmanager
def staged(
    df: DataFrame, label: str, partition_by: Sequence[str] = (), compression: str | None = None
) -> Iterator[DataFrame]:
    """As ``stage``, for a result that is only needed inside the block. ``compression`` is the session's by default."""
    spark = df.sparkSession
    folder = new_folder(spark, label)
    try:
        yield _written(df, folder, partition_by, compression)
    finally:
        delete_folder(spark, folder)


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def list_folder(spark: SparkSession, folder: str) -> list[str]:
    files, path = _file_system(spark, folder)
    if not files.exists(path):
        return []
    return [status.getPath().toString() for status in files.listStatus(path)]


def delete_folder(spark: SparkSession, folder: str) -> None:
    files, path = _file_system(spark, folder)
    files.delete(path, True)
