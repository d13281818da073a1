"""Helpers that the training-data operators share: the shared folder, written tables and reading."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_OWN_FOLDERS: dict[str, str] = {}
_HELD: ContextVar[list | None] = ContextVar("held", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: `spark.checkpoint.dir`, or one of our own where it is unset (local runs, tests)."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN_FOLDERS:
            _OWN_FOLDERS[app] = tempfile.mkdtemp(prefix="voxelloom-")
        base = _OWN_FOLDERS[app]
    return base.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/voxelloom-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


@contextmanager
def temporary() -> Iterator[None]:
    """Tables materialised inside are deleted at its end, but those with keep."""
    held: list[DataFrame] = []
    token = _HELD.set(held)
    try:
        yield
    finally:
        _HELD.reset(token)
        drop(*held)


def materialize(df: DataFrame, label: str, path: str | None = None, keep: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it again: lineage is cut and lost executors recompute nothing before it."""
    spark = df.sparkSession
    path = path or new_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    if not keep and _HELD.get() is not None:
        _HELD.get().append(out)
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables written by `materialize` that no later step reads; others are left alone."""
    for path in filter(None, (getattr(t, "written_path", None) for t in tables)):
        remove(tables[0].sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def written_bytes(df: DataFrame) -> int:
    """Bytes on disk of a table written by `materialize`."""
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(df.written_path)
    return int(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(target).getLength())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
