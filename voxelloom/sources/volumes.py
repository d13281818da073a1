"""Volumes by the kind of store a path names, and work that is still to be done."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tiff, zarr


def read(spark: SparkSession, path: str, base: str | None = None) -> DataFrame:
    """Volume rows of a folder: the (t, c) arrays of a base name, if one is given, else its TIFF series."""
    return zarr.read_volumes(spark, path, base) if base else tiff.read_volumes(spark, path)


def concatenated(parts: list[DataFrame]) -> DataFrame:
    """Plane rows of several files of one stack, in order: each file's slices follow the last one's."""
    rows = reduce(DataFrame.unionByName, [planes.withColumn("part", F.lit(k)) for k, planes in enumerate(parts)])
    depths = {r["part"]: r["depth"] for r in rows.groupBy("part").agg((F.max("z") + 1).alias("depth")).collect()}
    starts = [sum(depths.get(j, 1) for j in range(k)) for k in range(len(parts))]
    return rows.withColumn("z", (F.col("z") + F.get(F.lit(starts), F.col("part"))).cast("int")).drop("part")


def stack(planes: DataFrame, t: int, c: int, depth: int, height: int, width: int) -> DataFrame:
    """(z, data) of one stack, every slice there: planes that are missing are zero bytes of a u2 plane. t and c are pushed to the scan."""
    rows = planes.where((F.col("t") == t) & (F.col("c") == c)).select("z", "data")
    grid = planes.sparkSession.range(depth).select(F.col("id").cast("int").alias("z"))
    zero = F.lit(bytes(2 * height * width))
    return grid.join(rows, "z", "left").select("z", F.coalesce("data", zero).alias("data"))


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What a job still has to do: its keys without those of finished outputs."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")
