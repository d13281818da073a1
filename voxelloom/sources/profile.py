"""Profiler pages: tables of function times in HTML, summed by job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import seconds, strip_tags

# Functions that make up each part of a job's time, and the one whose time is the whole.
PARTS = {"load": ("readzarr", "readtiff"), "decon": ("decon_lucy_function",), "dsr": ("gpuArray.imwarp",), "save": ("writezarr",)}
WHOLE = "run_gpu_pipeline"


def read(spark: SparkSession, path: str) -> DataFrame:
    """(job, func, seconds, place) of every table row with three cells or more, from pages `<job>_html/file0.html`."""
    pages = spark.read.text(path, wholetext=True).withColumn("job", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)_html/file0\.html$", 1))
    rows = pages.select("job", F.posexplode(F.regexp_extract_all("value", F.lit(r"(?is)<tr.*?>(.*?)</tr>"), 1)).alias("place", "row"))
    cells = rows.withColumn("cells", F.transform(F.regexp_extract_all("row", F.lit(r"(?is)<td.*?>(.*?)</td>"), 1), lambda c: F.trim(strip_tags(c))))
    return cells.where(F.size("cells") >= 3).select("job", F.col("cells")[0].alias("func"), seconds(F.col("cells")[2]).alias("seconds"), "place")


def summarise(rows: DataFrame) -> DataFrame:
    """(job, load, decon, dsr, save, total) of (job, func, seconds) rows; without a time for the whole, its parts' sum; the first positive one counts."""
    sums = [F.coalesce(F.sum(F.when(F.col("func").isin(*names), F.col("seconds"))), F.lit(0.0)).alias(part) for part, names in PARTS.items()]
    place = F.col("place") if "place" in rows.columns else F.lit(0)
    whole = F.min_by(F.when(F.col("func").contains(WHOLE), F.col("seconds")), F.when(F.col("func").contains(WHOLE) & (F.col("seconds") > 0), place)).alias("whole")
    parts = sum((F.col(p) for p in PARTS), F.lit(0.0))
    return rows.groupBy("job").agg(*sums, whole).withColumn("total", F.coalesce(F.nullif("whole", F.lit(0.0)), parts)).drop("whole")


def averages(jobs: DataFrame) -> DataFrame:
    """One row: means over all jobs, and how many there are."""
    return jobs.agg(F.count("*").alias("jobs"), *[F.avg(c).alias(c) for c in (*PARTS, "total")])
