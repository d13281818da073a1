"""Images, files, tickets and ROI logs as views of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import voxels_of_arrays

WIDTH, DEPTH = 8, 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(t, z, c, y, x, v): each embedding is an 8 x 8 plane, its label the channel, 50 planes a stack."""
    rows = table(spark, sf_dir, "embeddings").select(
        F.expr(f"cast(vec_id div {DEPTH} as int)").alias("t"), F.expr(f"cast(vec_id % {DEPTH} as int)").alias("z"), F.col("label").cast("int").alias("c"), "embedding"
    )
    return voxels_of_arrays(rows, "embedding", WIDTH, lambda e: F.floor((e.cast("double") + 1) * 1000).cast("int"))


VOXELS_SQL = """vox as (
  select cast(vec_id // 50 as int) as t, cast(vec_id % 50 as int) as z, cast(label as int) as c,
    cast((p - 1) // 8 as int) as y, cast((p - 1) % 8 as int) as x, cast(floor((cast(e as double) + 1) * 1000) as int) as v
  from (select vec_id, label, unnest(embedding) as e, generate_subscripts(embedding, 1) as p from embeddings)
)"""


def planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same images as plane rows, without a shuffle: each embedding's voxels as little-endian u2."""
    rows = table(spark, sf_dir, "embeddings").where("embedding is not null")
    value = F.transform("embedding", lambda e: F.floor((e.cast("double") + 1) * 1000).cast("int"))
    pair = F.transform(value, lambda v: F.concat(F.lpad(F.hex(v.bitwiseAND(255)), 2, "0"), F.lpad(F.hex(F.shiftright(v, 8).bitwiseAND(255)), 2, "0")))
    return rows.select(
        F.lit("embeddings").alias("dataset"), F.expr(f"cast(vec_id div {DEPTH} as int)").alias("t"), F.expr(f"cast(vec_id % {DEPTH} as int)").alias("z"), F.col("label").cast("int").alias("c"),
        F.lit(WIDTH).alias("h"), F.lit(WIDTH).alias("w"), F.lit("<u2").alias("dtype"), F.unhex(F.array_join(pair, "")).alias("data"),
    )


def series_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dir, name, mtime, length): a TIFF series for each of five directories, from lineitem."""
    rows = table(spark, sf_dir, "lineitem")
    name = F.concat(F.lit("cell_C"), F.col("l_linenumber").cast("string"), F.lit("_T"), F.lpad((F.col("l_orderkey") % 997 + 3).cast("string"), 3, "0"), F.lit(".tif"))
    return rows.select(F.concat(F.lit("d"), (F.col("l_orderkey") % 5).cast("string")).alias("dir"), name.alias("name"), F.col("l_shipdate").alias("mtime"), F.col("l_quantity").cast("long").alias("length"))


SERIES_SQL = """files as (
  select 'd' || (l_orderkey % 5)::varchar as dir, printf('cell_C%d_T%03d.tif', l_linenumber::int, (l_orderkey % 997 + 3)::int) as name,
    l_shipdate::timestamp as mtime, l_quantity::bigint as length from lineitem
)"""


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticket, job_type, data_dir, parameters, state, ts) from events."""
    kind = F.element_at(F.array(*[F.lit(k) for k in ("crop", "deskew", "decon", "pipeline", "other")]), (F.col("event_id") % 5 + 1).cast("int"))
    state = F.when(F.col("event_type").isin("click", "view"), "queued").when(F.col("event_type") == "signup", "active").when(F.col("event_type") == "purchase", "completed").otherwise("failed")
    return table(spark, sf_dir, "events").select(
        F.concat(F.upper(kind), F.format_string("_%d.json", "event_id")).alias("ticket"), kind.alias("job_type"), F.concat(F.lit("data"), (F.col("user_id") % 100).cast("string")).alias("data_dir"),
        F.col("props").alias("parameters"), state.alias("state"), "ts", "user_id",
    )


TICKETS_SQL = """tickets as (
  select upper(job_type) || '_' || event_id::varchar || '.json' as ticket, job_type, 'data' || (user_id % 100)::varchar as data_dir, props as parameters,
    case when event_type in ('click', 'view') then 'queued' when event_type = 'signup' then 'active' when event_type = 'purchase' then 'completed' else 'failed' end as state, ts, user_id
  from (select *, (['crop', 'deskew', 'decon', 'pipeline', 'other'])[event_id % 5 + 1] as job_type from events)
)"""
