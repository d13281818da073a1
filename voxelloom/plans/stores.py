"""File formats, logs and the queue: what is written is read again and held against SQL over the tables it came from."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..functions import scalars as S
from ..model import arrow_schema, gathered, pixels, planes_of_volumes, rows_of, volumes, voxels_of_stacks
from ..model import voxels as explode_planes
from ..operators import rois as R
from ..session import scratch
from ..sources import chunks, metadata, pages, tiff, zarr
from ..sources.driver import DEPTH, VOXELS_SQL, WIDTH, planes, table
from ..streaming import queue

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
_SUMS = "t int, z int, c int, total long, top int, place int"
_PLANES_SQL = f"with {VOXELS_SQL} select t, z, c, sum(v)::bigint as total, max(v) as top, arg_max(y * 8 + x, (v, -(y * 8 + x))) as place from vox group by t, z, c"


def query(sql: str):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _sums(rows: DataFrame) -> DataFrame:
    """Sum, maximum and its place of each plane that is not all zero, as those are which fill up a stack."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in gathered(rows_of(batches)):
            v = [pixels(r["data"], r["dtype"], r["h"] * r["w"]).astype(np.int64) for r in held]
            at = [int(x.argmax()) for x in v]
            found = [{**{k: r[k] for k in "tzc"}, "total": int(x.sum()), "top": int(x[k]), "place": k // r["w"] * 8 + k % r["w"]} for r, x, k in zip(held, v, at)]
            yield pa.RecordBatch.from_pylist(found, arrow_schema(_SUMS))

    best = F.max(F.struct("top", (-F.col("place")).alias("at")))
    out = rows.mapInArrow(run, _SUMS).where("total <> 0 or top > 0").groupBy("t", "z", "c").agg(F.sum("total").alias("total"), best.alias("b")).where("b.top > 0")
    return out.select("t", "z", "c", "total", F.col("b.top").alias("top"), (-F.col("b.at")).alias("place"))


def _alike(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stacks of one depth: an empty last plane where a stack has none."""
    rows = planes(spark, sf_dir)
    last = rows.groupBy("dataset", "t", "c").agg(F.max("z").alias("z"), F.first("h").alias("h"), F.first("w").alias("w"), F.first("dtype").alias("dtype")).where(F.col("z") < DEPTH - 1)
    empty = last.withColumn("z", F.lit(DEPTH - 1)).withColumn("data", F.lit(bytes(2 * WIDTH * WIDTH))).select(*rows.columns)
    return volumes(rows.unionByName(empty))


@query(_PLANES_SQL)
def tiff_series_round_trip(spark, sf_dir):
    """A TIFF file for each (c, t), then single pages of it."""
    folder = scratch(spark, "series")
    tiff.write_series(volumes(planes(spark, sf_dir)), folder)
    return _sums(pages.read_series(spark, folder))


@query(_PLANES_SQL)
def tiff_volumes_round_trip(spark, sf_dir):
    """The same files through Spark's reader of whole files."""
    folder = scratch(spark, "volumes")
    tiff.write_series(volumes(planes(spark, sf_dir)), folder)
    return _sums(planes_of_volumes(tiff.read_volumes(spark, folder)))


@query(_PLANES_SQL)
def ome_round_trip(spark, sf_dir):
    """An OME file for each timepoint, pages found by the frame maps in their XML."""
    folder = scratch(spark, "ome")
    tiff.write_ome(planes(spark, sf_dir), folder)
    return _sums(tiff.read_ome(spark, folder))


@query(f"""with {VOXELS_SQL}, n as (select max(z) + 1 as nz, max(c) + 1 as nc from vox)
select t, z, c, (z * nc + c)::bigint as ifd, 8 as h, 8 as w, '<u2' as dtype, 128::bigint as bytes, 'embeddings_' || t || '.ome.tif' as file from (select distinct t from vox), n, range(nz) a(z), range(nc) b(c)""")
def ome_page_index(spark, sf_dir):
    """Where the pages of these files stand: one directory walk a file, joined with the frame maps."""
    folder = scratch(spark, "ome-index")
    tiff.write_ome(planes(spark, sf_dir), folder)
    found = pages.page_index(spark, folder)
    return found.select("t", F.col("z").cast("long").alias("z"), F.col("c").cast("long").alias("c"), "ifd", "h", "w", "dtype", F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n).alias("bytes"), "file")


@query(_PLANES_SQL)
def ome_whole_round_trip(spark, sf_dir):
    """The same from a path that only Spark's reader opens."""
    folder = scratch(spark, "ome-whole")
    tiff.write_ome(planes(spark, sf_dir), folder)
    return _sums(tiff.read_ome_whole(spark, folder))


@query(_PLANES_SQL)
def zarr_planes_round_trip(spark, sf_dir):
    """One array with a chunk for each plane."""
    folder = scratch(spark, "planes.zarr")
    zarr.write_planes(planes(spark, sf_dir), folder, compress=True)
    return _sums(zarr.read_planes(spark, folder))


@query(f"""with {VOXELS_SQL}, n as (select max(t) + 1 as nt, max(z) + 1 as nz, max(c) + 1 as nc from vox), sums as (select t, z, c, sum(v) as total from vox group by t, z, c),
grid as (select t, z, c from n, range(nt) i(t), range(nz) j(z), range(nc) k(c) where t >= 1 and t < 3 and z > 40 and c in (1, 4, 77))
select t::int as t, z::int as z, c::int as c, coalesce(total, 0)::bigint as total from grid left join sums using (t, z, c)""")
def zarr_scan(spark, sf_dir):
    """A part of an array, opened by the chunks' names alone; planes without a chunk are 0."""
    folder = scratch(spark, "scan.zarr")
    zarr.write_planes(planes(spark, sf_dir), folder)
    some = chunks.scan(spark, folder).where("t >= 1 and t < 3 and z > 40 and c in (1, 4, 77)")
    return explode_planes(some).groupBy("t", "z", "c").agg(F.sum("v").cast("long").alias("total"))


@query(_PLANES_SQL)
def zarr_volumes_round_trip(spark, sf_dir):
    """An array in slabs for each (t, c)."""
    folder = scratch(spark, "arrays")
    zarr.write_volumes(_alike(spark, sf_dir), folder, "b")
    return _sums(planes_of_volumes(zarr.read_volumes(spark, folder, "b")))


@query(_PLANES_SQL.replace("select t, z, c,", "select dense_rank() over (order by t) - 1 as t, z, dense_rank() over (order by c) - 1 as c,", 1))
def zarr_store_round_trip(spark, sf_dir):
    """The arrays joined into one store without copying pixels; t and c are ranks there."""
    folder = scratch(spark, "store")
    zarr.write_volumes(_alike(spark, sf_dir), folder, "b")
    zarr.consolidate(spark, folder, "b", 0.1, 2.0)
    found = _sums(zarr.read_planes(spark, os.path.join(folder, "b.ome.zarr", "0")))
    return found.select(F.col("t").cast("long").alias("t"), "z", F.col("c").cast("long").alias("c"), "total", "top", "place")


@query(f"with {VOXELS_SQL} select t, c, z, y, x + z as x, v from vox")
def deskew_only(spark, sf_dir):
    """Slices sheared by one pixel each, without turning."""
    vox = voxels_of_stacks(planes(spark, sf_dir), lambda v: K.deskew(v, 1.0), above=0)
    return vox.select("t", "c", "z", "y", "x", F.col("v").cast("int").alias("v"))


@query("""with axis as (select (i - 31) * 0.1 as p from range(63) r(i)), s as (select 0.11::double as sz, 0.29::double as sy, 0.21::double as sx),
v as (select exp(-0.5 * ((z.p / sz) ** 2 + ((y.p - z.p * tan(radians(-30.0))) / sy) ** 2 + (x.p / sx) ** 2)) as v from axis z, axis y, axis x, s)
select round(sum(v), 6) as mass, max(v) as peak, count(*) as voxels from v""")
def synthetic_psf_moments(spark, sf_dir):
    """Mass and peak of an analytic PSF, by column expressions."""
    from ..operators.psf import synthetic_psf

    return synthetic_psf(spark, 525.0).agg(S.rounded(F.sum("v"), 6).alias("mass"), F.max("v").alias("peak"), F.count("*").alias("voxels"))


@query("""select 'f' || p_partkey as file_name, p_size as top_y0, p_size + 10 as top_y1, 3 as top_x0, 9 as top_x1, case when p_size % 2 = 0 then p_size end as bottom_y0 from part""")
def roi_log_round_trip(spark, sf_dir):
    """Regions as log texts and back; half of the files have no bottom region."""
    n = F.col("p_size")
    region = lambda y1: F.struct(n.alias("y0"), (n + y1).alias("y1"), F.lit(3).alias("x0"), F.lit(9).alias("x1"))
    rows = table(spark, sf_dir, "part").select(F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("file_name"), region(10).alias("top"), F.when(n % 2 == 0, region(4)).alias("bottom"))
    found = R.read_log(R.write_log(rows))
    return found.select("file_name", *[F.col(f"top.{k}").alias(f"top_{k}") for k in ("y0", "y1", "x0", "x1")], F.col("bottom.y0").alias("bottom_y0"))


def _files(rows: DataFrame, folder: str) -> None:
    """Write (name, text) rows as small files."""
    os.makedirs(folder, exist_ok=True)

    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                os.makedirs(os.path.dirname(os.path.join(folder, r.name)), exist_ok=True)
                tiff.put(os.path.join(folder, r.name), r.text.encode("latin-1"))
            yield pdf[["name"]]

    rows.select("name", "text").mapInPandas(run, "name string").count()


@query("select 'n' || n_nationkey as run, case n_nationkey % 4 when 0 then n_nationkey / 8 when 1 then n_nationkey / 4 else 1 end::double as z_step from nation")
def acquisition_z_steps(spark, sf_dir):
    """The z step under either name, or a default where the settings have none or are corrupt."""
    k = F.col("n_nationkey")
    text = F.when(k % 4 == 0, F.format_string('{"stepSizeUm": %s, "unit": "\u00b5m"}', k / 8)).when(k % 4 == 1, F.format_string('{"zStep_um": %s, "x": "y"}', k / 4)).when(k % 4 == 2, '{"other": 3}').otherwise("{broken")
    folder = scratch(spark, "settings")
    _files(table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), k.cast("string"), F.lit("/AcqSettings.txt")).alias("name"), text.alias("text")), folder)
    found = metadata.z_step(metadata.acquisition_settings(spark, folder))
    return found.select(F.element_at(F.split("path", "/"), -2).alias("run"), "z_step")


@query("select s_suppkey::int as t, (s_suppkey % 3)::int as z, s_nationkey::int as c, (s_suppkey * 10 + 0.5)::double as elapsed_ms from supplier where s_suppkey % 5 <> 0")
def frame_times_of_files(spark, sf_dir):
    """Frame times of a metadata file; frames without one are left out."""
    k = F.col("s_suppkey")
    name = F.format_string("FrameKey-%d-%d-%d", k, k % 3, F.col("s_nationkey"))
    entry = F.concat(F.lit('"'), name, F.lit('": {'), F.when(k % 5 != 0, F.format_string('"ElapsedTime-ms": %s', k * 10 + 0.5)).otherwise('"Camera": "A"'), F.lit("}"))
    text = table(spark, sf_dir, "supplier").agg(F.concat(F.lit('{"Summary": {}, '), F.array_join(F.array_sort(F.collect_list(entry)), ", "), F.lit("}")).alias("text"))
    folder = scratch(spark, "frames")
    _files(text.withColumn("name", F.lit("run_metadata.txt")), folder)
    return metadata.frame_times(spark, f"{folder}/run_metadata.txt")


def _submitted(spark: SparkSession, sf_dir: str) -> str:
    """Tickets of all kinds, one for each nation."""
    folder = scratch(spark, "tickets")
    for r in table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect():  # one row a nation
        k, data = r["n_nationkey"], f"/data/{r['n_name']}"
        if k % 3 == 0:
            queue.submit_crop(folder, f"{data}.ome.tif", "0:4,0:4", None, [0, 1])
        elif k % 3 == 1:
            queue.submit_deskew(folder, data, 0.5, 60.0, 0.136)
        else:
            queue.submit_decon(folder, data, ["p.tif"], rl_method="omw" if k % 2 else "simple")
    return folder


@query("""select case n_nationkey % 3 when 0 then 'crop' when 1 then 'deskew' else 'decon' end as job_type, '/data/' || n_name || case when n_nationkey % 3 = 0 then '.ome.tif' else '' end as data_dir,
  n_name || case when n_nationkey % 3 = 0 then '' else '*' end as base_name, case when n_nationkey % 3 = 2 then case when n_nationkey % 2 = 1 then 2 else 25 end end as iterations from nation""")
def submitted_tickets(spark, sf_dir):
    """Tickets as the consumer's schema reads them, with the default number of iterations of their method."""
    rows = spark.read.schema(queue.TICKET).option("multiLine", "true").json(_submitted(spark, sf_dir))
    return rows.select(F.col("jobType").alias("job_type"), F.col("dataDir").alias("data_dir"), F.col("baseName").alias("base_name"), F.get_json_object("parameters", "$.iterations").cast("int").alias("iterations"))


@query("select case n_nationkey % 3 when 0 then 'crop' when 1 then 'deskew' else 'decon' end as route, case when n_nationkey % 3 = 2 and n_nationkey % 2 = 1 then 'failed' else 'completed' end as state, count(*) as n from nation group by all")
def queue_outcomes(spark, sf_dir):
    """The queue as a stream over these tickets; jobs of one method fail."""

    def handle(job: dict) -> None:
        if job["parameters"].get("rl_method") == "omw":
            raise ValueError("refused")

    results = scratch(spark, "results")
    queue.run_queue(spark, _submitted(spark, sf_dir), dict.fromkeys(("crop", "decon", "deskew", "pipeline"), handle), results, scratch(spark, "checkpoint"), per_batch=10).awaitTermination()
    return spark.read.schema(queue.RESULT).parquet(results).groupBy("route", "state").agg(F.count("*").alias("n"))


@query("select n_nationkey, n_name as source, 2 - n_nationkey % 2 as exported, case when n_nationkey % 2 = 0 then '0:' || (n_nationkey + 1) end as top_rows from nation")
def processing_logs(spark, sf_dir):
    """The log of a crop, written and read again."""
    folder = scratch(spark, "logs")
    os.makedirs(folder)
    for r in table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect():  # one row a nation
        k = r["n_nationkey"]
        log = metadata.processing_log(r["n_name"], "m.txt", "ZARR", [0] if k % 2 else [0, 1], None if k % 2 else metadata.Roi(0, k + 1, 2, 5), None, True, [])
        tiff.put(f"{folder}/{k}.json", json.dumps(log).encode())
        metadata.merge_settings(f"{folder}/{k}.json", {"rotate_90_degrees": None})
    schema = "source_base_file string, channels_exported array<int>, rotate_90_degrees boolean, rois struct<top_roi: array<string>>"
    rows = spark.read.schema(schema).option("multiLine", "true").json(folder).where("rotate_90_degrees is null")
    key = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)", 1).cast("long")
    return rows.select(key.alias("n_nationkey"), F.col("source_base_file").alias("source"), F.size("channels_exported").cast("long").alias("exported"), F.get("rois.top_roi", F.lit(0)).alias("top_rows"))
