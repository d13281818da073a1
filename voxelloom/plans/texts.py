"""Scalar-function queries over names, texts and numbers of the star tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.driver import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def register(f):
        QUERIES[name], ORACLE_SQL[name] = f, sql
        return f

    return register


@query("safe_ticket_name", r"select doc_id, regexp_replace(text, '[^\p{L}\p{M}\p{N}_\-\.]', '_', 'g') as safe from documents")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.safe_ticket_name(F.col("text")).alias("safe"))


@query("sanitize_names", "select p_partkey, replace(replace(p_name || ' x.ome.tif', '.ome.tif', ''), ' ', '_') as clean, regexp_replace(p_name || '.OME.TIF', '(?i)(\\.ome)?\\.tiff?$', '') as base, regexp_replace(p_name || '.OME.TIF', '(\\.ome)?\\.tiff?$', '') as base_strict from part")
def _(spark, sf_dir):
    upper = F.concat("p_name", F.lit(".OME.TIF"))
    return table(spark, sf_dir, "part").select("p_partkey", S.sanitize_filename(F.concat("p_name", F.lit(" x.ome.tif"))).alias("clean"), S.strip_suffix(upper, True).alias("base"), S.strip_suffix(upper).alias("base_strict"))


_BEADS_SQL = "select p_partkey, (['PSF_C0_Bead_', 'Master_Bead_', 'Avg_Bead_', 'bead_', 'PSF_'])[p_partkey % 5 + 1] || p_partkey::varchar || case when p_size % 4 = 0 then '_mask' else '' end || '.tif' as name from part"


@query("bead_files", f"select p_partkey, name from ({_BEADS_SQL}) where contains(name, 'Bead') and not contains(name, 'Master') and not contains(name, 'Avg') and not contains(name, '_mask')")
def _(spark, sf_dir):
    prefix = F.element_at(F.array(*[F.lit(x) for x in ("PSF_C0_Bead_", "Master_Bead_", "Avg_Bead_", "bead_", "PSF_")]), (F.col("p_partkey") % 5 + 1).cast("int"))
    name = F.concat(prefix, F.col("p_partkey").cast("string"), F.when(F.col("p_size") % 4 == 0, "_mask").otherwise(""), F.lit(".tif"))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name")).where(S.is_bead_file(F.col("name")))


@query("zero_padded_names", "select l_orderkey, l_linenumber, 'cell' || printf('_C%d_T%03d.tif', l_linenumber::int, (l_orderkey % 2000)::int) as name from lineitem")
def _(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.series_name(F.lit("cell"), F.col("l_linenumber").cast("int"), (F.col("l_orderkey") % 2000).cast("int")).alias("name"))


_ROIS_SQL = "select p_partkey, p_size, (p_size)::varchar || ':' || (p_size + 20)::varchar || case when p_partkey % 7 = 0 then '-' else ', ' end || (p_partkey % 90)::varchar || ':' || (p_partkey % 90 + 30)::varchar as s from part"


@query("roi_text_round_trip", rf"""select p_partkey, case when ok then y0 end as y0, case when ok then x1 end as x1, case when ok then y0::varchar || ':' || y1::varchar || ',' || x0::varchar || ':' || x1::varchar end as written from (
  select p_partkey, regexp_matches(s, '^(\d+):(\d+),\s*(\d+):(\d+)$') as ok, p_size as y0, p_size + 20 as y1, (p_partkey % 90)::int as x0, (p_partkey % 90 + 30)::int as x1 from ({_ROIS_SQL}))""")
def _(spark, sf_dir):
    y, x = F.col("p_size"), F.col("p_partkey") % 90
    text = F.concat(F.concat_ws(":", y.cast("string"), (y + 20).cast("string")), F.when(F.col("p_partkey") % 7 == 0, "-").otherwise(", "), F.concat_ws(":", x.cast("string"), (x + 30).cast("string")))
    rows = table(spark, sf_dir, "part").select("p_partkey", S.parse_roi(text).alias("r"))
    return rows.select("p_partkey", F.col("r.y0").alias("y0"), F.col("r.x1").alias("x1"), F.when(F.col("r").isNotNull(), S.roi_text(F.col("r"))).alias("written"))


@query("channel_list_parse", "select p_partkey, [p_size, (p_partkey % 5)::int] as channels, ['_C0', '_C' || p_size::varchar] as patterns from part")
def _(spark, sf_dir):
    text = F.concat(F.col("p_size").cast("string"), F.lit(" ,x, "), (F.col("p_partkey") % 5).cast("string"), F.lit(" -3"))
    patterns = F.concat(F.lit(" _C0 ,, _C"), F.col("p_size").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", S.parse_channels(text).alias("channels"), S.parse_patterns(patterns).alias("patterns"))


@query("html_strip", "select page_id, regexp_replace(html, '<[^>]+>', '', 'g') as text from pages")
def _(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", S.strip_tags(F.col("html")).alias("text"))


@query("parse_seconds", "select event_id, case when event_id % 4 = 0 then 0 else round(value, 3) end as seconds from events")
def _(spark, sf_dir):
    text = F.when(F.col("event_id") % 4 == 0, "n/a").otherwise(F.concat(F.col("value").cast("string"), F.lit(" s")))
    return table(spark, sf_dir, "events").select("event_id", S.seconds(text).alias("seconds")).withColumn("seconds", S.rounded(F.col("seconds"), 3))


@query("elapsed_times", "select event_id, epoch_us(ts) // 1000 as ticket_ms, round((epoch_us(ts) - min(epoch_us(ts)) over (partition by user_id)) / 1e6, 6) as elapsed_s from events")
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    first = events.groupBy("user_id").agg(F.min("ts").alias("t0"))
    elapsed = (S.epoch_micros(F.col("ts")) - S.epoch_micros(F.col("t0"))) / 1e6
    rows = events.join(first, "user_id").select("event_id", F.floor(S.epoch_micros(F.col("ts")) / 1000).alias("ticket_ms"), elapsed.alias("elapsed_s"))
    return rows.withColumn("elapsed_s", S.rounded(F.col("elapsed_s"), 6))


_GEOMETRY_SQL = """g as (select l_orderkey, l_linenumber, l_quantity as nz, 0.1 + l_discount as px, 0.3 + l_tax as dz, 30 + l_linenumber * 4.0 as angle, l_linenumber % 3 = 0 as obj, l_linenumber % 3 = 1 as stage from lineitem),
a as (select *, case when obj then dz / px when stage then cos(radians(angle)) * dz / px else sin(radians(angle)) * dz / px end as aniso from g)"""


@query(
    "geometry",
    f"""with {_GEOMETRY_SQL} select l_orderkey, l_linenumber, round(aniso, 6) as aniso, round(dz * sin(radians(angle)), 6) as dz_skewed,
  cast(round(round(case when obj then 277 * cos(radians(angle)) + nz * aniso * sin(radians(angle)) else 276 * cos(radians(angle)) + (nz - 1) * aniso / sin(radians(angle)) end, 6)) as int) as nx_out,
  cast(round(round(case when obj then nz * aniso * cos(radians(angle)) + 277 * sin(radians(angle)) else 276 * sin(radians(angle)) - 4 end, 6)) as int) as nz_out from a""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    angle, px, dz = F.lit(30) + F.col("l_linenumber") * 4.0, F.lit(0.1) + F.col("l_discount"), F.lit(0.3) + F.col("l_tax")
    objective, stage = F.col("l_linenumber") % 3 == 0, F.col("l_linenumber") % 3 == 1
    aniso = S.z_anisotropy(dz, px, angle, objective, stage)
    size = S.rotated_size(F.lit(1114), F.lit(277), F.col("l_quantity"), angle, aniso, objective)
    out = rows.select("l_orderkey", "l_linenumber", aniso.alias("aniso"), (dz * F.sin(F.radians(angle))).alias("dz_skewed"), size["nx"].alias("nx_out"), size["nz"].alias("nz_out"))
    return out.withColumns({c: S.rounded(F.col(c), 6) for c in ("aniso", "dz_skewed")})


@query(
    "angle_between",
    """with d as (select l_orderkey, l_linenumber, l_quantity - 25 as a1, l_linenumber - 3.5 as a2, l_discount - 0.05 as b1, l_tax - 0.04 as b2 from lineitem),
c as (select *, (a1 * b1 + a2 * b2) / nullif(sqrt(a1 * a1 + a2 * a2) * sqrt(b1 * b1 + b2 * b2), 0) as k from d),
g as (select *, degrees(acos(least(greatest(k, -1), 1))) as turn from c where k is not null)
select l_orderkey, l_linenumber, round(case when turn > 90 then 180 - turn else turn end, 4) as angle from g""",
)
def _(spark, sf_dir):
    angle = S.acute_angle(F.col("l_quantity") - 25, F.col("l_linenumber") - 3.5, F.col("l_discount") - 0.05, F.col("l_tax") - 0.04)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", angle.alias("angle")).where("angle is not null").withColumn("angle", S.rounded(F.col("angle"), 4))


@query("suggested_angle", "select l_orderkey, l_linenumber, round(degrees(atan(tan(radians(31.8)) + l_discount)), 6) as angle from lineitem")
def _(spark, sf_dir):
    from ..operators.measures import suggested_angle

    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", suggested_angle(F.lit(31.8), F.col("l_discount")).alias("angle")).withColumn("angle", S.rounded(F.col("angle"), 6))


@query("minmax_unit", "with r as (select l_suppkey, min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem group by 1) select l_orderkey, l_linenumber, l_partkey, round(case when hi > lo then least(greatest((l_extendedprice - lo) / (hi - lo), 0), 1) else 0 end, 6) as unit from lineitem join r using (l_suppkey)")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    limits = rows.groupBy("l_suppkey").agg(F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"))
    return rows.join(limits, "l_suppkey").select("l_orderkey", "l_linenumber", "l_partkey", S.unit_range(F.col("l_extendedprice"), F.col("lo"), F.col("hi")).alias("unit")).withColumn("unit", S.rounded(F.col("unit"), 6))


@query("resample_factors", "select p_partkey, case p_partkey % 3 when 0 then [p_size, p_size, p_size] when 1 then [p_size, p_size, 2] else [p_size, 2, 3] end as factors from part")
def _(spark, sf_dir):
    n = F.col("p_size")
    given = F.when(F.col("p_partkey") % 3 == 0, F.array(n)).when(F.col("p_partkey") % 3 == 1, F.array(n, F.lit(2))).otherwise(F.array(n, F.lit(2), F.lit(3)))
    return table(spark, sf_dir, "part").select("p_partkey", S.resample_factors(given).alias("factors"))


@query("job_of_index", "select p_partkey, p_partkey % 4 + 1 as c, p_partkey // 4 + 1 as t from part")
def _(spark, sf_dir):
    k = S.job_of_index(F.col("p_partkey") + 1, 4)
    return table(spark, sf_dir, "part").select("p_partkey", k["c"].alias("c"), k["t"].alias("t"))


@query("map_defaults", "select event_id, coalesce(case when event_id % 3 = 0 then value end, case when event_id % 2 = 0 then value * 2 end, 1.0) as z_step from events")
def _(spark, sf_dir):
    """The first of two keys that a settings map holds, else a default."""
    v, k = F.col("value"), F.col("event_id")
    made = F.map_from_entries(F.filter(F.array(F.when(k % 3 == 0, F.struct(F.lit("stepSizeUm").alias("k"), v.alias("v"))), F.when(k % 2 == 0, F.struct(F.lit("zStep_um").alias("k"), (v * 2).alias("v")))), lambda e: e.isNotNull()))
    rows = table(spark, sf_dir, "events").select("event_id", made.alias("m"))
    return rows.select("event_id", S.first_setting(F.col("m"), ["stepSizeUm", "zStep_um"], F.lit(1.0)).alias("z_step"))


@query(
    "derived_paths",
    """select p_partkey, replace(p_name || '.ome.tif', ' ', '_').replace('.ome.tif', '') as sanitized_name, '/d/' || p_name || '_metadata.txt' as metadata_file, '/d/processed_ngff' as output_dir,
  '/d/processed_ngff/' || replace(p_name, ' ', '_') || '_processing_log.json' as output_log from part""",
)
def _(spark, sf_dir):
    paths = S.derived_paths(F.lit("/d"), F.concat("p_name", F.lit(".ome.tif")), "ZARR")
    return table(spark, sf_dir, "part").select("p_partkey", *[c.alias(n) for n, c in paths.items()])


@query("first_assistant_turns", "select conv_id, arg_min(text, turn) as text, count(*) as turns from conversations where role = 'assistant' group by conv_id")
def _(spark, sf_dir):
    return table(spark, sf_dir, "conversations").where("role = 'assistant'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"), F.count("*").alias("turns"))
