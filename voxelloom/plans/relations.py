"""File, ticket, ROI-log and metadata queries over the star tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import names as N
from ..operators import rois as R
from ..operators import tickets as T
from ..sources.driver import SERIES_SQL, TICKETS_SQL, series_files, table, tickets

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str):
    """Register f(spark, sf_dir), with SQL over the views `files`, `series` and `tickets`."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        more, _, rest = sql.partition(";;")
        ORACLE_SQL[name] = f"with {SERIES_SQL}, {_PARSED_SQL}, {TICKETS_SQL}{', ' + more if rest else ''} {rest or more}"
        return f

    return register


_PARSED_SQL = r"""series as (select *, regexp_extract(name, '(?i)^(.*?)_C(\d+)_T(\d+)\.tif$', 1) as base,
  regexp_extract(name, '(?i)^(.*?)_C(\d+)_T(\d+)\.tif$', 2)::int as c, regexp_extract(name, '(?i)^(.*?)_C(\d+)_T(\d+)\.tif$', 3)::int as t from files)"""


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.parse_series(series_files(spark, sf_dir))


def stacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series(spark, sf_dir).select("dir", "base", "t", "c", "name").distinct()


@query("parse_series_name", "select dir, name, base, c, t, length from series")
def _(spark, sf_dir):
    return series(spark, sf_dir).select("dir", "name", "base", "c", "t", "length")


@query("index_normalise", "select dir, name, t - min(t) over (partition by dir) as t, c - min(c) over (partition by dir) as c from (select distinct dir, name, t, c from series)")
def _(spark, sf_dir):
    return N.normalised_index(stacks(spark, sf_dir)).select("dir", "name", "t", "c")


@query("index_dense_rank", "select dir, name, (dense_rank() over (partition by dir order by t) - 1)::int as t, (dense_rank() over (partition by dir order by c) - 1)::int as c from (select distinct dir, name, t, c from series)")
def _(spark, sf_dir):
    return N.ranked_index(stacks(spark, sf_dir)).select("dir", "name", "t", "c")


@query("index_ranges", "select dir, min(t) as t_min, max(t) as t_max, count(distinct t) as n_t, min(c) as c_min, max(c) as c_max, count(distinct c) as n_c from series group by dir")
def _(spark, sf_dir):
    ranges = [f(k).alias(n) for k in ("t", "c") for f, n in ((F.min, f"{k}_min"), (F.max, f"{k}_max"), (F.countDistinct, f"n_{k}"))]
    return series(spark, sf_dir).groupBy("dir").agg(*ranges)


@query(
    "chunk_keys",
    """k as (select distinct dir, t, c, length::int % 4 as iz from series), r as (select *, dense_rank() over (partition by dir order by t) - 1 as rt, dense_rank() over (partition by dir order by c) - 1 as rc from k);;
select dir, rt::int as t, rc::int as c, iz, rt::varchar || '.' || rc::varchar || '.' || iz::varchar || '.0.0' as key from r""",
)
def _(spark, sf_dir):
    chunks = series(spark, sf_dir).select("dir", "t", "c", F.pmod(F.col("length").cast("int"), F.lit(4)).alias("iz"), F.lit(0).alias("iy"), F.lit(0).alias("ix")).distinct()
    return N.chunk_keys(chunks).select("dir", "t", "c", "iz", "key")


@query("chunk_counts", "select dir, t, count(*) as chunks, count(distinct c) as channels from (select distinct dir, t, c from series) group by dir, t")
def _(spark, sf_dir):
    return stacks(spark, sf_dir).groupBy("dir", "t").agg(F.count("*").alias("chunks"), F.countDistinct("c").alias("channels"))


@query(
    "first_base",
    """f as (select distinct dir, name, case when c % 2 = 0 then 'a_' else 'b_' end || base as base, t, c from series);;
select f.* from f join (select dir, arg_min(base, name) as first_b from f group by dir) using (dir) where base = first_b""",
)
def _(spark, sf_dir):
    named = stacks(spark, sf_dir).withColumn("base", F.concat(F.when(F.col("c") % 2 == 0, "a_").otherwise("b_"), "base")).select("dir", "name", "base", "t", "c")
    return N.first_base(named).select("dir", "name", "base", "t", "c")


_LLSM_SQL = """l as (select distinct 'cell_Cam' || case when l_linenumber % 2 = 0 then 'A' else 'B' end || printf('_ch%d_stack%04d_x.tif', (l_linenumber // 2)::int, (l_orderkey % 211)::int) as name from lineitem)"""


def llsm_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    camera = F.when(F.col("l_linenumber") % 2 == 0, "A").otherwise("B")
    tail = F.format_string("_ch%d_stack%04d_x.tif", F.floor(F.col("l_linenumber") / 2).cast("int"), (F.col("l_orderkey") % 211).cast("int"))
    return rows.select(F.concat(F.lit("cell_Cam"), camera, tail).alias("name")).distinct()


@query(
    "llsm_collisions",
    _LLSM_SQL
    + r""", p as (select name, regexp_extract(name, '_Cam([AB])', 1) as camera, regexp_extract(name, '_ch(\d+)_', 1)::int as c, regexp_extract(name, '_stack(\d+)', 1)::int as t from l);;
select c, t, name, 'cell' as base, camera from p qualify row_number() over (partition by c, t order by name desc) = 1""",
)
def _(spark, sf_dir):
    return N.parse_llsm(llsm_files(spark, sf_dir))


@query(
    "detect_type",
    _LLSM_SQL
    + r""", a as (select dir, name from files union all select 'llsm', name from l union all select 'other', p_name from part);;
select dir, case when bool_or(regexp_matches(name, '(?i)^(.*?)_C(\d+)_T(\d+)\.tif$')) then 'OPM' when bool_or(regexp_matches(name, '(?i)^(.*?)_Cam([AB])_ch(\d+)_stack(\d+)')) then 'LLSM' else 'UNKNOWN' end as data_type from a group by dir""",
)
def _(spark, sf_dir):
    others = table(spark, sf_dir, "part").select(F.lit("other").alias("dir"), F.col("p_name").alias("name"))
    return N.data_type(series_files(spark, sf_dir).select("dir", "name").unionByName(llsm_files(spark, sf_dir).select(F.lit("llsm").alias("dir"), "name")).unionByName(others))


@query(
    "channel_patterns_csv",
    _LLSM_SQL
    + r""", a as (select dir, name from files union all select 'llsm', name from l), m as (select distinct dir, regexp_extract(name, '(?i)(_C\d+|Cam[AB])', 1) as mark from a);;
select dir, string_agg(mark, ', ' order by mark) as patterns from m where mark <> '' group by dir""",
)
def _(spark, sf_dir):
    return N.channel_patterns(series_files(spark, sf_dir).select("dir", "name").unionByName(llsm_files(spark, sf_dir).select(F.lit("llsm").alias("dir"), "name")))


@query("newest_dir_top1", "select dir, name, mtime from (select distinct dir, name, mtime from files) qualify row_number() over (partition by dir order by mtime desc, name) = 1")
def _(spark, sf_dir):
    return N.newest(series_files(spark, sf_dir))


_OME_SQL = r"o as (select 'd' || (o_custkey % 50)::varchar as dir, 'run' || (o_orderkey % 7)::varchar || case when o_orderkey % 3 = 0 then '_1' else '' end || '.ome.tif' as name from orders)"


def ome_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(F.col("o_orderkey") % 3 == 0, "_1").otherwise("")
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("d"), (F.col("o_custkey") % 50).cast("string")).alias("dir"), F.concat(F.lit("run"), (F.col("o_orderkey") % 7).cast("string"), part, F.lit(".ome.tif")).alias("name"))


@query("base_file_choice", _OME_SQL + r";; select dir, name from (select distinct dir, name from o) qualify row_number() over (partition by dir order by regexp_matches(name, '_\d+\.ome\.tif$'), name) = 1")
def _(spark, sf_dir):
    return N.base_file(ome_files(spark, sf_dir))


@query("concat_z_offset", "f as (select dir, name, sum(length)::bigint as nz from files group by dir, name);; select dir, name, nz, coalesce(sum(nz) over (partition by dir order by name rows between unbounded preceding and 1 preceding), 0)::bigint as z0 from f")
def _(spark, sf_dir):
    files = series_files(spark, sf_dir).groupBy("dir", "name").agg(F.sum("length").alias("nz"))
    return N.z_offsets(files)


@query("linear_frame_index", "select l_orderkey, l_linenumber, (l_orderkey % 9) * (40 * 4) + (l_linenumber % 4) * 40 + l_partkey % 40 as xyzct, (l_orderkey % 9) * (40 * 4) + (l_partkey % 40) * 4 + l_linenumber % 4 as xyczt from lineitem")
def _(spark, sf_dir):
    t, z, c = F.col("l_orderkey") % 9, F.col("l_partkey") % 40, F.col("l_linenumber") % 4
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", N.linear_frame(t, z, c, 40, 4, "XYZCT").alias("xyzct"), N.linear_frame(t, z, c, 40, 4).alias("xyczt"))


@query(
    "frame_map_files",
    """x as (select distinct l_linenumber as c, l_orderkey % 300 as t, l_partkey % 20 as z, 'part_' || (l_suppkey % 40)::varchar || '.tif' as file from lineitem), d as (select 'part_' || s_suppkey::varchar || '.tif' as file, s_suppkey + 1 as file_index from supplier where s_suppkey < 30);;
select c, t, z, file, coalesce(file_index, 0) as file_index from x left join d using (file)""",
)
def _(spark, sf_dir):
    """XML frames and the files on disk; a frame whose file is missing is unmapped, index 0."""
    frames = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("c"), (F.col("l_orderkey") % 300).alias("t"), (F.col("l_partkey") % 20).alias("z"), F.concat(F.lit("part_"), (F.col("l_suppkey") % 40).cast("string"), F.lit(".tif")).alias("file")).distinct()
    disk = table(spark, sf_dir, "supplier").where("s_suppkey < 30").select(F.concat(F.lit("part_"), F.col("s_suppkey").cast("string"), F.lit(".tif")).alias("file"), (F.col("s_suppkey") + 1).alias("file_index"))
    from ..sources.omexml import frame_map, with_file_index

    # each frame as the element of an OME-XML text that names it, attributes in an order of its own
    element = F.format_string('<TiffData IFD="7" FirstZ="%d" FirstT="%d" PlaneCount="1" FirstC="%d"><UUID FileName="%s">u</UUID></TiffData>', "z", "t", "c", "file")
    listed = frame_map(frames.select(element.alias("xml")))
    listed = listed.select(F.col("c").cast("long").alias("c"), F.col("t").cast("long").alias("t"), F.col("z").cast("long").alias("z"), "file")
    return with_file_index(listed, disk)


_LOG_SQL = "log as (select 'f' || (p_partkey % 500)::varchar as file_name, p_size as y0, p_size + 10 as y1, p_partkey as stamp from part)"


def roi_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.concat(F.lit("f"), (F.col("p_partkey") % 500).cast("string")).alias("file_name"), F.col("p_size").alias("y0"), (F.col("p_size") + 10).alias("y1"), F.col("p_partkey").alias("stamp"))


@query("roi_upsert_latest", _LOG_SQL + ";; select file_name, y0, y1, stamp from log qualify row_number() over (partition by file_name order by stamp desc) = 1")
def _(spark, sf_dir):
    return N.upsert_latest(roi_log(spark, sf_dir), "file_name", ["stamp"])


@query(
    "roi_lookup_join",
    _LOG_SQL + ", latest as (select * from log qualify row_number() over (partition by file_name order by stamp desc) = 1), f as (select 'f' || (o_custkey % 700)::varchar as file_name, o_orderkey from orders);; select o_orderkey, file_name, y0, y1, y0 is not null as found from f left join latest using (file_name)",
)
def _(spark, sf_dir):
    files = table(spark, sf_dir, "orders").select(F.concat(F.lit("f"), (F.col("o_custkey") % 700).cast("string")).alias("file_name"), "o_orderkey")
    latest = N.upsert_latest(roi_log(spark, sf_dir), "file_name", ["stamp"]).drop("stamp")
    return files.join(latest, "file_name", "left").withColumn("found", F.col("y0").isNotNull())


@query(
    "roi_snap",
    """select p_partkey, case when p_size >= 5 and p_size + 3 >= 5 then ((p_partkey % 90 + p_partkey % 90 + p_size) // 2 - 10) end as y0, case when p_size >= 5 and p_size + 3 >= 5 then ((p_partkey % 70 + p_partkey % 70 + p_size + 3) // 2 - 15) end as x0,
  case when p_size >= 5 then 21 end as h, case when p_size >= 5 then 30 end as w from part""",
)
def _(spark, sf_dir):
    y, x, n = F.col("p_partkey") % 90, F.col("p_partkey") % 70, F.col("p_size")
    first = F.struct(F.lit(0).alias("y0"), F.lit(21).alias("y1"), F.lit(5).alias("x0"), F.lit(35).alias("x1"))
    drawn = F.struct(y.alias("y0"), (y + n).alias("y1"), x.alias("x0"), (x + n + 3).alias("x1"))
    rows = table(spark, sf_dir, "part").withColumn("first", first).withColumn("drawn", drawn)
    s = R.snapped(F.col("first"), F.col("drawn"))
    return rows.select("p_partkey", s["y0"].alias("y0"), s["x0"].alias("x0"), (s["y1"] - s["y0"]).alias("h"), (s["x1"] - s["x0"]).alias("w"))


@query(
    "frame_time_fallback",
    """f as (select user_id as dataset, (event_id % 50)::int as t, min(value) * 1000 as elapsed_ms from events where event_type <> 'error' group by all), g as (select distinct user_id as dataset, unnest(range(50))::int as t from events);;
select dataset, t, round(coalesce(elapsed_ms / 1000, t * 6.0), 6) as elapsed_s from g left join f using (dataset, t)""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    frames = events.where("event_type <> 'error'").groupBy(F.col("user_id").alias("dataset"), (F.col("event_id") % 50).cast("int").alias("t")).agg((F.min("value") * 1000).alias("elapsed_ms"))
    grid = events.select(F.col("user_id").alias("dataset")).distinct().withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(49))))
    return N.frame_times(grid, frames, 6.0, ["dataset", "t"]).withColumn("elapsed_s", S.rounded(F.col("elapsed_s"), 6))


@query("missing_chunks_anti", "select o_orderkey from orders except select l_orderkey from lineitem")
def _(spark, sf_dir):
    have = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey").distinct().join(have, "o_orderkey", "left_anti")


@query("batch_minus_template", "select o_orderkey, o_orderstatus from orders where o_custkey not in (select c_custkey from customer where c_nationkey = 3)")
def _(spark, sf_dir):
    template = table(spark, sf_dir, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf_dir, "orders").join(template, "o_custkey", "left_anti").select("o_orderkey", "o_orderstatus")


@query("bead_mask_join", "select p_partkey, coalesce('mask_' || s_suppkey::varchar, 'auto') as mask from part left join supplier on p_partkey = s_suppkey")
def _(spark, sf_dir):
    masks = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("stem"), F.concat(F.lit("mask_"), F.col("s_suppkey").cast("string")).alias("mask"))
    return N.with_masks(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("stem")), masks).withColumnRenamed("stem", "p_partkey")


@query(
    "dsr_decon_pairs",
    """a as (select l_suppkey as channel, min(l_orderkey) as dsr from lineitem where l_returnflag = 'A' group by 1), b as (select l_suppkey as channel, min(l_orderkey) as decon from lineitem where l_returnflag = 'R' group by 1);; select channel, dsr, decon from a join b using (channel)""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    one = lambda flag, name: rows.where(F.col("l_returnflag") == flag).groupBy(F.col("l_suppkey").alias("channel")).agg(F.min("l_orderkey").alias(name))
    return N.pairs_by_channel(one("A", "dsr"), one("R", "decon"))


@query("channel_psf", "select s_suppkey as channel, case when s_suppkey % 3 = 0 then 'psf_own' else 'psf_0' end as psf from supplier")
def _(spark, sf_dir):
    """Each channel's PSF, or the only one there is."""
    channels = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("channel"))
    return N.with_psfs(channels, channels.where("channel % 3 = 0").withColumn("psf", F.lit("psf_own")), "psf_0")


@query("redirected_dirs", "select c_custkey, case when c_mktsegment = 'BUILDING' then 'file' when c_nationkey < 12 then 'dir' else 'legacy' end as found from customer")
def _(spark, sf_dir):
    found = N.redirected(F.when(F.col("c_mktsegment") == "BUILDING", "file"), F.when(F.col("c_nationkey") < 12, "dir"), F.lit("legacy"))
    return table(spark, sf_dir, "customer").select("c_custkey", found.alias("found"))


@query(
    "resolved_sources",
    """links as (select place, arg_min(target, (rank, target)) as target from (
  select 'd' || c_custkey as place, 2 as rank, 'd' || (c_custkey * 3 % 1501) as target from customer where c_custkey % 4 <> 0
  union all select 'f' || o_orderkey, 1, 'd' || (o_custkey % 1000) from orders where o_orderkey % 7 = 0
  union all select 'f' || o_orderkey, 3, 'd' || o_custkey from orders where o_orderkey % 5 = 0) group by place);;
select path, case when not cyclic then place end as place, case when not cyclic then steps end as steps, cyclic from (
  with recursive walk as (
    select 'f' || o_orderkey as path, 'f' || o_orderkey as place, 0::bigint as steps, ['f' || o_orderkey] as seen, false as cyclic from orders
    union all select path, target, steps + 1, list_append(seen, target), list_contains(seen, target) from walk join links using (place) where not cyclic
  ) select path, arg_max(place, len(seen)) as place, max(steps) as steps, bool_or(cyclic) as cyclic from walk group by path)""",
)
def _(spark, sf_dir):
    """Sources of jobs over chains of redirects, some of which run in cycles."""
    k, o, d = F.col("c_custkey"), F.col("o_orderkey"), F.col("o_custkey")
    named = lambda mark, n: F.concat(F.lit(mark), n.cast("string"))
    row = lambda rows, place, kind, target: rows.select(place.alias("place"), F.lit(kind).alias("kind"), target.alias("target"))
    customers, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    redirects = row(customers.where(k % 4 != 0), named("d", k), "folder", named("d", k * 3 % 1501))
    redirects = redirects.unionByName(row(orders.where(o % 7 == 0), named("f", o), "file", named("d", d % 1000)))
    redirects = redirects.unionByName(row(orders.where(o % 5 == 0), named("f", o), "legacy", named("d", d)))
    return N.resolved(orders.select(named("f", o).alias("path")), redirects)


@query("first_free_number", "n as (select distinct l_suppkey, l_quantity::int as k from lineitem), g as (select l_suppkey, k, row_number() over (partition by l_suppkey order by k) as nth from n);; select l_suppkey, coalesce(min(nth) filter (k <> nth), max(nth) + 1) as free from g group by l_suppkey")
def _(spark, sf_dir):
    taken = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").cast("int").alias("k"))
    return N.first_free(taken, "l_suppkey", "k").select("l_suppkey", F.col("free").cast("long").alias("free"))


@query("max_shape_odd", "select l_suppkey, max(l_quantity)::int + (1 - max(l_quantity)::int % 2) as mz, max(l_linenumber) + (1 - max(l_linenumber) % 2) as my from lineitem group by l_suppkey")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").alias("mz"), F.col("l_linenumber").alias("my"))
    return N.odd_canvas(rows, ["l_suppkey"], ["mz", "my"])


@query("channel_count_default", "select o_orderkey, coalesce(nullif(o_custkey % 9, 0), 4) as channels from orders")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", N.channel_count(F.col("o_custkey") % 9).alias("channels"))


@query("ticket_priority_order", "select data_dir, min(ticket) as ticket from tickets where state = 'queued' group by data_dir")
def _(spark, sf_dir):
    return T.next_ticket(tickets(spark, sf_dir), ["data_dir"])


@query("ticket_terminal_semi", "select distinct data_dir, job_type from tickets where state = 'queued' and user_id in (select user_id from tickets where state in ('completed', 'failed'))")
def _(spark, sf_dir):
    rows = tickets(spark, sf_dir)
    done = rows.where(F.col("state").isin("completed", "failed")).select("user_id").distinct()
    return rows.where("state = 'queued'").join(done, "user_id", "left_semi").select("data_dir", "job_type").distinct()


@query("ticket_state_counts", "select data_dir, state, count(*) as n, max(ts) as last_ts from tickets group by all")
def _(spark, sf_dir):
    return tickets(spark, sf_dir).groupBy("data_dir", "state").agg(F.count("*").alias("n"), F.max("ts").alias("last_ts"))


@query("ticket_last_state", "select user_id, arg_max(state, (ts, ticket)) as state, max(ts) as ts from tickets group by user_id")
def _(spark, sf_dir):
    return T.last_state(tickets(spark, sf_dir), "user_id")


@query("dispatch_routes", "select ticket, case when job_type in ('crop', 'pipeline', 'decon') then job_type else 'deskew' end as route from tickets")
def _(spark, sf_dir):
    return tickets(spark, sf_dir).select("ticket", T.route(F.col("job_type")).alias("route"))


@query("batch_finished", "q as (select distinct user_id, job_type from tickets where state in ('queued', 'active'));; select distinct user_id, job_type from tickets t where not exists (select 1 from q where q.user_id = t.user_id and q.job_type = t.job_type)")
def _(spark, sf_dir):
    """Each user's jobs of one type are a batch; those of which none is queued or active."""
    rows = tickets(spark, sf_dir)
    busy = rows.where(F.col("state").isin("queued", "active")).select("user_id", "job_type").distinct()
    return rows.select("user_id", "job_type").distinct().join(busy, ["user_id", "job_type"], "left_anti")


@query("datadir_union_distinct", "select data_dir from tickets where state = 'completed' union select data_dir from tickets where state = 'failed'")
def _(spark, sf_dir):
    rows = tickets(spark, sf_dir)
    return rows.where("state = 'completed'").select("data_dir").union(rows.where("state = 'failed'").select("data_dir")).distinct()


@query("consolidation_due", "d as (select distinct data_dir from tickets where state in ('completed', 'failed'));; select data_dir from d where data_dir in (select 'data' || (s_suppkey % 100)::varchar from supplier where s_nationkey < 10)")
def _(spark, sf_dir):
    sidecars = table(spark, sf_dir, "supplier").where("s_nationkey < 10").select(F.concat(F.lit("data"), (F.col("s_suppkey") % 100).cast("string")).alias("data_dir"))
    return tickets(spark, sf_dir).where(F.col("state").isin("completed", "failed")).select("data_dir").distinct().join(sidecars, "data_dir", "left_semi")


@query("idle_sessions", "g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) >= interval 5 minutes or lag(ts) over (partition by user_id order by ts) is null then 1 else 0 end as first_in from tickets), s as (select *, sum(first_in) over (partition by user_id order by ts rows unbounded preceding) as k from g);; select user_id, min(ts) as started, count(*) as tickets from s group by user_id, k")
def _(spark, sf_dir):
    return T.idle_sessions(tickets(spark, sf_dir), "user_id", "5 minutes")


@query(
    "param_defaults",
    """select ticket, case when json_extract_string(parameters, '$.k') is null or json_extract_string(parameters, '$.k') in ('', '[]') then '60' else json_extract_string(parameters, '$.k') end as angle,
  coalesce(nullif(nullif(json_extract_string(parameters, '$.dz'), ''), '[]'), '0.5') as dz from tickets""",
)
def _(spark, sf_dir):
    p = F.col("parameters")
    return tickets(spark, sf_dir).select("ticket", S.parameter(p, "$.k", F.lit("60")).alias("angle"), S.parameter(p, "$.dz", F.lit("0.5")).alias("dz"))


@query("iter_default_by_method", "select ticket, case when job_type = 'decon' then 2 else 25 end as iterations from tickets")
def _(spark, sf_dir):
    return tickets(spark, sf_dir).select("ticket", S.default_iterations(F.when(F.col("job_type") == "decon", "omw").otherwise("simple")).alias("iterations"))


@query("sidecars_not_copied", "select distinct s_name from supplier where s_suppkey not in (select l_suppkey from lineitem where l_quantity > 49 and l_orderkey % 40 = 0)")
def _(spark, sf_dir):
    there = table(spark, sf_dir, "lineitem").where("l_quantity > 49 and l_orderkey % 40 = 0").select(F.col("l_suppkey").alias("s_suppkey"))
    return table(spark, sf_dir, "supplier").join(there, "s_suppkey", "left_anti").select("s_name").distinct()


@query("listing_union", "select dir, name from files union all select dir, name from (" + "select 'd' || (o_custkey % 50)::varchar as dir, 'run' || (o_orderkey % 7)::varchar || case when o_orderkey % 3 = 0 then '_1' else '' end || '.ome.tif' as name from orders)")
def _(spark, sf_dir):
    return series_files(spark, sf_dir).select("dir", "name").unionByName(ome_files(spark, sf_dir))


@query(
    "iteration_errors",
    """e as (select user_id, row_number() over (partition by user_id order by event_id) as k, value from events), r as (select *, value / first_value(value) over (partition by user_id order by k) as ratio from e);;
select user_id, k, round(ratio, 6) as ratio, round(abs(ratio - lag(ratio) over (partition by user_id order by k)) / 10, 6) as change from r""",
)
def _(spark, sf_dir):
    return T.iteration_errors(table(spark, sf_dir, "events"), "user_id", "event_id", "value").withColumns({c: S.rounded(F.col(c), 6) for c in ("ratio", "change")})


@query(
    "profile_report",
    """p as (select 'job' || (user_id % 20)::varchar as job, (['readzarr', 'readtiff', 'decon_lucy_function', 'gpuArray.imwarp', 'writezarr', 'other'])[event_id % 6 + 1] as func, value from events);;
select job, round(coalesce(sum(value) filter (func in ('readzarr', 'readtiff')), 0), 4) as load, round(coalesce(sum(value) filter (func = 'decon_lucy_function'), 0), 4) as decon, round(coalesce(sum(value) filter (func = 'gpuArray.imwarp'), 0), 4) as dsr,
  round(coalesce(sum(value) filter (func = 'writezarr'), 0), 4) as save, round(coalesce(sum(value) filter (func <> 'other'), 0), 4) as total from p group by job""",
)
def _(spark, sf_dir):
    from ..sources.profile import summarise

    func = F.element_at(F.array(*[F.lit(k) for k in ("readzarr", "readtiff", "decon_lucy_function", "gpuArray.imwarp", "writezarr", "other")]), (F.col("event_id") % 6 + 1).cast("int"))
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("job"), (F.col("user_id") % 20).cast("string")).alias("job"), func.alias("func"), F.col("value").alias("seconds"))
    out = summarise(rows)
    return out.select("job", *[S.rounded(F.col(c), 4).alias(c) for c in ("load", "decon", "dsr", "save", "total")])


@query("stream_state_counts", "select time_bucket(interval 1 hour, ts) as hour, state, count(*) as n from tickets group by all")
def _(spark, sf_dir):
    """The same counts as a Structured Streaming query that reads all there is."""
    from ..streaming.replay import state_counts

    return state_counts(spark, sf_dir)
