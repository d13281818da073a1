"""Image queries: voxels of the 8 x 8 planes in `embeddings`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..model import map_planes
from ..model import voxels as explode_planes
from ..operators import measures as M
from ..operators import voxels as V
from ..sources.driver import VOXELS_SQL, planes, table, voxels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

TOP, BOTTOM = V.Roi(0, 4, 1, 7), V.Roi(4, 8, 1, 7)
MASK_SQL = "(y - 4) * (y - 4) + (x - 4) * (x - 4) <= 6"


def mask():
    """A disc in the middle of a plane."""
    return (F.col("y") - 4) * (F.col("y") - 4) + (F.col("x") - 4) * (F.col("x") - 4) <= 6


def query(name: str, sql: str | None = None):
    """Register f(voxels) under a name, with SQL over `vox`; "with x as (..)" parts of the SQL follow vox."""

    def register(f: Callable[[DataFrame], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(voxels(spark, sf_dir))
        if sql:
            more, _, rest = sql.partition(";;")
            ORACLE_SQL[name] = f"with {VOXELS_SQL}{', ' + more if rest else ''} {rest or more}"
        return f

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: S.rounded(F.col(c), digits) for c in columns})


@query("crop_roi", "select t, z, c, y - 2 as y, x - 1 as x, v from vox where y >= 2 and y < 6 and x >= 1 and x < 7")
def _(vox):
    return V.crop(vox, V.Roi(2, 6, 1, 7))


@query("crop_rot90", "select t, z, c, 6 - 1 - (x - 1) as y, y - 2 as x, v from vox where y >= 2 and y < 6 and x >= 1 and x < 7")
def _(vox):
    return V.rot90(V.crop(vox, V.Roi(2, 6, 1, 7)), 6)


def crop_rot90_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through plane rows: numpy slices and turns, one Arrow batch at a time."""
    import numpy as np

    turned = map_planes(planes(spark, sf_dir), lambda image: np.rot90(image[2:6, 1:7]))
    return explode_planes(turned).select("t", "z", "c", "y", "x", F.col("v").cast("int").alias("v"))


QUERIES["crop_rot90_planes"] = crop_rot90_planes
ORACLE_SQL["crop_rot90_planes"] = ORACLE_SQL["crop_rot90"]


@query(
    "flagship_contrast",
    """turned as (select t, c, y, x, max(v) as v from (
  select t, z, 4 * (c % 5) + s.slot as c, 6 - 1 - (x - 1) as y, y - s.y0 as x, v from vox
  join (values (0, 0, 4), (1, 0, 0), (2, 1, 0), (3, 1, 4)) s(slot, cam, y0) on c // 5 = s.cam and y >= s.y0 and y < s.y0 + 4 where x >= 1 and x < 7
) group by all), q as (select t, c, quantile_cont(v, 0.01) as lo, quantile_cont(v, 0.999) as hi, min(v) as mn, max(v) as mx from turned group by all);;
select t, c, round(case when mn = 0 and mx = 0 then 0 else lo end, 6) as vmin, round(case when mn = 0 and mx = 0 then 1 when hi <= lo then mx else hi end, 6) as vmax from q""",
)
def _(vox):
    """Crop and demultiplex both cameras, turn, project over z, contrast limits of each output."""
    turned = V.rot90(V.demux(vox, 10, TOP, BOTTOM, "blocked"), 6)
    return rounded(M.contrast(M.mip(turned, ["t", "c", "y", "x"]), ["t", "c"]), "vmin", "vmax")


_DEMUX_SQL = """select t, z, cast(4 * {exc} + s.slot as int) as c, cast(y - s.y0 as int) as y, x - 1 as x, v from vox
join (values (0, 0, 4), (1, 0, 0), (2, 1, 0), (3, 1, 4)) s(slot, cam, y0) on {cam} = s.cam and y >= s.y0 and y < s.y0 + 4 where c < 10 and x >= 1 and x < 7"""


@query("demux_blocked", _DEMUX_SQL.format(exc="(c % 5)", cam="c // 5"))
def _(vox):
    return V.demux(vox, 10, TOP, BOTTOM, "blocked")


@query("demux_interleaved", _DEMUX_SQL.format(exc="(c // 2)", cam="c % 2"))
def _(vox):
    return V.demux(vox, 10, TOP, BOTTOM, "interleaved")


@query("demux_wanted", "d as (" + _DEMUX_SQL.format(exc="(c % 5)", cam="c // 5") + ");; select t, z, w.k as c, y, x, v from d join (values (2, 0), (5, 1), (3, 2)) w(c, k) using (c)")
def _(vox):
    return V.demux(vox, 10, TOP, BOTTOM, "blocked", wanted=[2, 5, 3])


@query("demux_parity", "select t, z, 2 * c + k as c, y, x, v, case when ((c + 1) % 2 <> 0) = (k = 0) then 'bottom' else 'top' end as region from vox, (values (0), (1)) s(k)")
def _(vox):
    return V.demux_parity(vox)


@query("demux_legacy", "select t, z, 2 * c + k as c, y, x, v, case when c % 2 = 0 then 'top' else 'bottom' end as region from vox, (values (0), (1)) s(k)")
def _(vox):
    return V.demux_legacy(vox)


@query("channel_select", "select t, z, w.k as c, y, x, v from vox join (values (3, 0), (1, 1), (7, 2)) w(c, k) using (c)")
def _(vox):
    return V.select_channels(vox, [3, 1, 7])


@query("timepoint_select", "select * from vox where t + 1 in (2, 5)")
def _(vox):
    return V.select_timepoints(vox, [2, 5])


@query("active_channels", "select vox.* from vox join (values (0, 'Calcein_Violet'), (1, 'GFP'), (2, 'mScarlet'), (3, 'CF647')) d(k, dye) on c % 4 = k where dye in ('GFP', 'CF647')")
def _(vox):
    from ..operators.names import active_rows

    return active_rows(vox, ["GFP", "CF647"])


@query("need_roi_flags", "select t, bool_or(c % 4 in (1, 2)) as need_top, bool_or(c % 4 in (0, 3)) as need_bottom, bool_or(c in (1, 2)) as literal_top, bool_or(c in (0, 3)) as literal_bottom from vox where v > 1350 group by t")
def _(vox):
    c = F.col("c")
    flags = {"need_top": F.pmod(c, F.lit(4)).isin(1, 2), "need_bottom": F.pmod(c, F.lit(4)).isin(0, 3), "literal_top": c.isin(1, 2), "literal_bottom": c.isin(0, 3)}
    return vox.where("v > 1350").groupBy("t").agg(*[F.bool_or(f).alias(k) for k, f in flags.items()])


@query("orient_zyx", "select t, z, c, 8 - 1 - x as y, y as x, v from vox")
def _(vox):
    return V.orient_for_dsr(vox, 8)


@query("permute_axes", "select t, c, y as z, x as y, z as x, v from vox")
def _(vox):
    return V.permute(vox, "yxz")


@query("bbox_crop", "select t, z - 9 as z, c, y - 1 as y, x - 2 as x, v from vox where y >= 1 and y < 6 and x >= 2 and x < 8 and z >= 9 and z < 30")
def _(vox):
    return V.bounding_box(vox, (2, 3, 10, 6, 8, 30))


@query("zflip", "select t, 49 - z as z, c, y, x, v from vox")
def _(vox):
    return V.flip_z(vox, 50)


@query("ztrim", "select * from vox where z < 20")
def _(vox):
    return V.trim_z(vox, 20)


@query("center_crop", "select t, z - 15 as z, c, y - 1 as y, x - 2 as x, v from vox where z >= 15 and z < 34 and y >= 1 and y < 6 and x >= 2 and x < 6")
def _(vox):
    return V.centre_crop(vox, {"z": 50, "y": 8, "x": 8}, {"z": 19, "y": 5, "x": 4})


@query("center_pad", "select t, z, c, y + 1 as y, x + 2 as x, v from vox")
def _(vox):
    return V.centre_pad(vox, {"y": 8, "x": 8}, {"y": 11, "x": 13})


@query("bg_subtract", "select t, z, c, y, x, greatest(v - 1000, 0) as v from vox")
def _(vox):
    return vox.withColumn("v", V.subtract_background(F.col("v"), 1000))


@query("saturate_u16", "select t, z, c, y, x, cast(least(greatest(round((v - 900) * 250.5), 0), 65535) as int) as v from vox")
def _(vox):
    return vox.withColumn("v", V.saturate_u16((F.col("v") - 900) * F.lit(250.5)))


@query("z_decimate", "select t, (z - 1) // 4 as z, c, y, x, v from vox where z >= 1 and (z - 1) % 4 = 0")
def _(vox):
    return V.decimate_z(vox, 4)


@query("ortho_slices", "select 'xy' as plane, t, c, y as row, x as col, v from vox where z = 7 union all select 'xz', t, c, z, x, v from vox where y = 3 union all select 'yz', t, c, y, z, v from vox where x = 5")
def _(vox):
    parts = [V.section(vox, axis, at).withColumn("plane", F.lit(name)) for name, axis, at in (("xy", "z", 7), ("xz", "y", 3), ("yz", "x", 5))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "point_transforms",
    """select t, z, c, y, x, case t % 4 when 0 then y when 1 then 7 - x when 2 then 7 - y else x end as dy,
  case t % 4 when 0 then x when 1 then y when 2 then 7 - x else 7 - y end as dx, y as by, x as bx from vox""",
)
def _(vox):
    side, k = F.lit(8), F.col("t")
    shown = vox.withColumn("d", V.to_display(F.col("y"), F.col("x"), side, side, k))
    back = V.to_data(F.col("d.y"), F.col("d.x"), side, side, k)
    return shown.select("t", "z", "c", "y", "x", F.col("d.y").alias("dy"), F.col("d.x").alias("dx"), back["y"].alias("by"), back["x"].alias("bx"))


@query(
    "roi_validity",
    """m as (select t, y, x, max(v) as v from vox group by all), a as (select t, avg(v) filter (y < 4) as top, avg(v) filter (y >= 4) as bottom from m group by t);;
select t, round(top, 6) as top_mean, round(bottom, 6) as bottom_mean, case when top > 1330 and bottom > 1330 then 'align' when top > 1330 then 'top only' when bottom > 1330 then 'bottom only' else 'none' end as outcome from a""",
)
def _(vox):
    from ..operators.rois import validity

    return rounded(validity(M.mip(vox, ["t", "y", "x"]), ["t"], V.Roi(0, 4, 0, 8), V.Roi(4, 8, 0, 8), 1330.0), "top_mean", "bottom_mean")


@query("shift_guard", "select t, z, c, y, x, case when sqrt((y * 10.0) * (y * 10.0) + (x * 7.0) * (x * 7.0)) > 60 then 0 else y * 10 end as dy, case when sqrt((y * 10.0) * (y * 10.0) + (x * 7.0) * (x * 7.0)) > 60 then 0 else x * 7 end as dx from vox")
def _(vox):
    from ..operators.rois import guarded_shift

    shift = guarded_shift(F.col("y") * 10, F.col("x") * 7, 60.0)
    return vox.select("t", "z", "c", "y", "x", shift["dy"].alias("dy"), shift["dx"].alias("dx"))


@query("edge_guard", "select t, z, c, y, x, v from vox where z - 3 >= 0 and z + 3 < 50 and y - 2 >= 0 and y + 2 < 8 and x - 2 >= 0 and x + 2 < 8")
def _(vox):
    from ..operators.rois import inside

    return vox.where(inside({"z": (3, 50), "y": (2, 8), "x": (2, 8)}))


@query("rescale_u16", "r as (select min(v) as lo, max(v) as hi from vox);; select t, z, c, y, x, cast(round((v - lo) / (hi - lo)::double * 65535) as int) as v from vox, r")
def _(vox):
    low, high = vox.agg(F.min("v"), F.max("v")).first()
    return V.rescale_u16(vox, low or 0, high or 0)


@query("mask_zero", f"select t, z, c, y, x, case when {MASK_SQL} then v else 0 end as v from vox")
def _(vox):
    return vox.withColumn("v", F.when(mask(), F.col("v")).otherwise(0))


@query("mask_algebra", f"select y, x, bool_and(m and n) as both_in, bool_or(m or n) as either_in, not bool_or(m) as outside from (select *, {MASK_SQL} as m, y >= 3 as n from vox) group by y, x")
def _(vox):
    n = F.col("y") >= 3
    return vox.groupBy("y", "x").agg(F.bool_and(mask() & n).alias("both_in"), F.bool_or(mask() | n).alias("either_in"), (~F.bool_or(mask())).alias("outside"))


@query("flat_field", "f as (select y, x, avg(v) as flat from vox group by y, x), m as (select avg(flat) as mean from f);; select t, z, c, y, x, round(greatest((v - 900.0) / flat * mean, 0), 6) as v from vox join f using (y, x), m")
def _(vox):
    flat = vox.groupBy("y", "x").agg(F.avg("v").alias("flat"))
    mean = flat.agg(F.avg("flat")).first()[0] or 0.0
    return rounded(V.flat_field(vox, flat, 900.0, mean), "v").select("t", "z", "c", "y", "x", "v")


@query("mip_zc", "select t, y, x, max(v) as v from vox group by all")
def _(vox):
    return M.mip(vox, ["t", "y", "x"])


for _name, _keys in (("mip_xy", "t, c, y, x"), ("mip_xz", "t, c, z, x"), ("mip_yz", "t, c, z, y")):
    query(_name, f"select {_keys}, max(v) as v from vox group by all")(lambda vox, keys=_keys: M.mip(vox, keys.split(", ")))


def mip_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximum over z and c of plane rows: each task folds its planes, then one row a task and timepoint is folded again."""
    from ..operators.planes import project

    return explode_planes(project(planes(spark, sf_dir), ["dataset", "t"])).select("t", "y", "x", F.col("v").cast("int").alias("v"))


QUERIES["mip_zc_planes"] = mip_planes
ORACLE_SQL["mip_zc_planes"] = ORACLE_SQL["mip_zc"]


@query(
    "mip_groupsets",
    """select t, c, 'xy' as plane, y as a, x as b, max(v) as v from vox group by all union all select t, c, 'xz', z, x, max(v) from vox group by all
union all select t, c, 'yz', z, y, max(v) from vox group by all""",
)
def _(vox):
    return M.mip_all_axes(vox)


@query(
    "contrast_pct",
    """q as (select t, c, quantile_cont(v, 0.01) as lo, quantile_cont(v, 0.999) as hi, min(v) as mn, max(v) as mx from vox group by t, c);;
select t, c, round(case when mn = 0 and mx = 0 then 0 else lo end, 6) as vmin, round(case when mn = 0 and mx = 0 then 1 when hi <= lo then mx else hi end, 6) as vmax from q""",
)
def _(vox):
    return rounded(M.contrast(vox, ["t", "c"]), "vmin", "vmax")


@query("stack_minmax", "select t, c, round(quantile_cont(v, 0.001), 6) as p_low, round(quantile_cont(v, 0.999), 6) as p_high, min(v) as low, max(v) as high from vox group by t, c")
def _(vox):
    return rounded(M.percentiles(vox, ["t", "c"], {"p_low": 0.001, "p_high": 0.999}), "p_low", "p_high")


@query("roi_mean", "select t, c, round(avg(v), 6) as mean from vox where y >= 2 and y < 6 and x >= 1 and x < 7 group by t, c")
def _(vox):
    return rounded(V.crop(vox, V.Roi(2, 6, 1, 7)).groupBy("t", "c").agg(F.avg("v").alias("mean")), "mean")


@query("argmax_voxel", "select t, c, z, y, x, v from vox qualify row_number() over (partition by t, c order by v desc, z, y, x) = 1")
def _(vox):
    return M.argmax(vox, ["t", "c"])


@query("com_plane", "select t, z, c, round(sum(v * y) / sum(v)::double, 6) as cy, round(sum(v * x) / sum(v)::double, 6) as cx from vox group by t, z, c")
def _(vox):
    return rounded(M.centroid(vox, ["t", "z", "c"], ["y", "x"], F.col("v")), "cy", "cx")


_W4 = "pow(greatest(v - 1000, 0)::double, 4)"


@query("com_peak4", f"select t, c, round(sum({_W4} * z) / sum({_W4}), 6) as cz, round(sum({_W4} * y) / sum({_W4}), 6) as cy, round(sum({_W4} * x) / sum({_W4}), 6) as cx from vox group by t, c")
def _(vox):
    return rounded(M.centroid(vox, ["t", "c"], ["z", "y", "x"], M.peak_weight(F.lit(1000))), "cz", "cy", "cx")


@query(
    "label_com_nearest",
    """l as (select t, c, (y // 4) * 2 + x // 4 as label, sum(v * y) / sum(v)::double as cy, sum(v * x) / sum(v)::double as cx from vox group by all);;
select t, c, label, round(cy, 6) as cy, round(cx, 6) as cx from l qualify row_number() over (partition by t, c order by round((cy - 4) * (cy - 4) + (cx - 4) * (cx - 4), 9), label) = 1""",
)
def _(vox):
    labelled = vox.withColumn("label", (F.floor(F.col("y") / 4) * 2 + F.floor(F.col("x") / 4)).cast("int"))
    found = M.centroid(labelled, ["t", "c", "label"], ["y", "x"], F.col("v"))
    away = S.rounded((F.col("cy") - 4) * (F.col("cy") - 4) + (F.col("cx") - 4) * (F.col("cx") - 4), 9)
    best = found.groupBy("t", "c").agg(F.min(F.struct(away.alias("d"), "label", "cy", "cx")).alias("m"))
    return rounded(best.select("t", "c", "m.label", "m.cy", "m.cx"), "cy", "cx")


@query("bg_mean_median", f"select t, c, round(avg(v), 6) as mean, round(median(v), 6) as median, round(quantile_cont(v, 0.05), 6) as p5 from vox where not ({MASK_SQL}) group by t, c")
def _(vox):
    outside = vox.where(~mask())
    means = outside.groupBy("t", "c").agg(F.avg("v").alias("mean"))
    middle = M.percentiles(outside, ["t", "c"], {"median": 0.5, "p5": 0.05}).drop("low", "high")
    return rounded(means.join(middle, ["t", "c"]), "mean", "median", "p5")


@query("psf_mean", "select z, y, x, round(sum(v) / (select count(distinct c) from vox)::double, 6) as v from vox group by z, y, x")
def _(vox):
    return rounded(M.mean_planes(vox, "c", ["z", "y", "x"]), "v")


@query("psf_normalise", "select t, z, c, y, x, round(v / sum(v) over (partition by t, c)::double, 9) as share, round(v / max(v) over (partition by t, c)::double, 9) as of_max from vox")
def _(vox):
    whole = vox.groupBy("t", "c").agg(F.max("v").alias("top"), F.sum("v").alias("whole"))
    shares = vox.join(whole, ["t", "c"]).select("t", "z", "c", "y", "x", (F.col("v") / F.col("whole")).alias("share"), (F.col("v") / F.col("top")).alias("of_max"))
    return rounded(shares, "share", "of_max", digits=9)


@query("display_limit", "select t, c, max(v) * 3 as top, case when max(v) * 3 <= 255 then 255 when max(v) * 3 <= 4095 then 4095 else 65535 end as max_display from vox group by t, c")
def _(vox):
    return vox.groupBy("t", "c").agg((F.max("v") * 3).alias("top")).withColumn("max_display", M.display_limit(F.col("top")))


@query(
    "otsu_threshold",
    """lim as (select t, c, min(v) as lo, max(v) as hi, (max(v) - min(v)) / 256.0::double as wd from vox group by t, c),
h as (select t, c, cast(case when wd > 0 then least(floor((v - lo) / wd), 255) else 0 end as int) as bin, count(*) as n, any_value(lo) as lo, any_value(wd) as wd from vox join lim using (t, c) group by t, c, bin),
k as (select *, lo + (bin + 0.5) * wd as centre from h),
s as (select t, c, bin, centre, sum(n) over u as w0, sum(n * centre) over u as s0, sum(n) over p as w, sum(n * centre) over p as st from k
  window u as (partition by t, c order by bin rows unbounded preceding), p as (partition by t, c)),
b as (select *, round(case when w - w0 > 0 then w0 * (w - w0) * pow(s0 / w0 - (st - s0) / (w - w0), 2) else -1 end, 6) as between_v from s);;
select t, c, bin, round(centre, 6) as threshold from b qualify row_number() over (partition by t, c order by between_v desc, bin) = 1""",
)
def _(vox):
    return rounded(M.otsu(vox, ["t", "c"]), "threshold")


@query(
    "bead_slope_angle",
    """p as (select t, c, z, max(v) as top, sum(v * y) / sum(v)::double as cy from vox group by t, c, z), g as (select * from p qualify top >= 0.2 * max(top) over (partition by t, c)),
r as (select t, c, regr_slope(cy, z) as slope, regr_intercept(cy, z) as icpt, count(*) as planes from g group by t, c having count(*) >= 5);;
select t, c, round(slope, 6) as slope, round(icpt, 6) as intercept, planes, round(degrees(atan(tan(radians(31.8)) + slope)), 6) as angle from r""",
)
def _(vox):
    return rounded(M.bead_slope(vox, ["t", "c"]).withColumn("angle", M.suggested_angle(F.lit(31.8), F.col("slope"))), "slope", "intercept", "angle")


@query(
    "fwhm_profile",
    """h as (select *, min(v) over p + (max(v) over p - min(v) over p) / 2.0 as half from vox window p as (partition by t, z, c, y));;
select t, z, c, y, coalesce(max(x) filter (v >= half) - min(x) filter (v >= half), 0) as fwhm from h group by t, z, c, y""",
)
def _(vox):
    return M.fwhm(vox, ["t", "z", "c", "y"], "x")


@query("bead_plane_filter", "p as (select t, c, z, max(v) as top from vox group by t, c, z);; select t, c, z, top from p qualify top >= 0.95 * max(top) over (partition by t, c)")
def _(vox):
    planes_ = vox.groupBy("t", "c", "z").agg(F.max("v").alias("top"))
    return planes_.withColumn("peak", F.max("top").over(Window.partitionBy("t", "c"))).where("top >= 0.95 * peak").drop("peak")


@query("centre_profiles", "select 'z' as axis, t, c, z as at, v from vox where y = 4 and x = 4 union all select 'y', t, c, y, v from vox where z = 25 and x = 4 union all select 'x', t, c, x, v from vox where z = 25 and y = 4")
def _(vox):
    centre = {"z": 25, "y": 4, "x": 4}
    out = None
    for axis in centre:
        rows = vox
        for other, at in centre.items():
            rows = rows.where(F.col(other) == at) if other != axis else rows
        rows = rows.select(F.lit(axis).alias("axis"), "t", "c", F.col(axis).alias("at"), "v")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "refine_centroid",
    """m as (select t, c, y, x, max(v) as v from vox where y between 1 and 7 and x between 1 and 7 group by all), w as (select *, v - min(v) over (partition by t, c) as wt from m);;
select t, c, case when sum(wt) <> 0 then round(sum(wt * y) / sum(wt)::double, 6) end as cy, case when sum(wt) <> 0 then round(sum(wt * x) / sum(wt)::double, 6) end as cx from w group by t, c""",
)
def _(vox):
    return rounded(M.refine_centroid(vox, 4, 4, 3, ["t", "c"]), "cy", "cx")


# The default colours of channels, in cycle order.
COLOURS = [("Blue", 0.0, 0.0, 1.0), ("Green", 0.0, 1.0, 0.0), ("Red", 1.0, 0.0, 0.0), ("Purple", 1.0, 0.0, 1.0), ("Yellow", 1.0, 1.0, 0.0), ("Cyan", 0.0, 1.0, 1.0)]
_COLOURS_SQL = "colours(k, name, r, g, b) as (values " + ", ".join(f"({k}, '{n}', {r}, {g}, {b})" for k, (n, r, g, b) in enumerate(COLOURS)) + ")"


@query(
    "rgb_composite",
    f"{_COLOURS_SQL}, lim as (select c, min(v) as lo, max(v) as hi from vox group by c), s as (select t, z, y, x, c, case when hi > lo then (v - lo) / (hi - lo)::double else 0 end as s from vox join lim using (c));;"
    " select t, z, y, x, round(least(sum(s * r), 1), 6) as r, round(least(sum(s * g), 1), 6) as g, round(least(sum(s * b), 1), 6) as b from s join colours on c % 6 = k group by t, z, y, x",
)
def _(vox):
    limits = vox.groupBy("c").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    tint = F.element_at(F.array(*[F.struct(*[F.lit(x).alias(k) for k, x in zip("rgb", c[1:])]) for c in COLOURS]), F.pmod("c", F.lit(len(COLOURS))) + 1)
    colours = limits.select("c", tint.alias("k")).select("c", "k.r", "k.g", "k.b")
    return rounded(M.composite(vox, limits, colours), "r", "g", "b")


@query("channel_colours", f"{_COLOURS_SQL};; select c, k.name as cycled, z.name as zipped from (select distinct c from vox) join colours k on c % 6 = k.k left join colours z on c = z.k and z.k < 4")
def _(vox):
    names = F.array(*[F.lit(c[0]) for c in COLOURS])
    zipped = F.when(F.col("c") < 4, F.try_element_at(names, F.col("c") + 1))
    return vox.select("c").distinct().select("c", F.element_at(names, F.pmod("c", F.lit(len(COLOURS))) + 1).alias("cycled"), zipped.alias("zipped"))


@query("blend_alpha", "select a.t, a.z, a.y, a.x, round(0.7::double * a.v + 0.3::double * b.v, 6) as v from vox a join vox b using (t, z, y, x) where a.c = 0 and b.c = 1")
def _(vox):
    """Two channels' slices, one laid over the other."""
    from ..functions.scalars import blend

    a, b = (vox.where(F.col("c") == k).select("t", "z", "y", "x", F.col("v").alias(f"v{k}")) for k in (0, 1))
    return rounded(a.join(b, ["t", "z", "y", "x"]).select("t", "z", "y", "x", blend(F.col("v0"), F.col("v1"), 0.3).alias("v")), "v")


@query("blend_projections", "m as (select t, c, y, x, max(v) as v from vox group by all);; select a.t, a.y, a.x, round(0.7::double * a.v + 0.3::double * b.v, 6) as v from m a join m b using (t, y, x) where a.c = 0 and b.c = 1")
def _(vox):
    """The same of their projections over z."""
    from ..functions.scalars import blend

    flat = M.mip(vox.where("c in (0, 1)"), ["t", "c", "y", "x"])
    a, b = (flat.where(F.col("c") == k).select("t", "y", "x", F.col("v").alias(f"v{k}")) for k in (0, 1))
    return rounded(a.join(b, ["t", "y", "x"]).select("t", "y", "x", blend(F.col("v0"), F.col("v1"), 0.3).alias("v")), "v")


@query("display_transforms", "select t, z, c, y, x, round(ln(1 + v), 6) as log_v, round(pow(greatest(least((v - 900) / 300.0::double, 1), 0), 0.5), 6) as gamma_v from vox")
def _(vox):
    from ..functions.scalars import unit_range

    unit = unit_range(F.col("v"), F.lit(900.0), F.lit(1200.0))
    return rounded(vox.select("t", "z", "c", "y", "x", F.log1p("v").alias("log_v"), F.pow(unit, F.lit(0.5)).alias("gamma_v")), "log_v", "gamma_v")


@query("tukey_taper", "select t, z, c, y, x, round(v * w[y + 1] * w[x + 1], 6) as v from vox, (select [0.5 * (1 - cos(pi() * least(i, 7 - i) / (0.5 * 7 / 2))) * (least(i, 7 - i) < 0.5 * 7 / 2)::int + (least(i, 7 - i) >= 0.5 * 7 / 2)::int for i in range(8)] as w)")
def _(vox):
    side = F.lit(8)
    return rounded(vox.withColumn("v", F.col("v") * M.tukey(F.col("y"), side, 0.5) * M.tukey(F.col("x"), side, 0.5)), "v")


@query(
    "densify_zero_fill",
    "g as (select t, c, z from (select distinct t from vox), (select distinct c from vox), range(50) r(z)), p as (select t, c, z, max(v) as v from vox where z % 3 = 0 group by all);; select t, c, cast(z as int) as z, coalesce(v, 0) as v from g left join p using (t, c, z)",
)
def _(vox):
    """Every (t, c, z) of the distinct t and c, 0 where no plane is listed; the grid is built from array products, not a join."""
    sides = vox.agg(F.collect_set("t").alias("ts"), F.collect_set("c").alias("cs"))  # an axis has thousands of places at most
    grid = sides.select(F.explode("ts").alias("t"), "cs").select("t", F.explode("cs").alias("c")).select("t", "c", F.explode(F.sequence(F.lit(0), F.lit(49))).alias("z"))
    return V.densify(grid, vox.where("z % 3 = 0").groupBy("t", "c", "z").agg(F.max("v").alias("v")), ["t", "c", "z"])


@query("dense_inner", "select distinct t, c, z from vox where z % 3 = 0")
def _(vox):
    from ..operators.names import listed_only

    every = vox.select("t", "c").distinct().withColumn("z", F.explode(F.sequence(F.lit(0), F.lit(49))))
    return listed_only(every, vox.where("z % 3 = 0"), ["t", "c", "z"])


@query("slab_keys", "select t, c, z // 16 as iz, count(*) as voxels, max(v) as top from vox group by all")
def _(vox):
    """Slabs of 16 slices, so that a stack has several."""
    return vox.groupBy("t", "c", F.floor(F.col("z") / 16).alias("iz")).agg(F.count("*").alias("voxels"), F.max("v").alias("top"))


def joined_rois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each plane cut by every region that meets it, found by tiles."""
    from ..operators.rois import region_maxima

    k = F.col("n_nationkey")
    y0, x0 = F.pmod(k, F.lit(5)), F.pmod(k, F.lit(3))
    rois = table(spark, sf_dir, "nation").select(k.alias("roi"), y0.alias("y0"), (y0 + 3).alias("y1"), x0.alias("x0"), (x0 + 4).alias("x1"))
    found = region_maxima(planes(spark, sf_dir), rois, tile=4)
    return found.groupBy("roi", "t", "c").agg(F.max("top").cast("int").alias("top"), F.sum("n").alias("n"))


def percentiles_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles of float pixels, nearly all of which differ: by two passes over their bits."""
    from ..operators.planes import percentiles

    rows = table(spark, sf_dir, "embeddings").where("embedding is not null").select("vec_id", "label", "embedding")
    found = percentiles(float_planes(rows), ["t", "c"], {"p01": 0.01, "median": 0.5, "p999": 0.999})
    return rounded(found, "p01", "median", "p999", "low", "high")


def float_planes(rows: DataFrame) -> DataFrame:
    """The embeddings themselves as float32 planes."""
    import numpy as np
    import pandas as pd

    from ..model import PLANES

    def run(batches):
        for pdf in batches:
            data = [np.asarray(v, "<f4").tobytes() for v in pdf["embedding"]]
            yield pd.DataFrame({"dataset": "embeddings", "t": pdf["vec_id"] // 50, "z": pdf["vec_id"] % 50, "c": pdf["label"], "h": 8, "w": 8, "dtype": "<f4", "data": data})

    return rows.mapInPandas(run, PLANES)


QUERIES["percentiles_float"] = percentiles_float
ORACLE_SQL["percentiles_float"] = """with v as (select (vec_id // 50)::int as t, label::int as c, unnest(embedding)::double as v from embeddings)
select t, c, round(quantile_cont(v, 0.01), 6) as p01, round(quantile_cont(v, 0.5), 6) as median, round(quantile_cont(v, 0.999), 6) as p999, round(min(v), 6) as low, round(max(v), 6) as high from v group by t, c"""
QUERIES["planes_roi_join"] = joined_rois
ORACLE_SQL["planes_roi_join"] = f"""with {VOXELS_SQL}, rois as (select n_nationkey as roi, n_nationkey % 5 as y0, n_nationkey % 3 as x0 from nation)
select roi, t, c, max(v) as top, count(*) as n from vox join rois on y >= y0 and y < y0 + 3 and x >= x0 and x < x0 + 4 group by roi, t, c"""
