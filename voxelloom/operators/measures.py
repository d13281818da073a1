"""Aggregates and window measures of voxel tables.

Maxima, sums and moments are pre-aggregated by each task. Exact percentiles count distinct values
first, so what is shuffled is bounded by the pixel type, not by the voxels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def mip(vox: DataFrame, keys: list[str]) -> DataFrame:
    """Maximum intensity projection onto `keys`."""
    return vox.groupBy(*keys).agg(F.max("v").alias("v"))


def mip_all_axes(vox: DataFrame, keys: tuple[str, ...] = ("t", "c")) -> DataFrame:
    """XY, XZ and YZ projections of every stack, named by `keys`, in one pass: (keys.., plane, a, b, v). Of several datasets, `dataset` must be among the keys."""
    flat = vox.groupingSets([[*keys, "y", "x"], [*keys, "z", "x"], [*keys, "z", "y"]], *keys, "z", "y", "x").agg(F.max("v").alias("v"), F.grouping_id().alias("g"))
    plane = F.when(F.col("z").isNull(), "xy").when(F.col("y").isNull(), "xz").otherwise("yz")
    a = F.when(F.col("z").isNull(), F.col("y")).otherwise(F.col("z"))
    b = F.when(F.col("x").isNull(), F.col("y")).otherwise(F.col("x"))
    return flat.select(*keys, plane.alias("plane"), a.alias("a"), b.alias("b"), "v")


def percentiles(vox: DataFrame, keys: list[str], shares: dict[str, float], value: str = "v") -> DataFrame:
    """Exact, linearly interpolated percentiles of each group: distinct values are counted first."""
    counts = vox.groupBy(*keys, value).agg(F.count("*").alias("n"))
    wanted = F.percentile(F.col(value), F.array(*[F.lit(s) for s in shares.values()]), F.col("n"))
    return counts.groupBy(*keys).agg(wanted.alias("p"), F.min(value).alias("low"), F.max(value).alias("high")).select(*keys, *[F.col("p")[k].alias(name) for k, name in enumerate(shares)], "low", "high")


def contrast(vox: DataFrame, keys: list[str], low: float = 0.01, high: float = 0.999) -> DataFrame:
    """Display limits (vmin, vmax): two percentiles; if they don't differ, vmax is the maximum; an all-zero group has (0, 1)."""
    p = percentiles(vox, keys, {"vmin": low, "vmax": high})
    empty = (F.col("low") == 0) & (F.col("high") == 0)
    vmax = F.when(empty, 1.0).when(F.col("vmax") <= F.col("vmin"), F.col("high").cast("double")).otherwise(F.col("vmax"))
    return p.select(*keys, F.when(empty, 0.0).otherwise(F.col("vmin")).alias("vmin"), vmax.alias("vmax"))


def argmax(vox: DataFrame, keys: list[str]) -> DataFrame:
    """Place and value of each group's maximum; of equal ones the first in C order."""
    best = vox.groupBy(*keys).agg(F.min(F.struct((-F.col("v")).alias("n"), "z", "y", "x")).alias("m"))
    return best.select(*keys, F.col("m.z").alias("z"), F.col("m.y").alias("y"), F.col("m.x").alias("x"), (-F.col("m.n")).alias("v"))


def centroid(vox: DataFrame, keys: list[str], axes: list[str], weight: Column) -> DataFrame:
    """Weighted mean place of each group; null if nothing weighs."""
    total = F.sum("w")
    sums = vox.withColumn("w", weight).groupBy(*keys)
    return sums.agg(*[F.when(total != 0, F.sum(F.col("w") * F.col(a)) / total).alias(f"c{a}") for a in axes])


def peak_weight(background: Column, power: int = 4) -> Column:
    return F.pow(F.greatest(F.col("v") - background, F.lit(0)), F.lit(power))


def fwhm(vox: DataFrame, keys: list[str], axis: str) -> DataFrame:
    """Full width at half maximum of each profile along `axis`: last minus first place that reaches the middle between its least and greatest value; 0 if fewer than two do."""
    half = vox.groupBy(*keys).agg((F.min("v") + (F.max("v") - F.min("v")) / 2.0).alias("half"))
    above = vox.join(half, keys).withColumn("at", F.when(F.col("v") >= F.col("half"), F.col(axis)))
    return above.groupBy(*keys).agg(F.coalesce(F.max("at") - F.min("at"), F.lit(0)).alias("fwhm"))


def mean_planes(vox: DataFrame, item: str, keys: list[str]) -> DataFrame:
    """Voxel-wise mean over items: sums divided by the number of items, so an item's missing voxels count as 0.

    The number of items is one row; it joins as a scalar.
    """
    n = vox.select(item).distinct().count()
    return vox.groupBy(*keys).agg((F.sum("v") / F.lit(max(n, 1))).alias("v"))


def normalised(vox: DataFrame, keys: list[str], by: str = "sum") -> DataFrame:
    """v as a share of its group's sum or maximum; a group of zeros stays 0."""
    whole = vox.groupBy(*keys).agg(getattr(F, by)("v").alias("whole"))
    return vox.join(whole, keys).withColumn("v", F.when(F.col("whole") != 0, F.col("v") / F.col("whole")).otherwise(F.lit(0.0))).drop("whole")


def display_limit(top: Column) -> Column:
    """The display range that holds a maximum: 8, 12 or 16 bits."""
    return F.when(top <= 255, 255).when(top <= 4095, 4095).otherwise(65535)


def otsu(vox: DataFrame, keys: list[str], bins: int = 256) -> DataFrame:
    """Otsu's threshold (1979) of each group over `bins` equal bins: the lower edge's centre that best separates two classes.

    The histogram has `bins` rows a group at most; running sums over them give both classes.
    """
    limits = vox.groupBy(*keys).agg(F.min("v").alias("low"), F.max("v").alias("high"))
    width = (F.col("high") - F.col("low")) / bins
    place = F.when(width > 0, F.least(F.floor((F.col("v") - F.col("low")) / width), F.lit(bins - 1))).otherwise(0).cast("int")
    hist = vox.join(limits, keys).withColumn("bin", place).groupBy(*keys, "bin").agg(F.count("*").alias("n"), F.first("low").alias("low"), F.first("high").alias("high"))
    hist = hist.withColumn("centre", F.col("low") + (F.col("bin") + 0.5) * width)
    upto = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    hist = hist.withColumns({"w0": F.sum("n").over(upto), "s0": F.sum(F.col("n") * F.col("centre")).over(upto), "w": F.sum("n").over(whole), "s": F.sum(F.col("n") * F.col("centre")).over(whole)})
    w1 = F.col("w") - F.col("w0")
    between = F.when(w1 > 0, F.col("w0") * w1 * F.pow(F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / w1, F.lit(2))).otherwise(F.lit(-1.0))
    best = hist.withColumn("between", between).withColumn("between", S.rounded(F.col("between"), 6)).groupBy(*keys).agg(F.min(F.struct((-F.col("between")).alias("b"), "bin", "centre")).alias("m"))
    return best.select(*keys, F.col("m.bin").alias("bin"), F.col("m.centre").alias("threshold"))


def bead_slope(vox: DataFrame, keys: list[str], least_planes: int = 5, share: float = 0.2) -> DataFrame:
    """(slope, intercept, planes) of the centroid's y on z, over the planes whose maximum reaches `share` of the stack's."""
    planes = vox.groupBy(*keys, "z").agg(F.max("v").alias("top"), F.sum(F.col("v") * F.col("y")).alias("sy"), F.sum("v").alias("sv"))
    stack = Window.partitionBy(*keys)
    good = planes.where("sv > 0").withColumn("peak", F.max("top").over(stack)).where(F.col("top") >= share * F.col("peak")).withColumn("cy", F.col("sy") / F.col("sv"))
    return good.groupBy(*keys).agg(F.regr_slope("cy", "z").alias("slope"), F.regr_intercept("cy", "z").alias("intercept"), F.count("*").alias("planes")).where(F.col("planes") >= least_planes)


def suggested_angle(angle: Column, slope: Column) -> Column:
    """Sheet angle in degrees corrected by a measured tilt."""
    return F.degrees(F.atan(F.tan(F.radians(angle)) + slope))


def refine_centroid(vox: DataFrame, y: int, x: int, half: int, keys: list[str]) -> DataFrame:
    """Centroid of the projection over z in a window around a point, above the window's minimum."""
    near = vox.where((F.col("y") >= y - half) & (F.col("y") <= y + half) & (F.col("x") >= x - half) & (F.col("x") <= x + half))
    flat = mip(near, [*keys, "y", "x"])
    flat = flat.withColumn("base", F.min("v").over(Window.partitionBy(*keys)))
    return centroid(flat, keys, ["y", "x"], F.col("v") - F.col("base"))


def composite(vox: DataFrame, limits: DataFrame, colours: DataFrame, keys: tuple[str, ...] = ("t", "z")) -> DataFrame:
    """(keys.., y, x, r, g, b): each channel scaled to its limits (c, low, high), tinted (c, r, g, b), summed and clipped to 1."""
    scaled = F.when(F.col("high") > F.col("low"), F.least(F.greatest((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")), F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    rows = vox.join(limits, "c").join(colours, "c").withColumn("s", scaled)
    return rows.groupBy(*keys, "y", "x").agg(*[F.least(F.sum(F.col("s") * F.col(k)), F.lit(1.0)).alias(k) for k in ("r", "g", "b")])


def tukey(at: Column, size: Column, alpha: float) -> Column:
    """Tukey window of `size` points at a place."""
    edge = alpha * (size - 1) / 2
    near = F.least(at, size - 1 - at)
    return F.when((size <= 1) | (edge <= 0) | (near >= edge), 1.0).otherwise(0.5 * (1 - F.cos(F.pi() * near / edge)))
