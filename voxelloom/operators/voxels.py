"""Projections, filters and coordinate transforms of voxel tables (.., t, z, c, y, x, v).

All are column expressions over rows: no shuffle, and filters on t, z and c reach the scan.
Regions are 0-based and half-open.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Roi:
    y0: int
    y1: int
    x0: int
    x1: int

    @property
    def shape(self) -> tuple[int, int]:
        return self.y1 - self.y0, self.x1 - self.x0

    def column(self) -> Column:
        return F.struct(*[F.lit(getattr(self, k)).alias(k) for k in ("y0", "y1", "x0", "x1")])


def crop(vox: DataFrame, roi: Roi) -> DataFrame:
    inside = (F.col("y") >= roi.y0) & (F.col("y") < roi.y1) & (F.col("x") >= roi.x0) & (F.col("x") < roi.x1)
    return vox.where(inside).withColumns({"y": F.col("y") - roi.y0, "x": F.col("x") - roi.x0})


def rot90(vox: DataFrame, width: int) -> DataFrame:
    """A quarter turn counter-clockwise of planes `width` wide."""
    return vox.withColumns({"y": width - 1 - F.col("x"), "x": F.col("y")})


#: Position in an excitation's group of four outputs, its camera and which region it reads: fixed values.
SLOTS = [(0, 0, "bottom"), (1, 0, "top"), (2, 1, "top"), (3, 1, "bottom")]


def demux(vox: DataFrame, channels: int, top: Roi, bottom: Roi, layout: str, wanted: list[int] | None = None) -> DataFrame:
    """Split raw channels of two cameras into four outputs per excitation, cropped.

    layout "blocked": camera 0 holds channels 0..n-1, camera 1 the next n; "interleaved": an
    excitation's two cameras stand side by side. `wanted` outputs are numbered by their place in
    the list. An odd number of channels, and regions of different shape where both are needed, raise.
    """
    if channels % 2:
        raise ValueError("the number of channels must be even")
    if layout not in ("blocked", "interleaved"):
        raise ValueError(f"no layout {layout!r}")
    needs = needed_regions(wanted if wanted is not None else list(range(2 * channels)))
    if all(needs.values()) and top.shape != bottom.shape:
        raise ValueError("top and bottom regions differ in shape")
    n = channels // 2
    exc, cam = (F.pmod("c", F.lit(n)), F.floor(F.col("c") / n)) if layout == "blocked" else (F.floor(F.col("c") / 2), F.pmod("c", F.lit(2)))
    regions = {"top": top, "bottom": bottom}
    slots = F.array(*[F.struct(F.lit(s).alias("slot"), F.lit(k).alias("cam"), regions[r].column().alias("roi")) for s, k, r in SLOTS])
    rows = vox.where(F.col("c") < channels).withColumns({"exc": exc.cast("int"), "cam": cam.cast("int")})
    rows = rows.withColumn("s", F.explode(F.filter(slots, lambda s: s["cam"] == F.col("cam"))))
    roi = F.col("s.roi")
    rows = rows.where((F.col("y") >= roi["y0"]) & (F.col("y") < roi["y1"]) & (F.col("x") >= roi["x0"]) & (F.col("x") < roi["x1"]))
    rows = rows.withColumns({"c": 4 * F.col("exc") + F.col("s.slot"), "y": F.col("y") - roi["y0"], "x": F.col("x") - roi["x0"]})
    if wanted is not None:
        rows = select_channels(rows, wanted)
    return rows.drop("exc", "cam", "s")


def needed_regions(outputs: list[int]) -> dict[str, bool]:
    return {r: any(o % 4 in [s for s, _, q in SLOTS if q == r] for o in outputs) for r in ("top", "bottom")}


def demux_parity(vox: DataFrame) -> DataFrame:
    """One raw channel (counted from 1) gives two outputs, 2(rc-1) and 2(rc-1)+1: odd ones bottom then top, even ones top then bottom."""
    rc = F.col("c") + 1
    sides = F.when(rc % 2 != 0, F.array(F.lit("bottom"), F.lit("top"))).otherwise(F.array(F.lit("top"), F.lit("bottom")))
    return vox.select("*", F.posexplode(sides).alias("k", "region")).withColumn("c", 2 * F.col("c") + F.col("k")).drop("k")


def demux_legacy(vox: DataFrame) -> DataFrame:
    """Raw channel c gives outputs 2c and 2c+1, both of its own region: top for even c, bottom for odd."""
    region = F.when(F.pmod("c", F.lit(2)) == 0, "top").otherwise("bottom")
    return vox.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("k")).withColumns({"region": region, "c": 2 * F.col("c") + F.col("k")}).drop("k")


def select_channels(vox: DataFrame, wanted: list[int]) -> DataFrame:
    """Keep the listed channels, numbered by their place in the list; one listed twice appears twice."""
    places = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(k).alias("k")) for k, c in enumerate(wanted)])
    rows = vox.where(F.col("c").isin(wanted)).withColumn("s", F.explode(F.filter(places, lambda s: s["c"] == F.col("c"))))
    return rows.withColumn("c", F.col("s.k")).drop("s")


def select_timepoints(vox: DataFrame, wanted: list[int]) -> DataFrame:
    """Keep timepoints listed from 1; none listed keeps all. t itself stays 0-based."""
    return vox.where(F.col("t").isin([t - 1 for t in wanted])) if wanted else vox


def orient_for_dsr(vox: DataFrame, width: int) -> DataFrame:
    """(z, y, x) stacks as (row, column, slice) = (width-1-x, y, z)."""
    return vox.withColumns({"y": width - 1 - F.col("x"), "x": F.col("y"), "z": F.col("z")})


def permute(vox: DataFrame, order: str) -> DataFrame:
    """Axes z, y, x take the coordinates named by the letters of `order`, in turn."""
    if sorted(order) != ["x", "y", "z"]:
        raise ValueError(f"{order!r} does not permute zyx")
    return vox.withColumns({axis: F.col(source) for axis, source in zip("zyx", order)})


def bounding_box(vox: DataFrame, box: tuple[int, int, int, int, int, int]) -> DataFrame:
    """Crop to [y1, x1, z1, y2, x2, z2], counted from 1, ends included."""
    low, high = dict(zip("yxz", box[:3])), dict(zip("yxz", box[3:]))
    rows = vox
    for axis in "zyx":
        rows = rows.where((F.col(axis) >= low[axis] - 1) & (F.col(axis) < high[axis]))
    return rows.withColumns({axis: F.col(axis) - (low[axis] - 1) for axis in "zyx"})


def flip_z(vox: DataFrame, depth: int) -> DataFrame:
    return vox.withColumn("z", depth - 1 - F.col("z"))


def trim_z(vox: DataFrame, end: int | None) -> DataFrame:
    return vox if end is None else vox.where(F.col("z") < end)


def centre_crop(vox: DataFrame, shape: dict[str, int], target: dict[str, int]) -> DataFrame:
    """The middle of each axis; of an odd rest the smaller half is cut in front."""
    rows = vox
    for axis, size in target.items():
        start = (shape[axis] - size) // 2
        rows = rows.where((F.col(axis) >= start) & (F.col(axis) < start + size)).withColumn(axis, F.col(axis) - start)
    return rows


def centre_pad(vox: DataFrame, shape: dict[str, int], canvas: dict[str, int]) -> DataFrame:
    """Move each axis to the middle of a larger canvas; missing voxels stay absent, meaning 0."""
    return vox.withColumns({axis: F.col(axis) + (size - shape[axis]) // 2 for axis, size in canvas.items()})


def subtract_background(v: Column, background: float) -> Column:
    return F.greatest(v - background, F.lit(0))


def saturate_u16(v: Column) -> Column:
    """Round half away from zero and clip to 0..65535."""
    return F.least(F.greatest(F.round(v), F.lit(0)), F.lit(65535)).cast("int")


def decimate_z(vox: DataFrame, step: int) -> DataFrame:
    """Every step-th slice, the first at round(step / 2) counted from 1, renumbered."""
    first = int(step / 2 + 0.5) - 1
    return vox.where((F.col("z") >= first) & (F.pmod(F.col("z") - first, F.lit(step)) == 0)).withColumn("z", ((F.col("z") - first) / step).cast("int"))


def section(vox: DataFrame, axis: str, at: int) -> DataFrame:
    """An orthogonal section as (row, col, v): XY at a z, XZ at a y, or YZ at an x, the last with z across."""
    row, col = {"z": ("y", "x"), "y": ("z", "x"), "x": ("y", "z")}[axis]
    return vox.where(F.col(axis) == at).select("t", "c", F.col(row).alias("row"), F.col(col).alias("col"), "v")


def to_display(y: Column, x: Column, h: Column, w: Column, k: Column) -> Column:
    """Where a point of an h x w image stands after k quarter turns counter-clockwise; struct(y, x)."""
    turned = [(y, x), (w - 1 - x, y), (h - 1 - y, w - 1 - x), (x, h - 1 - y)]
    return _by_turns(turned, k)


def to_data(y: Column, x: Column, h: Column, w: Column, k: Column) -> Column:
    """The inverse of to_display; h and w are the unturned image's."""
    turned = [(y, x), (x, w - 1 - y), (h - 1 - y, w - 1 - x), (h - 1 - x, y)]
    return _by_turns(turned, k)


def _by_turns(points: list[tuple[Column, Column]], k: Column) -> Column:
    out = F.struct(points[0][0].alias("y"), points[0][1].alias("x"))
    for n, (y, x) in enumerate(points[1:], 1):
        out = F.when(F.pmod(k, F.lit(4)) == n, F.struct(y.alias("y"), x.alias("x"))).otherwise(out)
    return out


def rescale_u16(vox: DataFrame, low: float, high: float) -> DataFrame:
    """Stretch low..high to 0..65535; an empty range gives 0."""
    if high <= low:
        return vox.withColumn("v", F.lit(0))
    return vox.withColumn("v", saturate_u16((F.col("v") - low) / (high - low) * 65535))


def densify(grid: DataFrame, vox: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    """Every row of the grid, with 0 where the table has none."""
    return grid.join(vox, keys, "left").withColumn(value, F.coalesce(value, F.lit(0)))


def flat_field(vox: DataFrame, calibration: DataFrame, background: float, mean: float) -> DataFrame:
    """(v - background) / flat * mean with a calibration plane (y, x, flat), floored at 0; a flat of 0 leaves the voxel as it is.

    A calibration plane is one camera frame, whatever the number of voxels; the planner broadcasts
    it if its size allows.
    """
    v = F.when(F.col("flat") > 0, F.greatest((F.col("v") - background) / F.col("flat") * mean, F.lit(0.0))).otherwise(F.col("v").cast("double"))
    return vox.join(calibration, ["y", "x"], "left").withColumn("v", F.when(F.col("flat").isNull(), F.col("v").cast("double")).otherwise(v)).drop("flat")
