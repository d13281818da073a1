"""Regions of interest: validity, alignment guards, snapping, the ROI log."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import PLANES
from .voxels import Roi

#: Largest accepted alignment shift in pixels, and least side of a drawn region.
MAX_SHIFT, LEAST_SPAN = 60.0, 5
#: Side of the tiles by which boxes find each other.
TILE = 256
_NAMES = [c.split()[0] for c in PLANES.split(", ")]


def _within(roi: Roi) -> Column:
    return (F.col("y") >= roi.y0) & (F.col("y") < roi.y1) & (F.col("x") >= roi.x0) & (F.col("x") < roi.x1)


def validity(projection: DataFrame, keys: list[str], top: Roi, bottom: Roi, threshold: float = 1.0) -> DataFrame:
    """(keys, top_mean, bottom_mean, outcome): a region is valid if its mean exceeds the threshold; only two valid ones are aligned."""
    means = projection.groupBy(*keys).agg(F.avg(F.when(_within(top), F.col("v"))).alias("top_mean"), F.avg(F.when(_within(bottom), F.col("v"))).alias("bottom_mean"))
    a, b = (F.coalesce(F.col(c) > threshold, F.lit(False)) for c in ("top_mean", "bottom_mean"))
    return means.withColumn("outcome", F.when(a & b, "align").when(a, "top only").when(b, "bottom only").otherwise("none"))


def guarded_shift(dy: Column, dx: Column, most: float = MAX_SHIFT) -> Column:
    """struct(dy, dx), zero if the shift is longer than `most`."""
    far = F.sqrt(dy * dy + dx * dx) > most
    return F.struct(F.when(far, 0).otherwise(dy).alias("dy"), F.when(far, 0).otherwise(dx).alias("dx"))


def inside(sides: dict[str, tuple[int, int]]) -> Column:
    """Whether a crop of half-width h around a place lies inside an axis of n, for each axis: (h, n)."""
    out = F.lit(True)
    for axis, (half, size) in sides.items():
        out = out & (F.col(axis) - half >= 0) & (F.col(axis) + half < size)
    return out


def snapped(first: Column, drawn: Column) -> Column:
    """The second region: the first's size around the drawn one's centre; drawn sides under LEAST_SPAN give null."""
    cy, cx = (F.floor((drawn[a] + drawn[b]) / 2) for a, b in (("y0", "y1"), ("x0", "x1")))
    h, w = first["y1"] - first["y0"], first["x1"] - first["x0"]
    y0, x0 = cy - F.floor(h / 2), cx - F.floor(w / 2)
    fits = (drawn["y1"] - drawn["y0"] >= LEAST_SPAN) & (drawn["x1"] - drawn["x0"] >= LEAST_SPAN)
    return F.when(fits, F.struct(y0.cast("int").alias("y0"), (y0 + h).cast("int").alias("y1"), x0.cast("int").alias("x0"), (x0 + w).cast("int").alias("x1")))


def read_log(json: DataFrame, column: str = "value") -> DataFrame:
    """(file_name, top, bottom) of ROI log texts; a corrupt log gives no rows."""
    roi = "map<string, struct<top_roi: array<int>, bottom_roi: array<int>>>"
    rows = json.select(F.explode(F.from_json(column, roi)).alias("file_name", "r"))

    def region(c: str) -> Column:
        a = F.col(f"r.{c}")
        return F.when(F.size(a) == 4, F.struct(*[a[k].alias(n) for k, n in enumerate(("y0", "y1", "x0", "x1"))]))

    return rows.select("file_name", region("top_roi").alias("top"), region("bottom_roi").alias("bottom"))


def write_log(rois: DataFrame) -> DataFrame:
    """One JSON entry text for each row of (file_name, top, bottom)."""

    def numbers(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.array(*[F.col(c)[k] for k in ("y0", "y1", "x0", "x1")]))

    entry = F.create_map("file_name", F.struct(numbers("top").alias("top_roi"), numbers("bottom").alias("bottom_roi")))
    return rois.select(F.to_json(entry, {"ignoreNullFields": "false"}).alias("value"))


def box_join(left: DataFrame, right: DataFrame, left_box: Sequence[str], right_box: Sequence[str], keys: Sequence[str] = (), tile: int = TILE) -> DataFrame:
    """Pairs of rows whose half-open boxes (y0, y1, x0, x1 by column name) overlap and whose `keys` are equal, each pair once.

    Each row is keyed by the tiles its box touches, so candidates come from an equi-join, which a planner may broadcast, shuffle or split; then the boxes themselves
    are compared. Of the tiles a pair shares the one that holds the first pixel of their overlap reports it. Empty boxes, and those with a null side, meet nothing. Apart from the keys no
    two columns of the tables may share a name.
    """

    def tiled(rows: DataFrame, box: Sequence[str], *names: str) -> DataFrame:
        y0, y1, x0, x1 = map(F.col, box)
        sides = [F.explode(F.sequence(F.floor(a / tile), F.floor((b - 1) / tile))).alias(n) for a, b, n in ((y0, y1, names[0]), (x0, x1, names[1]))]
        return rows.where((y1 > y0) & (x1 > x0)).select("*", sides[0]).select("*", sides[1])

    pairs = tiled(left, left_box, "tile_y", "tile_x").join(tiled(right, right_box, "tile_y", "tile_x"), [*keys, "tile_y", "tile_x"])
    (a0, a1, b0, b1), (c0, c1, d0, d1) = (list(map(F.col, box)) for box in (left_box, right_box))
    y, x = F.greatest(a0, c0), F.greatest(b0, d0)
    met = (y < F.least(a1, c1)) & (x < F.least(b1, d1)) & (F.floor(y / tile) == F.col("tile_y")) & (F.floor(x / tile) == F.col("tile_x"))
    return pairs.where(met).drop("tile_y", "tile_x")


def _met(planes: DataFrame, regions: DataFrame, keys: Sequence[str], tile: int) -> DataFrame:
    """Planes with each region that meets them, cut at the plane's edges."""
    framed = planes.select(*_NAMES).withColumns({"top": F.lit(0), "left": F.lit(0)})
    met = box_join(framed, regions, ("top", "h", "left", "w"), ("y0", "y1", "x0", "x1"), keys, tile)
    return met.select("roi", *_NAMES, F.greatest("y0", "top").cast("int").alias("y0"), F.least("y1", "h").cast("int").alias("y1"), F.greatest("x0", "left").cast("int").alias("x0"), F.least("x1", "w").cast("int").alias("x1"))


def _cut(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The part of each row's plane inside its region."""
    columns = [batch.column(n).to_pylist() for n in ("data", "dtype", "h", "w", "y0", "y1", "x0", "x1")]
    for data, dtype, h, w, y0, y1, x0, x1 in zip(*columns):
        yield np.frombuffer(data, dtype).reshape(h, w)[y0:y1, x0:x1]


def crops(planes: DataFrame, regions: DataFrame, keys: Sequence[str] = (), tile: int = TILE) -> DataFrame:
    """Plane rows cut by each region (roi, y0, y1, x0, x1) that meets them, with `roi`; a region beyond the plane's edge is cut there. With keys, a region is for the planes that share them."""
    rows = _met(planes, regions, keys, tile)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            images = list(_cut(batch))
            new = {"h": pa.array([i.shape[0] for i in images], pa.int32()), "w": pa.array([i.shape[1] for i in images], pa.int32()), "data": pa.array([i.tobytes() for i in images], pa.binary())}
            yield pa.RecordBatch.from_arrays([new.get(n, batch.column(n)) for n in ("roi", *_NAMES)], names=["roi", *_NAMES])

    return rows.mapInArrow(run, f"roi {rows.schema['roi'].dataType.simpleString()}, {PLANES}")


def region_maxima(planes: DataFrame, regions: DataFrame, keys: Sequence[str] = (), tile: int = TILE) -> DataFrame:
    """(roi, dataset, t, z, c, top, n): maximum and number of the pixels of each plane inside each region that meets it; no pixel is a row."""
    rows, places = _met(planes, regions, keys, tile), ("roi", "dataset", "t", "z", "c")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            images = list(_cut(batch))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in places), pa.array([float(i.max()) for i in images]), pa.array([i.size for i in images], pa.int64())], names=[*places, "top", "n"])

    return rows.mapInArrow(run, f"roi {rows.schema['roi'].dataType.simpleString()}, dataset string, t int, z int, c int, top double, n long")
