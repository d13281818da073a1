"""The engine's relations and the ways between them.

A five-dimensional array (t, z, c, y, x) is a table of planes, one row for each (dataset, t, z, c) with
the pixels as C-order little-endian bytes. Plane-wise work maps over rows without a shuffle. A
voxel view (t, z, c, y, x, v) expresses the same work relationally; a volume row holds one (t, c)
stack for kernels that need all of z.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLANES = "dataset string, t int, z int, c int, h int, w int, dtype string, data binary"
VOXELS = "dataset string, t int, z int, c int, y int, x int, v double"
VOLUMES = "dataset string, t int, c int, nz int, ny int, nx int, dtype string, data binary"
ROI = "struct<y0:int,y1:int,x0:int,x1:int>"
_PLANE_KEYS = ["dataset", "t", "z", "c"]
_ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}
#: Bytes of pixels, and voxels, after which a task hands on what it has; these and a row's own size bound its memory, however many rows Spark puts in a batch.
BATCH, VOXELS_AT_ONCE = 8 << 20, 1 << 17


def pixels(data: bytes, dtype: str, *shape: int) -> np.ndarray:
    return np.frombuffer(data, dtype).reshape(shape)


def voxels_of_arrays(rows: DataFrame, array: str, width: int, value: Callable = lambda e: e) -> DataFrame:
    """Explode a row-major array column to (.., y, x, v), inside the JVM; null arrays give no voxels."""
    rest = [c for c in rows.columns if c != array]
    flat = rows.select(*rest, F.posexplode(array).alias("p", "e"))
    return flat.select(*rest, (F.col("p") / width).cast("int").alias("y"), (F.col("p") % width).alias("x"), value(F.col("e")).alias("v"))


def arrow_schema(columns: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (x.split() for x in columns.split(", "))])


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of Arrow batches; at a time no more of them are Python objects than BATCH bytes hold."""
    for batch in batches:
        n = max(1, batch.num_rows * BATCH // max(1, batch.nbytes))
        for k in range(0, batch.num_rows, n):
            yield from batch.slice(k, n).to_pylist()


def gathered(rows: Iterator[dict]) -> Iterator[list[dict]]:
    """Rows in lists of about BATCH bytes of `data`."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r["data"]) + 1024  # a row as Python objects
        if size >= BATCH:
            yield held
            held, size = [], 0
    if held:
        yield held


def packed(rows: Iterator[dict], columns: str) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about BATCH bytes of `data`."""
    schema = arrow_schema(columns)
    for held in gathered(rows):
        yield pa.RecordBatch.from_pylist(held, schema)


def _exploded(planes: list[dict], above: float | None) -> Iterator[pa.RecordBatch]:
    """Voxel batches of planes; with `above` only of the greater values, NaN among them as Spark orders it."""
    schema = arrow_schema(VOXELS)
    for (h, w, dtype), same in groupby(planes, lambda r: (r["h"], r["w"], r["dtype"])):
        same, size = list(same), h * w
        for r in same:
            if len(r["data"]) != size * np.dtype(dtype).itemsize:
                raise ValueError(f"plane t={r['t']}, z={r['z']}, c={r['c']} has {len(r['data'])} bytes")
        flat, names = np.frombuffer(b"".join(r["data"] for r in same), dtype), pa.array([r["dataset"] for r in same], pa.string())
        keys = np.array([(r["t"], r["z"], r["c"]) for r in same], np.int32)
        for k in range(0, len(flat), VOXELS_AT_ONCE):
            v = flat[k : k + VOXELS_AT_ONCE]
            at = np.arange(len(v)) if above is None else np.flatnonzero(~(v <= above))
            plane, place = np.divmod(at + k, size)
            y, x = np.divmod(place.astype(np.int32), np.int32(w))
            columns = [names.take(pa.array(plane)), *(pa.array(keys[plane, j]) for j in range(3)), pa.array(y), pa.array(x), pa.array(v[at].astype(np.float64))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def voxels(planes: DataFrame, above: float | None = None) -> DataFrame:
    """The voxel view of planes; rows of each plane in C order. With `above` voxels of greater values only, chosen before any is a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in gathered(rows_of(batches)):
            yield from _exploded(held, above)

    return planes.select(*[c.split()[0] for c in PLANES.split(", ")]).mapInArrow(run, VOXELS)


def planes_of_voxels(vox: DataFrame, dtype: str = "<u2") -> DataFrame:
    """Planes of a voxel table; the shape is one more than the largest y and x of each plane, missing voxels are 0."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        h, w = int(rows["y"].max()) + 1, int(rows["x"].max()) + 1
        image = np.zeros((h, w), dtype)
        image[rows["y"], rows["x"]] = rows["v"]
        return pd.DataFrame([[*key, h, w, dtype, image.tobytes()]], columns=[c.split()[0] for c in PLANES.split(", ")])

    return vox.groupBy(*_PLANE_KEYS).applyInPandas(run, PLANES)


def map_planes(planes: DataFrame, image: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Apply a function of one plane's pixels to every plane; narrow, one plane at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(r: dict) -> dict:
            v = np.ascontiguousarray(image(pixels(r["data"], r["dtype"], r["h"], r["w"])))
            v = v.astype(v.dtype.newbyteorder("<"))
            return {**r, "h": v.shape[0], "w": v.shape[1], "dtype": v.dtype.str, "data": v.tobytes()}

        return packed(map(done, rows_of(batches)), PLANES)

    return planes.select(*[c.split()[0] for c in PLANES.split(", ")]).mapInArrow(run, PLANES)


def _by_stack(planes: DataFrame, where: str) -> DataFrame:
    """Planes with each (dataset, t, c) in one partition and next to each other, by z."""
    return planes.where(where).select(*[c.split()[0] for c in PLANES.split(", ")]).repartition("dataset", "t", "c").sortWithinPartitions("dataset", "t", "c", "z")


def _stack(planes: list[dict]) -> dict:
    first, h, w = planes[0], max(r["h"] for r in planes), max(r["w"] for r in planes)
    out = np.zeros((max(r["z"] for r in planes) + 1, h, w), first["dtype"])
    for r in planes:
        out[r["z"], : r["h"], : r["w"]] = pixels(r["data"], first["dtype"], r["h"], r["w"])
    return {**{k: first[k] for k in ("dataset", "t", "c")}, "nz": len(out), "ny": h, "nx": w, "dtype": first["dtype"], "data": out.tobytes()}


def _stacked(rows: Iterator[dict]) -> Iterator[dict]:
    """Volume rows of planes that lie as `_by_stack` puts them; one stack is held at a time."""
    for _, same in groupby(rows, lambda r: (r["dataset"], r["t"], r["c"])):
        yield _stack(list(same))


def volumes(planes: DataFrame, where: str = "true", kernel: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """One row for each (dataset, t, c): its planes stacked by z, planes not listed are zero. `where` is pushed to the planes' scan.
    With a kernel `map_volumes(volumes(planes, where), kernel)` in one pass of Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stacks = _stacked(rows_of(batches))
        return packed(stacks if kernel is None else (_made(r, kernel) for r in stacks), VOLUMES)

    return _by_stack(planes, where).mapInArrow(run, VOLUMES)


def _through(r: dict, kernel: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    v = np.ascontiguousarray(kernel(pixels(r["data"], r["dtype"], r["nz"], r["ny"], r["nx"])))
    return v.astype(v.dtype.newbyteorder("<"))


def _made(r: dict, kernel: Callable[[np.ndarray], np.ndarray]) -> dict:
    v = _through(r, kernel)
    return {**r, "nz": v.shape[0], "ny": v.shape[1], "nx": v.shape[2], "dtype": v.dtype.str, "data": v.tobytes()}


def map_volumes(rows: DataFrame, kernel: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Apply a function of one (z, y, x) stack to every volume row, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return packed((_made(r, kernel) for r in rows_of(batches)), VOLUMES)

    return rows.select(*[c.split()[0] for c in VOLUMES.split(", ")]).mapInArrow(run, VOLUMES)


def _slices(r: dict, v: np.ndarray) -> Iterator[dict]:
    """A plane row for each z of one volume."""
    for z in range(len(v)):
        yield {"dataset": r["dataset"], "t": r["t"], "z": z, "c": r["c"], "h": v.shape[1], "w": v.shape[2], "dtype": v.dtype.str, "data": v[z].tobytes()}


def planes_of_volumes(rows: DataFrame) -> DataFrame:
    """One plane row for each z of each volume."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return packed((p for r in rows_of(batches) for p in _slices(r, pixels(r["data"], r["dtype"], r["nz"], r["ny"], r["nx"]))), PLANES)

    return rows.select(*[c.split()[0] for c in VOLUMES.split(", ")]).mapInArrow(run, PLANES)


def _voxels_made(stacks: Iterator[dict], kernel: Callable[[np.ndarray], np.ndarray], above: float | None) -> Iterator[pa.RecordBatch]:
    for held in gathered(p for r in stacks for p in _slices(r, _through(r, kernel))):
        yield from _exploded(held, above)


def voxels_of_volumes(rows: DataFrame, kernel: Callable[[np.ndarray], np.ndarray], above: float | None = None) -> DataFrame:
    """`voxels(planes_of_volumes(map_volumes(rows, kernel)), above)` in one pass of Python: a volume that a kernel made is not handed from worker to worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _voxels_made(rows_of(batches), kernel, above)

    return rows.select(*[c.split()[0] for c in VOLUMES.split(", ")]).mapInArrow(run, VOXELS)


def voxels_of_stacks(planes: DataFrame, kernel: Callable[[np.ndarray], np.ndarray], above: float | None = None, where: str = "true") -> DataFrame:
    """`voxels_of_volumes(volumes(planes, where), kernel, above)` in one pass of Python: a task has one worker, and stacks with their zero planes stay in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _voxels_made(_stacked(rows_of(batches)), kernel, above)

    return _by_stack(planes, where).mapInArrow(run, VOXELS)
