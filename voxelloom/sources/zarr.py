"""Zarr v2 arrays and OME-NGFF stores.

Chunks are C-ordered, raw, zlib, gzip or Blosc (LZ4, Zstandard, zlib, Snappy; bytes shuffled or not); written are raw and zlib. Reading works on any file system
Spark reads; writing, linking and the scan by chunk names (`chunks`) need a folder that all executors mount.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..model import PLANES, VOLUMES, pixels
from ..operators.names import ranked_index
from .chunks import CHUNK, Zarr, array_metadata, scan, unpacked
from .tiff import put

# Default channel colours of a store, in order.
COLOURS = ["00FF00", "FF00FF", "0000FF", "FF0000"]
SLAB = 64


def register(spark: SparkSession) -> None:
    """Make `format("zarr")` known to writers."""
    spark.dataSource.register(Zarr)


def write_planes(planes: DataFrame, folder: str, compress: bool = False) -> int:
    """Write one (t, z, c, y, x) array with a chunk for each plane; how many chunks. Planes that are missing read as 0.

    An array that was there before stays whole until the new one is, so planes may even be read from the folder they are written to; it also stays if the job fails.
    """
    register(planes.sparkSession)
    seen = Observation()
    rows = planes.select(*[c.split()[0] for c in PLANES.split(", ")]).observe(seen, F.count("*").alias("n"))
    rows.write.format("zarr").mode("overwrite").option("compress", str(compress).lower()).save(folder)
    return seen.get["n"]


def write_volumes(volumes: DataFrame, folder: str, base: str, compress: bool = False) -> int:
    """Write `{base}_T{t:04d}_C{c}.zarr`, a (z, y, x) array in slabs of SLAB slices, for each volume; slabs beyond the last one, of an earlier array, go."""
    os.makedirs(folder, exist_ok=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                v, chunk = pixels(r.data, r.dtype, r.nz, r.ny, r.nx), [min(SLAB, r.nz), r.ny, r.nx]
                target = os.path.join(folder, f"{base}_T{r.t:04d}_C{r.c}.zarr")
                os.makedirs(target, exist_ok=True)
                slabs = {f"{k // chunk[0]}.0.0" for k in range(0, r.nz, chunk[0])}
                for name in os.listdir(target):
                    if CHUNK.fullmatch(name) and name not in slabs:
                        os.remove(os.path.join(target, name))
                for k in range(0, r.nz, chunk[0]):
                    part = np.zeros(chunk, v.dtype)
                    part[: len(v[k : k + chunk[0]])] = v[k : k + chunk[0]]
                    put(os.path.join(target, f"{k // chunk[0]}.0.0"), zlib.compress(part.tobytes(), 1) if compress else part.tobytes())
                put(os.path.join(target, ".zarray"), json.dumps(array_metadata([r.nz, r.ny, r.nx], chunk, r.dtype, compress)).encode())
            yield pd.DataFrame({"n": [len(pdf)]})

    return volumes.mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0


def _small_text(spark: SparkSession, path: str) -> str | None:
    """A metadata file's text, on any file system Spark reads; its readers skip names with a leading dot. None if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _metadata(spark: SparkSession, folder: str) -> dict:
    text = _small_text(spark, f"{folder}/.zarray")
    if text is None:
        raise FileNotFoundError(f"{folder}/.zarray")
    return json.loads(text)


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """(key, index array<int>, content) of an array's chunk files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[0-9]*").load(folder)
    key = F.element_at(F.split("path", "/"), -1)
    return files.select(key.alias("key"), F.split(key, r"\.").cast("array<int>").alias("index"), "content")


def read_planes(spark: SparkSession, folder: str, dataset: str = "zarr") -> DataFrame:
    """Plane rows of a (t, z, c, y, x) array with one chunk a plane, or of a (t, c, z, y, x) store; planes without a chunk are left out.

    In a folder that is mounted filters on t, z and c decide which chunks are opened. Elsewhere Spark lists and reads them all.
    """
    if os.path.isdir(folder):
        return scan(spark, folder, dataset, missing="skip")
    meta = _metadata(spark, folder)
    zc = 1 if meta["chunks"][2] > 1 or _is_store(spark, folder) else 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for index, content in zip(pdf["index"], pdf["content"]):
                v = unpacked(content, meta)
                t, second, third = (int(k) * n for k, n in zip(index[:3], meta["chunks"][:3]))
                stack = v.reshape(-1, *v.shape[3:])
                for k, image in enumerate(stack):
                    z, c = (third + k, second) if zc == 1 else (second, third)
                    if zc == 2 or z < meta["shape"][2]:
                        out.append([dataset, t, z, c, *image.shape, meta["dtype"], image.tobytes()])
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PLANES.split(", ")])

    return read_chunks(spark, folder).select("index", "content").mapInPandas(run, PLANES)


def _is_store(spark: SparkSession, folder: str) -> bool:
    """Whether the array is resolution 0 of a store, whose axes are t, c, z, y, x."""
    parent = folder.rstrip("/").rpartition("/")[0]
    return "multiscales" in (_small_text(spark, f"{parent}/.zattrs") or "")


def read_volumes(spark: SparkSession, folder: str, base: str) -> DataFrame:
    """Volume rows of the `{base}_T.._C...zarr` arrays in a folder; slabs of an array meet in one group.

    Arrays of one base are alike, so the first one's metadata holds for all.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = rf"/{re.escape(base)}_T(\d+)_C(\d+)\.zarr/([^/]+)$"
    part = lambda k: F.regexp_extract("path", name, k)
    files = files.where(F.col("path").rlike(name))
    first = files.agg(F.min("path")).first()[0]
    meta = _metadata(spark, first.rpartition("/")[0]) if first else {}
    rows = files.select(part(1).cast("int").alias("t"), part(2).cast("int").alias("c"), part(3).alias("key"), "content")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        held = dict(zip(pdf["key"], pdf["content"]))
        v = np.zeros([-(-s // c) * c for s, c in zip(meta["shape"], meta["chunks"])], meta["dtype"])
        for k, data in held.items():
            v[tuple(slice(int(i) * c, (int(i) + 1) * c) for i, c in zip(k.split("."), meta["chunks"]))] = unpacked(data, meta)
        v = v[tuple(slice(0, s) for s in meta["shape"])]
        return pd.DataFrame([[base, *map(int, key), *v.shape, meta["dtype"], v.tobytes()]], columns=[c.split()[0] for c in VOLUMES.split(", ")])

    return rows.groupBy("t", "c").applyInPandas(run, VOLUMES)


def store_attributes(name: str, labels: list[str], t_step: float, xy_step: float) -> dict:
    """OME-NGFF 0.4 attributes; volumes are isotropic by then, so z has the step of x and y."""
    axes = [{"name": "t", "type": "time", "unit": "second"}, {"name": "c", "type": "channel"}, *[{"name": a, "type": "space", "unit": "micrometer"} for a in "zyx"]]
    scale = {"type": "scale", "scale": [t_step, 1.0, xy_step, xy_step, xy_step]}
    channels = [{"label": label, "active": True, "color": colour} for label, colour in zip(labels, COLOURS)]
    return {"multiscales": [{"version": "0.4", "name": name, "axes": axes, "datasets": [{"path": "0", "coordinateTransformations": [scale]}]}], "omero": {"channels": channels}}


def consolidate(spark: SparkSession, folder: str, base: str, xy_step: float, t_step: float, labels: list[str] | None = None) -> int:
    """Join a folder's `{base}_T.._C...zarr` arrays into `{base}.ome.zarr` without copying pixels; how many chunks it has.

    t and c become ranks. Chunk files are linked under new names by tasks, hard where the file
    system allows, else symbolically; links that exist stay. Returns 0 if there is nothing to join.
    """
    found = [(int(m[1]), int(m[2]), n) for n in sorted(os.listdir(folder)) if (m := re.fullmatch(rf"{re.escape(base)}_T(\d+)_C(\d+)\.zarr", n))]
    if not found:
        return 0
    first = os.path.join(folder, found[0][2], ".zarray")
    if not os.path.exists(first):
        return 0
    with open(first) as f:
        meta = json.load(f)
    arrays = spark.createDataFrame([("x", t, c, n) for t, c, n in found], "dir string, t int, c int, name string")
    target = os.path.join(folder, f"{base.removesuffix('.ome')}.ome.zarr")
    os.makedirs(os.path.join(target, "0"), exist_ok=True)

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = 0
            for r in pdf.itertuples():
                source = os.path.join(folder, r.name)
                for key in os.listdir(source):
                    goal = os.path.join(target, "0", f"{r.t}.{r.c}.{key}")
                    if key.startswith(".") or key.endswith(".part"):
                        continue
                    n += 1
                    if os.path.lexists(goal):
                        continue
                    try:
                        os.link(os.path.join(source, key), goal)
                    except FileExistsError:
                        pass
                    except OSError:
                        os.symlink(os.path.abspath(os.path.join(source, key)), goal)
            yield pd.DataFrame({"n": [n]})

    linked = ranked_index(arrays).select("t", "c", "name").mapInPandas(link, "n long").agg(F.sum("n")).first()[0]
    nt, nc = len({t for t, _, _ in found}), len({c for _, c, _ in found})
    named = labels if labels and len(labels) == nc else [f"C{c}" for c in sorted({c for _, c, _ in found})]
    whole = {**meta, "shape": [nt, nc, *meta["shape"]], "chunks": [1, 1, *meta["chunks"]]}
    put(os.path.join(target, "0", ".zarray"), json.dumps(whole).encode())
    put(os.path.join(target, ".zgroup"), json.dumps({"zarr_format": 2}).encode())
    put(os.path.join(target, ".zattrs"), json.dumps(store_attributes(base, named, t_step, xy_step), indent=2).encode())
    return linked
