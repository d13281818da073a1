"""Chunks of Zarr v2 arrays: their codecs, a writer in two phases and a scan that derives chunk names from the metadata."""

from __future__ import annotations

import json
import math
import os
import re
import shutil
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.functions import arrow_udf

from ..model import PLANES
from .pages import listed, tasks_for

CHUNK = re.compile(r"\d+([./]\d+)*")
# Of a Blosc frame, its flags, its codecs by number, and when a block is split into streams.
SHUFFLED, STORED, BITS_SHUFFLED, NOT_SPLIT = 1, 2, 4, 16
BLOSC_CODECS = {1: "lz4_raw", 2: "snappy", 3: "zlib", 4: "zstd"}
MOST_SPLITS, LEAST_SPLIT = 16, 128


def array_metadata(shape: list[int], chunks: list[int], dtype: str, compress: bool = False) -> dict:
    return {"zarr_format": 2, "shape": shape, "chunks": chunks, "dtype": dtype, "compressor": {"id": "zlib", "level": 1} if compress else None, "fill_value": 0, "order": "C", "filters": None}


def unblosc(frame: bytes) -> bytes:
    """The bytes of a Blosc frame: blocks that stand where the header's offsets say, each of one compressed stream or one for each byte of an element, shuffled by bytes or not."""
    flags, size = frame[2], frame[3]
    total, block, _ = struct.unpack_from("<III", frame, 4)
    if flags & STORED:
        return frame[16 : 16 + total]
    inner = BLOSC_CODECS.get(flags >> 5)
    if inner is None or flags & BITS_SHUFFLED:
        raise ValueError(f"Blosc codec {flags >> 5}{', bit shuffle' if flags & BITS_SHUFFLED else ''} is not supported")
    out = []
    for k in range(-(-total // block) if total else 0):
        at, length = struct.unpack_from("<I", frame, 16 + 4 * k)[0], min(block, total - k * block)
        split = not flags & NOT_SPLIT and size <= MOST_SPLITS and block // size >= LEAST_SPLIT and length == block
        streams = size if split else 1
        parts = []
        for _ in range(streams):
            n, at = struct.unpack_from("<i", frame, at)[0], at + 4
            raw, at = frame[at : at + n], at + n
            if n < length // streams:
                raw = zlib.decompress(raw) if inner == "zlib" else pa.Codec(inner).decompress(raw, decompressed_size=length // streams, asbytes=True)
            parts.append(raw)
        data = b"".join(parts)
        if flags & SHUFFLED and size > 1:
            n = length // size
            data = np.frombuffer(data, np.uint8, n * size).reshape(size, n).T.tobytes() + data[n * size :]
        out.append(data)
    return b"".join(out)


def unpacked(data: bytes, meta: dict) -> np.ndarray:
    """A chunk's elements in the shape of a whole chunk."""
    packing = (meta.get("compressor") or {}).get("id")
    unpack = {None: bytes, "zlib": lambda d: zlib.decompress(d, 47), "gzip": lambda d: zlib.decompress(d, 47), "blosc": unblosc}.get(packing)
    if unpack is None:
        raise ValueError(f"compressor {packing} is not supported")
    if meta.get("order", "C") != "C" or meta.get("filters"):
        raise ValueError("only C-ordered chunks without filters are supported")
    return np.frombuffer(unpack(data), meta["dtype"]).reshape(meta["chunks"])


@dataclass
class _Written(WriterCommitMessage):
    """What a task wrote: planes, the largest t, z and c, and the (dataset, h, w, dtype) it met."""

    planes: int = 0
    top: list[int] = field(default_factory=lambda: [-1, -1, -1])
    kinds: set = field(default_factory=set)


class ZarrWriter(DataSourceArrowWriter):
    """One (t, z, c, y, x) array with a chunk for each plane row, in two phases.

    Tasks write chunks to a new folder beside the array's; an attempt that is repeated writes the same files again. Only when all have ended well is the metadata
    written, from what they report, and the folder put in the place of the old one, whose other files go with it. A job that fails leaves
    the old array as it was. Rows are evaluated once. Planes of several datasets, sizes or types are refused.
    """

    def __init__(self, folder: str, compress: bool):
        self.folder, self.compress = folder.rstrip("/"), compress
        parent, name = os.path.split(self.folder)
        self.staging = os.path.join(parent, f".{name}-{uuid.uuid4().hex}.new")
        os.makedirs(self.staging)  # here, not by tasks: one that outlives its job then fails instead of making it anew

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        done = _Written()
        for batch in iterator:
            for r in batch.to_pylist():
                if len(r["data"]) != r["h"] * r["w"] * np.dtype(r["dtype"]).itemsize:
                    raise ValueError(f"plane t={r['t']}, z={r['z']}, c={r['c']} has {len(r['data'])} bytes")
                place = [r["t"], r["z"], r["c"]]
                part = os.path.join(self.staging, f".{uuid.uuid4().hex}.part")
                with open(part, "wb") as f:
                    f.write(zlib.compress(r["data"], 1) if self.compress else r["data"])
                os.replace(part, os.path.join(self.staging, ".".join(map(str, [*place, 0, 0]))))
                done.planes += 1
                done.top = [max(a, b) for a, b in zip(done.top, place)]
                done.kinds.add((r["dataset"], r["h"], r["w"], r["dtype"]))
        return done

    def commit(self, messages: list[_Written | None]) -> None:
        done = [m for m in messages if m is not None and m.planes]
        kinds = set().union(*(m.kinds for m in done)) if done else set()
        if len(kinds) != 1:
            raise ValueError("there are no planes" if not kinds else f"one array can't hold planes of different datasets, sizes or types: {sorted(map(str, kinds))[:3]}")
        ((_, h, w, dtype),) = kinds
        shape = [*(max(m.top[k] for m in done) + 1 for k in range(3)), h, w]
        for name in os.listdir(self.staging):
            if name.endswith(".part"):  # of an attempt that was killed
                os.remove(os.path.join(self.staging, name))
        with open(os.path.join(self.staging, ".zarray"), "w") as f:
            json.dump(array_metadata(shape, [1, 1, 1, h, w], dtype, self.compress), f)
        old = self.staging.removesuffix("new") + "old"
        if os.path.isdir(self.folder):
            for name in os.listdir(self.folder):
                source = os.path.join(self.folder, name)
                if not CHUNK.fullmatch(name) and name != ".zarray":
                    (shutil.copytree if os.path.isdir(source) else shutil.copy2)(source, os.path.join(self.staging, name))
            os.rename(self.folder, old)
        os.rename(self.staging, self.folder)
        shutil.rmtree(old, ignore_errors=True)

    def abort(self, messages: list[_Written | None]) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


class Planes:
    """Planes of an array, by the names of the chunks that hold them. The chunks that were read last are kept."""

    def __init__(self, folder: str, meta: dict, skip: bool):
        self.folder, self.meta, self.skip, self.at, self.block = folder, meta, skip, None, None
        self.fill, self.kind = meta.get("fill_value") or 0, np.dtype(meta["dtype"]).newbyteorder("<")

    def _read(self, at: tuple[int, ...]) -> np.ndarray | None:
        """The chunks at a place of the axes before y and x, put together over y and x; None if there is none."""
        shape, chunks, out = self.meta["shape"], self.meta["chunks"], None
        for i in range(-(-shape[-2] // chunks[-2])):
            for j in range(-(-shape[-1] // chunks[-1])):
                try:
                    with open(os.path.join(self.folder, self.meta.get("dimension_separator", ".").join(map(str, [*at, i, j]))), "rb") as f:
                        part = unpacked(f.read(), self.meta)
                except FileNotFoundError:
                    continue
                if out is None:
                    out = np.full([*chunks[:-2], *shape[-2:]], self.fill, self.meta["dtype"])
                y, x = i * chunks[-2], j * chunks[-1]
                out[..., y : y + chunks[-2], x : x + chunks[-1]] = part[..., : shape[-2] - y, : shape[-1] - x]
        return out

    def plane(self, place: tuple[int, ...]) -> list[tuple]:
        """(h, w, dtype, data) of a plane; nothing if no chunk has a part of it and such planes are skipped."""
        sizes = self.meta["chunks"]
        at, inner = tuple(p // c for p, c in zip(place, sizes)), tuple(p % c for p, c in zip(place, sizes))
        if at != self.at:
            self.at, self.block = at, self._read(at)
        if self.block is None and self.skip:
            return []
        image = np.full(self.meta["shape"][-2:], self.fill, self.kind) if self.block is None else self.block[inner].astype(self.kind)
        return [(*image.shape, self.kind.str, image.tobytes())]


def scan(spark: SparkSession, folder: str, dataset: str = "zarr", axes: str = "", missing: str = "fill") -> DataFrame:
    """Plane rows of an array in a folder that all executors mount, by chunk names that follow from its metadata: nothing is listed.

    Places are numbers of a range, those of one chunk next to each other; a function over batches of them reads the planes. So filters on t, z and c, of any form, are applied to numbers before a
    chunk is opened. A chunk that isn't there is all fill value; with missing="skip" planes that no chunk has a part of are left out. An axis that the array has not got is 0.
    """
    if missing not in ("fill", "skip"):
        raise ValueError(f"missing is {missing!r}, not fill or skip")
    with open(os.path.join(folder, ".zarray")) as f:
        meta = json.load(f)
    axes = axes or axes_of(folder, len(meta["shape"]))
    if len(axes) != len(meta["shape"]) or axes[-2:] != "yx" or not set(axes[:-2]) <= set("tzc"):
        raise ValueError(f"axes {axes!r} don't fit an array of {len(meta['shape'])} dimensions whose last are y and x")
    shape, sizes = meta["shape"][:-2], meta["chunks"][:-2]
    grid = [-(-n // c) for n, c in zip(shape, sizes)]
    n, rest = math.prod(grid) * math.prod(sizes), F.col("id")
    # from the last axis to the first: the place in the chunk, then the chunk's number
    inner, outer = [], []
    for found, counts in ((inner, sizes), (outer, grid)):
        for k in reversed(counts):
            found.insert(0, F.pmod(rest, F.lit(k)))
            rest = F.floor(rest / k)
    at = {a: (o * c + i).cast("int") for a, o, i, c in zip(axes, outer, inner, sizes)}
    pixels = math.prod(meta["shape"][-2:]) * np.dtype(meta["dtype"]).itemsize
    rows = spark.range(0, n, 1, tasks_for(n, n * pixels)).select(*[at.get(a, F.lit(0)).alias(a) for a in "tzc"])
    for a, size in zip(axes, shape):
        rows = rows.where(F.col(a) < size)
    target, skip, depth = os.path.abspath(folder), missing == "skip", len(shape)

    @arrow_udf("array<struct<h:int,w:int,dtype:string,data:binary>>")
    def plane_at(places: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        held = Planes(target, meta, skip)
        found = (held.plane(place[:depth]) for columns in places for place in zip(*(c.to_pylist() for c in columns)))
        return listed(found, "h int, w int, dtype string, data binary")

    # tzc as well, so that an array without these axes has a column to be called for
    planes = rows.select("t", "z", "c", F.inline(plane_at(*[F.col(a) for a in (*axes[:-2], *"tzc")])))
    return planes.select(F.lit(dataset).alias("dataset"), "t", "z", "c", "h", "w", "dtype", "data")


def axes_of(folder: str, dimensions: int) -> str:
    """The axes that the store above an array names; of a store that names none t, c, z, y, x, of an array in no store t, z, c, y, x, or the last of them."""
    try:
        with open(os.path.join(os.path.dirname(folder.rstrip("/")), ".zattrs")) as f:
            stores = json.load(f).get("multiscales")
    except (OSError, ValueError):
        stores = None
    if not stores:
        return {4: "zcyx"}.get(dimensions, "tzcyx" if dimensions == 5 else "zyx"[-dimensions:])
    named = stores[0].get("axes")
    return "".join(a["name"] if isinstance(a, dict) else a for a in named) if named else "tczyx"[-dimensions:]


class Zarr(DataSource):
    """`df.write.format("zarr").mode("overwrite").save(folder)` of plane rows, to a folder that all executors mount; option `compress`, true or false."""

    @classmethod
    def name(cls) -> str:
        return "zarr"

    def schema(self) -> str:
        return PLANES

    def writer(self, schema, overwrite: bool) -> ZarrWriter:
        folder = self.options["path"]
        if not overwrite and os.path.exists(os.path.join(folder, ".zarray")):
            raise FileExistsError(f"{folder} holds an array; it can be overwritten, not added to")
        return ZarrWriter(folder, self.options.get("compress", "false").lower() == "true")
