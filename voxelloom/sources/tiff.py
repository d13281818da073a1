"""TIFF files: codec, reading by Spark, and writing; single pages are read by `pages`.

The codec handles classic and BigTIFF in both byte orders, grey pages in
strips, uncompressed, deflate or LZW, with or without differences along rows, and writes uncompressed or deflate little-endian pages. No other TIFF software is
installed where this was built, so only round trips and bytes made by hand are tested.
"""

from __future__ import annotations

import mmap
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import PLANES, VOLUMES, arrow_schema, packed, pixels, rows_of

# The tags that matter, and bytes of each field type.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, DESCRIPTION, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PREDICTOR, SAMPLE_FORMAT = 256, 257, 258, 259, 262, 270, 273, 277, 278, 279, 317, 339
TYPE_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4, 16: 8, 17: 8, 18: 8}
TYPE_CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
NONE, LZW, DEFLATE, OLD_DEFLATE = 1, 5, 8, 32946
CLEAR, END = 256, 257


def directories(raw: bytes) -> Iterator[tuple[str, dict[int, tuple]]]:
    """(byte order, tags) of each page in turn."""
    order = {b"II": "<", b"MM": ">"}.get(raw[:2])
    if order is None:
        raise ValueError("not a TIFF file")
    version = struct.unpack_from(order + "H", raw, 2)[0]
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    big = version == 43
    at = struct.unpack_from(order + ("Q" if big else "I"), raw, 8 if big else 4)[0]
    count_code, entry, inline = ("Q", 20, 8) if big else ("H", 12, 4)
    seen = set()
    while at and at not in seen:
        seen.add(at)
        n = struct.unpack_from(order + count_code, raw, at)[0]
        at += struct.calcsize(count_code)
        tags = {}
        for k in range(n):
            tag, kind = struct.unpack_from(order + "HH", raw, at + k * entry)
            many = struct.unpack_from(order + ("Q" if big else "I"), raw, at + k * entry + 4)[0]
            size, value_at = TYPE_BYTES.get(kind, 1) * many, at + k * entry + (12 if big else 8)
            if size > inline:
                value_at = struct.unpack_from(order + ("Q" if big else "I"), raw, value_at)[0]
            if kind == 2:
                tags[tag] = (raw[value_at : value_at + many].split(b"\0")[0].decode("utf-8", "replace"),)
            elif kind in TYPE_CODES:
                tags[tag] = struct.unpack_from(f"{order}{many}{TYPE_CODES[kind]}", raw, value_at)
        yield order, tags
        at = struct.unpack_from(order + ("Q" if big else "I"), raw, at + n * entry)[0]


class Layout(NamedTuple):
    """Where a page's pixels stand and how they are packed."""

    h: int
    w: int
    dtype: str
    packing: int
    predictor: int
    offsets: Sequence[int]
    counts: Sequence[int]


def layout(order: str, tags: dict[int, tuple]) -> Layout:
    bits, form = tags.get(BITS, (1,))[0], tags.get(SAMPLE_FORMAT, (1,))[0]
    if tags.get(SAMPLES, (1,))[0] != 1 or bits % 8:
        raise ValueError("only grey pages of whole bytes are supported")
    dtype = f"{order}{ {1: 'u', 2: 'i', 3: 'f'}[form] }{bits // 8}"
    return Layout(tags[HEIGHT][0], tags[WIDTH][0], dtype, tags.get(COMPRESSION, (NONE,))[0], tags.get(PREDICTOR, (1,))[0], tags[STRIP_OFFSETS], tags[STRIP_COUNTS])


def unlzw(data: bytes) -> bytes:
    """Bytes of an LZW strip: codes of 9 to 12 bits, highest first; a code grows one entry before it must."""
    table, width, out, held, bits, before = [], 9, [], 0, 0, None
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & (1 << bits) - 1
        if code == END:
            break
        if code == CLEAR:
            table, width, before = [bytes([k]) for k in range(256)] + [b"", b""], 9, None
            continue
        if code > len(table) or before is None and code >= len(table):
            raise ValueError("a broken LZW strip")
        entry = table[code] if code < len(table) else before + before[:1]
        if before is not None and len(table) < 4096:
            table.append(before + entry[:1])
        out.append(entry)
        before = entry
        width = min(12, max(9, (len(table) + 1).bit_length()))
    return b"".join(out)


def image_at(raw: bytes, p: Layout) -> np.ndarray:
    """A page's pixels, little-endian, read where they stand."""
    if p.packing not in (NONE, LZW, DEFLATE, OLD_DEFLATE):
        raise ValueError(f"compression {p.packing} is not supported")
    dtype = np.dtype(p.dtype)
    if p.predictor not in (1, 2) or p.predictor == 2 and dtype.kind == "f":
        raise ValueError(f"predictor {p.predictor} is not supported")
    unpack = {NONE: lambda s: s, LZW: unlzw}.get(p.packing, zlib.decompress)
    data = b"".join(unpack(raw[a : a + n]) for a, n in zip(p.offsets, p.counts))
    image = np.frombuffer(data, dtype)[: p.h * p.w].reshape(p.h, p.w)
    if p.predictor == 2:
        image = np.cumsum(image, axis=1, dtype=dtype.newbyteorder("="))
    return image.astype(dtype.newbyteorder("<"))


def _page(raw: bytes, order: str, tags: dict[int, tuple]) -> np.ndarray:
    return image_at(raw, layout(order, tags))


def decode(raw: bytes) -> np.ndarray:
    """All pages of one shape as (page, y, x), little-endian."""
    return np.stack([_page(raw, order, tags) for order, tags in directories(raw)])


def decode_page(raw: bytes, number: int) -> np.ndarray:
    for k, (order, tags) in enumerate(directories(raw)):
        if k == number:
            return _page(raw, order, tags)
    raise IndexError(f"no page {number}")


def description(raw: bytes) -> str:
    """The first page's description: OME-XML, or ImageJ's key=value lines."""
    return next(directories(raw))[1].get(DESCRIPTION, ("",))[0]


def spacing(raw: bytes) -> float | None:
    """The z step that ImageJ's description states, if it does."""
    m = re.search(r"(?m)^spacing=([\d.eE+-]+)\s*$", description(raw))
    return float(m[1]) if m else None


def encode(v: np.ndarray, text: str | None = None, deflate: bool = False, big: bool | None = None) -> bytes:
    """A little-endian TIFF of a (page, y, x) or (y, x) array, one strip a page; BigTIFF if it wouldn't fit otherwise."""
    v = np.ascontiguousarray(v[None] if v.ndim == 2 else v)
    v = v.astype(v.dtype.newbyteorder("<"))
    if v.ndim != 3 or v.dtype.kind not in "uif":
        raise ValueError("pages must be grey and of one shape")
    big = v.nbytes > 3 << 30 if big is None else big
    offset, header = ("<Q", struct.pack("<2sHHHQ", b"II", 43, 8, 0, 16)) if big else ("<I", struct.pack("<2sHI", b"II", 42, 8))
    out = bytearray(header)
    for k, image in enumerate(v):
        data = zlib.compress(image.tobytes()) if deflate else image.tobytes()
        note = (text or "").encode() + b"\0" if text and k == 0 else b""
        entries = [
            (WIDTH, 4, image.shape[1]), (HEIGHT, 4, image.shape[0]), (BITS, 3, image.itemsize * 8), (COMPRESSION, 3, DEFLATE if deflate else NONE), (PHOTOMETRIC, 3, 1),
            *([(DESCRIPTION, 2, note)] if note else []), (STRIP_OFFSETS, 16 if big else 4, None), (SAMPLES, 3, 1), (ROWS_PER_STRIP, 4, image.shape[0]),
            (STRIP_COUNTS, 16 if big else 4, len(data)), (SAMPLE_FORMAT, 3, {"u": 1, "i": 2, "f": 3}[image.dtype.kind]),
        ]
        entry, inline = (20, 8) if big else (12, 4)
        body = len(out) + (8 if big else 2) + entry * len(entries) + struct.calcsize(offset)
        at_note, at_data = body, body + len(note)
        out += struct.pack("<Q" if big else "<H", len(entries))
        for tag, kind, value in entries:
            many = len(value) if kind == 2 else 1
            value = at_data if value is None else value
            field = (value if many <= inline else struct.pack(offset, at_note)) if kind == 2 else struct.pack("<" + TYPE_CODES[kind], value)
            out += struct.pack("<HH", tag, kind) + struct.pack(offset, many) + field.ljust(inline, b"\0")
        end = at_data + len(data)
        end += end % 2
        out += struct.pack(offset, end if k + 1 < len(v) else 0) + note + data
        out += b"\0" * (end - len(out))
    return bytes(out)


def imagej_text(shape: tuple[int, ...], step: float | None = None) -> str:
    lines = ["ImageJ=1.11a", f"images={shape[0]}", f"slices={shape[0]}", *([f"spacing={step}", "unit=micron"] if step else [])]
    return "\n".join(lines) + "\n"


def series_files(spark: SparkSession, path: str, name: str = r"_C(\d+)_T(\d+)", pattern: str = "", unless: Sequence[str] = (), labels: Sequence[str] = ()) -> DataFrame:
    """(path, dataset, t, c, content) of each file under `path`, c and t from its name; on any file system Spark reads.

    With a pattern, only files that have it in their name, and none of `unless`. With labels, names have the label of a channel, as `write_series` writes them, and c is its place.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").load(path)
    file = F.element_at(F.split("path", "/"), -1)
    for x, held in [(pattern, True), *((x, False) for x in unless)]:
        files = files.where(file.contains(x) == held)
    if labels:
        name = f"_({'|'.join(map(re.escape, labels))})_T(\\d+)"
        c = F.array_position(F.array(*[F.lit(x) for x in labels]), F.regexp_extract("path", name, 1)).cast("int") - 1
    else:
        c = F.regexp_extract("path", name, 1).try_cast("int")
    files = files.select("path", F.regexp_extract("path", r"([^/]+?)" + name, 1).alias("dataset"), F.regexp_extract("path", name, 2).try_cast("int").alias("t"), c.alias("c"), "content")
    return files.where("t is not null and c is not null")


def volumes_of(files: DataFrame) -> DataFrame:
    """One volume row for each of `series_files`. Files are decoded whole, one task each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                v = decode(r.content)
                out.append([r.dataset, int(r.t), int(r.c), *v.shape, v.dtype.str, v.tobytes()])
            yield pd.DataFrame(out, columns=[c.split()[0] for c in VOLUMES.split(", ")])

    return files.select("dataset", "t", "c", "content").mapInPandas(run, VOLUMES)


def read_volumes(spark: SparkSession, path: str, **which) -> DataFrame:
    """One volume row for each of the `series_files` under `path`."""
    return volumes_of(series_files(spark, path, **which))


def write_ome(planes: DataFrame, folder: str) -> int:
    """Write `{dataset}_{t}.ome.tif`, its pages by z and c, for each timepoint of plane rows to a folder that all executors mount; how many. Planes that are missing are zero."""
    os.makedirs(folder, exist_ok=True)
    sizes = planes.groupBy("dataset").agg(F.max("z").alias("z1"), F.max("c").alias("c1"))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        first = rows.iloc[0]
        shape = (1, int(first["z1"]) + 1, int(first["c1"]) + 1, int(rows["h"].max()), int(rows["w"].max()))
        out = np.zeros(shape[1:], first["dtype"])
        for r in rows.itertuples():
            out[r.z, r.c, : r.h, : r.w] = pixels(r.data, r.dtype, r.h, r.w)
        name = f"{key[0]}_{key[1]}.ome.tif"
        put(os.path.join(folder, name), encode(out.reshape(-1, *shape[3:]), ome_text(shape, name, int(key[1]))))
        return pd.DataFrame({"n": [1]})

    return planes.join(sizes, "dataset").groupBy("dataset", "t").applyInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0


def mapped(path: str) -> mmap.mmap:
    """A file's bytes, read where they are used, whatever its size."""
    with open(path, "rb") as f:
        return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)


def put(path: str, data: bytes) -> None:
    """Write a file under a name of its own, then rename it: a retried task leaves the same file."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    with open(part, "wb") as f:
        f.write(data)
    os.replace(part, path)


def write_series(volumes: DataFrame, folder: str, step: float | None = None, labels: Sequence[str] = ()) -> int:
    """Write `{dataset}_C{c}_T{t:03d}.tif` for each volume to a folder that all executors mount; how many. With labels, one for each channel, a file has its channel's label in place of C{c}, as `{dataset}_{label}_T{t:04d}.tif`."""
    if len(set(labels)) < len(labels):
        raise ValueError(f"channels share a label: {list(labels)}")
    os.makedirs(folder, exist_ok=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                v = pixels(r.data, r.dtype, r.nz, r.ny, r.nx)
                mark = f"{labels[r.c]}_T{r.t:04d}" if labels else f"C{r.c}_T{r.t:03d}"
                put(os.path.join(folder, f"{r.dataset}_{mark}.tif"), encode(v, imagej_text(v.shape, step)))
            yield pd.DataFrame({"n": [len(pdf)]})

    return volumes.mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0


def ome_text(shape: tuple[int, int, int, int, int], name: str, first_t: int = 0) -> str:
    """OME-XML of a (t, z, c, y, x) array in one file, whose first timepoint is first_t; its UUID derives from the name, so writing is repeatable."""
    nt, nz, nc, ny, nx = shape
    key = uuid.uuid5(uuid.NAMESPACE_URL, name)
    frames = "".join(f'<TiffData FirstC="{c}" FirstT="{first_t + t}" FirstZ="{z}" IFD="{(t * nz + z) * nc + c}" PlaneCount="1"><UUID FileName="{name}">urn:uuid:{key}</UUID></TiffData>' for t in range(nt) for z in range(nz) for c in range(nc))
    return (
        f'<?xml version="1.0" encoding="UTF-8"?><OME xmlns="http://www.openmicroscopy.org/Schemas/OME/2016-06" UUID="urn:uuid:{key}"><Image ID="Image:0" Name="{name}">'
        f'<Pixels ID="Pixels:0" DimensionOrder="XYCZT" Type="uint16" SizeX="{nx}" SizeY="{ny}" SizeC="{nc}" SizeZ="{nz}" SizeT="{nt}">{frames}</Pixels></Image></OME>'
    )


def read_ome(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Plane rows of OME-TIFF files by the frame maps in their XML; files a map names but that aren't under `path` are left out.

    In a folder that is mounted, an index of the pages is built beside the files, or used if it is up to date; pages are read where they stand in files of any size,
    and filters on t, z and c leave pages out. Elsewhere Spark reads each file whole, of 2 GB at most.
    """
    from . import pages

    if os.path.isdir(path):
        return pages.read_planes(spark, path, recursive)
    return read_ome_whole(spark, path)


def read_ome_whole(spark: SparkSession, path: str) -> DataFrame:
    """The same from any path Spark reads, file by file."""
    from .omexml import frame_map

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ome.tif").load(path)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("file string, xml string")
        for r in rows_of(batches):
            yield pa.RecordBatch.from_pylist([{"file": os.path.basename(r["path"]), "xml": description(r["content"])}], schema)

    xml = files.select("path", "content").mapInArrow(texts, "file string, xml string")
    frames = frame_map(xml).groupBy("file").agg(F.collect_list(F.struct("t", "z", "c", "ifd")).alias("frames"))
    rows = files.withColumn("file", F.element_at(F.split("path", "/"), -1)).join(frames, "file").select("file", "content", "frames")

    def planes(r: dict) -> Iterator[dict]:
        """The planes of one file that the frame maps name, page by page."""
        wanted: dict[int, list] = {}
        for f in r["frames"]:
            wanted.setdefault(f["ifd"], []).append(f)
        for ifd, (order, tags) in enumerate(directories(r["content"])):
            if ifd in wanted:
                image = _page(r["content"], order, tags)
                for f in wanted[ifd]:
                    yield {"dataset": re.sub(r"(_\d+)?\.ome\.tif$", "", r["file"]), "t": f["t"], "z": f["z"], "c": f["c"], "h": image.shape[0], "w": image.shape[1], "dtype": image.dtype.str, "data": image.tobytes()}

    return rows.mapInArrow(lambda batches: packed((p for r in rows_of(batches) for p in planes(r)), PLANES), PLANES)
