"""Pages of TIFF files by an index of offsets.

Tasks walk each file's directories once; a Spark join of what they find with the frame maps of the files' XML gives, for every
(t, z, c), the place of its pixels. The index is kept beside the files as Parquet, in the pages' order. Plane rows are a scan of that index with a
function that reads the rows' pages where they stand: filters on t, z and c go through its lists to the index's scan, and nothing but
the pages they leave is opened. (A Python data source would not do: of two uses of one table with different filters Spark 4.1 gives one the other's rows.)
"""

from __future__ import annotations

import json
import os
import re
import shutil
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf, udtf

from ..model import BATCH, PLANES, arrow_schema
from . import tiff
from .omexml import frame_map

#: Name of the index's folder, pages that share statistics there, most pages and bytes of pixels that a task reads, and most tasks.
INDEX, GROUP, PAGES, TASK_BYTES, MOST_TASKS = "_pages", 1024, 4096, 64 << 20, 20_000
_WALKED = "folder string, file string, path string, ifd long, h int, w int, dtype string, packing int, predictor int, offsets array<long>, counts array<long>, xml string"
_PLACED = "t int, z int, c int, ifd long, h int, w int, dtype string, packing int, predictor int, offsets array<long>, counts array<long>, file string"


def local(path: str) -> str:
    """The name under which tasks open a path that Spark listed."""
    return re.sub(r"^file:/+", "/", path)


def listing(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """(path, length, modificationTime) of the OME files in a folder, by Spark's own listing; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ome.tif").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return files.select("path", "length", "modificationTime")


# Name of the first file of an acquisition, and the columns of Spark's reader of whole files.
FIRST_FILE = "*_MMStack_Pos0.ome.tif"
_FILES = "path string, modificationTime timestamp, length long, content binary"


def acquisitions(spark: SparkSession, folder: str, per_batch: int = 1000) -> DataFrame:
    """A stream of (path, length, modificationTime) of acquisitions' first files, however deep in the folder they lie: each batch holds those that came since the last, at most `per_batch`.

    Spark's file source keeps in the query's checkpoint which it has seen, so a query that starts again goes on where it stopped; contents are not read.
    """
    rows = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", FIRST_FILE).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per_batch)
    return rows.load(folder).select("path", "length", "modificationTime")


def walk(files: DataFrame) -> DataFrame:
    """One row for each page of each file in `files` (path): its directory's shape, type and strips, and the first page's description. A file is one task's, read once from front to back."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in map(local, pdf["path"]):
                raw, out = tiff.mapped(path), []
                for ifd, (order, tags) in enumerate(tiff.directories(raw)):
                    p = tiff.layout(order, tags)
                    text = tags.get(tiff.DESCRIPTION, ("",))[0] if ifd == 0 else None
                    out.append([os.path.dirname(path), os.path.basename(path), path, ifd, p.h, p.w, p.dtype, p.packing, p.predictor, list(p.offsets), list(p.counts), text])
                    if len(out) == 4096:
                        yield pd.DataFrame(out, columns=[c.split()[0] for c in _WALKED.split(", ")])
                        out = []
                yield pd.DataFrame(out, columns=[c.split()[0] for c in _WALKED.split(", ")])

    return files.select("path").mapInPandas(run, _WALKED)


def build(spark: SparkSession, folder: str, recursive: bool = False) -> str:
    """Make sure the folder has an index of its files as they are now, and return its path. It is built anew, beside the old one, when files came, went or changed."""
    files, place = listing(spark, folder, recursive), os.path.join(folder, INDEX)
    now = files.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("x")).first()
    state = {"files": now["n"], "mark": now["x"], "recursive": recursive}
    try:
        with open(os.path.join(place, ".state")) as f:
            held = json.load(f)
        if state == {k: v for k, v in held.items() if k not in ("pages", "bytes")} and "bytes" in held:
            return place
    except (OSError, ValueError):
        pass
    part = f"{place}-{uuid.uuid4().hex}"
    walked, made = os.path.join(part, "walked"), os.path.join(part, "made")
    os.makedirs(made)
    try:
        walk(files).write.parquet(f"file://{walked}")
        pages = spark.read.schema(_WALKED).parquet(f"file://{walked}")
        frames = frame_map(pages.where("ifd = 0"), keep=("folder",))
        placed = pages.drop("xml").join(frames, ["folder", "file", "ifd"])

        def write(rows: pd.DataFrame) -> pd.DataFrame:
            """A file's pages in the order in which they stand."""
            rows, path = rows.sort_values(["ifd", "t", "z", "c"]), rows["path"].iloc[0]
            rows = rows.assign(file=os.path.relpath(path, folder))
            table = pa.Table.from_pandas(rows[[c.split()[0] for c in _PLACED.split(", ")]], preserve_index=False)
            target = os.path.join(made, f"{re.sub(r'[^A-Za-z0-9.]', '_', os.path.relpath(path, folder))}-{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}.parquet")
            whole = f"{target}.{uuid.uuid4().hex}.part"
            pq.write_table(table.replace_schema_metadata({"path": os.path.relpath(path, folder)}), whole, row_group_size=GROUP, write_statistics=["t", "z", "c"])
            os.replace(whole, target)
            size = sum(h * w * n * int(dtype[2:]) for (h, w, dtype), n in rows.groupby(["h", "w", "dtype"]).size().items())
            return pd.DataFrame({"n": [len(rows)], "size": [size]})

        state["pages"], state["bytes"] = (x or 0 for x in placed.groupBy("path").applyInPandas(write, "n long, size long").agg(F.sum("n"), F.sum("size")).first())
        with open(os.path.join(made, ".state"), "w") as f:
            json.dump(state, f)
        if os.path.isdir(place):
            os.rename(place, os.path.join(part, "old"))
        os.rename(made, place)
    finally:
        shutil.rmtree(part, ignore_errors=True)
    return place


def page_index(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """(t, z, c, ifd, h, w, dtype, packing, predictor, offsets, counts, file) of every page the frame maps name; file is relative to the folder."""
    place = build(spark, folder, recursive)
    return spark.read.schema(_PLACED).option("pathGlobFilter", "*.parquet").parquet(f"file://{os.path.abspath(place)}")


def _page_at(places: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """The pixels of pages, each a list of one. A task keeps the file it read last mapped, and hands on about BATCH bytes at a time."""

    def images() -> Iterator[list[tuple]]:
        path, raw = None, None
        for columns in places:
            for at, *where in zip(*(c.to_pylist() for c in columns)):
                if at != path:
                    path, raw = at, tiff.mapped(at)
                image = tiff.image_at(raw, tiff.Layout(*where))
                yield [(image.dtype.str, image.tobytes())]

    return listed(images(), "dtype string, data binary")


@udtf(returnType="z int, h int, w int, kind string, packing int, predictor int, offsets array<long>, counts array<long>", useArrow=True)
class PagesOf:
    """The layout of each page of a file."""

    def eval(self, path: str):
        for z, (order, tags) in enumerate(tiff.directories(tiff.mapped(path))):
            p = tiff.layout(order, tags)
            yield z, p.h, p.w, p.dtype, p.packing, p.predictor, list(p.offsets), list(p.counts)


def listed(rows: Iterator[list[tuple]], columns: str) -> Iterator[pa.Array]:
    """Arrow lists of structs, the last of whose fields holds bytes, in arrays of about BATCH bytes."""
    schema, found, ends = arrow_schema(columns), [], [0]
    size = 0
    for row in rows:
        found += row
        ends.append(len(found))
        size += sum(len(r[-1]) for r in row) + 512
        if size >= BATCH:
            yield _lists(found, ends, schema)
            found, ends, size = [], [0], 0
    if len(ends) > 1:
        yield _lists(found, ends, schema)


def _lists(found: list[tuple], ends: list[int], schema: pa.Schema) -> pa.Array:
    columns = list(zip(*found)) or [[] for _ in schema]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], fields=list(schema)))


def tasks_for(pages: int, size: int = 0) -> int:
    """Tasks for pages that hold `size` bytes in all. A task reads one page at a time, so more of them take it longer, not more memory."""
    return max(1, min(max(-(-pages // PAGES), -(-size // TASK_BYTES)), MOST_TASKS))


def _read(rows: DataFrame) -> DataFrame:
    """Plane rows of rows (path, dataset, t, z, c, h, w, kind, packing, predictor, offsets, counts)."""
    names = ("path", "h", "w", "kind", "packing", "predictor", "offsets", "counts")
    page_at = arrow_udf(_page_at, "array<struct<dtype:string,data:binary>>")
    return rows.select("dataset", "t", "z", "c", "h", "w", F.inline(page_at(*[F.col(n) for n in names]))).select(*[c.split()[0] for c in PLANES.split(", ")])


def read_planes(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Plane rows of the OME files in a folder that all executors mount; its index is built or used."""
    found = page_index(spark, folder, recursive)
    with open(os.path.join(folder, INDEX, ".state")) as f:
        state = json.load(f)
    n = tasks_for(state["pages"], state["bytes"])
    together = max(1, state["pages"] // n // 8)  # pages of a file that stay in one task
    dealt = found.repartition(n, "file", F.floor(F.col("ifd") / together))
    dataset = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"(?i)(_\d+)?\.ome\.tif$", "")
    return _read(dealt.select(F.concat(F.lit(f"{os.path.abspath(folder)}/"), "file").alias("path"), dataset.alias("dataset"), "t", "z", "c", "h", "w", F.col("dtype").alias("kind"), "packing", "predictor", "offsets", "counts"))


def read_series(spark: SparkSession, folder: str) -> DataFrame:
    """Plane rows of the files of a series in a folder that all executors mount: c and t by name, z by page. Filters on t and c leave files out, on z pages."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[tT][iI][fF]").load(folder).select("path")
    name = F.element_at(F.split("path", "/"), -1)
    part = lambda k: F.regexp_extract("name", r"(?i)^(.*)_C(\d+)_T(\d+)\.tif$", k)
    files = files.withColumn("name", name).where(part(2) != "").select("path", part(1).alias("dataset"), part(3).cast("int").alias("t"), part(2).cast("int").alias("c"))
    files = files.withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
    return _read(files.lateralJoin(PagesOf.asDeterministic()(F.col("path").outer())))
