"""OME-XML headers: each element is cut out first, then its attributes are read one by one, in any order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sizes and steps where an attribute is missing.
SIZES = {"SizeC": 1, "SizeZ": 1, "SizeT": 1}
STEPS = {"PhysicalSizeX": 0.1, "PhysicalSizeY": 0.1, "PhysicalSizeZ": 1.0}
# The references that XML has of its own, the ampersand's last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")]
#: A TiffData element with what it holds, or an empty one.
ELEMENT = r"(?s)<(?:\w+:)?TiffData\b[^>]*?(?:/>|>.*?</(?:\w+:)?TiffData>)"
#: Attributes of a frame, all but the file's name in the element's own tag.
PLACES = {"c": "FirstC", "z": "FirstZ", "t": "FirstT", "ifd": "IFD"}


def header(xml: DataFrame, column: str = "xml") -> DataFrame:
    """Sizes and voxel steps, with defaults for missing attributes."""

    def attribute(name: str, digits: str, kind: str, default) -> Column:
        return F.coalesce(F.regexp_extract(column, f'{name}="({digits})"', 1).try_cast(kind), F.lit(default)).alias(name)

    return xml.select("*", *[attribute(n, r"\d+", "int", d) for n, d in SIZES.items()], *[attribute(n, r"[\d.]+", "double", d) for n, d in STEPS.items()])


def _attribute(name: str) -> str:
    return rf"""\b{name}\s*=\s*["']([^"']*)["']"""


def frame_map(xml: DataFrame, column: str = "xml", keep: tuple[str, ...] = ()) -> DataFrame:
    """(c, z, t, file, ifd), 0-based, of every frame the XML lists; a place that an element doesn't state is 0, and elements without a file name are left out. With them come the columns in `keep`."""
    found = xml.select(*keep, F.explode(F.regexp_extract_all(column, F.lit(ELEMENT), F.lit(0))).alias("frame"))
    places = {k: F.coalesce(F.regexp_extract("frame", _attribute(n), 1).try_cast("long"), F.lit(0)) for k, n in PLACES.items()}
    name = F.regexp_extract("frame", _attribute("FileName"), 1)
    for mark, sign in ENTITIES:
        name = F.replace(name, F.lit(mark), F.lit(sign))
    found = found.withColumns({**places, "file": name}).where("file <> ''")
    return found.select(*keep, *[F.col(k).cast("int").alias(k) for k in "czt"], "file", "ifd").distinct()


def with_file_index(frames: DataFrame, disk: DataFrame) -> DataFrame:
    """Frames with the index, from 1, of their file among those on disk, (file, file_index); 0 where the file is missing."""
    return frames.join(disk, "file", "left").withColumn("file_index", F.coalesce("file_index", F.lit(0)))


def get_frame(frames: DataFrame, sizes: dict[str, int], t: int, z: int, c: int) -> DataFrame:
    """One frame's row; places outside the sizes, and frames without a file, raise."""
    if not (0 <= t < sizes["SizeT"] and 0 <= z < sizes["SizeZ"] and 0 <= c < sizes["SizeC"]):
        raise IndexError(f"no frame t={t}, z={z}, c={c} in {sizes}")
    found = frames.where((F.col("t") == t) & (F.col("z") == z) & (F.col("c") == c)).limit(1)
    if not found.count():
        raise LookupError(f"frame t={t}, z={z}, c={c} is in no file")
    return found
