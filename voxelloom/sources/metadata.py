"""Acquisition metadata, frame times, settings sidecars and the processing log."""

from __future__ import annotations

import datetime
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import first_setting
from ..operators.voxels import Roi

# The log's version, and the names of the z step in acquisition settings.
VERSION = "3.1-selective-channel"
STEP_KEYS = ["stepSizeUm", "zStep_um"]


def acquisition_settings(spark: SparkSession, path: str) -> DataFrame:
    """(path, settings map<string, double>) of AcqSettings.txt files, Latin-1 JSON; corrupt files have an empty map."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "AcqSettings.txt").load(path)
    text = F.decode("content", "ISO-8859-1")
    parsed = F.from_json(text, "map<string, string>")
    numbers = F.map_filter(F.transform_values(parsed, lambda _, v: v.try_cast("double")), lambda _, v: v.isNotNull())
    return files.select("path", F.coalesce(numbers, F.create_map().cast("map<string, double>")).alias("settings"))


def z_step(settings: DataFrame, default: float = 1.0) -> DataFrame:
    return settings.withColumn("z_step", first_setting(F.col("settings"), STEP_KEYS, F.lit(default)))


def frame_times(spark: SparkSession, path: str) -> DataFrame:
    """(t, z, c, elapsed_ms) of a metadata file's FrameKey-t-z-c entries; a corrupt file has none."""
    files = spark.read.format("binaryFile").load(path).select(F.decode("content", "ISO-8859-1").alias("text"))
    rows = files.select(F.explode(F.from_json("text", "map<string, struct<`ElapsedTime-ms`: double>>")).alias("key", "frame"))
    part = lambda k: F.regexp_extract("key", r"^FrameKey-(\d+)-(\d+)-(\d+)$", k).try_cast("int")
    return rows.select(part(1).alias("t"), part(2).alias("z"), part(3).alias("c"), F.col("frame")["ElapsedTime-ms"].alias("elapsed_ms")).where("t is not null and elapsed_ms is not null")


def timestamps(spark: SparkSession, path: str, count: int, interval_s: float = 6.0) -> list[float]:
    """Elapsed seconds of the first slice of each timepoint, computed where the file has none or cannot be read."""
    grid = spark.range(count).select(F.col("id").cast("int").alias("t"))
    if os.path.exists(path):
        frames = frame_times(spark, path).where("z = 0 and c = 0").select("t", "elapsed_ms")
        grid = grid.join(frames, "t", "left")
    else:
        grid = grid.withColumn("elapsed_ms", F.lit(None).cast("double"))
    return [r["s"] for r in grid.select("t", F.coalesce(F.col("elapsed_ms") / 1000, F.col("t") * F.lit(interval_s)).alias("s")).orderBy("t").collect()]


def processing_log(source: str, metadata_file: str, output: str, channels: list[int] | None, top: Roi | None, bottom: Roi | None, rotate: bool, times: list[float]) -> dict:
    """The log of one crop; regions are written as the two axes' "start:stop"."""
    channels = [0, 1, 2, 3] if channels is None else channels
    written = lambda r: [f"{r.y0}:{r.y1}", f"{r.x0}:{r.x1}"] if r else None
    return {
        "processing_version": VERSION,
        "processing_date": datetime.datetime.now().isoformat(),
        "channels_exported": channels,
        "rotate_90_degrees": rotate,
        "source_base_file": source,
        "source_metadata_file": metadata_file,
        "rois": {"top_roi": written(top), "bottom_roi": written(bottom)},
        "notes": f"Cropped {len(channels)} channels: {channels}. Output format: {output}",
        "timestamps_sec": times,
    }


def merge_settings(path: str, changes: dict) -> dict:
    """Set a sidecar's keys, or remove those given as None; a missing or corrupt file starts empty."""
    from .tiff import put

    try:
        with open(path) as f:
            held = json.load(f)
    except (OSError, ValueError):
        held = {}
    held = {k: v for k, v in {**held, **changes}.items() if v is not None}
    put(path, json.dumps(held, indent=4).encode())
    return held


def copy_sidecars(source: str, target: str, kinds: tuple[str, ...] = (".txt", ".json", ".xml")) -> list[str]:
    """Copy a dataset's small text files next to its output; those already there stay. The names copied."""
    from .tiff import put

    os.makedirs(target, exist_ok=True)
    copied = []
    for name in sorted(os.listdir(source)):
        if name.endswith(kinds) and not name.startswith(".") and not os.path.exists(os.path.join(target, name)):
            with open(os.path.join(source, name), "rb") as f:
                put(os.path.join(target, name), f.read())
            copied.append(name)
    return copied
