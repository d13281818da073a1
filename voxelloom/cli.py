"""Command line: crop datasets, run the queue, submit jobs, consolidate stores."""

from __future__ import annotations

import argparse
import os
import re
import sys

from .operators.voxels import Roi
from .session import session

ROI = re.compile(r"^(\d+):(\d+),\s*(\d+):(\d+)$")


def roi(text: str) -> Roi:
    m = ROI.match(text)
    if not m:
        raise argparse.ArgumentTypeError(f"{text!r} is not y0:y1,x0:x1")
    return Roi(*map(int, m.groups()))


def channels(text: str) -> list[int]:
    try:
        out = [int(x) for x in re.split(r"[ ,]+", text.strip())]
    except ValueError as e:
        raise argparse.ArgumentTypeError(str(e)) from None
    if min(out) < 0:
        raise argparse.ArgumentTypeError("channels count from 0")
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="voxelloom")
    p.add_argument("--master", help="Spark master; local[*] if spark-submit gives none")
    commands = p.add_subparsers(dest="command", required=True)
    crop = commands.add_parser("crop", help="crop and demultiplex the OME-TIFF datasets of a folder")
    crop.add_argument("folder")
    crop.add_argument("--output", required=True)
    crop.add_argument("--top", type=roi)
    crop.add_argument("--bottom", type=roi)
    crop.add_argument("--channels", type=channels)
    crop.add_argument("--format", choices=["ZARR", "TIFF_SERIES_SPLIT_C"], default="TIFF_SERIES_SPLIT_C")
    crop.add_argument("--no-rotate", action="store_true")
    queue = commands.add_parser("queue", help="handle the tickets of a folder")
    queue.add_argument("folder")
    queue.add_argument("--forever", action="store_true")
    join = commands.add_parser("consolidate", help="join per-(t, c) arrays into one store")
    join.add_argument("folder")
    join.add_argument("base")
    join.add_argument("--xy", type=float, required=True)
    join.add_argument("--interval", type=float, default=1.0)
    join.add_argument("--labels", nargs="*")
    report = commands.add_parser("profile", help="average the times in profiler pages")
    report.add_argument("path")
    return p


def main(arguments: list[str] | None = None) -> int:
    from pyspark.sql import functions as F

    from . import pipeline
    from .sources import profile, tiff, zarr
    from .streaming import queue

    a = parser().parse_args(arguments)
    spark = session(a.master or (None if "spark.master" in os.environ else "local[*]"))
    if a.command == "crop":
        source = tiff.read_ome(spark, a.folder)
        count = (source.agg(F.max("c")).first()[0] or 0) + 1
        n = pipeline.crop_job(spark, source, a.output, a.format, channels=count, top=a.top, bottom=a.bottom, wanted=a.channels, rotate=not a.no_rotate)
        print(f"{n} written to {a.output}")
    elif a.command == "queue":
        q = queue.run_queue(spark, a.folder, pipeline.handlers(spark), os.path.join(a.folder, "results"), os.path.join(a.folder, "_checkpoint"), forever=a.forever)
        q.awaitTermination()
    elif a.command == "consolidate":
        n = zarr.consolidate(spark, a.folder, a.base, a.xy, a.interval, a.labels)
        print(f"{n} chunks linked")
        return 0 if n else 1
    else:
        profile.averages(profile.summarise(profile.read(spark, a.path))).show()
    return 0


if __name__ == "__main__":
    sys.exit(main())
