"""Jobs end to end: crop a dataset, turn volumes level, and the handlers of the queue."""

from __future__ import annotations

import hashlib
import json
import os
import re
import shutil
import uuid
from collections.abc import Callable, Sequence
from functools import partial, reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import kernels as K
from .model import map_volumes, volumes
from .operators.names import DYES, active_outputs
from .operators.tickets import iterations_for
from .operators.voxels import SLOTS, Roi, needed_regions
from .session import scratch
from .sources import pages, tiff, zarr
from .streaming.queue import pending_consolidations


def crop_planes(planes: DataFrame, channels: int, top: Roi | None, bottom: Roi | None, layout: str, wanted: list[int] | None = None, rotate: bool = True) -> DataFrame:
    """Demultiplex and crop plane rows, turned if asked: a plane gives at most two, in one pass without a shuffle.

    Regions no wanted output reads may be None. Outputs are numbered by their place in `wanted`.
    """
    if channels % 2 or layout not in ("blocked", "interleaved"):
        raise ValueError("an even number of channels, blocked or interleaved, is needed")
    wanted = list(range(2 * channels)) if wanted is None else wanted
    regions, needs = {"top": top, "bottom": bottom}, needed_regions(wanted)
    if missing := [r for r, needed in needs.items() if needed and regions[r] is None]:
        raise ValueError(f"the {' and '.join(missing)} region is needed")
    if all(needs.values()) and top.shape != bottom.shape:
        raise ValueError("top and bottom regions differ in shape")
    n = channels // 2
    exc, cam = (F.pmod("c", F.lit(n)), F.floor(F.col("c") / n)) if layout == "blocked" else (F.floor(F.col("c") / 2), F.pmod("c", F.lit(2)))
    slots = F.array(*[F.struct(F.lit(s).alias("slot"), F.lit(k).alias("cam"), F.lit(r).alias("region")) for s, k, r in SLOTS])
    rows = planes.where(F.col("c") < channels).withColumns({"exc": exc.cast("int"), "cam": cam.cast("int")}).withColumn("s", F.explode(F.filter(slots, lambda s: s["cam"] == F.col("cam"))))
    rows = rows.withColumn("out", (4 * F.col("exc") + F.col("s.slot")).cast("int")).where(F.col("out").isin(wanted))
    # an output wanted twice is written twice
    places = F.filter(F.sequence(F.lit(0), F.lit(len(wanted) - 1)), lambda k: F.get(F.array(*[F.lit(w) for w in wanted]), k) == F.col("out"))
    rows = rows.withColumns({"c": F.explode(places), "region": F.col("s.region")})

    import pyarrow as pa

    def run(batches):
        for batch in batches:
            out = batch.to_pydict()
            for k, data in enumerate(out["data"]):
                r = regions[out["region"][k]]
                image = np.frombuffer(data, out["dtype"][k]).reshape(out["h"][k], out["w"][k])[r.y0 : r.y1, r.x0 : r.x1]
                image = np.ascontiguousarray(np.rot90(image) if rotate else image)
                out["h"][k], out["w"][k], out["data"][k] = *image.shape, image.tobytes()
            del out["region"]
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([f for f in batch.schema if f.name != "region"]))

    from .model import PLANES

    return rows.select(*[c.split()[0] for c in PLANES.split(", ")], "region").mapInArrow(run, PLANES)


def crop_job(spark: SparkSession, source: DataFrame, folder: str, output: str, labels: Sequence[str] = (), **how) -> int:
    """Crop a dataset into one array (ZARR) or a file for each (c, t) (TIFF_SERIES_SPLIT_C), named by the outputs' labels if given; chunks or files written."""
    if output not in ("ZARR", "TIFF_SERIES_SPLIT_C"):
        raise ValueError(f"no output format {output!r}")
    cropped = crop_planes(source, layout="blocked" if output == "ZARR" else "interleaved", **how)
    return zarr.write_planes(cropped, folder) if output == "ZARR" else tiff.write_series(volumes(cropped), folder, labels=labels)


def level_volumes(rows: DataFrame, z_step_um: float, xy_pixel_um: float, angle: float, psf: np.ndarray | None = None, dz_psf: float | None = None, iterations: int = 25, background: float = 100.0, z_end: int | None = None, reverse: bool = False, objective: bool = False, saturate: bool = True, z_stage: bool = False, rotate: bool = True, orders: tuple[str, str] = ("yxz", "yxz")) -> DataFrame:
    """Deconvolve (with a PSF), turn level, trim and saturate each volume in one pass over it.

    A PSF is resampled to the data's z step across the sheet and normalised to sum 1. A z-stage scan is turned by the complement of the angle in the other
    direction. Without `rotate` slices are sheared only. `orders` name the axes of a file's rows, columns and pages, on the way in and out.
    """
    if psf is not None and dz_psf is None:
        raise ValueError("the z step of the PSF is unknown")
    s = np.sin(np.radians(angle))
    c = np.cos(np.radians(angle))
    aniso = (1 if objective else c if z_stage else s) * z_step_um / xy_pixel_um
    turn, back = (90 - angle, not reverse) if z_stage else (angle, reverse)
    files = [{o[2]: 0, o[0]: 1, o[1]: 2} for o in orders]  # pages, rows, columns
    if any(sorted(f) != ["x", "y", "z"] for f in files):
        raise ValueError(f"axis orders {orders} do not name x, y and z")
    inward, outward = [files[0][a] for a in "zyx"], ["zyx".index(a) for a, _ in sorted(files[1].items(), key=lambda f: f[1])]
    ready = None if psf is None else K.resample_z(psf, dz_psf, z_step_um * s)

    def job(v: np.ndarray) -> np.ndarray:
        v = v.transpose(inward)
        if ready is not None:
            v = K.richardson_lucy(v, ready, iterations, background)
        out = K.deskew_rotate(v, turn, aniso, back, objective)[:z_end] if rotate else K.deskew(v, np.cos(np.radians(turn)) * z_step_um / xy_pixel_um, back)[:z_end]
        out = np.ascontiguousarray(out.transpose(outward))
        return np.clip(np.floor(out + 0.5), 0, 65535).astype("<u2") if saturate else out.astype("<f4")

    return map_volumes(rows, job)


#: Files of a series, by channel number or dye.
SERIES_FILE = rf"_(C\d+|{'|'.join(DYES)})_T\d+\.tif$"


def clear_series(folder: str, source: str) -> None:
    """Remove the files of a series that an earlier run left in an output folder; nothing in the source's own folder."""
    if os.path.isdir(folder) and os.path.realpath(folder) != os.path.realpath(source):
        for name in os.listdir(folder):
            if re.search(SERIES_FILE, name):
                os.remove(os.path.join(folder, name))


#: Where an output folder keeps what its files were made from.
MANIFEST = ".manifest"


def finish_series(spark: SparkSession, parts: list[tuple[DataFrame, str, Callable[[DataFrame], DataFrame]]], folder: str, source: str) -> int:
    """Bring a folder's series up to date with its inputs and return how many files were written; a repeated job writes none.

    Each part is (files, settings, job): `tiff.series_files`, a text that names all that the job depends on, and what makes its volumes. A file is made if it is
    not there, or if the folder's manifest does not say that it was made from these bytes with these settings. Inputs are read once for their digests, narrow rows that are written to the shared folder; only those
    pending are read again. Files of the series that no input stands for go. The manifest is replaced last, so what a failed job made is made again.
    """
    os.makedirs(folder, exist_ok=True)
    keys, place = ["dataset", "t", "c"], os.path.join(os.path.abspath(folder), MANIFEST)
    digest = lambda settings: F.sha2(F.concat(F.lit(settings.encode()), F.col("content")), 256).alias("digest")
    marks = reduce(DataFrame.unionByName, [files.select("path", *keys, digest(settings)) for files, settings, _ in parts])
    marks = marks.withColumn("name", F.format_string("%s_C%d_T%03d.tif", "dataset", "c", "t"))
    marks = _kept(spark, marks, "inputs")
    current = {r["name"] for r in marks.select("name").toLocalIterator()}  # as many as the folder lists
    own = os.path.realpath(folder) != os.path.realpath(source)
    there = []
    for name in os.listdir(folder):
        if name in current:
            there.append((name,))
        elif own and re.search(SERIES_FILE, name):
            os.remove(os.path.join(folder, name))
    todo = marks
    if os.path.isdir(place):
        done = spark.read.schema("name string, digest string").parquet(f"file://{place}").join(spark.createDataFrame(there, "name string"), "name")
        todo = marks.join(done, ["name", "digest"], "left_anti")
    todo = _kept(spark, todo.select("path"), "pending")
    made = [job(tiff.volumes_of(files.join(todo, "path", "left_semi"))) for files, _, job in parts]
    n = tiff.write_series(reduce(DataFrame.unionByName, made), folder)
    new = f"{place}-{uuid.uuid4().hex}"
    marks.select("name", "digest").write.parquet(f"file://{new}")
    if os.path.isdir(place):
        os.rename(place, f"{new}-old")
    os.rename(new, place)
    shutil.rmtree(f"{new}-old", ignore_errors=True)
    return n


def _kept(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    place = scratch(spark, label)
    rows.write.parquet(place)
    return spark.read.schema(rows.schema).parquet(place)


SIDECAR, CONSOLIDATION_LOG = ".consolidate.json", "consolidation.log"


def write_projections(rows: DataFrame, folder: str) -> int:
    """Write each volume's maximum over z as a one-page series next to it, into `folder`/MIPs."""
    return tiff.write_series(map_volumes(rows, lambda v: v.max(axis=0, keepdims=True)), os.path.join(folder, "MIPs"))


def missing_arrays(folder: str, expected: list[str]) -> list[str]:
    """The arrays a dataset is to have, by folder name, that are not there."""
    return sorted(name for name in set(expected) if not os.path.isdir(os.path.join(folder, name)))


def run_pending_consolidations(spark: SparkSession, data_dirs: list[str]) -> dict[str, int]:
    """Join the stores of datasets whose jobs have ended and that have a sidecar; chunks linked of each.

    A dataset of which arrays are still missing is joined as far as it goes. Each attempt adds a JSON line to the
    dataset's log: chunks linked, arrays expected, those missing, the error if there was one. The sidecar goes once chunks were
    linked, so a second call finds nothing to do. A sidecar that can't be read, or a failure, is 0.
    """
    done = {}
    for folder in data_dirs:
        path = os.path.join(folder, SIDECAR)
        if not os.path.exists(path):
            continue
        note = {"linked": 0}
        try:
            with open(path) as f:
                p = json.load(f)
            expected = p.get("expected_zarrs") or []
            note |= {"expected": len(set(expected)), "missing": missing_arrays(folder, expected)}
            note["linked"] = zarr.consolidate(spark, folder, p["base_name"], p["xy_pixel_um"], p["t_interval_s"], p.get("channel_names"))
        except (OSError, ValueError, KeyError, TypeError, AttributeError) as e:
            note["error"] = f"{type(e).__name__}: {e}"
        done[folder] = note["linked"]
        with open(os.path.join(folder, CONSOLIDATION_LOG), "a") as f:
            f.write(json.dumps(note) + "\n")
        if done[folder]:
            os.remove(path)
    return done


def consolidate_ended(spark: SparkSession, results: DataFrame, tickets: DataFrame) -> dict[str, int]:
    """`run_pending_consolidations` of the dataDirs of all tickets that have ended; they are fetched one by one, as the folders are local to the driver."""
    ended = pending_consolidations(results, tickets)
    return run_pending_consolidations(spark, [r["dataDir"] for r in ended.toLocalIterator()])


def level_settings(p: dict) -> dict:
    """Arguments of `level_volumes` from a ticket's parameters; what is not offered is refused, not ignored."""
    if (p.get("interp_method") or "linear") != "linear":
        raise ValueError(f"interpolation {p['interp_method']!r} is not offered, only linear")
    if p.get("objective_scan") and p.get("z_stage_scan"):
        raise ValueError("a scan moves the objective or the z stage")
    given = p.get("iterations") or p.get("decon_iter")
    return {
        "z_step_um": p["z_step_um"], "xy_pixel_um": p["xy_pixel_size"], "angle": p["sheet_angle_deg"], "iterations": iterations_for(p.get("rl_method") or "simple", given), "z_end": p.get("z_crop_end"),
        "reverse": bool(p.get("reverse")), "objective": bool(p.get("objective_scan")), "z_stage": bool(p.get("z_stage_scan")), "orders": (p.get("input_axis_order") or "yxz", p.get("output_axis_order") or "yxz"),
    }


def psfs_of(patterns: list[str], paths: list[str]) -> list[tuple[str, str]]:
    """(pattern, path) pairs; a single PSF is for all volumes of the patterns, or for all there are."""
    if len(paths) == 1:
        return [(x, paths[0]) for x in patterns or [""]]
    if len(set(patterns)) != len(paths):
        raise ValueError(f"{len(paths)} PSFs for {len(set(patterns))} channel patterns")
    return list(zip(patterns, paths))


def handlers(spark: SparkSession) -> dict:
    """Handlers of crop, deskew, decon and pipeline tickets over TIFF series. A crop clears its output folder of the series that an earlier run left; the others make what is missing or stale there."""

    def channels(folder: str, p: dict) -> list[tuple[DataFrame, np.ndarray | None, float | None, str]]:
        """The files of each channel pattern with its PSF, the PSF's z step and digest; of several patterns in a name the longest holds. Files that match no pattern are left out."""
        paths = p.get("psf_paths") or ([p["psf_path"]] if p.get("psf_path") else [])
        paths = [paths] if isinstance(paths, str) else paths
        if p.get("run_decon") is False:
            paths = []
        patterns = p.get("channel_patterns") or []
        patterns = [patterns] if isinstance(patterns, str) else list(dict.fromkeys(patterns))
        pairs = psfs_of(patterns, paths) if paths else [(x, None) for x in patterns or [""]]
        out = []
        for pattern, path in pairs:
            longer = [x for x in patterns if len(x) > len(pattern)]
            files = tiff.series_files(spark, folder, pattern=pattern, unless=longer)
            if path is None:
                out.append((files, None, None, ""))
                continue
            with open(path, "rb") as f:
                raw = f.read()
            out.append((files, tiff.decode(raw).astype(float), p.get("dz_psf") or tiff.spacing(raw), hashlib.sha256(raw).hexdigest()))
        return out

    def settings(kind: str, p: dict, psf: str) -> str:
        return json.dumps([kind, p, psf], sort_keys=True)

    def level(job: dict, folder: str) -> None:
        p = job["parameters"]
        how = level_settings(p)
        rotate = p.get("rotate") is not False
        if rotate and p.get("deskew") is False:
            raise ValueError("rotating what is not deskewed is not offered")
        made = [(files, settings("level", p, key), partial(level_volumes, psf=psf, dz_psf=dz, rotate=rotate, **how)) for files, psf, dz, key in channels(job["dataDir"], p)]
        finish_series(spark, made, folder, job["dataDir"])

    def deskew(job: dict) -> None:
        p = job["parameters"]
        if p.get("deskew") is False and not p.get("rotate"):  # deconvolution alone
            decon({**job, "parameters": {**p, "iterations": p.get("decon_iter"), "result_dir_name": "Decon"}})
            return
        level(job, os.path.join(job["dataDir"], (p.get("dsr_dir_name") or "DSR") if p.get("rotate") is not False else (p.get("ds_dir_name") or "DS")))

    def decon(job: dict) -> None:
        p = job["parameters"]
        parts = channels(job["dataDir"], p)
        if any(psf is None for _, psf, _, _ in parts):
            raise ValueError("a deconvolution needs a PSF")
        n, whole = iterations_for(p.get("rl_method") or "simple", p.get("iterations")), p.get("save_16bit") is not False

        def job_of(psf: np.ndarray):
            def run(v: np.ndarray) -> np.ndarray:
                out = K.richardson_lucy(v, psf, n)
                return np.clip(np.floor(out + 0.5), 0, 65535).astype("<u2") if whole else out.astype("<f4")

            return lambda rows: map_volumes(rows, run)

        made = [(files, settings("decon", p, key), job_of(psf)) for files, psf, _, key in parts]
        finish_series(spark, made, os.path.join(job["dataDir"], p.get("result_dir_name") or "Decon"), job["dataDir"])

    def crop(job: dict) -> None:
        p = job["parameters"]
        roi = lambda text: Roi(*[int(x) for part in text.split(",") for x in part.split(":")]) if text else None
        folder = os.path.dirname(job["dataDir"]) or "."
        source = tiff.read_ome(spark, folder)
        if p.get("timepoints"):
            source = source.where(F.col("t").isin([t - 1 for t in p["timepoints"]]))
        # the index knows the channels; no pixel is read for them
        named = pages.page_index(spark, folder) if os.path.isdir(folder) else source
        channels = (named.agg(F.max("c")).first()[0] or 0) + 1
        wanted = p.get("channels") or list(range(2 * channels))
        wanted = active_outputs(wanted, p.get("active_channels"))
        target = os.path.join(folder, job["baseName"])
        clear_series(target, folder)
        dyes = [DYES[w % 4] for w in wanted] if "Single Exposure" in (p.get("exposure_mode") or "") else []
        crop_job(spark, source, target, p.get("format") or "TIFF_SERIES_SPLIT_C", labels=dyes, channels=channels, top=roi(p["rois"].get("top")), bottom=roi(p["rois"].get("bottom")), wanted=wanted, rotate=bool(p.get("rotate", True)))

    return {"crop": crop, "decon": decon, "deskew": deskew, "pipeline": lambda job: level({**job, "dataDir": job["parameters"]["shm_path"]}, os.path.join(job["dataDir"], job["baseName"]))}
