"""The job queue as a stream: tickets are files, a checkpoint claims them, handlers run them.

Producers write one JSON ticket for each job. The consumer is a Structured Streaming query over the ticket
folder: a checkpoint takes the place of claiming by renaming, so each ticket is handled in one
batch, and a batch that is repeated after a failure overwrites its own results.
"""

from __future__ import annotations

import json
import os
import time
import traceback
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import groupby
from threading import Thread

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.tickets import ROUTES, TERMINAL, iterations_for
from ..sources.tiff import put

TICKET = "jobType string, dataDir string, baseName string, parameters string"
RESULT = "ticket string, route string, state string, error string, ts timestamp"


# ---- producers -----------------------------------------------------------------------------------


def submit(folder: str, prefix: str, job_type: str, data_dir: str, base: str, parameters: dict) -> str:
    """Write a ticket `{PREFIX}_{safe name}_{epoch ms}.json`; its path."""
    import regex

    os.makedirs(folder, exist_ok=True)
    safe = regex.sub(r"[^\w\-_\.]", "_", base)
    stamp = int(time.time() * 1000)
    while os.path.exists(path := os.path.join(folder, f"{prefix}_{safe}_{stamp}.json")):
        stamp += 1
    put(path, json.dumps({"jobType": job_type, "dataDir": data_dir, "baseName": base, "parameters": parameters}, indent=4).encode())
    return path


def _base(name: str) -> str:
    name = os.path.basename(name)
    for suffix in (".ome.tif", ".tif"):
        if name.lower().endswith(suffix):
            return name[: -len(suffix)]
    return name


def submit_crop(folder: str, source: str, top: str | None, bottom: str | None, channels: list[int], timepoints: list[int] | None = None, rotate: bool = True, output: str = "TIFF_SERIES_SPLIT_C", active_channels: list[str] | None = None, z_step_um: float | None = None, xy_pixel_size: float | None = None, exposure_mode: str | None = None, test: bool = False) -> str:
    """A crop job; timepoints count from 1 in tickets, none means all. A test job writes beside the real output, to a folder whose name ends in `_test`.

    A mode of single exposures, "Single Exposure (All Lasers)", names the files of a TIFF series by dye, any other by channel number.
    """
    extra = {k: v for k, v in (("z_step_um", z_step_um), ("xy_pixel_size", xy_pixel_size)) if v is not None}
    rois = {k: v for k, v in (("top", top), ("bottom", bottom)) if v}
    parameters = {"rois": rois, "channels": channels, "timepoints": timepoints, "rotate": rotate, "format": output, "active_channels": active_channels, **({"exposure_mode": exposure_mode} if exposure_mode else {}), **extra}
    return submit(folder, "CROP", "crop", source, _base(source) + "_test" * test, parameters)


#: File with the settings of a crop, in its output folder.
CROP_SETTINGS = "crop_settings.json"


def submit_crop_with_settings(folder: str, source: str, top: str | None, bottom: str | None, channels: list[int], rotate: bool = True, output: str = "TIFF_SERIES_SPLIT_C") -> tuple[str, str]:
    """A crop job, whose settings are written to its output folder at once; the ticket's path and that folder."""
    ticket = submit_crop(folder, source, top, bottom, channels, rotate=rotate, output=output)
    target = os.path.join(os.path.dirname(source), _base(source))
    os.makedirs(target, exist_ok=True)
    with open(ticket) as f:
        p = json.load(f)["parameters"]
    settings = {"source_file": os.path.basename(source), **{k: p[k] for k in ("rois", "channels", "rotate", "format")}}
    put(os.path.join(target, CROP_SETTINGS), json.dumps(settings, indent=4).encode())
    return ticket, target


def submit_deskew(folder: str, data_dir: str, z_step_um: float, angle: float, xy_pixel_size: float, channel_patterns: list[str] | None = None, interp: str = "linear", reverse: bool = True, objective_scan: bool = False, z_stage_scan: bool = False, psf_path: str | None = None, iterations: int | None = None, rl_method: str = "simple") -> str:
    parameters = {"deskew": True, "rotate": True, "interp_method": interp, "xy_pixel_size": xy_pixel_size, "z_step_um": z_step_um, "sheet_angle_deg": angle, "channel_patterns": channel_patterns, "objective_scan": objective_scan, "z_stage_scan": z_stage_scan, "reverse": reverse}
    if psf_path:
        parameters |= {"run_decon": True, "psf_path": psf_path, "decon_iter": iterations_for(rl_method, iterations), "rl_method": rl_method}
    return submit(folder, "DESKEW", "deskew", data_dir, f"{os.path.basename(data_dir)}*", parameters)


def submit_decon(folder: str, data_dir: str, psf_paths: list[str], iterations: int | None = None, rl_method: str = "simple", channel_patterns: list[str] | None = None) -> str:
    parameters = {"result_dir_name": "Decon", "iterations": iterations_for(rl_method, iterations), "rl_method": rl_method, "save_16bit": True, "psf_paths": psf_paths, "channel_patterns": channel_patterns}
    return submit(folder, "DECON", "decon", data_dir, f"{os.path.basename(data_dir)}*", parameters)


def submit_pipeline(folder: str, output: str, source: str, psf_paths: list[str], z_step_um: float, xy_pixel_size: float, angle: float, iterations: int | None = None, rl_method: str = "simple", z_crop_end: int | None = None, dz_psf: float | None = None) -> str:
    """Deconvolve, turn level, trim and save one volume; with a PSF its z step must be known, from the argument or the file's spacing."""
    if psf_paths and dz_psf is None:
        from ..sources.tiff import spacing

        with open(psf_paths[0], "rb") as f:
            dz_psf = spacing(f.read())
        if dz_psf is None:
            raise ValueError(f"the z step of {psf_paths[0]} is unknown")
    parameters = {"shm_path": source, "xy_pixel_size": xy_pixel_size, "z_step_um": z_step_um, "sheet_angle_deg": angle, "iterations": iterations_for(rl_method, iterations), "rl_method": rl_method, "psf_paths": psf_paths}
    parameters |= {k: v for k, v in (("dz_psf", dz_psf), ("z_crop_end", z_crop_end)) if v is not None}
    return submit(folder, "PIPELINE", "pipeline", os.path.dirname(output), os.path.basename(output), parameters)


# ---- consumer ------------------------------------------------------------------------------------


def ticket_stream(spark: SparkSession, folder: str, per_batch: int = 100) -> DataFrame:
    """Tickets as they appear: ticket, ts and the JSON's fields, parameters as text."""
    rows = spark.readStream.schema(TICKET).option("multiLine", "true").option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", per_batch).json(folder)
    return rows.select(F.col("_metadata.file_name").alias("ticket"), F.col("_metadata.file_modification_time").alias("ts"), *[c.split()[0] for c in TICKET.split(", ")])


def run_queue(spark: SparkSession, folder: str, handlers: dict[str, Callable[[dict], None]], results: str, checkpoint: str, per_batch: int = 100, forever: bool = False, together: int = 4):
    """Handle tickets by route (crop, pipeline, decon, deskew); returns the streaming query.

    A batch has at most `per_batch` tickets and takes them in name order, so crops come before decons, deskews and
    pipelines; `together` jobs of one kind run at a time. Handlers start Spark jobs of their own. Outcomes go to `results`/batch=n, a failed job's with
    its traceback; tickets stay where they are, and their state is what the results say.
    """

    def batch(rows: DataFrame, number: int) -> None:
        def one(r) -> tuple:
            route = r["jobType"] if r["jobType"] in ROUTES else "deskew"
            error = None
            try:
                handlers[route]({"ticket": r["ticket"], "dataDir": r["dataDir"], "baseName": r["baseName"], "parameters": json.loads(r["parameters"] or "{}")})
            except Exception:  # noqa: BLE001  a job's failure is its result
                error = traceback.format_exc()
            return r["ticket"], route, "failed" if error else "completed", error

        done, tickets = [], rows.orderBy("ticket").collect()  # per_batch at most
        with ThreadPoolExecutor(together) as pool:
            for _, alike in groupby(tickets, lambda r: r["ticket"].partition("_")[0]):
                done += pool.map(one, list(alike))
        out = spark.createDataFrame(done, "ticket string, route string, state string, error string").withColumn("ts", F.current_timestamp())
        out.coalesce(1).write.mode("overwrite").parquet(f"{results}/batch={number}")

    writer = ticket_stream(spark, folder, per_batch).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime="2 seconds") if forever else writer.trigger(availableNow=True)).start()


def wait_for_job(spark: SparkSession, results: str, ticket: str, timeout_s: float = 3600, pause_s: float = 2) -> str:
    """Wait until a ticket has ended; its state. TimeoutError if it has not by then."""
    until = time.monotonic() + timeout_s
    while True:
        try:
            state = wait_for(spark.read.schema(RESULT).parquet(results), ticket)
        except AnalysisException:  # nothing has ended yet
            state = None
        if state or time.monotonic() > until:
            break
        time.sleep(pause_s)
    if state is None:
        raise TimeoutError(f"{ticket} has not ended after {timeout_s} s")
    return state


def watch_job(spark: SparkSession, results: str, ticket: str, report: Callable[[str, float], None], timeout_s: float = 3600, pause_s: float = 2) -> Thread:
    """Wait for a job in the background; `report` is called once, with its state, or `timeout`, and the seconds it took."""

    def run() -> None:
        began = time.monotonic()
        try:
            state = wait_for_job(spark, results, ticket, timeout_s, pause_s)
        except TimeoutError:
            state = "timeout"
        report(state, time.monotonic() - began)

    thread = Thread(target=run, daemon=True)
    thread.start()
    return thread


def wait_for(results: DataFrame, ticket: str) -> str | None:
    """A ticket's terminal state, if it has one; completed counts before failed."""
    states = {r["state"] for r in results.where(F.col("ticket") == ticket).select("state").distinct().collect()}
    return next((s for s in TERMINAL if s in states), None)


def job_states(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """A stream of (ticket, state, ts) as (ticket, state, changes, ts) whenever a ticket's state moves on.

    States only move forward, queued, active, completed or failed; terminal ones stay. A ticket that says nothing more until the
    watermark has passed its last event by `delay` is forgotten.
    """
    rank = {"queued": 0, "active": 1, **dict.fromkeys(TERMINAL, 2)}

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now, changes, last = state.get if state.exists else ("", 0, 0)
        moved = None
        for pdf in batches:
            for r in pdf.sort_values("ts").itertuples():
                last = max(last, int(r.ts.timestamp() * 1000))
                if r.state in rank and rank[r.state] > rank.get(now, -1):
                    now, changes, moved = r.state, changes + 1, r.ts
        state.update((now, changes, last))
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + 1)
        if moved is not None:
            yield pd.DataFrame({"ticket": [key[0]], "state": [now], "changes": [changes], "ts": [moved]})

    return events.withWatermark("ts", delay).groupBy("ticket").applyInPandasWithState(run, "ticket string, state string, changes int, ts timestamp", "state string, changes int, last long", "append", GroupStateTimeout.EventTimeTimeout)


def idle_gaps(events: DataFrame, key: str, gap: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Stretches of activity of each key (a queue, a user), (key, started, ended, tickets), each closed by a pause of `gap`."""
    found = events.withWatermark("ts", delay).groupBy(key, F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("tickets"))
    return found.select(key, F.col("s.start").alias("started"), F.col("s.end").alias("ended"), "tickets")


def pending_consolidations(results: DataFrame, tickets: DataFrame) -> DataFrame:
    """Distinct dataDirs of tickets that have ended, whether well or not."""
    ended = results.where(F.col("state").isin(*TERMINAL)).select("ticket").distinct()
    return tickets.join(ended, "ticket", "left_semi").select("dataDir").where("dataDir is not null").distinct()
