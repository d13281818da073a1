"""Kernel queries: volumes of the 8 x 8 planes through numpy kernels; tests hold them against plain numpy."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..model import VOLUMES, pixels, volumes, voxels_of_stacks
from ..operators.psf import average_beads
from ..sources.driver import planes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def stacks(spark: SparkSession, sf_dir: str, kernel: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    return volumes(planes(spark, sf_dir), kernel=kernel)


def sizes_and_sums(rows: DataFrame) -> DataFrame:
    """(dataset, t, c, nz, ny, nx, total, top) of volume rows."""

    def run(batches):
        for pdf in batches:
            v = [pixels(r.data, r.dtype, r.nz, r.ny, r.nx) for r in pdf.itertuples()]
            yield pd.DataFrame({**{k: pdf[k] for k in ("dataset", "t", "c", "nz", "ny", "nx")}, "total": [round(float(x.sum(dtype=float)), 3) for x in v], "top": [round(float(x.max()), 3) for x in v]})

    return rows.mapInPandas(run, "dataset string, t int, c int, nz int, ny int, nx int, total double, top double")


def toy_psf() -> np.ndarray:
    return np.exp(-0.5 * sum((a - 1) ** 2 for a in np.indices((3, 3, 3))) / 0.5)


@query
def rl_decon(spark, sf_dir):
    psf = toy_psf()
    return sizes_and_sums(stacks(spark, sf_dir, lambda v: K.richardson_lucy(v, psf, 5, background=100)))


@query
def deskew_rotate(spark, sf_dir):
    return sizes_and_sums(stacks(spark, sf_dir, lambda v: K.deskew_rotate(v, 60.0, 1.2)))


@query
def decon_then_deskew(spark, sf_dir):
    """The whole pipeline of a volume in one pass: deconvolve, turn level, trim, saturate; then voxels."""
    psf = toy_psf()

    def job(v: np.ndarray) -> np.ndarray:
        level = K.deskew_rotate(K.richardson_lucy(v, psf, 2, background=100), 60.0, 1.2)
        return np.clip(np.floor(level + 0.5), 0, 65535).astype("<u2")

    flat = voxels_of_stacks(planes(spark, sf_dir), job)
    return flat.groupBy("t", "c", "y", "x").agg(F.max("v").alias("v"))


@query
def isolate_bead(spark, sf_dir):
    return sizes_and_sums(stacks(spark, sf_dir, K.isolate_bead))


@query
def auto_mask(spark, sf_dir):
    return sizes_and_sums(stacks(spark, sf_dir, lambda v: K.auto_mask(v).astype("u1")))


@query
def psf_average(spark, sf_dir):
    return sizes_and_sums(average_beads(stacks(spark, sf_dir)))


@query
def align_shift(spark, sf_dir):
    """Each projection's lower half moved to match its upper half."""
    from ..operators.planes import project

    def run(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                roi, dy, dx = K.align_rois(pixels(r.data, r.dtype, r.h, r.w), (0, 4, 0, 8), (4, 8, 0, 8))
                rows.append((r.t, r.c, list(map(int, roi)), round(dy, 3), round(dx, 3)))
            yield pd.DataFrame(rows, columns=["t", "c", "roi", "dy", "dx"])

    return project(planes(spark, sf_dir), ["dataset", "t", "c"]).mapInPandas(run, "t int, c int, roi array<int>, dy double, dx double")


@query
def gaussian_fwhm(spark, sf_dir):
    """Fitted width of each plane's middle row."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"t": pdf["t"], "z": pdf["z"], "c": pdf["c"], "fwhm": [round(K.gaussian_fwhm(pixels(r.data, r.dtype, r.h, r.w)[r.h // 2]), 4) for r in pdf.itertuples()]})

    return planes(spark, sf_dir).mapInPandas(run, "t int, z int, c int, fwhm double")


@query
def bead_extract(spark, sf_dir):
    """A crop around each stack's brightest voxel near its middle, where it fits."""

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                v = pixels(r.data, r.dtype, r.nz, r.ny, r.nx)
                bead = K.extract_bead(v, (r.nz // 2, r.ny // 2, r.nx // 2), (2, 2, 2))
                if bead is not None:
                    out.append([r.dataset, r.t, r.c, *bead.shape, bead.dtype.str, bead.tobytes()])
            yield pd.DataFrame(out, columns=[c.split()[0] for c in VOLUMES.split(", ")])

    return sizes_and_sums(stacks(spark, sf_dir).mapInPandas(run, VOLUMES))
