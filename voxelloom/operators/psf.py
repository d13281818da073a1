"""Point-spread functions: analytic volumes, averaging of beads, preparation for deconvolution."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..model import VOLUMES, pixels
from .planes import tree_fold

# Widths (z, y, x) in micrometres at 525 nm, voxel size, and the tilt of the light sheet.
SIGMAS, WAVELENGTH, SHEAR_DEGREES = (0.11, 0.29, 0.21), 525.0, -30.0


def synthetic_psf(spark: SparkSession, wavelength: float, size: int = 63, step: float = 0.1) -> DataFrame:
    """(z, y, x, v): a Gaussian whose widths scale with the wavelength, sheared along y with z, 1 at its peak; column expressions only."""
    sz, sy, sx = (s * wavelength / WAVELENGTH for s in SIGMAS)
    rows = spark.range(size**3).select(F.expr(f"cast(id div {size * size} as int)").alias("z"), F.expr(f"cast(id div {size} % {size} as int)").alias("y"), F.expr(f"cast(id % {size} as int)").alias("x"))
    z, y, x = ((F.col(a) - size // 2) * F.lit(step) for a in "zyx")
    sheared = y - z * F.tan(F.radians(F.lit(SHEAR_DEGREES)))
    return rows.withColumn("v", F.exp(-0.5 * (F.pow(z / sz, 2) + F.pow(sheared / sy, 2) + F.pow(x / sx, 2))))


def average_beads(beads: DataFrame, masks: DataFrame | None = None, taper: float = 0.1, strict: bool = True, mode: str = "library") -> DataFrame:
    """One PSF volume for each (dataset, c) from bead volumes, t telling beads apart.

    Each bead is cleaned, centred by a peak-weighted centroid and shifted onto an odd canvas that
    holds the largest. Tasks sum their own beads and the sums meet in a tree, so no task holds a channel's beads. mode "notebook" takes the background's median, clips
    and normalises each bead, and weighs its centroid plainly. Beads without signal are not counted.
    """
    keys = ["dataset", "c"]
    sizes = beads.groupBy(*keys).agg(*[F.max(n).alias(f"m{n}") for n in ("nz", "ny", "nx")])
    canvas = sizes.select(*keys, *[(F.col(f"m{n}") + 1 - F.pmod(f"m{n}", F.lit(2))).alias(f"m{n}") for n in ("nz", "ny", "nx")])
    rows = beads.join(canvas, keys)
    if masks is not None:
        rows = rows.join(masks.select("dataset", "t", "c", F.col("data").alias("mask")), ["dataset", "t", "c"], "left")
    else:
        rows = rows.withColumn("mask", F.lit(None).cast("binary"))

    names = [c.split()[0] for c in VOLUMES.split(", ")]

    def align(batches):
        held: dict[tuple, list] = {}
        for pdf in batches:
            for r in pdf.itertuples():
                shape = (r.nz, r.ny, r.nx)
                mask = pixels(r.mask, "u1", *shape) > 0 if r.mask is not None else None
                v = K.aligned_bead(pixels(r.data, r.dtype, *shape), mask, (r.mnz, r.mny, r.mnx), taper, strict, mode)
                if v is not None:
                    total = held.setdefault((r.dataset, r.c), [np.zeros(v.shape), 0])
                    total[0] += v
                    total[1] += 1
        part = TaskContext.get().partitionId()
        out = [[d, n, c, *v.shape, "<f8", v.tobytes(), part] for (d, c), (v, n) in held.items()]
        yield pd.DataFrame(out, columns=[*names, "part"])

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows.iloc[:1].copy()
        first["t"] = [int(rows["t"].sum())]  # t counts the beads in a partial sum
        first["data"] = [sum(pixels(r.data, r.dtype, r.nz, r.ny, r.nx) for r in rows.itertuples()).tobytes()]
        return first

    def finish(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                v = K.finished_psf(pixels(r.data, r.dtype, r.nz, r.ny, r.nx) / r.t, taper)
                out.append([r.dataset, 0, r.c, *v.shape, "<f4", v.astype("<f4").tobytes()])
            yield pd.DataFrame(out, columns=names)

    sums = tree_fold(rows.mapInPandas(align, f"{VOLUMES}, part long"), keys, fold, VOLUMES)
    return sums.mapInPandas(finish, VOLUMES)
