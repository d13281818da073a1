"""Scalar functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROI_TEXT = r"^(\d+):(\d+),\s*(\d+):(\d+)$"


def sanitize_filename(name: Column) -> Column:
    return F.replace(F.replace(name, F.lit(".ome.tif"), F.lit("")), F.lit(" "), F.lit("_"))


def strip_suffix(name: Column, ignore_case: bool = False) -> Column:
    """Without a final .ome.tif, .tif or .tiff."""
    return F.regexp_replace(name, ("(?i)" if ignore_case else "") + r"(\.ome)?\.tiff?$", "")


def safe_ticket_name(name: Column) -> Column:
    """Letters, digits, _, - and . of any script stay; the rest become _."""
    return F.regexp_replace(name, r"(?U)[^\w\-_\.]", "_")


def series_name(base: Column, c: Column, t: Column) -> Column:
    return F.concat(base, F.format_string("_C%d_T%03d.tif", c, t))


def parse_roi(text: Column) -> Column:
    """struct(y0, y1, x0, x1) of `y0:y1,x0:x1`; null if it is anything else."""
    part = lambda k: F.regexp_extract(text, ROI_TEXT, k).cast("int")
    return F.when(text.rlike(ROI_TEXT), F.struct(part(1).alias("y0"), part(2).alias("y1"), part(3).alias("x0"), part(4).alias("x1")))


def roi_text(roi: Column) -> Column:
    return F.concat(F.concat_ws(":", roi["y0"].cast("string"), roi["y1"].cast("string")), F.lit(","), F.concat_ws(":", roi["x0"].cast("string"), roi["x1"].cast("string")))


def parse_channels(text: Column) -> Column:
    """Non-negative integers of a list with spaces and commas; anything else is left out."""
    return F.filter(F.transform(F.split(F.trim(text), "[ ,]+"), lambda c: c.try_cast("int")), lambda c: c.isNotNull() & (c >= 0))


def parse_patterns(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ","), lambda p: F.trim(p)), lambda p: p != "")


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, r"<[^>]+>", "")


def seconds(text: Column) -> Column:
    """The number of `1.5 s`; 0 if it is none."""
    return F.coalesce(F.trim(F.replace(text, F.lit(" s"), F.lit(""))).try_cast("double"), F.lit(0.0))


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp, with or without a zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def parameter(json: Column, path: str, default: Column) -> Column:
    """A value of JSON text; missing, null, '' and [] give the default."""
    found = F.get_json_object(json, path)
    return F.when(found.isNull() | found.isin("", "[]", "{}"), default.cast("string")).otherwise(found)


def default_iterations(method: Column) -> Column:
    return F.when(method == "omw", 2).otherwise(25)


def z_anisotropy(dz: Column, px: Column, angle: Column, objective: Column, z_stage: Column) -> Column:
    return F.when(objective, dz / px).when(z_stage, F.cos(F.radians(angle)) * dz / px).otherwise(F.sin(F.radians(angle)) * dz / px)


def rotated_size(ny: Column, nx: Column, nz: Column, angle: Column, aniso: Column, objective: Column) -> Column:
    """struct(ny, nx, nz) of a stack turned by the sheet angle: the exact box for objective scans, else without its four end frames."""
    s, c = F.sin(F.abs(F.radians(angle))), F.cos(F.radians(angle))
    across = F.when(objective, nx * c + nz * aniso * s).otherwise((nx - 1) * c + (nz - 1) * aniso / s)
    height = F.when(objective, nz * aniso * c + nx * s).otherwise((nx - 1) * s - 4)
    return F.struct(ny.cast("int").alias("ny"), F.round(across).cast("int").alias("nx"), F.round(height).cast("int").alias("nz"))


def acute_angle(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Degrees between two directions, at most 90; null if one has no length."""
    size = F.hypot(ax, ay) * F.hypot(bx, by)
    turn = F.degrees(F.acos(F.least(F.greatest((ax * bx + ay * by) / size, F.lit(-1.0)), F.lit(1.0))))
    return F.when(size > 0, F.when(turn > 90, 180 - turn).otherwise(turn))


def unit_range(v: Column, low: Column, high: Column) -> Column:
    return F.when(high > low, F.least(F.greatest((v - low) / (high - low), F.lit(0.0)), F.lit(1.0))).otherwise(0.0)


def blend(a: Column, b: Column, alpha: float) -> Column:
    return (1 - alpha) * a + alpha * b


def resample_factors(factors: Column) -> Column:
    """One factor for all axes, two for rows-and-columns and slices, or three."""
    f = lambda k: F.try_element_at(factors, F.lit(k))
    return F.when(F.size(factors) == 1, F.array(f(1), f(1), f(1))).when(F.size(factors) == 2, F.array(f(1), f(1), f(2))).otherwise(F.slice(factors, 1, 3))


def job_of_index(k: Column, channels: int) -> Column:
    """struct(c, t), counted from 1, of the k-th (from 1) of channels x timepoints, channels running fastest."""
    return F.struct((F.pmod(k - 1, F.lit(channels)) + 1).alias("c"), (F.floor((k - 1) / channels) + 1).alias("t"))


def derived_paths(folder: Column, name: Column, output: str) -> dict[str, Column]:
    """A dataset's metadata file, output folder and log; output is ZARR or TIFF_SERIES_SPLIT_C."""
    # Names of the output folders.
    folders = {"ZARR": "processed_ngff", "TIFF_SERIES_SPLIT_C": "processed_tiff_series_split"}
    if output not in folders:
        raise ValueError(f"no output format {output!r}")
    clean, base, target = sanitize_filename(name), F.replace(name, F.lit(".ome.tif"), F.lit("")), F.concat(folder, F.lit("/" + folders[output]))
    return {
        "sanitized_name": clean,
        "metadata_file": F.concat(folder, F.lit("/"), base, F.lit("_metadata.txt")),
        "output_dir": target,
        "output_log": F.concat(target, F.lit("/"), clean, F.lit("_processing_log.json")),
    }


def is_bead_file(name: Column, named: bool = True) -> Column:
    """Bead volumes, not masks or averages; `named` asks for Bead in the name."""
    out = ~name.contains("Master") & ~name.contains("Avg") & ~name.contains("_mask")
    return name.contains("Bead") & out if named else out


def first_setting(settings: Column, keys: list[str], default: Column) -> Column:
    """The first of the keys that a map holds with a value, else the default; 0 is a value."""
    return F.coalesce(*[F.try_element_at(settings, F.lit(k)) for k in keys], default)


def rounded(value: Column, digits: int) -> Column:
    """A double rounded as the SQL twins do: its product with 10^digits, itself a double, goes to the nearest whole number, halves away from 0.

    Spark's own round goes by the shortest decimal text instead, which falls on other halves. What the product overflows stays as it is.
    The value is written four times, so give a long expression a name in a select before.
    """
    scale = F.lit(10.0**digits)
    scaled = value * scale
    return F.when(F.abs(scaled) < F.lit(float("inf")), F.round(F.abs(scaled)) * F.signum(scaled) / scale).otherwise(value)
