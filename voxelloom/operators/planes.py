"""Folds of plane and volume rows: each task folds its own rows, then partial results meet in a tree. Exact percentiles by passes over the digits of pixels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..model import PLANES, pixels
from ..session import scratch

_NAMES = [c.split()[0] for c in PLANES.split(", ")]
#: Partial results that meet in one group, and rounds of that: enough for FAN_IN ** LEVELS tasks, 262,144.
FAN_IN, LEVELS = 64, 3


def tree_fold(partials: DataFrame, keys: list[str], fold: Callable[[pd.DataFrame], pd.DataFrame], schema: str, fan_in: int = FAN_IN, levels: int = LEVELS) -> DataFrame:
    """One row for each key, from at most one row for each key and task; a column `part` holds the task's number.

    A group holds at most fan_in partial results, however many rows the key had, for up to fan_in ** levels tasks.
    """
    rows = partials
    for level in range(levels):
        last = level == levels - 1
        rows = rows.withColumn("part", F.lit(0).cast("long") if last else F.floor(F.col("part") / fan_in))

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            return fold(pdf) if len(pdf) > 1 else pdf

        rows = rows.groupBy(*keys, "part").applyInPandas(run, f"{schema}, part long")
    return rows.drop("part")


def project(planes: DataFrame, keys: list[str], combine: Callable = np.maximum) -> DataFrame:
    """One plane for each key: the fold of all its planes, of one shape; other coordinates become 0. A task keeps one plane for each key in memory."""
    at = [_NAMES.index(k) for k in keys]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for row in zip(*(batch.column(k).to_pylist() for k in range(len(_NAMES)))):
                key = (*(row[k] for k in at), *row[4:7])
                image = pixels(row[7], row[6], row[4], row[5])
                if key in held:
                    combine(held[key][1], image, out=held[key][1])
                else:
                    held[key] = [[x if k in at or k == 0 else 0 for k, x in enumerate(row[:4])] + list(row[4:7]), image.copy()]
        if schema is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pylist([dict(zip([*_NAMES, "part"], [*head, image.tobytes(), part])) for head, image in held.values()], schema.append(pa.field("part", pa.int64())))

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        out = None
        for r in rows.itertuples():
            image = pixels(r.data, r.dtype, r.h, r.w)
            out = image.copy() if out is None else combine(out, image)
        first = rows.iloc[:1].copy()
        first["data"] = [out.tobytes()]
        return first

    return tree_fold(planes.select(*_NAMES).mapInArrow(partial, f"{PLANES}, part long"), keys, fold, PLANES)


#: Bits of a pixel's order that one pass of a selection looks at, and histograms that a task holds at once.
DIGIT, HELD = 16, 64


def sortable(v: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of v: of whole numbers with the sign turned, of floats with all bits of negative ones turned. Both zeros are one, NaN is the largest."""
    u = np.dtype(f"u{v.dtype.itemsize}")
    top = u.type(1 << 8 * u.itemsize - 1)
    if v.dtype.kind == "u":
        return v.astype(u)
    if v.dtype.kind == "i":
        return v.astype(v.dtype.newbyteorder("=")).view(u) ^ top
    bits = np.where(np.isnan(v), np.nan, v + 0.0).astype(v.dtype.newbyteorder("=")).view(u)
    return np.where(bits & top, ~bits, bits | top)


def unsorted(keys: np.ndarray, dtype: str) -> np.ndarray:
    """The values whose `sortable` numbers are `keys`, as doubles."""
    kind = np.dtype(dtype).newbyteorder("=")
    u = np.dtype(f"u{kind.itemsize}")
    top, k = u.type(1 << 8 * u.itemsize - 1), keys.astype(u)
    if kind.kind == "u":
        return k.astype(float)
    if kind.kind == "i":
        return (k ^ top).view(kind).astype(float)
    return np.where(k & top, k ^ top, ~k).view(kind).astype(float)


def percentiles(planes: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """(keys.., shares.., low, high): exact, linearly interpolated percentiles, least and greatest of each group's pixels, whatever their type.

    A radix selection: each pass counts the next DIGIT bits of the pixels that share the bits found so far with a wanted rank, in the task that
    holds them; so a pass shuffles at most 2 ** DIGIT rows a wanted prefix and task, not pixels. Pixels of 16 bits take one pass, of 32 two, of 64 four. The state between passes, some
    numbers a group, is written to the shared folder. Groups must be of one type; NaN counts as the largest value.
    """
    spark = planes.sparkSession
    schema = ", ".join(f"{k} {planes.schema[k].dataType.simpleString()}" for k in keys)
    kinds = [r["dtype"] for r in planes.select("dtype").distinct().limit(2).collect()]
    if len(kinds) > 1:
        raise ValueError(f"pixels of types {kinds} have no common order")
    dtype = kinds[0] if kinds else "<u2"
    bits = 8 * np.dtype(dtype).itemsize
    digit = min(DIGIT, bits)

    def histogram(batches: Iterator[pa.RecordBatch], shift: int) -> Iterator[pa.RecordBatch]:
        """Counts of the digit at `shift`, of pixels whose higher bits are one of the row's prefixes."""
        held: dict[tuple, np.ndarray] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for (*group, prefix), counts in held.items():
                at = np.flatnonzero(counts)
                named = {k: pa.array([g] * len(at), types[k]) for k, g in zip(keys, group)}
                yield pa.RecordBatch.from_pydict({**named, "prefix": pa.array(np.full(len(at), prefix, np.uint64).view(np.int64)), "digit": pa.array(at.astype(np.int32)), "n": pa.array(counts[at])})
            held.clear()

        for batch in batches:
            types = {k: batch.schema.field(k).type for k in keys}
            for r in batch.to_pylist():
                v = sortable(np.frombuffer(r["data"], r["dtype"])).astype(np.uint64)
                high = v >> np.uint64(shift + digit) if shift + digit < 64 else np.zeros_like(v)
                low = (v >> np.uint64(shift) & np.uint64((1 << digit) - 1)).astype(np.int64)
                for prefix in np.array(r["prefixes"] if shift + digit < bits else [0], np.int64).view(np.uint64):
                    key = (*(r[k] for k in keys), int(prefix))
                    if key not in held and len(held) >= HELD:
                        yield from rows()
                    own = low if shift + digit >= bits else low[high == prefix]
                    held[key] = held.get(key, 0) + np.bincount(own, minlength=1 << digit)
        yield from rows()

    def counted(shift: int, source: DataFrame) -> DataFrame:
        found = source.mapInArrow(lambda b: histogram(b, shift), f"{schema}, prefix long, digit int, n long")
        return found.groupBy(*keys, "prefix", "digit").agg(F.sum("n").alias("n"))

    state, order = None, Window.partitionBy(*keys, "prefix").orderBy("digit")
    for shift in range(bits - digit, -1, -digit):
        source = planes.select(*keys, "dtype", "data")
        if state is not None:
            wanted = state.groupBy(*keys).agg(F.collect_set("prefix").alias("prefixes"))
            source = source.join(wanted, keys)
        counts = counted(shift, source).withColumn("upto", F.sum("n").over(order))
        if state is None:
            # of each share the ranks below and above its place, and the first and last rank
            sizes = counts.groupBy(*keys).agg(F.sum("n").alias("size"))
            places = F.array(*[F.struct(F.lit(k).alias("name"), (F.lit(float(s)) * (F.col("size") - 1)).alias("place")) for k, s in {**shares, "low": 0.0, "high": 1.0}.items()])
            ranks = sizes.select(*keys, F.explode(places).alias("p")).select(*keys, "p.name", (F.col("p.place") - F.floor("p.place")).alias("part"), F.explode(F.array(F.floor("p.place"), F.ceil("p.place"))).alias("rank"))
            state = ranks.withColumn("prefix", F.lit(0).cast("long")).distinct()
        hit = state.join(counts, [*keys, "prefix"]).where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        step = hit.select(*keys, "name", "part", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), F.shiftleft("prefix", digit).bitwiseOR(F.col("digit").cast("long")).alias("prefix"), "above" if "above" in hit.columns else F.col("rank").alias("above"))
        place = scratch(spark, "selection")
        step.write.parquet(place)
        state = spark.read.schema(step.schema).parquet(place)

    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(value=unsorted(pdf["prefix"].to_numpy(np.int64).view(np.uint64), dtype))[[*keys, "name", "part", "above", "value"]]

    found = state.mapInPandas(values, f"{schema}, name string, part double, above long, value double")
    both = found.groupBy(*keys, "name").agg(F.first("part").alias("part"), F.min_by("value", "above").alias("lower"), F.max_by("value", "above").alias("upper"))
    joined = F.col("lower") + F.when(F.col("part") > 0, (F.col("upper") - F.col("lower")) * F.col("part")).otherwise(0.0)
    return both.groupBy(*keys).pivot("name", [*shares, "low", "high"]).agg(F.first(joined))
