"""File-series, ticket and path relations: parsing, indexing, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import epoch_micros
from ..session import scratch
from .ranks import dense_ranks

# Patterns of the file-name conventions.
OPM_NAME = r"(?i)^(.*?)_C(\d+)_T(\d+)\.tif$"
LLSM_NAME = r"(?i)^(.*?)_Cam([AB])_ch(\d+)_stack(\d+)"
OME_PART = r"_\d+\.ome\.tif$"
DYES = ["Calcein_Violet", "GFP", "mScarlet", "CF647"]


def parse_series(files: DataFrame) -> DataFrame:
    """Files of a TIFF series with base, c, t as named; others go. A name is matched once; its parts are told apart by NUL, which no file's name holds."""
    parts = F.split(F.regexp_replace("name", OPM_NAME, "$1\0$2\0$3"), "\0")
    part = lambda k: F.get(parts, F.lit(k))
    return files.where(F.size(parts) == 3).withColumns({"base": part(0), "c": part(1).cast("int"), "t": part(2).cast("int")})


def parse_llsm(files: DataFrame) -> DataFrame:
    """Files of a lattice series with base, camera, c, t; files of both cameras with one (c, t) collide: the last name wins."""
    part = lambda k: F.regexp_extract("name", LLSM_NAME, k)
    rows = files.where(F.col("name").rlike(LLSM_NAME)).withColumns({"base": part(1), "camera": F.upper(part(2)), "c": part(3).cast("int"), "t": part(4).cast("int")})
    return rows.groupBy("c", "t").agg(F.max_by(F.struct("name", "base", "camera"), "name").alias("f")).select("c", "t", "f.*")


def normalised_index(files: DataFrame, directory: str = "dir") -> DataFrame:
    """t and c counted from their directory's smallest; the directory's minima are aggregated and joined, so no directory is one window."""
    low = files.groupBy(directory).agg(F.min("t").alias("t0"), F.min("c").alias("c0"))
    return files.join(low, directory).withColumns({"t": F.col("t") - F.col("t0"), "c": F.col("c") - F.col("c0")}).drop("t0", "c0")


def ranked_index(files: DataFrame, directory: str = "dir") -> DataFrame:
    """t and c replaced by their rank among the directory's distinct values.

    The distinct values of both come from one pass over the files and are ranked by blocks. The ranks are written to the shared folder, so that
    their size is known when the files meet them: small ones are broadcast, and the files stay where they are.
    """
    spark = files.sparkSession
    both = F.explode(F.array(*[F.struct(F.lit(k).alias("axis"), F.col(k).cast("long").alias("value")) for k in ("t", "c")])).alias("v")
    values = files.select(F.col(directory).alias("folder"), both).select("folder", "v.axis", "v.value").distinct()
    place = scratch(spark, "ranks")
    dense_ranks(values, ["folder", "axis"]).write.parquet(place)
    ranks, out = spark.read.schema("folder string, axis string, value long, rank int").parquet(place), files
    for k in ("t", "c"):
        own = ranks.where(F.col("axis") == k).select("folder", "value", "rank")
        out = out.join(own, out[directory].eqNullSafe(own["folder"]) & out[k].eqNullSafe(own["value"])).drop("folder", "value", k).withColumnRenamed("rank", k)
    return out


def first_base(files: DataFrame, directory: str = "dir") -> DataFrame:
    """Only the files whose base is that of the directory's first name."""
    base = files.groupBy(directory).agg(F.min_by("base", "name").alias("first_base"))
    return files.join(base, directory).where(F.col("base") == F.col("first_base")).drop("first_base")


def base_file(files: DataFrame, directory: str = "dir") -> DataFrame:
    """The directory's main OME file: the first that isn't a numbered part, else the first."""
    best = F.min(F.struct(F.col("name").rlike(OME_PART).alias("part"), "name"))
    return files.groupBy(directory).agg(best.alias("b")).select(directory, F.col("b.name").alias("name"))


def newest(files: DataFrame, directory: str = "dir") -> DataFrame:
    """The directory's newest entry; of equal times the first name."""
    best = F.min(F.struct((-epoch_micros(F.col("mtime"))).alias("age"), "name", "mtime"))
    return files.groupBy(directory).agg(best.alias("b")).select(directory, F.col("b.name").alias("name"), F.col("b.mtime").alias("mtime"))


def data_type(files: DataFrame, directory: str = "dir") -> DataFrame:
    """OPM, LLSM or UNKNOWN by the names a directory holds; OPM is asked first."""
    opm, llsm = (F.max(F.col("name").rlike(p)) for p in (OPM_NAME, LLSM_NAME))
    return files.groupBy(directory).agg(F.when(opm, "OPM").when(llsm, "LLSM").otherwise("UNKNOWN").alias("data_type"))


def channel_patterns(files: DataFrame, directory: str = "dir") -> DataFrame:
    """Distinct channel marks in a directory's names, sorted, as CSV."""
    mark = F.nullif(F.regexp_extract("name", r"(?i)(_C\d+|Cam[AB])", 1), F.lit(""))
    return files.withColumn("mark", mark).groupBy(directory).agg(F.array_join(F.array_sort(F.collect_set("mark")), ", ").alias("patterns"))


def linear_frame(t: Column, z: Column, c: Column, nz: int, nc: int, order: str = "XYCZT") -> Column:
    return t * (nz * nc) + (c * nz + z if order == "XYZCT" else z * nc + c)


def chunk_keys(chunks: DataFrame, directory: str = "dir") -> DataFrame:
    """Chunk names of one store for all (t, c): the ranks of t and c before the slab's own index."""
    ranked = ranked_index(chunks, directory)
    return ranked.withColumn("key", F.concat_ws(".", F.col("t").cast("string"), F.col("c").cast("string"), F.col("iz").cast("string"), F.col("iy").cast("string"), F.col("ix").cast("string")))


def z_offsets(files: DataFrame, directory: str = "dir") -> DataFrame:
    """Where each file's slices begin if a directory's files are concatenated in name order."""
    order = Window.partitionBy(directory).orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("z0", F.coalesce(F.sum("nz").over(order), F.lit(0)))


def frame_times(grid: DataFrame, frames: DataFrame, interval_s: float, keys: list[str]) -> DataFrame:
    """Elapsed seconds of each timepoint: the frame's own milliseconds, else t times the interval."""
    return grid.join(frames, keys, "left").withColumn("elapsed_s", F.coalesce(F.col("elapsed_ms") / 1000, F.col("t") * F.lit(interval_s))).drop("elapsed_ms")


def upsert_latest(log: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last written row of each key."""
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("r")).select(key, *[F.col("r")[c].alias(c) for c in rest])


def first_free(taken: DataFrame, key: str, number: str) -> DataFrame:
    """The smallest number from 1 that a key has not used: the first gap in its sorted numbers."""
    order = Window.partitionBy(key).orderBy(number)
    seen = taken.where(F.col(number) >= 1).select(key, number).distinct().withColumn("nth", F.row_number().over(order))
    return seen.groupBy(key).agg(F.coalesce(F.min(F.when(F.col(number) != F.col("nth"), F.col("nth"))), F.max("nth") + 1).alias("free"))


def active_outputs(wanted: list[int], dyes: list[str] | None) -> list[int]:
    """The wanted outputs whose dye, by the output's number modulo 4, is among `dyes`; all if none are named."""
    return [w for w in wanted if DYES[w % 4] in dyes] if dyes else wanted


def active_rows(rows: DataFrame, dyes: list[str]) -> DataFrame:
    """The same of rows with a channel c."""
    return rows.where(F.get(F.array(*[F.lit(d) for d in DYES]), F.pmod("c", F.lit(4))).isin(dyes))


def channel_count(count: Column, default: int = 4) -> Column:
    """The number of channels a header states; null and 0 are the default."""
    return F.coalesce(F.nullif(count, F.lit(0)), F.lit(default))


def listed_only(grid: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """The places of a dense grid that have a plane."""
    return grid.join(found.select(*keys).distinct(), keys, "left_semi")


def with_masks(beads: DataFrame, masks: DataFrame) -> DataFrame:
    """Beads (stem, ..) with the mask (stem, mask) of their own stem; `auto` where there is none."""
    return beads.join(masks, "stem", "left").withColumn("mask", F.coalesce("mask", F.lit("auto")))


def pairs_by_channel(first: DataFrame, second: DataFrame) -> DataFrame:
    """Level and deconvolved stacks, (channel, ..) each, of the channels that have both."""
    return first.join(second, "channel")


def with_psfs(channels: DataFrame, own: DataFrame, only: str | None = None) -> DataFrame:
    """Each channel with its own PSF, (channel, psf), else the only one there is."""
    return channels.join(own, "channel", "left").withColumn("psf", F.coalesce("psf", F.lit(only)))


def redirected(file: Column, folder: Column, legacy: Column) -> Column:
    """Where a source is found: the file itself, else its folder, else the place it had before; each null if it isn't there."""
    return F.coalesce(file, folder, legacy)


# What takes a source's place, in the order in which it is looked for.
REDIRECTS = ["file", "folder", "legacy"]


def resolved(paths: DataFrame, redirects: DataFrame) -> DataFrame:
    """(path, place, steps, cyclic) of each distinct path: where its redirects (place, kind, target) lead in the end, and over how many of them.

    Of a place's redirects the first of REDIRECTS holds, of equal kinds the smallest target; a path without one is its own place. A chain that comes back to where it was has no
    end: its place and steps are null and it is cyclic. Chains are followed by pointer jumping: each round joins the links with themselves, which doubles what each spans, so
    rounds grow with the logarithm of the longest chain. Links of more steps than there are places run in a cycle.
    """
    spark = paths.sparkSession
    rank = F.array_position(F.array(*[F.lit(k) for k in REDIRECTS]), F.col("kind"))
    links = redirects.where(F.col("place").isNotNull() & F.col("target").isNotNull() & (rank > 0)).groupBy("place").agg(F.min(F.struct(rank.alias("rank"), "target")).alias("best"))
    links = links.select("place", F.col("best.target").alias("at"), F.lit(1).cast("long").alias("steps"), F.lit(True).alias("on"))

    def written(rows: DataFrame) -> DataFrame:
        place = scratch(spark, "links")
        rows.write.parquet(place)
        return spark.read.schema(rows.schema).parquet(place)

    links, span = written(links), 1
    places = links.count()
    while span <= 2 * places:  # the round after the last jump finds that there is none
        ahead = links.select(F.col("place").alias("at"), F.col("at").alias("far"), F.col("steps").alias("more"))
        joined = links.join(ahead, "at", "left")
        links, span = written(joined.select("place", F.coalesce("far", "at").alias("at"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("far").isNotNull().alias("on"))), 2 * span
        if links.where("on").isEmpty():
            break
    found = paths.select("path").distinct().join(links.withColumnRenamed("place", "path"), "path", "left")
    cyclic = F.coalesce(F.col("on"), F.lit(False))
    return found.select("path", F.when(~cyclic, F.coalesce("at", "path")).alias("place"), F.when(~cyclic, F.coalesce("steps", F.lit(0))).alias("steps"), cyclic.alias("cyclic"))


def odd_canvas(rows: DataFrame, keys: list[str], sides: list[str]) -> DataFrame:
    """For each key the largest size of each side, made odd, so that a canvas has a middle."""
    return rows.groupBy(*keys).agg(*[(F.max(n).cast("int") + 1 - F.pmod(F.max(n).cast("int"), F.lit(2))).alias(n) for n in sides])
