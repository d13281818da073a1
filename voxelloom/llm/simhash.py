"""SimHash near-duplicates by tiled exact comparison of fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, forest
from .shared import materialize, temporary

#: Seed of the shingle hash, words to a shingle, differing bits that still link.
SEED, WORDS, RADIUS = 42, 3, 2
#: A fingerprint's bits fall in so many segments, whose population counts name its tile.
SEGMENTS = 4
#: Fingerprints in one block of a tile, in expectation; larger tiles are cut by a hash.
BLOCK = 512


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; 0 without words.

    ASCII letters are lower-cased and words are runs of anything but ASCII white
    space, so bytes can be handled throughout.
    """
    import xxhash

    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    if len(parts) <= words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(parts), SEED)]
    else:
        joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
        ends = np.cumsum([len(w) + 1 for w in parts])
        starts = (ends[: len(parts) - words + 1] - [len(w) + 1 for w in parts[: len(parts) - words + 1]]).tolist()
        stops = (ends[words - 1 :] - 1).tolist()
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, stops)]
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        block = np.array(hashes[k : k + (1 << 16)], "<u8")
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, keep_mark: bool = False) -> DataFrame:
    """(id_col, fp): fp is the fingerprint as a signed long; with `mark`, the text's hash, if asked for. One narrow pass over whole texts."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps), *batch.columns[2:]], names=[id_col, "fp", *["mark"] * keep_mark])

    return docs.select(id_col, text_col, *[F.xxhash64(text_col).alias("mark")] * keep_mark).mapInArrow(run, f"{id_col} {id_type}, fp long" + ", mark long" * keep_mark)


def _segment_counts() -> list:
    width = 64 // SEGMENTS
    mask = (1 << width) - 1
    return [F.bit_count(F.shiftrightunsigned("fp", width * k).bitwiseAND(F.lit(mask).cast("long"))) for k in range(SEGMENTS)]


def _neighbour_steps(radius: int) -> list[int]:
    """Steps from a tile's number to those of tiles within the radius, one of each opposite pair, 0 first."""
    base = 64 // SEGMENTS + 1 + 2 * radius
    steps = [s for s in product(range(-radius, radius + 1), repeat=SEGMENTS) if sum(map(abs, s)) <= radius]
    numbers = [sum(x * base**k for k, x in enumerate(s)) for s in steps]
    return sorted(n for n in numbers if n >= 0)


def close_links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) links between fingerprint classes that joins all classes within `radius` bits, and no others.

    `classes` has one row (fp, rep) for each distinct fingerprint. Two fingerprints
    differ by at least the sum of the differences of their segments' population
    counts, so a tile holds the fingerprints of equal counts, and only tiles
    within the radius of each other are compared; comparison is exact. Tiles are
    cut by a hash into blocks of about BLOCK fingerprints, so no task holds an
    unbounded one. Of a pair of blocks' close pairs, a spanning forest leaves
    the task: nothing quadratic is shuffled.
    """
    base = 64 // SEGMENTS + 1 + 2 * radius
    tile = sum((c.cast("long") * base**k for k, c in enumerate(_segment_counts())), F.lit(0).cast("long"))
    tiled = classes.select("fp", "rep", tile.alias("tile"))
    # at most (64 / SEGMENTS + 1) ** SEGMENTS rows, 83,521, however large the input
    cuts = tiled.groupBy("tile").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("cuts"))
    cuts = materialize(cuts, "simhash-tiles")
    blocks = (
        tiled.join(F.broadcast(cuts), "tile")
        .groupBy("tile", F.pmod(F.xxhash64("fp"), "cuts").alias("block"))
        .agg(F.collect_list(F.struct("fp", "rep")).alias("members"))
        .select("tile", "block", F.col("members.fp").alias("fps"), F.col("members.rep").alias("reps"))
    )
    blocks = materialize(blocks, "simhash-blocks")
    # the key of a pair is its partner block, so a tile of many blocks is dealt to many tasks
    steps = F.explode(F.array(*[F.lit(s).cast("long") for s in _neighbour_steps(radius)]))
    left = blocks.select(F.col("tile").alias("own"), F.col("block").alias("own_block"), steps.alias("step")).withColumn("tile", F.col("own") + F.col("step")).join(F.broadcast(cuts), "tile")
    partners = F.sequence(F.when(F.col("step") == 0, F.col("own_block")).otherwise(0), F.col("cuts") - 1)
    left = left.select("own", "own_block", "tile", F.explode(partners).alias("block"))
    first = blocks.select(F.col("tile").alias("own"), F.col("block").alias("own_block"), F.col("fps").alias("fps1"), F.col("reps").alias("reps1"))
    pairs = left.join(blocks.hint("merge"), ["tile", "block"]).join(first.hint("merge"), ["own", "own_block"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found_a, found_b = [], []
            cols = [batch.column(k) for k in range(4)]
            parts = []
            for c in cols:
                values, offsets = c.values.to_numpy(zero_copy_only=False), c.offsets.to_numpy()
                parts.append((values, offsets))
            for r in range(batch.num_rows):
                f1, r1, f2, r2 = (v[o[r] : o[r + 1]] for v, o in parts)
                a, b = [], []
                f1, f2 = f1.view(np.uint64), f2.view(np.uint64)
                for k in range(0, len(f1), 128):
                    i, j = np.nonzero(np.bitwise_count(f1[k : k + 128, None] ^ f2[None, :]) <= radius)
                    x, y = r1[i + k], r2[j]
                    away = x != y
                    if away.any():
                        x, y = forest(x[away], y[away])
                        a.append(x)
                        b.append(y)
                if a:
                    x, y = forest(np.concatenate(a), np.concatenate(b))
                    found_a.append(x)
                    found_b.append(y)
            none = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found_a or none)), pa.array(np.concatenate(found_b or none))], names=["a", "b"])

    return pairs.select("fps1", "reps1", "fps", "reps").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, words: int = WORDS, keep_mark: bool = False) -> DataFrame:
    """(id_col, fingerprint, component_id) of every row, and the text's 64-bit hash as `mark` if asked for; component_id is the smallest id that links of up to `radius` bits reach.

    Null and empty texts, and texts of white space alone, have fingerprint zero
    and link like any other. Documents of one fingerprint form a class; only
    classes are compared. Repeated ids and rows give repeated results. A null id keeps its row
    and its fingerprint; it is nobody's smallest id. An empty table gives an empty
    result. Other columns don't matter. Ids must be numbers.
    """
    mark = ["mark"] * keep_mark
    with temporary():
        own = materialize(fingerprints(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "id", "text", words, keep_mark), "simhash-fingerprints")
        classes = materialize(own.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-classes")
        links = materialize(close_links(classes.where("rep is not null"), radius), "simhash-links")
        found = components(links, "a", "b")
        labels = classes.join(found, classes["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
        # A class can hold a third of all rows: its rows may be split among tasks, as nothing above the join needs them together.
        out = own.join(labels.hint("merge"), "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", *mark)
        return materialize(out, "simhash-result", keep=True)
