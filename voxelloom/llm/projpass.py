"""Embedding near-duplicates by sorted projection passes.

Each pass hashes every vector to 64 signs of random projections, orders the vectors
by the concatenated signs, and compares each with a bounded window of
those before it. Vectors at a small angle share a prefix of signs in some pass and meet in its window. Pairs found
are verified by their cosine in double precision and united over the passes into components.

A window holds only part of a large group of near copies, so a vector that links with few of its members may not meet these. But it meets
others: whatever a linked member links with is within 2 * cosine ** 2 - 1 of it. So, once the components are known, vectors that were seen that
near to one which is larger than a window are compared with all its members, and join it if they link with any, until none does.
Then the links inside each component are counted exactly, block against block, whatever the windows had room for.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, forest
from .shared import drop, materialize, temporary

#: Least cosine of a link, vectors before its own that each is compared with, and the share of links at that cosine that the passes are to find.
COSINE, WINDOW, RECALL = 0.9, 512, 0.98
BITS = 64
#: Vectors in a task's unit of work, beside the window before them; vectors in a block of a component.
CHUNK, BLOCK = 4096, 1024


def passes_for(vectors: int, cosine: float = COSINE, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes after which two vectors at `cosine` have met with probability `recall`, at least 4.

    One sign separates them with probability angle / pi (Charikar, 2002), and a window
    is reached once as many signs agree as tell N / window groups apart. The count
    grows as a small power of N: 4 for 10^4 vectors, 9 for 5 * 10^4, about 80 for 10^9.
    """
    same = 1 - math.acos(cosine) / math.pi
    met = same ** max(0.0, math.log2(max(vectors, 1) / window)) if vectors > window else 1.0
    return max(4, math.ceil(math.log(1 - recall) / math.log1p(-met))) if met < 1 else 4


def _directions(one_pass: int, dim: int) -> np.ndarray:
    return np.random.default_rng([17, one_pass, dim]).standard_normal((dim, BITS))


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    v = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # neither overflow nor underflow in the squares
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _digested(vectors: DataFrame, kind: str) -> DataFrame:
    """(vec_id, usable, digest, dim, raw); not usable: null, empty, zero, or with null or non-finite components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            for vec_id, x in zip(batch.column(0), batch.column(1)):
                v = np.array([math.nan if y is None else y for y in x.as_py() or []], kind) + 0.0  # no negative zero
                usable = vec_id.is_valid and len(v) > 0 and bool(np.isfinite(v).all() and v.any())
                raw = v.tobytes() if usable else None
                for c, y in zip(cols, (usable, hashlib.md5(raw).digest() if usable else None, len(v), raw)):
                    c.append(y)
            types = pa.bool_(), pa.binary(), pa.int32(), pa.binary()
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types))], names=["vec_id", "usable", "digest", "dim", "raw"])

    return vectors.mapInArrow(run, "vec_id long, usable boolean, digest binary, dim int, raw binary")


def _keyed(classes: DataFrame, passes: int, kind: str) -> DataFrame:
    """(one_pass, dim, key, rep): each class once for every pass; key is its 64 signs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, raws = batch.column(1).to_numpy(), batch.column(2).to_pylist()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                unit, reps = _unit([raws[i] for i in at], kind), batch.column(0).take(pa.array(at))
                for p in range(passes):
                    signs = np.packbits(unit @ _directions(p, int(dim)) > 0, axis=1)
                    keys = pa.array([s.tobytes() for s in signs], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), p, np.int32)), pa.array(np.full(len(at), dim, np.int32)), keys, reps], names=["one_pass", "dim", "key", "rep"])

    return classes.select("rep", "dim", "raw").mapInArrow(run, "one_pass int, dim int, key binary, rep long")


def _ranked(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """The rows with `place`, their rank in the whole order, from 0; it depends on the rows alone, not on how they are dealt out.

    What reaches the driver is one count for each partition.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = materialize(placed, label)
    part = F.shiftrightunsigned("at", 33)
    sizes = {r["part"]: r["count"] for r in placed.groupBy(part.alias("part")).count().collect()}
    starts = np.cumsum([0, *(sizes.get(k, 0) for k in range(max(sizes, default=0)))]).tolist()
    out = placed.withColumn("place", F.get(F.lit(starts), part) + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("at")
    out.written_path = placed.written_path
    return out


def _linked(unit_a: np.ndarray, unit_b: np.ndarray, allowed: np.ndarray | bool, cosine: float) -> np.ndarray:
    return (unit_a @ unit_b.T >= cosine) & allowed


def _windows(ordered: DataFrame, classes: DataFrame, window: int, cosine: float, kind: str) -> DataFrame:
    """(a, b, near): links between each class and the `window` before it in every pass, of a chunk's links a spanning forest; and, near, the closest that each class met which is no link but may share a neighbour with it.

    A chunk of the order is a task's unit: CHUNK classes, and the window before them, which are the
    last of the chunk before. So the pairs compared depend on ranks alone.
    """
    chunk, least = max(CHUNK, window), 2 * cosine * cosine - 1
    narrow = ordered.select("rep", "one_pass", "place", F.floor(F.col("place") / chunk).alias("chunk"))
    halo = narrow.where(F.pmod("place", F.lit(chunk)) >= chunk - window).withColumn("chunk", F.col("chunk") + 1)
    rows = narrow.unionByName(halo).join(classes.select("rep", "dim", "raw").hint("merge"), "rep")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place", ignore_index=True)
        first = int(np.searchsorted(rows["place"], int(rows["chunk"].iloc[0]) * chunk))
        found_a, found_b, near_a, near_b = [], [], [], []
        for _, same in rows.groupby(["one_pass", "dim"], sort=False):
            reps, places, own = same["rep"].to_numpy(np.int64), same["place"].to_numpy(np.int64), same.index.to_numpy() >= first
            unit = _unit(list(same["raw"]), kind)
            closest, other = np.full(len(reps), least), np.full(len(reps), -1)
            for k in range(0, len(reps), window):
                a = slice(k, k + window)
                b = slice(max(0, k - window), k + window)
                apart, cosines = places[a, None] - places[None, b], unit[a] @ unit[b].T
                met = (apart > 0) & (apart <= window) & own[a, None]
                i, j = np.nonzero((cosines >= cosine) & met)
                if len(i):
                    x, y = forest(reps[a][i], reps[b][j])
                    found_a.append(x)
                    found_b.append(y)
                below = np.where(met & (cosines < cosine), cosines, -1.0)
                for at, axis, across in ((a, 1, b), (b, 0, a)):
                    best = below.max(axis=axis)
                    better = np.flatnonzero(best > closest[at])
                    closest[at][better] = best[better]
                    other[at][better] = below.argmax(axis=axis)[better] + across.start
            seen = np.flatnonzero(other >= 0)
            near_a.append(reps[seen])
            near_b.append(reps[other[seen]])
        none = [np.zeros(0, np.int64)]
        links = forest(np.concatenate(found_a or none), np.concatenate(found_b or none)) if found_a else none * 2
        near = np.concatenate(near_a or none), np.concatenate(near_b or none)
        return pd.DataFrame({"a": np.concatenate([links[0], near[0]]), "b": np.concatenate([links[1], near[1]]), "near": np.arange(len(links[0]) + len(near[0])) >= len(links[0])})

    return rows.groupBy("chunk").applyInPandas(run, "a long, b long, near boolean")


def _attached(outside: DataFrame, members: DataFrame, classes: DataFrame, cosine: float, kind: str, block: int) -> DataFrame:
    """(a, b): links of vectors `outside` (rep, component) with any of the component's `members` (component, rep), a spanning forest of each task's.

    Both are dealt into blocks, and each pair of blocks is one task's product of matrices, so neither a large component nor many vectors near it is ever in one task.
    """
    ordered = _ranked(members, ["component", "rep"], "vector-large")
    inside = ordered.select("component", "rep", F.floor(F.col("place") / block).alias("inner"))
    spans = inside.groupBy("component").agg(F.min("inner").alias("first"), F.max("inner").alias("last"))
    parts = outside.groupBy("component").agg(F.ceil(F.count("*") / block).alias("parts"))
    around = outside.join(parts, "component").join(spans, "component")
    around = around.select("component", "rep", F.pmod(F.xxhash64("rep"), F.col("parts")).alias("outer"), F.explode(F.sequence("first", "last")).alias("inner"), F.lit(1).alias("side"))
    inside = inside.join(parts, "component").select("component", "rep", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("outer"), "inner", F.lit(0).alias("side"))
    rows = around.unionByName(inside).join(classes.select("rep", "dim", "raw").hint("merge"), "rep")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found_a, found_b = [], []
        for _, same in rows.groupby("dim", sort=False):
            a, b = same[same["side"] == 0], same[same["side"] == 1]
            if len(a) and len(b):
                i, j = np.nonzero(_linked(_unit(list(a["raw"]), kind), _unit(list(b["raw"]), kind), True, cosine))
                found_a.append(a["rep"].to_numpy(np.int64)[i])
                found_b.append(b["rep"].to_numpy(np.int64)[j])
        pairs = np.concatenate(found_a or [np.zeros(0, np.int64)]), np.concatenate(found_b or [np.zeros(0, np.int64)])
        return pd.DataFrame(dict(zip("ab", forest(*pairs) if len(pairs[0]) else pairs)))

    out = materialize(rows.groupBy("component", "outer", "inner").applyInPandas(run, "a long, b long"), "vector-attached")
    drop(ordered)
    return out


def _joined(found: DataFrame, classes: DataFrame, window: int, cosine: float, kind: str, block: int) -> DataFrame:
    """(rep, component) of the classes that links reach: those that windows found, and those of vectors near a component that no window holds with all of it."""
    links, near = found.where("not near").select("a", "b"), found.where("near").select("a", "b")
    while True:
        reached = materialize(components(links, "a", "b").select(F.col("node").alias("rep"), "component"), "vector-components")
        large = reached.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > window).select("component")
        members = materialize(reached.join(large, "component"), "vector-large")
        seen = near.join(members.select(F.col("rep").alias("b"), "component").hint("merge"), "b").select(F.col("a").alias("rep"), "component").distinct()
        own = reached.select("rep", F.col("component").alias("own"))
        outside = materialize(seen.join(own.hint("merge"), "rep", "left").where("own is null or own <> component").select("rep", "component"), "vector-outside")
        more = None if outside.isEmpty() else _attached(outside, members, classes, cosine, kind, block)
        if more is None or more.isEmpty():
            return reached
        links = links.unionByName(more)


def _counted(members: DataFrame, classes: DataFrame, cosine: float, kind: str, block: int) -> DataFrame:
    """(rep, linked): the rows of other classes of its component that each class links with, exactly.

    `members` are (component, rep). In the order of components, `block` classes are a block; a block is
    compared with itself and, where a component goes on over several, with the others that hold
    a part of it. Counts leave the task, pairs do not.
    """
    ordered = _ranked(members, ["component", "rep"], "vector-members")
    blocks = ordered.select("component", "rep", F.floor(F.col("place") / block).alias("block"))
    placed = materialize(blocks.join(classes.select("rep", "copies", "dim", "raw").hint("merge"), "rep"), "vector-placed")
    # the blocks of a component: of one that fits into a block, only that; each larger one has its pairs of blocks
    spans = blocks.groupBy("component").agg(F.min("block").alias("first"), F.max("block").alias("last")).where("first < last")
    lefts = spans.select("component", F.explode(F.sequence("first", "last")).alias("left"), "last").repartition("component", "left")
    pairs = lefts.where("left < last").select("component", "left", F.explode(F.sequence(F.col("left") + 1, F.col("last"))).alias("right"))
    inner = placed.withColumns({"left": F.col("block"), "right": F.col("block"), "side": F.lit(0)})
    # a block's share of a component is on one side of each of its pairs; the key names both blocks and the component
    ends = pairs.select("component", "left", "right", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("left").alias("block")), F.struct(F.lit(1).alias("side"), F.col("right").alias("block")))).alias("e"))
    ends = ends.select("component", "left", "right", F.col("e.side").alias("side"), F.col("e.block").alias("block"))
    names = ["component", "rep", "copies", "dim", "raw", "left", "right", "side"]
    across = placed.join(ends.hint("merge"), ["component", "block"])

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        whole = rows["left"].iloc[0] == rows["right"].iloc[0]
        out_rep, out_n = [], []
        for _, same in rows.groupby(["component", "dim"], sort=False):
            a, b = (same, same) if whole else (same[same["side"] == 0], same[same["side"] == 1])
            if len(a) and len(b):
                links = _linked(_unit(list(a["raw"]), kind), _unit(list(b["raw"]), kind), True, cosine)
                if whole:
                    np.fill_diagonal(links, False)
                for x, y, found in ((a, b, links),) if whole else ((a, b, links), (b, a, links.T)):
                    out_rep.append(x["rep"].to_numpy(np.int64))
                    out_n.append(found @ y["copies"].to_numpy(np.int64))
        none = [np.zeros(0, np.int64)]
        return pd.DataFrame({"rep": np.concatenate(out_rep or none), "n": np.concatenate(out_n or none)})

    schema = "rep long, n long"
    parts = inner.select(*names).groupBy("left").applyInPandas(run, schema).unionByName(across.select(*names).groupBy("component", "left", "right").applyInPandas(run, schema))
    counts = materialize(parts.groupBy("rep").agg(F.sum("n").alias("linked")), "vector-counts")
    drop(ordered, placed)
    return counts


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, window: int = WINDOW, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    component_id is the smallest id that links reach which some pass brought into a window, or that lead into a component larger than a window. n_links counts the other rows
    of the component linked to it directly: its exact copies and all copies of vectors at the cosine or above, exactly, however
    large the component. Vectors that are
    null, empty, zero, or hold null or non-finite components, and rows with a null id, link with nothing and are kept; a null
    id has a null component. Vectors of different lengths don't link. Repeated rows are vectors of their own. Ids must be numbers. An empty table gives an
    empty result. The result doesn't depend on how rows are partitioned.

    Exact copies are one class: a vector held by a third of all rows is compared once. What passes emit is
    linear in the vectors. The exact count is quadratic in the distinct vectors of one component, done by matrix products of
    bounded blocks.
    """
    kind = "<f4" if "float" in vectors.schema[vector_col].dataType.simpleString() else "<f8"
    with temporary():
        own = materialize(_digested(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")), kind), "vectors")
        classes = materialize(own.where("usable").groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("dim").alias("dim"), F.first("raw").alias("raw")), "vector-classes")
        passes = passes_for(classes.count(), cosine, window, recall)
        keyed = materialize(_keyed(classes, passes, kind), "vector-keys")
        ordered = _ranked(keyed, ["one_pass", "dim", "key", "rep"], "vector-order")
        links = materialize(_windows(ordered, classes, window, cosine, kind), "vector-links")
        reached = _joined(links, classes, window, cosine, kind, block)
        linked = _counted(reached, classes, cosine, kind, block)
        labels = classes.select("digest", "rep", "copies").join(linked, "rep", "left").join(reached, "rep", "left")
        labels = labels.select("digest", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("component"))
        usable = own.where("usable").select("vec_id", "digest").join(labels.hint("merge"), "digest").select("vec_id", F.col("n").alias("n_links"), F.col("component").alias("component_id"))
        alone = own.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        out = usable.unionByName(alone).select(F.col("vec_id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
        return materialize(out, "vector-results", keep=True)
