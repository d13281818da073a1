"""Merkle dataset manifest with coordinate lookup proofs.

Every row is a leaf; a group's leaves, in order, are hashed together in runs of FANOUT, level by level, to the group's
subroot, and subroots likewise to the root. Nodes are materialised as runs: one row for the FANOUT nodes that are hashed together. The
coordinates of the siblings that a leaf's proof needs follow from its index and its group's size alone; they are exploded, joined
with the nodes, ordered, concatenated and folded. The leaves of one run need the same coordinates above their own run,
so these are exploded once for the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .projpass import _ranked
from .shared import drop, materialize

#: Nodes that are hashed together, as a power of two.
FANOUT_BITS = 4
FANOUT = 1 << FANOUT_BITS
#: Leaves whose proofs meet one copy of a node, so that the nodes near a root are not keys that every leaf needs.
SPAN = 1 << 11
#: Tree of the subroots, beside one for each group, which are numbered from 0.
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Length of a digest in hexadecimal digits.
HEX = 64


def leaf(fields: list[Column]) -> Column:
    """The digest of a row: of each field `-` if it is null, else its bytes' count, a colon and its value."""
    parts = []
    for f in fields:
        text = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _depth(size: Column) -> Column:
    """Levels above the leaves until one node is left."""
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(62 // FANOUT_BITS)), lambda k: size > F.call_function("shiftleft", F.lit(1).cast("long"), k * FANOUT_BITS)))


def _hashed(run: Column) -> Column:
    """The parent of a run, which is the digests of its nodes as bytes, one after another."""
    return F.unhex(F.sha2(F.lower(F.hex(run)), 256))


def tree(leaves: DataFrame, most: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """(runs by level, tops) of the trees over (tree, at, size, digest, low, high) rows; `most` is the largest size.

    Runs are (tree, level, run, digests, low, high): the digests of up to FANOUT nodes, and the least and greatest of the leaves' `low` and
    `high` under them; the top of each tree is a run of its own at its depth. tops has the columns of leaves.
    """
    rows, runs, tops, level, reach = leaves, [], [], 0, 1
    while True:
        top = rows.where("size = 1")
        tops.append(top.select("tree", F.lit(level).alias("level"), "digest", "low", "high"))
        if reach >= most:
            break
        together = F.array_sort(F.collect_list(F.struct("at", "digest")))
        held = rows.where("size > 1").groupBy("tree", F.shiftright("at", FANOUT_BITS).alias("run"), "size")
        held = held.agg(F.unhex(F.array_join(F.transform(together, lambda x: F.hex(x["digest"])), "")).alias("digests"), F.min("low").alias("low"), F.max("high").alias("high"))
        held = materialize(held, f"merkle-{label}-{level}")
        runs.append(held.withColumn("level", F.lit(level)))
        runs[-1].written_path = held.written_path
        level, reach = level + 1, reach * FANOUT
        rows = held.select("tree", F.col("run").alias("at"), F.shiftright(F.col("size") + (FANOUT - 1), FANOUT_BITS).alias("size"), _hashed(F.col("digests")).alias("digest"), "low", "high")
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return runs, materialize(out, f"merkle-{label}-tops")


def coordinates(run: Column, size: Column, group: Column, groups: int) -> Column:
    """What the leaves of a run need beside each other: structs (nth, tree, level, run, place) from the leaf level to the root; place is that of the own ancestor in the run.

    The subroot and the root are coordinates without a place.
    """
    shifted = lambda c, k: F.call_function("shiftright", c, k)
    at = lambda c, k: shifted(c, (k - 1) * FANOUT_BITS).bitwiseAND(F.lit(FANOUT - 1)).cast("int")
    depth = _depth(size)
    top_depth = next(k for k in range(64) if FANOUT**k >= groups)
    point = lambda nth, tree, level, run, place: F.struct(nth.cast("int").alias("nth"), tree.cast("long").alias("tree"), level.cast("int").alias("level"), run.cast("long").alias("run"), place.cast("int").alias("place"))
    none = F.lit(None)
    own = F.when(depth > 0, F.transform(F.sequence(F.lit(0), depth - 1), lambda k: point(k, group, k, shifted(run, k * FANOUT_BITS), F.when(k > 0, at(run, k)))))
    own = F.coalesce(own, F.array().cast("array<struct<nth: int, tree: bigint, level: int, run: bigint, place: int>>"))
    above = [point(depth + 1 + e, F.lit(TOP), F.lit(e), shifted(group, F.lit((e + 1) * FANOUT_BITS)), at(group, F.lit(e + 1))) for e in range(top_depth)]
    return F.concat(own, F.array(point(depth, group, depth, F.lit(0), none)), F.array(*above, point(depth + 1 + top_depth, F.lit(TOP), F.lit(top_depth), F.lit(0), none)))


def manifest(docs: DataFrame, group_col: str = "source", id_col: str = "doc_id", fields: tuple[str, ...] = FIELDS, text_col: str = "text", tampered: Column | None = None) -> DataFrame:
    """(id_col, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    Leaves are ordered by group, null first, id and digest: rows of one id are leaves each, a null id comes first. Where
    `tampered`, a condition on the row, holds, folded_root starts from the leaf of the row with the text's A-Z in lower case; it is
    by default that 5 divides the crc32 of the id, false for null ids. `proof_sha256` is the digest of all siblings, of none for a lone row. Null fields differ from empty ones,
    texts may be of any length; columns that are not among `fields` are not read, whatever their names. An empty table gives an empty result.
    """
    touched = F.crc32(F.col(id_col).cast("string")) % 5 == 0 if tampered is None else tampered
    capital = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    other = [F.translate(text_col, capital, capital.lower()) if f == text_col else F.col(f) for f in fields]
    rows = docs.select(F.col(group_col).alias("name"), F.col(id_col).alias("id"), F.unhex(leaf([F.col(f) for f in fields])).alias("digest"), F.unhex(F.when(touched, leaf(other))).alias("forged"))
    leaves = materialize(rows, "merkle-leaves")
    placed = _ranked(leaves, ["name", "id", "digest"], "merkle-order")
    # group numbers follow the order of names, as nodes of the tree of subroots
    sizes = materialize(placed.groupBy("name").agg(F.min("place").alias("first"), F.count("*").alias("size")), "merkle-sizes")
    numbered = _ranked(sizes, ["name"], "merkle-groups").withColumnRenamed("place", "tree")
    counted = sizes.agg(F.count("*").alias("n"), F.max("size").alias("most")).first()
    groups, most = counted["n"], counted["most"] or 0
    numbered = numbered.withColumnRenamed("name", "group_name")
    own = placed.join(numbered, placed["name"].eqNullSafe(numbered["group_name"]))
    own = own.select("tree", (F.col("place") - F.col("first")).alias("at"), "size", "first", "id", "digest", "forged")
    own = own.withColumn("span", F.floor((F.col("first") + F.col("at") - F.pmod("at", F.lit(FANOUT))) / SPAN))
    own = materialize(own, "merkle-own")
    drop(leaves, placed, sizes, numbered)

    runs, tops = tree(own.select("tree", "at", "size", "digest", F.col("span").alias("low"), F.col("span").alias("high")), most, "nodes")
    over = tops.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(groups).cast("long").alias("size"), "digest", "low", "high")
    top_runs, roots = tree(over, groups, "roots")
    columns = ["tree", "level", "run", "digests", "low", "high"]
    nodes = tops.unionByName(roots).select("tree", "level", F.lit(0).cast("long").alias("run"), F.col("digest").alias("digests"), "low", "high")
    for r in (*runs, *top_runs):
        nodes = nodes.unionByName(r.select(*columns))
    nodes = nodes.withColumn("span", F.explode(F.sequence("low", "high"))).drop("low", "high")

    wanted = own.where(F.pmod("at", F.lit(FANOUT)) == 0).select("tree", "size", "span", F.shiftright("at", FANOUT_BITS).alias("run"))
    wanted = wanted.select(F.col("tree").alias("own_tree"), F.col("run").alias("own_run"), "span", F.explode(coordinates(F.col("run"), F.col("size"), F.col("tree"), groups)).alias("c"))
    wanted = wanted.select("own_tree", "own_run", "span", "c.*")
    found = wanted.join(nodes.hint("merge"), ["tree", "level", "run", "span"])
    paths = found.groupBy("own_tree", "own_run").agg(F.array_sort(F.collect_list(F.struct("nth", "tree", "place", "digests"))).alias("path"))
    paths = paths.withColumnsRenamed({"own_tree": "tree", "own_run": "run"})

    proved = own.withColumn("run", F.shiftright("at", FANOUT_BITS)).join(paths.hint("merge"), ["tree", "run"])
    hexed = lambda c: F.lower(F.hex(c))
    leads = F.filter("path", lambda x: (x["nth"] < _depth(F.col("size"))) | ((x["tree"] == TOP) & x["place"].isNotNull()))
    place = lambda x: F.coalesce(x["place"], F.pmod("at", F.lit(FANOUT)).cast("int"))
    steps = F.transform(leads, lambda x: F.struct(hexed(F.substring(x["digests"], F.lit(1), place(x) * (HEX // 2))).alias("before"), hexed(F.substring(x["digests"], (place(x) + 1) * (HEX // 2) + 1, F.lit(FANOUT * HEX))).alias("after")))
    alone = lambda part: hexed(F.element_at(F.filter("path", part), 1)["digests"])
    proved = proved.select(
        "id", hexed("digest").alias("leaf"), hexed(F.coalesce("forged", "digest")).alias("begin"), steps.alias("steps"),
        alone(lambda x: (x["tree"] != TOP) & (x["nth"] == _depth(F.col("size")))).alias("subroot"), alone(lambda x: (x["tree"] == TOP) & x["place"].isNull()).alias("root"),
    )
    proof = F.sha2(F.array_join(F.transform("steps", lambda s: F.concat(s["before"], s["after"])), ""), 256)
    folded = F.aggregate("steps", F.col("begin"), lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))
    out = proved.select(F.col("id").alias(id_col), "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
    out = materialize(out, "merkle-proofs", keep=True)
    drop(own, tops, roots, *runs, *top_runs)
    return out
