"""Reversible line dedup: sharded cuckoo filters backed by exact reference-count tables.

A line's key is the line stripped of ASCII white space and with A-Z lower-cased; only keys
of at least `min_length` code points count. The state of a store is three tables:

* refs (shard, k1, k2, doc_id): each document that holds a key, once; (k1, k2) is
  the 128-bit hash of the key;
* counts (shard, k1, k2, n_docs, max_doc): exact, one row for each key;
* filters (shard, buckets, full): for each shard a cuckoo filter of the keys found in at
  least `min_docs` documents. It answers "perhaps repeated" from two bytes a
  key and, unlike a Bloom filter, can forget a key again.

Documents are inserted and deleted in batches: only the keys they touch are counted anew, and keys
that cross `min_docs` enter or leave their shard's filter. A filter that
overflows is built again, larger, from its shard's exact counts. References meet the filter of their shard where
they are; what passes is joined with the exact tables, which decide, so results never depend on the filters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import materialize, new_path

#: Characters stripped from both ends of a line, and the regular expression's class [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"
MIN_LENGTH, MIN_DOCS = 40, 5
#: Keys that a shard's filter is sized for, about, and parts that a shard's references are dealt out in to meet it.
SHARD_KEYS, PARTS = 50_000, 16
KEY = ["shard", "k1", "k2"]


def line_key(line: str, min_length: int = MIN_LENGTH) -> bytes | None:
    """128-bit hash of the line's key; None if the key is too short to count."""
    import xxhash

    line = line.strip(SPACE)
    return xxhash.xxh3_128_digest(line.encode().lower()) if len(line) >= min_length else None


class Cuckoo:
    """A cuckoo filter of 16-bit tags, four to a bucket; a key is the low 64 bits of its hash."""

    def __init__(self, slots: np.ndarray, full: bool = False):
        self.slots, self.full = slots, full

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(keys, 1) / 4 / 0.8))))
        return cls(np.zeros((buckets, 4), np.uint16))

    @classmethod
    def of(cls, k2: np.ndarray) -> Cuckoo:
        """A filter with room for as many keys again."""
        size = 2 * len(k2)
        while True:
            one = cls.sized(size)
            one.add(k2)
            if not one.full:
                return one
            size *= 2

    def _places(self, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        k2 = np.asarray(k2, np.int64).view(np.uint64)
        tag = (k2 & np.uint64(0xFFFF)).astype(np.int64)
        tag[tag == 0] = 1
        first = ((k2 >> np.uint64(20)) & np.uint64(len(self.slots) - 1)).astype(np.int64)
        return tag, first, self._other(first, tag)

    def _other(self, place, tag):
        return place ^ ((tag * 0x5BD1E995 >> 8) & (len(self.slots) - 1))

    def add(self, k2: np.ndarray) -> None:
        rng = np.random.default_rng(7)
        for tag, a, b in zip(*(x.tolist() for x in self._places(k2))):
            for place in (a, b):
                free = np.flatnonzero(self.slots[place] == 0)
                if len(free):
                    self.slots[place, free[0]] = tag
                    break
            else:
                place = a
                for _ in range(500):
                    slot = int(rng.integers(4))
                    tag, self.slots[place, slot] = int(self.slots[place, slot]), tag
                    place = int(self._other(place, tag))
                    free = np.flatnonzero(self.slots[place] == 0)
                    if len(free):
                        self.slots[place, free[0]] = tag
                        break
                else:
                    self.full = True
                    return

    def remove(self, k2: np.ndarray) -> None:
        for tag, a, b in zip(*(x.tolist() for x in self._places(k2))):
            for place in (a, b):
                held = np.flatnonzero(self.slots[place] == tag)
                if len(held):
                    self.slots[place, held[0]] = 0
                    break

    def holds(self, k2: np.ndarray) -> np.ndarray:
        if self.full:
            return np.ones(len(k2), bool)
        tag, a, b = self._places(k2)
        return ((self.slots[a] == tag[:, None]) | (self.slots[b] == tag[:, None])).any(axis=1)


def _refs(docs: DataFrame, shards: int, min_length: int) -> DataFrame:
    """(shard, k1, k2, doc_id), once for each document and key, from (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = {line_key(x, min_length) for x in (text.as_py() or "").split("\n")} - {None} if doc is not None else ()
                keys.extend(found)
                ids.extend([doc] * len(found))
            k = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(k[:, 0] % shards, pa.int32()), pa.array(k[:, 0]), pa.array(k[:, 1]), pa.array(ids, pa.int64())], names=[*KEY, "doc_id"])

    return docs.mapInArrow(run, "shard int, k1 long, k2 long, doc_id long").distinct()


class LineStore:
    """Reference counts of lines that grow and shrink with the documents inserted and deleted.

    Every change writes a new version of the tables under `path` and leaves the
    old one, so a change that fails half way leaves the store as it was. Null ids hold no
    references; an id that is inserted again adds the keys it did not hold.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, shards: int = 16, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS):
        self.spark, self.path, self.shards = spark, path or new_path(spark, "lines"), shards
        self.min_length, self.min_docs, self.version = min_length, min_docs, 0
        self.refs: DataFrame | None = None
        self.counts: DataFrame | None = None
        self.filters: DataFrame | None = None

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name, f"{self.path}/{self.version}/{name}")

    def _counted(self, refs: DataFrame) -> DataFrame:
        return refs.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("max_doc"))

    def insert(self, docs: DataFrame) -> None:
        """Add documents, (id, text)."""
        self.version += 1
        new = _refs(docs, self.shards, self.min_length)
        if self.refs is None:
            self.refs = self._write(new, "refs")
            before, self.counts = None, self._write(self._counted(self.refs), "counts")
        else:
            new = self._write(new.join(self.refs, [*KEY, "doc_id"], "left_anti"), "new")
            before = self.counts
            self.refs = self._write(self.refs.unionByName(new), "refs")
            both = before.unionByName(self._counted(new))
            self.counts = self._write(both.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc")), "counts")
        self._refilter(before)

    def delete(self, ids: DataFrame) -> None:
        """Remove the documents whose ids are in the first column."""
        if self.refs is None:
            return
        self.version += 1
        ids = ids.select(F.col(ids.columns[0]).cast("long").alias("doc_id")).distinct()
        touched = self._write(self.refs.join(ids, "doc_id", "left_semi").select(*KEY).distinct(), "touched")
        self.refs = self._write(self.refs.join(ids, "doc_id", "left_anti").select(*KEY, "doc_id"), "refs")
        before = self.counts
        again = self._counted(self.refs.join(touched, KEY, "left_semi"))
        self.counts = self._write(before.join(touched, KEY, "left_anti").unionByName(again), "counts")
        self._refilter(before)

    def _refilter(self, before: DataFrame | None) -> None:
        """Let keys that crossed min_docs enter or leave the filters."""
        held = F.col("n_docs") >= self.min_docs
        now = self.counts.where(held).select(*KEY)
        if before is None:
            changes = now.withColumn("enters", F.lit(True))
            filters = None
        else:
            was = before.where(held).select(*KEY)
            changes = now.join(was, KEY, "left_anti").withColumn("enters", F.lit(True)).unionByName(was.join(now, KEY, "left_anti").withColumn("enters", F.lit(False)))
            filters = self.filters

        def state(shard: int, one: Cuckoo) -> pd.DataFrame:
            return pd.DataFrame({"shard": [shard], "buckets": [one.slots.tobytes()], "full": [one.full]})

        def change(key, new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
            enters = new["enters"].to_numpy(bool)
            if not len(old):
                return state(key[0], Cuckoo.of(new["k2"].to_numpy()[enters]))
            one = Cuckoo(np.frombuffer(old["buckets"].iloc[0], np.uint16).reshape(-1, 4).copy())
            one.remove(new["k2"].to_numpy()[~enters])
            one.add(new["k2"].to_numpy()[enters])
            return state(key[0], one)

        schema = "shard int, buckets binary, full boolean"
        if filters is None:
            self.filters = self._write(changes.groupBy("shard").applyInPandas(lambda key, new: state(key[0], Cuckoo.of(new["k2"].to_numpy())), schema), "filters")
            return
        changed = self._write(changes.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(change, schema), "changed-filters")
        over = changed.where("full").select("shard")
        again = now.join(over.hint("merge"), "shard", "left_semi").groupBy("shard").applyInPandas(lambda key, held: state(key[0], Cuckoo.of(held["k2"].to_numpy())), schema)
        self.filters = self._write(changed.where("not full").unionByName(again), "filters")

    def _perhaps(self, refs: DataFrame) -> DataFrame:
        """Of the references, those whose keys pass the filter of their shard.

        A shard's references are dealt out in PARTS by document, each with the filter ahead of them, so a key that a third of all
        documents hold is not one task's, and a task holds a batch and one filter.
        """
        heads = self.filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"), F.lit(0).alias("is_ref"), "buckets", *[F.lit(0).cast("long").alias(c) for c in ("k1", "k2", "doc_id")])
        rows = refs.select("shard", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int").alias("part"), F.lit(1).alias("is_ref"), F.lit(None).cast("binary").alias("buckets"), "k1", "k2", "doc_id")
        dealt = heads.unionByName(rows).repartition("shard", "part").sortWithinPartitions("shard", "part", "is_ref")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, one = -1, None
            for batch in batches:
                shard, is_ref, k2 = (batch.column(k).to_numpy() for k in (0, 2, 5))
                keep = np.zeros(batch.num_rows, bool)
                cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(is_ref) != 0)) + 1
                for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                    if a == b:
                        continue
                    if not is_ref[a]:
                        held, one = shard[a], Cuckoo(np.frombuffer(batch.column(3)[int(a)].as_py(), np.uint16).reshape(-1, 4))
                    elif held == shard[a]:  # a shard without a filter has no repeated key
                        keep[a:b] = one.holds(k2[a:b])
                out = batch.filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays([out.column(k) for k in (0, 4, 5, 6)], names=[*KEY, "doc_id"])

        return dealt.mapInArrow(run, "shard int, k1 long, k2 long, doc_id long")

    def dropped(self) -> DataFrame:
        """(doc_id, keys array<binary>): the keys whose lines a document loses: found in min_docs documents, and in a later one too."""
        hot = self.counts.where(F.col("n_docs") >= self.min_docs).select(*KEY, "max_doc")
        lost = self._perhaps(self.refs).join(hot.hint("merge"), KEY).where("doc_id <> max_doc")
        return lost.groupBy("doc_id").agg(F.collect_list(F.struct("k1", "k2")).alias("keys"))


def shards_for(docs: DataFrame) -> int:
    """A power of two such that a shard's filter holds about SHARD_KEYS keys at ten counted keys a document."""
    return 1 << max(2, int(np.ceil(np.log2(max(1, 10 * docs.count()) / SHARD_KEYS))))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per row (id_col, n_lines, n_dropped, kept_text, row): lines of keys found in at least min_docs documents go, but in the largest id that holds the key.

    Texts split at line feeds only; null and empty texts are one empty line and come
    back empty. `row` is a struct of the columns named in `keep`, so their
    names can't clash. A key repeated in one document counts once, and the largest id
    keeps all its lines of the key; so do repeated rows of that id. Rows with a null id count nowhere and lose nothing.
    An empty table gives an empty result.
    """
    one = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    store = LineStore(docs.sparkSession, shards=shards_for(docs), min_length=min_length, min_docs=min_docs)
    store.insert(one)
    lost = materialize(store.dropped(), "line-drops")
    row = F.struct(*[F.col(c) for c in keep] or [F.lit(0).alias("none")]).alias("row")
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), row)
    # one plan at every size: what is lost grows with the documents, so neither side is broadcast
    joined = own.join(lost.hint("merge"), own["id"] == lost["doc_id"], "left").select("id", "text", F.col("keys.k1").alias("k1"), F.col("keys.k2").alias("k2"), "row")
    row_type = joined.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, drops, kept = [], [], []
            k1s, k2s = batch.column(2), batch.column(3)
            for r, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                n = text.count("\n") + 1
                lines.append(n)
                k1 = k1s[r].as_py()
                if k1:
                    gone = {np.array(k, "<i8").tobytes() for k in zip(k1, k2s[r].as_py())}
                    left = [x for x in text.split("\n") if line_key(x, min_length) not in gone]
                    text, left_n = "\n".join(left), len(left)
                else:
                    left_n = n
                drops.append(n - left_n)
                kept.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.int64()), pa.array(drops, pa.int64()), pa.array(kept, pa.string()), batch.column(4)], names=["id", "n_lines", "n_dropped", "kept_text", "row"])

    return joined.mapInArrow(run, f"id long, n_lines long, n_dropped long, kept_text string, row {row_type}").withColumnRenamed("id", id_col)
