"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Every document is scanned once, whole. N-grams of its words that occur in a
   test item are seeds; around each cluster of seeds a passage is cut out, wide enough for the longest
   item to align, as word hashes.
2. The documents that hold each n-gram are counted over the whole corpus. Of every WINDOW consecutive
   n-grams of an item, the rarest is a seed, and so are those of at most RARE times its count; so each stretch has a
   seed, however common its words or its copies are, an edit spoils only the seeds that it
   touches, and common n-grams seed no candidates where rarer ones do.
3. Passages and items that share a seed are aligned; the score is the share of equal words in
   the aligned span, which must hold enough of the item's words. So the length of an item or of its copied part does not decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import materialize, temporary

#: Words to a seed; consecutive n-grams of an item that are weighed against each other, and how much commoner than the rarest a seed may be.
SEED_WORDS, WINDOW, RARE = 3, 4, 8
#: Share of equal words in an aligned span that counts as a copy; the least words of it, as a share of the item's and as a number.
THRESHOLD, PART, LEAST = 0.6, 0.45, 6
MATCH, MISMATCH, GAP = 1, -1, -1
#: Item n-grams up to which their hashes are broadcast (8 bytes each); of more, a bit map of BITS hash bits is, and what passes it is matched by a join.
BROADCAST_NGRAMS, BITS = 4_000_000, 28
_KNOWN: dict[str, int] = {}
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's lower-cased words; a task remembers those it has seen, up to a bound."""
    import regex
    import xxhash

    words = regex.findall(r"\w+", (text or "").lower())
    try:
        return np.array([_KNOWN[w] for w in words], np.uint64)
    except KeyError:
        pass
    if len(_KNOWN) > 250_000:
        _KNOWN.clear()
    for w in words:
        if w not in _KNOWN:
            _KNOWN[w] = xxhash.xxh64_intdigest(w.encode())
    return np.array([_KNOWN[w] for w in words], np.uint64)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each n consecutive word hashes; of all words if there are fewer."""
    if not len(words):
        return np.zeros(0, np.int64)
    n = min(n, len(words))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        h = (h ^ words[k : len(words) - n + 1 + k]) * _MIX
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def align(passage: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """(score, start, end) of the best local alignment (Smith and Waterman, 1981) of an item in a passage; equal scores: the leftmost end.

    One row at a time; within a row a gap costs the same at each step, so its best start
    is a running maximum.
    """

    def rows(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        steps, best = -GAP * np.arange(1, len(p) + 1), np.zeros(len(p), np.int64)
        before = np.zeros(len(p) + 1, np.int64)
        for word in q:
            row = np.maximum(before[:-1] + np.where(p == word, MATCH, MISMATCH), np.maximum(before[1:] + GAP, 0))
            row = np.maximum.accumulate(row + steps) - steps
            np.maximum(best, row, out=best)
            before[1:] = row
        return best

    best = rows(passage, item)
    score = int(best.max(initial=0))
    if not score:
        return 0, 0, 0
    end = int(best.argmax()) + 1
    back = rows(passage[:end][::-1], item[::-1])
    return score, end - 1 - int(np.flatnonzero(back >= score)[0]), end


def span(passage: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """(equal words, columns) of the best local alignment of an item in a passage; of equal scores the one with the fewest columns.

    Rows carry the score with the equal words below it in one number, so memory is linear in the
    passage. A column that isn't an equal word costs 1, so columns are twice the equal words less the score.
    """
    big = len(item) + 1
    match, other, gap = MATCH * big - 1, MISMATCH * big, GAP * big
    steps, best = -gap * np.arange(1, len(passage) + 1), 0
    before = np.zeros(len(passage) + 1, np.int64)
    for word in item:
        row = np.maximum(before[:-1] + np.where(passage == word, match, other), np.maximum(before[1:] + gap, 0))
        before[1:] = np.maximum.accumulate(row + steps) - steps
        best = max(best, int(before.max()))
    score = -(-best // big)
    equal = score * big - best
    return equal, 2 * equal - score


def judged(passage: np.ndarray, item: np.ndarray, threshold: float = THRESHOLD) -> tuple[float, int, int] | None:
    """(score, start, end) of an item's copy in a passage, None if there is none.

    A copy's span has at least `threshold` equal words, and of the item's words at least PART and LEAST, or for an item of few words so many that they outweigh
    the edits by `threshold` of the item.
    """
    part = max(PART * len(item), min(LEAST, threshold * len(item)))
    if np.isin(item, passage).sum() < part:
        return None  # fewer words in common than a copy has
    best, a, b = align(passage, item)
    if best < (2 - 1 / threshold) * part:
        return None  # with so many equal words and no more edits the score would be higher
    equal, columns = span(passage[a:b], item)
    if best < threshold * len(item) and (equal < max(PART * len(item), LEAST) or equal < threshold * columns):
        return None
    return equal / columns, a, b


_PASSAGES = "doc_id long, start long, words array<long>, at array<int>, gram array<long>"


def _cut(out: list[list], doc: int, words: np.ndarray, at: np.ndarray, grams: np.ndarray, n: int, reach: int) -> None:
    """Append the passages around clusters of a document's hits; positions count from the passage's start."""
    order = np.lexsort((grams, at))
    at, grams = at[order], grams[order]
    for a, g in zip(*(np.split(x, np.flatnonzero(np.diff(at) > reach) + 1) for x in (at, grams))):
        start = max(0, int(a[0]) - reach)
        for c, v in zip(out, (doc, start, words[start : int(a[-1]) + n + reach].view(np.int64), a - start, g)):
            c.append(v)


def _passages(out: list[list]) -> pa.RecordBatch:
    lists = [pa.array(c, pa.list_(t)) for c, t in zip(out[2:], (pa.int64(), pa.int32(), pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), *lists], names=["doc_id", "start", "words", "at", "gram"])


def _hits(words: np.ndarray, sizes: list[int], holds) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the n-grams of the given sizes that `holds` lets pass."""
    at, grams = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size in sizes:
        if len(words) >= size:
            h = ngram_hashes(words, size)
            hit = np.flatnonzero(holds(h))
            at.append(hit)
            grams.append(h[hit])
    return np.concatenate(at), np.concatenate(grams)


def _scan(docs: DataFrame, own: DataFrame, n: int, sizes: list[int], reach: int) -> DataFrame:
    """Passages (doc_id, start, words, at, gram) around clusters of n-grams of `own`, whose hashes are broadcast."""
    wanted = np.sort(np.array([r["gram"] for r in own.select("gram").distinct().toLocalIterator()], np.int64))
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        holds = lambda h: held[np.minimum(np.searchsorted(held, h), len(held) - 1)] == h
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = word_hashes(text.as_py())
                if doc is not None and len(words):
                    at, grams = _hits(words, sizes, holds)
                    if len(at):
                        _cut(out, doc, words, at, grams, n, reach)
            yield _passages(out)
        _KNOWN.clear()

    return docs.mapInArrow(run, _PASSAGES)


def _bits(grams: np.ndarray, bits: int) -> np.ndarray:
    return (grams.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _scan_many(docs: DataFrame, own: DataFrame, n: int, sizes: list[int], reach: int) -> DataFrame:
    """As `_scan`, in one pass over the corpus for a benchmark of any size: n-grams that pass a bit map of 2 ** BITS bits are joined with the benchmark's, and only documents with a hit are read again."""

    bits = BITS

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << bits, bool)
        for batch in batches:
            held[_bits(batch.column(0).to_numpy(), bits)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(held).tobytes()], pa.binary())], names=["map"])

    packed = np.zeros((1 << bits) // 8, np.uint8)
    for r in own.select("gram").coalesce(8).mapInArrow(mapped, "map binary").toLocalIterator():
        packed |= np.frombuffer(r["map"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(packed)
    marked = docs.where("doc_id is not null").withColumn("mark", F.xxhash64("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value

        def holds(h: np.ndarray) -> np.ndarray:
            at = _bits(h, bits)
            return (held[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1

        for batch in batches:
            out: list[list] = [[np.zeros(0, np.int64)] for _ in range(4)]
            for doc, text, mark in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                at, grams = _hits(word_hashes(text.as_py()), sizes, holds)
                for c, v in zip(out, (np.full(len(at), doc), np.full(len(at), mark), at, grams)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in out], names=["doc_id", "mark", "at", "gram"])
        _KNOWN.clear()

    found = marked.select("doc_id", "text", "mark").mapInArrow(find, "doc_id long, mark long, at long, gram long")
    hits = found.join(own.select("gram").distinct().hint("merge"), "gram").groupBy("doc_id", "mark").agg(F.collect_set(F.struct("at", "gram")).alias("hits"))
    again = marked.join(hits.hint("merge"), ["doc_id", "mark"]).select("doc_id", "text", F.col("hits.at").alias("at"), F.col("hits.gram").alias("gram"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for k, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                at, grams = (np.array(batch.column(c)[k].values, np.int64) for c in (2, 3))
                _cut(out, doc, word_hashes(text.as_py()), at, grams, n, reach)
            yield _passages(out)
        _KNOWN.clear()

    return again.mapInArrow(run, _PASSAGES)


def _items(benchmark: DataFrame, n: int) -> DataFrame:
    """(item_id, words, grams) of the test items that have words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [word_hashes(t.as_py()) for t in batch.column(1)]
            grams = [ngram_hashes(w, n) for w in words]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([w.view(np.int64) for w in words], pa.list_(pa.int64())), pa.array(grams, pa.list_(pa.int64()))], names=["item_id", "item_words", "grams"])

    out = benchmark.where("item_id is not null").mapInArrow(run, T.StructType([T.StructField("item_id", T.LongType()), T.StructField("item_words", T.ArrayType(T.LongType())), T.StructField("grams", T.ArrayType(T.LongType()))]))
    return out.where(F.size("item_words") > 0)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = SEED_WORDS,
    window: int = WINDOW,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) of each document and test item it holds a whole, edited or partial copy of.

    `benchmark` has (item_id, text). score is the share of equal words in the aligned span, at
    least `threshold`, and the span holds at least PART of the item's words; first_word and last_word bound the copy in the document's words, the last excluded.
    Null and empty texts hold nothing and are held by nothing; null ids are left out;
    repeated rows of an id count as one document, the best copy with the lowest start wins; items of
    equal text are all reported. Empty tables give an empty result.
    Ids must be numbers.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with temporary():
        return materialize(_contaminated(docs, benchmark, n, window, threshold), "decontam-result", keep=True)


def _contaminated(docs: DataFrame, benchmark: DataFrame, n: int, window: int, threshold: float) -> DataFrame:
    """`contaminated` of (doc_id, text) rows, with lazily joined results."""
    spark = docs.sparkSession
    items = materialize(_items(benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")), n), "decontam-items")
    facts = items.agg(F.max(F.size("item_words")).alias("longest"), F.sum(F.size("grams")).alias("grams"), F.collect_set(F.when(F.size("item_words") < n, F.size("item_words"))).alias("short")).first()
    if not facts["longest"]:
        return spark.createDataFrame([], "doc_id long, item_id long, score double, first_word long, last_word long")
    reach = int(facts["longest"] * 5 // 4) + n
    own = items.select("item_id", F.posexplode("grams").alias("item_at", "gram"))
    scans = (_scan if facts["grams"] <= BROADCAST_NGRAMS else _scan_many)(docs, own, n, sorted({n, *facts["short"]}), reach)
    # rows of one id can differ, so their words tell passages apart
    passages = materialize(scans.withColumn("mark", F.xxhash64("words")), "decontam-passages")
    seen = passages.select("doc_id", "start", "mark", F.explode(F.array_distinct("gram")).alias("gram"))
    spread = seen.groupBy("gram", "doc_id").count().groupBy("gram").agg(F.count("*").alias("docs"))
    counted = own.join(spread, "gram").select("item_id", "item_at", "gram", "docs")
    stretch = Window.partitionBy("item_id", F.floor(F.col("item_at") / window))  # the benchmark's own n-grams only
    seeds = counted.withColumn("least", F.min("docs").over(stretch)).where(F.col("docs") <= RARE * F.col("least")).select("item_id", "gram").distinct()
    seeds = materialize(seeds, "decontam-seeds")
    place = ["doc_id", "start", "mark"]
    pairs = seen.join(seeds, "gram").select(*place, "item_id").distinct()
    tried = pairs.join(passages.select(*place, "words").dropDuplicates(place), place).join(items.select("item_id", "item_words"), "item_id")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for r in range(batch.num_rows):
                passage, item = (np.array(batch.column(k)[r].values, np.int64) for k in (3, 4))
                if copy := judged(passage, item, threshold):
                    start = batch.column(1)[r].as_py()
                    for c, v in zip(out, (batch.column(0)[r].as_py(), batch.column(2)[r].as_py(), copy[0], start + copy[1], start + copy[2])):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))], names=["doc_id", "item_id", "score", "first_word", "last_word"])

    scored = tried.select("doc_id", "start", "item_id", "words", "item_words").mapInArrow(score, "doc_id long, item_id long, score double, first_word long, last_word long")
    best = F.max(F.struct("score", -F.col("first_word"), "last_word")).alias("b")
    return scored.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", F.col("b.score").alias("score"), (-F.col("b")["col2"]).alias("first_word"), F.col("b.last_word").alias("last_word"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` without those that hold a copy of a test item; rows with a null id stay."""
    found = contaminated(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias(id_col)).distinct()
    # one plan at every size: what is found grows with the documents, so it is not broadcast
    return docs.join(found.hint("merge"), id_col, "left_anti")
