"""Target-distribution importance resampling over hashed n-grams (Xie et al., 2023).

Two Arrow passes over the corpus. In the first every partition counts its features with np.bincount into one vector of
BUCKETS, and treeReduce merges the vectors. In the second the buckets' gains, broadcast, are gathered for each feature
and summed for each document by bincount with weights. Scores get Gumbel noise from the document's id, so
that the highest of them are a sample without replacement; their ranks are taken over the whole corpus by range partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .projpass import _ranked
from .shared import drop, materialize

#: Buckets of features, consecutive words of the longest feature, and a gain's unit.
BUCKETS, LONGEST, UNIT = 10_000, 2, 1000
#: Fewest words of a document that may be drawn, and how many of a hundred of them are.
LEAST_WORDS, PERCENT = 20, 25
#: Mixed into the noise of every document.
SEED = 7
#: Bytes of a text that are split into words at once.
_PIECE = 1 << 20
#: Words are of ASCII digits, ASCII letters and all that is beyond ASCII; capitals count as small letters.
_PLAIN = bytes(c | 0x20 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words(text: str | None) -> Iterator[list[bytes]]:
    """The text's words, lower-cased, in lists of bounded size; none for a null text."""
    raw, at = (text or "").encode().translate(_PLAIN), 0
    while at < len(raw):
        end = raw.find(b" ", at + _PIECE)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def features(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of the runs of 1 to LONGEST words, repeats included, in bounded arrays; the first array of each list of words holds its single words."""
    tail: list[bytes] = []
    for found in words(text):
        yield np.fromiter(map(crc32, found), np.int64, len(found)) % BUCKETS
        both = tail + found
        for n in range(2, LONGEST + 1):
            # runs that end in `found`
            own = both[max(0, len(tail) - n + 1) :]
            count = max(0, len(own) - n + 1)
            yield np.fromiter(map(crc32, map(b" ".join, zip(*(own[k:] for k in range(n))))), np.int64, count) % BUCKETS
        tail = both[len(both) - LONGEST + 1 :] if LONGEST > 1 else []


def bucket_counts(texts: DataFrame, text_col: str) -> np.ndarray:
    """Features of all texts by bucket. Each partition gives one vector; vectors meet in a tree, so the driver merges few."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for found in features(text.as_py()):
                    total += np.bincount(found, minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])

    parts = texts.select(text_col).mapInArrow(count, "counts binary").rdd.map(lambda r: np.frombuffer(r["counts"], np.int64))
    none = texts.sparkSession.sparkContext.parallelize([np.zeros(BUCKETS, np.int64)], 1)
    return parts.union(none).treeReduce(np.add)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored log of a bucket's share in the target to that in the corpus, each count one more than it is."""
    s, t = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(UNIT * math.log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(corpus.tolist(), target.tolist())], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(id_col, n_words, n_features, weight) of every row; weight is the floored mean of the gains of its features, 0 without any."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # BUCKETS numbers, whatever the input
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = shared.value
        for batch in batches:
            n = batch.num_rows
            n_words, n_features, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            held, owner, size = [], [], 0

            def add_up() -> None:
                if held:
                    total[:] += np.bincount(np.repeat(owner, [len(x) for x in held]), value[np.concatenate(held)], n).astype(np.int64)
                held.clear(), owner.clear()

            for i, text in enumerate(batch.column(1)):
                for k, found in enumerate(features(text.as_py())):
                    n_words[i] += len(found) * (k % LONGEST == 0)
                    n_features[i] += len(found)
                    held.append(found)
                    owner.append(i)
                    size += len(found)
                    if size > _PIECE:
                        add_up()
                        size = 0
            add_up()
            weight = np.where(n_features > 0, total // np.maximum(n_features, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in (n_words, n_features, weight))], names=["id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(weigh, f"id {kind}, n_words long, n_features long, weight long").withColumnRenamed("id", id_col)


def noise(ident: Column, seed: int = SEED) -> Column:
    """Floored Gumbel noise from the hash of seed and id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1.0 * UNIT) * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(id_col, n_features, weight, score, rank) of every row of `docs`; rank is null for those that are not drawn.

    Of the N rows with `least_words` words or more the floor(percent * N / 100) highest scores are drawn, ties to the smaller id, nulls before
    others; rows that repeat an id share its noise and are drawn each. A null text counts as empty; texts may be of any length and are counted whole. Other
    columns, whatever their names, are not read. An empty table gives an empty result; an empty target makes rare features gain.
    """
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    scored = weighed(docs, gain, id_col, text_col).withColumnRenamed(id_col, "id").withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    scored = materialize(scored, "resample-scores")
    may = scored.where(F.col("n_words") >= least_words)
    drawn = may.count() * percent // 100
    ranked = _ranked(may.withColumn("below", -F.col("score")), ["below", "id", "n_features", "weight"], "resample-ranks")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    few = scored.where(F.col("n_words") < least_words)
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    out = materialize(ranked.select(*columns, rank.alias("rank")).unionByName(few.select(*columns, F.lit(None).cast("long").alias("rank"))), "resample-result", keep=True)
    drop(scored, ranked)
    return out
