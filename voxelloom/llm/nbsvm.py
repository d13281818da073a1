"""Quality classifier: naive Bayes support vectors over hashed n-gram indicators (Wang and Manning, 2012).

Each indicator is scaled by its bucket's class log-count ratio; a linear hinge-loss model is fitted to
that by dual coordinate descent (Hsieh et al., 2008). Margins of documents that a fit has not seen calibrate the score.
The model is learned from a bounded sample of labelled documents, in one task for each fold; every document is scored where it lies.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .langcodes import _logistic
from .shared import drop, materialize

#: Buckets of n-grams, labelled documents of each class that are learned from, and folds whose margins calibrate the score.
BUCKETS, SAMPLE, FOLDS = 1 << 17, 4000, 3
#: Cost of a unit of hinge loss, the pull of class counts towards equality, most passes of the descent and the gap at which it ends.
COST, SMOOTHING, EPOCHS, TOLERANCE = 1.0, 1.0, 60, 1e-2
#: Score from which a document is predicted to be of class 1.
THRESHOLD = 0.3
#: Characters of a text that are split into words at once, words whose hashes a task remembers, and the longest of them.
_PIECE, _KNOWN, _LONGEST = 1 << 20, 1 << 18, 64
_SHAPES = re.compile(r"(?P<U>[A-ZÀ-ÖØ-Þ]+)|(?P<l>[a-zß-öø-ÿ]+)|(?P<d>[0-9]+)|(?P<o>[^\W\d_]+)")
#: Stands for a word, and for its shape, like the one before.
_REPEAT = np.uint32(0x5BD1E995)


def _shape(word: str) -> str:
    """The word with its runs of capitals, small letters, digits and other letters as one sign each, longer runs of capitals as two; signs stay.

    Beyond Latin letters, words of one case throughout have it in their shape.
    """
    core = word.rstrip(".,")
    if core.isalpha():
        known = "l" if core.islower() else "Ul" if len(core) > 1 and core[0].isupper() and core[1:].islower() else "U" * min(len(core), 2) if core.isupper() else None
        if known:
            return known + word[len(core) :]
    return _SHAPES.sub(lambda m: "UU" if m.lastgroup == "U" and len(m[0]) > 1 else m.lastgroup, word)


class _Hashes(dict):
    """word: its crc32 in lower case and, in the upper half, that of its shape; of a bounded number of words."""

    def __missing__(self, word: str) -> int:
        found = crc32(word.lower().encode("utf-8", "surrogatepass")) | crc32(_shape(word[:_LONGEST]).encode("utf-8", "surrogatepass")) << 32
        if len(word) <= _LONGEST:
            if len(self) >= _KNOWN:
                self.clear()
            self[word] = found
        return found


_HASHES = _Hashes()


def _pieces(text: str) -> Iterator[list[str]]:
    """The text's words in lists of bounded size."""
    at = 0
    while at < len(text):
        end = at + _PIECE
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[at:end].split()
        at = end


def _buckets(*parts: np.ndarray) -> np.ndarray:
    h = np.full(len(parts[0]), len(parts), np.uint32)
    for p in parts:
        h = (h ^ p) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return h % np.uint32(BUCKETS)


def indicators(text: str | None) -> np.ndarray:
    """Sorted distinct buckets of a whole text's n-grams: one and two words, one to three shapes of words.

    A word like the one before counts as a repeat mark in both, so that repetition is seen whichever word repeats. No text has no n-gram.
    """
    seen = np.zeros(BUCKETS, bool)
    last, w, s = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    for words in _pieces(text or ""):
        both = np.append(last, np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words)))
        same = np.append(np.zeros(1 - len(last), bool), both[1:] == both[:-1])[: len(words)]
        last, both = both[-1:], both[len(last) :]
        # the last two of the piece before go on into this one
        w = np.append(w[-2:], np.where(same, _REPEAT, both.astype(np.uint32)))
        s = np.append(s[-2:], np.where(same, _REPEAT, (both >> np.uint64(32)).astype(np.uint32)) ^ np.uint32(1))
        for found in (_buckets(w), _buckets(w[:-1], w[1:]), _buckets(s), _buckets(s[:-1], s[1:]), _buckets(s[:-2], s[1:-1], s[2:])):
            seen[found] = True
    return np.flatnonzero(seen).astype(np.int32)


def _ids(row: np.ndarray) -> np.ndarray:
    """A row's buckets; rows of many buckets are held as bits."""
    return np.flatnonzero(np.unpackbits(row, count=BUCKETS)) if row.dtype == np.uint8 else row


def _row(bits: bytes) -> np.ndarray:
    packed = np.frombuffer(zlib.decompress(bits), np.uint8)
    ids = np.flatnonzero(np.unpackbits(packed, count=BUCKETS)).astype(np.int32)
    return packed if ids.nbytes > packed.nbytes else ids


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Log of the smoothed share of class 1 to that of class 0 that falls to each bucket."""
    counts = np.full((2, BUCKETS), SMOOTHING)
    for row, k in zip(rows, good):
        counts[k, _ids(row)] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_descent(rows: list[np.ndarray], ratios: np.ndarray, good: np.ndarray, cost: float = COST, epochs: int = EPOCHS, tolerance: float = TOLERANCE) -> np.ndarray:
    """Weights of the L2-regularised hinge-loss model, the offset's last, by dual coordinate descent.

    Row i has ratios[b] / sqrt(buckets of the row) in each bucket b of its own, and 1 for the offset. Both classes have the same total
    cost. Ends when the projected gradients of a pass differ by less than `tolerance`, or after `epochs` passes.
    """
    y = np.where(good > 0, 1.0, -1.0)
    top = cost * len(y) / 2 / np.where(good > 0, max(1, (good > 0).sum()), max(1, (good <= 0).sum()))
    w, alpha, rng = np.zeros(BUCKETS + 1), np.zeros(len(y)), np.random.default_rng(5)
    for _ in range(epochs):
        low, high = np.inf, -np.inf
        for i in rng.permutation(len(y)):
            ids = _ids(rows[i])
            x = ratios[ids] / max(len(ids), 1) ** 0.5
            gradient = y[i] * (w[ids] @ x + w[-1]) - 1
            projected = min(gradient, 0.0) if alpha[i] <= 0 else max(gradient, 0.0) if alpha[i] >= top[i] else gradient
            low, high = min(low, projected), max(high, projected)
            if projected:
                step = min(max(alpha[i] - gradient / (x @ x + 1), 0.0), top[i]) - alpha[i]
                alpha[i] += step
                w[ids] += step * y[i] * x
                w[-1] += step * y[i]
        if high - low < tolerance:
            break
    return w


def fit(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Weights of indicators, the log-count ratios among them, and the offset last."""
    ratios = log_count_ratios(rows, good)
    w = dual_descent(rows, ratios, good)
    return np.append(w[:-1] * ratios, w[-1])


def margin(weights: np.ndarray, ids: np.ndarray) -> float:
    return float(weights[ids].sum() / max(len(ids), 1) ** 0.5 + weights[-1])


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 5, is 0; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def labelled(ids: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, good, mark) of each id of `ids` that may teach: it is not held out, and its labels are 0 or 1 and agree."""
    own = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("good")).where("id is not null and good in (0, 1)")
    own = own.where(~held_out("id")).groupBy("id").agg(F.min("good").alias("good"), F.max("good").alias("most")).where("good = most")
    return own.join(ids.select(F.col(id_col).alias("id")), "id", "left_semi").select("id", "good", F.xxhash64("id").alias("mark"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> tuple[np.ndarray, float, float]:
    """(weights, slope, offset): of margins, slope * margin + offset are the log odds of class 1.

    Of each class the `sample` documents with the smallest hashes of their ids teach, all if there are fewer; of rows with one id that with the
    smallest hash of its text does. The share of the classes is that of all labelled documents. Where a class has
    no document the odds are those of the labels alone.
    """
    known = materialize(labelled(docs, labels, id_col, label_col), "quality-labels")
    sizes = {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}
    zero, one = (sizes.get(k, 0) for k in (0, 1))
    odds = float(np.log((one + 0.5) / (zero + 0.5)))
    if not zero or not one:
        drop(known)
        return np.zeros(BUCKETS + 1), 0.0, odds
    chosen = known.where("good = 0").orderBy("mark", "id").limit(sample).unionByName(known.where("good = 1").orderBy("mark", "id").limit(sample))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")  # 2 * sample rows at most
    types = {f.name: f.dataType.simpleString() for f in texts.schema}

    def see(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for text in batch.column(1):
                seen = np.zeros(BUCKETS, bool)
                seen[indicators(text.as_py())] = True
                bits.append(zlib.compress(np.packbits(seen).tobytes(), 1))  # a bit a bucket at most
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:5], pa.array(bits, pa.binary())], names=["id", "good", "mark", "text_mark", "bits"])

    texts = texts.select("id", "text", "good", "mark", F.xxhash64("text").alias("text_mark"))
    seen = texts.mapInArrow(see, f"id {types['id']}, good int, mark long, text_mark long, bits binary")
    once = materialize(seen.groupBy("id").agg(F.min(F.struct("text_mark", "good", "mark", "bits")).alias("r")).select("id", "r.good", "r.mark", "r.bits"), "quality-sample")
    drop(known)

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        """Fold k is fitted to the other folds and measured on itself; the last is fitted to all."""
        rows, k = rows.sort_values(["mark", "id"]), int(rows["fold"].iloc[0])
        own, good, seen = rows["mark"].to_numpy() % FOLDS == k, rows["good"].to_numpy(), [_row(b) for b in rows["bits"]]
        weights = fit([seen[i] for i in np.flatnonzero(~own)], good[~own])
        margins = [margin(weights, _ids(seen[i])) for i in np.flatnonzero(own)]
        return pd.DataFrame({"fold": [k], "weights": [weights.tobytes() if k == FOLDS else b""], "margins": [margins], "good": [good[own].tolist()]})

    # by range, so that each fold has a task of its own
    dealt = once.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(FOLDS)))).repartitionByRange(FOLDS + 1, "fold")
    fits = {r["fold"]: r for r in dealt.groupBy("fold").applyInPandas(learn, "fold int, weights binary, margins array<double>, good array<int>").collect()}
    drop(once)
    weights = np.frombuffer(fits[FOLDS]["weights"])
    good = np.array([g for k in range(FOLDS) for g in fits[k]["good"]], float)
    slope, offset = _logistic(np.array([m for k in range(FOLDS) for m in fits[k]["margins"]]), good)
    # the sample's odds give way to those of all labelled documents
    return weights, float(slope), float(offset + odds - np.log((good.sum() + 0.5) / ((1 - good).sum() + 0.5)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, held_out, score, predicted) of every row of `docs`, learned from `labels` (id_col, label_col) of ids that are not held out.

    A score sees the whole text, however long, and nothing else; null and empty texts have no n-gram and get the score of the offset.
    Rows with a null id are scored, teach nothing and are not held out. Repeated rows give repeated results. Labels that are null, neither 0
    nor 1, or contradict each other teach nothing; without labels of both classes every score is the share of class 1 among them, 0.5 without any. Other
    columns, whatever their names, are not read. An empty table gives an empty result.
    """
    weights, slope, offset = train(docs, labels, id_col, text_col, label_col, sample)
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 8 bytes a bucket, whatever the input
    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds = slope * np.array([margin(shared.value, indicators(t.as_py())) for t in batch.column(2)]) + offset
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(1 / (1 + np.exp(-np.clip(odds, -500, 500))))], names=["id", "held_out", "score"])

    scored = rows.mapInArrow(score, f"id {types['id']}, held_out boolean, score double")
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
