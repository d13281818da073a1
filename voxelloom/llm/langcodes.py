"""Language identification with error-correcting output codes over byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize

#: Buckets that byte trigrams are hashed into, and documents of each language that are learned from, about.
BUCKETS, SAMPLE = 1 << 15, 600
#: Languages up to which every split of them is a code bit; bits for each doubling beyond; documents of the sample that calibrate the bits, about.
EXHAUSTIVE, BITS, CALIBRATION = 7, 10, 20_000
#: Difference of the two smallest decoding losses, as a share of the bits' weights, below which a prediction is ambiguous.
AMBIGUOUS = 0.02
_PLAIN = bytes(c | 0x20 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_PIECE = 1 << 20


def code_matrix(n: int) -> np.ndarray:
    """(languages, bits) of +1 and -1: every split of the languages once, or random balanced splits if there are many."""
    if n < 2:
        return np.ones((n, 1))
    if n <= EXHAUSTIVE:
        columns = [[1 if i == 0 or i in rest else -1 for i in range(n)] for size in range(n - 1) for rest in combinations(range(1, n), size)]
        return np.array(columns, float).T
    rng, bits, best = np.random.default_rng(11), int(np.ceil(BITS * np.log2(n))), None
    for _ in range(20):
        code = np.array([rng.permutation(np.where(np.arange(n) % 2, 1.0, -1.0)) for _ in range(bits)]).T
        near = min((code[i] != code[j]).sum() for i, j in combinations(range(min(n, 200)), 2))
        if best is None or near > best[0]:
            best = near, code
    return best[1]


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the text's byte trigrams around letters, in bounded pieces; ASCII signs and digits count as space."""
    raw = np.frombuffer((" " + text.lower() + " ").encode().translate(_PLAIN), np.uint8)
    for k in range(0, max(1, len(raw) - 2), _PIECE):
        x = raw[k : k + _PIECE + 2].astype(np.uint32)
        h = (x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - 15)
        yield h[x[1:-1] != 32]


def has_letter(text: str | None) -> bool:
    import regex

    return text is not None and regex.search(r"\p{L}", text) is not None


@dataclass
class Model:
    """languages; code (languages, bits); weights (BUCKETS, bits) of the bit classifiers; slope, offset and trust of each bit."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    slope: np.ndarray
    offset: np.ndarray
    trust: np.ndarray

    def margins(self, text: str) -> np.ndarray:
        """Mean log-odds of the text's n-grams, for each bit."""
        total, n = np.zeros(self.code.shape[1]), 0
        for h in trigrams(text):
            total += self.weights[h].sum(axis=0, dtype=np.float64)
            n += len(h)
        return total / max(n, 1)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous): the codeword of least weighted logistic loss."""
        if not has_letter(text) or not self.languages:
            return "und", 0.0, True
        z = self.slope * self.margins(text) + self.offset
        losses = (self.code > 0) @ (self.trust * np.logaddexp(0, -z)) + (self.code < 0) @ (self.trust * np.logaddexp(0, z))
        order = np.argsort(losses, kind="stable")
        odds = np.exp(losses[order[0]] - losses)
        ambiguous = len(order) > 1 and losses[order[1]] - losses[order[0]] < AMBIGUOUS * self.trust.sum()
        return self.languages[order[0]], float(1 / odds.sum()), bool(ambiguous)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of y in {0, 1} on x, with a weak pull to zero, by Newton's method."""
    spread = x.std() or 1.0
    f = np.stack([x / spread, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(f @ beta, -30, 30)))
        hessian = (f * (p * (1 - p))[:, None]).T @ f + 1e-2 * np.eye(2)
        beta += np.linalg.solve(hessian, f.T @ (y - p) - 1e-2 * beta)
    return beta[0] / spread, beta[1]


def train(rows: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from (lang, text) rows; a column `pick` of evenly spread longs chooses about `sample` whole documents of each language.

    Languages with fewer documents are taken whole. Rows whose lang is null or whose text has no letter teach
    nothing. What reaches the driver is one number and, one after the other, one vector of counts for each language, of which there may be any number, and the margins of
    about CALIBRATION documents.
    """
    rows = rows.where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).toLocalIterator()}
    languages = sorted(sizes)
    code = code_matrix(len(languages))
    none = Model(languages, code, np.zeros((BUCKETS, code.shape[1]), np.float32), np.ones(code.shape[1]), np.zeros(code.shape[1]), np.ones(code.shape[1]))
    if len(languages) < 2:
        return none
    # one row a language, as the driver's own table
    shares = rows.sparkSession.createDataFrame([(lang, min(1.0, sample / n)) for lang, n in sizes.items()], "lang string, share double")
    chosen = rows.join(F.broadcast(shares), "lang").where(F.pmod("pick", F.lit(1 << 30)) < F.col("share") * (1 << 30))
    chosen = materialize(chosen.select("lang", "text", "pick").repartition(8), "language-sample")
    position = {lang: i for i, lang in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Languages come one after the other, so a task holds the counts of one."""
        own, total = None, np.zeros(BUCKETS, np.int64)
        row = lambda: pa.RecordBatch.from_arrays([pa.array([own]), pa.array([total.tobytes()], pa.binary())], names=["lang", "counts"])
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang != own:
                    if own is not None:
                        yield row()
                    own, total = lang, np.zeros(BUCKETS, np.int64)
                for h in trigrams(text):
                    total += np.bincount(h, minlength=BUCKETS)
        if own is not None:
            yield row()

    # sums of the languages' rates on either side of each bit; a language whose documents have no letter has even rates
    sums, left = np.zeros((2, code.shape[1], BUCKETS)), set(languages)

    def add(lang: str, rate: np.ndarray) -> None:
        left.discard(lang)
        bits = code[position[lang]]
        for side, on in enumerate((bits > 0, bits < 0)):
            sums[side][on] += rate

    ordered = chosen.select("lang", "text").repartition("lang").sortWithinPartitions("lang")
    for r in ordered.mapInArrow(count, "lang string, counts binary").toLocalIterator():
        rate = np.frombuffer(r["counts"], np.int64) + 0.5
        add(r["lang"], rate / rate.sum())
    for lang in sorted(left):
        add(lang, np.full(BUCKETS, 1 / BUCKETS))
    weights = np.ascontiguousarray((np.log(sums[0].T / (code > 0).sum(axis=0)) - np.log(sums[1].T / (code < 0).sum(axis=0))).astype(np.float32))
    model = Model(languages, code, weights, none.slope, none.offset, none.trust)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = [model.margins(t).tolist() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(m, pa.list_(pa.float64()))], names=["lang", "m"])

    some = min(1.0, CALIBRATION / sum(min(n, sample) for n in sizes.values()))
    some = chosen.where(F.pmod(F.xxhash64("pick"), F.lit(1 << 30)) < some * (1 << 30))
    seen = some.mapInArrow(measure, "lang string, m array<double>").collect()
    if not seen:
        return none
    bits = code[[position[r["lang"]] for r in seen]] > 0
    m = np.array([r["m"] for r in seen])
    fits = [_logistic(m[:, k], bits[:, k].astype(float)) for k in range(code.shape[1])]
    model.slope, model.offset = (np.array(x) for x in zip(*fits))
    right = ((m * model.slope + model.offset > 0) == bits).mean(axis=0)
    model.trust = np.clip(2 * right - 1, 0.05, 1)
    return model


def held_out(id_col: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text, modulo 3, is 1; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: tuple[str, ...] = (), keep_text: bool = False, sample: int = SAMPLE) -> DataFrame:
    """Per row (id_col, held_out, lang_pred, score, ambiguous, row), and the text if asked for, learned from the rows that aren't held out.

    A prediction sees the whole text and nothing else. Null texts and texts without a letter are
    `und` with score 0; so is everything if no language could be learned. One learned language is always
    predicted. Rows with null ids teach nothing. Repeated rows give repeated results; `row` is a struct of the columns in `keep`.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.struct(*[F.col(c) for c in keep] or [F.lit(0).alias("none")]).alias("row"))
    model = train(own.where(~held_out("id") & F.col("id").isNotNull()).select("lang", "text", F.xxhash64("id").alias("pick")), sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS times the bits of a code, whatever the input
    out = own.select("id", held_out("id").alias("held_out"), "text", "row")
    types = {f.name: f.dataType.simpleString() for f in out.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_()), batch.column(3), *[batch.column(2)] * keep_text],
                names=["id", "held_out", "lang_pred", "score", "ambiguous", "row", *["text"] * keep_text],
            )

    return out.mapInArrow(run, f"id {types['id']}, held_out boolean, lang_pred string, score double, ambiguous boolean, row {types['row']}" + ", text string" * keep_text).withColumnRenamed("id", id_col)
