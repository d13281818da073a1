"""Brute-force, held-out and edge-case tests of the quality classifier, importance resampling and the Merkle manifest."""

import hashlib
import math
import re
import zlib
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelloom.llm import merkle, nbsvm, resample

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, id string, tree int, at int, place int, size int, good int, bits int, mark int, score int, name string, digest string, fold int"


def frame(spark, rows, schema=SCHEMA):
    """Rows (doc_id, source, lang, n_chars, text) with extra columns whose names clash with those used inside."""
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, 5, 6, 7, 8, "n", "d", 9) for r in rows], schema)


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(digests):
    """All levels of a tree, from the leaves up."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k : k + 16]) for k in range(0, len(levels[-1]), 16)])
    return levels


def path_of(levels, at):
    for level in levels[:-1]:
        run = level[at // 16 * 16 : at // 16 * 16 + 16]
        yield run[: at % 16], run[at % 16 + 1 :]
        at //= 16


def brute_manifest(rows):
    plain = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    names = sorted({r[1] for r in rows}, key=lambda n: (n is not None, (n or "").encode()))
    trees, order = [], []
    for n in names:
        own = sorted((r for r in rows if r[1] == n), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        order.append(own)
        trees.append(climb([leaf_of(r) for r in own]))
    top = climb([t[-1][0] for t in trees])
    out = []
    for g, (own, tree) in enumerate(zip(order, trees)):
        for at, r in enumerate(own):
            path = [*path_of(tree, at), *path_of(top, g)]
            touched = r[0] is not None and crc32(str(r[0]).encode()) % 5 == 0
            acc = leaf_of((*r[:4], r[4].translate(plain) if r[4] is not None else None)) if touched else leaf_of(r)
            for before, after in path:
                acc = H(*before, acc, *after)
            proof = H(*(d for before, after in path for d in (*before, *after)))
            out.append((r[0], leaf_of(r), tree[-1][0], top[-1][0], proof, acc, acc == top[-1][0]))
    return out


SHAPES = {
    "one": [(1, "a", "en", 3, "Abc")],
    "odd": [(None, None, None, None, None), (None, "a", "en", 0, ""), (5, "a", "en", 3, "ABC"), (5, "a", "en", 3, "ABC"), (5, "a", "en", 4, "ABCD"), (6, "", "é", 1, "É"), (7, "ü", None, None, "long Text " * 50_000)],
    "runs": [(i, f"s{i % 3}" if i > 2 else None, "en", i, f"Text {i}") for i in range(3 * 257)],
    "many sources": [(i, f"s{i % 300}" if i < 900 else "hot", "en", i, f"Text {i}") for i in range(1800)],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_manifest_equals_brute_force(spark, shape):
    rows = SHAPES[shape]
    got = merkle.manifest(frame(spark, rows).repartition(5))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_manifest(rows), key=repr)


def test_manifest_across_spans(spark, monkeypatch):
    """Nodes near the root are copied to several spans; proofs stay the same."""
    monkeypatch.setattr(merkle, "SPAN", 32)
    rows = SHAPES["many sources"]
    assert sorted(map(tuple, merkle.manifest(frame(spark, rows)).collect()), key=repr) == sorted(brute_manifest(rows), key=repr)


def test_manifest_of_nothing(spark):
    assert merkle.manifest(frame(spark, [])).collect() == []


def test_a_changed_row_changes_the_root(spark):
    rows = SHAPES["runs"]
    changed = [(*r[:4], r[4] + "!") if r[0] == 400 else r for r in rows]
    roots = {merkle.manifest(frame(spark, x)).first()["root"] for x in (rows, changed)}
    assert len(roots) == 2


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_features(text):
    words = WORDS.findall((text or "").translate(PLAIN))
    return words, [crc32(f.encode()) % 10000 for f in [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]]


def brute_resample(docs, target):
    made = [(i, *brute_features(t)) for i, t in docs]
    s = np.bincount([b for *_, f in made for b in f], minlength=10000)
    t = np.bincount([b for x in target for b in brute_features(x)[1]], minlength=10000)
    gain = [math.floor(1000 * math.log((int(t[b]) + 1) * (int(s.sum()) + 10000) / ((int(s[b]) + 1) * (int(t.sum()) + 10000)))) for b in range(10000)]
    rows = []
    for i, words, f in made:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    may = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(may[: len(may) * 25 // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


def texts(n):
    rng = np.random.default_rng(3)
    vocabulary = ["Word", "été", "x1", "ß", "日本", "a\u0000b", "THE", "of", "q-r", "it's", "🙂"]
    return [(int(i), "en", "s", 0, " ".join(rng.choice(vocabulary, rng.integers(0, 60)))) for i in rng.integers(0, 2 * n, n)]


def test_resample_equals_brute_force(spark, monkeypatch):
    rows = [*((i, s, g, c, t) for i, s, g, c, t in texts(300)), (None, None, None, None, "no id " * 30), (None, None, None, None, None), (3, None, None, None, ""), (4, None, None, None, "A long, Long text. " * 60_000), (4, None, None, None, "A long, Long text. " * 60_000)]
    target = ["the word of été", None, "", "x1 x1 x1"]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    want = sorted(brute_resample([(r[0], r[4]) for r in rows], target), key=repr)
    got = resample.resample(frame(spark, rows).repartition(7), bench)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes[1:]} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=repr) == want
    none = bench.where("false")
    assert sorted(map(tuple, resample.resample(frame(spark, rows), none).collect()), key=repr) == sorted(brute_resample([(r[0], r[4]) for r in rows], []), key=repr)
    assert resample.resample(frame(spark, []), bench).collect() == []


def test_features_do_not_depend_on_pieces(monkeypatch):
    for text in ("", "a", "one two three four five six " * 9, "é" * 50 + " b c", " . a . "):
        whole = sorted(np.concatenate([np.zeros(0, int), *resample.features(text)]).tolist())
        signs = nbsvm.indicators(text).tolist()
        assert whole == sorted(brute_features(text)[1])
        for size in (1, 3, 8, 40):
            monkeypatch.setattr(resample, "_PIECE", size)
            monkeypatch.setattr(nbsvm, "_PIECE", size)
            assert whole == sorted(np.concatenate([np.zeros(0, int), *resample.features(text)]).tolist())
            assert signs == nbsvm.indicators(text).tolist()
            monkeypatch.undo()


def test_repetition_and_shouting_are_seen():
    seen = lambda t: set(nbsvm.indicators(t).tolist())
    assert len(seen("qa qa qa qa") & seen("xu xu xu xu")) > len(seen("qa re vi lo") & seen("xu le po ti")) + 3
    assert len(seen("ABC!! DEF!!") & seen("GHI!! JKL!!")) == 2 and len(seen("a b")) == len(seen("A B"))


def test_dual_descent_reaches_the_optimum():
    """No small change of the weights lowers the hinge loss and its penalty; both classes cost the same."""
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 60, 12)).astype(np.int32) for _ in range(80)]
    good = np.array([int(r[0] % 3 == 0) for r in rows])
    ratios = nbsvm.log_count_ratios(rows, good)
    counts = [sum(17 in r for r, g in zip(rows, good) if g == k) + 1 for k in (0, 1)]
    totals = [sum(len(r) for r, g in zip(rows, good) if g == k) + nbsvm.BUCKETS for k in (0, 1)]
    assert ratios[17] == pytest.approx(math.log(counts[1] / totals[1]) - math.log(counts[0] / totals[0]))
    w = nbsvm.dual_descent(rows, ratios, good, epochs=3000, tolerance=1e-6)
    x = np.zeros((80, 61))
    for i, r in enumerate(rows):
        x[i, r], x[i, 60] = ratios[r] / len(r) ** 0.5, 1
    y, cost = np.where(good, 1, -1), 40 / np.where(good, good.sum(), 80 - good.sum())
    loss = lambda v: v @ v / 2 + (cost * np.maximum(0, 1 - y * (x @ v))).sum()
    small = np.append(w[:60], w[-1])
    assert not w[60:-1].any()
    for _ in range(300):
        assert loss(small + rng.standard_normal(61) * 10.0 ** -rng.integers(1, 5)) >= loss(small) - 1e-4


def test_rows_of_many_buckets_are_held_as_bits():
    ids = np.arange(0, nbsvm.BUCKETS, 3, dtype=np.int32)
    seen = np.zeros(nbsvm.BUCKETS, bool)
    seen[ids] = True
    row = nbsvm._row(zlib.compress(np.packbits(seen).tobytes()))
    assert row.dtype == np.uint8 and (nbsvm._ids(row) == ids).all() and nbsvm._row(zlib.compress(np.packbits(seen & False).tobytes())).dtype == np.int32


def test_quality_of_held_out_documents(spark):
    folder = SMALL.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    got = nbsvm.classify(docs, labels, sample=800)
    judged = [(r["quality"], r["predicted"], r["score"]) for r in got.where("held_out").join(labels, "doc_id").collect()]
    assert len(judged) > 700
    bad, good = ([p for q, p, _ in judged if q == k] for k in (0, 1))
    assert sum(good) > 0.99 * len(good) and sum(bad) < 0.05 * len(bad)
    # scores are shares: mean score and share of class 1 agree
    assert abs(np.mean([s for *_, s in judged]) - len(good) / len(judged)) < 0.03
    assert got.count() == docs.count()


def test_quality_of_odd_rows(spark):
    rows = [(i, None, None, None, ("fine words of a text " + str(i)) if i % 2 else "BUY!! NOW!! " * 5) for i in range(60)]
    odd = [(None, None, None, None, "fine words of a text"), (900, None, None, None, None), (901, None, None, None, ""), (902, None, None, None, "  \n "), (7, None, None, None, "fine words again"), (7, None, None, None, "fine words again"), (903, None, None, None, "word and more words " * 60_000)]
    docs = frame(spark, rows + odd).repartition(3)
    labels = [(i, i % 2) for i in range(60)] + [(i, i % 2) for i in range(60)] + [(8, 1), (None, 1), (9, None), (11, 7), (5000, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    got = nbsvm.classify(docs, labels).collect()
    assert len(got) == len(rows + odd) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["predicted"] == i % 2 for i in range(60)) and by_id[None]["predicted"] == 1 and not by_id[None]["held_out"]
    assert by_id[900]["score"] == by_id[901]["score"] == by_id[902]["score"]
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    # a label that contradicts another teaches nothing: 8 has both
    known = {r["id"] for r in nbsvm.labelled(docs, labels, "doc_id", "quality").collect()}
    assert 8 not in known and 5000 not in known and known == {i for i in range(60) if crc32(str(i).encode()) % 5 and i != 8}
    assert nbsvm.classify(frame(spark, []), labels).collect() == []
    shares = {round(r["score"], 3) for r in nbsvm.classify(docs, labels.where("quality = 1")).collect()}
    assert len(shares) == 1 and shares.pop() > 0.9
    assert {r["score"] for r in nbsvm.classify(docs, labels.where("false")).collect()} == {0.5}


def test_empty_partitions_and_repeated_labels(spark):
    docs = frame(spark, [(i, None, None, None, "a b c") for i in range(3)]).repartition(9)
    assert resample.bucket_counts(docs, "text").sum() == 15
    assert resample.weighed(docs, np.full(resample.BUCKETS, -3), "doc_id", "text").agg(F.min("weight"), F.max("weight")).first() == (-3, -3)
