"""Brute-force, round-trip and edge-case tests of the operators over documents."""

import hashlib
import random
import re

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from voxelloom.llm import decontam, langcodes, linededup, piecetable, simhash
from voxelloom.llm.components import components
from voxelloom.llm.queries import PIECE_MODEL

SMALL = "/root/testdata/sf0.001"
LONG = "word and another one " * 20_000
DOCS = [(1, "Ab c d e"), (2, None), (3, ""), (4, "  \n \t"), (5, LONG), (5, LONG), (6, "ab C d e"), (7, "é\u0000\n▁x  y   "), (None, "no id here at all")]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empties, a long text, ties, repeated rows and clashing extra columns."""
    rows = [(i, t, "en", f"s{k}", len(t or ""), 1, 2, "x") for k, (i, t) in enumerate(DOCS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, k1 int, fp int, row string")


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


def test_pieces_equal_the_library():
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    table = piecetable.PieceTable(piecetable.load_model(PIECE_MODEL))
    rng = random.Random(1)
    alphabet = [" ", "  ", "a", "b", "e", "the", "ing", "\n", "▁", "é", "日本", "😀", "\t", "0", "aaaa", " " * 17, "</s>", "ß", "tion", "s", "\u0000", "ll"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        ids = lib.encode(text, add_eos=True)
        assert table.encode_text(text) == " ".join(map(str, ids)), text
        assert table.decode(ids) == table.decode_text(" ".join(map(str, ids))) == lib.decode(ids), text
    for _ in range(100):
        text = "".join(rng.choice(alphabet) for _ in range(3000))
        ids = lib.encode(text, add_eos=True)
        assert table.encode(text) == ids and table.decode_text(table.encode_text(text)) == lib.decode(ids)
    for _ in range(1000):
        ids = [rng.randrange(lib.get_piece_size()) if rng.random() < 0.5 else rng.randrange(260) for _ in range(rng.randint(0, 8))]
        assert table.decode(ids) == lib.decode(ids), ids
        assert not ids or table.decode_text(" ".join(map(str, ids))) == lib.decode(ids), ids


def test_encode_decode_rows(docs, spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    got = piecetable.encode_decode(docs, PIECE_MODEL, keep_ids=True, keep_text=True).collect()
    assert len(got) == len(DOCS)
    for (i, text), r in zip(DOCS, got):
        ids = lib.encode(text or "", add_eos=True)
        assert (r["doc_id"], r["n_tokens"], r["ids"]) == (i, len(ids), ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
        assert r["decoded"] == lib.decode(ids)
    assert piecetable.encode_decode(docs.limit(0), PIECE_MODEL).count() == 0
    back = piecetable.decode_ids(spark.createDataFrame([([264, 2],), (None,)], "ids array<int>"), PIECE_MODEL)
    assert [r["decoded"] for r in back.collect()] == ["a", None]


def test_other_models_are_refused():
    with pytest.raises(Exception):
        piecetable.PieceTable(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())


def _plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]), 42) for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _plain_components(ids, linked):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if linked(a, b) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def test_simhash_brute_force(spark, small):
    base = [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").limit(60).collect()]
    words = " ".join(t for _, t in base[:5]).split()
    near = [(1000 + k, " ".join(words[:400] + [f"x{k}"] + words[400:800])) for k in range(25)]
    rows = base + near + [(2000, None), (2001, ""), (2002, " \n")]
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    fps = {i: _plain_fingerprint(t) for i, t in rows}
    label = _plain_components(list(fps), lambda a, b: bin(fps[a] ^ fps[b]).count("1") <= 2)
    assert got == {i: (f"{fps[i]:016x}", label[i]) for i in fps}
    assert len({label[i] for i, _ in near}) < len(near)


def test_simhash_close_links_are_exact(spark):
    rng = np.random.default_rng(5)
    fps = np.unique(np.concatenate([rng.integers(0, 2**63, 300, np.uint64)] + [np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 60, np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 60, np.uint64))]))
    table = spark.createDataFrame([(int(f.astype(np.int64)), i) for i, f in enumerate(fps)], "fp long, rep long")
    found = components(simhash.close_links(table), "a", "b").collect()
    ids = list(range(len(fps)))
    label = _plain_components(ids, lambda a, b: int(np.bitwise_count(fps[a] ^ fps[b])) <= 2)
    got = {i: i for i in ids} | {r["node"]: r["component"] for r in found}
    assert got == label


def test_simhash_edges(docs):
    got = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert {c for (i, f), c in got.items() if i in (2, 3, 4)} == {2} and {f for (i, f) in got if i == 2} == {"0" * 16}
    assert {c for (i, f), c in got.items() if i in (1, 6)} == {1}
    assert simhash.near_duplicates(docs).count() == len(DOCS)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_components_chain_and_hub(spark):
    chain = [(k, k + 1) for k in range(100, 150)] + [(7, 200 + k) for k in range(40)] + [(3, 3), (None, 4), (9, 8), (9, 8)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {k: 100 for k in range(100, 151)} | {7: 7} | {200 + k: 7 for k in range(40)} | {8: 8, 9: 8}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


LINE = "This is a repeated line of far more than forty code points. "


def _plain_lines(rows):
    holders, space = {}, linededup.SPACE
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(space))
    for i, t in rows:
        for x in set((t or "").split("\n")):
            if len(key(x)) >= 40 and i is not None:
                holders.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key(x), ())) < 5 or i == max(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup_brute_force(spark):
    rows = [(k, f"own {k}\n\t{LINE if k % 2 else LINE.upper()}\nshort\n{LINE}\u00e9") for k in range(8)] + [(20, None), (21, ""), (None, LINE), (7, LINE), (30, "x" * 500_000)]
    table = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, k1 int, n_lines string")
    got = linededup.dedup_lines(table, keep=("k1", "n_lines")).collect()
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got), key=str) == _plain_lines(rows)
    assert {tuple(r["row"]) for r in got} == {(1, "z")}
    assert linededup.dedup_lines(table.limit(0)).count() == 0


def test_line_store_is_reversible(spark):
    make = lambda ids: spark.createDataFrame([(i, f"{LINE}\nline only of document number {i} and of no other one") for i in ids], "id long, text string")
    store = linededup.LineStore(spark, shards=2)
    store.insert(make(range(4)))
    held = lambda df: sorted(tuple(r) for r in df.collect())
    counts, refs, filters = held(store.counts), held(store.refs), store.filters.count()
    assert filters == 0 and store.dropped().count() == 0
    store.insert(make(range(3, 9)))
    assert {r["doc_id"] for r in store.dropped().collect()} == set(range(8))
    whole = linededup.LineStore(spark, shards=2)
    whole.insert(make(range(9)))
    assert held(whole.counts) == held(store.counts) and held(whole.refs) == held(store.refs)
    store.delete(spark.createDataFrame([(i,) for i in range(4, 9)], "id long"))
    assert (held(store.counts), held(store.refs)) == (counts, refs) and store.dropped().count() == 0
    assert all(not np.frombuffer(r["buckets"], np.uint16).any() for r in store.filters.collect())


def test_line_store_outgrows_its_filters(spark):
    """A shard whose filter overflows gets a larger one; no filter is left that passes everything."""
    lines = [f"repeated line number {k} of far more than forty code points" for k in range(3000)]
    make = lambda ids, text: spark.createDataFrame([(i, text) for i in ids], "id long, text string")
    store = linededup.LineStore(spark, shards=1)
    store.insert(make(range(5), "\n".join(lines[:10])))
    before = len(store.filters.first()["buckets"])
    store.insert(make(range(10, 16), "\n".join(lines)))
    filters = store.filters.collect()
    assert len(filters) == 1 and not filters[0]["full"] and len(filters[0]["buckets"]) > before
    kept = store._perhaps(store.refs.unionByName(store.refs.withColumn("k2", F.xxhash64("k2"))))
    assert store.refs.count() <= kept.count() < 1.05 * store.refs.count()
    assert {r["doc_id"]: len(r["keys"]) for r in store.dropped().collect()} == {**{k: 10 for k in range(5)}, **{k: 3000 for k in range(10, 15)}}


def test_cuckoo_filter():
    rng = np.random.default_rng(3)
    keys = rng.integers(-(2**63), 2**63, 5000)
    one = linededup.Cuckoo.sized(len(keys))
    one.add(keys)
    assert not one.full and one.holds(keys).all()
    assert one.holds(rng.integers(-(2**63), 2**63, 5000)).mean() < 0.01
    one.remove(keys)
    assert not one.slots.any()
    small = linededup.Cuckoo.sized(1)
    small.add(keys)
    assert small.full and small.holds(keys).all()
    assert not linededup.Cuckoo.of(keys).full and not linededup.Cuckoo.of(keys[:0]).full


def test_language_codes():
    for n in (2, 3, 4, 6):
        code = langcodes.code_matrix(n)
        assert code.shape == (n, 2 ** (n - 1) - 1)
        assert min((a != b).sum() for i, a in enumerate(code) for b in code[:i]) == max(1, 2 ** (n - 2))
    assert langcodes.code_matrix(40).shape == (40, int(np.ceil(10 * np.log2(40))))


def test_language_held_out_accuracy(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langcodes.identify(table, keep=("lang",))
    total, right = got.where("held_out").agg(F.count("*"), F.sum((F.col("row.lang") == F.col("lang_pred")).cast("int"))).first()
    assert total > 250 and right / total > 0.98
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got.select("doc_id", "held_out").collect())


def test_language_codes_equal_plain_ones(spark, small):
    """Counting, bit classifiers, their calibration and decoding once more, with dictionaries and loops, learned from every row that isn't held out."""
    import math
    import zlib

    rows = [(r["doc_id"], r["lang"], r["text"]) for r in small.where("doc_id < 400").collect()]
    table = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = {r["doc_id"]: r for r in langcodes.identify(table, sample=10**9).collect()}

    def grams(text):
        raw = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in f" {text.lower()} ".encode()]
        for a, b, c in zip(raw, raw[1:], raw[2:]):
            if b != 32:
                yield (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) % 2**32 >> 17

    learned = [(lang, list(grams(t))) for i, lang, t in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    langs = sorted({lang for lang, _ in learned})
    counts = {lang: [0.5] * langcodes.BUCKETS for lang in langs}
    for lang, text in learned:
        for g in text:
            counts[lang][g] += 1
    rates = {}
    for lang, c in counts.items():
        total = sum(c)
        rates[lang] = [x / total for x in c]
    # every split of the languages, the first of them always on the positive side
    bits = [{langs[0]} | {x for k, x in enumerate(langs[1:]) if n >> k & 1} for n in range(2 ** (len(langs) - 1) - 1)]
    mean = lambda xs: sum(xs) / len(xs)
    weights = [[math.log(mean([rates[x][g] for x in bit])) - math.log(mean([rates[x][g] for x in langs if x not in bit])) for g in range(langcodes.BUCKETS)] for bit in bits]
    margin = lambda text, w: sum(w[g] for g in text) / max(len(text), 1)
    fits = []
    for bit, w in zip(bits, weights):
        x, y = [margin(t, w) for _, t in learned], [float(lang in bit) for lang, _ in learned]
        spread = float(np.std(x)) or 1.0
        a = b = 0.0
        for _ in range(25):
            p = [1 / (1 + math.exp(-min(max(a * v / spread + b, -30), 30))) for v in x]
            ga, gb = sum((k - q) * v / spread for k, q, v in zip(y, p, x)) - 0.01 * a, sum(k - q for k, q in zip(y, p)) - 0.01 * b
            haa, hab, hbb = sum(q * (1 - q) * (v / spread) ** 2 for q, v in zip(p, x)) + 0.01, sum(q * (1 - q) * v / spread for q, v in zip(p, x)), sum(q * (1 - q) for q in p) + 0.01
            det = haa * hbb - hab * hab
            a, b = a + (hbb * ga - hab * gb) / det, b + (haa * gb - hab * ga) / det
        right = mean([float((a / spread * v + b > 0) == (k > 0)) for v, k in zip(x, y)])
        fits.append((a / spread, b, min(max(2 * right - 1, 0.05), 1)))
    for i, _, text in rows:
        if not (text and re.search(r"[^\W\d_]", text)):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0)
            continue
        t = list(grams(text))
        z = [a * margin(t, w) + b for (a, b, _), w in zip(fits, weights)]
        loss = {x: sum(trust * math.log1p(math.exp(-v if x in bit else v)) for v, (_, _, trust), bit in zip(z, fits, bits)) for x in langs}
        best = min(loss, key=loss.get)
        assert got[i]["lang_pred"] == best and abs(got[i]["score"] - 1 / sum(math.exp(loss[best] - v) for v in loss.values())) < 1e-3, i


def test_language_edges(docs, spark):
    got = langcodes.identify(docs).collect()
    assert len(got) == len(DOCS) and {r["lang_pred"] for r in got if r["doc_id"] in (2, 3, 4)} == {"und"}
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 5)} == {"en"} and all(0 <= r["score"] <= 1 for r in got)
    assert langcodes.identify(docs.limit(0)).count() == 0
    nothing = langcodes.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


def test_two_thousand_languages(spark):
    """As many languages as there are words of three letters here: planned, learned and told apart."""
    letters = "abcdefghijklm"
    names = [a + b + c for a in letters for b in letters for c in letters][:2000]
    rows = [(k, f"{n} {n}{n} " * 3, n) for k, n in enumerate(names)]
    rows += [(len(names) + k, f"{n} {n}{n} " * 3, n) for k, n in enumerate(names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langcodes.identify(docs, keep=("lang",)).select("held_out", "lang_pred", F.col("row.lang").alias("lang")).collect()
    learned = {r["lang"] for r in got if not r["held_out"]}
    assert len(got) == 4000 and len(learned) > 1700
    assert sum(r["lang"] == r["lang_pred"] for r in got if r["lang"] in learned) > 0.9 * sum(r["lang"] in learned for r in got)


def test_alignment_equals_plain_smith_waterman():
    rng = np.random.default_rng(2)
    for _ in range(200):
        p, q = rng.integers(0, 4, rng.integers(0, 12)), rng.integers(0, 4, rng.integers(1, 8))
        h = np.zeros((len(q) + 1, len(p) + 1), int)
        for i in range(len(q)):
            for j in range(len(p)):
                h[i + 1, j + 1] = max(0, h[i, j] + (1 if q[i] == p[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert decontam.align(p, q)[0] == h.max()


def test_span_equals_plain_traceback():
    """(score, - equal words) of every alignment as plain tuples; long items in linear memory."""
    rng = np.random.default_rng(5)
    for _ in range(300):
        p, q = rng.integers(0, 5, rng.integers(1, 25)), rng.integers(0, 5, rng.integers(1, 20))
        h = [[(0, 0)] * (len(p) + 1) for _ in range(len(q) + 1)]
        for i in range(len(q)):
            for j in range(len(p)):
                same = q[i] == p[j]
                ways = [(0, 0), (h[i][j][0] + (1 if same else -1), h[i][j][1] - same), (h[i][j + 1][0] - 1, h[i][j + 1][1]), (h[i + 1][j][0] - 1, h[i + 1][j][1])]
                h[i + 1][j + 1] = max(ways)
        score, equal = max(x for row in h for x in row)
        assert decontam.span(p, q) == (-equal, -2 * equal - score)
    words = np.arange(8_000).astype(np.uint64)
    assert decontam.judged(np.concatenate([words[:100], words, words[:50]]), words) == (1.0, 100, 8_100)


def test_decontamination_copies_edits_and_clean(spark, small):
    items = [(1, "the quick brown fox jumps over the lazy dog while seven wizards quietly box with jugs of liquid"), (2, None), (3, ""), (4, "two words")]
    words = items[0][1].split()
    noise = " ".join(r["text"] for r in small.select("text").limit(3).collect())
    edited = [w if k % 7 else "edited" for k, w in enumerate(words)]
    rows = [
        (10, noise + " " + items[0][1].upper() + " " + noise),
        (11, "start " + " ".join(edited) + " end"),
        (12, " ".join(words[:5]) + " something else altogether"),
        (13, None),
        (14, ""),
        (15, noise),
        (16, "holds two words here"),
        (10, items[0][1]),
    ]
    table = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontam.contaminated(table, bench).collect()}
    assert set(got) == {(10, 1), (11, 1), (16, 4)}
    assert got[(10, 1)]["score"] == 1 and got[(10, 1)]["first_word"] == 0 and got[(10, 1)]["last_word"] == len(words)
    assert 0.6 <= got[(11, 1)]["score"] < 1
    assert {r["doc_id"] for r in decontam.clean(table, bench).collect()} == {12, 13, 14, 15}
    assert decontam.contaminated(table.limit(0), bench).count() == 0 and decontam.contaminated(table, bench.limit(0)).count() == 0


def test_edited_copies_are_found_beside_many_whole_ones(spark, small):
    item = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa"
    words = item.split()
    noise = [r["text"] for r in small.select("text").limit(40).collect()]
    rows = [(k, f"{noise[k]} {item} {noise[-k]}") for k in range(30)]
    for shift in range(5):
        edited = [w if (k + shift) % 5 else f"other{k}" for k, w in enumerate(words)]
        rows.append((100 + shift, f"{noise[30 + shift]} {' '.join(edited)} end"))
    rows += [(0, item), (50, noise[35])]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"] for r in decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {i for i, _ in rows} - {50}


@pytest.mark.parametrize("length", [15, 40, 59])
def test_length_does_not_decide_what_is_a_copy(spark, small, length):
    words = [f"w{length}x{k}" for k in range(length)]
    noise = [r["text"] for r in small.select("text").limit(8).collect()]
    rows = [(10 * shift, f"{noise[shift]} {' '.join(w if (k + shift) % 4 else f'other{k}' for k, w in enumerate(words))} end") for shift in range(4)]
    rows += [(1, f"{noise[4]} {' '.join(words[: length // 2])} {noise[5]}"), (2, f"{noise[5]} {' '.join(words[length // 2 :])} {noise[4]}")]
    rows += [(3, noise[6]), (4, f"{noise[7]} {' '.join(words[: length // 4])} {noise[6]}")]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    got = {r["doc_id"]: r["score"] for r in decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert set(got) == {i for i, _ in rows} - {3, 4}
    assert got[1] == got[2] == 1 and all(0.7 <= got[10 * shift] < 1 for shift in range(4))


@pytest.mark.parametrize("broadcast", [4_000_000, 10])
def test_decontamination_finds_every_planted_item(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontam, "BROADCAST_NGRAMS", broadcast)
    monkeypatch.setattr(decontam, "BITS", 20)
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    truth = {(d["doc_id"], b["item_id"]) for d in docs.collect() for b in bench.collect() if b["text"] in d["text"]}
    assert truth == {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()}


def test_decontamination_recall_of_edits_against_all_pairs(spark, small):
    """Every fourth to seventh word replaced, dropped or swapped with the next: nine in ten of what aligning all pairs finds are found, and nothing else."""
    rng = random.Random(8)
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").limit(20).collect()]
    noise = [" ".join(r["text"].split()[:120]) for r in small.select("text").limit(40).collect()]
    rows = [(k, x) for k, x in enumerate(noise)]
    for i, text in bench:
        for every in (4, 5, 6, 7):
            for edit in ("replace", "drop", "swap"):
                words, k = text.split(), rng.randrange(every)
                while k < len(words):
                    if edit == "replace":
                        words[k] = f"other{rng.randrange(1000)}"
                    elif edit == "drop":
                        words[k] = ""
                    elif k + 1 < len(words):
                        words[k], words[k + 1] = words[k + 1], words[k]
                    k += every
                rows.append((len(rows), f"{rng.choice(noise)} {' '.join(words)} {rng.choice(noise)}"))
    hashes = {i: decontam.word_hashes(t) for i, t in bench}
    truth = {(d, i) for d, t in rows for w in [decontam.word_hashes(t)] for i, q in hashes.items() if decontam.judged(w, q)}
    found = decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert len(truth) > 200 and len(got & truth) >= 0.9 * len(truth) and got <= truth, (len(truth), len(got & truth), got - truth)


def test_pipeline_stages_against_brute_force(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120).cache()
    texts = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    stages = dict(pipeline.STAGES)
    first = stages["language_id"](spark, docs, sf_dir)
    assert first.columns == docs.columns and texts(first) == {i: t for i, t in texts(docs).items() if t and re.search(r"[^\W\d_]", t)}
    second = stages["line_dedup"](spark, docs, sf_dir)
    assert texts(second) == {i: t for i, _, _, t in _plain_lines(list(texts(docs).items()))} and second.columns == docs.columns
    fps = {i: _plain_fingerprint(t) for i, t in texts(docs).items()}
    label = _plain_components(list(fps), lambda a, b: bin(fps[a] ^ fps[b]).count("1") <= 2)
    assert set(texts(stages["simhash_near_dedup"](spark, docs, sf_dir))) == {i for i in fps if label[i] == i}
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert set(texts(stages["decontamination"](spark, docs, sf_dir))) == {i for i, t in texts(docs).items() if not any(x in t for x in items)}
    last = stages["sentencepiece"](spark, docs, sf_dir)
    assert last.count() == docs.count()
    done = pipeline.run(spark, sf_dir)
    assert 0 < done.count() <= spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Null ids and texts, repeated rows, extra columns with clashing names, empty tables."""
    pipeline = pytest.importorskip("corpus_pipeline")
    base = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").where("lang = 'en' and n_chars > 800").orderBy("doc_id").limit(6).collect()]
    rows = [(1, base[0]), (1, base[0]), (1, base[1]), (2, base[1]), (2, base[2]), (3, base[2]), (4, None), (5, ""), (None, base[3]), (None, base[3]), (6, base[4]), (7, base[4])]
    table = spark.createDataFrame([(i, t, "en", f"s{k}", len(t or ""), k, 1, "r") for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, id int, mark int, row string")
    kept = pipeline.near_dedup(spark, table, "")
    assert kept.columns == table.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(str, [(1, base[0]), (1, base[1]), (2, base[2]), (4, None), (None, base[3]), (None, base[3]), (6, base[4])]))
    assert kept.where("doc_id = 1").agg(F.min("id")).first()[0] == 0
    for name, frame in (("odd", table), ("none", table.limit(0))):
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        got = pipeline.run(spark, f"{tmp_path}/{name}")
        assert sorted(map(str, (r["doc_id"] for r in got.collect()))) == (["1", "1", "2", "6", "None", "None"] if name == "odd" else [])
