"""Tests of the operators over pages, conversations and embeddings."""

import base64
import hashlib
import random
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelloom.llm import hostrep, preference, projpass, warc, wrapper
from voxelloom.llm.queries import ORACLE_SQL, QUERIES, RULES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    df = QUERIES[name](spark, SMALL)
    rel = con.execute(ORACLE_SQL[name])
    order = [[c[0] for c in rel.description].index(c) for c in df.columns]
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(str(tuple(r[i] for i in order)) for r in rel.fetchall())


URLS = [
    ("https://a.Example.NET/en/x?y#z", "a.example.net", "/en/x", "example.net/en/"),
    ("http://example.net/fr", "example.net", "/fr", "net/"),
    ("http://net", "net", "", None),
    ("http://net/", "net", "/", "net/"),
    ("http://badexample.com/de/", "badexample.com", "/de/", None),
    ("http://example.com/de/q://r/s", "example.com", "/de/q://r/s", "example.com/de/"),
    ("x://h.org?a/fr/", "h.org", "", None),
    ("//nohost/p", "", "", None),
    (None, "", "", None),
    ("", "", "", None),
    ("http://a.org/fr/\nb?c", "a.org", "/fr/\nb", "org/fr/"),
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(k, u[0], 1) for k, u in enumerate(URLS)] + [(None, "http://n.net/", 1), (0, URLS[0][0], 1)], "page_id long, url string, host int")
    labels = spark.createDataFrame([(2, 0, 1), (2, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got = hostrep.judge(pages, labels, RULES).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        if r["page_id"] is not None:
            assert (r["host"], r["path"], r["rule"]) == URLS[r["page_id"]][1:], r
    assert hostrep.judge(pages.limit(0), labels, RULES).count() == 0
    assert hostrep.judge(pages, labels.limit(0), []).count() == len(URLS) + 2


def test_reputation_shrinks_and_blocks(spark):
    hosts = [("bad.a.com", 100, 90), ("new.a.com", 0, 0), ("one.a.com", 1, 1), ("good.b.com", 400, 4), ("c.d.org", 300, 6), ("", 5, 0)]
    got = {r["host"]: r for r in hostrep.reputation(spark.createDataFrame(hosts, "host string, n long, bad long")).collect()}
    assert got["bad.a.com"]["bound"] > 0.5 and got["good.b.com"]["bound"] < 0.1
    assert got["good.b.com"]["bad_rate"] < got["new.a.com"]["bad_rate"] < got["one.a.com"]["bad_rate"] < 1
    assert got["one.a.com"]["bound"] < got["bad.a.com"]["bound"]


def test_domains_and_suffixes(spark):
    names = {"a.b.co.uk": ("co.uk", "b.co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.example.com": ("com", "example.com"), "u@example.net:8080": ("net", "example.net"), "com": ("com", "com"), "": ("", ""), "10.0.0.1:80": ("10.0.0.1", "10.0.0.1"), "a.tv.de": ("de", "tv.de")}
    table = spark.createDataFrame([(n,) for n in names], "host string").withColumn("site", hostrep.site(F.col("host"))).withColumn("suffix", hostrep.public_suffix(F.col("site"), hostrep.SECOND_LEVEL))
    assert {r["host"]: (r["suffix"], r["domain"]) for r in table.withColumn("domain", hostrep.registered_domain(F.col("site"), F.col("suffix"))).collect()} == names


def test_the_bound_blocks_where_no_rule_fits(spark):
    pages = spark.createDataFrame([(k, f"http://{'bad' if k < 60 else 'good'}.co.uk/p{k}") for k in range(160)] + [(200, "http://bad.co.uk/ok/x"), (201, None)], "page_id long, url string")
    labels = spark.createDataFrame([(k, int(k >= 60), 0) for k in range(160)], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: r for r in hostrep.judge(pages, labels, [hostrep.Rule("uk/ok/", "allow")]).collect()}
    assert all(got[k]["verdict"] == ("block" if k < 60 else "allow") and got[k]["rule"] is None for k in range(160))
    assert (got[200]["verdict"], got[200]["rule"], got[201]["verdict"]) == ("allow", "uk/ok/", "allow")


def test_many_rules(spark):
    pages = spark.createDataFrame([(k, f"http://h{k}.net/a/b{k % 3}") for k in range(3000)], "page_id long, url string")
    rules = spark.range(3000).select(F.concat(F.lit("h"), "id", F.lit(".NET/a/b1")).alias("name"), F.lit("block").alias("verdict"))
    got = hostrep.judge(pages, spark.createDataFrame([], "doc_id long, quality int, toxic int"), rules)
    assert got.where("verdict = 'block'").count() == 1000 and got.where("verdict = 'block' and page_id % 3 <> 1").count() == 0


def test_preference_prefix_and_masks(spark):
    turns = [
        (1, 0, "system", "S"), (1, 1, "user", "Hi"), (1, 2, "assistant", "Yes é"), (1, 3, "user", "x"),
        (2, 0, "system", "S"), (2, 1, "user", "Hi"), (2, 2, "assistant", "No"),
        (3, 0, "user", None), (3, 1, None, "b"), (3, 1, None, "b"),
    ]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("nth", F.lit(9))
    pairs = spark.createDataFrame([(7, 1, 2), (8, 3, 99), (9, 1, 1)], "pair_id long, chosen_id long, rejected_id long")
    got = {r["pair_id"]: r for r in preference.format_pairs(preference.attach_pairs(table, pairs)).collect()}
    r = got[7]
    assert (r["n_prefix"], r["prompt"]) == (2, "<|system|>\nS<|end|>\n<|user|>\nHi<|end|>\n")
    assert r["chosen"] == "<|assistant|>\nYes é<|end|>\n<|user|>\nx<|end|>\n" and r["rejected"] == "<|assistant|>\nNo<|end|>\n"
    assert [r["chosen"][a:b] for a, b in r["chosen_mask"]] == ["Yes é<|end|>\n"] and [r["rejected"][a:b] for a, b in r["rejected_mask"]] == ["No<|end|>\n"]
    assert (got[8]["n_prefix"], got[8]["rejected_id"], got[8]["rejected"], got[8]["prompt"]) == (0, None, "", "")
    assert got[8]["chosen"] == "<|user|>\n<|end|>\n" + "<|user|>\nb<|end|>\n" * 2
    assert (got[9]["n_prefix"], got[9]["chosen"], got[9]["chosen_mask"]) == (4, "", [])
    assert preference.format_pairs(preference.attach_pairs(table, pairs.limit(0))).count() == 0


def _digest(html):
    return base64.b32encode(hashlib.sha1(html if isinstance(html, bytes) else (html or "").encode()).digest()).decode()


FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


@pytest.mark.parametrize("split", ["128m", "1k"])
def test_warc_rejects_magic_in_payloads(spark, tmp_path, split):
    rows = [(5, "u", "same é"), (3, "u", "same é"), (4, None, None), (9, "u\r\nX: y", ""), (10, "u", FAKE * 2), (11, "u", "a\r\n\r\n" + FAKE), (12, "u", "z" * 30_000), (12, "u", "other"), (None, "u", "no id"), (None, "u", "other")]
    rows += [(13, "u", "\r\n\r\n" + FAKE * 40 + "\r\n\r\nWARC/1." * 3), (14, "u", "x\r\n\r\nWARC/1.1\r\nContent-Length: 9999999\r\n\r\n")] + [(100 + k, "u", f"page {k} \n" * 30) for k in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        path = str(tmp_path / "w")
        got = {(r["page_id"], r["payload_digest"]): r for r in warc.round_trip(pages, path).collect()}
        assert len(got) == len(rows)
        for i, _, html in rows:
            r = got[(i, _digest(html))]
            assert r["payload_bytes"] == len((html or "").encode())
            wanted = {5: ("revisit", 3), 9: ("revisit", 4)}.get(i, ("response", None)) if i or html == "no id" else ("revisit", 12)
            assert (r["record_type"], r["refers_to"]) == wanted
        payloads = sorted(bytes(r["payload"]) for r in warc.read(spark, path).where("payload is not null").collect())
        assert payloads == sorted({(x or "").encode() for _, _, x in rows})
        chain = warc.candidates(spark, path)
        assert chain.count() > len(rows) + 40 and warc.reachable(chain).count() == len(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert warc.round_trip(pages, str(tmp_path / "m"), min_bytes=3).where("record_type = 'revisit'").count() == 2
    assert warc.round_trip(pages.limit(0), str(tmp_path / "e")).count() == 0


def test_warc_of_others(spark, tmp_path):
    """Bytes that are no UTF-8, other records, a broken chain, a record cut off, compressed members."""
    import gzip

    def record(kind, block, extra=""):
        return f"WARC/1.0\r\nwarc-type:{kind}\r\nWARC-Record-ID: <urn:x>\r\n{extra}content-length : {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n"
    body = bytes(range(256)) * 3
    records = [record("warcinfo", b"software: s\r\n"), record("response", http + body), record("response", b"no end of header"), record("request", b"GET /\r\n\r\n")]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.warc").write_bytes(b"".join(records))
    (tmp_path / "a" / "two.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "a" / "cut.warc").write_bytes(b"".join(records[:2])[:-200])
    (tmp_path / "a" / "broken.warc").write_bytes(records[0] + b"junk\r\n\r\n" + records[1])
    (tmp_path / "a" / "other.warc").write_bytes(b"junk\r\n\r\n" + records[1])
    got = {}
    with pytest.raises(ValueError, match=r"end of .*\.warc"):
        warc.read(spark, str(tmp_path / "a"))
    for r in warc.read(spark, str(tmp_path / "a"), broken="keep").orderBy("file", "pos").collect():
        got.setdefault(r["file"].rsplit("/", 1)[1], []).append((r["kind"], None if r["payload"] is None else bytes(r["payload"])))
    whole = [("warcinfo", None), ("response", body), ("response", b""), ("request", None)]
    assert got == {"one.warc": whole, "two.warc.gz": whole, "cut.warc": whole[:1], "broken.warc": whole[:1]}


def test_warc_finds_magic_wherever_a_buffer_ends(spark, tmp_path):
    """The next magic at every offset around a reader's buffer and a range's border, after payloads that end like a blank line."""

    def record(block):
        return f"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    want = {}
    for ending in (b"", b"\r", b"\r\n", b"\r\n\r\n", b"\r\n\r\n\r\n", b"\r\n\r\nWARC/1"):
        for at in range(65530, 65547):
            n = at - (len(record(b"x" * (at - 100))) - (at - 100))
            block = b"H\r\n\r\n" + b"x" * (n - 5 - len(ending)) + ending
            assert len(record(block)) == at
            blocks = [block, b"H\r\n\r\nb" + ending, b"H\r\n\r\nc" + ending]
            (tmp_path / f"{len(want)}.warc").write_bytes(b"".join(map(record, blocks)))
            want[f"{len(want)}.warc"] = [b[5:] for b in blocks]
    for size in ("128m", "65541", "20000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = {}
            for r in warc.read(spark, str(tmp_path)).orderBy("file", "pos").collect():
                got.setdefault(r["file"].rpartition("/")[2], []).append(bytes(r["payload"]))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert got == want, size


def test_warc_of_pages_that_end_like_blank_lines(spark, tmp_path):
    """Whole round trips of odd rows: nulls, empty and long pages, repeated rows, magic and blank lines, columns with clashing names."""
    texts = [None, "", "x" * 200_000, "x" * 65_400 + "\r\n", "</html>\r\n\r\n", "\r\n\r\nWARC/1.1\r\n", "WARC/1.", "\r\n\r\n" * 3, "é\r"]
    rows = [(i, f"http://h/{i}", t, "f", 1, 2, 3, "k") for i, t in enumerate(texts)] + [(3, "u", texts[3], "f", 1, 2, 3, "k"), (None, None, "no id\r\n", "f", 1, 2, 3, "k"), (None, None, None, "f", 1, 2, 3, "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, file string, range int, pos int, first_id int, digest string").repartition(2)
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages, str(tmp_path / "w")).collect()), key=repr)
    raw = [(r[0], (r[2] or "").encode()) for r in rows]
    first = {b: min((i for i, x in raw if x == b and i is not None), default=None) for _, b in raw}
    want = []
    for i, b in raw:
        again = first[b] is not None and i != first[b]
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", first[b] if again else None))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("bound", [0, 64 << 20])
def test_warc_rows_of_one_id_keep_their_payloads(spark, tmp_path, monkeypatch, bound):
    monkeypatch.setattr(warc, "BROADCAST_BYTES", bound)
    rows = [(5, "u", "same"), (3, "u", "same"), (5, "u", "other"), (7, "u", "third"), (8, "u", "same"), (8, "u", "third"), (9, "u", "other")]
    path = str(tmp_path / "w")
    got = sorted((r["page_id"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"), path).collect())
    first = {"same": 3, "other": 5, "third": 7}
    want = [(i, _digest(x), "response", None) if i == first[x] else (i, _digest(x), "revisit", first[x]) for i, _, x in rows]
    assert got == sorted(want, key=str) or got == sorted(want)
    assert sorted(bytes(r["payload"]) for r in warc.read(spark, path).where("payload is not null").collect()) == [b"other", b"same", b"third"]


HEAD = "<html><head><title>t</title><style>p{}</style></head><body><div class='menu'><a href=/>Home</a></div>"


def _page(k):
    return f"{HEAD}<div id=main><div class=post><h1>Title {k}</h1><p>Text {k} &amp; more words of page {k}<br>on two lines<p>Last {k}<p>Subscribe now for more of this</div><div class='comments'><p>said {k}</div></div><div class=side-bar>Links {k}</div><footer>f</footer></body></html>"


def test_wrapper_template_and_content(spark):
    rows = [(k, f"http://h.org/{k}", _page(k)) for k in range(14)] + [(20, "http://h.org/x", "<p>other layout &lt;here&gt;</p>"), (21, None, None), (22, "http://e.org", ""), (23, "http://h.org/0", _page(0))]
    got = {r["page_id"]: r for r in wrapper.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(3))).collect()}
    assert len(got) == len(rows)
    for k in range(14):
        assert got[k]["text"] == f"Title {k}\nText {k} & more words of page {k} on two lines\nLast {k}", got[k]["text"]
        assert got[k]["n_chars"] == len(got[k]["text"])
    assert got[20]["text"] == "other layout <here>" and got[21]["text"] == got[22]["text"] == ""
    assert wrapper.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_what_is_not_article(spark):
    page = "<body class=has-sidebar><article><p>Keep this text of the page.</p><div class='advertising-box'>x</div><p hidden>y</p><div style='display: none'>z</div><section id=commentlist>c</section><p>And  this.</p></article>"
    assert wrapper.extract(page, None) == "Keep this text of the page.\nAnd this."


BIG = "Body of page {0} that goes on and on with words of its own. " * 8


def _read(page, pages=range(14)):
    learned = wrapper.induce([page(k) for k in pages])
    return [wrapper.extract(page(k), learned) for k in pages]


def test_all_slot_regions_are_content():
    text = lambda k: " ".join(BIG.format(k).split())
    lead = _read(lambda k: f"{HEAD}<main><h1>Title {k}</h1><p>Lead {k}</p><div class=body>{BIG.format(k)}</div><p>All rights reserved</p></main></body>")
    assert lead == [f"Title {k}\nLead {k}\n{text(k)}" for k in range(14)]
    two = _read(lambda k: f"{HEAD}<div class=a>{BIG.format(k)}</div><div class=b>Second part {k} " + "of some more words " * 20 + "</div></body>")
    assert all(x.startswith(text(k) + f"\nSecond part {k} of") for k, x in enumerate(two))
    several = _read(lambda k: f"{HEAD}<article class=x><p>First {k}</p></article><article class=y><p>Next {k}</p></article><main><p>Then {k}</p></main></body>")
    assert several == [f"First {k}\nNext {k}\nThen {k}" for k in range(14)]
    assert wrapper.extract("<main><h1>T</h1><p>L</p><div>" + "b " * 200 + "</div></main>", None).startswith("T\nL\nb b")


@pytest.mark.parametrize("named", ["article class='post has-sidebar'", "div id=page class='no-comments'", "section class='social-history'", "div class='related-work'", "div data-title='the hidden truth'", "div class=comments", "form id=form1", "header"])
def test_names_do_not_decide_what_is_content(named):
    tag = named.split()[0]
    page = lambda k: f"{HEAD}<{named}><p>{BIG.format(k)}</p><div class='related-posts'>see {k}</div></{tag}><div class=sidebar>to {k}</div></body>"
    text = [" ".join(BIG.format(k).split()) for k in range(14)]
    assert _read(page) == text and wrapper.extract(page(3), None) == text[3]


def test_layouts_of_one_host(spark):
    rare = lambda k: f"<body><div class='menu'>Home</div><main><div><p>Start</p></div><div class=comments><p>{BIG.format(k)}</p></div></main></body>"
    own = lambda k: f"<body class='postid-{k}'><div class='wrap w{k}'><div>Follow us</div><article class='a{k}'><p>Word {k} of {k}</p></article><p>All rights reserved</p></div></body>"
    rows = [(k, "http://h.org/a", _page(k)) for k in range(400)] + [(1000 + k, "http://h.org/b", own(k)) for k in range(5)] + [(2000 + k, "http://h.org/c", rare(k)) for k in range(2)]
    rows += [(3000 + k, "http://small.org/", own(k)) for k in range(4)] + [(4000, "http://one.org/", own(7))]
    got = {r["page_id"]: r["text"] for r in wrapper.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    assert all(got[k].startswith(f"Title {k}\nText {k} &") and "Subscribe" not in got[k] for k in range(400))
    assert [got[1000 + k] for k in range(5)] == [f"Word {k} of {k}" for k in range(5)] and [got[3000 + k] for k in range(4)] == [f"Word {k} of {k}" for k in range(4)]
    assert [got[2000 + k] for k in range(2)] == [" ".join(BIG.format(k).split()) for k in range(2)]  # two pages agree on their start
    assert got[4000] == "Follow us\nWord 7 of 7\nAll rights reserved"


@pytest.mark.parametrize("n", [2, 9, 10, 50])
def test_unmarked_boilerplate_goes_from_two_pages_on(spark, n):
    """No tag or class tells what is boilerplate: the wrapper does, and without one it stays."""
    page = lambda k: f"<body><div><p>Site wide line number one.</p></div><div><p>Word {k}</p><p>Body of page {k} with text of its own.</p></div><div><p>The same everywhere.</p></div></body>"
    rows = [(k, f"http://h{n}.org/{k}", page(k)) for k in range(n)]
    got = {r["page_id"]: r["text"] for r in wrapper.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    own = {k: f"Word {k}\nBody of page {k} with text of its own." for k in range(n)}
    assert got == own
    assert all(wrapper.extract(page(k), None) == f"Site wide line number one.\n{own[k]}\nThe same everywhere." for k in range(n))


class _PlainBlocks(HTMLParser):
    """(path, text) of a well-formed page's blocks, by the standard library's parser."""

    def __init__(self, page):
        super().__init__()
        self.path, self.blocks = ["html"], [["html", ""]]
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        if tag not in ("b", "i"):
            self.path.append(tag)
            self.blocks.append(["/".join(self.path), ""])

    def handle_endtag(self, tag):
        if tag not in ("b", "i"):
            self.path.pop()
            self.blocks.append(["/".join(self.path), ""])

    def handle_data(self, data):
        self.blocks[-1][1] += data

    def found(self):
        return [(p, " ".join(t.split())) for p, t in self.blocks if t.strip()]


def test_templates_equal_plain_ones(spark):
    """Random pages without marks: what every page of a host holds at a path goes, all else stays; by another parser and plain sets."""
    rng = random.Random(4)
    rows = []
    for h in range(12):
        skeleton = [(rng.choice(["div", "section", "div/div", "div/ul"]), rng.random() < 0.5) for _ in range(rng.randint(3, 7))] + [("div", False)]
        for k in range(rng.choice([2, 3, 9, 12])):
            parts = []
            for n, (place, same) in enumerate(skeleton):
                outer = place.split("/")
                item = "li" if outer[-1] == "ul" else "p"
                inner = [f"The same line {n} &amp; <b>more</b> of host {h}"] if same else [f"Line {n} of {k} in part {m}, <i>its own</i> words {rng.random()}" for m in range(rng.randint(1, 4))]
                parts.append("".join(f"<{t}>" for t in outer) + "".join(f"<{item}>{x}</{item}>" for x in inner) + "".join(f"</{t}>" for t in reversed(outer)))
            rows.append((len(rows), f"http://host{h}.org/{k}", "<body>" + "\n".join(parts) + "</body>"))
    hosts = {}
    for i, url, page in rows:
        hosts.setdefault(url.split("/")[2], {})[i] = _PlainBlocks(page).found()
    want = {}
    for pages in hosts.values():
        constant = set.intersection(*(set(b) for b in pages.values()))
        want |= {i: "\n".join(t for p, t in blocks if (p, t) not in constant) for i, blocks in pages.items()}
    got = {r["page_id"]: r["text"] for r in wrapper.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {i for i in want if got[i] != want[i]} == set() and sum("The same" in page for _, _, page in rows) > len(rows) / 2


def test_wrappers_joined_instead_of_broadcast(spark, monkeypatch):
    rows = [(k, f"http://h{k % 3}.org/{k}", _page(k)) for k in range(30)] + [(100, None, None), (101, "http://h1.org/z", "<p>alone</p>"), (5, "http://h2.org/5", _page(5))]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted(map(tuple, wrapper.main_text(table).fillna("").collect()))
    monkeypatch.setattr(wrapper, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, wrapper.main_text(table).fillna("").collect())) == want


def test_wide_pages_are_learned_in_a_second():
    import time

    wide = lambda k: "<body><div>" + "".join(f"<h2>H{i} of {k}</h2><p>P{i} of {k}</p>" for i in range(5000)) + "<p>Same</p></div></body>"
    many = lambda k: "<body><div>" + "".join(f"<p class=c{i}>P{i} of {k}</p>" for i in range(3000)) + "</div></body>"
    for page in (wide, many):
        pages = [page(k) for k in range(2)]
        trees = [wrapper.Folded(wrapper.parse(x), k) for k, x in enumerate(pages)]
        began = time.process_time()
        trees[0].merge(trees[1])
        assert time.process_time() - began < 1
        learned = wrapper.induce(pages)
        assert wrapper.extract(pages[0], learned).count("\n") in (9999, 2999)


def _plain_match(a, b):
    """Simple tree matching as published, over all pairs of children."""
    if a.key != b.key:
        return 0
    best = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children):
        for j, y in enumerate(b.children):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + _plain_match(x, y))
    return 1 + best[-1][-1]


def test_matching_equals_the_published_one():
    rng = np.random.default_rng(3)

    def tree(depth):
        return "".join(f"<{t}>{tree(depth - 1) if depth else 'x'}</{t}>" for t in rng.choice(["div", "p", "ul", "span", "h2", "section"], rng.integers(0, 7)))

    for _ in range(200):
        a, b = (wrapper.Folded(wrapper.parse(tree(3))) for _ in range(2))
        assert wrapper.match(a, b) == _plain_match(a, b)
        places = wrapper.alignment(a.children, b.children)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(places, places[1:])) and 1 + sum(_plain_match(a.children[i], b.children[j]) for i, j in places) == wrapper.match(a, b)


def test_tree_matching():
    a, b = (wrapper.Folded(wrapper.parse(x)) for x in ("<div><p>a</p><ul><li>1</li></ul></div>", "<div><h1>t</h1><p>b</p><p>c</p><ul><li>2</li></ul></div>"))
    assert wrapper.match(a, b) == 5  # html, div, p, ul, li
    assert wrapper.alignment(a.children[0].children, b.children[0].children) == [(0, 1), (1, 2)]


@pytest.mark.parametrize("page", ["<", "<p", "</p></div>x", "<script>", "a < b", "<!-- x", "<a title='>'>k</a>", "<b>" * 300 + "x"])
def test_broken_pages_do_not_crash(page):
    wrapper.extract(page, None)


def test_deep_pages():
    deep = "<div>" * 5000 + "end <b>of it</b><script>no</script><nav>" + "<div>" * 3000 + "menu" + "</div>" * 3000 + "</nav> all"
    assert wrapper.extract(deep, None).split() == ["end", "of", "it", "all"]
    assert wrapper.extract("<i>" * 3000 + "x", wrapper.induce([deep, "<p>a", deep])) == "x"
    from html.parser import HTMLParser

    class Plain(HTMLParser):  # knows no depth
        def handle_data(self, data):
            words.extend(data.split())

    page, words = "".join(f"<div>level {k} <b>bold {k}</b>" for k in range(400)) + "</div> after" * 400, []
    Plain().feed(page)
    assert wrapper.extract(page, None).split() == words
    assert wrapper.induce(["<aside>" * 3000 + "x", "<form>" * 3000 + "y"])["constants"] == []


def test_embedding_links_against_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((8, 16))
    near = np.repeat(centres, 12, axis=0) + 0.25 * rng.standard_normal((96, 16))
    v = np.concatenate([near, rng.standard_normal((150, 16)), near[:5], 2.0 * near[:2]]).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0, None]), (904, []), (905, [float("inf")] * 16), (906, [1.0]), (None, v[0].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("digest", F.lit(1))
    got = {r["vec_id"]: r for r in projpass.near_duplicates(table).collect()}
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    label = np.arange(len(v))
    for _ in range(len(v)):
        label = np.array([label[linked[i]].min() for i in range(len(v))])
    for i in range(len(v)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (linked[i].sum() - 1, label[i], label[i] == i)
    for i in (900, 901, 902, 903, 904, 905, 906):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[None]["n_links"] == 0
    assert projpass.near_duplicates(table.limit(0)).count() == 0


def _linked(v, cosine=0.9):
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    return linked.sum(axis=1)


def test_embedding_recall_in_small_windows(spark):
    rng = np.random.default_rng(6)
    v = np.concatenate([np.repeat(rng.standard_normal((150, 32)), 4, axis=0) + 0.2 * rng.standard_normal((600, 32)), rng.standard_normal((1400, 32))])
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    truth = _linked(v).sum()
    got = projpass.near_duplicates(table, window=64).agg(F.sum("n_links")).first()[0]
    assert truth > 1000 and 0.9 * truth <= got <= truth


def test_embedding_links_of_a_group_beyond_window_and_block(spark):
    """One group of 2000 near copies: all links are counted, however rows are dealt out."""
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.standard_normal((1, 32)) + 0.22 * rng.standard_normal((2000, 32)), rng.standard_normal((1000, 32)), np.repeat(rng.standard_normal((20, 32)), 3, axis=0)])
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    truth = _linked(v)
    settings = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        for parts, adaptive, block in (("1", "true", 1024), ("7", "false", 300), ("64", "true", 1024)):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            got = {r["vec_id"]: r for r in projpass.near_duplicates(table.repartition(3), window=256, block=block).collect()}
            assert [got[i]["n_links"] for i in range(len(v))] == truth.tolist()
            assert {got[i]["component_id"] for i in range(2000) if truth[i]} == {min(np.flatnonzero(truth[:2000]))}
    finally:
        for k, x in settings.items():
            spark.conf.set(k, x)


@pytest.mark.parametrize("size", [200, 2000, 6000])
def test_vectors_that_hang_on_one_member_of_a_dense_group(spark, size):
    """Each of 300 vectors links with one member, or few, of a group far larger than a window; counts and components equal brute force."""
    rng = np.random.default_rng(size)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    middle = rng.standard_normal((1, 64))
    group = unit(unit(middle) + rng.standard_normal((size, 64)) * (0.075**0.5 / 8))
    held = group[rng.choice(size, 300, replace=size < 300)]
    away = rng.standard_normal((300, 64))
    away = unit(away - (away * held).sum(axis=1, keepdims=True) * held)
    hanging = 0.904 * held + (1 - 0.904**2) ** 0.5 * away
    others = unit(rng.standard_normal((1500, 64)))
    v = np.concatenate([group, hanging, others]).astype(np.float32)[rng.permutation(size + 1800)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in projpass.near_duplicates(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")).collect()}
    u = unit(v.astype(float))
    links = u @ u.T >= 0.9
    np.fill_diagonal(links, False)
    label = np.arange(len(v))
    while True:
        low = np.minimum(label, np.where(links, label[None, :], len(v)).min(axis=1))
        if (low == label).all():
            break
        label = low
    want = {i: (int(n), int(c)) for i, (n, c) in enumerate(zip(links.sum(axis=1), label))}
    assert sum(got[i] == want[i] for i in want) > 0.999 * len(want)
    # of vectors with a link, those that found their component
    linked = [i for i in want if want[i][0]]
    assert np.mean([got[i][1] == want[i][1] for i in linked]) >= 0.99


def test_comments_go_however_long_they_are(spark):
    """Three pages of a layout: comments outweigh the article tenfold; a page of nothing but comments keeps them; an article's header is its title's."""
    words = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    rows = []
    for k in range(3):
        html = f"<html><body><header>Site {k}</header><article><header><h1>Title {k}</h1></header><p>{words(k, 50)}</p></article><section class='comments'><div class='comment'>{words(k + 10, 500)}</div></section></body></html>"
        rows.append((k, f"http://a.example/{k}", html))
    rows.append((7, "http://b.example/", f"<html><body><div id='comments'>{words(30, 40)}</div></body></html>"))
    got = {r["page_id"]: r["text"] for r in wrapper.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == f"Title {k}\n{words(k, 50)}" for k in range(3)) and got[7] == words(30, 40)


def test_suffixes_by_a_table_of_rules(spark):
    rules = ["com", "uk", "co.uk", "jp", "kyoto.jp", "*.kawasaki.jp", "!city.kawasaki.jp", "github.io", "*.ck", "!www.ck", "CO.UK", None]
    want = {
        "com": "com", "a.com": "com", "x.a.co.uk": "co.uk", "uk": "uk", "ide.kyoto.jp": "kyoto.jp", "kyoto.jp": "kyoto.jp", "a.b.c.kawasaki.jp": "c.kawasaki.jp", "kawasaki.jp": "jp",
        "x.city.kawasaki.jp": "kawasaki.jp", "me.github.io": "github.io", "io": "io", "a.b.ck": "b.ck", "www.ck": "ck", "a.www.ck": "ck", "none.example": "example", "10.0.0.1": "10.0.0.1", "": "",
    }
    table = lambda x, n: spark.createDataFrame([(v,) for v in x], f"{n} string")
    found = hostrep.suffixes_by_rules(table([*want, "a.com"], "site"), table(rules, "rule"))
    assert {r["site"]: r["suffix"] for r in found.collect()} == want and found.count() == len(want)
    hosts = spark.createDataFrame([("a.me.github.io:80", 5, 5), ("b.me.github.io", 3, 0), ("you.github.io", 9, 1)], "host string, n long, bad long")
    with_rules = {r["host"]: r["bad_rate"] for r in hostrep.reputation(hosts, suffix_rules=table(rules, "rule")).collect()}
    # one domain of two hosts, another of one: without the rule all three would be github.io's
    assert len(with_rules) == 3 and with_rules["you.github.io"] < with_rules["b.me.github.io"] <= with_rules["a.me.github.io:80"]
