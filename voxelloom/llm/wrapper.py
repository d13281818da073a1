"""Main text of web pages by wrapper induction.

All pages of a host are grouped by the signature of their layout, which the tags of their outer
elements give. Of each group a bounded sample of distinct pages is parsed, their trees are folded (like
siblings become one repeating node) and aligned by simple tree matching
(Yang, 1991) into one template. A node's texts that all sampled pages hold are
template; nodes whose texts vary are slots. Every page of the group is read whole, but for the
template and for marked elements with little of the varying text, so all slot regions are content, wherever they stand.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import math
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .hostrep import url_host
from .shared import materialize

#: Pages of one layout that its wrapper is learned from, at most; pages, and share of the sample, that must agree on a text before it counts as template. Rarer layouts of a host share one wrapper.
SAMPLE, AGREE, AGREE_SHARE = 12, 2, 10 / 12
#: Parts that a layout's pages are sampled in first, so that no task meets all pages of a host.
PARTS = 16
#: Elements inside each other that tell layouts apart.
LAYOUT_DEPTH = 4
#: Elements inside each other that are kept as such; deeper ones are read as part of the last, but for dropped and marked ones, which are kept down to twice the depth.
DEPTH = 150
#: Bytes of all wrappers up to which they are broadcast; more are joined by host.
BROADCAST_BYTES = 32 << 20

#: Share of the varying text up to which marked elements are dropped: what holds most of it is content, whatever its name.
MARKED_SHARE = 0.5
#: The same of what is marked as written by readers: it is content only where next to nothing else varies.
READERS_SHARE = 0.95

# Elements by kind, and words of classes, ids and roles that mark what isn't article text unless it holds most of it.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
DROPPED = frozenset("head script style noscript iframe template svg button select textarea title object canvas".split())
MARKED = frozenset("nav header footer aside form dialog menu".split())
MARKED_WORDS = frozenset("ad ads advert adverts advertisement advertisements advertising adbox adslot banner promo promos promotion promotions promoted sponsor sponsors sponsored nav navbar navigation menu breadcrumb breadcrumbs sidebar sidebars aside footer header masthead comment comments commentlist discussion disqus reply replies respond notice notices cookie cookies consent gdpr alert popup modal overlay share sharing social related recommended newsletter newsletters subscribe subscription signup login search pagination pager toolbar widget widgets complementary contentinfo side rail".split())
#: Of these, the words of what readers wrote.
READERS = frozenset("comment comments commentlist discussion disqus reply replies respond".split())
#: Words that say nothing by themselves: a class of marked words and these is marked, one with any other word is not.
FILLING = frozenset("area bar block blocks bottom box button buttons container inner item items left link links list main outer page post posts right section site top unit wrap wrapper".split())
KEPT = frozenset("html body main".split())
LAYOUT = frozenset("main article section div center table nav header footer aside form".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
SCOPES = frozenset("table ul ol dl body html article section div main td th".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORDS = re.compile(r"[a-z]+")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)


def marked(token: str) -> bool:
    """Whether a whole class, id or role is made of marked words: `comments`, `related-posts`, `side-bar`, but not `has-sidebar` or `related-work`."""
    words = _WORDS.findall(token)
    return "".join(words) in MARKED_WORDS or not MARKED_WORDS.isdisjoint(words) and all(w in MARKED_WORDS or w in FILLING for w in words)


class Node:
    """An element; children are nodes and texts in page order. mark, if not empty, names what it may be instead of article."""

    __slots__ = ("tag", "classes", "dropped", "mark", "children")

    def __init__(self, tag: str, attributes: str = ""):
        named: dict[str, str] = {}
        if attributes:
            for m in _ATTRIBUTE.finditer(attributes):
                named.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        classes = sorted(named.get("class", "").lower().split())
        self.tag = tag
        self.classes = classes
        hidden = "hidden" in named or named.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(named.get("style", "")) is not None
        self.dropped = tag in DROPPED or tag not in KEPT and hidden
        tokens = {t for t in (*classes, *named.get("id", "").lower().split(), *named.get("role", "").lower().split()) if marked(t)} if named else set()
        self.mark = " ".join([tag, *sorted(tokens)]) if tag in MARKED or tokens and tag not in KEPT else ""
        self.children: list = []


def parse(page: str) -> Node:
    """The page's tree; missing end tags are implied, stray ones ignored, raw text elements hold no markup."""
    root = Node("html")
    stack, at, n = [root], 0, len(page)
    lower = None
    flat: dict[str, int] = {}  # elements too deep to be kept that are still open
    while at < n:
        m = _TOKEN.search(page, at)
        text = page[at : m.start() if m else n]
        if text:
            stack[-1].children.append(text)
        if not m:
            break
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing and flat.get(tag):
            flat[tag] -= 1
            continue
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag not in BLOCK and stack[k].tag in BLOCK:
                    break
            continue
        if tag == "html":
            continue
        if tag == "body" and any(x.tag == "head" for x in stack):
            del stack[next(k for k, x in enumerate(stack) if x.tag == "head") :]
        if tag in BLOCK:
            closed = CLOSED_BY.get(tag, ())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p" or stack[k].tag in closed:
                    del stack[k:]
                    if stack[-1].tag not in closed:
                        break
                elif stack[k].tag in SCOPES and stack[k].tag not in closed:
                    break
        node = Node(tag, attributes)
        if node.mark == "header" and any(x.tag == "article" for x in stack):
            node.mark = ""  # an article's own header holds its title
        stack[-1].children.append(node)
        if tag in RAW:
            lower = lower or page.lower()
            end = lower.find(f"</{tag}", at) if len(lower) == n else page.find(f"</{tag}", at)
            at = n if end < 0 else end
        if tag in VOID:
            continue
        if len(stack) < (2 * DEPTH if node.dropped or node.mark else DEPTH):
            stack.append(node)
        else:
            flat[tag] = flat.get(tag, 0) + 1
    return root


def _squeeze(parts: list[str]) -> str:
    return " ".join(entities.unescape("".join(parts)).split())


def _own(node: Node, out: list[list[str]]) -> None:
    """Texts of an element that stand in none of its inner blocks; each list is one stretch."""
    for c in node.children:
        if isinstance(c, str):
            out[-1].append(c)
        elif c.tag == "br":
            out[-1].append(" ")
        elif not c.dropped:
            if c.tag in BLOCK or c.mark:
                out.append([])
            else:
                _own(c, out)


def signature(root: Node) -> str:
    """What pages of one layout share: the paths of the outer elements' tags, however often they occur."""
    paths: set[str] = set()

    def walk(node: Node, path: str, depth: int) -> None:
        for c in node.children:
            if isinstance(c, Node) and not c.dropped:
                if c.tag in LAYOUT:
                    paths.add(f"{path}/{c.tag}")
                    if depth < LAYOUT_DEPTH:
                        walk(c, f"{path}/{c.tag}", depth + 1)
                elif c.tag == "body":
                    walk(c, path, depth)

    walk(root, "", 1)
    return hashlib.md5(" ".join(sorted(paths)).encode()).hexdigest()[:16]


def shared_classes(roots: list[Node]) -> set[str]:
    """Classes that at least half of the pages have; others, such as a page's own number, don't tell elements apart."""
    pages: dict[str, int] = {}
    for root in roots:
        found, left = set(), [root]
        while left:
            node = left.pop()
            found.update(node.classes)
            left += [c for c in node.children if isinstance(c, Node)]
        for c in found:
            pages[c] = pages.get(c, 0) + 1
    return {c for c, n in pages.items() if 2 * n >= len(roots)}


class Folded:
    """A node of a template: likes among its siblings, wherever they stand, are one node; texts has for each page the texts of its elements' own blocks, path the tags of the blocks around them.

    key, the tag, the mark and the classes, those in `names` if given, tells siblings of different use apart."""

    __slots__ = ("key", "tag", "path", "dropped", "mark", "children", "texts", "_size")

    def __init__(self, node: Node | None = None, page: int = 0, path: str = "", names: set[str] | None = None):
        self.children: list[Folded] = []
        self.texts: dict[int, set[str]] = {}
        self._size: int | None = None
        if node:
            self.key = ".".join([node.tag, *(c for c in node.classes if names is None or c in names)]) + (f"!{node.mark}" if node.mark else "")
            self.tag, self.path, self.dropped, self.mark = node.tag, f"{path}/{node.tag}" if node.tag in BLOCK else path, node.dropped, node.mark
            own: list[list[str]] = [[]]
            if node.tag in BLOCK or node.mark:
                _own(node, own)
            self.texts[page] = {t for x in own if (t := _squeeze(x))}
            likes: dict[str, Folded] = {}
            for c in node.children:
                if isinstance(c, Node):
                    new = Folded(c, page, self.path, names)
                    if new.key in likes:
                        likes[new.key].merge(new)
                    else:
                        likes[new.key] = new
            self.children = list(likes.values())

    def merge(self, other: Folded) -> None:
        """Take in a matching node: aligned children merge, the others are kept in order."""
        for page, texts in other.texts.items():
            self.texts.setdefault(page, set()).update(texts)
        out, i, j = [], 0, 0
        for a, b in [*alignment(self.children, other.children), (len(self.children), len(other.children))]:
            out += self.children[i:a]
            out += other.children[j:b]
            if a < len(self.children):
                self.children[a].merge(other.children[b])
                out.append(self.children[a])
            i, j = a + 1, b + 1
        self.children = out

    def size(self) -> int:
        """Characters of varying text below, but for what is never content."""
        if self._size is None:
            self._size = 0 if self.dropped else sum(len(t) for t in self.varying()) + sum(c.size() for c in self.children)
        return self._size

    def judge(self) -> list[str]:
        """Marks that don't tell: together their elements hold more than MARKED_SHARE of the varying text outside READERS' marks, or READERS_SHARE of all if they are such; every mark where nothing else varies. Afterwards the other marked nodes are dropped."""
        sums: dict[str, int] = {}
        by_reader = lambda mark: not READERS.isdisjoint(_WORDS.findall(mark))

        def unread(x: Folded) -> int:
            """Varying text that stands in no reader's mark."""
            if x.dropped or x.mark and by_reader(x.mark):
                return 0
            return sum(len(t) for t in x.varying()) + sum(map(unread, x.children))

        def gather(x: Folded, around: frozenset[str]) -> int:
            """Adds up the nodes of each mark; varying text that stands in no marked node."""
            if x.dropped:
                return 0
            if x.mark and x.mark not in around:
                sums[x.mark] = sums.get(x.mark, 0) + x.size()
                around |= {x.mark}
            return (0 if around else sum(len(t) for t in x.varying())) + sum(gather(c, around) for c in x.children)

        plain = gather(self, frozenset())
        kept = {m for m in sums if by_reader(m) and sums[m] > READERS_SHARE * self.size()}
        size = self.size() if kept else unread(self)
        kept |= {m for m in sums if not by_reader(m) and sums[m] > MARKED_SHARE * size}
        if not plain and not kept:
            kept = set(sums)

        def drop(x: Folded) -> None:
            x._size = None
            x.dropped = x.dropped or x.mark != "" and x.mark not in kept
            for c in x.children:
                drop(c)

        drop(self)
        return sorted(kept)

    def constant(self) -> set[str]:
        return set.intersection(*self.texts.values()) if self.texts else set()

    def varying(self) -> set[str]:
        return set.union(*self.texts.values()) - (self.constant() if len(self.texts) > 1 else set()) if self.texts else set()


def match(a: Folded, b: Folded) -> int:
    """Nodes in the largest matching of two trees that keeps roots, parents and sibling order."""
    return 1 + _heaviest(a.children, b.children)[0] if a.key == b.key else 0


def alignment(a: list[Folded], b: list[Folded]) -> list[tuple[int, int]]:
    """Places of the matched children of both, in order."""
    out, link = [], _heaviest(a, b)[1]
    while link:
        i, j, link = link
        out.append((i, j))
    return out[::-1]


def _heaviest(a: list[Folded], b: list[Folded]) -> tuple[int, tuple | None]:
    """(nodes matched, last link) of the best matching of two lists of siblings; a link is (place in a, place in b, the link before).

    Only siblings of equal keys match, so the matching is a heaviest rising sequence of their
    places: each place in b keeps the best that ends at or before it in a tree of prefixes.
    """
    places: dict[str, list[int]] = {}
    for j, y in enumerate(b):
        places.setdefault(y.key, []).append(j)
    best: list[tuple[int, tuple | None]] = [(0, None)] * (len(b) + 1)

    def upto(j: int) -> tuple[int, tuple | None]:
        found = best[0]
        while j > 0:
            if best[j][0] > found[0]:
                found = best[j]
            j &= j - 1
        return found

    for i, x in enumerate(a):
        for j in reversed(places.get(x.key, ())):
            weight, link = upto(j)
            new, k = (weight + match(x, b[j]), (i, j, link)), j + 1
            while k <= len(b):
                if new[0] > best[k][0]:
                    best[k] = new
                k += k & -k
    return upto(len(b))


def induce(pages: list[str]) -> dict:
    """The wrapper of pages of one layout: the marked elements that are content nevertheless, and the template texts, each with the path of its block.

    Content is all that varies, wherever it stands. A text is template if all pages with its element
    hold it there, and these are AGREE at least and AGREE_SHARE of the pages.
    """
    roots = [parse(page) for page in pages]
    names = shared_classes(roots)
    template = Folded(roots[0], 0, "", names)
    for k, root in enumerate(roots[1:], 1):
        template.merge(Folded(root, k, "", names))
    agree = max(AGREE, math.ceil(AGREE_SHARE * len(pages)))
    kept = template.judge()
    if len(pages) < agree:
        return {"kept": kept, "constants": []}
    content = template
    while not content.varying() and len(live := [c for c in content.children if c.size()]) == 1:
        content = live[0]

    def gather(x: Folded, found: set[tuple[str, str]], inside: bool) -> set[tuple[str, str]]:
        if inside or x is not content:
            if len(x.texts) >= agree:
                found.update((x.path, t) for t in x.constant())
            for c in x.children:
                gather(c, found, inside)
        return found

    inner = gather(content, set(), True)
    if sum(len(t) for _, t in inner) > content.size():  # pages that share most of an article teach no template
        inner = set()
    return {"kept": kept, "constants": sorted(inner | gather(template, set(), False))}


def _blocks(node: Node, path: str, out: list[tuple[str, list[str]]], kept: set[str]) -> None:
    """(path, texts) of a node's blocks in page order."""
    for c in node.children:
        if isinstance(c, str):
            out[-1][1].append(c)
        elif c.tag == "br":
            out[-1][1].append(" ")
        elif not c.dropped and (not c.mark or c.mark in kept):
            if c.tag in BLOCK:
                inner = f"{path}/{c.tag}"
                out.append((inner, []))
                _blocks(c, inner, out, kept)
                out.append((path, []))
            else:
                _blocks(c, path, out, kept)


def extract(page: str | None, wrapper: dict | None) -> str:
    """The page's text but for what is dropped and its host's template, in page order."""
    if not page:
        return ""
    return read(parse(page), wrapper or induce([page]))


def _unmarked(root: Node, kept: set[str], constants: set[tuple[str, str]]) -> str:
    blocks: list[tuple[str, list[str]]] = [("/html", [])]
    _blocks(root, "/html", blocks, kept)
    return "\n".join(t for path, b in blocks if (t := _squeeze(b)) and (path, t) not in constants)


def read(root: Node, wrapper: dict) -> str:
    """A parsed page through a wrapper; marks are judged by the page too if its layout is rare, and where the wrapper's leave nothing of it."""
    constants, kept = set(map(tuple, wrapper["constants"])), set(wrapper["kept"])
    if wrapper.get("unlike"):
        kept.update(Folded(root).judge())
    return _unmarked(root, kept, constants) or _unmarked(root, set(Folded(root).judge()), constants)


def layouts(pages: DataFrame) -> DataFrame:
    """(host, mark, layout) of every distinct page in (host, html) rows; mark is its hash. Layouts of fewer than AGREE pages of a host are its layout ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = [signature(parse(html.as_py())) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(signs, pa.string())], names=["host", "mark", "sign"])

    signed = pages.where("html <> ''").select("host", F.xxhash64("html").alias("mark"), "html").mapInArrow(run, "host string, mark long, sign string").distinct()
    signed = materialize(signed, "wrapper-signatures")
    common = signed.groupBy("host", "sign").count().where(F.col("count") >= AGREE).withColumn("layout", F.col("sign")).drop("count")
    # a host's pages meet its layouts in PARTS of their own
    parted = signed.withColumn("part", F.pmod("mark", F.lit(PARTS)))
    common = common.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return materialize(parted.join(common.hint("merge"), ["host", "sign", "part"], "left").select("host", "mark", F.coalesce("layout", F.lit("")).alias("layout")), "wrapper-layouts")


def wrappers(pages: DataFrame, known: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(host, layout, wrapper) of every layout in `known` from (host, html) rows: distinct pages, those of the smallest hashes.

    Hashes are ranked first, in parts of a layout and then those that are left; only then the
    pages of the chosen hashes are fetched, copies folded to one by each task. So neither a host nor
    a page with a third of the rows needs more room than another.
    """
    chosen = known.withColumn("part", F.pmod("mark", F.lit(PARTS)))
    for keys in (["host", "layout", "part"], ["host", "layout"]):
        chosen = chosen.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy("mark"))).where(F.col("nth") <= sample).drop("nth")
    chosen = chosen.drop("part")
    marks = pages.where("html <> ''").withColumn("mark", F.xxhash64("html"))
    some = marks.join(materialize(chosen, "wrapper-sample"), ["host", "mark"]).groupBy("host", "layout", "mark").agg(F.first("html").alias("html"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("mark")
        layout = rows["layout"].iloc[0]
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "layout": [layout], "wrapper": [json.dumps(induce(list(rows["html"])) | {"unlike": layout == ""})]})

    return some.groupBy("host", "layout").applyInPandas(run, "host string, layout string, wrapper string")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sample: int = SAMPLE) -> DataFrame:
    """(id_col, url, text, n_chars) of every row, from the whole html.

    Character references are decoded, white space in a block becomes one space, blocks are joined by line feeds. Null and
    empty pages, and pages without article text, have ''. Pages without a url share the wrappers of host ''. Repeated rows give
    repeated results; an empty table gives an empty one. Wrappers are broadcast if their measured size
    allows, else joined by host and page.
    """
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html")).withColumn("host", url_host(F.col("url")))
    placed = layouts(own.select("host", "html"))
    known = materialize(wrappers(own.select("host", "html"), placed, sample), "wrappers")
    id_type = own.schema["id"].dataType.simpleString()
    size = known.agg(F.sum(F.octet_length("host") + F.octet_length("layout") + F.octet_length("wrapper"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        shared = pages.sparkSession.sparkContext.broadcast({(r["host"], r["layout"]): r["wrapper"] for r in known.collect()})
        rows = own.withColumn("wrapper", F.lit(None).cast("string"))
    else:
        shared = None
        rows = own.withColumn("mark", F.xxhash64("html")).join(placed, ["host", "mark"], "left").join(known, ["host", "layout"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value if shared else {}
        learned: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for html, host, wrapper in zip(*(batch.column(k) for k in (2, 3, 4))):
                html, host, wrapper = html.as_py(), host.as_py(), wrapper.as_py()
                if not html:
                    texts.append("")
                    continue
                root = parse(html)
                if shared:
                    wrapper = held.get((host, signature(root))) or held[host, ""]
                if wrapper not in learned:
                    if len(learned) > 10_000:
                        learned.clear()
                    learned[wrapper] = json.loads(wrapper)
                texts.append(read(root, learned[wrapper]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    return rows.select("id", "url", "html", "host", "wrapper").mapInArrow(run, f"id {id_type}, url string, text string, n_chars long").withColumnRenamed("id", id_col)
