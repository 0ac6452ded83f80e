"""Main text of web pages, with site templates removed.

Every element subtree of a page is hashed by its tags and text, paragraphs, list
items and table cells with all they hold included. Spark counts subtrees per
host over different pages (copies of a page count once), and those on many pages
of their host are template: they go, with all they hold. An element that lays
out a page needs a small share of the host's pages for that; one of running text
(a paragraph, a list item, a cell, or part of one) needs half of them, as sites
also quote and copy their own articles. A page all of whose text recurs is such
a copy and keeps it.

Lists are a supplement for what occurs once: elements that no page means as main
text (menus, headers, footers, forms, scripts) go by tag or role, and by a class
or id that says nothing else (``ad-slot`` does, ``social-history`` does not).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.llm.common import discard, saved, ship, slices
from tableferry.llm.host_trust import host_of

LEAST_PAGES = 8
LEAST_SHARE = 0.05
TEXT_SHARE = 0.5
#: Template subtrees that every task may hold, 8 bytes each; more are joined to the pages.
HELD_TEMPLATES = 1_000_000

# Elements without content, those whose content is no markup, and those that are never main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
DROPPED = frozenset("script style textarea title noscript iframe xmp noembed noframes template head nav header footer aside form button select option dialog menu svg math canvas object audio video label fieldset input".split())
BLOCK = frozenset("address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
# Blocks of running text, which repeat for other reasons than a template.
TEXT_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt figcaption tr".split())
ENDS_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "li", "dd", "dt", "figcaption", "summary"} | {"hr"}
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog form menu menubar toolbar".split())
# Words of a class or id that mark what is no main text, and words that only say what kind of box it is.
MARKS = frozenset(
    "ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices paywall popup promo promoted related share sharing sidebar social sponsor sponsored subscribe subscription widget widgets".split()
)

BOXES = frozenset(
    "area bar block bottom box btn button buttons col column container content group holder inner item items layout left link links list main message outer overlay page panel pane primary region right row secondary section site slot small text thread top unit wrap wrapper zone".split()
)

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parts", "drop", "index")

    def __init__(self, tag: str, drop: bool = False):
        self.tag, self.parts, self.drop, self.index = tag, [], drop, -1


def _unwanted(tag: str, attributes: str) -> bool:
    if tag in DROPPED:
        return True
    if not attributes or tag in ("html", "body", "main", "article"):
        return False
    found = {m[1].lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in _ATTRIBUTE.finditer(attributes)}
    if found.get("role", "").lower() in ROLES or found.get("aria-hidden", "").lower() == "true" or re.search(r"(?:^|[\s/])hidden(?:[\s/=]|$)", attributes):
        return True
    return any(map(_marks_no_text, f"{found.get('class', '')} {found.get('id', '')}".split()))


def _marks_no_text(name: str) -> bool:
    """A class or id all of whose words are marks or boxes, one mark at least."""
    words = [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", name)]
    return not MARKS.isdisjoint(words) and MARKS.union(BOXES).issuperset(words)


def parse(html: str) -> Node:
    """Tree of a page. Unclosed elements end with what holds them; a paragraph ends where another block begins."""
    root = Node("#root")
    stack = [root]
    at = 0

    def close(index: int) -> None:
        del stack[index:]

    while at < len(html):
        m = _TAG.search(html, at)
        if m is None:
            stack[-1].parts.append(html[at:])
            break
        if m.start() > at:
            stack[-1].parts.append(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                stack[-1].parts.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
                if tag not in BLOCK and stack[k].tag in BLOCK and stack[k].tag != "p":
                    break
            continue
        open_tags = [n.tag for n in stack]
        if tag in ENDS_P and "p" in open_tags:
            close(len(open_tags) - 1 - open_tags[::-1].index("p"))
        elif tag in CLOSES:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in CLOSES[tag]:
                    close(k)
                    break
                if stack[k].tag in ("ul", "ol", "dl", "table", "select", "menu"):
                    break
        node = Node(tag, _unwanted(tag, m[3]))
        stack[-1].parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            node.parts.append(html[at : end.start() if end else len(html)])
            at = end.end() if end else len(html)
        elif tag not in VOID and not m[3].rstrip().endswith("/"):
            stack.append(node)
    return root


def subtrees(root: Node) -> list[tuple[int, int, bool]]:
    """(index, hash, whether it is running text) of every element with text that may be template, in page order; each node gets its index."""
    out: list[tuple[int, int, bool]] = []
    hashes: dict[int, tuple[bytes, bool]] = {}
    work: list[tuple[Node, bool, bool]] = [(root, False, False)]
    counter = 0
    while work:
        node, done, in_text = work.pop()
        if done:
            digest, filled = xxhash.xxh3_64(), False
            digest.update(node.tag)
            for part in node.parts:
                if isinstance(part, Node):
                    inner, has_text = hashes.pop(id(part))
                else:
                    inner = _SPACE.sub(" ", part).strip()
                    has_text = bool(inner)
                filled |= has_text
                digest.update(inner)
                digest.update("\0")
            hashes[id(node)] = digest.digest(), filled
            if filled and node.tag not in ("#root", "html", "body", "main", "article") and not node.drop:
                out.append((node.index, digest.intdigest() - (1 << 63), in_text))
            continue
        node.index = counter
        counter += 1
        inside = in_text or node.tag in TEXT_BLOCK
        work.append((node, True, inside))
        work.extend((p, False, inside) for p in reversed(node.parts) if isinstance(p, Node))
    return out


def main_text(root: Node, template: frozenset[int]) -> str:
    """Text of the page without its template; the text of a page all of which recurs."""
    return blocks(root, template) or (blocks(root, frozenset()) if template else "")


def blocks(root: Node, template: frozenset[int]) -> str:
    """Text of the page: its article or main element if it has one, without dropped and template elements.

    White space inside a block is one space; blocks are joined by an empty line.
    """
    homes: list[Node] = []
    work = [root]
    while work:  # outermost articles, or else main
        node = work.pop()
        if node.drop or node.index in template:
            continue
        if node.tag == "article":
            homes.append(node)
        else:
            work.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    if not homes:
        work = [root]
        while work and not homes:
            node = work.pop()
            if node.tag == "main":
                homes = [node]
            else:
                work.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    out: list[str] = []
    now: list[str] = []

    def cut() -> None:
        text = _SPACE.sub(" ", "".join(now)).strip()
        if text:
            out.append(text)
        now.clear()

    steps: list = list(reversed(homes or [root]))
    while steps:
        step = steps.pop()
        if step is None:
            cut()
        elif isinstance(step, str):
            now.append(unescape(step))
        elif not (step.drop or step.index in template):
            if step.tag == "br":
                now.append(" ")
            edge = [None] if step.tag in BLOCK or step.tag == "#root" else []
            steps.extend(edge + list(reversed(step.parts)) + edge)
    cut()
    return "\n\n".join(out)


def templates(spark: SparkSession, found: DataFrame, pages: DataFrame, least_pages: int, least_share: float, text_share: float) -> DataFrame:
    """(``host``, ``hash``, ``in_text``) of subtrees on many pages of their host, from (host, page, hash, in_text) and (host, page).

    A subtree counts once a page. Counts are combined before their shuffle, so a
    subtree on all pages of a large host is one row per task.
    """
    per_host = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counted = found.select("host", "hash", "in_text", "page").distinct().groupBy("host", "hash", "in_text").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_pages)
    share = F.when(F.col("in_text"), F.lit(text_share)).otherwise(F.lit(least_share))
    return counted.join(per_host, "host").filter(F.col("n") >= share * F.col("pages")).select("host", "hash", "in_text")


def _keys(hosts: list[str], hashes: np.ndarray, in_text: np.ndarray) -> np.ndarray:
    """One number for host, hash and kind."""
    of_host = {h: xxhash.xxh3_64_intdigest(h) for h in set(hosts)}
    mixed = np.array([of_host[h] for h in hosts], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ hashes.view(np.uint64) ^ in_text.astype(np.uint64)


def extract(
    spark: SparkSession,
    pages: DataFrame,
    least_pages: int = LEAST_PAGES,
    least_share: float = LEAST_SHARE,
    text_share: float = TEXT_SHARE,
    held: int = HELD_TEMPLATES,
) -> DataFrame:
    """(``page_id``, ``url``, ``text``, ``n_chars``) for every row of ``pages`` (page_id, url, html).

    A subtree is template on at least ``least_pages`` different pages of its
    host and ``least_share`` of them, running text on ``text_share`` of them.
    Null html has no text; urls without a host share one. Equal pages are
    treated alike; ids and urls may be null or repeat; other columns are
    ignored. An empty table gives no rows.

    Up to ``held`` templates go to every task as 64-bit numbers, and the pages
    are not shuffled; more are joined to the pages.
    """
    ship(spark)
    base = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host")).withColumn("page", F.xxhash64("html"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            at, index, value, kind = [], [], [], []
            for i, html in enumerate(batch.column("html").to_pylist()):
                for k, h, in_text in subtrees(parse(html)):
                    at.append(i)
                    index.append(k)
                    value.append(h)
                    kind.append(in_text)
            where = pa.array(at, pa.int32())
            columns = [batch.column("host").take(where), batch.column("page").take(where), pa.array(index, pa.int32()), pa.array(value, pa.int64()), pa.array(kind, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "page", "node", "hash", "in_text"])

    found = saved(spark, base.select("host", "page", "html").mapInArrow(hashed, "host string, page long, node int, hash long, in_text boolean"), "subtrees")
    common = saved(spark, templates(spark, found, base.select("host", "page").distinct(), least_pages, least_share, text_share), "templates")
    if common.count() <= held:
        table = common.toArrow()  # at most ``held`` rows
        shared = spark.sparkContext.broadcast(np.unique(_keys(table["host"].to_pylist(), table["hash"].to_numpy(), table["in_text"].to_numpy())))
        discard(spark, found, common)
        joined = base.select("page_id", "url", "html", "host")
    else:
        shared = None
        nodes = found.join(common, ["host", "hash", "in_text"]).groupBy("host", "page").agg(F.collect_set("node").alias("template"))
        joined = base.join(nodes, ["host", "page"], "left").select("page_id", "url", "html", "template")
    schema = T.StructType([joined.schema["page_id"], joined.schema["url"], *T.StructType.fromDDL("text string, n_chars long").fields])

    def held_nodes(host: str, found: list[tuple[int, int, bool]]) -> frozenset[int]:
        if not found or not len(shared.value):
            return frozenset()
        index, value, kind = (np.array(x) for x in zip(*found, strict=True))
        keys = _keys([host] * len(found), value, kind)
        at = np.minimum(np.searchsorted(shared.value, keys), len(shared.value) - 1)
        return frozenset(index[shared.value[at] == keys].tolist())

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            out = []
            for html, more in zip(batch.column("html").to_pylist(), batch.column("host" if shared else "template").to_pylist(), strict=True):
                root = parse(html)
                elements = subtrees(root)
                out.append(main_text(root, held_nodes(more, elements) if shared else frozenset(more or ())))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=schema.fieldNames())

    return joined.mapInArrow(texts, schema)
