"""Main text of web pages by wrapper induction.

Pages of one host come from one template. Each host has an exemplar page, the one whose id has the smallest
hash, and every page's DOM tree is aligned with it by simple tree matching: roots with equal labels match,
and their children are paired in order so that the most nodes match below them. Over all pages of the host,
an exemplar node that nearly always carries the same text is template; one whose text varies is a slot.
A page's text is what lies in slots or in nodes that the template does not have, without the parts that
HTML itself or a whole word of their class, id or role marks as menus, headers, adverts, forms, comments and
the like. Where a host has too few pages to tell template from slot, the article element decides, if any.

Alignments are counted where the pages lie; a host's counts are as large as its exemplar, so a host with a
third of all pages is no problem. Exemplars are broadcast if their measured size allows, else joined.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import write_scratch
from ..plans.joins import BROADCAST_BYTES, measured_bytes
from .common import query, table

TEMPLATE_SHARE = 0.8
LEAST_PAGES = 5
#: Fixed values of HTML: elements without end tag, elements that part text into blocks, elements without text to read.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
UNREAD = frozenset("button canvas head iframe noscript object script select style svg template textarea".split())
#: Elements, and whole words of class, id or role, of parts around the article.
AROUND = frozenset("aside dialog footer form menu nav".split())
AROUND_NAMES = re.compile(
    r"(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|disqus|footer|header|login|masthead|menu|modal|nav\w*|"
    r"newsletter|notice|popup|promo\w*|related|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|toolbar)"
)
#: An open element that a new one of the second kind ends.
ENDS = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
_SPACES = re.compile(r"[\x20\t\n\r\f\v\xa0]+")
_UNFINISHED = re.compile("<[a-zA-Z/!?]")
_DEEPEST = 200


class Node:
    """A block element (label, children) or a piece of text (label "#")."""

    __slots__ = ("around", "children", "label", "number", "shape", "size", "tag", "text")

    def __init__(self, label: str, tag: str = "", around: bool = False, text: str = ""):
        self.label, self.tag, self.around, self.text = label, tag, around, text
        self.children: list[Node] = []
        self.number = -1


@lru_cache(maxsize=4096)
def _marked(names: str) -> bool:
    return any(map(AROUND_NAMES.fullmatch, names.split()))


def _close(names: list[str], tag: str) -> None:
    """Cut ``names`` at its last ``tag``."""
    while names.pop() != tag:
        pass


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", "html")
        self.open = [self.root]
        self.hidden: list[str] = []  # an unread element and what is open inside it
        self.deep: list[str] = []  # open elements beyond the depth, which are not in the tree
        self.held: list[str] = []
        self.holders: list[Node] = []  # marked nodes that hold an article
        self.plain = False  # whether an article lies in no marked node

    def flush(self) -> None:
        if self.held:
            text = _SPACES.sub(" ", "".join(self.held)).strip(" ")
            self.held = []
            if text:
                self.open[-1].children.append(Node("#", text=text))

    def handle_starttag(self, tag, attrs):
        if tag == "body" or (self.hidden == ["head"] and tag in BLOCKS and tag != "html"):
            self.hidden.clear()
        if tag in UNREAD or (self.hidden and tag in BLOCKS and tag not in VOID):
            self.hidden.append(tag)
        if self.hidden:
            return
        if tag not in BLOCKS:
            if tag == "br":
                self.held.append(" ")
            return
        self.flush()
        while self.deep and tag in ENDS.get(self.deep[-1], ()):
            self.deep.pop()
        for at in range(0 if self.deep else len(self.open) - 1, 0, -1):
            over = self.open[at].tag
            if over in ENDS and tag in ENDS[over]:
                del self.open[at:]
            elif over not in ("p", "li", "dt", "dd", "tr", "td", "th"):
                break
        if tag in ("html", "body", "hr"):
            return
        if self.deep or len(self.open) > _DEEPEST:
            self.deep.append(tag)
            return
        names = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v).lower()
        inside = any(n.tag in ("article", "main") for n in self.open)
        around = tag in AROUND or (tag == "header" and not inside) or _marked(names)
        node = Node(f"{tag} {names}" if names else tag, tag, around)
        self.open[-1].children.append(node)
        self.open.append(node)
        if tag in ("article", "main"):
            marked = [n for n in self.open if n.around]
            self.holders += marked
            self.plain = self.plain or not marked

    def handle_startendtag(self, tag, attrs):
        if tag not in UNREAD:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in self.hidden:
            _close(self.hidden, tag)
            return
        if tag not in BLOCKS:
            return
        if self.hidden:
            # The end of an element around them ends unread elements too.
            if tag not in ("body", "html") and (tag == "p" or all(n.tag != tag for n in self.open[1:])):
                return
            self.hidden.clear()
        self.flush()
        if tag in self.deep:
            _close(self.deep, tag)
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                del self.open[at:]
                self.deep.clear()
                break

    def handle_data(self, data):
        if not self.hidden:
            self.held.append(data)


def parse(html: str | None) -> Node:
    """Tree of blocks, its nodes numbered in page order; unfinished tags at the end are dropped."""
    tree = _Tree()
    tree.feed(html or "")
    # What the parser still holds: an unfinished tag or comment, or text that could go on.
    if not _UNFINISHED.match(tree.rawdata):
        tree.handle_data(unescape(tree.rawdata))
    tree.flush()
    if not tree.plain:  # every article lies inside marked parts: those are no marks
        for node in tree.holders:
            node.around = False
    order, stack = [], [tree.root]
    while stack:
        node = stack.pop()
        node.number = len(order)
        order.append(node)
        stack.extend(reversed(node.children))
    for node in reversed(order):  # children before their parents
        node.shape = hash((node.label, *[c.shape for c in node.children]))
        node.size = 1 + sum(c.size for c in node.children)
    return tree.root


def align(page: Node, exemplar: Node) -> list[tuple[Node, Node]]:
    """Pairs of matching nodes under two roots of equal label, by simple tree matching.

    Children of equal shape (labels all the way down) at both ends of two lists pair up at once: no other pairing of
    theirs matches more nodes, and an order-keeping pairing can only gain by it. The table of the rest is filled as
    usual, so long lists of alike items cost their length, and only what differs costs its square.
    """
    known: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def match(a: Node, b: Node) -> int:
        if a.label != b.label:
            return 0
        if a.shape == b.shape:
            return a.size
        key = (a.number, b.number)
        if key in known:
            return known[key][0]
        x, y = a.children, b.children
        least, first = min(len(x), len(y)), 0
        while first < least and x[first].shape == y[first].shape:
            first += 1
        last = 0
        while last < least - first and x[-1 - last].shape == y[-1 - last].shape:
            last += 1
        pairs = [(i, i) for i in range(first)]
        total = 1 + sum(c.size for c in x[:first]) + sum(c.size for c in x[len(x) - last :])
        m, n = len(x) - first - last, len(y) - first - last
        if m and n:
            best = np.zeros((m + 1, n + 1), np.int64)
            for i in range(m):
                row, above, c = best[i + 1], best[i], x[first + i]
                for j in range(n):
                    row[j + 1] = max(above[j + 1], row[j], above[j] + match(c, y[first + j]))
            i, j, middle = m, n, []
            while i and j:
                if best[i, j] == best[i - 1, j]:
                    i -= 1
                elif best[i, j] == best[i, j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    middle.append((first + i, first + j))
            pairs += middle[::-1]
            total += int(best[-1, -1])
        pairs += [(len(x) - k, len(y) - k) for k in range(last, 0, -1)]
        known[key] = (total, pairs)
        return total

    found, stack = [], [(page, exemplar)]
    match(page, exemplar)
    while stack:
        a, b = stack.pop()
        found.append((a, b))
        if a.shape == b.shape:
            stack.extend(zip(a.children, b.children))
        else:
            stack.extend((a.children[i], b.children[j]) for i, j in known.get((a.number, b.number), (0, []))[1])
    return found


@lru_cache(maxsize=256)
def _exemplar(html: str) -> Node:
    return parse(html)


def main_text(root: Node, template: set[int], judged: bool = False) -> str:
    """Blocks of the article in page order; nodes numbered in ``template`` are left out.

    If the host's template is known (``judged``), all other unmarked parts of the page are text.
    """
    top: list[Node] = []

    def articles(node: Node) -> None:
        for child in node.children:
            if child.around:
                continue
            if child.tag in ("article", "main"):
                top.append(child)
            else:
                articles(child)

    if not judged:
        articles(root)
    blocks: list[str] = []
    stack = list(reversed(top or [root]))
    while stack:
        node = stack.pop()
        if node.around or node.number in template:
            continue
        if node.label == "#":
            blocks.append(node.text)
        stack.extend(reversed(node.children))
    return "\n\n".join(blocks)


def induce_wrappers(pages: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Rows (_host, _exemplar, _template): a page of each host and the numbers of its template nodes.

    The numbers are null where no text node has ``LEAST_PAGES`` pages. ``pages`` has _id, _host and _html; empty pages
    take no part, and a host that has no others has no row. A text node is template if at least ``LEAST_PAGES``
    different pages match it and at least ``TEMPLATE_SHARE`` of those carry its text. Copies of a page count as one, so
    that an article that a host shows many times is not taken for its template.
    """
    pages = pages.filter(F.length(F.trim("_html")) > 0)
    order = F.struct(F.xxhash64("_id"), F.col("_id"), F.xxhash64("_html"))
    exemplars = pages.groupBy("_host").agg(F.min_by("_html", order).alias("_exemplar"))
    exemplars = write_scratch(exemplars, "exemplars")
    small = measured_bytes(exemplars) <= limit
    met = pages.join(F.broadcast(exemplars) if small else exemplars, "_host").select("_host", "_html", "_exemplar")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: set[tuple[str, bytes]] = set()
        for batch in batches:
            rows = []
            for host, html, model in zip(batch["_host"], batch["_html"], batch["_exemplar"]):
                page = hashlib.blake2b(html.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                if (host, page) in done:
                    continue
                if len(done) >= 100_000:  # what is seen again later goes below
                    done.clear()
                done.add((host, page))
                pairs = [(b.number, a.text == b.text) for a, b in align(parse(html), _exemplar(model)) if b.label == "#"]
                rows.append((host, page, [n for n, _ in pairs], [s for _, s in pairs]))
            yield pd.DataFrame(rows, columns=["_host", "page", "node", "same"])

    judged = met.mapInPandas(judge, "_host string, page binary, node array<int>, same array<boolean>")
    judged = judged.dropDuplicates(["_host", "page"]).select("_host", F.inline(F.arrays_zip("node", "same")))
    counted = judged.groupBy("_host", "node").agg(F.count(F.lit(1)).alias("n"), F.count_if("same").alias("same"))
    constant = F.when(F.col("same") >= TEMPLATE_SHARE * F.col("n"), F.col("node"))
    # As many numbers as the exemplar has nodes.
    template = counted.filter(F.col("n") >= LEAST_PAGES).groupBy("_host").agg(F.sort_array(F.collect_list(constant)).alias("_template"))
    return write_scratch(exemplars.join(template, "_host", "left"), "wrappers")


def extract_text(pages: DataFrame, html: str = "html", url: str = "url", key: str = "page_id", limit: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of ``pages``: ``key``, ``url``, text, n_chars and n_template (text nodes left out as constant).

    Null html counts as empty; its text is empty. A null url is a host of its own. Pages of hosts with
    too few different pages give the text of their article or main element, or without one that of the whole page,
    without the marked parts. Repeated rows repeat and get equal texts. A very long page is parsed and aligned whole, in
    proportion to its length where its lists differ little from the exemplar's. An empty table gives an empty
    result, and other columns are not read.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)", 1), F.lit("")))
    rows = pages.select(F.col(key).alias("_id"), F.col(url).alias("_url"), host.alias("_host"), F.coalesce(F.col(html), F.lit("")).alias("_html"))
    kind = dict(rows.dtypes)
    wrappers = induce_wrappers(rows, limit)
    met = rows.join(F.broadcast(wrappers) if measured_bytes(wrappers) <= limit else wrappers, "_host", "left")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, left = [], []
            for page, model, template in zip(batch["_html"], batch["_exemplar"], batch["_template"]):
                root, out = parse(page), set()
                if template is not None and len(template):
                    constant = set(map(int, template))
                    out = {a.number for a, b in align(root, _exemplar(model)) if b.number in constant and a.text == b.text}
                texts.append(main_text(root, out, template is not None))
                left.append(len(out))
            yield pd.DataFrame({"_id": batch["_id"], "_url": batch["_url"], "text": texts, "n_chars": [len(t) for t in texts], "n_template": left})

    read_ = met.mapInPandas(read, f"_id {kind['_id']}, _url {kind['_url']}, text string, n_chars bigint, n_template bigint")
    return read_.withColumnsRenamed({"_id": key, "_url": url})


@query("op2_wrapper_induction")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
