"""Main text of web pages by site style trees.

Pages of one host are merged into one tree. A node is a block element, named by the labels
(tag, classes, id; digits folded) from the page's root down to it. Its importance joins

* presentation: the entropy of its child sequences over the host's pages, with the number of
  pages as base: a node that looks alike everywhere is a template;
* content: one less the mean entropy of its texts over the pages: a text that stands on all
  pages says nothing about one of them, a text of one page is its own;

as ``(1 - 0.9 ** n) * presentation + 0.9 ** n * content``, ``n`` being its child labels and
content the mean over the texts of the whole branch. Leaves have content alone. Of ``m``
different pages of a host the sum counts ``m`` parts and one part more is 1, so small hosts
are smoothed and one page says nothing; pages with one and the same text count once, so copies
do not make their article a template.

The whole page goes into the tree, menus and adverts included. What the standard, roles and
names tell of a part (that it is navigation, an advert, reader comments) is a prior: the
node's importance times ``UNLIKELY``, or ``DOUBTFUL`` for names that also occur inside
articles. Branches below ``LEAST`` are taken out of each page. A part that only a name, a role
or ``form`` makes unlikely stays on a page whose only article is inside it, or most of its
text. Text outside ``article`` and ``main`` elements goes where they hold more than a
``MAIN_SHARE`` of the text left.

Each page is parsed once for the tree, whose rows (hashes, no texts) are staged, and once to
extract. Statistics are grouped sums over (host, node, text) with partial sums in the tasks,
so a host with most pages is no hot group; what returns to the pages is the list of low
branches of their host, no longer than a page's own branches are many. Elements nested deeper
than ``DEPTH`` blocks belong to the node at that depth (their text and marks count all the
same), so a page with any number of unclosed elements takes time in proportion to its length.

Edge cases: null and empty pages give an empty text; broken or cut pages are read as far as
they go; very long and deeply nested pages are read whole; a null address is a host of its
own; repeated rows are extracted one by one; other columns are kept as they are, except one
named like ``into``, which is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import fresh, quoted, staged, without

LEAST = 0.1
DECAY = 0.9
UNLIKELY, DOUBTFUL = 0.05, 0.5  # priors
MAIN_SHARE = 0.2
DEPTH = 64

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span
    strike strong sub sup time tt u var wbr img""".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
ENDS_P = frozenset(
    """address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2
    h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul""".split()
)
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "tbody", "thead"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# Parts of a page that are hardly its article, by element, by role, and by words of class and id.
NOISE_TAGS = frozenset(
    "aside audio button canvas datalist dialog footer form head map menu nav noscript object search select svg template video".split()
)
NOISE_ROLES = frozenset("navigation contentinfo complementary search form banner alert dialog menu menubar".split())
NOISE_WORDS = frozenset(
    """ad adbox ads adslot adspace adunit adv advert adverts advertisement advertising adsense alert banner bottombar breadcrumb breadcrumbs comment
    comments consent cookie cookies copyright disclaimer discussion disqus dropdown footer gdpr legal login menu modal
    nav navbar navigation newsletter notice notification outbrain overlay pager pagination popup promo promotion related
    recommended replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe
    subscription taboola tags toolbar topbar widget widgets""".split()
)
HEAD_WORDS = frozenset("header masthead".split())
# Of these, the names that sections of an article bear as well.
ALSO_INSIDE = frozenset(
    """alert banner copyright disclaimer dropdown footer legal login menu notice notification pager pagination related
    recommended respond search skip tags toolbar topbar widget widgets""".split()
)
# Words of a class that only say where such a part stands or how it is built.
PLAIN_WORDS = frozenset(
    "area bar block bottom box container content global inner item items left list main outer page primary reader readers right secondary section site slot thread top unit user users visitor visitors wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[A-Za-z][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
READ = frozenset("class hidden id itemprop role".split())
SIZES = re.compile(r"\d+(?:x\d+)*")
WORDS = re.compile(r"[a-z]+")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), HOST, 1))


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts)) - (1 << 63)


class Element:
    __slots__ = ("tag", "path", "prior", "noise", "main", "marks", "children")

    def __init__(self, tag, path, prior, noise, main, marks=()):
        self.tag, self.path, self.prior, self.noise, self.main, self.marks = tag, path, prior, noise, main, marks
        self.children: list[str] = []


class Page:
    """A page's text blocks and its block elements.

    A path is the tuple of hashes of the nodes from the root down. ``noise`` is what stands in
    an element that is no article wherever it stands; ``marks`` are the elements around a block
    that only a name, a role or ``form`` makes unlikely.
    """

    def __init__(self, source: str):
        root = Element("", (_hash(""),), 1.0, False, False)
        self.stack = [root]
        self.open: Counter[str] = Counter()  # tags of the stack
        self.elements = [root]
        self.blocks: list[tuple[str, Element]] = []
        self.marked: list[int] = []  # the node of each mark
        self.holders: list[bool] = []  # of each mark: whether an article or main is inside
        self.pieces: list[str] = []
        self._read(source)
        self._flush()

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            found = TOKEN.search(source, at)
            stop = found.start() if found else end
            if stop > at:
                self.pieces.append(source[at:stop])
            if not found:
                break
            at = found.end()
            if found[1]:
                self._close(found[1].lower())
            elif found[2]:
                tag = found[2].lower()
                self._open(tag, found[3])
                if tag in RAW:
                    close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
                    at = close.end() if close else end
                elif tag == "plaintext":
                    break

    def _freed(self, blocks: list[tuple[str, Element]]) -> set[int]:
        """Nodes of marks that hold the page's only article, or most of its text."""
        if not self.holders or any(e.main and not e.marks for _, e in blocks):
            return set()
        held = [0] * len(self.holders)
        for text, e in blocks:
            for mark in e.marks:
                held[mark] += len(text)
        freed = [i for i, holds in enumerate(self.holders) if holds and held[i]]
        if not freed:
            total = sum(len(t) for t, _ in blocks)
            freed = [i for i, n in enumerate(held) if 2 * n > total]
        return {self.marked[i] for i in freed}

    def _flush(self) -> None:
        if self.pieces:
            text = " ".join(html.unescape("".join(self.pieces)).split())
            if text:
                self.blocks.append((text, self.stack[-1]))
            self.pieces = []

    def _pop_to(self, at: int) -> None:
        self._flush()
        for e in self.stack[at:]:
            self.open[e.tag] -= 1
        del self.stack[at:]

    def _open(self, tag: str, attributes: str) -> None:
        if tag in RAW or tag == "br" or tag == "hr":
            if tag not in ("title", "script", "style"):
                self.pieces.append(" ")
            if tag == "hr":
                self._flush()
            return
        if tag in VOID or tag in INLINE:
            if not (found := self._named(attributes)) or tag in VOID:
                return
            if not self._is_noise(tag, found, True) and not self._named_part(tag, found, True):
                return
            self._flush()
        else:
            found = self._named(attributes)
            if tag in ENDS_P or tag == "body":
                self._end(("head",), ())
            if tag in ENDS_P:
                self._end(("p",), ("button", "table", "td", "th", "caption"))
            if tag in IMPLIED:
                self._end(*IMPLIED[tag])
            self._flush()
        above = self.stack[-1]
        opens = tag in ("article", "main") or found.get("role") == "main" or found.get("itemprop") == "articlebody"
        own = self._is_noise(tag, found, above.main)
        part = None if own else self._named_part(tag, found, above.main)
        prior = UNLIKELY if own else part or 1.0
        noise, marks = above.noise or own, above.marks
        if opens and not noise:
            for mark in marks:
                self.holders[mark] = True
        label = " ".join([tag, *sorted(set(found.get("class", "").split())), "#" + found.get("id", "")])
        label = re.sub(r"\d+", "0", label)
        label += "".join(f" {n}={found[n]}" for n in ("role", "itemprop", "hidden") if n in found)
        above.children.append(label)
        path = above.path
        if len(path) < DEPTH or prior < 1 and len(path) == DEPTH:
            path = (*path, _hash(str(path[-1]), label))
        if part == UNLIKELY and not noise and len(path) > len(above.path):
            marks = (*marks[: DEPTH - 1], len(self.holders))
            self.marked.append(path[-1])
            self.holders.append(opens)
        made = Element(tag, path, prior, noise, above.main or opens, marks)
        if len(path) > len(above.path):
            self.elements.append(made)
        self.stack.append(made)
        self.open[tag] += 1

    def _close(self, tag: str) -> None:
        if tag == "br":
            self.pieces.append(" ")
        if not self.open[tag]:
            return
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag == tag:
                self._pop_to(at)
                return
            if tag in INLINE and self.stack[at].tag not in INLINE:
                return

    def _end(self, tags, scope) -> None:
        """Close the outermost of the given elements that stand open inside the scope."""
        left = sum(self.open[t] for t in tags)
        cut, at = None, len(self.stack) - 1
        while left and at and self.stack[at].tag not in scope:
            if self.stack[at].tag in tags:
                cut, left = at, left - 1
            at -= 1
        if cut is not None:
            self._pop_to(cut)

    @staticmethod
    def _named(attributes: str) -> dict[str, str]:
        if not attributes or "=" not in attributes and "hidden" not in attributes:
            return {}
        found: dict[str, str] = {}
        for m in ATTRIBUTE.finditer(attributes):
            if (name := m[1].lower()) in READ:
                found.setdefault(name, html.unescape(m[2] or m[3] or m[4] or "").lower())
        return found

    @staticmethod
    def _is_noise(tag: str, found: dict[str, str], in_main: bool) -> bool:
        """What is no article wherever it stands."""
        return tag in NOISE_TAGS and tag != "form" or "hidden" in found or tag == "header" and not in_main

    @staticmethod
    def _named_part(tag: str, found: dict[str, str], in_main: bool) -> float | None:
        """The prior of what its name or role tells to be hardly an article: a whole class or
        id made of such words."""
        classes = found.get("class", "").split()
        if tag == "form" or found.get("role") in NOISE_ROLES:
            return UNLIKELY
        if tag in ("html", "body", "main", "article"):
            return UNLIKELY if {"comment", "comments"} & set(classes) else None
        names = NOISE_WORDS if in_main else NOISE_WORDS | HEAD_WORDS
        hits = [words for name in classes if (words := set(WORDS.findall(SIZES.sub(" ", name)))) & names and words <= names | PLAIN_WORDS]
        words = set(WORDS.findall(found.get("id", "")))
        if tag not in HEADINGS and words & names and words <= names | PLAIN_WORDS:
            hits.append(words)
        if not hits:
            return None
        return DOUBTFUL if in_main and all(w & names <= ALSO_INSIDE for w in hits) else UNLIKELY

    def unlikely(self) -> set[int]:
        """Nodes that their prior alone brings below the least importance."""
        return {e.path[-1] for e in self.elements if e.prior < LEAST}

    def text(self, low: set[int] | None = None) -> str:
        """The main text, in page order: blocks under no low branch (by default those that are
        unlikely), and inside the articles if these hold their share of it."""
        low = self.unlikely() if low is None else low
        freed = self._freed([b for b in self.blocks if not b[1].noise])
        low = low - freed
        kept = [(t, e) for t, e in self.blocks if low.isdisjoint(e.path)]
        inside = sum(len(t) for t, e in kept if e.main)
        if inside and inside > MAIN_SHARE * sum(len(t) for t, _ in kept):
            kept = [b for b in kept if b[1].main]
        return " ".join(t for t, _ in kept)


def page_rows(source: str) -> list[tuple]:
    """A page's part of its host's tree: (page, node, path, children, text, times, prior) rows;
    the path is empty for the row that tells a node's child sequence."""
    page = Page(source)
    blocks = Counter((e.path, _hash(text)) for text, e in page.blocks)
    own = _hash(*[t for t, _ in page.blocks])
    rows = [(own, path[-1], list(path), None, text, n, None) for (path, text), n in blocks.items()]
    inside = {node for path, _ in blocks for node in path}
    styles: dict[int, list[str]] = {}
    labels: dict[int, set[str]] = {}
    priors: dict[int, float] = {}
    for e in page.elements:
        node = e.path[-1]
        if node in inside:
            kept = [c for i, c in enumerate(e.children) if not i or c != e.children[i - 1]]
            styles.setdefault(node, []).append("\x01".join(kept))
            labels.setdefault(node, set()).update(e.children)
            priors[node] = e.prior
    rows += [(own, node, [], len(labels[node]), _hash(*kept), 1, priors[node]) for node, kept in styles.items()]
    return rows


ROWS = "host string, page long, node long, path array<long>, children int, value long, times int, prior double"


def tree_rows(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = [
                    (host, *row)
                    for host, source in zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                    for row in page_rows(source)
                ]
                types = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.int32(), pa.float64()]
                names = ["host", "page", "node", "path", "children", "value", "times", "prior"]
                columns = zip(*rows) if rows else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    text = F.coalesce(quoted(html_col).cast("string"), F.lit(""))
    return pages.select(host_of(quoted(url_col)).alias("host"), text.alias("html")).mapInArrow(run, ROWS)


def importance(rows: DataFrame) -> DataFrame:
    """``host``, ``node``, ``m`` (different pages), ``prior``, ``importance`` (prior included)."""
    once = rows.groupBy("host", "page", "node", "path", "value").agg(
        F.max("times").alias("times"), F.max("children").alias("children"), F.max("prior").alias("prior")
    )
    pages = rows.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("m"))
    n = F.col("times")
    spread = F.log("c") - F.col("s") / F.col("c")  # a value's entropy over the pages, in nats
    values = once.groupBy("host", "node", "path", "value").agg(
        F.sum(n).alias("c"), F.sum(n * F.log(n.cast("double"))).alias("s"), F.max("children").alias("children"), F.max("prior").alias("prior")
    )
    texts = (
        values.filter(F.size("path") > 0)
        .select("host", F.explode("path").alias("node"), spread.alias("h"), (F.element_at("path", -1) == F.col("node")).alias("own"))
        .groupBy("host", "node")
        .agg(F.sum("h").alias("h"), F.count("*").alias("texts"))
    )
    styles = (
        values.filter(F.size("path") == 0)
        .groupBy("host", "node")
        .agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.log(F.col("c").cast("double"))).alias("s"), F.max("children").alias("children"), F.max("prior").alias("prior"))
        .select("host", "node", spread.alias("style"), "children", "prior")
    )
    base = F.log(F.col("m").cast("double"))
    content = 1 - F.col("h") / (F.col("texts") * base)
    looks = F.col("style") / base
    held = F.pow(F.lit(DECAY), F.col("children"))
    own = F.when(F.col("m") > 1, (1 - held) * looks + held * content).otherwise(1.0)
    smooth = (own * F.col("m") + 1) / (F.col("m") + 1)
    return (
        texts.join(styles, ["host", "node"])
        .join(pages, "host")
        .select("host", "node", "m", "prior", (F.col("prior") * smooth).alias("importance"))
    )


def low_branches(pages: DataFrame, *, least: float = LEAST, **columns) -> DataFrame:
    """``host`` and ``low``, its branches of low importance."""
    rows = staged(tree_rows(pages, **columns), "style-tree")
    found = importance(rows).filter(F.col("importance") < least)
    return found.groupBy("host").agg(F.collect_set("node").alias("low"))


def main_text(
    pages: DataFrame,
    *,
    url_col: str = "url",
    html_col: str = "html",
    least: float = LEAST,
    into: str = "text",
) -> DataFrame:
    """``pages`` with their main text in the column ``into``."""

    @F.arrow_udf("string")
    def extract(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for sources, low in batches:
            out = [Page(s).text(set(n or ())) for s, n in zip(sources.to_pylist(), low.to_pylist())]
            yield pa.array(out, pa.string())

    text = F.coalesce(quoted(html_col).cast("string"), F.lit(""))
    low = staged(low_branches(pages, least=least, url_col=url_col, html_col=html_col), "low-branches")
    host, list_ = fresh(pages, "tree_host"), fresh(pages, "tree_low")
    names = low.select(F.col("host").alias(host), F.col("low").alias(list_))
    joined = pages.join(names, host_of(quoted(url_col)) == F.col(host), "left")
    return joined.select(*without(pages, into), extract(text, F.col(list_)).alias(into))
