"""Main text of web pages with site template removal.

A page becomes an element tree (end tags that HTML lets one omit are
implied).  Every element subtree of the page gets a hash of its tags and
texts; Spark counts on how many distinct pages of a host each occurs, and
subtrees that recur on many pages of that host are deleted.  Only then is
the content chosen from what is left: the article or, without one, the main
element, the content block or the body.  Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and comments also go by tag, role
or class name; a name counts as a whole (``comments``), or if all its parts
are such words or words of layout (``comment-list``, not ``social-science``),
and in an article no class makes a paragraph or heading vanish but an
advert's.

Which rule a subtree falls under depends on where it is in the page as
given.  Outside the content everything is template that is on a fifth of a
host's distinct pages, and what holds an article on half of them.  Headings, lists, tables, quotations and inline
elements of the content are never template, however often they recur: copies
and common passages are content.  Containers are from half of a host's pages
on.  Paragraphs are if they recur on nearly all pages, and in a block that
only a class or id marks as content from half of a host's pages on.  Pages
of one host with equal content are copies and count once, so an only article
is never template; of several articles on a page those that recur are.

A quoted attribute ends at a quote before white space, ``/`` or ``>``;
without one the tag ends at the next ``>``.  End tags without a partner are
ignored, and parsing takes linear time.

Null and empty pages give the empty text.  Pages without a host (null or
relative url) have no site, so no template.  Repeated rows give repeated
results and count as one page of their host.  An empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import chunks, plain, prepare
from civiclake.session import materialize

#: Fixed values of HTML: element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Start tags that end an open element of the other kinds (up to a boundary element).
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody")}
BOUNDARY = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",), "tbody": ("table",)}
P_BOUNDARY = frozenset("article aside blockquote body div dd dt fieldset figure footer form header html li main nav section table td th".split())

#: What is no main text, by tag, ARIA role, and word of a class or id.
DROP_TAGS = frozenset("nav header footer aside form script style noscript template iframe svg math object canvas button select textarea title head menu dialog input".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup login "
    "sidebar aside widget menu nav navbar navigation breadcrumb breadcrumbs pagination pager share sharing social related recommended recommendations comments comment disqus replies footer header masthead copyright toolbar skip".split()
)
#: Words of an advert: by these alone a paragraph or heading of an article goes.
AD_WORDS = frozenset("ad ads advert adverts advertisement advertising adbox adsense sponsor sponsored".split())
#: Words of layout that may stand beside them in a name, and words that an article's own parts bear as well.
LAYOUT_WORDS = frozenset("area bar block body bottom box button buttons container content form group holder inner item items left link links list main outer page panel post posts right section site slot strip text thread title top unit wrap wrapper".split())
OWN_WORDS = frozenset(("header", "masthead"))
CONTENT_WORDS = frozenset("content article post entry story main body text".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Elements inside the content that may be template; the others are content.
CONTAINERS = frozenset(("div", "section", "center", "fieldset", "details"))
#: Kinds of candidates: the lowest two bits of a template hash.
CONTAINER, PARAGRAPH, ARTICLE_PARAGRAPH, OUTSIDE = 0, 1, 2, 3

# a tag without its ">" is text, and matches as a whole all the same: no place is scanned twice
TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/<>]*+)((?:=\s*+"[^"]*"(?=[\s/>])|=\s*+'[^']*'(?=[\s/>])|[^<>])*+)(>?)|<[!?/][^>]*(?:>|$)""", re.S)
ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
COMMENT_ID = re.compile(r"(?:c|comment|reply)[-_]?\d+", re.I)
#: Nothing to delete: the frame of a page, and elements without text of their own.
NEVER_TEMPLATE = frozenset(("#root", "html", "body")) | VOID | RAW


@dataclass(slots=True)
class Node:
    tag: str
    attrs: dict[str, str]
    parent: int
    children: list = field(default_factory=list)


def parse(source: str) -> list[Node]:
    """Elements in document order; children are indices of elements or texts.  Element 0 is the root."""
    nodes = [Node("#root", {}, -1)]
    stack = [0]
    open_at: dict[str, list[int]] = {}  # depths of the open elements of each tag

    def text(s: str) -> None:
        if s:
            nodes[stack[-1]].children.append(html.unescape(s))

    def deepest(kinds: Iterable[str]) -> int:
        return max((open_at[k][-1] for k in kinds if open_at.get(k)), default=0)

    def cut(depth: int) -> None:
        """Close the open elements from a depth on; each is closed once, so all cuts take linear time."""
        while depth and len(stack) > depth:
            open_at[nodes[stack.pop()].tag].pop()

    def close(kinds: Iterable[str], until: Iterable[str]) -> None:
        depth = deepest(kinds)
        if depth > deepest(until):
            cut(depth)

    at = 0
    while m := TOKEN.search(source, at):
        text(source[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        if not m[4]:
            text(m[0])
            continue
        tag = m[2].lower()
        if m[1]:
            cut(deepest((tag,)))
            continue
        if tag in BLOCK and open_at.get("p"):
            close(("p",), P_BOUNDARY)
        if tag in ENDS:
            close(ENDS[tag], BOUNDARY[tag])
        attrs = {k.lower(): html.unescape(a or b or c) for k, a, b, c in ATTR.findall(m[3])} if m[3].strip(" /\t\r\n") else {}
        nodes.append(Node(tag, attrs, stack[-1]))
        nodes[stack[-1]].children.append(len(nodes) - 1)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
            at = end.end() if end else len(source)
        elif tag not in VOID:
            open_at.setdefault(tag, []).append(len(stack))
            stack.append(len(nodes) - 1)
    text(source[at:])
    return nodes


def names_of(node: Node) -> list[list[str]]:
    """The words of each class name and of the id, trailing numbers left out."""
    given = f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".split()
    return [WORD.findall(CAMEL.sub("-", n).lower()) for n in given]


def named(node: Node, words: frozenset[str]) -> bool:
    """Whether a class name or the id says one of the words, beside words of layout at most."""
    return any(words.intersection(n) and words.union(LAYOUT_WORDS).issuperset(n) for n in names_of(node))


def comment_like(node: Node) -> bool:
    return named(node, DROP_WORDS) or bool(COMMENT_ID.fullmatch(node.attrs.get("id", "")))


def dropped(node: Node, in_article: bool) -> bool:
    """Whether an element is no main text by its own marks."""
    a = node.attrs
    if node.tag in DROP_TAGS:
        return not (node.tag == "header" and in_article)
    if not a:
        return False
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", a.get("style", ""), re.I):
        return True
    if a.get("role", "").lower() in DROP_ROLES:
        return True
    if node.tag in ("main", "body", "html"):
        return False
    if node.tag == "article":
        return in_article and comment_like(node)
    if in_article:
        return named(node, AD_WORDS if node.tag == "p" or node.tag in HEADINGS else DROP_WORDS - OWN_WORDS)
    return named(node, DROP_WORDS)


@dataclass
class Page:
    """A parsed page: its elements, and those that are dropped by their own marks."""

    nodes: list[Node]
    out: list[bool]


def analysed(source: str) -> Page:
    nodes = parse(source)
    out = [False] * len(nodes)
    in_article = [False] * len(nodes)
    for i, n in enumerate(nodes[1:], 1):
        in_article[i] = in_article[n.parent] or nodes[n.parent].tag in ("article", "main")
        out[i] = out[n.parent] or dropped(n, in_article[i]) or (nodes[n.parent].tag == "header" and n.tag not in HEADINGS)
    return Page(nodes, out)


def within(nodes: list[Node], marks: list[bool]) -> list[bool]:
    """Which elements are marked or below a marked one (parents come first)."""
    out = list(marks)
    for i, n in enumerate(nodes[1:], 1):
        out[i] = out[i] or out[n.parent]
    return out


def content_roots(nodes: list[Node], gone: list[bool]) -> list[int]:
    """Where the content is among the elements that are not gone: outermost roots in page order."""
    pick = lambda test: [i for i, n in enumerate(nodes) if not gone[i] and test(n)]
    roots = pick(lambda n: n.tag == "article" and not comment_like(n))
    roots = roots or pick(lambda n: n.tag == "main" or n.attrs.get("role", "").lower() == "main")
    roots = roots or pick(lambda n: n.tag in ("div", "section", "td") and bool(CONTENT_WORDS.intersection(w for name in names_of(n) for w in name)))
    if not roots:
        return [0]
    chosen = set(roots)
    inside = within(nodes, [i in chosen for i in range(len(nodes))])
    return [i for i in roots if not inside[nodes[i].parent]]


def subtree_hashes(page: Page) -> np.ndarray:
    """Hash of each element's tags and texts, children first."""
    out = np.zeros(len(page.nodes), np.int64)
    for i in range(len(page.nodes) - 1, -1, -1):
        n = page.nodes[i]
        h = xxhash.xxh64(n.tag.encode())
        for c in n.children:
            h.update(b"\x01" + int(out[c]).to_bytes(8, "little", signed=True) if isinstance(c, int) else b"\x02" + " ".join(c.split()).encode("utf-8", "replace"))
        out[i] = np.uint64(h.intdigest()).astype(np.int64)
    return out


def candidates(page: Page, roots: list[int]) -> list[tuple[int, int]]:
    """Elements that may be template, each with its kind, by the content ``roots`` of the page as given."""
    first = page.nodes[roots[0]]
    marked = first.tag in ("article", "main", "#root") or first.attrs.get("role", "").lower() == "main"
    kinds = dict.fromkeys(CONTAINERS, CONTAINER) | {"p": ARTICLE_PARAGRAPH if marked else PARAGRAPH}
    top = set(roots)
    below = within(page.nodes, [i in top for i in range(len(page.nodes))])
    head = within(page.nodes, [n.tag == "head" for n in page.nodes])
    root_up: set[int] = set()
    for r in roots:
        while r >= 0 and r not in root_up:
            root_up.add(r)
            r = page.nodes[r].parent
    found = []
    for i, n in enumerate(page.nodes):
        if below[i] and i not in top:
            if n.tag in kinds:
                found.append((i, kinds[n.tag]))
        elif not head[i] and n.tag not in NEVER_TEMPLATE:
            found.append((i, CONTAINER if i in root_up else OUTSIDE))
    return found


def content_hash(roots: list[int], hashes: np.ndarray) -> int:
    """Equal for pages with equal content: those are copies."""
    return np.uint64(xxhash.xxh64(hashes[roots].tobytes()).intdigest()).astype(np.int64).item()


def marked_hash(h: int, kind: int) -> int:
    return (h & ~3) | kind


def main_text(page: Page, template: frozenset[int] | set[int]) -> str:
    """Blocks of the content in page order, without dropped and template elements."""
    nodes, gone = page.nodes, page.out
    roots = content_roots(nodes, gone)
    if template:
        hashes = subtree_hashes(page)
        recurring = [i for i, kind in candidates(page, roots) if marked_hash(int(hashes[i]), kind) in template]
        if recurring:
            gone = list(gone)
            for i in recurring:
                gone[i] = True
            gone = within(nodes, gone)
            roots = content_roots(nodes, gone)
    blocks, words = [], []

    def end_block() -> None:
        joined = " ".join("".join(words).split())
        if joined:
            blocks.append(joined)
        words.clear()

    for root in roots:
        stack: list = [root]
        while stack:
            x = stack.pop()
            if x is None:
                end_block()
            elif isinstance(x, str):
                words.append(x)
            elif not gone[x]:
                n = page.nodes[x]
                if n.tag == "br":
                    words.append(" ")
                elif n.tag in BLOCK:
                    end_block()
                    stack.append(None)
                stack.extend(reversed(n.children))
        end_block()
    return "\n\n".join(blocks)


@dataclass(frozen=True)
class TemplateRule:
    """On how many distinct pages, and on what share of a host's, a subtree must recur."""

    #: What is outside the content.
    min_pages_outside: int = 5
    share_outside: float = 0.2
    min_pages_in_article: int = 8
    share_in_article: float = 0.5
    #: Paragraphs of a block that only its class or id marks as content.
    min_pages_of_paragraph: int = 6
    share_of_paragraph: float = 0.5
    #: Other paragraphs: a notice of the site is on (nearly) all its pages, a common passage is not.
    min_pages_of_notice: int = 20
    share_of_notice: float = 0.95


def host_of(url):
    """Host of an absolute url in lower case, without user and port; empty otherwise."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:\s]+)", 1))


def subtree_counts(pages: DataFrame) -> DataFrame:
    """host, mark (hash and kind), n (distinct pages); mark null: all distinct pages of the host."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "html"):
            found: dict[tuple[str, int], list] = {}
            for host, source in zip(b.column("host").to_pylist(), plain(b.column("html")).to_pylist()):
                page = analysed(source)
                hashes = subtree_hashes(page)
                roots = content_roots(page.nodes, page.out)
                key = host, content_hash(roots, hashes)
                if key not in found:
                    found[key] = [None, *sorted({marked_hash(int(hashes[i]), kind) for i, kind in candidates(page, roots)})]
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in found], pa.string()), pa.array([c for _, c in found], pa.int64()), pa.array(list(found.values()), pa.list_(pa.int64()))],
                names=["host", "content", "marks"],
            )

    # copies bring equal marks unless their content root is marked differently: each then counts once for one of them
    each = pages.mapInArrow(work, "host string, content long, marks array<long>").groupBy("host", "content").agg(F.max("marks").alias("marks"))
    return each.select("host", F.explode("marks").alias("mark")).groupBy("host", "mark").agg(F.count("*").alias("n"))


def templates(pages: DataFrame, rule: TemplateRule) -> DataFrame:
    """host, template: hashes that recur.  Each takes a share of the host's pages, so a host has
    about as many as its pages have elements, whatever its size."""
    least = min(rule.min_pages_outside, rule.min_pages_in_article, rule.min_pages_of_paragraph, rule.min_pages_of_notice)
    found = materialize(subtree_counts(pages.where("host <> ''")).where(F.col("mark").isNull() | (F.col("n") >= least)), "html-counts")
    total = found.where("mark is null").select("host", F.col("n").alias("pages"))
    enough = lambda least, share: F.greatest(F.lit(least), F.lit(share) * F.col("pages"))
    kind = F.col("mark").bitwiseAND(3)
    need = (
        F.when(kind == PARAGRAPH, enough(rule.min_pages_of_paragraph, rule.share_of_paragraph))
        .when(kind == ARTICLE_PARAGRAPH, enough(rule.min_pages_of_notice, rule.share_of_notice))
        .when(kind == OUTSIDE, enough(rule.min_pages_outside, rule.share_outside))
        .otherwise(enough(rule.min_pages_in_article, rule.share_in_article))
    )
    many = found.where("mark is not null").join(total, "host").where(F.col("n") >= need)
    return many.groupBy("host").agg(F.collect_set("mark").alias("template"))


def extract(pages: DataFrame, rule: TemplateRule = TemplateRule(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: ``id_col``, ``url_col``, text and n_chars of the main text."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    # written, so Catalyst knows its size: small is broadcast, large is joined by host with skew split
    known = materialize(templates(rows.select("host", "html"), rule), "html-templates")
    joined = rows.join(known, "host", "left").select("page_id", "url", "html", "template")
    kind = rows.schema["page_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "html"):
            sets: dict = {}
            texts = []
            for source, template in zip(plain(b.column("html")).to_pylist(), b.column("template").to_pylist()):
                key = tuple(template or ())
                texts.append(main_text(analysed(source), sets.setdefault(key, frozenset(key))))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    out = joined.mapInArrow(work, f"page_id {kind}, url string, text string, n_chars long")
    return out.withColumnsRenamed({"page_id": id_col, "url": url_col})
