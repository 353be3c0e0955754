"""Main text of web pages, less site templates and page furniture.

Site template removal: a page is parsed into elements, each subtree is hashed
(tag, class, id, texts, children), Spark counts in how many pages of a host each
hash occurs, and subtrees that recur are deleted.  Counting alone cannot tell a
menu that differs on each page from text, nor an article that a host shows
twice from a template.  So elements whose tag, role or class says what they are
(menus, notices, adverts, forms, reader comments and so on) go in any case, and
in a page's article, headings, paragraphs and whatever holds one are never
taken for a template.  A class or id says so by a whole name, not by a part of
one: ``post-comments`` does, ``comments-open`` and ``has-sidebar`` do not.

The text is that of the page's ``article`` elements (outside furniture), else of
``main``, else of such elements inside what only a class calls furniture, else
of the body.  Each block element is one block: character
references decoded, white space turned into one space, trimmed; blocks are
joined by a newline.

Null and empty pages, and pages without text, give an empty string.  Pages with
an empty host (null URL or one without ``://``) share no templates.  Repeated
rows are pages of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ZIPPED, lean, zipped
from tidemark.llm.url_filter import host_and_path

#: A subtree is a template when it is on so many pages of its host, and on so large a share of them.
LEAST_PAGES = 5
LEAST_SHARE = 0.1

# Element names of HTML and words used for page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp noscript template".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul caption legend option".split()
)
CLOSES_PARAGRAPH = BLOCKS - frozenset("body html li dd dt td th tr tbody thead tfoot caption legend option".split())
FURNITURE_TAGS = frozenset(
    "nav aside footer form button select input dialog menu search canvas svg object audio video map head".split()
) | RAW
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer footer header masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted "
    "related share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
#: After such a word, these name a part of it; before it, those name the state of something else.
FURNITURE_PARTS = frozenset(
    "area bar block body box button buttons content entry form group icons inner item items left link links list meta overlay "
    "posts reply right section signup slot thread unit".split()
)
STATES = frozenset("has hide is no show with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEADING_WORDS = frozenset("banner header masthead".split())

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}
_PARENTS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
_SIBLINGS = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}


@lru_cache(maxsize=4096)
def named_word(name: str) -> str:
    """The word for page furniture that a class or id is made of: its last piece, or
    its first before the name of a part; empty if there is none."""
    pieces = [piece.rstrip("0123456789") for piece in re.split("[-_]+", name) if piece and not piece[0].isdigit()]
    if not pieces or not STATES.isdisjoint(pieces):
        return ""
    if pieces[-1] in FURNITURE_WORDS:
        return pieces[-1]
    return pieces[0] if pieces[0] in FURNITURE_WORDS and FURNITURE_PARTS.issuperset(pieces[1:]) else ""


class Element:
    """``furniture`` goes, ``by_name`` tells that only a class or id says so."""

    __slots__ = ("tag", "shown", "furniture", "by_name", "holds_text", "items", "digest", "root")

    def __init__(self, tag: str, attributes: str):
        self.tag = tag
        self.items: list[str | Element] = []
        self.digest = b""
        self.furniture = tag in FURNITURE_TAGS
        self.by_name = False
        self.holds_text = tag in HEADINGS or tag in ("p", "blockquote", "pre")
        self.root = tag if tag in ("article", "main") else ""
        self.shown = tag
        if attributes:
            for name, *values in _ATTRIBUTE.findall(attributes):
                value, name = "".join(values).lower(), name.lower()
                self.shown += f" {name}={value}"
                if name == "role":
                    self.furniture |= value in FURNITURE_ROLES
                    self.root = self.root or ("main" if value == "main" else "")
                elif name == "hidden":
                    self.furniture = True
                elif tag not in ("html", "body", "main"):
                    words = set(map(named_word, value.split())) - {""}
                    self.by_name |= bool(words - HEADING_WORDS if tag in HEADINGS else words)
        self.by_name &= not self.furniture
        self.furniture |= self.by_name

    def close(self) -> None:
        digest = xxhash.xxh3_64(self.shown.encode())
        for item in self.items:
            if isinstance(item, str):
                digest.update(b"\0" + " ".join(item.split()).encode())
            else:
                digest.update(b"\1" + item.digest)
                self.holds_text |= item.holds_text
        self.digest = digest.digest()


def parse(page: str) -> Element:
    """The page as a tree.  Missing end tags are implied; what has no start is ignored."""
    root = Element("html", "")
    stack, at = [root], 0
    opened: Counter[str] = Counter()

    def enter(element: Element) -> None:
        stack.append(element)
        opened[element.tag] += 1

    def leave(depth: int) -> None:
        while len(stack) > depth:
            element = stack.pop()
            opened[element.tag] -= 1
            element.close()

    def innermost(names: tuple[str, ...], bounds: tuple[str, ...] = ()) -> int:
        if not any(opened[name] for name in names):
            return 0
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in names:
                return depth
            if stack[depth].tag in bounds:
                return 0
        return 0

    for token in _TOKEN.finditer(page):
        if token.start() < at:  # inside raw text
            continue
        if token.start() > at:
            stack[-1].items.append(html.unescape(page[at : token.start()]))
        at = token.end()
        end, end_closed, start, attributes, closed = token.groups()
        if end and end_closed:
            end = end.lower()
            depth = innermost((end,))
            inline = end not in BLOCKS
            if depth and not (inline and any(each.tag in BLOCKS for each in stack[depth + 1 :])):
                leave(depth)
        elif start and closed:
            start = start.lower()
            if start in CLOSES_PARAGRAPH and (depth := innermost(("p",), ("button", "td", "th", "caption"))):
                leave(depth)
            if start in _PARENTS and (depth := innermost(_SIBLINGS.get(start, (start,)), _PARENTS[start])):
                leave(depth)
            if start in ("html", "body"):
                continue
            element = Element(start, attributes)
            stack[-1].items.append(element)
            if start in RAW:
                found = _RAW_END[start].search(page, at)
                at = found.start() if found else len(page)
                element.items.append(page[token.end() : at])
                element.close()
                if found:
                    at = page.find(">", at) + 1 or len(page)
            elif start in VOID or attributes.endswith("/"):
                element.close()
                if attributes.endswith("/") and start not in VOID:
                    enter(element)  # the slash means nothing on such elements
            else:
                enter(element)
    if at < len(page):
        stack[-1].items.append(html.unescape(page[at:]))
    leave(0)
    return root


def _roots(tree: Element) -> list[Element]:
    """The elements whose text is wanted."""
    for entered in (False, True):
        for wanted in ("article", "main"):
            found, stack = [], [tree]
            while stack:
                element = stack.pop()
                if element.root == wanted and not element.furniture:
                    found.append(element)
                elif not element.furniture or (entered and element.by_name):
                    stack += [item for item in reversed(element.items) if not isinstance(item, str)]
            if found:
                return found
    return [tree]


def _parts(tree: Element) -> Iterator[tuple[Element, bool]]:
    """Every element but the tree itself, and whether counting may delete it."""
    roots = {id(each) for each in _roots(tree)} - {id(tree)}
    stack = [(tree, False)]
    while stack:
        element, wanted = stack.pop()
        if element is not tree:
            yield element, not (wanted and element.holds_text) and id(element) not in roots
        inside = wanted or id(element) in roots
        stack += [(item, inside) for item in element.items if not isinstance(item, str)]


def subtree_hashes(page: str) -> set[int]:
    """Hashes of the subtrees that may be templates: those with text that hold no wanted text."""
    tree = parse(page)
    roots = {id(each) for each in _roots(tree)} - {id(tree)}
    holding: set[int] = set()
    if roots:  # what lies around the wanted elements is no template
        above: dict[int, int] = {}
        stack = [tree]
        while stack:
            element = stack.pop()
            inner = [item for item in element.items if not isinstance(item, str)]
            above.update((id(item), id(element)) for item in inner)
            stack += inner
        for each in roots:
            while (each := above.get(each)) is not None and each not in holding:
                holding.add(each)
    return {
        int.from_bytes(element.digest, "little", signed=True)
        for element, free in _parts(tree)
        if free and element.items and id(element) not in holding
    }


def main_text(page: str, templates: frozenset[int] = frozenset()) -> str:
    """The wanted text without furniture and without the given subtrees."""
    tree = parse(page)
    free = {id(element) for element, each in _parts(tree) if each} if templates else frozenset()
    blocks: list[str] = []
    line: list[str] = []

    def end_block() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    for root in _roots(tree):
        stack: list[str | Element | None] = [root]
        while stack:
            item = stack.pop()
            if item is None:
                end_block()
            elif isinstance(item, str):
                line.append(item)
            elif item.tag == "br":
                line.append(" ")
            elif item.furniture or (id(item) in free and int.from_bytes(item.digest, "little", signed=True) in templates):
                line.append(" ")
            elif item.tag in BLOCKS:
                end_block()
                stack += [None, *reversed(item.items)]
            else:
                stack += reversed(item.items)
        end_block()
    return "\n".join(blocks)


def site_templates(pages: DataFrame) -> DataFrame:
    """(host, subtree, pages, page) of subtrees that recur on their host, once per
    page they are on; from (page, host, html) rows, ``page`` telling rows apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (page, host, subtree)
                for page, host, source in zip(*(batch.column(at).to_pylist() for at in range(3)))
                for subtree in subtree_hashes(source or "")
            ]
            columns = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(each, kind) for each, kind in zip(columns, (pa.int64(), pa.string(), pa.int64()))], names=["page", "host", "subtree"]
            )

    known = pages.where("host != ''")
    found = known.select("page", "host", "html").mapInArrow(lean(run), "page bigint, host string, subtree bigint")
    sizes = known.groupBy("host").agg(F.count("*").alias("host_pages"))
    counts = (
        found.groupBy("host", "subtree")
        .agg(F.count("*").alias("pages"))
        .where(F.col("pages") >= LEAST_PAGES)
        .join(sizes, "host")
        .where(F.col("pages") >= LEAST_SHARE * F.col("host_pages"))
        .drop("host_pages")
    )
    return found.join(counts, ["host", "subtree"])


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_templates) of every row."""
    host, _ = host_and_path(F.col(url))
    rows = pages.select(
        F.xxhash64(key, url, source).alias("page"), F.col(key).alias("page_id"), F.col(url).alias("url"), host.alias("host"), F.col(source).alias("html")
    )
    templates = site_templates(rows).groupBy("page").agg(F.collect_set("subtree").alias("templates"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deleted = [frozenset(each or ()) for each in batch.column(4).to_pylist()]
            packed = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            sources = [pa.decompress(each, size, codec="zstd", asbytes=True).decode() if size else "" for each, size in packed]
            texts = [main_text(each, gone) for each, gone in zip(sources, deleted)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(map(len, deleted), pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_templates"],
            )

    joined = zipped(rows.drop("host"), "html").join(templates, "page", "left")
    joined = joined.select("page_id", "url", ZIPPED, f"{ZIPPED}_size", "templates")
    kind = pages.schema[key].dataType.simpleString()
    return joined.mapInArrow(lean(run), f"page_id {kind}, url string, text string, n_chars bigint, n_templates bigint")
