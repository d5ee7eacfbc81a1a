"""Main text of web pages by flat blocks and a decision tree.

A page is cut into flat text blocks at block-level tags. Each block is described by
its number of words and the share of them inside links, the same of the blocks
before and after it, and by what encloses it. A decision tree, grown by Gini
impurity on a small table of labelled blocks, says which blocks are main text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by what they mean here.
RAW = frozenset("script style template iframe object svg canvas textarea select title annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output picture q "
    "rp rt ruby s samp small source span strike strong sub sup time tt u var wbr br "
    "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace "
    "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_PEERS = frozenset("p li dt dd tr td th option".split())

# What class names, ids and roles say about an element. A name counts if one
# of its parts is listed here and the others only say what kind of box it is: "ad-slot" is an
# advert, "share-prices" and "has-sidebar" are not what one of their parts says.
BOX_NAMES = frozenset(
    "area articles block bottom box container content fixed global group holder inner item left links list main mobile outer "
    "page panel posts stories "
    "primary right row secondary section site slot sticky sub text top unit wrap wrapper".split()
)
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner bar breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright disqus footer form gdpr header login masthead menu menus modal nav navbar "
    "navigation newsletter notice notices pager pagination popup privacy promo promoted promotion recommended "
    "related replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription toolbar widget widgets complementary contentinfo alert dialog".split()
)
#: Those that an article or main element can be named, and those that name its own head.
NOT_ARTICLES = frozenset("ad advert comment comments promo related replies reply sidebar sponsored".split())
#: Those whose articles are not the page's own.
HOLDERS = frozenset("comment comments disqus promo recommended related replies reply sidebar sponsored".split())
HEADER_NAMES = frozenset("banner bar form header masthead".split())
CONTENT_NAMES = frozenset("article body content entry main post story text".split())

_TAG = re.compile(
    r"<!--(?:.*?-->|.*+)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>|<(?:[!?/a-zA-Z][^<]*+)?\Z",
    re.DOTALL,
)
_NAMING = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)


class Block(NamedTuple):
    """A flat block: its text, words, words in links, and what it stands in."""

    text: str
    words: int
    linked: int
    article: int  # inside article, main or an element named so
    aside: int  # inside an element of navigation, notes, forms or one named so
    heading: int
    page_part: int  # inside header or footer outside of an article


_ARTICLE_TAGS = frozenset(["article", "main"])
_ASIDE_TAGS = frozenset(["nav", "aside", "form", "menu", "dialog", "button", "fieldset", "head"])
_HOLDER_TAGS = frozenset(["nav", "aside", "menu", "dialog", "head"])
_PART_TAGS = frozenset(["header", "footer"])


def _names(attributes: str) -> list[set[str]]:
    """The parts of each class name, id and role."""
    found = []
    for match in _NAMING.finditer(attributes):
        value = match[1] or match[2] or match[3] or ""
        found += [{p.lower() for p in _PART.findall(name)} for name in value.split()]
    return found


class Kind(NamedTuple):
    """What an element makes of the blocks inside."""

    article: int = 0
    aside: int = 0
    part: int = 0
    #: An aside that its articles belong to.
    holder: int = 0


@lru_cache(maxsize=1 << 12)
def _kind(tag: str, attributes: str, in_article: bool) -> Kind:
    if tag in ("html", "body"):
        return Kind()
    names = _names(attributes) if "=" in attributes else []
    listed = NOT_ARTICLES if tag in _ARTICLE_TAGS else BOILERPLATE_NAMES
    told: set[str] = set()
    for name in names:
        if name & listed and name <= listed | BOX_NAMES | BOILERPLATE_NAMES:
            told |= name & listed
    content = any(name & CONTENT_NAMES for name in names)
    if in_article or content:
        told -= HEADER_NAMES
    aside = tag in _ASIDE_TAGS or bool(told) or bool(attributes) and bool(_HIDDEN.search(attributes))
    article = not aside and (tag in _ARTICLE_TAGS or tag in ("div", "section") and content)
    part = tag in _PART_TAGS and not in_article or tag == "footer"
    holder = aside and (tag in _HOLDER_TAGS or bool(told & HOLDERS))
    return Kind(int(article), int(aside), int(part), int(holder))


def blocks(page: str) -> list[Block]:
    """The page's blocks in order, references decoded and white space made single.

    What stands around an article or a main element, a form or a wrapper with a name of
    its layout, says nothing about what is inside; only that an article stands among
    comments, teasers or the like does.
    """
    found: list[Block] = []
    stack: list[tuple[str, Kind, tuple[int, int]]] = []
    article = aside = part = holder = heading = link = 0
    pieces: list[str] = []
    linked: list[str] = []

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                in_links = len(html.unescape(" ".join(linked)).split()) if linked else 0
                found.append(
                    Block(text, text.count(" ") + 1, in_links, int(article > 0), int(aside > 0), int(heading > 0), int(part > 0))
                )
            pieces.clear()
            linked.clear()

    def leave(depth: int) -> None:
        nonlocal article, aside, part, holder, heading
        while len(stack) > depth:
            tag, kind, (aside, part) = stack.pop()
            article, holder = article - kind.article, holder - kind.holder
            heading -= tag in _HEADINGS

    at, size = 0, len(page)
    while at < size:
        match = _TAG.search(page, at)
        stop = match.start() if match else size
        if stop > at:
            pieces.append(page[at:stop])
            if link:
                linked.append(page[at:stop])
        if not match:
            break
        at = match.end()
        tag = match[2] or match[5]
        if not tag:
            continue
        tag, closing, attributes = tag.lower(), match[1] or match[4], match[3] or match[6] or ""
        if tag in RAW:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*+>", re.IGNORECASE).search(page, at)
                if end or tag in ("script", "style", "textarea", "title"):
                    at = end.end() if end else size
            continue
        if tag in INLINE:
            if tag == "a":
                link = 0 if closing else 1
            elif tag == "br":
                pieces.append(" ")
            if "=" not in attributes or closing or tag in VOID:
                continue
            # An inline element that is named or hidden counts as a block of its own.
            if tag not in ("span", "small") or not _kind(tag, attributes, article > 0).aside:
                continue
        flush()
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    leave(depth)
                    break
            continue
        if tag in VOID or attributes.endswith("/") and tag not in CLOSED_BY_PEERS:
            continue
        if stack and tag in CLOSED_BY_PEERS and stack[-1][0] == tag or stack and stack[-1][0] == "p":
            leave(len(stack) - 1)
        kind = _kind(tag, attributes, article > 0)
        stack.append((tag, kind, (aside, part)))
        if kind.article and (tag == "main" or tag == "article" and not holder):
            aside = part = 0
        article, aside, part = article + kind.article, aside + kind.aside, part + kind.part
        holder += kind.holder
        heading += tag in _HEADINGS
    flush()
    return found


_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])

FEATURES = (
    "words",
    "link density",
    "words before",
    "link density before",
    "words after",
    "link density after",
    "in article",
    "in aside",
    "in heading",
    "in page part",
    "page has article",
)


def features(page: list[Block]) -> np.ndarray:
    """A row for each block: itself, its neighbours, and what encloses it."""
    rows = np.zeros((len(page) + 2, len(FEATURES)))
    for i, b in enumerate(page, 1):
        rows[i, 0], rows[i, 1] = b.words, b.linked / b.words
        rows[i, 6:10] = b.article, b.aside, b.heading, b.page_part
    rows[1:-1, 2:4], rows[1:-1, 4:6] = rows[:-2, :2], rows[2:, :2]
    rows[:, 10] = rows[:, 6].any()
    return rows[1:-1]


class Leaf(NamedTuple):
    keep: bool


class Node(NamedTuple):
    feature: int
    limit: float
    low: Node | Leaf
    high: Node | Leaf


def _impurity(hits: np.ndarray, rows: np.ndarray) -> np.ndarray:
    share = hits / rows
    return rows * share * (1 - share)


def grow(rows: np.ndarray, keep: np.ndarray, depth: int = 8) -> Node | Leaf:
    """A tree that splits where Gini impurity falls most; the first such place on a tie."""
    if depth == 0 or keep.all() or not keep.any():
        return Leaf(bool(2 * keep.sum() >= len(keep)) if len(keep) else False)
    best = (_impurity(np.array([keep.sum()]), np.array([len(keep)]))[0] - 1e-9, None, 0.0)
    for f in range(rows.shape[1]):
        order = np.argsort(rows[:, f], kind="stable")
        values, hits = rows[order, f], np.cumsum(keep[order])
        cuts = np.flatnonzero(np.diff(values) > 0)
        if not len(cuts):
            continue
        left = cuts + 1
        score = _impurity(hits[cuts], left) + _impurity(hits[-1] - hits[cuts], len(keep) - left)
        at = int(np.argmin(score))
        if score[at] < best[0]:
            best = (score[at], f, (values[cuts[at]] + values[cuts[at] + 1]) / 2)
    _, f, limit = best
    if f is None:
        return Leaf(bool(2 * keep.sum() >= len(keep)))
    low = rows[:, f] <= limit
    return Node(f, float(limit), grow(rows[low], keep[low], depth - 1), grow(rows[~low], keep[~low], depth - 1))


def decide(tree: Node | Leaf, rows: np.ndarray) -> np.ndarray:
    if isinstance(tree, Leaf):
        return np.full(len(rows), tree.keep)
    low = rows[:, tree.feature] <= tree.limit
    out = np.empty(len(rows), bool)
    out[low], out[~low] = decide(tree.low, rows[low]), decide(tree.high, rows[~low])
    return out


def train(labelled: list[list[tuple[bool, str]]]) -> Node | Leaf:
    """Grow the tree on pages given as pieces of HTML, each labelled as main text or not."""
    tables, truths = [], []
    for page in labelled:
        found = blocks("".join(piece for _, piece in page))
        truth: list[bool] = []
        for i in range(len(page)):
            # Blocks that end in this piece have its label.
            upto = len(blocks("".join(piece for _, piece in page[: i + 1])))
            truth += [page[i][0]] * (upto - len(truth))
        tables.append(features(found))
        truths.append(np.array(truth[: len(found)], bool))
    return grow(np.concatenate(tables), np.concatenate(truths))


def extract(page: str, tree: Node | Leaf) -> str:
    """Main text blocks of a page, in order, one to a line."""
    found = blocks(page)
    if not found:
        return ""
    kept = decide(tree, features(found))
    return "\n".join(b.text for b, k in zip(found, kept, strict=True) if k)


def main_texts(
    pages: DataFrame,
    labelled: list[list[tuple[bool, str]]],
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Rows ``page_id``, ``url``, ``text``, ``n_chars``: one for every row of the table.

    A null or empty page, or one without main text, has an empty text. Repeated rows
    stay; ids and urls pass through, nulls too; an empty table gives an empty result.
    The whole page is read, however long, and other columns are not, whatever they are
    called; a page is handled by itself, so nothing is shuffled.
    """
    tree = train(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(p, tree) if p else "" for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    picked = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    return picked.mapInArrow(run, "page_id long, url string, text string, n_chars long")
