"""Main text of web pages from flat text blocks.

A page is cut into blocks at block-level tags. Each block has a few shallow
features: its words and link density, those of its neighbours, and what it lies
in. A small decision tree, grown from the labelled pages below, decides block by
block; kept blocks are joined in page order.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import bounded_batches, without

# Element names of HTML by the part they play here.
SKIPPED = {"script", "style", "template", "textarea", "title", "svg", "iframe", "noscript", "object", "select", "button", "canvas", "audio", "video"}
UNSHOWN = {"script", "style", "template", "noscript"}
# These hold no tags: they end with their first end tag.
RAW = {"script", "style", "textarea", "title"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "label", "input"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ASIDE = {"nav", "footer", "aside", "form", "dialog", "menu", "header"}
MAIN = {"article", "main"}
# Words in class, id or role that announce something beside the article.
HINTS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "sidebar", "side", "aside",
    "menu", "menubar", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "topbar",
    "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "discussion", "share", "sharing", "social",
    "related", "recommended", "recommendations", "newsletter", "subscribe", "subscription", "signup", "login", "widget", "toolbar",
    "pagination", "pager", "copyright", "legal", "contentinfo", "complementary", "search", "form", "hidden", "warning", "disclaimer",
}

# A class or id with such a word says how the page is laid out, or that something is missing, not what the element is.
LAYOUT = {"has", "no", "not", "with", "without", "hide", "non"}
# The header of one of these is the article's own.
OWN = {"article", "entry", "post", "content", "story", "main", "page", "title"}
HEAD = {"header", "masthead", "banner"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_OPENING = re.compile(r"</?[a-zA-Z]")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_NOTE = re.compile(r"<(annotation(?:-xml)?)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TAG = re.compile(r"<[^>]*>?")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    beside: bool
    within: bool
    heading: bool
    hinted: tuple[int, ...] = ()


def _hinted(value: str, within: bool) -> bool:
    """Whether a class, id or role says that its element lies beside the article."""
    for name in value.split():
        parts = [w.lower() for w in _NAME.findall(name)]
        if LAYOUT.intersection(parts):
            continue
        found = HINTS.intersection(parts)
        if found - HEAD or (found and not within and not OWN.intersection(parts)):
            return True
    return False


def _role(name: str, rest: str, within: bool = False) -> tuple[bool, bool, bool]:
    """(beside the article by its tag, by a hint, never shown) as an element says of itself."""
    hinted, unseen = False, False
    for key, value in _ATTRIBUTE.findall(rest) if rest.strip() else ():
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _UNSEEN.search(value)):
            unseen = True
        elif key in ("class", "id", "role") and name not in ("html", "body"):
            # camelCase and dashes part words
            hinted = hinted or _hinted(value, within)
    return name in ASIDE, hinted, unseen


def _weighed(found: list[Block], holds: dict[int, bool]) -> list[Block]:
    """Blocks whose hints hold; ``holds`` tells which hinted elements have an article inside.

    A hint is only that: where all of the page's article or, without one, all of its
    headings would go, it does not count for an element with the article inside or
    with most of the words that are not linked.
    """
    main = any(b.within for b in found)
    if any((b.within if main else b.heading) and not b.beside and not b.hinted for b in found):
        cleared: set[int] = set()
    else:
        total, inside = 0, dict.fromkeys(holds, 0)
        for b in found:
            if not b.beside:
                total += b.words - b.linked
                for mark in b.hinted:
                    inside[mark] += b.words - b.linked
        heads = {m for b in found if b.heading and not b.beside for m in b.hinted}
        cleared = {m for m, n in inside.items() if holds[m] or (2 * n > total and (main or m in heads))}
    for b in found:
        b.beside = b.beside or any(m not in cleared for m in b.hinted)
    return found


class _Ends:
    """Where elements end: each end tag closes the innermost open element of its name."""

    def __init__(self, html: str):
        self.html = html
        self.found: dict[str, dict[int, re.Match]] = {}

    def of(self, name: str, begin: int) -> re.Match | None:
        """The end tag of the element whose tag ends at ``begin``; none if it is never closed."""
        if name not in self.found:
            pairs: dict[int, re.Match] = {}
            waiting: list[int] = []
            for tag in re.finditer(rf"<(/?){name}(?=[\s/>]|\Z)(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>?", self.html, re.I):
                if tag[1]:
                    if waiting:
                        # what holds no tags begins with the first one
                        pairs[waiting[0] if name in RAW else waiting.pop()] = tag
                        if name in RAW:
                            waiting.clear()
                elif not tag[0].endswith("/>"):
                    waiting.append(tag.end())
            self.found[name] = pairs
        return self.found[name].get(begin)


def blocks(html: str) -> list[Block]:
    """Flat text blocks of one page; tolerant of unclosed and stray tags.

    The tag of an element that is skipped or never shown but has no end is
    passed over alone; of an unclosed script or style the text up to the next tag goes too.
    """
    found: list[Block] = []
    held: list[str] = []
    linked = 0
    in_link = False
    link_depth = 0  # elements open around the link
    heading = False
    ends = _Ends(html)
    stack: list[tuple[str, bool, bool, bool, tuple[int, ...]]] = []  # open elements: name, beside, within, unseen, hinted
    holds: dict[int, bool] = {}
    at, end = 0, len(html)

    def flush() -> None:
        nonlocal linked, heading
        if held:
            parts = "".join(held).split()
            held.clear()
            if parts and not (stack and stack[-1][3]):
                beside, within, marks = (stack[-1][1], stack[-1][2], stack[-1][4]) if stack else (False, False, ())
                found.append(Block(" ".join(parts), len(parts), linked, beside, within, heading, marks))
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        plain = unescape(text) if "&" in text else text
        if in_link:
            linked += len(plain.split())
        held.append(plain)

    while at < end:
        match = _TOKEN.search(html, at)
        if match is None:
            add(html[at:])
            break
        if match.start() > at:
            add(html[at : match.start()])
        at = match.end()
        if html.startswith("<![CDATA[", match.start()):
            add(match.group()[9:].removesuffix("]]>"))
            continue
        name = (match["name"] or match["name2"] or "").lower()
        if not name:
            continue
        closing = bool(match["close"] or match["close2"])
        rest = match["rest"] or match["rest2"] or ""
        if name == "a":
            in_link, link_depth = not closing, len(stack)
            continue
        if name == "br":
            held.append(" ")
            continue
        if name == "math":
            if closing or rest.endswith("/"):
                continue
            stop = re.compile(r"</math\b[^>]*>?", re.I).search(html, at)
            inside = html[at : stop.start() if stop else end]
            at = stop.end() if stop else end
            if not _role(name, rest)[2]:
                # a formula is read as it is shown; its source in another notation is left out
                add(_TAG.sub("", _NOTE.sub("", inside)))
            continue
        if not closing and name in SKIPPED:
            if rest.endswith("/"):
                continue
            stop = ends.of(name, at)
            if stop:
                at = stop.end()
            elif name in ("script", "style"):
                tag = _OPENING.search(html, at)
                at = tag.start() if tag else end
            if name not in UNSHOWN:
                held.append(" ")
            continue
        if name in INLINE:
            if closing or not rest.strip():
                continue
            unseen = _role(name, rest)[2]
            if not (unseen and name not in VOID):
                continue
            # an inline element that is never shown: leave it out up to its end
            stop = ends.of(name, at)
            at = stop.end() if stop else at
            continue
        flush()
        if closing:
            heading = False
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            # a link reaches over blocks, but not over the end of what it was opened in
            in_link = in_link and len(stack) >= link_depth
            continue
        heading = name in HEADINGS
        if name in VOID or rest.endswith("/"):
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") or name in HEADINGS:
            # these end where the next one begins, unless something larger was opened in between
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name or (stack[i][0] == "p" and name in HEADINGS):
                    del stack[i:]
                    break
                if stack[i][0] not in ("p", "li", "dt", "dd", "td", "th", "tr"):
                    break
            in_link = in_link and len(stack) >= link_depth
        above = stack[-1] if stack else ("", False, False, False, ())
        beside, hinted, unseen = _role(name, rest, above[2])
        within = above[2] or name in MAIN
        # an article's own header holds its title; what else it sets aside is no part of it
        if name == "header" and above[2]:
            beside = False
        marks = above[4]
        if name in MAIN and not hinted:
            holds.update((m, True) for m in marks if not above[2])
        if hinted:
            marks = (*marks, len(holds))
            holds[len(holds)] = name in MAIN
        stack.append((name, above[1] or beside, within, above[3] or unseen, marks))
    flush()
    return _weighed(found, holds)


FEATURES = [
    "beside", "apart", "within", "heading", "link_density", "words",
    "previous_link_density", "next_link_density", "previous_words", "next_words",
]


def features(found: list[Block]) -> np.ndarray:
    """A row of FEATURES per block; beyond the ends of a page lie empty blocks."""
    n = len(found)
    own = np.array([(b.words, b.linked / b.words) for b in found], float).reshape(n, 2)
    padded = np.vstack([np.zeros((1, 2)), own, np.zeros((1, 2))])
    has_main = any(b.within and not b.beside for b in found)
    marks = [(b.beside, has_main and not b.within, b.within, b.heading) for b in found]
    before, after = padded[:-2], padded[2:]
    columns = [own[:, 1], own[:, 0], before[:, 1], after[:, 1], before[:, 0], after[:, 0]]
    return np.hstack([np.array(marks, float).reshape(n, 4), np.stack(columns, axis=1)])


# The labelled table: pages whose blocks that belong to the article begin with a section sign.
_LONG = "word " * 24 + "end."
_SHORT = "A short line here."
LABELLED = [
    f"<nav><a>Home</a> <a>News</a></nav><article><h1>§Title of it</h1><p>§{_LONG}<p>§{_SHORT}<p>§One.</p></article><footer>All rights kept</footer>",
    f"<body><div class=ad>{_LONG}</div><main><h1>§Title</h1><p>§{_LONG}</p><ul><li>§First point<li>§Second point</ul></main><aside><p>{_LONG}</aside>",
    f"<header><h1>Site name</h1><p>{_SHORT}</header><article><header><h2>§Name</h2></header><p>§{_SHORT}<p>§See <a>this one</a>.</article>",
    f"<article><p>§{_LONG}<div class=comments><p>{_LONG}<p>{_SHORT}</div></article><div id=comments><p>{_LONG}<p>{_SHORT}</div>",
    f"<article><h1>§T</h1><p>§<a>Linked words only in here</a><p>§{_SHORT}</article><section class=related><h3>More</h3><p>{_LONG}</section>",
    f"<div class=cookie-notice>{_LONG}</div><article><p>§One.<p>§Two.</article><form><p>Sign up for {_LONG}</form>",
    f"<div><a>One</a> <a>Two</a> <a>Three</a></div><div><h1>§The title</h1><p>§{_LONG}<p>§{_LONG}<p>§{_SHORT}<p>§{_LONG}</div><div><a>Terms</a></div><div>Copyright line</div>",
    f"<ul><li><a>A</a><li><a>B</a><li><a>C</a></ul><h1>§Heading words</h1><p>§{_LONG}<p>§{_LONG}<p>§{_LONG}<ul><li><a>D e f</a><li><a>G h</a></ul>",
    f"<div>Menu</div><div><a>Go there</a></div><p>§{_LONG}<p>§{_SHORT}<p>§{_LONG}<div><a>Next page</a></div><div>Tel. 1</div>",
    f"<table><tr><td><a>X</a><td><a>Y</a></table><h2>§Named</h2><p>§{_LONG} <a>a link</a><p>§{_LONG}<div class=sidebar>{_LONG}</div>",
    f"<nav><p>{_LONG}</nav><p>§{_LONG}<p>§{_LONG}<footer><p>{_LONG}</footer>",
    f"<main><p>§{_SHORT}</p></main><div>{_SHORT}</div><div>{_LONG}</div>",
    f"<article><p>§{_LONG}</article><p>{_SHORT}<p><a>{_LONG}</a>",
    f"<article><p>§{_SHORT}</article>",
    f"<article><p>§{_LONG}<p>§One.</article>",
    f"<article><p>§{_LONG}<p>§<a>Linked words only</a><p>§{_SHORT}</article>",
    f"<article><h2>§Two</h2></article>",
    f"<nav><a>A b</a></nav><main><p>§Three</p><p>§Four</p></main>",
    f"<nav><a>A b</a></nav><article><p>§<a>Only a link</a></article>",
    f"<p>§{_LONG}</p>",
    f"<div><a>Home</a></div><p>§{_LONG}<p>§{_SHORT}<p>§{_SHORT}<p>§{_LONG}<div><a>Up</a></div>",
    f"<div><a>Home</a></div><h1>§Named so</h1><p>§{_LONG}<p>§Two words.<p>§{_LONG}<p>§Word.<p>§{_LONG}<div><a>Up</a></div><div>Tel. 2</div>",
    f"<header><p>{_LONG}</header><h1>§Heading here</h1><p>§{_LONG}<p>§A few <a>linked</a> words here.<p>§{_LONG}",
    f"<div class='content has-sidebar'><article><div class=article-header><h1>§Title</h1></div><p>§{_LONG}<p>§{_SHORT}</article><div class=sidebar>{_LONG}</div></div>",
    f"<section class=discussion><article><h1>§Title</h1><p>§{_LONG}<div class=comments><p>{_SHORT}</div></article></section>",
    f"<div class='main with-comments'><h1>§Title</h1><p>§{_LONG}<p>§{_LONG}</div><div id=comments><p>{_LONG}</div>",
]


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """FEATURES and labels of LABELLED, a fixed table of about 80 blocks."""
    rows, labels = [], []
    for page in LABELLED:
        found = blocks(page)
        labels += [b.text.startswith("§") for b in found]
        rows.append(features(found))
    return np.vstack(rows), np.array(labels)


Node = tuple  # (verdict,) or (feature, cut, below or equal, above)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 6) -> Node:
    """A decision tree by Gini impurity; the first best cut wins, leaves take the majority."""
    share = labels.mean()
    if depth == 0 or share in (0.0, 1.0):
        return (bool(share >= 0.5),)
    best: tuple[float, int, float] | None = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for cut in (values[:-1] + values[1:]) / 2:
            low = rows[:, feature] <= cut
            cost = sum(len(part) * 2 * part.mean() * (1 - part.mean()) for part in (labels[low], labels[~low]))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, feature, float(cut))
    if best is None:
        return (bool(share >= 0.5),)
    low = rows[:, best[1]] <= best[2]
    return (best[1], best[2], grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1))


def decide(tree: Node, row: list[float]) -> bool:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def main_text(html: str, tree: Node) -> str:
    found = blocks(html)
    if not found:
        return ""
    keep = [decide(tree, row) for row in features(found).tolist()]
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def _extractor(tree: Node) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    def extract(chunks: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for chunk in chunks:
            yield pa.array([main_text(x.as_py() or "", tree) for x in chunk], pa.string())

    extract.__annotations__ = {"chunks": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return extract


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points) in place of the html.

    Null and empty pages have the empty text; pages of any length and with
    unclosed or stray tags are read to their end; repeated rows stay. Pages are
    independent: no shuffle, and a page is the most a task holds besides its batch.
    """
    bounded_batches(pages.sparkSession)
    tree = grow(*labelled_table())
    kept = [c for c in without(pages, ["text", "n_chars"]) if c != html_col]
    made = pages.select(*[F.col(f"`{c}`") for c in kept], F.arrow_udf(_extractor(tree), "string")(html_col).alias("text"))
    return made.withColumn("n_chars", F.length("text").cast("long"))
