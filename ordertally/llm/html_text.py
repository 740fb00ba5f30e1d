"""Main text of HTML pages: flat text blocks classified by a small decision tree.

A page is cut into flat text blocks at block-level tags.  Each block carries
its word count and link density, those of its two neighbours, and three cues
from its place in the page (inside article or main, inside an element that
names itself page furniture, heading).  A decision tree, trained on the
labelled block table below, keeps or drops each block.

Defined cases: a null or empty page gives an empty text; a page whose blocks
are all dropped gives an empty text; repeated rows are extracted each on
their own; further input columns are ignored.  Unclosed tags, comments and
raw-text elements run to the end of the page, as in browsers.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
from pyspark.sql import DataFrame

from ordertally.llm.common import fields, map_columns

# Elements that end the block before them.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead title tr ul".split()
)
# Elements whose content is never main text.
SKIPPED_TAGS = frozenset(
    "script style noscript template svg math title head textarea select button iframe object canvas audio video map "
    "datalist".split()
)
# Of those, the ones whose content is raw text up to their own end tag.
RAW_TAGS = frozenset("script style title textarea iframe noscript".split())
FURNITURE_TAGS = frozenset("nav aside footer form menu dialog search".split())
# Words of class, id and role values that name page furniture.
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial adsense sponsor sponsored sponsors promo promos "
    "promoted promotion banner banners nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars "
    "aside footer foot header masthead topbar toolbar cookie cookies consent gdpr notice notices notification alert "
    "popup modal overlay newsletter subscribe subscription signup login search share sharing social related "
    "recommended recommendations teaser teasers widget widgets comment comments commentlist discussion disqus replies "
    "reply respond pagination pager copyright legal disclaimer skip toc complementary contentinfo "
    "dialog alertdialog form".split()
)
# Furniture only outside of the article; inside they hold its title.
TOP_WORDS = frozenset("header head masthead".split())
# Of an article or main element, only these speak against it.
ASIDE_WORDS = frozenset("comment comments commentlist reply replies respond teaser teasers related promo promos".split())
_ABOUT_THE_LAYOUT = frozenset("has with no without free open is js".split())
MAIN_WORDS = frozenset("article main content post entry story".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<![^>]*+(?:>|\Z)|<\?[^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)|</[^>]*+(?:>|\Z)",
    re.S,
)
_NAMING = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(
    r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I
)
_WORDS = re.compile(r"[a-z]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for t in RAW_TAGS}

# Labelled blocks: words and link density (percent) of the block before, the
# block itself and the block after, then the three cues (in an article or
# main element, in furniture, heading) and the label (1: main text).
LABELLED_BLOCKS = """
0 0 3 100 3 100 0 1 0 0
3 100 2 100 1 100 0 1 0 0
1 100 9 0 8 0 0 1 0 0
9 0 8 0 40 0 1 0 1 1
0 0 8 0 40 0 1 0 1 1
8 0 45 0 60 0 1 0 0 1
45 0 60 4 2 0 1 0 0 1
60 0 2 0 30 0 1 0 0 1
30 0 1 0 90 0 1 0 0 1
90 0 120 2 12 0 1 0 0 1
20 0 5 0 12 10 1 0 0 1
1 0 1 0 1 0 1 0 0 1
35 0 14 0 0 0 1 0 0 1
60 0 12 10 0 0 0 1 0 0
40 0 25 0 18 0 0 1 0 0
25 0 80 0 35 0 0 1 0 0
12 0 150 0 40 0 0 1 0 0
80 0 6 0 22 0 0 1 1 0
50 0 30 0 20 0 1 1 0 0
30 0 70 0 9 0 1 1 0 0
15 0 4 0 55 0 1 1 1 0
70 0 5 100 6 100 1 1 0 0
40 0 18 100 50 0 1 0 0 1
44 0 12 92 4 100 1 0 0 1
0 0 2 100 2 100 0 0 0 0
2 100 3 100 2 100 0 0 0 0
4 100 4 75 5 100 0 0 0 0
5 100 7 0 3 100 0 0 0 0
3 100 6 0 45 0 0 0 1 1
4 50 7 0 60 0 0 0 1 1
0 0 5 0 38 0 0 0 1 1
7 0 50 0 40 0 0 0 0 1
50 0 40 5 35 0 0 0 0 1
40 0 35 8 60 0 0 0 0 1
35 0 120 0 6 90 0 0 0 1
120 0 22 0 50 0 0 0 0 1
50 0 12 0 48 0 0 0 0 1
48 0 4 0 52 0 0 0 0 1
60 0 28 10 5 100 0 0 0 1
7 0 18 0 3 0 0 0 0 1
3 100 20 60 4 100 0 0 0 0
4 100 35 70 6 100 0 0 0 0
6 80 9 55 7 90 0 0 0 0
60 0 3 100 2 100 0 0 0 0
50 0 4 100 45 0 0 0 0 0
30 0 9 80 28 0 0 0 0 0
4 100 3 0 3 100 0 0 1 0
5 90 2 0 4 100 0 0 1 0
2 100 1 0 2 100 1 0 0 1
4 100 3 0 0 0 1 0 0 1
0 0 4 0 3 100 1 0 0 1
6 90 7 0 5 100 1 0 1 1
3 0 2 0 3 0 1 0 0 1
5 0 6 100 4 0 1 0 0 1
2 0 40 0 1 0 1 0 0 1
0 0 200 1 0 0 1 0 0 1
8 60 15 40 9 55 1 0 0 1
1 0 2 100 2 100 1 0 0 1
3 100 2 100 1 0 1 0 0 1
12 0 1 100 6 0 1 0 1 1
9 0 30 0 11 0 0 1 0 0
2 0 3 0 55 0 0 1 1 0
0 0 9 0 0 0 0 1 0 0
0 0 60 0 0 0 0 1 0 0
7 100 8 100 6 100 0 1 0 0
5 0 20 0 7 0 1 1 0 0
0 0 2 0 0 0 0 0 0 1
0 0 6 0 4 0 0 0 0 1
3 0 5 0 2 0 0 0 0 1
2 0 4 0 3 0 0 0 0 1
4 0 3 0 0 0 0 0 0 1
40 0 3 0 35 0 0 0 0 1
0 0 40 10 0 0 0 0 0 1
70 0 6 90 80 0 0 0 0 0
0 0 5 100 0 0 0 0 0 0
30 0 20 70 25 0 0 0 0 0
6 100 40 5 50 0 0 0 0 1
45 0 60 3 4 100 0 0 0 1
3 100 5 0 4 100 0 0 0 0
4 90 6 0 3 100 0 0 0 0
50 0 9 0 4 100 0 0 0 1
4 100 8 0 30 0 0 0 0 1
3 100 6 0 4 100 1 0 0 1
4 100 5 0 3 100 1 0 0 1
5 90 2 0 4 100 1 0 0 1
3 100 2 100 3 100 1 0 0 1
6 80 9 0 4 100 1 0 0 1
"""
MAX_DEPTH = 6
_BLOCK_TABLE = np.array([row.split() for row in LABELLED_BLOCKS.strip().splitlines()], float)


def train_tree(rows: np.ndarray, depth: int = MAX_DEPTH):
    """A decision tree on ``rows`` (features, then a 0/1 label) by Gini impurity.

    A leaf is an int label; an inner node is (feature, threshold, left, right),
    left for values at or below the threshold.
    """
    y = rows[:, -1]
    majority = int(2 * y.sum() >= len(y))
    if depth == 0 or y.min() == y.max():
        return majority
    best = None
    for f in range(rows.shape[1] - 1):
        values = np.unique(rows[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            left = rows[:, f] <= cut
            cost = sum(m.sum() * (p := y[m].mean()) * (1 - p) for m in (left, ~left))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, cut, left)
    if best is None:
        return majority
    _, f, cut, left = best
    return (f, float(cut), train_tree(rows[left], depth - 1), train_tree(rows[~left], depth - 1))


def keeps(tree, x: list[float]) -> bool:
    while not isinstance(tree, int):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree == 1


def _cues(attrs: str) -> set[str]:
    """Words of the names that an element gives itself, but for names such as ``has-sidebar``."""
    if "=" not in attrs:
        return set()
    names = [n for m in _NAMING.finditer(attrs) for n in (m[1] or m[2] or m[3] or "").lower().split()]
    words = [set(_WORDS.findall(n)) for n in names]
    return set().union(*[w for w in words if not w & _ABOUT_THE_LAYOUT])


def text_blocks(html: str) -> list[tuple[str, int, float, bool, bool, bool]]:
    """Flat blocks of a page in order: text, words, link density, in main, in furniture, heading."""
    blocks: list = []
    parts: list[str] = []  # text of the open block
    linked: list[str] = []  # its text within links
    # Open elements: tag, in main, in furniture, skipped.
    stack: list[tuple[str, bool, bool, bool]] = [("", False, False, False)]
    anchors = 0
    paragraph: tuple[bool, bool] | None = None  # of an open p, h1-h6: furniture, heading

    def close() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                n = len(text.split())
                inside = len(" ".join(linked).split())
                furniture = stack[-1][2] or bool(paragraph and paragraph[0])
                blocks.append((text, n, min(1.0, inside / n), stack[-1][1], furniture, bool(paragraph and paragraph[1])))
        parts.clear()
        linked.clear()

    def add(s: str) -> None:
        if s and not stack[-1][3]:
            parts.append(s)
            if anchors:
                linked.append(s)

    at = 0
    while at < len(html):
        m = _TOKEN.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag, attrs = tag.lower(), m["attrs"]
        if m["end"]:
            if tag == "a":
                anchors = max(0, anchors - 1)
            elif tag in BLOCK_TAGS or tag in SKIPPED_TAGS:
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
                if depth or tag in BLOCK_TAGS:
                    close()
                    anchors, paragraph = 0, None
                if depth:
                    del stack[depth:]
            continue
        if tag in RAW_TAGS:
            end = _RAW_END[tag].search(html, at)
            at = end.end() if end else len(html)
            if tag in ("title", "textarea"):
                close()
            continue
        if tag == "a":
            anchors += 1
        elif tag == "br":
            add(" ")
        if tag not in BLOCK_TAGS and tag not in SKIPPED_TAGS:
            # An inline element that is hidden or names itself an advert opens a part of its own.
            if tag != "span" or not (_cues(attrs) & FURNITURE_WORDS or _HIDDEN.search(attrs)):
                if tag == "span" and any(s[0] == "span" for s in stack):
                    stack.append((tag, *stack[-1][1:]))
                continue
        if tag == "body":
            close()
            del stack[1:]
            continue
        close()
        anchors, paragraph = 0, None
        if tag in VOID_TAGS or tag == "html":
            continue
        cues = _cues(attrs)
        furniture = bool(cues & FURNITURE_WORDS) or bool(_HIDDEN.search(attrs))
        if tag == "p" or re.fullmatch("h[1-6]", tag):
            paragraph = (furniture, tag != "p")
            continue
        if attrs.rstrip().endswith("/") and tag in ("svg", "math"):
            continue
        if tag in ("li", "dt", "dd", "td", "th", "tr", "option"):  # end tags may be left out
            holders = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",)}.get(tag, ("table",))
            siblings = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",)}
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in holders:
                    break
                if stack[i][0] in siblings.get(tag, (tag,)):
                    del stack[i:]
                    break
        if tag != "head":
            while stack[-1][0] == "head":  # a head whose end tag was left out
                stack.pop()
        _, in_main, in_furniture, skipped = stack[-1]
        if in_main:
            furniture = bool(cues & (FURNITURE_WORDS - TOP_WORDS)) or bool(_HIDDEN.search(attrs))
        if tag in ("article", "main"):
            furniture = bool(cues & ASIDE_WORDS) or bool(_HIDDEN.search(attrs))
            in_main = True
        elif tag == "header":
            furniture = furniture or not in_main
        elif not in_main and cues & MAIN_WORDS and not furniture:
            in_main = not in_furniture
        stack.append(
            (tag, in_main, in_furniture or furniture or tag in FURNITURE_TAGS, skipped or tag in SKIPPED_TAGS)
        )
    close()
    return blocks


def main_text(html: str | None, tree) -> str:
    """Kept blocks in page order, joined by a blank line."""
    if not html:
        return ""
    blocks = text_blocks(html)
    out = []
    for i, (text, n, density, in_main, furniture, heading) in enumerate(blocks):
        before = blocks[i - 1][1:3] if i else (0, 0.0)
        after = blocks[i + 1][1:3] if i + 1 < len(blocks) else (0, 0.0)
        x = [before[0], 100 * before[1], n, 100 * density, after[0], 100 * after[1], in_main, furniture, heading]
        if keeps(tree, x):
            out.append(text)
    return "\n\n".join(out)


def extract_text(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``pages`` with ``text`` (the main text) and ``n_chars`` (its code points).

    The tree is trained once on the driver from the bounded block table; the
    pages are read in one pass without a shuffle.
    """
    tree = train_tree(_BLOCK_TABLE)

    def run(column):
        texts = [main_text(x, tree) for x in column.to_pylist()]
        return [texts, [len(t) for t in texts]]

    return map_columns(pages, [html], fields("text string, n_chars long"), run, keep)


def op1(pages: DataFrame) -> DataFrame:
    return extract_text(pages, keep=["page_id", "url"])
