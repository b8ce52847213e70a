"""Main text of web pages from flat text blocks and a decision tree.

A page is read once, tag by tag, into blocks: the text between two block-level tags, with character references decoded and
white space turned into single spaces.  A block's features are its words and link density (share of words inside links),
the same of the blocks before and after it, and whether it stands inside an article, inside a part that pages use for
menus, notices, forms, adverts or comments, or in a heading.  A decision tree, grown on the small labelled table below,
says which blocks are main text; they are joined in page order by newlines.  Script, style and similar elements and
mark-up comments give no blocks.  Nothing is cut off, unclosed and stray tags are tolerated.

What wraps a whole page (a form, a container "with-sidebar") doesn't make its article side matter; an article inside
comments, menus, related matter or another article's side matter is.  Lists of links inside an article go by their link
density and that of their neighbours.

NULL or empty pages, and pages without main text, give the empty text.  Repeated rows each give a row.  A page takes time
in proportion to its length, whatever is left open in it; a tag has 400 attributes at most.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Element names of HTML by their role, and words in class, id and role attributes that name side matter.
SKIPPED = "script|style|noscript|template|svg|math|iframe|object|canvas|audio|video|textarea|select|button"
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
            "hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul caption".split())
VOID = set("hr br img input meta link base area col embed source track wbr param".split())
SIDE_TAGS = set("head nav footer aside form menu dialog".split())
SIDE_WORDS = set("ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert sidebar "
                 "menu nav navigation navbar breadcrumb breadcrumbs footer masthead share sharing social related recommended comment comments reply replies "
                 "respond discussion disqus subscribe newsletter signup login search widget popup modal pagination pager toolbar topbar tags copyright "
                 "contentinfo complementary".split())
# Inside these an article is no main text either: other pages' articles, comments and the like; the rest only wraps.
OUTSIDE_TAGS = set("head nav footer aside menu dialog".split())
OUTSIDE_WORDS = set("comment comments reply replies respond discussion disqus related recommended sidebar footer nav navigation menu popup modal advert advertisement ads ad".split())
LEAVES = set("p h1 h2 h3 h4 h5 h6 blockquote pre dd dt td th figcaption caption".split())
# Possessive, and no unquoted "<" inside a tag: what isn't closed is given up at the next one, so a page takes linear time.
_ATTRS = r"(?:\"[^\"]*\"|'[^']*'|[^'\"<>]++){0,400}+"
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<skip>" + SKIPPED + r")\b" + _ATTRS + r">.*?(?:</(?P=skip)\s*>|\Z)|"
                    r"<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>" + _ATTRS + r")>|<(?P<close2>/?)(?P<tag2>[a-z][a-z0-9:-]*)[^<>]*+>|<[!?/][^<>]*+>",
                    re.I | re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "article", "side", "heading")
# Labelled blocks: the features in this order, then 1 for main text.
LABELLED = [
    # In an article: paragraphs of all lengths, headings, linked text, at the edges and in the middle.
    (120, 0.0, 14, 0.0, 80, 0.0, 1, 0, 0, 1), (2, 0.0, 90, 0.0, 60, 0.0, 1, 0, 0, 1), (1, 0.0, 2, 0.0, 1, 0.0, 1, 0, 0, 1), (9, 0.0, 12, 1.0, 150, 0.0, 1, 0, 1, 1),
    (5, 0.0, 1, 1.0, 3, 0.0, 1, 0, 1, 1), (30, 0.4, 50, 0.0, 40, 0.0, 1, 0, 0, 1), (4, 1.0, 70, 0.0, 55, 0.1, 1, 0, 0, 1), (60, 0.0, 40, 0.0, 8, 0.0, 1, 0, 0, 1),
    (15, 0.2, 0, 0.0, 0, 0.0, 1, 0, 0, 1), (3, 0.0, 6, 0.0, 5, 0.5, 1, 0, 0, 1),
    (4, 0.0, 10, 0.0, 4, 0.0, 1, 0, 1, 1), (3, 0.0, 4, 0.0, 3, 0.0, 1, 0, 0, 1), (2, 0.0, 1, 0.0, 2, 0.0, 1, 0, 0, 1), (1, 0.0, 3, 0.0, 9, 1.0, 1, 0, 0, 1),
    (1, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 1), (5, 0.0, 6, 1.0, 3, 0.0, 1, 0, 0, 1), (6, 1.0, 30, 0.0, 45, 0.0, 1, 0, 0, 1), (3, 1.0, 20, 0.0, 25, 0.1, 1, 0, 0, 1),
    # Link lists in an article: linked lines beside linked lines.
    (2, 1.0, 3, 1.0, 2, 1.0, 1, 0, 0, 0), (12, 0.9, 4, 1.0, 6, 0.8, 1, 0, 0, 0), (4, 1.0, 60, 0.0, 5, 1.0, 1, 0, 0, 0), (5, 1.0, 4, 1.0, 40, 0.0, 1, 0, 0, 0), (7, 1.0, 6, 1.0, 0, 0.0, 1, 0, 0, 0),
    (3, 1.0, 3, 1.0, 90, 0.0, 1, 0, 0, 0), (4, 1.0, 5, 0.0, 3, 1.0, 1, 0, 0, 0),
    # Side matter inside an article: comments, sharing, notices, forms.
    (45, 0.0, 60, 0.0, 30, 0.0, 1, 1, 0, 0), (6, 1.0, 80, 0.0, 5, 1.0, 1, 1, 0, 0), (90, 0.0, 40, 0.0, 70, 0.0, 1, 1, 0, 0), (3, 0.0, 30, 0.0, 2, 0.0, 1, 1, 1, 0),
    # Side matter outside: titles in the head, menus, adverts, footers, long comments.
    (12, 0.0, 0, 0.0, 1, 1.0, 0, 1, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0), (8, 0.0, 1, 1.0, 10, 0.0, 0, 1, 0, 0), (20, 0.1, 40, 0.0, 0, 0.0, 0, 1, 0, 0),
    (150, 0.0, 60, 0.0, 100, 0.0, 0, 1, 0, 0), (4, 0.0, 15, 0.0, 35, 0.0, 0, 1, 1, 0), (70, 0.0, 5, 0.0, 3, 0.0, 0, 1, 0, 0),
    # Pages without an article element: running text is main text, also short lines in it and headings before it.
    (80, 0.0, 10, 0.0, 60, 0.0, 0, 0, 0, 1), (40, 0.1, 60, 0.0, 50, 0.0, 0, 0, 0, 1), (25, 0.0, 4, 1.0, 90, 0.0, 0, 0, 0, 1), (18, 0.0, 3, 0.0, 2, 0.5, 0, 0, 0, 1),
    (4, 0.0, 60, 0.0, 45, 0.0, 0, 0, 0, 1), (6, 0.0, 2, 1.0, 70, 0.0, 0, 0, 1, 1), (8, 0.0, 40, 0.0, 30, 0.0, 0, 0, 1, 1), (35, 0.25, 20, 0.0, 3, 1.0, 0, 0, 0, 1),
    (3, 0.0, 20, 0.0, 22, 0.0, 0, 0, 0, 1), (1, 0.0, 25, 0.0, 16, 0.0, 0, 0, 0, 1), (3, 0.0, 12, 0.0, 20, 0.0, 0, 0, 1, 1), (5, 0.0, 1, 1.0, 18, 0.0, 0, 0, 1, 1),
    (14, 0.0, 16, 0.0, 13, 0.0, 0, 0, 0, 1), (10, 0.0, 30, 0.0, 2, 0.0, 0, 0, 0, 1), (12, 0.0, 5, 0.0, 11, 0.0, 0, 0, 0, 1),
    # Elsewhere, link lists and short lines are not.
    (2, 1.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0), (12, 0.9, 4, 1.0, 6, 0.8, 0, 0, 0, 0), (30, 0.8, 20, 0.7, 25, 0.9, 0, 0, 0, 0), (3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0),
    (2, 0.0, 0, 0.0, 4, 1.0, 0, 0, 0, 0), (5, 0.0, 6, 1.0, 3, 0.0, 0, 0, 0, 0), (4, 0.5, 30, 0.0, 2, 1.0, 0, 0, 0, 0), (3, 0.0, 3, 0.0, 0, 0.0, 0, 0, 0, 0),
    (4, 0.0, 10, 0.0, 4, 0.0, 0, 0, 1, 0), (3, 0.0, 4, 0.0, 3, 0.0, 0, 0, 0, 0), (2, 0.0, 1, 0.0, 2, 0.0, 0, 0, 0, 0), (1, 0.0, 3, 0.0, 9, 1.0, 0, 0, 0, 0),
]


def read_blocks(html: str) -> tuple[list[str], np.ndarray]:
    """Texts of the blocks of a page and their features (one row each)."""
    texts: list[str] = []
    rows: list[tuple[int, float, int, int, int]] = []
    # Open elements: name, whether in an article, whether side matter, whether an article inside would be side matter too.
    stack: list[tuple[str, bool, bool, bool]] = []
    opened: dict[str, int] = {}
    parts: list[tuple[str, bool]] = []
    article = side = heading = False
    links = 0

    def pop():
        opened[stack.pop()[0]] -= 1

    def close_block():
        if parts:
            text = " ".join(unescape("".join(p for p, _ in parts)).split())
            if text:
                n = text.count(" ") + 1
                inside = sum(len(unescape(p).split()) for p, linked in parts if linked)
                texts.append(text)
                rows.append((n, min(1.0, inside / n), int(article), int(side), int(heading)))
            parts.clear()

    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            parts.append((html[at: m.start()], links > 0))
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        closing = bool(m["close"] or m["close2"])
        if tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            parts.append((" ", False))
        elif tag in BLOCK:
            close_block()
            if closing:
                if opened.get(tag):
                    links = 0
                    while stack[-1][0] != tag:
                        pop()
                    pop()
            elif tag not in VOID:
                if tag == "body":
                    while opened.get("head"):
                        pop()
                elif tag in ("p", "li") and stack and stack[-1][0] == tag:
                    pop()
                above = stack[-1] if stack else ("", False, False, False)
                is_main = tag in ("article", "main")
                in_article = is_main or above[1]
                tokens = {t for groups in _NAMES.findall(m["attrs"] or "") for v in groups for t in v.lower().split()} if m["attrs"] and tag != "body" else set()
                # A name says what its element is if it stands alone; as a part of a longer one it counts on containers only.
                words = tokens if tag in LEAVES else {w for t in tokens for w in re.split(r"[^a-z0-9]+", t)}
                own = tag in SIDE_TAGS or (tag == "header" and not in_article) or (not is_main and tag != "html" and not SIDE_WORDS.isdisjoint(words))
                outside = above[3] or tag in OUTSIDE_TAGS or not OUTSIDE_WORDS.isdisjoint(tokens)
                # An article or main part is not on the side because of what wraps the whole page.
                passed = above[2] and (not is_main or outside or above[1])
                stack.append((tag, in_article, own or passed or (is_main and outside), outside))
                opened[tag] = opened.get(tag, 0) + 1
            article, side = (stack[-1][1], stack[-1][2]) if stack else (False, False)
            heading = any(s[0] in ("h1", "h2", "h3", "h4", "h5", "h6") for s in stack[-3:])
    if at < len(html):
        parts.append((html[at:], links > 0))
    close_block()
    own = np.array(rows, float).reshape(-1, 5)
    around = np.zeros((len(own) + 2, 2))
    around[1:-1] = own[:, :2]
    return texts, np.concatenate([own[:, :2], around[:-2], around[2:], own[:, 2:]], 1)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6):
    """Decision tree by Gini impurity: a share of ones, or (feature, threshold, lower side, upper side)."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0):
        return share
    best = (2 * share * (1 - share) * len(y) - 1e-9, None, None)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= t
            cost = sum(2 * s.mean() * (1 - s.mean()) * len(s) for s in (y[low], y[~low]))
            if cost < best[0] - 1e-9:
                best = (cost, f, t)
    _, f, t = best
    if f is None:
        return share
    low = x[:, f] <= t
    return f, float(t), grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def classify(tree, x: np.ndarray) -> np.ndarray:
    """Share of ones at each row's leaf."""
    if isinstance(tree, float):
        return np.full(len(x), tree)
    f, t, low, high = tree
    return np.where(x[:, f] <= t, classify(low, x), classify(high, x)) if len(x) else np.zeros(0)


def train(labelled=LABELLED):
    table = np.array(labelled, float)
    return grow(table[:, :-1], table[:, -1])


def main_text(html: str | None, tree) -> str:
    texts, x = read_blocks(html or "")
    return "\n".join(t for t, s in zip(texts, classify(tree, x)) if s > 0.5)


def _extract(tree, names):
    def run(batches):
        for batch in batches:
            found = [main_text(h, tree) for h in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=names)

    return run


def extract(spark: SparkSession, pages: DataFrame, keep: list[str] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The ``keep`` columns of every page, text and n_chars (long)."""
    kept = pages.select(*keep)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "text string", "n_chars bigint"])
    return pages.select(*keep, F.col(html_col).alias("bl_html")).mapInArrow(_extract(train(), [*kept.columns, "text", "n_chars"]), schema)
