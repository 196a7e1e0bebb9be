"""Main text of web pages: flat blocks, told apart by a decision tree over their own and their neighbours' shape."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brooklet.llm.common import column

#: Depth of the tree, and rows of the labelled table that a side of a cut needs.
DEPTH, LEAF = 6, 2

COLUMNS = "words links prev_words prev_links next_words next_links inside outside heading".split()
# A labelled table: small pages as blocks in page order, a block as "words/share of linked words" with i
# (inside an article), o (set aside, as a menu or a form is), h (heading) and + (main text).
LABELLED_PAGES = """
2/1.0 2/1.0 1/1.0 8/0i+h 90/0i+ 45/.05i+ 1/0i+ 70/0i+ 3/1.0 2/1.0 9/0
1/1.0o 1/1.0o 2/1.0o 12/0o 9/0i+h 9/0i+ 3/0i+ 60/0i+ 2/0i+ 10/.2o
3/1.0o 2/1.0o 30/0o 60/0o 5/0i+h 4/0i+ 7/0o
2/1.0o 14/0o 12/0i+h 200/0i+ 1/0i+ 15/0o
1/1.0o 8/0o 11/0i+h 1/0i+ 20/.1o
4/0i+ 2/0i+ 1/0i+ 3/0i+ 6/1.0i+ 40/0i+ 5/1.0i+ 30/.3i+ 25/.6i+
1/1.0i 2/1.0i 1/1.0i 3/1.0i 2/1.0i
1/1.0i+h 40/0i+ 35/.1i+ 2/1.0i 3/1.0i 1/1.0i 2/1.0i
6/0i+h 50/0i+ 20/0o 4/1.0o 30/0i+ 9/0o 12/0i+
4/0o 3/0oh 40/0o 5/0o 60/0o
2/1.0 1/1.0 3/1.0 2/1.0 6/0+h 80/0+ 40/.1+ 4/0+ 60/0+ 15/0+ 2/1.0 2/1.0 7/0
5/0+h 25/0+ 18/0+ 30/.1+ 3/0+ 20/0+
2/1.0 2/1.0 2/0+h 30/0+ 30/0+ 1/1.0 1/1.0 8/0
1/1.0 5/0+h 12/0+ 45/0+ 14/0+ 26/0+ 4/.8 3/1.0
3/1.0 1/1.0 9/1.0 30/.9 12/.9 4/0 2/1.0
2/1.0 3/0 2/1.0 4/0 1/1.0 5/0
1/1.0 2/0h 2/1.0 3/1.0 1/1.0 2/0h 2/1.0 2/1.0
60/0+ 3/0+ 2/0+ 50/0+ 1/0+ 40/0+
5/0+h 40/0+ 30/0o 12/0o 8/0oh 90/0o 6/1.0o 9/0o
3/.7o 25/0o 30/.5o 7/0+h 100/0+ 22/0+ 80/.1o 20/0o
2/1.0o 4/0+h 11/0+ 35/0+ 16/0+ 10/0o
40/0i+ 5/1.0i+ 20/0i+ 2/0i+ 30/0i+ 6/1.0i+ 3/0i+
6/1.0i+ 3/0i+ 1/0i+ 50/0i+ 8/.9i+ 2/0i+ 2/0i+
1/1.0o 80/0i+ 40/0i+ 1/1.0o 60/0i+ 2/0i+ 1/1.0o
2/1.0 70/0+ 50/0+ 2/1.0 60/0+ 1/1.0
3/1.0o 45/0+ 60/0+ 2/1.0o 80/0+ 1/1.0o 90/0+ 2/0+
2/1.0o 90/0i+ 2/0i+ 1/1.0o 70/0i+ 3/0i+ 1/1.0o 5/0i+ 2/0i+
4/1.0o 100/0+ 3/0+ 50/0+ 1/1.0o 40/0+
1/1.0 1/0i+ 1/1.0o 2/0i+ 3/1.0 2/0i+ 2/0i+
2/1.0 9/0i+h 90/0i+ 120/.02io+ 150/0io+ 12/0io 6/1.0io 130/.05io+ 40/.9io 7/0o
8/0i+h 60/0i+ 5/0ioh 110/0io+ 140/.1io+ 10/.2io 4/1.0io 2/1.0io
"""
_BLOCK = re.compile(r"(\d+)/([\d.]+)([ioh+]*)")


def labelled_rows(pages: str = LABELLED_PAGES) -> list[tuple]:
    """Rows of ``COLUMNS`` and the label."""
    out = []
    for line in pages.strip().splitlines():
        page = [(int(n), float(share), marks) for n, share, marks in _BLOCK.findall(line)]
        for i, (n, share, marks) in enumerate(page):
            before = page[i - 1] if i else (0, 0.0)
            after = page[i + 1] if i + 1 < len(page) else (0, 0.0)
            out.append((n, share, *before[:2], *after[:2], "i" in marks, "o" in marks, "h" in marks, "+" in marks))
    return out


# Elements of HTML by their part in a page.
RAW = "script style noscript template textarea select svg iframe object canvas title math".split()
BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
ASIDE = set("nav footer aside form menu button dialog fieldset head".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = set(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner sidebar comment comments commentlist respond "
    "replies disqus menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert newsletter subscribe "
    "subscription signup login share sharing social related recommended popup modal overlay widget widgets toolbar pagination pager search skip".split()
)
_VOID = set("hr br img input meta link col area base embed source track wbr".split())
_SAME = set("p li dt dd tr td th option".split())

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b[^>]*>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_PART = re.compile(r"[A-Za-z]+")


def _set_aside(tag: str, rest: str, inside: bool) -> bool | None:
    """Whether an element holds no main text, by its name and attributes; None if only its class or id says so."""
    if tag in ASIDE or (tag == "header" and not inside):
        return True
    if tag in ("html", "body", "main", "article") or not rest:
        return False
    named: bool | None = False
    for name, *values in _ATTRIBUTE.findall(rest):
        value, name = "".join(values).lower(), name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in ROLES):
            return True
        if name in ("class", "id") and not NAMES.isdisjoint(_PART.findall(value)):
            named = None
    return named


class _Names:
    """Elements that a class or id names as no main text, which only the whole page can confirm.

    A name does not count for an element that holds the main element, or an article at least half as
    long as the page's longest; nor for one with more than half of the page's words, if no article
    stands elsewhere. Articles inside articles, as comments may be, are parts of the outer one.
    """

    def __init__(self) -> None:
        self.around: list[int] = []
        self.words: list[int] = []
        self.main: list[bool] = []
        self.within: list[bool] = []
        self.articles: list[tuple[int, list[int]]] = []
        self.total = 0

    def element(self, around: int, inside: bool) -> int:
        self.around.append(around)
        self.words.append(0)
        self.main.append(False)
        self.within.append(inside)
        return len(self.around) - 1

    def article(self, around: int) -> list[int]:
        self.articles.append((around, [0]))
        return self.articles[-1][1]

    def confirmed(self) -> list[bool]:
        longest = [0] * len(self.around)
        for around, (n,) in self.articles:
            if around >= 0:
                longest[around] = max(longest[around], n)
        for k in reversed(range(len(self.around))):
            up = self.around[k]
            if up >= 0:
                self.words[up] += self.words[k]
                self.main[up] = self.main[up] or self.main[k]
                longest[up] = max(longest[up], longest[k])
        best = max((n for _, (n,) in self.articles), default=0)
        out: list[bool] = []
        for k, up in enumerate(self.around):
            most = 2 * self.words[k] > self.total and (self.within[k] or not best)
            held = self.main[k] or most or 0 < best <= 2 * longest[k]
            out.append(not held or (up >= 0 and out[up]))
        return out


def blocks(html: str) -> list[tuple[str, int, int, bool, bool, bool]]:
    """Flat text blocks in page order: text, words, linked words, inside an article, set aside, heading."""
    out: list[tuple[str, int, int, bool, bool, bool]] = []
    names = _Names()
    of: list[int] = []
    # Tag, inside an article, set aside, the nearest element with a name, words of the outermost article.
    stack: list[tuple[str, bool, bool, int, list[int] | None]] = [("", False, False, -1, None)]
    parts: list[tuple[str, bool]] = []
    linked = False
    heading = False

    def end() -> None:
        text = " ".join(unescape("".join(t for t, _ in parts)).split())
        if text:
            in_links = sum(len(unescape(t).split()) for t, a in parts if a)
            n = len(text.split())
            _, inside, aside, named, article = stack[-1]
            out.append((text, n, in_links, inside, aside, heading))
            of.append(named)
            names.total += n
            if named >= 0:
                names.words[named] += n
            if article is not None:
                article[0] += n
        parts.clear()

    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            parts.append((html[at : m.start()], linked))
        at = m.end()
        tag = (m["tag"] or "").lower()
        if tag == "a":
            linked = not m["close"]
        elif tag == "br":
            parts.append((" ", linked))
        elif tag in BLOCKS:
            end()
            linked = False
            if m["close"]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
            elif tag not in _VOID:
                if tag in _SAME and stack[-1][0] == tag:
                    stack.pop()
                _, inside, aside, named, article = stack[-1]
                own = _set_aside(tag, m["rest"], inside)
                if own is None:
                    named = names.element(named, inside)
                elif tag == "main" and named >= 0 and not aside:
                    names.main[named] = True
                elif tag == "article" and article is None and not aside:
                    article = names.article(named)
                stack.append((tag, inside or tag in ("article", "main"), aside or bool(own), named, article))
            heading = stack[-1][0] in ("h1", "h2", "h3", "h4", "h5", "h6")
    if at < len(html):
        parts.append((html[at:], linked))
    end()
    confirmed = names.confirmed()
    return [(*x[:4], x[4] or (k >= 0 and confirmed[k]), x[5]) for x, k in zip(out, of, strict=True)]


class Tree:
    """A decision tree grown by Gini impurity."""

    def __init__(self, rows: list[tuple] | None = None):
        table = np.array(rows or labelled_rows(), float)
        self.root = self._grow(table[:, :-1], table[:, -1], DEPTH)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int):
        share = float(y.mean())
        if depth == 0 or share in (0.0, 1.0):
            return share >= 0.5
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, f] <= cut
                n = int(left.sum())
                if min(n, len(y) - n) >= LEAF:
                    p, q = y[left].mean(), y[~left].mean()
                    impurity = n * p * (1 - p) + (len(y) - n) * q * (1 - q)
                    if best is None or impurity < best[0] - 1e-12:
                        best = (impurity, f, float(cut), left)
        if best is None:
            return share >= 0.5
        _, f, cut, left = best
        return f, cut, self._grow(x[left], y[left], depth - 1), self._grow(x[~left], y[~left], depth - 1)

    def main(self, row: tuple) -> bool:
        node = self.root
        while isinstance(node, tuple):
            f, cut, low, high = node
            node = low if row[f] <= cut else high
        return node


def main_text(html: str | None, tree: Tree) -> str:
    """Blocks of main text, one a line."""
    found = blocks(html or "")
    shape = [(0, 0.0), *((n, links / n if n else 0.0) for _, n, links, *_ in found), (0, 0.0)]
    kept = []
    for i, (text, _, _, inside, aside, heading) in enumerate(found, 1):
        if tree.main((*shape[i], *shape[i - 1], *shape[i + 1], inside, aside, heading)):
            kept.append(text)
    return "\n".join(kept)


def _rows(batches: Iterator[pa.RecordBatch], tree: Tree) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h, tree) for h in column(batch, "html").to_pylist()]
        yield pa.RecordBatch.from_arrays([column(batch, "page_id"), column(batch, "url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, labelled: list[tuple] | None = None) -> DataFrame:
    """page_id, url and the main text of each page.

    A block is the text between two tags of block elements; a line break element is white space.
    Scripts, styles, comments and other elements without prose are left out before; a decision
    tree over ``COLUMNS``, grown on the labelled table, picks the blocks. Character references are
    decoded, white space in a block is one blank, blocks are joined by a line feed.

    Null, empty and textless pages give an empty text; null ids and urls stay; repeated rows are
    extracted one by one; an empty table gives an empty table; other columns are not read.
    """
    tree = Tree(labelled)
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return source.mapInArrow(lambda it: _rows(it, tree), "page_id long, url string, text string")


def op10_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn("n_chars", F.length("text").cast("long"))
