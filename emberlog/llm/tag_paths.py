"""Main text of web pages by tag-path ratios.

A page is read once into text blocks. Blocks of elements that never hold an article (menus,
headers, footers, sidebars, forms, scripts, adverts, notices, reader comments, by element,
role or class word; an article inside an article is a comment) are set aside. For each
root-to-leaf tag path the text length and the punctuation of its blocks are added up and
divided by their number; both ratios are smoothed along the page, fused to their geometric
mean in units of their spread, and the blocks of paths whose mean reaches ``threshold``
spreads are content. What belongs to content by its place joins it: headings, list items
and short paragraphs that stand in the same element as a content block, blocks of inner
elements between two content blocks of one element, and a heading right before content
(elements below the body only). Nothing else is kept, wherever it stands.

Cases: null or empty html, or a page without text, gives an empty text; a broken page is
read as browsers do where that is clear (unclosed tags, bare ampersands); a null id or url
is returned as it is; repeated rows each give a row; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.work import lean, small

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var".split()
)
#: Blocks that hold text alone.
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th caption figcaption tr tbody thead table ul ol dl".split())
#: What a start tag ends, if it is open inside the nearest of the second set.
ENDS = {
    **{t: ({t}, {"ul", "ol", "menu"}) for t in ("li",)},
    **{t: ({"dt", "dd"}, {"dl"}) for t in ("dt", "dd")},
    **{t: ({"td", "th"}, {"table"}) for t in ("td", "th")},
    "tr": ({"tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
NO_ARTICLE = frozenset(
    "script style noscript template head title nav footer aside form button select option textarea iframe object svg "
    "canvas dialog menu label fieldset".split()
)
NO_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NO_ARTICLE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments respond "
    "replies disqus share sharing social related recommended newsletter subscribe subscription signup login pagination "
    "pager skip widget toolbar copyright".split()
)
WHOLE = frozenset(("html", "body", "main"))
ARTICLES = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of a block's path that are no place of their own.
CLEAR = LEAF | frozenset("header hgroup figure".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")


class _Page(HTMLParser):
    """Text blocks as [path, elements from the root, text parts], in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # tag, element number, set aside
        self.blocks: list[tuple[str, tuple[int, ...], list[str]]] = []
        self.tags: list[str] = []
        self.counts: Counter[str] = Counter()  # of open elements, by tag
        self.block_key = None

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag not in ("img", "wbr", "input"):
                self.block_key = None
            return
        if tag not in INLINE:
            self.block_key = None
            self._end("p", {"body", "article", "div", "section", "td", "li"})
        if tag in ENDS:
            kinds, inside = ENDS[tag]
            for kind in kinds:
                self._end(kind, inside)
        above = bool(self.open) and self.open[-1][2]
        self.tags.append(tag)
        self.open.append((tag, len(self.tags) - 1, above or self._aside(tag, attrs)))
        self.counts[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.block_key = None
        self._end(tag, set() if tag not in INLINE else {"p", "div", "article", "section", "li", "td"})

    def _end(self, tag, inside):
        if not self.counts[tag]:
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self.counts.subtract(t for t, _, _ in self.open[at:])
                del self.open[at:]
                return
            if self.open[at][0] in inside:
                return

    def _aside(self, tag, attrs) -> bool:
        if tag in NO_ARTICLE:
            return True
        if tag in WHOLE:
            return False
        in_article = any(self.counts[t] for t in ARTICLES)
        if tag == "article" and self.counts["article"]:
            return True
        if tag == "header":
            return not in_article
        given = {k: v or "" for k, v in attrs}
        if "hidden" in given or given.get("aria-hidden") == "true" or re.search(r"display:\s*none", given.get("style", "")):
            return True
        if given.get("role", "").lower() in NO_ARTICLE_ROLES:
            return True
        if tag in LEAF and tag.startswith("h") or tag in INLINE and tag != "span":
            return False
        words = set(re.split(r"[^a-z0-9]+", f"{given.get('class', '')} {given.get('id', '')}".lower()))
        return bool(words & NO_ARTICLE_WORDS) or ("header" in words and not in_article)

    def handle_data(self, data):
        if self.open and self.open[-1][2]:
            return
        if self.block_key is not None:
            self.block_key.append(data)
        elif not data.isspace():
            elements = [(t, n) for t, n, _ in self.open]
            while elements and elements[-1][0] in INLINE:
                elements.pop()
            self.block_key = [data]
            self.blocks.append(("/".join(t for t, _ in elements), tuple(n for _, n in elements), self.block_key))


def _smooth(values: np.ndarray) -> np.ndarray:
    """Weights 1 8 1 along the page; ends count as their neighbour. More weight for the
    neighbours would lift a lone short block beside the article."""
    padded = np.concatenate((values[:1], values, values[-1:]))
    return (padded[:-2] + 8 * padded[1:-1] + padded[2:]) / 10


def path_means(paths: list[str], texts: list[str]) -> tuple[np.ndarray, float]:
    """For each block the mean fused ratio of its path, and the spread of the ratios."""
    _, path = np.unique(paths, return_inverse=True)
    number = np.bincount(path)
    ratios = []
    for values in ([len(x) for x in texts], [len(PUNCTUATION.findall(x)) for x in texts]):
        ratio = _smooth((np.bincount(path, values) / number)[path])
        ratios.append(ratio / (ratio.std() or ratio.max() or 1.0))
    fused = np.sqrt((ratios[0] + 0.1) * (ratios[1] + 0.1))
    return (np.bincount(path, fused) / number)[path], float(fused.std())


def _joined(page: _Page, elements: list[tuple[int, ...]], content: np.ndarray) -> np.ndarray:
    """The content blocks, with what belongs to them by its place."""
    place = [next((n for n in reversed(e) if page.tags[n] not in CLEAR), -1) for e in elements]
    first, last = {}, {}
    for at in np.flatnonzero(content).tolist():
        first.setdefault(place[at], at)
        last[place[at]] = at
    kept = content.copy()
    for at, own in enumerate(elements):
        # the body itself gathers too much to take in what lies deeper
        inner = (n for n in own if n in first and page.tags[n] not in ("html", "body"))
        kept[at] = kept[at] or place[at] in first or any(first[n] < at < last[n] for n in inner)
    for at in range(len(elements) - 2, -1, -1):
        own, following = elements[at], elements[at + 1]
        if not kept[at] and kept[at + 1] and own and page.tags[own[-1]] in HEADINGS:
            shared = os.path.commonprefix([own, following])
            kept[at] = bool(shared) and page.tags[shared[-1]] not in ("html", "body")
    return kept


def main_text(html: str, threshold: float = 1.0) -> str:
    page = _Page()
    page.feed(html)
    page.close()
    blocks = [(p, e, t) for p, e, parts in page.blocks if (t := " ".join("".join(parts).split()))]
    if not blocks:
        return ""
    means, spread = path_means([p for p, _, _ in blocks], [t for _, _, t in blocks])
    content = means >= min(threshold * spread, means.max())
    kept = _joined(page, [e for _, e, _ in blocks], content)
    return " ".join(t for (_, _, t), k in zip(blocks, kept, strict=True) if k)


def extract(pages: DataFrame, threshold: float = 1.0) -> DataFrame:
    """page_id, url, text and n_chars of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, "html"):
            texts = [main_text(x, threshold) if x else "" for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(lean(run), "page_id long, url string, text string, n_chars long")
