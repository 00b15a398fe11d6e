"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering.

The page is cut into lines at block tags. The ratio of a line is its
characters over its tags; ratios are smoothed along the page, and lines above
the threshold (one standard deviation) mark the regions that hold content. A
marked region keeps all its lines, so a short paragraph stays, while lines
inside menus, notices, adverts and the like count as nothing.

A name (a whole word of class, id or role) takes an element out only if it is
not and does not hold an article, main or h1 or most of the text of the page.
An element with such a word as a part of a name is a region of its own, that
its own ratios decide on. In a block, named inline elements stay, unless they
are all of it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Set
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SIGMA = 2.0
#: Fixed vocabulary of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split()
)
CELLS = frozenset(["td", "th"])
MAIN = frozenset(["article", "main"])
NEVER = frozenset(
    "head script style noscript template nav footer aside form button select option textarea iframe object svg canvas dialog menu video audio map".split()
)
#: An open element that a start tag of the same kind ends, unless one of SIBLING_SCOPE stands between.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SIBLING_SCOPE = frozenset(["ul", "ol", "dl", "table", "select"])
#: A block ends an open paragraph, unless one of these stands between.
PARAGRAPH_SCOPE = frozenset(["td", "th", "table", "button", "object"])
#: Words of class, id or role that name what is not part of the article.
BOILERPLATE = frozenset(
    """ad ads adbox adsense advert advertisement adverts alert banner breadcrumb breadcrumbs byline-share comment comments complementary consent
    contentinfo cookie cookies copyright disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager
    pagination popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social
    sponsor sponsored subscribe teaser toolbar widget""".split()
)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAMES = re.compile(r"[A-Za-z0-9]+")


#: Share of the text of a page from which an element is the page, whatever it is named: by a whole word, by a part of one.
MOST = {True: 0.75, False: 0.5}


def hidden(tag: str, attrs: list[tuple[str, str | None]], inside_main: bool) -> bool:
    """Whether an element is never part of an article, by its tag or because it is not shown."""
    if tag in NEVER or tag == "header" and not inside_main:
        return True
    if tag in ("html", "body", "main"):
        return False
    return any(name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and value and HIDDEN.search(value) for name, value in attrs)


def boilerplate(tag: str, attrs: list[tuple[str, str | None]]) -> bool | None:
    """Whether a whole class, id or role is in the vocabulary; False: a part of one is; None: not even that."""
    if tag in ("html", "body", "h1") or tag in MAIN:
        return None
    names = [w.lower() for name, value in attrs if name in ("class", "id", "role") and value for w in value.split()]
    if any(w in BOILERPLATE for w in names):
        return True
    return False if any(part in BOILERPLATE for w in names for part in _NAMES.findall(w)) else None


@dataclass
class Named:
    """An element with a name that speaks against it."""

    parent: int  # the named element it lies in, or -1
    whole: bool
    inline: bool
    holds_main: bool = False  # article, main or h1
    size: int = 0


@dataclass
class Line:
    text: list[tuple[str, int]]  # with the innermost named element
    tags: int
    region: int
    inside: bool  # of an article
    named: int  # innermost named block

    def joined(self, out: Set[int] = frozenset()) -> str:
        return " ".join("".join(t for t, named in self.text if named not in out).split())


class Lines(HTMLParser):
    """Collects the lines of a page, and the named elements they lie in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # tag, never part of an article, region, inside article, innermost named element, innermost named block
        self.open: list[tuple[str, bool, int, bool, int, int]] = [("", False, 0, False, -1, -1)]
        # how many elements of a tag are open: in all, inside each open list or table, and paragraphs inside each cell
        self.count: Counter[str] = Counter()
        self.listed: list[Counter[str]] = [Counter()]
        self.paragraphs = [0]
        self.regions = 0
        self.text: list[tuple[str, int]] = []
        self.tags = 0
        self.lines: list[Line] = []
        self.named: list[Named] = []

    def end_line(self) -> None:
        if self.tags or any(t.strip() for t, _ in self.text):
            _, _, region, inside, _, named = self.open[-1]
            self.lines.append(Line(self.text, max(self.tags, 1), region, inside, named))
        self.text, self.tags = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in ("br", "hr"):
            self.text.append((" ", -1))
        if tag in INLINE or tag in VOID:
            if tag not in VOID and attrs and not self.open[-1][1]:
                out, name = hidden(tag, attrs, self.open[-1][3]), boilerplate(tag, attrs)
                if out or name:
                    self.push(tag, out, name or None)
            return
        if tag in CELLS:
            self.text.append((" ", -1))
            self.close_siblings(tag)
        else:
            self.end_line()
            self.close_paragraph()
            self.close_siblings(tag)
        self.push(tag, hidden(tag, attrs, self.open[-1][3]), boilerplate(tag, attrs))
        if tag not in CELLS:
            self.tags = 1

    def cut(self, k: int) -> None:
        """End the element at place k and all inside it."""
        while len(self.open) > k:
            tag = self.open.pop()[0]
            self.count[tag] -= 1
            if tag in SIBLING_SCOPE:
                self.listed.pop()
            self.listed[-1][tag] -= 1
            if tag in PARAGRAPH_SCOPE:
                self.paragraphs.pop()
            self.paragraphs[-1] -= tag == "p"

    def close_siblings(self, tag: str) -> None:
        # every walk ends at an element and takes out all it has passed, so all walks together are linear
        own = SIBLINGS.get(tag, ())
        while any(self.listed[-1][t] for t in own):
            k = len(self.open) - 1
            while self.open[k][0] not in own:
                k -= 1
            self.cut(k)

    def close_paragraph(self) -> None:
        if self.paragraphs[-1]:
            self.close("p")

    def push(self, tag: str, out: bool, whole: bool | None) -> None:
        _, was_out, region, inside, named, block = self.open[-1]
        out = was_out or out
        if (tag in MAIN or tag == "h1") and not out and named >= 0:
            self.named[named].holds_main = True
        if tag in MAIN and not inside:
            self.regions += 1
            region, inside = self.regions, True
        elif not inside and tag in ("div", "section", "body", "td", "center"):
            self.regions += 1
            region = self.regions
        if whole is not None and not out:
            self.named.append(Named(named, whole, tag in INLINE))
            named = len(self.named) - 1
            block = block if tag in INLINE or tag in CELLS else named
        self.open.append((tag, out, region, inside, named, block))
        self.count[tag] += 1
        self.listed[-1][tag] += 1
        if tag in SIBLING_SCOPE:
            self.listed.append(Counter())
        self.paragraphs[-1] += tag == "p"
        if tag in PARAGRAPH_SCOPE:
            self.paragraphs.append(0)

    def close(self, tag: str | None = None) -> None:  # type: ignore[override]
        """End the page, or the innermost open element of a tag (there is one)."""
        if tag is None:
            super().close()
            self.end_line()
            return
        k = len(self.open) - 1
        while self.open[k][0] != tag:
            k -= 1
        self.cut(k)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in INLINE:
            if self.open[-1][0] == tag:
                self.cut(len(self.open) - 1)
            return
        if tag in VOID:
            return
        if tag in CELLS:
            self.text.append((" ", -1))
        else:
            self.end_line()
        if tag == "p":
            self.close_paragraph()
        elif self.count[tag]:
            self.close(tag)

    def handle_data(self, data: str) -> None:
        if not self.open[-1][1]:
            self.text.append((data, self.open[-1][4]))

    def judged(self) -> tuple[list[str], list[int | tuple[int]]]:
        """Texts of all lines without the elements their names take out, and the region of each."""
        for line in self.lines:
            for text, named in line.text:
                if named >= 0:
                    self.named[named].size += len(" ".join(text.split()))
        for x in reversed(self.named):  # an element comes after the one it lies in
            if x.parent >= 0:
                self.named[x.parent].size += x.size
                self.named[x.parent].holds_main |= x.holds_main
        total = sum(len(line.joined()) for line in self.lines)
        out, inline, apart = set(), set(), {}
        for k, x in enumerate(self.named):
            believed = not x.holds_main and x.size < MOST[x.whole] * total
            if x.parent in out or believed and x.whole and not x.inline:
                out.add(k)
            if x.parent in inline or believed and x.inline:
                inline.add(k)
            if x.parent in apart or believed and not x.whole:
                apart[k] = apart.get(x.parent, k)
        texts, regions, gone = [], [], out | inline
        for line in self.lines:
            # a named inline element goes with a line that it is all of
            texts.append(line.joined(out) if not inline or line.joined(gone) else "")
            regions.append((apart[line.named],) if line.named in apart else line.region)
        return texts, regions


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(np.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.concatenate([np.zeros(reach), ratios, np.zeros(reach)])
    weight = np.convolve(np.concatenate([np.zeros(reach), np.ones(len(ratios)), np.zeros(reach)]), kernel, "valid")
    return np.convolve(padded, kernel, "valid") / weight


def main_text(html: str) -> str:
    """The blocks of the selected regions, in page order, joined by an empty line."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    texts, regions = parser.judged()
    some = np.array([bool(text) for text in texts], bool)
    if not some.any():
        return ""
    own = np.array([len(text) / line.tags for text, line in zip(texts, parser.lines, strict=True)])
    ratios = smoothed(own)
    inside = np.array([line.inside for line in parser.lines], bool)
    eligible = some & inside if (some & inside).any() else some
    threshold = min(float(ratios.std()), float(ratios[eligible].max()))
    # a region apart does not gain from the lines around it
    apart = np.array([isinstance(r, tuple) for r in regions], bool)
    high = eligible & (np.where(apart, own, ratios) >= threshold)
    if not high.any():
        high = eligible & (ratios >= threshold)
    marked = {regions[k] for k in np.flatnonzero(high)}
    return "\n\n".join(texts[k] for k in np.flatnonzero(eligible) if regions[k] in marked)


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    pages: page_id, url, html; other columns are ignored. Null, empty and
    text-free pages give an empty text. Repeated rows give repeated rows.
    Unclosed elements end where HTML says so, or with the page. A page is parsed
    whole, in time linear in its length, however deep its elements lie.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h or "") for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
