"""Main text of web pages: parser events, text-to-tag ratio per line, smoothing and threshold clustering."""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.common import slices

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: No text of the page at all.
UNREAD = frozenset("head title script style noscript template iframe object svg math canvas audio video button select option textarea input".split())
#: Tags that speak against a line.
OUTER = frozenset("nav header footer aside form dialog menu".split())
LANDMARK = frozenset(["article", "main"])
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words of class and id that name page furniture.
FURNITURE = frozenset(
    """ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert sidebar
    aside rail menu nav navbar navigation breadcrumb breadcrumbs header masthead footer foot comment comments commentlist reply replies respond disqus discussion share
    sharing social related recommended recommendations newsletter subscribe subscription signup popup modal overlay toolbar pagination pager widget login search skip
    disclaimer""".split()
)
COMMENTS = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
#: Words of class and id that name a wrapper, and tags that hold a piece of prose.
WRAPPER = frozenset("layout wrapper wrap container content page main body".split())
PROSE = frozenset("p li h1 h2 h3 h4 h5 h6 tr dd pre blockquote".split())
_WORD = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Closed by the next start tag of the same kind.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Standard deviation of the smoothing, in lines.
SIGMA = 1.0
#: Evidence against a line: its score is multiplied by these, for page furniture by tag, role or name, for a place outside the text's regions, for being all links, and for standing in no element of prose.
MARKED, OUTSIDE, LINKED, LOOSE = 0.01, 0.02, 0.1, 0.3
#: The smoothed ratio that scores one half.
HALF = 50.0
#: Of regions beside one another those are kept that have so much of the largest one's text.
SHARE = 0.3


class PageLines(HTMLParser):
    """Turns parser events into lines of text, one per block, with tag counts and the regions around them."""

    def __init__(self, by_name: bool = True, kept: frozenset[int] = frozenset()):
        super().__init__(convert_charrefs=True)
        self.by_name, self.kept = by_name, kept
        self.stack: list[tuple[str, bool, int, bool, bool, int, bool, bool]] = []  # tag, and what was before it: marked, region, in comments, marked but for names, named element, in a link, unread
        self.open: Counter = Counter()  # tags on the stack
        self.seen = 0  # start tags
        self.hard, self.named, self.link = False, -1, False
        #: Per outermost element marked by its name: characters outside links, pieces of prose, whether it has a wrapper's name.
        self.held: dict[int, list] = {}
        self.total = 0
        self.regions: list[tuple[int, bool]] = [(-1, False)]  # parent, is a landmark
        self.lines: list[tuple[str, int, int, bool, float, bool]] = []  # text, tags, region, is marked, share of links, is in no element of prose
        self.parts: tuple[list[str], list[str]] = ([], [])  # of the line itself, and of what is marked within it
        self.linked = [0, 0]  # characters of both in links
        self.tags = 0
        self.marked, self.region, self.comments, self.unread = False, 0, False, False

    def flush(self) -> None:
        for marked, parts in enumerate(self.parts):
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    self.lines.append((text, self.tags, self.region, bool(marked), min(1.0, self.linked[marked] / len(text)), not any(self.open[t] for t in PROSE)))
                    self.tags = 0
                parts.clear()
                self.linked[marked] = 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        self.seen += 1
        if tag in VOID:
            if tag not in INLINE:
                self.flush()
            return
        closes = CLOSES.get(tag)
        if closes and any(self.open[c] for c in closes):
            self._close_open(closes)
        if tag not in INLINE:
            self.flush()
        words, hidden, role = set(), False, ""
        for name, value in attrs:
            value = value or ""
            if name in ("class", "id"):
                words |= {w.lower() for w in _WORD.findall(_CAMEL.sub(" ", value))}
            elif name == "role":
                role = value.strip().lower()
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
                hidden = True
        comments = self.comments or bool(words & COMMENTS)
        landmark = (tag in LANDMARK or role in ("main", "article")) and not comments
        furniture = self.by_name and bool(words & FURNITURE) and not words & {"no", "has", "with", "without"} and tag not in ("html", "body") and not landmark and self.seen not in self.kept
        escapes = landmark and tag in LANDMARK
        unread = tag in UNREAD or hidden or (self.unread and not escapes)
        for_sure = tag in OUTER or role in ROLES or comments or tag in UNREAD or hidden
        marked = for_sure or furniture or (self.marked and not escapes)
        hard = for_sure or (self.hard and not escapes)
        named = -1 if escapes else self.named
        if furniture and named < 0 and not hard:
            named = self.seen
            self.held[named] = [0, 0, bool(words & WRAPPER)]
        if named >= 0 and not hard and tag in PROSE:
            self.held[named][1] += 1
        region = self.region
        if landmark or (tag in ("div", "section", "body", "td", "center") and not marked):
            self.regions.append((self.region, landmark))
            region = len(self.regions) - 1
        self.open[tag] += 1
        self.stack.append((tag, self.marked, self.region, self.comments, self.hard, self.named, self.link, self.unread))
        self.marked, self.region, self.comments, self.hard, self.named, self.link, self.unread = marked, region, comments, hard, named, self.link or tag == "a", unread

    def _close_open(self, closes) -> None:
        """Ends the nearest open element of `closes`, unless a list, table or block lies between."""
        for i in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[i][0]
            if tag in closes:
                self.flush()
                self._pop_to(i)
                return
            if tag not in INLINE and tag != "p":
                return

    def _pop_to(self, i: int) -> None:
        _, self.marked, self.region, self.comments, self.hard, self.named, self.link, self.unread = self.stack[i]
        for frame in self.stack[i:]:
            self.open[frame[0]] -= 1
        del self.stack[i:]

    def handle_endtag(self, tag):
        self.tags += 1
        if tag not in INLINE:
            self.flush()
        if self.open[tag]:
            i = len(self.stack) - 1
            while self.stack[i][0] != tag:
                i -= 1
            self._pop_to(i)

    def handle_startendtag(self, tag, attrs):
        self.tags += 1
        self.seen += 1
        if tag not in INLINE:
            self.flush()

    def handle_data(self, data):
        if not self.unread:
            self.parts[self.marked].append(data)
            self.linked[self.marked] += self.link * len(data.strip())
        if not self.hard and not self.link and (n := len(data.strip())):
            self.total += n
            if self.named >= 0:
                self.held[self.named][0] += n

    def wrappers(self) -> frozenset[int]:
        """Elements named like furniture that hold more than half of the page's text outside links, as more than one piece of prose or by a wrapper's name."""
        return frozenset(k for k, (n, pieces, wraps) in self.held.items() if 2 * n > self.total and (pieces > 1 or wraps))


def ratios(lines: list[tuple]) -> np.ndarray:
    """Text-to-tag ratio of each line, smoothed by a Gaussian over the lines."""
    raw = np.array([len(line[0]) / max(1, line[1]) for line in lines])
    reach = int(3 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    weight = np.convolve(np.ones(len(raw)), kernel, "full")[reach : reach + len(raw)]
    return np.convolve(raw, kernel, "full")[reach : reach + len(raw)] / weight


def cluster(values: np.ndarray) -> np.ndarray:
    """Which lines belong to the upper of two clusters: the threshold is moved to the middle of their means until it rests."""
    threshold = values.mean()
    for _ in range(50):
        high = values >= threshold
        if high.all():
            return high
        new = (values[high].mean() + values[~high].mean()) / 2
        if abs(new - threshold) < 1e-9:
            break
        threshold = new
    return values >= threshold


def main_text(html: str) -> str:
    """The article of a page as one string."""
    parser = _read(html, True)
    while wrappers := parser.wrappers():  # a wrapper that is named like furniture is kept, what it holds is looked at anew
        parser = _read(html, True, parser.kept | wrappers)
    if all(line[3] for line in parser.lines):
        parser = _read(html, False)
    lines = parser.lines
    plain = np.array([not line[3] for line in lines], bool)
    if not plain.any():
        return ""
    values = ratios(lines)
    evidence = np.array([(1.0 if ok else MARKED) * LINKED ** line[4] * (LOOSE if line[5] else 1.0) for line, ok in zip(lines, plain)])
    score = values / (values + HALF) * evidence
    chosen = upper(score)
    regions = parser.regions
    own, deep = [0] * len(regions), [0] * len(regions)  # characters of chosen lines in each region itself, and with its inner regions
    for line, yes in zip(lines, chosen.tolist()):
        own[line[2]] += len(line[0]) * yes
    for i in range(len(regions) - 1, -1, -1):  # inner regions come after those around them
        deep[i] += own[i]
        if (up := regions[i][0]) >= 0:
            deep[up] += deep[i]
    inside, outer = _landmarks(regions, deep)
    if not inside:
        inside = _densest(regions, own, deep)
    within, around = np.array(_spread(regions, inside)), np.array(_spread(regions, outer))
    region = np.array([line[2] for line in lines])
    # Where the text is found to be speaks for short lines there and against lines elsewhere.
    chosen = upper(score * np.where(within[region] | around[region], 1.0, OUTSIDE))
    return " ".join(line[0] for line, yes in zip(lines, (chosen | (within[region] & plain)).tolist()) if yes)


def upper(score: np.ndarray) -> np.ndarray:
    """The lines of the upper cluster.  Two clusters are found in prose alone too: lines with half the upper one's mean belong to it."""
    high = cluster(score)
    return high | (score >= 0.5 * score[high].mean())


def _read(html: str, by_name: bool, kept: frozenset[int] = frozenset()) -> PageLines:
    parser = PageLines(by_name, kept)
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser


def _landmarks(regions, mass) -> tuple[set[int], set[int]]:
    """The innermost landmarks with most of their content, of which all lines count, and those around them, of which the chosen lines count."""
    marked = [landmark and mass[i] > 0 for i, (_, landmark) in enumerate(regions)]
    if not any(marked):
        return {i for i, (_, landmark) in enumerate(regions) if landmark}, set()
    inner = [0] * len(regions)  # mass of the largest landmark inside
    for i in range(len(regions) - 1, 0, -1):
        up = regions[i][0]
        if up >= 0:
            inner[up] = max(inner[up], inner[i], mass[i] if marked[i] else 0)
    holders = {i for i, yes in enumerate(marked) if yes and inner[i] >= 0.5 * mass[i]}
    return {i for i, yes in enumerate(marked) if yes} - holders, holders


def _densest(regions, own, deep) -> set[int]:
    """The regions that hold the text: from the page inwards, those with SHARE of the chosen characters of the largest beside them.

    It goes into a region as long as one alone holds the text there; several beside one
    another, or text that stands in a region itself, are the article's parts, and more than
    half of the page's chosen text is never left behind.
    """
    inner: list[list[int]] = [[] for _ in regions]
    for i, (up, _) in enumerate(regions):
        if up >= 0 and deep[i]:
            inner[up].append(i)
    at = 0
    while inner[at]:
        most = max(deep[i] for i in inner[at])
        if own[at] >= SHARE * most:
            break
        kept = [i for i in inner[at] if deep[i] >= SHARE * most]
        if len(kept) > 1:
            return set(kept)
        if 2 * deep[kept[0]] < deep[0]:
            break
        at = kept[0]
    return {at}


def _spread(regions, wanted: set[int]) -> list[bool]:
    """Whether each region is one of the wanted ones or inside one."""
    out: list[bool] = []
    for i, (up, _) in enumerate(regions):
        out.append(i in wanted or (up >= 0 and out[up]))
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points of text).

    The parser's events give one line per block.  A line's score is its smoothed
    text-to-tag ratio, between 0 and 1, weighed by evidence against it: page furniture by
    tag, role, class or id around it, its share of links, and that no element of prose
    (paragraph, heading, list item, cell) holds it.  A threshold parts the
    scores in two clusters; where the upper one is are the text's regions: landmarks
    (article, main) where there are any, else the blocks found by going inwards.  Being
    outside of them is evidence too, and a second threshold over all lines says which stay;
    short lines inside, which nothing speaks against, stay with them.

    Edge cases: a null or empty page, and one with no text, give an empty text; broken
    markup and unclosed tags are read as far as they go; pages of any length are read
    whole; an empty table gives no rows; other columns are not read.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html")
    )

    def run(batches):
        for batch in slices(batches):
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
