"""Main text of web pages from text-to-tag ratios.

A streaming parser turns a page into blocks in page order.  What the markup
itself names as something else (menus, page headers, footers, adverts, forms,
comments, hidden parts) is left out first.  Adverts, notices and comments stay out
whatever their size, unless a page has no other text; other names and forms
do not hide an article inside them, nor all that the ratios call content.  Each
block, the *line* of the method, has a ratio of text to tags, links not counted as
text; the ratios are smoothed by a Gaussian over neighbouring blocks, and those
above the threshold (their standard deviation) are the content cluster.  Every
outermost ``article`` or ``main`` with a block of the cluster is main text, with its
short blocks too: a one-word paragraph has a low ratio and still belongs.  Without
any, it is the smallest region that holds all of the cluster and its heading.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stored import prepare

SIGMA, RADIUS = 1.0, 3

# Fixed by HTML: elements without an end tag, and elements inside a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
CONTAINERS = frozenset("body article main section div td".split())
REGIONS = frozenset(("article", "main"))
# Never main text.
OTHER = frozenset(
    "head title script style noscript template nav header footer aside button select "
    "textarea iframe object svg canvas audio video dialog menu fieldset datalist".split()
)
OTHER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar toolbar".split()
)
# Elements whose class or id can name something else than main text; on the others
# here, only a whole name of an advert, a notice or a comment counts.
NAMED = frozenset("div section ul ol li dl table tbody tr td center".split())
WHOLLY_NAMED = frozenset("article p span figure blockquote".split())
HEADINGS = frozenset(("h1", "h2"))
# Words of such a class or id that name an advert, a notice or comments, as their
# last word but for words that may stand beside ...
NEVER_NAMES = re.compile(
    r"(?:ads?|advert(?:s|isements?|ising|orial)?|adbox|sponsor(?:s|ed)?|promo(?:s|ted|tions?)?|"
    r"cookies?|consent|gdpr|notices?|alerts?|comments?|commentlist|respond|replies|reply|disqus)\Z"
)
# ... and unless the first word says something about them.
ABOUT = frozenset("no has have with without show hide is not allow open closed".split())
# Other words of such a name: all of it must be of these or stand beside them.
OTHER_NAMES = re.compile(
    r"(?:banners?|popup|modal|overlay|newsletter|subscri(?:be|bers?|ptions?)|signup|login|"
    r"sidebars?|rail|menus?|nav(?:s|bar|igation)?|breadcrumbs?|toolbar|pagination|pager|"
    r"shar(?:e|ing)|social|related|recommended|widgets?|footers?|copyright|disclaimer|"
    r"hidden|form)\Z"
)
BESIDE = frozenset(
    "site page main primary secondary global left right top bottom sticky box block bar banner "
    "section area container wrapper wrap inner outer list links items buttons icons posts "
    "articles stories media".split()
)
NEVER, OTHERWISE = 2, 1
# Outside an article only: its own header holds its heading.
HEADER_NAMES = re.compile(r"(?:headers?|masthead|topbar)\Z")
# A new one ends an open one, as end tags may be missing.
SELF_CLOSING = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
    "main nav ol p pre section table ul".split()
)


def _kind_of_name(name: str, in_article: bool) -> int:
    """``NEVER`` for adverts, notices and comments, ``OTHERWISE`` for other things that
    are no main text, else 0."""
    words = [word for word in re.split(r"[^a-z]+", name) if word]
    own = list(words)
    while len(own) > 1 and own[-1] in BESIDE:
        own.pop()
    if own and NEVER_NAMES.match(own[-1]) and own[0] not in ABOUT:
        return NEVER
    named = [
        bool(OTHER_NAMES.match(word) or (not in_article and HEADER_NAMES.match(word)))
        or bool(NEVER_NAMES.match(word))
        for word in words
    ]
    whole = all(n or w in BESIDE for n, w in zip(named, words, strict=True))
    return OTHERWISE if any(named) and whole else 0


def _is_hidden(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    """What is never text."""
    if tag in OTHER:
        return tag != "header" or not in_article
    for key, value in attrs:
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and "display:none" in (value or "").replace(" ", "").lower():
            return True
    return False


def _kind(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> int:
    """What an element is named, the strongest of its names."""
    found = [OTHERWISE] if tag == "form" else [0]
    for key, value in attrs:
        if key in ("class", "id"):
            names = (value or "").lower().split()
            if tag in NAMED:
                found += [_kind_of_name(name, in_article) for name in names]
            elif tag in WHOLLY_NAMED and any(NEVER_NAMES.match(name) for name in names):
                found.append(NEVER)
        elif key == "role" and tag not in REGIONS:
            role = (value or "").strip().lower()
            if role in ("alert", "alertdialog"):
                found.append(NEVER)
            elif role in OTHER_ROLES:
                found.append(OTHERWISE)
    return max(found)


class _Blocks(HTMLParser):
    """Collects ``texts`` with their tag counts, link characters and regions."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.tags: list[int] = []
        self.links: list[int] = []
        self.regions: list[int] = []
        self.headings: list[bool] = []
        # Innermost element around a block that is named something else; each has
        # the one around it, and 0 is none.
        self.named: list[int] = []
        self.around, self.kinds = [0], [0]
        # How many articles were open around each block and each such element.
        self.depths: list[int] = []
        self.outside = [0]
        # Regions in the order they begin, so parents come before children.
        self.parents, self.stops = [0], [False]
        # Open elements: name, region and named element before it, whether it is
        # left out.
        self._open: list[tuple[str, int, int, bool]] = []
        # How many of each are open, so that nothing is searched for in vain.
        self._names: Counter[str] = Counter()
        self._region, self._named, self._other, self._in_link = 0, 0, 0, 0
        self._parts: list[str] = []
        self._tags = self._links = 0

    def _articles(self) -> int:
        return sum(self._names[name] for name in REGIONS)

    def _end_block(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            self.texts.append(text)
            self.tags.append(self._tags)
            self.links.append(self._links)
            self.regions.append(self._region)
            self.named.append(self._named)
            self.depths.append(self._articles())
            self.headings.append(any(self._names[name] for name in HEADINGS))
            self._tags = 0
        self._parts.clear()
        self._links = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in CLOSES_P:
            self._close(("p",), across=False)
        if tag in SELF_CLOSING:
            self._close(SELF_CLOSING[tag], across=False)
        if tag not in INLINE:
            self._end_block()
        self._tags += 1
        if tag in VOID:
            return
        in_article = self._articles() > 0
        page = tag in ("body", "html")
        other = not page and _is_hidden(tag, attrs, in_article)
        self._open.append((tag, self._region, self._named, other))
        kind = 0 if page or other else _kind(tag, attrs, in_article)
        if kind:
            self.around.append(self._named)
            self.kinds.append(kind)
            self.outside.append(self._articles())
            self._named = len(self.around) - 1
        self._names[tag] += 1
        self._other += other
        self._in_link += tag == "a"
        if tag in CONTAINERS:
            self.parents.append(self._region)
            self.stops.append(tag in REGIONS)
            self._region = len(self.parents) - 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID:
            self._tags += 1
            self._close((tag,), across=True)

    def _close(self, tags: tuple[str, ...], across: bool) -> None:
        """Close the innermost open element of these; ``across`` blocks too."""
        if not any(self._names[tag] for tag in tags):
            return
        for i in range(len(self._open) - 1, -1, -1):
            name = self._open[i][0]
            if name in tags:
                break
            if not across and name not in INLINE:
                return
        else:
            return
        if any(name not in INLINE for name, *_ in self._open[i:]):
            self._end_block()
        for name, region, named, other in reversed(self._open[i:]):
            self._region, self._named = region, named
            self._other -= other
            self._in_link -= name == "a"
            self._names[name] -= 1
        del self._open[i:]

    def handle_data(self, data: str) -> None:
        if not self._other:
            self._parts.append(data)
            if self._in_link:
                self._links += len(data)

    def finish(self) -> _Blocks:
        self.close()
        self._end_block()
        return self


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian mean over neighbours; at the ends, over those there are."""
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    both = np.convolve(ratios, kernel), np.convolve(np.ones(len(ratios)), kernel)
    inside = slice(RADIUS, RADIUS + len(ratios))
    return both[0][inside] / both[1][inside]


def _below(parents: list[int], root: int) -> np.ndarray:
    """Which nodes are ``root`` or below it; parents come before children."""
    inside = np.zeros(len(parents), bool)
    inside[root] = True
    for child in range(root + 1, len(parents)):
        inside[child] = inside[parents[child]]
    return inside


def _cluster(blocks: _Blocks, plain: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Which of the ``used`` blocks are the content cluster."""
    # Tags of what is left out count for the next block.
    tags = np.diff(np.cumsum(blocks.tags)[used], prepend=0)
    ratios = smoothed(plain[used] / np.maximum(1, tags))
    content = np.zeros(len(used), bool)
    content[used] = ratios >= min(ratios.std(), ratios.max())
    return content


def _left_out(blocks: _Blocks, plain: np.ndarray) -> np.ndarray:
    """Blocks of elements that are named something else."""
    named, depths = np.array(blocks.named), np.array(blocks.depths)
    if len(blocks.around) == 1:
        return np.zeros(len(named), bool)
    # Whether such an element, or one around it, is never main text.
    never = np.array(blocks.kinds) == NEVER
    for element in range(1, len(never)):
        never[element] |= never[blocks.around[element]]
    out = never[named]
    text = plain > 0
    if not (text & ~out).any():
        return np.zeros(len(named), bool)
    # The deepest article with text in an element that is named otherwise.
    deepest = np.zeros(len(never), int)
    shown = np.flatnonzero(text & ~out)
    np.maximum.at(deepest, named[shown], depths[shown])
    for element in range(len(never) - 1, 0, -1):
        outer = blocks.around[element]
        deepest[outer] = max(deepest[outer], deepest[element])
    other = np.zeros(len(never), bool)
    for element in range(1, len(other)):
        wraps_article = deepest[element] > blocks.outside[element]
        other[element] = other[blocks.around[element]] or not (never[element] or wraps_article)
    content = _cluster(blocks, plain, ~out)
    if (content & text & ~other[named]).any():
        out |= other[named]
    return out


def _articles(blocks: _Blocks, content: np.ndarray) -> np.ndarray:
    """Blocks of the outermost articles that have one of the cluster."""
    outermost = np.zeros(len(blocks.parents), int)
    for region in range(1, len(outermost)):
        outer = outermost[blocks.parents[region]]
        outermost[region] = outer or (region if blocks.stops[region] else 0)
    own = outermost[blocks.regions]
    return (own > 0) & np.isin(own, own[content])


def _region_of(blocks: _Blocks, weight: np.ndarray, used: np.ndarray) -> int:
    """The smallest region with all the weight and its heading."""
    n = len(blocks.parents)
    held, count, first, heading = np.zeros(n), np.zeros(n), [len(used)] * n, [len(used)] * n
    for i in np.flatnonzero(used)[::-1]:
        own = blocks.regions[i]
        held[own] += weight[i]
        count[own] += 1
        first[own] = i
        if blocks.headings[i]:
            heading[own] = i
    children: dict[int, list[int]] = {}
    for region in range(n - 1, 0, -1):
        outer = blocks.parents[region]
        held[outer] += held[region]
        count[outer] += count[region]
        first[outer] = min(first[outer], first[region])
        children.setdefault(outer, []).append(region)
    at = 0
    while True:
        inner = max(children.get(at, []), key=held.__getitem__, default=None)
        # All of the cluster; a heading before the region is the region's own.
        if inner is None or held[inner] < held[at] or heading[at] < first[inner]:
            return at
        # A single block is no region, unless it is all there is.
        if count[inner] < 2 and count[at] > 1:
            return at
        at = inner


def _link_lists(heavy: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Blocks in runs of link-heavy ones outside the cluster."""
    run = heavy & ~content
    near = np.zeros(len(run) + 2, bool)
    near[1:-1] = run
    return run & (near[:-2] | near[2:])


def main_text(html: str | None) -> str:
    """The main text of a page, its blocks joined by a line feed."""
    parser = _Blocks()
    parser.feed(html or "")
    blocks = parser.finish()
    if not blocks.texts:
        return ""
    sizes = np.array([len(text) for text in blocks.texts], float)
    plain = sizes - np.minimum(np.array(blocks.links, float), sizes)
    used = ~_left_out(blocks, plain)
    if not used.any():
        return ""
    content = _cluster(blocks, plain, used)
    keep = used & _articles(blocks, content & (plain > 0))
    if not keep.any():
        region = _region_of(blocks, np.where(content, plain, 0.0), used)
        keep = used & _below(blocks.parents, region)[blocks.regions]
        # Outside an article, lists of links are no text.
        at = np.flatnonzero(keep)
        keep[at[_link_lists(2 * plain[at] < sizes[at], content[at])]] = False
    return "\n".join(text for text, kept in zip(blocks.texts, keep, strict=True) if kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html.as_py()) for html in batch["html"]]
        yield pa.RecordBatch.from_arrays(
            [
                batch["page_id"],
                batch["url"],
                pa.array(texts, pa.string()),
                pa.array([len(text) for text in texts], pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id``,
    ``url``, ``html``; other columns do not matter).

    A null or empty page, or one without any text, has an empty text.  Rows are
    read one by one, also if they repeat; ids and urls may be null.
    """
    prepare(pages.sparkSession)
    return pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    ).mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
