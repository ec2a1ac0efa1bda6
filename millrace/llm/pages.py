"""The main text of web pages, by the distribution of text over lines."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import words as W

#: Lines of a window, and characters in a window at which text sets in.
WINDOW, SURGE = 3, 80
#: Lines without text that may stand before a paragraph or heading that goes on.
GAP = 2 * WINDOW
#: Share of the largest region's text that a surer one must have to be the article.
PART = 0.25

#: Fixed values of HTML: elements whose content is no markup and no text of the
#: page, up to their end; the first two have what the page's end leaves of them.
_RAW = frozenset("script style noscript template iframe title textarea".split())
_CODE = frozenset(["script", "style"])
#: Elements with markup that is no text of the page, and those that end most of
#: them where their own end is missing.
_SILENT = frozenset("head svg math object select button".split())
_BLOCKS = frozenset(
    "address article aside blockquote body dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main nav ol p pre section table ul".split()
)
#: Elements that may stand in the head.
_IN_HEAD = frozenset("base basefont bgsound link meta".split()) | _RAW - {"iframe", "textarea"}
#: Elements beside the article; what an article in the first ones means is that
#: their own end is missing, or that they hold all of the page.
_BESIDE = frozenset("nav footer aside form menu dialog".split())
_AROUND = frozenset("nav form menu".split())
#: Words of labels that name one of several short pieces about other pages.
_CARDS = frozenset("card cards teaser teasers preview tile tiles".split())
#: A line beside paragraphs goes with them from this number of words on, or with
#: one of these signs at its end, unless it begins as the last line of a page does.
_WORDS, _STOPS = 3, tuple(".!?:;\u2026\u3002\"'\u201d\u00bb)")
_LAST = re.compile(r"\W*(?:\u00a9|\(c\)\s|copyright\b|all rights reserved)", re.I)
#: Elements without an end.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements inside a line.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter "
    "output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Classes, ids and roles that name something beside the article, alone or after
#: and before some words of place.
_NAMES = frozenset(
    "ad ads adslot advert adverts advertisement advertisements alert banner breadcrumb breadcrumbs "
    "comment comments commentlist complementary consent contentinfo cookie cookies copyright "
    "disclaimer discussion disqus "
    "footer gdpr login masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "notification pager pagination popup promo promoted promotion related replies respond search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser "
    "toolbar widget widgets".split()
)

_BEFORE = frozenset(
    "article bottom entry global js left main page post primary right secondary site top".split()
)
_AFTER = frozenset(
    "area bar block box container form inner item items left link links list right section slot unit "
    "wrap wrapper".split()
)

#: Words of which a class, id or role that names the article is made, and those
#: of which it has one at least.
_ABOUT = frozenset("article content post entry story main body text page blog news single".split())
_ARTICLE = frozenset("article content post entry story main".split())

#: Elements whose line goes on with the text before a few lines without text.
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)"
    r"(?P<rest>(?:\"[^\"<]*\"|'[^'<]*'|[^'\">])*+|[^>]*)(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in _RAW | _SILENT | _BESIDE}
#: The end of a tag that closes itself, not of an attribute's value.
_CLOSED = re.compile(r"""(?:^|[\s"'])/\s*$|^[^=]*/\s*$""")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NONE = re.compile(r"display\s*:\s*none", re.I)
_PART = re.compile(r"[^A-Za-z]+")


def _attributes(rest: str) -> dict[str, str]:
    found = _ATTRIBUTE.findall(rest) if rest else ()
    return {name.lower(): a or b or c for name, a, b, c in reversed(found)}


def _labels(attributes: dict[str, str]) -> list[str]:
    return [
        label
        for key in ("class", "id", "role")
        for label in attributes.get(key, "").lower().split()
    ]


def _hidden(attributes: dict[str, str]) -> bool:
    return (
        "hidden" in attributes
        or attributes.get("aria-hidden", "").strip().lower() == "true"
        or bool(_NONE.search(attributes.get("style", "")))
    )


def _names_beside(label: str) -> bool:
    """Whether a whole label names something beside the article."""
    parts = [part for part in _PART.split(label) if part]
    while parts and parts[0] in _BEFORE:
        del parts[0]
    while len(parts) > 1 and parts[-1] in _AFTER:
        del parts[-1]
    return bool(parts) and all(part in _NAMES for part in parts)


def _rank(name: str, labels: list[str]) -> int:
    """How surely an element is the article: 3 and 2 by its name, 1 by its labels, else 0."""
    if name in ("article", "main"):
        return 3 if name == "article" else 2
    if name in ("div", "section", "td"):
        for label in labels:
            parts = set(_PART.split(label)) - {""}
            if parts and parts <= _ABOUT and parts & _ARTICLE:
                return 1
    return 0


class _Lines:
    """The lines of a page in order, each with where it stands."""

    def __init__(self) -> None:
        self.texts: list[str] = []
        self.regions: list[int] = []  # number of the innermost region it is in, 0 for none
        self.around = [0]  # for each region the one around it
        self.homes: list[tuple[int, tuple[str, ...]]] = [(0, ())]  # number of its parent, labels
        self.linked: list[int] = []  # characters in links
        self.prose: list[bool] = []  # whether the innermost element is a paragraph or heading
        self.marked = False  # whether there is any element but those inside a line
        self.ranks = [0]
        self.doubtful = [False]  # whether a region is, or stands in, what a label puts beside
        self.counted: list[int] = []  # characters outside of links; 0 beside the article
        self.beside: list[int | None] = []  # region around the innermost element beside by label
        self._parts: list[str] = []
        self._linked = 0

    def add(self, text: str, linked: bool) -> None:
        self._parts.append(text)
        if linked:
            self._linked += len(text)

    def close(self, region: int, beside: bool, label: int | None, prose: bool) -> None:
        if self._parts:
            text = " ".join(html.unescape("".join(self._parts)).split())
            if text:
                self.texts.append(text)
                self.regions.append(region)
                alone = 0 if region else min(self._linked, len(text))
                self.counted.append(0 if beside else len(text) - alone)
                self.beside.append(label)
                self.linked.append(min(self._linked, len(text)))
                self.prose.append(prose)
            self._parts = []
        self._linked = 0


def _lines(page: str) -> _Lines:
    """Take the markup away; every element that is not inside a line ends the line.

    A raw element without its end is a tag alone, and so is one that closes
    itself; a script or style that the page cuts off ends there.
    """
    lines = _Lines()
    # Names of open elements, each with what held around it.
    stack: list[tuple[str, str, int | None, int, str]] = []
    # What puts the innermost element beside the article: an element's name or "hidden".
    beside, label, region, links = "", None, 0, 0
    parents = [0]  # where the elements around and the innermost one begin
    silent = ""  # name of the innermost open element without text of the page
    ends_at: dict[str, re.Match | None] = {}  # next ends of raw and silent elements

    def ending(name: str, at: int) -> re.Match | None:
        found = ends_at.get(name)
        if name not in ends_at or found and found.start() < at:
            found = ends_at[name] = _END[name].search(page, at)
        return found

    at = 0
    while token := _TOKEN.search(page, at):
        if token.start() > at:
            text = page[at : token.start()]
            if silent == "head" and not text.isspace():  # text of the page ends the head
                beside, label, region, silent = stack[-1][1:]
                del stack[-1]
            if not silent:
                lines.add(text, links > 0)
        at = token.end()
        name = token["name"]
        if not name:
            continue
        name = name.lower()
        if not token["end"]:
            if name in _RAW or name in _SILENT:
                if _CLOSED.search(token["rest"]) and name not in ("head", "style"):
                    continue
            if name in _RAW:
                if found := ending(name, at):
                    at = found.end()
                elif name in _CODE:
                    at = len(page)
                continue
            if silent == "head":
                ends = name not in _IN_HEAD
            elif silent in ("svg", "math"):
                ends = name in _BLOCKS or name == "div"
                ends = ends and all(entry[0] != "foreignobject" for entry in stack)
            else:
                ends = silent in ("button", "select") and (name in _BLOCKS or name == silent)
            if ends:
                depth = next(i for i in reversed(range(len(stack))) if stack[i][0] == silent)
                _, beside, label, region, silent = stack[depth]
                del stack[depth:]
            if name in _SILENT and (name == "head" or ending(name, at)):
                stack.append((name, beside, label, region, silent))
                silent = name
                continue
            if name in _SILENT:
                continue
        if silent and not token["end"]:
            if name not in _VOID and name not in _INLINE and not _CLOSED.search(token["rest"]):
                stack.append((name, beside, label, region, silent))
            continue
        if name in _INLINE:
            if name == "br":
                lines.add(" ", False)
            elif name == "a":
                links = 0 if token["end"] else 1
            continue
        depth = None
        if token["end"]:
            depth = next((i for i in reversed(range(len(stack))) if stack[i][0] == name), None)
        if name in _SILENT or silent and (depth is None or stack[depth][4]):
            if depth is not None:
                _, beside, label, region, silent = stack[depth]
                del stack[depth:]
            continue
        lines.close(region, bool(beside), label, bool(stack) and stack[-1][0] in _PROSE)
        links = 0
        lines.marked = True
        if name in _VOID:
            continue
        if token["end"]:
            if depth is not None:
                _, beside, label, region, silent = stack[depth]
                del stack[depth:]
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack:
            if stack[-1][0] == name:  # these end where the next one begins
                _, beside, label, region, silent = stack.pop()
        stack.append((name, beside, label, region, silent))
        del parents[len(stack) :]
        parents += [token.start()] * (len(stack) + 1 - len(parents))
        attributes = _attributes(token["rest"])
        labels = _labels(attributes)
        within = label
        if beside in _BESIDE:
            # The article is not beside itself: an element without its end, or one
            # that can hold no article, goes no further.
            if name in ("article", "main"):
                if beside in _AROUND or not ending(beside, at):
                    beside = ""
            elif name in ("h1", "h2", "p") and beside in _AROUND and not ending(beside, at):
                beside = ""
        elif beside == "header" and name == "h1" and lines.ranks[region] == 2:
            beside = ""
        if name not in ("html", "body", "main"):
            hidden = "hidden" if _hidden(attributes) else ""
            beside = beside or (name if name in _BESIDE else hidden)
            if any(map(_names_beside, labels)):
                within = region
        if name == "header" and lines.ranks[region] < 3:
            beside = beside or "header"
        rank = 0 if beside else _rank(name, labels)
        if rank > lines.ranks[region]:
            lines.around.append(region)
            lines.ranks.append(rank)
            lines.homes.append((parents[len(stack) - 1], tuple(labels)))
            lines.doubtful.append(lines.doubtful[region] or within is not None)
            region = len(lines.ranks) - 1
        label = within
    if at < len(page) and not silent:
        lines.add(page[at:], links > 0)
    lines.close(region, bool(beside), label, bool(stack) and stack[-1][0] in _PROSE)
    return lines


def _runs(counted: np.ndarray, surge: int, regions: np.ndarray) -> np.ndarray:
    """Which lines stand between a surge and the next dive of the windows' sums.

    Window ``i`` holds ``WINDOW`` lines from ``i`` on.  Text sets in with the
    first line of text in a window of ``surge`` characters, of lines in the same
    region, and ends where a window of no text or another region begins.
    """
    sums, own = np.zeros_like(counted), np.zeros_like(counted)
    for k in range(WINDOW):
        later = counted[k:]
        sums[: len(later)] += later
        own[: len(later)] += later * (regions[k:] == regions[: len(later)])
    edge = np.concatenate(([False], regions[1:] != regions[:-1]))
    begins = (counted > 0) & (own >= surge)
    ends = edge | (sums == 0)
    inside = np.zeros(len(counted), dtype=bool)
    on = False
    for i, (begin, end) in enumerate(zip(begins.tolist(), ends.tolist(), strict=True)):
        on = begin or on and not end
        inside[i] = on
    return inside & (counted > 0)


def _within(lines: _Lines, counted: np.ndarray) -> list[set[int]]:
    """The regions that each line counts for: those around it, out to what a label puts beside."""
    out = []
    for at, label, n in zip(lines.regions, lines.beside, counted.tolist(), strict=True):
        own = set()
        while n and at and at != label:
            own.add(at)
            at = lines.around[at]
        out.append(own)
    return out


def _article(lines: _Lines, counted: np.ndarray, within: list[set[int]]) -> int:
    """The surest region that has a good part of the text of the largest, 0 for none.

    What a label puts beside the article is not the article, unless no other
    region as sure has text and this one has more than any: then the label is
    on the article or on what holds it.
    """
    sizes = np.zeros(len(lines.ranks))
    for own, n in zip(within, counted.tolist(), strict=True):
        for region in own:
            sizes[region] += n
    doubtful = np.array(lines.doubtful)
    ranks = np.array(lines.ranks)
    clean = np.where(doubtful, 0, sizes)
    surest = ranks[clean > 0].max(initial=0)
    if ((ranks > surest) & (sizes > clean.max())).any():
        sizes[(ranks <= surest) | (sizes <= clean.max())] = 0
    else:
        sizes = clean
    large = np.flatnonzero((sizes > 0) & (sizes >= PART * sizes.max()))
    return max(large, key=lambda region: (lines.ranks[region], sizes[region], -region), default=0)


def _parts(lines: _Lines, counted: np.ndarray, within: list[set[int]], region: int) -> set[int]:
    """The article's region and those beside it, under one parent, that go on with it.

    A region of the same rank is a teaser where half of its text stands in
    links, where its label says so, and where it is small beside the article and
    has links or other labels.
    """
    sizes, linked = np.zeros(len(lines.ranks)), np.zeros(len(lines.ranks))
    for own, n, link in zip(within, counted.tolist(), lines.linked, strict=True):
        for at in own:
            sizes[at] += n
            linked[at] += link
    (home, labels), rank = lines.homes[region], lines.ranks[region]
    parts = {region}
    for at in range(1, len(sizes)):
        same = (lines.homes[at][0], lines.ranks[at], lines.around[at], lines.doubtful[at])
        if same == (home, rank, lines.around[region], lines.doubtful[region]) and sizes[at]:
            if _is_card(lines.homes[at][1]) and lines.homes[at][1] != labels:
                continue
            large = sizes[at] >= PART * sizes[region]
            if 2 * linked[at] < sizes[at] and (
                large or lines.homes[at][1] == labels and not linked[at]
            ):
                parts.add(at)
    return parts


def _is_card(labels: tuple[str, ...]) -> bool:
    return any(part in _CARDS for label in labels for part in _PART.split(label))


def _fits(text: str, prose: bool) -> bool:
    """Whether a line next to text belongs to it, as a menu's or the page's last line does not."""
    said = prose or len(text.split()) >= _WORDS or text.endswith(_STOPS)
    return said and not _LAST.match(text)


def _trimmed(inside: np.ndarray, fits: list[bool]) -> np.ndarray:
    """Without the first and last lines that do not fit, unless none does."""
    kept = np.flatnonzero(inside & np.array(fits))
    out = inside.copy()
    if len(kept):
        out[: kept[0]] = False
        out[kept[-1] + 1 :] = False
    return out


def _extended(
    inside: np.ndarray, counted: np.ndarray, prose: list[bool], fits: list[bool]
) -> np.ndarray:
    """Runs with the fitting lines next to them, and on to prose after up to ``GAP`` others."""
    out = inside.copy()
    text = counted > 0
    n = len(out)
    for step in (1, -1):
        apart = GAP + 1  # lines since the last one that is kept
        for i in range(n) if step > 0 else reversed(range(n)):
            if out[i]:
                apart = 0
            elif text[i] and fits[i] and (apart == 0 or step > 0 and apart <= GAP and prose[i]):
                out[i] = True
                apart = 0
            else:
                apart += 1
    return out


def _largest(counted: np.ndarray) -> np.ndarray:
    """The lines of the run of text, ended by a window without any, that has most of it."""
    runs = _runs(counted, 1, np.zeros_like(counted))
    places = np.flatnonzero(runs)
    if not len(places):
        return runs
    number = np.concatenate(([0], np.cumsum(np.diff(places) > WINDOW)))
    best = np.bincount(number, weights=counted[places]).argmax()
    out = np.zeros(len(counted), dtype=bool)
    out[places[number == best]] = True
    return out


def _plain(lines: _Lines, counted: np.ndarray) -> np.ndarray:
    """The same without what a label puts beside, unless the label is on all of the page."""
    plain = np.where([label is None for label in lines.beside], counted, 0)
    return plain if plain.any() else counted


def _windows(lines: _Lines, counted: np.ndarray) -> np.ndarray:
    """Lines between surge and dive; the largest run of text where no window has a surge."""
    inside = _runs(counted, SURGE, np.array(lines.regions))
    if not inside.any() and lines.marked:
        inside = _largest(counted)
    return inside


def _reached(lines: _Lines, counted: np.ndarray, within: list[set[int]]) -> int:
    """The region that the spans of the windows lead to, 0 if they stay outside of all.

    A marked region is the article by its text between surge and dive; the
    span then goes on to the region's edges.  One in which no text sets in is
    the article only if it has a good part of the text that sets in elsewhere.
    """
    spans = np.where(_windows(lines, counted), counted, 0)
    region = _article(lines, spans, within)
    if region and not lines.doubtful[region]:
        return region
    if region := _article(lines, counted, within):
        own = sum(n for n, of in zip(counted.tolist(), within, strict=True) if region in of)
        if own >= PART * np.where(_windows(lines, _plain(lines, counted)), counted, 0).sum():
            return region
    return 0


def main_text(page: str | None) -> str:
    """The article of one page, a line for each block; empty if there is none."""
    if not page:
        return ""
    lines = _lines(page)
    counted = np.array(lines.counted, dtype=np.int64)
    if not len(counted):
        return ""
    within = _within(lines, counted)
    if region := _reached(lines, counted, within):
        parts = _parts(lines, counted, within, region)
        counted[[not (parts & own) for own in within]] = 0
        inside = counted > 0
    else:
        plain = _plain(lines, np.where([not of for of in within], counted, 0))
        fits = [_fits(*line) for line in zip(lines.texts, lines.prose, strict=True)]
        inside = _trimmed(_windows(lines, plain), fits)
        inside = _extended(inside, plain, lines.prose, fits)
    return "\n".join(text for text, keep in zip(lines.texts, inside, strict=True) if keep)


def extracted(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """For each row its id, url, ``text string`` and ``n_chars bigint`` (code points).

    Markup, scripts, styles and comments are taken away first.  What stands in
    an element beside the article, by its name, by a whole class, id or role or
    as it is hidden, counts no characters; a label on the article itself, or on
    what holds it, puts nothing beside.  The rest is judged by the sums of text
    lengths over sliding windows of lines, on every page: text sets in at a surge
    and ends at the next dive, or is the largest run where there is no surge of
    ``SURGE`` characters.  Where the page marks articles, by name or by label, the
    span goes on to the edges of the surest and largest region that it reaches,
    and to the regions of its kind under the same parent that are no teasers; a
    marked region without a surge gives way to four times its text elsewhere.
    Where it marks none, the span takes in the lines next to it, but for single
    words and the page's last line, and paragraphs a few other lines further on.

    Character references are decoded, white space inside a block is one space,
    blocks are joined by line ends.  A null, empty or textless page has the
    empty text.  A tag or comment cut off by the end of the page ends there; an
    element without its own end takes no text after it away.
    Every row gives one row, repeated and null ids too; an empty table gives
    none.  Other columns are not read.  Pages are taken apart where they are
    read, nothing is shuffled.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in W.ranges(batch.column(2)):
                part = batch.slice(begin, end - begin)
                texts = [main_text(page) for page in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(texts, pa.string()),
                        pa.array([len(text) for text in texts], pa.int64()),
                    ],
                    names=["id", "url", "text", "n_chars"],
                )

    chosen = W.small_batches(pages).select(id_column, url_column, html_column)
    kind = chosen.schema[0].dataType.simpleString()
    found = chosen.mapInArrow(extract, f"id {kind}, url string, text string, n_chars bigint")
    return found.withColumnsRenamed({"id": id_column, "url": url_column})
