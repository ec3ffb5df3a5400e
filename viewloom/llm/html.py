"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from viewloom.llm.common import with_columns

#: Lines in a sliding window, text that a surge must reach in one (less on pages without so much), empty lines that set off a dropped element.
WINDOW, SURGE = 3, 86
#: A line whose text lies in links by this share counts as no text.
LINKED = 0.6

#: Fixed names of HTML: elements that begin a new line of text, elements whose content is never text, and elements that hold no main text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
RAW_TAGS = ("script", "style", "template", "noscript", "svg", "math", "iframe", "object", "textarea", "title", "canvas", "audio", "video", "noembed", "noframes")
ASIDE_TAGS = frozenset("head nav header footer aside form menu dialog button select fieldset".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words in class, id or role that tell an element beside the main text.
ASIDE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar side rail aside footer header masthead cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup login search social share sharing "
    "related recommended widget popup modal overlay comment comments commentlist disqus reply replies respond discussion pagination pager toolbar copyright "
    "contentinfo complementary form".split()
)
#: A name that begins so tells what an element has around or in it, not what it is.
WRAPPING = frozenset("has with no without is show hide".split())
#: Elements that hold the main text where a page has them.
MAIN_TAGS = frozenset(("article", "main"))

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW_TAGS) + r")(?=[\s/>])(?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)|[^>]*+)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|</(?=[\s>])[^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|\Z)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)


def _beside(attrs: str) -> bool:
    """Class, id or role names something beside the text; what only has or lacks such a thing ("with-sidebar") is not meant."""
    for m in _NAMED.finditer(attrs):
        for name in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", m[1] or m[2] or m[3] or "").lower().split():
            words = re.findall(r"[a-z]+", name)
            first = next((k for k, w in enumerate(words) if w in ASIDE_WORDS), None)
            if first is not None and not WRAPPING.intersection(words[:first]):
                return True
    return False


class _Lines:
    """Lines of text with the length of what stands outside links, the main element they lie in, and the named element around them."""

    def __init__(self):
        self.texts: list[str] = []
        self.lengths: list[int] = []
        self.main: list[int] = []  # number of the outermost main element, 0 outside
        self.around: list[int] = []  # number of the innermost element whose name tells that it is beside the text, 0 outside
        self.sets_off: list[int] = []
        self.parents = [0]  # the named element around each named element; its number is higher
        self.parts: list[str] = []
        self.linked = 0

    def flush(self, main: int, around: int, paragraph: bool, sets_off: int = 0, empty: bool = False) -> None:
        """Ends a line; without text there is none, unless it is to be an empty one."""
        text = " ".join(unescape("".join(self.parts)).split()) if self.parts else ""
        self.parts = []
        if not text and not empty:
            return
        # a list of links is no text, a paragraph is
        counts = paragraph or len(text) - self.linked >= (1 - LINKED) * len(text)
        self.texts.append(text)
        self.lengths.append(len(text) if counts else 0)
        self.main.append(main)
        self.around.append(around)
        self.sets_off.append(sets_off)
        self.linked = 0

    def decide(self) -> None:
        """Drops the lines of named elements, but not of one with a surge and most of the page's text where other main elements do not hold a tenth of it, nor of all if nothing else has text."""
        amounts = [0] * len(self.parents)
        whole, core = sum(self.lengths), 0
        for n, around, main in zip(self.lengths, self.around, self.main):
            core += n if main and not around else 0
            amounts[around] += n
        for k in range(len(amounts) - 1, 0, -1):
            amounts[self.parents[k]] += amounts[k]
        stays = [n >= SURGE and 2 * n > whole and 10 * core < whole for n in amounts]

        def visible() -> list[bool]:
            found = [True] * len(stays)
            for k in range(1, len(stays)):
                found[k] = stays[k] and found[self.parents[k]]
            return found

        inside = visible()
        if not any(n for n, around in zip(self.lengths, self.around) if inside[around]):
            stays = [True] * len(stays)
            inside = visible()
        # the empty lines that set off an element that stays are not needed
        at = [i for i, around in enumerate(self.around) if inside[around] and not (self.sets_off[i] and stays[self.sets_off[i]])]
        self.texts, self.lengths, self.main = ([x[i] for i in at] for x in (self.texts, self.lengths, self.main))


def _strip(html: str) -> _Lines:
    """Markup taken off: one line per block, and WINDOW empty lines in place of an element that holds no main text. Time and memory grow with the length of the page, however its tags are nested."""
    lines = _Lines()
    open_tags: list[tuple[str, bool, bool, int]] = []  # name, beside the text, main, number as named element
    opened: Counter = Counter()
    beside = main = links = seen = mains = named = 0
    at = 0

    def inside() -> int:
        return mains if main else 0

    def flush(sets_off: int = 0, empty: bool = False) -> None:
        lines.flush(inside(), named, opened["p"] > 0, sets_off, empty)

    def add(text: str) -> None:
        if beside or not text:
            return
        lines.parts.append(text)
        if links:
            lines.linked += len(" ".join(unescape(text).split()))

    def gap(sets_off: int = 0) -> None:
        flush()
        for _ in range(WINDOW):
            flush(sets_off, True)

    def close() -> str:
        """Closes the innermost element."""
        nonlocal beside, main, links, named
        name, aside, is_main, number = open_tags.pop()
        if number:
            flush()
            named = lines.parents[number]
        opened[name] -= 1
        links -= name == "a"
        main -= is_main
        beside -= aside
        if aside and not beside:
            gap()
        if number:
            gap(number)
        return name

    for m in _TOKEN.finditer(html):
        add(html[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if tag in BLOCK_TAGS and not beside:
            flush()
            # a paragraph ends where another block begins
            if opened["p"] and open_tags[-1][0] == "p" and not m["end"]:
                close()
        if tag in VOID_TAGS:
            continue
        if not m["end"]:
            free = tag in ("html", "body", "main")
            aside = tag in ASIDE_TAGS or not free and bool(m["attrs"]) and bool(_HIDDEN.search(m["attrs"]))
            if tag == "body" and beside:  # an unclosed head
                open_tags, beside, main, links, named = [], 0, 0, 0, 0
                opened.clear()
            if aside and not beside:
                gap()
            beside += aside
            number = 0
            if not beside and not free and _beside(m["attrs"]):
                seen += 1
                number = seen
                gap(number)
                lines.parents.append(named)
                named = number
            holds = tag in MAIN_TAGS and not beside
            if holds and not main:
                mains += 1
            open_tags.append((tag, aside, holds, number))
            opened[tag] += 1
            main += holds
            links += tag == "a"
        elif opened[tag] > 0:
            while close() != tag:
                pass
    add(html[at:])
    flush()
    if seen:
        lines.decide()
    return lines


def regions(lengths: np.ndarray) -> list[tuple[int, int]]:
    """Line ranges that hold text by the line-block distribution: between two dives (windows of three lines without text) and with a surge in between.

    A surge is a window of 86 characters, or half the fullest window where that is less. A region reaches back to the dive before it.
    """
    if not lengths.any():
        return []
    sums = np.convolve(lengths, np.ones(WINDOW, np.int64))[WINDOW - 1 :]  # of a line and the lines after it
    level = min(SURGE, sums.max() / 2)
    dives = np.flatnonzero(np.concatenate(([True], sums == 0, [True])))
    found = []
    for start, end in zip(dives.tolist(), dives[1:].tolist()):
        part = slice(start, max(start, end - 1))
        if sums[part].size and sums[part].max() >= level:
            full = part.start + np.flatnonzero(lengths[part])
            found.append((int(full[0]), int(full[-1]) + 1))
    return found


def main_text(html: str | None) -> str:
    """The main text of one page: its blocks in page order, one per line, white space inside a block as one space.

    Comments, scripts and other raw elements are cut, menus, headers, footers, forms, hidden elements and elements whose class, id or role names something beside the text
    (unless they hold most of it, or all) become runs of empty lines, and what is left stands block by block in lines. Lines of links have no length, unless they
    are paragraphs. Windows of three lines, surge and dive then pick the regions of text on the whole page; where main elements hold most of the text,
    lines outside them weigh nothing. A region keeps its lines from the first with text to the last, links between them included; a main
    element that a region touches keeps all its lines. Null, empty and text-free pages give an empty text.
    """
    if not html:
        return ""
    lines = _strip(html)
    lengths, main = np.array(lines.lengths, np.int64), np.array(lines.main, np.int64)
    if 2 * lengths[main > 0].sum() > lengths.sum():
        lengths[main == 0] = 0
    keep = np.zeros(len(lengths), bool)
    for start, end in regions(lengths):
        keep[start:end] = True
    keep |= (main > 0) & np.isin(main, np.unique(main[keep]))
    return "\n".join(lines.texts[k] for k in np.flatnonzero(keep) if lines.texts[k])


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with text and n_chars (code points) of the main text; columns of these names are replaced.

    A null or empty page has an empty text of 0 characters; rows that repeat stay, an empty table gives an empty result.
    """

    def compute(bodies: list) -> list[list]:
        texts = [main_text(b) for b in bodies]
        return [texts, [len(t) for t in texts]]

    return with_columns(pages, [html], [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())], compute)
