"""Main text of web pages by the distribution of text over line blocks."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A comment, a declaration, a tag with its attributes, or the text up to the next one.
PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>|([^<]+|<)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"']+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"']+)")
#: Elements whose content is no text.
SILENT = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "head", "title", "textarea", "select", "option", "audio", "video"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that end a line.
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are not the article, whatever they hold.
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "button", "dialog", "fieldset", "label", "input"}
#: Words in class, id or role that mark such a part.
MARKS = set(
    "nav navbar navigation menu menubar header masthead banner footer contentinfo sidebar aside complementary widget ad ads adv advert adverts "
    "advertisement advertising sponsor sponsored promo promoted promotion cookie cookies consent notice notices gdpr popup modal overlay alert "
    "comment comments commentlist disqus reply replies respond discussion breadcrumb breadcrumbs share sharing social related recommended "
    "newsletter subscribe subscription signup login search form pagination pager toolbar tags copyright legal disclaimer skip toc hidden".split()
)
#: Of these, the ones that hold however much text there is.
READERS = {"comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "discussion"}
#: Before a word they say that the page has, or lacks, such a part, not that this is one.
ABOUT = {"has", "have", "no", "non", "with", "without", "is", "hide", "show"}
MAIN = {"article", "main"}
#: Elements that no class marks, since they hold the page.
WHOLE = {"html", "body"}
#: A bare header inside the article holds its title, not the site's.
TITLED = {"header"}


@dataclass(frozen=True)
class Settings:
    """``window`` lines are summed; a sum of ``surge`` characters starts a block, one of ``dive`` or less ends it."""

    window: int = 3
    surge: int = 40
    dive: int = 0


@dataclass
class Line:
    """A line of text: characters in links, number of its article, marks it stands under, elements it stands in."""

    text: str
    linked: int
    region: int
    marks: tuple[int, ...]
    path: tuple[int, ...]


def _marks(attributes: str) -> set[str]:
    """The words of class, id and role that mark a part as something else than the article."""
    found: set[str] = set()
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role"):
            for label in value.strip("\"'").lower().split():
                words = re.split(r"[^a-z0-9]+", label)
                found.update(w for before, w in zip(["", *words], words) if w in MARKS and before not in ABOUT)
        elif name == "aria-hidden" and "true" in value.lower() or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            found.add("unseen")
    if re.search(r"(?:^|\s)hidden(?:\s|$)", ATTRIBUTE.sub("", attributes).lower()):
        found.add("unseen")
    return found


def lines_of(source: str) -> tuple[list[Line], set[int]]:
    """Text lines of a page without markup, and the regions that an article or main element makes.

    Lines are cut at block elements. Parts that are something else by their
    element, or that hold readers' comments or are not shown, leave none. Parts
    that only a class, id or role marks leave none either, unless such a part
    holds more than half of the page's text, or of its articles' text: then the
    word says something about the whole page.
    """
    lines: list[Line] = []
    stack: list[tuple[str, bool, bool, int]] = []  # element, is it aside, is it main, its mark or 0
    path: list[int] = []
    words: list[str] = []
    linked = region = depth_aside = depth_main = anchors = number = 0
    marks: list[int] = []
    mains: set[int] = set()
    silent = ""

    def cut() -> None:
        nonlocal linked
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            if text:
                lines.append(Line(text, linked, region, tuple(marks), tuple(path)))
        words.clear()
        linked = 0

    def close(to: int) -> None:
        nonlocal region, depth_aside, depth_main
        while len(stack) > to:
            _, was_aside, was_main, mark = stack[-1]
            if was_aside or was_main or mark:
                cut()
            stack.pop()
            path.pop()
            depth_aside -= was_aside
            depth_main -= was_main
            if mark:
                marks.pop()
            if was_main:
                region += 1
                if depth_main:
                    mains.add(region)

    for m in PIECE.finditer(source):
        closing, name, attributes, text = m.group(1, 2, 3, 4)
        if text is not None:
            if not silent and not depth_aside:
                words.append(text)
                linked += len(text) if anchors else 0
            continue
        if name is None:
            continue
        name, empty = name.lower(), attributes.endswith("/")
        if silent == "head" and not closing and (name == "body" or name in BLOCK):
            silent = ""  # the end tag may be left out
        if silent:
            if closing and name == silent:
                silent = ""
            continue
        if name in BLOCK:
            cut()
        if closing:
            if name == "a":
                anchors = max(0, anchors - 1)
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), -1)
            if at >= 0:
                close(at)
            continue
        if name in SILENT:
            if not empty:
                silent = name
            continue
        if name == "br":
            words.append(" ")
        if name in VOID or empty:
            continue
        if name == "a":
            anchors += 1
            continue
        why = _marks(attributes) if name not in WHOLE else set()
        hard = bool(why & READERS) or "unseen" in why
        is_main = name in MAIN and not depth_aside and not hard
        is_aside = not is_main and (hard or name in ASIDE and not (name in TITLED and depth_main and not why))
        number += 1
        mark = number if why and not is_aside and not is_main else 0
        if name == "p":  # a paragraph ends the one before it
            while stack and stack[-1][0] == "p":
                close(len(stack) - 1)
        if is_aside or is_main or mark:
            cut()
        depth_aside += is_aside
        if mark:
            marks.append(mark)
        if is_main:
            region += 1
            depth_main += 1
            mains.add(region)
        if is_aside or is_main or mark or name in BLOCK:
            stack.append((name, is_aside, is_main, mark))
            path.append(number)
    cut()

    def held(some: list[Line]) -> set[int]:
        """Marks with more than half of the text of some lines under them."""
        total, under = 0, {}
        for line in some:
            total += len(line.text)
            for mark in line.marks:
                under[mark] = under.get(mark, 0) + len(line.text)
        return {mark for mark, n in under.items() if 2 * n > total}

    void = held(lines) | held([line for line in lines if line.region in mains])
    return [line for line in lines if void.issuperset(line.marks)], mains


def _blocks(sizes: list[int], s: Settings) -> list[tuple[int, int]]:
    """Stretches of lines, from one dive to the next, in which the text surges.

    The sum over ``window`` lines is ``dive`` or less at a dive, and ``surge`` or
    more at a surge; lines without text at the ends of a stretch are no part of it.
    """
    total = list(accumulate(sizes, initial=0))
    sums = [total[min(i + s.window, len(sizes))] - total[i] for i in range(len(sizes))]
    blocks: list[tuple[int, int]] = []
    i = 0
    while i < len(sums):
        if not sizes[i]:
            i += 1
            continue
        end = i
        while end < len(sums) and sums[end] > s.dive:
            end += 1
        if max(sums[i:end]) >= s.surge:
            last = max(k for k in range(i, end) if sizes[k])
            blocks.append((i, last + 1))
        i = end
    return blocks


def main_text(source: str | None, s: Settings = Settings()) -> str:
    """The article's blocks in page order, one per line.

    A block of lines runs from where the text length summed over ``window`` lines
    surges to where it dives, and back to the dive before it. Lines with half or
    more of their text in links count for nothing, but stay if they lie inside a
    block. Of article and main elements with text those are taken whole, and
    nothing else, that a block reaches: one of links alone is a menu. Blocks that
    are parted by such lines only, inside one element of the page or by few, are
    one. If nothing surges, all lines that count are the text.
    """
    lines, mains = lines_of(source or "")
    inside = [line for line in lines if line.region in mains]
    sizes = [len(line.text) - line.linked if 2 * line.linked < len(line.text) else 0 for line in inside or lines]
    if inside:
        # Regions of one outermost element follow each other without a gap.
        unit = {region: region - place for place, region in enumerate(sorted(mains))}
        reached = {unit[line.region] for a, b in _blocks(sizes, s) for line in inside[a:b]}
        return "\n".join(line.text for line in inside if not reached or unit[line.region] in reached)
    joined: list[tuple[int, int]] = []
    for a, b in _blocks(sizes, s):
        if joined:
            between = lines[joined[-1][1] - 1 : a + 1]
            shared = [x[0] for x in zip(*(line.path for line in between)) if len(set(x)) == 1]
            # A page's outermost element holds everything; a deeper one that holds both blocks is the text's own.
            if len(shared) > 1 or len(between) - 2 <= 2 * s.window and not any(sizes[joined[-1][1] : a]):
                joined[-1] = (joined[-1][0], b)
                continue
        joined.append((a, b))
    if joined:
        return "\n".join(line.text for a, b in joined for line in lines[a:b])
    return "\n".join(line.text for line, size in zip(lines, sizes) if size)


def extracted(pages: DataFrame, settings: Settings = Settings(), id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``, without a shuffle.

    NULL and empty pages, and pages without text, give an empty text. Markup
    that is cut off or never closed is read as far as it goes. Ids repeated or
    NULL come back as they are; a missing ``url`` column gives NULLs; an empty
    table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), settings) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
