"""Main text of web pages by the distribution of text over lines.

Markup is stripped into lines: a line is the text of one block element, white space made single, references decoded.
Containers that are page furniture by their tag, role, class or id (menus, headers, footers, sidebars, notices, adverts,
forms, comments) and everything without text of its own leave a gap of empty lines. The weight of a line is the number of its characters
outside links. Over every three lines in a row the weights are summed. Text surges where a sum passes the threshold, and
dives where a sum is zero again; lines between a surge and the next dive are the main text, with headings that stand
right before the surge.

Pages that mark their article say more than lengths do: then lines outside `article` or `main` weigh nothing, and those
inside weigh at least the threshold, so that surge and dive lie on the borders of the article and short paragraphs stay. The
mark is believed only if what it encloses is at least half of the text that lengths alone find: teasers are marked too.

Cases: null and empty pages, and pages without text, give an empty text; cut pages are read to their end; long pages are read
whole; repeated rows give repeated rows; an empty table gives an empty one; other columns are not read. Text before and
after a tag that never ends is text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.words import chunks

WINDOW = 3
#: Characters in three lines from which text surges; half of the page's largest sum where that is less.
THRESHOLD = 86

# Names of the HTML standard.
_BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
              "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav noframes ol p pre section summary table tbody td "
              "tfoot th thead tr ul title".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title noscript template iframe svg math object canvas select".split())
_FURNITURE = set("head nav footer aside form menu dialog button noscript template iframe svg canvas select textarea object label".split())
_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
# Words of class and id that name furniture: always, and unless a word for content stands beside them.
_ALWAYS = set("ad ads adv advert adverts advertisement adsense sponsor sponsored promo promotion cookie cookies consent gdpr newsletter subscribe "
              "subscription signup popup modal overlay sidebar navbar nav navigation menu breadcrumb breadcrumbs comment comments disqus "
              "replies respond share sharing social related recommended recommendations toolbar widget login pagination pager paywall".split())
_UNLESS = set("header masthead footer banner notice notices alert announcement search form aside copyright disclaimer meta byline".split())
_CONTENT = set("article entry post content story text body main".split())
# What readers have written: it stays shut even where each comment is an article of its own.
_READERS = set("comment comments disqus replies respond".split())
#: Elements that hold text and no others: a word of class alone does not make them furniture.
_TEXTUAL = set("p blockquote pre h1 h2 h3 h4 h5 h6 li dd td".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""")
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)


def _class_words(attributes: str) -> set[str]:
    found: set[str] = set()
    for name, value in _NAMES.findall(attributes):
        if name.lower() != "role":
            found |= set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
    return found


def is_furniture(tag: str, attributes: str, inside: bool) -> bool:
    if tag in _FURNITURE or tag == "header" and not inside:
        return True
    if not attributes:
        return False
    if tag == "article":
        return bool(_class_words(attributes) & _READERS)
    if tag in ("html", "body", "main"):
        return False
    if _HIDDEN.search(attributes):
        return True
    words = set()
    for name, value in _NAMES.findall(attributes):
        found = set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
        if name.lower() == "role":
            if found & _ROLES:
                return True
        else:
            words |= found
    if tag in _TEXTUAL:
        return bool(words) and words <= _ALWAYS
    return bool(words & _ALWAYS or words & _UNLESS and not words & _CONTENT)


def lines_of(page: str) -> list[tuple[str, int, bool, bool]]:
    """(text, characters outside links, in an article, heading) for each block; gaps are empty lines."""
    out: list[tuple[str, int, bool, bool]] = []
    parts: list[str] = []
    free = 0  # characters outside links
    skipped, depth = "", 0
    readers = False  # what is skipped is what readers have written
    article = link = heading = 0

    def close(gap: bool = False) -> None:
        nonlocal free
        text = " ".join("".join(parts).split())
        if text:
            out.append((text, min(free, len(text)), article > 0, heading > 0))
        parts.clear()
        free = 0
        if gap:
            out.extend([("", 0, article > 0, False)] * WINDOW)

    def add(raw: str) -> None:
        nonlocal free
        if raw and not skipped:
            text = html.unescape(raw)
            parts.append(text)
            free += 0 if link else len(" ".join(text.split()))

    at, n = 0, len(page)
    while at < n:
        to = page.find("<", at)
        if to < 0:
            add(page[at:])
            break
        add(page[at:to])
        if page.startswith("<!--", to):
            end = page.find("-->", to + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), to):
            end = page.find(">", to)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, to)
        if not m:
            add("<")
            at = to + 1
            if page.find(">", to) < 0:  # no tag can end any more
                add(page[at:])
                break
            continue
        at = m.end()
        ends, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        tag = tag.lower()
        if skipped:
            if tag == skipped:
                depth += -1 if ends else not attributes.endswith("/")
            if depth > 0 and (ends or readers or tag not in ("article", "main") or skipped == "head"):
                if skipped == "head" and tag == "body" and not ends:
                    skipped = ""
                elif not (ends and tag in ("body", "html")):
                    if not ends and tag in ("script", "style"):
                        at = _after_raw(page, at, tag)
                    continue
            skipped, depth = "", 0
            if ends:
                continue
        if not ends and tag in ("script", "style"):
            at = _after_raw(page, at, tag)
            continue
        if not ends and tag not in _VOID and is_furniture(tag, attributes, article > 0):
            close(gap=True)
            if not attributes.endswith("/"):
                skipped, depth = tag, 1
                readers = bool(_class_words(attributes) & _READERS)
            continue
        if tag in ("article", "main"):
            close(gap=True)
            article = max(0, article + (-1 if ends else 1))
        elif tag in _BLOCKS:
            close()
            if re.fullmatch("h[1-6]", tag):
                heading = 0 if ends else 1
            elif not ends:
                heading = 0
        elif tag == "a":
            link = 0 if ends else 1
        elif tag == "br":
            add(" ")
        if tag in _BLOCKS:
            link = 0
    close()
    return out


def _after_raw(page: str, at: int, tag: str) -> int:
    m = re.compile(f"</{tag}[^>]*>", re.I).search(page, at)
    return m.end() if m else len(page)


def _surges(lines: list[tuple[str, int, bool, bool]], weights: list[int]) -> set[int]:
    """The numbers of the lines between surge and dive, with headings right before."""
    sums = [sum(weights[i: i + WINDOW]) for i in range(len(weights))]
    threshold = min(THRESHOLD, max(sums, default=0) / 2)
    kept: set[int] = set()
    i = 0
    while i < len(lines):
        if weights[i] and sums[i] > threshold:  # surge
            start = i
            while start and lines[start - 1][3] and lines[start - 1][0] and weights[start - 1]:
                start -= 1
            while i < len(lines) and sums[i] > 0:  # to the dive
                i += 1
            kept.update(range(start, i))
        i += 1
    return kept


def main_blocks(page: str) -> list[str]:
    lines = lines_of(page)
    kept = _surges(lines, [free for _, free, _, _ in lines])
    if any(inside and text for text, _, inside, _ in lines):
        marked = _surges(lines, [max(free, THRESHOLD) + 1 if inside and text else 0 for text, free, inside, _ in lines])
        size = lambda ks: sum(lines[k][1] for k in ks)
        if 2 * size(marked) >= size(kept):
            kept = marked
    return [lines[k][0] for k in sorted(kept) if lines[k][0]]


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """key, url, text and n_chars (code points) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "page"):
                texts = ["\n\n".join(main_blocks(p or "")) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["key", "address", "text", "n_chars"])

    kinds = [pages.select(c).schema[0].dataType.simpleString() for c in (key, url)]
    slim = pages.select(F.col(key).alias("key"), F.col(url).alias("address"), F.col(page).alias("page"))
    found = slim.mapInArrow(run, f"key {kinds[0]}, address {kinds[1]}, text string, n_chars bigint")
    return found.withColumnsRenamed({"key": key, "address": url})
