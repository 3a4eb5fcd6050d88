"""Main text of web pages by block rules in two passes.

A page is cut into blocks at block-level tags. Pass one decides each block:
inside a page part that never holds the article (menu, header, footer, sidebar,
notice, advert, form, reader comments - by element, role, class or id) it is
boilerplate, and so it is if link-dense; others are text if they are long, or of
middle length with many stop words; the rest stays ambiguous. Stop words of a few
languages are known: on a page whose blocks hold next to none of them (another
language, code, tables) those of middle length are text without them. In pass two
an ambiguous block takes what its nearest decided neighbours are; where the two
differ the nearer one counts, then the text one.

Class names and ids are guesses: a name counts by its first or last word, unless it
begins with a word of state (no-sidebar); of an article element the whole name must be
one. And a part that would hold the article is none: where no block outside page parts
is text or in an article element, parts with half of the page's unlinked text are disregarded and their blocks
judged by the rules, and so is a part (reader comments excepted) with most of it, such
as a wrapper of the page, a form around it, or a menu that is not closed. A link is an
anchor with a target; it ends with the element it stands in.

The article element is a prior, blocks outside it are judged by the same rules.
Inside it a link-dense block stays ambiguous, except where all blocks found to be
text lie outside (cards around a body in a plain element): there the rules hold as
elsewhere. Ambiguous blocks inside look at blocks
inside only, those with few links first and past page parts; without a decided
neighbour they are text.

Scripts, styles, titles, comments and markup are no blocks. Character references
are decoded, white space within a block becomes one blank, blocks are joined by
two line feeds in page order.

Defined results: a null or empty page, or one without text, gives an empty
string; broken markup (unclosed tags, stray ends, unclosed quotes or comments)
is read as far as it goes: a script, style, title or textarea without an end takes
the rest of the page, as in browsers, another element that is not shown ends with
its parent, or before the next block where that is the page or article itself
(svg: always); self-closed it has no content; pages of any length are read whole in one linear
pass; rows that repeat are each extracted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.session import ship_package

# Elements that begin and end a block.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
# Elements whose content is no markup, or not shown as text.
RAW = frozenset("script style title textarea noscript template iframe object svg canvas".split())
# Of those, the ones that hold nothing when self-closed, and no more than their parent when their end is missing.
HOLDERS = RAW - {"script", "style", "title", "textarea"}
# Parents whose next block ends such an element.
ROOTS = frozenset("html body main article p".split()) | HOLDERS
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Page parts that hold no article, by element, role, and word of class or id.
PARTS = frozenset("nav menu footer aside form header dialog button select".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
NAMES = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie
cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices notification pagination popup
promo related share sharing sidebar social sponsor sponsored subscribe subscription""".split())
# Frequent words of English, French, German and Spanish.
STOP_WORDS = frozenset("""the and of to in is that for it was with as on are this be by at or from not
le la les de des du et un une est que qui dans pour par sur en pas au avec
der die das und zu den von mit im dem ein eine nicht auf ist sich des auch als
el los las que y del se una por con para no su como es""".split())

# Words of NAMES that stand for reader comments.
REMARKS = frozenset("comment comments disqus".split())
# Words with which a name tells how a page looks, not what an element is.
STATES = frozenset("no has with without hide show is not".split())

# Of a page's unlinked text: what makes a part suspicious, and what makes it none.
HALF, MOST = 0.5, 0.8
MANY_STOP_WORDS, SOME_STOP_WORDS = 0.3, 0.1
MANY_LINKS = 0.5
SHORT, LONG = 70, 140

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^\"'>]*+)(>?)")
_STOP = re.compile(r"[\"'>]")
_BEGUN = re.compile(r"</?[A-Za-z]")
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])([^\s"'>/=]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")
_NAME = re.compile(r"[a-z0-9]+")
_WORDS = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int      # code points inside links
    outside: bool    # in a part that holds no article
    article: bool
    parts: tuple[int, ...] = ()     # the parts around it, those of reader comments negative


def _named(value: str, whole: bool) -> str | None:
    """The word by which a class or id names a part."""
    for name in value.split():
        words = _NAME.findall(name)
        if len(words) == 1 or whole:
            if len(words) == 1 and words[0] in NAMES:
                return words[0]
        elif words and words[0] not in STATES:
            for word in (words[0], words[-1]):
                if word in NAMES:
                    return word
    return None


def _part(tag: str, attributes: str, in_article: bool) -> str | None:
    """What part an element is, if any."""
    if tag in PARTS and not (tag == "header" and in_article):
        return tag
    if tag in ("html", "body", "main"):
        return None
    for m in _ATTRIBUTE.finditer(attributes) if attributes else ():
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "role":
            if value.strip() in ROLES:
                return value.strip()
        elif name in ("class", "id") and not (in_article and tag == "header") and (found := _named(value, tag == "article")):
            return found
    return None


def _has_target(attributes: str) -> bool:
    return any(m[1].lower() == "href" for m in _ATTRIBUTE.finditer(attributes))


def blocks(html: str) -> Iterator[Block]:
    """Blocks with text, in page order."""
    stack: list[tuple[str, bool, bool, tuple[int, ...]]] = []      # tag, not shown, article, parts around
    opened: dict[str, int] = {}                   # how often each tag is on it
    pieces: list[str] = []
    endless: set[str] = set()                     # tags that do not end any more
    linked = links = numbered = 0
    link_depth = 0                                # elements around the open link
    pos, size = 0, len(html)
    closed = -1                                   # the next ">"
    open_quotes: set[int] = set()                 # quotes behind which the tag does not end
    lower = html.lower() if len(html.lower()) == size else html

    def block() -> Block | None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        pieces.clear()
        _, hidden, article, parts = stack[-1] if stack else ("", False, False, ())
        found = Block(text, min(linked, len(text)), hidden or bool(parts), article, parts) if text else None
        linked = 0
        if hidden and endless and any(map(opened.get, endless)):
            return None                            # not shown
        return found

    def text(a: int, b: int) -> None:
        nonlocal linked
        if a < b:
            piece = unescape(html[a:b])
            pieces.append(piece)
            if links:
                linked += len(piece)

    def tag_end(a: int) -> int:
        """The ``>`` of the tag read up to ``a``: the first outside quoted values,
        or the first of all if the quotes do not close. Each quote that leads to
        no end is followed once."""
        tried = []
        while (stop := _STOP.search(html, a)) is not None:
            k = stop.start()
            if stop[0] == ">":
                return k
            a, before = k + 1, html[a:k].rstrip()
            if before.endswith("="):
                if k in open_quotes:
                    break
                tried.append(k)
                a = html.find(stop[0], k + 1) + 1
                if not a:
                    break
        open_quotes.update(tried)
        return closed

    while pos < size:
        at = html.find("<", pos)
        if at < 0:
            text(pos, size)
            break
        text(pos, at)
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            pos = size if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), at):
            end = html.find(">", at)
            pos = size if end < 0 else end + 1
            continue
        if closed < at:
            closed = html.find(">", at)
        if closed < 0:                             # no tag ends any more: what begins one is no text
            begun = _BEGUN.search(html, at)
            text(at, begun.start() if begun else size)
            break
        m = _TAG.match(html, at)
        if not m:                                  # a plain "<"
            text(at, at + 1)
            pos = at + 1
            continue
        end = m.end() - 1 if m[4] else tag_end(m.end(2))
        attributes = m[3] if m[4] else html[m.end(2):end]
        pos, closing, tag = end + 1, m[1] == "/", m[2].lower()
        if not closing and tag in RAW:
            if tag in HOLDERS and attributes.endswith("/"):
                continue
            end = -1 if tag in endless else lower.find(f"</{tag}", pos)
            if end >= 0:
                end = html.find(">", end)
                pos = size if end < 0 else end + 1
            elif tag in HOLDERS:
                endless.add(tag)
                if (found := block()) is not None:
                    yield found
                stack.append((tag, True, stack[-1][2] if stack else False, stack[-1][3] if stack else ()))
                opened[tag] = opened.get(tag, 0) + 1
            else:
                pos = size
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag == "a":
            links = 0 if closing or not _has_target(attributes) else 1
            link_depth = len(stack)
            continue
        is_block = tag in BLOCKS
        named = not is_block and not closing and _part(tag, attributes, False) is not None
        if not is_block and not named and not (closing and opened.get(tag)):
            continue
        if (found := block()) is not None:
            yield found
        if closing:
            while opened.get(tag):
                top = stack.pop()[0]
                opened[top] -= 1
                if top == tag:
                    break
            if len(stack) < link_depth:
                links = 0                          # the element around the link has ended
        elif tag not in VOID and not attributes.endswith("/"):
            while is_block and stack and stack[-1][0] in HOLDERS and (
                    stack[-1][0] == "svg" or len(stack) == 1 or stack[-2][0] in ROOTS):
                opened[stack.pop()[0]] -= 1
            if stack and stack[-1][0] == "p" and is_block:
                stack.pop()
                opened["p"] -= 1
            _, hidden, article, parts = stack[-1] if stack else ("", False, False, ())
            part = _part(tag, attributes, article)
            if tag in ("article", "main") and not part and not article:
                hidden, article, parts = False, True, ()     # what is left open before does not reach into it
            if part:
                numbered += 1
                parts = (*parts, -numbered if part in REMARKS else numbered)
            stack.append((tag, hidden, article, parts))
            opened[tag] = opened.get(tag, 0) + 1
    if (found := block()) is not None:
        yield found


def _without_wrappers(found: list[Block]) -> list[Block]:
    """The blocks with parts disregarded that must hold the article."""
    held: dict[int, int] = {}
    total = 0
    for b in found:
        total += len(b.text) - b.linked
        for part in b.parts:
            held[part] = held.get(part, 0) + len(b.text) - b.linked
    others = any(_first_pass(found)) or any(b.article and not b.outside for b in found)
    loose = {part for part, n in held.items() if n >= (MOST if others else HALF) * total and (part > 0 or not others)}
    if not loose:
        return found
    return [b if not b.parts or not loose.issuperset(b.parts) else replace(b, outside=False) for b in found]


def _first_pass(found: list[Block]) -> list[bool | None]:
    """Per block True: text, False: boilerplate, None: ambiguous."""
    out: list[bool | None] = []
    middle: list[tuple[int, float]] = []      # blocks of middle length and their share of stop words
    n = known = 0
    for k, b in enumerate(found):
        if b.outside or b.linked >= MANY_LINKS * len(b.text):
            out.append(False)
            continue
        words = _WORDS.findall(b.text.lower())
        stops = sum(w in STOP_WORDS for w in words)
        n, known = n + len(words), known + stops
        out.append(True if len(b.text) >= LONG else None)
        if SHORT <= len(b.text) < LONG:
            middle.append((k, stops / len(words) if words else 0.0))
    silent = known < SOME_STOP_WORDS * n      # the known stop words tell nothing about this page
    for k, share in middle:
        if silent or share >= MANY_STOP_WORDS:
            out[k] = True
    return out


def _second_pass(first: list[bool | None]) -> list[bool]:
    n = len(first)
    left: list[tuple[int, bool] | None] = [None] * n
    right: list[tuple[int, bool] | None] = [None] * n
    last = None
    for k in range(n):
        last = (k, first[k]) if first[k] is not None else last
        left[k] = last
    last = None
    for k in reversed(range(n)):
        last = (k, first[k]) if first[k] is not None else last
        right[k] = last
    out = []
    for k in range(n):
        a, b = left[k], right[k]
        if first[k] is not None:
            out.append(first[k])
        elif a is None or b is None:
            out.append(bool((a or b or (k, True))[1]))
        elif a[1] == b[1] or k - a[0] < b[0] - k:
            out.append(a[1])
        else:
            out.append(b[1] if b[0] - k < k - a[0] else True)
    return out


def _article_pass(found: list[Block], first: list[bool | None]) -> list[bool | None]:
    """Decides the blocks of article elements, the others stay as they are."""
    inside = [k for k, b in enumerate(found) if b.article]
    free = [k for k in inside if not found[k].outside]
    out = list(first)
    if any(first[k] for k in free) or not any(first):
        for k in free:
            out[k] = out[k] or None
    few = [k for k in free if out[k] is not None or found[k].linked < MANY_LINKS * len(found[k].text)]
    for some in (few, inside):
        for k, keep in zip(some, _second_pass([out[k] for k in some])):
            out[k] = keep
    return out


def main_text(html: str | None) -> str:
    found = _without_wrappers(list(blocks(html or "")))
    keep = _second_pass(_article_pass(found, _first_pass(found)))
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """``(<id>, <url>, text, n_chars)`` per page. Map-only."""
    ship_package(pages.sparkSession)
    return pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(
        _batches, "id long, url string, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})
