"""HTML extraction by two-pass block rules.

A page is cut into blocks at block-level tags. Menus, headers, footers,
sidebars, notices, adverts, forms and comments are boilerplate by their
container, and with an article or main element all that stands outside it.
Class and id names make no boilerplate of an element that holds the main
element or, without one, all of the page's long text. Pass one decides the
other blocks, inside a main element or not, by link density, length and
stop-word density; a main element lowers the length from which running text is
decided, leaves long text without stop words open and links too, unless they
are a list of three or more without stop words. Pass two lets every
undecided block take the label of its nearest decided neighbours. Content
blocks are joined in page order.

Each page is independent, so the work is one map over the rows: no shuffle,
memory bounded by the longest page of a batch.

Defined results: null or empty html gives an empty text; a comment, script or
style that never ends runs to the end of the page; a head ends at the first
thing that can't be in it, a title or textarea without its closing tag at the
next block; a self-closed raw element is empty; unknown closing tags are
ignored; repeated rows are extracted one by one; extra columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .common import narrow, python_ready, table
from .quality_rules import STOP_WORDS

_STOP = frozenset(STOP_WORDS)

# Elements of HTML, by what they do to the text around them.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html iframe legend li main menu nav ol option p pre
section select summary table tbody td tfoot th thead tr ul""".split())
RAW_TAGS = frozenset(("script", "style", "template", "textarea", "title"))    # up to their closing tag, no text of the page
HEAD_TAGS = frozenset("base head html link meta noscript script style template title".split())
OPEN_TAGS = frozenset(("head", "title", "textarea"))     # end at the next block when they aren't closed
FOREIGN_TAGS = frozenset(("svg", "math"))
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside form menu dialog button select iframe".split())
MAIN_TAGS = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Parts of class and id names, and roles, of boilerplate containers.
BOILERPLATE_NAMES = frozenset("""ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent
cookie cookies copyright disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices
pagination popup promo promotion related reply replies respond share sharing sidebar signup social sponsor sponsored
subscribe teaser toolbar widget""".split())
BOILERPLATE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form navigation search".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+)>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)", re.S | re.I)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_CLOSE = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW_TAGS}
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\s*$")
_PART = re.compile(r"[^a-z0-9]+")

LONG_CHARS = 140          # a block this long is decided by its stop words
SHORT_CHARS = 40          # and inside the main element one this long
STOP_HIGH = 0.12          # share of stop words of running text
LIST_LINKS = 3            # so many link-dense blocks in a row are a menu, inside a main element too
STOP_LOW = 0.04           # below it a long block outside a main element is none
LINK_HIGH = 0.5           # share of characters inside links


def _bad_container(tag: str, attrs: str) -> tuple[bool, bool]:
    """Whether an element is boilerplate by its tag or role, and by its names."""
    bad, named = tag in BOILERPLATE_TAGS, False
    for m in _NAMES.finditer(attrs):
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            bad = bad or value in BOILERPLATE_ROLES
        else:
            named = named or not BOILERPLATE_NAMES.isdisjoint(_PART.split(value))
    return bad, named


@dataclass
class _Block:
    text: str
    linked: int
    heading: bool
    bad: bool                  # inside a container that is boilerplate by tag or role
    named: int                 # the innermost container around it that is boilerplate by name, else 0
    main: int                  # the innermost main element around it, else 0


def _holders(found: list[_Block], around: dict[int, int], mains: dict[int, tuple[str, int, int]]) -> set[int]:
    """The named containers whose names don't count, as they hold the main
    element or, without one, all long text. ``around``: the next named
    container around each one, else 0; ``mains``: tag, innermost named
    container and next main element around each main element."""
    def chain(k: int) -> list[int]:
        out = []
        while k:
            out.append(k)
            k = around[k]
        return out

    sound = [b for b in found if not b.bad]
    held = dict.fromkeys(mains, 0)
    for b in sound:
        if b.main:
            held[b.main] += len(b.text)
    for k in sorted(mains, reverse=True):      # inner ones start later
        if mains[k][2]:
            held[mains[k][2]] += held[k]
    held = {k: n for k, n in held.items() if n}
    first = [k for k in held if mains[k][0] == "main"] or list(held)
    best = max(sorted(first), key=lambda k: held[k], default=0)
    # a teaser in a sidebar is no main element beside longer text
    if best and held[best] >= sum(len(b.text) for b in sound if not b.main and not b.named):
        return set(chain(mains[best][1]))
    if any(b.main and not b.named for b in sound):
        return set()
    long = [b for b in sound if len(b.text) >= LONG_CHARS and b.linked <= LINK_HIGH * len(b.text)] or sound
    if not long:
        return set()
    common = chain(long[0].named)
    place = {k: i for i, k in enumerate(common)}
    start, walked = 0, {0}
    for b in long[1:]:
        k = b.named
        while k not in place and k not in walked:
            walked.add(k)
            k = around[k]
        if k in place:
            start = max(start, place[k])
        elif k == 0:
            return set()
    return set(common[start:])


def blocks(page: str) -> list[tuple[str, int, bool, bool, bool]]:
    """Non-empty blocks in page order: (text, characters in links, inside a
    boilerplate container, inside a main element, is a heading)."""
    out: list[_Block] = []
    # open elements: tag, boilerplate by tag or role (with its ancestors'), innermost named container, innermost main element
    stack: list[tuple[str, bool, int, int]] = []
    around: dict[int, int] = {}
    mains: dict[int, tuple[str, int, int]] = {}
    unclosed: set[str] = set()
    parts: list[str] = []
    linked = links = foreign = at = 0
    pending = -1               # place of the first of OPEN_TAGS in the stack
    heading = False

    def flush() -> None:
        nonlocal linked, heading
        if parts:
            text = " ".join(_html.unescape("".join(parts)).split())
            if text:
                out.append(_Block(text, linked, heading, *(stack[-1][1:] if stack else (False, 0, 0))))
            parts.clear()
        linked, heading = 0, False

    def cut(k: int) -> None:
        nonlocal foreign, pending
        foreign -= sum(e[0] in FOREIGN_TAGS for e in stack[k:])
        del stack[k:]
        if pending >= k:
            pending = -1

    def end_open() -> None:
        if pending >= 0:
            cut(pending)

    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        text = m["text"]
        if text is not None:
            if stack and stack[-1][0] == "head" and text.strip():
                flush()
                end_open()
            parts.append(text)
            if links:
                linked += len(text.strip())
            continue
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW_TAGS and not m["end"]:
            if _SELF_CLOSED.search(m["attrs"]):
                continue
            close = None if tag in unclosed else _CLOSE[tag].search(page, at)
            if close:
                at = close.end()
                continue
            unclosed.add(tag)
            if tag in ("script", "style"):
                break
            if tag == "template":
                continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS or tag in OPEN_TAGS:
            flush()
            links = 0
        if m["end"]:
            if tag == "a":
                links = 0
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    cut(k)
                    break
        elif tag not in VOID_TAGS:
            if tag in BLOCK_TAGS:
                end_open()
            elif stack and stack[-1][0] == "head" and tag not in HEAD_TAGS:
                flush()
                end_open()
            if (foreign or tag in FOREIGN_TAGS) and _SELF_CLOSED.search(m["attrs"]):
                continue
            if tag == "a":
                links = 1
            if tag == "p" or tag in HEADINGS:
                # a new paragraph or heading ends the open one
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p" or stack[k][0] in HEADINGS:
                        cut(k)
                        break
                    if stack[k][0] in BLOCK_TAGS:
                        break
            bad, named, main = stack[-1][1:] if stack else (False, 0, 0)
            if tag in OPEN_TAGS:
                bad = True
                pending = len(stack) if pending < 0 else pending
            elif (tag in BLOCK_TAGS or m["attrs"].strip()) and tag not in ("body", "html", "a"):
                by_tag, by_name = _bad_container(tag, m["attrs"])
                bad = bad or by_tag
                if by_name:
                    around[at], named = named, at
            if tag in MAIN_TAGS:
                mains[at], main = (tag, named, main), at
            stack.append((tag, bad, named, main))
            foreign += tag in FOREIGN_TAGS
            if tag in HEADINGS:
                heading = True
    flush()
    free = _holders(out, around, mains) | {0}
    return [(b.text, b.linked, b.bad or b.named not in free, b.main > 0, b.heading) for b in out]


def _stop_share(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(".,;:!?%*#&$|\"'()") in _STOP for w in words) / max(1, len(words))


def _links(text: str, linked: int) -> bool:
    return linked > LINK_HIGH * len(text)


def _in_lists(dense: list[bool]) -> list[bool]:
    """Whether each block is one of ``LIST_LINKS`` or more link-dense ones in a row."""
    out, start = [False] * len(dense), 0
    for k, is_dense in enumerate([*dense, False]):
        if not is_dense:
            out[start:k] = [k - start >= LIST_LINKS] * (k - start)
            start = k + 1
    return out


def _first_pass(text: str, dense: bool, listed: bool, heading: bool, main: bool, known: bool) -> bool | None:
    """A block's label by its own densities; None: undecided. ``known``: some
    long block of the region has the stop words of running text, so that their
    lack says something."""
    stops = _stop_share(text)
    if dense:
        # inside the main element a menu goes; other links wait for their neighbours
        return None if main and (heading or not listed or stops >= STOP_HIGH) else False
    if heading or len(text) < (SHORT_CHARS if main else LONG_CHARS):
        return None
    if stops >= STOP_HIGH or not known:
        return True
    return None if main or stops >= STOP_LOW else False


def _second_pass(first: list[bool | None]) -> list[bool]:
    """Undecided blocks take the nearest decided label, content on equal
    distances and where nothing is decided."""
    n = len(first)
    before: list[tuple[int, bool]] = [(n + 1, True)] * n
    after = list(before)
    for side, order in ((before, range(n)), (after, range(n - 1, -1, -1))):
        d, label = n + 1, True
        for k in order:
            if first[k] is not None:
                d, label = 0, first[k]
            side[k] = (d, label)
            d += 1
    return [lb if db < da else la if da < db else (la or lb) for (db, lb), (da, la) in zip(before, after)]


def labels(found: list[tuple[str, int, bool, bool, bool]]) -> list[bool]:
    """Both passes: whether each block is content. With a main element they
    judge its blocks, each other's neighbours alone, and what stands outside it
    goes; without one they judge the page, where boilerplate containers are
    decided neighbours."""
    has_main = any(main and not bad for _, _, bad, main, _ in found)
    region = [k for k, (_, _, bad, main, _) in enumerate(found) if not has_main or main and not bad]
    dense = [_links(*found[k][:2]) for k in region]
    known = any(_stop_share(found[k][0]) >= STOP_HIGH for k, d in zip(region, dense)
                if not (d or found[k][2]) and len(found[k][0]) >= LONG_CHARS)
    first = [False if bad else _first_pass(text, d, listed, heading, has_main, known)
             for (text, _, bad, _, heading), d, listed in zip((found[k] for k in region), dense, _in_lists(dense))]
    out = [False] * len(found)
    for k, label in zip(region, _second_pass(first)):
        out[k] = label
    return out


def main_text(page: str | None) -> str:
    """The content blocks of a page, joined by one newline."""
    if not page:
        return ""
    found = blocks(page)
    return "\n".join(b[0] for b, good in zip(found, labels(found)) if good)


def extract_html(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    python_ready(pages.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            text = [main_text(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return narrow(pages, {"page_id": "long", "url": "string", "html": "string"}).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")


# query --------------------------------------------------------------------
def op9_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract_html(table(spark, sf_dir, "pages"))
