"""Main text of HTML by line-block distribution.

Markup is stripped into lines, one a block; menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments are stripped with it, by their elements and names. A line weighs
as many characters as it has outside links; a heading weighs all of its own. The weights are summed over sliding windows of
`window` lines: a region surges where a sum reaches `surge` characters (or `share` of the page's
greatest sum, if that is less) and dives where a whole window weighs nothing. That says what the page's main text is:

* The article and main elements whose own sums surge, if they hold more than `share` of all that weighs.
* Else the regions that surge, and what stands in the element that holds the long lines of the region that weighs most.

Of these lines, runs of `window` or more that weigh nothing (menus by another name) go; shorter runs stay, as do short lines
beside or between regions: their length doesn't tell a poem or a closing paragraph from a notice.

Names mark containers only, never headings or paragraphs. Inside an article or main element a whole
class name must be one of NAMES, or a name or id be of reader comments; elsewhere each part of a class name or id, but for
parts of place (PLACES). An article inside a marked element goes with it if comments, teasers or footers
may hold articles (HOLDERS); it ends any other, which wasn't closed or was wrapped around the page.

Defined cases: null html is empty and gives an empty text of 0 characters; pages without main
text give an empty text; a page all of whose lines are links is weighed with them; tags cut off at the end of the page are dropped; references that
are cut off stay as they stand; elements that are never closed end with what holds them, but for raw ones (scripts, styles), which
reach to the page's end as in browsers; repeated rows are extracted alike; extra columns are ignored.
"""

from __future__ import annotations

import html as htmllib
import re
from dataclasses import dataclass
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>|<[a-zA-Z/!?][^>]*+\Z|[^<]++|<""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden|itemprop)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPLIT = re.compile(r"[_:-]+")
#: HTML elements (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp".split())
_CLOSE = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*+>?", re.I) for tag in RAW}
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol option p pre search section select summary table tbody tfoot thead title tr ul caption".split()
)
#: Elements and name parts of what is not main text.
DROPPED = frozenset("nav footer aside form head menu select button dialog fieldset search svg canvas object".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login sidebar side aside menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments disqus "
    "reply replies respond social share sharing related recommended recommendations widget toolbar pagination pager copyright skip search".split()
)
#: Name parts that only say where something is; elements whose names mark them; what an article's own container may be called.
PLACES = frozenset("site global top bottom left right bar box list wrapper container inner area".split())
CONTAINERS = frozenset("div section ul ol dl table tbody tr td details center".split())
OWN = frozenset("header masthead".split())
#: Elements that hold lines, rather than be one.
HOLDING = CONTAINERS | frozenset("html body article main header hgroup dir address".split())
MARKING, WITHIN = NAMES | PLACES, NAMES - OWN
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
MAIN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What may hold articles of its own: elements and name parts; and the names of reader comments, with parts of theirs.
HOLDERS = frozenset("aside footer comment comments disqus reply replies respond related recommended recommendations sidebar side promo promotion sponsored widget".split())
COMMENTS = frozenset("comment comments disqus reply replies respond".split())
ITEMS = PLACES | COMMENTS | frozenset("body item thread section".split())
#: An open element that an opening tag closes.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def _marked(tag: str, attributes: str, inside: bool) -> frozenset | None:
    """The element or names that say that it holds something other than main text; None: none do."""
    if tag in DROPPED or (tag == "header" and not inside):
        return frozenset([tag])
    if not attributes or tag in ("html", "body", "main"):
        return None
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if tag != "article":
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in ROLES):
                return frozenset([value])
            if name == "style" and "display:none" in value.replace(" ", ""):
                return frozenset([name])
        if name == "itemprop" and value == "comment":
            return COMMENTS
        if name not in ("class", "id") or (tag not in CONTAINERS and tag != "article"):
            continue
        for x in value.split():
            parts = frozenset(p for p in _SPLIT.split(x) if p)
            if not COMMENTS.isdisjoint(parts) and parts <= ITEMS:
                return parts
            if tag == "article":
                if not HOLDERS.isdisjoint(parts) and parts <= MARKING:
                    return parts
            elif (name == "class" and x in WITHIN) if inside else (not NAMES.isdisjoint(parts) and parts <= MARKING):
                return parts
    return None


@dataclass
class Line:
    text: str
    weight: int
    frame: int  # the article or main element that holds it, from 1; 0: none
    element: int  # the innermost of HOLDING


def lines_of(html: str) -> tuple[list[Line], list[int]]:
    """The lines that no element or name drops, and the parent of each element."""
    out: list[Line] = []
    parts: list = []  # (text, whether it stands in a link)
    parent = [0]
    stack: list = []  # (tag, names that drop it or None, frame, element)
    dropped, frame, element, frames = None, 0, 0, 0
    linked = heading = False

    def flush() -> None:
        nonlocal linked
        linked = False
        if parts and dropped is None:
            text = " ".join("".join(t for t, _ in parts).split())
            if text:
                links = any(k for _, k in parts) and not heading
                out.append(Line(text, len("".join("".join(t for t, k in parts if not k).split())) if links else len(text), frame, element))
        parts.clear()

    at = 0
    while at < len(html):
        m = _TOKEN.match(html, at)
        at = m.end()
        token = m[0]
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if token[0] != "<" or token == "<":
                parts.append((htmllib.unescape(token), linked))
            elif token.startswith("<![CDATA["):
                parts.append((token[9:].removesuffix("]]>"), linked))
            continue
        block = tag in BLOCK
        if m[1] or m[4]:
            if block:
                flush()
                heading = False
            elif tag in ("td", "th"):
                parts.append((" ", linked))
            elif tag == "a":
                linked = False
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    _, before, own, _ = stack[i - 1] if i else ("", None, 0, 0)
                    if (before, own) != (dropped, frame):
                        flush()
                    del stack[i:]
                    _, dropped, frame, element = stack[-1] if stack else ("", None, 0, 0)
                    break
            continue
        if block:
            flush()
            heading = tag in HEADINGS
            if stack and stack[-1][0] == "p" and tag != "br":
                stack.pop()
        elif tag in ("td", "th"):
            parts.append((" ", linked))
        if stack and stack[-1][0] in CLOSES.get(tag, ()):
            stack.pop()
        if not stack:
            dropped, frame, element = None, 0, 0
        else:
            _, dropped, frame, element = stack[-1]
        attributes = m[3] or m[6] or ""
        if tag in RAW:
            if not attributes.rstrip().endswith("/"):
                # Its contents are no markup: only its own closing tag, or the page's end, ends it.
                close = _CLOSE[tag].search(html, at)
                at = close.end() if close else len(html)
            continue
        if tag in VOID:
            continue
        if tag == "a":
            linked = "href" in attributes.lower()
            continue
        names = None if dropped is not None and tag not in MAIN else _marked(tag, attributes, frame > 0)
        if tag in MAIN and not frame and names is None and (dropped is None or HOLDERS.isdisjoint(dropped)):
            if dropped is not None:
                # What stands open around it wasn't closed, or wraps the page.
                stack.clear()
                dropped = None
            frames += 1
            frame = frames
        elif dropped is None and names is not None:
            flush()
            dropped = names
        if tag in HOLDING:
            parent.append(element)
            element = len(parent) - 1
        stack.append((tag, dropped, frame, element))
    flush()
    return out, parent


def _sums(weights: list[int], window: int) -> list[int]:
    """Of the windows that begin with each line."""
    total = [0, *accumulate(weights)]
    n = len(weights)
    return [total[min(n, i + window)] - total[i] for i in range(n)]


def _regions(weights: list[int], window: int, least: float) -> list[tuple[int, int]]:
    """[surge, dive) of each region, from its first line to its last that weighs something."""
    sums, out, i = _sums(weights, window), [], 0
    while i < len(sums):
        if sums[i] < least or not weights[i]:
            i += 1
            continue
        start = i
        while i < len(sums) and sums[i]:
            i += 1
        out.append((start, i))
    return out


def _trough(weights: list[int], window: int) -> list[bool]:
    """Whether each line is in a run of `window` lines or more that weigh nothing."""
    out: list = []
    for heavy, run in groupby(weights, bool):
        n = len(list(run))
        out += [not heavy and n >= window] * n
    return out


def _holder(elements: list[int], parent: list[int]) -> int:
    """The innermost element that holds all of these."""
    common, *others = sorted(set(elements))
    for e in others:
        while e != common:  # an element's number is above its parent's
            e, common = max(e, common), min(e, common)
            e = parent[e]
    return common


def main_text(html: str | None, window: int = 3, surge: int = 80, share: float = 0.25) -> str:
    lines, parent = lines_of(html or "")
    weights = [x.weight for x in lines]
    if not any(weights):
        weights = [len(x.text) for x in lines]
    least = min(surge, share * max(_sums(weights, window), default=0))
    regions = _regions(weights, window, least)
    if not regions:
        return ""
    frames: dict = {}
    for i, x in enumerate(lines):
        if x.frame:
            frames.setdefault(x.frame, []).append(i)
    own = {f: [weights[i] for i in at] for f, at in frames.items()}
    own = {f: w for f, w in own.items() if max(_sums(w, window)) >= least}
    if sum(map(sum, own.values())) > share * sum(weights):
        kept = [i for f, w in own.items() for i, low in zip(frames[f], _trough(w, window), strict=True) if not low]
    else:
        core = max(regions, key=lambda r: sum(weights[r[0] : r[1]]))
        surged = {i for r in regions for i in range(*r)}
        long = [lines[i].element for i in range(*core) if weights[i] >= least] or [lines[i].element for i in range(*core)]
        holder = _holder(long, parent)
        beside: list = []  # whether each element stands in the holder
        for e, up in enumerate(parent):
            beside.append(e == holder or (e > 0 and beside[up]))
        kept = [i for i, low in enumerate(_trough(weights, window)) if not low and (beside[lines[i].element] or i in surged)]
    return "\n".join(lines[i].text for i in sorted(kept))


def extract(pages: DataFrame, window: int = 3, surge: int = 80, share: float = 0.25) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""

    def run(it):
        for rb in it:
            texts = [main_text(h, window, surge, share) for h in rb.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    cols = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return cols.mapInArrow(run, "page_id long, url string, text string, n_chars long")
