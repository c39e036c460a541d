"""Main text of web pages by tag-path ratios.

The page is read once into blocks: runs of text between block-level tags, each
with its root-to-leaf tag path (inline tags left out). Text length, punctuation
and link text are summed per path; a path's ratio is its text per block fused
with its punctuation per block, less its share of link text. Each block then
takes the mean of the ratios around it, weighted by distance and by how much of
their paths is shared, and a path is content if its smoothed ratio reaches a
share of the page's mean (weighted by text). A path below that (short items, cells,
lines) stays too if it lies in the article or in the element around blocks of
content, unless it is mostly link text. Where most of the content taken stands in an
article (or ``main``), what follows it outside (a thread of comments, say) is dropped. Paths through elements that never hold the
article (menus, footers, scripts...) have ratio 0; so have those through forms and
elements named like them, but not if most of the page's article lies inside.

Scale: a page is a row; there is no shuffle.

Defined cases: a null or empty html gives an empty text; unclosed and stray tags
are closed as browsers do for paragraphs, list items and cells; bad character
references stay as they are; repeated rows are judged each; other columns are
passed through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from .words import annotate

SHARE = 0.15
SIGMA = 1.0
REACH = 3

# fixed values: element names of HTML
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg math select xmp noembed noframes".split())
ASIDE = frozenset("nav header footer aside form button menu dialog label fieldset legend head".split())
HOLDERS = frozenset("html body main article".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "thead": {"tr", "td", "th"},
}
SCOPES = frozenset("ul ol dl table td th body html".split())
#: parts of lists, tables and quotes: what they stand in is the container of their text
PARTS = frozenset("ul ol dl li dt dd table thead tbody tfoot tr td th caption blockquote figure figcaption details pre p center".split())
#: names that may be given to an element around an article, or around a whole page
WRAPPERS = frozenset("form fieldset".split())
#: words of whole class, id and role names of what surrounds an article; a name may
#: have several, a place before and a part after them
_PLACE = "bottom|global|google|left|main|page|post|reader|right|side|site|top|user"
_WORD = (
    "ads?|advert|advertise|advertising|advertisements?|banners?|breadcrumbs?|commentform|commentlist|comments?|consent|cookiebar|cookieconsent|"
    "cookies?|disclaimer|disqus|footer|header|masthead|menu|modal|nav|navbar|navigation|navmenu|newsletter|notices?|pagination|popup|promos?|"
    "promotions?|promotional|related|replies|reply|share|sharing|sidebar|social|sponsors?|sponsored|subscribe|toolbar|widgets?")
_PART = "area|bar|block|body|box|button|buttons|container|form|group|icon|icons|inner|item|items|label|link|links|list|panel|row|section|slot|unit|wrap|wrapper"
#: words that name what surrounds an article wherever they stand in a name
_ALWAYS = "advert|advertisements?|breadcrumbs?|consent|cookies?|disqus|gdpr|newsletter|notices?|pagination|popup|promos?|sidebar|sponsored"
AROUND = re.compile(rf"(?:^|[\s_-])(?:{_ALWAYS})(?=[\s_-]|$)|(?:^|\s)(?:(?:{_PLACE})[-_]*)*(?:{_WORD})(?:[-_]+(?:{_WORD}|{_PART}|\d+))*(?=\s|$)")

#: a quote opens a value right after the equals sign only; other values end at white space or >
_VALUE = r"=\s*\"[^\"]*+(?:\"|\Z)|=\s*'[^']*+(?:'|\Z)|=\s*[^\s\"'>][^\s>]*+"
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:" + _VALUE + r"|[^>])*+)(?:>|\Z)", re.S)
_NAMES = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*))", re.I)
_MARKS = re.compile(r"[.,;:!?…。，、¿¡]")


def blocks(html: str) -> Iterator[tuple[tuple[str, ...], str, int, tuple[tuple[int, int], ...]]]:
    """(path, text, characters of link text, marks) of each block with text, in page order.

    An element that surrounds articles has its path entry marked with ``-``; the marks
    are the places of such entries in the path, and where in the page each element begins.
    """
    path: list[str] = []
    begun: list[int] = []
    text: list[str] = []
    linked, links = 0, 0

    def flush() -> Iterator[tuple[tuple[str, ...], str, int, tuple[tuple[int, int], ...]]]:
        nonlocal text, links
        whole = " ".join(unescape("".join(text)).split()) if text else ""
        if whole:
            yield tuple(path), whole, min(links, len(whole)), tuple((k, begun[k]) for k, x in enumerate(path) if x[0] == "-")
        text, links = [], 0

    at = 0
    while at < len(html):
        m = _TOKEN.search(html, at)
        upto = m.start() if m else len(html)
        if upto > at:
            text.append(html[at:upto])
            if linked:
                links += len(html[at:upto].strip())
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name in RAW and not closing:
            if not m[0].endswith("/>"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if name in INLINE:
            if name == "a":
                linked = 0 if closing else 1
            elif name == "br":
                text.append(" ")
            continue
        yield from flush()
        linked = 0
        if closing:
            names = [p.lstrip("-").split(".")[0] for p in path]
            if name in names:
                del path[len(names) - 1 - names[::-1].index(name) :]
            continue
        if name in VOID:
            continue
        _imply(path, name)
        if not m[0].endswith("/>"):
            label = " ".join(x for g in _NAMES.findall(m[3] or "") for x in g if x).lower()
            around = name in ASIDE or bool(label and name not in HOLDERS and AROUND.search(label))
            del begun[len(path) :]
            begun.append(at)
            path.append(("-" if around else "") + name + ("." + label.replace(" ", ".") if label else ""))
    yield from flush()


def _imply(path: list[str], name: str) -> None:
    """Close what a browser closes before it opens ``name``."""
    if path and path[-1].lstrip("-").split(".")[0] == "p":
        path.pop()
    if name in CLOSES:
        for k in range(len(path) - 1, -1, -1):
            here = path[k].lstrip("-").split(".")[0]
            if here in CLOSES[name]:
                del path[k:]
                if name not in ("tr", "tbody"):
                    break
            elif here in SCOPES:
                break


def released(found: list[tuple[tuple[str, ...], str, int, tuple[tuple[int, int], ...]]]) -> list[tuple[tuple[str, ...], str, int]]:
    """(path, text, links), without the marks of forms and named elements that hold the page's article.

    That is most of the text in articles (or ``main``) or, if no article is in sight,
    most of the page's text. What stands in an element that never holds it is no part of either.
    """
    size: dict[tuple[tuple[str, ...], tuple[tuple[int, int], ...]], int] = {}
    for path, text, _, marks in found:
        size[path, marks] = size.get((path, marks), 0) + len(text)
    clear = articles = total = 0
    inside: dict[tuple[int, int], list[int]] = {}
    for (path, marks), n in size.items():
        if any(_name(path[k]) in ASIDE - WRAPPERS for k, _ in marks):
            continue
        # an article named as a comment or a teaser is none
        held = [k for k, x in enumerate(path) if _name(x) in ("article", "main") and not AROUND.search(x.partition(".")[2].replace(".", " "))]
        total += n
        articles += n if held else 0
        clear += n if not marks and any(_name(path[k]) == "article" for k in held) else 0
        for m in marks:
            got = inside.setdefault(m, [0, 0])
            got[0] += n
            got[1] += n if held and held[-1] > m[0] else 0
    free = {m for m, (n, within) in inside.items() if 2 * within > articles or not clear and 2 * n > total}
    out = []
    for path, text, links, marks in found:
        lose = {k for k, at in marks if (k, at) in free}
        out.append((tuple(x[1:] if k in lose else x for k, x in enumerate(path)) if lose else path, text, links))
    return out


def path_ratios(found: list[tuple[tuple[str, ...], str, int]]) -> dict[tuple[str, ...], float]:
    """Text per block, fused with punctuation per block, of each path."""
    total: dict[tuple[str, ...], list[float]] = {}
    for path, text, links in found:
        t = total.setdefault(path, [0, 0, 0, 0])
        t[0] += len(text)
        t[1] += len(_MARKS.findall(text))
        t[2] += links
        t[3] += 1
    return {
        p: 0.0 if any(x.startswith("-") for x in p) else (chars / n) * (1 + np.sqrt(marks / n)) * (1 - links / chars) ** 2
        for p, (chars, marks, links, n) in total.items()
    }


def shared_part(a: tuple[str, ...], b: tuple[str, ...]) -> float:
    """How much of two paths is the same from the root on."""
    if a == b:
        return 1.0
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n / max(len(a), len(b), 1)


def content_paths(found: list[tuple[tuple[str, ...], str, int]], share: float = SHARE) -> set[tuple[str, ...]]:
    """The paths whose smoothed ratio reaches ``share`` of the page's mean."""
    ratio = path_ratios(found)
    smooth: dict[tuple[str, ...], list[float]] = {}
    kernel = [np.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(REACH + 1)]
    open_ = [i for i, (p, _, _) in enumerate(found) if ratio[p] > 0]
    for k, i in enumerate(open_):
        path = found[i][0]
        up = down = 0.0
        for j in open_[max(0, k - REACH) : k + REACH + 1]:
            near = found[j][0]
            w = kernel[min(abs(j - i), REACH)] * shared_part(path, near) ** 2
            up, down = up + w * ratio[near], down + w
        got = smooth.setdefault(path, [0.0, 0.0, 0.0])
        got[0] += up / down
        got[1] += 1
        got[2] += len(found[i][1])
    if not smooth:
        return set()
    chars = sum(c for _, _, c in smooth.values())
    mean = sum(s / n * c for s, n, c in smooth.values()) / chars
    taken = {p for p, (s, n, _) in smooth.items() if s / n >= share * mean}
    return taken | beside(found, taken, smooth.keys() - taken)


def _name(entry: str) -> str:
    return entry.lstrip("-").split(".")[0]


def container(path: tuple[str, ...]) -> tuple[str, ...]:
    """The element that a block stands in, past the parts of lists, tables and quotes."""
    end = len(path) - 1
    while end > 0 and _name(path[end - 1]) in PARTS:
        end -= 1
    return path[: max(end, 0)]


def beside(found: list[tuple[tuple[str, ...], str, int]], taken: set[tuple[str, ...]], rest: set[tuple[str, ...]]) -> set[tuple[str, ...]]:
    """Paths of ``rest``, not mostly link text, that lie in a container of ``taken`` paths.

    Containers are the articles around taken paths (``main`` where no article is), and
    the elements taken blocks stand in. Of ``body`` only its own blocks count.
    """
    if not rest:
        return set()
    size = dict.fromkeys(rest, 0)
    links = dict.fromkeys(rest, 0)
    for path, text, n in found:
        if path in size:
            size[path] += len(text)
            links[path] += n
    direct = {container(p) for p in taken}
    outer = {c for c in direct if c and _name(c[-1]) not in ("html", "body")}
    for p in taken:
        names = [_name(x) for x in p]
        for holder in ("article", "main"):
            if holder in names:
                outer.add(p[: names.index(holder) + 1])
                break
    lengths = sorted({len(c) for c in outer})
    return {p for p in rest if 2 * links[p] <= size[p] and (
        container(p) in direct or any(p[:n] in outer for n in lengths if n <= len(p)))}


def _held(path: tuple[str, ...]) -> bool:
    return any(not x.startswith("-") and _name(x) in ("article", "main") for x in path)


def main_text(html: str | None, share: float = SHARE) -> str:
    """The blocks on content paths, in page order, one a line."""
    found = released(list(blocks(html or "")))
    keep = content_paths(found, share)
    taken = [(path, text) for path, text, _ in found if path in keep]
    within = [k for k, (path, _) in enumerate(taken) if _held(path)]
    if within and 2 * sum(len(taken[k][1]) for k in within) >= sum(len(text) for _, text in taken):
        del taken[within[-1] + 1 :]
    return "\n".join(text for _, text in taken)


def extract_text(pages: DataFrame, html: str = "html", keep: list[str] | None = None, share: float = SHARE) -> tuple[DataFrame, str]:
    """Append a struct (text, n_chars) to each page; returns the frame and its name."""

    def judge(part: pa.RecordBatch) -> dict[str, object]:
        texts = [main_text(x, share) for x in part.column(part.schema.get_field_index(html)).to_pylist()]
        return {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}

    frame = pages.select(*dict.fromkeys([*(pages.columns if keep is None else keep), html]))
    return annotate(frame, html, "main", [StructField("text", StringType()), StructField("n_chars", LongType())], judge, keep=keep)
