"""Main text of web pages by tag-path ratios.

Every text on a page has a root-to-leaf path of block tags and links. For each path
the operator adds up text length and punctuation and divides by the number of texts
on it; the two ratios are smoothed along the page, fused with the path's share of
link text into one score, and paths that reach a share of the page's mean score are
content. An article or main element with nearly all content text is the main part, or
else the smallest element that holds all of it; the result is all its blocks, in an
article every one, elsewhere those on link-heavy paths only where they are content.

Parts that their tag, role, class or id names as menu, header, footer, sidebar,
notice, advert, form or reader comments are left out before paths are weighed, and
so are scripts, styles and what isn't shown. A class or id names noise if one of its
names consists of such words, with or without words that only say where or of what
kind; ``related-work`` isn't such a name, ``related-posts`` is. Some words, such as
``sidebar``, tell by themselves, but not in ``has-sidebar``. Where classes and ids
leave next to nothing of a page without an article, they are not believed; a form with
paragraphs or headings that holds most of the page's text is read like any other part.
Formulas are text of the line they stand in.

Defined results: a null or empty page, or one without content, gives an empty text; a
tag or comment that never ends takes the rest of the page; a reference that isn't
one stays as it is written; repeated rows are each reported; nothing is cut off.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import batch, map_batches

# HTML element names by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp "
    "rt ruby s samp small span strike strong sub sup time tt u var wbr br img "
    "math semantics mrow mi mn mo ms mtext mspace msup msub msubsup mfrac msqrt mroot mover "
    "munder munderover mstyle mpadded mfenced menclose mtable mtr mtd".split()
)
DROPPED = frozenset(
    "head script style noscript template title nav footer aside form button select option optgroup "
    "datalist textarea iframe object embed svg canvas audio video dialog menu map annotation annotation-xml".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset("article main".split())
# An open element of the first kind ends where one of the second kind begins.
CLOSES = {
    "p": frozenset(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
        "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "option": frozenset(["option", "optgroup"]),
}
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split()
)
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
    "banner cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup signin login sidebar sidenav rail widget widgets menu "
    "submenu nav navbar navigation topnav breadcrumb breadcrumbs pagination pager paginator footer "
    "foot header masthead topbar toolbar comment comments commentlist reply replies respond disqus "
    "discussion share sharing social related recommended recommendations trending skip skiplink "
    "copyright disclaimer search searchbox".split()
)
# Words that say where or of what kind a part is, not what it holds.
PLACE_NAMES = frozenset(
    "site page main global primary secondary top bottom left right inner outer user users reader "
    "readers post posts article articles entry story stories content section sections block box "
    "area region wrap wrapper container inline item items list links link button buttons bar panel "
    "group row col column js wp widget the my new desktop mobile fixed sticky form forms input "
    "message thread text title icon icons media image unit slot zone policy law body meta author date".split()
)
# Noise words that name nothing else, whatever stands beside them.
SURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored gdpr popup modal "
    "newsletter sidebar sidenav navbar submenu breadcrumb breadcrumbs pagination pager paginator "
    "footer masthead topbar toolbar topnav commentlist disqus signup signin login skiplink".split()
)
# Words that say of a part what is beside it.
BESIDE_NAMES = frozenset("has with no without".split())
COMMENT_NAMES = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
PUNCTUATION = re.compile(r"[.,;:!?…、。，；：！？·]")

_TAG = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTRIBUTE = re.compile(
    r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE
)
_NAMED = re.compile(r"class|id|role|hidden|style", re.IGNORECASE)
_PARTS = re.compile(r"[^a-z0-9]+")
_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}

SPREAD = (1.0, 2.0, 1.0)
SHARE = 0.3
# Share of the content an article or main element must hold to be the main part.
HOLDS = 0.85
# Names aren't believed where they leave less than this share of a page without article.
NAMED = 0.15


@dataclass
class Element:
    """Parents come before their children; equal paths have equal numbers; ``block`` is
    the nearest block element, this one included."""

    name: str
    parent: int
    block: int
    path: int
    noise: bool
    link: bool


@dataclass
class Text:
    """One block's text: its pieces, in which element, on which path."""

    element: int
    path: int
    pieces: list[str] = field(default_factory=list)
    linked: int = 0


def _names_noise(value: str, noise: frozenset[str], within_main: bool) -> bool:
    """Whether a class or id consists of noise words, beside such that say where."""
    for name in value.split():
        words = {w for w in _PARTS.split(name) if w and not any(c.isdigit() for c in w)}
        if within_main:  # an article's own header holds its title
            words.discard("header")
        if words & BESIDE_NAMES:
            continue
        found = words & noise
        if found & SURE_NAMES or (found and words <= NOISE_NAMES | PLACE_NAMES):
            return True
    return False


def _is_noise(name: str, attributes: str, within_main: bool, by_name: bool, forms: bool) -> bool:
    if forms and name == "form":
        return False
    if name in DROPPED or (name == "header" and not within_main):
        return True
    if not attributes or not _NAMED.search(attributes):
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "role" and value in NOISE_ROLES and name != "main":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if by_name and key in ("class", "id") and name not in ("html", "body"):
            if _names_noise(value, COMMENT_NAMES if name in MAIN else NOISE_NAMES, within_main):
                return True
    return False


def parse(
    html: str, by_name: bool = True, forms: bool = False
) -> tuple[list[Element], list[Text], int]:
    """Elements, the texts of blocks in page order, noise left out, and how many
    characters were left out in forms that hold paragraphs or headings.

    ``by_name`` says whether class and id tell noise, beside tag, role and style;
    ``forms``, whether forms are read too.
    """
    elements = [Element("", -1, 0, 0, False, False)]
    stack, texts = [0], []
    open_names: dict[str, int] = {}
    paths: dict[tuple[int, str], int] = {}
    mains = formed = 0
    telling = False
    at, n = 0, len(html)
    fresh = True

    def text(piece: str) -> None:
        nonlocal fresh, formed
        here = elements[stack[-1]]
        if here.noise and open_names.get("form"):
            formed += len(piece.strip())
        if here.noise or not piece:
            return
        block = here.block
        if fresh or texts[-1].element != block:
            if not piece.strip():
                if not fresh:
                    texts[-1].pieces.append(" ")
                return
            texts.append(Text(block, elements[block].path))
            fresh = False
        piece = unescape(piece) if "&" in piece else piece
        texts[-1].pieces.append(piece)
        if here.link:
            texts[-1].linked += len(piece.strip())

    def leave(depth: int) -> None:
        nonlocal fresh, mains
        while len(stack) > depth:
            gone = elements[stack.pop()]
            open_names[gone.name] -= 1
            mains -= gone.name in MAIN
            fresh = fresh or gone.name not in INLINE

    while at < n:
        tag = _TAG.search(html, at)
        if not tag:
            text(html[at:])
            break
        if tag.start() > at:
            text(html[at : tag.start()])
        at = tag.start()
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            at = n if end < 0 else end + 3
            continue
        if html[at + 1] in "!?":
            end = html.find(">", at)
            at = n if end < 0 else end + 1
            continue
        name_at = _NAME.match(html, at + 1)
        closing, name = name_at[1], name_at[2].lower()
        rest = _REST.match(html, name_at.end())
        end = rest.end() if rest else html.find(">", name_at.end()) + 1
        if not end:
            break
        attributes = html[name_at.end() : end - 1]
        at = end
        if closing:
            for depth in range(len(stack) - 1, 0, -1) if open_names.get(name) else ():
                if elements[stack[depth]].name == name:
                    leave(depth)
                    break
                if name in INLINE and elements[stack[depth]].name not in INLINE:
                    break
            fresh = fresh or name not in INLINE
            continue
        if name == "br":
            text(" ")
            continue
        if name in VOID:
            fresh = fresh or name not in INLINE
            continue
        if name not in INLINE:
            # Inline elements left open end with their block; so may p, li and the like.
            closable = any(open_names.get(k) for k, closers in CLOSES.items() if name in closers)
            for depth in range(len(stack) - 1, 0, -1) if closable else ():
                open_name = elements[stack[depth]].name
                if name in CLOSES.get(open_name, ()):
                    leave(depth)
                    break
                if open_name not in INLINE:
                    break
            fresh = True
        number, parent = len(elements), elements[stack[-1]]
        path = parent.path
        if name not in INLINE or name == "a":
            path = paths.setdefault((path, name), len(paths) + 1)
        elements.append(
            Element(
                name,
                stack[-1],
                parent.block if name in INLINE else number,
                path,
                parent.noise or _is_noise(name, attributes, mains > 0, by_name, forms),
                parent.link or name == "a",
            )
        )
        stack.append(number)
        open_names[name] = open_names.get(name, 0) + 1
        mains += name in MAIN
        telling = telling or bool(open_names.get("form") and (name in MAIN or name in HEADINGS or name == "p"))
        if name in RAW:
            close = _END[name].search(html, at)
            inside = html[at : close.start() if close else n]
            if name not in DROPPED:
                text(inside)
            at = close.start() if close else n
    return elements, texts, formed if telling else 0


def _smooth(values: list[float]) -> list[float]:
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for k, w in enumerate(SPREAD, -(len(SPREAD) // 2)):
            if 0 <= i + k < len(values):
                total, weight = total + w * values[i + k], weight + w
        out.append(total / weight)
    return out


def _path_scores(
    paths: list[int], blocks: list[str], linked: list[int]
) -> tuple[dict[int, float], dict[int, float]]:
    """Fused score and share of link text of each path."""
    sums: dict[int, list[float]] = {}
    for path, block, link in zip(paths, blocks, linked, strict=True):
        s = sums.setdefault(path, [0, 0, 0, 0])
        s[0] += 1
        s[1] += len(block)
        s[2] += len(PUNCTUATION.findall(block))
        s[3] += min(link, len(block))
    lengths = _smooth([sums[p][1] / sums[p][0] for p in paths])
    points = _smooth([sums[p][2] / sums[p][0] for p in paths])
    links = {p: s[3] / max(1, s[1]) for p, s in sums.items()}
    fused: dict[int, float] = dict.fromkeys(sums, 0.0)
    for path, length, point in zip(paths, lengths, points, strict=True):
        fused[path] += length * (1 + point) * (1 - links[path]) / sums[path][0]
    return fused, links


def _main_part(elements: list[Element], held: dict[int, int]) -> int:
    """An article or main element with nearly all content text, or the smallest element
    with all of it; ``held`` has it by block."""
    within = [held.get(i, 0) for i in range(len(elements))]
    for i in range(len(elements) - 1, 0, -1):
        within[elements[i].parent] += within[i]
    best: dict[int, int] = {}
    for i in range(1, len(elements)):
        rival = best.get(elements[i].parent)
        if rival is None or within[i] > within[rival]:
            best[elements[i].parent] = i
    here, whole = 0, 0
    while here in best and within[best[here]] >= HOLDS * within[0]:
        here = best[here]
        if elements[here].name in MAIN:
            return here
        if elements[here].name in (*HEADINGS, "p"):
            break
        if within[here] == within[0]:
            whole = here
    return whole


def _below(elements: list[Element], roots: set[int]) -> list[bool]:
    """Whether each element is one of the roots or lies in one."""
    below = [False] * len(elements)
    for i, element in enumerate(elements):
        below[i] = i in roots or (i > 0 and below[element.parent])
    return below


def _blocks(html: str, by_name: bool) -> tuple[list[Element], list[tuple[Text, str]]]:
    """The page's elements, and its texts with their words parted by single spaces."""

    def joined(texts: list[Text]) -> list[tuple[Text, str]]:
        blocks = [" ".join("".join(t.pieces).split()) for t in texts]
        return [(t, b) for t, b in zip(texts, blocks, strict=True) if b]

    elements, texts, formed = parse(html, by_name)
    kept = joined(texts)
    size = sum(len(b) for _, b in kept)
    if formed > size:
        every, texts, _ = parse(html, by_name, forms=True)
        more = joined(texts)
        if sum(len(b) for _, b in more) > 2 * size:
            return every, more
    return elements, kept


def extract(html: str | None) -> str:
    """The main text of one page, blocks in page order joined by line feeds."""
    elements, kept = _blocks(html or "", True)
    mains = _below(elements, {i for i, e in enumerate(elements) if e.name in MAIN})
    if not any(mains[t.element] for t, _ in kept):
        # A class such as "has-sidebar" may stand on what holds all the rest.
        every, more = _blocks(html or "", False)
        if sum(len(b) for _, b in kept) < NAMED * sum(len(b) for _, b in more):
            elements, kept = every, more
    if not kept:
        return ""
    paths = [t.path for t, _ in kept]
    scores, links = _path_scores(paths, [b for _, b in kept], [t.linked for t, _ in kept])
    size = sum(len(b) for _, b in kept)
    mean = sum(scores[t.path] * len(b) for t, b in kept) / size
    content = {p for p, s in scores.items() if s >= SHARE * mean}
    held: dict[int, int] = {}
    for t, b in kept:
        if t.path in content:
            held[t.element] = held.get(t.element, 0) + len(b)
    if not held:
        return ""
    part = _main_part(elements, held)
    # A heading right above the part, beside it in the page, belongs to it.
    parent = elements[part].parent
    if parent > 0 and elements[part].name not in MAIN and any(
        elements[t.element].name == "h1" and elements[t.element].parent == parent for t, _ in kept
    ):
        part = parent

    inside = _below(elements, {part})
    articles = _below(elements, {i for i, e in enumerate(elements) if e.name == "article"})
    return "\n".join(
        b
        for t, b in kept
        if inside[t.element]
        and (articles[t.element] or t.path in content or links[t.path] <= 0.5)
    )


OUT = "page_id long, url string, text string, n_chars long"


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; no shuffle."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            found = [extract(html) for html in part["html"].to_pylist()]
            yield batch(OUT, part["page_id"], part["url"], found, [len(t) for t in found])

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return map_batches(rows, step, OUT)
