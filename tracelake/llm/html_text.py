"""HTML extraction by tree scoring: paragraphs give points to their ancestors, the best container and siblings stay.

Tags, roles and hidden or style attributes that say so remove a block outright. A class or id does so if a whole token of
it names boilerplate; how much text a block holds does not matter. Two things are wrappers instead, if the page is built
so: a form around an ``article``, ``main`` or a head line (``h1``) with a paragraph, and, on a page without an ``article``
or ``main`` and without a head line elsewhere, a named block around the head line and a paragraph. Readers' comments,
adverts, cookie and sign-up notices, copyright lines and footers are never wrappers.

If nothing is left of a page, a second look also takes asides, headers, dialogs, forms and blocks of other names, but still
none of those that are never wrappers.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import as_bytes, byte_slices, ship

#: Raw text up to the end tag, or to the end of the page.
_RAW = "script|style|textarea|title|iframe"
#: Markup that is left out with its end tag; without one, up to the next block or the end of the block around it.
_SKIP = "noscript|template|svg|canvas|object|math|audio|video|select"
_TOKEN = re.compile(
    rf"<(?P<raw>{_RAW}|{_SKIP})(?=[\s/>])[^>]*+>|<!--|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^<>\"']++|\"[^\">]*+\"|'[^'>]*+'|[\"'])*+)>|<[!?][^>]*+>",
    re.I,
)
_SKIP_TAG = {t: re.compile(rf"<(/?){t}(?=[\s/>])[^>]*+>", re.I) for t in _SKIP.split("|")}
_FOREIGN = frozenset(["svg", "math"])
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in _RAW.split("|")}
_ATTR = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)

#: Elements that start a block of their own; all others are part of the text around them.
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that an opening tag closes if they are open below the nearest of the listed bounds.
_CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset()),
}
_DROP = frozenset("head nav footer aside button dialog menu fieldset option".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: What also the second look leaves out.
_DROP_SOFT = frozenset("head nav footer button menu option".split())
_ROLES_SOFT = frozenset("navigation contentinfo search alert alertdialog menu menubar toolbar".split())
#: Words of class and id names of boilerplate. A token names boilerplate if it has one of them and else only _FILLER.
_BOILER = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored sponsors promo promos promotion sidebar sidebars sidenav "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs crumbs masthead topbar footer foot footnav copyright cookie cookies consent gdpr "
    "notice notices notification notifications alert alerts popup modal overlay lightbox newsletter subscribe subscription signup signin login register "
    "comment comments commentlist disqus discussion replies reply respond feedback share sharing social related recommended recommendations "
    "widget widgets pagination pager toolbar disclaimer hidden search skip skiplink byline-share tagcloud outbrain taboola rail".split()
)
_HEADERS = frozenset(["header", "head", "hdr", "topheader", "pageheader"])
_FILLER = frozenset(
    "area areas bar bars block blocks body bottom box boxes btn button buttons center col column container content ctn desktop float global google "
    "group holder horizontal icons inner item items left link links list lists main mobile module outer page panel panels placeholder policy "
    "primary region right row secondary section site slot slots small sticky tertiary top unit units vertical visually wrap wrapper zone".split()
)
#: Filler of boilerplate names, but not of headers: a post's header is part of it.
_STORY = frozenset("article articles entry news post posts stories story".split())
#: Boilerplate words that also are titles of sections of an article.
_TOPICS = frozenset(
    "ad alert alerts copyright disclaimer discussion feedback foot hidden menu menus navigation newsletter notice notices notification notifications "
    "overlay promotion recommended recommendations register related replies reply search share sharing social sponsors subscription widget widgets".split()
)
#: Boilerplate words whose blocks never are wrappers of an article: readers' words, adverts, consent and sign-up, page feet.
_NEVER = frozenset(
    "comment comments commentlist disqus discussion replies reply respond feedback "
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promos promotion outbrain taboola "
    "cookie cookies consent gdpr newsletter subscribe subscription signup signin login register copyright footer foot footnav disclaimer".split()
)
#: Kinds of blocks that are decided on when the page is known: of another name, never to be kept, a form.
NAMED, NEVER, FORM = 1, 2, 3
_SAFE = frozenset(["html", "body", "article", "main"])
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_BASE = {"article": 25.0, "main": 15.0, "div": 5.0, "section": 5.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "address": -3.0}
_CONTAINER = frozenset("article main div section body td center html blockquote figure details".split())


#: Levels of ancestors that a text gives points to; the weight of the last one is a thousandth.
DEPTH = 400


@dataclass
class Node:
    tag: str
    parent: int
    drop: bool
    named: int = 0  #: NAMED, NEVER or FORM; see _named()
    runs: list = field(default_factory=list)
    kids: int = 0
    score: float = 0.0
    chars: int = 0
    links: int = 0


def _attributes(attrs: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(attrs):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def _removed(tag: str, attrs: dict[str, str], in_article: bool, soft: bool) -> bool:
    """Does the element's tag, role, style or hidden attribute say that it is no part of an article?"""
    if tag in (_DROP_SOFT if soft else _DROP) or tag == "header" and not in_article and not soft:
        return True
    if tag in _SAFE:
        return False
    return (
        "hidden" in attrs
        or attrs.get("aria-hidden", "").strip().lower() == "true"
        or _HIDING.search(attrs.get("style", "")) is not None
        or attrs.get("role", "").strip().lower() in (_ROLES_SOFT if soft else _ROLES)
    )


def _named(tag: str, attrs: dict[str, str], in_article: bool) -> int:
    """NEVER, NAMED or 0 by the class and id of a block: do they name boilerplate, and which?

    Headings are never named, and sections not by an id inside an article, nor elsewhere by an id that can be a title.
    """
    if tag in _HEADING or tag in _SAFE and not (tag == "article" and in_article):
        return 0
    classes = attrs.get("class", "").split()
    section = tag == "section" or "section" in classes
    out = 0
    for at, token in enumerate([*classes, *attrs.get("id", "").split()]):
        words = _WORD.findall(_CAMEL.sub(" ", token).lower())
        signs = [w for w in words if w in _BOILER]
        heads = [] if signs or in_article else [w for w in words if w in _HEADERS]
        if not signs and not heads or words[0] == "content":
            continue
        if any(len(w) > 1 and w not in _BOILER and w not in _FILLER and (heads or w not in _STORY) and w not in heads for w in words):
            continue
        if section and at >= len(classes) and (in_article or not heads and _TOPICS.issuperset(signs)):
            continue
        if token == "hidden" and any(":" in c for c in classes):  # shown at some widths
            continue
        out = max(out, NAMED if _NEVER.isdisjoint(signs) else NEVER)
    return out


@dataclass
class Page:
    nodes: list[Node]
    runs: list[tuple[int, str, int]]  #: (node, text, characters inside links), in page order


def _ends(page: str, tag: str) -> dict[int, int]:
    """Where each element of this name that has an end tag of its own ends, by the end of its opening tag."""
    out, begun = {}, []
    for m in _SKIP_TAG[tag].finditer(page):
        if not m[1]:
            if tag not in _FOREIGN or not m[0].endswith("/>"):
                begun.append(m.end())
        elif begun:
            out[begun.pop()] = m.end()
    return out


def parse(page: str, soft: bool = False) -> Page:
    """Blocks of a page. Raw elements, comments and markup vanish; white space in a block becomes one space.

    ``soft`` is the second look at a page of which nothing was left.
    """
    nodes = [Node("html", -1, False)]
    runs: list[tuple[int, str, int]] = []
    stack = [0]
    opened = {"html": 1}  # open blocks by tag
    articles = 0
    pieces: list[str] = []
    link_at = -1  # stack depth at which the open link began
    linked = 0
    ends: dict[str, dict[int, int]] = {}
    muted = False  # inside an element of _SKIP without an end tag

    def flush() -> None:
        nonlocal linked, muted
        muted = False
        if pieces:
            at = stack[-1]
            if not nodes[at].drop:
                text = " ".join(html.unescape("".join(pieces)).split())
                if text:
                    nodes[at].runs.append(len(runs))
                    runs.append((at, text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal link_at, articles
        while len(stack) > depth:
            tag = nodes[stack.pop()].tag
            opened[tag] -= 1
            if tag in ("article", "main"):
                articles -= 1
        if link_at > len(stack):
            link_at = -1

    pos, n = 0, len(page)
    last = page.rfind(">") + 1
    search = _TOKEN.search
    while pos < n:
        m = search(page, pos, last)
        at = m.start() if m else n
        if at > pos and not muted:
            pieces.append(page[pos:at])
            if link_at >= 0:
                linked += at - pos
        if m is None:
            break
        pos = m.end()
        if m["raw"]:
            name = m["raw"].lower()
            if name in _SKIP_TAG:
                if name not in ends:
                    ends[name] = _ends(page, name)
                if pos in ends[name]:
                    pos = ends[name][pos]
                elif name not in _FOREIGN or not m[0].endswith("/>"):
                    muted = True
                continue
            stop = _RAW_END[name].search(page, pos)
            pos = stop.end() if stop else n
            continue
        if m["tag"] is None:
            if m[0] == "<!--":
                stop = page.find("-->", pos)
                pos = stop + 3 if stop >= 0 else n
            continue
        tag = m["tag"].lower()
        if tag == "a":
            link_at = -1 if m["end"] else len(stack)
            continue
        if tag in ("br", "hr", "img", "wbr"):
            pieces.append(" ")
            continue
        if tag not in _BLOCK:
            continue
        flush()
        if m["end"]:
            if not opened.get(tag):
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == tag:
                    close(depth)
                    break
            continue
        if tag in ("html", "body") and opened.get(tag, 0) > (tag == "html"):
            continue
        shut, bound = _CLOSES.get(tag, (frozenset(), frozenset()))
        if not any(opened.get(t) for t in shut):
            shut = frozenset()
        for depth in range(len(stack) - 1, 0, -1):
            open_tag = nodes[stack[depth]].tag
            if open_tag in ("p", "option") or open_tag in shut or open_tag in _HEADING and tag in _HEADING:
                close(depth)
                if open_tag in shut:
                    break
            elif open_tag in bound or not shut:
                break
        parent = stack[-1]
        drop, named = nodes[parent].drop, 0
        if not drop:
            attrs = _attributes(m["attrs"])
            drop = _removed(tag, attrs, articles > 0, soft)
            named = 0 if drop else _named(tag, attrs, articles > 0)
            if tag == "form":
                named = max(named, FORM) if named != NEVER else NEVER
            if soft and named != NEVER:
                named = 0
        nodes.append(Node(tag, parent, drop, named))
        nodes[parent].kids += 1
        stack.append(len(nodes) - 1)
        opened[tag] = opened.get(tag, 0) + 1
        if tag in ("article", "main"):
            articles += 1
    flush()
    return _without_named(Page(nodes, runs))


def _signs(page: Page) -> tuple[dict[int, list], dict[int, int]]:
    """What each undecided block holds outside such blocks in it (-1: what lies in none), and the undecided block around it.

    The greatest number of an ``article`` or ``main`` around a text (it lies in the block if it is greater than the
    block's), whether there is an ``h1``, and whether there is text of a block that is neither a heading nor a link.
    """
    nodes = page.nodes
    inner, story = [-1] * len(nodes), [-1] * len(nodes)
    out: dict[int, list] = {-1: [-1, False, False]}
    above = {}
    for i, x in enumerate(nodes):
        around = inner[x.parent] if x.parent >= 0 else -1
        inner[i] = i if x.named else around
        story[i] = i if x.tag in ("article", "main") else story[x.parent] if x.parent >= 0 else -1
        if x.named:
            out[i], above[i] = [-1, False, False], around
    for at, text, linked in page.runs:
        signs, tag = out[inner[at]], nodes[at].tag
        signs[0] = max(signs[0], story[at])
        signs[1] |= tag == "h1"
        signs[2] |= tag not in _HEADING and linked < len(text)
    return out, above


def _without_named(page: Page) -> Page:
    """Decide on forms and named blocks (see the module's docstring), from the inside out, and drop those that go."""
    nodes = page.nodes
    for kind in (FORM, NAMED):
        signs, above = _signs(page)
        for i in sorted((i for i in above if nodes[i].named == kind), reverse=True):
            story, head, text = signs[i]
            if story > i or head and text if kind == FORM else head and text and signs[-1][0] < 0 and not signs[-1][1]:
                nodes[i].named = 0  # a wrapper: what it holds lies in the block around it
                to = signs[above[i]]
                to[0], to[1], to[2] = max(to[0], story), to[1] or head, to[2] or text
    for x in nodes:
        x.drop = x.drop or x.named > 0 or x.parent >= 0 and nodes[x.parent].drop
    return Page(nodes, [r for r in page.runs if not nodes[r[0]].drop])


def score(page: Page) -> None:
    """Points of every node: a text of a block counts for length and commas, in full for the parent of the block, by half
    for the next ancestor and by a third of the level beyond; then every node is discounted by its link density."""
    nodes = page.nodes
    for at, text, linked in page.runs:
        size = len(text)
        nodes[at].chars += size
        nodes[at].links += linked
        points = (size >= 25) + min(size / 100, 3.0) + min(text.count(",") + text.count("，"), size / 20)
        points *= 1 - linked / size
        to = at if nodes[at].tag in _CONTAINER else nodes[at].parent
        level = 0
        while to >= 0 and level < DEPTH:
            nodes[to].score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            to = nodes[to].parent
            level += 1
    for node in reversed(nodes):  # a block comes after those around it
        if node.parent >= 0:
            nodes[node.parent].chars += node.chars
            nodes[node.parent].links += node.links
    for node in nodes:
        if node.chars:
            node.score = (node.score + _BASE.get(node.tag, 0.0)) * (1 - node.links / node.chars)


def main_text(page: str, soft: bool = False) -> str:
    """The article of a page: its blocks in page order, joined by two line feeds; empty if there is none."""
    tree = parse(page, soft)
    if not tree.runs:
        return "" if soft or not page.strip() else main_text(page, True)
    score(tree)
    nodes = tree.nodes
    best = max((i for i, x in enumerate(nodes) if x.tag in _CONTAINER and x.chars and not x.drop), key=lambda i: (nodes[i].score, -i))
    up = best
    while up >= 0:
        if nodes[up].tag == "article":
            best = up
            break
        up = nodes[up].parent
    keep = {best}
    parent, top = nodes[best].parent, nodes[best].score
    least = max(10.0, 0.2 * top)
    for i, x in enumerate(nodes):
        if parent < 0 or x.parent != parent or i == best or x.drop or not x.chars:
            continue
        density = x.links / x.chars
        if x.tag in ("h1", "h2") and i < best and density < 0.5:
            keep.add(i)
        elif x.tag in _CONTAINER and x.score >= least and density < 0.3:
            keep.add(i)
        elif x.tag == "p" and (x.chars > 80 and density < 0.25 or x.links == 0 and x.chars > 20 and nodes[best].tag != "article"):
            keep.add(i)
    linked = _link_boxes(tree)
    inside = [False] * len(nodes)
    for i, x in enumerate(nodes):
        inside[i] = i in keep or x.parent >= 0 and inside[x.parent] and i not in linked
    return "\n\n".join(text for at, text, _ in tree.runs if inside[at])


def _link_boxes(page: Page) -> set[int]:
    """Lists and boxes of nothing but links that stand under no heading: they lead elsewhere.

    A list or box stays if any of its text is no link, if it holds a heading, or if the text in front of it is one (a list
    of references, say); a table and a box with a single link always stay.
    """
    nodes = page.nodes
    count, mixed, headed = [0] * len(nodes), [False] * len(nodes), [False] * len(nodes)
    after_heading = set()  # blocks whose first text follows a heading
    seen = [False] * len(nodes)
    before = False
    for at, text, linked in page.runs:
        heading = nodes[at].tag in _HEADING
        up = at
        count[at] += 1
        mixed[at] |= linked < len(text)
        headed[at] |= heading
        while up >= 0 and not seen[up]:
            seen[up] = True
            if before:
                after_heading.add(up)
            up = nodes[up].parent
        before = heading
    for i in range(len(nodes) - 1, 0, -1):
        up = nodes[i].parent
        count[up] += count[i]
        mixed[up] |= mixed[i]
        headed[up] |= headed[i]
    boxes = ("ul", "ol", "div", "section", "dl")
    return {i for i, x in enumerate(nodes) if x.tag in boxes and count[i] > 1 and not mixed[i] and not headed[i] and i not in after_heading}


def extractor():
    """Arrow UDF: UTF-8 bytes of a page -> its main text."""

    @F.arrow_udf("string")
    def run(page: pa.Array) -> pa.Array:
        out = []
        for part in byte_slices(page):
            for b in part.to_pylist():
                out.append(main_text(b.decode("utf-8", "replace")).encode("utf-8", "replace").decode("utf-8"))
        return pa.array(out, pa.string())

    return run.asNondeterministic()


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row; a null or empty page gives an empty text. Other columns are not read.

    Rows are independent: no shuffle, one page in memory at a time.
    """
    ship(pages.sparkSession)
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), extractor()(as_bytes(html_col)).alias("text"))
    return src.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
