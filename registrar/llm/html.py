"""Main text of web pages by composite text density.

A page is read into a tree (void elements, raw-text elements, implied end tags and
unclosed elements as browsers treat them). Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments are known by element
name, role, class or id and left out. An element known by its class or id only stays if
it holds the page's main, most of the text of its articles or, without articles
elsewhere, most of its text (reader comments: only a main or all articles). For every element left, the link-adjusted
density of characters per tag is computed; the children's densities are summed. The
least density on the path from the body to the element with the largest sum is the
threshold: from the body down, of every element that reaches it the subtree with the
largest sum is taken, and loose text that reaches it as an element would, and of the
headings those before them. An article or main element around a subtree is taken whole; where
the largest sum is inside one, only such elements are taken. All blocks taken are joined
in page order by an empty line.

White space is what ``str.split`` splits at. Defined results: null, empty and
text-free pages give an empty text; repeated rows give repeated results; an empty
table gives no rows; a page that breaks off keeps what came before; other columns
are ignored.
"""

from __future__ import annotations

import html as references
import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Element names of HTML by their kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset((
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul").split())
NOT_TEXT = frozenset((
    "script style noscript template head title nav footer aside button select option textarea input label "
    "iframe object svg canvas menu dialog noembed noframes xmp datalist").split())
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form toolbar".split())
KEEPERS = frozenset(("article", "main"))
#: Words in a class or id that mark what isn't the article; reader comments apart.
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|replies|respond)(?:$|[\s_\d-])")
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed|s)?|promo(?:tion|s)?|banner|"
    r"nav|navbar|navigation|menus?|breadcrumbs?|sidebar|side-bar|aside|footer|foot|masthead|topbar|"
    r"site-header|page-header|cookies?|consent|gdpr|notices?|popup|modal|"
    r"overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|recommended|"
    r"widgets?|toolbar|search|pagination|pager|skip-link|copyright|legal|disclaimer)(?:$|[\s_\d-])")
#: Names that say what an element has or how it is, not what it is.
MODIFIER = re.compile(r"(?:has|have|no|not|with|without)[_-]|.*[_-](?:open|opened|closed|enabled|disabled|on|off)$")
#: The same, but for parts of an article.
PAGE_HEADER = re.compile(r"(?:^|[\s_-])header(?:$|[\s_\d-])")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the key closes an open element of the value, if nothing between bounds it.
_CLOSES_P = BLOCKS - {"body", "html", "caption", "dd", "dt", "legend", "li", "summary", "tbody", "td", "tfoot", "th", "thead", "tr"}
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead", "tr", "td", "th"),
          "tfoot": ("tbody", "thead", "tr", "td", "th"), "thead": ("tr", "td", "th")}
BOUNDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",)} | dict.fromkeys(
    ("tr", "td", "th", "tbody", "tfoot", "thead"), ("table",))

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_LABELS = frozenset(("class", "id", "role", "hidden"))


class Node:
    __slots__ = ("tag", "dropped", "parent", "parts", "chars", "tags", "link_chars", "link_tags", "density", "total",
                 "head_chars", "inline", "peak", "suspect", "within")

    def __init__(self, tag: str, parent: "Node | None", dropped: bool):
        self.tag, self.parent, self.dropped, self.parts = tag, parent, dropped, []
        self.chars = self.tags = self.link_chars = self.link_tags = self.head_chars = 0
        self.density = self.total = 0.0
        self.inline, self.peak = tag not in BLOCKS, self
        self.suspect = ""  # known by its class or id: "comments" or "other"
        self.within = tag in KEEPERS or parent is not None and parent.within


def labels(attributes: str) -> dict[str, str]:
    """class, id, role and hidden of a start tag in lower case; the first of a name counts."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if (name := name.lower()) in _LABELS:
            out.setdefault(name, (a or b or c).lower())
    return out


def _judge(x: Node, attributes: str) -> None:
    """Whether a new element is left out, or to be judged when the page is read."""
    tag, inside = x.tag, x.parent
    x.dropped = inside.dropped or tag in NOT_TEXT
    if x.dropped or tag in ("html", "body") or tag in KEEPERS or tag in HEADINGS:
        return
    if tag == "header" and not inside.within:  # an article's own heading part stays
        x.dropped = True
        return
    found = labels(attributes) if attributes else {}
    if "hidden" in found or found.get("role") in ROLES:
        x.dropped = True
        return
    names = " ".join(n for k in ("class", "id") for n in found.get(k, "").split() if not MODIFIER.match(n))
    if COMMENTS.search(names):
        x.suspect = "comments"
    elif tag == "form":  # some pages are one form; its controls are left out anyhow
        x.suspect = "other"
    elif BOILERPLATE.search(names) or not inside.within and PAGE_HEADER.search(names):
        x.suspect = "other"


def _settle(root: Node) -> None:
    """Leave out the elements known by class or id that don't hold the page's text."""
    nodes = _nodes(root)
    if not any(x.suspect for x in nodes):
        return
    chars, kept, mains = {}, {}, {}  # of all text, of text in articles and mains, mains with text
    for x in reversed(nodes):
        n = k = m = 0
        for p in x.parts:
            if isinstance(p, str):
                n += len("".join(p.split()))
            elif not p.dropped:
                n, k, m = n + chars[p], k + kept[p], m + mains[p]
        chars[x], kept[x], mains[x] = n, n if x.tag in KEEPERS else k, m + (x.tag == "main" and n > 0)
    for x in nodes:
        if x.suspect:
            keeps = 0 if x.parent.within else kept[x]
            if x.suspect == "comments":
                stays = mains[x] or keeps and keeps == kept[root]
            else:
                elsewhere = 0 if x.parent.within else kept[root] - kept[x]
                stays = mains[x] or 2 * keeps > kept[root] or 2 * chars[x] > chars[root] and not elsewhere
            x.dropped = not stays


def parse(page: str) -> Node:
    """The tree of a page; ``parts`` of a node are its texts and child nodes in order."""
    root = Node("html", None, False)
    way, depths = [root], {"html": [0]}  # the open elements, and for each name where they stand among them
    at, n = 0, len(page)

    def close(depth: int) -> None:
        while len(way) > depth:
            depths[way.pop().tag].pop()

    while at < n:
        found = _TOKEN.search(page, at)
        if found is None:
            way[-1].parts.append(page[at:])
            break
        if found.start() > at:
            way[-1].parts.append(page[at:found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:  # an end tag closes the nearest such element; others are ignored
            if depths.get(tag) and depths[tag][-1] > 0:
                close(depths[tag][-1])
            continue
        if tag in ("html", "body") and len(way) == 1:
            if tag == "body":
                root.parts.append(child := Node(tag, root, False))
                depths.setdefault(tag, []).append(len(way))
                way.append(child)
            continue
        closing = ("p",) if tag in _CLOSES_P else CLOSES.get(tag, ())
        if any(depths.get(c) for c in closing):
            bounds = BOUNDS.get(tag, ("table", "td", "th", "button", "body"))
            least = max((depths[x][-1] for x in bounds if depths.get(x)), default=-1)
            inside = [d[i] for d in (depths.get(c, []) for c in closing) if (i := bisect_right(d, least)) < len(d)]
            if inside and min(inside) > 0:  # the outermost within the bound
                close(min(inside))
        node = way[-1]
        child = Node(tag, node, False)
        _judge(child, found[3] or "")
        node.parts.append(child)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            stop = page.find(">", end.start()) if end else -1
            at = stop + 1 if stop >= 0 else n
        elif tag not in VOID and not (found[3] or "").endswith("/"):
            depths.setdefault(tag, []).append(len(way))
            way.append(child)
    _settle(root)
    return root


def _nodes(root: Node) -> list[Node]:
    """Kept nodes, each before its children."""
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        out.append(x)
        todo.extend(p for p in reversed(x.parts) if isinstance(p, Node) and not p.dropped)
    return out


def measure(root: Node) -> list[Node]:
    """Fill in the densities; gives the kept nodes, each before its children."""
    nodes = _nodes(root)
    for x in reversed(nodes):
        for p in x.parts:
            if isinstance(p, str):
                x.chars += len("".join(p.split()))
            elif not p.dropped:
                x.chars += p.chars
                x.tags += p.tags + 1
                x.link_chars += p.link_chars
                x.link_tags += p.link_tags + (p.tag == "a")
                x.head_chars += p.head_chars
                x.inline = x.inline and p.inline
        if x.tag == "a":
            x.link_chars = x.chars
        if x.tag in HEADINGS:
            x.head_chars = x.chars
    for x in nodes:
        x.density = _density(x, root)
    for x in nodes:
        x.total = sum(p.density for p in x.parts if isinstance(p, Node) and not p.dropped)
    for x in reversed(nodes):  # the first of the largest sums in the subtree
        for p in reversed(x.parts):
            if isinstance(p, Node) and not p.dropped and p.chars and (
                    p.peak.total > x.peak.total or x.peak is not x and p.peak.total == x.peak.total):
                x.peak = p.peak
    return nodes


def _density(x: Node, root: Node) -> float:
    if not x.chars:
        return 0.0
    c, t, lc, lt = x.chars, max(x.tags, 1), max(x.link_chars, 1), max(x.link_tags, 1)
    base = math.log(c / max(c - x.link_chars, 1) * x.link_chars + root.link_chars / max(root.chars, 1) * c + math.e)
    return c / t * math.log(max(c / lc * t / lt, 1.0)) / (math.log(base) if base > 1 else 1.0)


def _runs(x: Node) -> list[Node]:
    """The kept parts with text; text and inline elements in a row are one part."""
    out, run = [], None
    for p in x.parts:
        if isinstance(p, Node) and not p.dropped and not p.inline:
            out.append(p)
            run = None
        else:
            if run is None:
                out.append(run := Node("", x, False))
            run.parts.append(p)
            if isinstance(p, str):
                run.chars += len("".join(p.split()))
            elif not p.dropped:
                run.chars, run.tags = run.chars + p.chars, run.tags + p.tags + 1
                run.link_chars, run.link_tags = run.link_chars + p.link_chars, run.link_tags + p.link_tags + (p.tag == "a")
    return [p for p in out if p.chars]


def _outermost_keeper(x: Node) -> Node | None:
    keeper, up = None, x
    while up is not None:
        keeper, up = (up if up.tag in KEEPERS else keeper), up.parent
    return keeper


def main_nodes(root: Node) -> list[Node]:
    """The subtrees that are the page's text, in page order."""
    nodes = [x for x in measure(root) if x.chars]
    if not nodes:
        return []
    best = root.peak
    if best.total == 0:  # no element holds another with text
        best = root
    in_keeper = _outermost_keeper(best) is not None
    bodied = any(isinstance(p, Node) and p.tag == "body" and p.chars for p in root.parts)
    least, up = best.density, best
    while up is not None and not (bodied and up is root):  # the path from the body
        least, up = min(least, up.density), up.parent

    taken: set[Node] = set()
    runs: dict[Node, list[Node]] = {}

    def take(x: Node) -> None:
        while x.inline and x.parent is not None:
            x = x.parent
        if (keeper := _outermost_keeper(x)) is not None:
            taken.add(keeper)
            return
        inner = [y for y in _topmost(x) if y.chars]
        if 2 * sum(y.chars for y in inner) > x.chars:
            taken.update(y for y in inner if y.density >= least or y.total == max(z.total for z in inner))
        elif not in_keeper:
            taken.add(x)

    chosen: set[Node] = set()
    todo = [root]
    while todo:  # from the body down
        x = todo.pop()
        if x.peak not in chosen:
            chosen.add(x.peak)
            take(x.peak)
        if x in chosen or x in taken:
            continue
        runs[x] = _runs(x)
        for p in runs[x]:
            if p.tag and p.density >= least and p.head_chars < p.chars:
                todo.append(p)
            elif not p.tag and not in_keeper and _density(p, root) >= least:
                taken.add(p)

    # the headings that stand before something taken, however short
    holds: set[Node] = set()
    for x in taken:
        while (x := x.parent) is not None and x not in holds:
            holds.add(x)
    for x, parts in runs.items():
        before, past_heading = False, False
        for p in reversed(parts):
            if p in taken or p in holds:
                before, past_heading = True, False
            elif p.tag and p.head_chars == p.chars:
                past_heading = True
                if before and not in_keeper:
                    taken.add(p)
            elif past_heading or 2 * p.link_chars > p.chars:
                before = False

    out, todo = [], [root]
    while todo:
        x = todo.pop()
        if x in taken:
            out.append(x)
        elif x in runs:
            todo.extend(reversed(runs[x]))
        else:
            todo.extend(p for p in reversed(x.parts) if isinstance(p, Node) and not p.dropped)
    return out


def _topmost(x: Node) -> list[Node]:
    """The outermost articles and mains inside a subtree."""
    out, todo = [], [x]
    while todo:
        y = todo.pop()
        if y.tag in KEEPERS:
            out.append(y)
        else:
            todo.extend(p for p in reversed(y.parts) if isinstance(p, Node) and not p.dropped)
    return out


def blocks(node: Node) -> list[str]:
    """Texts of the blocks of a subtree in page order."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        # references are decoded in the joined text of a block, then its white space
        text = " ".join(references.unescape("".join(line)).split())
        if text:
            out.append(text)
        line.clear()

    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            line.append(x)
        elif x.tag == "br":
            line.append("\n")
        elif not x.dropped or x is node:
            if x.tag in BLOCKS:
                flush()
                todo.append(None)
            todo.extend(reversed(x.parts))
    flush()
    return out


def extract_text(page: str | None) -> str:
    if not page:
        return ""
    return "\n\n".join(b for x in main_nodes(parse(page)) for b in blocks(x))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            text = [extract_text(h) for h in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"].astype(object),
                                "text": pd.Series(text, dtype=object, index=pdf.index),
                                "n_chars": pd.Series([len(t) for t in text], dtype="int64", index=pdf.index)})

    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, url string, text string, n_chars long")
