"""The main text of web pages, by a minimum cut over the blocks of a page.

A block is a run of text between block-level tags. What a classifier thinks of a block
gives the capacities to the two terminals, content and boilerplate; blocks that are
neighbours on the page or in the document tree are joined by smoothness edges. The
minimum cut labels all blocks of a page at once. Pages are independent of one another.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, deque

from pyspark.sql import DataFrame

from .shared import arrow_batch

# The elements of HTML by their part in a page.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style title textarea noscript template iframe svg select button object audio video canvas head annotation annotation-xml".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var nobr "
    "math semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover "
    "munderover mmultiscripts mtable mtr mtd".split()
)
_CLOSED_BY_BLOCK = set("p".split())
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_PLACES = {"ul", "ol", "dl", "table", "div", "section", "article", "body", "main", "td"}
_BOILER_TAGS = set("nav footer aside form menu dialog fieldset".split())
_FIELD_TAGS = set("form fieldset".split())  # labels of fields, but a form may hold a whole page
_CONTENT_TAGS = set("article main".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|style|aria-hidden|itemprop|aria-label)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_HREF = re.compile(r"(?:^|\s)href\s*=", re.I)
# Words of class, id and role, after splitting at case changes, hyphens and underscores: those that tell in any name, ...
_BOILER_WORDS = set(
    "nav navbar navigation navi menu menubar breadcrumb breadcrumbs header masthead banner topbar toolbar footer bottombar colophon "
    "sidebar aside complementary ad ads adv advert adverts advertisement advertising advertorial sponsored promo "
    "promotion promoted cookie cookies consent gdpr popup modal overlay sharing comment "
    "comments commentlist reply replies respond disqus related recommended recommendations trending "
    "thread threads newsletter subscribe subscription signup login contentinfo copyright disclaimer pagination pager "
    "tagcloud byline skip contactform paywall".split()
)
# ... those that tell only if the whole name is of such words, ...
_WEAK_WORDS = set(
    "foot side rail sponsor notice notices alert dialog share social follow discussion popular more widget register search form contact "
    "legal tags hidden feedback rating ratings reviews".split()
)
# ... and those of lists whose items may be articles.
_LIST_WORDS = set("comment comments commentlist thread threads reply replies respond disqus related recommended recommendations trending".split())
_HEADER_WORDS = set("header masthead banner byline".split())
_WITHOUT = set("has no not non with without".split())  # what follows in a name is of another element
_CONTENT_WORDS = set("article content main post entry story body text articlebody maincontent postcontent entrycontent".split())
# Terms of the capacities, of the order of a block's edges, so that its length, links and neighbours can outvote them.
_HIDDEN = 20.0  # not shown at all: the one thing that decides alone
_PLACE = 4.0  # below nav, footer and the like
_WORD = 4.0  # below a name with a boilerplate word, for a short block or one of links
_WEAK = 1.5  # the same for a name of weak words
_INSIDE = 2.0  # inside the main element, if all the page's text is there
_OUTSIDE = 1.5  # outside of it, likewise
_SMOOTH = 1.0  # of an edge between blocks of one parent


def _words(value: str) -> list[str]:
    """Of one name; without what follows has-, no- or with-."""
    out = re.sub(r"([a-z])([A-Z])", r"\1 \2", value).replace("-", " ").replace("_", " ").lower().split()
    return out[: next((i for i, w in enumerate(out) if w in _WITHOUT), len(out))]


class _Node:
    """An element, with what tags and names from here up say of it."""

    __slots__ = ("tag", "parent", "depth", "hidden", "main", "placed", "named", "listed", "weak", "fields", "in_header")

    def __init__(self, tag: str, parent: _Node | None, attributes: str):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.hidden, self.main, self.placed, self.named, self.listed, self.weak, self.fields = (
            (parent.hidden, parent.main, parent.placed, parent.named, parent.listed, parent.weak, parent.fields) if parent else (False,) * 7
        )
        self.in_header = tag == "header" or (parent is not None and parent.in_header)
        names: list[list[str]] = []
        if attributes:
            for m in _ATTR.finditer(attributes):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                    self.hidden = True
                elif name == "style":
                    self.hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
                else:
                    names += map(_words, [value] if name == "aria-label" else value.split())
        found = {w for name in names for w in name}
        if tag in _CONTENT_TAGS:
            # Names above or of the main element say nothing of it, but for lists of other articles.
            self.named, self.weak, self.fields = self.listed, False, False
        elif tag not in ("body", "html") and tag not in _HEADINGS:
            self.placed |= tag in _BOILER_TAGS - _FIELD_TAGS or (tag == "header" and not self.main)
            words = found & (_BOILER_WORDS - _HEADER_WORDS if self.main else _BOILER_WORDS)
            self.named |= bool(words)
            self.listed |= bool(words & _LIST_WORDS)
            both = _WEAK_WORDS | _BOILER_WORDS
            self.weak |= not self.main and any(name and both.issuperset(name) for name in names)
            self.fields |= tag in _FIELD_TAGS
        if tag in _CONTENT_TAGS or (not self.main and found & _CONTENT_WORDS and tag in ("div", "section", "td")):
            self.main = True

    @property
    def suspect(self) -> bool:
        return self.hidden or self.placed or self.named or self.weak


class _Block:
    __slots__ = ("node", "text", "linked")

    def __init__(self, node: _Node, text: str, linked: int):
        self.node, self.text, self.linked = node, text, linked


def blocks(page: str) -> list[_Block]:
    """The blocks of a page in order, with the element that holds each.

    A link lasts until it is closed, over blocks inside it as well, but not beyond the element that holds it. If no link is
    closed any more in the page, it ends with its block. Every element is entered and left once, and an end tag that
    nothing open fits is passed over, so the work grows with the page however deep it is nested.
    """
    root = _Node("html", None, "")
    node, out = root, []
    link: _Node | None = None  # the element that holds the open link
    last_end = page.lower().rfind("</a")
    open_tags: Counter[str] = Counter()
    text: list[str] = []
    linked = at = 0

    def flush() -> None:
        nonlocal linked, link
        if text:
            words = " ".join(entities.unescape("".join(text)).split())
            if words:
                out.append(_Block(node, words, linked))
            text.clear()
        linked = 0
        if at > last_end:
            link = None

    def leave(upto: _Node) -> None:
        """Close the open elements down from (and with) one of them."""
        nonlocal node, link
        while True:
            closed, node = node, node.parent
            open_tags[closed.tag] -= 1
            if closed is link:
                link = None
            if closed is upto:
                return

    size = len(page)
    while at < size:
        m = _TAG.search(page, at)
        begin = m.start() if m else size
        if begin > at:
            text.append(page[at:begin])
            if link is not None:
                linked += begin - at
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0].startswith("<![CDATA["):
                text.append(m[0][9:-3])
            continue
        name, closes = name.lower(), bool(m[1] or m[4])
        attributes = m[3] or m[6] or ""
        if name in _INLINE:
            if name == "a":
                link = None if closes or not _HREF.search(attributes) else node
            continue
        if name == "br" or name in _VOID:
            text.append(" ")
            if name == "hr":
                flush()
            continue
        if name in _RAW:
            if not closes and not (attributes.endswith("/") and name == "svg"):
                if name == "head":
                    continue
                end = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
                at = size if end is None else page.find(">", end.start()) + 1 or size
                if name in ("textarea", "select", "button", "title"):
                    text.append(" ")
            continue
        flush()
        if closes:
            if open_tags[name]:
                up = node
                while up.tag != name:
                    up = up.parent
                leave(up)
            continue
        if node.tag in _CLOSED_BY_BLOCK and node.parent:
            leave(node)
        if name in _SIBLINGS:
            up = node
            while up.parent is not None and up.tag not in _PLACES and up.tag not in _SIBLINGS[name]:
                up = up.parent
            if up.tag in _SIBLINGS[name] and up.parent is not None:
                leave(up)
        elif name in _HEADINGS and node.tag in _HEADINGS and node.parent:
            leave(node)
        if not attributes.endswith("/"):
            node = _Node(name, node, attributes)
            open_tags[name] += 1
    flush()
    return out


def main_share(found: list[_Block]) -> float:
    """How much of the page's text is inside article, main and the like; links and suspect blocks do not count."""
    inside = everything = 0
    for b in found:
        if not b.node.suspect:
            plain = max(len(b.text) - b.linked, 0)
            everything += plain
            inside += plain if b.node.main else 0
    return inside / everything if everything else 0.0


def costs(block: _Block, share: float) -> tuple[float, float]:
    """Capacities to the terminals content and boilerplate: what the other label would cost."""
    node, n = block.node, len(block.text)
    if node.hidden:
        return 0.0, _HIDDEN
    words = block.text.count(" ") + 1
    links = min(1.0, block.linked / n)
    score = -0.5 + min(words, 60) / 20 + min(2, len(re.findall(r"[.!?](?:\s|$)", block.text))) * 0.5
    score -= 4.0 * links
    told = node.tag in _HEADINGS or re.search(r"[.!?](?:\s|$)", block.text)
    score += 2.0 if node.tag in _HEADINGS else 0.5 if node.tag in ("p", "blockquote", "pre") else 0.0
    score -= 3.0 if re.match(r"(?:©|\(c\)|copyright\b)", block.text, re.I) else 0.0
    score += _INSIDE * share if node.main else -_OUTSIDE * share
    # A long text without links is little suspect by a name above it.
    short = 1.0 - 0.75 * min(words, 60) / 60 * (1.0 - links)
    if node.placed:
        score -= _PLACE
    elif node.named:
        score -= _WORD * short
    elif node.weak:
        score -= _WEAK * short
    elif node.fields and not told:
        score -= _WORD * short
    elif node.in_header and node.tag not in _HEADINGS:
        score -= _WORD * short
    return max(score, 0.0), max(-score, 0.0)


def _apart(a: _Node, b: _Node) -> int:
    """Steps from the two elements up to the first that holds both."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def edges(found: list[_Block]) -> list[tuple[int, int, float]]:
    """Smoothness: between neighbours on the page by their distance in the tree, and between
    consecutive blocks below one parent, whatever stands between them."""
    out, last = [], {}
    for i, b in enumerate(found):
        if i:
            out.append((i - 1, i, _SMOOTH / (1 + _apart(found[i - 1].node, b.node))))
        group = id(b.node.parent)
        if group in last and last[group] < i - 1:
            out.append((last[group], i, _SMOOTH / 2))
        last[group] = i
    return out


def minimum_cut(source: list[float], sink: list[float], joined: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut (as few as can be).

    A node whose capacities differ by more than all its edges is on the same side in every
    minimum cut; such nodes are settled first, and their edges become capacities of their
    neighbours. The rest is solved by shortest augmenting paths.
    """
    n = len(source)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in joined:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    lead = [a - b for a, b in zip(source, sink, strict=True)]
    side: list[bool | None] = [None] * n
    open_ = deque(range(n))
    while open_:
        i = open_.popleft()
        if side[i] is None and abs(lead[i]) > sum(near[i].values()):
            side[i] = lead[i] > 0
            for j, w in near[i].items():
                lead[j] += w if side[i] else -w
                del near[j][i]
                open_.append(j)
            near[i] = {}
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        s, t = n, n + 1
        room: dict[int, dict[int, float]] = {i: dict(near[i]) for i in rest} | {s: {}, t: {}}
        for i in rest:
            if lead[i] > 0:
                room[s][i], room[i][s] = lead[i], 0.0
            elif lead[i] < 0:
                room[i][t], room[t][i] = -lead[i], 0.0
        while True:
            came, line = {s: s}, deque([s])
            while line and t not in came:
                i = line.popleft()
                for j, w in room[i].items():
                    if w > 1e-9 and j not in came:
                        came[j] = i
                        line.append(j)
            if t not in came:
                break
            path, j = [], t
            while j != s:
                path.append((came[j], j))
                j = came[j]
            flow = min(room[a][b] for a, b in path)
            for a, b in path:
                room[a][b] -= flow
                room[b][a] = room[b].get(a, 0.0) + flow
        for i in rest:
            side[i] = i in came
    return [bool(x) for x in side]


def main_text(page: str) -> str:
    found = blocks(page)
    if not found:
        return ""
    share = main_share(found)
    both = [costs(b, share) for b in found]
    chosen = minimum_cut([c for c, _ in both], [b for _, b in both], edges(found))
    return "\n\n".join(b.text for b, keep in zip(found, chosen, strict=True) if keep)


TEXTS = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame) -> DataFrame:
    """The main text of each page: page_id, url, text, n_chars (code points).

    A null or empty page, and one without content, gives an empty text. Pages
    that are equal or share a page_id are rows of their own. An empty table
    gives an empty result. A page is never cut.
    """

    def task(batches):
        for batch in batches:
            texts = [main_text(page or "") for page in batch.column(2).to_pylist()]
            yield arrow_batch(TEXTS, [batch.column(0), batch.column(1), texts, [len(t) for t in texts]])

    return pages.selectExpr("CAST(page_id AS LONG) AS page_id", "url", "html").mapInArrow(task, TEXTS)
