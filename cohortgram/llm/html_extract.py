"""Main text of web pages by wrapper induction.

Pages of one host are made from one template. Their trees are aligned by simple tree matching: two nodes match if
their tags and classes do, and the children of a match are matched in order by dynamic programming for the most
matching nodes. A run of alike siblings counts as one repeated node, so the work depends on the shape of a page
and not on the length of its lists; wide lists are matched in a band. A wrapper is the tree the pages of a group have been aligned to; it
takes in the nodes it lacks. Below each node of it, children of one kind are aligned by text as well: a text that ``CONSTANT`` of the pages
with such a child have there is template, the others are
slots. Slots are content where they are not part of the page's furniture by tag, class, id or
role: menus, headers and footers, sidebars, notices, adverts, forms, scripts, styles, reader comments.
The main text is that of the article where the wrapper has one, of the main element, or else of the body.

A host's pages are dealt into groups of about ``GROUP`` by a hash of url and page_id, so that groups do not depend on how the table is
stored (rows alone that repeat both more than ``GROUP`` times are dealt by their place), and each group is aligned in one task, so a host with a
third of all pages is many groups. Alone, a page's own structure decides. Equal pages count once.
A constant needs two pages. Pages that share ``CONSTANT`` of their main text are copies and count as one, as what copies share need
not be template; a host whose pages are all copies shows no template, and its pages are read by their own structure.

A class, id or part of one between spaces names furniture if all its words do, beside words of layout: ``share-links`` and ``cookie-notice``
are furniture, ``legal-analysis`` and ``related-work`` are not.

A null url is a host of its own kind; a null or empty html, or one without main text, gives ''. Broken markup is
parsed as far as it goes: unclosed paragraphs, list items and cells end where the next begins. Rows are returned one for one. No rows give no rows. Columns
besides ``page_id``, ``url`` and ``html`` are left out.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator
from functools import cache, lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgram.plans.storage import Scratch

GROUP = 64
CONSTANT = 0.8
#: Runs of children by which an alignment may stray from the diagonal of two lists.
WIDTH = 64
#: Levels that enter it; what lies deeper belongs to the node there.
DEPTH = 200

EXTRACTED = "page_id long, url string, text string"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_BLANK = re.compile(r"\s+")

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style template noscript textarea title xmp iframe noembed noframes head svg math object canvas audio video select option button".split())
FURNITURE = frozenset("nav header footer aside form dialog menu".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: What an opening tag ends where it is still open.
ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
#: Elements beyond which such an end does not reach.
_SCOPES = frozenset("ul ol menu dl table tbody thead tfoot tr select article section div body".split())
_ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar note".split())
#: Words of classes and ids of furniture.
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay newsletter subscribe subscription signup login nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar aside widget widgets footer header masthead topbar share sharing social "
    "related recommended recommendations comment comments respond replies disqus discussion pagination pager toolbar "
    "copyright legal disclaimer form search searchform".split()
)
#: Words that say nothing of what a node is.
_LAYOUT = frozenset(
    "area bar block body bottom box button buttons card center column container content fixed group icons inner item items js left "
    "level links list main outer page panel post primary right row secondary section site slot sticky text title top wrap wrapper".split()
)
_NAME = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "name", "role", "children", "hidden")

    def __init__(self, tag: str, name: str = "", role: str = "", hidden: bool = False):
        self.tag, self.name, self.role, self.hidden = tag, name, role, hidden
        self.children: list[Node | str] = []


def parse(html: str) -> Node:
    """The tree of a page; text is kept with its character references decoded."""
    root = Node("#root")
    stack = [root]
    at, end = 0, len(html)
    while at < end:
        found = _TOKEN.search(html, at)
        start = found.start() if found else end
        if start > at:
            stack[-1].children.append(entities.unescape(html[at:start]))
        if not found:
            break
        at = found.end()
        if found.group(2) is None:
            if found.group(0).startswith("<![CDATA["):
                stack[-1].children.append(found.group(0)[9:].removesuffix("]]>"))
            continue
        tag = found.group(2).lower()
        if found.group(1):
            _close(stack, tag)
            continue
        _make_room(stack, tag)
        node = Node(tag, *_described(found.group(3)))
        stack[-1].children.append(node)
        if tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = closing.end() if closing else end
        elif tag not in VOID and not found.group(3).rstrip().endswith("/"):
            stack.append(node)
    return root


def _described(attributes: str) -> tuple[str, str, bool]:
    if not attributes.strip(" /\t\r\n"):
        return "", "", False
    name, role, hidden = [], "", False
    for found in _ATTRIBUTE.finditer(attributes):
        key = found.group(1).lower()
        value = found.group(2) or found.group(3) or found.group(4) or ""
        if key in ("class", "id"):
            name.append(value.lower())
        elif key == "role":
            role = value.strip().lower()
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            hidden = True
        elif key == "style":
            hidden = hidden or "display:none" in value.replace(" ", "").lower()
    return " ".join(name), role, hidden


def _close(stack: list[Node], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        # An end tag of running text does not end the block around it.
        if tag in INLINE and stack[i].tag not in INLINE:
            return


def _make_room(stack: list[Node], tag: str) -> None:
    """Ends what the opening tag ends."""
    if tag in _ENDS_P:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == "p":
                del stack[i:]
                break
            if stack[i].tag not in INLINE:
                break
    ends = ENDS.get(tag, ())
    for i in range(len(stack) - 1, 0, -1):
        if not ends or stack[i].tag in _SCOPES and stack[i].tag not in ends:
            break
        if stack[i].tag in ends:
            del stack[i:]
            break


def furniture(node: Node) -> bool:
    """Whether a node is no part of the page's own text, whatever it holds."""
    if node.tag in UNSEEN or node.tag in FURNITURE or node.hidden or node.role in _ROLES:
        return True
    if not node.name or node.tag in ("html", "body", "article", "main"):
        return False
    return any(map(_names_furniture, node.name.split()))


@lru_cache(maxsize=4096)
def _names_furniture(name: str) -> bool:
    words = _NAME.findall(name)
    return any(w in _NAMES for w in words) and all(w in _NAMES or w in _LAYOUT for w in words)


def blocks(node: Node, skipped: frozenset[int] = frozenset()) -> list[str]:
    """The texts of the blocks below a node, in order, white space within them as one space; nodes ``skipped`` lack their own text."""
    found: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = _BLANK.sub(" ", "".join(line)).strip()
        if text:
            found.append(text)
        line.clear()

    # Frames of an explicit stack, as trees may be deep: children left, whether the node is a block, whether one
    # that has a place of its own, whether its text is skipped.
    frames = [(iter(node.children), True, True, id(node) in skipped)]
    while frames:
        children, block, placed, mute = frames[-1]
        child = next(children, None)
        if child is None:
            frames.pop()
            if block:
                end()
        elif isinstance(child, str):
            if not mute:
                line.append(child)
        elif furniture(child):
            end()
        elif child.tag in INLINE:
            frames.append((iter(child.children), False, False, mute))
        else:
            end()
            frames.append((iter(child.children), True, placed, id(child) in skipped if placed else mute))
    return found


def own_text(node: Node) -> str:
    """The text of a node outside the blocks below it; blocks within running text are part of it."""
    line: list[str] = []
    frames = [(iter(node.children), False)]
    while frames:
        children, inside = frames[-1]
        child = next(children, None)
        if child is None:
            frames.pop()
        elif isinstance(child, str):
            line.append(child)
        elif furniture(child):
            line.append(" ")
        elif child.tag in INLINE:
            frames.append((iter(child.children), True))
        else:
            line.append(" ")
            if inside:
                frames.append((iter(child.children), True))
    return _BLANK.sub(" ", "".join(line)).strip()


class Shape:
    """A node of the tree that is aligned: kind, runs of alike children, and the nodes they stand for."""

    __slots__ = ("kind", "members", "children", "size")

    def __init__(self, kind: tuple, members: list[Node], children: list[Shape]):
        self.kind, self.members, self.children = kind, members, children
        self.size = 1 + sum(c.size for c in children)


def shape(node: Node) -> Shape:
    """Runs of siblings of one kind become one node; what is below them is joined by kind."""
    return _shape([node], 0)


def _shape(members: list[Node], depth: int) -> Shape:
    runs: list[list[Node]] = []
    if depth < DEPTH:
        of_kind: dict[tuple, list[Node]] = {}
        for number, member in enumerate(members):
            last = None
            for child in member.children:
                if isinstance(child, str) or child.tag in UNSEEN or child.tag in INLINE:
                    continue
                kind = (child.tag, child.name)
                if kind != last and (number == 0 or kind not in of_kind):
                    of_kind[kind] = []
                    runs.append(of_kind[kind])
                of_kind[kind].append(child)
                last = kind
    return Shape((members[0].tag, members[0].name), members, [_shape(r, depth + 1) for r in runs])


def _band(m: int, n: int, i: int) -> range:
    """The places of a list of ``n`` against which place ``i`` of a list of ``m`` is matched."""
    if max(m, n) <= WIDTH:
        return range(n)
    middle, reach = i * n // m, WIDTH + n // m
    return range(max(0, middle - reach), min(n, middle + reach + 1))


def _table(a: Shape, b: Shape, memo: dict) -> list[dict[int, int]]:
    """Per row of a's children, by number of b's children, the most matching nodes; outside the band as at its edge."""
    m, n = len(a.children), len(b.children)
    table = [dict.fromkeys(range(n + 1), 0)]
    for i, x in enumerate(a.children):
        above, band = table[-1], _band(m, n, i)
        left = _at(above, band.start)
        row = {band.start: left}
        for j in band:
            left = max(left, _at(above, j + 1))
            y = b.children[j]
            if x.kind == y.kind:
                left = max(left, _at(above, j) + match(x, y, memo))
            row[j + 1] = left
        table.append(row)
    return table


def _at(row: dict[int, int], j: int) -> int:
    found = row.get(j)
    if found is None:
        # Keys ascend without gaps: right of the band nothing is added, left of it nothing is known.
        last = next(reversed(row))
        found = row[last] if j > last else 0
    return found


def match(a: Shape, b: Shape, memo: dict) -> int:
    """Nodes that match in the best alignment of two trees, in order."""
    if a.kind != b.kind:
        return 0
    if not a.children or not b.children:
        return 1
    key = (id(a), id(b))
    if key not in memo:
        memo[key] = 1 + _at(_table(a, b, memo)[-1], len(b.children))
    return memo[key]


def aligned(a: Shape, b: Shape, memo: dict) -> list[tuple[Shape, Shape]]:
    """The pairs of that alignment."""
    found, waiting = [], [(a, b)]
    while waiting:
        x, y = waiting.pop()
        if x is not y and not match(x, y, memo):
            continue
        found.append((x, y))
        if x is y:
            waiting.extend((c, c) for c in x.children)
            continue
        table = _table(x, y, memo)
        i, j = len(x.children), len(y.children)
        while i and j:
            here = _at(table[i], j)
            if here == _at(table[i - 1], j):
                i -= 1
            elif here == _at(table[i], j - 1):
                j -= 1
            else:
                i, j = i - 1, j - 1
                waiting.append((x.children[i], y.children[j]))
    return found


class Wrapper:
    """The tree of a group of pages, and the texts seen at its nodes."""

    def __init__(self, first: Shape):
        self.tree = first
        #: By place and text, the pages that have it there.
        self.texts: dict[tuple, dict[str, set[int]]] = {}
        #: By place, the pages that have any text there.
        self.pages: dict[tuple, set[int]] = {}
        self.places: list[list[tuple[Node, tuple, str]]] = []

    def add(self, page: Shape) -> None:
        """Aligns a page and takes in the nodes the tree lacks."""
        number, places = len(self.places), []
        pairs = aligned(self.tree, page, {})
        ours_of = {id(theirs): ours for ours, theirs in pairs}
        quiet = set()
        for ours, theirs in pairs:
            if ours is not theirs:
                self._grow(ours, theirs, ours_of, pairs)
            for run in theirs.children:
                # What is inside furniture goes with it. Pairs come from the top down.
                if id(theirs) in quiet or all(map(furniture, run.members)):
                    quiet.add(id(run))
                    continue
                for node in run.members:
                    self._see(number, places, node, (id(ours), run.kind))
        for node in page.members:
            self._see(number, places, node, (0, page.kind))
        self.places.append(places)

    def _see(self, number: int, places: list, node: Node, place: tuple) -> None:
        text = own_text(node)
        if text:
            self.texts.setdefault(place, {}).setdefault(text, set()).add(number)
            self.pages.setdefault(place, set()).add(number)
            places.append((node, place, text))

    @staticmethod
    def _grow(ours: Shape, theirs: Shape, ours_of: dict[int, Shape], pairs: list) -> None:
        """Puts what only the page has behind its neighbour before it."""
        merged, left = [], iter(ours.children)
        for child in theirs.children:
            partner = ours_of.get(id(child))
            if partner is None:
                merged.append(child)
                # Read on by the loop over the pairs.
                pairs.extend((s, s) for s in _below(child))
                continue
            for own in left:
                merged.append(own)
                if own is partner:
                    break
        ours.children = [*merged, *left]

    def constant(self, page: int, copies: Callable[[], list[int]]) -> frozenset[int]:
        """The page's nodes whose own text is template; ``copies`` gives each page the number of its class of copies."""
        found = set()
        for node, place, text in self.places[page]:
            total, most = self.pages[place], self.texts[place][text]
            if len(most) < 2:
                continue
            classes = copies()
            n_total, n_most = len({classes[p] for p in total}), len({classes[p] for p in most})
            if n_most >= 2 and n_most >= CONSTANT * n_total:
                found.add(id(node))
        return frozenset(found)


def _below(top: Shape) -> list[Shape]:
    found = [top]
    for node in found:
        found.extend(node.children)
    return found


def _copies(roots: list[Node]) -> list[int]:
    """Classes of pages that share ``CONSTANT`` of the main text of the shorter one."""
    classes: list[int] = []
    first: list[set[str]] = []
    for root in roots:
        own = {b for part in _content_root(root) for b in blocks(part)}
        size = sum(map(len, own))
        for number, other in enumerate(first):
            if sum(map(len, own & other)) >= CONSTANT * min(size, sum(map(len, other))):
                classes.append(number)
                break
        else:
            classes.append(len(first))
            first.append(own)
    return classes


def _content_root(root: Node) -> list[Node]:
    """The articles of a page outside its furniture, the main element or the body, else all of it."""
    found: dict[str, list[Node]] = {"article": [], "main": [], "body": []}
    waiting = [root]
    while waiting:
        node = waiting.pop()
        for child in reversed([c for c in node.children if isinstance(c, Node)]):
            if child.tag in ("article", "main", "body") or child.role == "main":
                kind = "main" if child.role == "main" else child.tag
                if not furniture(child):
                    found[kind].append(child)
                if kind == "article":
                    continue
            if not furniture(child):
                waiting.append(child)
    articles = [a for a in found["article"] if not furniture(a)]
    return articles or found["main"][:1] or found["body"][:1] or [root]


def extract(pages: list[str | None]) -> list[str]:
    """The main texts of pages of one host."""
    distinct = list(dict.fromkeys(p or "" for p in pages))
    roots = [parse(p) for p in distinct]
    shapes = [shape(r) for r in roots]
    # The page with the most nodes comes first, as it has most of the template.
    order = sorted(range(len(shapes)), key=lambda k: -shapes[k].size)
    wrapper = Wrapper(shapes[order[0]]) if shapes else None
    for k in order:
        wrapper.add(shapes[k])
    added = {k: number for number, k in enumerate(order)}
    copies = cache(lambda: _copies([roots[k] for k in order]))
    texts = {}
    for number, (source, root) in enumerate(zip(distinct, roots)):
        skipped = wrapper.constant(added[number], copies)
        texts[source] = " ".join(b for part in _content_root(root) for b in blocks(part, skipped))
    return [texts[p or ""] for p in pages]


def main_text(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """``page_id, url, text`` of every row."""
    # Parts of a url by pattern: a broken one gives no host instead of an error.
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    known = pages.select(F.col("page_id").cast("long"), "url", "html", F.coalesce(host, F.lit("")).alias("host"))
    counts = known.groupBy("host").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    placed = known.withColumn("place", F.xxhash64("url", "page_id"))
    # Repeated rows would fill one group. They are few, or the table is small: urls and ids are counted without the pages.
    often = known.withColumn("place", F.xxhash64("url", "page_id")).groupBy("place").agg(F.count("*").alias("times"))
    often = scratch.keep("repeated", often.where(F.col("times") > GROUP).select("place", F.lit(True).alias("often")))
    dealt = placed.join(scratch.keep("hosts", counts), "host").join(often, "place", "left")
    by = F.when(F.col("often"), F.xxhash64(F.monotonically_increasing_id())).otherwise(F.col("place"))
    dealt = dealt.withColumn("part", F.pmod(by, "groups")).drop("often", "groups")

    def induce(group: pa.Table) -> pa.Table:
        order = pc.sort_indices(group, [("place", "ascending"), ("html", "ascending")])
        group = group.take(order)
        texts = pa.array(extract(group.column("html").to_pylist()), pa.string())
        return pa.table([group.column("page_id"), group.column("url"), texts], names=["page_id", "url", "text"])

    return dealt.groupBy("host", "part").applyInArrow(induce, EXTRACTED)
