"""A small forgiving HTML tree and the wrapper trees aligned over it."""

from __future__ import annotations

import html
import json
import re
import zlib
from dataclasses import dataclass, field

# Element names and the words that mark page furniture.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe xmp svg math".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s "
             "samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIST_SCOPE = set("ul ol dl table tbody thead tfoot select article section div main body".split())
FURNITURE_TAGS = set("head nav footer aside form script style noscript template svg math button select "
                     "textarea input iframe dialog menu object embed canvas audio video title".split())
FURNITURE_WORDS = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion "
                      "banner sidebar aside nav navbar navigation menu breadcrumb breadcrumbs masthead header "
                      "footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
                      "subscribe subscription signup login search share sharing social related recommended "
                      "comment comments commentlist respond replies disqus widget toolbar pagination pager "
                      "skip copyright disclaimer".split())
FURNITURE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu "
                      "menubar toolbar".split())
BLOCK_TEXT = set("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption td th caption summary address".split())

_TOKEN = re.compile(r"([^<]*)(?:<(/?)([A-Za-z][A-Za-z0-9:\-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
                    r"|<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*>?|(<)|$)", re.S)
_CARES = re.compile(r"class|id|role|hidden|style", re.I)
_ATTR = re.compile(r"([A-Za-z_:][\w:.\-]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


# Elements nested deeper than this give their text to the ancestor at this
# depth, in order and as blocks of their own.
MAX_DEPTH = 120


class Node:
    """An element: its children are nodes and pieces of raw text."""

    __slots__ = ("tag", "mark", "furniture", "items")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.items, self.mark, self.furniture = tag, [], "", tag in FURNITURE_TAGS
        if attrs and _CARES.search(attrs):
            own = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)}
            words = re.findall(r"[a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", " ".join(
                (own.get("class", ""), own.get("id", "")))).lower())
            self.mark = re.sub(r"\d+", "0", own.get("class", "").strip().lower())
            self.furniture = (self.furniture or bool(FURNITURE_WORDS & set(words))
                              or own.get("role", "").lower() in FURNITURE_ROLES
                              or "hidden" in own or own.get("aria-hidden") == "true"
                              or "display:none" in own.get("style", "").replace(" ", "").lower())
            if tag in ("html", "body", "article", "main", "h1"):
                self.furniture = tag == "article" and bool({"comment", "comments", "related", "ad"} & set(words))


def parse(page: str | None) -> Node:
    """The tree of a page; tags that are not closed end with their parents. No
    node lies deeper than ``MAX_DEPTH``, so walks over the tree may recurse."""
    root = Node("#root")
    stack, at, page = [root], 0, page or ""

    def put(item: str | Node) -> None:
        if len(stack) <= MAX_DEPTH:
            stack[-1].items.append(item)
        elif isinstance(item, str) or item.tag == "br":
            deep = stack[MAX_DEPTH:]
            holder = Node(next((n.tag for n in reversed(deep) if n.tag not in INLINE), deep[-1].tag))
            holder.furniture = any(n.furniture for n in deep)
            holder.items.append(item)
            stack[MAX_DEPTH - 1].items.append(holder)

    while at < len(page):
        found = _TOKEN.match(page, at)
        text, close, name, attrs, data, stray = found.groups()
        at = found.end()
        if text:
            put(text)
        if not name:
            if data or stray:
                put(html.escape(data or stray))
            continue
        tag = name.lower()
        if close:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        if tag not in INLINE:
            _close_open(stack, tag)
        node = Node(tag, attrs)
        if tag == "header" and not any(n.tag in ("article", "main") for n in stack):
            node.furniture = True  # the site's, not an article's own
        put(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not attrs.endswith("/"):
            stack.append(node)
    return root


def _close_open(stack: list[Node], tag: str) -> None:
    """A block element ends an open paragraph or heading; list items, cells and
    rows end the open one of their list or table."""
    for depth in range(len(stack) - 1, 0, -1):
        open_tag = stack[depth].tag
        if open_tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6") or open_tag in CLOSES.get(tag, ()):
            del stack[depth:]
            return
        if open_tag not in INLINE and open_tag not in ("td", "th", "tr") or open_tag in LIST_SCOPE:
            return


@dataclass
class Wrap:
    """A node of a wrapper: the nodes aligned with it over all pages seen.

    values holds up to VALUES hashes of the text found directly in them, 0 for
    none: one hash means constant (template), several mean a slot (content)."""

    tag: str
    mark: str
    furniture: bool
    n: int = 1
    chars: int = 0
    linked: int = 0
    repeat: bool = False
    values: set = field(default_factory=set)
    kids: list = field(default_factory=list)
    own: list = field(default_factory=list)

    def dump(self) -> list:
        return [self.tag, self.mark, self.furniture, self.n, self.chars, self.linked, self.repeat,
                sorted(self.values), [k.dump() for k in self.kids]]


VALUES = 8
SEEN_ENOUGH = 5


def load(data: list) -> Wrap:
    tag, mark, furniture, n, chars, linked, repeat, values, kids = data
    return Wrap(tag, mark, furniture, n, chars, linked, repeat, set(values), [load(k) for k in kids])


def _flat(node: Node):
    """The node's own text pieces and block children; inline elements are
    transparent."""
    for x in node.items:
        if isinstance(x, str):
            yield x, False
        elif x.tag == "br":
            yield " ", False
        elif x.tag in INLINE and not x.furniture:
            for y, linked in _flat(x):
                yield y, linked or x.tag == "a"
        else:
            yield x, False


def shape(node: Node) -> Wrap:
    """The wrapper of one page: equal neighbours are folded into one node."""
    if node.furniture:
        return Wrap(node.tag, node.mark, True, own=[node])
    texts, linked, kids = [], 0, []
    for x, in_link in _flat(node):
        if isinstance(x, str):
            texts.append(x)
            linked += len(x) if in_link else 0
        else:
            kid = shape(x)
            if kids and alike(kids[-1], kid):
                kids[-1] = merge(kids[-1], kid, same_page=True)
            else:
                kids.append(kid)
    text = "".join(texts).strip()
    return Wrap(node.tag, node.mark, node.furniture, 1, len(text), min(linked, len(text)), False,
                {zlib.crc32(text.encode("utf-8", "replace")) if text else 0}, kids, [node])


def alike(a: Wrap, b: Wrap) -> bool:
    return a.tag == b.tag and a.mark == b.mark and a.furniture == b.furniture


def align(a: list[Wrap], b: list[Wrap]) -> list[tuple[int, int]]:
    """Simple tree matching of two child lists: the in-order pairs that match
    the most nodes."""
    if len(a) == len(b) and all(map(alike, a, b)):
        return [(i, i) for i in range(len(a))]
    size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    weight = {}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best = max(size[i][j + 1], size[i + 1][j])
            if alike(x, y):
                weight[i, j] = w = 1 + matching(x, y)
                best = max(best, size[i][j] + w)
            size[i + 1][j + 1] = best
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if (i - 1, j - 1) in weight and size[i][j] == size[i - 1][j - 1] + weight[i - 1, j - 1]:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif size[i][j] == size[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return pairs[::-1]


def matching(a: Wrap, b: Wrap) -> int:
    """Nodes below a and b that simple tree matching pairs."""
    return sum(1 + matching(a.kids[i], b.kids[j]) for i, j in align(a.kids, b.kids))


def merge(a: Wrap, b: Wrap, same_page: bool = False) -> Wrap:
    """One wrapper for both: aligned children merge, the others stay in order."""
    kids, i, j = [], 0, 0
    for x, y in [*align(a.kids, b.kids), (len(a.kids), len(b.kids))]:
        kids += a.kids[i:x] + b.kids[j:y]
        if x < len(a.kids):
            kids.append(merge(a.kids[x], b.kids[y], same_page))
        i, j = x + 1, y + 1
    values = a.values | b.values
    if len(values) > VALUES:
        values = set(sorted(values)[:VALUES])
    return Wrap(a.tag, a.mark, a.furniture, max(a.n, b.n) if same_page else a.n + b.n, a.chars + b.chars,
                a.linked + b.linked, a.repeat or b.repeat or same_page, values, kids,
                a.own + b.own if same_page else [])


def slot_chars(w: Wrap) -> int:
    """Characters in content slots at or below ``w``: text that varies, or that
    too few pages show, outside furniture and not mostly links."""
    if w.furniture:
        return 0
    own = w.chars if 2 * w.linked <= w.chars and (len(w.values) > 1 or w.n < SEEN_ENOUGH) else 0
    return own + sum(map(slot_chars, w.kids))


def container(w: Wrap) -> Wrap:
    """The node that holds the content slots: an article, else the lowest node
    with all of them."""
    best = _article(w)
    if best is not None:
        return best
    while True:
        inner = [k for k in w.kids if slot_chars(k)]
        if (len(inner) != 1 or inner[0].tag in BLOCK_TEXT or inner[0].repeat
                or 2 * w.linked <= w.chars and w.chars and len(w.values) > 1):
            return w
        w = inner[0]


def _article(w: Wrap) -> Wrap | None:
    for tag in ("article", "main"):
        found = [x for x in _walk(w) if x.tag == tag and slot_chars(x)]
        if found:
            return max(found, key=slot_chars)
    return None


def _walk(w: Wrap):
    yield w
    if not w.furniture:
        for k in w.kids:
            yield from _walk(k)


def _template(w: Wrap) -> bool:
    """Constant text in a fixed place of enough pages. A paragraph or heading
    inside the content stays, even if many pages share it."""
    return w.tag not in BLOCK_TEXT and not w.repeat and not w.kids and w.n >= SEEN_ENOUGH and len(w.values) == 1


def main_text(page: str | None, wrapper: Wrap | None) -> str:
    """The content blocks of a page under its host's wrapper."""
    root = parse(page)
    own = shape(root)
    if wrapper is None:
        wrapper = own
        pairs = {id(x): x for x in _walk(own)}
    else:
        pairs = {}
        _pair(wrapper, own, pairs)
    target = container(wrapper)
    nodes = [x for x in _walk(own) if pairs.get(id(x)) is target]
    varied = sum(1 for k in _walk(target) if len(k.values) >= SEEN_ENOUGH)
    skip = {id(node) for x in _walk(own) for node in x.own
            if varied and id(x) in pairs and _template(pairs[id(x)])}
    if not nodes or not slot_chars_of_page(nodes):
        nodes = [container(own)]
    blocks: list[str] = []
    for x in nodes:
        for node in x.own:
            _blocks(node, skip, blocks)
    return "\n\n".join(blocks)


def slot_chars_of_page(nodes: list[Wrap]) -> int:
    return sum(k.chars for x in nodes for k in _walk(x))


def _pair(w: Wrap, own: Wrap, pairs: dict) -> None:
    pairs[id(own)] = w
    for i, j in align(w.kids, own.kids):
        _pair(w.kids[i], own.kids[j], pairs)


def _blocks(node: Node, skip: set, blocks: list[str]) -> None:
    run: list[str] = []

    def flush():
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            blocks.append(text)

    for x, _ in _flat(node):
        if isinstance(x, str):
            run.append(html.unescape(x) if "&" in x else x)
            continue
        flush()
        if not x.furniture and id(x) not in skip:
            _blocks(x, skip, blocks)
    flush()


def dumps(w: Wrap) -> str:
    return json.dumps(w.dump(), separators=(",", ":"))


def loads(data: str) -> Wrap:
    return load(json.loads(data))
