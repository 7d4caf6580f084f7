"""Main text of HTML pages by wrappers, inferred as union-free regular expressions.

1. A page's tags make a tree of tokens. Runs of equal sibling groups in it become
   repeated groups, so most pages of a template have one stream. The distinct streams
   of a host are aligned one after the other: what only one side has becomes optional,
   what follows its like becomes repeated, and texts become slots. The result is the
   host's wrapper; its nodes are numbered in page order.
2. Every page is matched with its host's wrapper, so each of its blocks of text stands
   at a node. A text that stands in one place on nearly all pages of the host belongs to
   the expression: it is fixed. What differs from page to page fills a slot.
3. The main region is all articles that the host marks as such, or else the smallest
   node with most of the slot text. A marked region gives all its text, fixed or not;
   another one what stands from its first filled slot to its last, so that headings
   between paragraphs stay and lines above and below them that every page has go. A
   page that has nothing at the region gives its slots elsewhere.

Elements that HTML itself keeps apart from the text (nav, aside, footer, form, ...)
give no text. Names in class, id and role are a fallback for what differs on every
page and yet is no article: a whole name of a short list drops an element beside the
region, never one around it. Inside a marked region only adverts and reader comments
go by their names alone, other named elements if they hold form controls or if most
of their text is links.

Copies don't look like templates: pages count as one if their longest block is the same.
A page is parsed once; its tree and blocks are written, and matched wherever needed.
Walks and alignments are loops without recursion.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanframe.llm.common import written

#: Partitions of a host's pages where wrappers aren't broadcast, and streams that one task merges.
SALTS, FAN = 32, 64
#: Total bytes of wrappers, and of decisions, up to which they are broadcast; else pages meet them by host.
BROADCAST_BYTES = 16 << 20
#: A text is fixed if it stands in its element's place on this share of the host's unlike pages with text there, and on so many at least.
FIXED_SHARE, FIXED_PAGES = 0.9, 4
#: Part of a node's slot text that one child must hold for the region to narrow to it.
NARROWS = 0.6
#: Bits of the rows of an alignment that are held at once; longer lists are halved, with a longest common part all the same.
HELD_BITS = 1 << 26

_raw = "script|style|textarea|title|noscript|template|iframe|xmp|noembed|noframes|svg|select"
_token = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<({_raw})(?=[\s/>])(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>",
    re.S | re.I,
)
_attribute = re.compile(r"(?<![\w:.-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
#: What a key leaves out of names: long numbers, and what isn't a word.
_no_key = re.compile(r"\d{3,}|[^\w]+")
_tag_part = re.compile("[^.@]*")
BLOCKS = frozenset("html head body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address header footer nav aside form fieldset details summary dialog menu center hgroup".split())
_breaks = frozenset("br hr img input".split())
_cells = frozenset("td th".split())
_closes_p = BLOCKS - _cells
#: Elements that no main text stands in; also header, but in an article or main.
AWAY_TAGS = frozenset("nav aside footer form dialog menu head button".split())
#: Form controls. What they stand in is a form, if it is a fieldset or has one of the names below.
_controls = re.compile(r"<(?:input|select|textarea|button)(?=[\s/>])", re.I)
#: Whole names of what is no article anywhere: adverts and reader comments.
INNER_NAMES = re.compile(r"(?:ads?|ad[-_].*|.*[-_]ads?|advert.*|sponsor(?:ed)?(?:[-_].*)?|promo(?:tion)?s?(?:[-_].*)?|comments?|comments?[-_](?:list|section|area|form|thread|box)|respond|replies|disqus.*)", re.I)
#: Whole names in class, id or role of what is no article, though it differs on every page, where it stands beside one.
AWAY_NAMES = re.compile(
    r"(?:ads?|ad[-_].*|.*[-_]ads?|advert.*|sponsor(?:ed)?(?:[-_].*)?|promo(?:tion)?s?(?:[-_].*)?|side[-_]?bar|banner|masthead|comments?|comments?[-_](?:list|section|area|form|thread|box)|respond|replies|disqus.*|"
    r"cookies?(?:[-_].*)?|consent.*|gdpr.*|notices?|alert|newsletter.*|subscribe.*|sign-?up.*|share|sharing|share[-_].*|social(?:[-_].*)?|related|related[-_](?:posts|articles|links|stories|news)|recommend(?:ed|ations)(?:[-_].*)?|"
    r"breadcrumbs?|menu|nav|navbar|navigation|.*[-_](?:nav|menu)|(?:nav|menu)[-_].*|pagination|pager|footer|(?:site|page)[-_](?:footer|header)|popup|modal|overlay|toolbar|search(?:[-_]form)?|login|widgets?|contentinfo|complementary)",
    re.I,
)
#: What no name drops.
NAMED_STAYS = frozenset("html body article main p h1 h2 h3 h4 h5 h6".split())
#: Nodes that a region never narrows to.
_leaves = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr blockquote pre figcaption caption #".split())


class Node:
    """A node of a page or wrapper: flag is "", "?", "+" or "*"; the key "#" is a text slot, "(a b)" a group; named keys begin with "!", those of INNER_NAMES with "!!"."""

    __slots__ = ("at", "flag", "into", "key", "kids", "off", "waiting")

    def __init__(self, key: str, flag: str = ""):
        self.key, self.flag = key, flag
        self.kids: list[Node] = []
        self.waiting: list[list[Node]] = []  # lists of children still to be aligned with kids
        self.into: Node | None = None  # the node this one was merged into
        self.at, self.off = 0, 0

    @property
    def tag(self) -> str:
        return _tag_part.match(self.key.lstrip("!"))[0]


def _either(a: str, b: str, more: str = "") -> str:
    flags = a + b + more
    optional, repeated = "?" in flags or "*" in flags, "+" in flags or "*" in flags
    return "*" if optional and repeated else "?" if optional else "+" if repeated else ""


def _absorb(x: Node, y: Node, todo: list[Node], more: str = "") -> None:
    x.flag = _either(x.flag, y.flag, more)
    if y.kids or x.kids:
        x.waiting.append(y.kids)
    x.waiting += y.waiting
    y.waiting, y.into = [], x
    if x.waiting:
        todo.append(x)


def _rows(a: list[str], masks: dict[str, int], width: int, keep: bool) -> list[int]:
    """Bit rows of a longest common part: of each beginning of a (or of a alone), bit j is 0 where one more key of b's beginning of j + 1 fits."""
    every = (1 << width) - 1
    row, out = every, []
    for key in a:
        hit = row & masks.get(key, 0)
        row = ((row + hit) | (row - hit)) & every
        if keep:
            out.append(row)
    return out if keep else [row]


def _masks(b: list[str]) -> dict[str, int]:
    out: dict[str, int] = {}
    for j, key in enumerate(b):
        out[key] = out.get(key, 0) | 1 << j
    return out


def _lengths(row: int, width: int) -> np.ndarray:
    """Of each beginning of b, from none to all: how much of it is common."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(width // 8 + 1, "little"), np.uint8), bitorder="little")[:width]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def matching(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Increasing index pairs of equal keys: a longest common part, by rows of bits, in memory that halving bounds."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        low, high, left, right = todo.pop()
        while low < high and left < right and a[low] == b[left]:
            out.append((low, left))
            low, left = low + 1, left + 1
        while low < high and left < right and a[high - 1] == b[right - 1]:
            high, right = high - 1, right - 1
            out.append((high, right))
        n, m = high - low, right - left
        if not n or not m:
            continue
        if n > 1 and n * m > HELD_BITS:
            mid = (low + high) // 2
            front = _lengths(_rows(a[low:mid], _masks(b[left:right]), m, False)[0], m)
            back = _lengths(_rows(a[mid:high][::-1], _masks(b[left:right][::-1]), m, False)[0], m)[::-1]
            at = left + int((front + back).argmax())
            todo += [(low, mid, left, at), (mid, high, at, right)]
            continue
        rows = _rows(a[low:high], _masks(b[left:right]), m, True)
        i, j = n, m
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
                continue
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                out.append((low + i, left + j))
    return sorted(out)


def _group_key(nodes: list[Node]) -> str:
    return "(" + " ".join(x.key for x in nodes) + ")"


def _folded(kids: list[Node], todo: list[Node]) -> list[Node]:
    """Neighbouring equal groups as one repeated group each. Groups are as long as some key is from its next like."""
    last: dict[str, int] = {}
    sizes = {1}
    for k, node in enumerate(kids):
        sizes.add(k - last.get(node.key, k - 1))
        last[node.key] = k
    for size in sorted(sizes):
        if len(kids) < 1 + min(size, 2):
            break
        out: list[Node] = []
        for node in kids:
            out.append(node)
            if size == 1:
                if len(out) > 1 and out[-2].key == node.key:
                    _absorb(out[-2], out.pop(), todo, "+")
            elif len(out) > size:
                group = out[-size - 1]
                if group.key[0] == "(" and group.key == _group_key(out[-size:]):
                    pass
                elif len(out) >= 2 * size and all(x.key == y.key for x, y in zip(out[-2 * size : -size], out[-size:], strict=True)):
                    group = Node(_group_key(out[-size:]), "+")
                    group.kids = out[-2 * size : -size]
                    out[-2 * size : -size] = [group]
                else:
                    continue
                for x, y in zip(group.kids, out[-size:], strict=True):
                    _absorb(x, y, todo)
                del out[-size:]
        kids = out
    return kids


def _settle(todo: list[Node]) -> None:
    """Aligns all children that wait."""
    while todo:
        x = todo.pop()
        while x.waiting:
            a, b = x.kids, x.waiting.pop()
            keys = [y.key for y in a], [y.key for y in b]
            if keys[0] == keys[1]:
                for y, z in zip(a, b, strict=True):
                    _absorb(y, z, todo)
                continue
            out: list[Node] = []
            i = j = 0
            for p, q in [*matching(*keys), (len(a), len(b))]:
                for only in a[i:p] + b[j:q]:
                    only.flag = _either(only.flag, "?")
                    out.append(only)
                if p < len(a):
                    _absorb(a[p], b[q], todo)
                    out.append(a[p])
                i, j = p + 1, q + 1
            x.kids = _folded(out, todo)


def aligned(a: Node, b: Node) -> Node:
    """The wrapper a, which now also matches b."""
    todo: list[Node] = []
    _absorb(a, b, todo)
    _settle(todo)
    return a


def expression(root: Node) -> str:
    """A wrapper as a regular expression over tags and text slots."""
    out: list[str] = []
    stack: list[Node | str] = list(reversed(root.kids))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.key == "#":
            out.append("#" + x.flag)
        else:
            group = x.key[0] == "("
            out.append(("(" if group or x.flag else "") + ("" if group else f"<{x.key}>"))
            stack.append(("" if group else "</>") + (f"){x.flag}" if group or x.flag else ""))
            stack += reversed(x.kids)
    return "".join(out)


def flat(root: Node) -> str:
    """A tree as lines (depth, flag, key) in page order; node k has at = k afterwards, as in unflat."""
    out: list[str] = []
    stack = [(0, x) for x in reversed(root.kids)]
    while stack:
        depth, x = stack.pop()
        x.at = len(out) + 1
        out.append(f"{depth}\t{x.flag}\t{x.key}")
        stack += [(depth + 1, y) for y in reversed(x.kids)]
    return "\n".join(out)


def unflat(lines: str) -> tuple[Node, list[Node], list[int]]:
    """(root, all nodes in page order, for each the number of the first node behind its subtree); node k has at = k."""
    root = Node("")
    nodes, ends, up = [root], [0], [root]
    for line in lines.split("\n") if lines else []:
        depth, flag, key = line.split("\t")
        x = Node(key, flag)
        x.at = len(nodes)
        for y in up[int(depth) + 1 :]:
            ends[y.at] = len(nodes)
        del up[int(depth) + 1 :]
        up[-1].kids.append(x)
        up.append(x)
        nodes.append(x)
        ends.append(0)
    for y in up:
        ends[y.at] = len(nodes)
    return root, nodes, ends


def read_page(html: str | None) -> tuple[Node, list[tuple[Node, Node, bool, int, str]]]:
    """(tree of the page, blocks (node, the element around its own, off, characters in links, text)). Articles and mains also give a block without text, which says that they are there.

    off: the block's fieldset, or named element, holds a form control.
    """
    source = html or ""
    root = Node("")
    stack: list[tuple[str, Node, bool, list[bool]]] = [("", root, False, [False])]  # tag, node, away, whether what is perhaps a form has controls
    opened: Counter[str] = Counter()
    todo: list[Node] = []
    blocks: list[tuple[Node, Node, list[bool], int, str]] = []
    held: list[str] = []
    first: tuple[Node, Node, list[bool]] | None = None
    links = in_link = at = 0

    def flush() -> None:
        nonlocal first, links
        if first is not None:
            text = " ".join("".join(held).split())
            if text:
                blocks.append((*first, links, text))
        held.clear()
        first, links = None, 0

    def text_at(raw: str) -> None:
        nonlocal first, links
        _, node, away, form = stack[-1]
        if not raw.isspace():
            if not node.kids or node.kids[-1].key != "#":
                node.kids.append(Node("#"))
            if away:
                return
            if first is None:
                first = node.kids[-1], stack[max(0, len(stack) - 2)][1], form
            if in_link:
                links += len(raw)
        if not away:
            held.append(entities.unescape(raw) if "&" in raw else raw)

    def close() -> None:
        tag, node, *_ = stack.pop()
        if tag not in _cells:
            flush()
        opened[tag] -= 1
        node.kids = _folded(node.kids, todo)
        if todo:
            _settle(todo)

    for m in _token.finditer(source):
        if m.start() > at:
            text_at(source[at : m.start()])
        at = m.end()
        if _controls.match(source, m.start()) and stack[-1][3] is not stack[0][3]:
            stack[-1][3][0] = True
        tag = m[3] or m[6]
        if tag is None:
            continue
        tag, closing, rest = tag.lower(), m[2] or m[5], m[4] if m[3] else m[7]
        if tag in _breaks or tag == "button" and not closing:
            held.append(" ")
        elif tag == "a":
            in_link = 0 if closing else 1
        elif tag not in BLOCKS:
            pass
        elif closing:
            if opened[tag] > 0:
                while stack[-1][0] != tag:
                    close()
                close()
        else:
            if tag in _closes_p and stack[-1][0] == "p" or tag in ("li", "dt", "dd", "tr") and stack[-1][0] == tag:
                close()
            names = [(x[0].lower(), x[1] or x[2] or x[3]) for x in _attribute.findall(rest)] if rest and "=" in rest else []
            key = tag + "".join(sorted(("@" if k == "role" else ".") + _no_key.sub("", v).lower() for k, v in names if k != "id"))
            whole = [name for _, v in names for name in v.split()] if tag not in NAMED_STAYS else []
            if any(map(AWAY_NAMES.fullmatch, whole)):
                key = ("!!" if any(map(INNER_NAMES.fullmatch, whole)) else "!") + key
            marked = tag in ("article", "main") or any(k == "role" and v.strip().lower() == "main" for k, v in names)
            away = stack[-1][2] or tag in AWAY_TAGS or tag == "header" and not opened["article"] and not opened["main"]
            if tag in _cells:
                held.append(" ")
            else:
                flush()
            node = Node(key)
            stack[-1][1].kids.append(node)
            stack.append((tag, node, away, [False] if tag == "fieldset" or key[0] == "!" else stack[-1][3]))
            opened[tag] += 1
            in_link = 0
            if marked and not away:
                blocks.append((node, node, [False], 0, ""))
    if at < len(source):
        text_at(source[at:])
    while len(stack) > 1:
        close()
    flush()
    root.kids = _folded(root.kids, todo)
    _settle(todo)
    return root, [(x, y, form[0], n, text) for x, y, form, n, text in blocks]


def _merged(node: Node) -> Node:
    """What a node was merged into."""
    found = node
    while found.into is not None:
        found = found.into
    while node.into is not None:
        node.into, node = found, node.into
    return found


def matched(wrapper: Node, page: Node) -> None:
    """Sets at, the number of its node in the wrapper, for all nodes of a page; below a node that the wrapper lacks that of the nearest around, and off where such a node is named."""
    stack = [(wrapper, page)]
    while stack:
        w, p = stack.pop()
        p.at = w.at
        keys = [x.key for x in w.kids], [x.key for x in p.kids]
        pairs = [(k, k) for k in range(len(keys[0]))] if keys[0] == keys[1] else matching(*keys)
        stack += [(w.kids[i], p.kids[j]) for i, j in pairs]
        if len(pairs) < len(p.kids):
            there = {j for _, j in pairs}
            lost = [(x, 0) for j, x in enumerate(p.kids) if j not in there]
            while lost:
                x, off = lost.pop()
                x.at, x.off = w.at, off | (x.key[0] == "!")
                lost += [(y, x.off) for y in x.kids]


def decided(nodes: list[Node], ends: list[int], chars: dict[int, int], links: dict[int, int], fixed: dict[int, int], fixed_links: dict[int, int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]], bool]:
    """(ranges of nodes that make the main region, ranges that are dropped, whether the region is marked) of a wrapper.

    chars: characters of slot text at a node outside elements that are away by
    tag; links: those of them in links; fixed and fixed_links: the same of fixed text.
    """
    n = len(nodes)
    parent = [0] * n
    for x in nodes:
        for y in x.kids:
            parent[y.at] = x.at
    # a named element counts unless something is lost by it: nothing marked stands outside of all named ones
    named = [False] * n
    marked: list[int] = []
    for x in nodes[1:]:
        named[x.at] = named[parent[x.at]] or x.key[0] == "!"
        marked += [x.at] * (x.tag in ("article", "main") or x.key.endswith("@main"))

    def sums(value) -> list[int]:
        out = [value(k) for k in range(n)]
        for k in range(n - 1, 0, -1):
            out[parent[k]] += out[k]
        return out

    total, linked = sums(lambda k: chars.get(k, 0) + fixed.get(k, 0)), sums(lambda k: links.get(k, 0) + fixed_links.get(k, 0))
    regions = [k for k in marked if total[k] and not named[k]] or [k for k in marked if total[k]]
    marks = bool(regions)
    if marks:
        top = "article" if any(nodes[k].tag == "article" for k in regions) else ""
        outer: list[int] = []
        for k in sorted(k for k in regions if not top or nodes[k].tag == top):
            if not outer or k >= ends[outer[-1]]:
                outer.append(k)
        regions = outer
    else:
        inside = sums(lambda k: 0 if named[k] else max(0, chars.get(k, 0) - links.get(k, 0)))
        at = 0
        while True:
            kids, below = list(nodes[at].kids), []
            while kids:  # a group is no element
                y = kids.pop()
                if y.key[0] == "(":
                    kids += y.kids
                elif y.tag not in _leaves:
                    below.append(y)
            best = max(below, key=lambda y: (inside[y.at], -y.at), default=None)
            if best is None or inside[best.at] <= NARROWS * inside[at]:
                break
            at = best.at
        regions = [at]
    around: set[int] = set()
    for k in regions:
        while k:
            around.add(k)
            k = parent[k]
    drops = []
    inner = set()
    for k in regions:
        inner.update(range(k, ends[k]) if marks else ())
    for x in nodes[1:]:
        list_of_links = 2 * linked[x.at] > total[x.at] > 0
        if x.at in around:
            continue
        if x.key[0] == "!" and (x.at not in inner or x.key[:2] == "!!" or list_of_links):
            drops.append((x.at, ends[x.at]))
        elif not marks and list_of_links and x.tag in ("ul", "ol", "div", "section", "table"):  # a menu
            drops.append((x.at, ends[x.at]))
    return [(k, ends[k]) for k in regions], sorted(set(drops)), marks


def _host(url: Column) -> Column:
    """The host of a URL without a leading www. or m.; of a null one the empty string."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), r"^(www|m)\.", "")


BLOCK = "struct<node:int,box:int,off:boolean,links:int,text:string>"


def read_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, host, tree, blocks, context), written: each page parsed once. Blocks name the nodes of the page's own tree.

    Null and empty pages have the empty tree and no blocks; repeated rows come
    again; an empty table has no rows. context: a digest of the longest block.
    """
    id_type, url_type = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), _host(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("node", pa.int32()), ("box", pa.int32()), ("off", pa.bool_()), ("links", pa.int32()), ("text", pa.string())]))
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                trees, out = [], []
                for text in part.column(3):
                    root, blocks = read_page(text.as_py())
                    trees.append(flat(root))
                    out.append([{"node": _merged(x).at, "box": _merged(y).at, "off": off, "links": links, "text": t} for x, y, off, links, t in blocks])
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(trees, pa.string()), pa.array(out, kind)], names=["id", "url", "host", "tree", "blocks"])

    found = rows.mapInArrow(read, f"id {id_type}, url {url_type}, host string, tree string, blocks array<{BLOCK}>")
    longest = F.aggregate("blocks", F.struct(F.lit(0).alias("n"), F.lit("").alias("text")), lambda acc, b: F.when(F.length(b["text"]) > acc["n"], F.struct(F.length(b["text"]).alias("n"), b["text"].alias("text"))).otherwise(acc))
    return written(found.withColumn("context", F.xxhash64(longest["text"])), "pages")


def wrappers(read: DataFrame) -> DataFrame:
    """(host, tree, wrapper, pages) from read_pages: the tree of a host's pages, the expression it stands for, and the number of pages.

    Pages without a host share one wrapper. Equal streams are counted before they
    are moved; a task merges FAN streams or so, and rounds go on until a host has
    no more than that. An empty table has no wrappers.
    """

    def merged(table: pa.Table) -> tuple[str, str, int]:
        found = sorted(zip(table.column("n").to_pylist(), table.column("tree").to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
        root = Node("")
        for k, (_, tree) in enumerate(found):
            root = aligned(root, unflat(tree)[0]) if k else unflat(tree)[0]
        return flat(root), expression(root), sum(x[0] for x in found)

    def some(table: pa.Table) -> pa.Table:
        tree, _, n = merged(table)
        return pa.table({"host": table.column("host").slice(0, 1), "tree": [tree], "n": pa.array([n], pa.int64())})

    def whole(table: pa.Table) -> pa.Table:
        tree, wrapper, n = merged(table)
        return pa.table({"host": table.column("host").slice(0, 1), "tree": [tree], "wrapper": [wrapper], "pages": pa.array([n], pa.int64())})

    now = written(read.groupBy("host", "tree").agg(F.count("*").alias("n")), "streams")
    while True:
        sizes = now.groupBy("host").agg(F.ceil(F.count("*") / FAN).cast("int").alias("groups")).withColumnRenamed("host", "__host")
        most = sizes.agg(F.max("groups")).first()[0] or 1
        if most <= 1:
            return now.groupBy("host").applyInArrow(whole, "host string, tree string, wrapper string, pages bigint")
        salted = now.join(sizes, F.col("host") == F.col("__host")).withColumn("salt", F.pmod(F.xxhash64("tree"), F.col("groups"))).drop("__host", "groups")
        now = written(salted.groupBy("host", "salt").applyInArrow(some, "host string, tree string, n bigint"), "streams")


def placed(read: DataFrame, found: DataFrame) -> DataFrame:
    """read with its blocks at the nodes of their wrappers, found: (host, tree). A box is the element around that of the text.

    Pages without blocks keep none; repeated rows are placed alike; no pages give no rows.
    """
    id_type, url_type = (read.schema[c].dataType.simpleString() for c in ("id", "url"))
    rows = read.select("id", "url", "host", "tree", "context", "blocks")
    size = found.agg(F.sum(F.length("host") + F.length("tree"))).first()[0] or 0
    known = None
    if size <= BROADCAST_BYTES:
        known = found.sparkSession.sparkContext.broadcast({r["host"]: r["tree"] for r in found.select("host", "tree").collect()})
        rows = rows.withColumn("wrapper", F.lit(None).cast("string"))
    else:  # a host's pages follow its wrapper, in as many partitions as salts
        salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
        nothing = {c: F.lit(None).cast(read.schema[c].dataType) for c in ("id", "url", "context", "blocks")}
        trees = found.select("host", F.col("tree").alias("wrapper"), salts.alias("salt"), F.lit(0).alias("page")).withColumns({**nothing, "tree": F.lit(None).cast("string")})
        rows = rows.withColumn("wrapper", F.lit(None).cast("string")).withColumn("salt", F.pmod(F.xxhash64("id", "url", "tree", "context"), F.lit(SALTS))).withColumn("page", F.lit(1))
        rows = trees.unionByName(rows).repartition("host", "salt").sortWithinPartitions("host", "salt", "page").select("id", "url", "host", "tree", "context", "blocks", "wrapper")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[str, Node] = {}
        where: dict[str, tuple[list[int], list[bool]]] = {}  # of the streams of a host
        kept = None
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                keep: list[int] = []
                nodes: list[int] = []
                boxes: list[int] = []
                offs: list[bool] = []
                counts = [0]
                lists = part.column(5)
                for k, (host, tree, wrapper) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), part.column(6), strict=True)):
                    if wrapper.is_valid:
                        made, kept = {host: unflat(wrapper.as_py())[0]}, None
                        continue
                    if host not in made:
                        if len(made) > 256:
                            made.clear()
                        made[host], kept = unflat(known.value[host])[0], None
                    if kept != host or len(where) > 4096:
                        where, kept = {}, host
                    if tree not in where:
                        root, own, _ = unflat(tree)
                        matched(made[host], root)
                        where[tree] = [x.at for x in own], [x.off for x in own]
                    at, off = where[tree]
                    blocks = lists[k].values
                    mine = blocks.field("node").to_numpy()
                    nodes += [at[x] for x in mine]
                    boxes += [at[x] for x in blocks.field("box").to_numpy()]
                    offs += [bool(off[x]) for x in mine]
                    counts.append(len(nodes))
                    keep.append(k)
                part = part.take(pa.array(keep, pa.int64()))
                old = part.column(5).flatten()
                new = pa.StructArray.from_arrays([pa.array(nodes, pa.int32()), pa.array(boxes, pa.int32()), pa.compute.or_(old.field("off"), pa.array(offs, pa.bool_())), old.field("links"), old.field("text")], names=["node", "box", "off", "links", "text"])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), part.column(4), pa.ListArray.from_arrays(pa.array(counts, pa.int32()), new)], names=["id", "url", "host", "context", "blocks"])

    return rows.mapInArrow(place, f"id {id_type}, url {url_type}, host string, context bigint, blocks array<{BLOCK}>")


def decisions(found: DataFrame, blocks: DataFrame) -> DataFrame:
    """(host, keep, drop, marked, fixed): ranges of wrapper nodes, whether the region is marked, and digests of the fixed texts with their nodes. A row a host, of the size of its wrapper.

    Hosts without any text keep the region that their wrapper marks, or all of it; no pages give no rows.
    """
    each = blocks.select("host", "context", F.explode("blocks").alias("b")).filter("NOT b.off AND b.text <> ''")
    each = each.select("host", "context", "b.node", "b.box", F.xxhash64("b.box", "b.text").alias("digest"), F.length("b.text").alias("chars"), "b.links")
    once = written(each.groupBy("host", "box", "digest", "node", "context").agg(F.max("chars").cast("bigint").alias("chars"), F.max("links").cast("bigint").alias("links")), "texts")
    boxes = once.select("host", "box", "context").distinct().groupBy("host", "box").agg(F.count("*").alias("pages"))
    often = once.select("host", "box", "digest", "context").distinct().groupBy("host", "box", "digest").agg(F.count("*").alias("on")).filter(F.col("on") >= FIXED_PAGES)
    fixed = written(often.join(boxes, ["host", "box"]).filter(F.col("on") >= FIXED_SHARE * F.col("pages")).select("host", "box", "digest"), "fixed")
    sums = [F.sum("chars").alias("chars"), F.sum("links").alias("links")]
    at_node = once.groupBy("host", "node").agg(*sums)
    mass = once.groupBy("host", "box", "digest", "node").agg(*sums).join(fixed, ["host", "box", "digest"])
    of_fixed = mass.groupBy("host", "node").agg(F.sum("chars").alias("f_chars"), F.sum("links").alias("f_links"))
    slots = at_node.join(of_fixed, ["host", "node"], "left").fillna(0, ["f_chars", "f_links"])
    slot = F.struct("node", (F.col("chars") - F.col("f_chars")).alias("chars"), (F.col("links") - F.col("f_links")).alias("links"), "f_chars", "f_links")
    by_host = slots.groupBy("host").agg(F.collect_list(slot).alias("slots")).join(fixed.groupBy("host").agg(F.collect_list("digest").alias("fixed")), "host", "left")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
        for batch in batches:
            keep, drop, marked = [], [], []
            for tree, slots in zip(batch.column(1), batch.column(2), strict=True):
                _, nodes, ends = unflat(tree.as_py())
                rows = slots.as_py() or []
                kept, dropped, marks = decided(nodes, ends, *({r["node"]: r[name] for r in rows} for name in ("chars", "links", "f_chars", "f_links")))
                keep.append([{"lo": a, "hi": b} for a, b in kept])
                drop.append([{"lo": a, "hi": b} for a, b in dropped])
                marked.append(marks)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keep, ranges), pa.array(drop, ranges), pa.array(marked, pa.bool_()), batch.column(3)], names=["host", "keep", "drop", "marked", "fixed"])

    both = found.select("host", "tree").join(by_host, "host", "left").select("host", "tree", "slots", F.coalesce("fixed", F.array().cast("array<bigint>")).alias("fixed"))
    return both.mapInArrow(decide, "host string, keep array<struct<lo:int,hi:int>>, drop array<struct<lo:int,hi:int>>, marked boolean, fixed array<bigint>")


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id_col, url_col, text, n_chars.

    Null and empty pages have the empty text. Pages without a host are aligned
    with each other. Repeated rows give repeated results; an empty table an
    empty one. Pages of any depth and width are walked without recursion.
    Further columns are not read.
    """
    read = read_pages(pages, id_col, url_col, html_col)
    found = written(wrappers(read), "wrappers")
    blocks = placed(read, found)
    chosen = written(decisions(found, blocks), "decisions").withColumnRenamed("host", "__host")
    size = chosen.agg(F.sum(F.length("__host") + 8 * (F.size("keep") + F.size("drop") + F.size("fixed")) + 64)).first()[0] or 0
    both = blocks.join(F.broadcast(chosen) if size <= BROADCAST_BYTES else chosen, F.col("host") == F.col("__host"), "left")
    within = lambda b, ranges: F.exists(ranges, lambda r: (r["lo"] <= b["node"]) & (b["node"] < r["hi"]))
    is_fixed = lambda b: F.array_contains("fixed", F.xxhash64(b["box"], b["text"]))
    there = F.exists("blocks", lambda b: within(b, "keep"))
    part = lambda b: F.when(~F.col("there"), ~is_fixed(b)).otherwise(within(b, "keep"))
    mine = both.withColumn("there", there).withColumn("used", F.filter("blocks", lambda b: ~b["off"] & (b["text"] != "") & ~within(b, "drop") & part(b)))
    # of an unmarked region what stands from its first slot to its last
    slots = F.filter(F.transform("used", lambda b, k: F.when(~is_fixed(b), k)), lambda k: k.isNotNull())
    cut = mine.withColumn("slots", F.when(F.col("there") & ~F.col("marked"), slots))
    used = F.when(F.col("slots").isNull(), F.col("used")).when(F.size("slots") == 0, F.slice("used", 1, 0)).otherwise(F.slice("used", F.array_min("slots") + 1, F.array_max("slots") - F.array_min("slots") + 1))
    text = F.array_join(F.transform(used, lambda b: b["text"]), "\n\n")
    return cut.select(F.col("id").alias(id_col), F.col("url").alias(url_col), text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
