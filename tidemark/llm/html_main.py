"""Main text of web pages by wrapper induction over the pages of a host.

Pages are range-partitioned and sorted by host and a hash of their id, so a
host of any size is split over many tasks while a small host stays together;
each task streams through its rows and works on one run of same-host pages at
a time (ended by a hash value about every 64 pages, by 256 pages or by 4
million characters), which bounds its memory. No page is left out.

For each run the DOM trees are aligned by simple tree matching. Neighbouring
children of one kind (tag, class, id) are first folded into one repeated slot,
so the size of a tree follows the page's layout and not its length; matching is
done once for each distinct layout. The aligned nodes form the host's template.
Every template node gathers, over the pages: how much text it held that varies
between pages, how much of it in links, and how often its text was the same.

- A node whose text hardly ever changes is template; it goes unless it
  encloses the content.
- Among the varying slots the content is the smallest container that holds
  most of the varying text outside links (an ``article`` or ``main`` node, if the
  layout has one that holds text).
- Slots that are boilerplate by their tag, role, class or id go: menus,
  headers, footers, side bars, notices, adverts, forms, comments, scripts, styles.

Defined results: null or empty html, or a page without main text, gives the
empty string; text without any markup is itself the main text; a null or odd
URL belongs to the host ''; repeated rows give repeated results and count once
for the template; other columns aren't read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow

RUN_PAGES, RUN_CHARS, RUN_BREAK = 256, 4_000_000, 64
SAME_SHARE, SAME_PAGES = 0.9, 8
MAIN_SHARE = 0.6

# HTML element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
BLOCK = frozenset(
    "address article aside blockquote body br dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("br body html dd dt li tbody td tfoot th thead tr summary".split())
SECTIONS = frozenset("html body div section article main table tbody tr td center".split())
DROP_TAGS = frozenset("head nav footer aside form script style noscript template iframe svg button select textarea menu dialog object canvas audio video title".split())
DROP_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|menu|nav|navbar|navigation|breadcrumbs?|header|masthead|footer|side-?bar|aside|cookies?|consent|notice|popup|modal|overlay|newsletter|subscribe|social|share|sharing|related|recommend\w*|comments?|commentlist|respond|replies|reply|disqus|widget|toolbar|paginat\w*|pager|copyright|login|signup|search|skip)(?:$|[\s_-])",
    re.I,
)
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
SAME_ONLY = frozenset("li dt dd td th tr option p".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'](?=[^\"']*+>))*+)>|<[!?][^>]*>",
    re.S,
)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


class Node:
    __slots__ = ("tag", "name", "role", "kids", "slot")

    def __init__(self, tag: str, name: str = "", role: str = ""):
        self.tag, self.name, self.role, self.kids, self.slot = tag, name, role, [], None

    def kind(self) -> tuple[str, str]:
        return self.tag, self.name

    def dropped(self, inside: bool) -> bool:
        """Boilerplate by tag, role, class or id; ``inside``: within an article, whose header holds its title."""
        if self.tag in DROP_TAGS or self.role in DROP_ROLES:
            return True
        if self.tag == "header":
            return not inside
        return self.tag not in ("html", "body", "main", "article") and bool(self.name) and bool(DROP_NAME.search(self.name))


def parse(html: str) -> Node:
    """A tolerant DOM tree: text nodes are decoded strings among ``kids``."""
    root = Node("#root")
    stack = [root]
    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        end = m.start() if m else n
        if end > at:
            stack[-1].kids.append(unescape(html[at:end]))
        if not m:
            break
        at = m.end()
        if not m["name"]:
            continue
        tag = m["name"].lower()
        if m["close"]:
            if any(x.tag == tag for x in reversed(stack)):
                while stack[-1].tag != tag:
                    stack.pop()
                stack.pop()
            elif tag == "p":
                stack[-1].kids.append(Node("p"))
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in SECTIONS:
                    break
        elif tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            like = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in like:
                    del stack[i:]
                    break
                if stack[i].tag in ("ul", "ol", "dl", "table", "select", "tr" if tag in ("td", "th") else "table"):
                    break
        name, role = "", ""
        if m["attrs"]:
            for a in _ATTR.finditer(m["attrs"]):
                value = a[2] or a[3] or a[4] or ""
                if a[1].lower() == "role":
                    role = value.lower()
                elif a[1].lower() in ("class", "id"):
                    name = f"{name} {value}".strip()
        node = Node(tag, name, role)
        stack[-1].kids.append(node)
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            stop = close.start() if close else n
            if tag in ("title", "textarea"):
                node.kids.append(unescape(html[at:stop]))
            at = close.end() if close else n
        elif tag not in VOID and not m["attrs"].rstrip().endswith("/"):
            stack.append(node)
    return root


class Slot:
    """A template node: children, and what its nodes held on the pages of the run."""

    __slots__ = ("kind", "kids", "pages", "texts", "plain", "linked")

    def __init__(self, kind: tuple[str, str]):
        self.kind, self.kids, self.pages, self.texts, self.plain, self.linked = kind, [], 0, {}, 0, 0


def folded(node: Node) -> list[tuple[tuple[str, str], list[Node]]]:
    """The element children, neighbours of one kind as one slot."""
    out: list[tuple[tuple[str, str], list[Node]]] = []
    for k in node.kids:
        if isinstance(k, Node) and k.tag not in ("br", "b", "i", "em", "strong", "span", "u", "small", "font"):
            if out and out[-1][0] == k.kind():
                out[-1][1].append(k)
            else:
                out.append((k.kind(), [k]))
    return out


def layout(nodes: list[Node], depth: int = 0) -> tuple:
    """The folded layout below a slot (of the children of all its nodes, by first appearance)."""
    if depth > 40:
        return ()
    groups: dict[tuple[str, str], list[Node]] = {}
    for node in nodes:
        for kind, kids in folded(node):
            groups.setdefault(kind, []).extend(kids)
    return tuple((kind, layout(kids, depth + 1)) for kind, kids in groups.items())


def weight(tree: tuple, slot: Slot, memo: dict) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of a layout's children with a slot's: size of the largest match that keeps order, and its pairs."""
    key = (id(tree), id(slot))
    if key in memo:
        return memo[key]
    a, b = tree, slot.kids
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    gain = [[0] * len(b) for _ in a]
    for i, (kind, below) in enumerate(a):
        for j, other in enumerate(b):
            if kind == other.kind:
                gain[i][j] = 1 + weight(below, other, memo)[0]
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + gain[i][j])
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if gain[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + gain[i - 1][j - 1]:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    memo[key] = best[len(a)][len(b)], pairs[::-1]
    return memo[key]


def align(tree: tuple, slot: Slot, memo: dict) -> dict:
    """Map the children of a layout to slots; children without a partner become new slots after their left neighbour."""
    _, pairs = weight(tree, slot, memo)
    to = {i: slot.kids[j] for i, j in pairs}
    last = None
    for i, (kind, _) in enumerate(tree):
        if i not in to:
            new = Slot(kind)
            slot.kids.insert(slot.kids.index(last) + 1 if last else 0, new)
            to[i] = new
        last = to[i]
    return {kind: (to[i], align(below, to[i], memo)) for i, (kind, below) in enumerate(tree)}


def place(nodes: list[Node], mapped: dict) -> None:
    for node in nodes:
        for kind, kids in folded(node):
            if kind in mapped:
                slot, below = mapped[kind]
                for k in kids:
                    k.slot = slot
                place(kids, below)


def induce(pages: list[Node]) -> Slot:
    """The template of the pages; every node of the trees gets its slot."""
    top, seen = Slot(("#root", "")), {}
    for page in pages:
        tree = layout([page])
        if tree not in seen:
            seen[tree] = align(tree, top, {})
        page.slot = top
        place([page], seen[tree])
    for number, page in enumerate(pages):
        _measure(page, number)
    return top


_MOD, _STEP = (1 << 61) - 1, 1_000_003


def _measure(page_root: Node, page: int) -> None:
    """Add to every node's slot the characters below it outside and inside links, and on this page a hash of the
    sequence of its texts. Goes through the tree with a stack of its own, so any depth will do; the hash of a
    sequence is made of those of its parts, so no node's texts are gone through twice."""
    # node, inside a link, next child, hash and number of the texts so far, characters outside and inside links
    stack: list[list] = [[page_root, page_root.tag == "a", 0, 0, 0, 0, 0]]
    while stack:
        top = stack[-1]
        node = top[0]
        if top[2] < len(node.kids):
            k = node.kids[top[2]]
            top[2] += 1
            if isinstance(k, str):
                t = k.strip()
                if t:
                    top[3], top[4] = (top[3] * _STEP + hash(t)) % _MOD, top[4] + 1
                    top[6 if top[1] else 5] += len(t)
            elif k.tag not in DROP_TAGS or k.tag in ("nav", "footer", "aside", "form"):
                stack.append([k, top[1] or k.tag == "a", 0, 0, 0, 0, 0])
            continue
        stack.pop()
        _, _, _, texts, n, plain, link = top
        if node.slot is not None:
            s = node.slot
            s.plain += plain
            s.linked += link
            s.texts[page] = hash((s.texts.get(page), texts, n))
        if stack:
            above = stack[-1]
            above[3], above[4] = (above[3] * pow(_STEP, n, _MOD) + texts) % _MOD, above[4] + n
            above[5] += plain
            above[6] += link


def constant(slot: Slot) -> bool:
    """Whether the slot's text is the same on nearly all of at least SAME_PAGES pages."""
    n = len(slot.texts)
    if n < SAME_PAGES or not slot.plain + slot.linked or slot.kind[0] in SAME_ONLY:
        return False
    counts: dict[int, int] = {}
    for h in slot.texts.values():
        counts[h] = counts.get(h, 0) + 1
    return max(counts.values()) >= SAME_SHARE * n


def content_slot(top: Slot) -> Slot:
    """The smallest container slot that holds most of the varying text outside links."""
    named = []
    todo = [top]
    while todo:
        s = todo.pop()
        if s.kind[0] in ("article", "main") and s.plain:
            named.append(s)
        if s.kind[0] not in DROP_TAGS and not DROP_NAME.search(s.kind[1] or "#"):
            todo += s.kids
    if named:
        return max(named, key=lambda s: (s.plain, s.kind[0] == "article"))
    at = top
    while True:
        open_kids = [s for s in at.kids if s.kind[0] in SECTIONS and not DROP_NAME.search(s.kind[1] or "#") and not constant(s)]
        best = max(open_kids, key=lambda s: s.plain - s.linked, default=None)
        total = sum(s.plain for s in at.kids if s.kind[0] not in DROP_TAGS and not DROP_NAME.search(s.kind[1] or "#") and not constant(s))
        if best is None or best.plain < MAIN_SHARE * max(total, 1):
            return at
        at = best


def text_of(page: Node, main: Slot) -> str:
    """Text of the nodes of the main slot, without boilerplate and constant slots; of the whole page if it lacks that slot."""
    found, todo = [], [(page, False)]
    while todo:
        node, inside = todo.pop()
        if node.slot is main:
            found.append((node, node.tag == "article"))
            continue
        if node.dropped(inside):
            continue
        todo += [(k, inside or node.tag == "article") for k in reversed(node.kids) if isinstance(k, Node)]
    out: list[str] = []
    stack: list = [(x, inside) for x, inside in reversed(found or [(page, False)])]
    fresh = True
    while stack:
        item, inside = stack.pop()
        if isinstance(item, str):
            out.append(item)
            continue
        if not fresh and (item.dropped(inside) or item.slot is not None and item.slot is not main and constant(item.slot)):
            if item.tag in BLOCK:
                out.append(" ")
            continue
        fresh = item.tag in ("#root", "html", "body")
        inside = inside or item.tag == "article"
        if item.tag in BLOCK:
            out.append(" ")
            stack.append((" ", inside))
        stack += [(k, inside) for k in reversed(item.kids)]
    return " ".join("".join(out).split())


def extract_run(htmls: list[str | None]) -> list[str]:
    """Main texts of one run of same-host pages."""
    trees = {h: parse(h) for h in dict.fromkeys(h for h in htmls if h)}
    top = induce(list(trees.values()))
    main = content_slot(top)
    texts = {h: text_of(tree, main) for h, tree in trees.items()}
    return [texts[h] if h else "" for h in htmls]


def host(url: str = "url") -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


SCHEMA = "page_id long, url string, text string, n_chars long"


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    chars, current = 0, None

    def flush() -> pa.RecordBatch:
        texts = extract_run([r[2] for r in rows])
        out = arrow(SCHEMA, {"page_id": [r[0] for r in rows], "url": [r[1] for r in rows], "text": texts, "n_chars": [len(t) for t in texts]})
        rows.clear()
        return out

    for batch in batches:
        for page_id, url, html, name, mark in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and (name != current or len(rows) >= RUN_PAGES or chars >= RUN_CHARS or mark % RUN_BREAK == 0):
                yield flush()
                chars = 0
            current = name
            rows.append((page_id, url, html))
            chars += len(html or "")
    if rows:
        yield flush()


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages(page_id, url, html)``."""
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host().alias("host"), F.xxhash64("page_id", "url").alias("mark"))
    return rows.repartitionByRange(n, "host", "mark").sortWithinPartitions("host", "mark", "page_id").mapInArrow(_extract, SCHEMA)
