"""Main text of web pages by wrapper induction.

Pages become trees of their block elements; what stands in a row under one parent with the same label
(tag, class, id, role) counts as one repeated node. Trees of the pages of one host are aligned by simple
tree matching (the largest set of pairs of equal labels that keeps parents and order) and merge into the
host's wrapper, a tree that counts for each node its pages, its characters, those in links, and whether
its text ever varied. Nodes that don't vary over pages that differ are template, and so are menus,
notices and the like by label or by their share of links. Every page is then aligned with its host's
wrapper. Of the slots that the page has, the article, or else the varying one that holds most text a page,
is content, so templates of one host don't decide for each other; the blocks of content slots are the text.

Each task merges the pages it reads, so a host of any size meets as small partial wrappers, which are
merged 64 at a time until each host has one. No page is shuffled.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, shipped

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.DOTALL)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"

# Elements of the markup language by what they mean for text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp noembed noframes iframe".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
NEVER = frozenset("script style title textarea xmp noembed noframes iframe head nav footer aside form button select option input menu dialog template noscript svg object canvas".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: A start tag ends an open element of these, if no element of the second kind is in between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
#: Words in classes, ids and roles of what is not the article.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer "
    "footer header masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted related "
    "search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget alert complementary contentinfo dialog".split()
)
ARTICLE = frozenset("article main".split())
ARTICLE_WORDS = frozenset("article main post entry story content body text".split())

#: Pages of a host, and share of them, that a text must stand in unchanged to count as template inside an article.
TEMPLATE_PAGES, TEMPLATE_SHARE = 10, 0.9
#: Share of link characters from which a slot is a menu.
LINK_SHARE = 0.6
#: Partial wrappers that one task merges.
MERGED = 64


class Node:
    """A block element: its text runs and block children in page order."""

    __slots__ = ("items", "label", "links", "tag")

    def __init__(self, tag: str, label: str):
        self.tag, self.label, self.items, self.links = tag, label, [], 0


def _label(tag: str, attributes: str) -> str:
    words = set()
    for m in _NAMED.finditer(attributes) if attributes else ():
        value = unescape(m[2] or m[3] or m[4] or "").lower()
        words.update(w for w in re.split(r"[^a-z]+", value) if w)
    return ".".join([tag, *sorted(words)])


def parse(html: str | None) -> Node:
    """The page's tree; markup that is not well-formed is repaired as browsers do in the common cases."""
    root = Node("html", "html")
    stack, run, anchors = [root], [], 0

    def flush() -> None:
        if run:
            text = " ".join(unescape("".join(run)).split())
            if text:
                stack[-1].items.append(text)
            run.clear()

    def close(to: int) -> None:
        flush()
        del stack[to:]

    html = html or ""
    at = 0
    while True:
        m = _TOKEN.search(html, at)
        piece = html[at : m.start()] if m else html[at:]
        if piece:
            run.append(piece)
            if anchors:
                stack[-1].links += len(piece)
        if m is None:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                anchors = max(anchors - 1, 0)
            elif tag not in INLINE:
                place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
                if place:
                    close(place)
            continue
        if tag in INLINE:
            if tag == "a":
                anchors += 1
            elif tag == "br":
                run.append(" ")
            continue
        anchors = 0
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(html, at)
            at = end.end() if end else len(html)
            flush()
            continue
        if tag in CLOSES_P:
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p"), 0)
            if place:
                close(place)
        if tag in ENDS:
            ended, kept = ENDS[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in kept:
                    break
                if stack[i].tag in ended:
                    close(i)
                    break
        flush()
        if tag == "html":
            continue
        node = Node(tag, _label(tag, m[3]))
        stack[-1].items.append(node)
        if tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
    close(1)
    return root


class Slot:
    """A node of a page's skeleton or of a wrapper; ``nodes`` are the page's, the counts the wrapper's."""

    __slots__ = ("chars", "children", "label", "links", "nodes", "pages", "text")

    def __init__(self, label: str):
        self.label, self.children, self.nodes = label, [], []
        self.pages, self.chars, self.links, self.text = 0, 0, 0, 0


#: A slot's text that varied.
VARIES = -1


def skeleton(nodes: list[Node]) -> Slot:
    """Nodes of one label as one slot; their children in order, equal neighbours as one."""
    slot = Slot(nodes[0].label)
    slot.nodes, slot.pages = nodes, 1
    digest = xxhash.xxh3_64()
    row: list[Node] = []
    for node in nodes:
        slot.links += node.links
        for item in node.items:
            if isinstance(item, str):
                slot.chars += len(item)
                digest.update(item.encode())
            elif row and row[0].label == item.label:
                row.append(item)
            else:
                if row:
                    slot.children.append(skeleton(row))
                row = [item]
    if row:
        slot.children.append(skeleton(row))
    slot.text = digest.intdigest() >> 2 if slot.chars else 0
    return slot


def matching(a: list[Slot], b: list[Slot]) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two rows of trees: most pairs that keep labels, parents and order, and those of the rows."""
    if [x.label for x in a] == [x.label for x in b]:
        return sum(1 + matching(x.children, y.children)[0] for x, y in zip(a, b)), [(i, i) for i in range(len(a))]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    size = [[1 + matching(x.children, y.children)[0] if x.label == y.label else 0 for y in b] for x in a]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + size[i - 1][j - 1])
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return best[-1][-1], pairs[::-1]


def merge(wrapper: Slot, other: Slot) -> None:
    """Adds a page's skeleton, or another wrapper, to a wrapper of the same label."""
    wrapper.pages += other.pages
    wrapper.chars += other.chars
    wrapper.links += other.links
    if other.text != wrapper.text:
        wrapper.text = VARIES
    _, pairs = matching(wrapper.children, other.children)
    out, i, j = [], 0, 0
    for p, q in [*pairs, (len(wrapper.children), len(other.children))]:
        out += wrapper.children[i:p] + other.children[j:q]
        if p < len(wrapper.children):
            merge(wrapper.children[p], other.children[q])
            out.append(wrapper.children[p])
        i, j = p + 1, q + 1
    wrapper.children = out


def packed(slot: Slot) -> list:
    return [slot.label, slot.pages, slot.chars, slot.links, slot.text, [packed(c) for c in slot.children]]


def unpacked(data: list) -> Slot:
    slot = Slot(data[0])
    slot.pages, slot.chars, slot.links, slot.text = data[1:5]
    slot.children = [unpacked(c) for c in data[5]]
    return slot


def never(label: str, inside: bool) -> bool:
    """Whether a label says that a node is not of the article; an article's own header may be."""
    tag, *words = label.split(".")
    if tag in NEVER or (tag == "header" and not inside):
        return True
    return not BOILERPLATE.isdisjoint(words) and tag not in ("html", "body", "main") and not (tag == "article" and "comment" not in words and "comments" not in words)


def links_of(slot: Slot) -> tuple[int, int]:
    below = [links_of(c) for c in slot.children]
    return slot.chars + sum(b[0] for b in below), slot.links + sum(b[1] for b in below)


def articles(slot: Slot) -> list[Slot]:
    """Slots below that are articles by label."""
    found = []
    for c in slot.children:
        tag, *words = c.label.split(".")
        if never(c.label, False):
            continue
        if tag in ARTICLE or "article" in words or "main" in words:
            inner = articles(c) if tag == "main" else []
            found += inner or [c]
        else:
            found += articles(c)
    return found


class Judged:
    """A host's wrapper with its article slots (those that hold text on any page) and the marks by content roots."""

    def __init__(self, wrapper: Slot):
        self.wrapper, self.varied = wrapper, _varies(wrapper)
        self.articles = frozenset(id(a) for a in articles(wrapper) if links_of(a)[0])
        self.known: dict[frozenset[int], dict[int, bool]] = {}

    def fixed(self, slot: Slot, pages: float) -> bool:
        return self.varied and slot.text not in (0, VARIES) and slot.pages >= max(TEMPLATE_PAGES, pages)

    def roots(self, page: Slot, partner: dict[int, Slot]) -> frozenset[int]:
        """Content roots of a page: the host's article slots if it has one, else the heaviest of its own slots."""
        if any(id(w) in self.articles for w in partner.values()):
            return self.articles
        weights: dict[int, float] = {}

        def weigh(slot: Slot) -> float:
            """Characters outside links, a page, of a slot and all below that the page has and that is not boilerplate."""
            w = partner.get(id(slot))
            own = 0 if w is None or self.fixed(w, 0) else max(w.chars - w.links, 0) / w.pages
            weights[id(slot)] = own + sum([weigh(c) for c in slot.children if not never(c.label, False)])
            return weights[id(slot)]

        def heaviest(slot: Slot) -> Slot:
            for c in slot.children:
                if id(c) in partner and weights.get(id(c), 0) >= 0.8 * weights[id(slot)] > 0:
                    return heaviest(c) if c.children else slot
            return slot

        weigh(page)
        return frozenset([id(partner[id(heaviest(page))])])

    def marks(self, content: frozenset[int]) -> dict[int, bool]:
        """Whether each of the wrapper's slots is dropped, as template, as boilerplate or outside the content roots."""
        if content not in self.known:
            drop: dict[int, bool] = {}

            def mark(slot: Slot, inside: bool) -> None:
                here = inside or id(slot) in content
                drop[id(slot)] = not here or (id(slot) not in content and never(slot.label, here))
                if here and not drop[id(slot)]:
                    chars, links = links_of(slot)
                    fixed = self.fixed(slot, TEMPLATE_SHARE * self.wrapper.pages)
                    tag = slot.label.split(".")[0]
                    drop[id(slot)] = (fixed and not _varies(slot)) or (tag in ("ul", "ol", "div", "section") and id(slot) not in content and chars > 0 and links >= LINK_SHARE * chars)
                for c in slot.children:
                    mark(c, here and not drop[id(slot)])

            mark(self.wrapper, False)
            self.known[content] = drop
        return self.known[content]


def _varies(slot: Slot) -> bool:
    return slot.text == VARIES or any(_varies(c) for c in slot.children)


def aligned(page: Slot, wrapper: Slot) -> dict[int, Slot]:
    """The wrapper's slots by those of a page."""
    partner: dict[int, Slot] = {}

    def align(slot: Slot, other: Slot) -> None:
        partner[id(slot)] = other
        for i, j in matching(slot.children, other.children)[1]:
            align(slot.children[i], other.children[j])

    align(page, wrapper)
    return partner


def blocks(page: Slot, root: Node, partner: dict[int, Slot], drop: dict[int, bool]) -> list[str]:
    """Texts of the page's kept nodes, in page order; slots that the wrapper lacks follow their labels and what they stand in."""
    kept: set[int] = set()

    def mark(slot: Slot, above: bool) -> None:
        w = partner.get(id(slot))
        dropped = drop[id(w)] if w is not None else above or never(slot.label, True)
        if not dropped:
            kept.update(map(id, slot.nodes))
        for c in slot.children:
            mark(c, dropped)

    mark(page, True)
    out: list[str] = []

    def read(node: Node) -> None:
        mine = id(node) in kept
        for item in node.items:
            if not isinstance(item, str):
                read(item)
            elif mine:
                out.append(item)

    read(root)
    return out


def extract(html: str | None, judged: Judged) -> str:
    """The page's main text by its host's judged wrapper."""
    root = parse(html)
    page = skeleton([root])
    partner = aligned(page, judged.wrapper)
    return "\n".join(blocks(page, root, partner, judged.marks(judged.roots(page, partner))))


def wrappers(df: DataFrame, url: str, html: str) -> DataFrame:
    """One wrapper a host, as (host, wrapper); pages without a host are of host ''."""
    host = F.lower(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")))
    source = shipped(df).select(host.alias("host"), F.col(html).cast("string").alias("html"))

    def induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Slot] = {}
        for batch in batches:
            for h, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                slot = skeleton([parse(page.as_py())])
                if h in found:
                    merge(found[h], slot)
                else:
                    _forget(slot)
                    found[h] = slot
            for slot in found.values():
                _forget(slot)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found)), pa.array([json.dumps(packed(s)) for s in found.values()])], ["host", "wrapper"])

    def together(group: pa.Table) -> pa.Table:
        parts = sorted(group.column("wrapper").to_pylist())
        first = unpacked(json.loads(parts[0]))
        for p in parts[1:]:
            merge(first, unpacked(json.loads(p)))
        return pa.table({"host": group.column("host").slice(0, 1), "wrapper": [json.dumps(packed(first))]})

    parts = checkpointed(source.mapInArrow(induce, "host string, wrapper string"))
    while True:
        most = parts.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return parts
        dealt = parts.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(-(-most // MERGED))))
        parts = checkpointed(dealt.groupBy("host", "part").applyInArrow(lambda t: together(t), "host string, wrapper string"))


def _forget(slot: Slot) -> None:
    """Lets go of a page's nodes."""
    slot.nodes = []
    for c in slot.children:
        _forget(c)


#: Hosts whose wrappers are broadcast at most; more are joined by a shuffle.
BROADCAST_HOSTS = 5_000


def main_text(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: page_id, url, text and n_chars (its code points).

    Character references are decoded, white space inside a block becomes one blank, and blocks are joined
    by line ends in page order. A NULL or empty page, or one without an article, has an empty text; pages
    without a host share one wrapper; repeated rows get equal texts; a NULL key or address stays NULL.
    Other columns are left out, and an empty table gives no rows.
    """
    known = wrappers(df, url, html)
    host = F.lower(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")))
    source = df.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"), host.alias("host"))
    kind = source.schema["page_id"].dataType.simpleString()
    known = F.broadcast(known) if known.count() <= BROADCAST_HOSTS else known
    joined = source.join(known, "host").select("page_id", "url", "html", "host", "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judged: dict[str, Judged] = {}
        for batch in batches:
            texts = []
            for page, h, wrapper in zip(batch.column(2), batch.column(3), batch.column(4)):
                name = h.as_py()
                if name not in judged:
                    if len(judged) >= 1000:
                        judged.clear()
                    judged[name] = Judged(unpacked(json.loads(wrapper.as_py())))
                texts.append(extract(page.as_py(), judged[name]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
