"""Main text of HTML pages by site style trees.

A page is parsed once, to pieces of text and the container elements around them. Pages of a host are merged into one
tree whose nodes are paths of container elements (tag, id and classes; nameless ones and table cells by their number
among like ones). For each node the merged pages give two entropies, both over log(pages with the node): of the child
sequences (presentation) and of the text below (content). With l kinds of child sequence its importance is
(1 - g**l) * presentation + g**l * content, g = 0.9; a node of one page has importance 1. Pages of a host with one and
the same text count as one page, so copies make nothing unimportant. A branch is removed if it is on ``at_pages`` pages
or more and its importance, the entropy of its text and those of all nodes below are under ``least``; so text that
differs from page to page stays, however many pages or layouts the host has. Paths that hold an article or main element
on any page of the host never are removed, and a page that would be left without any text keeps its branches.

What a page says of itself is prior knowledge of importance, and enters as importance 0 on that page:

* navigation, footers, asides, menus, dialogs, buttons, hidden elements and such roles, unless they hold an article or
  main element (a wrapper that was never closed, or misused);
* containers named as adverts, consent notices, popups, sharing bars or reader comments, unless they hold an article,
  main or h1 element. A name counts whole, with only neutral words beside it: ``ad-slot`` and ``comment-list`` do,
  ``has-comments``, ``notice-of-law`` or ``related-law`` do not;
* forms, headers outside of articles (also by name: an article's own header holds its title), containers named as menus, sidebars, notices and the like, and containers outside
  of articles whose text is nearly all links (three or more), unless they hold an article or main element or more than
  half of the page's other text (a form around the whole page is no form of it).

Of what is left, articles alone are the main text if they hold half of what is in main and article elements and a fifth
of all; else main elements if they hold a fifth of all; else everything.

The tree is never built in one place: parsed pages (their pieces compressed) are a written table, and counts of (host, path, children, text) are
grouped by key with partial sums, the page's text among the keys, so a host with a third of all pages is no one's task.
Removed paths come back to pages by joins on (host, path) and on the page's place in the table.

Text: character references are decoded, white space inside a block is one space, blocks are trimmed and joined by one
line feed; ``br`` and table cells are white space, other block elements end blocks, inline elements neither.

Defined results: null or empty html gives empty text; a null url is the host ''; broken markup never fails, an
unfinished tag at the end is dropped; very long pages are read whole, and containers nested deeper than 64 count to the
64th; repeated rows get equal results; ties do not occur; an empty table gives an empty result; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import materialize, positioned, ship

#: Elements without content of their own, with raw content, of the block kind.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template", "svg", "math", "object", "select"}
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
CELLS = {"td", "th"}
SPACE = {"br", "wbr"}
MAIN = {"article", "main"}
CLOSES_P = BLOCK - {"body", "html", "head", "caption", "legend", "tbody", "tfoot", "thead", "tr", "summary"}
#: Elements and roles that are no main text: always, or unless most of the page is in them.
NOISE, SOFT_NOISE = {"nav", "footer", "aside", "head", "menu", "dialog"}, {"form", "header"}
ROLES = {"navigation", "contentinfo", "complementary", "dialog", "alertdialog", "menu", "menubar"}
SOFT_ROLES = {"banner", "search", "alert", "form"}
#: Words of names for what is never main text, for what is around it, and neutral words beside them.
LOUD = set("ad ads adbox advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promoted cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription social share sharing comment comments commentlist disqus".split())
QUIET = set("banner notice notices notification notifications alert sidebar aside widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs header footer masthead topbar toolbar respond replies related recommended pagination pager login signup search skip".split())
NEUTRAL = set("site page main top bottom left right global primary secondary area bar block box container content unit wrapper wrap section list inner outer slot item items link links user reader readers col column layer article articles post posts entry story stories reads".split())
#: Of them, those that an article may have of its own: they hold its title.
OWN_HEAD = {"header", "masthead"}
#: Containers that are nodes of the tree even without a name.
NODES = set("div section article main ul ol dl nav aside header footer table form figure td th body fieldset".split())
DEEPEST = 64

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_PART = re.compile(r"[a-z0-9]+")
_END = re.compile(r"<[a-zA-Z/!?][^>]*\Z", re.S)
_NUMBER = re.compile(r"\d{3,}")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _said(names: str, inside: bool) -> int:
    """What class and id names say: 2 adverts, notices of consent, comments; 1 what stands around main text; 0 nothing."""
    most, quiet = 0, QUIET - OWN_HEAD if inside else QUIET
    for name in names.split():
        parts = {p.rstrip("0123456789") for p in _PART.findall(_CAMEL.sub("-", name).lower())} - {""}
        if parts and parts <= LOUD | quiet | NEUTRAL:
            most = max(most, 2 if parts & LOUD else 1 if parts & quiet else 0)
    return most


def _traits(tag: str, attributes: str, inside: bool) -> tuple[str, int]:
    """The element's name in paths ('': none of its own), and its noise: 0 none, 1 soft, 2 loud by name, 3 by kind.

    ``inside``: it stands in an article or main element.
    """
    noise = 3 if tag in NOISE else 1 if tag in SOFT_NOISE else 0
    if not attributes or not attributes.strip():
        return "", noise
    found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
    if not found:
        return "", noise
    names = f"{found.get('class', '')} {found.get('id', '')}"
    role = found.get("role", "").lower()
    if role in ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        noise = 3
    elif tag not in ("body", "html"):
        noise = max(noise, _said(names, inside), 1 if role in SOFT_ROLES else 0)
    return ".".join(sorted({_NUMBER.sub("0", w) for w in _PART.findall(names.lower())})), noise


class Element:
    """An open or closed element: its path, place among the pieces, and what it holds."""

    __slots__ = ("tag", "node", "first", "end", "noise", "holds", "heads", "links", "kind", "inline", "skip", "like", "depth")

    def __init__(self, tag: str, node: int, first: int, noise: int, kind: int, inline: bool, skip: bool, depth: int):
        self.tag, self.node, self.first, self.end, self.noise, self.kind, self.inline, self.skip, self.depth = tag, node, first, -1, noise, kind, inline, skip, depth
        self.holds = self.heads = False
        self.links, self.like = 0, None


class Page:
    """Pieces of text that are not noise by the page's own word, and its nodes.

    ``pieces``: (text, node, kind: 2 in article, 1 in main, 0 elsewhere, block number); ``nodes``: path digest, digests
    of the child sequence and of the text below, digests of the paths above; ``holders``: paths over article or main.
    """

    def __init__(self, html: str):
        self._pieces: list[tuple[str, int, int, int, int]] = []  # text, node, kind, block, characters in links
        self._paths: list[int] = [0]  # path digest of each node; node 0 is the page
        self._up: list[int] = [-1]
        self._children: list[list[str]] = [[]]
        self._known: dict[tuple[int, str], int] = {}
        self._elements: list[Element] = []
        self._stack: list[Element] = [Element("", 0, 0, 0, 0, False, False, 0)]
        self._text: list[str] = []
        self._linked, self._link, self._links, self._block = 0, False, 0, 0
        self._walk(html)
        self._settle()

    # --- reading

    def _cut(self) -> None:
        """Ends a piece (not its block)."""
        if self._text:
            joined = " ".join(entities.unescape("".join(self._text)).split())
            self._text.clear()
            if joined:
                top = self._stack[-1]
                self._pieces.append((joined, top.node, top.kind, self._block, min(self._linked, len(joined))))
        self._linked = 0

    def _flush(self) -> None:
        self._cut()
        self._block += 1

    def _say(self, text: str) -> None:
        if not self._stack[-1].skip:
            self._text.append(text)
            if self._link:
                self._linked += len(text)

    def _push(self, tag: str, name: str, noise: int) -> None:
        top = self._stack[-1]
        kind = max(top.kind, 2 if tag == "article" else 1 if tag == "main" else 0)
        if noise < 3 and (tag == "header" and top.kind or tag in MAIN and top.kind < 2):
            noise = 0
        node = top.node
        if (tag in NODES or name) and tag not in ("html", "body") and top.depth < DEEPEST:
            label = f"{tag}.{name}" if name else tag
            if not name or tag in CELLS:
                top.like = top.like or {}
                top.like[tag] = nth = top.like.get(tag, 0) + 1
                label = f"{label}:{nth}"
            self._children[node].append(f"{tag}.{name}" if name else tag)
            key = (node, label)
            if key not in self._known:
                self._known[key] = len(self._paths)
                self._paths.append(digest(f"{self._paths[node]}/{label}"))
                self._up.append(node)
                self._children.append([])
            node = self._known[key]
        else:
            self._children[node].append(tag)
        if tag in MAIN or tag == "h1":
            for x in reversed(self._stack):
                if x.holds or x.heads and tag not in MAIN:
                    break  # and so is what is above
                x.holds, x.heads = tag in MAIN, True
        x = Element(tag, node, len(self._pieces), noise, kind, False, top.skip, top.depth + (node != top.node))
        x.links = -self._links
        self._elements.append(x)
        self._stack.append(x)

    def _pop_to(self, i: int) -> None:
        for x in self._stack[i:]:
            x.end = len(self._pieces)
            x.links += self._links
        del self._stack[i:]

    def _close(self, tag: str) -> None:
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i].tag == tag:
                self._pop_to(i)
                return

    def _walk(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            m = _TOKEN.search(html, at)
            if m is None:
                rest = html[at:]
                if unfinished := _END.search(rest):
                    rest = rest[: unfinished.start()]
                self._say(rest)
                break
            if m.start() > at:
                self._say(html[at : m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            closing, attributes = m[1] or m[4], (m[3] if m[2] else m[6]) or ""
            if tag in SPACE:
                self._say(" ")
            elif tag in RAW:
                if not closing and not attributes.endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                    at = end.end() if end else size
                self._say(" " if tag in ("iframe", "object") else "")
            elif tag in BLOCK:
                self._block_tag(tag, closing, attributes)
            elif tag in CELLS:
                self._cell(tag, closing, attributes)
            else:
                self._inline(tag, closing, attributes)
        self._flush()
        self._pop_to(1)

    def _block_tag(self, tag: str, closing: str, attributes: str) -> None:
        self._flush()
        if closing:
            self._close(tag)
            return
        top = self._stack[-1]
        if tag in CLOSES_P and top.tag == "p" or tag == "li" and top.tag == "li" or tag == "tr" and top.tag in CELLS:
            self._pop_to(len(self._stack) - 1)
        if tag not in VOID and not attributes.endswith("/"):
            self._push(tag, *_traits(tag, attributes, self._stack[-1].kind > 0))

    def _cell(self, tag: str, closing: str, attributes: str) -> None:
        """A table cell is a node of its own, but its text stays in the row's block."""
        self._cut()
        if closing:
            self._close(tag)
        else:
            if self._stack[-1].tag in CELLS:
                self._pop_to(len(self._stack) - 1)
            self._push(tag, *_traits(tag, attributes, self._stack[-1].kind > 0))

    def _inline(self, tag: str, closing: str, attributes: str) -> None:
        if tag == "a":
            self._link = not closing
            self._links += not closing
        if closing:
            if self._stack[-1].inline and self._stack[-1].tag == tag:
                self._stack.pop()
        elif not attributes.endswith("/") and tag not in VOID and (tag == "button" or (attributes and _traits(tag, attributes, self._stack[-1].kind > 0)[1] > 1)):
            top = self._stack[-1]
            self._stack.append(Element(tag, top.node, len(self._pieces), 0, top.kind, True, True, top.depth))

    # --- deciding what the page itself says

    def _settle(self) -> None:
        pieces, n = self._pieces, len(self._pieces)
        gone = [False] * n
        sums: list[list[int]] = []

        def inside(x: Element) -> tuple[int, int]:
            """Characters of text, and of links, that are left in an element."""
            if x.end - x.first < 256:
                left = [pieces[i] for i in range(x.first, x.end) if not gone[i]]
                return sum(len(p[0]) for p in left), sum(p[4] for p in left)
            if not sums:
                for value in ([len(p[0]) for p in pieces], [p[4] for p in pieces]):
                    sums.append([0, *accumulate(0 if g else v for v, g in zip(value, gone))])
            return sums[0][x.end] - sums[0][x.first], sums[1][x.end] - sums[1][x.first]

        for x in self._elements:
            if x.noise == 3 and not x.holds or x.noise == 2 and not x.heads:
                gone[x.first : x.end] = [True] * (x.end - x.first)
        total = sum(len(p[0]) for p, g in zip(pieces, gone) if not g)
        for x in self._elements:
            linking = x.links >= 3 and not x.kind and x.tag in NODES
            if x.holds or (x.kind and x.heads) or not (x.noise or linking):
                continue
            text, linked = inside(x)
            if text and 2 * text <= total and (x.noise or linked >= 0.8 * text):
                gone[x.first : x.end] = [True] * (x.end - x.first)
                sums.clear()
        self.pieces = [p[:4] for p, g in zip(pieces, gone) if not g]
        held = {x.node for x in self._elements if x.holds or x.tag in MAIN}
        self.holders = set()
        for node in held:
            while node > 0:
                self.holders.add(self._paths[node])
                node = self._up[node]
        below: dict[int, list[str]] = {}
        for text, node, _, _ in self.pieces:
            while node > 0:
                below.setdefault(node, []).append(text)
                node = self._up[node]
        self.nodes = [(self._paths[k], digest(",".join(dict.fromkeys(self._children[k]))), digest("\n".join(texts)), self._above(k)) for k, texts in below.items()]
        self._place = {k: i for i, k in enumerate(below)}

    def _above(self, node: int) -> list[int]:
        out = []
        while (node := self._up[node]) > 0:
            out.append(self._paths[node])
        return out

    def placed(self) -> list[tuple[str, int, int, int]]:
        """Pieces with the number of their node in ``nodes`` (-1: none)."""
        return [(text, self._place.get(node, -1), kind, block) for text, node, kind, block in self.pieces]

    def text(self) -> str:
        """The page's text without knowledge of its site."""
        return joined([p[0] for p in self.pieces], [p[2] for p in self.pieces], [p[3] for p in self.pieces])


def joined(texts: list[str], kinds: list[int], blocks: list[int]) -> str:
    """The main text of pieces: of articles, of main elements or of all (see the module), pieces of a block by a space."""
    everything = sum(map(len, texts))
    article = sum(len(t) for t, k in zip(texts, kinds) if k == 2)
    main = sum(len(t) for t, k in zip(texts, kinds) if k)
    least = 2 if article and 2 * article >= main and 5 * article >= everything else 1 if main and 5 * main >= everything else 0
    out: list[str] = []
    last = None
    for t, k, b in zip(texts, kinds, blocks):
        if k >= least:
            out += [" " if b == last else "\n", t] if out else [t]
            last = b
    return "".join(out)


def digest(text: str) -> int:
    """A signed 64-bit hash of a string."""
    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def host_of(url: str | None) -> str:
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


_NODE = pa.struct([("path", pa.int64()), ("children", pa.int64()), ("words", pa.int64()), ("up", pa.list_(pa.int64()))])
_PARSED = "host long, page long, holders array<long>, nodes array<struct<path: long, children: long, words: long, up: array<long>>>, pieces binary"


def packed(pieces: list[tuple[str, int, int, int]], pack: zstandard.ZstdCompressor) -> bytes:
    """Pieces as compressed bytes: their number, then their nodes, kinds, blocks and sizes as ints, then their text."""
    texts = [p[0].encode("utf-8", "surrogatepass") for p in pieces]
    numbers = np.array([[p[1], p[2], p[3], len(t)] for p, t in zip(pieces, texts)], "<i4").reshape(-1, 4)
    return pack.compress(np.int32(len(texts)).astype("<i4").tobytes() + numbers.T.tobytes() + b"".join(texts))


def unpacked(body: bytes, unpack: zstandard.ZstdDecompressor) -> tuple[list[str], list[int], list[int], list[int]]:
    """Texts, nodes, kinds and blocks of packed pieces."""
    raw = unpack.decompress(body)
    n = int.from_bytes(raw[:4], "little")
    nodes, kinds, blocks, sizes = np.frombuffer(raw, "<i4", 4 * n, 4).reshape(4, n)
    ends = (4 + 16 * n + np.concatenate(([0], np.cumsum(sizes)))).tolist()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])], nodes.tolist(), kinds.tolist(), blocks.tolist()


def parsed_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, host and page (digests of the host's name and the page's text), holders, nodes and packed pieces: one row a page."""
    ship(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for whole in batches:
            for at in range(0, whole.num_rows, 64):  # few pages at once, so that a batch of long ones stays small
                batch = whole.slice(at, 64)
                urls = batch.column(1).to_pylist()
                found = [Page(h or "") for h in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:2],
                        pa.array([digest(host_of(u)) for u in urls], pa.int64()),
                        pa.array([digest(p.text()) for p in found], pa.int64()),
                        pa.array([sorted(p.holders) for p in found], pa.list_(pa.int64())),
                        pa.array([p.nodes for p in found], pa.list_(_NODE)),
                        pa.array([packed(p.placed(), pack) for p in found], pa.binary()),
                    ],
                    names=["page_id", "url", "host", "page", "holders", "nodes", "pieces"],
                )

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, {_PARSED}")


def style_nodes(parsed: DataFrame) -> DataFrame:
    """host, path, children, words, n: how many different page texts of a host have this node with these children and this text."""
    rows = parsed.select("host", "page", F.explode("nodes").alias("x"))
    once = rows.groupBy("host", F.col("x.path").alias("path"), "page").agg(F.min(F.struct("x.children", "x.words")).alias("x"))
    return once.groupBy("host", "path", "x.children", "x.words").agg(F.count(F.lit(1)).alias("n"))


def importance(nodes: DataFrame, decay: float = 0.9) -> DataFrame:
    """host, path, pages, importance, e_words (the entropy of its text) of every node of the merged trees."""

    def entropy(kind: str) -> DataFrame:
        by = nodes.groupBy("host", "path", kind).agg(F.sum("n").alias("n"))
        agg = by.groupBy("host", "path").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log2("n")).alias("s"), F.count(F.lit(1)).alias("kinds"))
        value = F.when(F.col("pages") <= 1, 1.0).otherwise((F.log2("pages") - F.col("s") / F.col("pages")) / F.log2("pages"))
        return agg.select("host", "path", "pages", "kinds", value.alias(f"e_{kind}"))

    both = entropy("children").join(entropy("words").drop("pages", "kinds"), ["host", "path"])
    fade = F.pow(F.lit(decay), F.col("kinds"))
    return both.select("host", "path", "pages", ((1 - fade) * F.col("e_children") + fade * F.col("e_words")).alias("importance"), "e_words")


def low_branches(parsed: DataFrame, least: float = 0.2, at_pages: int = 10) -> DataFrame:
    """host, path of the branches to remove: nothing in them reaches ``least``, and they hold no article or main."""
    scored = materialize(importance(style_nodes(parsed)), "scored")
    is_low = (F.col("importance") < least) & (F.col("e_words") < least)
    node = parsed.select("host", F.explode("nodes").alias("x")).select("host", "x.path", F.explode("x.up").alias("other")).distinct()
    kept = scored.where(~is_low).select("host", "path").join(node, ["host", "path"]).select("host", F.col("other").alias("path"))
    kept = kept.union(parsed.select("host", F.explode("holders").alias("path"))).distinct()
    return scored.where(is_low & (F.col("pages") >= at_pages)).select("host", "path").join(kept, ["host", "path"], "left_anti")


def main_text(pages: DataFrame, least: float = 0.2, at_pages: int = 10) -> DataFrame:
    """page_id, url, text, n_chars and removed (how many pieces of text the style tree removed) of all pages."""
    kind = pages.schema["page_id"].dataType.simpleString()
    parsed = materialize(parsed_pages(pages), "parsed")
    low = materialize(low_branches(parsed, least, at_pages), "low")
    placed, file, row = positioned(parsed)
    on_pages = placed.select(file, row, "host", F.explode("nodes.path").alias("path")).join(low, ["host", "path"])
    # a page's own paths at most; written, so that its size is known when the join to pages is planned
    gone = materialize(on_pages.groupBy(file, row).agg(F.collect_set("path").alias("gone")), "gone")
    rows = placed.join(gone, [file, row], "left").select("page_id", "url", "pieces", F.transform("nodes", lambda x: F.struct(x["path"], x["up"])).alias("nodes"), "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts, removed = [], []
                for body, nodes, low in zip(*(batch.column(i) for i in (2, 3, 4))):
                    text, places, kinds, blocks = unpacked(body.as_py(), unpack)
                    removed.append(0)
                    if low.is_valid:
                        off = set(low.as_py())
                        out = [x["path"] in off or not off.isdisjoint(x["up"]) for x in nodes.as_py()]
                        stay = [i for i, k in enumerate(places) if k < 0 or not out[k]]
                        if stay:
                            removed[-1] = len(text) - len(stay)
                            text, kinds, blocks = ([x[i] for i in stay] for x in (text, kinds, blocks))
                    texts.append(joined(text, kinds, blocks))
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int32())], names=["page_id", "url", "text", "n_chars", "removed"])

    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, removed int")
