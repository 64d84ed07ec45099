"""Main text of web pages by wrapper induction.

Every page of a host is parsed to a tree and aligned with the host's first page (by page id, of those with text) by simple tree
matching. Nodes without boxes that have equal text in nearly all pages they are aligned in are template, the others are slots. The wrapper of a host is the path to the smallest container
that holds nearly all slot text outside marked furniture, summed over all pages that have it; pages of equal text count once. Sums and counts are made by host and node of the first page,
so no task needs a host's pages together. Constant blocks are counted over all pages of a host, too. A block is constant if at least `ALIKE` pages of different text have it and they are at least the share `CONSTANT` of the host's, or of those of one
template of the host (the boxes next to the body); where such blocks are a third or more of all text they are taken for content, so pages
that are copies of each other lose nothing. Every page of the host is then read through the wrapper: blocks of the container, without furniture (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments: by element, role or class; within an article only by names that are marks as a whole, and its
header stays) and constant blocks. Where the path isn't there, the page's
article, main or body element is the container.

Null, empty or unparsable pages have an empty text; pages without a host share one wrapper; rows with equal ids are read one by one;
other columns are not read. A page of any length is read whole; beyond DEEPEST levels elements become siblings. Wrappers and first pages are broadcast
only while their bytes are few.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import saved, small
from tagloom.llm.url_filter import url_host

ALIKE, CONSTANT, NEARLY, MATCH_CELLS, DEEPEST, HELD = 4, 0.5, 0.9, 40_000, 200, 2 << 20
_TAG = re.compile(r"""<!--|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes svg math object".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
BOXES = frozenset("html body div main article section center table tbody tr td".split())
FURNITURE = frozenset("head nav header footer aside form button select option input dialog menu fieldset script style textarea title noscript iframe template svg math object xmp noembed noframes audio video canvas".split())
MARKS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside header masthead footer comment comments respond replies reply disqus related share sharing social newsletter subscribe subscription signup popup modal widget widgets pager pagination toolbar skip login search complementary contentinfo navigation".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_IN_LINE = INLINE | RAW | (VOID - {"hr"}) | frozenset("button select option audio video canvas".split())
_BOUND = frozenset("html body div main article section nav header footer aside form table ul ol dl blockquote td th".split())
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "key", "junk", "kids", "up", "within")

    def __init__(self, tag: str, key: str, junk: bool, up: Node | None):
        self.tag, self.key, self.junk, self.up = tag, key, junk, up
        self.within = up is not None and (up.within or up.tag in ("article", "main"))
        self.kids: list[Node | str] = []


def _marked(value: str, within: bool) -> bool:
    """Whether a class, id or role is a mark of furniture: any of its words outside an article, a name made of marks alone within one, where
    names such as article-header or notice-period belong to the text."""
    if within:
        return any((w := _WORD.findall(name)) and MARKS.issuperset(w) for name in value.split())
    return not MARKS.isdisjoint(_WORD.findall(value))


def _marks(tag: str, attributes: str, within: bool) -> tuple[str, bool]:
    """A node's key (element and class), and whether it is furniture; an article's own header is none."""
    junk, key = tag in FURNITURE and not (within and tag == "header"), tag
    if attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "class":
                key = f"{tag}.{value}"
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                junk = True
            elif name in ("class", "id", "role") and tag not in ("html", "body", "article", "main"):
                junk = junk or (_marked(value, within) and not (within and tag == "header"))
    return key, junk


def parse(page: str) -> Node:
    """A page's tree; end tags that authors leave out are implied, stray ones ignored."""
    root = at = Node("html", "html", False, None)
    pos, depth, last = 0, 0, page.rfind(">") + 1  # no tag ends behind the last one that does, so none is looked for there
    while m := _TAG.search(page, pos, last):
        if m.start() > pos:
            at.kids.append(page[pos : m.start()])
        pos = m.end()
        if m[0] == "<!--":
            end = page.find("-->", pos)
            pos = len(page) if end < 0 else end + 3
            continue
        close, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        tag = name.lower()
        if close:
            node = at
            while node is not None and node.tag != tag and not (tag in INLINE and node.tag in _BOUND):
                node = node.up
            if node is not None and node.tag == tag and node.up is not None:
                while at is not node.up:
                    at, depth = at.up, depth - 1
            continue
        if tag in ("html", "body") and (tag == "html" or at.tag == "body"):
            continue
        if tag not in _IN_LINE:  # a block ends an open paragraph
            node = at
            while node.up is not None and node.tag not in _BOUND and node.tag != "p":
                node = node.up
            if node.tag == "p":
                while at is not node.up:
                    at, depth = at.up, depth - 1
            for _ in range(2):
                node = at
                while node.up is not None and node.tag not in _CLOSES.get(tag, ()) and node.tag not in ("ul", "ol", "dl", "table", "select", "html", "body"):
                    node = node.up
                if node.tag in _CLOSES.get(tag, ()):
                    while at is not node.up:
                        at, depth = at.up, depth - 1
        key, junk = _marks(tag, attributes, at.within or at.tag in ("article", "main"))
        node = Node(tag, key, junk, at)
        at.kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, pos)
            pos = len(page) if end is None else end.start()
            if end is not None:
                close_at = page.find(">", pos)
                pos = len(page) if close_at < 0 else close_at + 1
        elif tag not in VOID and not attributes.rstrip().endswith("/") | (depth >= DEEPEST):
            at, depth = node, depth + 1
    rest = page[pos:]
    cut = re.search(r"<[a-zA-Z/!?]", rest)  # a tag that the page's end cuts off
    at.kids.append(rest[: cut.start()] if cut else rest)
    return root


def _blocks(node: Node, out: list[str], line: list[str]) -> None:
    for kid in node.kids:
        if isinstance(kid, str):
            line.append(kid)
        elif kid.tag == "br":
            line.append(" ")
        elif kid.junk:
            if kid.tag not in _IN_LINE:
                _flush(out, line)
        else:
            if kid.tag in INLINE:
                _blocks(kid, out, line)
            else:
                _flush(out, line)
                _blocks(kid, out, line)
                _flush(out, line)


def _flush(out: list[str], line: list[str]) -> None:
    text = " ".join(html.unescape("".join(line)).split())
    line.clear()
    if text:
        out.append(text)


def blocks(node: Node) -> list[str]:
    """A node's blocks of text, furniture left out, references decoded, white space inside a block made one space."""
    out: list[str] = []
    line: list[str] = []
    _blocks(node, out, line)
    _flush(out, line)
    return out


def _nodes(node: Node) -> list[Node]:
    return [k for k in node.kids if isinstance(k, Node) and not k.junk and k.tag not in INLINE]


def _size(node: Node, sizes: dict[int, int]) -> int:
    sizes[id(node)] = 1 + sum(_size(k, sizes) for k in _nodes(node))
    return sizes[id(node)]


def align(a: Node, b: Node, pairs: list[tuple[Node, Node]], sizes: dict[int, int]) -> None:
    """Simple tree matching from two nodes of one key downwards: an order-keeping match of children, heavier subtrees first."""
    pairs.append((a, b))
    x, y = _nodes(a), _nodes(b)
    if len(x) * len(y) > MATCH_CELLS:  # very wide nodes: pair equal keys in turn
        later: dict[str, list[Node]] = {}
        for k in reversed(y):
            later.setdefault(k.key, []).append(k)
        matched = [(k, later[k.key].pop()) for k in x if later.get(k.key)]
    else:
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, k in enumerate(x):
            for j, n in enumerate(y):
                both = min(sizes[id(k)], sizes[id(n)]) if k.key == n.key else 0
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + both)
        matched, i, j = [], len(x), len(y)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                matched.append((x[i], y[j]))
    for k, n in matched:
        align(k, n, pairs, sizes)


def _texts(node: Node, texts: dict[int, int]) -> int:
    """Sizes of the text of a node and all below, furniture left out."""
    texts[id(node)] = sum(len(k.strip()) if isinstance(k, str) else 0 if k.junk else _texts(k, texts) for k in node.kids)
    return texts[id(node)]


class First:
    """The first page of a host, with which all are aligned; its nodes are numbered in page order."""

    def __init__(self, page: str):
        self.root, self.sizes, self.texts, self.nodes = parse(page), {}, {}, []
        _size(self.root, self.sizes)
        _texts(self.root, self.texts)
        todo = [self.root]
        while todo:
            self.nodes.append(node := todo.pop())
            todo += reversed(_nodes(node))
        self.number = {id(k): i for i, k in enumerate(self.nodes)}
        self.own = {id(k): blocks(k) for k in self.nodes if not _nodes(k)}

    def aligned(self, root: Node) -> list[dict]:
        """Nodes that a page has, too: their number, the sizes of the text there and of all text of the node above, and whether it is the same."""
        sizes, texts, pairs = dict(self.sizes), {}, []
        _size(root, sizes)
        _texts(root, texts)
        align(self.root, root, pairs, sizes)
        out = []
        for a, b in pairs:
            own = self.own.get(id(a))
            out.append({"no": self.number[id(a)], "size": texts[id(b)], "within": texts[id(b.up if b.up is not None else b)], "alike": bool(own) and own == blocks(b)})
        return out


def induce(page: str, found: list[dict]) -> dict:
    """Of a host's first page and, by node, in how many pages it is (n), in how many of them alike, the size of its text and of that of the node above there: path of keys to the container."""
    first, at = First(page), {x["no"]: x for x in found}
    if at[0]["n"] < 2:
        return {"path": []}
    none = {"n": 0, "alike": 0, "size": 0, "within": 0}
    of = lambda node: at.get(first.number[id(node)], none)

    def constant(node: Node) -> int:
        """The size of the template's text in all pages."""
        kids, x = _nodes(node), of(node)
        if kids:
            return sum(map(constant, kids))
        return first.texts[id(node)] * x["alike"] if x["n"] > 1 and x["alike"] - 1 >= NEARLY * (x["n"] - 1) else 0

    slot = lambda node: of(node)["size"] - constant(node)
    node, path = first.root, []
    while node.tag not in ("article", "main"):
        kids = _nodes(node)
        big = max(kids, key=slot, default=None)
        if big is None or big.tag not in BOXES or any(k.tag in ("h1", "h2") for k in kids if k is not big):
            break
        around = of(big)["within"] - constant(node) * of(big)["n"] / of(node)["n"]  # of the pages that have it
        if slot(big) < NEARLY * max(1, around):
            break
        node = big
        path.append(node.key)
    return {"path": path}


def hash_of(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def template(root: Node) -> int:
    """A page's template: which boxes, by element and class without numbers, are within two levels of its body."""
    seen, level = set(), [root]
    for _ in range(3):
        level = [k for n in level for k in _nodes(n) if k.tag in BOXES]
        seen |= {re.sub("[0-9]+", "#", k.key) for k in level}
    return hash_of("|".join(sorted(seen)))


def _find(root: Node, path: list[str]) -> Node | None:
    for key in path:
        root = next((k for k in _nodes(root) if k.key == key), None)
        if root is None:
            return None
    return root


def _all(node: Node, tag: str) -> Iterator[Node]:
    for k in node.kids:
        if isinstance(k, Node) and not k.junk:
            if k.tag == tag:
                yield k
            else:
                yield from _all(k, tag)


def main_text(page: str | None, wrapper: dict) -> str:
    """The main text of a page, read through its host's wrapper."""
    root = parse(page or "")
    node = _find(root, wrapper["path"]) if wrapper["path"] else None
    if node is None or not blocks(node):
        found = list(_all(root, "article")) or list(_all(root, "main")) or [root]
    else:
        found = list(_all(node, "article")) if node.tag not in ("article", "main") else [node]
        found = found or [node]
    everywhere, by = wrapper["host"], wrapper["template"]
    constant = everywhere | by.get(template(root), frozenset()) if by else everywhere
    kept = [x for n in found for x in blocks(n) if not constant or hash_of(x) not in constant]
    return "\n".join(kept)


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [json.dumps(induce(page.as_py(), nodes.as_py())) for page, nodes in zip(batch.column(1), batch.column(2), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["host", "wrapper"])


def _supports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, First] = {}
    held = 0
    for batch in batches:
        rows = []
        for host, page, first in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            page = page.as_py() or ""
            root = parse(page)
            own = blocks(root)
            nodes = None
            if page and first.is_valid:
                if host not in known:
                    text = first.as_py()
                    if held + len(text) > HELD:
                        known, held = {}, 0
                    known[host], held = First(text), held + len(text)
                nodes = known[host].aligned(root)
            rows.append((template(root), hash_of("\n".join(own)), [{"block": hash_of(x), "size": len(x)} for x in dict.fromkeys(own)], nodes))
        cols = list(zip(*rows, strict=True)) or [()] * 4
        kind = pa.list_(pa.struct([("block", pa.int64()), ("size", pa.int64())]))
        node = pa.list_(pa.struct([("no", pa.int32()), ("size", pa.int64()), ("within", pa.int64()), ("alike", pa.bool_())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), kind, node), strict=True))], ["host", "template", "same", "blocks", "nodes"])


def supports(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages of different text (host, template, same: a hash of the text, blocks, nodes of the host's first page that it has), saved; and host, first: first pages, saved."""
    pages = pages.select(url_host(F.col("url")).alias("host"), "page_id", "html")
    filled = pages.filter(F.length("html") > 0)
    picked = saved(filled.groupBy("host").agg(F.min("page_id").alias("page_id")), "picked")
    firsts = saved(filled.join(small(picked, 1_000_000), ["host", "page_id"]).groupBy("host").agg(F.min("html").alias("first")), "firsts")
    rows = pages.select("host", "html").join(small(firsts, 100_000, "first"), "host", "left").select("host", "html", "first")
    rows = rows.mapInArrow(_supports, "host string, template long, same long, blocks array<struct<block:long,size:long>>, nodes array<struct<no:int,size:long,within:long,alike:boolean>>")
    return saved(rows.groupBy("host", "template", "same").agg(F.first("blocks").alias("blocks"), F.min("nodes").alias("nodes")), "pages"), firsts


def constants(rows: DataFrame) -> DataFrame:
    """host, constant (template or null for all of the host, block): constant blocks, by all pages of a host with different texts."""
    of = saved(rows.select("host", "template", F.inline("blocks")).groupBy("host", "template", "block").agg(F.count("*").alias("n"), F.max("size").alias("size")), "blocks")
    totals = saved(rows.groupBy("host", "template").agg(F.count("*").alias("pages")), "templates")
    found = None
    for by in (["host", "template"], ["host"]):
        every = totals.groupBy(*by).agg(F.sum("pages").alias("pages"))
        n = of.groupBy(*by, "block").agg(F.sum("n").alias("n"), F.max("size").alias("size")).join(every, by).withColumn("often", (F.col("n") >= ALIKE) & (F.col("n") >= CONSTANT * F.col("pages")))
        length = F.col("n") * F.col("size")
        fit = n.groupBy(*by).agg(F.sum(length).alias("total"), F.sum(F.when(F.col("often"), length).otherwise(0)).alias("own")).filter("3 * own < total")
        some = n.filter("often").join(fit, by).select("host", F.struct((F.col("template") if len(by) > 1 else F.lit(None).cast("long")).alias("template"), "block").alias("c"))
        found = found.union(some) if found else some
    return found.groupBy("host").agg(F.to_json(F.sort_array(F.collect_list("c")), {"ignoreNullFields": "false"}).alias("constant"))


def _wrapper(path: str | None, constant: str | None) -> dict:
    out = {"path": json.loads(path)["path"] if path else [], "host": set(), "template": {}}
    for c in json.loads(constant) if constant else ():
        (out["host"] if c["template"] is None else out["template"].setdefault(c["template"], set())).add(c["block"])
    return out


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple, dict] = {}
    for batch in batches:
        texts = []
        for page, *wrapper in zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            if (key := tuple(wrapper)) not in known:
                known = {} if len(known) > 1000 else known
                known[key] = _wrapper(*key)
            texts.append(main_text(page.as_py(), known[key]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])


def wrappers(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """host, wrapper: of all pages of a host with different texts."""
    nodes = rows.select("host", F.inline("nodes")).groupBy("host", "no").agg(F.count("*").alias("n"), F.count_if("alike").alias("alike"), F.sum("size").alias("size"), F.sum("within").alias("within"))
    found = nodes.groupBy("host").agg(F.collect_list(F.struct("no", "n", "alike", "size", "within")).alias("nodes"))  # as many as one page has
    return firsts.join(found, "host").select("host", "first", "nodes").mapInArrow(_induce, "host string, wrapper string")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of each page."""
    pages = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    rows, firsts = supports(pages)
    known = small(saved(wrappers(rows, firsts), "wrappers"), 100_000, "wrapper")
    fixed = small(saved(constants(rows), "constants"), 100_000, "constant")
    joined = pages.withColumn("host", url_host(F.col("url"))).join(known, "host", "left").join(fixed, "host", "left")
    return joined.select("page_id", "url", "html", "wrapper", "constant").mapInArrow(_extract, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
