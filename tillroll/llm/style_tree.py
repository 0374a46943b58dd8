"""Main text of web pages by site style trees.

The DOMs of one host are merged: an element of a page is the tree node of its
path, the chain of tag, class and id from the root. Over all pages of the host
a node has a distribution of presentations (the sequence of its child
elements) and of contents (its own text). Its importance is the entropy of
that distribution in units of log(pages): 0 if every page shows the same, 1 if
all differ. Pages are reduced to (node, kind, feature) counts by a map with
partial sums; one shuffle adds them up. A second map prunes every page: an
element's composite importance mixes its own with that of its children,
weighted by their text, and branches below ``LOWEST`` are removed.

Priors: elements whose tag or role is that of a menu, header, footer, sidebar,
notice, advert, form, script or style have importance 0. A class or id with
such a word is a prior weight only: ``PRIOR`` characters of importance 0 are
mixed into the element's composite importance, so it goes if it is short or
hardly varies and stays if it is long and varies. For words of reader comments
the tree says nothing (they vary as the text does): those elements go. No word
removes an element that holds an article or main element or an article's
heading, nor one with ``MOST`` of the text (comments: of a page without
article). The article elements of a page (or else its main elements) are its only
important branch if they hold ``BRANCH`` of the page's important text, its
characters weighted by their importance on the host; so a teaser beside the
content is not taken for it, and a short article is found among long texts that
every page shows. Inside the branch the style tree removes boxes (div, section, ul,
ol, table) that hardly vary over the host while other parts of it do; headings
and paragraphs stay, so an article copied to many pages is whole.

What is the same on every page can be the main text itself, copied. So an
element with at least ``MOST`` of the text (of the page, or of the article)
is never removed, and if the other removals together come to ``MOST`` of it,
or leave only headings and dates, nothing is removed.

Only nodes seen on at least ``MIN_PAGES`` pages of a host and not fully
varying are sent to the second map, ``PART`` of them at a time: hosts are
dealt into as many parts as that takes, each a broadcast of its own. Pages
are never shuffled by host; if there are several parts, they are written once by
part, so every page is read once more however many parts there are. One host's
nodes are one broadcast.

Defined results: null or empty html and pages without text give an empty
text; a null URL is the host ""; repeated pages are extracted one by one;
broken markup is read as browsers do in the common cases (unclosed elements,
references without semicolon); only the id, url and result columns are
returned.
"""

from __future__ import annotations

import html as entities
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tillroll.llm.staging import early_cleanup, share, stage
from tillroll.llm.url_filter import split_url
from tillroll.session import scratch_dir

MIN_PAGES = 4
LOWEST = 0.2
DAMPING = 0.9
MOST = 0.75
BRANCH = 0.25
PRIOR = 400
PART = 500_000

# HTML's elements by their role in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
             "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup "
             "option p pre search section select summary table tbody td tfoot th thead tr ul caption".split())
ENDS_P = BLOCKS - set("body head html legend option optgroup caption tbody td tfoot th thead tr".split())
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
           "tfoot": {"tr", "td", "th", "tbody"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"}}
NOISE_TAGS = set("nav footer aside form button select menu dialog head object embed applet canvas audio video map "
                 "fieldset label input".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form "
                  "toolbar".split())
NOISE_WORDS = set("menu nav navbar navigation breadcrumb breadcrumbs header masthead footer sidebar aside cookie cookies "
                  "consent notice notices gdpr banner ad ads advert adverts advertisement advertising sponsor sponsored "
                  "promo promotion form newsletter subscribe signup login comment comments disqus respond share sharing "
                  "social related recommended popup modal overlay widget pagination pager toolbar skip adsbygoogle "
                  "adbox adslot cookiebanner cookieconsent".split())
COMMENT_WORDS = set("comment comments disqus".split())
BOXES = set("div section ul ol table dl".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
TITLES = HEADINGS | set("hgroup header time address".split())

_TAG = re.compile(
    r"""<(?:!--(?:.*?--!?>|.*)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+(?=>|\Z)|[^>]*)>?|[!?/][^>]*>?)""",
    re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAMED = re.compile(r"class|id|role", re.I)  # 'hidden' holds an id
_DIGITS = re.compile(r"\d+")
_WORD = re.compile(r"[a-z]+")
_MASK = (1 << 64) - 1
END = object()


class Node:
    __slots__ = ("tag", "sig", "parent", "noise", "named", "items", "key")

    def __init__(self, tag, sig, parent, noise, named=0):
        self.tag, self.sig, self.parent, self.noise = tag, sig, parent, noise
        self.named = named  # 1: by a word of NOISE_WORDS, 2: of COMMENT_WORDS
        self.items: list = []  # child nodes and pieces of text, in order
        self.key = 0


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(raw):
        out.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _start(tag: str, raw: str, parent: Node) -> Node:
    # A header is the page's, unless it is the heading part of some content.
    sig, noise = tag, tag in NOISE_TAGS or tag == "header" and not _open(parent, {"article", "main", "section"})
    named = 0
    if raw and _NAMED.search(raw):
        attrs = _attributes(raw)
        names = (attrs.get("class", "") + " " + attrs.get("id", "")).strip()
        sig = tag + "." + _DIGITS.sub("0", names)
        words = set(_WORD.findall(names.lower()))
        noise = noise or "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "") in NOISE_ROLES
        if tag == "article":
            noise = noise or bool(words & COMMENT_WORDS)
        elif tag not in ("html", "body", "main"):
            named = 2 if words & COMMENT_WORDS else int(bool(words & NOISE_WORDS))
    return Node(tag, sig, parent, noise, named)


def parse(text: str) -> Node:
    """A DOM good enough for extraction: implied ends, raw text, lost ends."""
    root = Node("#", "#", None, False)
    node, at, n, match = root, 0, len(text), _TAG.match
    while at < n:
        cut = text.find("<", at)
        if cut < 0:
            node.items.append(text[at:])
            break
        if cut > at:
            node.items.append(text[at:cut])
        m = match(text, cut)
        if m is None:
            node.items.append("<")
            at = cut + 1
            continue
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not _open(node, {"p"}):
                node.items.append(None)  # </p> alone ends a block
                continue
            up = node
            while up is not None and up.tag != tag:
                up = up.parent
            if up is not None and up.parent is not None:
                if tag not in BLOCKS and _blocks_between(node, up):
                    continue
                node = up.parent
            continue
        if tag in ENDS_P:
            node = _close_to(node, {"p"}, BLOCKS)
        if tag in IMPLIED:
            node = _close_to(node, IMPLIED[tag], SCOPE[tag])
        raw = m[3] or ""
        if tag in RAW:
            close = re.compile("</" + re.escape(tag) + r"(?=[\s/>]|\Z)", re.I).search(text, at)
            end = text.find(">", close.start()) if close else -1
            at = n if end < 0 else end + 1
            continue
        child = _start(tag, raw, node)
        node.items.append(child)
        if tag not in VOID:  # in HTML a slash at the end closes nothing else
            node = child
    _unname(root)
    return root


def _unname(root: Node) -> None:
    """Take the name prior from elements that hold an article, a main element
    or an article's heading: its first h1, or else its first heading. Articles
    inside an article are part of it."""
    heads: dict[int, tuple[Node, Node]] = {}
    todo: list[tuple[Node, Node | None]] = [(root, None)]
    while todo:
        node, article = todo.pop()
        if node.tag in ("article", "main") and (article is None or (article.tag, node.tag) == ("main", "article")):
            article = node
            _clear(node, root)
        elif node.tag in HEADINGS and article is not None:
            if id(article) not in heads or node.tag == "h1" != heads[id(article)][0].tag:
                heads[id(article)] = node, article
        todo += [(k, article) for k in reversed(_kids(node))]
    for head, article in heads.values():
        _clear(head, article)


def _clear(node: Node, top: Node) -> None:
    while node is not top:
        node.named = 0
        node = node.parent


def _kids(node: Node) -> list[Node]:
    return [i for i in node.items if isinstance(i, Node) and not i.noise]


def _open(node: Node, tags: set) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.parent
    return False


def _blocks_between(node: Node, up: Node) -> bool:
    while node is not up:
        if node.tag in BLOCKS:
            return True
        node = node.parent
    return False


def _close_to(node: Node, tags: set, scope: set) -> Node:
    """Close the nearest open element of ``tags``, unless one of ``scope`` is nearer."""
    up = node
    while up is not None and up.parent is not None:
        if up.tag in tags:
            return up.parent
        if up.tag in scope:
            return node
        up = up.parent
    return node


def clean(text: str) -> str:
    return " ".join((entities.unescape(text) if "&" in text else text).split())


def own_text(node: Node) -> str:
    """The element's own text as it stands in the page; "" if only white space."""
    text = "".join([i for i in node.items if type(i) is str])
    return "" if text.isspace() else text


def keyed(root: Node, host: str) -> list[Node]:
    """Elements outside noise, parents first, with the key of host and path."""
    root.key = zlib.crc32(host.encode("utf-8", "surrogatepass")) * 0x9E3779B97F4A7C15 & _MASK
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        for child in node.items:
            if isinstance(child, Node) and not child.noise:
                crc = zlib.crc32(child.sig.encode("utf-8", "surrogatepass"))
                child.key = ((node.key ^ crc) * 0xD6E8FEB86659FD93 + (node.key >> 29)) & _MASK
                out.append(child)
                todo.append(child)
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def features(root: Node, host: str) -> set[tuple[int, int, int]]:
    """(node key, kind, feature) of a page: one presentation per node (kind 0)
    and the hash of each of its own texts (kind 1)."""
    shown: dict[int, int] = {}
    out = set()
    for node in keyed(root, host):
        crc = shown.get(node.key, 0)
        last = None
        for item in node.items:
            if isinstance(item, Node) and item.sig != last:
                last = item.sig
                crc = zlib.crc32(last.encode("utf-8", "surrogatepass"), crc)
        shown[node.key] = crc
        text = own_text(node)
        if text:
            raw = text.encode("utf-8", "surrogatepass")
            out.add((_signed(node.key), 1, zlib.crc32(raw) << 20 ^ len(raw)))
    out.update((_signed(key), 0, crc) for key, crc in shown.items())
    return out


def _counter(batches):
    for batch in batches:
        sums: dict[tuple[int, int, int], int] = {}
        part: dict[int, int] = {}
        for url, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            host = split_url(url)[0]
            code = zlib.crc32(host.encode("utf-8", "surrogatepass"))
            for row in features(parse(text or ""), host):
                sums[row] = sums.get(row, 0) + 1
                part[row[0]] = code
        keys = list(sums)
        columns = [pa.array([k[c] for k in keys], pa.int64()) for c in range(3)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([part[k[0]] for k in keys], pa.int64()), *columns, pa.array([sums[k] for k in keys], pa.int64())],
            names=["host", "node", "kind", "feature", "n"])


def importances(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, node, importance) of nodes on MIN_PAGES pages or more that are
    not fully varying; every other node has importance 1."""
    counted = (pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html"))
               .mapInArrow(_counter, "host long, node long, kind long, feature long, n long")
               .groupBy("host", "node", "kind", "feature").agg(F.sum("n").alias("n")))
    sums = counted.groupBy("host", "node").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("pages"),
        F.sum(F.when(F.col("kind") == 0, F.col("n") * F.ln("n"))).alias("shown"),
        F.sum(F.when(F.col("kind") == 1, F.col("n"))).alias("texts"),
        F.sum(F.when(F.col("kind") == 1, F.col("n") * F.ln("n"))).alias("said")).where(F.col("pages") >= MIN_PAGES)
    content = 1 - F.col("said") / (F.col("texts") * F.ln("pages"))
    presentation = 1 - F.col("shown") / (F.col("pages") * F.ln("pages"))
    return sums.select("host", "node", F.coalesce(content, presentation).cast("float").alias("importance")).where(
        "importance < 0.999")


class StyleTree:
    """Importances of tree nodes, by key."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], values[order]

    def of(self, key: int) -> float:
        key = _signed(key)
        at = int(np.searchsorted(self.keys, key))
        return float(self.values[at]) if at < len(self.keys) and self.keys[at] == key else 1.0


def _sizes(nodes: list[Node]) -> dict[int, float]:
    """Text of elements (given parents first) and of all below them."""
    sizes: dict[int, float] = {}
    for node in reversed(nodes):
        sizes[id(node)] = float(len(own_text(node))) + sum(sizes[id(k)] for k in _kids(node))
    return sizes


def _composite(nodes: list[Node], tree: StyleTree | None, tops: list[Node]) -> tuple[dict, dict, set[int]]:
    """Composite importance and text of elements given parents first, and the
    elements that the name prior removes, which count for nothing above them."""
    page = tops[0].parent is None
    around = [tops[0], *nodes] if page else nodes
    whole = _sizes(around)
    starts, totals = {id(t) for t in tops}, {}
    for node in around:
        up = id(node.parent)
        if up in totals or id(node) in starts:
            totals[id(node)] = totals[up] if up in totals else whole[id(node)]
    comp: dict[int, float] = {}
    sizes: dict[int, float] = {}
    gone: set[int] = set()
    for node in reversed(around):
        at, own, kids = id(node), float(len(own_text(node))), [k for k in _kids(node) if id(k) not in gone]
        weight = sizes[at] = own + sum(sizes[id(k)] for k in kids)
        mine = tree.of(node.key) if tree is not None else 1.0
        inner = (mine * own + sum(comp[id(k)] * sizes[id(k)] for k in kids)) / weight if weight else mine
        comp[at] = mine if not kids else (1 - DAMPING) * mine + DAMPING * inner
        if node.named and not (whole[at] >= MOST * totals.get(at, 0.0) and (page or node.named == 1)):
            if node.named == 2 or comp[at] * weight < LOWEST * (weight + PRIOR):
                gone.add(at)
    return comp, sizes, gone


def _removed(top: Node, nodes: list[Node], comp: dict[int, float], sizes: dict[int, float],
             named: set[int]) -> set[int]:
    """Elements under ``top`` that the style tree removes besides ``named``:
    the main branch never, and none if most of the text or all but titles
    would go."""
    page, own, inside = top.parent is None, [], {id(top)}
    for x in nodes:  # parents first
        if id(x.parent) in inside and id(x) not in named:
            inside.add(id(x))
            own.append(x)
    if not page and max((comp[id(x)] for x in own), default=0.0) < 0.5:
        return set()
    total = sizes[id(top)]
    drop = {id(x) for x in own if comp[id(x)] < LOWEST and sizes[id(x)] < MOST * total and (page or x.tag in BOXES)}
    gone, title, body, lost = set(), set(), bool(own_text(top)), 0.0
    for x in own:
        up = id(x.parent)
        if up in gone or id(x) in drop:
            lost += 0 if up in gone else sizes[id(x)]
            gone.add(id(x))
        elif up in title or x.tag in TITLES:
            title.add(id(x))
        else:
            body = body or bool(own_text(x))
    return drop if body and lost < MOST * total else set()


def _branches(root: Node, nodes: list[Node], tree: StyleTree | None) -> list[Node]:
    """The elements that hold the page's important text, or the root."""
    found = {tag: {id(x) for x in nodes if x.tag == tag} for tag in ("article", "main")}
    if not any(found.values()):
        return [root]
    held, total, inside = dict.fromkeys(found, 0.0), float(len(own_text(root))), {id(root): (frozenset(), False)}
    for node in nodes:  # parents first
        above, named = inside[id(node.parent)]
        above |= {tag for tag in found if id(node) in found[tag]}
        named = (named or bool(node.named)) and not above
        inside[id(node)] = above, named
        if not named:
            weight = len(own_text(node)) * (tree.of(node.key) if tree is not None else 1.0)
            total += weight
            for tag in above:
                held[tag] += weight
    for tag, own in found.items():
        if own and held[tag] >= BRANCH * total:
            return [x for x in nodes if id(x) in own]
    return [root]


def extract(text: str, host: str, tree: StyleTree | None) -> str:
    """Main text of one page: blocks joined by empty lines."""
    root = parse(text)
    nodes = keyed(root, host)
    known = tree if tree is not None and len(tree.keys) else None
    tops = _branches(root, nodes, known)
    comp, sizes, drop = _composite(nodes, known, tops)
    if known is not None:
        named = set(drop)
        for top in tops:
            drop |= _removed(top, nodes, comp, sizes, named)
    blocks: list[str] = []
    held: list[str] = []

    def flush():
        block = clean("".join(held))
        held.clear()
        if block:
            blocks.append(block)

    seen = set()
    for top in tops:
        if id(top) in seen:
            continue
        flush()
        todo: list = [iter(top.items)]
        owner = [top]
        seen.add(id(top))
        while todo:
            item = next(todo[-1], END)
            if item is END:
                todo.pop()
                if owner.pop().tag in BLOCKS:
                    flush()
                continue
            if item is None:
                flush()
            elif isinstance(item, str):
                held.append(item)
            elif item.tag == "br":
                held.append(" ")
            elif not item.noise and id(item) not in drop:
                seen.add(id(item))
                if item.tag in BLOCKS:
                    flush()
                todo.append(iter(item.items))
                owner.append(item)
            elif item.tag in BLOCKS:
                flush()
        flush()
    return "\n\n".join(blocks)


def _extractor(shared):
    def run(batches):
        tree = shared()
        for batch in batches:
            urls, pages = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            texts = [extract(page or "", split_url(url)[0], tree) for url, page in zip(urls, pages)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             names=["id", "url", "text"])
    return run


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              part_size: int = PART) -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    spark = pages.sparkSession
    noted = stage(importances(pages, url_col, html_col), "style-tree")
    parts = max(1, -(-noted.count() // part_size))
    schema = T.StructType([T.StructField("id", pages.schema[id_col].dataType), T.StructField("url", T.StringType()),
                           T.StructField("text", T.StringType())])
    read = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    host = F.translate(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by_part = None
    if parts > 1:
        by_part = scratch_dir(spark, "pages-by-part")
        with early_cleanup(spark):
            (read.withColumn("part", F.crc32(host.cast("binary")) % parts).write.partitionBy("part")
             .option("compression", "zstd").parquet(by_part))
    out = None
    for part in range(parts):
        own = noted.where(F.col("host") % parts == part).select("node", "importance").toArrow()
        tree = StyleTree(own.column(0).to_numpy(), own.column(1).to_numpy())
        rows = read if by_part is None else spark.read.schema(read.schema.add("part", "long")).parquet(by_part).where(
            F.col("part") == part).drop("part")
        done = rows.mapInArrow(_extractor(share(spark, tree)), schema)
        out = done if out is None else out.union(done)
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                      F.char_length("text").cast("long").alias("n_chars"))
