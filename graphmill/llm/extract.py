"""Operator 10: main text of web pages by wrapper induction.

1. A page becomes a tree of its block elements with their texts (inline markup is text; scripts, styles, forms and
   elements that name themselves as menus, headers, footers, sidebars, notices, adverts or comments are marked).
2. A host's wrapper is the tree of its page with the least page_id, without texts.
3. Every page is aligned with its host's wrapper by simple tree matching: the mapping of most nodes that keeps parents,
   order and labels, by dynamic programming over the children.  Siblings in a row with one label count as one repeated child.
4. A page's core is its longest unmarked texts that together hold half of its unmarked text; copies of an article with other adverts or
   menus have one core, and count once.  A text that stands at the same wrapper node beside at least ``SHARE`` of a host's different
   cores, plus half the root of their number, and beside two at least, is the template's; other texts fill varying slots.  The wrapper node whose subtree holds most of the varying text
   outside marked elements, and no child of which holds nearly all of it, is the content node.  An <article> or <main> that holds
   half of it needs no more, and is taken as a whole.
5. A page's text: the blocks of the nodes aligned to the content node; if it has none, or that is the whole body and the wrapper lacks
   them, of its <article> or <main> elements, else of its body; without marked elements and the template's texts, in page order.

All counts cover all pages; per host only the wrapper and the template's texts are kept, and Spark broadcasts those if
their size allows and else joins by host, splitting a host with many pages.

Defined results: null and empty html give an empty text; a null url, or one without a host, is host ""; repeated rows come
back one by one, and pages of a host with one core count once for its template; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphmill.llm.common import stored
from graphmill.session import table

SHARE = 0.5
#: A child that holds this share of a node's varying text takes its place as the content node.
NEARLY_ALL = 0.8
#: The share that an element labelled as content needs.
LABELLED = 0.5
CONTENT_TAGS = ("article", "main")

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
RAW = frozenset("script style textarea title noscript template iframe svg math object xmp noembed noframes".split())
MARKED_TAGS = frozenset("nav header footer aside form menu dialog button select fieldset head".split())
MARKED_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
#: Words of class and id attributes, split at other than letters.
MARKED_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising adsense sponsor sponsored promo promotion banner nav navigation navbar menu "
    "breadcrumb breadcrumbs sidebar sidenav aside header masthead footer cookie cookies consent notice notification alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social comment comments disqus discussion respond reply replies related "
    "recommended widget toolbar pagination pager skip".split()
)
#: Marked elements inside the content that are a header of its own keep their headings.
_OWN_HEADER = frozenset(["header", "hgroup"])

#: Words that say nothing about an element's role, beside one of ``MARKED_WORDS`` in a class or id.
PLAIN_WORDS = frozenset(
    "area article bar block body bottom box btn button center col column container content footer global group head holder inner item "
    "items js left line link links list main outer page panel part post primary right row secondary section site slot small sticky sub text "
    "title top unit wide wrap wrapper".split()
)
#: Inside <article> and <main> the class of these says nothing against their text.
_TEXT_TAGS = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th blockquote pre caption figcaption tr tbody thead table".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_WORD = re.compile(r"[a-z]+")
#: Numbers in class names that tell pages apart, not kinds of elements.
_NUMBER = re.compile(r"\d{3,}")
#: Which open elements an element's start ends, up to the nearest of the second set.
_CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
    "tfoot": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
}


class Node:
    """A block element: label, whether it is marked, and its texts and block children in order."""

    __slots__ = ("index", "items", "label", "marked", "tag")

    def __init__(self, tag: str, label: str, marked: bool):
        self.tag, self.label, self.marked = tag, label, marked
        self.items: list[Node | str] = []
        self.index = -1  # the wrapper node that it is aligned to

    def kids(self) -> list[Node]:
        return [x for x in self.items if isinstance(x, Node)]


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)} if "=" in raw else {}


def _is_marked(tag: str, attributes: dict[str, str], inside_content: bool) -> bool:
    if tag in MARKED_TAGS and not (inside_content and tag in _OWN_HEADER):
        return True
    if not attributes:
        return False
    if attributes.get("role", "").lower() in MARKED_ROLES or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if tag in ("body", "html", "article", "main") or (inside_content and tag in _TEXT_TAGS):
        return False
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        words = set(_WORD.findall(name))
        if not MARKED_WORDS.isdisjoint(words) and words <= MARKED_WORDS | PLAIN_WORDS:  # "share-price" is no sharing bar
            return True
    return False


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) of a page in order, in one pass: kind is "text", "open", "close" or "raw".

    A tag ends at the first > outside quotes.  From a quote on that nothing closes, quotes are ordinary characters; a tag that nothing
    ends is text.  "raw" is text in which & is no reference."""
    at, size = 0, len(page)
    last_end = page.rfind(">")
    quoted = True
    open_ended: set[str] = set()  # raw elements that no later end tag closes
    while at < size:
        begin = page.find("<", at)
        if begin < 0 or begin > last_end and not page.startswith(("<!--", "<![CDATA["), begin):
            yield "text", page[at:], ""
            return
        if begin > at:
            yield "text", page[at:begin], ""
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith("<![CDATA[", begin):
            end = page.find("]]>", begin + 9)
            yield "raw", page[begin + 9 : size if end < 0 else end], ""
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), begin):
            at = page.find(">", begin) + 1
            continue
        closing = page.startswith("/", begin + 1)
        name = _NAME.match(page, begin + 1 + closing)
        if not name:
            yield "text", "<", ""
            at = begin + 1
            continue
        end = name.end()
        while True:
            stop = _STOP.search(page, end) if quoted else None
            if stop is None or stop[0] == ">":
                end = stop.start() if stop else page.find(">", name.end())
                break
            other = page.find(stop[0], stop.end())
            if other < 0:
                quoted = False
                end = page.find(">", name.end())
                break
            end = other + 1
        if end < 0:
            yield "text", page[begin:], ""
            return
        tag, rest = name[0].lower(), page[name.end() : end]
        at = end + 1
        yield "close" if closing else "open", tag, rest
        if not closing and tag in RAW and not rest.endswith("/"):
            found = None if tag in open_ended else re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            if found:
                at = found.end()
            else:
                open_ended.add(tag)
                if tag in ("script", "style", "textarea", "title"):
                    return


def parse(page: str) -> Node:
    """The block tree of a page; never fails."""
    root = Node("#", "#", False)
    stack: list[tuple[str, Node | None]] = [("#", root)]  # open elements; None for inline ones
    open_at: dict[str, list[int]] = {}  # their depths by tag, so that no tag walks through the stack
    block_at = [0]  # the depths of blocks
    node, text = root, []
    marked_inline = 0  # inside an inline element that is marked

    def flush() -> None:
        if text:
            said = "".join(text)
            text.clear()
            said = " ".join((entities.unescape(said) if "&" in said else said).split())
            if said:
                node.items.append(said)

    def push(name: str, own: Node | None) -> None:
        open_at.setdefault(name.lstrip("!"), []).append(len(stack))
        if own is not None:
            block_at.append(len(stack))
        stack.append((name, own))

    def close_to(depth: int) -> None:
        nonlocal node, marked_inline
        if block_at[-1] >= depth:
            flush()
        while len(stack) > depth:
            name, own = stack.pop()
            open_at[name.lstrip("!")].pop()
            if own is not None:
                block_at.pop()
            else:
                marked_inline -= name[0] == "!"
        node = stack[block_at[-1]][1]

    def nearest(names) -> int:
        return max((open_at[n][-1] for n in names if open_at.get(n)), default=0)

    for kind, tag, rest in tokens(page):
        if kind == "text":
            if not marked_inline:
                text.append(tag)
            continue
        if kind == "raw":
            if not marked_inline:
                text.append(tag.replace("&", "&amp;"))
            continue
        if kind == "close":
            if tag in VOID:
                if tag == "br":
                    text.append(" ")
                continue
            depth = nearest((tag,))
            # an inline end tag doesn't reach out of its block, nor does a block's out of a table cell
            border = block_at[-1] if tag not in BLOCKS else 0 if tag in ("table", "tr", "tbody", "thead", "tfoot") else nearest(("td", "th"))
            if depth and depth >= border:
                close_to(depth)
            continue
        if tag in RAW:
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                text.append(" ")
            continue
        attributes = _attributes(rest)
        inside = bool(open_at.get("article") or open_at.get("main"))
        if tag not in BLOCKS:
            if not rest.endswith("/"):
                off = tag in ("button", "select", "option") or _is_marked(tag, attributes, False)
                marked_inline += off
                push(("!" if off else "") + tag, None)
            continue
        if tag != "html" and open_at.get("head"):  # a head that was left open ends with the first block
            close_to(open_at["head"][0])
        # a block ends an open paragraph, and inline elements that were left open in it
        if stack[block_at[-1]][0] == "p":
            close_to(block_at[-1])
        if tag in _CLOSES:
            ends, until = _CLOSES[tag]
            border = nearest(until)
            if tag in ("li", "td", "th", "dt", "dd"):
                depth = nearest(ends)
            else:  # all of them up to the border
                depth = min((d[bisect_right(d, border)] for d in map(open_at.get, ends) if d and d[-1] > border), default=0)
            if depth > border:
                close_to(depth)
        flush()
        words = sorted(set(_NUMBER.sub("#", attributes.get("class", "").lower()).split()))
        new = Node(tag, ".".join([tag, *words]), bool(node.marked or marked_inline or _is_marked(tag, attributes, inside)))
        if tag in ("html", "body"):  # these only carry the page
            new.marked = node.marked
        node.items.append(new)
        node = new
        push(tag, new)
    flush()
    return root


def _runs(kids: list[Node]) -> list[list[Node]]:
    out: list[list[Node]] = []
    for k in kids:
        if out and out[-1][0].label == k.label:
            out[-1].append(k)
        else:
            out.append([k])
    return out


class Wrapper:
    """A node of a host's tree without texts, in which a run of equal labels stands once; nodes are numbered in preorder."""

    __slots__ = ("index", "kids", "label")

    def __init__(self, label: str, index: int):
        self.label, self.index, self.kids = label, index, []

    @staticmethod
    def of(shape: list) -> list[Wrapper]:
        """All nodes of a tree given as [labels, parents], the root first."""
        nodes = [Wrapper(label, i) for i, label in enumerate(shape[0])]
        for n, parent in zip(nodes[1:], shape[1][1:], strict=True):
            nodes[parent].kids.append(n)
        return nodes


def _labelled(w: Wrapper) -> bool:
    return w.label.split(".")[0] in CONTENT_TAGS


def shape_of(root: Node) -> list:
    """The wrapper of one page as [labels, parents] in preorder; a run of siblings is as rich as its member of most nodes."""
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo.extend(n.kids())
    kept: dict[int, tuple[int, list[Node]]] = {}  # nodes under each, and the children that stand for their runs
    for n in reversed(order):
        rich = [max(run, key=lambda k: kept[id(k)][0]) for run in _runs(n.kids())]
        kept[id(n)] = (1 + sum(kept[id(k)][0] for k in rich), rich)
    labels, parents, todo = [], [], [(root, -1)]
    while todo:
        n, parent = todo.pop()
        at = len(labels)
        labels.append(n.label)
        parents.append(parent)
        todo.extend((k, at) for k in reversed(kept[id(n)][1]))
    return [labels, parents]


def _matched(runs: list[list[Node]], kids: list[Wrapper], score: dict[tuple[int, int], int]) -> tuple[int, list[tuple[int, int]]]:
    """The pairs (run, child) of equal labels, in order, whose scores have the greatest sum."""
    if not runs or not kids:
        return 0, []
    best = np.zeros((len(runs) + 1, len(kids) + 1), np.int64)
    places: dict[str, list[int]] = {}
    for j, k in enumerate(kids):
        places.setdefault(k.label, []).append(j)
    for i, run in enumerate(runs):
        row = best[i].copy()
        for j in places.get(run[0].label, ()):
            row[j + 1] = max(row[j + 1], best[i, j] + score[id(run[0]), kids[j].index])
        best[i + 1] = np.maximum.accumulate(row)
    pairs, i, j = [], len(runs), len(kids)
    while i and j:
        if best[i, j] == best[i, j - 1]:
            j -= 1
        elif best[i, j] == best[i - 1, j]:
            i -= 1
        else:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
    return int(best[-1, -1]), pairs


def align(page: Node, wrapper: Wrapper) -> int:
    """Simple tree matching: gives the page's nodes the wrapper nodes that they are aligned to; returns how many are."""
    if page.label != wrapper.label:
        return 0
    score: dict[tuple[int, int], int] = {}
    pairs_of: dict[tuple[int, int], list[tuple[int, int]]] = {}
    runs_of: dict[int, list[list[Node]]] = {}

    def weigh(a: Node, b: Wrapper) -> None:
        """The score of a pair, those of the pairs below it first."""
        todo = [(a, b)]
        while todo:
            x, w = todo[-1]
            key = (id(x), w.index)
            if key in score:
                todo.pop()
                continue
            if id(x) not in runs_of:
                runs_of[id(x)] = _runs(x.kids())
            runs = runs_of[id(x)]
            heads: dict[str, list[Node]] = {}
            for run in runs:
                heads.setdefault(run[0].label, []).append(run[0])
            missing = [(n, k) for k in w.kids for n in heads.get(k.label, ()) if (id(n), k.index) not in score]
            if missing:
                todo.extend(missing)
                continue
            total, pairs_of[key] = _matched(runs, w.kids, score)
            score[key] = total + 1
            todo.pop()

    n, todo = 0, [(page, wrapper)]
    while todo:
        a, b = todo.pop()
        a.index = b.index
        n += 1
        weigh(a, b)
        for i, j in pairs_of[id(a), b.index]:
            todo.extend((x, b.kids[j]) for x in runs_of[id(a)][i])
    return n


def blocks(node: Node, marked: bool = False) -> Iterator[tuple[Node, str]]:
    """(element, text) of the unmarked blocks in page order."""
    todo: list[tuple[Node, Iterator]] = [(node, iter(node.items))]
    while todo:
        own, items = todo[-1]
        x = next(items, None)
        if x is None:
            todo.pop()
        elif isinstance(x, str):
            if marked or not own.marked:
                yield own, x
        else:
            todo.append((x, iter(x.items)))


def _key(text: str) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _find(node: Node, ok) -> list[Node]:
    """The outermost unmarked elements that satisfy ``ok``, in page order."""
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if x.marked:
            continue
        if ok(x):
            out.append(x)
        else:
            todo.extend(reversed(x.kids()))
    return out


def main_text(page: Node, content: int | None, constants: set[tuple[int, int]]) -> str:
    """The text of an aligned page, by its host's content node and template texts."""
    found = _find(page, lambda n: n.index == content) if content is not None else []
    if all(f.tag in ("#", "html", "body") for f in found):  # none, or undecided
        labelled = _find(page, lambda n: n.tag in CONTENT_TAGS)
        found = [x for x in labelled if not found or x.index < 0] or found
    out = []
    for root in found or [page]:
        out += [t for n, t in blocks(root) if not constants or n.index < 0 or (n.index, _key(t)) not in constants]
    return "\n".join(out)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _wrappers(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(host, shape): the tree of each host's first page as JSON."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"host": pdf["host"], "shape": [json.dumps(shape_of(parse(h or ""))) for h in pdf["html"]]})

    first = pages.groupBy("host").agg(F.min(F.coalesce("page_id", F.lit((1 << 63) - 1))).alias("_first"))
    first = stored(spark, first, "hosts")  # with its size known, it is broadcast if it may be
    own = pages.join(first.withColumnRenamed("host", "_host"), (F.col("host") == F.col("_host")) & (F.coalesce("page_id", F.lit((1 << 63) - 1)) == F.col("_first")))
    own = own.groupBy("host").agg(F.min("html").alias("html"))  # of pages with one id, one
    return own.mapInPandas(rows, "host string, shape string")


def core_of(page: Node) -> int:
    """A hash of the longest unmarked texts that together hold half of all unmarked text."""
    own = sorted({t for _, t in blocks(page)}, key=lambda t: (-len(t), t))
    half, held, core = sum(map(len, own)) / 2, 0, []
    for t in own:
        if held >= half:
            break
        held += len(t)
        core.append(t)
    return _key("\n".join(core))


def _templates(spark: SparkSession, pages: DataFrame, wrappers: DataFrame, share: float) -> DataFrame:
    """(host, shape, constants, content): each host's wrapper, (node, text hash) of its template, and its content node."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Wrapper] = {}
        for batch in batches:
            out: list[tuple] = []
            for host, shape, h in zip(batch.column("host").to_pylist(), batch.column("shape").to_pylist(), batch.column("html").to_pylist(), strict=True):
                if len(known) > 1000:
                    known.clear()
                page, wrapper = parse(h or ""), known.get(shape) or known.setdefault(shape, Wrapper.of(json.loads(shape))[0])
                align(page, wrapper)
                said = {(n.index, _key(t)): (len(t), n.marked) for n, t in blocks(page, marked=True) if n.index >= 0}
                same = core_of(page)
                out += [(host, k[0], k[1], same, *v) for k, v in said.items()]
                out.append((host, -1, same, same, 0, False))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    schema = pa.schema([("host", pa.string()), ("node", pa.int32()), ("said", pa.int64()), ("page", pa.int64()), ("chars", pa.int64()), ("marked", pa.bool_())])
    texts = pages.join(wrappers, "host").select("host", "shape", "html").mapInArrow(slots, "host string, node int, said long, page long, chars long, marked boolean")
    texts = texts.groupBy("host", "node", "said", "page").agg(F.max("chars").alias("chars"), F.min("marked").alias("marked"))
    per = stored(spark, texts.groupBy("host", "node", "said").agg(F.count("*").alias("n"), F.first("chars").alias("chars"), F.min("marked").alias("marked")), "slots")
    pages_of = stored(spark, per.where("node < 0").groupBy("host").agg(F.sum("n").alias("pages")), "pages-of")
    # of few cores nearly all have to have it, of many the share
    least = F.greatest(F.lit(2.0), F.least(F.col("pages"), F.col("pages") * share + F.sqrt("pages") / 2))
    per = per.where("node >= 0").join(pages_of, "host").withColumn("fixed", F.col("n") >= least)
    # a text on fewer than 1 / share pages of a node: at most pages of the host / (pages * share) fixed texts per page
    fixed = per.where("fixed").groupBy("host").agg(F.collect_list(F.struct("node", "said")).alias("constants"))
    varying = per.where("not fixed and not marked").groupBy("host", "node").agg(F.sum(F.col("chars") * F.col("n")).alias("chars"))
    varying = varying.groupBy("host").agg(F.collect_list(F.struct("node", "chars")).alias("varying"))  # bounded by the wrapper

    def content(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for shape, varying in zip(pdf["shape"], pdf["varying"], strict=True):
                mass = {int(v["node"]): int(v["chars"]) for v in varying} if varying is not None else {}

                nodes = Wrapper.of(json.loads(shape))
                total = [0] * len(nodes)
                for n in reversed(nodes):  # preorder: children come after their parents
                    total[n.index] = mass.get(n.index, 0) + sum(total[k.index] for k in n.kids)
                node = nodes[0]
                while not _labelled(node):
                    own = total[node.index]
                    heavy = [k for k in node.kids if total[k.index] >= (LABELLED if _labelled(k) else NEARLY_ALL) * own and (k.kids or _labelled(k))] if own else []
                    if not heavy:
                        break
                    node = max(heavy, key=lambda k: total[k.index])
                found.append(node.index)
            yield pdf.assign(content=found)[["host", "shape", "constants", "content"]]

    hosts = wrappers.join(fixed, "host", "left").join(varying, "host", "left").select("host", "shape", "constants", "varying")
    return hosts.mapInPandas(content, "host string, shape string, constants array<struct<node:int,said:long>>, content int")


def extract(spark: SparkSession, pages: DataFrame, share: float = SHARE) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    own = own.withColumn("host", host_of(F.col("url")))
    wrappers = stored(spark, _wrappers(spark, own), "wrappers")
    templates = stored(spark, _templates(spark, own, wrappers, share), "templates")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[Wrapper, set]] = {}
        for batch in batches:
            texts = []
            for r, h in enumerate(batch.column("html").to_pylist()):
                host = batch.column("host")[r].as_py()
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    constants = batch.column("constants")[r].as_py() or []
                    known[host] = (Wrapper.of(json.loads(batch.column("shape")[r].as_py()))[0], {(c["node"], c["said"]) for c in constants})
                wrapper, constants = known[host]
                page = parse(h or "")
                align(page, wrapper)
                texts.append(main_text(page, batch.column("content")[r].as_py(), constants))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return own.join(templates, "host").select("page_id", "url", "host", "html", "shape", "constants", "content").mapInArrow(rows, "page_id long, url string, text string, n_chars long")


def op10_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, table(spark, sf_dir, "pages"))
