"""Main text of web pages by wrapper induction.

1. Every page becomes a skeleton: its DOM tree without text, runs of siblings of one shape
   folded to one node, each node with hashes and lengths of its own texts. Of more than
   ``WIDE`` siblings that are left, those of one label are folded wherever they stand (paths
   do not tell them apart). Nodes more than ``DEEP`` levels down belong to their ancestor there.
2. A host's pivot is a page of its most common outline (labels of the upper levels), the
   smallest one. Each distinct skeleton of the host is aligned with it by simple tree
   matching (order-preserving, same labels, most nodes). Only siblings of one label are paired,
   and the best order-preserving choice among pairs is found by a chain with prefix maxima,
   so a long table costs little more than its rows.
3. Texts of aligned nodes are counted per host and pivot node. A text on half of the host's
   distinct pages at one node is constant, others fill slots. The wrapper is the path of the
   deepest container that holds nine tenths of the slots' text outside menus, adverts, forms
   and the like, or of the article (else main) around it, and its template: the texts below
   that path which nine tenths of the host's distinct pages have at one node, if that is
   evidence that most of its pages do: share - sqrt(ln(1000) / (2 pages)) >= 1/2 (Hoeffding's
   bound, one in a thousand), the same test for every number of pages. A host whose template would be over a third of its content holds copies of one
   page; it gets none. Hosts of too few pages to tell take the wrapper that holds the most
   slot text over all hosts that can tell.
4. A page's text is what lies below the wrapper's path, without the template's texts and
   without nested parts of a boilerplate role. No page is tried against another host's
   wrapper, so the result does not depend on the input's size.

Only skeletons and counts move between tasks, keyed by host with partial aggregation.
Pages are read again for step 4 and joined with their own host's wrapper: where they lie
if at most ``broadcast_paths`` hosts have one, as Spark chooses if more do. All walks over
trees keep their own stack, so the depth of a page has no bound.

Cases. Null and empty html: empty text. No element matches the wrapper: article, else
main, else body, else the whole page. Null url: a host of its own. Null or repeated
page_id: each row by itself; a page that another repeats counts once in step 3. Very long
pages are read whole. Ties: smaller page, longer path. Broken markup: missing end tags are
closed by what follows, stray ones ignored, an unfinished page ends where it ends. Empty
table: no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import settle, table

#: HTML's void, raw-text and block elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe xmp noembed noframes".split())
BLOCK = set(
    "html body article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre "
    "figure figcaption main nav header footer aside form fieldset hr address details summary center head title dialog menu".split()
)
#: Start tags that end an open element of the second kind.
ENDS = {**dict.fromkeys(BLOCK - {"html", "body"}, {"p"}), "li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "tr": {"p", "tr", "td", "th"}, "td": {"p", "td", "th"}, "th": {"p", "td", "th"}, "option": {"option"}}
SCOPE = set("ul ol dl table article section div body html main aside nav form blockquote td th".split())
CONTAINERS = "html body main article section div center table tbody tr td".split()
#: Roles that are never main text: by element, and by whole class, id or role of the elements of ASIDE_ON.
ASIDE_TAGS = set("head nav header footer aside form script style noscript template iframe svg canvas object button select textarea title dialog menu".split())
ASIDE_ON = set("div section ul ol table".split())
ASIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert newsletter subscribe "
    "subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments commentlist reply replies disqus social share sharing "
    "related popup modal widget login signup search toolbar pagination pager contentinfo complementary dialog".split()
)
#: Levels of a page that wrappers tell apart, and siblings whose places are told apart.
DEEP, WIDE = 40, 32
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Node:
    __slots__ = ("tag", "label", "aside", "parts")

    def __init__(self, tag: str, attributes: str):
        self.tag = tag
        self.parts: list = []  # texts and nodes in order
        self.label, self.aside = tag, tag in ASIDE_TAGS
        if attributes:
            words: set[str] = set()
            classes: list[str] = []
            for name, *values in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), next((v for v in values if v), "").lower()
                if name in ("class", "id", "role"):
                    words |= set(value.split())
                    if name == "class":
                        classes = sorted(value.split())
                elif name == "hidden":
                    self.aside = True
            if classes:
                self.label = tag + "." + ".".join(classes).replace("/", "_")
            self.aside = self.aside or (tag in ASIDE_ON and bool(words & ASIDE_WORDS))


def parse(page: str) -> Node:
    """A tolerant DOM tree; character references are decoded."""
    root = Node("#", "")
    stack, at, n = [root], 0, len(page)
    opened: Counter = Counter()  # tags on the stack
    while at < n:
        m = TAG.search(page, at)
        text = page[at : m.start() if m else n]
        if text:
            stack[-1].parts.append(entities.unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        close, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if close:
            while opened[tag] > 0:
                last = stack.pop().tag
                opened[last] -= 1
                if last == tag:
                    break
            continue
        if tag in ENDS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ENDS[tag]:
                    opened.subtract(x.tag for x in stack[k:])
                    del stack[k:]
                    break
                if stack[k].tag in SCOPE:
                    break
        node = Node(tag, attributes)
        stack[-1].parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if tag in ("title", "textarea"):
                node.parts.append(entities.unescape(page[at : end.start() if end else n]))
            at = end.end() if end else n
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            stack.append(node)
            opened[tag] += 1
    return root


def own_text(node: Node) -> tuple[str, list[Node]]:
    """Text of ``node`` outside nested blocks, and those blocks (and parts of a boilerplate role)."""
    out, kids, todo = [], [], list(reversed(node.parts))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.tag in BLOCK or x.tag in RAW or x.aside:
            kids.append(x)
        elif x.tag == "br":
            out.append(" ")
        else:
            todo += reversed(x.parts)
    return " ".join("".join(out).split()), kids


def blocks(node: Node, dropped: set[int] = frozenset()) -> list[str]:
    """Texts of the blocks below ``node`` in page order, without parts of a boilerplate role.

    ``dropped`` has the id() of blocks whose own text goes.
    """
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()

    todo: list = [(node, False, node)]
    while todo:
        x, leaving, block = todo.pop()
        if leaving:
            flush()
        elif isinstance(x, str):
            if id(block) not in dropped:
                line.append(x)
        elif not x.aside:
            if x.tag == "br":
                line.append(" ")
            if x.tag in BLOCK:
                flush()
                todo.append((x, True, block))
                block = x
            todo += [(p, False, block) for p in reversed(x.parts)]
        elif x.tag in BLOCK:
            flush()
    flush()
    return out


def text_hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) << 16 | len(text) & 0xFFFF


def _folded(nodes: list[list]) -> None:
    """Fold siblings, in place: runs of one shape, and of many siblings all of one label."""
    shape: list[int] = [0] * len(nodes)
    kinds: dict[tuple, int] = {}

    def named(i: int) -> int:
        """The number of a node's shape: its label and the shapes below."""
        return kinds.setdefault((*nodes[i][:2], *(shape[k] for k in nodes[i][3])), len(kinds) + 1)

    def absorb(into: int, other: int) -> None:
        """Give the texts of a subtree to one of the same shape."""
        todo = [(into, other)]
        while todo:
            x, y = todo.pop()
            nodes[x][2] += nodes[y][2]
            todo += zip(nodes[x][3], nodes[y][3])

    def unite(into: int, other: int) -> None:
        """Give a subtree to one of the same label: children of one label are one."""
        todo, changed = [(into, other)], []
        while todo:
            x, y = todo.pop()
            changed.append(x)
            nodes[x][2] += nodes[y][2]
            at = {}
            for k in [*nodes[x][3], *nodes[y][3]]:
                own = tuple(nodes[k][:2])
                if own in at:
                    todo.append((at[own], k))
                else:
                    at[own] = k
            nodes[x][3] = list(at.values())
        for x in reversed(changed):
            shape[x] = named(x)

    for i in range(len(nodes) - 1, -1, -1):  # children come after their parents
        node = nodes[i]
        kids: list[int] = []
        for k in node[3]:
            if kids and shape[kids[-1]] == shape[k]:
                absorb(kids[-1], k)
            else:
                kids.append(k)
        if len(kids) > WIDE:
            at: dict[tuple, int] = {}
            for k in kids:
                own = tuple(nodes[k][:2])
                if own in at:
                    unite(at[own], k)
                else:
                    at[own] = k
            kids = list(at.values())
        node[3] = kids
        shape[i] = named(i)


def skeleton(root: Node) -> list[list]:
    """Nodes in page order: [label, aside, [[hash, length] of own texts], places of children]."""
    nodes: list[list] = []
    todo = [(root, -1, 0)]
    while todo:
        x, parent, depth = todo.pop()
        text, kids = ("", []) if x.aside else own_text(x)
        own = [[text_hash(text), len(text)]] if text else []
        if depth > DEEP:
            nodes[parent][2] += own
        else:
            if parent >= 0:
                nodes[parent][3].append(len(nodes))
            parent = len(nodes)
            nodes.append([x.label, int(x.aside), own, []])
        todo += [(k, parent, depth + 1) for k in reversed(kids)]
    _folded(nodes)
    order, todo = [], [0]
    while todo:
        order.append(todo.pop())
        todo += reversed(nodes[order[-1]][3])
    place = {k: i for i, k in enumerate(order)}
    return [[*nodes[k][:3], [place[c] for c in nodes[k][3]]] for k in order]


def outline(tree: list[list], levels: int = 3) -> int:
    """Hash of the labels of the upper levels."""
    level, labels = [0], []
    for _ in range(levels):
        level = [c for k in level for c in tree[k][3]]
        labels.append([tree[k][0] for k in level])
    return zlib.crc32(json.dumps(labels).encode())


def _chain(xs: list[int], ys: list[int], score: dict[tuple[int, int], int], a: list[list], b: list[list]) -> tuple[int, list[tuple[int, int]]]:
    """(score, pairs) of the best order-preserving choice of pairs of one label."""
    where: dict[str, list[int]] = {}
    for m, y in enumerate(ys):
        where.setdefault(b[y][0], []).append(m)
    best = [(0, -1)] * (len(ys) + 1)  # greatest score of chains that end before a place, as prefix maxima
    chains: list[tuple[int, int, int]] = []  # x, y, chain before
    for x in xs:
        for m in reversed(where.get(a[x][0], ())):
            s = score.get((x, ys[m]), 0)
            total, before = (0, -1)
            k = m
            while k:
                if best[k][0] > total:
                    total, before = best[k]
                k &= k - 1
            if s:
                chains.append((x, ys[m], before))
                new = total + s, len(chains) - 1
                k = m + 1
                while k <= len(ys):
                    if best[k][0] < new[0]:
                        best[k] = new
                    k += k & -k
    total, last = 0, -1
    k = len(ys)
    while k:
        if best[k][0] > total:
            total, last = best[k]
        k &= k - 1
    pairs = []
    while last >= 0:
        x, y, last = chains[last]
        pairs.append((x, y))
    return total, pairs


def match_scores(a: list[list], b: list[list]) -> dict[tuple[int, int], int]:
    """Simple tree matching: for each pair of nodes that can meet, the nodes of the largest
    order-preserving match of equal labels below them, root on root."""
    pairs = [(0, 0)] if a[0][0] == b[0][0] else []
    for i, j in pairs:  # grows: pairs of children come after their parents
        of: dict[str, list[int]] = {}
        for y in b[j][3]:
            of.setdefault(b[y][0], []).append(y)
        for x in a[i][3]:
            pairs += [(x, y) for y in of.get(a[x][0], ())]
    score: dict[tuple[int, int], int] = {}
    for i, j in reversed(pairs):
        score[i, j] = 1 + _chain(a[i][3], b[j][3], score, a, b)[0]
    return score


def tree_match(a: list, b: list) -> int:
    """Nodes of the largest match of two nested trees [label, ..., children], root on root."""

    def flat(tree: list) -> list[list]:
        nodes = [[tree[0], 0, [], tree[-1]]]
        for node in nodes:  # grows by the children
            node[3], nested = list(range(len(nodes), len(nodes) + len(node[3]))), node[3]
            nodes += [[c[0], 0, [], c[-1]] for c in nested]
        return nodes

    return match_scores(flat(a), flat(b)).get((0, 0), 0)


def align(pivot: list[list], page: list[list]) -> list[tuple[int, str, int, int, int]]:
    """(pivot node, label path, aside, hash, length) of the texts of a page; node -1: unmatched."""
    score = match_scores(pivot, page)
    found: Counter = Counter()
    todo = [(0 if score else -1, 0, page[0][0], 0)]
    while todo:
        i, j, path, aside = todo.pop()
        aside |= page[j][1]
        for h, n in page[j][2]:
            found[i, path, aside, h] += n
        xs, ys = pivot[i][3] if i >= 0 else [], page[j][3]
        partner = {y: x for x, y in _chain(xs, ys, score, pivot, page)[1]} if xs and ys else {}
        todo += [(partner.get(y, -1), y, f"{path}/{page[y][0]}", aside) for y in ys]
    return [(*key, n) for key, n in found.items()]


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        trees = [skeleton(parse(p or "")) for p in batch.column(2).to_pylist()]
        texts = pa.array([json.dumps(t, separators=(",", ":")) for t in trees], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(outline, trees), pa.int64()), texts], names=["page_id", "host", "outline", "tree"])


def _alignments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pivots: dict[str, list] = {}
    for batch in batches:
        rows = []
        for host, tree, pivot in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if host not in pivots:
                if len(pivots) > 100:
                    pivots.clear()
                pivots[host] = json.loads(pivot)
            rows += [(host, *r) for r in align(pivots[host], json.loads(tree))]
        columns = list(zip(*rows)) or [()] * 6
        types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["host", "node", "path", "aside", "hash", "length"])


def _within(path: str, wrapper: str) -> Column:
    return (F.col(path) == F.col(wrapper)) | F.startswith(F.col(path), F.concat(wrapper, F.lit("/")))


def induce(pages: DataFrame, least_pages: int = 3, broadcast_hosts: int = 1000) -> tuple[DataFrame, str]:
    """((host, wrapper, template) of hosts that can tell, wrapper of all other hosts)."""
    pages = pages.select("page_id", host_of(F.col("url")).alias("host"), "html")
    trees = settle(pages.mapInArrow(_skeletons, "page_id long, host string, outline long, tree string"), "skeletons")
    # A page of the host's most common outline; copies of a page count once.
    outlines = trees.groupBy("host", "outline").agg(F.min_by("tree", F.struct("page_id", "tree")).alias("pivot"), F.count(F.lit(1)).alias("n"))
    pivots = outlines.groupBy("host").agg(F.max_by("pivot", F.struct("n", "outline")).alias("pivot"), F.sum("n").alias("pages"))
    distinct = trees.groupBy("host", F.md5("tree").alias("mark")).agg(F.first("tree").alias("tree")).select("host", "tree")
    texts_of = distinct.join(pivots.select("host", "pivot"), "host").select("host", "tree", "pivot")
    texts = texts_of.mapInArrow(_alignments, "host string, node long, path string, aside long, hash long, length long")
    texts = settle(texts.groupBy("host", "node", "path", "aside", "hash").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("length")), "node-texts")
    pages_of = settle(pivots.select("host", "pages").join(distinct.groupBy("host").agg(F.count(F.lit(1)).alias("kinds")), "host"), "host-pages")
    # Rows of a busy host stay where they are if few hosts allow it.
    few = (lambda of: F.broadcast(of)) if pages_of.limit(broadcast_hosts + 1).count() <= broadcast_hosts else (lambda of: of)
    texts = texts.where("aside = 0").join(few(pages_of), "host")
    slots = texts.where("n = 1 OR n * 2 < kinds").groupBy("host", "path").agg(F.sum("length").alias("length"))
    # Every ancestor holds what its descendants hold.
    steps = F.split("path", "/")
    prefix = F.explode(F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/")))
    tag = F.regexp_extract("wrapper", r"([^/.]+)[^/]*$", 1)
    held = settle(slots.select("host", prefix.alias("wrapper"), "length").groupBy("host", "wrapper").agg(F.sum("length").alias("held")).where(tag.isin("#", *CONTAINERS)), "slot-text")
    deepest = F.max_by("wrapper", F.struct(F.size(F.split("wrapper", "/")), "held", "wrapper")).alias("wrapper")
    inside = [F.regexp_extract("wrapper", rf"^(.*?/{x}(?:\.[^/]*)?)(?:/|$)", 1) for x in ("article", "main")]
    around = F.coalesce(*(F.when(x != "", x) for x in inside), F.col("wrapper"))
    most = held.groupBy("host").agg(F.max("held").alias("whole")).join(pages_of.where(F.col("pages") >= least_pages).select("host"), "host")
    wrappers = held.join(few(most), "host").where("held * 10 >= whole * 9").groupBy("host").agg(deepest).withColumn("wrapper", around)

    below = texts.join(few(wrappers), "host").where(_within("path", "wrapper"))
    share = F.col("n") / F.col("kinds")
    same = (share >= 0.9) & (share - F.sqrt(F.log(F.lit(1000.0)) / (2 * F.col("kinds"))) >= 0.5) & (F.col("node") >= 0)
    known = F.concat_ws(":", "hash", "path")
    template = below.groupBy("host").agg(F.sum("length").alias("whole"), F.sum(F.when(same, F.col("length"))).alias("fixed"), F.collect_set(F.when(same, known)).alias("template"))
    template = template.where("fixed * 3 <= whole").select("host", "template")
    every = held.join(few(most.select("host")), "host").groupBy("wrapper").agg(F.sum("held").alias("held"))
    whole = every.agg(F.max("held")).first()[0] or 0
    usual = every.where(F.col("held") * 10 >= whole * 9).agg(deepest).withColumn("wrapper", around).first()[0]
    return settle(wrappers.join(template, "host", "left"), "wrappers"), usual or "#/html/body/article"


def learn_wrappers(pages: DataFrame) -> tuple[DataFrame, str]:
    """((host, wrapper) of hosts that can tell, wrapper of all other hosts)."""
    known, usual = induce(pages)
    return known.select("host", "wrapper"), usual


def _below(root: Node, path: str) -> list[Node]:
    found = [root]
    for label in path.split("/")[1:]:
        found = [c for x in found for c in x.parts if not isinstance(c, str) and c.label == label and not c.aside]
    return found


def _first(root: Node, tag: str) -> list[Node]:
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        if x.tag == tag:
            out.append(x)
        else:
            todo += [c for c in reversed(x.parts) if not isinstance(c, str)]
    return out


def _constant(root: Node, template: set[str]) -> set[int]:
    """id() of the blocks whose own text is one of the template."""
    out, todo = set(), [(root, root.label, 0)]
    while todo:
        x, path, depth = todo.pop()
        if not x.aside:
            text, kids = own_text(x)
            if text and f"{text_hash(text)}:{path}" in template:
                out.add(id(x))
            todo += [(k, path if depth >= DEEP else f"{path}/{k.label}", depth + 1) for k in kids]
    return out


def main_text(page: str | None, path: str, template: list[str] | None = None) -> str:
    """What lies below the wrapper's ``path`` without its template, else the article, main or body."""
    root = parse(page or "")
    nodes = _below(root, path)
    dropped = _constant(root, set(template)) if nodes and template else set()
    nodes = nodes or _first(root, "article") or _first(root, "main") or _first(root, "body") or [root]
    return "\n".join(b for x in nodes for b in blocks(x, dropped))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(*x) for x in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, broadcast_paths: int = 1000) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    wrappers, usual = induce(pages, broadcast_hosts=broadcast_paths)
    if wrappers.limit(broadcast_paths + 1).count() <= broadcast_paths:
        wrappers = F.broadcast(wrappers)
    own = pages.withColumn("host", host_of(F.col("url"))).join(wrappers, "host", "left")
    chosen = own.select("page_id", "url", "html", F.coalesce("wrapper", F.lit(usual)).alias("wrapper"), "template")
    return chosen.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every row of ``pages``."""
    return extract_pages(table(spark, sf_dir, "pages"))
