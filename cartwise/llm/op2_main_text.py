"""HTML extraction by wrapper induction.

Pages become trees of blocks; text in the line belongs to its block. Siblings of one label (tag, classes, whether tag,
role or class call it no content) that follow each other are one repeated node. All pages of a host are aligned by simple
tree matching: the most pairs of equal labels that keep order and ancestry. The wrapper is the union of the trees. Then
each page is aligned with its host's whole wrapper, and Spark sums on how many different pages each text stands at each
node (and at each path of labels that several nodes share). Texts on CONSTANT of the pages that have text there, of at
least MIN_PAGES, are template; the others are slots. Content lies where most of a host's varying text is; menus, headers,
sidebars, notices, adverts, forms, comments by tag, role or class are out unless they hold more than half of it, and
``article`` or ``main`` bound it if they hold half of the rest. Hosts of fewer than MIN_PAGES different pages go by tags,
roles and classes alone. An element that holds the marked article is never out. Scripts and styles always are.

Each task leaves one wrapper for each host, merged by a salt and then by host, so that a host with any number of pages
meets in at most SALTS wrappers. A page is parsed once: its tree, without what is never shown, is stored in the shared
folder, and wrappers, counts and texts are made from that. Counts are exact for a given wrapper; where several alignments score alike, the order
of merging decides the wrapper's shape. Wrappers go to all tasks if they are at most SENT_BYTES in all, and are joined by
host and salt otherwise.

Null, empty and broken pages give what text there is, else an empty one; a null url is the host ''. Elements
beyond DEPTH are closed by their own end tags and places in them that are no content are left out; only their
nodes are folded into the one at DEPTH. Repeated rows are extracted alike. Columns besides those named are not looked at.
"""

from __future__ import annotations

import json
import marshal
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import common as C
from cartwise.llm.op9_url_filter import url_parts
from cartwise.session import materialize

CONSTANT, MIN_PAGES = 0.9, 8
SALTS, SENT_BYTES, DEPTH = 32, 8 << 20, 60
#: Pages whose trees are handed on at once.
SLICE = 500

#: Fixed values of HTML: elements without content, without shown text, in the line, and what a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSHOWN = frozenset("head script style noscript template iframe object svg math canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
CLOSES = {
    **dict.fromkeys("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split(), ("p",)),
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",), "body": ("head",),
    "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tr", "td", "th"),
}
SCOPE = frozenset("html body table ul ol dl div section article main aside nav header footer form blockquote fieldset".split())
#: Places that are no content: tags, roles and words of class and id.
OUT_TAGS = UNSHOWN | frozenset("nav footer aside form button select textarea input dialog menu".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs "
    "masthead footer sidebar aside widget related recommended share sharing social comment comments disqus discussion reply "
    "replies respond notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login search "
    "toolbar pagination pager hidden copyright disclaimer".split()
)
OWN_WORDS = frozenset("article post entry story title headline".split())


class Node:
    __slots__ = ("label", "tag", "out", "children", "place")

    def __init__(self, label: str, tag: str, out: bool):
        self.label, self.tag, self.out = sys.intern(f"{label} !" if out else label), sys.intern(tag), out
        self.children: list[Node | str] = []
        self.place = 0


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", "", False)
        #: Of each open element: its tag, the node that takes its content, what it adds to ``count``.
        self.open = [("", self.root, ())]
        self.count = Counter()

    def cut(self, i):
        """Closes the open elements from place ``i`` on."""
        while len(self.open) > i:
            tag, node, counted = self.open.pop()
            self.count.subtract(counted)
            if counted[-1] == "flat" and tag not in INLINE:
                node.children.append("\n")

    def handle_starttag(self, tag, attrs):
        for closed in CLOSES.get(tag, ()):
            for i in range(len(self.open) - 1, 0, -1) if self.count[closed] else ():
                if self.open[i][0] == closed:
                    self.cut(i)
                    break
                if self.open[i][0] in SCOPE:
                    break
        got = {k: v or "" for k, v in attrs}
        names = f"{got.get('class', '')} {got.get('id', '')}".lower()
        words = set(re.split(r"[^a-z]+", names))
        inside = self.count["article"] > 0 or self.count["main"] > 0
        out = (
            tag in OUT_TAGS
            or tag == "header" and not inside
            or got.get("role", "").lower() in OUT_ROLES
            or bool(words & OUT_WORDS)
            or "header" in words and not inside and not words & OWN_WORDS
            or "hidden" in got
            or "display:none" in got.get("style", "").replace(" ", "").lower()
        )
        label = " ".join([tag, *sorted(re.sub(r"[\W\d_]+", "", w) for w in got.get("class", "").lower().split())])
        node, parent = Node(label, tag, out and tag not in ("html", "body")), self.open[-1][1]
        if tag in VOID:
            parent.children.append(node)
            return
        counted = (tag,)
        if len(self.open) >= DEPTH:
            # Deeper elements are open like others, but only places out of the content, articles and links get a node.
            kind = "deep out" if node.out else "deep mark" if tag in ("article", "main") else "deep a" if tag == "a" else "flat"
            if kind == "flat" or self.count[kind]:
                if tag not in INLINE:
                    parent.children.append("\n")
                self.open.append((tag, parent, (tag, "flat")))
                self.count.update((tag, "flat"))
                return
            counted = (tag, kind)
        parent.children.append(node)
        self.open.append((tag, node, counted))
        self.count.update(counted)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.cut(len(self.open) - 1)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1) if self.count[tag] else ():
            if self.open[i][0] == tag:
                self.cut(i)
                return
            if self.open[i][0] in SCOPE and tag not in SCOPE:
                return

    def handle_data(self, data):
        self.open[-1][1].children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    try:
        builder.feed(html or "")
        builder.close()
    except (AssertionError, ValueError):  # the parser gives up on some broken declarations
        rest = builder.rawdata
        if rest:
            builder.handle_data(re.sub(r"<[^>]*>?", " ", rest))
    return builder.root


def packed(root: Node) -> bytes:
    """A tree without its unshown elements, which no step looks at."""

    def walk(node):
        children = [c if isinstance(c, str) else walk(c) for c in node.children if isinstance(c, str) or c.tag not in UNSHOWN]
        return node.label, node.tag, node.out, children

    return marshal.dumps(walk(root))


def unpacked(tree: bytes) -> Node:
    def walk(given):
        node = Node.__new__(Node)
        node.label, node.tag, node.out, children = given
        node.children = [c if isinstance(c, str) else walk(c) for c in children]
        node.place = 0
        return node

    return walk(marshal.loads(tree))


def _elements(node: Node) -> list[Node]:
    return [c for c in node.children if isinstance(c, Node)]


def _blocks(node: Node) -> Iterator[Node]:
    """The blocks in a node, also those inside its elements in the line."""
    for child in _elements(node):
        if child.tag in INLINE and not child.out:
            yield from _blocks(child)
        elif child.tag not in UNSHOWN and child.tag not in VOID:
            yield child


def _own_text(node: Node) -> str:
    """The text of a block with that of its elements in the line, without that of blocks in it."""
    parts: list[str] = []

    def walk(n):
        for child in n.children:
            if isinstance(child, str):
                parts.append(child)
            elif child.tag in INLINE and not child.out:
                walk(child)

    walk(node)
    return " ".join("".join(parts).split())


def _hash(text: str) -> int:
    """64 bits; never 0."""
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) or 1


def skeleton(node: Node) -> list:
    """[label, blocks, place, varied, children]: a page as a wrapper of one page. Siblings of one label that follow
    each other are one repeated node that knows all its blocks; their texts are counted one by one (``_counted``)."""
    runs: list[list] = []
    for child in _blocks(node):
        made = skeleton(child)
        if runs and runs[-1][0] == made[0]:
            runs[-1] = _merged(runs[-1], made)
        else:
            runs.append(made)
    return [node.label, [node], 0, 0, runs]


def _shape(wrapper: list) -> list:
    """Labels and children alone."""
    return [wrapper[0], [_shape(c) for c in wrapper[4]]]


def _wrapper(shape: list) -> list:
    return [shape[0], [], 0, 0, [_wrapper(c) for c in shape[1]]]


def _nodes(wrapper: list) -> Iterator[list]:
    yield wrapper
    for child in wrapper[4]:
        yield from _nodes(child)


def _matching(a: list, b: list) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two lists of children: the score and the pairs of places."""
    # Children whose label the other side lacks have no partner; without them the tables stay small.
    labels = {x[0] for x in a} & {y[0] for y in b}
    if not labels:
        return 0, []
    at, bt = ([i for i, x in enumerate(side) if x[0] in labels] for side in (a, b))
    a, b = [a[i] for i in at], [b[j] for j in bt]
    weights = [[0] * len(b) for _ in a]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            if x[0] == y[0]:
                weights[i][j] = 1 + (_matching(x[4], y[4])[0] if x[4] and y[4] else 0)
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        row, above, weight = best[i + 1], best[i], weights[i]
        for j in range(len(b)):
            row[j + 1] = max(row[j], above[j + 1], above[j] + weight[j])
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((at[i], bt[j]))
    return best[-1][-1], pairs[::-1]


def _merged(a: list, b: list) -> list:
    """The union of two aligned wrappers."""
    _, pairs = _matching(a[4], b[4])
    children, i, j = [], 0, 0
    for x, y in [*pairs, (len(a[4]), len(b[4]))]:
        children += a[4][i:x] + b[4][j:y]
        if x < len(a[4]):
            children.append(_merged(a[4][x], b[4][y]))
        i, j = x + 1, y + 1
    return [a[0], a[1] + b[1], 0, 0, children]


class Wrapper:
    """The wrapper of a host: aligned nodes, numbered; with counts, what is template and where content lies."""

    def __init__(self, text: str, facts: str | None = None):
        self.root, self.classes, self.known = _wrapper(json.loads(text)), {}, {}
        paths: dict[tuple, list[int]] = {}
        number = 0

        def walk(w, path):
            nonlocal number
            number += 1
            w[2] = number
            paths.setdefault(path, []).append(number)
            for c in w[4]:
                walk(c, (*path, c[0]))

        walk(self.root, ())
        #: Places of one path of labels, by which texts are counted too: alignment may deal them differently by page.
        self.classes = {n: -same[0] for same in paths.values() if len(same) > 1 for n in same}
        self.template: set[tuple[int, int]] = set()
        self.content: set[int] = set()
        self.marks, self.counts = True, bool(facts)
        if facts:
            given = json.loads(facts)
            self.template = {tuple(t) for t in given["template"]}
            self._choose({place: n for place, n in given["varied"]})

    def _choose(self, varied: dict[int, int]) -> None:
        """Content lies where most of the varying text is. Tags, roles and words of class decide the rest: a place that
        they call no content is content if it holds more than half; article and main bound it if they hold half."""
        total: dict[int, int] = {}

        def add(w):
            total[w[2]] = varied.get(w[2], 0) + sum(map(add, w[4]))
            return total[w[2]]

        add(self.root)
        if not total[1]:
            return
        self.content = {w[2] for w in _nodes(self.root) if w[0].endswith(" !") and 2 * total[w[2]] > total[1]}

        def seen(w, marked):
            """Varying text in content places, and of it in article or main."""
            if w[0].endswith(" !") and w[2] not in self.content:
                return 0, 0
            marked = marked or w[0].split(" ")[0] in ("article", "main")
            own = varied.get(w[2], 0)
            parts = [seen(c, marked) for c in w[4]]
            return own + sum(p[0] for p in parts), (own if marked else 0) + sum(p[1] for p in parts)

        shown, marked = seen(self.root, False)
        self.marks = 2 * marked >= shown

    def align(self, root: Node) -> None:
        """Gives the page's blocks the places of the wrapper's nodes; pages of one shape are aligned once."""
        page = skeleton(root)
        shape = _hash(json.dumps(_shape(page)))
        if shape not in self.known:

            def walk(w, p):
                p[2] = w[2]
                for i, j in _matching(w[4], p[4])[1]:
                    walk(w[4][i], p[4][j])

            walk(self.root, page)
            if len(self.known) > 50:
                self.known.clear()
            self.known[shape] = [run[2] for run in _nodes(page)]
        for run, place in zip(_nodes(page), self.known[shape], strict=True):
            for node in run[1]:
                node.place = place

    def constant(self, node: Node) -> bool:
        if not self.template or not node.place:
            return False
        text = _own_text(node)
        made = _hash(text) if text else 0
        return (node.place, made) in self.template or (self.classes.get(node.place), made) in self.template

    def counted(self, root: Node) -> dict[tuple[int, int], int]:
        """Characters by (place, text's hash) of an aligned page; hash 0 is the place as a whole."""
        found: dict[tuple[int, int], int] = {(1, 0): 0}

        def walk(node):
            text = _own_text(node) if node.place else ""
            if text:
                made = _hash(text)
                for place in {node.place, self.classes.get(node.place, node.place)}:
                    for key in ((place, made), (place, 0)):
                        found[key] = found.get(key, 0) + len(text)
            for child in _blocks(node):
                walk(child)

        walk(root)
        return found


def _links(node: Node) -> tuple[int, int, int]:
    """Characters of text, of link text, and links."""
    text = sum(len(c.strip()) for c in node.children if isinstance(c, str))
    inside, links = 0, 0
    for child in _elements(node):
        if child.tag not in UNSHOWN:
            t, i, n = _links(child)
            text, inside, links = text + t, inside + (t if child.tag == "a" else i), links + n + (child.tag == "a")
    return text, inside, links


def main_text(root: Node, wrapper: Wrapper | None) -> str:
    """The content of a page: the slots of its wrapper that lie in content places."""
    if wrapper:
        wrapper.align(root)
    content_places = wrapper.content if wrapper else ()
    marked: list[Node] = []
    around: set[int] = set()

    def mark(node, tag, above, enter):
        for child in _elements(node):
            if child.tag in UNSHOWN or child.out and child.place not in content_places and (not enter or child.tag == tag):
                continue
            if child.tag == tag:
                marked.append(child)
                around.update(map(id, above))
            else:
                mark(child, tag, (*above, child), enter)

    # An article inside a place that is no content by its class counts only where no other is.
    for tag, enter in (("article", False), ("main", False), ("article", True), ("main", True)):
        if not marked and (not wrapper or wrapper.marks):
            mark(root, tag, (), enter)
    inside = {id(n) for n in marked}
    blocks: list[list[str]] = [[]]

    def walk(node, content, constant):
        for child in node.children:
            if isinstance(child, str):
                if content and not constant:
                    blocks[-1].append(child)
            elif child.tag == "br":
                blocks[-1].append("\n")
            elif not child.out or child.place in content_places and child.place or id(child) in around:
                block = child.tag not in INLINE or child.out
                if block:
                    if not marked and child.tag in ("ul", "ol", "div", "p", "table"):
                        text, linked, links = _links(child)
                        if links > 2 and linked > 0.6 * text:
                            continue
                    blocks.append([])
                walk(child, content or id(child) in inside, wrapper is not None and wrapper.constant(child) if block else constant)
                if block:
                    blocks.append([])

    walk(root, not marked, wrapper is not None and wrapper.constant(root))
    return " ".join(filter(None, (" ".join("".join(b).split()) for b in blocks)))


def parsed(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep``, _host, _page (a hash of the html, null for none) and _tree of every row of ``pages`` (url, html), stored."""
    host, _ = url_parts(F.col("url"))
    number = F.when(F.col("html").isNotNull(), F.xxhash64("html"))
    rows = pages.select(*keep, F.coalesce(host, F.lit("")).alias("_host"), number.alias("_page"), F.col("html").alias("_html"))
    columns = C.with_fields(rows.drop("_html").schema, _tree="binary")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                trees = [packed(parse(html.as_py())) for html in part.column("_html")]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(trees, pa.binary())], names=columns.names)

    return materialize(rows.mapInArrow(run, columns), "trees")


def induce(trees: DataFrame) -> DataFrame:
    """(host, wrapper as JSON) of all pages of each host of ``trees`` (_host, _page, _tree)."""

    def run(batches):
        wrappers: dict[str, list] = {}
        seen: set[tuple[str, str]] = set()
        for batch in batches:
            for host, tree in zip(batch.column("_host").to_pylist(), batch.column("_tree"), strict=True):
                shape = _shape(skeleton(unpacked(tree.as_py())))
                key = (host, _hash(json.dumps(shape)))
                if key in seen:
                    continue
                seen.add(key)
                wrappers[host] = _merged(wrappers[host], _wrapper(shape)) if host in wrappers else _wrapper(shape)
                if len(wrappers) > 5000:
                    yield out(wrappers)
                    wrappers = {}
            if len(seen) > 500_000:
                seen.clear()
        if wrappers:
            yield out(wrappers)

    def out(wrappers):
        made = [json.dumps(_shape(w)) for w in wrappers.values()]
        salt = [zlib.crc32(w.encode()) % SALTS for w in made]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(wrappers)), pa.array(salt, pa.int32()), pa.array(made)], names=["host", "salt", "wrapper"]
        )

    def merged(key, found):
        made = None
        for text in sorted(set(found.column("wrapper").to_pylist())):
            made = _wrapper(json.loads(text)) if made is None else _merged(made, _wrapper(json.loads(text)))
        return pa.table({"host": [key[0].as_py()], "wrapper": [json.dumps(_shape(made))]})

    parts = trees.where("_page is not null").select("_host", "_tree").mapInArrow(run, "host string, salt int, wrapper string")
    some = parts.groupBy("host", "salt").applyInArrow(merged, "host string, wrapper string")
    return some.groupBy("host").applyInArrow(merged, "host string, wrapper string")


def _with_wrappers(rows: DataFrame, wrappers: DataFrame):
    """``rows`` (_host, _page, _tree, others), and what gives each batch's (host, root, wrapper) in a task."""
    size = wrappers.agg(F.sum(F.length("wrapper") + F.coalesce(F.length("facts"), F.lit(0)) + F.length("host") + 64)).first()[0] or 0
    sent = None
    if size <= SENT_BYTES:
        sent = rows.sparkSession.sparkContext.broadcast({r.host: (r.wrapper, r.facts) for r in wrappers.collect()})
        joined = rows
    else:
        salt = F.pmod("_page", F.lit(SALTS)).alias("_salt")
        each = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
        salted = wrappers.select(F.col("host").alias("_host"), F.col("wrapper").alias("_wrapper"), F.col("facts").alias("_facts"), each)
        joined = rows.withColumn("_salt", F.coalesce(salt, F.lit(0))).join(salted, ["_host", "_salt"], "left")
    made: dict = {}

    def pages_of(batch):
        hosts = batch.column("_host").to_pylist()
        if sent is None:
            given = zip(batch.column("_wrapper").to_pylist(), batch.column("_facts").to_pylist(), strict=True)
        else:
            given = (sent.value.get(host, (None, None)) for host in hosts)
        for host, tree, (text, facts) in zip(hosts, batch.column("_tree"), given, strict=True):
            if host not in made:
                if len(made) > 2000:
                    made.clear()
                made[host] = Wrapper(text, facts) if text else None
            yield host, unpacked(tree.as_py()), made[host]

    return joined, pages_of


def _counts(trees: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, place, hash, pages, chars): on how many different pages of a host a text stands at a place."""
    rows = trees.select("_host", "_page", "_tree").where("_page is not null")
    joined, pages_of = _with_wrappers(rows, wrappers.withColumn("facts", F.lit(None).cast("string")))

    def run(batches):
        for batch in batches:
            hosts, places, hashes, numbers, chars = [], [], [], [], []
            for (host, root, wrapper), number in zip(pages_of(batch), batch.column("_page").to_pylist(), strict=True):
                wrapper.align(root)
                for (place, made), n in wrapper.counted(root).items():
                    hosts.append(host)
                    places.append(place)
                    hashes.append(made)
                    numbers.append(number)
                    chars.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), *(pa.array(x, pa.int64()) for x in (places, hashes, numbers, chars))],
                names=["host", "place", "hash", "page", "n"],
            )

    each = joined.mapInArrow(run, "host string, place long, hash long, page long, n long")
    once = each.groupBy("host", "place", "hash", "page").agg(F.max("n").alias("n"))
    return once.groupBy("host", "place", "hash").agg(F.count("*").alias("pages"), F.sum("n").alias("chars"))


def learn(trees: DataFrame) -> DataFrame:
    """(host, wrapper, facts) of ``trees`` (:func:`parsed`); facts (JSON) are the template texts and the varying
    characters by place, null for hosts of fewer than MIN_PAGES different pages."""
    wrappers = materialize(induce(trees), "wrappers")
    counts = materialize(_counts(trees, wrappers), "texts-by-place")
    places = counts.where(f"hash = 0 and pages >= {MIN_PAGES}").select("host", "place", F.col("pages").alias("of"), F.col("chars").alias("all"))
    often = counts.where(f"hash <> 0 and pages >= {CONSTANT * MIN_PAGES}").join(places, ["host", "place"])
    fixed = materialize(often.where(F.col("pages") >= CONSTANT * F.col("of")).select("host", "place", "hash", "chars"), "template-texts")
    known = counts.where(f"place = 1 and hash = 0 and pages >= {MIN_PAGES}").select("host")
    lost = fixed.groupBy("host", "place").agg(F.sum("chars").alias("lost"))
    slots = counts.where("hash = 0 and place > 0").join(lost, ["host", "place"], "left")
    slots = slots.select("host", F.array("place", F.col("chars") - F.coalesce("lost", F.lit(0))).alias("slot"))
    varied = slots.groupBy("host").agg(F.collect_list("slot").alias("varied"))
    template = fixed.groupBy("host").agg(F.collect_list(F.array("place", "hash")).alias("template"))
    none = F.array().cast("array<array<bigint>>")
    facts = known.join(varied, "host").join(template, "host", "left")
    facts = facts.select("host", F.to_json(F.struct(F.coalesce("template", none).alias("template"), "varied")).alias("facts"))
    return materialize(wrappers.join(facts, "host", "left"), "wrappers-and-counts")


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` and ``main_text`` of every row of ``pages`` (url, html)."""
    trees = parsed(pages, keep)
    columns = C.with_fields(trees.select(*keep).schema, main_text="string")
    names = list(keep)
    joined, pages_of = _with_wrappers(trees, learn(trees))

    def run(batches):
        for batch in batches:
            # Hosts of few pages have no counts: their pages go by tags and words alone.
            texts = [main_text(root, w if w and w.counts else None) for _, root, w in pages_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(texts, pa.string())], names=[*names, "main_text"]
            )

    return joined.mapInArrow(run, columns)


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    found = extract(C.table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
