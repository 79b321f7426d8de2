"""HTML extraction by wrapper induction.

The pages of a host are told apart by layout: the paths of nested sections down to those that hold prose. The pages of one
layout are aligned, by simple tree matching, with one of them (the one whose HTML has the least hash). Nodes whose text
is the same on nearly all aligned pages are constant; slots whose text varies are content. The smallest section that holds
most of the varying text is the content container. Boxes (sections, tables, lists) all of whose text is constant are
template, whatever they are called; headings, paragraphs and quotations that stand in the container itself are the
article's even if other articles repeat them. A page's main text is what its aligned container holds, without template
and without elements that HTML or their class names mark as navigation, headers, footers, sidebars, notices, adverts,
forms, scripts, styles or comments. Names are judged whole (``site-footer`` marks, ``no-sidebar`` and ``related-work``
don't), and never mark a box that holds the article or its heading and most of the page's text. Where there is no container (layouts of fewer than ``LEAST_PAGES`` pages, content
that stands in the body itself, pages that don't align) the text is that of ``article`` or ``main``, or else of the whole
body, less the same.

Boxes count as template only if the container varies on the whole: where the pages are copies of one article, nothing is
dropped. Votes are summed per task before they are shuffled, so a host with a third of all pages is as cheap as any;
reference trees and wrappers go to the tasks by broadcast while all of them together stay below ``BROADCAST_BYTES``, and
by a join on host and layout beyond that.

Edge cases: a null or empty page has an empty text. Unclosed, crossed and cut-off tags are mended. Pages may be of any
length and nested to any depth. Repeated rows are pages of their own. A page without a host (no ``://``) belongs to the
host "". An empty table gives no rows. Of columns that share a name with a computed one, the computed one stays.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from xxhash import xxh64_intdigest

from .bytewords import besides
from .html_tree import COMMENTS, Flat, Node, match, parse
from .storage import released, settled
from .url_filter import canonical

BROADCAST_BYTES = 16 << 20
LEAST_PAGES, SAME_SHARE, ALIGNED_SHARE = 3, 0.9, 0.8
CONTAINER_SHARE, TEMPLATE_SHARE = 0.8, 0.3
HELD_VOTES = 200_000
SECTIONS = {"#page", "html", "body", "main", "article", "section", "div", "td", "table", "tbody", "tr", "center"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PROSE = HEADINGS | {"p", "pre", "blockquote", "ul", "ol", "dl"}
BOXES = (SECTIONS - {"#page", "html", "body", "main", "article"}) | {"ul", "ol", "dl"}

# Elements that aren't main text.
NOISE_TAGS = {"head", "nav", "footer", "aside", "form", "fieldset", "menu", "dialog"}


def is_noise(node: Node, within: bool) -> bool:
    """``within``: inside an article or main element, where a header is the article's own."""
    if node.tag in NOISE_TAGS or node.tag == "header" and not within:
        return True
    if node.tag in ("html", "body", "article", "main"):
        return node.tag == "article" and not COMMENTS.isdisjoint(node.noise)
    return bool(node.noise) and not (within and node.noise == ("header",))


def blocks_of(node: Node, skip: set[int], within: bool = False) -> list[str]:
    """The text blocks of a subtree, in page order. ``skip``: ids of nodes whose own text is template."""
    out: list[str] = []
    stack: list[tuple[Node | str, bool]] = [(node, within)]
    while stack:
        item, inside = stack.pop()
        if isinstance(item, str):
            out.append(item)
            continue
        if item is not node and is_noise(item, inside):
            continue
        inside = inside or item.tag in ("article", "main")
        parts = [p for p in item.parts if isinstance(p, Node)] if id(item) in skip else item.parts
        stack += [(p, inside) for p in reversed(parts)]
    return out


def layout(root: Node) -> int:
    """A number for the paths of sections in a page, down to those that hold prose: what varies with the article leaves it as it is."""
    found, stack = set(), [(root, 0)]
    while stack:
        node, above = stack.pop()
        path = xxh64_intdigest(node.label(), above)  # a number for the path, at any depth
        found.add(path)
        kids = node.children
        if node.blocks() or any(c.tag in PROSE for c in kids) or node.tag in ("article", "main"):
            continue
        stack += [(c, path) for c in kids if c.tag in SECTIONS and not is_noise(c, False)]
    return xxh64_intdigest(",".join(map(str, sorted(found))))


def fallback(root: Node, skip: set[int]) -> list[str]:
    found: list[Node] = []
    stack = [(root, False)]
    while stack:
        node, within = stack.pop()
        if is_noise(node, within):
            continue
        if node.tag in ("article", "main"):
            found.append(node)
            continue
        stack += [(c, within) for c in reversed(node.children)]
    return [b for n in found for b in blocks_of(n, skip, True)] if found else blocks_of(root, skip)


def vote(ref: Flat, page: Flat) -> list[tuple[int, int, int, int]]:
    """For each aligned node of the reference: its number, whether its text is the same, and the page's characters there that are the same and that vary."""
    mine = {j: i for i, j in match(ref, page)[1]}
    noise = [False] * len(page.labels)
    owner = [0] * len(page.labels)
    within = [False] * len(page.labels)
    got: dict[int, list[int]] = {i: [0, 0, 0] for i in mine.values()}
    for j, node in enumerate(page.nodes):  # parents stand before their children
        i = mine.get(j)
        owner[j] = owner[j] if i is None else i
        noise[j] = noise[j] or is_noise(node, within[j])
        for k in page.kids[j]:
            owner[k], noise[k], within[k] = owner[j], noise[j], within[j] or node.tag in ("article", "main")
        same = i is not None and ref.hashes[i] == page.hashes[j]
        if same:
            got[i][0] = 1
        if not noise[j] and owner[j] in got:
            got[owner[j]][1 if same else 2] += sum(map(len, node.blocks()))
    return [(i, *v) for i, v in got.items()]


def induce(ref: Flat, votes: list[tuple[int, int, int, int, int]]) -> dict:
    """The wrapper: the number of the container (-1: none) and of the template nodes, from (node, pages aligned, pages with the same text, characters the same, characters that vary)."""
    n = len(ref.labels)
    aligned, same, still, vary = ([0] * n for _ in range(4))
    for i, *v in votes:
        aligned[i], same[i], still[i], vary[i] = v
    parent = [-1] * n
    for i, kids in enumerate(ref.kids):
        for k in kids:
            parent[k] = i
    mass, quiet = list(vary), list(still)
    for i in range(n - 1, 0, -1):
        mass[parent[i]] += mass[i]
        quiet[parent[i]] += quiet[i]
    pages = aligned[0]
    if pages < LEAST_PAGES or not mass[0]:
        return {"container": -1, "template": []}
    at = 0
    tag = lambda i: ref.labels[i].split(".")[0]
    while True:
        down = next((k for k in ref.kids[at] if mass[k] >= CONTAINER_SHARE * mass[0] and tag(k) in SECTIONS and aligned[k] >= ALIGNED_SHARE * pages), None)
        if down is None:
            break
        at = down
    up = at
    while up > 0 and tag(up) not in ("article", "main"):
        up = parent[up]
    if up > 0:
        at = up
    while at > 0 and parent[at] > 0 and tag(parent[at]) not in ("html", "body") and any(tag(k) in HEADINGS for k in ref.kids[parent[at]]):
        at = parent[at]
    held = tag(at) not in ("#page", "html", "body")
    template: list[int] = []
    if quiet[at] < TEMPLATE_SHARE * (quiet[at] + mass[at]):
        # from the last node to the first: whether all text of the subtree is constant, and whether there is any
        steady, worded, inside = [True] * n, [False] * n, [False] * n
        for i in range(n - 1, -1, -1):
            own = still[i] > 0 or vary[i] > 0
            constant = aligned[i] >= ALIGNED_SHARE * pages and same[i] >= SAME_SHARE * aligned[i]
            steady[i] = constant and all(steady[k] for k in ref.kids[i])
            worded[i] = own or any(worded[k] for k in ref.kids[i])
        boxed = [False] * n
        for i in range(at, n):
            inside[i] = i == at or parent[i] >= 0 and inside[parent[i]]
            boxed[i] = inside[i] and i != at and (boxed[parent[i]] or tag(i) in BOXES and steady[i] and worded[i])
        template = [i for i in range(at, n) if boxed[i] and still[i]]
    return {"container": at if held else -1, "template": template}


def extract(page: str | Node, ref: Flat | None = None, wrapper: dict | None = None) -> str:
    root = parse(page) if isinstance(page, str) else page
    if ref is None or wrapper is None or wrapper["container"] < 0 and not wrapper["template"]:
        return "\n".join(fallback(root, set()))
    flat = Flat(root)
    pairs = dict(match(ref, flat)[1])
    skip = {id(flat.nodes[pairs[i]]) for i in wrapper["template"] if i in pairs and flat.hashes[pairs[i]] == ref.hashes[i]}
    home = pairs.get(wrapper["container"])
    if home is None:
        return "\n".join(fallback(root, skip))
    homes = [home]
    if flat.nodes[home].tag in ("article", "main"):  # a page may have more of them than the reference
        above = next(kids for kids in flat.kids if home in kids)
        aligned = set(pairs.values())
        homes = [k for k in above if k == home or k not in aligned and flat.labels[k] == flat.labels[home] and not is_noise(flat.nodes[k], False)]
    return "\n".join(b for k in homes for b in blocks_of(flat.nodes[k], skip, True))


def group_key(host: str, root: Node) -> str:
    return f"{host} {layout(root)}"


def _with_group(pages: DataFrame) -> DataFrame:
    """All columns and ``group``, the host and layout of each page; ``pages`` ends in ``__html, host``."""
    schema = T.StructType([*pages.schema.fields, T.StructField("group", T.StringType())])
    arrow = to_arrow_schema(schema)
    n = len(pages.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 64):
                batch = whole.slice(lo, 64)
                groups = [group_key(h, parse(p or "")) for p, h in zip(batch.column(n - 2).to_pylist(), batch.column(n - 1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(groups, pa.string())], schema=arrow)

    return pages.mapInArrow(run, schema)


def _with_state(pages: DataFrame, states: DataFrame, work: Callable[[Iterator, Callable[[str, str | None], object]], Iterator[pa.RecordBatch]], schema: T.StructType, parse_state: Callable[[str], object]) -> DataFrame:
    """``work`` over batches of ``pages`` (whose last columns are ``__html, host``), with a function that gives a group's state (JSON in ``states``: ``group, state``).

    Few or small states are broadcast; else each page gets its group's by a join, in a column after the host.
    """
    size = states.agg(F.coalesce(F.sum(F.length("state") + F.length("group")), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        held = pages.sparkSession.sparkContext.broadcast({r.group: r.state for r in states.collect()})

        def lookup(known: dict, group: str, _: str | None) -> object:
            if group not in known:
                known[group] = parse_state(held.value[group]) if group in held.value else None
            return known[group]
    else:
        pages = _with_group(pages).join(states, "group", "left").select(*pages.columns, "state")

        def lookup(known: dict, group: str, state: str | None) -> object:
            if group not in known:
                if len(known) > 1000:
                    known.clear()
                known[group] = None if state is None else parse_state(state)
            return known[group]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        yield from work(batches, lambda group, state: lookup(known, group, state))

    return pages.mapInArrow(run, schema)


def _rows(batches: Iterator[pa.RecordBatch], page: int) -> Iterator[tuple[pa.RecordBatch, int, Node, str, str | None]]:
    """Batch, row, the page's tree, its group and joined state (if there is one), a few rows of a batch at a time."""
    for whole in batches:
        for lo in range(0, whole.num_rows, 64):
            batch = whole.slice(lo, 64)
            states = batch.column(page + 2).to_pylist() if batch.num_columns > page + 2 else [None] * batch.num_rows
            for i, (p, h, s) in enumerate(zip(batch.column(page).to_pylist(), batch.column(page + 1).to_pylist(), states, strict=True)):
                root = parse(p or "")
                yield batch, i, root, group_key(h, root), s


def references(pages: DataFrame) -> DataFrame:
    """``group, state``: the tree of the page with the least hash, for every host and layout. ``pages`` has ``__html, host``."""
    schema = T.StructType([T.StructField("group", T.StringType()), T.StructField("key", T.LongType()), T.StructField("state", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, tuple[int, str]] = {}

        def flush() -> pa.RecordBatch:
            groups, values = list(best), list(best.values())
            best.clear()
            return pa.RecordBatch.from_arrays([pa.array(groups, pa.string()), pa.array([v[0] for v in values], pa.int64()), pa.array([v[1] for v in values], pa.string())], names=["group", "key", "state"])

        held = 0
        for batch in batches:
            for page, host, key in zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True):
                root = parse(page or "")
                group = group_key(host, root)
                if group not in best or key < best[group][0]:
                    best[group] = (key, json.dumps(Flat(root).spec()))
                    held += len(best[group][1])
            if held > 32 << 20:
                yield flush()
                held = 0
        yield flush()

    found = pages.select("__html", "host", F.xxhash64(F.coalesce("__html", F.lit(""))).alias("key")).mapInArrow(run, schema)
    return found.groupBy("group").agg(F.min(F.struct("key", "state")).alias("top")).select("group", F.col("top.state").alias("state"))


VOTES = T.StructType([T.StructField("group", T.StringType()), T.StructField("node", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("aligned", "same", "still", "vary")]])


def _votes(batches: Iterator[pa.RecordBatch], state: Callable) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[str, int], list[int]] = {}

    def flush() -> pa.RecordBatch:
        keys, values = list(sums), list(sums.values())
        sums.clear()
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), *[pa.array([v[c] for v in values], pa.int64()) for c in range(4)]]
        return pa.RecordBatch.from_arrays(columns, names=VOTES.names)

    for _, _, root, group, joined in _rows(batches, 0):
        ref = state(group, joined)
        for i, same, still, vary in vote(ref, Flat(root)):
            v = sums.setdefault((group, i), [0, 0, 0, 0])
            v[0] += 1
            v[1] += same
            v[2] += still
            v[3] += vary
        if len(sums) > HELD_VOTES:
            yield flush()
    yield flush()


def wrappers(pages: DataFrame, refs: DataFrame) -> DataFrame:
    """``group, state``: the reference tree with the wrapper. A group's votes are one row for each node of its reference page."""
    votes = _with_state(pages.select("__html", "host"), refs, _votes, VOTES, lambda s: Flat(spec=json.loads(s)))
    summed = votes.groupBy("group", "node").agg(*[F.sum(c).alias(c) for c in ("aligned", "same", "still", "vary")])
    by_group = summed.groupBy("group").agg(F.collect_list(F.struct("node", "aligned", "same", "still", "vary")).alias("votes")).join(refs, "group")
    schema = T.StructType([T.StructField("group", T.StringType()), T.StructField("state", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for got, spec in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                tree = json.loads(spec)
                out.append(json.dumps([tree, induce(Flat(spec=tree), [tuple(v.values()) for v in got])]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["group", "state"])

    return by_group.select("group", "votes", "state").mapInArrow(run, schema)


def main_text(df: DataFrame, html: str = "html", url: str = "url", keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """``keep``, ``text`` and ``n_chars`` for every row."""
    keep = besides(keep, ("text", "n_chars"))
    pages = df.select(*[F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(keep)], F.col(f"`{html}`").alias("__html"), canonical(url)[0].alias("host"))
    refs = settled(references(pages), "references")
    states = settled(wrappers(pages, refs), "wrappers")
    released(refs)
    schema = T.StructType([*[T.StructField(c, df.schema[c].dataType) for c in keep], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    arrow = to_arrow_schema(schema)

    def load(state: str) -> tuple[Flat, dict]:
        tree, wrapper = json.loads(state)
        return Flat(spec=tree), wrapper

    def work(batches: Iterator[pa.RecordBatch], state: Callable) -> Iterator[pa.RecordBatch]:
        texts: list[str] = []
        for batch, i, root, group, joined in _rows(batches, len(keep)):
            known = state(group, joined)
            texts.append(extract(root, *known) if known else extract(root))
            if i == batch.num_rows - 1:
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in range(len(keep))], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=arrow)
                texts = []

    return _with_state(pages, states, work, schema, load)


def query(spark, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
