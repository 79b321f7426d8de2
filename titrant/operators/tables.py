"""Tables in article XML: spans expanded to a grid, then headings, categories and warnings as columns."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from ..functions.classify import HEADER_ECHOES, canonical_category, header_role, heading_category
from ..functions.text import strip
from .mining import forward_fill

KEY_TABLE = re.compile(r"key\s+resources?\s+table", re.I)
GRID = "pmcid string, xml_ok boolean, n_tables int, table_idx int, match_source string, header array<string>, row_idx int, cells array<string>"


def local(tag: object) -> str:
    return tag.rpartition("}")[2] if isinstance(tag, str) else ""


def text_of(el: ET.Element) -> str:
    return " ".join(" ".join(el.itertext()).split())


def _within(el: ET.Element, *path: str) -> list[ET.Element]:
    """Descendants named by the first of ``path``, and their children named by the rest."""
    found = [e for e in el.iter() if e is not el and local(e.tag) == path[0]]
    for name in path[1:]:
        found = [c for e in found for c in e if local(c.tag) == name]
    return found


#: The greatest column span that counts, as in HTML.
SPAN_MOST = 1000


def span(el: ET.Element, name: str) -> int:
    raw = next((v for k, v in el.attrib.items() if local(k) == name), "1")
    try:
        return max(1, int(raw.strip()))
    except ValueError:
        return 1


def expand(trs: Iterable[ET.Element]) -> Iterator[list[str]]:
    """Rows with spans repeated, one after the other. ``down[c]`` is what still hangs into column ``c`` from above; gaps become empty.

    A cell begins in the first column that is free. Where its columns run into one that is held from above, the cell covers
    it in this row, and what hangs there goes on in the next one with as many rows left as before.
    """
    down: dict[int, tuple[str, int]] = {}
    for tr in trs:
        row = {c: text for c, (text, _) in down.items()}
        below = {c: (text, left - 1) for c, (text, left) in down.items() if left > 1}
        c = 0
        for cell in tr:
            if local(cell.tag) not in ("td", "th"):
                continue
            text, tall = text_of(cell), span(cell, "rowspan")
            while c in row:
                c += 1
            for at in range(c, c + min(SPAN_MOST, span(cell, "colspan"))):
                row[at] = text
                if tall > 1:
                    below[at] = (text, tall - 1)
                elif at in down:
                    below[at] = down[at]
                c = at + 1
        down = below
        yield [row.get(i, "") for i in range(max(row) + 1)] if row else []


_TAG = re.compile(r"<(?P<close>/?)(?P<tag>[A-Za-z_][\w.:-]*)(?P<more>[^<>]*)>")
_ATTRIBUTE = re.compile(r"""([A-Za-z_][\w.:-]*)\s*=\s*(?:"([^"]*)"|'([^']*)')""")
_REFERENCE = re.compile(r"&(?:#x([0-9A-Fa-f]+)|#([0-9]+)|([A-Za-z_][\w.-]*));?")
# The references that XML itself defines.
_NAMED = {"lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'"}


def _unescaped(text: str) -> str:
    """References as characters; those that nothing defines vanish."""

    def one(m: re.Match) -> str:
        if m.group(3):
            return _NAMED.get(m.group(3), "")
        code = int(m.group(1), 16) if m.group(1) else int(m.group(2))
        return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else ""

    return _REFERENCE.sub(one, text) if "&" in text else text


#: What stands between these is no element; the text between the third pair is taken as it is.
_SKIPPED = (("<!--", "-->"), ("<?", "?>"), ("<![CDATA[", "]]>"))


def _doctype_end(page: str, at: int) -> int:
    """Behind a document type declaration, and the subset in brackets that it may have; -1 if it isn't closed."""
    end, bracket = page.find(">", at), page.find("[", at)
    if 0 <= bracket < end:
        close = page.find("]", bracket)
        end = page.find(">", close) if close >= 0 else -1
    return end + 1 if end >= 0 else -1


def tokens(page: str) -> Iterator[tuple[str, str | re.Match]]:
    """``text``, ``raw`` and ``tag`` in one pass. What looks like markup but never ends is text.

    A search that has failed isn't made again: there is no such end further on either.
    """
    at = start = 0
    hopeless: set[str] = set()
    while (at := page.find("<", at)) >= 0:
        begin = next(((a, z) for a, z in _SKIPPED if page.startswith(a, at)), None)
        end, found = -1, None
        if begin and begin[1] not in hopeless:
            close = page.find(begin[1], at + len(begin[0]))
            if close < 0:
                hopeless.add(begin[1])
            else:
                end = close + len(begin[1])
                found = ("raw", page[at + len(begin[0]) : close]) if begin[0] == "<![CDATA[" else ("", "")
        elif page.startswith("<!DOCTYPE", at) and "<!DOCTYPE" not in hopeless:
            end = _doctype_end(page, at)
            found = ("", "")
            if end < 0:
                hopeless.add("<!DOCTYPE")
        elif m := _TAG.match(page, at):
            end, found = m.end(), ("tag", m)
        if end < 0:
            at += 1
            continue
        if start < at:
            yield "text", page[start:at]
        if found[0]:
            yield found
        at = start = end
    if start < len(page):
        yield "text", page[start:]


def recovered(raw: bytes | str) -> ET.Element | None:
    """As much of malformed XML as can be read: what is unclosed ends with what holds it, an end tag of nothing open is passed over, and so is all behind the root. None if there is no element.

    Time is linear in the page: one pass over its tokens, the places of open elements by name, texts joined once.
    """
    page = bytes(raw).decode("utf-8", "replace") if not isinstance(raw, str) else raw
    root: ET.Element | None = None
    stack: list[ET.Element] = []
    open_at: dict[str, list[int]] = {}
    pending: list[str] = []

    def settle_text() -> None:
        if pending and stack:
            value = "".join(pending)
            if len(stack[-1]):
                stack[-1][-1].tail = value
            else:
                stack[-1].text = value
        pending.clear()

    for kind, value in tokens(page):
        if kind != "tag":
            if stack:
                pending.append(value if kind == "raw" else _unescaped(value))
            continue
        tag = value["tag"].rpartition(":")[2]
        if value["close"]:
            if not open_at.get(tag):
                continue
            settle_text()
            depth = open_at[tag][-1]
            while len(stack) > depth:
                open_at[stack.pop().tag].pop()
            if not stack:
                break
            continue
        settle_text()
        more = value["more"]
        el = ET.Element(tag, {k.rpartition(":")[2]: _unescaped(a or b) for k, a, b in _ATTRIBUTE.findall(more)})
        if stack:
            stack[-1].append(el)
        else:
            root = el
        if not more.endswith("/"):
            open_at.setdefault(tag, []).append(len(stack))
            stack.append(el)
        elif root is el:
            break
    settle_text()
    return root


def parse_xml(raw: bytes | str | None, recover: bool = False) -> ET.Element | None:
    """The root; of malformed XML what can be recovered, if asked for, else None."""
    if not raw:
        return None
    try:
        return ET.fromstring(raw if isinstance(raw, str) else bytes(raw))
    except (ET.ParseError, ValueError, LookupError):
        return recovered(raw) if recover else None


def is_article(raw: bytes | None) -> bool:
    """At least 200 bytes of well-formed XML whose root is an article, or a set that holds one."""
    if raw is None or len(raw) < 200:
        return False
    root = parse_xml(bytes(raw))
    if root is None:
        return False
    return local(root.tag) == "article" or local(root.tag) == "pmc-articleset" and any(local(c.tag) == "article" for c in root)


def key_tables(root: ET.Element) -> list[tuple[ET.Element, str]]:
    """Table elements that a caption, a label or the title of a section around them names, with which of these did."""
    above: dict[ET.Element, ET.Element] = {}
    in_section: dict[ET.Element, bool] = {root: False}  # whether a section around an element has such a title
    holds: dict[str, set[ET.Element]] = {"caption": set(), "label": set()}
    wraps = []
    for el in root.iter():
        name = local(el.tag)
        titled = in_section[el] or name == "sec" and any(local(c.tag) == "title" and KEY_TABLE.search(text_of(c)) for c in el)
        for c in el:
            above[c], in_section[c] = el, titled
        if name == "table-wrap":
            wraps.append(el)
        elif name in holds and KEY_TABLE.search(text_of(el)):
            up = above.get(el)
            while up is not None and up not in holds[name]:
                holds[name].add(up)
                up = above.get(up)
    found = []
    for tw in wraps:
        where = next((n for n in ("caption", "label") if tw in holds[n]), "section" if in_section[tw] else None)
        if where:
            found.append((tw, where))
    return found


def grid_rows(pmcid: str | None, raw: bytes | str | None) -> Iterator[tuple]:
    """Rows of :data:`GRID`, as they come; one row without cells for an article that has none. Malformed articles are read as far as they go."""
    root = parse_xml(raw, recover=True)
    found = [] if root is None else key_tables(root)
    some = False
    for t, (tw, where) in enumerate(found):
        head = _within(tw, "thead", "tr")
        header: list[str] = []
        for header in expand(head):
            pass
        heads = set(map(id, head))
        body = _within(tw, "tbody", "tr") or [tr for tr in _within(tw, "tr") if id(tr) not in heads]
        for r, cells in enumerate(expand(body)):
            if cells:
                some = True
                yield pmcid, True, len(found), t, where, header, r, cells
    if not some:
        yield pmcid, root is not None, len(found), None, None, None, None, None


class GridFunction:
    """The table function behind :func:`expand_tables`: an article in, its tables' rows out one by one."""

    def eval(self, pmcid: str | None, xml: bytes | str | None):
        yield from grid_rows(pmcid, xml)


def expand_tables(papers: DataFrame, xml: str = "xml", key: str = "pmcid") -> DataFrame:
    """The grid of every key table of every paper. Cell order and spans are sequential, so this is Python; the rest isn't.

    A table function yields the rows of one article after the other, so a task holds the tree of one article and the
    batch of rows under way, however many articles or rows there are.
    """
    grid = udtf(GridFunction, returnType=GRID)
    rows = papers.select(F.col(key).cast("string").alias("k"), F.col(xml).alias("x"))
    return rows.lateralJoin(grid(F.col("k").outer(), F.col("x").outer())).drop("k", "x")


def _place(roles: Column, role: str, default: int | None) -> Column:
    at = F.array_position(roles, role).cast("int") - 1
    return F.when(at >= 0, at).otherwise(F.lit(default).cast("int"))


def table_rows(grid: DataFrame) -> DataFrame:
    """``pmcid, table_idx, row_idx, category, reagent_name, source, identifier, additional_info, parser_warnings``."""
    g = grid.filter("row_idx IS NOT NULL").withColumn("heading", heading_category(F.col("cells")))
    g = forward_fill(g, ["pmcid", "table_idx"], ["row_idx"], "heading", "active", F.col("heading").isNotNull())
    roles = F.transform("header", header_role)
    places = {"p_reagent": _place(roles, "reagent", 0), "p_source": _place(roles, "source", 1), "p_identifier": _place(roles, "identifier", 2), "p_additional": _place(roles, "additional", None), "p_category": _place(roles, "category", None)}
    g = g.withColumns(places).withColumn("width", F.greatest(*places) + 1).withColumn("n", F.size("cells"))
    cell = lambda p: F.coalesce(F.get("cells", F.col(p)), F.lit(""))
    extra = F.filter(F.slice("cells", F.col("width") + 1, F.greatest(F.col("n") - F.col("width"), F.lit(0))), lambda c: strip(c) != "")
    named = F.nullif(strip(cell("p_category")), F.lit(""))
    g = g.withColumns({"extra": extra, "category": F.coalesce(canonical_category(named), named, F.col("active"))})
    warnings = F.concat_ws(
        ";", F.when(F.size("extra") > 0, F.concat(F.lit("captured_"), F.size("extra").cast("string"), F.lit("_extra_cells"))),
        F.when(F.col("n") < F.col("width"), F.concat(F.lit("only_"), F.col("n").cast("string"), F.lit("_cells_expected_"), F.col("width").cast("string"))), F.when(F.col("category").isNull(), F.lit("no_active_category")),
    )
    more = F.array_join(F.filter(F.array(cell("p_additional"), F.array_join("extra", " | ")), lambda x: x != ""), " | ")
    name = strip(cell("p_reagent"))
    kept = g.filter((name != "") & ~F.lower(name).isin(*HEADER_ECHOES))
    return kept.select("pmcid", "table_idx", "row_idx", F.coalesce("category", F.lit("")).alias("category"), cell("p_reagent").alias("reagent_name"), cell("p_source").alias("source"), cell("p_identifier").alias("identifier"), more.alias("additional_info"), warnings.alias("parser_warnings"))


def paper_counts(grid: DataFrame) -> DataFrame:
    """``pmcid, found, xml_ok, tables``."""
    return grid.groupBy("pmcid").agg(F.lit(True).alias("found"), F.bool_or("xml_ok").alias("xml_ok"), F.max("n_tables").alias("tables"))
