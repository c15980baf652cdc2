"""Layout-aware text of HTML pages.

A tolerant tokenizer feeds a tree builder that supplies implied tags (a block closes an open paragraph, an
item, a row or a cell its predecessor, a cell outside a row opens one). The tree is walked with the
rules of what a browser shows: no scripts, styles, templates, head, undisplayed elements, closed details, and no text whose
computed visibility is hidden (an element inside may be visible again). Style attributes and the page's style elements
count: rules of one compound selector (element, classes, id; for all media or the screen), by specificity, importance and
order, for display, visibility and white-space. Text of a block is one paragraph; blocks are set apart by a blank line or a line
break according to their kind, list items get their numbers (start, value, reversed) or markers and indents, the cells of a
table are padded to the columns that they have after the spans of rows and columns, and preformatted text keeps its white space.

Runs over Arrow batches, one page at a time, without recursion, in time linear in the page (lists nested d deep
indent their lines d times). Null html gives null text, empty html empty text. One row per input row;
repeated rows get equal results; columns other than those asked for aren't read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martsmith.llm.common import fresh, table

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
UNSEEN = frozenset("area audio base canvas datalist embed head iframe img link meta noembed noframes noscript "
                   "object param script source style svg template title track video".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
PARAGRAPHS = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul".split())
BLOCKS = PARAGRAPHS | frozenset("address article aside body center dd details dialog dir div dt figcaption footer form header hgroup "
                                "html legend li main nav search section summary optgroup".split())
LISTS = frozenset("dir menu ol ul".split())
TABLE_PARTS = frozenset("caption tbody td tfoot th thead tr".split())
CELLS = frozenset(["td", "th"])
GROUPS = frozenset(["tbody", "tfoot", "thead"])
#: what an opening tag ends, if it is open, and where the search stops
ENDS = {
    "li": (frozenset(["li"]), LISTS | CELLS), "dt": (frozenset(["dt", "dd"]), frozenset(["dl"]) | CELLS),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"]) | CELLS), "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["optgroup"]), frozenset(["select"])), "td": (CELLS | {"caption"}, frozenset(["table"])),
    "th": (CELLS | {"caption"}, frozenset(["table"])), "tr": (frozenset(["tr", "caption"]), frozenset(["table"])),
    **{g: (GROUPS | {"tr", "caption"}, frozenset(["table"])) for g in GROUPS},
}
PARAGRAPH_STOPS = CELLS | {"table", "caption", "button", "object"}

# A quote opens a value only right after "="; any other, or one that is never closed, is a character like any.
VALUE = r"""[ \t\n\r\f]*+=[ \t\n\r\f]*+("[^"]*+"|'[^']*+'|[^ \t\n\r\f>]*+)"""
NAME = r"[^ \t\n\r\f/>][^ \t\n\r\f/>=]*+"
TAG = re.compile(rf"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[ \t\n\r\f/]++|{NAME}(?:{VALUE.replace("(", "(?:")})?+)*+)>?|<[!?][^>]*>?""", re.S)
ATTRIBUTE = re.compile(rf"({NAME})(?:{VALUE})?+")
SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "kids", "more", "sheets")

    def __init__(self, tag: str, more: dict[str, str] | None = None) -> None:
        self.tag, self.kids, self.more = tag, [], more
        self.sheets: list[str] = []  # of the root: the texts of the page's style elements


PROPERTIES = frozenset(["display", "visibility", "white-space"])
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
RULE = re.compile(r"([^{}]*)\{([^{}]*)\}")
MEDIA = re.compile(r"@media\s+(?:only\s+)?(?:all|screen)\s*\{((?:[^{}]*\{[^{}]*\})*)\s*\}", re.I)
AT_RULE = re.compile(r"@[^{};]*(?:;|\{(?:[^{}]*\{[^{}]*\})*[^{}]*\}?)")
COMPOUND = re.compile(r"([A-Za-z][A-Za-z0-9]*|\*)?((?:[.#][\w-]+)*)")
Declared = dict[str, tuple[bool, str]]  # property -> (important, value)


def declarations(text: str) -> Declared:
    out: Declared = {}
    for part in text.split(";"):
        name, colon, value = part.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        if colon and name in PROPERTIES:
            important = value.endswith("!important")
            value = value.removesuffix("!important").strip()
            if important >= out.get(name, (False, ""))[0]:
                out[name] = (important, value)
    return out


class Styles:
    """The rules of a page's style elements, found by id, class or element."""

    def __init__(self, sheets: list[str]) -> None:
        self.rules: dict[str, list[tuple[tuple[int, int, int], int, str, frozenset[str], Declared]]] = {}
        order = 0
        for sheet in sheets:
            sheet = AT_RULE.sub("", MEDIA.sub(r"\1", COMMENT.sub("", sheet)))
            for selectors, body in RULE.findall(sheet):
                if not (declared := declarations(body)):
                    continue
                for selector in selectors.split(","):
                    m = COMPOUND.fullmatch(selector.strip())
                    if not m or not m[0]:
                        continue
                    tag, marks = (m[1] or "*").lower(), re.findall(r"[.#][\w-]+", m[2])
                    order += 1
                    ids = sum(x[0] == "#" for x in marks)
                    rule = ((ids, len(marks) - ids, int(tag != "*")), order, tag, frozenset(marks), declared)
                    self.rules.setdefault(max(marks, key=lambda x: x[0] == "#") if marks else tag, []).append(rule)

    def of(self, node: Node) -> dict[str, str]:
        """The element's own values; what it inherits is not here."""
        more = node.more or {}
        own = declarations(more["style"]) if "style" in more else {}
        if self.rules:
            marks = {"." + c for c in more.get("class", "").split()} | ({"#" + more["id"].strip()} if "id" in more else set())
            hits = [r for k in (node.tag, "*", *marks) for r in self.rules.get(k, ()) if r[2] in ("*", node.tag) and r[3] <= marks]
            found: Declared = {}
            for *_, declared in sorted(hits, key=lambda r: r[:2]):
                found.update({n: v for n, v in declared.items() if v[0] >= found.get(n, (False, ""))[0]})
            own = {**found, **{n: v for n, v in own.items() if v[0] >= found.get(n, (False, ""))[0]}}
        return {n: v for n, (_, v) in own.items()}


def _attributes(text: str) -> dict[str, str] | None:
    """Names in lower case; None if the tag has none."""
    if not text or text.isspace():
        return None
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(value[1:-1] if len(value) > 1 and value[0] in "\"'" and value[-1] == value[0] else value))
    return found


def build(html: str) -> Node:
    """The tree of a page; text nodes are strings."""
    root = Node("#root")
    stack = [root]

    opened: Counter[str] = Counter()  # open elements by tag: no search for what is not there

    def pop(first: int) -> None:
        for node in stack[first:]:
            opened[node.tag] -= 1
        del stack[first:]

    def push(node: Node) -> None:
        opened[node.tag] += 1
        stack.append(node)

    def close(tags: frozenset, stops: frozenset) -> None:
        if not any(opened[tag] for tag in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            tag = stack[i].tag
            if tag in tags:
                pop(i)
                return
            if tag in stops:
                return

    def open_(tag: str, more: dict[str, str] | None = None) -> Node:
        node = Node(tag, more)
        stack[-1].kids.append(node)
        return node

    pos, size = 0, len(html)
    while pos < size:
        m = TAG.search(html, pos)
        text = html[pos:m.start()] if m else html[pos:]
        if text:
            if stack[-1].tag == "head" and not text.isspace():
                pop(len(stack) - 1)
            stack[-1].kids.append(unescape(text) if "&" in text else text)
        if not m:
            break
        pos = m.end()
        if m[2] is None:  # a comment or declaration
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                open_("br")
            elif tag in CELLS or tag in GROUPS or tag in ("tr", "caption"):
                close(frozenset([tag]), frozenset(["table"]))
            elif tag != "html" and tag != "body":
                close(frozenset([tag]), CELLS if tag != "table" else frozenset())
            continue
        if stack[-1].tag == "head" and tag not in IN_HEAD:
            pop(len(stack) - 1)
        if tag in BLOCKS:
            close(frozenset(["p"]), PARAGRAPH_STOPS)
        if tag in ENDS:
            close(*ENDS[tag])
        if tag in CELLS and stack[-1].tag != "tr" and opened["table"]:
            push(open_("tr"))
        node = open_(tag, _attributes(m[3]))
        if tag in RAW:
            end = re.compile(f"</{tag}(?![^\\s/>])", re.I).search(html, pos)
            raw = html[pos:end.start()] if end else html[pos:]
            node.kids.append(unescape(raw) if tag in ("textarea", "title") else raw)
            if tag == "style" and (node.more or {}).get("media", "all").strip().lower() in ("", "all", "screen"):
                root.sheets.append(raw)
            pos = end.start() if end else size
            push(node)
        elif tag not in VOID:  # a slash at its end does not close an HTML element
            push(node)
    return root


class Flow:
    """Text in the making: finished lines, and the line that grows."""

    __slots__ = ("lines", "parts", "gap", "pre", "number", "step")

    def __init__(self, pre: int = 0) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap, self.pre = 0, pre
        self.number, self.step = 0, 1

    def text(self, text: str) -> None:
        if self.pre:
            self.parts.append(text)
            return
        text = SPACE.sub(" ", text)
        if text[:1] == " " and (not self.parts or self.parts[-1][-1:] in (" ", "\n")):
            text = text[1:]
        if text:
            self.parts.append(text)

    def block(self, lines: list[str]) -> None:
        if lines:
            if self.lines:
                self.lines.extend([""] * self.gap)
            self.lines.extend(lines)
            self.gap = 0

    def flush(self, gap: int = 0) -> None:
        if self.parts:
            lines = "".join(self.parts).split("\n")
            lines = [x.rstrip() for x in lines] if self.pre else [x.strip(" \t\r\f") for x in lines]
            while lines and not lines[-1]:
                lines.pop()
            while lines and not lines[0]:
                del lines[0]
            self.parts = []
            self.block(lines)
        self.gap = max(self.gap, gap)


def _width(lines: list[str]) -> int:
    return max(map(len, lines), default=0)


def placed(rows: list[list[tuple[int, int, list[str]]]]) -> list[list[tuple[int, int, list[str]]]]:
    """Rows of (columns spanned, rows spanned, lines) with the cells' first columns instead of their rows: a cell takes the first
    columns that no cell of a row above reaches into."""
    out, busy = [], {}  # column -> rows that it is taken for, this one included
    for row in rows:
        at, own = 0, []
        for columns, down, lines in row:
            while busy.get(at, 0):
                at += 1
            own.append((at, columns, lines))
            for c in range(at, at + columns):
                busy[c] = max(busy.get(c, 0), down)
            at += columns
        out.append(own)
        busy = {c: n - 1 for c, n in busy.items() if n > 1}
    return out


def table_lines(rows: list[list[tuple[int, int, list[str]]]]) -> list[str]:
    """Cells padded to their column, two spaces between columns; a cell over several rows stands in the first."""
    cells = placed(rows)
    widths = [0] * max((at + n for row in cells for at, n, _ in row), default=0)
    for row in cells:
        for at, n, lines in row:
            if n == 1:
                widths[at] = max(widths[at], _width(lines))
    for row in cells:  # a cell over several columns widens the last of them if need be
        for at, n, lines in row:
            if n > 1:
                widths[at + n - 1] += max(0, _width(lines) - sum(widths[at:at + n]) - 2 * (n - 1))
    starts = [0]
    for w in widths:
        starts.append(starts[-1] + w + 2)
    out = []
    for row in cells:
        for i in range(max((len(lines) for *_, lines in row), default=0)):
            line = ""
            for at, _, lines in row:
                if i < len(lines):
                    line = line.ljust(starts[at]) + lines[i]
            out.append(line.rstrip())
    return out


def _number(node: Node, name: str) -> int | None:
    value = (node.more or {}).get(name, "").strip()
    return int(value) if value.lstrip("-").isascii() and value.lstrip("-").isdigit() and len(value) < 10 else None


def _spans(node: Node) -> tuple[int, int]:
    """Columns and rows of a cell, within HTML's own limits; 0 rows are all that follow."""
    columns, rows = _number(node, "colspan"), _number(node, "rowspan")
    return min(1000, columns) if columns and columns > 0 else 1, 65534 if rows == 0 else min(65534, rows) if rows and rows > 0 else 1


def render(root: Node) -> str:
    styles = Styles(root.sheets)
    flows, tables = [Flow()], []
    todo: list[tuple[Node | str, bool, bool, bool]] = [(root, False, True, False)]  # element, leaving it, visible, own white space
    while todo:
        node, leaving, visible, own_pre = todo.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if visible:
                flow.text(node)
            continue
        tag, more = node.tag, node.more or {}
        if not leaving:
            style = styles.of(node)
            if tag in UNSEEN or style.get("display") == "none" or "hidden" in more and "display" not in style or tag == "dialog" and "open" not in more:
                continue
            if "visibility" in style:
                visible = style["visibility"] not in ("hidden", "collapse") if style["visibility"] != "inherit" else visible
            if tag == "br":
                flow.parts.append("\n")
                continue
            if tag == "input":
                if visible and more.get("type", "text").lower() in ("button", "reset", "submit", "text", "search", "email", "url", "tel", "number"):
                    flow.text(more.get("value", ""))
                continue
            kids = node.kids
            if tag == "details" and "open" not in more:
                kids = [k for k in kids if isinstance(k, Node) and k.tag == "summary"][:1]
            if tag in BLOCKS:
                flow.flush(1 if tag in PARAGRAPHS and not (tag in LISTS and len(flows) > 1) else 0)
            own_pre = tag in ("pre", "textarea") or style.get("white-space", "").startswith(("pre", "break-spaces"))
            if tag in LISTS:
                flow = Flow(flow.pre + own_pre)
                if tag == "ol":
                    start, items = _number(node, "start"), sum(isinstance(k, Node) and k.tag == "li" for k in kids)
                    flow.step = -1 if "reversed" in more else 1
                    flow.number = (start if start is not None else items if "reversed" in more else 1) - flow.step
                else:
                    flow.number = -(1 << 62)
                flows.append(flow)
            elif tag in ("li", "dd", "blockquote", "caption") or tag in CELLS:
                flows.append(Flow(flow.pre + own_pre))
            elif tag == "table":
                tables.append([])
                flows.append(Flow(flow.pre + own_pre))
            else:
                flow.pre += own_pre
                if tag == "tr" and tables:
                    tables[-1].append([])
                elif tag == "option":
                    flow.text(" ")
            todo.append((node, True, visible, own_pre))
            todo.extend((k, False, visible, False) for k in reversed(kids))
            continue
        if tag in LISTS:
            flow.flush()
            flows.pop()
            flows[-1].block(flow.lines)
        elif tag in ("li", "dd", "blockquote"):
            flow.flush()
            flows.pop()
            outer = flows[-1]
            mark = "  "
            if tag == "li":
                value = _number(node, "value")
                outer.number = value if value is not None and outer.number > -(1 << 61) else outer.number + outer.step
                mark = f"{outer.number}. " if outer.number > -(1 << 61) and len(flows) > 1 else "- "
            pad = " " * len(mark)
            if not visible:
                mark = pad  # what is visible inside keeps its indent
            outer.block([(mark if i == 0 and tag == "li" else pad) + x if x else x for i, x in enumerate(flow.lines)])
        elif tag == "caption":
            flow.flush()
            flows.pop()
            flows[-1].block(flow.lines)
        elif tag in CELLS:
            flow.flush()
            flows.pop()
            if tables:
                if not tables[-1]:
                    tables[-1].append([])
                tables[-1][-1].append((*_spans(node), flow.lines))
            else:  # a cell outside any table
                flows[-1].block(flow.lines)
        elif tag == "table":
            flow.flush()
            flows.pop()
            outer = flows[-1]
            outer.block(flow.lines)  # the caption, and what stands in the table but in no cell
            outer.block(table_lines(tables.pop()))
        elif own_pre:
            if tag in BLOCKS or tag == "textarea":
                flow.flush()
            flow.pre -= 1
        if tag in BLOCKS:
            flows[-1].flush(1 if tag in PARAGRAPHS and not (tag in LISTS and len(flows) > 1) else 0)
    flows[0].flush()
    return "\n".join(flows[0].lines)


def visible_text(html: str | None) -> str | None:
    return None if html is None else render(build(html))


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` (all but the html) of ``pages``, and the visible text."""
    keep = [c for c in pages.columns if c != html_col] if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array([visible_text(x.as_py()) for x in b.column(0)], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], texts], [*keep, text_col])

    schema = pages.select(*keep, F.lit("").alias(text_col)).schema
    schema[text_col].nullable = True
    return pages.select(F.col(html_col).alias(fresh(keep, "html_in")), *keep).mapInArrow(run, schema)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    got = extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return got.withColumn("n_chars", F.length("text").cast("long"))
