"""Visible text of web pages, laid out as blocks, lists and tables.

A tree is built from the tags of a page: void elements hold nothing, an element that its
successor implies closed is closed (``li``, ``p``, ``td``, ``tr``, ``option`` and so on; ``head`` by whatever
belongs to the body, text too), an end tag closes up to its
element if that is open and is passed over otherwise. Scripts, styles, comments, ``head`` but for
nothing, templates, controls without text, elements with ``hidden`` or ``aria-hidden="true"``, and those whose style says
``display:none`` are invisible with all they hold; ``visibility`` is inherited, so that a visible child of a hidden element is seen.
Text of drawings and formulas is seen, of a choice the option that is shown (all of them if several can be chosen). White space collapses except in ``pre`` and ``textarea``. Blocks
stand on lines of their own, paragraphs, headings, lists and tables apart by an empty line; list items
carry a dash or their number and are indented by depth; the cells of a table are placed on a grid, on which cells may
span rows and columns, and padded to columns.

Defined cases: null pages give null, empty pages empty text; unclosed and misnested tags, stray
``<`` and unknown entities are text or are closed at the end as above; pages of any length and depth are read without
recursion, inner tables before those around them; a cell spans 1,000 columns and 65,534 rows at most, as in browsers; repeated rows are rendered alike; empty tables give empty tables.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of elements by how they behave.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("audio canvas datalist defs desc head iframe map metadata noframes noscript object script style template title video".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
APART = set("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul".split())
BLOCK = APART | set(
    "address article aside body caption center dd details dialog dir div dt fieldset figcaption footer form header hgroup hr html legend li main menu nav optgroup option"
    " search section summary tbody td tfoot th thead tr".split()
)
#: An open element on the left is closed by a start tag on the right, if none of its scope lies between.
IMPLIED = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "optgroup": {"optgroup"},
    "td": {"td", "th", "tr", "tbody", "thead", "tfoot"}, "th": {"td", "th", "tr", "tbody", "thead", "tfoot"},
    "tr": {"tr", "tbody", "thead", "tfoot"}, "tbody": {"tbody", "tfoot", "thead"}, "thead": {"tbody", "tfoot"}, "tfoot": {"tbody"},
    "caption": {"tr", "tbody", "thead", "tfoot", "colgroup"}, "colgroup": {"tr", "tbody", "thead", "tfoot"}, "head": {"body"},
    "p": BLOCK - set("caption dd dt html body legend li option optgroup tbody td tfoot th thead tr summary".split()) | set("li dd dt".split()),
}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}}
#: What an open ``head`` takes in; any other start tag and any text but white space close it.
_HEAD = set("base link meta noframes noscript script style template title".split())
_WALL = {"table", "td", "th", "body", "html"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_GONE = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


@dataclass
class Node:
    tag: str
    hidden: bool = False
    start: int = 1
    span: int = 1
    rows: int = 1
    #: Whether it sets its visibility; after :func:`_settle`, whether its own text is seen.
    seen: bool | None = None
    #: Of an option: it is chosen; of a choice: all its options are shown.
    marked: bool = False
    children: list[Node | str] = field(default_factory=list)
    #: Of a table: its lines, once they are laid out.
    lines: list[str] | None = None


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape((m[2] or "").strip("\"'")) for m in _ATTRIBUTE.finditer(text)}


def _number(text: str | None, least: int, most: int) -> int:
    m = re.match(r"\s*(-?\d{1,9})", text or "")
    return min(max(int(m[1]), least), most) if m else 1


def tree(html: str) -> Node:
    """The elements of a page below one root."""
    root = Node("html")
    open_ = [root]
    at = 0

    def text(s: str) -> None:
        if s:
            s = unescape(s)
            if open_[-1].tag == "head" and s.strip(" \t\n\r\f"):
                open_.pop()
            open_[-1].children.append(s)

    while m := _TOKEN.search(html, at):
        text(html[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    del open_[k:]
                    break
                if open_[k].tag in _WALL and tag not in BLOCK:
                    break
            continue
        for k in range(len(open_) - 1, 0, -1):
            name = open_[k].tag
            if tag in IMPLIED.get(name, ()):
                del open_[k:]
            elif name in SCOPE.get(tag, ()) or name in _WALL and tag not in IMPLIED["td"]:
                break
        if tag in ("html", "body") and any(n.tag == tag for n in open_):
            continue
        if open_[-1].tag == "head" and tag not in _HEAD:
            open_.pop()
        node = Node(tag, tag in HIDDEN)
        if m[3]:
            a = _attributes(m[3])
            unseen = "hidden" in a and a["hidden"].lower() != "until-found" or a.get("aria-hidden", "").lower() == "true" or _GONE.search(a.get("style", ""))
            node.hidden |= bool(unseen)
            if shown := _VISIBILITY.search(a.get("style", "")):
                node.seen = shown[1].lower() == "visible"
            node.marked = "selected" in a if tag == "option" else "multiple" in a or _number(a.get("size"), 0, 99) > 1
            node.start = _number(a["start"], -(10**9), 10**9) if tag == "ol" and "start" in a else 1
            node.span = _number(a.get("colspan"), 1, 1000)
            node.rows = _number(a.get("rowspan"), 0, 65534)
            if tag == "img" and a.get("alt"):
                node.children.append(a["alt"])
        open_[-1].children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*[^>]*>", re.I).search(html, at)
            if tag in ("textarea", "xmp"):
                node.children.append(unescape(html[at : end.start() if end else len(html)]))
            at = end.end() if end else len(html)
        else:
            open_.append(node)
    text(html[at:])
    return root


class _Lines:
    """Lines in the making: collapses white space and keeps gaps between blocks."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = False
        self.space = False
        self.prefix = ""
        self.indent = ""

    def word(self, text: str) -> None:
        for k, piece in enumerate(_SPACE.split(text)):
            if k:
                self.space = True
            if piece:
                if self.space and self.parts:
                    self.parts.append(" ")
                self.parts.append(piece)
                self.space = False

    def plain(self, text: str) -> None:
        for k, piece in enumerate(text.split("\n")):
            if k:
                self.end(True)
            if piece:
                self.parts.append(piece)

    def end(self, keep: bool = False) -> None:
        if self.parts or keep:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines.append((self.indent + self.prefix + "".join(self.parts)).rstrip())
            if self.prefix:
                self.indent += " " * len(self.prefix)
                self.prefix = ""
        self.parts, self.space = [], False

    def apart(self) -> None:
        self.end()
        self.gap = True


def render(html: str | None) -> str | None:
    """The visible text of a page."""
    if html is None:
        return None
    root = tree(html)
    for table in reversed(_settle(root)):
        table.lines = _table(table)
    return "\n".join(_rendered(root)).strip("\n")


def _settle(root: Node) -> list[Node]:
    """Hand visibility down and hide the options that are not shown; all tables that are seen, outer ones first."""
    tables = []
    root.seen = True
    stack = [root]
    while stack:
        node = stack.pop()
        if node.hidden:
            continue
        if node.tag == "table":
            tables.append(node)
        if node.tag == "select" and not node.marked:
            _choose(node)
        for c in node.children:
            if isinstance(c, Node):
                c.seen = node.seen if c.seen is None else c.seen
                stack.append(c)
    return tables


def _choose(select: Node) -> None:
    """Hide all options but the last chosen one, or the first where none is."""
    options, stack = [], [select]
    while stack:
        node = stack.pop()
        if node.tag == "option":
            options.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    shown = next((o for o in reversed(options) if o.marked), options[0] if options else None)
    for o in options:
        o.hidden |= o is not shown


def _rendered(node: Node) -> list[str]:
    """Lines of one node, in which all tables have their lines; the walk keeps its own stack."""
    out = _Lines()
    stack: list[tuple] = [("open", node, False, None, True)]
    while stack:
        act, n, pre, lists, seen = stack.pop()
        if act == "call":
            n()
            continue
        if isinstance(n, str):
            if seen:
                out.plain(n) if pre else out.word(n)
            continue
        if n.hidden:
            continue
        tag = n.tag
        if tag == "br":
            out.end(True)
            continue
        if tag == "hr":
            out.apart()
            continue
        if n.lines is not None:
            out.apart()
            out.end()
            for line in n.lines:
                out.parts.append(line)
                out.end(True)
            out.apart()
            continue
        after = []
        block = tag in BLOCK
        if block:
            # A list inside a list stands close to its item.
            (out.end if tag in ("ul", "ol") and lists else out.apart if tag in APART else out.end)()
            after.append(out.apart if tag in APART and not (tag in ("ul", "ol") and lists) else out.end)
        if tag in ("ul", "ol", "menu"):
            lists = [tag, n.start]
        if tag == "li":
            mark = f"{lists[1]}. " if lists and lists[0] == "ol" else "- "
            if lists:
                lists[1] += 1
            before = (out.indent, out.prefix)
            if out.prefix:
                out.indent += " " * len(out.prefix)
            out.prefix = mark

            def close(before=before) -> None:
                out.end()
                out.indent, out.prefix = before

            after = [close]
        if tag == "td" or tag == "th":
            after.append(lambda: setattr(out, "space", True))
        pre = pre or tag in ("pre", "textarea", "xmp")
        for f in after[::-1]:
            stack.append(("call", f, None, None, True))
        stack.extend(("open", c, pre, lists, n.seen) for c in reversed(n.children))
    out.end()
    return out.lines


def _within(parent: Node, children: list[Node | str] | None = None) -> list[str]:
    return _rendered(Node("div", seen=parent.seen, children=parent.children if children is None else children))


def _table(table: Node) -> list[str]:
    """Rows of a table with cells padded to columns; a cell of several lines takes as many."""
    captions, rows = [], []
    stack = [(c, table) for c in reversed(table.children)]
    while stack:
        n, parent = stack.pop()
        if isinstance(n, str):
            if parent.seen and n.strip():
                captions += [_SPACE.sub(" ", n).strip()]
        elif n.hidden:
            continue
        elif n.tag == "tr":
            cells = [(_within(c), c.span, c.rows) for c in n.children if isinstance(c, Node) and c.tag in ("td", "th") and not c.hidden]
            loose = [c for c in n.children if not (isinstance(c, Node) and c.tag in ("td", "th"))]
            if any(isinstance(c, Node) or c.strip() for c in loose):
                captions += _within(n, loose)
            if cells:
                rows.append(cells)
        elif n.tag in ("tbody", "thead", "tfoot"):
            stack.extend((c, n) for c in reversed(n.children))
        elif n.tag in ("td", "th"):
            rows.append([(_within(n), n.span, n.rows)])
        else:
            captions += _rendered(n)
    placed, widths = _grid(rows)
    out = [*captions]
    for cells in placed:
        for k in range(max([1, *(len(lines) for lines, _, _ in cells)])):
            line = []
            for lines, at, span in cells:
                room = sum(widths[at : at + span]) + 3 * (span - 1)
                line.append((lines[k] if k < len(lines) else "").ljust(room))
            out.append(" | ".join(line).rstrip())
    return out


def _grid(rows: list[list[tuple[list[str], int, int]]]) -> tuple[list[list[tuple[list[str], int, int]]], list[int]]:
    """Cells of each row with their first column and span, blank ones below a cell that spans rows; and the widths of the columns."""
    placed, open_ = [], []  # open_: first column, span and rows left of the cells that reach into the next row
    for i, cells in enumerate(rows):
        own, held, at = [], sorted(open_), 0
        waiting = list(cells)
        while waiting or held:
            if held and (held[0][0] <= at or not waiting):
                own.append(([], held[0][0], held[0][1]))
                at = max(at, held[0][0] + held[0][1])
                held.pop(0)
                continue
            lines, span, down = waiting.pop(0)
            # A cell ends where one from above begins.
            if held:
                span = max(1, min(span, held[0][0] - at))
            own.append((lines, at, span))
            if down != 1:
                open_.append((at, span, down if down else len(rows) - i))
            at += span
        open_ = [(a, s, d - 1) for a, s, d in open_ if d > 1]
        placed.append(own)
    widths = [0] * max([0, *(at + span for own in placed for _, at, span in own)])
    spanning = []
    for own in placed:
        for lines, at, span in own:
            need = max([0, *map(len, lines)])
            if span == 1:
                widths[at] = max(widths[at], need)
            elif need:
                spanning.append((span, at, need))
    # What a wide cell needs beyond its columns goes to the last of them.
    for span, at, need in sorted(spanning):
        room = sum(widths[at : at + span]) + 3 * (span - 1)
        widths[at + span - 1] += max(0, need - room)
    return placed, widths


def extract(pages: DataFrame, html_col: str = "html", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``pages`` (all but the page by default) and ``text``, its visible text."""
    columns = [c for c in pages.columns if c != html_col] if columns is None else columns
    names = [f"_c{i}" for i in range(len(columns))]
    rows = pages.select(*(F.col(c).alias(n) for c, n in zip(columns, names)), F.col(html_col).alias("text"))

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(map(render, part.column(len(names)).to_pylist()), pa.string())], names=part.schema.names)

    return rows.mapInArrow(run, rows.schema).select(*(F.col(n).alias(c) for c, n in zip(columns, names)), F.col("text").alias("text"))
