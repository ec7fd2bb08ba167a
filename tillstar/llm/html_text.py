"""Visible text of HTML pages, laid out as a reader sees it.

A page becomes a tree: end tags that HTML lets authors leave out are implied, void and raw-text
elements know their own ends, stray end tags are dropped. The tree is then rendered. Elements
that are not shown (scripts, styles, the head, ``hidden``, ``display:none``,
``visibility:hidden``) give nothing; blocks start lines, paragraphs and headings leave a blank
line, lists have bullets or numbers and are indented, preformatted text keeps its blanks, and
table cells are padded into columns.

Null and empty pages give an empty text, text without any tag is one paragraph. Broken markup
never fails: an unclosed tag or comment reaches to the end of the page. Elements may be nested
to any depth: what renders them keeps its own stack. Rows are rendered one by one, repeated ids
included; other columns are kept.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Generator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from tillstar.llm.common import appended

# Fixed values of HTML: element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head script style template noscript noembed noframes iframe object audio video canvas "
    "datalist param source track title".split()
)
BLOCKS = frozenset(
    "address article aside body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form header hgroup html legend li main menu nav optgroup option search "
    "section summary".split()
)
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 menu ol p pre table ul xmp".split())
LISTS = frozenset("ul ol menu dir".split())
# A start tag of the key ends an open element of the values, unless a fence stands between.
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th", "caption", "colgroup"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "thead": {"caption", "colgroup", "tr", "td", "th"},
    "tbody": {"thead", "tbody", "tr", "td", "th", "caption", "colgroup"},
    "tfoot": {"thead", "tbody", "tr", "td", "th", "caption", "colgroup"},
    "option": {"option"},
    "optgroup": {"option", "optgroup"},
    "body": {"head"},
}
FENCES = {
    "li": LISTS,
    "dt": frozenset({"dl"}),
    "dd": frozenset({"dl"}),
    **dict.fromkeys(("tr", "td", "th", "thead", "tbody", "tfoot"), frozenset({"table"})),
    "option": frozenset({"select", "datalist"}),
    "optgroup": frozenset({"select", "datalist"}),
}
HEAD_ONLY = frozenset("base basefont link meta noscript script style template title".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|$))|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)"
    r"((?:[^>=]|=\s*\"[^\"]*(?:\"|$)|=\s*'[^']*(?:'|$)|=)*)(?:>|$)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?", re.S)
_HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None):
        self.tag, self.attributes = tag, attributes or {}
        self.children: list[Node | str] = []


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(value.strip("\"'")) if value else "")
    return found


class Open:
    """Open elements from the page inwards, and the places of each tag among them."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}

    def last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, at: int) -> None:
        while len(self.nodes) > at:
            self.places[self.nodes.pop().tag].pop()

    def close(self, tags, fence=frozenset()) -> None:
        """Ends the outermost open element of ``tags`` above the next ``fence``."""
        above, found = self.last(fence), []
        for places in filter(None, map(self.places.get, tags)):
            found += places[bisect_right(places, above) :][:1]
        if found:
            self.cut(min(found))

    def close_last(self, tag: str, fence) -> None:
        """Ends the innermost open ``tag`` above the next ``fence``; a stray end tag does nothing."""
        at = self.last([tag])
        if at and at >= self.last(fence):
            self.cut(at)


def parsed(html: str) -> Node:
    """The tree of a page."""
    root = Node("#page")
    stack, at = Open(root), 0
    for token in iter(lambda: _TOKEN.search(html, at), None):
        if token.start() > at:
            stack.nodes[-1].children.append(unescape(html[at : token.start()]))
        at = token.end()
        closing, tag, rest = token.group(1), (token.group(2) or "").lower(), token.group(3) or ""
        if not tag:
            if token.group().startswith("<![CDATA["):
                stack.nodes[-1].children.append(token.group()[9:].removesuffix("]]>"))
        elif closing:
            if tag == "p" and not stack.places.get("p"):
                stack.nodes[-1].children.append(Node("p"))
            elif tag == "br":
                stack.nodes[-1].children.append(Node("br"))
            else:
                fence = {"table", "td", "th"} if tag not in ENDS and tag != "table" else {"table"}
                stack.close_last(tag, fence if tag != "table" else frozenset())
        else:
            if stack.nodes[-1].tag == "head" and tag not in HEAD_ONLY:
                stack.cut(len(stack.nodes) - 1)
            if tag in BLOCKS or tag in SPACED or tag == "hr":
                stack.close({"p"}, {"table", "td", "th", "button", "caption"})
            if tag in ENDS:
                stack.close(ENDS[tag], FENCES.get(tag, frozenset()))
            node = Node(tag, _attributes(rest) if rest else None)
            stack.nodes[-1].children.append(node)
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                inner = html[at : end.start() if end else len(html)]
                node.children.append(unescape(inner) if tag in ("textarea", "title") else inner)
                at = end.end() if end else len(html)
            elif tag not in VOID:
                stack.push(node)
    if at < len(html):
        stack.nodes[-1].children.append(unescape(html[at:]))
    return root


class Page:
    """Lines of text in the making: words join a line until something ends it."""

    def __init__(self):
        self.lines: list[str] = []
        self.line, self.blank_due, self.space_due = "", False, False
        self.mark = ""

    def end_line(self) -> None:
        if self.line or self.mark:
            if self.blank_due and self.lines:
                self.lines.append("")
            self.lines.append((self.mark + self.line).rstrip())
            self.line, self.mark, self.blank_due = "", "", False
        self.space_due = False

    def space(self) -> None:
        self.end_line()
        self.blank_due = bool(self.lines)

    def words(self, text: str) -> None:
        parts = _BLANKS.sub(" ", text)
        if not parts:
            return
        if parts == " ":
            self.space_due = self.space_due or bool(self.line)
            return
        lead = parts[0] == " " or self.space_due
        self.line += (" " if lead and self.line else "") + parts.strip(" ")
        self.space_due = parts[-1] == " "

    def kept(self, text: str) -> None:
        """Preformatted text."""
        first, *more = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        self.line += first
        for line in more:
            self.hard_break()
            self.line = line

    def hard_break(self) -> None:
        if self.line or self.mark:
            self.end_line()
        else:
            self.lines.append("")

    def nested(self, inner: list[str], first: str, rest: str, spaced: bool) -> None:
        """Lines of an element, the first after ``first``, the others after ``rest``."""
        if spaced:
            self.space()
        else:
            self.end_line()
        if inner and self.blank_due:
            self.lines.append("")
            self.blank_due = False
        for k, line in enumerate(inner):
            self.lines.append(((first if k == 0 else rest if line else "") + line).rstrip())
        self.blank_due = spaced and bool(self.lines)

    def done(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        while self.lines and not self.lines[0]:
            self.lines.pop(0)
        return self.lines


def _unseen(node: Node) -> bool:
    a = node.attributes
    if node.tag in UNSEEN or (a and ("hidden" in a or _HIDING.search(a.get("style", "")))):
        return True
    return node.tag == "input" and a.get("type", "").lower() == "hidden"


def _run(task: Generator):
    """The result of ``task``, a generator that hands out the tasks whose results it needs."""
    stack, value = [task], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as end:
            stack.pop()
            value = end.value
    return value


def _rendered(children: list, pre: bool = False) -> Generator:
    page = Page()
    yield _flow(page, children, pre)
    return page.done()


def _number(text: str | None, other: int) -> int:
    return int(text) if text and re.fullmatch(r"\s*-?\d{1,9}\s*", text) else other


def _flow(page: Page, children: list, pre: bool) -> Generator:
    for child in children:
        if isinstance(child, str):
            page.kept(child) if pre else page.words(child)
            continue
        tag = child.tag
        if _unseen(child):
            continue
        if tag == "br":
            page.hard_break()
        elif tag == "hr":
            page.nested(["-" * 20], "", "", spaced=False)
        elif tag == "img":
            page.words(f" {child.attributes.get('alt', '')} ")
        elif tag == "input":
            page.words(f" {child.attributes.get('value', '')} ")
        elif tag == "table":
            page.nested((yield _table(child)), "", "", spaced=True)
        elif tag in LISTS:
            page.nested((yield _list(child, pre)), "", "", spaced=True)
        elif tag == "blockquote":
            page.nested((yield _rendered(child.children, pre)), "    ", "    ", spaced=True)
        elif tag == "dd":
            page.nested((yield _rendered(child.children, pre)), "    ", "    ", spaced=False)
        elif tag in SPACED:
            page.space()
            inner = child.children
            if tag in ("pre", "xmp") and inner and isinstance(inner[0], str):
                inner = [inner[0].removeprefix("\n"), *inner[1:]]
            yield _flow(page, inner, pre or tag in ("pre", "xmp"))
            page.space()
        elif tag in BLOCKS or tag in ("tr", "caption"):
            page.end_line()
            yield _flow(page, child.children, pre)
            page.end_line()
        elif tag in ("td", "th"):
            page.words(" ")
            yield _flow(page, child.children, pre)
            page.words(" ")
        else:
            yield _flow(page, child.children, pre or tag == "textarea")


def _list(node: Node, pre: bool) -> Generator:
    """Items after a bullet or their number, other content in between."""
    page = Page()
    step = -1 if "reversed" in node.attributes else 1
    items = sum(isinstance(c, Node) and c.tag == "li" and not _unseen(c) for c in node.children)
    number = _number(node.attributes.get("start"), items if step < 0 else 1)
    for child in node.children:
        if not isinstance(child, Node) or child.tag != "li":
            yield _flow(page, [child], pre)
            continue
        if _unseen(child):
            continue
        number = _number(child.attributes.get("value"), number)
        mark = f"{number}. " if node.tag == "ol" else "* "
        number += step
        page.nested((yield _rendered(child.children, pre)) or [""], mark, " " * len(mark), spaced=False)
    return page.done()


def _rows(node: Node) -> list[Node]:
    """Rows in the order they are shown: heads first, feet last."""
    parts: dict[int, list[Node]] = {0: [], 1: [], 2: []}
    for child in node.children:
        if isinstance(child, Node) and not _unseen(child):
            if child.tag == "tr":
                parts[1].append(child)
            elif child.tag in ("thead", "tbody", "tfoot"):
                place = ("thead", "tbody", "tfoot").index(child.tag)
                parts[place] += [
                    r for r in child.children if isinstance(r, Node) and r.tag == "tr" and not _unseen(r)
                ]
    return parts[0] + parts[1] + parts[2]


def _table(node: Node) -> Generator:
    """Caption and stray content, then rows with cells padded to the width of their column."""
    shown = set(map(id, _rows(node)))
    page = Page()
    for child in node.children:
        if isinstance(child, str) or child.tag not in ("tr", "thead", "tbody", "tfoot", "colgroup"):
            yield _flow(page, [child], False)
        elif child.tag in ("thead", "tbody", "tfoot"):
            yield _flow(page, [c for c in child.children if id(c) not in shown], False)
    grid: list[list[tuple[int, list[str]]]] = []
    held: dict[int, int] = {}
    for row in _rows(node):
        cells, column = [], 0
        for cell in row.children:
            if isinstance(cell, str) or cell.tag not in ("td", "th"):
                yield _flow(page, [cell], False)
                continue
            while held.get(column, 0) > 0:
                column += 1
            if _unseen(cell):
                continue
            wide = min(max(_number(cell.attributes.get("colspan"), 1), 1), 1000)
            tall = max(_number(cell.attributes.get("rowspan"), 1), 1)
            cells.append((column, (yield _rendered(cell.children))))
            for k in range(column, column + wide):
                held[k] = tall
            column += wide
        held = {k: n - 1 for k, n in held.items() if n > 1}
        if cells:
            grid.append(cells)
    widths: dict[int, int] = {}
    for cells in grid:
        for (column, lines), after in zip(cells, [*cells[1:], None], strict=True):
            if after and after[0] == column + 1:
                widths[column] = max(widths.get(column, 0), *map(len, lines), 0)
    starts, used = {}, sorted({c for cells in grid for c, _ in cells} | set(widths))
    place = 0
    for column, following in zip(used, [*used[1:], None], strict=True):
        starts[column] = place
        place += widths.get(column, 0) + 2 if following is not None else 0
    for cells in grid:
        for k in range(max(len(lines) for _, lines in cells) or 0):
            line = ""
            for column, lines in cells:
                if k < len(lines) and lines[k]:
                    line = line.ljust(starts[column])
                    line += ("  " if line and not line.endswith("  ") else "") + lines[k]
            page.nested([line], "", "", spaced=False)
    return page.done()


def visible_text(html: str | None) -> str:
    """The page's text as it is laid out."""
    return "\n".join(_run(_rendered([parsed(html)]))) if html else ""


def with_text(df: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``df`` with the visible text of each page (replaced if the column exists)."""

    def make(batch: pa.RecordBatch):
        return [[visible_text(h) for h in batch.column(html_col).to_pylist()]]

    return appended(df, make, {out_col: pa.string()}, f"`{out_col}` string")
