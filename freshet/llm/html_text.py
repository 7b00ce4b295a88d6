"""Text of web pages as a reader sees it: a tree with implied tags, then a layout of its visible parts.

The tree builder closes what HTML lets authors leave open (paragraphs, list items, cells, options) and
ignores stray end tags. The layout leaves out what is not shown (scripts, styles, hidden attributes and
styles, lists to choose from), collapses white space outside `pre`, sets blocks apart, marks list items and aligns table cells
in columns. All visible text is kept, navigation and footers too.

Pages may nest as deep as they like, tables too: nothing recurses, and closing an element looks up where the
open ones of its kind are. Padding between cells is bounded, whatever their text, so the text grows with the page.

Odd rows: a null page, like an empty one, has an empty text; repeated rows and null ids each give a row; no rows
give none; other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Generator, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript title meta link datalist object iframe audio video canvas select".split())
# What may lie in a head; any other element, or text, ends one left open.
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
# Parts of a drawing or formula that only describe it.
ASIDE = frozenset("defs desc metadata annotation annotation-xml".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Blocks with an empty line around them, and those that only start a line of their own.
SPACED = frozenset("p blockquote pre ul ol dl table figure hr".split()) | HEADINGS
LINES = frozenset("html body div section article aside header footer main nav address form fieldset details summary dialog figcaption legend dt dd li tr caption center menu hgroup search".split())
BLOCKS = SPACED | LINES
# A start tag closes these open elements, looked for no further up than the given ones.
_CELLS = ("td", "th")
IMPLIED_END = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "tr": (("tr", *_CELLS), ("table",)),
    "td": (_CELLS, ("tr", "table")),
    "th": (_CELLS, ("tr", "table")),
    "thead": (("tr", *_CELLS, "thead", "tbody", "tfoot", "caption"), ("table",)),
    "tbody": (("tr", *_CELLS, "thead", "tbody", "tfoot", "caption"), ("table",)),
    "tfoot": (("tr", *_CELLS, "thead", "tbody", "tfoot", "caption"), ("table",)),
}
_SPACE = re.compile(r"[ \t\n\r\f]+")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.I)
# Cells up to this wide are aligned, with at most this much padding in a line; all text is kept.
ALIGNED = 60
PADDING = 400
SPAN = 100
# Inline boxes that stand apart from the text around them.
BOXES = frozenset("textarea svg text button".split())


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


class TreeBuilder(HTMLParser):
    """Nodes and strings below `root`; open elements on a stack, and where in it those of each tag are."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}

    def _is_open(self, *tags: str) -> bool:
        return any(self.places.get(tag) for tag in tags)

    def _cut(self, place: int) -> None:
        """Close the open elements from a place on."""
        for node in self.open[place:]:
            self.places[node.tag].pop()
        del self.open[place:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body") and self._is_open(tag):
            return
        if tag == "body" or (self.open[-1].tag == "head" and tag not in HEAD and tag not in ("html", "head")):
            self._close(("head",), ())
        if tag in BLOCKS:
            self._close(("p",), _CELLS + ("table", "li", "dd", "button", "object"))
            if tag in HEADINGS and self.open[-1].tag in HEADINGS:
                self._cut(len(self.open) - 1)
        if tag in IMPLIED_END:
            self._close(*IMPLIED_END[tag])
        node = Node(tag, {k: v or "" for k, v in attrs})
        if tag in ASIDE and self._is_open("svg", "math"):
            node.attrs["hidden"] = ""
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing outside void elements

    def handle_endtag(self, tag: str) -> None:
        if tag == "br" or (tag == "p" and not self._is_open("p")):
            self.handle_starttag(tag, [])
        if tag in VOID:
            return
        limit = ("table",) if tag not in BLOCKS and tag != "table" else ()
        self._close((tag,), limit if tag not in _CELLS else ("table",))

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip(" \t\n\r\f"):
            self._cut(len(self.open) - 1)
        if self.open[-1].tag in ("table", "thead", "tbody", "tfoot", "tr") and not data.strip():
            return
        self.open[-1].children.append(data)

    def _close(self, tags: tuple[str, ...], stop: tuple[str, ...]) -> None:
        """Close the outermost open element of `tags` above the nearest one of `stop`; of a single tag, the
        nearest."""
        floor = max((self.places[t][-1] for t in stop if self.places.get(t)), default=0)
        found = []
        for tag in tags:
            places = self.places.get(tag)
            if places and places[-1] > floor:
                found.append(places[-1] if len(tags) == 1 else places[bisect_right(places, floor)])
        if found:
            self._cut(min(found))


def visible(node: Node) -> bool:
    if node.tag in HIDDEN or "hidden" in node.attrs or (node.tag == "input" and node.attrs.get("type", "").lower() == "hidden"):
        return False
    return not _NOT_SHOWN.search(node.attrs.get("style", ""))


def width(text: str) -> int:
    """Columns a text takes: wide East Asian characters two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Layout:
    """Lines of text. A line that is open takes inline text; blocks ask for breaks before and after."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False  # a space is due before the next inline text
        self.gap = 0  # lines to leave before the next text
        self.prefix = ""  # the mark of a list item, due at its first text
        self.indent = ""

    def text(self, data: str, keep_space: bool = False) -> None:
        if keep_space:
            for i, part in enumerate(data.split("\n")):
                if i:
                    self.end_line(force=True)
                if part:
                    self.add(part)
            return
        words = _SPACE.sub(" ", data)
        if words.startswith(" "):
            self.space, words = bool(self.line), words[1:]
        if words:
            tail = words.endswith(" ")
            self.add((" " if self.space and self.line else "") + words.rstrip(" "))
            self.space = tail

    def add(self, part: str) -> None:
        if not self.line:
            if self.lines:
                self.lines += [""] * max(0, self.gap - 1)
            self.gap = 0
            self.line = [self.indent + self.prefix]
            self.prefix = ""
        self.line.append(part)

    def end_line(self, force: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
        elif force and self.lines:
            self.lines.append("")
        self.line, self.space = [], False

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def done(self) -> str:
        self.end_line()
        return "\n".join(self.lines).strip("\n")


def muted_by(node: Node, muted: bool) -> bool:
    """Whether a node's own text is invisible, given that its parent's is: its place stays, and what is
    made visible again inside it shows."""
    found = _VISIBILITY.findall(node.attrs.get("style", ""))
    return muted if not found else found[-1].lower() != "visible"


def render(root: Node) -> str:
    """The text of a tree. Parts that wait for the text of a part of theirs are kept on a stack."""
    waiting, value = [_rendered(root, False)], None
    while waiting:
        try:
            part = waiting[-1].send(value)
        except StopIteration as end:
            waiting.pop()
            value = end.value
        else:
            waiting.append(part)
            value = None
    return value


def _rendered(root: Node, muted: bool) -> Generator:
    """Depth first; a table is another part, waited for."""
    out = Layout()
    lists: list[list] = []
    pre = 0
    stack: list = [root]
    while stack:
        at = stack.pop()
        if isinstance(at, str):
            if not muted:
                out.text(at, pre > 0)
            continue
        if isinstance(at, tuple):
            node, muted = at
            if node.tag == "pre":
                pre -= 1
            elif node.tag in ("ul", "ol", "menu"):
                lists.pop()
                out.indent = "  " * max(0, len(lists) - 1)
            elif node.tag == "li":
                out.prefix = ""
            elif node.tag == "blockquote":
                out.indent = out.indent[2:]
            elif node.tag == "q" and not muted:
                out.add('"')
            elif node.tag in BOXES:
                out.space = bool(out.line)
            if node.tag in BLOCKS:
                out.block(2 if node.tag in SPACED and not (lists and node.tag in ("ul", "ol")) else 1)
            continue
        tag = at.tag
        if tag and not visible(at):
            continue
        if tag == "br":
            out.end_line(force=True)
            continue
        if tag == "hr":
            out.block(2)
            continue
        hidden = muted_by(at, muted)
        if tag == "img":
            if not hidden:
                out.text(at.attrs.get("alt", ""))
            continue
        if tag in BLOCKS:
            out.block(2 if tag in SPACED and not (lists and tag in ("ul", "ol")) else 1)
        if tag == "table":
            for row in (yield _table_lines(at, hidden)):
                out.add(row)
                out.end_line()
            out.block(2)
            continue
        if tag == "pre":
            pre += 1
        elif tag in ("ul", "ol", "menu"):
            start = at.attrs.get("start", "1")
            lists.append([tag == "ol", int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
            out.indent = "  " * (len(lists) - 1)
        elif tag == "li":
            numbered, number = lists[-1] if lists else (False, 0)
            out.prefix = f"{number}. " if numbered else "- "
            if numbered:
                lists[-1][1] += 1
        elif tag == "blockquote":
            out.indent += "  "
        elif tag == "dd":
            out.text("    ", True)
        elif tag == "q" and not hidden:
            out.text('"')
        if tag in ("td", "th") or tag in BOXES:  # a cell outside a table, a field, a drawing and its labels
            out.space = bool(out.line)
        stack.append((at, muted))
        stack.extend(reversed(at.children))
        muted = hidden
    return out.done()


def _span(cell: Node, name: str) -> int:
    given = cell.attrs.get(name, "1")
    return min(int(given), SPAN) if re.fullmatch(r"[1-9]\d{0,3}", given) else 1


def _table_lines(table: Node, muted: bool) -> Generator:
    """Its rows with cells padded to their column; a caption comes first, a nested table's rows are
    lines of its cell. Cells that reach into later rows keep their columns free there."""
    rows: list[list[list[str]]] = []
    lines: list[str] = []
    taken: dict[int, int] = {}  # column: rows for which a cell above still takes it
    stack: list = [(child, muted) for child in reversed(table.children)]
    while stack:
        at, muted = stack.pop()
        if isinstance(at, str):
            if at.strip() and not muted:
                lines.append(_SPACE.sub(" ", at).strip())
            continue
        if not visible(at):
            continue
        muted = muted_by(at, muted)
        if at.tag == "tr":
            row: list[list[str]] = []
            spans: dict[int, int] = {}
            for cell in at.children:
                if isinstance(cell, str):
                    if cell.strip() and not muted:
                        lines.append(_SPACE.sub(" ", cell).strip())
                    continue
                if not visible(cell):
                    continue
                while taken.get(len(row)):
                    row.append([""])
                first = len(row)
                row.append((yield _inner(cell, muted_by(cell, muted))).split("\n"))
                row += [[""]] * (_span(cell, "colspan") - 1)
                spans |= dict.fromkeys(range(first, len(row)), _span(cell, "rowspan"))
            taken = {c: n - 1 for c, n in (taken | spans).items() if n > 1}
            if row:
                rows.append(row)
        elif at.tag in ("thead", "tbody", "tfoot", "colgroup"):
            taken = {}
            stack.extend((child, muted) for child in reversed(at.children))
        else:
            lines += [line for line in (yield _inner(at, muted)).split("\n") if line]
    widths: list[int] = []
    for row in rows:
        for i, cell in enumerate(row):
            widths += [0] * (i + 1 - len(widths))
            widths[i] = max(widths[i], *(w for w in map(width, cell) if w <= ALIGNED), 0)
    for row in rows:
        for k in range(max(map(len, row))):
            room, parts = PADDING, []
            for cell, wide in zip(row, widths, strict=False):
                part = cell[k] if k < len(cell) else ""
                pad = min(room, max(0, wide - width(part)))
                room -= pad
                parts.append(part + " " * pad)
            lines.append("  ".join(parts).rstrip())
    return [line for line in lines if line.strip()]


def _inner(node: Node, muted: bool) -> Generator:
    holder = Node("", {})
    holder.children = node.children
    return _rendered(holder, muted)


def page_text(html: str | None) -> str:
    builder = TreeBuilder()
    builder.feed(html or "")
    if not builder.rawdata.startswith("<!--"):  # a comment that never ends hides what is left
        builder.close()
    return render(builder.root)


def extract(pages: DataFrame, html: str = "html", id_col: str = "page_id") -> DataFrame:
    """`page_id`, `text`, `n_lines` of every row; a null or empty page has an empty text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [page_text(h.as_py()) for h in batch.column("html")]
            lines = pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(texts, pa.string()), lines], ["page_id", "text", "n_lines"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(html).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(each, f"page_id {kind}, text string, n_lines long")
