"""Layout-aware text of web pages.

A tree is built from the tags, with the end tags that HTML lets authors leave out;
then what a reader would see is rendered: blocks on lines of their own, paragraphs
parted by a blank line, list items with bullets or numbers, tables with aligned
columns, preformatted text as it is.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Fixed values of HTML: element kinds, and what ends an open element.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("datalist head iframe noscript object script style svg template title".split())
SPACED = set("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 ol p pre table ul".split())
BLOCKS = SPACED | set(
    "address article aside body caption center dd details dialog div dt figcaption footer form header hgroup hr html legend"
    " li main nav option section summary tbody td tfoot th thead tr".split()
)
CLOSES_P = BLOCKS - set("body caption dd dt html legend li option summary tbody td tfoot th thead tr".split())
#: Opening the tag ends these, up to the nearest of the elements that hold them.
ENDS = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "body": ({"head"}, {"html"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
#: What a head may hold; anything else ends it.
HEAD_HOLDS = set("base link meta noscript script style template title".split())
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(hidden|collapse)", re.I)
#: A column is padded to its longest cell, but no further than this.
WIDEST = 60
BLANK = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []


class TreeBuilder(HTMLParser):
    """The tree of a page; ``open`` holds the elements that have not ended."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html":
            return
        if tag in CLOSES_P:
            self._end({"p"}, {"td", "th", "li", "div", "body", "table", "button"})
        if tag in ENDS:
            self._end(*ENDS[tag])
        elif self.open[-1].tag == "head" and tag not in HEAD_HOLDS:
            self.open.pop()  # a body without its tag
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "p" and not any(n.tag == "p" for n in self.open):
            self.handle_starttag("p", [])
        self._end({tag}, {"table"} if tag in ("p", "li", "div", "td", "th", "tr") and tag != "table" else set())

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and BLANK.sub("", data):
            self.open.pop()  # a body without its tag
        self.open[-1].children.append(data)

    def _end(self, tags: set[str], within: set[str]) -> None:
        """End the outermost of ``tags`` that is open inside the nearest of ``within``."""
        found = None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                found = i
                if len(tags) == 1:
                    break
            elif self.open[i].tag in within:
                break
        if found is not None:
            del self.open[found:]


def hidden(node: Node) -> bool:
    attrs = node.attrs
    if node.tag in HIDDEN or "hidden" in attrs or (node.tag == "dialog" and "open" not in attrs):
        return True
    if node.tag == "input":
        return (attrs.get("type") or "").lower() == "hidden"
    return bool(attrs.get("style")) and UNSEEN.search(attrs["style"]) is not None


class Lines:
    """Rendered lines. A gap asked for before or after a block is made once, between blocks."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = False
        self.indent = ""
        self.mark = ""

    def words(self, text: str, pre: bool) -> None:
        if pre:
            first, *rest = text.replace("\r\n", "\n").split("\n")
            self.parts.append(first)
            for line in rest:
                self.newline(keep=True)
                self.parts.append(line)
            return
        text = BLANK.sub(" ", text)
        if text == " " and (not self.parts or self.parts[-1].endswith(" ")):
            return
        if text.startswith(" ") and (not self.parts or self.parts[-1].endswith(" ")):
            text = text[1:]
        if text:
            self.parts.append(text)

    def newline(self, keep: bool = False) -> None:
        line = "".join(self.parts).rstrip()
        self.parts = []
        if not line and not keep:
            return
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines.append((self.indent[: len(self.indent) - len(self.mark)] + self.mark + line).rstrip() if self.mark else (self.indent + line).rstrip())
        self.mark = ""

    def block(self, spaced: bool) -> None:
        self.newline()
        self.gap = self.gap or spaced


def render(page: str) -> str:
    """All text of a page that shows."""
    builder = TreeBuilder()
    builder.feed(page)
    builder.close()
    return "\n".join(_rendered(builder.root)).strip("\n")


def _rendered(top: Node, cells: bool = True) -> list[str]:
    """Lines of a subtree. The stack holds what is left to do, so nesting costs no recursion."""
    out = Lines()
    stack: list = [("open", top, False, [0])]
    while stack:
        what, node, pre, number = stack.pop()
        if what == "text":
            out.words(node, pre)
        elif what == "restore":
            out.newline()
            out.indent, out.mark = node
        elif what == "block":
            out.block(node)
        elif not hidden(node):
            _open(out, stack, node, pre, number, cells)
    out.newline()
    return out.lines


def _open(out: Lines, stack: list, node: Node, pre: bool, number: list[int], cells: bool) -> None:
    tag = node.tag
    if tag == "br":
        out.newline(keep=True)
        return
    if tag == "hr":
        out.block(False)
        out.words("---", False)
        out.block(False)
        return
    if tag == "img":
        if node.attrs.get("alt"):
            out.words(node.attrs["alt"], False)
        return
    if tag == "table" and cells:
        out.block(True)
        for line in _table(node):
            out.parts = [line]
            out.newline()
        out.block(True)
        return
    if tag in BLOCKS:
        spaced = tag in SPACED and not (tag in ("ul", "ol") and out.indent)
        out.block(spaced)
        stack.append(("block", spaced, pre, number))
    if tag in ("td", "th") and out.parts:
        out.words(" ", False)
    if tag in ("ul", "ol"):
        start = node.attrs.get("start") or ""
        number = [int(start) if tag == "ol" and start.isascii() and start.isdigit() and len(start) < 10 else 1, tag == "ol"]
    if tag == "li":
        mark = f"{number[0]}. " if len(number) > 1 and number[1] else "- "
        number[0] += 1
        stack.append(("restore", (out.indent, out.mark), pre, number))
        out.indent, out.mark = out.indent + " " * len(mark), mark
    elif tag in ("blockquote", "dd"):
        stack.append(("restore", (out.indent, out.mark), pre, number))
        out.indent += "  "
    pre = pre or tag in ("pre", "textarea")
    for child in reversed(node.children):
        stack.append(("text", child, pre, number) if isinstance(child, str) else ("open", child, pre, number))


def _table(table: Node) -> list[str]:
    """Rows with their cells in columns as wide as their longest line. A table within a cell is not aligned itself."""
    lines: list[str] = []
    rows: list[list[list[str]]] = []
    stack = list(reversed(table.children))
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            lines.extend(x for x in [BLANK.sub(" ", node).strip()] if x)
        elif hidden(node):
            continue
        elif node.tag == "tr":
            rows.append([_rendered(c, False) if isinstance(c, Node) else [c.strip()] for c in node.children if isinstance(c, Node) or c.strip()])
        elif node.tag in ("tbody", "thead", "tfoot"):
            stack.extend(reversed(node.children))
        elif node.tag in ("td", "th"):
            rows.append([_rendered(node, False)])
        else:
            lines.extend(_rendered(node, False))
    widths: list[int] = []
    for row in rows:
        for i, cell in enumerate(row):
            if i == len(widths):
                widths.append(0)
            widths[i] = min(WIDEST, max([widths[i], *map(len, cell)]))
    for row in rows:
        for k in range(max([1, *map(len, row)])):
            parts = [(cell[k] if k < len(cell) else "").ljust(width) for cell, width in zip(row, widths)]
            lines.append("  ".join(parts).rstrip())
    return lines


def extract(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per row its id, ``text``, ``n_lines`` and ``n_chars``.

    NULL and empty pages have an empty text. NULL and repeated ids and repeated rows
    are rendered each by itself. An empty table gives no rows. Broken markup is
    rendered as far as it can be read. Columns besides the two named are not read.
    """
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = [render(p) if p else "" for p in b.column("html").to_pylist()]
            sizes = [t.count("\n") + 1 if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array([len(t) for t in texts], pa.int64())],
                [id_col, "text", "n_lines", "n_chars"],
            )

    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, text string, n_lines long, n_chars long")
