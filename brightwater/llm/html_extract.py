"""Layout-aware text of HTML pages.

A tree builder turns the page's tags into a tree, supplying what authors leave out: a new
``<p>`` or ``<li>`` closes the last one, a block closes an open paragraph, cells and rows imply each
other, stray end tags are dropped. A renderer then emits all text that a browser would show, boilerplate
included: elements that never render (scripts, styles, templates, ``hidden``, inline
``display:none``) are left out, blocks stand on lines of their own with blank lines around
paragraphs and headings, list items carry bullets or numbers at their depth, cells of a table are
padded to common widths, ``<pre>`` and ``<textarea>`` keep their spaces, options stand on lines of their own, of an svg
its text elements are shown, and other white space collapses.

Any text is a page. Tags are read in one pass and nothing is looked up by walking the tree, so time
grows with the length of a page however its markup is broken: an unclosed tag or comment ends the page as in
a browser. Layout has limits, text has none: indents grow for ``MOST_INDENTS`` levels, tables nested
deeper than ``MOST_TABLES`` and those that padding would blow up stand unaligned.

Nulls: a null page gives null text and 0 counts. Repeated rows are pages of their own. An
empty table gives no rows. Other columns are never looked at.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Callable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_INDENTS, MOST_TABLES = 40, 20
#: Cells wider than this don't widen their column; padding that makes a table this many times its text is left out.
MAX_CELL, MOST_PADDING = 60, 50

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style title template head noscript object iframe canvas audio video datalist annotation annotation-xml noembed noframes".split())
#: What may stand in a head; of these, what holds text of its own; anything else ends a head.
IN_HEAD = frozenset("base link meta title script style noscript template".split())
HEAD_TEXT = IN_HEAD - VOID
#: Tags that end an open svg or math; parts of an svg whose text is shown or isn't.
BREAKOUT = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre
    ruby s small span strong strike sub sup table tt u ul var""".split())
SVG_TEXT, SVG_UNSEEN = frozenset(["text", "foreignobject"]), frozenset("defs symbol clippath mask pattern marker desc metadata".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    header hgroup hr html legend li main menu nav ol optgroup option p plaintext pre search section select summary table textarea ul xmp listing""".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p plaintext pre table ul xmp listing".split())
CELLS, ROW_GROUPS = frozenset(["td", "th"]), frozenset(["thead", "tbody", "tfoot"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose content is no markup, and those of them that are shown.
RAW = frozenset("script style title textarea iframe noembed noframes noscript xmp plaintext".split())
RAW_SHOWN, PREFORMATTED = frozenset("textarea xmp plaintext".split()), frozenset("pre textarea xmp listing plaintext".split())
#: Attributes that matter here; kinds of input whose value is shown.
KEPT = frozenset("hidden style open alt label start type value colspan rowspan".split())
VALUE_SHOWN = frozenset(["", *"text search email url tel number date time month week submit button reset".split()])
#: What an opening tag closes first, and what stops the search for it.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "table"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl", "table"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])), "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "tr": (frozenset(["tr", "td", "th", "caption"]), frozenset(["table"])),
    "td": (CELLS | {"caption"}, frozenset(["tr", "table"])), "th": (CELLS | {"caption"}, frozenset(["tr", "table"])),
    **{g: (ROW_GROUPS | {"tr", "td", "th", "caption"}, frozenset(["table"])) for g in ROW_GROUPS},
}
_NO_DISPLAY = re.compile(r"(?:display\s*+:\s*+none|visibility\s*+:\s*+(?:hidden|collapse))", re.I)
_SPACES = re.compile(r"[ \t\n\r\f]+")
_TAG_NAME = re.compile(r"[a-zA-Z][^ \t\n\r\f/>]*+")
_SKIP, _NAME, _EQUALS, _UNQUOTED = (re.compile(p) for p in (r"[ \t\n\r\f/]*+", r"=?[^ \t\n\r\f/>=]*+", r"[ \t\n\r\f]*+=[ \t\n\r\f]*+", r"[^ \t\n\r\f>]*+"))
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {t: re.compile(rf"</{t}(?=[ \t\n\r\f/>])", re.I) for t in RAW - {"plaintext"}}
_ZEROS, _HUGE = re.compile(r"&#([xX]?)0++(?=[0-9])"), re.compile(r"&#(?:[0-9]{8,}+|[xX][0-9a-fA-F]{7,}+);?")
_NUMBER = re.compile(r"[ \t\n\r\f]*+0*+(\d{1,9})(?!\d)")


def decoded(text: str) -> str:
    """Character references of a text; numbers beyond Unicode become U+FFFD."""
    if "&" not in text:
        return text
    return unescape(_HUGE.sub("\ufffd", _ZEROS.sub(r"&#\1", text)) if "&#" in text else text)


def number(value: str | None, least: int, most: int, otherwise: int) -> int:
    """A whole number of an attribute, within bounds."""
    if m := _NUMBER.match(value or ""):
        return max(least, min(most, int(m[1])))
    return most if (value or "").strip().isdecimal() else otherwise


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


class TreeBuilder:
    """Open elements, and for each tag the places where it is open, so that no search walks the stack."""

    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]
        self.at: dict[str, list[int]] = {}

    def last(self, *tags: str) -> int:
        """The innermost place where one of the tags is open, or 0."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def _cut(self, k: int) -> None:
        while len(self.open) > k:
            self.at[self.open.pop().tag].pop()

    def foreign(self) -> bool:
        return self.last("svg", "math") > self.last("foreignobject", "annotation-xml")

    def _leave_head(self, tag: str | None = None) -> None:
        """Ends an open head that ``tag``, or text, can't be part of."""
        at = self.last("head")
        if not at or tag in IN_HEAD or tag == "head":
            return
        inner = self.last(*HEAD_TEXT) if tag is None else max(self.last("template"), self.last("noscript") if tag in VOID or tag in HIDDEN else 0)
        if inner < at:
            self._cut(at)

    def _close_until(self, tags: frozenset[str], stops: frozenset[str]) -> None:
        while (k := self.last(*tags)) > self.last(*stops):  # go on: a row group closes the row and the cell in it
            self._cut(k)

    def _push(self, tag: str, attrs: dict[str, str]) -> None:
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.at.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def start(self, tag: str, attrs: dict[str, str], ended: bool) -> None:
        if tag in ("html", "body"):
            self._close_until(frozenset(["head"]), frozenset())
            return
        if self.at.get("head"):
            self._leave_head(tag)
        if tag in BREAKOUT and self.foreign():
            self._cut(self.last("svg", "math"))
        if tag in BLOCK and tag not in ("option", "optgroup", "select", "textarea"):
            self._close_until(frozenset(["p"]), CELLS | {"table", "button", "caption"})
        if tag in CLOSES:
            self._close_until(*CLOSES[tag])
        if tag in CELLS and self.open[-1].tag != "tr":
            self._push("tr", {})
        self._push(tag, attrs)
        # "/" at the end means nothing in HTML, but ends an element of svg or math
        if ended and self.open[-1].tag == tag and tag not in BLOCK and self.foreign():
            self._cut(len(self.open) - 1)

    def end(self, tag: str) -> None:
        if tag == "br":
            self._push("br", {})
            return
        stop = 0 if tag in ("table", "tr") or tag in ROW_GROUPS else self.last("table")
        k = self.last(*HEADINGS) if tag in HEADINGS else self.last(tag)
        if k > stop:
            self._cut(k)
        elif tag == "p":
            self._push("p", {})
            self._cut(len(self.open) - 1)

    def text(self, data: str) -> None:
        if self.at.get("head") and not data.isspace():
            self._leave_head()
        if data:
            self.open[-1].children.append(data)


def _attributes(html: str, i: int) -> tuple[dict[str, str], bool, int] | None:
    """(attributes, whether the tag ends in "/", place after it); None where the page ends within the tag."""
    n, found = len(html), {}
    while True:
        i = _SKIP.match(html, i).end()
        if i >= n:
            return None
        if html[i] == ">":
            return found, html[i - 1] == "/", i + 1
        m = _NAME.match(html, i)
        name, value, i = m[0].lower() if m.end() - i < 16 else "", "", m.end()
        if m := _EQUALS.match(html, i):
            i = m.end()
            if i < n and html[i] in "\"'":
                close = html.find(html[i], i + 1)
                if close < 0:
                    return None
                value, i = html[i + 1:close], close + 1
            else:
                m = _UNQUOTED.match(html, i)
                value, i = m[0], m.end()
        if name in KEPT and name not in found:
            found[name] = decoded(value)


def build_tree(html: str) -> Node:
    """The page's tree. Every character is read a bounded number of times."""
    tree, i, n = TreeBuilder(), 0, len(html)
    while i < n:
        at = html.find("<", i)
        if at < 0:
            at = n
        if at > i:
            tree.text(decoded(html[i:at]))
        if at >= n:
            break
        if m := _TAG_NAME.match(html, at + 1):
            tag, parsed = m[0].lower(), _attributes(html, m.end())
            if parsed is None:
                break
            attrs, ended, i = parsed
            raw = tag in RAW and not tree.foreign()
            tree.start(tag, attrs, ended)
            if raw:
                close = _RAW_END[tag].search(html, i) if tag in _RAW_END else None
                upto = close.start() if close else n
                if tag in RAW_SHOWN:
                    tree.text(decoded(html[i:upto]) if tag == "textarea" else html[i:upto])
                i = upto
        elif html.startswith("</", at) and (m := _TAG_NAME.match(html, at + 2)):
            parsed = _attributes(html, m.end())
            if parsed is None:
                break
            tree.end(m[0].lower())
            i = parsed[2]
        elif html.startswith("<!--", at):
            if html.startswith((">", "->"), at + 4):
                i = html.find(">", at) + 1
            else:
                m = _COMMENT_END.search(html, at + 4)
                i = m.end() if m else n
        elif html.startswith("<![CDATA[", at) and tree.foreign():
            close = html.find("]]>", at)
            tree.text(html[at + 9:close if close >= 0 else n])
            i = close + 3 if close >= 0 else n
        elif at + 1 < n and html[at + 1] in "!?/":
            i = html.find(">", at) + 1 or n
        else:
            tree.text("<")
            i = at + 1
    return tree.root


def shown(node: Node) -> bool:
    a = node.attrs
    return not (node.tag in HIDDEN or "hidden" in a or node.tag == "dialog" and "open" not in a or node.tag == "input" and a.get("type", "").lower() == "hidden"
                or "style" in a and _NO_DISPLAY.search(a["style"]))


def width(text: str) -> int:
    return sum(2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text) if not text.isascii() else len(text)


class Renderer:
    """Lines of text; ``gap`` is how many blank lines the next text asks for.

    What is left to do lies on a stack, elements and steps alike, so depth costs no recursion.
    """

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []  # of the line that is being written
        self.space, self.gap, self.pre, self.tables = False, -1, 0, 0
        self.indent: list[list] = []  # [padding, marker that the next line shows instead]
        self.todo: list[Node | str | Callable[[], None]] = []

    def run(self, root: Node) -> str:
        self._children(root)
        while self.todo:
            one = self.todo.pop()
            if isinstance(one, str):
                self._text(one)
            elif isinstance(one, Node):
                self._element(one)
            else:
                one()
        self._break()
        return "\n".join(self.lines).strip("\n")

    def _children(self, node: Node) -> None:
        self.todo.extend(reversed(node.children))

    def _break(self, gap: int = 0) -> None:
        if self.parts:
            line = "".join(self.parts)
            self.lines.append(line if self.pre else line.rstrip(" "))
            self.parts = []
        self.space = False
        self.gap = max(self.gap, gap)

    def _start_line(self) -> None:
        if self.lines and self.gap > 0 and self.lines[-1] != "":
            self.lines.append("")
        self.gap = -1
        levels = self.indent[:MOST_INDENTS]
        if len(self.indent) > MOST_INDENTS and self.indent[-1][1]:
            levels.append(self.indent[-1])
        self.parts = ["".join([level[1] or level[0] for level in levels])]
        for level in levels:
            level[1] = ""

    def _text(self, data: str) -> None:
        if self.pre:
            for k, part in enumerate(data.replace("\r\n", "\n").split("\n")):
                if k:
                    if not self.parts:
                        self._start_line()
                    self.lines.append("".join(self.parts))
                    self.parts = []
                if part:
                    if not self.parts:
                        self._start_line()
                    self.parts.append(part)
            return
        data = _SPACES.sub(" ", data)
        core = data.strip(" ")
        if not core:
            self.space |= data == " "
            return
        if not self.parts:
            self._start_line()
        elif self.space or data[0] == " ":
            self.parts.append(" ")
        self.parts.append(core)
        self.space = data[-1] == " "

    def _set_space(self) -> None:
        self.space = True

    def _element(self, node: Node) -> None:
        tag = node.tag
        if not shown(node):
            return
        if tag == "br":
            if not self.parts:
                self._start_line()
            self.lines.append("".join(self.parts).rstrip(" "))
            self.parts, self.space = [], False
        elif tag == "hr":
            self._break(1)
        elif tag == "img":
            self._text(node.attrs.get("alt", "").strip())
        elif tag == "input":
            kind = node.attrs.get("type", "").lower()
            self._text(node.attrs.get("alt" if kind == "image" else "value", "") if kind in VALUE_SHOWN or kind == "image" else "")
        elif tag == "table":
            self._break(1)
            self.todo.append(lambda: self._break(1))
            self._table(node)
        elif tag == "svg":
            self._svg(node)
        else:
            self._container(node, tag)

    def _container(self, node: Node, tag: str) -> None:
        gap = 1 if tag in SPACED and not (tag in ("ul", "ol") and self.indent) else 0
        if tag in BLOCK:
            self._break(gap)
            self.todo.append(lambda: self._break(gap))
        if tag in ("ul", "ol", "menu", "dir"):
            self._list(node)
        elif tag in ("blockquote", "dd"):
            self._indented(node, ["    " if tag == "dd" else "> ", ""])
        elif tag in ("option", "optgroup") and (label := node.attrs.get("label", "").strip()):
            self._text(label)
            if tag == "optgroup":
                self._break()
                self._children(node)
        elif tag in PREFORMATTED:
            self.pre += 1
            self.todo.append(self._end_pre)
            self._children(node)
            if node.children and isinstance(node.children[0], str):
                self.todo[-1] = re.sub(r"^\r?\n", "", node.children[0])
        else:
            self._children(node)

    def _end_pre(self) -> None:
        self._break()
        self.pre -= 1

    def _indented(self, node: Node, level: list) -> None:
        def end() -> None:
            self._break()
            self.indent.pop()

        self.indent.append(level)
        self.todo.append(end)
        self._children(node)

    def _svg(self, node: Node) -> None:
        """Text elements, each a word of its own; other characters in an svg aren't drawn."""
        for c in reversed(node.children):
            if isinstance(c, str) or c.tag in SVG_UNSEEN or not shown(c):
                continue
            if c.tag in SVG_TEXT:
                self.todo.append(self._set_space)
                self._children(c)
                self.todo.append(self._set_space)
            else:
                self.todo.append(lambda c=c: self._svg(c))

    def _list(self, node: Node) -> None:
        """The first line of an item carries its marker, further lines line up with it."""
        start = node.attrs.get("start", "")
        count = -number(start[1:], 0, 10**9, -1) if start.startswith("-") else number(start, 0, 10**9, 1)
        steps: list = []
        for c in node.children:
            if isinstance(c, str) or c.tag != "li" or not shown(c):
                if not isinstance(c, str) or c.strip():
                    steps.append(c)
                continue
            mark = f"{count}. " if node.tag == "ol" else "- "
            count += 1

            def item(c: Node = c, mark: str = mark) -> None:
                self._break()
                self._indented(c, [" " * len(mark), mark])

            steps.append(item)
        self.todo.extend(reversed(steps))

    def _table(self, node: Node) -> None:
        rows, other, todo = [], [], list(reversed(node.children))
        while todo:
            c = todo.pop()
            if isinstance(c, str):
                if c.strip():
                    other.append(c)
            elif not shown(c):
                continue
            elif c.tag == "tr":
                rows.append([x for x in c.children if not isinstance(x, str) and x.tag in CELLS and shown(x)])
                other.extend(x for x in c.children if isinstance(x, str) and x.strip() or not isinstance(x, str) and x.tag not in CELLS)
            elif c.tag in ROW_GROUPS:
                todo.extend(reversed(c.children))
            elif c.tag not in ("col", "colgroup"):
                other.append(c)
        if self.tables >= MOST_TABLES or all(len(cells) < 2 for cells in rows):  # nothing to align
            for cells in reversed(rows):
                for cell in reversed(cells):
                    self.todo.append(self._break)
                    self._children(cell)
        else:
            grid: list[list[tuple[int, int, list[str]]]] = []
            self.todo.append(lambda: self._lay_out(grid))
            steps: list = []
            for cells, places in zip(rows, self._places(rows), strict=True):
                line: list[tuple[int, int, list[str]]] = []
                grid.append(line)
                steps.extend(lambda cell=cell, place=place, line=line: self._cell(cell, place, line) for cell, place in zip(cells, places, strict=True))
            self.todo.extend(reversed(steps))
        for c in reversed(other):  # what stands in a table but in no cell is shown before it
            self.todo += [self._break, c]

    def _places(self, rows: list[list[Node]]) -> Iterator[list[tuple[int, int]]]:
        """(column, columns) of each row's cells. Cells of rows above that reach down are stepped over."""
        reach: list[tuple[int, int, int]] = []  # first column, column after the last, row after the last; ascending
        for r, cells in enumerate(rows):
            reach = [x for x in reach if x[2] > r]
            col, k, places, new = 0, 0, [], []
            for cell in cells:
                while k < len(reach) and reach[k][0] <= col:
                    col = max(col, reach[k][1])
                    k += 1
                span = number(cell.attrs.get("colspan"), 1, 1000, 1)
                down = number(cell.attrs.get("rowspan"), 0, 65534, 1) or len(rows)
                places.append((col, span))
                if down > 1:
                    new.append((col, col + span, r + down))
                col += span
            yield places
            reach = sorted(reach + new)

    def _cell(self, cell: Node, place: tuple[int, int], line: list) -> None:
        """The cell's own lines: what was being written is put aside until they are done."""
        held = self.lines, self.parts, self.space, self.gap, self.pre, self.indent

        def end() -> None:
            self._break()
            line.append((*place, self.lines))
            self.lines, self.parts, self.space, self.gap, self.pre, self.indent = held
            self.tables -= 1

        self.lines, self.parts, self.space, self.gap, self.pre, self.indent = [], [], False, -1, 0, []
        self.tables += 1
        self.todo.append(end)
        self._children(cell)

    def _lay_out(self, grid: list[list[tuple[int, int, list[str]]]]) -> None:
        firsts = sorted({col for line in grid for col, _, _ in line})
        widths = [0] * len(firsts)
        cells = [[(bisect_left(firsts, col), bisect_left(firsts, col + span), text) for col, span, text in line] for line in grid]
        for line in cells:
            for i, j, text in line:
                if j == i + 1:
                    widths[i] = max([widths[i], *[w for x in text if (w := width(x)) <= MAX_CELL]])
        before = [0]
        for w in widths:
            before.append(before[-1] + w + 3)
        size = sum(len(x) + 3 for line in cells for _, _, text in line for x in text)
        padded = sum(before[line[-1][1]] * max(len(text) for _, _, text in line) for line in cells if line)
        aligned = padded <= MOST_PADDING * (size + 1000)
        for line in cells:
            for k in range(max([len(text) for _, _, text in line], default=0)):
                out, filled = [], 0
                for i, j, text in line:
                    one = text[k] if k < len(text) else ""
                    if aligned:
                        out += [" " * widths[m] for m in range(filled, i)]
                        out.append(one + " " * (before[j] - before[i] - 3 - width(one)))
                        filled = j
                    elif one:
                        out.append(one)
                joined = " | ".join(out).rstrip(" ")
                joined = joined.rstrip(" |") if aligned and not any(k < len(t) and t[k] for _, _, t in line[-1:]) else joined
                if joined.strip(" |"):
                    self._start_line()
                    self.lines.append(self.parts[0] + joined)
                    self.parts = []


def render(html: str) -> str:
    """All visible text of a page."""
    return Renderer().run(build_tree(html))


def html_extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """A row per page: id, text, n_chars, n_lines."""
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{html_col}`").cast("string").alias("html"))
    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("n_lines", T.LongType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts = [None if h is None else render(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column("id"), pa.array(texts, pa.string()), pa.array([len(t or "") for t in texts], pa.int64()),
                pa.array([len(t.split("\n")) if t else 0 for t in texts], pa.int64())], schema.names)

    return rows.mapInArrow(run, schema)
