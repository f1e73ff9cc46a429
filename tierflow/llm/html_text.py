"""HTML to text, laid out as a reader would see it.

A scanner gives tags, attributes and text. The tree builder keeps the stack of
open elements, closes what a tag implies to be closed, and drops end tags that
close nothing. Each element knows whether it is shown. Text goes into flows of
lines: blocks begin lines, some with a blank line around them, items of lists get
a mark and an indent, and cells of a table are laid out in aligned columns; what
a table holds outside its cells comes before it. The text of svg and math is shown
where it stands, but for their definitions, titles and annotations.
There is no recursion, and work is linear in the page: indents and column widths
have bounds, beyond which text stays whole but is no longer padded.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tierflow.llm.common import append, strings

# Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
DECODED_RAW = {"textarea", "title"}
HIDDEN = set(
    "head script style title template noscript iframe noembed noframes object audio video canvas "
    "datalist".split()
)
SPACED = set(
    "p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre plaintext table figure fieldset menu".split()
)
BLOCKS = SPACED | set(
    "html body address article aside center dd details dialog dir div dt figcaption footer form "
    "header hgroup hr legend li main nav optgroup option search section summary caption tr td th "
    "thead tbody tfoot xmp textarea select".split()
)
CLOSES_P = BLOCKS - set(
    "html body option optgroup select textarea caption tr td th thead tbody tfoot legend".split()
)
PARTS = {"thead", "tbody", "tfoot"}
BETWEEN = {"table", "tr", *PARTS}
# Inside svg and math: where HTML goes on, what ends them, what is never shown, what stands apart.
FOREIGN = {"svg", "math"}
HTML_INSIDE = set("foreignobject desc title mi mo mn ms mtext".split())
BREAKS = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li "
    "listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
FOREIGN_HIDDEN = set(
    "defs desc metadata title style script symbol clippath mask pattern marker annotation "
    "annotation-xml mphantom".split()
)
APART = set("text foreignobject mtr mtd".split())
# What an opening tag closes first, and the elements that it does not look beyond.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({*PARTS, "caption", "colgroup"}, {"table"}),
    "tbody": ({*PARTS, "caption", "colgroup"}, {"table"}),
    "tfoot": ({*PARTS, "caption", "colgroup"}, {"table"}),
    "rp": ({"rp", "rt"}, {"ruby"}),
    "rt": ({"rp", "rt"}, {"ruby"}),
    "a": ({"a"}, BLOCKS),
    "button": ({"button"}, BLOCKS),
}
SCOPES = {"table", "td", "th", "caption", "html", "template", "button", "object"}

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(
    r"""[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)))?"""
)
TAG_END = re.compile(r"[\s/]*>")
SPACE = " \t\n\r\f"
GAPS = re.compile(f"[{SPACE}]+")
NOT_DISPLAYED = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"visibility\s*:\s*(\w+)", re.I)

MAX_INDENT = 20
MAX_WIDTH = 60
MAX_SPAN = 100


def scan(html: str, foreign=lambda: False):
    """Text as ("text", data), tags as ("open", name, attributes) and ("close", name).

    ``foreign`` tells whether what was given so far leaves svg or math open: there, tags may
    close themselves, no element holds raw text, and CDATA sections are text.
    """
    at, size = 0, len(html)
    while at < size:
        mark = html.find("<", at)
        if mark < 0:
            yield "text", unescape(html[at:])
            return
        following = html[mark + 1 : mark + 2]
        closing = following == "/" and html[mark + 2 : mark + 3].isascii() and html[mark + 2 : mark + 3].isalpha()
        if not closing and not (following.isascii() and following.isalpha()) and following not in "!?/" or not following:
            yield "text", unescape(html[at : mark + 1])
            at = mark + 1
            continue
        if mark > at:
            yield "text", unescape(html[at:mark])
        if not closing and following in "!?/":
            if html.startswith("<!--", mark):
                end = html.find("-->", mark + 4)
                short = html.startswith((">", "->"), mark + 4)
                at = html.find(">", mark) + 1 if short else size if end < 0 else end + 3
            elif html.startswith("<![CDATA[", mark) and foreign():
                end = html.find("]]>", mark + 9)
                yield "text", html[mark + 9 : size if end < 0 else end]
                at = size if end < 0 else end + 3
            else:
                end = html.find(">", mark)
                at = size if end < 0 else end + 1
            continue
        name = NAME.match(html, mark + 1 + closing)
        at, attributes = name.end(), {}
        while (end := TAG_END.match(html, at)) is None:
            found = ATTRIBUTE.match(html, at)
            if found is None:
                # A stray sign, or an opened quote that nothing closes.
                at += 1
                if at >= size:
                    return
                continue
            attributes.setdefault(
                found[1].lower(), unescape(next((x for x in found.groups()[1:] if x is not None), ""))
            )
            at = found.end()
        at, alone = end.end(), end[0].endswith("/>")
        tag = name[0].lower()
        if closing:
            yield "close", tag
            continue
        within = foreign()
        yield "open", tag, attributes
        if alone and (tag in FOREIGN or within and tag not in BREAKS):
            yield "close", tag
        elif tag == "plaintext" and not within:
            # Nothing ends it.
            yield "text", html[at:]
            return
        elif tag in RAW and not within:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
            inside = html[at : stop.start() if stop else size]
            yield "text", unescape(inside) if tag in DECODED_RAW else inside
            at = stop.start() if stop else size
            if not stop:
                yield "close", tag


class Flow:
    """Lines of text; the last one is still open."""

    def __init__(self):
        self.lines: list[str] = []
        self.open: list[str] = []
        self.gap = False
        self.indent = 0
        # What the next line begins with, or the list and place that its number follows from.
        self.mark: str | tuple[Element, int] = ""

    def add(self, text: str) -> None:
        self.open.append(text)

    def end_line(self, exact: bool = False, forced: bool = False) -> None:
        text = "".join(self.open)
        self.open = []
        text = text if exact else GAPS.sub(" ", text).strip(" ")
        if text.strip(SPACE + "\xa0") or (exact and forced):
            self.put(text.replace("\xa0", " ").rstrip())
        elif forced and self.lines:
            self.lines.append("")

    def put(self, line: str) -> None:
        if self.gap and self.lines and self.lines[-1]:
            self.lines.append("")
        self.gap = False
        shift = 2 * min(self.indent, MAX_INDENT)
        if self.mark:
            pad = max(0, shift - 2)
            if isinstance(self.mark, tuple):
                of, place = self.mark
                of.later.append((len(self.lines), pad, place))
                line = " " * pad + line
            else:
                line = " " * pad + self.mark + line
            self.mark = ""
        elif shift:
            line = " " * shift + line
        self.lines.append(line)

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.gap = self.gap or spaced


class Table:
    """Rows of cells; a cell is (lines, columns, rows)."""

    def __init__(self):
        self.rows: list[list[tuple[list[str], int, int]]] = []

    def lines(self) -> list[str]:
        taken: dict[int, int] = {}
        placed = []
        for row in self.rows:
            column, cells = 0, []
            now = {c for c, n in taken.items() if n > 0}
            for lines, columns, down in row:
                while column in now:
                    column += 1
                cells.append((column, columns, lines))
                for c in range(column, column + columns):
                    taken[c] = max(taken.get(c, 0), down)
                column += columns
            taken = {c: n - 1 for c, n in taken.items() if n > 1}
            placed.append(cells)
        width: dict[int, int] = {}
        for cells in placed:
            for column, columns, lines in cells:
                if columns == 1:
                    longest = max((len(x) for x in lines if len(x) <= MAX_WIDTH), default=0)
                    width[column] = max(width.get(column, 0), longest)
        before, starts = 0, {}
        for column in range(max(width, default=-1) + 1):
            starts[column] = before
            before += width.get(column, 0) + 2 * (width.get(column, 0) > 0)
        out = []
        for cells in placed:
            for k in range(max((len(lines) for _, _, lines in cells), default=0)):
                line = ""
                for column, _, lines in cells:
                    if k < len(lines) and lines[k]:
                        line = line.ljust(starts.get(column, before))
                        line += "  " * (bool(line) and not line.endswith("  ")) + lines[k]
                out.append(line.rstrip())
        return out


class Element:
    __slots__ = (
        "name", "shown", "visible", "flow", "table", "number", "spans", "pre", "listed", "between", "foreign",
        "step", "relative", "items", "later",
    )

    def __init__(self, name, shown, visible, flow, table, pre):
        self.name, self.shown, self.visible, self.flow, self.table = name, shown, visible, flow, table
        self.number, self.spans, self.pre, self.listed = None, (1, 1), pre, False
        # In a table but in no cell of it; in svg or math but in no HTML within.
        self.between = self.foreign = False
        # Of lists: numbers go up or down, from a number known at the end alone, with the lines that wait for it.
        self.step, self.relative, self.items, self.later = 1, False, 0, []


def _count(attributes: dict, name: str, default: int | None = 1, most: int = MAX_SPAN) -> int | None:
    digits = re.match(r"\s*(-?\d{1,9})", attributes.get(name, ""))
    return min(int(digits[1]), most) if digits else default


class Renderer:
    def __init__(self):
        root = Element("#root", True, True, Flow(), None, False)
        self.stack = [root]
        self.count: dict[str, int] = {"#root": 1}
        self.fresh_pre = False

    def push(self, element: Element) -> None:
        self.stack.append(element)
        self.count[element.name] = self.count.get(element.name, 0) + 1

    def pop(self) -> None:
        element = self.stack.pop()
        self.count[element.name] -= 1
        top = self.stack[-1]
        if not element.shown:
            return
        if element.name in BLOCKS and element.name not in ("td", "th", *BETWEEN):
            element.flow.end_line(exact=element.pre)
            element.flow.gap = element.flow.gap or element.name in SPACED
        if element.name in APART and top.foreign:
            element.flow.add(" ")
        for at, pad, place in element.later:
            line = element.flow.lines[at]
            element.flow.lines[at] = f"{line[:pad]}{element.items + place}. {line[pad:]}"
        if element.listed:
            element.flow.indent -= 1
            element.flow.mark = ""
        if element.name in ("ul", "ol", "menu", "dir") and self.count.get("li", 0):
            element.flow.gap = False
        if element.name in ("td", "th") and element.flow is not top.flow:
            element.flow.end_line(exact=element.pre)
            if element.table is not None:
                element.table.rows[-1].append((element.flow.lines, *element.spans))
        if element.name == "table":
            top.flow.block(True)
            for line in element.table.lines():
                if line:
                    top.flow.put(line)
            top.flow.gap = True

    def close(self, names: set[str], barriers: set[str]) -> None:
        """Close the nearest of ``names``, with what is open in it, if no barrier is between."""
        if not any(self.count.get(n) for n in names):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].name in names:
                while len(self.stack) > i:
                    self.pop()
                return
            if self.stack[i].name in barriers:
                return

    def in_foreign(self) -> bool:
        return self.stack[-1].foreign

    def start_foreign(self, name: str, attributes: dict) -> None:
        """Open an element of svg or math; nothing is implied by it, and it lays nothing out."""
        top = self.stack[-1]
        style = attributes.get("style", "")
        shown = top.shown and not (
            name in FOREIGN_HIDDEN or attributes.get("display") == "none" or NOT_DISPLAYED.search(style)
        )
        seen = VISIBILITY.search(style) or re.match(r"(\w+)", attributes.get("visibility", ""))
        visible = top.visible if seen is None else seen[1].lower() == "visible"
        element = Element(name, shown, visible, top.flow, top.table, top.pre)
        element.between, element.foreign = top.between, name not in HTML_INSIDE
        if shown and name in APART:
            element.flow.add(" ")
        self.push(element)
        self.fresh_pre = False

    def clear_to_table(self) -> None:
        """Close what stands between the parts of a table and in no cell."""
        while self.stack[-1].between and self.stack[-1].name not in BETWEEN:
            self.pop()

    def start(self, name: str, attributes: dict) -> None:
        if self.stack[-1].foreign:
            if name not in BREAKS and not (name == "font" and attributes.keys() & {"color", "face", "size"}):
                self.start_foreign(name, attributes)
                return
            while self.stack[-1].foreign:
                self.pop()
        if name in ("html", "body", "head") and self.count.get(name):
            return
        if self.count.get("head") and name not in HIDDEN | {"meta", "link", "base"}:
            self.close({"head"}, {"template"})
        if name in CLOSES_P:
            self.close({"p"}, SCOPES)
        if name in IMPLIED:
            self.close(*IMPLIED[name])
        if name in PARTS | {"tr", "td", "th"}:
            if not self.count.get("table"):
                return
            if name == "tr":
                self.close({"tr"}, {"table"})
            if name in PARTS:
                self.close({"tr"}, {"table"})
            self.clear_to_table()
            if name in ("td", "th") and self.stack[-1].name != "tr":
                self.start("tr", {})
        if name in ("caption", "colgroup"):
            self.clear_to_table()
        if name == "table" and self.stack[-1].between:
            self.close({"table"}, set())
        top = self.stack[-1]
        if name == "br":
            if top.shown:
                top.flow.end_line(exact=top.pre, forced=True)
            return
        if name in VOID:
            if name == "hr" and top.shown:
                top.flow.block(True)
            return
        style = attributes.get("style", "")
        shown = top.shown and not (
            name in HIDDEN
            or name == "rp"
            or "hidden" in attributes
            or NOT_DISPLAYED.search(style)
            or (name == "dialog" and "open" not in attributes)
            or (top.name == "details" and top.number == 0 and name != "summary")
        )
        seen = VISIBILITY.search(style)
        visible = top.visible if seen is None else seen[1].lower() == "visible"
        element = Element(name, shown, visible, top.flow, top.table, top.pre or name in ("pre", "plaintext", "xmp", "textarea"))
        element.between = name == "table" or top.between and name not in ("td", "th", "caption")
        element.foreign = name in FOREIGN
        if name == "details":
            element.number = 1 if "open" in attributes else 0
        if shown:
            self.lay_out(element, top, attributes)
        self.push(element)
        self.fresh_pre = name in ("pre", "textarea")

    def lay_out(self, element: Element, top: Element, attributes: dict) -> None:
        name = element.name
        if name == "table":
            top.flow.block(True)
            # What is in no cell is shown before the table.
            element.table = Table()
        elif name == "caption":
            element.flow.block(False)
        elif name == "tr":
            element.table.rows.append([])
        elif name in ("td", "th"):
            element.flow = Flow()
            columns, down = _count(attributes, "colspan"), _count(attributes, "rowspan", most=65534)
            element.spans = max(1, columns), 1 << 30 if down == 0 else max(1, down)
        elif name in BLOCKS - PARTS:
            nested = name in ("ul", "ol", "menu", "dir") and self.count.get("li", 0)
            top.flow.end_line(exact=top.pre)
            top.flow.gap = top.flow.gap or (name in SPACED and not nested)
            if name == "ol":
                start = _count(attributes, "start", None, 10**9)
                element.step = -1 if "reversed" in attributes else 1
                element.relative = start is None and element.step < 0
                element.number = 0 if element.relative else 1 if start is None else start
            if name in ("li", "dd"):
                element.flow.indent += 1
                element.listed = True
            if name == "li":
                element.flow.mark = "- "
                if top.name == "ol":
                    value = _count(attributes, "value", None, 10**9)
                    if value is not None:
                        top.number, top.relative = value, False
                    element.flow.mark = (top, top.number) if top.relative else f"{top.number}. "
                    top.number += top.step
                    top.items += 1

    def end(self, name: str) -> None:
        if name == "br":
            self.start("br", {})
        elif name in ("html", "body") or name in VOID:
            return
        elif name in ("td", "th", "tr", "table", *PARTS):
            self.close({name}, {"table"} - {name})
        elif name == "li":
            self.close({"li"}, {"ul", "ol", "menu", "dir", "table"})
        else:
            self.close({name}, {"table", "td", "th", "caption", "template"} - {name})

    def text(self, data: str) -> None:
        top = self.stack[-1]
        if self.count.get("head") and top.name == "head" and data.strip(SPACE):
            self.close({"head"}, {"template"})
            top = self.stack[-1]
        if not top.shown or not top.visible:
            self.fresh_pre = False
            return
        if top.name == "details" and top.number == 0:
            return
        flow = top.flow
        if top.name in BETWEEN and not data.strip(SPACE):
            return
        if top.pre:
            if self.fresh_pre and data.startswith("\n"):
                data = data[1:]
            first, *others = data.split("\n")
            flow.add(first)
            for line in others:
                flow.end_line(exact=True, forced=True)
                flow.add(line)
        else:
            flow.add(data)
        self.fresh_pre = False

    def result(self) -> str:
        while len(self.stack) > 1:
            self.pop()
        flow = self.stack[0].flow
        flow.end_line()
        return "\n".join(flow.lines).strip("\n")


def html_text(html: str) -> str:
    """The visible text of one page."""
    page = Renderer()
    html = html.replace("\r\n", "\n").replace("\r", "\n").replace("\0", "")
    for event in scan(html, page.in_foreign):
        if event[0] == "text":
            page.text(event[1])
        elif event[0] == "open":
            page.start(event[1], event[2])
        else:
            page.end(event[1])
    return page.result()


FIELDS = T.StructType([T.StructField("text", T.StringType())])


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``text``, the laid-out visible text of ``html``; nothing is shuffled.

    A null or empty page, or one that shows nothing, has an empty text. A page
    that ends in the middle of a tag loses that tag alone. A column ``text`` is
    replaced, others pass; repeated rows all stay, no rows give no rows.
    """

    def make():
        def step(column: pa.Array) -> list[pa.Array]:
            return [pa.array([html_text(x) for x in strings(column)], pa.string())]

        return step

    return append(pages, FIELDS, make, html)
