"""HTML extraction: build a tree with implied tags, render its visible text with its layout."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element classes and closing rules of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "head title script style noscript template meta link base iframe audio video canvas datalist "
    "annotation annotation-xml desc metadata defs symbol".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table text textarea ul".split()
)
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul".split())
CLOSES_P = BLOCK - frozenset("body html li dd dt legend option optgroup text textarea".split())
# A start tag closes these open elements, looking no further up than the given ones.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
    **{t: ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}) for t in ("thead", "tbody", "tfoot")},
    **{f"h{i}": ({f"h{j}" for j in range(1, 7)}, {"div", "section", "article", "td", "th", "li"}) for i in range(1, 7)},
}
SCOPE = frozenset("table td th caption html template button object".split())
SHOWN_INPUTS = frozenset("text search url tel email number date time month week datetime-local submit button reset".split())
NO_BOX = re.compile(r"display\s*:\s*none", re.IGNORECASE)
VISIBILITY = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.IGNORECASE)
WIDE = 60
BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("children", "closed", "down", "hidden", "span", "start", "tag", "visible")

    def __init__(self, tag: str, attributes: dict[str, str | None]):
        self.tag, self.children = tag, []
        style = attributes.get("style") or ""
        self.closed = tag in ("details", "dialog") and "open" not in attributes
        self.hidden = tag in HIDDEN or "hidden" in attributes or bool(NO_BOX.search(style)) or (tag == "dialog" and self.closed)
        said = VISIBILITY.findall(style)
        self.visible = said[-1].lower() == "visible" if said else None  # None: as around it
        cell = tag in ("td", "th")
        self.span = max(1, min(1000, number(attributes.get("colspan"), 1))) if cell else 1  # the standard's bounds of spans
        self.down = (max(0, min(65534, number(attributes.get("rowspan"), 1))) or 1 << 20) if cell else 1  # 0: to the end of the group
        self.start = number(attributes.get("start"), 1) if tag == "ol" else number(attributes.get("value"), None) if tag == "li" else 1
        if tag == "input" and (attributes.get("type") or "text").lower() in SHOWN_INPUTS and attributes.get("value"):
            self.children.append(attributes["value"])


def number(text: str | None, default: int | None) -> int | None:
    found = re.match(r"\s*([+-]?\d{1,18})", text or "")
    return int(found[1]) if found else default


class Tree(HTMLParser):
    """Open elements as a stack; tags that authors leave out are closed here."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.number: dict[str, int] = {}  # open elements by tag, so that most searches can be left out

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)  # outside drawings and formulas the standard knows no such sections

    def cut(self, i: int) -> None:
        for node in self.open[i:]:
            self.number[node.tag] -= 1
        del self.open[i:]

    def close_until(self, wanted: set[str], barrier: frozenset[str] | set[str]) -> None:
        if not any(self.number.get(tag) for tag in wanted):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in wanted:
                self.cut(i)
                if not wanted & {"tr", "thead"}:  # rows also close what stands between
                    return
            elif self.open[i].tag in barrier:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body"):
            self.open[-1].hidden |= tag == "body" and Node(tag, dict(attrs)).hidden
            self.leave_head()
            return
        if self.open[-1].tag == "head" and tag not in HIDDEN:
            self.leave_head()
        if tag in CLOSES_P:
            self.close_until({"p"}, SCOPE)
        if tag in CLOSES:
            self.close_until(*CLOSES[tag])
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.number[tag] = self.number.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def leave_head(self) -> None:
        self.close_until({"head"}, frozenset())

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body") or tag in VOID:
            if tag == "br":
                self.handle_starttag("br", [])
            return
        if not self.number.get(tag):
            return
        barrier = frozenset() if tag in ("table", "td", "th", "tr", "head") else SCOPE - {tag}
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self.cut(i)
                return
            if self.open[i].tag in barrier:
                return

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip():
            self.leave_head()
        self.open[-1].children.append(data)


class Page:
    """Lines of text; blanks collapse, blocks begin lines, paragraphs are set apart."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.gap = False
        self.mark = ""
        self.blank = True  # the line so far ends with a blank or is empty

    def inline(self, text: str) -> None:
        text = BLANKS.sub(" ", text)
        if self.blank:
            text = text.lstrip(" ")
        if text:
            self.now.append(text)
            self.blank = text[-1] == " "

    def literal(self, text: str) -> None:
        first, *rest = text.split("\n")
        self.now.append(first)
        for line in rest:
            self.end_line(keep=True)
            self.now.append(line)
        self.blank = not self.now or not self.now[-1]

    def end_line(self, keep: bool = False) -> None:
        text = "".join(self.now).rstrip()
        self.now, self.blank = [], True
        if text or keep:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines.append(self.mark + text)
            self.mark = " " * len(self.mark) if self.mark.strip() else self.mark

    def space(self) -> None:
        self.end_line()
        self.gap = True

    def text(self) -> str:
        self.end_line()
        return "\n".join(self.lines).strip("\n")


class Table:
    """Cells by row and column; ``taken`` has the last row that a cell reaches in each column."""

    def __init__(self):
        self.rows: list[list[str]] = []
        self.taken: dict[int, int] = {}

    def add(self, cell: str, span: int, down: int) -> None:
        if not self.rows:
            self.rows.append([])
        row, here = self.rows[-1], len(self.rows) - 1
        while self.taken.get(len(row), -1) >= here:  # a cell from above reaches down to here
            row.append("")
        for column in range(len(row), len(row) + span) if down > 1 else ():
            self.taken[column] = here + down - 1
        row += [cell] + [""] * (span - 1)


def aligned(rows: list[list[str]]) -> list[str]:
    """Cells padded to the width of their column, which cells of over WIDE characters do not set."""
    widths = [0] * max(map(len, rows), default=0)
    for row in rows:
        for i, cell in enumerate(row):
            if len(cell) <= WIDE:
                widths[i] = max(widths[i], len(cell))
    return [" | ".join(c.ljust(w) for c, w in zip(row, widths, strict=False)).rstrip() for row in rows]


def shown(node: Node) -> list:
    """The children; of closed details only the summary."""
    if node.tag == "details" and node.closed:
        return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
    return node.children


def render(root: Node) -> str:
    """Walk the tree without recursion; tables collect their cells before they are written."""
    pages, tables, lists, literal, visible = [Page()], [], [], 0, [True]
    steps: list[tuple[object, bool]] = [(root, True)]
    while steps:
        node, enter = steps.pop()
        page = pages[-1]
        if isinstance(node, str):
            if visible[-1]:
                (page.literal if literal else page.inline)(node)
            continue
        tag = node.tag
        if enter:
            if node.hidden:
                continue
            visible.append(visible[-1] if node.visible is None else node.visible)
            steps.append((node, False))
            steps.extend((c, True) for c in reversed(shown(node)))
        else:
            visible.pop()
        if tag == "br" and enter:
            page.end_line(keep=True)
        elif tag == "table":
            if enter:
                page.space()
                tables.append(Table())
            else:
                page.end_line()  # of a caption or of what stands between the rows
                for line in aligned(tables.pop().rows):
                    page.literal(line)
                    page.end_line()
                page.space()
        elif tag == "tr" and tables:
            if enter:
                tables[-1].rows.append([])
        elif tag in ("thead", "tbody", "tfoot") and tables:
            tables[-1].taken.clear()  # cells end with their group of rows
        elif tag in ("td", "th") and tables:
            if enter:
                pages.append(Page())
                lists.append(None)
                continue
            cell = BLANKS.sub(" ", pages.pop().text().replace("\n", " ")).strip()
            lists.pop()
            tables[-1].add(cell, node.span, node.down)
        elif tag in ("ul", "ol", "menu", "dir"):
            mark = page.mark if enter else lists.pop()[2]
            nested = any(x is not None for x in lists[-1:])
            (page.end_line if nested else page.space)()
            if enter:
                lists.append([tag == "ol", node.start, mark])
            else:
                page.mark = mark
        elif tag == "li":
            page.end_line()
            here = lists[-1] if lists and lists[-1] is not None else None
            outer = here[2] if here else ""
            if enter:
                outer = " " * len(outer)
                if here and here[0]:
                    here[1] = here[1] if node.start is None else node.start
                    page.mark = f"{outer}{here[1]}. "
                    here[1] += 1
                else:
                    page.mark = f"{outer}- "
            else:
                page.mark = outer if not outer.strip() else " " * len(outer)
        elif tag in BLOCK:
            (page.space if tag in SPACED else page.end_line)()
            if tag in ("pre", "textarea"):
                literal += 1 if enter else -1
    while len(pages) > 1:
        last = pages.pop().text()
        pages[-1].inline(last)
    return pages[0].text()


def page_text(html: str | None) -> str | None:
    """All visible text of a page; null stays null, an empty page gives an empty text.

    All options of a select count as visible, as do formulas, labels in drawings, form
    texts, values of fields and buttons, and what stands in an object; what replaces a video,
    sound, frame or canvas not, nor a closed dialog or the body of closed details. Rules in
    style sheets are not applied, only attributes of the elements. Any text can be parsed, of
    any length; padding of tables adds at most WIDE characters a cell.
    """
    if html is None:
        return None
    tree = Tree()
    tree.feed(html)
    tree.close()
    return render(tree.root)


def extract(pages: DataFrame) -> DataFrame:
    """The visible text of every page: page_id, url, text.

    Paragraphs are set apart by an empty line, list items have a mark, and table cells
    stand in columns. Rows map one to one, so nulls, repeated rows and empty tables need
    no care; columns other than the three that are read may have any name.
    """

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                text = pa.array([page_text(h.as_py()) for h in part.column("html")], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), text], names=["page_id", "url", "text"])

    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(texts, schema)
