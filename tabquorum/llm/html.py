"""HTML extraction by layout: a small tree builder and a text renderer.

The builder adds implied end tags (paragraphs, list items, table parts, options, definitions) and
tolerates stray and missing tags; it reads a page once, from start to end. The renderer emits all
visible text: blocks on lines of their own, paragraphs apart, list items marked, table cells in
aligned columns (spans and line breaks inside cells kept), preformatted text as it stands, texts of
form fields, formulas and drawings. Elements are hidden by kind, attribute, style or a plain rule
(tag, class, id or tag and class) of a style sheet in the page.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import slices

# Element classes of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes plaintext".split())
HIDDEN = set("head script style template noscript iframe object embed noembed noframes title meta link base datalist audio video canvas desc metadata defs annotation annotation-xml".split())
APART = set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure".split())
BLOCK = APART | set("address article aside body center dd details dialog dir div dt fieldset figcaption footer form header hgroup hr html legend li main menu nav option search section select summary tbody td textarea tfoot th thead tr caption".split())
CLOSES_P = BLOCK - set("body html option select textarea td th tr tbody thead tfoot caption".split())
# start tag -> (open elements it ends, elements beyond which it ends none)
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}), "body": ({"head"}, set()),
}
_SCOPE = set("html body table td th caption button object template".split())
LARGEST_SPAN = 100
_OPEN = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_STOP = re.compile(r"(=\s*)?([>\"'])")
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
# A style sheet's comment, to the end of the sheet if nothing ends it.
_COMMENT = re.compile(r"/(?:\*/|\*.*?(?:\*/|\Z))", re.S)
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_SPACE = re.compile(r"[ \t\n\f\r]+")
_PLAIN = re.compile(r"[a-z][a-z0-9]*|(?:[a-z][a-z0-9]*)?\.[A-Za-z0-9_-]+|#[A-Za-z0-9_-]+")


class Sheet:
    """Plain selectors that a page's style sheets hide."""

    def __init__(self):
        self.hidden: set[str] = set()

    def read(self, css: str) -> None:
        for rule in _COMMENT.sub("", css).split("}"):
            names, _, body = rule.rpartition("{")
            if _HIDING.search(body) and "{" not in names:
                self.hidden |= {n.strip() for n in names.split(",") if _PLAIN.fullmatch(n.strip())}

    def hides(self, node: Node) -> bool:
        if not self.hidden:
            return False
        names = [node.tag]
        if node.attrs.get("id"):
            names.append("#" + node.attrs["id"])
        for c in (node.attrs.get("class") or "").split():
            names += ["." + c, f"{node.tag}.{c}"]
        return not self.hidden.isdisjoint(names)


class Node:
    __slots__ = ("tag", "attrs", "parts")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.parts = tag, attrs, []

    @property
    def hidden(self) -> bool:
        a = self.attrs
        return self.tag in HIDDEN or "hidden" in a or bool(a.get("style") and _HIDING.search(a["style"]))

    def span(self, name: str) -> int:
        value = self.attrs.get(name) or ""
        return max(1, min(int(value), LARGEST_SPAN)) if re.fullmatch("[0-9]{1,6}", value) else 1


class Tags:
    """Markup of a page from start to end: (start, end, closing, name, attributes); comments and
    declarations have no name.

    A quote opens a value only after ``=``. Where no ``>`` follows outside of quotes, quotes are not
    heeded from there on, and where none follows at all, the rest is text; so every part of the page is
    passed at most twice.
    """

    def __init__(self, text: str):
        self.text, self.at, self.quotes = text, 0, True
        self.last = {c: text.rfind(c) for c in "<>\"'"}

    def _end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag whose name ends at ``at``, or -1."""
        text, start = self.text, at
        if self.last[">"] < at:
            return -1
        while self.quotes and (stop := _STOP.search(text, at)):
            mark, at = stop[2], stop.end()
            if mark == ">":
                return at - 1
            if stop[1] and at <= self.last[mark]:
                at = text.find(mark, at) + 1
        self.quotes = False
        return text.find(">", start)

    def __iter__(self) -> Iterator[tuple[int, int, bool, str | None, str]]:
        text = self.text
        while (m := _OPEN.search(text, self.at)) is not None:
            start = m.start()
            if text.startswith("<!--", start):
                end = text.find("-->", start + 4)
                self.at = len(text) if end < 0 else end + 3
                yield start, self.at, False, None, ""
                continue
            end = text.find(">", start) if m[2] is None else self._end(m.end())
            if end < 0:
                return
            self.at = end + 1
            yield start, end + 1, bool(m[1]), None if m[2] is None else m[2].lower(), text[m.end(): end] if m[2] else ""


def build(text: str) -> tuple[Node, Sheet]:
    """Tree of a page, whose text parts are strings, and what its style sheets hide."""
    root, sheet = Node("#root", {}), Sheet()
    stack = [root]
    open_tags: dict[str, int] = {}

    def pop() -> None:
        open_tags[stack.pop().tag] -= 1

    def close(tags: set[str], beyond: set[str]) -> None:
        """End the outermost open element of ``tags`` above the nearest one of ``beyond``."""
        if not any(open_tags.get(t) for t in tags):
            return
        at = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in beyond:
                break
            if stack[i].tag in tags:
                at = i
        while at is not None and len(stack) > at:
            pop()

    at = 0
    tags = Tags(text)
    for start, end, closing, tag, rest in tags:
        if start > at:
            stack[-1].parts.append(entities.unescape(text[at: start]))
        at = end
        if tag is None:
            continue
        if closing:
            if tag == "br" or tag == "p" and not open_tags.get("p"):
                stack[-1].parts.append(Node(tag, {}))
            elif open_tags.get(tag):
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        attrs = {k.lower(): entities.unescape(a or b or c) for k, a, b, c in _ATTR.findall(rest)} if rest.strip(" /\n\t\r\f") else {}
        if tag in CLOSES_P:
            close({"p"}, _SCOPE)
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        node = Node(tag, attrs)
        stack[-1].parts.append(node)
        if tag in RAW:
            found = re.compile(f"</{tag}", re.I | re.A).search(text, at)
            end = found.start() if found else len(text)
            node.parts.append(entities.unescape(text[at:end]) if tag in ("textarea", "title") else text[at:end])
            after = text.find(">", end)
            at = tags.at = len(text) if after < 0 else after + 1
            if tag == "style":
                sheet.read(node.parts[0])
        elif tag not in VOID:
            stack.append(node)
            open_tags[tag] = open_tags.get(tag, 0) + 1
    if at < len(text):
        stack[-1].parts.append(entities.unescape(text[at:]))
    return root, sheet


class Page:
    """Lines being laid out; ``gap`` is the number of line breaks due before the next text."""

    def __init__(self):
        self.out: list[str] = []
        self.gap, self.space, self.mark, self.depth = 0, False, "", 0

    def block(self, gap: int) -> None:
        if self.out:
            self.gap = max(self.gap, gap)
        self.space = False

    def text(self, value: str, pre: bool) -> None:
        if pre:
            if value:
                self._flush()
                self.out.append(value)
            return
        words = _SPACE.sub(" ", value)
        if words[:1] == " ":
            self.space, words = True, words[1:]
        if not words:
            return
        tail = words[-1] == " "
        self._flush()
        self.out.append(words.rstrip(" "))
        self.space = tail

    def _flush(self) -> None:
        if self.gap:
            self.out.append("\n" * self.gap)
        elif self.space and self.out and self.out[-1][-1:] != "\n":
            self.out.append(" ")
        if self.mark:
            self.out.append(self.mark)
        self.gap, self.space, self.mark = 0, False, ""

    def done(self) -> str:
        return "".join(self.out).strip("\n")


Cell = tuple[str, int, int]     # text, columns and rows it covers


def _grid(rows: list[list[Cell]]) -> list[list[tuple[list[str], int]]]:
    """Lines and columns of the cells of each row, in column order; cells covered from above are empty."""
    grid: list[list[tuple[list[str], int]]] = []
    below: dict[int, int] = {}       # columns covered from above, for so many rows more
    for cells in rows:
        line: list[tuple[list[str], int]] = []
        column, waiting = 0, list(reversed(cells))
        while waiting or any(c >= column for c in below):
            if below.get(column) or not waiting:
                line.append(([], 1))
                column += 1
                continue
            text, columns, deep = waiting.pop()
            line.append(([_SPACE.sub(" ", part).rstrip() for part in text.split("\n")], columns))
            below |= {c: deep for c in range(column, column + columns) if deep > 1}
            column += columns
        below = {c: n - 1 for c, n in below.items() if n > 1}
        grid.append(line)
    return grid


def _table(rows: list[list[Cell]]) -> str:
    """Cells in columns as wide as their widest line; a cell over several columns is as wide as these,
    and a cell of several lines makes its row as high."""
    grid = [r for r in _grid(rows) if any(any(lines) for lines, _ in r)]
    widths = [0] * max((sum(columns for _, columns in r) for r in grid), default=0)
    spanning = []
    for r in grid:
        at = 0
        for lines, columns in r:
            size = max(map(len, lines), default=0)
            if columns == 1:
                widths[at] = max(widths[at], size)
            else:
                spanning.append((columns, at, size))
            at += columns
    for columns, at, size in sorted(spanning):
        widths[at + columns - 1] += max(0, size - sum(widths[at: at + columns]) - 3 * (columns - 1))
    out = []
    for r in grid:
        for n in range(max(len(lines) for lines, _ in r)):
            at, cells = 0, []
            for lines, columns in r:
                cells.append((lines[n] if n < len(lines) else "").ljust(sum(widths[at: at + columns]) + 3 * (columns - 1)))
                at += columns
            out.append(re.sub(r"(?: *\|)* *$", "", " | ".join(cells)))
    return "\n".join(out)


def render(root: Node, sheet: Sheet | None = None) -> str:
    """Visible text of a tree, without recursion (nesting may be of any depth)."""
    sheet = sheet or Sheet()
    page = Page()
    lists: list[list] = []           # kind and next number of open lists
    tables: list[tuple] = []         # pages to go back to, and rows of open tables
    work: list = [(root, False)]
    pre = 0
    while work:
        item, leaving = work.pop()
        if isinstance(item, str):
            page.text(item, pre > 0)
            continue
        tag = item.tag
        gap = 2 if tag in APART and not (tag in ("ul", "ol") and len(lists) > leaving) else 1
        if leaving:
            if tag in ("ul", "ol", "menu"):
                lists.pop()
            elif tag in ("pre", "textarea"):
                pre -= 1
            elif tag in ("td", "th") and tables and tables[-1][2]:
                outer, rows, cells = tables[-1]
                cells.pop()
                (rows[-1] if rows else rows.append([]) or rows[-1]).append((page.done(), item.span("colspan"), item.span("rowspan")))
                page = Page()
                continue
            elif tag == "table":
                outer, rows, _ = tables.pop()
                rest, page = page.done(), outer
                for text in (rest, _table(rows)):
                    if text:
                        page.block(2)
                        page.text(text, True)
            if tag in BLOCK:
                page.mark = "" if tag == "li" else page.mark
                page.block(gap)
            continue
        if item.hidden or sheet.hides(item):
            continue
        if tag == "br":
            page.gap, page.space = page.gap + 1 if page.out else 0, False
            continue
        if tag == "img" and item.attrs.get("alt"):
            page.text(item.attrs["alt"], False)
            continue
        if tag in BLOCK:
            page.block(gap)
        if tag in ("ul", "ol", "menu"):
            start = item.attrs.get("start") or ""
            lists.append([tag, int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1])
        elif tag == "li":
            kind = lists[-1] if lists else ["ul", 1]
            page.mark = "  " * max(len(lists) - 1, 0) + (f"{kind[1]}. " if kind[0] == "ol" else "- ")
            kind[1] += 1
        elif tag in ("pre", "textarea"):
            pre += 1
        elif tag == "table":
            tables.append((page, [], []))
            page = Page()
        elif tag == "tr" and tables:
            tables[-1][1].append([])
        elif tag in ("td", "th") and tables:
            tables[-1][2].append(True)
            rest = page.done()
            if rest and tables[-1][1]:
                tables[-1][1][-1].append((rest, 1, 1))
            page = Page()
        if item.parts or tag not in VOID:
            work.append((item, True))
            work.extend((part, False) for part in reversed(item.parts))
    return page.done()


def text_of(page: str | None) -> str:
    """Visible text of a page."""
    return render(*build(page or ""))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, text and n_lines of every page (columns page_id and html).

    Null and empty html give an empty text, repeated rows alike texts; text without markup is
    returned with its white space collapsed; an empty table gives no rows. Pages are read whole, in
    time that grows with their length, markup that never ends included; other columns are not
    looked at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [text_of(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(texts, pa.string()),
                                              pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())],
                                             names=["page_id", "text", "n_lines"])

    kind = dict(pages.dtypes)["page_id"]
    return pages.select("page_id", "html").mapInArrow(run, f"page_id {kind}, text string, n_lines bigint")
