"""Text of HTML pages as it would be laid out.

A tokenizer and a tree builder with implied tags (paragraphs, list items, table parts, head and body) make a tree. What has no box is
left out with all it holds (head, scripts, noscript, as scripts are taken to run, hidden attributes, display: none); text that is
invisible by an inherited visibility is left out, but not what is visible again within it. What a table holds outside captions and cells stands
before it. Rendering keeps blank lines between blocks and those of repeated line breaks, marks and indents list items, and aligns
table cells in columns: a cell may have several lines, as of blocks, lists and tables in it; one that spans columns is as wide as all
of them, and below one that spans rows its column stays empty. A cell wider than WIDE is written whole beyond its column. Texts and values of form fields, formulas and
drawings are visible text; images are not loaded, so their alternative texts stand for them. Line breaks and blanks are kept in all that is preformatted. Of styles only those in
attributes count, not those of style sheets, and closed details count as open. Nesting of any depth is walked without recursion; indents grow up to INDENT levels.

Definite results: a null page has null text; an empty one has empty text; unclosed, stray and misnested tags never fail; text of any
length is rendered whole; repeated rows give repeated rows; an empty table gives an empty result; other columns play no part, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundshift.llm.shared import small_batches

#: Cells up to this width make their column's width.
WIDE = 120
#: Levels of lists that are indented.
INDENT = 40
#: Elements by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = set("head script style template noscript iframe object audio video canvas datalist title noembed noframes meta link base".split())
BLOCK = set("html body address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tr ul caption thead tbody tfoot legend option optgroup".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr menu".split())
PREFORMATTED = set("pre textarea xmp listing".split())
#: Types of input whose value is not shown as text.
WORDLESS = set("hidden checkbox radio file image password color range".split())
#: Which open elements a start tag ends, and where the search for them stops.
ENDS = {
    **dict.fromkeys("address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split(), ({"p"}, {"td", "th", "caption", "button", "table"})),
    "li": ({"li", "p"}, {"ul", "ol", "menu", "table"}),
    "dt": ({"dt", "dd", "p"}, {"dl", "table"}),
    "dd": ({"dt", "dd", "p"}, {"dl", "table"}),
    "tr": ({"tr", "td", "th", "p", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}),
    "th": ({"td", "th", "p"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "p", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "p", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "p", "caption", "colgroup"}, {"table"}),
    "caption": ({"caption", "thead", "tbody", "tfoot", "tr", "td", "th", "p", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
_TAG = re.compile(r"<(?:!--(?:-?>|(?P<comment>.*?)(?:--!?>|$))|(?P<decl>[!?][^>]*)>?|/(?P<end>[a-zA-Z][^\s/>]*)[^>]*>?|(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)>?)", re.DOTALL)
_ATTR = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
_NONE = re.compile(r"display\s*:\s*none", re.I)
_VISIBLE = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.I)
_BLANKS = re.compile(r"[ \t\n\f\r]+")


@dataclass
class Node:
    tag: str
    hidden: bool = False
    children: list = field(default_factory=list)  # nodes and texts
    start: int = 1
    visible: bool | None = None  # None: as what is around it
    wide: int = 1  # columns and rows that a cell spans
    high: int = 1


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): entities.unescape(v.strip("\"'")) for k, v in _ATTR.findall(text)} if text.strip("/ \n\t") else {}


def tree(page: str) -> Node:
    """The document's tree."""
    root = Node("html")
    open_nodes, at, n = [root], 0, len(page)
    count = Counter()  # open nodes by tag

    def cut(k: int) -> None:
        for x in open_nodes[k:]:
            count[x.tag] -= 1
        del open_nodes[k:]

    def text(s: str) -> None:
        if s:
            open_nodes[-1].children.append(entities.unescape(s) if "&" in s else s)

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        m = _TAG.match(page, lt)
        if not m:
            text(page[at : lt + 1])
            at = lt + 1
            continue
        text(page[at:lt])
        at = m.end()
        if end := m["end"]:
            end = end.lower()
            if end == "br":
                open_nodes[-1].children.append(Node("br"))
            elif end == "p" and not count["p"]:
                open_nodes[-1].children.append(Node("p"))
            elif count[end]:
                for k in range(len(open_nodes) - 1, 0, -1):
                    if open_nodes[k].tag == end:
                        cut(k)
                        break
                    inside = open_nodes[k].tag
                    if end not in ("table", "body", "html") and (inside == "table" or (inside in ("td", "th") and end not in ("tr", "thead", "tbody", "tfoot"))):
                        break
            continue
        tag = m["start"]
        if not tag:
            continue
        tag = tag.lower()
        if tag == "html" or (tag == "body" and count["body"]):
            continue
        closes, stop = ENDS.get(tag, (set(), set()))
        if tag not in HIDDEN and open_nodes[-1].tag == "head":
            cut(len(open_nodes) - 1)
        left = sum(count[x] for x in closes)
        if left:
            last = None
            for k in range(len(open_nodes) - 1, 0, -1):
                if open_nodes[k].tag in closes:
                    last, left = k, left - 1
                    if not left:
                        break
                elif open_nodes[k].tag in stop:
                    break
            if last is not None:
                cut(last)
        a = _attributes(m["attrs"] or "")
        style = a.get("style", "")
        hidden = tag in HIDDEN or "hidden" in a or (tag == "input" and a.get("type", "").lower() == "hidden") or bool(_NONE.search(style))
        node = Node(tag, hidden)
        if seen := _VISIBLE.findall(style):
            node.visible = seen[-1].lower() == "visible"
        if tag in ("td", "th"):
            node.wide, node.high = (int(x) if (x := a.get(k, "").strip()).isascii() and x.isdigit() and 0 < int(x[:6]) <= 65534 and len(x) < 6 else 1 for k in ("colspan", "rowspan"))
        if tag == "ol" and a.get("start", "").lstrip("-").isdigit():
            node.start = int(a["start"])
        if tag == "img" and a.get("alt") and not hidden:
            node.children.append(a["alt"])
        if tag == "input" and a.get("value") and not hidden and a.get("type", "").lower() not in WORDLESS:
            node.children.append(f" {a['value']} ")
        open_nodes[-1].children.append(node)
        if tag in ("pre", "textarea", "listing"):  # a line break that comes first does not count
            at += len(page[at : at + 2]) - len(page[at : at + 2].removeprefix("\r\n").removeprefix("\n"))
        if tag in RAW:
            close = re.compile(f"</{tag}[\\s/>]", re.I).search(page, at)
            stop_at = close.start() if close else n
            raw = page[at:stop_at]
            node.children.append(entities.unescape(raw) if tag == "textarea" else raw)
            at = page.find(">", stop_at) + 1 if close else n
            at = at or n
        elif tag not in VOID and not (m[0].endswith("/>") and tag not in BLOCK and hidden):
            open_nodes.append(node)
            count[tag] += 1
    return root


class _Lines:
    """Lines being laid out."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.gap = 0  # blank lines that the next line is set off by

    def word(self, s: str) -> None:
        s = _BLANKS.sub(" ", s)
        if s == " " or not s:
            if s and self.now and not self.now[-1].endswith(" "):
                self.now.append(" ")
            return
        if not self.now or self.now[-1].endswith(" "):
            s = s.lstrip(" ")
        if s:
            self.now.append(s)

    def line(self) -> None:
        """End the line, if it has begun."""
        s = "".join(self.now).rstrip(" ")
        self.now = []
        if s:
            self.put([s])

    def put(self, lines: list[str]) -> None:
        if self.lines:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        self.lines.extend(lines)

    def feed(self) -> None:
        """A line break: the line ends, or one is left blank."""
        if self.now:
            self.line()
        else:
            self.gap += 1

    def space(self) -> None:
        self.line()
        self.gap = max(self.gap, 1)


#: What a table's rows and cells may stand in.
_PARTS = {"tr", "thead", "tbody", "tfoot", "colgroup", "col"}


def _table(table: Node, visible: bool) -> tuple[list[tuple[Node, bool]], Node, list[list[tuple[Node, bool]]]]:
    """Captions at any depth, a node of what stands outside captions and cells, and the cells by row; captions and cells with whether they are visible."""
    captions: list[tuple[Node, bool]] = []
    loose = Node("div")
    rows: list[list[tuple[Node, bool]]] = []
    todo = [(iter(table.children), loose, visible)]
    while todo:
        children, into, seen = todo[-1]
        c = next(children, None)
        if c is None:
            todo.pop()
        elif isinstance(c, str):
            into.children.append(c)
        elif c.hidden:
            continue
        else:
            own = seen if c.visible is None else c.visible
            if c.tag == "caption":
                captions.append((c, own))
            elif c.tag in ("td", "th"):
                if not rows:
                    rows.append([])
                rows[-1].append((c, own))
            elif c.tag == "table":
                into.children.append(c)
            else:  # a part, or an element misplaced in the table, which may hold cells
                if c.tag == "tr":
                    rows.append([])
                shell = Node("span" if c.tag in _PARTS else c.tag, start=c.start, visible=c.visible)
                into.children.extend([" ", shell, " "] if c.tag in _PARTS else [shell])
                todo.append((iter(c.children), shell, own))
    return captions, loose, [r for r in rows if r]


def _grid(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Lines of a table from the lines of its cells and how many columns and rows each spans."""
    placed, taken = [], {}  # first row, first and last column, lines; columns taken by cells from above, with the number of rows to come
    for r, row in enumerate(rows):
        c, now = 0, taken
        taken = {k: n - 1 for k, n in now.items() if n > 1}
        for lines, wide, high in row:
            while c in now:
                c += 1
            placed.append((r, c, c + wide - 1, lines))
            if high > 1:
                taken |= dict.fromkeys(range(c, c + wide), high - 1)
            c += wide
    starts = sorted({c for _, c, _, _ in placed})
    number = {c: k for k, c in enumerate(starts)}
    placed = [(r, number[c], bisect_right(starts, z) - 1, lines) for r, c, z, lines in placed]
    width = [0] * len(starts)
    size = lambda lines: max((len(x) for x in lines if len(x) <= WIDE), default=0)
    for _, c, z, lines in placed:
        if c == z:
            width[c] = max(width[c], size(lines))
    for _, c, z, lines in placed:
        if z > c:
            width[z] += max(0, size(lines) - sum(width[c : z + 1]) - 3 * (z - c))
    at = [0]
    for w in width:
        at.append(at[-1] + w + 3)
    out, k = [], 0
    for r in range(len(rows)):
        cells = []
        while k < len(placed) and placed[k][0] == r:
            cells.append(placed[k])
            k += 1
        for i in range(max((len(lines) for *_, lines in cells), default=0)):
            line, last = [], 0
            for _, c, z, lines in cells:
                while last < c:  # columns that a cell from above spans, or that nothing stands in
                    line.append(" " * width[last])
                    last += 1
                line.append((lines[i] if i < len(lines) else "").ljust(at[z + 1] - at[c] - 3))
                last = z + 1
            while line and not line[-1].strip(" "):
                line.pop()
            out.append(" | ".join(line).rstrip(" ") if any(i < len(x) and x[i] for *_, x in cells) else "")
    return out


def _lines_of(node: Node, visible: bool, level: int, pre: bool = False):
    """Steps of laying out a node; yields what is to be laid out first, is sent its lines, and returns its own."""
    out = _Lines()
    # the nodes that are open: children to come, number of the next item, whether text is visible and preformatted, what ends the node
    todo = [[iter(node.children), node, node.start, visible, pre or node.tag in PREFORMATTED, None]]
    while todo:
        top = todo[-1]
        children, parent, number, seen, kept, end = top
        c = next(children, None)
        if c is None:
            todo.pop()
            if end:
                end()
            continue
        if isinstance(c, str):
            if not seen:
                continue
            if kept:
                first, *more = c.replace("\r\n", "\n").split("\n")
                out.now.append(first)
                for s in more:
                    out.put(["".join(out.now).rstrip()])
                    out.now = [s]
            else:
                out.word(c)
            continue
        if c.hidden:
            continue
        own = seen if c.visible is None else c.visible
        if c.tag == "br":
            out.feed()
        elif c.tag == "table":
            out.space()
            captions, loose, rows = _table(c, own)
            for caption, shown in captions:
                lines = yield _lines_of(caption, shown, level, kept)
                out.put(lines) if lines else None
            lines = yield _lines_of(loose, own, level, kept)
            out.put(lines) if lines else None
            cells = []
            for row in rows:
                cells.append([])
                for cell, shown in row:
                    lines = yield _lines_of(cell, shown, level, kept)
                    cells[-1].append((lines, cell.wide, cell.high))
            lines = _grid(cells)
            if any(lines):
                out.put(lines)
            out.space()
        elif c.tag == "li":
            out.line()
            lines = yield _lines_of(c, own, level + 1, kept)
            mark = f"{number}. " if parent.tag == "ol" else "- "
            top[2] += 1
            if lines:
                indent = " " * len(mark) if level < INDENT else ""
                out.put([(mark if i == 0 else indent) + s if s else "" for i, s in enumerate(lines)])
        elif c.tag in BLOCK:
            around = out.space if c.tag in SPACED and not (parent.tag == "li" and c.tag in ("ul", "ol")) else out.line
            around()
            todo.append([iter(c.children), c, c.start, own, kept or c.tag in PREFORMATTED, around])
        else:
            todo.append([iter(c.children), c, c.start, own, kept or c.tag in PREFORMATTED, None])
    out.line()
    return out.lines


def render_lines(node: Node) -> list[str]:
    """Lines of a tree; steps within steps wait on a list, not on the stack."""
    waiting, lines = [_lines_of(node, True, 0)], None
    while waiting:
        try:
            waiting.append(waiting[-1].send(lines))
            lines = None
        except StopIteration as done:
            waiting.pop()
            lines = done.value
    return lines


def render(page: str) -> str:
    """All visible text of a page."""
    return "\n".join(render_lines(tree(page)))


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [None if p is None else render(p) for p in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["page_id", "text"])


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, text of each page."""
    small_batches(pages.sparkSession)
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("html").cast("string").alias("html")).mapInArrow(_rendered, "page_id bigint, text string")
