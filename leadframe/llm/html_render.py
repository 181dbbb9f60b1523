"""Visible text of HTML pages, laid out (operator 5)."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import column, only, shipped

#: Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset("head script style template noscript iframe object svg math canvas audio video datalist "
                   "noembed noframes select textarea".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
                  "search section summary table tbody tfoot thead tr ul caption".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr menu".split())
#: Opening the element on the left ends open elements on the right, up to a boundary.
IMPLIED = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select"),
    "optgroup": ("option optgroup", "select"), "tr": ("tr td th caption", "table"), "td": ("td th caption", "table tr"),
    "th": ("td th caption", "table tr"), "thead": ("thead tbody tfoot tr td th caption colgroup", "table"),
    "tbody": ("thead tbody tfoot tr td th caption colgroup", "table"),
    "tfoot": ("thead tbody tfoot tr td th caption colgroup", "table"), "body": ("head", "html"),
}
IMPLIED = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in IMPLIED.items()}
CELLS = frozenset("td th caption".split())
TABLE = frozenset("caption colgroup thead tbody tfoot tr td th".split())
SCOPE = frozenset("table td th caption html template".split())
HEAD = frozenset("title meta link base style script noscript template".split())

OPEN = re.compile(r"<!--|<[!?]|</?([A-Za-z][^\s/>]*)")
#: Attributes up to the end of the tag; quotes count after "=" only.
REST = re.compile(r"""(?:[^>=]+|=\s*(?:"[^"]*"|'[^']*')?)*+>""")
SPANS = re.compile(r"""\b(colspan|rowspan)\s*=\s*["']?(\d{1,5})""", re.I)
#: A column is padded up to this width; behind a longer cell the rest of its row begins later.
WIDEST = 60
UNSEEN = re.compile(r"""(?:^|[\s"'/])hidden(?=[\s=/]|$)|\bstyle\s*=\s*["']?[^"']*(?:display\s*:\s*none|visibility\s*:\s*hidden)"""
                    r"""|\btype\s*=\s*["']?hidden|\baria-hidden\s*=\s*["']?true""", re.I)
START = re.compile(r"""\bstart\s*=\s*["']?(-?\d{1,9})""", re.I)
SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "hidden", "start", "spans", "items")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag = tag
        self.hidden = tag in HIDDEN or bool(attributes) and UNSEEN.search(attributes) is not None
        self.start = int(m[1]) if tag == "ol" and (m := START.search(attributes)) else 1
        told = {name.lower(): n for name, n in SPANS.findall(attributes)} if tag in ("td", "th") else {}
        self.spans = tuple(max(1, min(1000, int(told.get(k, 1)))) for k in ("colspan", "rowspan"))
        self.items: list = []


def _raw_end(page: str, tag: str, at: int, ends: dict) -> int:
    """Where ``</tag`` begins from ``at`` on, the page's end if nowhere; a miss is remembered."""
    if ends.get(tag) is None:
        found = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
        if found:
            return found.start()
        ends[tag] = len(page)
    return ends[tag]


def _end_of_mark(page: str, found: re.Match) -> int:
    """End of the tag, comment or declaration that begins here; -1 if it never ends."""
    if found[1]:
        rest = REST.match(page, found.end())
        return rest.end() if rest else -1
    mark = "-->" if found[0] == "<!--" else ">"
    end = page.find(mark, found.end())
    return end + len(mark) if end >= 0 else len(page)


class Open(list):
    """Open elements, the innermost last, and how many there are of each name."""

    def __init__(self, root: Node):
        super().__init__([root])
        self.names = Counter([root.tag])

    def push(self, node: Node) -> None:
        self.append(node)
        self.names[node.tag] += 1

    def cut(self, depth: int) -> None:
        """Close the element at this depth and all inside it."""
        self.names.subtract(node.tag for node in self[depth:])
        del self[depth:]


def _close(stack: Open, tag: str) -> None:
    for depth in range(len(stack) - 1 if stack.names[tag] else 0, 0, -1):
        if stack[depth].tag == tag:
            stack.cut(depth)
            return
        if stack[depth].tag in SCOPE and tag not in TABLE and tag != "table":
            return


def _close_implied(stack: Open, tag: str) -> None:
    ended, boundary = IMPLIED.get(tag, (frozenset(), frozenset()))
    if tag in BLOCK and tag not in TABLE:
        ended = ended | {"p"}
    lowest = None
    for depth in range(len(stack) - 1 if any(stack.names[name] for name in ended) else 0, 0, -1):
        here = stack[depth].tag
        if here in ended:
            lowest = depth
        elif here in boundary or here in SCOPE:
            break
    if lowest is not None:
        stack.cut(lowest)


def tree(page: str) -> Node:
    """Elements and texts nested as the page says, with the end tags that HTML lets authors leave out."""
    root = Node("html")
    stack, ends, at, size = Open(root), {}, 0, len(page)
    while at < size:
        found = OPEN.search(page, at)
        end = _end_of_mark(page, found) if found else -1
        # a mark that never ends is text, as is all that follows the last mark
        text = page[at:found.start() if end >= 0 else size]
        if text:
            if stack[-1].tag == "head" and text.strip():
                stack.cut(len(stack) - 1)
            stack[-1].items.append(html.unescape(text) if "&" in text else text)
        if end < 0:
            break
        at = end
        tag = (found[1] or "").lower()
        if not tag or tag == "html":
            continue
        if page[found.start() + 1] == "/":
            _close(stack, tag)
            continue
        if tag == "body" and stack.names["body"]:
            continue
        if stack[-1].tag == "head" and tag not in HEAD:
            stack.cut(len(stack) - 1)
        _close_implied(stack, tag)
        node = Node(tag, page[found.end():end - 1])
        stack[-1].items.append(node)
        if tag in RAW:
            close = _raw_end(page, tag, at, ends)
            closing = page.find(">", close)
            at = closing + 1 if closing >= 0 else size
        elif tag not in VOID:
            stack.push(node)
    return root


class Page:
    """Lines of text; blocks begin on a line of their own, spaced ones after an empty line."""

    def __init__(self):
        self.lines: list[str] = []
        self.words: list[str] = []
        self.gap = False

    def block(self, spaced: bool = False, lead: str = "") -> None:
        line = SPACE.sub(" ", "".join(self.words)).strip(" ")
        self.words = []
        if line:
            if self.gap and self.lines and self.lines[-1] != "":
                self.lines.append("")
            self.gap = False
            self.lines.append(line)
        if spaced:
            self.gap = True
        if lead:
            self.words = [lead]

    def verbatim(self, text: str) -> None:
        self.block(True)
        if self.lines and text.strip("\n"):
            self.lines.append("")
        self.lines.extend(line.rstrip() for line in text.strip("\n").split("\n") if text.strip("\n"))
        self.gap = True

    def text(self) -> str:
        self.block()
        return "\n".join(self.lines)


def _plain(node: Node) -> str:
    """All visible text below a node, not laid out."""
    out, todo = [], [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
        elif item.tag == "br":
            out.append("\n")
        elif not item.hidden:
            todo.extend(reversed(item.items))
    return "".join(out)


def _rows(table: Node) -> list[list[Node]]:
    """Rows of cells of one table; rows of tables inside its cells are theirs."""
    rows: list[list[Node]] = []
    todo: list = list(reversed(table.items))
    while todo:
        item = todo.pop()
        if isinstance(item, str) or item.hidden:
            continue
        if item.tag == "tr":
            rows.append([])
            todo.extend(reversed(item.items))
        elif item.tag in ("td", "th"):
            if not rows:
                rows.append([])
            rows[-1].append(item)
        elif item.tag in ("thead", "tbody", "tfoot", "form"):
            todo.extend(reversed(item.items))
    return [r for r in rows if r]


def _stray(table: Node) -> list:
    """What a table holds outside its cells: captions, texts, misplaced elements."""
    out, todo = [], list(reversed(table.items))
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            if item.strip():
                out.append(item)
        elif item.tag in ("tr", "thead", "tbody", "tfoot", "form"):
            todo.extend(reversed(item.items))
        elif item.tag not in ("td", "th", "colgroup", "col"):
            out.append(item)
    return out


def _placed(rows: list[list[Node]]) -> Iterator[list[tuple[int, Node]]]:
    """Rows of (column, cell), where cells that span columns or rows keep others out."""
    taken: dict[int, int] = {}  # column: rows that it stays taken
    for row in rows:
        out, column, below = [], 0, {}
        for cell in row:
            while taken.get(column, 0):
                column += 1
            out.append((column, cell))
            across, down = cell.spans
            for i in range(column, column + across):
                if down > 1:
                    below[i] = down - 1
            column += across
        taken = {i: n - 1 for i, n in taken.items() if n > 1} | below
        yield out


def _grid(table: Node, page: Page) -> None:
    """Cells of a column begin at the same place; a cell of several lines takes as many lines."""
    rows = [[(i, cell.spans[0], render_node(cell).split("\n")) for i, cell in row] for row in _placed(_rows(table))]
    widths: dict[int, int] = {}
    for row in rows:
        for i, across, cell in row[:-1]:
            if across == 1:
                widths[i] = max(widths.get(i, 0), *map(len, cell))
    last = max((i for row in rows for i, _, _ in row), default=0)
    starts = [0]
    for i in range(last):
        starts.append(starts[-1] + (min(widths[i], WIDEST) + 2 if i in widths else 0))
    page.block(True)
    out = []
    for row in rows:
        for k in range(max(len(cell) for _, _, cell in row)):
            line = ""
            for i, _, cell in row:
                part = cell[k] if k < len(cell) else ""
                line = line.ljust(starts[i]) if len(line) + 2 <= starts[i] or not line else line + "  "
                line += part
            out.append(line.rstrip())
    if any(out):
        if page.lines and page.lines[-1] != "":
            page.lines.append("")
        page.gap = False
        page.lines.extend(out)
        page.gap = True


def render_node(root: Node) -> str:
    """Lay out the visible content of an element; nesting of any depth is walked with a list, not by recursion."""
    page, lists = Page(), []
    todo: list = list(reversed(root.items))
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            page.words.append(item)
            continue
        if isinstance(item, tuple):
            kind, node = item
            if kind == "list":
                lists.pop()
            page.block(node.tag in SPACED and not (kind == "list" and lists))
            continue
        if item.hidden:
            continue
        tag = item.tag
        if tag == "br":
            page.block()
        elif tag == "hr":
            page.block(True)
        elif tag == "img":
            continue
        elif tag == "pre":
            page.verbatim(_plain(item))
        elif tag == "table" and _shallow(item):
            page.block(True)
            for other in _stray(item):
                text = other if isinstance(other, str) else "" if other.hidden else render_node(other)
                page.words.append(text)
                page.block()
            _grid(item, page)
        else:
            if tag == "li":
                lead = "- "
                if lists and lists[-1][0] == "ol":
                    lead = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                page.block(lead=lead)
                page.words[:] = ["  " * max(0, len(lists) - 1) + lead]
            elif tag in BLOCK:
                page.block(tag in SPACED and not (tag in ("ul", "ol") and lists))
            if tag in ("ul", "ol", "menu"):
                lists.append([tag, item.start])
                todo.append(("list", item))
            elif tag in BLOCK:
                todo.append(("block", item))
            elif tag in CELLS:
                page.words.append(" ")
                todo.append(" ")
            todo.extend(reversed(item.items))
    return page.text()


def _shallow(table: Node, most: int = 20) -> bool:
    """Tables nested deeper than this are laid out as blocks, so that recursion stays shallow; no text is lost."""
    level, here = 0, [table]
    while here:
        nested, todo = [], list(here)
        while todo:
            for x in todo.pop().items:
                if not isinstance(x, str):
                    (nested if x.tag == "table" else todo).append(x)
        level, here = level + 1, nested
        if level > most:
            return False
    return True


def render(page: str | None) -> str | None:
    return None if page is None else render_node(tree(page)).replace(" ", " ")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, text, n_lines: the visible text of every page.

    Hidden elements (head, script, style, template …, ``hidden``, ``aria-hidden``,
    ``display:none``, ``visibility:hidden``) show nothing.  Blocks begin on their
    own line, paragraphs, headings, lists and tables after an empty line; list
    items get ``-`` or their number and are indented by depth; the cells of a
    table column start at one place, also under cells that span several columns
    or rows, and behind a cell of over 60 characters later in its own row only;
    ``pre`` keeps its lines.

    Null html gives null text and 0 lines, empty html an empty text and 0 lines.
    Pages are independent: repeated rows are rendered alike, an empty table gives
    an empty result, other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(p) for p in column(batch, "html")]
            lines = [t.count("\n") + 1 if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("page_id")).cast(pa.int64()),
                 pa.array(texts, pa.string()), pa.array(lines, pa.int32())], names=["page_id", "text", "n_lines"])

    return only(pages, "page_id", "html").mapInArrow(run, "page_id bigint, text string, n_lines int")


shipped(__name__)
