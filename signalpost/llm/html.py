"""Layout-aware text of web pages.

A tree is built with the tags that authors may leave out; elements that are not displayed are skipped; blocks are divided by line
breaks and empty lines, list items get their marks, preformatted text keeps its form, and the cells of a table are aligned in columns.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds of HTML elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIP = set("script style template noscript head title iframe object canvas audio video datalist".split())
# What may stand in a table outside cells, the elements that hold it, and parts of a drawing that are not drawn where they stand.
TABLE_PARTS = set("caption colgroup col thead tbody tfoot tr td th".split())
TABLE_CONTEXT = set("table thead tbody tfoot tr".split())
TABLE_KEEPS = TABLE_PARTS | {"script", "style", "template", "form"}
SVG_UNSEEN = set("title desc defs symbol metadata clippath mask pattern marker filter lineargradient radialgradient".split())
SPACED = set("p blockquote ul ol dl table pre h1 h2 h3 h4 h5 h6 figure fieldset".split())
BLOCK = SPACED | set("html body div section article aside header footer main nav address form li dt dd tr caption thead tbody tfoot td th hr "
                     "figcaption details summary legend center".split())
# An opening tag closes these open elements, up to the element in which it belongs.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th", "caption"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
          "select": ({"select"}, {"table", "td", "th"}), "textarea": ({"select"}, {"table", "td", "th"}), "input": ({"select"}, {"table", "td", "th"}),
          "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
          "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"})}
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
# Tables in each other that are aligned; columns one cell spans at most and rows, as browsers have it.
DEEPEST, WIDEST, TALLEST = 40, 1000, 65534
BLANKS = re.compile(r"[ \t\n\r\f]+")
COMMENT, AT_RULE, RULE = re.compile(r"/\*.*?\*/", re.S), re.compile(r"@[^{};]*(?:;|\{(?:[^{}]*\{[^{}]*\})*[^{}]*\})"), re.compile(r"([^{}]+)\{([^{}]*)\}")
SIMPLE = re.compile(r"([a-z][a-z0-9]*|\*)?((?:[.#][\w-]+)*)", re.I)
SHOWS = re.compile(r"display\s*:|visibility\s*:", re.I)


def _whole(text: str, default: int) -> int:
    """A number of one to nine ASCII digits, else the default."""
    return int(text) if re.fullmatch("[0-9]{1,9}", text) else default


class Node:
    __slots__ = ("tag", "attrs", "inside")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.inside = tag, attrs, []


class Builder(HTMLParser):
    """Tree of a page; a paragraph ends where a block begins, and items, cells and rows end where the next one begins.

    What stands in a table outside its cells goes before the table, as in browsers.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]

    def _cut(self, at: int) -> None:
        del self.open[at:]

    def _table(self) -> int:
        """Index of the innermost open table if no cell or caption is open in it, else 0."""
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == "table":
                return at
            if self.open[at].tag in ("td", "th", "caption"):
                return 0
        return 0

    def _put(self, item: Node | str) -> None:
        """Add to the open element, or before the table if that does not hold such an item."""
        tag = item.tag if isinstance(item, Node) else ""
        if self.open[-1].tag == "colgroup" and (item.strip() if isinstance(item, str) else tag not in ("col", "template")):
            self.open.pop()
        here = self.open[-1]
        at = self._table() if here.tag in TABLE_CONTEXT else 0
        if not at or tag in TABLE_KEEPS or isinstance(item, str) and not item.strip(" \t\n\r\f"):
            here.inside.append(item)
            return
        around, table = self.open[at - 1].inside, self.open[at]
        place = next(k for k in range(len(around) - 1, -1, -1) if around[k] is table)
        around.insert(place, item)

    def handle_starttag(self, tag, attrs):
        if self.open[-1].tag == "textarea":  # holds no elements
            self.handle_data(self.get_starttag_text())
            return
        if tag == "html":
            return
        if tag == "table" and self.open[-1].tag in TABLE_CONTEXT and self._table():
            self._cut(self._table())
        if tag in BLOCK and self.open[-1].tag != "html":
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at].tag == "p":
                    self._cut(at)
                    break
                if self.open[at].tag in BLOCK:
                    break
        if tag in CLOSES:
            ended, border = CLOSES[tag]
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at].tag in border:
                    break
                if self.open[at].tag in ended:
                    self._cut(at)
        if tag in TABLE_PARTS and self._table():
            while self.open[-1].tag not in TABLE_CONTEXT and (tag, self.open[-1].tag) != ("col", "colgroup"):
                self.open.pop()
        if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self.handle_starttag("tr", [])
        if tag == "body" or tag not in VOID and tag != "head":
            if len(self.open) > 1 and self.open[1].tag == "head" and tag not in ("title", "style", "script", "noscript", "template"):
                self._cut(1)
        node = Node(tag, {k: v or "" for k, v in attrs})
        in_table = tag == "form" and self.open[-1].tag in TABLE_CONTEXT and self._table()
        self._put(node)
        if tag not in VOID and not in_table:  # a form in a table does not hold its rows
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag and (tag in ("svg", "object", "iframe") or self._drawing()):
            self._cut(len(self.open) - 1)

    def _drawing(self) -> bool:
        """Whether the last open element is part of a drawing."""
        for node in reversed(self.open):
            if node.tag in ("svg", "foreignobject"):
                return node.tag == "svg"
        return False

    def handle_endtag(self, tag):
        if self.open[-1].tag == "textarea" and tag != "textarea":
            self.handle_data(f"</{tag}>")
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                self._cut(at)
                return
            if self.open[at].tag in ("table", "td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html", self.open[at].tag):
                return
        if tag == "p":
            self._put(Node("p", {}))

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self._cut(len(self.open) - 1)
        if self.open[-1].tag == "textarea" and not self.open[-1].inside:
            data = data.removeprefix("\n")
        self._put(data)


def visible(node: Node) -> bool:
    attrs = node.attrs
    return not (node.tag in SKIP or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" and node.tag in ("span", "i", "svg")
                or node.tag == "input" or HIDDEN_STYLE.search(attrs.get("style", ""))
                or node.tag == "dialog" and "open" not in attrs)


def hide(root: Node) -> None:
    """Mark as hidden what a rule of a style element hides by tag, class or id; the last rule of a selector counts.

    Rules for elements within others, and those of media, are not looked at: what they say depends on more than the page.
    """
    sheets, nodes, todo = [], [], [root]
    while todo:
        node = todo.pop()
        nodes.append(node)
        if node.tag == "style":
            sheets.append("".join(c for c in node.inside if isinstance(c, str)))
        todo += [c for c in reversed(node.inside) if isinstance(c, Node)]
    rules: dict[tuple, bool] = {}
    for sheet in sheets:
        for selectors, body in RULE.findall(AT_RULE.sub("", COMMENT.sub("", sheet))):
            for selector in selectors.split(",") if SHOWS.search(body) else ():
                simple = SIMPLE.fullmatch(selector.strip())
                if simple and selector.strip():
                    parts = re.findall(r"[.#][\w-]+", simple[2])
                    rules[(simple[1] or "*").lower(), frozenset(parts)] = bool(HIDDEN_STYLE.search(body))
    hidden = [rule for rule, hides in rules.items() if hides]
    for node in nodes if hidden else ():
        marks = {f".{c}" for c in node.attrs.get("class", "").split()} | ({f"#{node.attrs['id']}"} if node.attrs.get("id") else set())
        if not SHOWS.search(node.attrs.get("style", "")) and any(tag in ("*", node.tag) and parts <= marks for tag, parts in hidden):
            node.attrs["hidden"] = ""


def options(node: Node) -> list[str]:
    """Texts that a choice shows: all of a list box, the chosen one of a menu."""
    found, todo = [], [(c, False) for c in reversed(node.inside)]  # (text, option or not, disabled, selected)
    while todo:
        child, off = todo.pop()
        if not isinstance(child, Node) or not visible(child):
            continue
        off = off or child.tag in ("option", "optgroup") and "disabled" in child.attrs
        if child.tag == "option":
            found.append((child.attrs.get("label") or " ".join(render(child, DEEPEST).split()), True, off, "selected" in child.attrs))
            continue
        if child.tag == "optgroup":
            found.append((child.attrs.get("label", ""), False, off, False))
        todo += [(c, off) for c in reversed(child.inside)]
    size = node.attrs.get("size", "")
    if "multiple" in node.attrs or _whole(size, 1) > 1:
        return [text for text, *_ in found if text]
    real = [x for x in found if x[1]]
    shown = [x[0] for x in real if x[3]][-1:] or [x[0] for x in real if not x[2]][:1]
    return [text for text in shown if text]


def drawn(node: Node) -> list[Node]:
    """Text of a drawing, each in a block."""
    out, todo = [], list(reversed(node.inside))
    while todo:
        child = todo.pop()
        if not isinstance(child, Node) or not visible(child) or child.tag in SVG_UNSEEN:
            continue
        if child.tag in ("text", "foreignobject"):
            out.append(Node("div", {}))
            out[-1].inside.append(child)
        else:
            todo += reversed(child.inside)
    return out


def width(text: str) -> int:
    """Columns that a text takes: wide characters take two, marks on letters none."""
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Writer:
    """Lines of text; gaps between blocks are the largest of those asked for."""

    def __init__(self):
        self.lines: list[str] = []
        self.line, self.gap = "", 0

    def text(self, data: str) -> None:
        data = BLANKS.sub(" ", data)
        if not self.line:
            data = data.lstrip(" ")
        elif self.line.endswith(" ") and data.startswith(" "):
            data = data[1:]
        self.line += data

    def end(self, gap: int = 0) -> None:
        """End the line; ``gap`` empty lines at least come before the next one."""
        if self.line.strip(" "):
            self.put(self.line.rstrip(" "))
        self.line = ""
        self.gap = max(self.gap, gap)

    def put(self, line: str) -> None:
        if self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        self.lines.append(line)


def _rows(node: Node) -> Iterator[Node]:
    for child in node.inside:
        if isinstance(child, Node) and visible(child):
            if child.tag == "tr":
                yield child
            elif child.tag in ("thead", "tbody", "tfoot"):
                yield from _rows(child)


def _table(node: Node, out: Writer, depth: int) -> None:
    for child in node.inside:
        if isinstance(child, Node) and child.tag == "caption" and visible(child):
            out.put(" ".join(render(child, depth + 1).split("\n")))
    grid = []
    below: dict[int, int] = {}  # rows that a cell above still takes, by column
    for row in _rows(node):
        cells: list[list[str]] = []
        for cell in [*row.inside, None]:
            if cell is not None and not (isinstance(cell, Node) and cell.tag in ("td", "th") and visible(cell)):
                continue
            while below.get(len(cells), 0):
                below[len(cells)] -= 1
                cells.append([""])
            if cell is not None:
                at = len(cells)
                cells.append(render(cell, depth + 1).split("\n"))
                cells += [[""]] * (max(1, min(_whole(cell.attrs.get("colspan", ""), 1), WIDEST)) - 1)
                down = _whole(cell.attrs.get("rowspan", ""), 1) or TALLEST  # 0: to the end
                below |= {k: min(down, TALLEST) - 1 for k in range(at, len(cells))}
        grid.append(cells)
    columns = max(map(len, grid), default=0)
    widths = [max((width(line) for cells in grid if k < len(cells) for line in cells[k]), default=0) for k in range(columns)]
    for cells in grid:
        for at in range(max(map(len, cells), default=0)):
            parts = [cell[at] if at < len(cell) else "" for cell in cells]
            line = "  ".join(p + " " * (widths[k] - width(p)) for k, p in enumerate(parts)).rstrip()
            if line:
                out.put(line)


def _walk(root: Node, out: Writer, depth: int) -> None:
    """Write a tree, with a stack in place of recursion, as pages may be nested deeply."""
    todo: list = [(root, "in", None)]
    while todo:
        node, step, kept = todo.pop()
        if isinstance(node, str):
            if step == "pre":
                first, *rest = node.split("\n")
                out.line += first
                for line in rest:
                    out.put(out.line.rstrip())
                    out.line = line
            else:
                out.text(node)
            continue
        tag = node.tag
        if step == "out":
            if tag in BLOCK:
                out.end(1 if tag in SPACED and kept is None else 0)
            continue
        if node is not root and not visible(node):
            continue
        if tag == "br":
            if out.line.strip(" "):
                out.end()
            else:
                out.gap = max(out.gap, 1)
            continue
        if tag == "hr":
            out.end()
            continue
        if tag == "img":
            if node.attrs.get("alt"):
                out.text(node.attrs["alt"])
            continue
        if tag == "select":
            shown = options(node)
            if "multiple" in node.attrs or len(shown) > 1:
                for line in shown:
                    out.end()
                    out.text(line)
                out.end()
            elif shown:
                out.text(shown[0])
            continue
        nested = kept if tag in ("ul", "ol") else None
        if tag in BLOCK and node is not root:
            out.end(1 if tag in SPACED and nested is None else 0)
        if tag == "table" and depth < DEEPEST:
            _table(node, out, depth)
            out.end(1)
            continue
        mark = kept if tag == "li" else None
        if mark is not None:
            out.line = mark
        todo.append((node, "out", nested))
        kind = "pre" if tag in ("pre", "textarea") or step == "pre" else "in"
        level = kept if isinstance(kept, int) else 0
        inside: list = []
        number = _whole(node.attrs.get("start", ""), 1)
        for child in drawn(node) if tag == "svg" else node.inside:
            if isinstance(child, Node) and child.tag == "li":
                sign = f"{number}. " if tag == "ol" else "- "
                number += 1
                inside.append((child, kind, "  " * level + sign))
            elif isinstance(child, Node) and child.tag in ("ul", "ol") and tag in ("li", "ul", "ol"):
                inside.append((child, kind, (len(mark) - len(mark.lstrip())) // 2 + 1 if mark is not None else level + 1))
            else:
                inside.append((child, kind, None))
        todo += reversed(inside)


def render(node: Node, depth: int = 0) -> str:
    """Text of a tree; tables within over ``DEEPEST`` tables are written as blocks."""
    out = Writer()
    _walk(node, out, depth)
    out.end()
    return "\n".join(out.lines).strip("\n")


def page_text(html: str | None) -> tuple[str, str]:
    """Title and visible text of a page; both empty for a null or empty page."""
    builder = Builder()
    builder.feed(html or "")
    builder.close()
    title, todo = "", [builder.root]
    while todo and not title:
        node = todo.pop()
        if node.tag == "title":
            title = " ".join("".join(c for c in node.inside if isinstance(c, str)).split())
        todo += [c for c in reversed(node.inside) if isinstance(c, Node)]
    hide(builder.root)
    return title, render(builder.root)


def extract(df: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Per row of ``df``: ``key``, ``title``, ``text``, ``n_chars`` and ``n_lines`` of the visible text.

    Null and empty pages give empty texts.  Repeated rows and null keys are rendered like others.
    """
    pages = df.select(F.col(key).alias("id"), F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [page_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([t for t, _ in found], pa.string()), pa.array([x for _, x in found], pa.string())],
                                             ["id", "title", "text"])

    kind = pages.schema["id"].dataType.simpleString()
    out = pages.mapInArrow(run, f"id {kind}, title string, text string")
    lines = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n", -1))).cast("bigint")
    return out.select(F.col("id").alias(key), "title", "text", F.length("text").cast("bigint").alias("n_chars"), lines.alias("n_lines"))
