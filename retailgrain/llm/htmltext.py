"""Layout-aware text of HTML pages: a small tree builder with implied tags, visibility rules, and a renderer.

Spark deals out the pages; each page is one row and needs no other. All visible text comes out once, in
the order of the page: blocks on lines of their own, lists with marks and indents, tables with aligned columns.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# As the standard's tokenizer reads attributes: a quote delimits only directly after "=", elsewhere it is a character like others.
_VALUE = r"\"([^\"]*)\"|'([^']*)'|([^ \t\n\r\f\"'>][^ \t\n\r\f>]*+)|(?=>)"
_ATTRIBUTE = rf"([^ \t\n\r\f/>][^ \t\n\r\f/>=]*+)(?:[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:{_VALUE})|(?![ \t\n\r\f]*+=))"
ATTRIBUTE = re.compile(_ATTRIBUTE)
_ATTRIBUTES = rf"(?:[ \t\n\r\f/]*+{re.sub(r'[(](?![?])', '(?:', _ATTRIBUTE)})*+[ \t\n\r\f/]*+"
TOKEN = re.compile(rf"<!--(?:.*?)(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})>|<[!?][^>]*>|([^<]+)", re.S)
BEGINS_TAG = re.compile(r"</?[a-zA-Z]|<[!?]")
CUT_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>")
BLANKS = re.compile(r"[ \t\n\r\f]+")
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
LOOK = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
SIMPLE = re.compile(r"(\*|[a-z][\w-]*)?((?:[.#][\w-]+)*)", re.I)

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
NOT_SHOWN = frozenset("head script style title noscript iframe noembed noframes template datalist object audio video canvas".split())
# Of a drawing only words that it draws are seen.
DRAWN = frozenset("svg g a switch text tspan textpath foreignobject".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl table blockquote pre figure hr".split())
CLOSES_P = BLOCK - frozenset("html body li dd dt td th tr tbody thead tfoot caption option optgroup legend".split())
# What an opening tag ends, and where the search for it stops.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("optgroup", "option"), ("select",)),
    "tr": (("tr", "caption", "colgroup"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (("thead", "tbody", "tfoot", "caption", "colgroup"), ("table",))),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SCOPE = frozenset("table td th caption html".split())
NESTED = 50  # lists, quotes and tables nested deeper keep their text and visibility, but indent no further


class Element:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def attributes(raw: str) -> dict[str, str]:
    """Of attributes with one name the first counts."""
    out: dict[str, str] = {}
    if raw.strip(" /\n\t"):
        for n, a, b, c in ATTRIBUTE.findall(raw):
            out.setdefault(n.lower(), unescape(a or b or c or ""))
    return out


class Open:
    """Open elements, with the places of each tag, so that an end tag finds its element without a search."""

    def __init__(self, root: Element):
        self.stack, self.places = [root], {root.tag: [0]}

    def push(self, node: Element) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def nearest(self, tags) -> int:
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)

    def close(self, tags, stops) -> None:
        """End the innermost of the tags and all in it, unless one of the stops is further in."""
        at = self.nearest(tags)
        if at and at >= self.nearest(stops):
            while len(self.stack) > at:
                self.places[self.stack.pop().tag].pop()


def parse(html: str) -> tuple[Element, list[str]]:
    """Tree of a page, and its style sheets. Unclosed elements end where the standard ends them; stray end tags are ignored.

    What begins like a tag and never ends is dropped. Time is linear in the length of the page.
    """
    root, sheets = Element("html", {}), []
    opened, at, size, last_end = Open(root), 0, len(html), html.rfind(">")
    stack = opened.stack
    while at < size:
        token = TOKEN.match(html, at) if html[at] != "<" or at < last_end or html.startswith("<!--", at) else None
        if token is None:
            if not BEGINS_TAG.match(html, at):  # a "<" of the text
                stack[-1].children.append("<")
                at += 1
                continue
            token = CUT_TAG.match(html, at) if at < last_end else None
            if token is None:
                break
            # A quote that is never closed: the tag ends at the next ">".
            at, (end, tag, raw), text = token.end(), token.groups(), None
        else:
            at = token.end()
            end, tag, raw, text = token.groups()
        if text is not None:
            stack[-1].children.append(text)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if end:
            if tag == "br":
                stack[-1].children.append(Element("br", {}))
            elif tag not in VOID:
                opened.close((tag,), () if tag in SCOPE else SCOPE)
            continue
        if tag in CLOSES_P:
            opened.close(("p",), SCOPE)
        if tag == "head" or tag == "body":
            opened.close(("head",), ("body",))
        if tag in ENDS:
            opened.close(*ENDS[tag])
        elif tag in HEADINGS and stack[-1].tag in HEADINGS:
            opened.close((stack[-1].tag,), ())
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            row = Element("tr", {})
            stack[-1].children.append(row)
            opened.push(row)
        node = Element(tag, attributes(raw))
        stack[-1].children.append(node)
        drawing = bool(opened.places.get("svg"))
        if tag in RAW and not drawing or tag in ("script", "style"):
            stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            node.children.append(html[at : stop.start() if stop else size])
            at = html.find(">", stop.end()) + 1 if stop else size
            if tag == "style":
                sheets.append(node.children[0])
            if not at:
                break
        elif tag not in VOID and not (drawing and raw.rstrip().endswith("/")):  # a slash ends an element only inside a drawing
            opened.push(node)
    return root, sheets


class Sheet:
    """Which elements the page's own styles hide: rules of simple selectors (tag, classes, id) without conditions."""

    def __init__(self, texts: list[str]):
        self.rules: dict[str, dict[tuple, dict[str, tuple]]] = {}
        order = 0
        for text in texts:
            text, at = COMMENT.sub("", text), 0
            while (brace := text.find("{", at)) >= 0:
                head = text[at:brace].rsplit(";", 1)[-1].strip()
                if head.startswith("@"):  # conditions: its whole block is left out
                    depth, at = 1, brace + 1
                    for mark in re.finditer(r"[{}]", text[at:]):
                        depth += 1 if mark.group() == "{" else -1
                        if not depth:
                            break
                    at = at + mark.end() if not depth else len(text)
                    continue
                stop = text.find("}", brace)
                stop = len(text) if stop < 0 else stop
                looks = LOOK.findall(text[brace + 1 : stop])
                for selector in head.split(",") if looks else ():
                    if (simple := SIMPLE.fullmatch(selector.strip())) and simple.group():
                        order += 1
                        self._add(simple, looks, order)
                at = stop + 1

    def _add(self, simple: re.Match, looks: list, order: int) -> None:
        tag, marks = (simple.group(1) or "*").lower(), re.findall(r"[.#][\w-]+", simple.group(2))
        ids, classes = [m[1:] for m in marks if m[0] == "#"], [m[1:] for m in marks if m[0] == "."]
        weight = (0, len(ids), len(classes), int(tag != "*"), order)
        key = f"#{ids[0]}" if ids else f".{classes[0]}" if classes else tag
        same = self.rules.setdefault(key, {}).setdefault((tag, frozenset(ids), frozenset(classes)), {})
        self._say(same, weight, looks)

    @staticmethod
    def _say(found: dict[str, tuple], weight: tuple, looks: list) -> None:
        for name, value, important in looks:
            name, rank = name.lower(), (bool(important), *weight)
            if name not in found or rank >= found[name][0]:
                found[name] = (rank, value.lower())

    def look(self, node: Element) -> dict[str, str]:
        """display and visibility of an element, as far as styles say so."""
        have = node.attributes
        found: dict[str, tuple] = {}
        if self.rules:
            own_id, classes = have.get("id", ""), frozenset(have.get("class", "").split())
            for key in (node.tag, "*", f"#{own_id}", *(f".{c}" for c in classes)):
                for (tag, ids, wanted), said in self.rules.get(key, {}).items():
                    if tag in ("*", node.tag) and ids <= {own_id} and wanted <= classes:
                        for name, told in said.items():
                            if name not in found or told[0] >= found[name][0]:
                                found[name] = told
        if "style" in have:
            self._say(found, (1, 0, 0, 0, 0), LOOK.findall(COMMENT.sub("", have["style"])))
        return {name: value for name, (_, value) in found.items()}

    def seen(self, node: Element, visible: bool) -> tuple[bool, bool]:
        """Whether an element is laid out at all, and whether its own text is visible, which its children inherit."""
        have = node.attributes
        if node.tag in NOT_SHOWN or node.tag == "dialog" and "open" not in have or node.tag == "input" and have.get("type", "").lower() == "hidden":
            return False, False
        look = self.look(node) if self.rules or "style" in have else {}
        if look.get("display", "none" if "hidden" in have else "") == "none":
            return False, False
        if "visibility" in look and look["visibility"] not in ("inherit", "unset"):
            visible = look["visibility"] not in ("hidden", "collapse")
        return True, visible


class Page:
    """Lines of one block. Blanks collapse, and the widest of adjoining margins counts."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.margin = 0

    def text(self, text: str, keep: bool) -> None:
        if keep:
            first, *rest = text.replace("\r\n", "\n").split("\n")
            self.line.append(first)
            for more in rest:
                self.feed(True)
                self.line.append(more)
            return
        text = BLANKS.sub(" ", text)
        if text.startswith(" ") and (not self.line or self.line[-1].endswith(" ")):
            text = text[1:]
        if text:
            self.line.append(text)

    def feed(self, always: bool = False) -> None:
        """End the line; ``always``: even an empty one."""
        line = "".join(self.line).rstrip(" ")
        self.line = []
        if line or always:
            if self.lines and self.margin:
                self.lines += [""] * self.margin
            self.margin = 0
            self.lines.append(line)

    def space(self, margin: int) -> None:
        self.feed()
        self.margin = max(self.margin, margin)

    def block(self, lines: list[str], margin: int) -> None:
        self.space(margin)
        for line in lines:
            self.line = [line]
            self.feed(True)
        self.margin = margin


class Renderer:
    """Lines of a tree. ``visible``: whether text at this place is; ``level``: how many lists, quotes and tables are around it."""

    def __init__(self, sheet: Sheet):
        self.sheet = sheet

    def lines(self, node: Element, visible: bool, keep: bool, level: int) -> list[str]:
        page = Page()
        self.render(node, page, visible, keep, level)
        page.feed()
        return page.lines

    def render(self, node: Element, page: Page, visible: bool, keep: bool, level: int) -> None:
        number = _start(node) if node.tag == "ol" else 0
        closed = node.tag == "details" and "open" not in node.attributes
        for child in node.children:
            if isinstance(child, str):
                if visible and not closed:
                    page.text(unescape(child), keep)
                continue
            tag = child.tag
            there, seen = self.sheet.seen(child, visible)
            if not there or closed and tag != "summary":
                continue
            nested = level < NESTED
            if tag == "br":
                page.feed(True)
            elif tag == "svg":
                self.drawing(child, page, seen, False, level)
            elif tag == "table" and nested:
                page.block(self.table(child, seen, level + 1), 1)
            elif tag == "li" and nested:
                mark = "- "
                if node.tag == "ol":
                    number = _number(child.attributes.get("value"), number)
                    mark, number = f"{number}. ", number + 1
                inside = self.lines(child, seen, keep, level + 1)
                if inside or seen:
                    page.block(hung(inside, mark), 0)
            elif tag in ("ul", "ol", "menu", "dir") and nested:
                inside = Page()
                self.render(child, inside, seen, keep, level + 1)
                inside.feed()
                page.block(inside.lines, 0 if node.tag in ("li", "ul", "ol", "menu", "dir") else 1)
            elif tag in ("blockquote", "dd") and nested:
                page.block(hung(self.lines(child, seen, keep, level + 1), "  "), int(tag == "blockquote"))
            elif tag == "pre":
                lines = self.lines(child, seen, True, level + 1) if nested else []
                if nested:
                    page.block(lines[1:] if lines and not lines[0] else lines, 1)
                else:
                    self.render(child, page, seen, True, level)
            elif tag in BLOCK or tag in ("td", "th", "tr"):
                page.space(int(tag in SPACED))
                self.render(child, page, seen, keep, level)
                page.space(int(tag in SPACED))
            elif tag == "input":
                if seen and child.attributes.get("type", "").lower() in ("submit", "button", "reset"):
                    page.text(child.attributes.get("value", ""), keep)
            else:
                self.render(child, page, seen, keep or tag == "textarea", level)

    def drawing(self, node: Element, page: Page, visible: bool, words: bool, level: int) -> None:
        """Words that a drawing shows; its titles, descriptions and definitions are none."""
        for child in node.children:
            if isinstance(child, str):
                if words and visible:
                    page.text(unescape(child), False)
                continue
            there, seen = self.sheet.seen(child, visible)
            if not there or child.tag not in DRAWN:
                continue
            if child.tag == "foreignobject":
                self.render(child, page, seen, False, level)
            else:
                self.drawing(child, page, seen, words or child.tag == "text", level)
                if child.tag == "text":
                    page.text(" ", False)

    def table(self, node: Element, visible: bool, level: int) -> list[str]:
        """Captions and stray text first, then rows with the columns under each other; cells keep their spans."""
        before, rows, down = Page(), [], {}

        def stray(child: Element, seen: bool) -> None:
            holder = Element("div", {})
            holder.children.append(child)
            before.block(self.lines(holder, seen, False, level), 0)

        def collect(part: Element, seen: bool) -> None:
            for child in part.children:
                if isinstance(child, str):
                    if seen and child.strip():
                        before.text(unescape(child), False)
                    continue
                there, own = self.sheet.seen(child, seen)
                if not there:
                    continue
                if child.tag in ("tbody", "thead", "tfoot"):
                    collect(child, own)
                elif child.tag == "tr":
                    row(child, own)
                else:
                    before.block(self.lines(child, own, False, level), 0)

        def row(part: Element, seen: bool) -> None:
            cells: dict[int, tuple[list[str], int]] = {}
            column = 0
            for child in part.children:
                if isinstance(child, str):
                    if seen and child.strip():
                        stray(child, seen)
                    continue
                if child.tag not in ("td", "th"):
                    stray(child, seen)
                    continue
                while down.get(column, 0) > 0:
                    column += 1
                wide = max(1, min(_number(child.attributes.get("colspan"), 1), 1000))
                there, own = self.sheet.seen(child, seen)
                cells[column] = (self.lines(child, own, False, level) if there else [], wide)
                tall = max(1, min(_number(child.attributes.get("rowspan"), 1), 65534))
                for c in range(column, column + wide):
                    down[c] = tall
                column += wide
            for c in list(down):
                down[c] -= 1
                if not down[c]:
                    del down[c]
            if any(lines for lines, _ in cells.values()):
                rows.append(cells)

        collect(node, visible)
        before.feed()
        return before.lines + aligned(rows)


def aligned(rows: list[dict[int, tuple[list[str], int]]]) -> list[str]:
    """Rows of cells as lines, each column as wide as its widest cell that spans no other."""
    width: dict[int, int] = {}
    for cells in rows:
        for c, (lines, wide) in cells.items():
            if wide == 1:
                width[c] = max(width.get(c, 0), *map(len, lines), 0) if lines else width.get(c, 0)
    out, starts, position = [], {}, 0
    for c in range(max((c + 1 for cells in rows for c in cells), default=0)):
        starts[c] = position
        position += width[c] + 2 if width.get(c) else 0
    for cells in rows:
        for k in range(max(len(lines) for lines, _ in cells.values())):
            line = ""
            for c in sorted(cells):
                text = cells[c][0][k] if k < len(cells[c][0]) else ""
                if text:
                    line = line.ljust(starts[c]) if len(line) <= starts[c] else line + "  "
                    line += text
            out.append(line.rstrip())
    return out


def _number(text: str | None, otherwise: int) -> int:
    return int(text) if text and re.fullmatch(r"-?\d{1,9}", text.strip()) else otherwise


def _start(node: Element) -> int:
    return _number(node.attributes.get("start"), 1)


def hung(lines: list[str], mark: str) -> list[str]:
    if not lines:
        return [mark.rstrip()] if mark.strip() else []
    return [mark + lines[0], *[" " * len(mark) + x if x else x for x in lines[1:]]]


def text_of(html: str | None) -> str:
    root, sheets = parse(html or "")
    # Elements may be nested as deep as a page has tags; each level takes a few calls.
    most = sys.getrecursionlimit()
    sys.setrecursionlimit(max(most, 4 * (html or "").count("<") + 1000))
    try:
        return "\n".join(Renderer(Sheet(sheets)).lines(root, True, False, 0))
    finally:
        sys.setrecursionlimit(most)


def extract(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text, n_chars) for every row; null and empty pages give an empty text.

    Rows repeat as they come, and equal pages get equal texts. A long page takes time and memory in proportion to its length. Other
    columns are ignored, whatever their names; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text_of(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["page_id", "text"])

    pages = df.select(F.col(id_col).cast("bigint"), F.col(html_col).cast("string")).mapInArrow(run, "page_id bigint, text string")
    return pages.withColumn("n_chars", F.length("text"))
