"""Layout-aware text of HTML pages.

A tokenizer's events drive a tree builder that supplies implied tags (a paragraph ends where a block starts, a
list item where the next one starts, rows and cells likewise) and knows what is not shown. Elements are laid
out as they close, so nesting depth costs no recursion. Blocks are set apart by line breaks, paragraphs and
headings by blank lines; list items carry bullets or numbers and are indented; cells of a table are padded to
common column widths; preformatted text keeps its spaces. All visible text is kept, nothing is scored away.

Time grows with the page, however deep or unclosed its markup: open elements are found by tag, and the lines of
a list item are indented when the page is written. Indents stop growing at MOST_INDENT characters, columns are
padded to at most MOST_PAD, and tables inside MOST_TABLES others are set cell below cell; no text is lost by it.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of the HTML standard.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = set("head title script style template noscript iframe object canvas audio video datalist".split())
#: Not shown inside the element named.
UNSEEN_IN = {"desc": "svg", "metadata": "svg", "annotation": "math", "annotation-xml": "math"}
#: What may stand in a head; anything else, text too, ends it.
HEAD_CONTENT = set("base basefont bgsound link meta noframes noscript script style template title".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr".split())
BLOCK = SPACED | set(
    "address article aside body dd details dialog div dt fieldset figcaption footer form header hgroup html legend li "
    "main menu nav section summary caption".split()
)
#: Inline elements that end no paragraph, and whose text has lines of its own.
LINES = BLOCK | {"option", "optgroup", "textarea"}
#: Inline elements whose text stands apart from what is beside it.
APART = {"text", "mtd"}
#: A start tag closes these open elements first, unless one of the barriers lies between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
#: Scopes that an end tag or an implied paragraph end does not reach out of.
SCOPES = {"table", "td", "th", "caption", "html"}
#: End tags that do reach out of them.
REACHING = {"table", "html", "body", "td", "th", "tr", "caption", "tbody", "thead", "tfoot"}
MOST_INDENT, MOST_PAD, MOST_TABLES = 80, 200, 8


class _Box:
    """Lines to be written behind a mark: the first one after it, the others indented by its width."""

    __slots__ = ("mark", "lines")

    def __init__(self, mark: str, lines: list[str | _Box]):
        self.mark, self.lines = mark, lines


def _written(lines: list[str | _Box]) -> list[str]:
    """Plain lines; boxes are unfolded without recursion. `lead` holds marks that still wait for their first line."""
    out: list[str] = []
    lead: list[str] = []
    indent, open_boxes = 0, [(iter(lines), 0)]
    while open_boxes:
        inner, width = open_boxes[-1]
        for line in inner:
            if isinstance(line, _Box):
                lead = lead or [" " * min(indent, MOST_INDENT)]
                lead.append(line.mark)
                indent += len(line.mark)
                open_boxes.append((iter(line.lines), len(line.mark)))
                break
            if lead:
                out.append(("".join(lead) + line).rstrip())
                lead = []
            else:
                out.append(" " * min(indent, MOST_INDENT) + line if line else "")
        else:
            open_boxes.pop()
            indent -= width
    return out


class _Flow:
    """Lines under construction: collapsed text, breaks, and finished lines of inner boxes."""

    def __init__(self) -> None:
        self.lines: list[str | _Box] = []
        self.open: list[str] = []
        self.space = False
        self.gap = 0

    def text(self, data: str, pre: bool = False) -> None:
        if pre:
            first, *rest = data.split("\n")
            self._put(first)
            for line in rest:
                self.lines.append("".join(self.open).rstrip())
                self.open = [line]
            return
        words = data.split()
        if not words:
            self.space |= bool(data) and bool(self.open)
            return
        lead = (self.space or data[0].isspace()) and bool(self.open)
        self._put(" " * lead + " ".join(words))
        self.space = data[-1].isspace()

    def _put(self, piece: str) -> None:
        if piece:
            self._leave_gap()
            self.open.append(piece)

    def _leave_gap(self) -> None:
        if self.gap > 1 and self.lines:
            self.lines.append("")
        self.gap = 0

    def close_line(self) -> None:
        if self.open:
            self.lines.append("".join(self.open).rstrip())
        self.open, self.space = [], False

    def break_(self, size: int) -> None:
        self.close_line()
        self.gap = max(self.gap, size)

    def forced(self) -> None:
        """A <br>: ends the line, or leaves an empty one."""
        if self.open:
            self.close_line()
        elif self.lines:
            self.lines.append("")

    def box(self, lines: list[str | _Box], size: int, mark: str = "") -> None:
        self.break_(size)
        if lines:
            self._leave_gap()
            self.lines.append(_Box(mark, lines))
        self.gap = max(self.gap, size)

    def done(self) -> list[str | _Box]:
        self.close_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class _Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str | _Box], int]]] = []

    def lines(self) -> list[str | _Box]:
        if all(len(row) < 2 for row in self.rows):  # one column: nothing to align
            return [_Box("", cell) for row in self.rows for cell, _ in row if cell]
        return self._aligned([[(_written(cell), span) for cell, span in row] for row in self.rows])

    def _aligned(self, rows: list[list[tuple[list[str], int]]]) -> list[str]:
        widths: list[int] = []
        for row in rows:
            at = 0
            for cell, span in row:
                widths += [0] * (at + span - len(widths))
                if span == 1:
                    widths[at] = min(max([widths[at], *map(len, cell)]), MOST_PAD)
                at += span
        out = []
        for row in rows:
            at, columns = 0, []
            for cell, span in row:
                columns.append((cell, min(sum(widths[at : at + span]) + 2 * (span - 1), MOST_PAD)))
                at += span
            for k in range(max((len(cell) for cell, _ in columns), default=0)):
                padded = [(cell[k] if k < len(cell) else "").ljust(width) for cell, width in columns]
                out.append("  ".join(padded).rstrip())
        return out


class _Element:
    __slots__ = ("tag", "unseen", "flow", "table", "number", "pre")

    def __init__(self, tag: str, unseen: bool, flow: _Flow, table: _Table | None, number: int, pre: bool):
        self.tag, self.unseen, self.flow, self.table, self.number, self.pre = tag, unseen, flow, table, number, pre


def _hidden(tag: str, attrs: dict[str, str | None]) -> bool:
    style = "".join((attrs.get("style") or "").lower().split())
    return (
        tag in UNSEEN or "hidden" in attrs or "display:none" in style or "visibility:hidden" in style
        or (tag == "dialog" and "open" not in attrs)
    )


def _number(text: str | None, default: int, most: int) -> int:
    return min(int(text), most) if text and text.isascii() and text.isdigit() and int(text[:9]) > 0 else default


class Layout(HTMLParser):
    """Feed a page, then `close` and read `text`."""

    CDATA_CONTENT_ELEMENTS = (*HTMLParser.CDATA_CONTENT_ELEMENTS, "textarea")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        root = _Element("#root", False, _Flow(), None, 0, False)
        self.stack = [root]
        #: Places on the stack by tag, ascending.
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.root = root.flow

    def parse_html_declaration(self, i: int) -> int:
        if self.rawdata[i : i + 3] == "<![":
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in HEAD_CONTENT:
            self._end_head()
        if tag in ("td", "th") and not self._inside("tr", "table"):
            self._imply("tr")
        if tag in CLOSES:
            closing, barrier = CLOSES[tag]
            self._close_open(closing, barrier)
        if tag in BLOCK:
            self._close_open({"p"}, SCOPES)
        top, flow = self.stack[-1], self.stack[-1].flow
        values = dict(attrs)
        unseen = top.unseen or _hidden(tag, values) or (tag in UNSEEN_IN and self._inside(UNSEEN_IN[tag], "#root"))
        if tag in VOID:
            if not unseen and tag == "br":
                flow.forced()
            elif not unseen and tag == "hr":
                flow.break_(2)
            return
        table, number, pre = top.table, 0, top.pre or tag in ("pre", "textarea")
        if tag == "table":
            table = _Table() if len(self.places["table"]) < MOST_TABLES else None
        elif tag == "tr" and table and not unseen:
            table.rows.append([])
        elif tag == "ol":
            number = _number(values.get("start"), 1, 10**9)
        elif tag in ("td", "th"):
            number = _number(values.get("colspan"), 1, 1000)
        if tag in ("li", "td", "th", "caption"):
            flow = _Flow()
        elif tag in APART and not unseen:
            flow.text(" ")
        elif tag in LINES and not unseen:
            flow.break_(2 if tag in SPACED and not (tag in ("ul", "ol") and self._inside("li", "table")) else 1)
        self.places[tag].append(len(self.stack))
        self.stack.append(_Element(tag, unseen, flow, table, number, pre))

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
            return
        place = self._nearest((tag,))
        if place and (tag in REACHING or self._nearest(SCOPES) <= place):
            self._close_to(place)

    def handle_data(self, data: str) -> None:
        if data.strip():
            self._end_head()
        top = self.stack[-1]
        if top.tag == "textarea":  # raw up to its end tag, but for character references and a first line break
            data = unescape(data).replace("\r\n", "\n").removeprefix("\n")
        if not top.unseen:
            top.flow.text(data, top.pre)

    def _end_head(self) -> None:
        while self.stack[-1].tag == "head":
            self._leave()

    def feed(self, data: str) -> None:
        self.unfinished = False
        super().feed(data)

    def parse_comment(self, i: int, report: bool = True) -> int:
        """Where one comment has no end, no later one has; the rest is then not searched again."""
        end = -1 if self.unfinished else super().parse_comment(i, report)
        self.unfinished = end < 0
        return end

    def close(self) -> None:
        if not self.cdata_elem and ">" not in self.rawdata:  # no markup can end any more: the rest is text
            rest, self.rawdata = self.rawdata, ""
            self.handle_data(unescape(rest))
        super().close()
        if self.cdata_elem == "textarea" and self.rawdata:
            self.handle_data(self.rawdata)
        while len(self.stack) > 1:
            self._leave()

    def text(self) -> str:
        return "\n".join(_written(self.root.done()))

    def _inside(self, tag: str, barrier: str) -> bool:
        """Whether `tag` is open above the nearest `barrier`."""
        return self._nearest((tag,)) > self._nearest((barrier,))

    def _nearest(self, tags: Iterable[str]) -> int:
        """The highest place on the stack of one of some tags; 0 where none is open."""
        return max((self.places[tag][-1] for tag in tags if self.places[tag]), default=0)

    def _close_to(self, place: int) -> None:
        while len(self.stack) > place:
            self._leave()

    def _imply(self, tag: str) -> None:
        if self._inside("table", "#root"):
            self.handle_starttag(tag, [])

    def _close_open(self, closing: set[str], barrier: set[str]) -> None:
        """Close the lowest open element of `closing` above the barriers, and all above it."""
        after = self._nearest(barrier)
        found = (self.places[tag] for tag in closing)
        above = [places[bisect_right(places, after)] for places in found if places and places[-1] > after]
        if above:
            self._close_to(min(above))

    def _leave(self) -> None:
        element = self.stack.pop()
        self.places[element.tag].pop()
        outer = self.stack[-1]
        if element.unseen:
            return
        if element.tag == "table":
            outer.flow.box(element.table.lines() if element.table else [], 2)
        elif element.tag in ("td", "th") and element.table:
            if not element.table.rows:
                element.table.rows.append([])
            element.table.rows[-1].append((element.flow.done(), element.number))
        elif element.tag == "li":
            mark = "- "
            if outer.tag == "ol":
                mark = f"{outer.number}. "
                outer.number += 1
            outer.flow.box(element.flow.done() or [""], 1, mark)
        elif element.tag in ("td", "th", "caption"):
            outer.flow.box(element.flow.done(), 1)
        elif element.tag in APART:
            outer.flow.text(" ")
        elif element.tag in LINES:
            outer.flow.break_(2 if element.tag in SPACED and not (element.tag in ("ul", "ol") and self._inside("li", "table")) else 1)


def layout_text(html: str) -> str:
    """The visible text of a page."""
    page = Layout()
    page.feed(html)
    page.close()
    return page.text()


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [layout_text(html) for html in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], ["key", "text"])


def extract_text(pages: DataFrame) -> DataFrame:
    """All rows of `pages` (page_id, html): page_id and text. A null or empty page has an empty text."""
    id_type = pages.schema["page_id"].dataType.simpleString()
    keyed = pages.select(F.struct("page_id").alias("key"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    return keyed.mapInArrow(_render, f"key struct<page_id:{id_type}>, text string").select("key.page_id", "text")
