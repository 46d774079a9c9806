"""HTML extraction by layout-aware rendering.

A page becomes a tree (implied end tags, raw-text elements, void elements, mis-nested end tags) and the tree
is rendered as a reader sees it: hidden parts left out, block spacing kept, lists marked and indented,
preformatted text as it stands, table cells aligned in columns. Formulas, text drawn by an svg, the content of
text areas and the options a select shows are text too. Not shown: values of input elements and the content of
object, video, audio, canvas, iframe and noscript, which stands in only where a browser cannot show them.

Each page is parsed in its own row of a map-only job, so nothing is shuffled and a lost task repeats
only its own pages.

Cases: null or empty html gives empty text; text without tags is rendered as one block; unclosed and stray
tags follow the implied-tag rules; elements nested deeper than ``MAX_DEPTH`` become children of the
element at that depth (as browsers do), none of their text is lost; repeated rows are rendered row by
row; columns of the input other than the key, url and html are not read.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendnet.llm.common import ship

# fixed values: element classes of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SVG_SHOWN = frozenset("text foreignobject".split())       # an svg draws text nowhere else
SVG_DEFS = frozenset("defs symbol metadata desc clippath mask marker pattern".split())
MATH_NOTES = frozenset("annotation annotation-xml".split())
REPLACED = frozenset("img select svg textarea".split())         # text comes from more than the children's strings
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style title template noscript iframe noembed noframes object video audio canvas "
                   "datalist input meta link base mphantom".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
                  "summary table tbody td tfoot th thead tr ul caption xmp listing".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir blockquote pre figure table hr article section fieldset".split())
CLOSES_P = BLOCK - frozenset("body html td th tr tbody thead tfoot li dd dt legend summary caption".split())
# an opening tag ends these open elements, up to the named boundary
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, {"html"}), "rt": ({"rt", "rp"}, {"ruby"}), "rp": ({"rt", "rp"}, {"ruby"}),
}
HEAD_PARTS = frozenset("title meta link base script style noscript template".split())

MAX_DEPTH = 150
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
SPECIAL = re.compile(r"[>\"']")
ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "kids", "hidden", "attrs", "depth")

    def __init__(self, tag: str, attrs: dict | None = None, depth: int = 0):
        self.tag, self.kids, self.attrs, self.depth = tag, [], attrs or {}, depth
        style = self.attrs.get("style")
        self.hidden = tag in UNSEEN or "hidden" in self.attrs or bool(style and HIDDEN_STYLE.search(style))


class Tags:
    """The tags, comments and declarations of a page, one after the other, in linear time.

    A tag ends at the first ``>`` outside quotes; where a quote never closes, at the first ``>``. A ``<`` that begins
    none of them is text. Quoted stretches that led to the page's end without a ``>`` are remembered, so no part of
    the page is searched twice in vain."""

    def __init__(self, html: str):
        self.html = html
        self.dead: set[int] = set()            # places outside quotes from which no tag ends
        self.last_end = html.rfind(">")

    def _end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag whose attributes begin at ``at``; -1 where there is none."""
        html, seen, pos = self.html, [], at
        while True:
            m = SPECIAL.search(html, pos)
            if m is None or m.start() in self.dead:
                break
            pos = m.start()
            if html[pos] == ">":
                return pos
            seen.append(pos)
            pos = html.find(html[pos], pos + 1) + 1
            if pos == 0:
                break
        self.dead.update(seen)
        return html.find(">", at)

    def next(self, at: int):
        """(start, end, closing, name, attributes) of the next one from ``at`` on; name is None for comments and
        declarations. None behind the last."""
        html = self.html
        pos = html.find("<", at)
        while pos >= 0:
            if html.startswith("<!--", pos):
                end = html.find("-->", pos + 4)
                return pos, (end + 3 if end >= 0 else len(html)), False, None, ""
            if pos < self.last_end:
                if html[pos + 1] in "!?":
                    return pos, html.find(">", pos + 2) + 1, False, None, ""
                closing = html[pos + 1] == "/"
                m = NAME.match(html, pos + 1 + closing)
                if m:
                    end = self._end(m.end())
                    if end >= 0:
                        return pos, end + 1, closing, m.group(), html[m.end():end]
            pos = html.find("<", pos + 1)
        return None

    def closing(self, tag: str, at: int) -> tuple[int, int]:
        """(start, end) of the end tag of a raw element from ``at`` on; the page's end where there is none."""
        m = re.compile("</" + re.escape(tag), re.I).search(self.html, at)
        end = self.html.find(">", m.end()) if m else -1
        return (m.start(), end + 1) if end >= 0 else (len(self.html), len(self.html))


def parse(html: str) -> Node:
    """The page's tree; text nodes are strings with entities resolved."""
    root = Node("html")
    stack = [root]
    at, n = 0, len(html)

    def close(kinds, bounds):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in bounds:
                return
            if stack[i].tag in kinds:
                del stack[i:]
                # one opening tag may end several nested parts (td, then tr)
                close(kinds, bounds)
                return

    tags = Tags(html)
    while at < n:
        found = tags.next(at)
        if not found:
            stack[-1].kids.append(unescape(html[at:]))
            break
        begin, end, closing, name, rest = found
        if begin > at:
            text = html[at:begin]
            if stack[-1].tag == "head" and text.strip():
                stack.pop()
            stack[-1].kids.append(unescape(text) if "&" in text else text)
        at = end
        if not name:
            continue
        tag = name.lower()
        if closing:
            if tag == "p" and not any(x.tag == "p" for x in stack):
                stack[-1].kids.append(Node("p"))       # a stray </p> is an empty paragraph
                continue
            if tag == "br":
                stack[-1].kids.append(Node("br"))
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in ("table", "td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot",
                                                                         "td", "th", "body", "html"):
                    break                                # an end tag does not reach out of a cell
            continue
        attrs = {}
        if rest and not rest.isspace():
            for a, v1, v2, v3 in ATTR.findall(rest):
                attrs.setdefault(a.lower(), v1 or v2 or v3)
        if tag == "html":
            continue
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        if stack[-1].tag == "head" and tag not in HEAD_PARTS:
            stack.pop()
        if tag in CLOSES_P:
            close({"p"}, {"td", "th", "table", "button", "object", "li", "div", "section", "article", "blockquote"})
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            row = Node("tr", depth=len(stack))
            stack[-1].kids.append(row)
            stack.append(row)
        node = Node(tag, attrs, len(stack))
        stack[-1].kids.append(node)
        if tag in RAW:
            stop, end = tags.closing(tag, at)
            if tag in ("xmp", "textarea"):
                node.kids.append(unescape(html[at:stop]) if tag == "textarea" else html[at:stop])
            at = end
        elif tag not in VOID and not (rest or "").rstrip().endswith("/"):
            if len(stack) < MAX_DEPTH:
                stack.append(node)
    return root


class Flow:
    """Lines of one block formatting context."""

    def __init__(self):
        self.lines: list[str] = []
        self.cur: list[str] = []
        self.gap = False
        self.open_space = False

    def text(self, s: str) -> None:
        s = BLANKS.sub(" ", s)
        if not s:
            return
        if s[0] == " ":
            self.open_space = bool(self.cur) or self.open_space
            s = s[1:]
            if not s:
                return
        if self.open_space and self.cur:
            self.cur.append(" ")
        self.open_space = s[-1] == " "
        self.cur.append(s[:-1] if self.open_space else s)

    def flush(self) -> None:
        if self.cur:
            self._put("".join(self.cur))
            self.cur = []
        self.open_space = False

    def _put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines.append(line)

    def br(self) -> None:
        if self.cur:
            self.flush()
        elif self.lines:
            self.lines.append("")

    def block(self, lines: list[str], spaced: bool) -> None:
        self.flush()
        self.gap = self.gap or spaced
        for i, line in enumerate(lines):
            if i == 0:
                self._put(line)
            else:
                self.lines.append(line)
        self.gap = self.gap or spaced


def _trim(lines: list[str]) -> list[str]:
    lo, hi = 0, len(lines)
    while lo < hi and not lines[lo].strip():
        lo += 1
    while hi > lo and not lines[hi - 1].strip():
        hi -= 1
    return lines[lo:hi]


def _span(cell: Node) -> int:
    v = cell.attrs.get("colspan", "")
    return min(max(int(v), 1), 1000) if v.isdigit() else 1


def _held(kids: list) -> list[str]:
    """Visible lines of nodes and strings as some block's content."""
    box = Node("div")
    box.kids = kids
    return render(box)


def _stray(kid: Node) -> list[str]:
    """Visible lines of a node where a list or table holds only items or rows."""
    return render(kid) if kid.tag in BLOCK else _held([kid])


def _row(node: Node) -> list[tuple[list[str], int]]:
    """(lines, span) of a row's cells; what stands between cells is a cell too where it shows anything."""
    cells: list[tuple[list[str], int]] = []
    run: list = []
    for c in [*node.kids, Node("td")]:
        if isinstance(c, str) or c.tag not in ("td", "th"):
            run.append(c)
            continue
        lines = _held(run) if run else []
        run = []
        if lines:
            cells.append((lines, 1))
        if not c.hidden:
            cells.append((render(c), _span(c)))
    return cells[:-1]


def _table(node: Node) -> list[str]:
    """Rows of aligned cells; a cell's own lines stay together under its column."""
    captions, rows = [], []
    for kid in node.kids:
        parts = kid.kids if isinstance(kid, Node) and kid.tag in ("tbody", "thead", "tfoot") and not kid.hidden else [kid]
        for p in parts:
            if isinstance(p, str):
                if p.strip():
                    captions.append(BLANKS.sub(" ", p).strip())
            elif p.hidden:
                continue
            elif p.tag == "tr":
                rows.append(_row(p))
            else:
                captions += _stray(p)
    widths: list[int] = []
    for row in rows:
        col = 0
        for lines, span in row:
            while len(widths) < col + span:
                widths.append(0)
            if span == 1:
                widths[col] = max(widths[col], max(map(len, lines), default=0))
            col += span
    out = captions
    for row in rows:
        for k in range(max((len(lines) for lines, _ in row), default=0)):
            cells, col = [], 0
            for lines, span in row:
                room = sum(widths[col:col + span]) + 3 * (span - 1)
                cells.append((lines[k] if k < len(lines) else "").ljust(room))
                col += span
            out.append(" | ".join(cells).rstrip())
    return out


def _list(node: Node) -> list[str]:
    out: list[str] = []
    start = node.attrs.get("start", "")
    number = int(start) if start.isdigit() else 1
    for kid in node.kids:
        if isinstance(kid, str):
            if kid.strip():
                out.append(BLANKS.sub(" ", kid).strip())
        elif kid.hidden:
            continue
        elif kid.tag == "li":
            lines = render(kid)
            mark = f"{number}. " if node.tag == "ol" else "- "
            number += 1
            if lines:
                out.append(mark + lines[0])
                out += [" " * len(mark) + x if x else x for x in lines[1:]]
        else:
            out += ["  " + x if x else x for x in _stray(kid)]
    return out


def _strings(node: Node) -> str:
    return "".join(x if isinstance(x, str) else "" if x.hidden else _strings(x) for x in node.kids)


def _options(node: Node, shut: bool = False):
    """(label, selected, disabled) of a select's options; an optgroup's own label comes as (label, None, None)."""
    for kid in node.kids:
        if isinstance(kid, str) or kid.hidden:
            continue
        off = shut or "disabled" in kid.attrs
        if kid.tag == "option":
            label = unescape(kid.attrs.get("label") or "") or _strings(kid)
            yield BLANKS.sub(" ", label).strip(), "selected" in kid.attrs, off
            continue
        if kid.tag == "optgroup" and kid.attrs.get("label"):
            yield unescape(kid.attrs["label"]), None, None
        yield from _options(kid, off)


def _select(node: Node, flow: Flow) -> None:
    """A list box shows all options, a closed menu the selected one or else the first that can be chosen."""
    shown = list(_options(node))
    size = node.attrs.get("size") or ""
    if "multiple" in node.attrs or size.isdigit() and int(size) > 1:
        flow.block([x for x, _, _ in shown if x], False)
        return
    chosen = [x for x, on, _ in shown if on][-1:] or [x for x, on, off in shown if on is not None and not off][:1]
    for x in chosen:
        flow.text(x)


def _svg(node: Node, flow: Flow) -> None:
    """What an svg draws as text: its text elements and embedded HTML."""
    for kid in node.kids:
        if isinstance(kid, str) or kid.hidden or kid.tag in SVG_DEFS or kid.attrs.get("display") == "none" \
                or kid.attrs.get("visibility") in ("hidden", "collapse"):
            continue
        if kid.tag in SVG_SHOWN:
            flow.text(" ")
            _inline(kid, flow)
            flow.text(" ")
        else:
            _svg(kid, flow)


def _preformatted(node: Node) -> list[str]:
    parts: list[str] = []
    todo = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            parts.append(x)
        elif not x.hidden:
            if x.tag == "br":
                parts.append("\n")
            if x.tag in REPLACED and x is not node:
                parts.append("\n".join(_held([x])))
                continue
            todo.extend(reversed(x.kids))
    text = "".join(parts)
    return _trim([x.rstrip() for x in (text[1:] if text.startswith("\n") else text).split("\n")])


def _inline(node: Node, flow: Flow) -> None:
    for kid in node.kids:
        if isinstance(kid, str):
            flow.text(kid)
        elif kid.hidden:
            continue
        elif kid.tag == "br":
            flow.br()
        elif kid.tag == "img":
            if kid.attrs.get("alt"):
                flow.text(unescape(kid.attrs["alt"]))
        elif kid.tag == "select":
            _select(kid, flow)
        elif kid.tag == "svg":
            _svg(kid, flow)
        elif kid.tag == "textarea":
            lines = _preformatted(kid)
            if len(lines) > 1:
                flow.block(lines, False)
            else:
                flow.text("".join(lines))
        elif kid.tag == "math" and kid.attrs.get("display") == "block":
            flow.block(render(kid), False)
        elif kid.tag in MATH_NOTES and node.tag == "semantics":
            continue
        elif kid.tag == "hr":
            flow.block(["----"], True)
        elif kid.tag in ("pre", "xmp", "listing"):
            flow.block(_preformatted(kid), True)
        elif kid.tag in ("ul", "ol", "menu", "dir"):
            flow.block(_list(kid), node.tag != "li")
        elif kid.tag == "table":
            flow.block(_table(kid), True)
        elif kid.tag == "blockquote":
            flow.block(["> " + x if x else ">" for x in render(kid)], True)
        elif kid.tag == "dd":
            flow.block(["  " + x if x else x for x in render(kid)], False)
        elif kid.tag in BLOCK:
            flow.block(render(kid), kid.tag in SPACED)
        else:
            _inline(kid, flow)


def render(node: Node) -> list[str]:
    """Visible lines of a node's content."""
    flow = Flow()
    _inline(node, flow)
    flow.flush()
    return _trim(flow.lines)


def visible_text(html: str | None) -> str:
    return "\n".join(render(parse(html))) if html else ""


def _extract(key: str):
    def run(batches):
        for b in batches:
            htmls = b.column("html")
            text = [visible_text(htmls[i].as_py()) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("url"), pa.array(text, pa.string())],
                                             names=[key, "url", "text"])
    return run


def extract_text(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """key, url, text: the visible text of every page."""
    ship(pages.sparkSession)
    src = pages.select(key, F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    kind = pages.schema[key].dataType.simpleString()
    return src.mapInArrow(_extract(key), f"{key} {kind}, url string, text string")
