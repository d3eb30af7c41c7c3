"""One plan page to its rows, in one walk over the text inside a task.

The walk keeps what the page carries down: year, term, numbers of rows and of choice
groups. So rows are never shuffled to be numbered, and a cell is cut once. Classes
of characters are ASCII, as in the column functions of `functions.text`, whose results these
functions have: see there for what each one means.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.entities import html5
from urllib.parse import unquote_plus

import pyarrow as pa

from ..codes import BLOCK, COURSE, HEADER, OPTION, SUBTOTAL, TOTAL
from ..functions.text import BLANKS, COURSE_CODE, EDGES, HOURS_RANGE, HOURS_SINGLE, REFERENCE, SUP
from . import patterns

# Rows of one batch of plan rows, about.
BATCH = 20_000
SCHEMA = pa.schema([
    ("major", pa.string()), ("year_label", pa.string()), ("term", pa.string()), ("row_order", pa.int32()), ("row_type", pa.string()),
    ("choice_group_id", pa.int64()), ("course_subject", pa.string()), ("course_number", pa.string()), ("course_code_raw", pa.string()),
    ("title", pa.string()), ("footnote_refs", pa.string()), ("credit_hours_raw", pa.string()), ("credit_hours_min", pa.float64()),
    ("credit_hours_max", pa.float64()), ("credit_hours", pa.float64()),
])


def _re(pattern: str) -> re.Pattern:
    """A pattern of the column functions. Word boundaries know all letters there, so `<t\u00e9>` is no `<t>`."""
    return re.compile(pattern.replace("\\x{00a0}", "\\xa0").replace("\\b", "(?u:\\b)"), re.ASCII)


_UNSEEN, _ROW, _CELL, _HEAD_CELL, _LINK = (
    _re(p) for p in (patterns.UNSEEN, patterns.ROW, patterns.CELL, patterns.HEAD_CELL, patterns.LINK))
_GRID_OPEN, _INDENT_OPEN = _re(patterns.GRID_OPEN), _re(patterns.INDENT_OPEN)
_TABLE_CUT, _DIV_CUT = _re(r"(?i)(?=</?table\b)"), _re(r"(?i)(?=</?div\b)")
_TABLE_OPENS, _TABLE_CLOSES, _TABLE_TAG = _re(r"(?i)<table\b"), _re(r"(?i)</table\b"), _re(r"(?is)^</?table\b[^>]*>")
_DIV_OPENS, _DIV_CLOSES = _re(r"(?i)<div\b"), _re(r"(?i)</div\b")
_PARTS = _re(r"(?is)</?t(?:r|d|h|body|head|foot)\b[^>]*>")
_ANY_TAG, _COMMENT, _TAG = _re(r"<[^>]*>"), _re(r"(?s)<!--.*?-->"), _re(r"(?is)^</?[a-z][^\s>/]*[^>]*>")
_BLANKS, _BLANK, _REFERENCE, _SUP = _re(BLANKS), _re(r"\s+"), _re(REFERENCE), _re(SUP)
_COURSE_CODE, _HOURS_RANGE, _HOURS_SINGLE = _re(COURSE_CODE), _re(HOURS_RANGE), _re(HOURS_SINGLE)
_QUERY_P, _NOT_ENCODED = _re(r"^[^#?]*\?(?:[^#]*?&)??P=([^&#]+)"), _re(r"%(?![0-9A-Fa-f]{2})")
_QUOTES = _re("^[\"']|[\"']$")
_ATTRIBUTES = {
    n: _re(rf"""(?is)(?:^|[\s"']){n}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""") for n in ("class", "colspan", "href")
}
_NAMES = {name[:-1]: char for name, char in html5.items() if name.endswith(";")}


def _character(found: re.Match) -> str:
    ref = found[1]
    if ref[0] != "#":
        return _NAMES.get(ref, found[0])
    code = int(ref[2:], 16) if ref[1] in "xX" else int(ref[1:])
    return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code <= 0xDFFF else "\ufffd"


def _strip(text: str) -> str:
    return (_REFERENCE.sub(_character, text) if "&" in text else text).strip(EDGES)


def text_of(markup: str, gap: str = "") -> str:
    if "<" not in markup:
        return _strip(markup)
    bare = _COMMENT.sub("", markup) if "<!--" in markup else markup
    return gap.join([s for p in _ANY_TAG.split(bare) if p and (s := _strip(p))])


def _squeeze(text: str) -> str:
    return _BLANKS.sub(" ", text).strip(" ")


def _without_sup(markup: str) -> str:
    bare = _SUP.sub("<br>", markup) if "<sup" in markup.lower() else markup
    return _squeeze(text_of(bare, " "))


def _sup_marks(markup: str) -> str | None:
    if "<sup" not in markup.lower():
        return None
    return ",".join(text_of(m) for m in _SUP.findall(markup)) or None


def _attribute(tag: str, name: str) -> str | None:
    found = _ATTRIBUTES[name].search(tag) if "=" in tag else None
    if not found:
        return None
    value = _QUOTES.sub("", found[1])
    return _REFERENCE.sub(_character, value) if "&" in value else value


def _query_p(href: str | None) -> str | None:
    found = _QUERY_P.search(href) if href is not None else None
    if not found:
        return None
    raw = found[1]
    if "%" not in raw:
        return raw.replace("+", " ").strip(" ")
    return (raw if _NOT_ENCODED.search(raw) else unquote_plus(raw)).strip(" ")


def _indent(markup: str) -> str | None:
    """What lies inside the first indented element, as `elements.first_element` has it."""
    depth, out = 0, []
    for piece in _DIV_CUT.split(markup):
        opens, closes = _DIV_OPENS.match(piece), _DIV_CLOSES.match(piece)
        if depth == 0:
            if opens and _INDENT_OPEN.match(piece):
                depth = 1
                out.append(_TAG.sub("", piece))
            continue
        depth += 1 if opens else -1 if closes else 0
        if depth == 0:
            break
        out.append(piece)
    return "".join(out) if out else None


def _grid_markup(page: str) -> str:
    """What lies inside the plan grids of a page; a table inside a cell is text of that cell."""
    depth = at = 0
    out = []
    for piece in _TABLE_CUT.split(page):
        before = depth
        if _TABLE_OPENS.match(piece):
            depth += 1
            if at == 0 and _GRID_OPEN.match(piece):
                at = depth
        elif _TABLE_CLOSES.match(piece):
            if at > 0 and before == at:
                at = 0
            depth = max(depth - 1, 0)
        if at and depth >= at:
            body = _TABLE_TAG.sub("", piece)
            out.append(body if depth == at else "<br>" + _PARTS.sub("<br>", body))
    return "".join(out)


def _inner(element: str) -> str:
    return element[element.find(">") + 1 :]


def _kind(marks: list[str], cells: list[str], indent: str | None) -> str | None:
    for name, kind in (("plangridyear", "year"), ("plangridterm", "term"), ("plangridsum", SUBTOTAL), ("plangridtotal", TOTAL)):
        if name in marks:
            return kind
    if not cells:
        return None
    first = cells[0]
    if len(cells) == 2 or ("colspan" in first and _attribute(first[: first.find(">") + 1], "colspan") == "2"):
        return HEADER if _without_sup(_inner(first)).lower().startswith("select") else BLOCK
    return COURSE if indent is None else OPTION


def page_rows(html: str) -> Iterator[tuple]:
    """Values of `SCHEMA` without the major, in document order.

    The order of the cases matters: a year, term or sum row is known by its class, a block
    row by its span, and only then an option by its indent. A choice group starts at each block
    row and ends at the next term row.
    """
    year = term = group = None
    order = blocks = 0
    for found in _ROW.finditer(_grid_markup(_UNSEEN.sub("", html))):
        tr = found[0]
        tag = tr[: tr.find(">") + 1]
        marks = _BLANK.split(_attribute(tag, "class") or "")
        cells = _CELL.findall(tr)
        code_td = _inner(cells[0]) if cells else None
        indent = _indent(code_td) if cells and "blockindent" in code_td else None
        kind = _kind(marks, cells, indent)
        if kind is None:
            continue
        if kind in ("year", "term"):
            head = _HEAD_CELL.search(tr)
            label = text_of(head[0]) if head else None
            if kind == "year":
                year = year if label is None else label
            else:
                term, group = term if label is None else label, None
            continue
        title_td = _inner(cells[1]) if len(cells) > 1 else None
        raw = text_of(_inner(cells[-1])) if cells else ""
        subject = number = code_raw = notes = None
        if kind in (HEADER, BLOCK):
            blocks += 1
            group, title, notes = blocks, _without_sup(code_td), _sup_marks(code_td)
        elif kind in (COURSE, OPTION):
            inside = code_td if indent is None else indent
            link = _LINK.search(inside) if "<" in inside else None
            code_raw = _squeeze(text_of(link[2] if link else code_td))
            code = _query_p(_attribute(link[1], "href")) if link else None
            if known := _COURSE_CODE.search((code_raw if code is None else code).strip(" ")):
                subject, number = known[1].upper(), known[2].upper()
            title = _without_sup(title_td) if title_td is not None else ""
            notes = _sup_marks(title_td) if title_td is not None else None
        elif kind == SUBTOTAL:
            title = "Semester Credit Hours"
        else:
            title = text_of(title_td) if title_td is not None else "Total"
        if span := _HOURS_RANGE.search(raw):
            low, high = float(span[1]), float(span[2])
        else:
            one = _HOURS_SINGLE.search(raw)
            low = high = float(one[1]) if one else None
        yield (
            year, term, order, kind, group if kind in (HEADER, BLOCK, OPTION) else None, subject, number, code_raw, title, notes,
            raw, low, high, None if low is None else (low + high) / 2,
        )
        order += 1


def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (major, html) to batches of `SCHEMA`."""
    for batch in batches:
        out: list[tuple] = []
        for major, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if html is not None:
                out += [(major, *row) for row in page_rows(html)]
            if len(out) >= BATCH:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SCHEMA)], schema=SCHEMA)
