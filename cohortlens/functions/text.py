"""Text cleaning: blanks, slugs, codes, hours, markup and entities."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import _col

# \s leaves out the non-breaking space, so the class names it.
BLANKS = r"[\s\x{00a0}]+"
# The formats of course codes and of credit hours.
COURSE_CODE = r"^([A-Za-z]+)\s*(\d[\dA-Za-z]*)$"
HOURS_RANGE = r"(\d+(?:\.\d+)?)\s*-\s*(\d+(?:\.\d+)?)"
HOURS_SINGLE = r"(\d+(?:\.\d+)?)"


def match(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null where there is none or it is empty."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def squeeze(c: Column | str) -> Column:
    """Collapse blanks, the non-breaking space included, and trim."""
    return F.trim(F.regexp_replace(_col(c), BLANKS, " "))


def inner(element: Column | str) -> Column:
    """What follows the open tag of an element."""
    c = _col(element)
    return F.substring(c, F.instr(c, F.lit(">")) + 1, F.length(c))


def blank_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~c.rlike(r"^\s*$"), c)


def slug(c: Column | str) -> Column:
    """Each character that is no letter or digit becomes `_`; outer ones go; lower case."""
    return F.lower(F.trim(F.regexp_replace(_col(c), r"[^\p{L}\p{N}]", "_"), F.lit("_")))


def split_last_dash(c: Column | str) -> tuple[Column, Column]:
    """(text before the last dash, text after it); no dash gives (text, null)."""
    c = _col(c)
    dashed = F.contains(c, F.lit("-"))
    last = F.substring_index(c, "-", -1)
    head = F.trim(F.when(dashed, F.left(c, F.length(c) - F.length(last) - 1)).otherwise(c))
    return head, F.when(dashed, F.nullif(F.trim(last), F.lit("")))


def split_first_dash(c: Column | str) -> tuple[Column, Column]:
    """(subject, number) around the first dash, trimmed, upper case."""
    c = _col(c)
    first = F.substring_index(c, "-", 1)
    rest = F.when(F.contains(c, F.lit("-")), F.substring(c, F.length(first) + 2, F.length(c)))
    return F.upper(F.trim(first)), F.upper(F.trim(rest))


def course_code(c: Column | str) -> tuple[Column, Column]:
    """'CSCE 222' -> ('CSCE', '222'); (null, null) if the text is no course code."""
    bare = F.trim(_col(c))
    return F.upper(match(bare, COURSE_CODE, 1)), F.upper(match(bare, COURSE_CODE, 2))


def hours(c: Column | str) -> tuple[Column, Column]:
    """(min, max) hours from '3', '15-16' or text without a number."""
    c = _col(c)
    one = match(c, HOURS_SINGLE).cast("double")
    low = F.coalesce(match(c, HOURS_RANGE, 1).cast("double"), one)
    high = F.coalesce(match(c, HOURS_RANGE, 2).cast("double"), one)
    return low, high


def _let(c: Column, body) -> Column:
    """Evaluate `c` once and use it several times in `body`."""
    return F.get(F.transform(F.array(c), body), F.lit(0))


def query_value(href: Column | str, name: str) -> Column:
    """The first value of a query parameter of a decoded link, decoded and trimmed."""
    pattern = rf"^[^#?]*\?(?:[^#]*?&)??{name}=([^&#]+)"
    return _let(match(_col(href), pattern), lambda raw: F.trim(F.coalesce(F.try_url_decode(raw), raw)))


REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);"
# All names of the public list, as a constant that is parsed once per plan.
_NAMES = json.dumps({name[:-1]: char for name, char in html5.items() if name.endswith(";")})


def _character(ref: Column) -> Column:
    """The character of a reference without `&` and `;`; unknown names stay as they are."""
    code = F.when(ref.rlike("^#[xX]"), F.conv(F.substring(ref, 3, 6), 16, 10)).otherwise(F.substring(ref, 2, 7)).cast("int")
    code = F.when((code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF), code).otherwise(0xFFFD)
    numeric = F.decode(F.unhex(F.lpad(F.hex(code.cast("bigint")), 8, "0")), "UTF-32")
    named = F.try_element_at(F.from_json(F.lit(_NAMES), "map<string,string>"), ref)
    return F.when(F.startswith(ref, F.lit("#")), numeric).otherwise(F.coalesce(named, F.concat(F.lit("&"), ref, F.lit(";"))))


def _references(c: Column) -> Column:
    """Split around the references and put their characters between the parts."""
    chars = F.transform(F.regexp_extract_all(c, F.lit(REFERENCE), F.lit(1)), _character)
    woven = F.zip_with(F.split(c, REFERENCE), chars, lambda p, x: F.concat(p, F.coalesce(x, F.lit(""))))
    return F.array_join(woven, "")


def unescape(c: Column | str) -> Column:
    """Replace character references by their characters, each once."""

    def decode(x: Column) -> Column:
        return F.when(F.contains(x, F.lit("&")), _references(x)).otherwise(x)

    return _let(_col(c), decode)


def attribute(tag: Column | str, name: str) -> Column:
    """Value of an attribute in the text of an open tag, quoted or not, decoded; null if absent."""
    pattern = rf"""(?is)(?:^|[\s"']){name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    return _let(match(_col(tag), pattern), lambda q: unescape(F.regexp_replace(q, "^[\"']|[\"']$", "")))


EDGES = " \t\r\n\f\u000b\u00a0"


def text_of(markup: Column | str, gap: str = "") -> Column:
    """The text between tags: each piece stripped, empty ones dropped, joined by `gap`."""

    def strip(p: Column) -> Column:
        return F.btrim(unescape(p), F.lit(EDGES))

    def pieces(x: Column) -> Column:
        bare = F.when(F.contains(x, F.lit("<!--")), F.regexp_replace(x, r"(?s)<!--.*?-->", "")).otherwise(x)
        kept = F.filter(F.transform(F.split(bare, r"<[^>]*>"), strip), lambda p: p != "")
        return F.array_join(kept, gap)

    # Most cells are plain text.
    return _let(_col(markup), lambda x: F.when(F.contains(x, F.lit("<")), pieces(x)).otherwise(strip(x)))


SUP = r"(?is)<sup\b[^>]*>(.*?)</sup>"


def without_sup(c: Column | str) -> Column:
    """Visible text with footnote markers taken out."""
    marked = F.lower(_col(c)).contains("<sup")
    bare = F.when(marked, F.regexp_replace(_col(c), SUP, "<br>")).otherwise(_col(c))
    return squeeze(text_of(bare, " "))


def sup_marks(c: Column | str) -> Column:
    """The footnote markers of a cell, comma-joined; null if there are none."""
    found = F.lower(_col(c)).contains("<sup")
    marks = F.transform(F.regexp_extract_all(_col(c), F.lit(SUP), F.lit(1)), lambda m: text_of(m))
    return F.when(found, F.nullif(F.array_join(marks, ","), F.lit("")))


def keyword_hit(columns: list[Column], keywords: list[str]) -> Column:
    """True where any keyword occurs in the space-joined, lower-cased cells."""
    text = F.lower(F.concat_ws(" ", *[c.cast("string") for c in columns]))
    hit = F.lit(False)
    for k in keywords:
        hit = hit | F.contains(text, F.lit(k.lower()))
    return hit
