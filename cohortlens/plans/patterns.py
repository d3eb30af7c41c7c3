"""Patterns of the markup of plan pages."""

from __future__ import annotations

UNSEEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"


def with_class(tag: str, name: str) -> str:
    """Pattern of an open tag with a class, in quotes of either kind or none."""
    values = [rf"{q}(?:[^{q}]*\s)?{name}(?:\s[^{q}]*)?{q}" for q in "\"'"]
    return rf"""(?is)<{tag}\b[^>]*\sclass\s*=\s*(?:{values[0]}|{values[1]}|{name}(?=[\s>]))[^>]*>"""


GRID_OPEN = with_class("table", "sc_plangrid")
# An element ends at its end tag, or where the next of its kind or its parent's end is.
ROW = r"(?is)<tr\b[^>]*>.*?(?=</tr>|<tr\b|$)"
CELL = r"(?is)<td\b[^>]*>.*?(?=</td>|<td\b|<th\b|$)"
HEAD_CELL = r"(?is)<th\b[^>]*>.*?(?=</th>|<t[hd]\b|$)"
INDENT_OPEN = with_class("div", "blockindent")
LINK = r"(?is)<a\b([^>]*)>(.*?)(?:</a>|$)"
NOTES_OPEN = with_class("dl", "sc_footnotes")
