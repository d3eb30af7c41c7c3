"""Nested elements against a tree built by `html.parser`."""

import random
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from cohortlens.functions.elements import first_element, list_items
from cohortlens.plans import documents


class Tree(HTMLParser):
    """Items below the first footnote list and the text of each; the content of the first indent."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.items, self.indent, self.used, self.note = [], [], None, False, False

    def handle_starttag(self, tag, attrs):
        noted = ("class", "sc_footnotes") in attrs
        if tag == "dl" and noted and not self.note:
            self.note = True
            self.stack.append([tag, "root"])
        elif tag in ("dt", "dd") and any(s[1] == "root" for s in self.stack):
            # An item of the same list ends here.
            while self.stack[-1][0] not in ("dl",):
                self.stack.pop()
            item = [tag, []]
            self.items.append(item)
            self.stack.append([tag, item])
        elif tag in ("dl", "div", "b"):
            kind = "indent" if tag == "div" and ("class", "blockindent") in attrs and not self.used else None
            self.used |= kind == "indent"
            if kind:
                self.indent = []
            self.stack.append([tag, kind])

    def handle_endtag(self, tag):
        if any(s[0] == tag for s in self.stack):
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        for _, mark in self.stack:
            if isinstance(mark, list):
                mark[1].append(data)
            elif mark == "indent":
                self.indent.append(data)


def tree(html):
    t = Tree()
    t.feed(html)
    t.close()
    return t


def joined(parts):
    return " ".join(x for p in parts for x in [p.strip()] if x)


def random_list(rng, level=0):
    out = []
    for i in range(rng.randint(0, 3)):
        body = f"t{rng.randint(0, 99)} <b>x{i}</b> "
        if level < 2 and rng.random() < 0.4:
            body += f"<dl>{random_list(rng, level + 1)}</dl> after{i}"
        close = rng.random() < 0.7
        out.append(f"<DT class=a>{level}.{i}{'</dt>' if rng.random() < 0.7 else ''}<dd>{body}{'</dd>' if close else ''}")
    return "".join(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_list_items_equal_the_tree(spark, seed):
    rng = random.Random(seed)
    pages = [f"<p>a</p><dl><dt>no</dt></dl><dl class=\"sc_footnotes\">{random_list(rng)}</dl><dl><dt>9</dt><dd>z</dd></dl>" for _ in range(40)]
    pages += ["", "<dl class='sc_footnotes'>", "<dl class='sc_footnotes'><dt>1<dd>open to the end"]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    got = df.select("i", list_items(F.col("html"), "dl", documents.NOTES_OPEN, ("dt", "dd")).alias("items")).collect()
    for row in got:
        want = [(tag, joined(data)) for tag, data in tree(pages[row.i]).items]
        mine = [(r["tag"], joined([x for x in re.split(r"<[^>]*>", r["text"])])) for r in row["items"]]
        assert mine == want, pages[row.i]


def test_nested_footnotes(spark, rows):
    html = (
        '<dl class="sc_footnotes"><dt>1</dt><dd>Take one: <dl><dt>a</dt><dd>first</dd></dl> or ask.</dd>'
        "<dt>2</dt><dd>Last</dd></dl><dl><dt>3</dt><dd>other</dd></dl>"
    )
    got = documents.parse_footnotes(spark.createDataFrame([("M", html), ("N", None), ("O", "<p>")], "major string, html string"))
    assert rows(got) == [("M", "1", "Take one: a first or ask."), ("M", "2", "Last"), ("M", "a", "first")]


def test_first_element_keeps_what_is_nested(spark):
    cells = [
        '<div>no</div><div class="x blockindent">a<div>b</div>c</div>d', "<div class=blockindent></div>x", "<div>y</div>",
        "<DIV class='blockindent'>open <div>in</div> end", '<div class="blockindent">1</div><div class="blockindent">2</div>',
    ]
    df = spark.createDataFrame(list(enumerate(cells)), "i int, c string")
    got = [r[0] for r in df.orderBy("i").select(first_element(F.col("c"), "div", documents.INDENT_OPEN)).collect()]
    assert got == ["a<div>b</div>c", "", None, "open <div>in</div> end", "1"]
