from cohortlens.plans import documents

PAGE = """
<table class="sc_plangrid">
<tr class="plangridyear"><th>First Year</th></tr>
<tr class="plangridterm"><th>Fall</th></tr>
<tr class="even"><td class="codecol"><a href="/search/?P=MATH%20151">MATH 151</a></td><td>Calc<sup>1</sup></td><td>4</td></tr>
<tr><td colspan="2">Select one of the following:</td><td>3-4</td></tr>
<tr><td><div class="blockindent"><a href="/search/?P=PHYS%20206">PHYS 206</a></div></td><td>Mech</td><td></td></tr>
<tr class="plangridterm"><th>Spring</th></tr>
<tr><td><div class="blockindent">X</div></td><td>T</td><td>3</td></tr>
<tr class="plangridsum"><td></td><td>Semester Credit Hours</td><td>15-16</td></tr>
</table>
<dl class="sc_footnotes"><dt>1</dt><dd>Grade of C or better.</dd></dl>
"""


def pages(spark, **html):
    return spark.createDataFrame(list(html.items()), "major string, html string")


def short(df):
    return [
        (r.row_order, r.row_type, r.year_label, r.term, r.choice_group_id, r.course_subject, r.course_number, r.credit_hours)
        for r in df.orderBy("major", "row_order").collect()
    ]


def test_sample_page(spark, rows):
    source = pages(spark, A=PAGE)
    plan = documents.parse_plans(source)
    assert short(plan) == [
        (0, "course", "First Year", "Fall", None, "MATH", "151", 4.0),
        (1, "choice_header", "First Year", "Fall", 1, None, None, 3.5),
        (2, "choice_option", "First Year", "Fall", 1, "PHYS", "206", None),
        (3, "choice_option", "First Year", "Spring", None, None, None, 3.0),
        (4, "term_subtotal", "First Year", "Spring", None, None, None, 15.5),
    ]
    assert plan.where("row_order = 0").first().footnote_refs == "1"
    assert rows(documents.parse_footnotes(source)) == [("A", "1", "Grade of C or better.")]
    maps = documents.footnote_maps(source)
    assert maps.first().footnotes == {"1": "Grade of C or better."}
    assert rows(documents.footnotes_to_rows(maps)) == [("A", "1", "Grade of C or better.")]


def test_several_pages(spark):
    source = pages(spark, A=PAGE, B=PAGE.replace("sc_plangrid", "other"), C="", D=PAGE + PAGE)
    plan = documents.parse_plans(source)
    assert {r.major: r["count"] for r in plan.groupBy("major").count().collect()} == {"A": 5, "D": 10}
    assert {r.major for r in documents.pages_without_rows(source, plan).collect()} == {"B", "C"}
    assert tuple(documents.plan_counts(plan).first()) == (15, 2)
    assert documents.preview(plan, 3).count() == 3
    # Numbering runs on across the tables of a page.
    assert [x[0] for x in short(plan.where("major = 'D'"))] == list(range(10))
    assert [x[4] for x in short(plan.where("major = 'D' and row_type = 'choice_header'"))] == [1, 2]


def test_odd_rows(spark):
    html = """<table class='x sc_plangrid'>
    <tr class="plangridyear"><td>no head cell</td></tr>
    <tr><th>only a head cell</th></tr>
    <tr><td>University Core<sup>2</sup><sup>3</sup></td><td>3</td></tr>
    <tr><td><div class="blockindent">csce 121H</div></td><td>Prog &amp; design</td><td>4</td></tr>
    <tr><td>CSCE 222/ECEN 222</td><td>Discrete<br>structures</td><td>TBD</td></tr>
    <tr><td><div class="blockindent">or</div></td><td>selected</td></tr>
    <tr class="plangridtotal"><td></td><td>Total</td><td>120</td></tr>
    <tr class="plangridtotal"><td>60</td></tr></table>"""
    out = documents.parse_plans(pages(spark, A=html)).orderBy("row_order").collect()
    assert [(r.row_type, r.choice_group_id, r.course_subject, r.title, r.footnote_refs) for r in out] == [
        ("requirement_block", 1, None, "University Core", "2,3"),
        ("choice_option", 1, "CSCE", "Prog & design", None),
        ("course", None, None, "Discrete structures", None),
        ("requirement_block", 2, None, "or", None),
        ("plan_total", None, None, "Total", None),
        ("plan_total", None, None, "Total", None),
    ]
    assert out[1].course_number == "121H" and out[2].course_code_raw == "CSCE 222/ECEN 222"
    assert all(r.year_label is None and r.term is None for r in out)


def test_footnotes_last_wins_and_short_lists(spark, rows):
    html = """<dl class="sc_footnotes"><dt>1</dt><dd>old</dd><dt></dt><dd>void</dd><dt>1</dt><dd>new <b>text</b></dd><dt>9</dt></dl>
    <dl class="sc_footnotes"><dt>7</dt><dd>second list</dd></dl>"""
    assert rows(documents.parse_footnotes(pages(spark, A=html))) == [("A", "1", "new text")]


PLAIN = (
    "<table class='sc_plangrid'><tr><td colspan='2'>Select one</td><td></td><td>3</td></tr>"
    "<tr><td><div class='blockindent'><a href='?P=A%201'>A 1</a></div></td><td>x</td><td></td></tr>"
    "<tr><td>B 2</td><td>{}</td><td>4</td></tr><tr><td>C 3</td><td>z</td><td>1</td></tr></table>"
)


def test_markup_as_browsers_take_it(spark):
    """Unquoted attributes, tables in cells and tables that are never closed give the rows of the plain page."""
    from cohortlens.plans import documents

    pages = {
        "plain": PLAIN.format("yq"),
        "bare": PLAIN.format("yq").replace("'sc_plangrid'", "sc_plangrid").replace("'2'", "2").replace("'blockindent'", "blockindent"),
        "nested": PLAIN.format("y<table class=inner><tr><td>q</td></tr></table>"),
        "open": PLAIN.format("yq").replace("</table>", "<p>end"),
        "later": "<table><tr><td>no</td></tr></table>" + PLAIN.format("yq") + "<table><tr><td>K 9</td><td>no</td><td>1</td></tr></table>",
    }
    df = spark.createDataFrame(list(pages.items()), "major string, html string")
    found = {}
    for r in documents.parse_plans(df).orderBy("major", "row_order").collect():
        found.setdefault(r.major, []).append(tuple(r)[1:])
    assert [r[4] for r in found["plain"]] == ["Select one", "x", "yq", "z"] or len(found["plain"]) == 4
    for name in ("bare", "open", "later"):
        assert found[name] == found["plain"], name
    titles = documents.PLAN_ROWS.fieldNames().index("title") - 1
    assert [r[titles].replace(" ", "") for r in found["nested"]] == [r[titles].replace(" ", "") for r in found["plain"]]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_are_numbered_without_a_shuffle(spark):
    plan = _plan(documents.parse_plans(pages(spark, A=PAGE)))
    assert "MapInArrow" in plan and "Window" not in plan and "Generate" not in plan


def test_pages_of_one_name_are_numbered_apart(spark):
    """Two pages with the same major do not run into each other."""
    source = spark.createDataFrame([("A", PAGE), ("A", PAGE), (None, PAGE)], "major string, html string")
    found = documents.parse_plans(source).where("major = 'A' OR major IS NULL").select("row_order", "choice_group_id").collect()
    assert sorted(r.row_order for r in found) == sorted(list(range(5)) * 3)
    assert {r.choice_group_id for r in found} == {None, 1}


def test_odd_markup(spark):
    """What the column functions gave: letters of all scripts in names of tags, bad references and escapes, rows that never end."""
    html = (
        "<TABLE class=sc_plangrid><tr><td>a<tdß 1></td><td>3</td><tr class=plangridsum><td><td>x<td>2 - 3.5"
        "<tr><td><a href='?q=1&amp;P=CSCE+222%zz'>A&nbsp;B &bogus;</a></td><td>&#xD800;<SUP>2<b>x</b></SUP></td><td>&#49;</td>"
    )
    found = documents.parse_plans(pages(spark, A=html)).orderBy("row_order").collect()
    assert [(r.row_type, r.course_code_raw, r.title, r.footnote_refs, r.credit_hours_raw, r.credit_hours) for r in found] == [
        ("requirement_block", None, "a", None, "3", 3.0),
        ("term_subtotal", None, "Semester Credit Hours", None, "2 - 3.5", 2.75),
        ("course", "A B &bogus;", "�", "2x", "1", 1.0),
    ]


def test_counts_preview_and_empty_pages_cut_no_cell_in_columns(spark):
    """What is made from the rows reads the walk alone."""
    source = pages(spark, A=PAGE, B="<p>")
    plan = documents.parse_plans(source)
    for df in (documents.plan_counts(plan), documents.preview(plan, 2), documents.pages_without_rows(source, plan)):
        text = _plan(df)
        assert "MapInArrow" in text and "Window" not in text and "regexp_extract_all" not in text
