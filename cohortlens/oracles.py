"""The registered queries as SQL for DuckDB, written without the library's operators."""

from __future__ import annotations

from .catalog import NOMINAL, NUMERIC

# Character references in the test pages, apart from the library's own list.
ENTITIES = {
    "nbsp": "\u00a0", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "copy": "©", "middot": "·", "#8211": "–", "eacute": "é",
}

# Domain tables over the test tables.
RAW = """
sections_raw AS (
SELECT
  concat('grd_', CAST(year(l_shipdate) AS VARCHAR), '_', CAST(1 + month(l_shipdate) % 3 AS VARCHAR), '_', replace(r_name, ' ', '_'), '.pdf') AS source_file,
  CASE WHEN l_linenumber = 7 AND l_partkey % 5 = 0 THEN NULL
       WHEN l_partkey % 97 = 0 THEN p_type
       ELSE concat(p_type, '-', CAST(l_partkey AS VARCHAR), '-', CAST(500 + l_linenumber AS VARCHAR)) END AS section_raw,
  CAST(floor(disc_pct * 5 * graded / 100) AS BIGINT) AS a_cnt,
  CAST(CASE WHEN l_returnflag = 'R' THEN least(graded, l_linenumber) ELSE 0 END AS BIGINT) AS f_cnt,
  CAST(graded AS BIGINT) AS total_af,
  CASE WHEN l_linenumber = 6 AND l_partkey % 3 = 0 THEN '-------'
       ELSE concat(CAST(CAST(floor(g / 100) AS INT) AS VARCHAR), '.', lpad(CAST(g % 100 AS VARCHAR), 2, '0')) END AS gpa_raw,
  CAST(q_cnt AS BIGINT) AS q_cnt, CAST(x_cnt AS BIGINT) AS x_cnt, CAST(total AS BIGINT) AS total,
  concat('1,', lpad(CAST(total AS VARCHAR), 3, '0')) AS total_comma_raw,
  s_name AS instructor
FROM (SELECT *, CASE WHEN qty % 10 = 0 THEN 0 ELSE qty - q_cnt - x_cnt END AS graded,
             CASE WHEN qty = 50 THEN 0 ELSE qty END AS total,
             CAST(400 - 20 * tax_pct - l_partkey % 17 AS INT) AS g
      FROM (SELECT *, CASE WHEN l_returnflag = 'A' AND qty > 3 THEN 1 ELSE 0 END AS q_cnt,
                   CASE WHEN l_linestatus = 'O' AND l_linenumber % 3 = 0 AND qty > 3 THEN 1 ELSE 0 END AS x_cnt
            FROM (SELECT l.*, p_type, s_name, r_name, CAST(l_quantity AS INT) AS qty,
                         CAST(round(l_tax * 100) AS INT) AS tax_pct, CAST(round(l_discount * 100) AS INT) AS disc_pct
                  FROM lineitem l JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
                  JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey) t0) t1) t2)"""
S = RAW + """,
s AS (
SELECT source_file,
  trim(CASE WHEN section_raw LIKE '%-%' THEN regexp_extract(section_raw, '^(.*)-([^-]*)$', 1) ELSE section_raw END) AS "Class_Code",
  CASE WHEN section_raw LIKE '%-%' THEN nullif(trim(regexp_extract(section_raw, '^(.*)-([^-]*)$', 2)), '') END AS "Section",
  a_cnt AS "A", f_cnt AS "F", total_af AS "Total_A_F", TRY_CAST(gpa_raw AS DOUBLE) AS "GPA",
  q_cnt AS "Q", x_cnt AS "X", total AS "Total", instructor AS "Instructor",
  regexp_extract(source_file, '^grd_([^_]*)_([^_]*)_(.*)[.]pdf$', 1) AS "Year",
  CASE regexp_extract(source_file, '^grd_([^_]*)_([^_]*)_(.*)[.]pdf$', 2)
    WHEN '1' THEN 'Spring' WHEN '2' THEN 'Summer' WHEN '3' THEN 'Fall' END AS "Semester",
  regexp_extract(source_file, '^grd_([^_]*)_([^_]*)_(.*)[.]pdf$', 3) AS "College"
FROM sections_raw)"""
KEYED = S + """,
keyed AS (
SELECT *, upper(trim(regexp_extract("Class_Code", '^([^-]*)-(.*)$', 1))) AS course_subject,
          upper(trim(regexp_extract("Class_Code", '^([^-]*)-(.*)$', 2))) AS course_number
FROM s WHERE "Class_Code" LIKE '%-%' AND "Total" > 0),
gpa AS (
SELECT course_subject, course_number, sum("GPA" * "Total") / sum("Total") AS mean_gpa, CAST(sum("Total") AS BIGINT) AS n_students
FROM keyed WHERE "GPA" IS NOT NULL GROUP BY ALL),
stats AS (
SELECT course_subject, course_number,
       sum("GPA" * "Total") / nullif(sum(CASE WHEN "GPA" IS NOT NULL THEN "Total" END), 0) AS mean_gpa,
       CAST(sum("F") AS DOUBLE) / nullif(sum("Total_A_F"), 0) AS fail_rate,
       CAST(sum("Q") + sum("X") AS DOUBLE) / nullif(sum("Total"), 0) AS drop_rate,
       CAST(sum("Total") AS BIGINT) AS n_students
FROM keyed GROUP BY ALL)"""
PLAN = KEYED + """,
plan AS (
SELECT concat('M', o_custkey) AS major,
       CASE o_orderstatus WHEN 'O' THEN 'choice_option' ELSE 'course' END AS row_type,
       CASE o_orderstatus WHEN 'O' THEN o_orderkey END AS choice_group_id,
       CASE WHEN p_type = 'ECONOMY' AND p_partkey % 2 = 0 THEN 'ECON2' ELSE p_type END AS course_subject,
       CAST(p_partkey AS VARCHAR) AS course_number, p_name AS title,
       CASE WHEN o_orderstatus = 'F' AND o_orderkey % 50 <> 0 THEN CAST(1 + o_orderkey % 4 AS DOUBLE) END AS credit_hours
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey WHERE o_orderstatus IN ('O', 'F')
UNION ALL
SELECT concat('M', o_custkey), CASE o_orderstatus WHEN 'O' THEN 'choice_header' ELSE 'requirement_block' END,
       o_orderkey, NULL, NULL, CASE o_orderstatus WHEN 'O' THEN 'Select one of the following:' ELSE 'elective' END,
       CASE WHEN o_orderkey % 50 <> 0 THEN CAST(1 + o_orderkey % 4 AS DOUBLE) END
FROM orders WHERE o_orderstatus IN ('O', 'P'))"""


def _join_plan(source: str, metrics: list[str]) -> str:
    """Plan rows with metrics; the renamed subject falls back to its old name."""
    cols = ", ".join(
        f"CASE WHEN d.mean_gpa IS NULL AND p.course_subject = 'ECON2' THEN a.{m} ELSE d.{m} END AS {m}" for m in metrics
    )
    return f"""
SELECT p.*, {cols} FROM plan p
LEFT JOIN {source} d ON d.course_subject = p.course_subject AND d.course_number = p.course_number
LEFT JOIN {source} a ON p.course_subject = 'ECON2' AND a.course_subject = 'ECONOMY' AND a.course_number = p.course_number"""


GPA_METRICS = ["mean_gpa", "n_students"]
STAT_METRICS = ["mean_gpa", "fail_rate", "drop_rate", "n_students"]
G = PLAN + f""",
g AS ({_join_plan('gpa', GPA_METRICS)}),
opt AS (SELECT major, choice_group_id, avg(mean_gpa) AS mean_gpa, count(*) AS n_options, count(mean_gpa) AS n_matched
        FROM g WHERE row_type = 'choice_option' GROUP BY ALL),
units AS (
SELECT major, coalesce(credit_hours, 0) AS h, mean_gpa AS v FROM g WHERE row_type = 'course'
UNION ALL
SELECT x.major, coalesce(x.credit_hours, 0), o.mean_gpa FROM g x
LEFT JOIN opt o ON o.major = x.major AND o.choice_group_id = x.choice_group_id WHERE x.row_type = 'choice_header'),
majors AS (
SELECT m.major, sum(v * h) / nullif(sum(CASE WHEN v IS NOT NULL THEN h END), 0) AS expected_gpa,
       coalesce(sum(CASE WHEN v IS NOT NULL THEN h END), 0) AS matched_credit_hours,
       coalesce(sum(h), 0) AS total_course_credit_hours
FROM (SELECT DISTINCT major FROM plan) m LEFT JOIN units u ON u.major = m.major GROUP BY m.major),
ranking AS (
SELECT major, expected_gpa, matched_credit_hours, total_course_credit_hours,
       round_even(coalesce(matched_credit_hours / nullif(total_course_credit_hours, 0), 0) * 1000, 0) / 10 AS coverage_pct
FROM majors)"""
GROUPS = G + """,
heads AS (SELECT major, choice_group_id, coalesce(credit_hours, 0) AS hours FROM g WHERE row_type = 'choice_header'),
offers AS (
SELECT o.major, o.choice_group_id, o.course_subject, o.course_number, o.title, o.mean_gpa, h.hours,
       coalesce(o.mean_gpa, 0) * h.hours AS value,
       row_number() OVER (PARTITION BY o.major, o.choice_group_id
                          ORDER BY coalesce(o.mean_gpa, 0) * (h.hours > 0)::INT DESC, o.course_subject, o.course_number, o.title, o.mean_gpa) AS rn
FROM g o JOIN heads h ON h.major = o.major AND h.choice_group_id = o.choice_group_id WHERE o.row_type = 'choice_option'),
groups AS (
SELECT f.major, f.choice_group_id, f.hours, t.n_options, t.n_matched, f.course_subject, f.course_number, f.title, f.mean_gpa, f.value
FROM offers f JOIN opt t ON t.major = f.major AND t.choice_group_id = f.choice_group_id WHERE f.rn = 1)"""
# Groups that share a course with another group of their major are enumerated;
# all others take their best option.
BEST = GROUPS.replace("WITH", "", 1) + """,
keys AS (SELECT DISTINCT major, choice_group_id, concat(course_subject, chr(1), course_number) AS course, value FROM offers),
shared AS (SELECT major, course FROM keys GROUP BY ALL HAVING count(DISTINCT choice_group_id) > 1),
tangled AS (
SELECT major, choice_group_id, row_number() OVER (PARTITION BY major ORDER BY choice_group_id) AS idx
FROM (SELECT DISTINCT k.major, k.choice_group_id FROM keys k JOIN shared x ON x.major = k.major AND x.course = k.course) d),
steps AS (SELECT t.major, t.idx, k.course, k.value FROM tangled t JOIN keys k ON k.major = t.major AND k.choice_group_id = t.choice_group_id),
walk AS (
SELECT DISTINCT major, CAST(0 AS BIGINT) AS idx, CAST([] AS VARCHAR[]) AS used, CAST(0 AS DOUBLE) AS v FROM tangled
UNION ALL
SELECT w.major, w.idx + 1, list_append(w.used, x.course), w.v + x.value
FROM walk w JOIN steps x ON x.major = w.major AND x.idx = w.idx + 1 WHERE NOT list_contains(w.used, x.course)),
last_step AS (SELECT major, max(idx) AS n FROM tangled GROUP BY major),
solved AS (SELECT w.major, max(w.v) AS v FROM walk w JOIN last_step l ON l.major = w.major AND l.n = w.idx GROUP BY w.major),
free AS (
SELECT r.major, sum(r.value) AS v FROM groups r LEFT JOIN tangled t ON t.major = r.major AND t.choice_group_id = r.choice_group_id
WHERE t.idx IS NULL GROUP BY r.major),
fixed AS (SELECT major, sum(mean_gpa * coalesce(credit_hours, 0)) AS v, sum(coalesce(credit_hours, 0)) AS h
          FROM g WHERE row_type = 'course' AND mean_gpa IS NOT NULL GROUP BY major),
sums AS (SELECT major, count(*) AS n, sum(CASE WHEN n_matched > 0 THEN hours ELSE 0 END) AS h FROM groups GROUP BY major),
best AS (
SELECT m.major,
       (coalesce(f.v, 0) + coalesce(e.v, 0) + coalesce(x.v, 0)) / (coalesce(f.h, 0) + coalesce(c.h, 0)) AS optimal_expected_gpa,
       coalesce(f.h, 0) + coalesce(c.h, 0) AS matched_credit_hours, coalesce(c.n, 0) AS num_choice_groups
FROM (SELECT DISTINCT major FROM plan) m LEFT JOIN fixed f ON f.major = m.major LEFT JOIN sums c ON c.major = m.major
LEFT JOIN free e ON e.major = m.major LEFT JOIN solved x ON x.major = m.major LEFT JOIN last_step l ON l.major = m.major
WHERE coalesce(f.h, 0) + coalesce(c.h, 0) > 0 AND (l.n IS NULL OR x.v IS NOT NULL))"""
INDEX = PLAN + f""",
gs AS ({_join_plan('stats', STAT_METRICS)}),
per_group AS (SELECT major, choice_group_id, avg(mean_gpa) AS g, avg(fail_rate) AS f, avg(drop_rate) AS d
              FROM gs WHERE row_type = 'choice_option' AND mean_gpa IS NOT NULL GROUP BY ALL),
parts AS (
SELECT major, coalesce(credit_hours, 0) AS h, mean_gpa AS g, fail_rate AS f, drop_rate AS d FROM gs WHERE row_type = 'course' AND mean_gpa IS NOT NULL
UNION ALL
SELECT x.major, coalesce(x.credit_hours, 0), p.g, p.f, p.d FROM gs x
JOIN per_group p ON p.major = x.major AND p.choice_group_id = x.choice_group_id WHERE x.row_type = 'choice_header'),
rates AS (
SELECT m.major, sum(g * h) / nullif(sum(h), 0) AS expected_gpa, sum(coalesce(f, 0) * h) / nullif(sum(h), 0) AS avg_fail_rate,
       sum(coalesce(d, 0) * h) / nullif(sum(h), 0) AS avg_drop_rate, coalesce(sum(h), 0) AS matched_credit_hours
FROM (SELECT DISTINCT major FROM plan) m LEFT JOIN parts p ON p.major = m.major GROUP BY m.major),
moments AS (
SELECT avg(expected_gpa) AS mg, stddev_pop(expected_gpa) AS sg, avg(avg_fail_rate) AS mf, stddev_pop(avg_fail_rate) AS sf,
       avg(avg_drop_rate) AS md, stddev_pop(avg_drop_rate) AS sd FROM rates WHERE expected_gpa IS NOT NULL),
raw_score AS (
SELECT r.*, (mg - expected_gpa) / sg + (avg_fail_rate - mf) / sf + (avg_drop_rate - md) / sd AS raw FROM rates r, moments),
scored AS (
SELECT major, expected_gpa, avg_fail_rate, avg_drop_rate, matched_credit_hours,
       (raw - (SELECT min(raw) FROM raw_score)) / (SELECT max(raw) - min(raw) FROM raw_score) * 100 AS difficulty_score
FROM raw_score)"""
PREPARED = S + """,
prep AS (
SELECT "Section", CAST("Year" AS BIGINT) AS "Year", "A", "F", "Total_A_F", "GPA", "Q", "X", "Total",
       round_even("A" / nullif(CAST("Total_A_F" AS DOUBLE), 0) * 1000, 0) / 10 AS "Pct_A",
       round_even("Total_A_F" / nullif(CAST("Total" AS DOUBLE), 0) * 1000, 0) / 10 AS "Pct_graded",
       "Total" AS "Class_Size", "College", "Semester", "Instructor"
FROM s WHERE NOT regexp_matches(coalesce(lower("Section"), ''), 'total|page|instructor'))"""


def _pairs(columns: list[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]


def _long(columns: list[str], kind: str, table: str = "prep") -> str:
    """(col_a, col_b, x, y) for every pair of columns, both set."""
    rows = ", ".join(
        f"""{{'a': '{a}', 'b': '{b}', 'x': CAST("{a}" AS {kind}), 'y': CAST("{b}" AS {kind})}}""" for a, b in _pairs(columns)
    )
    return f"""SELECT p.a AS col_a, p.b AS col_b, p.x AS x, p.y AS y FROM (SELECT unnest([{rows}]) AS p FROM {table}) t
WHERE p.x IS NOT NULL AND p.y IS NOT NULL"""


def _q(columns: list[str]) -> str:
    return ", ".join(f'"{c}"' for c in columns)


PEARSON = "covar_pop(x, y) / nullif(sqrt(var_pop(x) * var_pop(y)), 0)"
RANKED = """ranked AS (
SELECT col_a, col_b, rank() OVER (PARTITION BY col_a, col_b ORDER BY x) + (count(*) OVER (PARTITION BY col_a, col_b, x) - 1) / 2.0 AS x,
       rank() OVER (PARTITION BY col_a, col_b ORDER BY y) + (count(*) OVER (PARTITION BY col_a, col_b, y) - 1) / 2.0 AS y FROM long)"""
NOMINAL4 = [*NOMINAL, "Section"]


def _filled(nominal: list[str], numeric: list[str]) -> str:
    parts = [f"""coalesce("{c}", '0.0') AS "{c}\"""" for c in nominal]
    parts += [f'coalesce(CAST("{c}" AS DOUBLE), 0) AS "{c}"' for c in numeric]
    return f"filled AS (SELECT {', '.join(parts)} FROM prep)"


def _theil(columns: list[str]) -> str:
    """CTE `theil`: U for ordered pairs, by conditional entropies."""
    both = ", ".join(
        f"""{{'a': '{a}', 'b': '{b}', 'x': "{a}", 'y': "{b}"}}""" for a in columns for b in columns if a != b
    )
    return f"""
tl AS (SELECT p.a AS col_a, p.b AS col_b, p.x AS x, p.y AS y FROM (SELECT unnest([{both}]) AS p FROM filled) t),
xy AS (SELECT col_a, col_b, x, y, count(*) AS n FROM tl GROUP BY ALL),
xy2 AS (SELECT *, sum(n) OVER (PARTITION BY col_a, col_b, y) AS ny, sum(n) OVER (PARTITION BY col_a, col_b) AS total FROM xy),
cond AS (SELECT col_a, col_b, sum(n / total * ln(ny / n)) AS h FROM xy2 GROUP BY ALL),
xs AS (SELECT col_a, col_b, x, sum(n) AS n FROM xy GROUP BY ALL),
own AS (SELECT col_a, col_b, -sum(n / total * ln(n / total)) AS h
        FROM (SELECT *, sum(n) OVER (PARTITION BY col_a, col_b) AS total FROM xs) z GROUP BY ALL),
theil AS (SELECT col_a, col_b, CASE WHEN own.h = 0 THEN 0 ELSE greatest(0, least(1, (own.h - cond.h) / own.h)) END AS r
          FROM own JOIN cond USING (col_a, col_b))"""


def _eta(nominal: list[str], numeric: list[str]) -> str:
    """CTE `eta`: correlation ratios, by group means around the overall mean."""
    rows = ", ".join(
        f"""{{'a': '{a}', 'b': '{b}', 'x': "{a}", 'y': "{b}"}}""" for a in nominal for b in numeric
    )
    return f"""
el AS (SELECT p.a AS col_a, p.b AS col_b, p.x AS x, p.y AS y FROM (SELECT unnest([{rows}]) AS p FROM filled) t),
lv AS (SELECT col_a, col_b, x, count(*) AS n, avg(y) AS m FROM el GROUP BY ALL),
al AS (SELECT col_a, col_b, avg(y) AS m, var_pop(y) * count(*) AS ss FROM el GROUP BY ALL),
eta AS (SELECT lv.col_a, lv.col_b, coalesce(sqrt(sum(n * (lv.m - al.m) ** 2) / nullif(any_value(al.ss), 0)), 0) AS r
        FROM lv JOIN al ON al.col_a = lv.col_a AND al.col_b = lv.col_b GROUP BY ALL)"""


def _round(columns: list[str], digits: int = 6) -> str:
    return ", ".join(f"{_r(c, digits)} AS {c}" for c in columns)


def _r(c: str, digits: int = 6) -> str:
    """Round half away from zero on nine exact decimals, as the library's `half_up`."""
    return f"CAST(round(CAST({c} AS DECIMAL(28, 9)), {digits}) AS DOUBLE)"


def _unescape(c: str) -> str:
    for name, char in ENTITIES.items():
        c = f"replace({c}, '&{name};', '{char.replace(chr(39), chr(39) * 2)}')"
    return f"replace({c}, '&amp;', '&')"


UNSEEN = r"""regexp_replace(html, '<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'gis')"""


def _text(markup: str, gap: str) -> str:
    pieces = f"string_split_regex({markup}, '<[^>]*>')"
    stripped = f"list_transform({pieces}, lambda p: regexp_replace({_unescape('p')}, '^[\\s\\x{{00a0}}]+|[\\s\\x{{00a0}}]+$', '', 'g'))"
    joined = f"array_to_string(list_filter({stripped}, lambda p: p <> ''), '{gap}')"
    return f"trim(regexp_replace({joined}, '[\\s\\x{{00a0}}]+', ' ', 'g'))"


COURSE_ROW = """SELECT concat('P', o_orderkey) AS major, concat('Year ', year(o_orderdate)) AS year_label, {term} AS term,
       CAST({order} AS INT) AS row_order, '{kind}' AS row_type, CAST({gid} AS BIGINT) AS choice_group_id,
       {subject} AS course_subject, {number} AS course_number, {raw} AS course_code_raw, {title} AS title, {marks} AS footnote_refs,
       {hours} AS credit_hours_raw, CAST({low} AS DOUBLE) AS credit_hours_min, CAST({high} AS DOUBLE) AS credit_hours_max,
       CAST(({low} + {high}) / 2.0 AS DOUBLE) AS credit_hours FROM orders {where}"""


def _plan_grid() -> str:
    late = "(o_orderkey % 3 = 0)::INT"
    spring = "CASE WHEN o_orderkey % 3 = 0 THEN 'Spring' ELSE 'Fall' END"

    def row(kind, order, term="'Fall'", gid="NULL", subject="NULL", number="NULL", raw="NULL", title="NULL",
            marks="NULL", hours="''", low="NULL", high="NULL", where=""):
        return COURSE_ROW.format(**locals())

    math, engl, phys = "o_custkey % 400 + 100", "o_custkey % 300 + 200", "o_custkey % 300 + 200"

    def num(n: str) -> str:
        return f"CAST({n} AS VARCHAR)"

    rows = [
        row("course", "0", subject="'MATH'", number=num(math), raw=f"concat('MATH ', {math})",
            title="replace(o_orderpriority, '-', '&')", marks="'1,2'", hours=num("o_orderkey % 4 + 1"),
            low="(o_orderkey % 4 + 1)", high="(o_orderkey % 4 + 1)"),
        row("choice_header", "1", gid="1", title="'Select one of the following:'",
            hours="concat(o_orderkey % 4 + 1, '-', o_orderkey % 4 + 3)", low="(o_orderkey % 4 + 1)", high="(o_orderkey % 4 + 3)"),
        row("choice_option", "2", gid="1", subject="'ENGL'", number=num(engl), raw=f"concat('ENGL ', {engl})", title="'Essay'"),
        row("choice_option", "3", gid="1", raw="'or by advice'", title="'Other'"),
        row("choice_option", "4", term="'Spring'", subject="'PHYS'", number=num(phys), raw=f"concat('phys ', {phys})",
            title="'Late option'", where="WHERE o_orderkey % 3 = 0"),
        row("requirement_block", f"4 + {late}", term=spring, gid="2", title="'Science elective'", marks="'3'", hours="'3'", low="3", high="3"),
        row("term_subtotal", f"5 + {late}", term=spring, title="'Semester Credit Hours'", hours=num("o_orderkey % 5 + 12"),
            low="(o_orderkey % 5 + 12)", high="(o_orderkey % 5 + 12)"),
        row("plan_total", f"6 + {late}", term=spring, title="'Total Semester Credit Hours'", hours="'120'", low="120", high="120"),
    ]
    return "\nUNION ALL\n".join(rows)


GRID = """
grid AS (
SELECT concat('grd_', year(l_shipdate), '_1_EN.pdf') AS source_file, l_linenumber AS table_idx,
       CASE WHEN l_linenumber % 3 <> 0 THEN l_returnflag END AS c1, CAST(l_partkey AS VARCHAR) AS c2,
       CASE WHEN l_quantity >= 10 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS c3,
       CASE WHEN l_linenumber = 7 THEN l_returnflag END AS c4
FROM lineitem WHERE l_linenumber <> 5),
ext AS (
SELECT source_file, table_idx,
       CASE WHEN count(c1) > 0 THEN 1 ELSE 2 END AS lo,
       CASE WHEN count(c4) > 0 THEN 4 WHEN count(c3) > 0 THEN 3 ELSE 2 END AS hi
FROM grid GROUP BY ALL),
fitted AS (
SELECT grid.source_file, grid.table_idx, list_slice([c1, c2, c3, c4], lo, hi) AS c
FROM grid JOIN ext ON ext.source_file = grid.source_file AND ext.table_idx = grid.table_idx)"""

FILES = """
SELECT d.source_file, d.n_rows,
  CASE WHEN bad THEN 'Unknown' WHEN college = 'EN' THEN 'Engineering' WHEN college = 'MD_PROF' THEN 'Medicine - Professional' ELSE college END AS "College",
  CASE WHEN bad THEN 'Unknown' ELSE y END AS "Year",
  CASE WHEN bad THEN 'Unknown' ELSE CASE sem WHEN '1' THEN 'Spring' WHEN '2' THEN 'Summer' WHEN '3' THEN 'Fall' END END AS "Semester"
FROM (
  SELECT source_file, count(*) AS n_rows, NOT starts_with(source_file, 'grd_') AS bad,
         upper(regexp_extract(source_file, '^grd_([^_]*)_([^_]*)_(.*)[.]pdf$', 3)) AS college,
         regexp_extract(source_file, '^grd_([^_]*)_([^_]*)_(.*)[.]pdf$', 1) AS y,
         regexp_extract(source_file, '^grd_([^_]*)_([^_]*)_(.*)[.]pdf$', 2) AS sem
  FROM (SELECT CASE WHEN contains(f, 'EUROPE') THEN replace(f, 'grd_', 'gpac_') ELSE f END AS source_file
        FROM (SELECT replace(replace(replace(source_file, 'AFRICA', 'en'), 'ASIA', 'md_prof'), 'AMERICA', 'zz_q') AS f FROM sections_raw) a) b
  GROUP BY source_file) d"""

WORK = """
span AS (SELECT min(year(l_shipdate)) AS lo, max(year(l_shipdate)) AS hi FROM lineitem),
work AS (
SELECT CAST(y AS INT) AS year, semester, report_type, college,
       concat('https://example.org/reports/', y, semester, '/', report_type, y, semester, college, '.pdf') AS url,
       concat('data/', CASE WHEN report_type = 'grd' THEN 'grd/' ELSE '' END, report_type, '_', y, '_', semester, '_', college, '.pdf') AS path
FROM (SELECT replace(r_name, ' ', '_') AS college FROM region) c,
     (SELECT unnest(range(lo, hi + 1)) AS y FROM span) t,
     (SELECT unnest([1, 2, 3]) AS semester) m, (SELECT unnest(['grd', 'gpad', 'gpac']) AS report_type) r),
present AS (SELECT concat('data/grd/', source_file) AS path, count(*) * 8 AS length FROM sections_raw GROUP BY source_file)"""


def _top_courses(direction: str) -> str:
    return f"""WITH {S}
SELECT class_code, weighted_gpa, n_students FROM (
  SELECT "Class_Code" AS class_code, CAST(round(CAST(sum("GPA" * "Total") / nullif(sum("Total"), 0) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS weighted_gpa,
         CAST(sum("Total") AS BIGINT) AS n_students
  FROM s WHERE "GPA" IS NOT NULL AND "Total" IS NOT NULL GROUP BY "Class_Code" HAVING sum("Total") >= 200) t
ORDER BY weighted_gpa {direction}, class_code LIMIT 10"""


def _rounded_mean(c: str) -> str:
    return f"""round_even(CAST(CAST(avg("{c}") AS DECIMAL(18, 9)) AS DOUBLE) * 100, 0) / 100"""


PLAN_COLUMNS = "major, row_type, choice_group_id, course_subject, course_number, title, credit_hours"

ORACLES: dict[str, str] = {
    "section_split": f'WITH {S} SELECT source_file, "Class_Code", "Section" FROM s',
    "numeric_coercion": f'WITH {PREPARED} SELECT "Section", {_q(NUMERIC)} FROM prep',
    "int_conversion": f"""WITH {RAW}
SELECT coalesce(CAST(trunc(TRY_CAST(replace(total_comma_raw, ',', '') AS DOUBLE)) AS BIGINT), -1) AS total_comma_raw,
       coalesce(CAST(trunc(TRY_CAST(gpa_raw AS DOUBLE)) AS BIGINT), -1) AS "GPA",
       coalesce(CAST(trunc(TRY_CAST(section_raw AS DOUBLE)) AS BIGINT), -1) AS "Section"
FROM sections_raw""",
    "keyword_filter": f"""WITH {RAW}
SELECT * FROM (SELECT source_file, section_raw AS "Section", CAST(a_cnt AS VARCHAR) AS "A", CAST(f_cnt AS VARCHAR) AS "F",
  CAST(total_af AS VARCHAR) AS "Total_A_F", gpa_raw AS "GPA", CAST(q_cnt AS VARCHAR) AS "Q", CAST(x_cnt AS VARCHAR) AS "X",
  CAST(total AS VARCHAR) AS "Total", instructor AS "Instructor" FROM sections_raw) t
WHERE NOT regexp_matches(lower(concat_ws(' ', source_file, "Section", "A", "F", "Total_A_F", "GPA", "Q", "X", "Total", "Instructor")), '%|total|promo-1|--')""",
    "grid_trim_pad": f"""WITH {GRID}
SELECT source_file, table_idx, c[1] AS c0, c[2] AS c1, c[3] AS column_2, c[4] AS column_3, 4 AS n_cells FROM fitted""",
    "grid_rows": f"""WITH {GRID}
SELECT source_file, table_idx, c[1] AS "Section", c[2] AS "A", c[3] AS "B", c[4] AS "C" FROM fitted""",
    "file_metadata": f"WITH {RAW} {FILES}",
    "header_row": """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier
UNION ALL SELECT '-1', 's_name', 's_nationkey'""",
    "aligned_append": f"""WITH {S}
SELECT "Class_Code", "Total", "GPA" FROM s WHERE "Total" >= 25 UNION ALL SELECT "Class_Code", "Total", NULL FROM s WHERE "Total" < 25""",
    "group_rollup": f"""WITH {S},
member AS (SELECT unnest(['SOUTH', 'SOUTH', 'EAST', 'EAST', 'WIDE', 'WIDE']) AS college_group,
                  unnest(['AFRICA', 'AMERICA', 'ASIA', 'MIDDLE_EAST', 'ASIA', 'AFRICA']) AS college),
joined AS (SELECT coalesce(m.college_group, 'OTHER') AS college_group, s."College" AS college, s."Total" AS t
           FROM s LEFT JOIN member m ON m.college = s."College")
SELECT college_group, college, count(*) AS n_sections, CAST(sum(t) AS BIGINT) AS n_students, CAST(grouping(college_group, college) AS INT) AS level
FROM joined GROUP BY ROLLUP (college_group, college)""",
    "kpi_summary": f"""WITH {S}
SELECT count(*) AS total_grade_rows, CAST(sum("Total") AS BIGINT) AS total_students_graded, count(DISTINCT "Class_Code") AS distinct_courses,
       min(TRY_CAST("Year" AS INT)) AS earliest_year, max(TRY_CAST("Year" AS INT)) AS latest_year FROM s WHERE TRY_CAST("Year" AS INT) IS NOT NULL""",
    "hardest_courses": _top_courses("ASC"),
    "easiest_courses": _top_courses("DESC"),
    "yearly_trend": f"""WITH {S}
SELECT TRY_CAST("Year" AS INT) AS "Year", CAST(round(CAST(sum("GPA" * "Total") / sum("Total") AS DECIMAL(28, 9)), 3) AS DOUBLE) AS weighted_gpa
FROM s WHERE "GPA" IS NOT NULL AND "Total" IS NOT NULL GROUP BY 1""",
    "course_gpa": f"WITH {KEYED} SELECT course_subject, course_number, {_round(['mean_gpa'])}, n_students FROM gpa",
    "course_stats": f"""WITH {KEYED}
SELECT course_subject, course_number, {_round(['mean_gpa', 'fail_rate', 'drop_rate'])}, n_students FROM stats""",
    "instructor_report": f"""WITH {PREPARED}
SELECT "Instructor", {_rounded_mean('GPA')} AS "GPA_mean", count("GPA") AS "GPA_count", CAST(sum("Total") AS BIGINT) AS "Total_sum",
       {_rounded_mean('Pct_A')} AS "Pct_A_mean", {_rounded_mean('Class_Size')} AS "Class_Size_mean"
FROM prep WHERE "Instructor" IS NOT NULL GROUP BY "Instructor" ORDER BY "GPA_mean" DESC NULLS LAST, "Instructor" LIMIT 20""",
    "plan_match": f"WITH {G} SELECT {PLAN_COLUMNS}, {_round(['mean_gpa'])}, n_students FROM g",
    "plan_match_stats": f"""WITH {INDEX}
SELECT {PLAN_COLUMNS}, {_round(['mean_gpa', 'fail_rate', 'drop_rate'])}, n_students FROM gs""",
    "choice_group_gpa": f"WITH {G} SELECT major, choice_group_id, {_round(['mean_gpa'])}, n_options, n_matched FROM opt",
    "major_expected_gpa": f"""WITH {G}
SELECT major, {_round(['expected_gpa', 'matched_credit_hours', 'total_course_credit_hours'])}, coverage_pct FROM ranking""",
    "low_coverage": f"""WITH {G}
SELECT major, {_round(['expected_gpa', 'matched_credit_hours', 'total_course_credit_hours'])}, coverage_pct FROM ranking WHERE coverage_pct < 80""",
    "difficulty_index": f"""WITH {INDEX}
SELECT major, {_round(['expected_gpa', 'avg_fail_rate', 'avg_drop_rate', 'matched_credit_hours', 'difficulty_score'])} FROM scored""",
    "best_option_relaxed": f"""WITH {GROUPS}
SELECT major, choice_group_id, hours, n_options, n_matched, course_subject, course_number, title, {_round(['mean_gpa'])} FROM groups""",
    "option_conflicts": f"""WITH {GROUPS}
SELECT major, course_subject, course_number, count(*) AS n_groups FROM groups GROUP BY ALL HAVING count(*) > 1""",
    "optimal_plan": f"""WITH RECURSIVE {BEST}
SELECT major, {_round(['optimal_expected_gpa', 'matched_credit_hours'])}, num_choice_groups FROM best""",
    "optimal_selections": f"""WITH RECURSIVE {BEST},
paths AS (
SELECT w.major, w.used FROM walk w JOIN last_step l ON l.major = w.major AND l.n = w.idx
QUALIFY row_number() OVER (PARTITION BY w.major ORDER BY round(w.v, 9) DESC, w.used) = 1),
picked AS (
SELECT o.major, o.choice_group_id, o.course_subject, o.course_number, o.title, o.mean_gpa
FROM paths p JOIN tangled t ON t.major = p.major JOIN offers o ON o.major = t.major AND o.choice_group_id = t.choice_group_id
 AND concat(o.course_subject, chr(1), o.course_number) = list_extract(p.used, t.idx)
QUALIFY row_number() OVER (PARTITION BY o.major, o.choice_group_id ORDER BY o.title NULLS FIRST, o.mean_gpa NULLS FIRST) = 1
UNION ALL
SELECT r.major, r.choice_group_id, r.course_subject, r.course_number, r.title, r.mean_gpa
FROM groups r LEFT JOIN tangled t ON t.major = r.major AND t.choice_group_id = r.choice_group_id WHERE t.idx IS NULL)
SELECT p.major, p.choice_group_id, course_subject, course_number, title, {_r('mean_gpa')} AS mean_gpa
FROM picked p SEMI JOIN best b ON b.major = p.major""",
    "optimizer_comparison": f"""WITH RECURSIVE {BEST}
SELECT b.major, {_r('optimal_expected_gpa')} AS optimal_expected_gpa, {_r('b.matched_credit_hours')} AS matched_credit_hours, num_choice_groups,
       {_r('r.expected_gpa')} AS baseline_expected_gpa, {_r('optimal_expected_gpa - r.expected_gpa')} AS gpa_uplift
FROM best b LEFT JOIN ranking r ON r.major = b.major""",
    "pearson_matrix": f"""WITH {PREPARED}, long AS ({_long(NUMERIC, 'DOUBLE')})
SELECT col_a, col_b, {_r(PEARSON)} AS r, count(*) AS n FROM long GROUP BY col_a, col_b""",
    "spearman_matrix": f"""WITH {PREPARED}, long AS ({_long(NUMERIC, 'DOUBLE')}), {RANKED}
SELECT col_a, col_b, {_r(PEARSON)} AS r, count(*) AS n FROM ranked GROUP BY col_a, col_b""",
    "spearman_top_pairs": f"""WITH {PREPARED}, long AS ({_long(NUMERIC, 'DOUBLE')}), {RANKED},
rho AS (SELECT col_a, col_b, round_even({PEARSON} * 1000, 0) / 1000 AS r FROM ranked GROUP BY col_a, col_b)
SELECT col_a, col_b, r, abs(r) AS abs_r FROM rho WHERE abs(r) > 0.4 AND abs(r) < 1 ORDER BY abs_r DESC, col_a, col_b LIMIT 15""",
    "kendall_tau_b": f"""WITH {PREPARED}, long AS ({_long(['A', 'F', 'GPA', 'Total'], 'DOUBLE')}),
cells AS (SELECT col_a, col_b, x, y, count(*) AS n FROM long GROUP BY ALL),
balance AS (SELECT p.col_a, p.col_b, sum(CAST(p.n AS DOUBLE) * q.n * sign(p.y - q.y)) AS v
            FROM cells p JOIN cells q ON q.col_a = p.col_a AND q.col_b = p.col_b AND q.x < p.x GROUP BY ALL),
sizes AS (SELECT col_a, col_b, CAST(sum(n) AS DOUBLE) AS n FROM cells GROUP BY ALL),
tx AS (SELECT col_a, col_b, sum(CAST(n AS DOUBLE) * (n - 1) / 2) AS t FROM (SELECT col_a, col_b, x, sum(n) AS n FROM cells GROUP BY ALL) z GROUP BY ALL),
ty AS (SELECT col_a, col_b, sum(CAST(n AS DOUBLE) * (n - 1) / 2) AS t FROM (SELECT col_a, col_b, y, sum(n) AS n FROM cells GROUP BY ALL) z GROUP BY ALL)
SELECT col_a, col_b, {_r('v / nullif(sqrt((n * (n - 1) / 2 - tx.t) * (n * (n - 1) / 2 - ty.t)), 0)')} AS r, CAST(n AS BIGINT) AS n
FROM sizes LEFT JOIN balance USING (col_a, col_b) JOIN tx USING (col_a, col_b) JOIN ty USING (col_a, col_b)""",
    "theils_u": f"WITH {PREPARED}, {_filled(NOMINAL4, [])}, {_theil(NOMINAL4)} SELECT col_a, col_b, {_round(['r'])} FROM theil",
    "correlation_ratio": f"WITH {PREPARED}, {_filled(NOMINAL, NUMERIC)}, {_eta(NOMINAL, NUMERIC)} SELECT col_a, col_b, {_round(['r'])} FROM eta",
    "mixed_associations": f"""WITH {PREPARED}, {_filled(NOMINAL4, NUMERIC)}, {_theil(NOMINAL4)}, {_eta(NOMINAL4, NUMERIC)},
long AS ({_long(NUMERIC, 'DOUBLE', 'filled')}), pear AS (SELECT col_a, col_b, {PEARSON} AS r FROM long GROUP BY col_a, col_b),
parts AS (
SELECT col_a, col_b, 'theils_u' AS measure, r FROM theil
UNION ALL SELECT col_a, col_b, 'correlation_ratio', r FROM eta UNION ALL SELECT col_b, col_a, 'correlation_ratio', r FROM eta
UNION ALL SELECT col_a, col_b, 'pearson', r FROM pear UNION ALL SELECT col_b, col_a, 'pearson', r FROM pear)
SELECT col_a, col_b, measure, {_r('r')} AS value FROM parts""",
    "chi2_contingency": f"""WITH {PREPARED}, long AS ({_long([*NOMINAL4, *NUMERIC], 'VARCHAR')}),
cells AS (SELECT col_a, col_b, x, y, CAST(count(*) AS DOUBLE) AS n FROM long GROUP BY ALL),
xs AS (SELECT col_a, col_b, x, sum(n) AS n FROM cells GROUP BY ALL), ys AS (SELECT col_a, col_b, y, sum(n) AS n FROM cells GROUP BY ALL),
total AS (SELECT col_a, col_b, sum(n) AS n FROM cells GROUP BY ALL),
fits AS (SELECT xs.col_a, xs.col_b, coalesce(c.n, 0) AS o, xs.n * ys.n / t.n AS e
  FROM xs JOIN ys ON ys.col_a = xs.col_a AND ys.col_b = xs.col_b JOIN total t ON t.col_a = xs.col_a AND t.col_b = xs.col_b
  LEFT JOIN cells c ON c.col_a = xs.col_a AND c.col_b = xs.col_b AND c.x = xs.x AND c.y = ys.y)
SELECT f.col_a, f.col_b, {_r('f.chi2')} AS chi2, (la - 1) * (lb - 1) AS dof, CAST(t.n AS BIGINT) AS n, la AS levels_a, lb AS levels_b
FROM (SELECT col_a, col_b, sum((o - e) ** 2 / e) AS chi2 FROM fits GROUP BY ALL) f JOIN total t USING (col_a, col_b)
JOIN (SELECT col_a, col_b, count(*) AS la FROM xs GROUP BY ALL) a USING (col_a, col_b)
JOIN (SELECT col_a, col_b, count(*) AS lb FROM ys GROUP BY ALL) b USING (col_a, col_b)""",
    "plan_grid_parse": _plan_grid(),
    "plan_footnotes": """
SELECT concat('P', o_orderkey) AS major, '1' AS footnote_num, 'Grade of C or better.' AS footnote_text FROM orders
UNION ALL SELECT concat('P', o_orderkey), '2', concat('Order ', o_orderkey, ' – see adviser') FROM orders""",
    "page_outline": f"""WITH marked AS (
SELECT page_id, regexp_replace(regexp_replace({UNSEEN}, '<(h1|p|li)\\b[^>]*>', chr(1) || '\\1' || chr(2), 'gi'), '</(h1|p|li)>', chr(3), 'gi') AS m FROM pages),
parts AS (SELECT page_id, unnest(string_split(m, chr(1))[2:]) AS part, generate_subscripts(string_split(m, chr(1))[2:], 1) AS pos FROM marked),
items AS (SELECT page_id, pos, lower(string_split(part, chr(2))[1]) AS kind,
                 {_text("string_split(string_split(part, chr(2))[2], chr(3))[1]", " ")} AS text FROM parts)
SELECT page_id, CAST(pos - 1 AS INT) AS item_order, kind,
       last_value(CASE WHEN kind = 'h1' THEN text END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading,
       CAST(sum((kind = 'p')::INT) OVER (PARTITION BY page_id ORDER BY pos) AS BIGINT) AS block_no, text
FROM items""",
    "page_links": f"""WITH links AS (
SELECT page_id, unnest(regexp_extract_all({UNSEEN}, '(?is)<a\\b[^>]*>.*?(?:</a>|$)')) AS a,
       generate_subscripts(regexp_extract_all({UNSEEN}, '(?is)<a\\b[^>]*>.*?(?:</a>|$)'), 1) AS pos FROM pages)
SELECT page_id, CAST(pos - 1 AS INT) AS link_no, {_unescape("regexp_extract(a, 'href=\"([^\"]*)\"', 1)")} AS href,
       {_text("regexp_replace(a, '</a>$', '', 'i')", "")} AS text FROM links""",
    "url_values": """SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), '') AS value,
       nullif(regexp_extract(url, '[?&]ref=([^&#]+)', 1), '') AS ref FROM pages""",
    "slugify": """SELECT name, lower(trim(regexp_replace(name, '[^\\p{L}\\p{N}]', '_', 'g'), '_')) AS slug
FROM (SELECT p_name AS name FROM part UNION ALL SELECT concat('# ', s_name, ' - BS ') FROM supplier) t""",
    "work_grid": f"WITH {WORK.replace('present AS', 'unused AS').replace('FROM sections_raw', 'FROM (SELECT NULL AS source_file) z')} SELECT * FROM work",
    "pending_files": f"""WITH {RAW}, {WORK}
SELECT w.* FROM work w LEFT JOIN present p ON p.path = w.path AND p.length >= 2048 WHERE p.path IS NULL""",
    "file_tally": f"""WITH {RAW}, {WORK}
SELECT CASE WHEN p.length >= 2048 THEN 'present' WHEN p.length IS NOT NULL THEN 'too small' ELSE 'missing' END AS status, count(*) AS n
FROM work w LEFT JOIN present p ON p.path = w.path GROUP BY 1""",
    "partitioned_export": f"""WITH {S}
SELECT "College", "Year", "Semester", count(*) AS n_rows, CAST(sum("Total") AS BIGINT) AS students, count(DISTINCT "Class_Code") AS n_courses
FROM s GROUP BY ALL""",
    "exported_index_report": f"""WITH {INDEX}
SELECT major, {_round(['expected_gpa', 'avg_fail_rate', 'avg_drop_rate', 'difficulty_score'])} FROM scored""",
    "stream_ingest": f"""WITH {S}
SELECT "College", "Year", count(*) AS n_rows, CAST(sum("Total") AS BIGINT) AS students, count("GPA") AS n_gpa FROM s GROUP BY ALL""",
    "events_running_mean": f"""
SELECT user_id, {_r('sum(value * (event_id % 5 + 1)) / sum(event_id % 5 + 1)')} AS mean,
       CAST(sum(event_id % 5 + 1) AS BIGINT) AS weight, count(*) AS n FROM events GROUP BY user_id""",
}

# Queries that take another road to a result known from above.
ORACLES |= {
    "append_table": ORACLES["aligned_append"],
    "replace_table": f"""WITH {S} SELECT "Instructor", "Total", "Class_Code" FROM s WHERE "Total" < 25""",
    "export_by_major": f"""WITH {PLAN}
SELECT major, count(*) AS n_rows, {_r('sum(credit_hours)')} AS credit_hours FROM plan GROUP BY major""",
    "course_tables": f"""WITH {KEYED}
SELECT s.course_subject, s.course_number, {_r('s.mean_gpa')} AS mean_gpa, {_r('s.fail_rate')} AS fail_rate, {_r('s.drop_rate')} AS drop_rate,
       s.n_students, {_r('g.mean_gpa')} AS gpa, g.n_students AS graded
FROM stats s LEFT JOIN gpa g ON g.course_subject = s.course_subject AND g.course_number = s.course_number""",
    "optimize_all_majors": ORACLES["optimal_plan"],
    "pearson_by_type": ORACLES["pearson_matrix"],
    "footnote_maps": ORACLES["plan_footnotes"],
    "empty_pages": "SELECT concat('N', r_regionkey) AS major FROM region",
    "plan_counts": f"SELECT count(*) AS n_rows, count(DISTINCT major) AS n_majors FROM ({_plan_grid()}) g",
    "plan_preview": f"SELECT * FROM ({_plan_grid()}) g ORDER BY major, row_order LIMIT 30",
    "stream_rejects": "SELECT concat('broken_', r_regionkey, '.parquet') AS name, strlen(r_name) AS length, 'unreadable' AS reason FROM region",
    "report_expected_gpa": f"""WITH {G} SELECT major, {_round(['expected_gpa', 'matched_credit_hours'])}, coverage_pct FROM ranking""",
    "report_optimizer_comparison": f"""SELECT major, baseline_expected_gpa, optimal_expected_gpa, gpa_uplift, num_choice_groups
FROM ({ORACLES["optimizer_comparison"]}) c""",
    "report_optimizer_selections": f"""SELECT major, course_subject, course_number, title, mean_gpa FROM ({ORACLES["optimal_selections"]}) c""",
    "report_kpis": ORACLES["kpi_summary"],
    "report_hardest_courses": ORACLES["hardest_courses"],
    "report_easiest_courses": ORACLES["easiest_courses"],
    "report_yearly_trend": ORACLES["yearly_trend"],
}
