"""The domain tables, derived by Spark from the TPC-H-like test tables.

lineitem = section, part = course, supplier = instructor, region = college,
customer = major; an order is a choice group (status O), a list of required
courses (F) or a requirement block (P).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.sections import split_section, sql_names, typed, with_file_fields
from .session import tune

# The renamed subject planted in the bridge plan.
ALIASES = {"ECON2": ["ECONOMY"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def facts(spark: SparkSession, sf_dir: str, name: str, columns: list[str], key: list[str]) -> DataFrame:
    """Columns of a fact table, dealt out to all cores by `key` if it has fewer splits than cores.

    A table in many files passes through unchanged.
    """
    df = table(spark, sf_dir, name).select(*columns)
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *key)


def _int(c: Column) -> Column:
    return c.cast("int")


def raw_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section rows as text, with the dirt a real extract has."""
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
    college = nation.join(F.broadcast(region), "r_regionkey").select(F.col("n_nationkey").alias("s_nationkey"), "r_name")
    # Nations are a fixed list; parts and suppliers are broadcast only if their files are small.
    supplier = (
        table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
        .join(F.broadcast(college), "s_nationkey")
    )
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    rows = facts(spark, sf_dir, "lineitem", [
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax", "l_discount",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ], ["l_partkey", "l_suppkey"])
    rows = rows.join(part, "l_partkey").join(supplier, "l_suppkey")

    line, key = F.col("l_linenumber"), F.col("l_partkey")
    qty, text = _int(F.col("l_quantity")), "string"
    q = F.when((F.col("l_returnflag") == "A") & (qty > 3), 1).otherwise(0)
    x = F.when((F.col("l_linestatus") == "O") & (line % 3 == 0) & (qty > 3), 1).otherwise(0)
    graded = F.when(qty % 10 == 0, 0).otherwise(qty - q - x)
    total = F.when(qty == 50, 0).otherwise(qty)
    tax = _int(F.round(F.col("l_tax") * 100))
    discount = _int(F.round(F.col("l_discount") * 100))
    g = _int(F.lit(400) - 20 * tax - key % 17)
    date = F.col("l_shipdate")
    return rows.select(
        F.concat(
            F.lit("grd_"), F.year(date).cast(text), F.lit("_"), (F.month(date) % 3 + 1).cast(text),
            F.lit("_"), F.replace(F.col("r_name"), F.lit(" "), F.lit("_")), F.lit(".pdf"),
        ).alias("source_file"),
        F.when((line == 7) & (key % 5 == 0), None)
        .when(key % 97 == 0, F.col("p_type"))
        .otherwise(F.concat_ws("-", "p_type", key.cast(text), (line + 500).cast(text)))
        .alias("Section"),
        _int(F.floor(discount * 5 * graded / 100)).cast(text).alias("A"),
        F.when(F.col("l_returnflag") == "R", F.least(graded, line)).otherwise(0).cast(text).alias("F"),
        graded.cast(text).alias("Total A-F"),
        F.when((line == 6) & (key % 3 == 0), "-------")
        .otherwise(F.concat(F.floor(g / 100).cast(text), F.lit("."), F.lpad((g % 100).cast(text), 2, "0")))
        .alias("GPA"),
        q.cast(text).alias("Q"),
        x.cast(text).alias("X"),
        total.cast(text).alias("Total"),
        F.concat(F.lit("1,"), F.lpad(total.cast(text), 3, "0")).alias("total_comma_raw"),
        F.col("s_name").alias("Instructor"),
    )


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed section layer; the college keeps the name of the region."""
    raw = raw_sections(spark, sf_dir).drop("total_comma_raw")
    return typed(sql_names(split_section(with_file_fields(raw))))


def plan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan rows of all majors: required courses, choice groups, requirement blocks."""
    major = F.concat(F.lit("M"), F.col("o_custkey").cast("string"))
    hours = F.when(F.col("o_orderkey") % 50 != 0, (1 + F.col("o_orderkey") % 4).cast("double"))
    status = F.col("o_orderstatus")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = facts(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey"], ["l_orderkey", "l_partkey"])
    lines = lines.withColumnRenamed("l_orderkey", "o_orderkey")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_name")

    listed = lines.join(orders.where(status.isin("O", "F")), "o_orderkey").join(part, "l_partkey")
    renamed = (F.col("p_type") == "ECONOMY") & (F.col("l_partkey") % 2 == 0)
    courses = listed.select(
        major.alias("major"),
        F.when(status == "O", "choice_option").otherwise("course").alias("row_type"),
        F.when(status == "O", F.col("o_orderkey")).alias("choice_group_id"),
        F.when(renamed, "ECON2").otherwise(F.col("p_type")).alias("course_subject"),
        F.col("l_partkey").cast("string").alias("course_number"),
        F.col("p_name").alias("title"),
        F.when(status == "F", hours).alias("credit_hours"),
    )
    heads = orders.where(status.isin("O", "P")).select(
        major.alias("major"),
        F.when(status == "O", "choice_header").otherwise("requirement_block").alias("row_type"),
        F.col("o_orderkey").alias("choice_group_id"),
        F.lit(None).cast("string").alias("course_subject"),
        F.lit(None).cast("string").alias("course_number"),
        F.when(status == "O", "Select one of the following:").otherwise("elective").alias("title"),
        hours.alias("credit_hours"),
    )
    return courses.unionByName(heads)


def plan_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One plan document per order, with every kind of row a plan grid has."""
    o = facts(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"], ["o_orderkey"])
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    text = "string"

    def course(letters: str, number: Column) -> Column:
        code = F.concat(F.lit(f"{letters} "), number.cast(text))
        link = F.concat(F.lit('<a href="/search/?x=1&amp;P='), F.replace(code, F.lit(" "), F.lit("%20")), F.lit('">'), code, F.lit("</a>"))
        return link

    def row(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    low = (key % 4 + 1).cast(text)
    orphan = F.when(
        key % 3 == 0,
        row('<tr class="plangridterm"><th>Spring</th></tr><tr><td><div class="blockindent">', course("phys", cust % 300 + 200),
            "</div></td><td>Late&nbsp; option</td><td></td></tr>"),
    ).otherwise("")
    html = row(
        '<html><body><!-- <table class="sc_plangrid"><tr><td>x</td><td>y</td><td>1</td></tr></table> -->',
        '<table class="sc_plangrid table"><tr class="plangridyear"><th>Year ', F.year("o_orderdate").cast(text),
        '</th></tr><tr class="plangridterm"><th>Fall</th></tr>',
        '<tr class="even"><td class="codecol">', course("MATH", cust % 400 + 100), "</td><td>",
        F.replace(F.col("o_orderpriority"), F.lit("-"), F.lit("&amp;")), "<sup>1</sup><sup>2</sup></td><td>", low, "</td></tr>",
        '<tr><td colspan="2">Select one of the following:</td><td></td><td>', low, "-", (key % 4 + 3).cast(text), "</td></tr>",
        '<tr class="odd"><td><div class="blockindent">', course("ENGL", cust % 300 + 200), "</div></td><td>Essay</td><td></td></tr>",
        '<tr><td><div class="blockindent">or by advice</div></td><td>Other</td><td></td></tr>',
        orphan,
        "<tr><td>Science elective<sup>3</sup></td><td>3</td></tr>",
        '<tr class="plangridsum"><td></td><td>Semester Credit Hours</td><td>', (key % 5 + 12).cast(text), "</td></tr>",
        '<tr class="plangridtotal"><td></td><td>Total Semester Credit Hours</td><td>120</td></tr></table>',
        '<dl class="sc_footnotes"><dt>1</dt><dd>Grade of <b>C</b> or better.</dd><dt></dt><dd>void</dd>',
        "<dt>2</dt><dd>old</dd><dt>2</dt><dd>Order ", key.cast(text), " &#8211; see adviser</dd><dt>9</dt></dl></body></html>",
    )
    return o.select(F.concat(F.lit("P"), key.cast(text)).alias("major"), html.alias("html"))


def raw_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted tables with blank outer columns, one table per ship month and line number."""
    rows = facts(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate"], ["l_orderkey", "l_partkey"])
    line, text = F.col("l_linenumber"), "string"
    cells = F.array(
        F.when(line % 2 == 0, "").otherwise(F.lit(" ")),
        F.when(line % 3 == 0, F.lit("  ")).otherwise(F.col("l_returnflag")),
        F.col("l_partkey").cast(text),
        F.when(F.col("l_quantity") < 10, "").otherwise(F.col("l_quantity").cast("int").cast(text)),
        F.when(line == 7, F.col("l_returnflag")).otherwise(""),
        F.lit(" "),
    )
    blank = F.transform(cells, lambda c: F.lit(" "))
    return rows.select(
        F.concat(F.lit("grd_"), F.year("l_shipdate").cast(text), F.lit("_1_EN.pdf")).alias("source_file"),
        line.alias("table_idx"),
        F.col("l_orderkey").cast("int").alias("row_idx"),
        # One table of the file is blank throughout.
        F.when(line == 5, blank).otherwise(cells).alias("cells"),
    )
