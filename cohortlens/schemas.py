"""Schemas of the layers: raw text, typed sections, plan rows, results."""

from pyspark.sql import types as T

# Public names, types and order of columns.
GRID = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("table_idx", T.IntegerType()),
    T.StructField("row_idx", T.IntegerType()),
    T.StructField("cells", T.ArrayType(T.StringType())),
])

# SQL-safe names of the typed section layer.
COUNT_COLUMNS = ["A", "B", "C", "D", "F", "Total_A_F", "I", "S", "U", "Q", "X", "Total"]
PARTITION_COLUMNS = ["College", "Year", "Semester"]

PLAN_ROWS = T.StructType([
    T.StructField("major", T.StringType()),
    T.StructField("year_label", T.StringType()),
    T.StructField("term", T.StringType()),
    T.StructField("row_order", T.IntegerType()),
    T.StructField("row_type", T.StringType()),
    T.StructField("choice_group_id", T.LongType()),
    T.StructField("course_subject", T.StringType()),
    T.StructField("course_number", T.StringType()),
    T.StructField("course_code_raw", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("footnote_refs", T.StringType()),
    T.StructField("credit_hours_raw", T.StringType()),
    T.StructField("credit_hours_min", T.DoubleType()),
    T.StructField("credit_hours_max", T.DoubleType()),
    T.StructField("credit_hours", T.DoubleType()),
])

COURSE_KEY = ["course_subject", "course_number"]

COURSE_GPA = T.StructType([
    T.StructField("course_subject", T.StringType()),
    T.StructField("course_number", T.StringType()),
    T.StructField("mean_gpa", T.DoubleType()),
    T.StructField("n_students", T.LongType()),
])

COURSE_STATS = T.StructType([
    T.StructField("course_subject", T.StringType()),
    T.StructField("course_number", T.StringType()),
    T.StructField("mean_gpa", T.DoubleType()),
    T.StructField("fail_rate", T.DoubleType()),
    T.StructField("drop_rate", T.DoubleType()),
    T.StructField("n_students", T.LongType()),
])

GPA_METRICS = ["mean_gpa", "n_students"]
STAT_METRICS = ["mean_gpa", "fail_rate", "drop_rate", "n_students"]
