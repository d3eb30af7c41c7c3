"""Sharding by longest-processing-time scheduling.

Documents of equal text form a group that stays together. Groups go, the largest
first, each to the shard with the least bytes so far (of equal ones the first),
which a heap finds. The law that holds is `bytes`: loads differ by the size of a
group at most, but for shards that a group larger than their share fills alone.

Groups of one size are alike, so the schedule needs no list of groups, only how
many there are of each size. Sizes beyond `DIGITS` binary digits are taken as one
with their neighbours of the same leading digits (they differ by one part in 2,048
at most and count with their mean), so there are at most 2,048 classes for each
doubling of the size: under 100,000 for any input. That table alone reaches the
driver. Spark numbers the groups of each class and the rows of each group: a class
is cut into buckets by key, a group into salts by document id, so no task holds
a class or a group as a whole, whatever its size. A shard's rows are numbered in the
order of class, key and id.

Null texts count as empty and share the group of empty ones (8 bytes). Rows with a
null id are rows like others. Repeated rows of one id and text are counted, then
numbered one by one. An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .texts import kept, texts

SHARDS = 24
EXTRA = 8  # bytes a row needs besides its text
DIGITS = 12
# Parts that the groups of all classes, and the copies of one group, are cut into.
PARTS = 2048


def _dealt(loads: list[int], size: int, count: int) -> list[int]:
    """How many of `count` groups of one size each shard gets; `loads` are raised."""
    n = len(loads)
    got = [0] * n
    if count > 4 * n and size > 0:
        if max(loads) - min(loads) >= size:
            # The heap pops loads in rising order: all below a level that leaves fewer than one round.
            low, high = min(loads), max(loads) + size * (count // n + 1)
            while low < high:
                level = (low + high + 1) // 2
                if sum(max(0, -((x - level) // size)) for x in loads) <= count:
                    low = level
                else:
                    high = level - 1
            got = [max(0, -((x - low) // size)) for x in loads]
        else:
            got = [count // n] * n
        for i in range(n):
            loads[i] += got[i] * size
        count -= sum(got)
    heap = [(x, i) for i, x in enumerate(loads)]
    heapq.heapify(heap)
    for _ in range(count):
        x, i = heap[0]
        heapq.heapreplace(heap, (x + size, i))
        loads[i] += size
        got[i] += 1
    return got


def schedule(classes: Iterable[tuple[int, int]], shards: int = SHARDS) -> list[list[int]]:
    """How many groups of each class (size, number of groups; largest first) each shard gets."""
    loads = [0] * shards
    return [_dealt(loads, size, count) for size, count in classes]


def _class(size: Column, digits: int) -> Column:
    """The size with all but its leading binary digits zero."""
    below = F.greatest(F.length(F.bin(size)) - digits, F.lit(0))
    unit = F.pow(F.lit(2.0), below).cast("long")
    return size - size % unit


def _leading(key: Column, parts: Column) -> Column:
    """The part of the range of hexadecimal keys that a key lies in, from 0."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * parts / F.lit(float(2**32))).cast("int")


def _salt(doc_id: Column) -> Column:
    return _leading(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")), F.lit(PARTS))


def _table(spark: SparkSession, rows: list[tuple], dealt: list[list[int]], parts: float) -> DataFrame:
    """Per class: in how many buckets it is cut, and the ranks that each shard's groups end before."""
    ends = [np.cumsum(got).tolist() for got in dealt]
    out = [(c, -(-int(n) // max(1, int(parts))), e) for (c, _, n), e in zip(rows, ends)]
    return spark.createDataFrame(out, "class long, buckets int, ends array<long>")


def shards(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """Per document: `doc_id`, `size`, `text_crc32`, `law`, `shard`, `slot`, `grown_shard` (null under this law)."""
    spark = docs.sparkSession
    text = F.col("text")
    rows = texts(docs).select(
        "doc_id", (F.octet_length(text) + EXTRA).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"),
        F.sha2(text.cast("binary"), 256).alias("key"), _salt(F.col("doc_id")).alias("salt"),
    )
    # Rows equal in id and text are one line with their number.
    lines = kept(rows.groupBy("key", "salt", "doc_id", "size", "crc").agg(F.count(F.lit(1)).alias("n")))
    salted = kept(lines.groupBy("key", "salt").agg(F.sum("n").alias("n"), F.first("size").alias("size")))
    groups = kept(
        salted.groupBy("key").agg(F.sum("n").alias("copies"), F.first("size").alias("size"))
        .withColumn("total", F.col("copies") * F.col("size")).withColumn("class", _class(F.col("total"), DIGITS))
    )
    classes = groups.groupBy("class").agg(F.sum("total").alias("bytes"), F.count(F.lit(1)).alias("n"))
    # At most 2**DIGITS rows and 2**(DIGITS - 1) for each doubling beyond.
    found = sorted(((r["class"], r["bytes"] // r["n"], r["n"]) for r in classes.collect()), reverse=True)
    dealt = schedule(((size, n) for _, size, n in found), n_shards)
    plan = _table(spark, found, dealt, sum(n for *_, n in found) / PARTS)

    # The number of each group in its class: buckets are ranges of keys.
    placed = groups.join(F.broadcast(plan), "class").withColumn("bucket", _leading(F.col("key"), F.col("buckets")))
    before = (Window.unboundedPreceding, -1)
    filled = placed.groupBy("class", "bucket").agg(F.count(F.lit(1)).alias("n"))
    start = filled.select("class", "bucket", F.coalesce(
        F.sum("n").over(Window.partitionBy("class").orderBy("bucket").rowsBetween(*before)), F.lit(0)).alias("start"))
    inside = Window.partitionBy("class", "bucket").orderBy("key")
    rank = F.col("start") + F.row_number().over(inside) - 1
    ranked = kept(
        placed.join(start, ["class", "bucket"]).withColumn("rank", rank)
        .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("rank"))))
        .select("key", "copies", "class", "bucket", "shard", "rank")
    )
    # Where the rows of each group begin in its shard: within its bucket, and before it.
    units = ranked.groupBy("shard", "class", "bucket").agg(F.sum("copies").alias("n"))
    in_shard = Window.partitionBy("shard").orderBy(F.col("class").desc(), "bucket").rowsBetween(*before)
    starts = units.select("shard", "class", "bucket", F.coalesce(F.sum("n").over(in_shard), F.lit(0)).alias("unit_slot"))
    in_unit = Window.partitionBy("shard", "class", "bucket").orderBy("rank").rowsBetween(*before)
    group_slots = ranked.join(starts, ["shard", "class", "bucket"]).select(
        "key", "shard", (F.col("unit_slot") + F.coalesce(F.sum("copies").over(in_unit), F.lit(0))).alias("group_slot")
    )
    # A group has at most PARTS salts, a salt of one group few of all rows.
    over_salts = Window.partitionBy("key").orderBy("salt").rowsBetween(*before)
    salt_slots = salted.select("key", "salt", F.coalesce(F.sum("n").over(over_salts), F.lit(0)).alias("salt_slot"))
    bases = salt_slots.join(group_slots, "key").select(
        "key", "salt", "shard", (F.col("group_slot") + F.col("salt_slot")).alias("base")
    )
    in_salt = Window.partitionBy("key", "salt").orderBy(F.col("doc_id").asc_nulls_first()).rowsBetween(*before)
    numbered = lines.withColumn("line_slot", F.coalesce(F.sum("n").over(in_salt), F.lit(0)))
    first = F.col("base") + F.col("line_slot")
    return numbered.join(bases, ["key", "salt"]).select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), F.col("shard").cast("int"),
        F.explode(F.sequence(first, first + F.col("n") - 1)).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


# The heap as a recursion over the groups, the largest class first; CRC-32 by the rule of its table.
ORACLE = f"""
WITH RECURSIVE bits AS (
  SELECT b, b AS c, 0 AS step FROM range(256) AS r(b)
  UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, step + 1 FROM bits WHERE step < 8
), codes AS (
  SELECT list(c ORDER BY b) AS code FROM bits WHERE step = 8
), lines AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(strlen(coalesce(text, '')) + {EXTRA} AS BIGINT) AS size, sha256(coalesce(text, '')) AS key,
    ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8))::BIGINT * {PARTS} // 4294967296 AS salt
  FROM documents
), groups AS (
  SELECT key, count(*) * any_value(size) AS total, any_value(text) AS text FROM lines GROUP BY key
), summed AS (
  SELECT key, xor(4294967295, list_reduce([4294967295::BIGINT] ||
    [('0x' || substr(h, 2 * i - 1, 2))::BIGINT FOR i IN range(1, length(h) // 2 + 1)],
    lambda acc, b: xor(acc // 256, code[xor(acc, b) % 256 + 1]))) AS crc
  FROM (SELECT key, hex(encode(text)) AS h FROM groups), codes
), classed AS (
  SELECT key, total, total - total % CAST(pow(2, greatest(length(bin(total)) - {DIGITS}, 0)) AS BIGINT) AS class FROM groups
), means AS (
  SELECT class, CAST(sum(total) AS BIGINT) // count(*) AS mean FROM classed GROUP BY class
), steps AS (
  SELECT row_number() OVER (ORDER BY class DESC, key) AS k, class, mean FROM classed JOIN means USING (class)
), dealt AS (
  SELECT 0::BIGINT AS k, CAST([0 FOR i IN range({SHARDS})] AS BIGINT[]) AS loads, 0::BIGINT AS shard
  UNION ALL
  SELECT s.k, list_transform(d.loads, lambda x, i: CASE WHEN i = list_position(d.loads, list_min(d.loads)) THEN x + s.mean ELSE x END),
    list_position(d.loads, list_min(d.loads)) - 1
  FROM dealt d JOIN steps s ON s.k = d.k + 1
), ranked AS (
  SELECT class, shard, row_number() OVER (PARTITION BY class ORDER BY shard) AS r FROM dealt JOIN steps USING (k)
), placed AS (
  SELECT key, class, shard FROM ranked
  JOIN (SELECT key, class, row_number() OVER (PARTITION BY class ORDER BY key) AS r FROM classed) USING (class, r)
)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY class DESC, key, salt, doc_id NULLS FIRST) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM lines JOIN placed USING (key) JOIN summed USING (key)
"""
