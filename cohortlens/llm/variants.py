"""Spelling variants: words one edit apart, by asymmetric q-chunks.

Two words are near if exactly one code point is inserted, deleted or replaced.
Of two words the shorter one (either, if as long) contributes two disjoint
chunks, its first and its last half; the other one contributes its positional
grams. One edit leaves one of the chunks whole: the first at its own place, the
last at a place shifted by the difference in length, so by one at most. Grams at
other places cannot meet a chunk by one edit and are not posted. Chunks and grams
meet in an equi-join, and every pair that shares one is verified.

A gram that many words share is not joined: what is left of its words, chunk taken
off, must again be one edit apart, so it is cut into chunks in turn, and the key
grows by them. Each round halves what is left; in the end a key holds words that
differ in one place. So a frequent gram costs rounds, not pairs, and no
pair is lost.

Words are taken from whole texts: runs of letters, A-Z lower-cased. To every 31st
pair of document and run (by CRC-32) a letter is lost, as a source of variants.
Runs are counted in each task before the shuffle. Null texts have no words; a null
`doc_id` counts as `null`. Equal rows count twice, ties go to the smaller word in
code-point order. An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .texts import kept, pieces, strings, texts

LETTERS = "A-Za-zÀ-ÿ"
LEAST = 7  # code points of a word
OFTEN = 2  # occurrences of a word
LOST = 31
STRONGER = 10  # times as frequent as the word
# Pairs that one key may bring together; a key with more is cut further.
MOST_PAIRS = 4096
# Distinct words counted in a task before they are sent on.
COUNTED = 100_000

# A maximal run is matched from its beginning; shorter ones can never count.
_RUN = re.compile(f"[{LETTERS}]{{{LEAST},}}")
_LOWER = {i: i + 32 for i in range(65, 91)}


def damaged(doc_id: int | None, run: str) -> str:
    """The lower-cased run, without one letter if the hash says so."""
    low = run.lower() if run.isascii() else run.translate(_LOWER)
    name = "null" if doc_id is None else str(doc_id)
    h = zlib.crc32(f"{name}:{low}".encode())
    if h % LOST:
        return low
    at = h % len(low)
    return low[:at] + low[at + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()

    def sent() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
        )
        total.clear()
        return out

    for whole in batches:
        for batch in pieces(whole, "text", 1 << 20):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text"))):
                for run, n in Counter(_RUN.findall(text)).items():
                    word = damaged(doc_id, run)
                    if len(word) >= LEAST:
                        total[word] += n
            if len(total) >= COUNTED:
                yield sent()
    if total:
        yield sent()


def vocabulary(docs: DataFrame, often: int = OFTEN) -> DataFrame:
    """`word` and `n`, its occurrences in all documents, of the words that occur often enough."""
    counted = texts(docs).mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= often)


def _first(c: Column, n: Column) -> Column:
    return F.substring(c, F.lit(1), n)


def _after(c: Column, n: Column) -> Column:
    return F.substring(c, n + 1, F.length(c))


def _posted(side: DataFrame) -> DataFrame:
    """Cut what is left of each word: the key grows by a chunk (or gram), the rest is what remains.

    `side` has `key`, `word`, `rest` and `size`, the length that the chunks'
    side has left under this key. The grams' side has as much or one more.
    """
    rest, half = F.col("rest"), F.floor(F.col("size") / 2).cast("int")
    shifted = F.length(rest) - half  # place of the last chunk in this word
    kinds = F.array(
        F.struct(F.concat_ws("<", "key", _first(rest, half)).alias("key"), _after(rest, half).alias("rest")),
        F.struct(F.concat_ws(">", "key", _after(rest, shifted)).alias("key"), _first(rest, shifted).alias("rest")),
    )
    return side.select("word", (F.col("size") - half).alias("size"), F.explode(kinds).alias("p")).select(
        "p.key", "word", "p.rest", "size"
    )


def _verified(chunks: DataFrame, grams: DataFrame) -> DataFrame:
    """`word` and `other` of the pairs under one key that are one edit apart."""
    a = chunks.select("key", F.col("word"))
    b = grams.select(F.col("key"), F.col("word").alias("other"))
    # Of words as long as each other both stand on both sides; one order is enough.
    one_way = (F.length("word") < F.length("other")) | (F.col("word") < F.col("other"))
    return a.join(b, "key").where(one_way & (F.levenshtein("word", "other", 1) == 1)).select("word", "other")


def near_pairs(words: DataFrame) -> DataFrame:
    """Each pair of `words.word` that is exactly one edit apart, once (`word` the shorter or smaller one)."""
    size = F.length("word")
    w = words.select("word").where(size > 0)
    chunks = _posted(w.select(size.cast("string").alias("key"), "word", F.col("word").alias("rest"), size.alias("size")))
    # A word is met by chunks of words as long as it and one shorter.
    reach = F.explode(F.array(size, size - 1)).alias("size")
    grams = _posted(
        w.select("word", reach).where("size > 0")
        .select(F.col("size").cast("string").alias("key"), "word", F.col("word").alias("rest"), "size")
    )
    found: DataFrame | None = None
    while True:
        both = kept(
            chunks.withColumn("chunk", F.lit(True)).unionByName(grams.withColumn("chunk", F.lit(False)))
        )
        chunks, grams = both.where("chunk").drop("chunk"), both.where("NOT chunk").drop("chunk")
        sizes = both.groupBy("key").agg(
            F.count_if("chunk").alias("a"), F.count_if(~F.col("chunk")).alias("b"), F.first("size").alias("size")
        )
        # What is down to one letter cannot be cut: there the words differ in one place at most.
        crowd = (F.col("a") * F.col("b") > MOST_PAIRS) & (F.col("size") > 1)
        seen = Observation()
        crowded = kept(
            sizes.where("a > 0 AND b > 0").select("key", crowd.alias("crowded"))
            .observe(seen, F.count_if("crowded").alias("n"))
        )
        few, many = crowded.where("NOT crowded").select("key"), crowded.where("crowded").select("key")
        # The pairs are verified in the join and written each round.
        pairs = kept(_verified(chunks.join(few, "key", "left_semi"), grams.join(few, "key", "left_semi")))
        found = pairs if found is None else found.unionByName(pairs)
        if seen.get["n"] == 0:
            return found.distinct()
        chunks = _posted(chunks.join(many, "key", "left_semi"))
        grams = _posted(grams.join(many, "key", "left_semi"))


def roots(forms: DataFrame) -> DataFrame:
    """`word` and `root`, the last of its forms, of `word` and `form`; forms must not run in circles."""
    path = kept(forms.select("word", F.col("form").alias("root")))
    while True:
        # Every round doubles the steps taken.
        onward = path.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = Observation()
        path = kept(
            path.join(onward, "root", "left").observe(moved, F.count("further").alias("n"))
            .select("word", F.coalesce("further", "root").alias("root"))
        )
        if moved.get["n"] == 0:
            return path


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Per word: `word`, `form`, `root`, `n`, `n_near`, `form_n`.

    The form of a word is its most frequent near word, if that is `STRONGER`
    times as frequent. It grows in frequency by that factor each time, so the way
    to the root has few steps.
    """
    words = kept(vocabulary(docs))
    pairs = near_pairs(words)
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))
    counts = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    near = both.join(counts, "other").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    strong = -F.col("best.less") >= STRONGER * F.col("n")
    named = kept(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, F.col("best.other")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"),
        )
    )
    ends = roots(named.where("form IS NOT NULL"))
    return named.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


# CRC-32 by its table, which is made by its rule.
ORACLE = f"""
WITH RECURSIVE bits AS (
  SELECT b, b AS c, 0 AS step FROM range(256) AS r(b)
  UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, step + 1 FROM bits WHERE step < 8
), codes AS (
  SELECT list(c ORDER BY b) AS code FROM bits WHERE step = 8
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[{LETTERS}]+')) AS run FROM documents
), lowered AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' AS name,
    translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, count(*) AS n
  FROM runs WHERE length(run) >= {LEAST} GROUP BY ALL
), hashed AS (
  SELECT low, n, xor(4294967295, list_reduce([4294967295::BIGINT] ||
    [('0x' || hex(encode(name || low))[2 * i - 1:2 * i])::BIGINT FOR i IN range(1, octet_length(encode(name || low)) + 1)],
    lambda acc, b: xor(acc // 256, code[xor(acc, b) % 256 + 1]))) AS h
  FROM lowered, codes
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % {LOST} = 0 THEN substr(low, 1, CAST(h % length(low) AS BIGINT)) || substr(low, CAST(h % length(low) AS BIGINT) + 2)
      ELSE low END AS word FROM hashed)
  WHERE length(word) >= {LEAST} GROUP BY word HAVING sum(n) >= {OFTEN}
), cut AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM words, unnest(range(1, length(word) + 1)) AS t(i)
), near AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, w.word FROM cut a JOIN words w ON a.less = w.word
  UNION SELECT w.word, a.word FROM cut a JOIN words w ON a.less = w.word
), best AS (
  SELECT near.word, count(*) AS n_near, min((-w.n, other)) AS top FROM near JOIN words w ON w.word = other GROUP BY near.word
), named AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -top[1] >= {STRONGER} * w.n THEN top[2] END AS form, CASE WHEN -top[1] >= {STRONGER} * w.n THEN -top[1] END AS form_n
  FROM words w LEFT JOIN best USING (word)
), path AS (
  SELECT word, word AS root, form AS upward FROM named
  UNION ALL
  SELECT p.word, p.upward, f.form FROM path p JOIN named f ON f.word = p.upward
)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM named JOIN (SELECT word, root FROM path WHERE upward IS NULL) USING (word)
"""
