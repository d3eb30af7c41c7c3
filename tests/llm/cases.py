"""Tables with the odd rows that every operator has to take."""

import random

from pyspark.sql import Row

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; they must not matter as columns of the input.
CLASHING = ["size", "key", "rep", "bucket", "word", "toxic", "text_key", "rate", "target", "row", "component_id", "rank"]


def words(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(n))


def odd_rows() -> list[tuple]:
    base = words(60, 1)
    texts = [
        (1, ""), (2, None), (3, "one two three"), (4, words(30_000, 2)), (5, base), (6, base),
        (7, base.replace(" ", "\n\t", 3)), (8, base + " tail"), (9, "a"), (10, " \t\n "),
        (11, "Ünïcode “quotes” ΑΣ ☃ 12 <|endoftext|> x"), (12, "x" * 5000), (None, "no id here at all"),
        (13, "again and again"), (13, "again and again"), (14, base.upper()), (15, "0 " * 300),
    ]
    return [(i, t, "en" if (i or 0) % 2 else None, None if i == 9 else f"s{(i or 0) % 3}", len(t or "")) for i, t in texts]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), DOCUMENTS)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHING)))


def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


def collected(df) -> list[Row]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
