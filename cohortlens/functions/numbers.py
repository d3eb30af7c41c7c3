"""Lossy number parsing, safe division and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: Column | str) -> Column:
    """Text to double; null where the text is no number.

    Spark alone would also take '1d', '1f', 'nan', 'inf' and hex floats: all of
    these end in a letter or hold an x.
    """
    # Only the last character needs the blanks cut off: the cast cuts them itself.
    text = _col(c).cast("string")
    last = F.right(F.btrim(text, F.lit(" \t\r\n")), F.lit(1))
    plain = F.contains(F.lit("./0123456789"), last) & ~F.contains(text, F.lit("x")) & ~F.contains(text, F.lit("X"))
    return F.when(plain, text.try_cast("double"))


def count(c: Column | str) -> Column:
    """Text to bigint by way of double, cutting off decimals; null if no number."""
    return number(c).try_cast("bigint")


def whole_number(c: Column | str, fill: int = 0, strict: bool = False) -> Column:
    """Text to bigint after removing commas and blanks; null becomes `fill`.

    With `strict` a text that is no number raises instead.
    """
    bare = F.regexp_replace(_col(c).cast("string"), r"[,\s]", "")
    value = count(bare)
    if strict:
        bad = bare.isNotNull() & value.isNull()
        value = F.when(bad, F.raise_error(F.concat(F.lit("not a number: "), bare)).cast("bigint")).otherwise(value)
    return F.coalesce(value, F.lit(fill).cast("bigint"))


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as double; null if b is zero or null."""
    return _col(a).cast("double") / F.nullif(_col(b).cast("double"), F.lit(0.0))


def half_even(c: Column, digits: int) -> Column:
    """Round a double half to even on the scaled value, as array libraries do."""
    return F.rint(c * F.lit(10.0**digits)) / F.lit(10.0**digits)


def half_up(c: Column, digits: int) -> Column:
    """Round half away from zero.

    The detour over nine exact decimals keeps the noise of float sums from
    deciding an exact half.
    """
    return F.round(c.cast("decimal(28,9)"), digits).cast("double")
