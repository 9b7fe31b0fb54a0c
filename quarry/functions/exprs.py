"""Column expressions built only from ``pyspark.sql.functions``.

They stay inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_nonempty(df: DataFrame, name: str) -> Column:
    """Value present: not NULL and, for strings, not the empty string."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return c.isNotNull() & (c != F.lit(""))
    return c.isNotNull()


def _float_text(c: Column) -> Column:
    """Python ``repr`` of a double: positional for exponents -4..15, else ``1e-05``."""
    text = c.cast("string")
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), "^-", "")
    digits = F.regexp_replace(F.replace(mantissa, F.lit("."), F.lit("")), "(?<=.)0+$", "")
    e = F.substring_index(text, "E", -1).try_cast("int")
    n = F.length(digits)
    positional = (
        F.when(e < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits))
        .when(n > e + 1, F.concat(F.substring(digits, F.lit(1), e + 1), F.lit("."), F.substring(digits, e + 2, n)))
        .otherwise(F.concat(F.rpad(digits, e + 1, "0"), F.lit(".0"))))
    exponent = F.concat(
        F.substring(digits, 1, 1), F.when(n > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), n))).otherwise(""),
        F.lit("e"), F.when(e < 0, "-").otherwise("+"), F.lpad(F.abs(e).cast("string"), F.greatest(
            F.length(F.abs(e).cast("string")), F.lit(2)), "0"))
    return (F.when(F.isnan(c), F.lit("nan")).when(text == "Infinity", F.lit("inf")).when(text == "-Infinity", F.lit("-inf"))
            .when(F.instr(text, "E") == 0, text)
            .otherwise(F.concat(sign, F.when((e >= -4) & (e < 16), positional).otherwise(exponent))))


def _string_repr(c: Column) -> Column:
    """Python ``repr`` of a string: single quotes unless it holds them and no double ones."""
    body = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(raw), F.lit(shown))
    double = (F.instr(c, "'") > 0) & (F.instr(c, '"') == 0)
    return F.when(double, F.concat(F.lit('"'), body, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'")))


def _text(c: Column, dt: T.DataType, inside: bool = False) -> Column:
    """Python ``str`` of a value, or ``repr`` of it ``inside`` a list."""
    if isinstance(dt, T.ArrayType):
        parts = F.transform(c, lambda x: _text(x, dt.elementType, True))
        out = F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]"))
    elif isinstance(dt, T.BooleanType):
        out = F.when(c, F.lit("True")).otherwise(F.lit("False"))
    elif isinstance(dt, (T.DoubleType, T.FloatType)):
        out = _float_text(c.cast("double"))
    elif isinstance(dt, T.StringType) and inside:
        out = _string_repr(c)
    else:
        out = c.cast("string")
    return F.when(c.isNull(), F.lit("None")).otherwise(out)


def py_str(df: DataFrame, name: str) -> Column:
    """Python ``str()`` of one value.

    NULL prints ``None``, booleans ``True``/``False``, doubles and floats as
    Python floats, arrays as Python lists with the ``repr`` of their elements.
    Control characters other than newline, return and tab stay as they are; the
    very smallest subnormal doubles have the two digits that Java gives them.
    """
    return _text(F.col(name), df.schema[name].dataType)


def csv_line(df: DataFrame, columns: list[str] | None = None, sep: str = ",") -> Column:
    """One unquoted text line per row: Python ``str`` of each value joined by ``sep``."""
    names = columns or df.columns
    return F.concat_ws(sep, *[py_str(df, n) for n in names])


def hash_bucket(seed, *cols, buckets: int = 100) -> Column:
    """Deterministic bucket in [0, buckets) of ``md5('seed:c1:c2…')``.

    Depends only on the values, never on partitioning or column order, so a
    split made with it is the same on 8 cores and on 1000 executors.
    """
    key = F.concat_ws(":", F.lit(str(seed)), *[_col(c).cast("string") for c in cols])
    top32 = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return F.pmod(top32, F.lit(buckets))


def seeded_order(seed, c) -> Column:
    """Sort key that shuffles values reproducibly for a given seed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _col(c).cast("string")))


def rmse_expr(prediction, label) -> Column:
    """Root mean squared error as one aggregate expression."""
    diff = _col(prediction).cast("double") - _col(label).cast("double")
    return F.sqrt(F.avg(diff * diff))


def joined(c, sep: str = ",", sort: bool = True) -> Column:
    """Array of scalars → one string (sorted by default), for stable output."""
    c = _col(c)
    arr = F.array_sort(c) if sort else c
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), sep)


# Sums that do not depend on the order of their terms: each term becomes a whole number of 2^-bits (floor, as
# exact as the term up to there), and whole numbers are added as decimals. n terms are off by less than n * 2^-bits.
EXACT_BITS = 40


def exact_sum(c: Column, bits: int = EXACT_BITS) -> Column:
    """Order-free sum (an aggregate) of numbers below ``2^(63 - bits)``; larger ones raise. Nulls are left out."""
    scaled = F.floor(c.cast("double") * float(1 << bits))
    whole = F.when(F.abs(c.cast("double")) < float(1 << (63 - bits)), scaled.cast("decimal(20,0)")).when(
        c.isNotNull(), F.raise_error(F.lit(f"exact_sum: a term is not below 2^{63 - bits}")).cast("decimal(20,0)"))
    return F.sum(whole).cast("double") / F.lit(float(1 << bits))


def exact_avg(c: Column, bits: int = EXACT_BITS) -> Column:
    """Order-free mean: the same bits on any number of partitions."""
    return exact_sum(c, bits) / F.count(c)


def exact_rmse(prediction: str, label: str, bits: int = EXACT_BITS) -> Column:
    """RMSE of two columns by an order-free sum of the squared differences."""
    gap = F.col(prediction).cast("double") - F.col(label).cast("double")
    return F.sqrt(exact_avg(gap * gap, bits))
