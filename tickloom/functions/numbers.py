"""Numbers from columns of any archive type; missing doubles are NULL, never NaN."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing(x: Column) -> Column:
    """NaN as NULL."""
    return F.nanvl(x, F.lit(None).cast("double"))


def as_double(df: DataFrame, name: str) -> Column:
    """Strings may have blanks around them and single underscores between digits; null stays missing."""
    kind = dict(df.dtypes)[name]
    x = F.col(name)
    if kind == "void":
        return F.lit(None).cast("double").alias(name)
    if kind == "string":
        x = F.regexp_replace(F.trim(x), "(?<=[0-9])_(?=[0-9])", "")
        got = x.try_cast("double")
        x = F.when(F.col(name).isNotNull() & got.isNull(), F.raise_error(F.concat(F.lit(f"{name}: not a number: "), F.col(name))).cast("double")).otherwise(got)
    return missing(x.cast("double")).alias(name)


def as_long(df: DataFrame, name: str) -> Column:
    """Whole numbers; null and fractions that are not finite are an error."""
    kind = dict(df.dtypes)[name]
    x = F.col(name)
    if kind == "string":
        x = F.regexp_replace(F.trim(x), "(?<=[0-9])_(?=[0-9])", "")
        got = x.try_cast("long")
    elif kind in ("double", "float"):
        got = F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), None).otherwise(x).try_cast("long")
    elif kind == "void":
        got = F.lit(None).cast("long")
    else:
        got = x.cast("long")
    return F.coalesce(got, F.raise_error(F.concat(F.lit(f"{name}: missing or not a whole number: "), F.coalesce(F.col(name).cast("string"), F.lit("null")))).cast("long")).alias(name)


def ratio(a: Column, b: Column) -> Column:
    """a / b in floating point, also where ANSI mode would fail: a/0 is infinite, 0/0 missing."""
    zero = F.when(a > 0, F.lit(float("inf"))).when(a < 0, F.lit(float("-inf")))
    return F.when(b == 0, zero).otherwise(missing(F.try_divide(a, b)))


def kahan(values: Column, field: str) -> Column:
    """The compensated sum of one field of an array of structs, in array order; missing entries are passed by, none gives 0."""
    present = F.filter(values, lambda x: x[field].isNotNull())
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c"))

    def add(a: Column, x: Column) -> Column:
        y = x[field] - a["c"]
        total = a["s"] + y
        lost = (total - a["s"]) - y
        return F.struct(total.alias("s"), F.nanvl(lost, F.lit(0.0)).alias("c"))

    return F.aggregate(present, zero, add, lambda a: a["s"])
