"""Scalar functions of the retail model as Column expressions (Column in, Column out)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Cents = T.LongType()
Quantity = T.DecimalType(18, 4)
Units = T.DecimalType(28, 4)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_local_time(tz: Column | str, utc: Column | str) -> Column:
    """The naive local time of a naive UTC time; a null zone counts as UTC."""
    return F.convert_timezone(F.lit("UTC"), F.coalesce(col(tz), F.lit("UTC")), col(utc).cast("timestamp_ntz"))


def regexp_replace_all(text: Column | str, pattern: str, to: str) -> Column:
    return F.regexp_replace(col(text), pattern, to)


def date_diff_in(unit: str, start: Column | str, end: Column | str) -> Column:
    """end - start in whole days, week starts (Mondays) or elapsed hours."""
    start, end = col(start), col(end)
    if unit == "day":
        return F.datediff(end, start)
    if unit == "week":
        return (F.datediff(F.trunc(end, "week"), F.trunc(start, "week")) / 7).cast("int")
    if unit == "hour":
        return F.timestamp_diff("HOUR", start, end)
    raise ValueError(f"unknown unit {unit}")


def day_of_week_iso(d: Column | str) -> Column:
    """1 is Monday, 7 is Sunday."""
    return F.weekday(col(d)) + 1


def day_name(d: Column | str) -> Column:
    return F.date_format(col(d), "EEEE")


def month_name(d: Column | str) -> Column:
    return F.date_format(col(d), "MMMM")


def add_days(d: Column | str, n: Column | int) -> Column:
    return F.date_add(col(d), n if isinstance(n, int) else n.cast("int"))


def is_nan(x: Column | str) -> Column:
    """NaN and null both mean that there is no number."""
    return F.isnan(col(x)) | col(x).isNull()


def integers(spark: SparkSession, low: int, high: int) -> DataFrame:
    """One column n: low to high, both included."""
    return spark.range(low, high + 1).select(F.col("id").cast("int").alias("n"))


def try_cast_as(x: Column | str, kind: str) -> Column:
    return col(x).try_cast(kind)


def week_start(d: Column | str) -> Column:
    """The Monday of the date's week."""
    return F.trunc(col(d), "week")


def week_of_year(d: Column | str) -> Column:
    return F.weekofyear(col(d))


def surrogate_key(*parts: Column | str) -> Column:
    """md5 of the parts as text, null as empty, separated by |."""
    return F.md5(F.concat_ws("|", *(F.coalesce(col(p).cast("string"), F.lit("")) for p in parts)))


def normalize_category(x: Column | str) -> Column:
    """Upper case, inner white space collapsed, trimmed; blank is null."""
    clean = F.upper(F.trim(F.regexp_replace(col(x), r"\s+", " ")))
    return F.when(clean != "", clean)


def item_key_or_custom(object_id: Column | str, name: Column | str) -> Column:
    """The catalog id, or custom:<name> for lines without one."""
    return F.coalesce(col(object_id), F.concat(F.lit("custom:"), F.coalesce(col(name), F.lit("unknown"))))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def rounded(x: Column, places: int = 0) -> Column:
    """Half away from zero, in doubles, the same on every engine."""
    x, by = x.cast("double"), float(10**places)
    return F.signum(x) * F.floor(F.abs(x) * by + 0.5).cast("double") / by


def cents(x: Column) -> Column:
    """A number of cents, rounded."""
    return rounded(x).cast("long")


def ratio(a: Column, b: Column) -> Column:
    """a / b as doubles; null where b is 0."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def percent(a: Column, b: Column, places: int) -> Column:
    return rounded(F.lit(100.0) * a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0)), places)


def pct_change(now: Column, prior: Column, complete: Column) -> Column:
    """The change in percent, one place; null unless the prior window is complete and not 0."""
    change = F.lit(100.0) * (now.cast("double") - prior.cast("double")) / F.nullif(prior.cast("double"), F.lit(0.0))
    return F.when(complete, rounded(change, 1))


def item_label(name: Column | str, variation: Column | str) -> Column:
    """The name, with the variation unless it says nothing more."""
    name, variation = col(name), col(variation)
    more = variation.isNotNull() & (variation != "") & (variation != F.coalesce(name, F.lit(""))) & (F.lower(variation) != "regular")
    return F.when(more, F.concat(F.coalesce(name, F.lit("")), F.lit(" — "), variation)).otherwise(name)


def money(struct: Column | str) -> Column:
    """The amount of a money struct; 0 where it or its amount is missing."""
    return F.coalesce(col(struct)["amount"].cast("long"), F.lit(0).cast("long"))


def iso_timestamp(text: Column | str) -> Column:
    """An instant from ISO text (Z or offset); null where it cannot be read."""
    return col(text).try_cast("timestamp")
