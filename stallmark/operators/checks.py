"""Data-quality checks. Each returns the failing rows; none means that the check passed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import kpi, range_functions
from .merge import as_of_join
from .star import Star, as_date
from .windows import Windows


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def accepted_values(df: DataFrame, column: str, *values) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n"))


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    keys = parent.select(F.col(key).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def calendar_covers_sales(star: Star) -> DataFrame:
    sales = star.lines.where("sale_date is not null").agg(F.min("sale_date").alias("first_sale"), F.max("sale_date").alias("last_sale"))
    days = star.dates.agg(F.min("date_day").alias("first_day"), F.max("date_day").alias("last_day"), F.count("*").alias("days"), F.countDistinct("date_day").alias("distinct_days"))
    both = sales.crossJoin(F.broadcast(days))
    return both.where("first_sale < first_day or last_sale > last_day or days <> distinct_days or days <> datediff(last_day, first_day) + 1")


def item_key_resolves(star: Star) -> DataFrame:
    items = star.items.select("item_key", "square_catalog_object_id")
    return star.lines.where("item_key is not null").join(items, "item_key", "left").where(~F.col("catalog_object_id").eqNullSafe(F.col("square_catalog_object_id"))).select("order_line_key", "catalog_object_id", "square_catalog_object_id")


def fact_matches_source(star: Star) -> DataFrame:
    sums = [F.count("*").alias("rows"), F.sum("net_sales_cents").alias("net"), F.sum("tax_cents").alias("tax"), F.sum("quantity").alias("units")]
    fact = star.lines.agg(*sums, F.countDistinct("order_line_key").alias("keys"))
    source = star.staged["order_lines"].agg(*(s for s in sums), F.countDistinct("order_id", "line_item_uid").alias("keys"))
    return compare_by_key(fact.withColumn("k", F.lit(1)), source.withColumn("k", F.lit(1)), ["k"], ["rows", "net", "tax", "units", "keys"])


def forecast_is_sane(forecast: DataFrame) -> DataFrame:
    u = F.col("forecast_units")
    return forecast.where(u.isNull() | F.isnan(u) | (u < 0))


def history_fan_out(star: Star) -> DataFrame:
    return history_fan_out_of(star.lines, star.item_history)


def history_fan_out_of(lines: DataFrame, history: DataFrame) -> DataFrame:
    """Lines that meet more than one version of their item."""
    return as_of_join(lines.where("closed_at is not null"), history).groupBy("order_line_key").agg(F.count("*").alias("n")).where("n > 1")


def history_well_formed(history: DataFrame) -> DataFrame:
    """Versions that end before they begin, overlap or leave a gap; items without exactly one open version among those not closed."""
    after = F.lead("valid_from").over(W.partitionBy("item_key").orderBy("valid_from"))
    v = history.select("item_key", "valid_from", "valid_to", after.alias("next_from"))
    fault = F.when(F.col("valid_to") <= F.col("valid_from"), "backwards").when(F.col("next_from") < F.col("valid_to"), "overlap").when(F.col("next_from") > F.col("valid_to"), "gap").when(F.col("valid_to").isNull() & F.col("next_from").isNotNull(), "open_before_end")
    bad = v.select("item_key", fault.alias("fault")).where("fault is not null")
    many = history.groupBy("item_key").agg(F.count(F.when(F.col("valid_to").isNull(), 1)).alias("n")).where("n > 1").select("item_key", F.lit("several_open").alias("fault"))
    return bad.unionByName(many)


def local_time_is_right(star: Star) -> DataFrame:
    """Lines with a closing time but no date or the reverse; and at stores with a zone other than UTC, lines whose
    date is not that of their local time or whose local time is not 1 to 23 hours off."""
    zones = star.locations.select("location_key", "timezone")
    hours = F.abs(F.timestamp_diff("HOUR", F.col("closed_at_local"), F.col("closed_at")))
    one_sided = F.col("closed_at").isNull() != F.col("sale_date").isNull()
    off = F.col("closed_at").isNotNull() & F.col("timezone").isNotNull() & (F.col("timezone") != "UTC") & ((F.col("sale_date") != F.to_date("closed_at_local")) | ~hours.between(1, 23))
    failure = F.when(one_sided, "nullability_mismatch").when(off, "offset_or_date_mismatch")
    lines = star.lines.join(zones, "location_key", "left").withColumn("failure", failure)
    return lines.where("failure is not null").select("failure", "order_line_key", "closed_at", "closed_at_local", "sale_date")


def short_payments(reconciled: DataFrame, severity: str = "warn") -> DataFrame:
    return reconciled.where("reconciliation_status = 'short'").withColumn("severity", F.lit(severity))


def period_grain(df: DataFrame, *columns: str) -> DataFrame:
    return unique(df, "period_label", *columns)


def narrower_within_wider(summary: DataFrame) -> DataFrame:
    a, b = summary.alias("a"), F.broadcast(summary.alias("b"))  # five rows each
    wider = (F.col("a.period_order") < F.col("b.period_order")) & (F.col("a.period_start") >= F.col("b.period_start"))
    worse = (F.col("a.orders") > F.col("b.orders")) | (F.col("a.units") > F.col("b.units")) | (F.col("a.gross_sales_cents") > F.col("b.gross_sales_cents"))
    return a.join(b, wider & worse).select(F.col("a.period_label").alias("narrow"), F.col("b.period_label").alias("wide"))


def compare_by_key(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str], tolerance: float = 0.0) -> DataFrame:
    """Keys on one side only or with different values (relative tolerance for numbers): key columns, column, a, b as text."""
    x, y = a.select(*keys, *(F.col(c).alias(f"a_{c}") for c in columns), F.lit(True).alias("in_a")), b.select(*keys, *(F.col(c).alias(f"b_{c}") for c in columns), F.lit(True).alias("in_b"))
    both = x.join(y, keys, "full")
    kinds = dict(a.dtypes)
    parts = [F.when(~(F.coalesce("in_a", F.lit(False)) & F.coalesce("in_b", F.lit(False))), F.struct(F.lit("(row)").alias("column"), F.col("in_a").cast("string").alias("a"), F.col("in_b").cast("string").alias("b")))]
    for c in columns:
        p, q = F.col(f"a_{c}"), F.col(f"b_{c}")
        same = p.eqNullSafe(q)
        if tolerance and (kinds[c] in ("int", "bigint", "double") or kinds[c].startswith("decimal")):
            same = same | (F.abs(p.cast("double") - q.cast("double")) <= tolerance * F.greatest(F.abs(p.cast("double")), F.abs(q.cast("double"))))
        parts.append(F.when(F.col("in_a") & F.col("in_b") & ~F.coalesce(same, F.lit(False)), F.struct(F.lit(c).alias("column"), p.cast("string").alias("a"), q.cast("string").alias("b"))))
    return both.select(*keys, F.explode(F.array_compact(F.array(*parts))).alias("d")).select(*keys, "d.*")


#: Relations that exist for periods and for ranges, with the columns that tell their rows apart.
RELATION_KEYS = {"summary": [], "category": ["category_name"], "weekday": ["day_of_week"], "hour": ["hour_of_day"], "payments": ["source_type"], "items": ["variation_id"]}


#: Figures of a range that All time does not have.
OWN_OF_RANGES = {"prior_start", "prior_end", "period_days", "period_start", "period_end", "avg_weekly_units"}


def ranges_equal_periods(star: Star) -> DataFrame:
    """relation, period_label, key, column, a, b: where a relation over a period's days as a range differs from the period's own rows.

    Each relation is called for all periods at once, by a lateral call of its SQL function, and compared once. All relations, periods and figures; of prior figures only where the period has a prior window (All time has none,
    a range over its days does), and items' weekly average not for All time, likewise.
    """
    undated = [r.period_label for r in star.periods.where("period_days is null").collect()]  # of five rows
    out = None
    for name, key in RELATION_KEYS.items():
        own, ranges = kpi.RANGES[name](star, Windows(star.periods)), range_functions.over_table(star, name)
        columns = [c for c in ranges.columns if c in own.columns and c not in (*key, "period_label", "period_order")]
        at = F.concat_ws("|", *(F.col(c).cast("string") for c in key)).alias("key") if key else F.lit("all").alias("key")
        held = lambda c: F.when(~F.col("period_label").isin(undated), F.col(c)).alias(c) if c in OWN_OF_RANGES else F.col(c)  # noqa: E731, B023
        a, b = (df.select("period_label", at, *(held(c) for c in columns)) for df in (own, ranges))
        diff = compare_by_key(a, b, ["period_label", "key"], columns)
        diff = diff.select(F.lit(name).alias("relation"), "period_label", "key", "column", "a", "b")
        out = diff if out is None else out.unionByName(diff)
    return out


def is_fresh(star: Star, most_days: int = 2, as_of: dt.date | None = None) -> DataFrame:
    today = as_date(as_of or star.as_of)
    return star.lines.agg(F.max("sale_date").alias("last_sale")).where(F.col("last_sale").isNull() | (F.datediff(today, F.col("last_sale")) > most_days))


def peak_hour_in(hours: DataFrame, low: int = 8, high: int = 23) -> DataFrame:
    by = hours.groupBy("hour_of_day").agg(F.sum("orders").alias("orders")).orderBy(F.col("orders").desc(), "hour_of_day").limit(1)
    return by.where(~F.col("hour_of_day").between(low, high))


def row_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side that the other lacks, as often as they are missing."""
    b = b.select(*a.columns)
    return a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))


def period_coverage(df: DataFrame, periods: DataFrame) -> DataFrame:
    """Periods without a row."""
    return periods.join(df.select("period_label").distinct(), "period_label", "left_anti").select("period_label")


def single_row(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n")).where("n <> 1")


def flagged(rows: DataFrame, check: str, severity: str = "error") -> DataFrame:
    """check, severity, failures of a check's rows."""
    return rows.agg(F.count("*").alias("failures")).select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), "failures")
