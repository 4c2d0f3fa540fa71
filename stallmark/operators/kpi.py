"""KPI operators. Each takes a star and windows (periods or one range), so both answer alike.

Rules of comparison: figures of the prior window are null unless the data covers that window, and null
(not 0) for a group without prior sales.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import Units, day_name, day_of_week_iso, pct_change, percent, rounded, week_start
from .daily import orders_of, with_split
from .star import Star, as_date
from .windows import LABEL, Windows


def _units(c: str = "quantity") -> Column:
    return F.sum(c).cast(Units)


def _total(c: str) -> Column:
    return F.sum(c).cast("long")


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)).alias(c)


def _per_order(cents: Column, orders: Column) -> Column:
    return F.when(orders > 0, rounded(cents.cast("double") / orders.cast("double"))).otherwise(0.0)


def _when_complete(c: str) -> Column:
    return F.when(F.col("prior_window_complete"), F.col(c))


def _side_by_side(both: DataFrame, key: list[str], now: tuple[str, ...], prior: dict[str, str]) -> DataFrame:
    """Of rows by key and is_prior, the figures of the window and, renamed, of the one before it in one row."""
    at = lambda c, is_prior: F.max(F.when(F.col("is_prior") == is_prior, F.col(c)))
    return both.groupBy(*key).agg(F.min("is_prior").alias("only_prior"), *(at(c, False).alias(c) for c in now), *(at(c, True).alias(to) for c, to in prior.items()))


def summary(star: Star, windows: Windows) -> DataFrame:
    sums = ("gross_sales_cents", "discount_cents", "tax_cents", "net_sales_cents")
    days = with_split(star.day_slots.select("sale_date", "orders", "units", *sums), star.split_lines)
    sold = windows.attach_both(days, "sale_date").groupBy(LABEL, "is_prior").agg(orders_of(days).alias("orders"), _units("units").alias("units"), *(_total(c).alias(c) for c in sums))
    sold = _side_by_side(sold, [LABEL], ("orders", "units", *sums), {"orders": "p_orders", "units": "p_units", "net_sales_cents": "p_net"})
    paid = windows.attach(star.day_tenders, "pay_date").groupBy(LABEL).agg(_total("amount_cents").alias("collected_cents"), _total("processing_fee_cents").alias("processing_fee_cents"))
    costed = windows.attach(star.day_margins, "sale_date").groupBy(LABEL).agg(*(_total(c).alias(c) for c in ("costed", "cogs_cents", "gross_profit_cents", "all_net")))
    out = windows.frame
    for part in (sold, paid, costed):
        out = out.join(F.broadcast(part), LABEL, "left")  # at most one row for each window
    full = F.col("prior_window_complete")
    orders = F.coalesce(F.col("orders"), F.lit(0))
    return out.select(
        LABEL, "period_order", "period_days", "period_start", "period_end", "prior_start", "prior_end", _zero("orders"), F.coalesce(F.col("units"), F.lit(0).cast(Units)).alias("units"),
        *(_zero(c) for c in ("gross_sales_cents", "discount_cents", "tax_cents", "net_sales_cents")), _per_order(F.col("net_sales_cents"), orders).alias("avg_order_value_cents"),
        F.when(orders > 0, rounded(F.col("units").cast("double") / orders.cast("double"), 2)).otherwise(0.0).alias("units_per_order"), _zero("collected_cents"), _zero("processing_fee_cents"),
        "prior_window_complete", _when_complete("p_net").alias("prior_net_sales_cents"), _when_complete("p_orders").alias("prior_orders"), _when_complete("p_units").alias("prior_units"),
        pct_change(F.coalesce("net_sales_cents", F.lit(0)), F.col("p_net"), full).alias("net_sales_change_pct"), pct_change(orders, F.col("p_orders"), full).alias("orders_change_pct"),
        pct_change(F.coalesce(F.col("units").cast("double"), F.lit(0.0)), F.col("p_units"), full).alias("units_change_pct"), "cogs_cents", "gross_profit_cents",
        F.when(F.col("costed") > 0, percent(F.col("gross_profit_cents"), F.col("costed"), 2)).alias("gross_margin_pct"),
        F.when(F.col("all_net") > 0, percent(F.col("costed"), F.col("all_net"), 1)).alias("cost_coverage_pct"),
    )


def _share(part: str, whole: Column, windows: Windows) -> Column:
    """The share of the window's total: of any total but 0 for periods, of positive totals for ranges."""
    total = F.when(whole > 0, whole) if windows.bounds else whole
    return percent(F.col(part), total, 2)


def by_category(star: Star, windows: Windows) -> DataFrame:
    days = with_split(star.day_categories, star.split_lines, "category_name")
    key = [LABEL, "category_name"]
    sold = windows.attach_both(days, "sale_date").groupBy(*key, "is_prior").agg(orders_of(days).alias("orders"), _units("units").alias("units"), _total("net_sales_cents").alias("net_sales_cents"))
    sold = _side_by_side(sold, key, ("orders", "units", "net_sales_cents"), {"net_sales_cents": "p_net"}).where("not only_prior")
    out = sold.join(F.broadcast(windows.frame), LABEL)
    total = F.sum("net_sales_cents").over(W.partitionBy(LABEL))
    return out.select(
        LABEL, "period_order", "category_name", "orders", "units", "net_sales_cents", _share("net_sales_cents", total, windows).alias("pct_of_net_sales"),
        _when_complete("p_net").alias("prior_net_sales_cents"), pct_change(F.col("net_sales_cents"), F.col("p_net"), F.col("prior_window_complete")).alias("net_sales_change_pct"),
    )


def _sold(star: Star, windows: Windows, *by: Column) -> DataFrame:
    """Orders and net sales by the given columns within each window."""
    days = with_split(star.day_slots.select("sale_date", "hour_of_day", "orders", "net_sales_cents"), star.split_lines, "hour_of_day")
    out = windows.attach(days, "sale_date").groupBy(LABEL, *by).agg(orders_of(days).alias("orders"), _total("net_sales_cents").alias("net_sales_cents"))
    return out.join(F.broadcast(windows.frame.select(LABEL, "period_order")), LABEL)


def by_weekday(star: Star, windows: Windows) -> DataFrame:
    day = day_of_week_iso("sale_date")
    out = _sold(star, windows, day.alias("day_of_week"), day_name("sale_date").alias("day_name"), day.isin(6, 7).alias("is_weekend"))
    return out.select(LABEL, "period_order", "day_of_week", "day_name", "is_weekend", "orders", "net_sales_cents", _per_order(F.col("net_sales_cents"), F.col("orders")).alias("avg_order_value_cents"))


def by_hour(star: Star, windows: Windows) -> DataFrame:
    return _sold(star, windows, F.col("hour_of_day")).select(LABEL, "period_order", "hour_of_day", "orders", "net_sales_cents")


def popular_times(star: Star, windows: Windows) -> DataFrame:
    days = with_split(star.day_slots.select("sale_date", "hour_of_day", "orders", "net_sales_cents"), star.split_lines, "hour_of_day")
    slot = windows.attach(days, "sale_date").groupBy(LABEL, day_of_week_iso("sale_date").alias("day_of_week"), day_name("sale_date").alias("day_name"), "hour_of_day").agg(
        F.countDistinct("sale_date").alias("days_observed"), orders_of(days).alias("orders"), _total("net_sales_cents").alias("net_sales_cents"),
    )
    peak = F.max("orders").over(W.partitionBy(LABEL, "day_of_week"))
    return slot.select(
        LABEL, "day_of_week", "day_name", "hour_of_day", "days_observed", "orders", "net_sales_cents",
        rounded(F.col("orders").cast("double") / F.col("days_observed").cast("double"), 1).alias("orders_per_day"), percent(F.col("orders"), peak, 0).alias("busyness_pct"),
    )


def by_payment(star: Star, windows: Windows) -> DataFrame:
    out = windows.attach(star.day_tenders, "pay_date").groupBy(LABEL, "source_type").agg(
        F.sum("payments").alias("payments"), _total("amount_cents").alias("amount_collected_cents"), _total("processing_fee_cents").alias("processing_fee_cents"),
    )
    total = F.sum("amount_collected_cents").over(W.partitionBy(LABEL))
    return out.join(F.broadcast(windows.frame.select(LABEL, "period_order")), LABEL).select(
        LABEL, "period_order", "source_type", "payments", "amount_collected_cents", "processing_fee_cents", _share("amount_collected_cents", total, windows).alias("pct_of_collected"),
    )


def by_item(star: Star, windows: Windows) -> DataFrame:
    days = with_split(star.day_items, star.split_lines, "variation_id")
    key = [LABEL, "variation_id"]
    sold = windows.attach_both(days, "sale_date").groupBy(*key, "is_prior").agg(
        F.max("item_name").alias("item_name"), F.max("variation_name").alias("variation_name"), orders_of(days).alias("orders"), _units("units").alias("units"), _total("net_sales_cents").alias("net_sales_cents"),
    )
    now = ("item_name", "variation_name", "orders", "units", "net_sales_cents")
    sold = _side_by_side(sold, key, now, {"units": "p_units", "net_sales_cents": "p_net"}).where("not only_prior")
    life = star.day_items.groupBy("variation_id").agg(_units("units").alias("units_all_time"), F.min("sale_date").alias("first_sold_at"), F.max("sale_date").alias("last_sold_at"))
    items = star.items.select(F.col("square_catalog_object_id").alias("variation_id"), "category_name", "is_lottery")
    out = sold.join(F.broadcast(windows.frame), LABEL).join(life, "variation_id", "left").join(items, "variation_id", "left")
    full, days = F.col("prior_window_complete"), F.col("period_days").cast("double")
    flag = [F.coalesce("is_lottery", F.lit(False)).alias("is_lottery")] if windows.bounds else []  # of the range relation only
    return out.select(
        LABEL, "period_order", "variation_id", "item_name", "variation_name", "category_name", *flag, "units", "orders", "net_sales_cents",
        rounded(F.col("units").cast("double") * 7.0 / days, 2).alias("avg_weekly_units"), _when_complete("p_units").alias("prior_units"), _when_complete("p_net").alias("prior_net_sales_cents"),
        pct_change(F.col("units"), F.col("p_units"), full).alias("units_change_pct"), pct_change(F.col("net_sales_cents"), F.col("p_net"), full).alias("net_sales_change_pct"),
        "units_all_time", "first_sold_at", "last_sold_at",
    )


def daily_sales(star: Star) -> DataFrame:
    sums = [_total(c).alias(c) for c in ("gross_sales_cents", "discount_cents", "tax_cents", "net_sales_cents")]
    days = with_split(star.day_slots, star.split_lines)
    by_day = days.groupBy(F.col("sale_date").alias("date_day")).agg(orders_of(days).alias("orders"), F.sum("line_items").alias("line_items"), _units("units").alias("units"), *sums)
    out = star.dates.select("date_day", "day_name", "is_weekend").join(by_day, "date_day", "left").select(
        F.col("date_day").alias("sale_date"), "day_name", "is_weekend", _zero("orders"), _zero("line_items"), F.coalesce(F.col("units"), F.lit(0).cast(Units)).alias("units"),
        *(_zero(c) for c in ("gross_sales_cents", "discount_cents", "tax_cents", "net_sales_cents")),
        _per_order(F.col("net_sales_cents"), F.coalesce("orders", F.lit(0))).alias("avg_order_value_cents"),
    )
    week = W.orderBy("sale_date").rowsBetween(-6, 0)  # over one row a day
    whole = F.sum("net_sales_cents").over(week).cast("double") / 7.0
    return out.withColumn("net_sales_7d_avg_cents", F.when(F.count("*").over(week) == 7, rounded(whole)))


def item_weekly_sales(star: Star) -> DataFrame:
    days = with_split(star.day_items, star.split_lines, "variation_id")
    return days.groupBy(week_start("sale_date").alias("week_start"), "variation_id").agg(
        F.max("item_name").alias("item_name"), F.max("variation_name").alias("variation_name"), orders_of(days).alias("orders"), _units("units").alias("units_sold"), _total("net_sales_cents").alias("net_sales_cents"),
    )


def data_coverage(star: Star) -> DataFrame:
    today = as_date(star.as_of)
    days = with_split(star.day_slots.select("sale_date", "orders", "last_order_at"), star.split_lines).withColumn("week", week_start("sale_date"))
    done = F.col("week") < week_start(today)
    first, last = F.min("sale_date"), F.max("sale_date")
    sold = star.day_items.agg(F.countDistinct("variation_id").alias("items_sold"))
    out = days.agg(
        first.alias("first_sale_date"), last.alias("last_sale_date"), F.max("last_order_at").alias("last_order_at"), (F.datediff(last, first) + 1).cast("long").alias("days_covered"),
        F.countDistinct("sale_date").alias("days_with_sales"), F.countDistinct("week").alias("weeks_covered"), F.countDistinct(F.when(done, F.col("sale_date"))).alias("days_in_complete_weeks"),
        F.countDistinct(F.when(done, F.col("week"))).alias("complete_weeks_covered"), F.coalesce(orders_of(days), F.lit(0)).alias("orders"),
        F.greatest(F.lit(0), F.datediff(today, last)).cast("long").alias("days_since_last_sale"),
    )
    return out.crossJoin(F.broadcast(sold)).select(*out.columns[:-1], "items_sold", out.columns[-1])  # one row each


def reconciliation(star: Star) -> DataFrame:
    """Totals and payments by order meet in their buckets: neither lines nor payments are shuffled."""
    orders = star.order_totals.select("square_order_id", "order_total_cents", F.lit(True).alias("o"))
    paid = star.order_payments.withColumn("p", F.lit(True))
    due, got = F.col("order_total_cents"), F.col("paid_cents")
    status = F.when(F.col("o").isNull(), "payment_without_order").when(F.col("p").isNull(), "order_without_payment").when(F.abs(due - got) <= 1, "matched").when(got > due, "overpaid").otherwise("short")
    return orders.join(paid, "square_order_id", "full").select(
        "square_order_id", "order_total_cents", "paid_cents", (F.coalesce(due, F.lit(0)) - F.coalesce(got, F.lit(0))).alias("variance_cents"), status.alias("reconciliation_status"),
    )


def margin_by_category(star: Star) -> DataFrame:
    costed = F.sum(F.when(F.col("has_cost"), F.col("net_sales_cents")))
    out = star.margin.groupBy(F.coalesce("category_name", F.lit("Uncategorized")).alias("category_name")).agg(
        F.count("*").alias("order_lines"), F.sum(F.col("has_cost").cast("int")).alias("n_costed"), costed.cast("long").alias("net_sales_cents"),
        _total("cogs_cents").alias("cogs_cents"), _total("gross_profit_cents").alias("gross_profit_cents"),
    )
    return out.select(
        "category_name", "order_lines", percent(F.col("n_costed"), F.col("order_lines"), 1).alias("line_cost_coverage_pct"), "net_sales_cents", "cogs_cents", "gross_profit_cents",
        F.when(F.col("net_sales_cents") > 0, percent(F.col("gross_profit_cents"), F.col("net_sales_cents"), 2)).alias("gross_margin_pct"),
    )


def margin_by_vendor(star: Star) -> DataFrame:
    out = star.margin.where("has_cost").groupBy("vendor_name").agg(
        F.count("*").alias("order_lines"), _total("net_sales_cents").alias("net_sales_cents"), _total("cogs_cents").alias("cogs_cents"), _total("gross_profit_cents").alias("gross_profit_cents"),
    )
    return out.withColumn("gross_margin_pct", F.when(F.col("net_sales_cents") > 0, percent(F.col("gross_profit_cents"), F.col("net_sales_cents"), 2)))


def inventory_position(star: Star) -> DataFrame:
    recent = star.lines.where(F.col("sale_date") >= F.date_sub(as_date(star.as_of), 30)).groupBy(F.col("catalog_object_id").alias("square_catalog_object_id")).agg(_units().alias("sold"))
    out = star.inventory.join(recent, "square_catalog_object_id", "left").join(star.items.select("item_key", "item_name", "category_name"), "item_key", "left")
    sold = F.coalesce(F.col("sold").cast("double"), F.lit(0.0))
    daily = F.nullif(sold / 30.0, F.lit(0.0))
    left = F.col("quantity_on_hand") / daily
    status = F.when(sold == 0, "no_recent_sales").when(left < 7, "reorder_soon").when(left < 14, "watch").otherwise("ok")
    return out.select(
        "square_catalog_object_id", "item_name", "category_name", "quantity_on_hand", F.coalesce("sold", F.lit(0).cast(Units)).alias("units_sold_30d"), rounded(sold / 30.0, 3).alias("avg_daily_units"),
        rounded(left, 1).alias("days_of_inventory"), status.alias("stock_status"), "calculated_at",
    )


# Ranges: the same operators over one window, without the period's label.


def over_range(operator, star: Star, start: dt.date, end: dt.date) -> DataFrame:
    return operator(star, Windows.of_range(star.day_slots, start, end, star.as_of)).drop(LABEL, "period_order")


def range_window(star: Star, start: dt.date, end: dt.date) -> DataFrame:
    w = Windows.of_range(star.day_slots, start, end, star.as_of)
    return w.frame.select("period_start", "period_end", "period_days", "prior_start", "prior_end", "prior_window_complete")


#: Range relations by name.
RANGES = {"summary": summary, "category": by_category, "weekday": by_weekday, "hour": by_hour, "popular_times": popular_times, "payments": by_payment, "items": by_item}


def over_periods(operator, star: Star, periods: list[tuple[str, dt.date, dt.date]]) -> DataFrame:
    """A range relation called for each labelled window, all rows together."""
    out = None
    for label, start, end in periods:
        part = over_range(operator, star, start, end).withColumn(LABEL, F.lit(label))
        out = part if out is None else out.unionByName(part)
    return out


def publish(star: Star, start: dt.date, end: dt.date, prefix: str = "range_") -> list[str]:
    """Registers every range relation of one window as a temporary view (for SQL that joins several); rows are ordered by the caller."""
    names = []
    for name, operator in RANGES.items():
        over_range(operator, star, start, end).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    range_window(star, start, end).createOrReplaceTempView(prefix + "window")
    return [*names, prefix + "window"]
