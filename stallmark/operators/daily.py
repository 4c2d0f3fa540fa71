"""Tables by order and by day, from which windows are summed.

An order nearly always lies in one slot, a local hour of one sale date, so its distinct count by day adds up over the days of any
window. Orders whose lines lie in several slots (found in the table by order) are left out of the days' counts; their
lines are kept beside them (`split_lines`) and counted as distinct orders in the window itself, so figures are exact either way.
Lines without a sale date are in no day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import Units, item_key_or_custom

SUMS = ("gross_sales_cents", "discount_cents", "tax_cents", "net_sales_cents")
#: Most split orders that are broadcast to the lines; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def total(c: str) -> Column:
    return F.sum(c).cast("long")


def order_totals(lines: DataFrame) -> DataFrame:
    """A row for each order: its total, and the first and last slot of its dated lines."""
    slot = F.when(F.col("sale_date").isNotNull(), F.struct("sale_date", F.hour("closed_at_local").alias("hour_of_day")))
    return lines.groupBy("square_order_id").agg(F.sum(F.col("net_sales_cents") + F.col("tax_cents")).alias("order_total_cents"), F.min(slot).alias("first_slot"), F.max(slot).alias("last_slot"))


def order_payments(payments: DataFrame) -> DataFrame:
    """What was paid for each order."""
    return payments.where("square_order_id is not null").groupBy("square_order_id").agg(total("amount_cents").alias("paid_cents"))


def split_orders(totals: DataFrame) -> DataFrame:
    """The orders whose dated lines lie in more than one slot."""
    return totals.where(F.col("square_order_id").isNotNull() & ~F.col("first_slot").eqNullSafe(F.col("last_slot"))).select("square_order_id")


def day_lines(lines: DataFrame) -> DataFrame:
    """The dated lines, which have their item's category, with the groups of the day tables."""
    return lines.where("sale_date is not null").select(
        "sale_date", "closed_at_local", F.hour("closed_at_local").alias("hour_of_day"), "square_order_id", F.coalesce("category_name", F.lit("Uncategorized")).alias("category_name"),
        item_key_or_custom("catalog_object_id", "item_name").alias("variation_id"), "item_name", "variation_name", "quantity", *SUMS,
    )


def split_lines(lines: DataFrame, split: DataFrame) -> DataFrame:
    """Day, hour, category and item of the lines of split orders."""
    return lines.join(split, "square_order_id", "left_semi").select("sale_date", "hour_of_day", "category_name", "variation_id", "square_order_id").distinct()


def in_one_slot(lines: DataFrame, split: DataFrame | None) -> DataFrame:
    """Lines with `whole_order`, the order's id where the order lies in one slot."""
    if split is None:
        return lines.withColumn("whole_order", F.col("square_order_id"))
    mark = split.withColumn("split", F.lit(True))
    return lines.join(mark, "square_order_id", "left").withColumn("whole_order", F.when(F.col("split").isNull(), F.col("square_order_id"))).drop("split")


def _by_day(lines: DataFrame, by: tuple[str, ...], *more: Column) -> DataFrame:
    return lines.groupBy("sale_date", *by).agg(F.countDistinct("whole_order").alias("orders"), F.sum("quantity").cast(Units).alias("units"), total("net_sales_cents").alias("net_sales_cents"), *more)


def day_slots(lines: DataFrame) -> DataFrame:
    """Sales by sale date and local hour; whole_order is that of in_one_slot."""
    more = (F.count("*").alias("line_items"), F.max("closed_at_local").alias("last_order_at"), *(total(c).alias(c) for c in SUMS[:-1]))
    return _by_day(lines, ("hour_of_day",), *more)


def day_categories(lines: DataFrame) -> DataFrame:
    return _by_day(lines, ("category_name",))


def day_items(lines: DataFrame) -> DataFrame:
    return _by_day(lines, ("variation_id",), F.max("item_name").alias("item_name"), F.max("variation_name").alias("variation_name"))


def day_tenders(payments: DataFrame) -> DataFrame:
    """Payments by day and tender."""
    sums = [total(c).alias(c) for c in ("amount_cents", "processing_fee_cents")]
    return payments.where("pay_date is not null").groupBy("pay_date", "source_type").agg(F.count("*").alias("payments"), *sums)


def day_margins(margin: DataFrame) -> DataFrame:
    """Margin by sale date; costed is the net of lines with a cost."""
    return margin.where("sale_date is not null").groupBy("sale_date").agg(
        F.sum(F.when(F.col("has_cost"), F.col("net_sales_cents"))).alias("costed"), total("cogs_cents").alias("cogs_cents"), total("gross_profit_cents").alias("gross_profit_cents"), total("net_sales_cents").alias("all_net"),
    )


def with_split(days: DataFrame, split: DataFrame | None, *by: str) -> DataFrame:
    """Rows of a day table and, where there are split orders, a row for each of these by day and group, with its id as split_order."""
    if split is None:
        return days
    own = split.select("sale_date", *by, F.col("square_order_id").alias("split_order")).distinct().withColumn("orders", F.lit(0).cast("long"))
    return days.unionByName(own, allowMissingColumns=True)


def orders_of(days: DataFrame) -> Column:
    """Distinct orders of rows of with_split."""
    return F.sum("orders") + F.countDistinct("split_order") if "split_order" in days.columns else F.sum("orders")
