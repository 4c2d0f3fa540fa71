"""Row logic of the presentation: trends, searches, boards, densified grids, joined series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import percent, rounded


def weekly_trend(weekly: DataFrame, weeks: int = 12) -> DataFrame:
    """variation_id, trend: units of each of the last `weeks` weeks with sales, oldest first, 0 where none."""
    last = weekly.select("week_start").distinct().orderBy(F.col("week_start").desc()).limit(weeks)
    last = last.agg(F.array_sort(F.collect_list("week_start")).alias("grid"))  # one row of at most `weeks` dates
    own = weekly.join(F.broadcast(last), F.array_contains("grid", F.col("week_start")))
    sold = own.groupBy("variation_id", "grid").agg(F.map_from_entries(F.collect_list(F.struct("week_start", F.col("units_sold").cast("double")))).alias("sold"))
    return sold.select("variation_id", F.transform("grid", lambda w: F.coalesce(F.try_element_at("sold", w), F.lit(0.0))).alias("trend"))


SORTS = {"units": [("units", False)], "revenue": [("net_sales_cents", False)], "growth": [("units_change_pct", False)], "name": [("item_name", True)]}


def item_search(items: DataFrame, text: str = "", categories: tuple[str, ...] = (), min_units: float = 0, sort: str = "units", top: int | None = 25) -> DataFrame:
    """Items whose name, variation or category holds the text (any case, literal), filtered, sorted (nulls last) and cut."""
    where = F.concat_ws(" ", "item_name", "variation_name", "category_name")
    out = items.where(F.lower(where).contains(text.lower()) & (F.col("units") >= min_units))
    if categories:
        out = out.where(F.col("category_name").isin(*categories))
    order = [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in SORTS[sort]]
    out = out.orderBy(*order, "variation_id")
    return out.limit(top) if top else out


def top_sellers(items: DataFrame, lottery: bool, top: int = 10) -> DataFrame:
    return items.where(F.col("is_lottery") == lottery).orderBy(F.col("units").desc(), "variation_id").limit(top)


def lottery_share(items: DataFrame) -> DataFrame:
    net, own = F.sum("net_sales_cents"), F.sum(F.when(F.col("is_lottery"), F.col("net_sales_cents")).otherwise(0))
    return items.agg(percent(own, F.greatest(net, F.lit(1)), 1).alias("lottery_share_pct"))


def busiest_weekday(weekdays: DataFrame) -> DataFrame:
    return weekdays.groupBy("day_name").agg(F.sum("orders").alias("orders")).orderBy(F.col("orders").desc(), "day_name").limit(1)


def hour_grid(popular: DataFrame) -> DataFrame:
    """Every hour between the first and the last seen, for every weekday seen; 0 where nothing was sold."""
    span = popular.agg(F.min("hour_of_day").alias("lo"), F.max("hour_of_day").alias("hi"))
    days = popular.select("day_of_week", "day_name").distinct()
    grid = days.crossJoin(F.broadcast(span)).select("day_of_week", "day_name", F.explode(F.sequence("lo", "hi")).alias("hour_of_day"))
    return grid.join(popular.select("day_of_week", "hour_of_day", "orders", "busyness_pct"), ["day_of_week", "hour_of_day"], "left").fillna(0, ["orders", "busyness_pct"])


def revenue_series(daily: DataFrame, forecast: DataFrame, days: int = 28) -> DataFrame:
    """The last `days` days and the forecast, labelled."""
    last = daily.agg(F.max("sale_date").alias("last"))
    actual = daily.crossJoin(F.broadcast(last)).where(F.col("sale_date") > F.date_sub("last", days))
    parts = actual.select(F.col("sale_date").alias("day"), "net_sales_cents", F.lit("actual").alias("series"))
    return parts.unionByName(forecast.select(F.col("forecast_date").alias("day"), F.col("forecast_net_sales_cents").alias("net_sales_cents"), F.lit("forecast").alias("series")))


def item_series(weekly: DataFrame, forecast: DataFrame) -> DataFrame:
    """Weekly units of every item and their forecast, the last actual week repeated as the forecast's first point."""
    actual = weekly.select("variation_id", F.col("week_start").alias("week"), F.col("units_sold").cast("double").alias("units"), F.lit("actual").alias("series"))
    ahead = forecast.select("variation_id", F.col("forecast_week_start").alias("week"), F.col("forecast_units").alias("units"), F.lit("forecast").alias("series"))
    known = forecast.select("variation_id").distinct()
    bridge = actual.groupBy("variation_id").agg(F.max_by(F.struct("week", "units"), "week").alias("p")).join(known, "variation_id", "left_semi")
    return actual.unionByName(bridge.select("variation_id", "p.week", "p.units", F.lit("forecast").alias("series"))).unionByName(ahead)


def reconciliation_rollup(rows: DataFrame) -> DataFrame:
    """Orders by status, each with the share of all that ties (matched or overpaid)."""
    by = rows.groupBy("reconciliation_status").agg(F.count("*").alias("orders"))
    every = W.partitionBy()  # over five rows
    tied = F.sum(F.when(F.col("reconciliation_status").isin("matched", "overpaid"), F.col("orders")).otherwise(0)).over(every)
    return by.withColumn("tie_pct", percent(tied, F.sum("orders").over(every), 1))


def daily_slice(daily: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return daily.where(F.col("sale_date").between(F.lit(start), F.lit(end)))


def top_categories(categories: DataFrame, top: int = 12) -> DataFrame:
    return categories.orderBy(F.col("net_sales_cents").desc(), "category_name").limit(top)


def staleness_label(days: Column) -> Column:
    return F.when(days == 0, "today").when(days == 1, "yesterday").otherwise(F.concat(days.cast("string"), F.lit(" days ago")))


def staleness_level(days: Column) -> Column:
    return F.when(days <= 1, "good").otherwise("warning")


def margin_rows(margin: DataFrame) -> DataFrame:
    return margin.where("gross_profit_cents is not null").orderBy(F.col("gross_profit_cents").desc())


def average(a: Column, b: Column) -> Column:
    return rounded(a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0)), 2)
