"""Forecasts: weekly units by item (least squares) and daily revenue (weekday average times trend)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import cents, clamp, date_diff_in, day_name, day_of_week_iso, integers, percent, ratio, rounded, week_start
from .kpi import daily_sales, item_weekly_sales
from .star import Star, as_date

WEEKS, HORIZON = 8, 4
HORIZONS = (("Tomorrow", 1, 1), ("Next 7 days", 7, 2), ("Next 30 days", 30, 3))


def item_forecast(star: Star) -> DataFrame:
    """The next four weeks of each item sold in the last eight whole weeks; a series starts at its first week."""
    this_week = week_start(as_date(star.as_of))
    weekly = item_weekly_sales(star).where((F.col("week_start") < this_week) & (F.col("week_start") >= F.date_sub(this_week, 7 * WEEKS)))
    span = weekly.groupBy("variation_id").agg(
        F.max("item_name").alias("item_name"), F.min("week_start").alias("first_week"), F.collect_list(F.struct(F.col("week_start").alias("w"), F.col("units_sold").cast("double").alias("u"))).alias("sold"),
    )
    # Least squares over weeks 0..n-1 from the first; weeks without sales add 0 to the sums.
    n = date_diff_in("week", F.col("first_week"), this_week).cast("double")
    add = lambda f: F.aggregate("sold", F.lit(0.0), lambda a, x: a + f(x))
    index = lambda x: (F.datediff(x["w"], F.col("first_week")) / 7).cast("double")
    fit = span.withColumns({"n": n, "sy": add(lambda x: x["u"]), "sxy": add(lambda x: index(x) * x["u"])})
    sx, sxx = F.col("n") * (F.col("n") - 1) / 2, F.col("n") * (F.col("n") - 1) * (2 * F.col("n") - 1) / 6
    slope = (F.col("n") * F.col("sxy") - sx * F.col("sy")) / F.nullif(F.col("n") * sxx - sx * sx, F.lit(0.0))
    fit = fit.withColumn("slope", slope).withColumn("base", (F.col("sy") - F.col("slope") * sx) / F.col("n"))
    trend = (F.col("n") >= 2) & F.col("slope").isNotNull()
    at = F.col("n") - 1 + 1 + F.col("weeks_ahead")
    # The line is fitted in doubles: nine places are kept before halves are rounded, so that noise does not decide them.
    units = F.when(trend, rounded(F.round(F.col("base") + F.col("slope") * at, 9))).otherwise(rounded(F.col("sy") / F.col("n")))
    return fit.withColumn("weeks_ahead", F.explode(F.sequence(F.lit(1), F.lit(HORIZON)))).select(
        "variation_id", "item_name", F.date_add(this_week, F.col("weeks_ahead") * 7).alias("forecast_week_start"), "weeks_ahead", F.col("n").cast("long").alias("weeks_of_history"),
        F.greatest(F.lit(0.0), units).alias("forecast_units"), F.when(trend, "linear_trend").otherwise("avg_fallback").alias("method"),
    )


def _profile(daily: DataFrame, last: str) -> DataFrame:
    """One row: sums and counts by weekday of the 56 days up to `last`, the trend and the flat average. Over one row a day."""
    d = daily.where((F.col("sale_date") > F.date_sub(last, 56)) & (F.col("sale_date") <= F.col(last)))
    late = F.col("sale_date") > F.date_sub(last, 28)
    net = F.col("net_sales_cents")
    trend = F.coalesce(ratio(F.sum(F.when(late, net)), F.sum(F.when(~late, net))), F.lit(1.0))
    days = [F.struct(F.sum(F.when(day_of_week_iso("sale_date") == k, net)).alias("cents"), F.count(F.when(day_of_week_iso("sale_date") == k, net)).alias("days")) for k in range(1, 8)]
    return d.agg(F.array(*days).alias("weekdays"), clamp(trend, 0.5, 2.0).alias("trend"), (F.sum(net).cast("double") / F.count(net)).alias("flat"))


def _weekday_average(day):
    own = F.get("weekdays", day_of_week_iso(day) - 1)
    return ratio(own["cents"], own["days"]), own["days"]


def revenue_forecast_daily(star: Star, daily: DataFrame | None = None) -> DataFrame:
    """31 days ahead: the weekday's average of 56 days times the trend of the last 28."""
    daily = daily if daily is not None else daily_sales(star)
    anchor = daily.agg(F.max("sale_date").alias("as_of_date"))
    profile = _profile(daily.crossJoin(F.broadcast(anchor)), "as_of_date")
    ahead = integers(daily.sparkSession, 1, 31).withColumnRenamed("n", "days_ahead").crossJoin(F.broadcast(anchor)).crossJoin(F.broadcast(profile))
    ahead = ahead.withColumn("forecast_date", F.date_add("as_of_date", F.col("days_ahead")))
    average, seen = _weekday_average("forecast_date")
    return ahead.where(seen > 0).select(
        "forecast_date", "days_ahead", day_name("forecast_date").alias("day_name"), day_of_week_iso("forecast_date").alias("day_of_week"), cents(average * F.col("trend")).alias("forecast_net_sales_cents"),
        cents(average).alias("weekday_avg_cents"), rounded(F.col("trend"), 3).alias("trend_factor"), seen.alias("weeks_of_history"), F.lit("weekday_average_x_trend").alias("method"), "as_of_date",
    )


def revenue_forecast(star: Star) -> DataFrame:
    """Sums over 1, 7 and 30 days, with the error of the same method on the last 28 days."""
    daily = daily_sales(star)
    split = daily.agg(F.date_sub(F.max("sale_date"), 28).alias("split_date"))
    with_split = daily.crossJoin(F.broadcast(split))
    scored = with_split.where("sale_date > split_date").crossJoin(F.broadcast(_profile(with_split, "split_date")))
    average, seen = _weekday_average("sale_date")
    miss, flat_miss = F.abs(F.col("net_sales_cents") - average * F.col("trend")), F.abs(F.col("net_sales_cents") - F.col("flat"))
    errors = scored.where(seen > 0).agg(
        percent(F.sum(miss), F.sum("net_sales_cents"), 1).alias("wape_pct"), percent(F.sum(flat_miss), F.sum("net_sales_cents"), 1).alias("baseline_wape_pct"),
        cents(F.sum(miss) / F.count(miss)).alias("mae_cents"), F.count("*").alias("backtest_days"),
    )
    horizons = daily.sparkSession.createDataFrame(list(HORIZONS), "horizon_label string, horizon_days int, horizon_order int")
    f = revenue_forecast_daily(star, daily)
    out = f.join(F.broadcast(horizons), F.col("days_ahead") <= F.col("horizon_days")).groupBy("horizon_label", "horizon_days", "horizon_order").agg(
        F.min("forecast_date").alias("period_start"), F.max("forecast_date").alias("period_end"), F.sum("forecast_net_sales_cents").alias("forecast_net_sales_cents"), F.count("*").alias("n"),
        F.max("trend_factor").alias("trend_factor"), F.max("method").alias("method"), F.max("as_of_date").alias("as_of_date"),
    )
    return out.crossJoin(F.broadcast(errors)).select(
        "horizon_label", "horizon_days", "horizon_order", "period_start", "period_end", "forecast_net_sales_cents", cents(F.col("forecast_net_sales_cents").cast("double") / F.col("n")).alias("forecast_daily_avg_cents"),
        "trend_factor", "method", "wape_pct", "baseline_wape_pct", "mae_cents", "backtest_days", rounded(F.col("baseline_wape_pct") - F.col("wape_pct"), 1).alias("points_better_than_baseline"), "as_of_date",
    )
