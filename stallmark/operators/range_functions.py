"""The range relations as SQL table functions of two dates.

`register` creates them in the session: `SELECT * FROM range_summary(DATE '2001-05-01', DATE '2001-05-31')`, or for every
row of a table `FROM dim_period p, LATERAL range_summary(p.period_start, p.period_end) r`. With literal dates the
bounds reach the scan; in a lateral call the windows are a small table that each day table meets once. The bodies take the
two dates in one place (w), so that Spark can turn a lateral call into joins. A window that ends before it
starts has no rows, and zeros in the summary.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kpi
from .daily import with_split
from .star import Star, as_date

#: Functions of one expression each that the bodies share.
_SCALAR = {
    "rl_round(x DOUBLE, n INT) RETURNS DOUBLE": "sign(x) * floor(abs(x) * power(10, n) + 0.5D) / power(10, n)",
    "rl_pct(part DOUBLE, whole DOUBLE, n INT) RETURNS DOUBLE": "rl_round(100.0D * part / nullif(whole, 0.0D), n)",
    "rl_change(now DOUBLE, prior DOUBLE, whole_window BOOLEAN) RETURNS DOUBLE": "CASE WHEN whole_window THEN rl_round(100.0D * (now - prior) / nullif(prior, 0.0D), 1) END",
}
_W = """WITH w AS (SELECT p_start AS s, p_end AS e, datediff(p_end, p_start) + 1 AS n, date_sub(p_start, datediff(p_end, p_start) + 1) AS ps, date_sub(p_start, 1) AS pe),
f AS (SELECT w.*, ps >= first_sale_date AS full_prior FROM w CROSS JOIN rl_span)"""
_BOTH = "FROM rl_{} JOIN w ON sale_date BETWEEN ps AND e"
_NOW = "FROM rl_slot JOIN w ON sale_date BETWEEN s AND e"


def _now(what: str, agg: str = "sum") -> str:
    return f"{agg}(CASE WHEN sale_date >= s THEN {what} END)"


def _prior(what: str, agg: str = "sum") -> str:
    return f"{agg}(CASE WHEN sale_date < s THEN {what} END)"


_SUMS = ("gross_sales_cents", "discount_cents", "tax_cents", "net_sales_cents")
#: Distinct orders: those of one slot add up by day, the others (views have their ids by day) are counted in the window.
_ORDERS = f"coalesce({_now('orders')}, 0) + {_now('split_order', 'count')}".replace("count(CASE", "count(DISTINCT CASE")
_ALL_ORDERS = "sum(orders) + count(DISTINCT split_order)"
#: What counts split orders; 0 where there are none, as a distinct count multiplies the rows that are shuffled.
_OF_SPLIT = ("count(DISTINCT split_order)", *(f"count(DISTINCT CASE WHEN sale_date {x} s THEN split_order END)" for x in (">=", "<")))
BODIES = {
    "window": "SELECT s, e, n, ps, pe, full_prior FROM f",
    "summary": f""", sold AS (
  SELECT {_ORDERS} AS orders, {_ORDERS.replace(">= s", "< s")} AS p_orders, count(CASE WHEN sale_date < s THEN 1 END) AS p_lines, {_now("units")} AS units, {_prior("units")} AS p_units,
    {", ".join(f"{_now(c)} AS {c}" for c in _SUMS)}, {_prior("net_sales_cents")} AS p_net {_BOTH.format("slot")}
), paid AS (SELECT sum(amount_cents) AS collected_cents, sum(processing_fee_cents) AS processing_fee_cents FROM rl_payment JOIN w ON pay_date BETWEEN s AND e),
costed AS (
  SELECT sum(costed) AS costed, sum(cogs_cents) AS cogs_cents, sum(gross_profit_cents) AS gross_profit_cents, sum(all_net) AS all_net
  FROM rl_margin JOIN w ON sale_date BETWEEN s AND e
), one AS (SELECT * FROM f CROSS JOIN sold CROSS JOIN paid CROSS JOIN costed)
SELECT n, s, e, ps, pe, orders, coalesce(units, 0), {", ".join(f"coalesce({c}, 0)" for c in _SUMS)},
  CASE WHEN orders > 0 THEN rl_round(CAST(net_sales_cents AS DOUBLE) / CAST(orders AS DOUBLE), 0) ELSE 0.0D END, CASE WHEN orders > 0 THEN rl_round(CAST(units AS DOUBLE) / CAST(orders AS DOUBLE), 2) ELSE 0.0D END,
  coalesce(collected_cents, 0), coalesce(processing_fee_cents, 0), full_prior, CASE WHEN full_prior THEN p_net END, CASE WHEN full_prior AND p_lines > 0 THEN p_orders END, CASE WHEN full_prior THEN p_units END,
  rl_change(coalesce(net_sales_cents, 0), p_net, full_prior), rl_change(orders, CASE WHEN p_lines > 0 THEN p_orders END, full_prior), rl_change(coalesce(units, 0), p_units, full_prior), cogs_cents, gross_profit_cents,
  CASE WHEN costed > 0 THEN rl_pct(gross_profit_cents, costed, 2) END, CASE WHEN all_net > 0 THEN rl_pct(costed, all_net, 1) END FROM one""",
    "category": f""", c AS (
  SELECT category_name, {_ORDERS} AS orders, {_now("units")} AS units, {_now("net_sales_cents")} AS net, {_prior("net_sales_cents")} AS p_net {_BOTH.format("category")}
  GROUP BY category_name HAVING {_now("1", "count")} > 0
), t AS (SELECT *, sum(net) OVER () AS total FROM c)
SELECT category_name, orders, units, net, rl_pct(net, CASE WHEN total > 0 THEN total END, 2), CASE WHEN full_prior THEN p_net END, rl_change(net, p_net, full_prior) FROM t CROSS JOIN f""",
    "weekday": f""", d AS (SELECT weekday(sale_date) + 1 AS dow, date_format(sale_date, 'EEEE') AS name, {_ALL_ORDERS} AS orders, sum(net_sales_cents) AS net {_NOW} GROUP BY ALL)
SELECT dow, name, dow >= 6, orders, net, CASE WHEN orders > 0 THEN rl_round(CAST(net AS DOUBLE) / CAST(orders AS DOUBLE), 0) ELSE 0.0D END FROM d""",
    "hour": f"SELECT hour_of_day AS h, {_ALL_ORDERS}, sum(net_sales_cents) {_NOW} GROUP BY ALL",
    "popular_times": f""", d AS (
  SELECT weekday(sale_date) + 1 AS dow, date_format(sale_date, 'EEEE') AS name, hour_of_day AS h, count(DISTINCT sale_date) AS days, {_ALL_ORDERS} AS orders, sum(net_sales_cents) AS net {_NOW} GROUP BY ALL
), t AS (SELECT *, max(orders) OVER (PARTITION BY dow) AS peak FROM d)
SELECT dow, name, h, days, orders, net, rl_round(CAST(orders AS DOUBLE) / CAST(days AS DOUBLE), 1), rl_pct(orders, peak, 0) FROM t""",
    "payments": """, d AS (SELECT source_type, sum(payments) AS payments, sum(amount_cents) AS amount, sum(processing_fee_cents) AS fee FROM rl_payment JOIN w ON pay_date BETWEEN s AND e GROUP BY source_type),
t AS (SELECT *, sum(amount) OVER () AS total FROM d) SELECT source_type, payments, amount, fee, rl_pct(amount, CASE WHEN total > 0 THEN total END, 2) FROM t""",
    "items": f""", i AS (
  SELECT variation_id, {_now("item_name", "max")} AS item_name, {_now("variation_name", "max")} AS variation_name, {_now("units")} AS units, {_ORDERS} AS orders, {_now("net_sales_cents")} AS net,
    {_prior("units")} AS p_units, {_prior("net_sales_cents")} AS p_net {_BOTH.format("sold_item")} GROUP BY variation_id HAVING {_now("1", "count")} > 0
)
SELECT i.variation_id, i.item_name, i.variation_name, a.category_name, coalesce(a.is_lottery, false), units, orders, net, rl_round(CAST(units AS DOUBLE) * 7.0D / CAST(n AS DOUBLE), 2),
  CASE WHEN full_prior THEN p_units END, CASE WHEN full_prior THEN p_net END, rl_change(units, p_units, full_prior), rl_change(net, p_net, full_prior), units_all_time, first_sold_at, last_sold_at
FROM i CROSS JOIN f LEFT JOIN rl_life l ON l.variation_id = i.variation_id LEFT JOIN rl_item a ON a.variation_id = i.variation_id""",
}

_registered: dict[int, Star] = {}


def register(star: Star) -> list[str]:
    """Creates the functions range_window, range_summary ... over the tables of a star (and the views that they read); their names."""
    spark = star.lines.sparkSession
    names = [f"range_{n}" for n in BODIES]
    if _registered.get(id(spark)) is star:
        return names
    split = star.split_lines
    life = star.day_items.groupBy("variation_id").agg(F.sum("units").alias("units_all_time"), F.min("sale_date").alias("first_sold_at"), F.max("sale_date").alias("last_sold_at"))
    views = {
        "rl_slot": with_split(star.day_slots, split, "hour_of_day"), "rl_category": with_split(star.day_categories, split, "category_name"), "rl_sold_item": with_split(star.day_items, split, "variation_id"),
    }
    if split is None:
        views = {name: df.withColumn("split_order", F.lit(None).cast("string")) for name, df in views.items()}
    views |= {
        "rl_payment": star.day_tenders, "rl_life": life, "rl_margin": star.day_margins, "rl_item": star.items.select(F.col("square_catalog_object_id").alias("variation_id"), "category_name", "is_lottery"),
        "rl_span": star.day_slots.agg(F.coalesce(F.min("sale_date"), as_date(star.as_of)).alias("first_sale_date")),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    star.periods.createOrReplaceTempView("dim_period")
    for head, body in _SCALAR.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    day = dt.date(2000, 1, 1)
    for name, body in BODIES.items():
        for counted in _OF_SPLIT if split is None else ():
            body = body.replace(counted, "0L")
        like = kpi.range_window(star, day, day) if name == "window" else kpi.over_range(kpi.RANGES[name], star, day, day)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in like.schema)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION range_{name}(p_start DATE, p_end DATE) RETURNS TABLE ({columns}) RETURN {_W} {body}")
    _registered[id(spark)] = star
    return names


def called(star: Star, name: str, start: dt.date, end: dt.date) -> DataFrame:
    """SELECT * FROM range_<name>(start, end)."""
    register(star)
    return star.lines.sparkSession.sql(f"SELECT * FROM range_{name}(DATE '{start}', DATE '{end}')")


def over_table(star: Star, name: str, windows: str = "dim_period", keep: str = "w.period_label, w.period_order") -> DataFrame:
    """The relation of every row of a table or view with period_start and period_end, by a lateral call."""
    register(star)
    return star.lines.sparkSession.sql(f"SELECT {keep}, r.* FROM {windows} w, LATERAL range_{name}(w.period_start, w.period_end) r")


def functions(spark: SparkSession) -> list[str]:
    """The range functions that are registered in the session."""
    return sorted(r.function for r in spark.sql("SHOW USER FUNCTIONS LIKE 'range_*'").collect())
