"""Tables by order and by day: windows summed from them equal distinct counts over the lines, orders of several days included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stallmark.functions.scalar import item_key_or_custom, week_start
from stallmark.operators import kpi, range_functions, star
from stallmark.operators.windows import Windows
from stallmark.plans import retail
from stallmark.sources import gold

START, END = dt.date(2001, 5, 1), dt.date(2001, 7, 31)


def spoiled(s):
    """Lines of which every fifth order has some on the next day, every seventh some two hours later, and some have no order."""
    key, n = F.col("square_order_id").cast("long"), F.substring_index("square_line_item_uid", "-", 1).cast("int")
    later = F.when((key % 5 == 0) & (n % 2 == 0), F.expr("interval 24 hours")).when((key % 7 == 0) & (n % 2 == 1), F.expr("interval 2 hours")).otherwise(F.expr("interval 0 hours"))
    lines = s.lines.withColumn("closed_at_local", F.col("closed_at_local") + later).withColumn("sale_date", F.col("closed_at_local").cast("date"))
    return lines.withColumn("square_order_id", F.when(key % 11 != 0, F.col("square_order_id")))


@pytest.fixture(scope="module", params=["stored", "lazy"])
def both(request, spark, sf):
    s = retail.star(spark, sf)
    lines = gold.materialised(spoiled(s), gold.gold_root(spark, "spoiled", request.param), "lines")
    out = star.Star(s.staged, s.as_of, s.lottery, gold.gold_root(spark, "spoiled-star", request.param) if request.param == "stored" else None)
    out.__dict__["lines"] = lines
    return out, lines.where("sale_date is not null")


def dated(lines, start=START, end=END):
    return lines.where(F.col("sale_date").between(F.lit(start), F.lit(end)))


def counts(df, *by):
    return sorted((*(str(r[c]) for c in by), r.orders) for r in df.select(*by, "orders").collect())


def distinct_orders(lines, *by):
    return lines.groupBy(*by).agg(F.countDistinct("square_order_id").alias("orders"))


def test_split_orders_count_once_in_a_window(both):
    s, lines = both
    now = dated(lines)
    assert s.split_orders.count() > 50
    days = distinct_orders(now, "sale_date").agg(F.sum("orders")).first()[0]
    whole = now.agg(F.countDistinct("square_order_id")).first()[0]
    assert days > whole  # a sum over days alone would count them twice
    assert kpi.over_range(kpi.summary, s, START, END).first().orders == whole
    assert range_functions.called(s, "summary", START, END).first().orders == whole


def test_groups_of_a_window(both):
    s, lines = both
    now = dated(lines)
    category = now.join(s.items.select("item_key", F.col("category_name").alias("c")), "item_key", "left").withColumn("category_name", F.coalesce("c", F.lit("Uncategorized")))
    item = now.withColumn("variation_id", item_key_or_custom("catalog_object_id", "item_name"))
    hour = now.withColumn("hour_of_day", F.hour("closed_at_local")).withColumn("day_of_week", F.weekday("sale_date") + 1)
    for name, rows, by in (("category", category, ["category_name"]), ("items", item, ["variation_id"]), ("hour", hour, ["hour_of_day"]), ("weekday", hour, ["day_of_week"]), ("popular_times", hour, ["day_of_week", "hour_of_day"])):
        assert counts(kpi.over_range(kpi.RANGES[name], s, START, END), *by) == counts(distinct_orders(rows, *by), *by), name


def test_weeks_days_and_coverage(both):
    s, lines = both
    assert counts(kpi.daily_sales(s).where("line_items > 0"), "sale_date") == counts(distinct_orders(lines, "sale_date"), "sale_date")
    item = lines.withColumn("variation_id", item_key_or_custom("catalog_object_id", "item_name")).withColumn("week_start", week_start("sale_date"))
    assert counts(kpi.item_weekly_sales(s), "week_start", "variation_id") == counts(distinct_orders(item, "week_start", "variation_id"), "week_start", "variation_id")
    got, want = kpi.data_coverage(s).first(), lines.agg(F.countDistinct("square_order_id"), F.max("closed_at_local")).first()
    assert (got.orders, got.last_order_at) == tuple(want)


def test_periods_read_day_rows_only(spark, sf):
    s = retail.build_gold(spark, sf)
    for name, operator in kpi.RANGES.items():
        scanned = operator(s, Windows(s.periods)).inputFiles()
        assert scanned and not [f for f in scanned if "/fact_order_line" in f or "/fact_payment" in f], name
    assert s.split_orders is None and s.split_lines is None  # every order of these tables lies in one slot


def test_orders_meet_payments_without_an_exchange(spark, sf):
    df = kpi.reconciliation(retail.build_gold(spark, sf))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert not [f for f in df.inputFiles() if "/fact_" in f]


def test_buckets_follow_the_rows_and_are_released(spark, sf, monkeypatch):
    s = retail.build(spark, sf)
    monkeypatch.setattr(gold, "BUCKET_ROWS", 1000)
    n = -(-s.lines.count() // 1000)
    assert f"SelectedBucketsCount: {n} out of {n}" in s.order_totals.join(s.order_payments, "square_order_id", "full")._jdf.queryExecution().executedPlan().toString()
    name = next(t for t in gold._tables[s.root] if t.startswith("order_totals"))
    assert spark.catalog.tableExists(name)
    assert gold.release(spark, sf) >= 1 and not spark.catalog.tableExists(name)
    retail._stars.clear()
    range_functions._registered.clear()


def test_empty_lines(spark, sf):
    s = retail.star(spark, sf)
    none = star.Star(s.staged, s.as_of, s.lottery)
    none.__dict__["lines"] = s.lines.limit(0)
    assert kpi.data_coverage(none).first().orders == 0
    assert kpi.over_range(kpi.summary, none, START, END).first().orders == 0
    assert kpi.over_range(kpi.by_item, none, START, END).count() == 0
