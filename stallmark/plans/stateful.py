"""Registered queries of the stateful operators, the views and the checks, with their SQL."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import item_label, normalize_category
from ..operators import checks, forecast, kpi, range_functions, silver, views
from ..operators.merge import VersionedTable, as_of_join, incremental, merge, scd2, scd2_snapshot
from ..operators.star import Star, dim_item_history, fact_order_line
from ..operators.windows import Windows
from ..sources import bronze
from ..streaming.bronze_stream import merge_stream
from .oracle import PERIOD_NAMES, QUERIES, STAR, over_periods, over_range
from .retail import AS_OF, END, LOTTERY, START, VERSION_TIME, catalog_snapshot, star, table

CAPTURED = dt.datetime(1998, 6, 1)
OLD_STATE = "2001-07-20"


def merged_lines(s: Star) -> DataFrame:
    """An old state of the fact with other amounts, and the merge of the present one into it."""
    old = s.lines.where(F.col("order_updated_at") < F.lit(OLD_STATE).cast("timestamp_ntz")).withColumn("net_sales_cents", F.col("net_sales_cents") + 1)
    return merge(old, s.lines).select("order_line_key", "order_updated_at", "net_sales_cents")


def _old_lines(s: Star) -> DataFrame:
    return s.lines.where(F.col("order_updated_at") < F.lit(OLD_STATE).cast("timestamp_ntz")).withColumn("net_sales_cents", F.col("net_sales_cents") + 1)


def _stored(s: Star, cluster: str | None = None) -> VersionedTable:
    return VersionedTable(s.lines.sparkSession, f"{s.root}/stored-{uuid.uuid4().hex}", cluster)


def merged_stored_lines(s: Star) -> DataFrame:
    """As merged_lines, in a stored table of which only the files with changed keys are written again."""
    stored = _stored(s, "order_updated_at")
    stored.publish(_old_lines(s))
    return incremental(stored, s.lines).select("order_line_key", "order_updated_at", "net_sales_cents")


def streamed_lines(s: Star) -> DataFrame:
    """An old state of the fact, stored, after a stream of all lines was added to it file by file."""
    stored = _stored(s)
    stored.publish(_old_lines(s))
    spark = s.lines.sparkSession
    stream = spark.readStream.schema(s.line_rows.schema).option("maxFilesPerTrigger", 4).parquet(f"{s.root}/fact_order_line")
    merge_stream(stream, fact_order_line, stored, f"{stored.path}/checkpoint", keep=1).awaitTermination()
    return stored.current().select("order_line_key", "order_updated_at", "net_sales_cents")


def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of captured_history from two captures into a stored table, with all columns."""
    full = catalog_snapshot(spark, sf_dir).drop("item_version_key", "valid_from", "valid_to", "version_captured_at")
    key = F.substring("variation_id", 2, 20).cast("long")
    stored = _stored(star(spark, sf_dir))
    scd2_snapshot(stored, full.where(key % 10 != 3), dt.datetime.fromisoformat(VERSION_TIME))
    later = full.where(key % 10 != 7).withColumn("category_name", F.when(key % 3 == 0, "Wine").otherwise(F.col("category_name")))
    return scd2_snapshot(stored, later, CAPTURED)


def differing_lines(s: Star, tolerance: float = 0.0) -> DataFrame:
    """Where the merge of merged_lines left other amounts than the fact has, beyond a relative tolerance."""
    return checks.compare_by_key(s.lines.select("order_line_key", "net_sales_cents"), merged_lines(s), ["order_line_key"], ["net_sales_cents"], tolerance)


def lost_lines(s: Star) -> DataFrame:
    """Rows of the merged fact that the fact does not hold."""
    return checks.row_differences(merged_lines(s), s.lines.select("order_line_key", "order_updated_at", "net_sales_cents"))


def captured_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog's history after a later capture in which parts changed, vanished and came."""
    key = F.substring("variation_id", 2, 20).cast("long")
    full = catalog_snapshot(spark, sf_dir)
    before = full.where(key % 10 != 3)
    source = full.drop("item_version_key", "valid_from", "valid_to", "version_captured_at").where(key % 10 != 7)
    source = source.withColumn("category_name", F.when(key % 3 == 0, "Wine").otherwise(F.col("category_name")))
    return scd2(before, source, CAPTURED)


def history_of(spark: SparkSession, sf_dir: str, s: Star) -> DataFrame:
    return dim_item_history(captured_history(spark, sf_dir), s.staged["category_overrides"], LOTTERY)


def sales_by_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = star(spark, sf_dir)
    j = as_of_join(s.lines, history_of(spark, sf_dir, s))
    return j.groupBy(F.col("h_category_name").alias("category_name"), F.col("h_version_number").alias("version_number")).agg(F.count("*").alias("order_lines"), F.sum("net_sales_cents").cast("long").alias("net_sales_cents"))


def newest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines share (order, line number): the latest shipped stays, on a tie the one with the largest part and supplier."""
    line = table(spark, sf_dir, "lineitem")
    position = F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")
    pages = line.select(F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity").alias("record"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("extracted_at"), F.lit("").alias("file"), position.alias("position"))
    return silver.latest(pages, [F.col("record.l_orderkey"), F.col("record.l_linenumber")], None).select("record.l_orderkey", "record.l_linenumber", "record.l_partkey", "record.l_suppkey", "record.l_shipdate")


def store_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of one local day of a store, by hour of UTC."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    own = e.where(bronze.in_store_day("ts", dt.date(2024, 1, 10), "America/Los_Angeles"))
    return own.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_utc"), "event_type").agg(F.count("*").alias("events"))


def category_starter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.sinks import category_override_starter

    return category_override_starter(catalog_snapshot(spark, sf_dir))


def _over(f):
    return lambda spark, sf_dir: f(star(spark, sf_dir))


def _range_items(s: Star) -> DataFrame:
    return kpi.over_range(kpi.by_item, s, START, END)


def _board(lottery: bool):
    return lambda s: views.top_sellers(_range_items(s), lottery).select("variation_id", "item_name", "units", "net_sales_cents")


def _trend(s: Star) -> DataFrame:
    t = views.weekly_trend(kpi.item_weekly_sales(s))
    return t.select("variation_id", F.array_join(F.transform("trend", lambda x: x.cast("long").cast("string")), ",").alias("trend"))


def _labels(s: Star) -> DataFrame:
    return s.items.select("square_catalog_object_id", item_label("item_name", "variation_name").alias("label"), normalize_category("category_name_raw").alias("category"))


def _search(s: Star) -> DataFrame:
    return views.item_search(_range_items(s), "RED", ("STANDARD", "SEASONAL"), 5, "revenue", 25).select("variation_id", "item_name", "category_name", "units", "net_sales_cents")


def category_over_periods(s: Star) -> DataFrame:
    """The range relation called for each canonical period."""
    periods = [(r.period_label, r.period_start, r.period_end) for r in s.periods.collect()]  # five rows
    return kpi.over_periods(kpi.by_category, s, periods)


def margin_rows(s: Star) -> DataFrame:
    return views.margin_rows(s.margin).select("order_line_key", "gross_profit_cents")


#: What a lateral call gives for All time and the relation of the period does not.
_LATERAL_DROP = {"summary": ("period_days", "prior_start", "prior_end"), "items": ("avg_weekly_units", "is_lottery")}


def _called(name: str):
    return lambda s: range_functions.called(s, name, START, END)


def _lateral(name: str):
    own = ("period_order",) if name == "popular_times" else ()
    return lambda s: range_functions.over_table(s, name).drop(*own, *_LATERAL_DROP.get(name, ()))


def queries() -> dict:
    return {f"sql_range_{n}": _over(_called(n)) for n in range_functions.BODIES} | {f"lateral_range_{n}": _over(_lateral(n)) for n in PERIOD_NAMES} | {
        "check_lines_that_differ": _over(differing_lines), "check_lines_that_differ_by_more": _over(lambda s: differing_lines(s, 1e-6)),
        "merge_stored_lines": _over(merged_stored_lines), "stream_stored_lines": _over(streamed_lines), "scd2_stored_history": stored_history,
        "merge_order_lines": _over(merged_lines),
        "scd2_history": lambda spark, sf_dir: captured_history(spark, sf_dir).select("variation_id", "category_name", "valid_from", "valid_to"),
        "as_of_sales_by_version": sales_by_version, "latest_version_dedupe": newest_lines, "store_day_events": store_day, "category_override_starter": category_starter,
        "view_weekly_trend": _over(_trend), "view_item_labels": _over(_labels), "view_item_search": _over(_search), "view_top_merchandise": _over(_board(False)), "view_top_lottery": _over(_board(True)),
        "view_lottery_share": _over(lambda s: views.lottery_share(_range_items(s))),
        "view_busiest_weekday": _over(lambda s: views.busiest_weekday(kpi.over_range(kpi.by_weekday, s, START, END))),
        "view_hour_grid": _over(lambda s: views.hour_grid(kpi.over_range(kpi.popular_times, s, START, END))),
        "view_revenue_series": _over(lambda s: views.revenue_series(kpi.daily_sales(s), forecast.revenue_forecast_daily(s))),
        "view_item_series": _over(lambda s: views.item_series(kpi.item_weekly_sales(s), forecast.item_forecast(s))),
        "view_reconciliation_rollup": _over(lambda s: views.reconciliation_rollup(kpi.reconciliation(s))),
        "view_daily_slice": _over(lambda s: views.daily_slice(kpi.daily_sales(s), START, END).select("sale_date", "orders", "net_sales_cents")),
        "view_top_categories": _over(lambda s: views.top_categories(kpi.over_range(kpi.by_category, s, START, END)).select("category_name", "net_sales_cents")),
        "check_unique_line_numbers": lambda spark, d: checks.unique(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber"),
        "check_dated_lines": _over(lambda s: checks.not_null(s.lines, "sale_date").select("order_line_key")),
        "check_order_status": lambda spark, d: checks.accepted_values(table(spark, d, "orders"), "o_orderstatus", "F", "O"),
        "check_paid_orders_have_lines": _over(lambda s: checks.relationships(s.payments, "square_order_id", s.lines, "square_order_id").select("square_order_id", "square_payment_id")),
        "check_item_key_resolves": _over(checks.item_key_resolves), "check_fact_matches_source": _over(checks.fact_matches_source), "check_calendar": _over(checks.calendar_covers_sales),
        "check_forecast_is_sane": _over(lambda s: checks.forecast_is_sane(forecast.item_forecast(s))), "check_local_time": _over(checks.local_time_is_right),
        "check_short_payments": _over(lambda s: checks.short_payments(kpi.reconciliation(s)).select("square_order_id", "variance_cents", "severity")),
        "check_history_well_formed": lambda spark, d: checks.history_well_formed(history_of(spark, d, star(spark, d))),
        "check_period_nesting": _over(lambda s: checks.narrower_within_wider(kpi.summary(s, Windows(s.periods)))),
        "check_peak_hour": _over(lambda s: checks.peak_hour_in(kpi.over_range(kpi.by_hour, s, START, END), 8, 12)),
        "check_freshness": _over(lambda s: checks.is_fresh(s, 2, AS_OF + dt.timedelta(10))),
        "check_range_equals_period": _over(checks.ranges_equal_periods), "range_category_over_periods": _over(category_over_periods), "view_margin_rows": _over(margin_rows),
        "check_history_fan_out": lambda spark, d: checks.history_fan_out_of(star(spark, d).lines, history_of(spark, d, star(spark, d))),
        "check_item_grain": _over(lambda s: checks.period_grain(kpi.by_item(s, Windows(s.periods)), "variation_id")),
        "check_period_coverage": _over(lambda s: checks.period_coverage(kpi.summary(s, Windows(s.periods)), s.periods)),
        "check_coverage_is_one_row": _over(lambda s: checks.single_row(kpi.data_coverage(s))),
    }


_SCD = """scd AS (
  SELECT 'P' || p_partkey AS variation_id, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS category_name, TIMESTAMP '1994-01-01' AS valid_from,
    CASE WHEN p_partkey % 10 <> 7 AND p_partkey % 3 = 0 THEN TIMESTAMP '1998-06-01' END AS valid_to FROM part WHERE p_partkey % 10 <> 3
  UNION ALL
  SELECT 'P' || p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Wine' ELSE upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) END, TIMESTAMP '1998-06-01', NULL FROM part
  WHERE p_partkey % 10 <> 7 AND (p_partkey % 10 = 3 OR p_partkey % 3 = 0)
)"""



def oracle_sql() -> dict[str, str]:
    items, popular = over_range("items"), over_range("popular_times")
    ahead = QUERIES["kpi_revenue_forecast_daily"]
    periods = over_periods("summary")
    called = {f"sql_range_{n}": QUERIES["range_window"] if n == "window" else over_range(n) for n in range_functions.BODIES}
    drop = lambda n: f" EXCLUDE ({', '.join(c for c in _LATERAL_DROP[n] if c != 'is_lottery')})" if n in _LATERAL_DROP else ""
    lateral = {f"lateral_range_{n}": f"SELECT *{drop(n)} FROM ({over_periods(n)})" for n in PERIOD_NAMES}
    merged = f"""{STAR} SELECT order_line_key, order_updated_at, net_sales_cents + CASE WHEN order_updated_at < (SELECT CAST(max(order_updated_at) AS DATE) - 7 FROM fact_order_line WHERE order_updated_at < TIMESTAMP '{OLD_STATE}') THEN 1 ELSE 0 END AS net_sales_cents FROM fact_order_line"""
    return called | lateral | {
        "check_lines_that_differ": f"""WITH m AS ({merged}), f AS ({STAR} SELECT order_line_key, net_sales_cents FROM fact_order_line)
  SELECT order_line_key, 'net_sales_cents' AS "column", CAST(f.net_sales_cents AS VARCHAR) AS a, CAST(m.net_sales_cents AS VARCHAR) AS b FROM f JOIN m USING (order_line_key) WHERE f.net_sales_cents <> m.net_sales_cents""",
        "check_lines_that_differ_by_more": f"""WITH m AS ({merged}), f AS ({STAR} SELECT order_line_key, net_sales_cents FROM fact_order_line)
  SELECT order_line_key, 'net_sales_cents' AS "column", CAST(f.net_sales_cents AS VARCHAR) AS a, CAST(m.net_sales_cents AS VARCHAR) AS b FROM f JOIN m USING (order_line_key)
  WHERE abs(f.net_sales_cents::DOUBLE - m.net_sales_cents::DOUBLE) > 1e-6::DOUBLE * greatest(abs(f.net_sales_cents::DOUBLE), abs(m.net_sales_cents::DOUBLE))""",
        "merge_stored_lines": merged, "stream_stored_lines": f"{STAR} SELECT order_line_key, order_updated_at, net_sales_cents FROM fact_order_line",
        "scd2_stored_history": f"""WITH {_SCD} SELECT md5(variation_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S')) AS item_version_key, variation_id, p_name AS item_name, p_brand AS variation_name, category_name,
  CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) AS price_cents, 'USD' AS currency, 'SKU' || p_partkey AS sku, p_partkey % 41 = 0 AS is_deleted, valid_from, valid_to, valid_from AS version_captured_at
  FROM scd JOIN part ON variation_id = 'P' || p_partkey""",
        "check_calendar": f"""{STAR}, s AS (SELECT min(sale_date) AS first_sale, max(sale_date) AS last_sale FROM lines), d AS (SELECT min(date_day) AS first_day, max(date_day) AS last_day, count(*) AS days, count(DISTINCT date_day) AS distinct_days FROM dim_date)
  SELECT * FROM s, d WHERE first_sale < first_day OR last_sale > last_day OR days <> distinct_days OR days <> last_day - first_day + 1""",
        "check_fact_matches_source": f"""{STAR}, f AS (SELECT count(*) AS n, sum(net_sales_cents) AS net, sum(tax_cents) AS tax, sum(quantity) AS units, count(DISTINCT order_line_key) AS keys FROM fact_order_line),
  s AS (SELECT count(*) AS n, sum(net_sales_cents) AS net, sum(tax_cents) AS tax, sum(quantity) AS units, count(DISTINCT (order_id, line_item_uid)) AS keys FROM stg_lines),
  both_ AS (SELECT unnest(['rows', 'net', 'tax', 'units', 'keys']) AS "column", unnest([f.n::VARCHAR, f.net::VARCHAR, f.tax::VARCHAR, f.units::VARCHAR, f.keys::VARCHAR]) AS a, unnest([s.n::VARCHAR, s.net::VARCHAR, s.tax::VARCHAR, s.units::VARCHAR, s.keys::VARCHAR]) AS b FROM f, s)
  SELECT 1 AS k, * FROM both_ WHERE a IS DISTINCT FROM b""",
        "check_forecast_is_sane": f"SELECT * FROM ({QUERIES['kpi_item_forecast']}) WHERE forecast_units IS NULL OR isnan(forecast_units) OR forecast_units < 0",
        "check_local_time": f"""{STAR}, l AS (SELECT f.*, timezone FROM fact_order_line f LEFT JOIN places USING (location_key))
  SELECT CASE WHEN (closed_at IS NULL) <> (sale_date IS NULL) THEN 'nullability_mismatch' ELSE 'offset_or_date_mismatch' END AS failure, order_line_key, closed_at, closed_at_local, sale_date FROM l
  WHERE (closed_at IS NULL) <> (sale_date IS NULL) OR (closed_at IS NOT NULL AND timezone <> 'UTC' AND (sale_date <> CAST(closed_at_local AS DATE) OR abs(date_sub('hour', closed_at_local, closed_at)) NOT BETWEEN 1 AND 23))""",
        "check_history_well_formed": f"""WITH {_SCD}, v AS (SELECT md5(variation_id) AS item_key, valid_from, valid_to, lead(valid_from) OVER (PARTITION BY variation_id ORDER BY valid_from) AS next_from FROM scd)
  SELECT item_key, CASE WHEN valid_to <= valid_from THEN 'backwards' WHEN next_from < valid_to THEN 'overlap' WHEN next_from > valid_to THEN 'gap' ELSE 'open_before_end' END AS fault FROM v
  WHERE valid_to <= valid_from OR next_from <> valid_to OR (valid_to IS NULL AND next_from IS NOT NULL)
  UNION ALL SELECT item_key, 'several_open' FROM v WHERE valid_to IS NULL GROUP BY 1 HAVING count(*) > 1""",
        "check_period_nesting": f"""WITH p AS ({periods}) SELECT a.period_label AS narrow, b.period_label AS wide FROM p a JOIN p b ON a.period_order < b.period_order AND a.period_start >= b.period_start
  AND (a.orders > b.orders OR a.units > b.units OR a.gross_sales_cents > b.gross_sales_cents)""",
        "check_range_equals_period": f"""WITH k AS ({over_periods("category")}), f AS ({STAR} SELECT l.sale_date, square_order_id, quantity, net_sales_cents, coalesce(category_name, 'Uncategorized') AS category_name FROM lines l LEFT JOIN dim_item USING (item_key)),
  p AS ({QUERIES["dim_period"]}), r AS (SELECT period_label, category_name, count(DISTINCT square_order_id) AS orders, CAST(sum(net_sales_cents) AS BIGINT) AS net_sales_cents FROM f JOIN p ON sale_date BETWEEN period_start AND period_end GROUP BY 1, 2)
  SELECT 'category' AS relation, period_label, category_name AS "key", 'orders or net_sales_cents' AS "column", CAST(k.orders AS VARCHAR) AS a, CAST(r.orders AS VARCHAR) AS b FROM k FULL JOIN r USING (period_label, category_name)
  WHERE k.orders IS DISTINCT FROM r.orders OR k.net_sales_cents IS DISTINCT FROM r.net_sales_cents""",
        "range_category_over_periods": f"SELECT * EXCLUDE (period_order) FROM ({over_periods('category')})",
        "view_margin_rows": f"{STAR} SELECT order_line_key, gross_profit_cents FROM fact_order_line_margin WHERE gross_profit_cents IS NOT NULL",
        "check_history_fan_out": f"""{STAR}, {_SCD} SELECT order_line_key, count(*) AS n FROM fact_order_line f JOIN scd v ON f.catalog_object_id = v.variation_id AND closed_at >= valid_from AND (valid_to IS NULL OR closed_at < valid_to) WHERE item_key IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
        "check_item_grain": f"SELECT period_label, variation_id, count(*) AS n FROM ({over_periods('items')}) GROUP BY 1, 2 HAVING count(*) > 1",
        "check_period_coverage": f"WITH s AS ({periods}), p AS ({QUERIES['dim_period']}) SELECT period_label FROM p WHERE period_label NOT IN (SELECT period_label FROM s)",
        "check_coverage_is_one_row": f"SELECT count(*) AS n FROM ({QUERIES['kpi_data_coverage']}) HAVING count(*) <> 1",
        "merge_order_lines": f"""{STAR} SELECT order_line_key, order_updated_at, net_sales_cents + CASE WHEN order_updated_at < (SELECT CAST(max(order_updated_at) AS DATE) - 7 FROM fact_order_line WHERE order_updated_at < TIMESTAMP '{OLD_STATE}') THEN 1 ELSE 0 END AS net_sales_cents FROM fact_order_line""",
        "scd2_history": f"WITH {_SCD} SELECT * FROM scd",
        "as_of_sales_by_version": f"""{STAR}, {_SCD}, versions AS (
  SELECT variation_id, CASE upper(category_name) WHEN 'PROMO' THEN 'SEASONAL' WHEN 'LARGE' THEN 'BULK' ELSE upper(category_name) END AS category_name, valid_from, valid_to, CAST(row_number() OVER (PARTITION BY variation_id ORDER BY valid_from) AS INTEGER) AS version_number FROM scd
) SELECT category_name, version_number, count(*) AS order_lines, CAST(sum(net_sales_cents) AS BIGINT) AS net_sales_cents FROM fact_order_line f JOIN versions v ON f.catalog_object_id = v.variation_id AND closed_at >= valid_from AND (valid_to IS NULL OR closed_at < valid_to) WHERE item_key IS NOT NULL GROUP BY 1, 2""",
        "latest_version_dedupe": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1",
        "store_day_events": "SELECT date_trunc('hour', ts) AS hour_utc, event_type, count(*) AS events FROM events WHERE ts >= TIMESTAMP '2024-01-10 08:00:00' AND ts < TIMESTAMP '2024-01-11 08:00:00' GROUP BY 1, 2",
        "category_override_starter": "SELECT upper(p_type) AS raw_category, upper(p_type) AS canonical_category, count(*) AS items FROM part GROUP BY 1",
        "view_weekly_trend": f"""{STAR}, weekly AS (SELECT CAST(date_trunc('week', sale_date) AS DATE) AS w, variation_id, sum(quantity) AS u FROM lines GROUP BY 1, 2), grid AS (SELECT DISTINCT w FROM weekly ORDER BY w DESC LIMIT 12),
  own AS (SELECT DISTINCT variation_id FROM weekly WHERE w IN (SELECT w FROM grid)) SELECT variation_id, string_agg(CAST(CAST(coalesce(u, 0) AS BIGINT) AS VARCHAR), ',' ORDER BY grid.w) AS trend FROM own CROSS JOIN grid LEFT JOIN weekly USING (variation_id, w) GROUP BY 1""",
        "view_item_labels": f"{STAR} SELECT square_catalog_object_id, item_name || ' — ' || variation_name AS label, upper(category_name_raw) AS category FROM dim_item",
        "view_item_search": f"SELECT variation_id, item_name, category_name, units, net_sales_cents FROM ({items}) WHERE lower(concat_ws(' ', item_name, variation_name, category_name)) LIKE '%red%' AND units >= 5 AND category_name IN ('STANDARD', 'SEASONAL') ORDER BY net_sales_cents DESC, variation_id LIMIT 25",
        "view_top_merchandise": f"SELECT variation_id, item_name, units, net_sales_cents FROM ({items}) WHERE NOT is_lottery ORDER BY units DESC, variation_id LIMIT 10",
        "view_top_lottery": f"SELECT variation_id, item_name, units, net_sales_cents FROM ({items}) WHERE is_lottery ORDER BY units DESC, variation_id LIMIT 10",
        "view_lottery_share": f"SELECT floor(100.0::DOUBLE * sum(CASE WHEN is_lottery THEN net_sales_cents ELSE 0 END)::DOUBLE / greatest(sum(net_sales_cents), 1)::DOUBLE * 10 + 0.5) / 10 AS lottery_share_pct FROM ({items})",
        "view_busiest_weekday": f"SELECT day_name, CAST(sum(orders) AS BIGINT) AS orders FROM ({over_range('weekday')}) GROUP BY 1 ORDER BY orders DESC, day_name LIMIT 1",
        "view_hour_grid": f"""WITH p AS ({popular}), h AS (SELECT CAST(unnest(generate_series(min(hour_of_day), max(hour_of_day))) AS INTEGER) AS hour_of_day FROM p), d AS (SELECT DISTINCT day_of_week, day_name FROM p)
  SELECT d.day_of_week, d.day_name, h.hour_of_day, coalesce(orders, 0) AS orders, coalesce(busyness_pct, 0) AS busyness_pct FROM d CROSS JOIN h LEFT JOIN p ON p.day_of_week = d.day_of_week AND p.hour_of_day = h.hour_of_day""",
        "view_revenue_series": f"""{STAR} SELECT sale_date AS day, net_sales_cents, 'actual' AS series FROM daily WHERE sale_date > (SELECT max(sale_date) FROM daily) - 28 UNION ALL SELECT forecast_date, forecast_net_sales_cents, 'forecast' FROM ({ahead})""",
        "view_item_series": f"""WITH w AS ({QUERIES["kpi_item_weekly_sales"]}), f AS ({QUERIES["kpi_item_forecast"]})
  SELECT variation_id, week_start AS week, CAST(units_sold AS DOUBLE) AS units, 'actual' AS series FROM w UNION ALL SELECT variation_id, forecast_week_start, forecast_units, 'forecast' FROM f
  UNION ALL SELECT variation_id, max(week_start), CAST(max_by(units_sold, week_start) AS DOUBLE), 'forecast' FROM w WHERE variation_id IN (SELECT variation_id FROM f) GROUP BY 1""",
        "view_reconciliation_rollup": f"WITH r AS ({QUERIES['rpt_order_payment_reconciliation']}) SELECT reconciliation_status, count(*) AS orders, floor(100.0::DOUBLE * (SELECT count(*) FROM r WHERE reconciliation_status IN ('matched', 'overpaid'))::DOUBLE / (SELECT count(*) FROM r)::DOUBLE * 10 + 0.5) / 10 AS tie_pct FROM r GROUP BY 1",
        "view_daily_slice": f"{STAR} SELECT sale_date, orders, net_sales_cents FROM daily WHERE sale_date BETWEEN DATE '{START}' AND DATE '{END}'",
        "view_top_categories": f"SELECT category_name, net_sales_cents FROM ({over_range('category')}) ORDER BY net_sales_cents DESC, category_name LIMIT 12",
        "check_unique_line_numbers": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
        "check_dated_lines": f"{STAR} SELECT order_line_key FROM fact_order_line WHERE sale_date IS NULL",
        "check_order_status": "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1",
        "check_paid_orders_have_lines": f"{STAR} SELECT square_order_id, square_payment_id FROM fact_payment WHERE square_order_id NOT IN (SELECT square_order_id FROM fact_order_line)",
        "check_short_payments": f"SELECT square_order_id, variance_cents, 'warn' AS severity FROM ({QUERIES['rpt_order_payment_reconciliation']}) WHERE reconciliation_status = 'short'",
        "check_freshness": f"{STAR} SELECT max(sale_date) AS last_sale FROM fact_order_line HAVING max(sale_date) IS NULL OR DATE '{AS_OF + dt.timedelta(10)}' - max(sale_date) > 2",
        "check_peak_hour": f"SELECT * FROM (SELECT hour_of_day, CAST(sum(orders) AS BIGINT) AS orders FROM ({over_range('hour')}) GROUP BY 1 ORDER BY orders DESC, hour_of_day LIMIT 1) WHERE hour_of_day NOT BETWEEN 8 AND 12",
        "check_item_key_resolves": f"{STAR} SELECT order_line_key, catalog_object_id, square_catalog_object_id FROM fact_order_line LEFT JOIN dim_item USING (item_key) WHERE item_key IS NOT NULL AND catalog_object_id IS DISTINCT FROM square_catalog_object_id",
    }



