"""The same model and queries as DuckDB SQL, against which the registered queries are compared."""

from __future__ import annotations

from .retail import AS_OF, END, START


def _r(x: str, n: int = 0) -> str:
    """Half away from zero, in doubles."""
    return f"(sign(CAST({x} AS DOUBLE)) * floor(abs(CAST({x} AS DOUBLE)) * {10.0**n} + 0.5) / {10.0**n})"


def _pct(a: str, b: str, n: int) -> str:
    return _r(f"100.0::DOUBLE * ({a})::DOUBLE / nullif(({b})::DOUBLE, 0)", n)


def _change(now: str, prior: str) -> str:
    return f"CASE WHEN w.prior_window_complete THEN {_r(f'100.0::DOUBLE * (({now})::DOUBLE - ({prior})::DOUBLE) / nullif(({prior})::DOUBLE, 0)', 1)} END"


_KEY = "coalesce(catalog_object_id, 'custom:' || coalesce(item_name, 'unknown'))"
_UNITS = "CAST(sum(quantity) AS DECIMAL(28, 4))"


def _sum(c: str) -> str:
    return f"CAST(sum({c}) AS BIGINT) AS {c}"


STAR = f"""WITH located AS (
  SELECT o.*, 'LOC' || n_regionkey AS location_id, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS placed_at
  FROM orders o LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
), places AS (
  SELECT CAST(row_number() OVER (ORDER BY 'LOC' || r_regionkey) AS BIGINT) AS location_key, 'LOC' || r_regionkey AS location_id, r_name AS location_name,
    CASE r_regionkey WHEN 0 THEN 'Africa/Lagos' WHEN 1 THEN 'America/Los_Angeles' WHEN 2 THEN 'Asia/Tokyo' WHEN 3 THEN 'Europe/Berlin' ELSE 'UTC' END AS timezone FROM region
), gross AS (SELECT *, CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS gross_sales_cents FROM lineitem),
discounted AS (SELECT *, CAST(floor(gross_sales_cents * l_discount + 0.5) AS BIGINT) AS discount_cents FROM gross),
netted AS (SELECT *, gross_sales_cents - discount_cents AS net_sales_cents FROM discounted),
stg_lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, concat_ws('-', l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d'), CAST(l_quantity AS INTEGER)) AS line_item_uid, location_id,
    CASE WHEN l_partkey % 17 <> 0 THEN 'P' || l_partkey END AS catalog_object_id, p_name AS item_name, p_brand AS variation_name, CAST(l_quantity AS DECIMAL(18, 4)) AS quantity,
    gross_sales_cents, discount_cents, CAST(floor(net_sales_cents * l_tax + 0.5) AS BIGINT) AS tax_cents, net_sales_cents,
    greatest(placed_at, l_shipdate) AS order_updated_at, CASE WHEN o_orderkey % 97 <> 0 THEN placed_at END AS closed_at
  FROM netted JOIN located ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey
), dim_item AS (
  SELECT md5('P' || p_partkey) AS item_key, 'P' || p_partkey AS square_catalog_object_id, p_name AS item_name, p_brand AS variation_name,
    CASE upper(p_type) WHEN 'PROMO' THEN 'SEASONAL' WHEN 'LARGE' THEN 'BULK' ELSE upper(p_type) END AS category_name, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS category_name_raw,
    upper(p_type) = 'MEDIUM' AS is_lottery, 'SKU' || p_partkey AS sku, CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) AS price_amount_cents, 'USD' AS currency, p_partkey % 41 = 0 AS is_deleted, p_partkey, p_size, p_retailprice FROM part
), fact_order_line AS MATERIALIZED (
  SELECT md5(order_id || '|' || line_item_uid) AS order_line_key, order_id AS square_order_id, line_item_uid AS square_line_item_uid, catalog_object_id, s.item_name, s.variation_name, location_key, item_key, closed_at,
    timezone(coalesce(timezone, 'UTC'), closed_at AT TIME ZONE 'UTC') AS closed_at_local, CAST(timezone(coalesce(timezone, 'UTC'), closed_at AT TIME ZONE 'UTC') AS DATE) AS sale_date,
    order_updated_at, quantity, gross_sales_cents, discount_cents, tax_cents, net_sales_cents
  FROM stg_lines s LEFT JOIN places USING (location_id) LEFT JOIN dim_item i ON i.square_catalog_object_id = s.catalog_object_id
), due AS (SELECT order_id, CAST(sum(net_sales_cents + tax_cents) AS BIGINT) AS due FROM stg_lines GROUP BY order_id),
paid AS (
  SELECT *, CASE WHEN o_orderkey % 3 = 0 AND due IS NOT NULL THEN due ELSE CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) END AS amount_cents
  FROM located LEFT JOIN due ON order_id = CAST(o_orderkey AS VARCHAR) WHERE o_orderstatus <> 'P'
), fact_payment AS (
  SELECT 'PAY' || o_orderkey AS square_payment_id, CAST(o_orderkey AS VARCHAR) AS square_order_id, location_key, placed_at AS created_at, timezone(coalesce(timezone, 'UTC'), placed_at AT TIME ZONE 'UTC') AS created_at_local,
    CAST(timezone(coalesce(timezone, 'UTC'), placed_at AT TIME ZONE 'UTC') AS DATE) AS pay_date, placed_at AS updated_at, 'COMPLETED' AS status, o_orderpriority AS source_type, amount_cents,
    CAST(floor(amount_cents * 0.026::DOUBLE + 10 + 0.5) AS BIGINT) AS processing_fee_cents, 'USD' AS currency
  FROM paid LEFT JOIN places USING (location_id)
), costs AS (SELECT 'P' || p_partkey AS variation_id, 'Vendor ' || (p_partkey % 7) AS vendor_name, CAST(floor(p_retailprice * 60 + 0.5) AS BIGINT) AS unit_cost_cents FROM part WHERE p_partkey % 5 <> 0),
dim_vendor AS (SELECT CAST(row_number() OVER (ORDER BY vendor_name) AS BIGINT) AS vendor_key, vendor_name, count(*) AS variation_count FROM costs GROUP BY vendor_name),
fact_order_line_margin AS (
  SELECT order_line_key, square_order_id, square_line_item_uid, f.item_key, vendor_key, category_name, c.vendor_name, quantity, net_sales_cents, unit_cost_cents,
    CAST({_r("unit_cost_cents::DOUBLE * quantity::DOUBLE")} AS BIGINT) AS cogs_cents, net_sales_cents - CAST({_r("unit_cost_cents::DOUBLE * quantity::DOUBLE")} AS BIGINT) AS gross_profit_cents,
    CASE WHEN unit_cost_cents IS NOT NULL AND net_sales_cents > 0 THEN {_pct("net_sales_cents - unit_cost_cents::DOUBLE * quantity::DOUBLE", "net_sales_cents", 2)} END AS gross_margin_pct, unit_cost_cents IS NOT NULL AS has_cost
  FROM fact_order_line f LEFT JOIN costs c ON c.variation_id = f.catalog_object_id LEFT JOIN dim_item i ON i.item_key = f.item_key LEFT JOIN dim_vendor v ON v.vendor_name = c.vendor_name
), span AS (SELECT min(sale_date) AS first_sale_date, max(sale_date) AS as_of_date FROM fact_order_line),
dim_date AS (SELECT CAST(d AS DATE) AS date_day FROM (SELECT unnest(generate_series(first_sale_date, as_of_date, INTERVAL 1 DAY)) AS d FROM span)),
dim_period AS (
  SELECT label AS period_label, days AS period_days, ord AS period_order, as_of_date, coalesce(as_of_date - days + 1, first_sale_date) AS period_start, as_of_date AS period_end,
    as_of_date - 2 * days + 1 AS prior_start, as_of_date - days AS prior_end, coalesce(as_of_date - 2 * days + 1 >= first_sale_date, false) AS prior_window_complete
  FROM (VALUES ('Last 7 days', 7, 1), ('Last 30 days', 30, 2), ('Last 90 days', 90, 3), ('Last 365 days', 365, 4), ('All time', NULL, 5)) v(label, days, ord), span
), lines AS (SELECT *, {_KEY} AS variation_id FROM fact_order_line WHERE sale_date IS NOT NULL),
daily AS (
  SELECT date_day AS sale_date, dayname(date_day) AS day_name, isodow(date_day) >= 6 AS is_weekend, count(DISTINCT square_order_id) AS orders, count(order_line_key) AS line_items,
    CAST(coalesce(sum(quantity), 0) AS DECIMAL(28, 4)) AS units, {", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in ("gross_sales_cents", "discount_cents", "tax_cents", "net_sales_cents"))}
  FROM dim_date LEFT JOIN fact_order_line ON sale_date = date_day GROUP BY date_day
)"""
_RANGE = f"""windows AS (
  SELECT *, prior_start >= first_sale_date AS prior_window_complete FROM (
    SELECT 'range' AS period_label, 1 AS period_order, {(END - START).days + 1} AS period_days, DATE '{START}' AS period_start, DATE '{END}' AS period_end,
      DATE '{START}' - {(END - START).days + 1} AS prior_start, DATE '{START}' - 1 AS prior_end), span
)"""
_PERIODS = "windows AS (SELECT * FROM dim_period)"
_IN = "JOIN windows w ON l.sale_date BETWEEN w.period_start AND w.period_end"
_BEFORE = "JOIN windows w ON l.sale_date BETWEEN w.prior_start AND w.prior_end"


def _summary() -> str:
    return f""", now AS (
  SELECT period_label, count(DISTINCT square_order_id) AS orders, {_UNITS} AS units, {_sum("gross_sales_cents")}, {_sum("discount_cents")}, {_sum("tax_cents")}, {_sum("net_sales_cents")} FROM lines l {_IN} GROUP BY ALL
), prior AS (SELECT period_label, count(DISTINCT square_order_id) AS p_orders, {_UNITS} AS p_units, CAST(sum(net_sales_cents) AS BIGINT) AS p_net FROM lines l {_BEFORE} GROUP BY ALL),
pay AS (SELECT period_label, CAST(sum(amount_cents) AS BIGINT) AS collected_cents, {_sum("processing_fee_cents")} FROM fact_payment l JOIN windows w ON l.pay_date BETWEEN w.period_start AND w.period_end GROUP BY ALL),
cost AS (
  SELECT period_label, sum(CASE WHEN has_cost THEN m.net_sales_cents END) AS costed, {_sum("cogs_cents")}, {_sum("gross_profit_cents")}, sum(m.net_sales_cents) AS all_net
  FROM fact_order_line_margin m JOIN lines l USING (order_line_key) {_IN} GROUP BY ALL
)
SELECT w.period_label, w.period_order, w.period_days, w.period_start, w.period_end, w.prior_start, w.prior_end, coalesce(orders, 0) AS orders, coalesce(units, 0) AS units, coalesce(gross_sales_cents, 0) AS gross_sales_cents,
  coalesce(discount_cents, 0) AS discount_cents, coalesce(tax_cents, 0) AS tax_cents, coalesce(net_sales_cents, 0) AS net_sales_cents,
  CASE WHEN orders > 0 THEN {_r("net_sales_cents::DOUBLE / orders::DOUBLE")} ELSE 0.0 END AS avg_order_value_cents, CASE WHEN orders > 0 THEN {_r("units::DOUBLE / orders::DOUBLE", 2)} ELSE 0.0 END AS units_per_order,
  coalesce(collected_cents, 0) AS collected_cents, coalesce(processing_fee_cents, 0) AS processing_fee_cents, w.prior_window_complete, CASE WHEN w.prior_window_complete THEN p_net END AS prior_net_sales_cents,
  CASE WHEN w.prior_window_complete THEN p_orders END AS prior_orders, CASE WHEN w.prior_window_complete THEN p_units END AS prior_units,
  {_change("coalesce(net_sales_cents, 0)", "p_net")} AS net_sales_change_pct, {_change("coalesce(orders, 0)", "p_orders")} AS orders_change_pct, {_change("coalesce(units, 0)", "p_units")} AS units_change_pct,
  cogs_cents, gross_profit_cents, CASE WHEN costed > 0 THEN {_pct("gross_profit_cents", "costed", 2)} END AS gross_margin_pct, CASE WHEN all_net > 0 THEN {_pct("costed", "all_net", 1)} END AS cost_coverage_pct
FROM windows w LEFT JOIN now USING (period_label) LEFT JOIN prior USING (period_label) LEFT JOIN pay USING (period_label) LEFT JOIN cost USING (period_label)"""


def _category(guard: str) -> str:
    return f""", cat AS (SELECT l.*, coalesce(category_name, 'Uncategorized') AS category FROM lines l LEFT JOIN dim_item i USING (item_key)),
now AS (SELECT period_label, category AS category_name, count(DISTINCT square_order_id) AS orders, {_UNITS} AS units, {_sum("net_sales_cents")} FROM cat l {_IN} GROUP BY ALL),
prior AS (SELECT period_label, category AS category_name, CAST(sum(net_sales_cents) AS BIGINT) AS p_net FROM cat l {_BEFORE} GROUP BY ALL),
shared AS (SELECT *, sum(net_sales_cents) OVER (PARTITION BY period_label) AS total FROM now)
SELECT w.period_label, w.period_order, category_name, orders, units, net_sales_cents, {_pct("net_sales_cents", guard, 2)} AS pct_of_net_sales, CASE WHEN w.prior_window_complete THEN p_net END AS prior_net_sales_cents,
  {_change("net_sales_cents", "p_net")} AS net_sales_change_pct FROM shared JOIN windows w USING (period_label) LEFT JOIN prior USING (period_label, category_name)"""


_WEEKDAY = f""", now AS (
  SELECT period_label, w.period_order, CAST(isodow(sale_date) AS INTEGER) AS day_of_week, dayname(sale_date) AS day_name, isodow(sale_date) >= 6 AS is_weekend, count(DISTINCT square_order_id) AS orders, {_sum("net_sales_cents")} FROM lines l {_IN} GROUP BY ALL
) SELECT *, {_r("net_sales_cents::DOUBLE / orders::DOUBLE")} AS avg_order_value_cents FROM now"""
_HOUR = f" SELECT period_label, w.period_order, CAST(hour(closed_at_local) AS INTEGER) AS hour_of_day, count(DISTINCT square_order_id) AS orders, {_sum('net_sales_cents')} FROM lines l {_IN} GROUP BY ALL"
_POPULAR = f""", slot AS (
  SELECT period_label, CAST(isodow(sale_date) AS INTEGER) AS day_of_week, dayname(sale_date) AS day_name, CAST(hour(closed_at_local) AS INTEGER) AS hour_of_day, count(DISTINCT sale_date) AS days_observed, count(DISTINCT square_order_id) AS orders,
    {_sum("net_sales_cents")} FROM lines l {_IN} GROUP BY ALL
), peaked AS (SELECT *, max(orders) OVER (PARTITION BY period_label, day_of_week) AS peak FROM slot)
SELECT * EXCLUDE (peak), {_r("orders::DOUBLE / days_observed::DOUBLE", 1)} AS orders_per_day, {_pct("orders", "peak", 0)} AS busyness_pct FROM peaked"""


def _payments(guard: str) -> str:
    return f""", now AS (
  SELECT period_label, w.period_order, source_type, count(*) AS payments, CAST(sum(amount_cents) AS BIGINT) AS amount_collected_cents, {_sum("processing_fee_cents")} FROM fact_payment l JOIN windows w ON l.pay_date BETWEEN w.period_start AND w.period_end GROUP BY ALL
), shared AS (SELECT *, sum(amount_collected_cents) OVER (PARTITION BY period_label) AS total FROM now)
SELECT * EXCLUDE (total), {_pct("amount_collected_cents", guard, 2)} AS pct_of_collected FROM shared"""


_ITEMS = f""", now AS (
  SELECT period_label, variation_id, max(item_name) AS item_name, max(variation_name) AS variation_name, count(DISTINCT square_order_id) AS orders, {_UNITS} AS units, {_sum("net_sales_cents")} FROM lines l {_IN} GROUP BY ALL
), prior AS (SELECT period_label, variation_id, {_UNITS} AS p_units, CAST(sum(net_sales_cents) AS BIGINT) AS p_net FROM lines l {_BEFORE} GROUP BY ALL),
life AS (SELECT variation_id, {_UNITS} AS units_all_time, min(sale_date) AS first_sold_at, max(sale_date) AS last_sold_at FROM lines GROUP BY ALL)
SELECT w.period_label, w.period_order, variation_id, now.item_name, now.variation_name, category_name, coalesce(is_lottery, false) AS is_lottery, units, orders, net_sales_cents,
  {_r("units::DOUBLE * 7.0::DOUBLE / w.period_days::DOUBLE", 2)} AS avg_weekly_units, CASE WHEN w.prior_window_complete THEN p_units END AS prior_units, CASE WHEN w.prior_window_complete THEN p_net END AS prior_net_sales_cents,
  {_change("units", "p_units")} AS units_change_pct, {_change("net_sales_cents", "p_net")} AS net_sales_change_pct, units_all_time, first_sold_at, last_sold_at
FROM now JOIN windows w USING (period_label) LEFT JOIN prior USING (period_label, variation_id) LEFT JOIN life USING (variation_id) LEFT JOIN dim_item i ON i.square_catalog_object_id = variation_id"""
_POSITIVE, _NOT_ZERO = "CASE WHEN total > 0 THEN total END", "total"
#: Relation -> (SQL for periods, SQL for a range).
RELATIONS = {
    "summary": (_summary(), _summary()), "category": (_category(_NOT_ZERO), _category(_POSITIVE)), "weekday": (_WEEKDAY, _WEEKDAY), "hour": (_HOUR, _HOUR), "popular_times": (_POPULAR, _POPULAR),
    "payments": (_payments(_NOT_ZERO), _payments(_POSITIVE)), "items": (_ITEMS, _ITEMS),
}


def over_periods(name: str) -> str:
    own = f"{STAR}, {_PERIODS}{RELATIONS[name][0]}"
    return f"SELECT * EXCLUDE (is_lottery) FROM ({own})" if name == "items" else own


def over_range(name: str) -> str:
    drop = "period_label" if name == "popular_times" else "period_label, period_order"
    return f"SELECT * EXCLUDE ({drop}) FROM ({STAR}, {_RANGE}{RELATIONS[name][1]})"


_TODAY = f"DATE '{AS_OF}'"
_FORECAST_DAILY = f"""anchor AS (SELECT max(sale_date) AS as_of_date FROM daily),
recent AS (SELECT d.*, as_of_date FROM daily d, anchor WHERE sale_date > as_of_date - 56),
profile AS (SELECT CAST(isodow(sale_date) AS INTEGER) AS dow, sum(net_sales_cents)::DOUBLE / count(*)::DOUBLE AS average, count(*) AS seen FROM recent GROUP BY 1),
factor AS (SELECT greatest(0.5, least(2.0, coalesce(sum(CASE WHEN sale_date > as_of_date - 28 THEN net_sales_cents END)::DOUBLE / nullif(sum(CASE WHEN sale_date <= as_of_date - 28 THEN net_sales_cents END)::DOUBLE, 0), 1.0))) AS trend FROM recent),
ahead AS (SELECT CAST(unnest(range(1, 32)) AS INTEGER) AS days_ahead),
forecast_daily AS (
  SELECT as_of_date + days_ahead AS forecast_date, days_ahead, dayname(as_of_date + days_ahead) AS day_name, dow AS day_of_week, CAST({_r("average * trend")} AS BIGINT) AS forecast_net_sales_cents,
    CAST({_r("average")} AS BIGINT) AS weekday_avg_cents, {_r("trend", 3)} AS trend_factor, seen AS weeks_of_history, 'weekday_average_x_trend' AS method, as_of_date
  FROM ahead, anchor, factor JOIN profile ON dow = isodow(as_of_date + days_ahead)
)"""
_BACKTEST = f"""split AS (SELECT max(sale_date) - 28 AS cut FROM daily),
train AS (SELECT d.*, cut FROM daily d, split WHERE sale_date <= cut AND sale_date > cut - 56),
t_profile AS (SELECT isodow(sale_date) AS dow, sum(net_sales_cents)::DOUBLE / count(*)::DOUBLE AS average FROM train GROUP BY 1),
t_factor AS (SELECT greatest(0.5, least(2.0, coalesce(sum(CASE WHEN sale_date > cut - 28 THEN net_sales_cents END)::DOUBLE / nullif(sum(CASE WHEN sale_date <= cut - 28 THEN net_sales_cents END)::DOUBLE, 0), 1.0))) AS trend, sum(net_sales_cents)::DOUBLE / count(*)::DOUBLE AS flat FROM train),
scored AS (SELECT net_sales_cents, abs(net_sales_cents - average * trend) AS miss, abs(net_sales_cents - flat) AS flat_miss FROM daily d, split, t_factor JOIN t_profile ON dow = isodow(d.sale_date) WHERE d.sale_date > cut),
errors AS (SELECT {_pct("sum(miss)", "sum(net_sales_cents)", 1)} AS wape_pct, {_pct("sum(flat_miss)", "sum(net_sales_cents)", 1)} AS baseline_wape_pct, CAST({_r("sum(miss) / count(*)")} AS BIGINT) AS mae_cents, count(*) AS backtest_days FROM scored)"""

QUERIES = {
    "kpi_daily_sales": f"""{STAR} SELECT *, CASE WHEN orders > 0 THEN {_r("net_sales_cents::DOUBLE / orders::DOUBLE")} ELSE 0.0 END AS avg_order_value_cents,
  CASE WHEN count(*) OVER week = 7 THEN {_r("(sum(net_sales_cents) OVER week)::DOUBLE / 7.0::DOUBLE")} END AS net_sales_7d_avg_cents FROM daily WINDOW week AS (ORDER BY sale_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "kpi_item_weekly_sales": f"{STAR} SELECT CAST(date_trunc('week', sale_date) AS DATE) AS week_start, variation_id, max(item_name) AS item_name, max(variation_name) AS variation_name, count(DISTINCT square_order_id) AS orders, {_UNITS} AS units_sold, {_sum('net_sales_cents')} FROM lines GROUP BY 1, 2",
    "kpi_item_forecast": f"""{STAR}, weekly AS (
  SELECT CAST(date_trunc('week', sale_date) AS DATE) AS week_start, variation_id, max(item_name) AS item_name, sum(quantity)::DOUBLE AS units FROM lines
  WHERE date_trunc('week', sale_date) < date_trunc('week', {_TODAY}) AND date_trunc('week', sale_date) >= date_trunc('week', {_TODAY}) - INTERVAL 56 DAY GROUP BY 1, 2
), spans AS (SELECT variation_id, max(item_name) AS item_name, min(week_start) AS first_week FROM weekly GROUP BY 1),
grid AS (
  SELECT s.variation_id, s.item_name, CAST(w AS DATE) AS week_start, (CAST(w AS DATE) - first_week)::DOUBLE / 7 AS x
  FROM spans s, unnest(generate_series(first_week, CAST(date_trunc('week', {_TODAY}) AS DATE) - 7, INTERVAL 7 DAY)) t(w)
), fit AS (
  SELECT variation_id, g.item_name, count(*) AS n, avg(coalesce(units, 0)) AS average, regr_slope(coalesce(units, 0)::DOUBLE, x) AS slope, regr_intercept(coalesce(units, 0)::DOUBLE, x) AS base
  FROM grid g LEFT JOIN weekly w USING (variation_id, week_start) GROUP BY ALL
)
SELECT variation_id, item_name, CAST(date_trunc('week', {_TODAY}) AS DATE) + 7 * h AS forecast_week_start, h AS weeks_ahead, CAST(n AS BIGINT) AS weeks_of_history,
  greatest(0.0, CASE WHEN n >= 2 AND slope IS NOT NULL THEN {_r("round(base + slope * (n + h), 9)")} ELSE {_r("average")} END) AS forecast_units,
  CASE WHEN n >= 2 AND slope IS NOT NULL THEN 'linear_trend' ELSE 'avg_fallback' END AS method FROM fit, (SELECT CAST(unnest(range(1, 5)) AS INTEGER) AS h)""",
    "kpi_revenue_forecast_daily": f"{STAR}, {_FORECAST_DAILY} SELECT * FROM forecast_daily",
    "kpi_revenue_forecast": f"""{STAR}, {_FORECAST_DAILY}, {_BACKTEST}
SELECT horizon_label, horizon_days, horizon_order, min(forecast_date) AS period_start, max(forecast_date) AS period_end, {_sum("forecast_net_sales_cents")},
  CAST({_r("sum(forecast_net_sales_cents)::DOUBLE / count(*)")} AS BIGINT) AS forecast_daily_avg_cents, max(trend_factor) AS trend_factor, max(method) AS method, wape_pct, baseline_wape_pct, mae_cents, backtest_days,
  {_r("baseline_wape_pct - wape_pct", 1)} AS points_better_than_baseline, max(as_of_date) AS as_of_date
FROM (VALUES ('Tomorrow', 1, 1), ('Next 7 days', 7, 2), ('Next 30 days', 30, 3)) v(horizon_label, horizon_days, horizon_order) JOIN forecast_daily ON days_ahead <= horizon_days, errors
GROUP BY horizon_label, horizon_days, horizon_order, wape_pct, baseline_wape_pct, mae_cents, backtest_days""",
    "kpi_data_coverage": f"""{STAR} SELECT min(sale_date) AS first_sale_date, max(sale_date) AS last_sale_date, max(closed_at_local) AS last_order_at, CAST(max(sale_date) - min(sale_date) + 1 AS BIGINT) AS days_covered, count(DISTINCT sale_date) AS days_with_sales,
  count(DISTINCT date_trunc('week', sale_date)) AS weeks_covered, count(DISTINCT CASE WHEN date_trunc('week', sale_date) < date_trunc('week', {_TODAY}) THEN sale_date END) AS days_in_complete_weeks,
  count(DISTINCT CASE WHEN date_trunc('week', sale_date) < date_trunc('week', {_TODAY}) THEN date_trunc('week', sale_date) END) AS complete_weeks_covered, count(DISTINCT square_order_id) AS orders, count(DISTINCT variation_id) AS items_sold,
  CAST(greatest(0, {_TODAY} - max(sale_date)) AS BIGINT) AS days_since_last_sale FROM lines""",
    "rpt_order_payment_reconciliation": f"""{STAR}, o AS (SELECT square_order_id, CAST(sum(net_sales_cents + tax_cents) AS BIGINT) AS order_total_cents FROM fact_order_line GROUP BY 1),
p AS (SELECT square_order_id, CAST(sum(amount_cents) AS BIGINT) AS paid_cents FROM fact_payment GROUP BY 1)
SELECT coalesce(o.square_order_id, p.square_order_id) AS square_order_id, order_total_cents, paid_cents, coalesce(order_total_cents, 0) - coalesce(paid_cents, 0) AS variance_cents,
  CASE WHEN o.square_order_id IS NULL THEN 'payment_without_order' WHEN p.square_order_id IS NULL THEN 'order_without_payment' WHEN abs(order_total_cents - paid_cents) <= 1 THEN 'matched' WHEN paid_cents > order_total_cents THEN 'overpaid' ELSE 'short' END AS reconciliation_status
FROM o FULL JOIN p ON o.square_order_id = p.square_order_id""",
    "kpi_margin_by_category": f"""{STAR}, m AS (SELECT coalesce(category_name, 'Uncategorized') AS category_name, count(*) AS order_lines, sum(CASE WHEN has_cost THEN 1 ELSE 0 END) AS n_costed, CAST(sum(CASE WHEN has_cost THEN net_sales_cents END) AS BIGINT) AS net_sales_cents,
  {_sum("cogs_cents")}, {_sum("gross_profit_cents")} FROM fact_order_line_margin GROUP BY 1)
SELECT * EXCLUDE (n_costed), {_pct("n_costed", "order_lines", 1)} AS line_cost_coverage_pct, CASE WHEN net_sales_cents > 0 THEN {_pct("gross_profit_cents", "net_sales_cents", 2)} END AS gross_margin_pct FROM m""",
    "kpi_margin_by_vendor": f"""{STAR}, m AS (SELECT vendor_name, count(*) AS order_lines, {_sum("net_sales_cents")}, {_sum("cogs_cents")}, {_sum("gross_profit_cents")} FROM fact_order_line_margin WHERE has_cost GROUP BY 1)
SELECT *, CASE WHEN net_sales_cents > 0 THEN {_pct("gross_profit_cents", "net_sales_cents", 2)} END AS gross_margin_pct FROM m""",
    "kpi_inventory_position": f"""{STAR}, sold AS (SELECT catalog_object_id, CAST(sum(quantity) AS DECIMAL(28, 4)) AS u FROM fact_order_line WHERE sale_date >= {_TODAY} - 30 GROUP BY 1),
stock AS (SELECT i.*, coalesce(u, 0) AS units_sold_30d, coalesce(u::DOUBLE, 0.0) AS sold FROM dim_item i LEFT JOIN sold ON catalog_object_id = square_catalog_object_id),
paced AS (SELECT *, p_size::DOUBLE / nullif(sold / 30.0::DOUBLE, 0) AS days_left FROM stock)
SELECT square_catalog_object_id, item_name, category_name, p_size::DOUBLE AS quantity_on_hand, units_sold_30d, {_r("sold / 30.0::DOUBLE", 3)} AS avg_daily_units, {_r("days_left", 1)} AS days_of_inventory,
  CASE WHEN sold = 0 THEN 'no_recent_sales' WHEN days_left < 7 THEN 'reorder_soon' WHEN days_left < 14 THEN 'watch' ELSE 'ok' END AS stock_status, TIMESTAMP '2001-08-01 06:00:00' AS calculated_at FROM paced""",
    "range_window": f"{STAR}, {_RANGE} SELECT period_start, period_end, period_days, prior_start, prior_end, prior_window_complete FROM windows",
    "dim_date": f"""{STAR} SELECT date_day, CAST(strftime(date_day, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(date_day) AS INTEGER) AS year, CAST(month(date_day) AS INTEGER) AS month, monthname(date_day) AS month_name, CAST(day(date_day) AS INTEGER) AS day_of_month,
  CAST(isodow(date_day) AS INTEGER) AS day_of_week, dayname(date_day) AS day_name, CAST(weekofyear(date_day) AS INTEGER) AS week_of_year, isodow(date_day) >= 6 AS is_weekend FROM dim_date""",
    "dim_period": f"{STAR} SELECT * FROM dim_period",
    "dim_vendor": f"{STAR} SELECT * FROM dim_vendor",
    "dim_location": f"{STAR} SELECT location_key, location_id AS square_location_id, location_name, timezone, true AS is_current FROM places",
    "dim_item_history": f"""{STAR} SELECT md5(square_catalog_object_id || '|1994-01-01 00:00:00') AS item_version_key, item_key, square_catalog_object_id, item_name, variation_name, category_name, category_name_raw, is_lottery, sku, price_amount_cents, currency, is_deleted,
  TIMESTAMP '1994-01-01' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current, 1 AS version_number FROM dim_item""",
    "dim_item": f"""{STAR} SELECT item_key, square_catalog_object_id, item_name, variation_name, category_name, category_name_raw, is_lottery, sku, price_amount_cents, currency, TIMESTAMP '1994-01-01' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, NOT is_deleted AS is_current FROM dim_item""",
    "fact_order_line": f"{STAR} SELECT * FROM fact_order_line",
    "fact_payment": f"{STAR} SELECT * FROM fact_payment",
    "fact_inventory_snapshot": f"""{STAR} SELECT md5(square_catalog_object_id || '|LOC' || (p_partkey % 5) || '|IN_STOCK') AS inventory_snapshot_key, square_catalog_object_id, item_key, location_key, 'LOC' || (p_partkey % 5) AS square_location_id, 'IN_STOCK' AS state,
  p_size::DOUBLE AS quantity_on_hand, TIMESTAMP '2001-08-01 06:00:00' AS calculated_at FROM dim_item LEFT JOIN places ON location_id = 'LOC' || (p_partkey % 5)""",
    "fact_order_line_margin": f"{STAR} SELECT * FROM fact_order_line_margin",
    "order_totals": f"""{STAR}, o AS (SELECT square_order_id, CAST(sum(net_sales_cents + tax_cents) AS BIGINT) AS order_total_cents, min(date_trunc('hour', closed_at_local)) AS lo, max(date_trunc('hour', closed_at_local)) AS hi FROM fact_order_line GROUP BY 1)
SELECT square_order_id, order_total_cents, CAST(lo AS DATE) AS first_sale_date, CAST(hour(lo) AS INTEGER) AS first_hour_of_day, CAST(hi AS DATE) AS last_sale_date, CAST(hour(hi) AS INTEGER) AS last_hour_of_day FROM o""",
    "day_slots": f"""{STAR} SELECT sale_date, CAST(hour(closed_at_local) AS INTEGER) AS hour_of_day, count(DISTINCT square_order_id) AS orders, {_UNITS} AS units, count(*) AS line_items, max(closed_at_local) AS last_order_at,
  {_sum("gross_sales_cents")}, {_sum("discount_cents")}, {_sum("tax_cents")}, {_sum("net_sales_cents")} FROM lines GROUP BY 1, 2""",
    "day_categories": f"{STAR} SELECT sale_date, coalesce(category_name, 'Uncategorized') AS category_name, count(DISTINCT square_order_id) AS orders, {_UNITS} AS units, {_sum('net_sales_cents')} FROM lines LEFT JOIN dim_item USING (item_key) GROUP BY 1, 2",
    "day_items": f"{STAR} SELECT sale_date, variation_id, count(DISTINCT square_order_id) AS orders, {_UNITS} AS units, {_sum('net_sales_cents')}, max(item_name) AS item_name, max(variation_name) AS variation_name FROM lines GROUP BY 1, 2",
    "day_tenders": f"{STAR} SELECT pay_date, source_type, count(*) AS payments, {_sum('amount_cents')}, {_sum('processing_fee_cents')} FROM fact_payment WHERE pay_date IS NOT NULL GROUP BY 1, 2",
    "day_margins": f"""{STAR} SELECT sale_date, CAST(sum(CASE WHEN has_cost THEN m.net_sales_cents END) AS BIGINT) AS costed, {_sum("cogs_cents")}, {_sum("gross_profit_cents")}, CAST(sum(m.net_sales_cents) AS BIGINT) AS all_net
  FROM fact_order_line_margin m JOIN lines l USING (order_line_key) GROUP BY 1""",
}
PERIOD_NAMES = {"summary": "kpi_summary", "category": "kpi_sales_by_category", "weekday": "kpi_sales_by_weekday", "hour": "kpi_sales_by_hour", "payments": "kpi_payment_methods", "items": "kpi_item_sales", "popular_times": "kpi_popular_times"}


def oracle_sql() -> dict[str, str]:
    return QUERIES | {PERIOD_NAMES[n]: over_periods(n) for n in RELATIONS} | {f"range_{n}": over_range(n) for n in RELATIONS}
