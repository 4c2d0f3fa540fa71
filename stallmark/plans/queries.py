"""The registered queries of the retail model over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import forecast, kpi
from ..operators.star import Star
from ..operators.windows import Windows
from . import oracle, raw, stateful
from .oracle import PERIOD_NAMES
from .retail import END, START, star


def _over_star(make: Callable[[Star], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: make(star(spark, sf_dir))


def _order_totals(s: Star) -> DataFrame:
    slots = [F.col(f"{end}_slot.{c}").alias(f"{end}_{c}") for end in ("first", "last") for c in ("sale_date", "hour_of_day")]
    return s.order_totals.select("square_order_id", "order_total_cents", *slots)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    of_star = {
        "kpi_daily_sales": kpi.daily_sales, "kpi_item_weekly_sales": kpi.item_weekly_sales, "kpi_item_forecast": forecast.item_forecast, "kpi_revenue_forecast_daily": forecast.revenue_forecast_daily,
        "kpi_revenue_forecast": forecast.revenue_forecast, "kpi_data_coverage": kpi.data_coverage, "rpt_order_payment_reconciliation": kpi.reconciliation, "kpi_margin_by_category": kpi.margin_by_category,
        "kpi_margin_by_vendor": kpi.margin_by_vendor, "kpi_inventory_position": kpi.inventory_position, "range_window": lambda s: kpi.range_window(s, START, END), "dim_date": lambda s: s.dates,
        "dim_period": lambda s: s.periods, "dim_vendor": lambda s: s.vendors, "dim_location": lambda s: s.locations.drop("valid_from", "valid_to"), "dim_item_history": lambda s: s.item_history, "dim_item": lambda s: s.items,
        "fact_order_line": lambda s: s.lines, "fact_payment": lambda s: s.payments, "fact_inventory_snapshot": lambda s: s.inventory, "fact_order_line_margin": lambda s: s.margin,
        "order_totals": _order_totals, "day_slots": lambda s: s.day_slots, "day_categories": lambda s: s.day_categories, "day_items": lambda s: s.day_items, "day_tenders": lambda s: s.day_tenders, "day_margins": lambda s: s.day_margins,
    }
    for name, operator in kpi.RANGES.items():
        of_star[PERIOD_NAMES[name]] = lambda s, f=operator: f(s, Windows(s.periods))
        of_star[f"range_{name}"] = lambda s, f=operator: kpi.over_range(f, s, START, END)
    return {name: _over_star(make) for name, make in of_star.items()} | stateful.queries() | raw.QUERIES


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql() | stateful.oracle_sql() | raw.SQL
