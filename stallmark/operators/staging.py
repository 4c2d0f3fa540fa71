"""Staging: renamed and defensively cast columns; lazy, never written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import Quantity, normalize_category


def naive_utc(name: str):
    """ISO text, or a time, as a naive UTC time; null where unreadable."""
    return F.col(name).try_cast("timestamp").cast("timestamp_ntz").alias(name)


def _cast(df: DataFrame, **exprs) -> DataFrame:
    return df.withColumns(exprs)


def stg_locations(df: DataFrame) -> DataFrame:
    return _cast(df.withColumnRenamed("name", "location_name"), created_at=naive_utc("created_at"))


def stg_catalog_items(df: DataFrame) -> DataFrame:
    return _cast(df, updated_at=naive_utc("updated_at"))


def stg_order_lines(df: DataFrame) -> DataFrame:
    times = {c: naive_utc(c) for c in ("order_created_at", "order_updated_at", "closed_at")}
    return _cast(df, quantity=F.col("quantity").try_cast(Quantity), **times)


def stg_payments(df: DataFrame) -> DataFrame:
    return _cast(df, created_at=naive_utc("created_at"), updated_at=naive_utc("updated_at"))


def stg_inventory_snapshots(df: DataFrame) -> DataFrame:
    return _cast(df.withColumnRenamed("catalog_object_id", "variation_id"), calculated_at=naive_utc("calculated_at"))


def stg_vendor_costs(df: DataFrame) -> DataFrame:
    own = df.where("variation_id is not null")
    return own.groupBy("variation_id").agg(
        F.max("item_name").alias("item_name"), F.max("category_name").alias("category_name"), F.max("vendor_name").alias("vendor_name"),
        F.max(F.col("unit_cost_cents").try_cast("long")).alias("unit_cost_cents"),
    )


def stg_category_overrides(df: DataFrame) -> DataFrame:
    both = df.select(normalize_category("raw_category").alias("raw_norm"), normalize_category("canonical_category").alias("canonical_category"))
    return both.where("raw_norm is not null and canonical_category is not null and raw_norm <> canonical_category").groupBy("raw_norm").agg(F.max("canonical_category").alias("canonical_category"))
