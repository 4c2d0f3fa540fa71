"""The retail model over the TPC-H-like tables: staged tables and the star."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import Quantity, surrogate_key
from ..operators.staging import stg_category_overrides, stg_vendor_costs
from ..operators.star import Star
from ..sources import gold

AS_OF = dt.date(2001, 8, 2)
START, END = dt.date(2001, 5, 1), dt.date(2001, 7, 31)
LOTTERY = ("MEDIUM",)
ZONES = {0: "Africa/Lagos", 1: "America/Los_Angeles", 2: "Asia/Tokyo", 3: "Europe/Berlin", 4: "UTC"}
OVERRIDES = (("Promo", "Seasonal"), (" large ", "Bulk"), ("SMALL", "small"), ("", "Nothing"))
VERSION_TIME = "1994-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _half_up(x):
    return F.floor(x + 0.5).cast("long")


def located_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their location and closing time (a few have none)."""
    o = table(spark, sf_dir, "orders")
    place = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("LOC"), F.col("n_regionkey").cast("string")).alias("location_id"))
    at = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    o = o.join(place, "o_custkey", "left").join(nation, "n_nationkey", "left")
    return o.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "location_id", at.alias("placed_at"), F.when(F.col("o_orderkey") % 97 != 0, at).alias("closed_at"))


def stg_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("item_name"), F.col("p_brand").alias("variation_name"))
    orders = located_orders(spark, sf_dir).select(F.col("o_orderkey").alias("l_orderkey"), "location_id", "o_orderdate", "closed_at", "placed_at")
    gross = _half_up(F.col("l_extendedprice") * 100)
    line = line.join(orders, "l_orderkey").join(part, "l_partkey", "left").withColumn("gross_sales_cents", gross)
    line = line.withColumn("discount_cents", _half_up(F.col("gross_sales_cents") * F.col("l_discount")))
    line = line.withColumn("net_sales_cents", F.col("gross_sales_cents") - F.col("discount_cents")).withColumn("tax_cents", _half_up(F.col("net_sales_cents") * F.col("l_tax")))
    uid = F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd"), F.col("l_quantity").cast("int"))
    return line.select(
        F.col("l_orderkey").cast("string").alias("order_id"), uid.alias("line_item_uid"), "location_id", F.when(F.col("l_partkey") % 17 != 0, F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("catalog_object_id"),
        "item_name", "variation_name", F.col("l_quantity").cast(Quantity).alias("quantity"), "gross_sales_cents", "discount_cents", "tax_cents", "net_sales_cents", F.lit("USD").alias("currency"), F.lit("COMPLETED").alias("order_state"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_created_at"), F.greatest("placed_at", F.col("l_shipdate").cast("timestamp_ntz")).alias("order_updated_at"), "closed_at",
    )


def stg_payments(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """One payment for each order but those of status P; a third pays exactly what its lines sum to."""
    due = lines.groupBy("order_id").agg(F.sum(F.col("net_sales_cents") + F.col("tax_cents")).alias("due"))
    o = located_orders(spark, sf_dir).where("o_orderstatus <> 'P'").withColumn("order_id", F.col("o_orderkey").cast("string")).join(due, "order_id", "left")
    amount = F.when((F.col("o_orderkey") % 3 == 0) & F.col("due").isNotNull(), F.col("due")).otherwise(_half_up(F.col("o_totalprice") * 100))
    o = o.withColumn("amount_cents", amount)
    return o.select(
        F.concat(F.lit("PAY"), F.col("order_id")).alias("payment_id"), "order_id", "location_id", "amount_cents", F.lit("USD").alias("currency"), F.lit("COMPLETED").alias("status"),
        F.col("o_orderpriority").alias("source_type"), _half_up(F.col("amount_cents") * 0.026 + 10).alias("processing_fee_cents"), F.col("placed_at").alias("created_at"), F.col("placed_at").alias("updated_at"),
    )


def catalog_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One open version of every part."""
    p = table(spark, sf_dir, "part")
    variation = F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
    at = F.lit(VERSION_TIME).cast("timestamp_ntz")
    return p.select(
        surrogate_key(variation, at).alias("item_version_key"), variation.alias("variation_id"), F.col("p_name").alias("item_name"), F.col("p_brand").alias("variation_name"), F.initcap("p_type").alias("category_name"),
        _half_up(F.col("p_retailprice") * 100).alias("price_cents"), F.lit("USD").alias("currency"), F.concat(F.lit("SKU"), F.col("p_partkey").cast("string")).alias("sku"), (F.col("p_partkey") % 41 == 0).alias("is_deleted"),
        at.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"), at.alias("version_captured_at"),
    )


def vendor_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs of four parts in five, from seven vendors; all text, as the optional file has it."""
    p = table(spark, sf_dir, "part").where("p_partkey % 5 <> 0")
    return p.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("variation_id"), F.col("p_name").alias("item_name"), F.col("p_type").alias("category_name"),
        F.concat(F.lit("Vendor "), (F.col("p_partkey") % 7).cast("string")).alias("vendor_name"), _half_up(F.col("p_retailprice") * 60).cast("string").alias("unit_cost_cents"),
    )


def stg_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("variation_id"), F.lit("ITEM_VARIATION").alias("catalog_object_type"), F.concat(F.lit("LOC"), (F.col("p_partkey") % 5).cast("string")).alias("location_id"),
        F.lit("IN_STOCK").alias("state"), F.col("p_size").cast("double").alias("quantity"), F.lit("2001-08-01 06:00:00").cast("timestamp_ntz").alias("calculated_at"),
    )


def stg_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = F.lit(None).cast("string")
    for key, tz in ZONES.items():
        zone = F.when(F.col("r_regionkey") == key, tz).otherwise(zone)
    return table(spark, sf_dir, "region").select(F.concat(F.lit("LOC"), F.col("r_regionkey").cast("string")).alias("location_id"), F.col("r_name").alias("location_name"), F.lit("ACTIVE").alias("status"), zone.alias("timezone"))


def build(spark: SparkSession, sf_dir: str, mark: str | None = None) -> Star:
    """A star of its own (or that of a mark) over the tables as they are now."""
    lines = stg_lines(spark, sf_dir)
    overrides = spark.createDataFrame(list(OVERRIDES), "raw_category string, canonical_category string")
    staged = {
        "locations": stg_locations(spark, sf_dir), "order_lines": lines, "payments": stg_payments(spark, sf_dir, lines), "inventory_snapshots": stg_inventory(spark, sf_dir),
        "vendor_costs": stg_vendor_costs(vendor_costs(spark, sf_dir)), "category_overrides": stg_category_overrides(overrides), "snapshot": catalog_snapshot(spark, sf_dir),
    }
    return Star(staged, AS_OF, LOTTERY, gold.gold_root(spark, sf_dir, uuid.uuid4().hex if mark is None else mark), table(spark, sf_dir, "lineitem").count())


#: Tables that the star reads.
SOURCES = ("region", "nation", "customer", "part", "orders", "lineitem")
_stars: dict[tuple[str, str], tuple[str, Star]] = {}


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The star of a folder, built once for a session and state of its files: its facts are written as gold tables at their first use.

    When a source file is another (path, length or time) a new star is built; gold.release removes tables that nobody reads.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    mark = gold.fingerprint(spark, [f"{sf_dir}/{t}.parquet" for t in SOURCES])
    if key not in _stars or _stars[key][0] != mark or _stars[key][1].staged["order_lines"].sparkSession is not spark:
        _stars[key] = (mark, build(spark, sf_dir, mark))
    return _stars[key][1]


def build_gold(spark: SparkSession, sf_dir: str) -> Star:
    """The star with all its gold tables written, as a step of its own."""
    out = star(spark, sf_dir)
    gold.built(out)
    return out
