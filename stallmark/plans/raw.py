"""Raw pages made of the driver's tables, put through the silver transforms and staging, with their SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import silver, staging
from ..sources import bronze, sinks
from .retail import located_orders, star, stg_locations, table


def _text(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _money(amount: Column) -> Column:
    return F.struct(F.floor(amount + 0.5).cast("long").alias("amount"), F.lit("USD").alias("currency"))


def _iso(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _pages(rows: DataFrame, record: Column, at: Column, position: Column) -> DataFrame:
    return rows.select(record.alias("record"), at.alias("extracted_at"), F.lit("page").alias("file"), position.cast("int").alias("position"))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every region in two extractions; the later one has the name."""
    r = table(spark, sf_dir, "region").withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    none = F.lit(None).cast("string")
    names = {"name": F.when(F.col("n") == 2, F.col("r_name")).otherwise("old"), "status": F.lit("ACTIVE"), "timezone": F.lit("UTC"), "created_at": F.lit("2020-01-01T00:00:00Z")}
    record = F.struct(_text("LOC", F.col("r_regionkey")).alias("id"), *(names.get(c, none).alias(c) for c in ("name", "status", "timezone", "currency", "country", "business_name", "merchant_id", "created_at")))
    at = F.when(F.col("n") == 2, "2026-01-02T00:00:00Z").otherwise("2026-01-01T00:00:00Z")
    out = staging.stg_locations(silver.locations(_pages(r, record, at, F.col("n"))))
    return out.select("location_id", "location_name", "status", "created_at")


def catalog_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as variations, items and categories; an item's category lies in one of three places."""
    p = table(spark, sf_dir, "part")
    k, kind = F.col("p_partkey"), F.col("p_type")
    cat, none = _text("C", kind), F.lit(None).cast("string")
    item = F.struct(
        F.col("p_name").alias("name"), F.when(k % 3 == 0, F.array(F.struct(cat.alias("id")))).otherwise(F.array().cast("array<struct<id:string>>")).alias("categories"),
        F.struct(F.when(k % 3 == 1, cat).alias("id")).alias("reporting_category"), F.when(k % 5 != 0, cat).alias("category_id"),
    )
    variation = F.struct(_text("I", k).alias("item_id"), F.col("p_brand").alias("name"), _text("SKU", k).alias("sku"), _money(F.col("p_retailprice") * 100).alias("price_money"))
    no = {"item_data": F.when(F.lit(False), item), "item_variation_data": F.when(F.lit(False), variation), "category_data": F.when(F.lit(False), F.struct(kind.alias("name")))}

    def record(what: str, id_: Column, deleted: Column, **data: Column) -> Column:
        return F.struct(F.lit(what).alias("type"), id_.alias("id"), F.lit("2026-01-01T00:00:00Z").alias("updated_at"), deleted.alias("is_deleted"), *(data.get(c, x).alias(c) for c, x in no.items()))

    parts = [record("ITEM_VARIATION", _text("P", k), k % 41 == 0, item_variation_data=variation), record("ITEM", _text("I", k), k % 43 == 0, item_data=item), record("CATEGORY", cat, F.lit(None).cast("boolean"), category_data=F.struct(kind.alias("name")))]
    pages = _pages(p.withColumn("r", F.explode(F.array(*parts))), F.col("r"), F.lit("2026-01-01T00:00:00Z"), F.lit(0))
    out = staging.stg_catalog_items(silver.catalog_items(pages))
    return out.select("variation_id", "item_name", "variation_name", "category_name", "price_cents", "sku", "is_deleted", "updated_at")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines nested; lines without a discount have no money for it."""
    gross = F.col("l_extendedprice") * 100
    line = F.struct(
        F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd"), F.col("l_quantity").cast("int")).alias("uid"), _text("P", F.col("l_partkey")).alias("catalog_object_id"),
        F.lit("x").alias("name"), F.lit("y").alias("variation_name"), F.col("l_quantity").cast("string").alias("quantity"), _money(gross).alias("gross_sales_money"),
        F.when(F.col("l_discount") > 0, _money(gross * F.col("l_discount"))).alias("total_discount_money"), _money(gross * F.col("l_tax")).alias("total_tax_money"), _money(gross).alias("total_money"),
    )
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(line).alias("line_items"))
    o = table(spark, sf_dir, "orders").join(lines, "o_orderkey", "left")
    day = _iso(F.col("o_orderdate"))
    record = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.lit("LOC0").alias("location_id"), F.col("o_orderstatus").alias("state"), day.alias("created_at"), day.alias("updated_at"), F.lit("").alias("closed_at"), "line_items")
    out = staging.stg_order_lines(silver.order_lines(_pages(o, record, F.lit("2026-01-01T00:00:00Z"), F.lit(0))))
    return out.select("order_id", "line_item_uid", "catalog_object_id", "quantity", "gross_sales_cents", "discount_cents", "tax_cents", "net_sales_cents", "order_state", "order_created_at", "closed_at")


def _payment_records(o: DataFrame, amount: Column, **card_fields: Column) -> DataFrame:
    """Orders with a payment record."""
    day, k = _iso(F.col("o_orderdate")), F.col("o_orderkey")
    fees = F.array(F.struct(_money(k % 50).alias("amount_money")), F.struct(F.lit(None).cast("struct<amount:bigint,currency:string>").alias("amount_money")), F.struct(_money(F.lit(7)).alias("amount_money")))
    card = F.struct(F.struct(F.lit("VISA").alias("card_brand"), F.lpad((k % 10_000).cast("string"), 4, "0").alias("last_4"), *(c.alias(n) for n, c in card_fields.items())).alias("card"))
    record = F.struct(
        _text("PAY", k).alias("id"), k.cast("string").alias("order_id"), F.lit("LOC0").alias("location_id"), _money(amount).alias("amount_money"), F.lit("COMPLETED").alias("status"),
        F.col("o_orderpriority").alias("source_type"), F.when(k % 4 != 0, fees).alias("processing_fee"), card.alias("card_details"), day.alias("created_at"), day.alias("updated_at"),
    )
    return o.withColumn("record", record)


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payments with two fees, one of them without money."""
    o = _payment_records(table(spark, sf_dir, "orders"), F.col("o_totalprice") * 100)
    out = staging.stg_payments(silver.payments(_pages(o, F.col("record"), F.lit("2026-01-01T00:00:00Z"), F.lit(0))))
    return out.select("payment_id", "order_id", "amount_cents", "source_type", "card_brand", "card_last_4", "processing_fee_cents", "created_at")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two counts of every part; the later one is the size, in some cases text that is no number."""
    p = table(spark, sf_dir, "part").withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    k = F.col("p_partkey")
    quantity = F.when(F.col("n") == 1, "99").when(k % 11 == 0, "none").otherwise(F.col("p_size").cast("string"))
    at = F.when(F.col("n") == 2, "2026-01-02T00:00:00+00:00").otherwise("2026-01-01T00:00:00Z")
    record = F.struct(_text("P", k).alias("catalog_object_id"), F.lit("ITEM_VARIATION").alias("catalog_object_type"), F.when(k % 13 != 0, _text("LOC", k % 5)).alias("location_id"), F.when(k % 2 == 0, "IN_STOCK").alias("state"), quantity.alias("quantity"), at.alias("calculated_at"))
    out = staging.stg_inventory_snapshots(silver.inventory_snapshots(_pages(p, record, F.lit("2026-01-03T00:00:00Z"), F.col("n"))))
    return out.select("variation_id", "location_id", "state", "quantity", "calculated_at")


# The same from pages that are written as JSON and scanned: sources and sinks end to end.

PAGE_ROWS = 200
#: Two extractions of the payments.
RUNS = (("2026-01-01T00:00:00Z", "run-1"), ("2026-01-02T00:00:00Z", "run-2"))
#: What the pages of payments hold and flattened rows must not. Both begin with letters that no other field has: bare digits also occur in ids and amounts.
FINGERPRINT, BIN = "FP-", "BIN-411111"
_written: set[str] = set()


def _enveloped(rows: DataFrame, list_key: str, entity: str, key: Column, at: str, run: str) -> DataFrame:
    """Pages of up to PAGE_ROWS records (by number ranges of the key), in the order of the key."""
    page = F.floor(key / PAGE_ROWS).cast("long")
    held = rows.groupBy(page.alias("page")).agg(F.array_sort(F.collect_list(F.struct(key.alias("key"), "record"))).alias("rs"))
    meta = F.struct(F.lit("square").alias("source"), F.lit(entity).alias("entity"), F.col("page").alias("page_number"), F.lit(at).alias("extracted_at"), F.lit(run).alias("run_id"), F.lit("test").alias("environment"))
    return held.select(meta.alias("metadata"), F.struct(F.col("rs.record").alias(list_key)).alias("payload"))


def raw_root(spark: SparkSession, sf_dir: str) -> str:
    """A folder of raw pages, written once for a star: payments in two extractions (the first with other amounts, both as fresh,
    each card with a fingerprint and a BIN), counts of inventory; catalog and orders have no pages."""
    root = f"{star(spark, sf_dir).root}/raw"
    if root not in _written:
        k = F.col("o_orderkey")
        for n, (at, run) in enumerate(RUNS):
            own = _payment_records(table(spark, sf_dir, "orders"), F.col("o_totalprice") * 100 + (1 - n), fingerprint=_text(FINGERPRINT, k), bin=F.lit(BIN))
            sinks.append_bronze(_enveloped(own, "payments", "payments", k, at, run), root, "payments")
        k = F.col("p_partkey")
        record = F.struct(_text("P", k).alias("catalog_object_id"), _text("LOC", k % 5).alias("location_id"), F.lit("IN_STOCK").alias("state"), F.col("p_size").cast("string").alias("quantity"), F.lit(RUNS[0][0]).alias("calculated_at"))
        sinks.append_bronze(_enveloped(table(spark, sf_dir, "part").withColumn("record", record), "counts", "inventory", k, *RUNS[0]), root, "inventory")
        _written.add(root)
    return root


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan of the payments' pages: every record with its place in its page."""
    pages = bronze.bronze_pages(spark, raw_root(spark, sf_dir), "payments")
    return pages.select(F.col("record.id").alias("payment_id"), "extracted_at", F.col("position").cast("int").alias("position"), F.col("record.amount_money.amount").alias("amount_cents"))


def raw_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments of a rebuild of all flattened tables: of two equally fresh records the one of the later file."""
    root = raw_root(spark, sf_dir)
    silver.rebuild(spark, root, f"{root}-silver")
    return bronze.silver_table(spark, f"{root}-silver", "payments").select("payment_id", "amount_cents", "card_brand", "card_last_4", "processing_fee_cents", "updated_at")


def raw_rebuild_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each rebuilt table; a table without pages is empty."""
    root = raw_root(spark, sf_dir)
    silver.rebuild(spark, root, f"{root}-silver-counts")
    out = None
    for name in silver.TABLES:
        part = bronze.silver_table(spark, f"{root}-silver-counts", name).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def raw_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that hold card fingerprints, and flattened payments that hold one or a BIN in any column."""
    root = raw_root(spark, sf_dir)
    raw = spark.read.option("recursiveFileLookup", True).text(f"{root}/square/payments").where(F.col("value").contains(FINGERPRINT))
    rows = silver.payments(bronze.bronze_pages(spark, root, "payments"))
    text = F.concat_ws("|", *(F.col(c).cast("string") for c in rows.columns))
    leaked = rows.where(text.contains(FINGERPRINT) | text.contains(BIN)).agg(F.count("*").alias("leaked"))
    return raw.agg(F.count("*").alias("planted_pages")).crossJoin(leaked)  # one row each


def active_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of active locations; two of five are closed."""
    status = F.when(F.col("location_id").isin("LOC1", "LOC3"), "CLOSED").otherwise("ACTIVE")
    places = stg_locations(spark, sf_dir).withColumn("status", status)
    return bronze.only_active(located_orders(spark, sf_dir), places).select(F.col("o_orderkey").alias("order_key"), "location_id")


def recent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders placed within 90 days before a time."""
    o = located_orders(spark, sf_dir)
    return bronze.updated_within(o, "placed_at", 90, dt.datetime(2001, 7, 1)).select(F.col("o_orderkey").alias("order_key"), "placed_at")


QUERIES = {"silver_locations": locations, "silver_catalog_items": catalog_items, "silver_order_lines": order_lines, "silver_payments": payments, "silver_inventory": inventory}
QUERIES |= {"raw_scan": raw_scan, "raw_rebuild": raw_rebuild, "raw_rebuild_counts": raw_rebuild_counts, "raw_fingerprints": raw_fingerprints, "source_active_orders": active_orders, "source_recent_orders": recent_orders}

_GROSS = "CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)"
_DISCOUNT = "CASE WHEN l_discount > 0 THEN CAST(floor(l_extendedprice * 100 * l_discount + 0.5) AS BIGINT) ELSE 0 END"
SQL = {
    "silver_locations": "SELECT 'LOC' || r_regionkey AS location_id, r_name AS location_name, 'ACTIVE' AS status, TIMESTAMP '2020-01-01' AS created_at FROM region",
    "silver_catalog_items": """SELECT 'P' || p_partkey AS variation_id, p_name AS item_name, p_brand AS variation_name, CASE WHEN p_partkey % 3 = 2 AND p_partkey % 5 = 0 THEN NULL ELSE p_type END AS category_name,
  CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) AS price_cents, 'SKU' || p_partkey AS sku, p_partkey % 41 = 0 OR p_partkey % 43 = 0 AS is_deleted, TIMESTAMP '2026-01-01' AS updated_at FROM part""",
    "silver_order_lines": f"""SELECT CAST(l_orderkey AS VARCHAR) AS order_id, concat_ws('-', l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d'), CAST(l_quantity AS INTEGER)) AS line_item_uid, 'P' || l_partkey AS catalog_object_id,
  CAST(l_quantity AS DECIMAL(18, 4)) AS quantity, {_GROSS} AS gross_sales_cents, {_DISCOUNT} AS discount_cents, CAST(floor(l_extendedprice * 100 * l_tax + 0.5) AS BIGINT) AS tax_cents, {_GROSS} - {_DISCOUNT} AS net_sales_cents,
  o_orderstatus AS order_state, CAST(o_orderdate AS TIMESTAMP) AS order_created_at, CAST(NULL AS TIMESTAMP) AS closed_at FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "silver_payments": """SELECT 'PAY' || o_orderkey AS payment_id, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) AS amount_cents, o_orderpriority AS source_type, 'VISA' AS card_brand,
  lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') AS card_last_4, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 50 + 7 ELSE 0 END AS processing_fee_cents, CAST(o_orderdate AS TIMESTAMP) AS created_at FROM orders""",
    "silver_inventory": """SELECT 'P' || p_partkey AS variation_id, 'LOC' || (p_partkey % 5) AS location_id, CASE WHEN p_partkey % 2 = 0 THEN 'IN_STOCK' END AS state, CASE WHEN p_partkey % 11 = 0 THEN 0.0::DOUBLE ELSE p_size::DOUBLE END AS quantity,
  TIMESTAMP '2026-01-02' AS calculated_at FROM part WHERE p_partkey % 13 <> 0""",
    "raw_scan": f"""SELECT 'PAY' || o_orderkey AS payment_id, extracted AS extracted_at, CAST(row_number() OVER (PARTITION BY extracted, o_orderkey // {PAGE_ROWS} ORDER BY o_orderkey) - 1 AS INTEGER) AS position,
  CAST(floor(o_totalprice * 100 + more + 0.5) AS BIGINT) AS amount_cents FROM orders, (VALUES ('{RUNS[0][0]}', 1), ('{RUNS[1][0]}', 0)) v(extracted, more)""",
    "raw_rebuild": """SELECT 'PAY' || o_orderkey AS payment_id, CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) AS amount_cents, 'VISA' AS card_brand, lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') AS card_last_4,
  CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 50 + 7 ELSE 0 END AS processing_fee_cents, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS updated_at FROM orders""",
    "raw_rebuild_counts": "SELECT 'payments' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'inventory_snapshots', count(*) FROM part UNION ALL SELECT unnest(['locations', 'catalog_items', 'order_lines']), 0",
    "raw_fingerprints": f"SELECT 2 * count(DISTINCT o_orderkey // {PAGE_ROWS}) AS planted_pages, 0 AS leaked FROM orders",
    "source_active_orders": "SELECT o_orderkey AS order_key, 'LOC' || n_regionkey AS location_id FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey NOT IN (1, 3)",
    "source_recent_orders": "SELECT o_orderkey AS order_key, o_orderdate + INTERVAL (o_orderkey % 24) HOUR AS placed_at FROM orders WHERE o_orderdate + INTERVAL (o_orderkey % 24) HOUR BETWEEN TIMESTAMP '2001-04-02' AND TIMESTAMP '2001-07-01'",
}
