"""Raw pages to flattened tables: the latest version of every record, then typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalar import iso_timestamp, money
from ..sources.bronze import bronze_pages
from ..sources.sinks import write_table


def latest(rows: DataFrame, keys: list[Column], freshness: Column | None, required: int | None = None) -> DataFrame:
    """One row for each key: the freshest, on a tie the later in scan order (file, position).

    Freshness falls back to extracted_at where null or empty. Rows with a null among the first
    `required` keys (all by default) go. max_by combines before the shuffle, so hot keys stay cheap.
    """
    fresh = F.col("extracted_at") if freshness is None else F.coalesce(F.when(freshness != "", freshness), F.col("extracted_at"))
    named = rows.select("*", *(k.alias(f"_k{n}") for n, k in enumerate(keys)))
    for n in range(len(keys) if required is None else required):
        named = named.where(F.col(f"_k{n}").isNotNull())
    order = F.struct(iso_timestamp(fresh).alias("at"), fresh.alias("text"), F.coalesce("file", F.lit("")).alias("file"), F.col("position").alias("position"))
    best = F.max_by(F.struct("record", "extracted_at"), order).alias("best")
    return named.groupBy(*(f"_k{n}" for n in range(len(keys)))).agg(best).select("best.record", "best.extracted_at")


def _in_order(df: DataFrame, table: str, *by: str) -> DataFrame:
    return df.select(*schemas.SILVER[table].names).sortWithinPartitions(*by)


def locations(pages: DataFrame) -> DataFrame:
    r = latest(pages, [F.col("record.id")], None)
    return _in_order(r.select(F.col("record.id").alias("location_id"), "record.*"), "locations", "location_id")


def category_id(item: Column) -> Column:
    """The first category's id if there are categories (null if that is null), else the reporting category, else the plain id."""
    many, reporting = item["categories"], item["reporting_category"]["id"]
    return F.when(F.size(many) > 0, F.get(many, 0)["id"]).when(reporting.isNotNull(), reporting).otherwise(item["category_id"])


def catalog_items(pages: DataFrame) -> DataFrame:
    newest = latest(pages, [F.col("record.id")], F.col("record.updated_at")).select("record.*")
    variations = newest.where("type = 'ITEM_VARIATION'").select(F.col("id").alias("variation_id"), F.col("item_variation_data").alias("v"), "is_deleted", "updated_at")
    items = newest.where("type = 'ITEM'").select(F.col("id").alias("item_id"), F.col("item_data.name").alias("item_name"), category_id(F.col("item_data")).alias("category_id"), F.col("is_deleted").alias("item_deleted"))
    categories = newest.where("type = 'CATEGORY'").select(F.col("id").alias("category_id"), F.col("category_data.name").alias("category_name"))
    out = variations.withColumn("item_id", F.col("v.item_id")).join(items, "item_id", "left").join(categories, "category_id", "left")
    deleted = F.coalesce("is_deleted", F.lit(False)) | F.coalesce("item_deleted", F.lit(False))
    out = out.withColumns({
        "variation_name": F.col("v.name"), "sku": F.col("v.sku"), "price_cents": F.col("v.price_money.amount"), "currency": F.col("v.price_money.currency"), "is_deleted": deleted,
    })
    return _in_order(out, "catalog_items", "variation_id")


def order_lines(pages: DataFrame) -> DataFrame:
    o = latest(pages, [F.col("record.id")], F.col("record.updated_at")).select(F.col("record").alias("o"), F.explode("record.line_items").alias("i"))
    gross, discount = money("i.gross_sales_money"), money("i.total_discount_money")
    out = o.select(
        F.col("o.id").alias("order_id"), F.col("i.uid").alias("line_item_uid"), F.col("o.location_id").alias("location_id"), F.col("i.catalog_object_id").alias("catalog_object_id"),
        F.col("i.name").alias("item_name"), F.col("i.variation_name").alias("variation_name"), F.col("i.quantity").alias("quantity"), gross.alias("gross_sales_cents"),
        discount.alias("discount_cents"), money("i.total_tax_money").alias("tax_cents"), (gross - discount).alias("net_sales_cents"),
        F.coalesce("i.total_money.currency", "i.gross_sales_money.currency").alias("currency"), F.col("o.state").alias("order_state"),
        F.col("o.created_at").alias("order_created_at"), F.col("o.updated_at").alias("order_updated_at"), F.col("o.closed_at").alias("closed_at"),
    )
    return _in_order(out, "order_lines", "order_id", "line_item_uid")


def payments(pages: DataFrame) -> DataFrame:
    """Brand and last four digits only; card fingerprint and BIN are never read."""
    r = latest(pages, [F.col("record.id")], F.col("record.updated_at")).select("record.*")
    fee = F.coalesce(F.aggregate("processing_fee", F.lit(0).cast("long"), lambda a, x: a + money(x["amount_money"])), F.lit(0).cast("long"))
    out = r.withColumns({
        "payment_id": F.col("id"), "amount_cents": money("amount_money"), "currency": F.col("amount_money.currency"),
        "card_brand": F.col("card_details.card.card_brand"), "card_last_4": F.col("card_details.card.last_4"), "processing_fee_cents": fee,
    })
    return _in_order(out, "payments", "payment_id")


def inventory_snapshots(pages: DataFrame) -> DataFrame:
    key = [F.col("record.catalog_object_id"), F.col("record.location_id"), F.coalesce("record.state", F.lit(""))]
    r = latest(pages, key, F.col("record.calculated_at"), required=2).select("record.*")
    out = r.withColumn("quantity", F.coalesce(F.col("quantity").try_cast("double"), F.lit(0.0)))
    return _in_order(out, "inventory_snapshots", "catalog_object_id", "location_id", "state")


#: Flattened table -> (raw entity, transform).
TABLES = {
    "locations": ("locations", locations), "catalog_items": ("catalog", catalog_items), "order_lines": ("orders", order_lines),
    "payments": ("payments", payments), "inventory_snapshots": ("inventory", inventory_snapshots),
}


def rebuild(spark: SparkSession, bronze_root: str, silver_root: str) -> dict[str, int]:
    """All flattened tables from all raw pages; rows by table."""
    return {name: write_table(transform(bronze_pages(spark, bronze_root, entity)), silver_root, name) for name, (entity, transform) in TABLES.items()}
