"""Sinks: append-only raw pages, typed tables, CSV exports and the two starter files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalar import normalize_category


def append_bronze(pages: DataFrame, root: str, entity: str, source: str = "square") -> int:
    """Appends pages (metadata, payload) under extracted_date; a page that is there already is refused. Only the days of the new pages are read."""
    spark = pages.sparkSession
    path = f"{root}/{source}/{entity}"
    keys = pages.select("metadata.run_id", "metadata.page_number")
    total = keys.count()
    if keys.distinct().count() != total:
        raise ValueError("a page occurs twice in one write")
    day = F.to_date(F.substring("metadata.extracted_at", 1, 10))
    days = [r.day for r in pages.select(day.alias("day")).distinct().collect()]  # the days of one run
    try:
        old = spark.read.schema("metadata struct<run_id string, page_number long>, extracted_date date").json(path).where(F.col("extracted_date").isin(days) | F.col("extracted_date").isNull())
        if not keys.join(old.select("metadata.run_id", "metadata.page_number"), ["run_id", "page_number"], "left_semi").isEmpty():
            raise FileExistsError(f"a page of this run is already in {path}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
    # A page is a document and a file of its own: the scan reads documents, of a file with several lines only the first.
    pages.withColumn("extracted_date", day).write.mode("append").option("maxRecordsPerFile", 1).partitionBy("extracted_date").json(path)
    return total


def write_table(df: DataFrame, root: str, name: str) -> int:
    """Overwrites a table with its declared columns (flattened tables) or its own; returns its rows, also 0."""
    if name in schemas.SILVER:
        df = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.SILVER[name]))
    path = f"{root}/{name}.parquet"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def category_override_starter(catalog: DataFrame) -> DataFrame:
    """raw_category, canonical_category (the same to begin with), items: the categories in use, most items first."""
    raw = normalize_category("category_name")
    return catalog.where(raw.isNotNull()).groupBy(raw.alias("raw_category")).agg(F.count("*").alias("items")).select("raw_category", F.col("raw_category").alias("canonical_category"), "items").orderBy(F.col("items").desc(), "raw_category")


def vendor_cost_template(catalog: DataFrame, vendors: dict[str, str], default_vendor: str, low: float = 0.55, high: float = 0.75) -> DataFrame:
    """One cost row for each variation: the vendor by category, a cost share between low and high from the id's hash."""
    category = normalize_category("category_name")
    vendor: Column = F.lit(default_vendor)
    for name, v in vendors.items():
        vendor = F.when(category == name.upper(), v).otherwise(vendor)
    share = low + (high - low) * F.pmod(F.xxhash64("variation_id"), F.lit(1000)) / 1000
    cost = F.floor(F.col("price_cents") * share + 0.5).cast("long").cast("string")
    return catalog.groupBy("variation_id").agg(F.max("item_name").alias("item_name"), F.max("category_name").alias("category_name"), F.max("price_cents").alias("price_cents")).select("variation_id", "item_name", "category_name", vendor.alias("vendor_name"), cost.alias("unit_cost_cents"))
