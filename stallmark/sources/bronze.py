"""Sources: raw pages, flattened Parquet, optional CSV, and the windows that select from them."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def _is_missing(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (e.getCondition() or "")


def bronze_pages(spark: SparkSession, root: str, entity: str, source: str = "square") -> DataFrame:
    """record, extracted_at, file, position of every record of an entity's pages; a missing folder is empty."""
    key = schemas.LIST_KEYS[entity]
    schema = schemas.envelope(key)
    try:
        pages = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(f"{root}/{source}/{entity}")
        pages = pages.select("metadata", "payload", F.col("_metadata.file_path").alias("file"))
    except AnalysisException as e:
        if not _is_missing(e):
            raise
        pages = spark.createDataFrame([], schema).withColumn("file", F.lit(None).cast("string"))
    return pages.select(F.posexplode(f"payload.{key}").alias("position", "record"), F.col("metadata.extracted_at").alias("extracted_at"), "file")


def silver_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A flattened table with its declared columns, on any file system that Spark knows."""
    return spark.read.schema(schemas.SILVER[name]).parquet(f"{root}/{name}.parquet")


def optional_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """An optional input as text columns; a missing file is an empty table."""
    schema = schemas.CSV[name]
    try:
        return spark.read.schema(schema).option("header", True).csv(path)
    except AnalysisException as e:
        if not _is_missing(e):
            raise
        return spark.createDataFrame([], schema)


def in_store_day(ts: Column | str, day: dt.date, tz: str) -> Column:
    """Whether a naive UTC time lies on the store's local day (23 or 25 hours where clocks change)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    start, stop = store_day_window(day, tz)
    return (ts >= start) & (ts < stop)


def store_day_window(day: dt.date, tz: str) -> tuple[Column, Column]:
    """The UTC start and end (not included) of a local day, as naive times."""
    def utc(d: dt.date) -> Column:
        return F.convert_timezone(F.lit(tz), F.lit("UTC"), F.lit(d.isoformat()).cast("timestamp_ntz"))

    return utc(day), utc(day + dt.timedelta(days=1))


def active_locations(locations: DataFrame) -> DataFrame:
    """The ids of active locations; none at all is an error."""
    ids = locations.where(F.col("status") == "ACTIVE").select("location_id").distinct()
    if ids.isEmpty():
        raise ValueError("no active location")
    return ids


def only_active(df: DataFrame, locations: DataFrame) -> DataFrame:
    return df.join(active_locations(locations), "location_id", "left_semi")


def updated_within(df: DataFrame, ts: str, days: int, now: dt.datetime) -> DataFrame:
    """Rows updated in the last `days` days before now (naive UTC); 1 to 365."""
    if not 1 <= days <= 365:
        raise ValueError("days must be from 1 to 365")
    at = F.col(ts).cast("timestamp_ntz")
    start = F.lit((now - dt.timedelta(days=days)).isoformat(sep=" ")).cast("timestamp_ntz")
    return df.where((at >= start) & (at <= F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")))
