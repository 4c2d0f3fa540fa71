"""Gold tables: facts of the star written once, clustered by day, and read by every query after that.

A large table is written in parts one after the other, each by a job of its own whose shuffle files go when it ends, so that the
disk for shuffles follows a part and not the table.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of the fact for each bucket of a table by order.
BUCKET_ROWS = 4_000_000
#: Rows of the fact that a part holds, about; each part by hash reads the sources again, so there are at most MOST_PARTS of these.
PART_ROWS = 16_000_000
MOST_PARTS = 16
#: A setting of Spark: the shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_lock, _writers, _before = threading.Lock(), Counter(), {}
_roots: dict[tuple[str, str, str], str] = {}
_tables: dict[str, list[str]] = {}


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """A digest of the files of tables: of each its path, length and time of change. Folders are listed in Spark, a single file by its status."""
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    told, folders = [], []
    for p in paths:
        fs = path(p).getFileSystem(conf)
        if fs.exists(path(p)):
            status = fs.getFileStatus(path(p))
            if status.isDirectory():
                folders.append(p)
            else:
                told.append((p, status.getLen(), status.getModificationTime()))
    if folders:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders)
        each = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        told.append(tuple(files.agg(F.count("*"), F.sum(each)).first()))
    return hashlib.sha256(repr((sorted(paths), told)).encode()).hexdigest()


def gold_root(spark: SparkSession, name: str, mark: str = "") -> str:
    """A folder for the gold tables of `name`, one for each application and mark (see fingerprint), under spark.checkpoint.dir.

    Only a local master without that setting (tests) gets a local folder.
    """
    key = (spark.sparkContext.applicationId, name, mark)
    if key not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            master = spark.sparkContext.master
            if not re.fullmatch(r"local(\[.*\])?", master):
                raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
            base = "file://" + tempfile.mkdtemp(prefix="stallmark-gold-")
        _roots[key] = f"{base.rstrip('/')}/gold-{uuid.uuid4().hex}"
    return _roots[key]


def release(spark: SparkSession, name: str | None = None) -> int:
    """Removes the gold tables of this application (of one name, or all), for when nothing reads them any more; how many folders."""
    keys = [k for k in _roots if k[0] == spark.sparkContext.applicationId and name in (None, k[1])]
    for k in keys:
        root = _roots.pop(k)
        for name in _tables.pop(root, ()):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(keys)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of each query of the session go when it ends; then the session's own setting holds again."""
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        if not _writers[session]:
            _before[session] = spark.conf.get(FREE_SHUFFLES, None)
            spark.conf.set(FREE_SHUFFLES, "true")
        _writers[session] += 1
    try:
        yield
    finally:
        with _lock:
            _writers[session] -= 1
            if not _writers[session]:
                del _writers[session]
                was = _before.pop(session)
                spark.conf.unset(FREE_SHUFFLES) if was is None else spark.conf.set(FREE_SHUFFLES, was)


def parts_by_hash(key: str, rows: int) -> Sequence[Column | None]:
    """Conditions on a key that cut a table of so many rows into parts; one None if it is written as a whole."""
    n = min(MOST_PARTS, -(-rows // PART_ROWS))
    return [F.pmod(F.xxhash64(key), F.lit(n)) == k for k in range(n)] if n > 1 else [None]


def parts_by_day(rows: DataFrame, day: str) -> Sequence[Column | None]:
    """Conditions on the day that cut a table over these rows into ranges of days with about PART_ROWS of the rows; as the rows are sorted by day, each is read once."""
    cuts, held = [], 0
    with freed_shuffles(rows.sparkSession):
        days = rows.where(F.col(day).isNotNull()).groupBy(day).count().orderBy(day).collect()  # at most the days of a calendar
    for r in days:
        if held and held + r["count"] > PART_ROWS:
            cuts.append(r[day])
            held = 0
        held += r["count"]
    if not cuts:
        return [None]
    between = [(F.col(day) >= F.lit(a)) & (F.col(day) < F.lit(b)) for a, b in zip(cuts, cuts[1:])]
    return [F.col(day) < F.lit(cuts[0]), *between, F.col(day) >= F.lit(cuts[-1])]


def materialised(df: DataFrame, root: str, name: str, day: str | None = None, parts: Sequence[Column | None] = (None,), then: tuple[str, ...] = ()) -> DataFrame:
    """Drops and rebuilds a gold table, part by part, and reads it.

    With a day column, rows of a month lie together, sorted by day (and `then`), so that file statistics skip other days; Spark splits
    months that are large for one task and joins small ones (rebalance), without a pass to find bounds.
    """
    path = f"{root}/{name}"
    with freed_shuffles(df.sparkSession):
        for k, part in enumerate(parts):
            out = df if part is None else df.where(part)
            if day:
                out = out.withColumn("_month", F.trunc(day, "month")).hint("rebalance", "_month").sortWithinPartitions(day, *then).drop("_month")
            out.write.mode("append" if k else "overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, root: str, name: str, key: str, rows: int, parts: Sequence[Column | None] = (None,), sort: str | None = None) -> DataFrame:
    """A gold table in buckets by hash of its key, one file of each part; tables of the same `rows` have buckets alike and are joined on the key in place.

    Buckets follow the number of rows, up to Spark's bound (spark.sql.sources.bucketing.maxBuckets). Spark knows buckets
    only of tables in its catalog; the table is an external one over the folder, and release drops it. Without `sort` df is
    grouped by the key: where the buckets are a multiple of the shuffle partitions, each of its tasks holds whole buckets.
    """
    spark = df.sparkSession
    most, own = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")), int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    n = min(most, max(own, -(-rows // BUCKET_ROWS)))
    table = f"{name}_{root.rsplit('-', 1)[-1]}"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    with freed_shuffles(spark):
        for k, part in enumerate(parts):
            out = df if part is None else df.where(part)
            out = out if not sort and n % own == 0 else out.repartition(n, key)
            writer = out.write.mode("append" if k else "overwrite").format("parquet").option("compression", "zstd").bucketBy(n, key)
            (writer.sortBy(sort) if sort else writer).option("path", f"{root}/{name}").saveAsTable(table)
    _tables.setdefault(root, []).append(table)
    return spark.table(table)


def written_tables(star, root: str) -> dict[str, int]:
    """Writes every dimension and fact of a star under root; rows by table."""
    tables = {
        "dim_location": star.locations, "dim_item_history": star.item_history, "dim_item": star.items, "dim_vendor": star.vendors, "dim_date": star.dates, "dim_period": star.periods,
        "fact_order_line": star.lines, "fact_payment": star.payments, "fact_inventory_snapshot": star.inventory, "fact_order_line_margin": star.margin,
    }
    return {name: materialised(df, root, name).count() for name, df in tables.items()}


def built(star) -> None:
    """Writes the gold tables of a star: dimensions first, then the facts that do not need one another side by side, then those that follow."""
    steps = (
        ("locations", "items", "vendors"), ("lines", "payments", "inventory"), ("stored_margin", "dates", "periods", "order_totals", "order_payments", "day_tenders"),
        ("split_orders", "day_lines"), ("split_lines", "day_slots", "day_categories", "day_items", "day_margins"),
    )
    for step in steps:
        with ThreadPoolExecutor(len(step)) as pool:
            list(pool.map(lambda name: getattr(star, name), step))
