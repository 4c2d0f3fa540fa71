"""Stored tables: what a merge, a capture and a batch write, writers at one time, and gold tables that follow their sources."""

import datetime as dt
import os
import re
import shutil
import threading

import pytest
from pyspark.sql import functions as F

from stallmark.operators import checks, merge, range_functions
from stallmark.plans import queries as retail_queries
from stallmark.plans import retail
from stallmark.sources import gold, versions
from stallmark.streaming import bronze_stream

LINE = "order_line_key string, order_updated_at timestamp_ntz, net_sales_cents long, note string"
CATALOG = "variation_id string, item_name string, variation_name string, category_name string, price_cents long, currency string, sku string, is_deleted boolean"


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def lines(spark, n, change=None):
    """n lines over 100 days, with texts that do not compress to nothing; `change` is a condition on their number."""
    at = F.lit("2026-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.floor(F.col("id") * 100 / n).cast("int"))
    net = F.col("id") if change is None else F.col("id") + F.when(change, 1_000_000).otherwise(0)
    return spark.range(n).select(F.md5(F.col("id").cast("string")).alias("order_line_key"), at.alias("order_updated_at"), net.alias("net_sales_cents"), F.sha2(F.col("id").cast("string"), 512).alias("note"))


def test_merge_writes_only_the_files_of_changed_keys(spark, tmp_path):
    t = merge.VersionedTable(spark, str(tmp_path / "t"), "order_updated_at")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t.publish(lines(spark, 20_000))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    before = size(tmp_path / "t" / "data")
    source = lines(spark, 20_000, F.col("id") >= 19_800)  # the last 1 %
    got = merge.incremental(t, source)
    assert size(tmp_path / "t" / "data") - before < 0.05 * before
    assert checks.row_differences(got, source).count() == 0
    after = size(tmp_path / "t" / "data")
    merge.incremental(t, source)  # nothing changed: nothing is written
    assert size(tmp_path / "t" / "data") == after and checks.row_differences(t.current(), source).count() == 0


def test_merge_moves_keys_and_takes_new_columns(spark, tmp_path):
    day = lambda n: dt.datetime(2026, 1, n)
    t = merge.VersionedTable(spark, str(tmp_path / "t"), "order_updated_at")
    row = lambda k, d, n: (k, None if d is None else day(d), n, "x")
    t.publish(spark.createDataFrame([row("a", 1, 1), row("b", 20, 2), row(None, 20, 3), row("d", None, 4)], LINE))
    got = merge.incremental(t, spark.createDataFrame([row("a", 21, 10), row("b", 20, 2), row(None, 20, 30), row("d", None, 40), row("e", 2, 50)], LINE))
    assert sorted((r.order_line_key or "", r.net_sales_cents) for r in got.collect()) == [("", 30), ("a", 10), ("b", 2), ("d", 40)]  # e lies before the lookback
    wider = spark.createDataFrame([row("a", 22, 11)], LINE).withColumn("more", F.lit(1))
    got = merge.incremental(t, wider)
    assert got.columns == wider.columns and {(r.order_line_key, r.more) for r in got.collect()} >= {("a", 1), ("b", None)}


def test_of_writers_at_one_time_one_wins(spark, tmp_path):
    t = merge.VersionedTable(spark, str(tmp_path / "t"))
    t.publish(lines(spark, 10))
    segments, schema = t.state()
    for k in range(1, 26):
        start, won, lost = threading.Barrier(4), [], []

        def commit(n=k, start=start, won=won, lost=lost):
            own = merge.VersionedTable(spark, str(tmp_path / "t"))
            start.wait()
            try:
                own.commit(segments, schema, n)
                won.append(n)
            except FileExistsError:
                lost.append(n)

        threads = [threading.Thread(target=commit) for _ in range(4)]
        for x in threads:
            x.start()
        for x in threads:
            x.join()
        assert (len(won), len(lost)) == (1, 3) and t.version() == k + 1
    assert t.current().count() == 10 and not [f for f in os.listdir(tmp_path / "t" / "pointers") if f.startswith(".") and not f.endswith(".crc")]


def test_changes_cost_what_they_hold_and_are_folded(spark, tmp_path, monkeypatch):
    t = merge.VersionedTable(spark, str(tmp_path / "t"))
    t.publish(lines(spark, 5000))
    day = lambda n: dt.datetime(2026, 6, n)
    key = lambda k: lines(spark, 5000).where(F.col("net_sales_cents") == k).first().order_line_key
    a, b, before = key(0), key(1), size(tmp_path / "t" / "data")
    monkeypatch.setattr(merge, "replaced", lambda *_: pytest.fail("the base was written again"))
    batches = [[(a, day(2), 7, "x"), (a, day(1), 6, "x"), ("new", None, 1, "x")], [(a, day(1), 5, "late"), (b, dt.datetime(2020, 1, 1), 9, "late")], [(a, day(2), 8, "as new as before"), ("new", day(1), 2, "x")]]
    for rows in [*batches, batches[0]]:  # the first one comes again
        merge.append_changes(t, spark.createDataFrame(rows, LINE))
    assert size(tmp_path / "t" / "data") - before < 0.05 * before
    want = {a: 7, b: 1, "new": 2}  # of equally new rows the later batch's
    read = lambda: {r.order_line_key: r.net_sales_cents for r in t.current().where(F.col("order_line_key").isin(*want)).collect()}
    assert read() == want and t.current().count() == 5001
    monkeypatch.undo()
    merge.append_changes(t, lines(spark, 5000, F.col("id") < 2000).where("net_sales_cents >= 1000000"))  # more than a fifth
    assert {s.part for s in t.state()[0]} == {"base"} and t.current().count() == 5001
    assert read() == want | {b: 1_000_001}  # a is newer in the table
    assert t.current().agg(F.sum("net_sales_cents")).first()[0] == sum(range(5000)) + 1_999 * 1_000_000 + 7 + 2
    rows = t.current().collect()
    assert t.vacuum(1) > 0 and sorted(t.current().collect()) == sorted(rows)
    merge.append_changes(t, spark.createDataFrame(batches[0], LINE))
    assert merge.incremental(t, lines(spark, 5000).withColumn("net_sales_cents", F.col("net_sales_cents") + 1)).count() == 5001  # changes are folded first


def test_capture_writes_what_changed(spark, tmp_path):
    catalog = lambda changed: spark.range(20_000).select(
        F.col("id").cast("string").alias("variation_id"), F.sha2(F.col("id").cast("string"), 256).alias("item_name"), F.lit("R").alias("variation_name"),
        F.when(changed, "WINE").otherwise("BEER").alias("category_name"), F.lit(1).cast("long").alias("price_cents"), F.lit("USD").alias("currency"), F.lit(None).cast("string").alias("sku"), F.lit(False).alias("is_deleted"),
    )
    t = merge.VersionedTable(spark, str(tmp_path / "h"))
    merge.scd2_snapshot(t, catalog(F.lit(False)), dt.datetime(2026, 1, 1))
    data = tmp_path / "h" / "data"
    before, kept = size(data), {f for f in os.listdir(data)}
    got = merge.scd2_snapshot(t, catalog(F.col("id") % 100 == 0), dt.datetime(2026, 2, 1))
    assert size(data) - before < 0.05 * before and kept <= set(os.listdir(data))
    assert got.count() == 20_200 and got.where("valid_to is null").count() == 20_000
    closed = {s.folder for s in t.state()[0] if s.part == "closing"}
    got = merge.scd2_snapshot(t, catalog(F.col("id") % 3 == 0), dt.datetime(2026, 3, 1))  # many close: open versions are written anew
    state = t.state()[0]
    assert {s.part for s in state} == {"open", "closed"} and closed <= {s.folder for s in state}
    per_key = got.groupBy("variation_id").agg(F.sum(F.col("valid_to").isNull().cast("int")).alias("open"))
    assert got.where("valid_to is null").count() == 20_000 and per_key.where("open <> 1").isEmpty()
    assert checks.unique(got, "item_version_key").isEmpty()


def test_stream_of_files(spark, tmp_path):
    lines(spark, 1000).repartition(4).write.parquet(str(tmp_path / "in"))
    t = merge.VersionedTable(spark, str(tmp_path / "t"))
    t.publish(lines(spark, 5000).withColumn("net_sales_cents", F.lit(-1).cast("long")).withColumn("order_updated_at", F.lit("2020-01-01").cast("timestamp_ntz")))
    stream = spark.readStream.schema(LINE).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    bronze_stream.merge_stream(stream, lambda b: b, t, str(tmp_path / "check")).awaitTermination()
    assert t.version() == 5 and t.current().count() == 5000
    assert t.current().where("net_sales_cents >= 0").agg(F.sum("net_sales_cents")).first()[0] == sum(range(1000))


def test_put_if_absent(spark, tmp_path):
    path = str(tmp_path / "a" / "x")
    os.makedirs(os.path.dirname(path))
    assert versions.put_if_absent(spark, path, "one") and not versions.put_if_absent(spark, path, "two")
    with open(path) as f:
        assert f.read() == "one"


def test_gold_follows_its_sources(spark, sf, tmp_path):
    """A source that changes in the session is noticed; gold tables are built in one step, and released."""
    d = str(tmp_path / "sf")
    shutil.copytree(sf, d)
    fact = retail_queries.queries()["fact_order_line"]
    n = fact(spark, d).count()
    assert n == spark.read.parquet(f"{d}/lineitem.parquet").count() and retail.star(spark, d) is retail.star(spark, d)
    few = spark.read.parquet(f"{sf}/lineitem.parquet").limit(100)
    os.remove(f"{d}/lineitem.parquet")
    few.write.parquet(f"{d}/lineitem.parquet")  # now a folder
    assert fact(spark, d).count() == 100 and retail_queries.queries()["merge_order_lines"](spark, d).count() == 100
    star = retail.build_gold(spark, d)
    assert {"fact_order_line", "fact_payment", "fact_order_line_margin", "dim_date", "dim_period"} <= set(os.listdir(star.root.removeprefix("file://")))
    assert gold.release(spark, d) == 2 and not os.path.exists(star.root.removeprefix("file://"))


def test_gold_needs_a_shared_folder_on_a_cluster():
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        gold.gold_root(Session(), "x")


def test_range_functions_are_callable(spark, sf):
    s = retail.star(spark, sf)
    names = range_functions.register(s)
    assert set(names) <= set(range_functions.functions(spark)) and len(names) == 8
    for n in names:
        assert spark.sql(f"SELECT * FROM {n}(DATE '2001-05-01', DATE '2001-05-31')").columns
    own = spark.createDataFrame([("May", dt.date(2001, 5, 1), dt.date(2001, 5, 31)), ("July", dt.date(2001, 7, 1), dt.date(2001, 7, 31))], "name string, period_start date, period_end date")
    own.createOrReplaceTempView("months")
    got = {r.name: r for r in range_functions.over_table(s, "summary", "months", "w.name").collect()}
    for name, start, end in (("May", "2001-05-01", "2001-05-31"), ("July", "2001-07-01", "2001-07-31")):
        one = spark.sql(f"SELECT * FROM range_summary(DATE '{start}', DATE '{end}')").first()
        assert tuple(one) == tuple(got[name])[1:] and one.orders > 0
    plan = spark.sql("SELECT * FROM range_hour(DATE '2001-05-01', DATE '2001-05-31')")._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"sale_date#\d+ <= 2001-05-31", plan) and plan.count("Relation [") == 1  # the bounds reach the one scan


def test_check_of_ranges_is_one_pass(spark, sf):
    s = retail.star(spark, sf)
    plan = checks.ranges_equal_periods(s)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") < 70  # 210 with a comparison for each period
