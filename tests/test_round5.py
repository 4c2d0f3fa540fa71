"""Findings of round 4: what differs on larger tables, and what the stored tables write to disk."""

import glob
import os
import re
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from stallmark.operators import checks, kpi, range_functions
from stallmark.operators.windows import Windows
from stallmark.plans import queries as retail_queries
from stallmark.plans import raw, retail
from stallmark.sources import gold, versions
from stallmark.streaming import bronze_stream


def changed(spark, sf, folder, **tables):
    """A folder with the tables of sf, some of them others."""
    os.makedirs(folder)
    for f in os.listdir(sf):
        if f.split(".")[0] not in tables:
            os.symlink(f"{sf}/{f}", f"{folder}/{f}")
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_a_bin_is_told_from_ids_and_amounts(spark, sf, tmp_path, monkeypatch):
    orders = spark.read.parquet(f"{sf}/orders.parquet").limit(3).withColumn("o_orderkey", F.monotonically_increasing_id() + 411_110).withColumn("o_totalprice", F.lit(4111.11))
    d = changed(spark, sf, tmp_path / "sf", orders=orders.coalesce(1))
    assert [tuple(r) for r in retail_queries.queries()["raw_fingerprints"](spark, d).collect()] == [(2, 0)]
    plain = raw.silver.payments
    monkeypatch.setattr(raw.silver, "payments", lambda pages: plain(pages).withColumn("card_last_4", F.when(F.col("order_id") == "411111", F.lit(raw.BIN)).otherwise(F.col("card_last_4"))))
    assert [tuple(r) for r in retail_queries.queries()["raw_fingerprints"](spark, d).collect()] == [(2, 1)]


@pytest.fixture(scope="module")
def stars(spark, sf):
    """A star written as a whole, and one written in parts."""
    whole, parts = (retail.build(spark, sf, mark) for mark in ("whole", "parts"))
    gold.built(whole)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(gold, "PART_ROWS", 1000)
        gold.built(parts)
    yield whole, parts
    gold.release(spark, sf)
    retail._stars.clear()
    range_functions._registered.clear()


def jobs(s, name):
    """How many jobs wrote a table: the files of each carry its id."""
    return len({re.search(r"part-\d+-([0-9a-f-]{36})", f)[1] for f in os.listdir(f"{s.root.removeprefix('file://')}/{name}") if f.startswith("part-")})


@pytest.mark.parametrize("name", ["lines", "payments", "margin", "order_totals", "order_payments", "day_slots", "day_categories", "day_items", "day_margins"])
def test_parts_hold_the_whole_table(stars, name):
    whole, parts = (getattr(s, name) for s in stars)
    assert whole.count() > 0 and checks.row_differences(whole, parts).isEmpty()


def test_large_tables_are_written_in_parts(stars):
    whole, parts = stars
    for name in ("fact_order_line", "fact_payment", "order_totals", "day_slots", "day_items"):
        assert jobs(whole, name) == 1 and jobs(parts, name) > 4, name


def test_shuffle_files_go_when_a_table_is_written(spark, sf):
    """Shuffles of the parts do not add up: when a table is written only those of counts are left; the session's own setting holds after that."""
    s = retail.build(spark, sf, "shuffles")
    before, setting = shuffle_files(), spark.conf.get(gold.FREE_SHUFFLES, None)
    assert s.lines.count() and s.day_items.count()
    left = lambda: sum(os.path.getsize(f) for f in shuffle_files() - before if os.path.exists(f))
    waited = time.time() + 20
    while left() > 20_000 and time.time() < waited:
        time.sleep(0.5)
    assert left() <= 20_000 and spark.conf.get(gold.FREE_SHUFFLES, None) == setting


def shuffle_files():
    tops = glob.glob(f"{tempfile.gettempdir()}/blockmgr-*")
    return {f"{d}/{x}" for top in tops for d, _, names in os.walk(top) for x in names if x.startswith("shuffle_")}


def test_stored_lines_hold_no_hashes_and_the_margin_is_not_a_second_copy(spark, sf):
    s = retail.build(spark, sf, "narrow")
    kpi.margin_by_category(s).collect()
    root = s.root.removeprefix("file://")
    assert os.listdir(root) == ["fact_order_line"]
    assert not {"order_line_key", "item_key"} & set(spark.read.parquet(f"{root}/fact_order_line").columns)
    plan = s.margin._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_items_are_summed_without_moving_day_rows(spark, stars):
    whole, _ = stars
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(whole.day_items.groupBy("variation_id").agg(F.sum("units")))
    for name in ("items", "summary", "category", "hour", "weekday"):
        assert "Expand" not in plan(range_functions.over_table(whole, name)), name  # no orders are split
    assert checks.ranges_equal_periods(whole).isEmpty()


def test_a_fold_in_parts_leaves_the_same_rows(spark, tmp_path, monkeypatch):
    """A stream into a stored table whose folds go through it in parts; files that no version names any more go as it runs."""
    rows = spark.range(4000).select(F.md5(F.col("id").cast("string")).alias("order_line_key"), F.lit("2026-01-01").cast("timestamp_ntz").alias("order_updated_at"), F.col("id").alias("net_sales_cents"))
    rows.repartition(6).withColumn("net_sales_cents", F.col("net_sales_cents") + 1).write.parquet(str(tmp_path / "in"))
    monkeypatch.setattr(gold, "PART_ROWS", 900)
    t = versions.VersionedTable(spark, str(tmp_path / "t"))
    t.publish(rows)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    bronze_stream.merge_stream(stream, lambda b: b, t, str(tmp_path / "check"), keep=1).awaitTermination()
    want = rows.withColumn("net_sales_cents", F.col("net_sales_cents") + 1)
    assert t.version() == 7 and checks.row_differences(t.current(), want).isEmpty()
    base = [s for s in t.state()[0] if s.part == "base"]
    assert len(base) >= 5  # each fold leaves one for each part
    assert {f"data/{f}" for f in os.listdir(tmp_path / "t" / "data")} <= {s.folder for s in t.state()[0]} | folders_since(t, 6)


def folders_since(t, version):
    """What versions from one on added; vacuum runs at folds only."""
    return {s.folder for n in range(version, t.version() + 1) for s in t.state(n)[0]}
