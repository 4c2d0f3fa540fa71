"""Small cases: raw pages, store days, sinks, merge, history, functions, checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stallmark import schemas
from stallmark.functions import scalar
from stallmark.operators import checks, kpi, merge, silver, staging, star, views, windows
from stallmark.plans import retail
from stallmark.sources import bronze, gold, sinks
from stallmark.streaming import bronze_stream

T1, T2 = "2026-01-01T00:00:00Z", "2026-01-02T00:00:00Z"


def money(n):
    return {"amount": n, "currency": "USD"}


def write(spark, root, entity, records, at=T1, run="r1", page=1):
    key = schemas.LIST_KEYS[entity]
    meta = {"source": "square", "entity": entity, "page_number": page, "extracted_at": at, "run_id": run, "environment": "test"}
    df = spark.createDataFrame([{"metadata": meta, "payload": {key: records}}], schemas.envelope(key))
    return sinks.append_bronze(df, str(root), entity)


def test_latest_extraction_wins_and_missing_is_empty(spark, tmp_path):
    write(spark, tmp_path, "locations", [{"id": "L", "name": "old", "status": "ACTIVE"}], T1)
    write(spark, tmp_path, "locations", [{"id": "L", "name": "new", "status": "ACTIVE"}, {"id": None, "name": "dropped"}], T2, "r2")
    rows = silver.locations(bronze.bronze_pages(spark, str(tmp_path), "locations")).collect()
    assert [(r.location_id, r.name) for r in rows] == [("L", "new")]
    assert bronze.bronze_pages(spark, str(tmp_path), "orders").count() == 0


def test_page_is_never_overwritten(spark, tmp_path):
    assert write(spark, tmp_path, "locations", [{"id": "L"}]) == 1
    with pytest.raises(FileExistsError):
        write(spark, tmp_path, "locations", [{"id": "M"}])


def test_every_page_of_a_write_is_read(spark, tmp_path):
    key = schemas.LIST_KEYS["locations"]
    meta = lambda n: {"source": "square", "entity": "locations", "page_number": n, "extracted_at": T1, "run_id": "r", "environment": "test"}
    pages = spark.createDataFrame([{"metadata": meta(n), "payload": {key: [{"id": f"L{n}"}]}} for n in range(20)], schemas.envelope(key)).coalesce(1)
    assert sinks.append_bronze(pages, str(tmp_path), "locations") == 20
    assert bronze.bronze_pages(spark, str(tmp_path), "locations").select("record.id").distinct().count() == 20


def test_catalog(spark, tmp_path):
    write(spark, tmp_path, "catalog", [
        {"type": "ITEM_VARIATION", "id": "V", "updated_at": T1, "is_deleted": False, "item_variation_data": {"item_id": "I", "name": "Six", "sku": "S", "price_money": money(1299)}},
        {"type": "ITEM", "id": "I", "updated_at": T1, "is_deleted": False, "item_data": {"name": "Ale", "categories": [{"id": "C"}], "category_id": "X"}},
        {"type": "CATEGORY", "id": "C", "updated_at": T1, "category_data": {"name": "Beer"}},
        {"type": "ITEM_VARIATION", "id": "W", "updated_at": T1, "item_variation_data": {"item_id": "J"}},
        {"type": "ITEM", "id": "J", "updated_at": T1, "is_deleted": True, "item_data": {"name": "Plain", "categories": [{"id": None}], "reporting_category": {"id": "C"}}},
    ])
    rows = {r.variation_id: r for r in silver.catalog_items(bronze.bronze_pages(spark, str(tmp_path), "catalog")).collect()}
    assert (rows["V"].category_name, rows["V"].price_cents, rows["V"].currency) == ("Beer", 1299, "USD")
    assert rows["W"].category_name is None and rows["W"].is_deleted and not rows["V"].is_deleted


def test_orders(spark, tmp_path):
    lines = [{"uid": "1", "quantity": "2", "gross_sales_money": money(2000), "total_discount_money": money(100), "total_tax_money": money(50)}, {"uid": "2", "quantity": "1", "gross_sales_money": money(500)}]
    write(spark, tmp_path, "orders", [{"id": "O", "state": "COMPLETED", "updated_at": T2, "line_items": lines}], run="a")
    write(spark, tmp_path, "orders", [{"id": "O", "state": "OPEN", "updated_at": T1, "line_items": lines[:1]}, {"id": "E", "updated_at": T1}], run="b")
    rows = {r.line_item_uid: r for r in silver.order_lines(bronze.bronze_pages(spark, str(tmp_path), "orders")).collect()}
    assert (rows["1"].net_sales_cents, rows["2"].net_sales_cents, rows["2"].discount_cents, rows["1"].order_state) == (1900, 500, 0, "COMPLETED") and len(rows) == 2


def test_payments_and_inventory(spark, tmp_path):
    write(spark, tmp_path, "payments", [{"id": "P", "amount_money": money(10), "processing_fee": [{"amount_money": money(1)}, {"amount_money": None}], "card_details": {"card": {"card_brand": "VISA", "last_4": "1111"}}}])
    out = silver.payments(bronze.bronze_pages(spark, str(tmp_path), "payments"))
    r = out.first()
    assert (r.processing_fee_cents, r.card_brand, r.card_last_4) == (1, "VISA", "1111") and not {"fingerprint", "bin"} & set(out.columns)
    base = {"catalog_object_id": "V", "location_id": "L", "state": "IN_STOCK"}
    write(spark, tmp_path, "inventory", [base | {"quantity": "10", "calculated_at": T1}, base | {"quantity": "3", "calculated_at": T2}, base | {"location_id": "M", "quantity": "bad", "calculated_at": T1}, base | {"location_id": None}])
    rows = {r.location_id: r.quantity for r in silver.inventory_snapshots(bronze.bronze_pages(spark, str(tmp_path), "inventory")).collect()}
    assert rows == {"L": 3.0, "M": 0.0}


def test_rebuild_writes_typed_empty_tables(spark, tmp_path):
    counts = silver.rebuild(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"))
    assert set(counts.values()) == {0}
    assert bronze.silver_table(spark, str(tmp_path / "silver"), "payments").schema == schemas.SILVER["payments"]
    assert bronze.optional_csv(spark, str(tmp_path / "none.csv"), "vendor_costs").count() == 0


@pytest.mark.parametrize(("day", "tz", "start", "hours"), [
    (dt.date(2026, 1, 15), "America/Los_Angeles", "2026-01-15 08:00:00", 24), (dt.date(2026, 7, 15), "America/Los_Angeles", "2026-07-15 07:00:00", 24),
    (dt.date(2026, 3, 8), "America/Los_Angeles", "2026-03-08 08:00:00", 23), (dt.date(2026, 11, 1), "America/Los_Angeles", "2026-11-01 07:00:00", 25), (dt.date(2026, 5, 1), "Asia/Tokyo", "2026-04-30 15:00:00", 24),
])
def test_store_days(spark, day, tz, start, hours):
    a, b = bronze.store_day_window(day, tz)
    r = spark.range(1).select(a.alias("a"), b.alias("b"), bronze.store_day_window(day + dt.timedelta(1), tz)[0].alias("c")).first()
    assert str(r.a) == start and r.b - r.a == dt.timedelta(hours=hours) and r.b == r.c


def test_sources_refuse(spark):
    with pytest.raises(ValueError):
        bronze.active_locations(spark.createDataFrame([("L", "CLOSED")], "location_id string, status string"))
    with pytest.raises(ValueError):
        bronze.updated_within(spark.range(1), "id", 366, dt.datetime(2026, 1, 1))
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1),), (dt.datetime(2025, 1, 1),)], "t timestamp_ntz")
    assert bronze.updated_within(df, "t", 7, dt.datetime(2026, 1, 3)).count() == 1


def test_functions(spark):
    df = spark.createDataFrame([("  red \t wine ", dt.date(2025, 7, 26), 7.5, float("nan"))], "c string, d date, x double, n double")
    r = df.select(
        scalar.normalize_category("c"), scalar.day_of_week_iso("d"), scalar.day_name("d"), scalar.month_name("d"), scalar.week_start("d"), scalar.week_of_year("d"), scalar.rounded(-F.col("x")), scalar.is_nan("n"),
        scalar.add_days("d", 2), scalar.date_diff_in("week", F.lit("2025-07-20").cast("date"), "d"), scalar.surrogate_key(F.lit("a"), F.lit(None)), scalar.item_label(F.lit("Ale"), F.lit("Regular")),
        scalar.item_label(F.lit("Ale"), F.lit("Six")), scalar.clamp(F.col("x"), 0.5, 2.0), scalar.try_cast_as(F.lit("x"), "int"), scalar.regexp_replace_all("c", r"\s", ""), scalar.to_local_time(F.lit(None), F.lit("2026-01-01 00:00:00")),
    ).first()
    assert list(r)[:10] == ["RED WINE", 6, "Saturday", "July", dt.date(2025, 7, 21), 30, -8.0, True, dt.date(2025, 7, 28), 1]
    assert list(r)[11:16] == ["Ale", "Ale — Six", 2.0, None, "redwine"] and str(r[16]) == "2026-01-01 00:00:00"
    assert [x.n for x in scalar.integers(spark, 2, 4).collect()] == [2, 3, 4]


LINE = "order_line_key string, order_updated_at timestamp_ntz, net_sales_cents long"


def test_incremental_merge(spark, tmp_path):
    day = lambda n: dt.datetime(2026, 1, n)
    t = merge.VersionedTable(spark, str(tmp_path / "fact"))
    assert t.current() is None
    first = spark.createDataFrame([("old", day(1), 1), ("late", day(20), 2), ("gone", day(20), 3)], LINE)
    merge.incremental(t, first)
    edit = spark.createDataFrame([("old", day(1), 99), ("late", day(21), 12_347), ("new", None, 5)], LINE)
    rows = {r.order_line_key: r.net_sales_cents for r in merge.incremental(t, edit).collect()}
    assert rows == {"old": 1, "late": 12_347, "gone": 3, "new": 5}  # outside the lookback: kept; deletions: not propagated
    again = {r.order_line_key: r.net_sales_cents for r in merge.incremental(t, edit).collect()}
    assert again == rows
    assert merge.incremental(t, edit, full_refresh=True).count() == 3


def test_history(spark):
    v = "variation_id string, item_name string, variation_name string, category_name string, price_cents long, currency string, sku string, is_deleted boolean"
    full = "item_version_key string, " + v + ", valid_from timestamp_ntz, valid_to timestamp_ntz, version_captured_at timestamp_ntz"
    t1, t2, t3 = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1), dt.datetime(2026, 3, 1)
    row = lambda k, name="A", cat="BEER": (k, name, "R", cat, 1, "USD", None, False)
    h = merge.scd2(spark.createDataFrame([], full), spark.createDataFrame([row("a"), row("b"), row("c")], v), t1)
    assert h.where("valid_to is null").count() == 3
    source = spark.createDataFrame([row("a", "B", "WINE"), row("b")], v)
    h2 = merge.scd2(h, source, t2)
    assert h2.count() == 4 and h2.where("valid_to is null").count() == 3 and merge.scd2(h2, source, t3).count() == 4
    history = star.dim_item_history(h2, spark.createDataFrame([], "raw_norm string, canonical_category string"))
    assert checks.history_well_formed(history).count() == 0
    facts = history.select("item_key").where("square_catalog_object_id = 'a'").distinct().withColumn("closed_at", F.explode(F.array(*[F.lit(x).cast("timestamp_ntz") for x in (t1, t2 - dt.timedelta(1), t2)])))
    assert [r.h_item_name for r in merge.as_of_join(facts, history).orderBy("closed_at").collect()] == ["A", "A", "B"]
    broken = history.withColumn("valid_to", F.when(F.col("valid_to").isNotNull(), F.lit(dt.datetime(2026, 1, 20)).cast("timestamp_ntz")))
    assert [r.fault for r in checks.history_well_formed(broken).collect()] == ["gap"]


def test_staging(spark):
    raw = spark.createDataFrame([("O", "1", "2.5", T1, "bad", None)], "order_id string, line_item_uid string, quantity string, order_created_at string, order_updated_at string, closed_at string")
    r = staging.stg_order_lines(raw).first()
    assert float(r.quantity) == 2.5 and r.order_created_at == dt.datetime(2026, 1, 1) and r.order_updated_at is None
    o = staging.stg_category_overrides(spark.createDataFrame([("wine ", "Red Wine"), ("x", " X"), (None, "a"), ("Wine", "Rose")], "raw_category string, canonical_category string")).collect()
    assert [tuple(r) for r in o] == [("WINE", "ROSE")]
    c = staging.stg_vendor_costs(spark.createDataFrame([("v", "n", "c", "w", "12"), ("v", "n", "c", "w", "x"), (None,) * 5], schemas.CSV["vendor_costs"])).collect()
    assert [(r.variation_id, r.unit_cost_cents) for r in c] == [("v", 12)]


def test_checks_fail_where_they_must(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k int, v string")
    assert checks.not_null(df, "v").count() == 1 and checks.unique(df, "k").count() == 1 and checks.accepted_values(df, "v", "a").count() == 1
    assert checks.relationships(df, "k", df.where("k = 1"), "k").count() == 1 and checks.row_differences(df, df.limit(2)).count() == 1 and checks.row_differences(df, df).count() == 0
    a, b = spark.createDataFrame([(1, 100.0), (2, 5.0), (3, 1.0)], "k int, v double"), spark.createDataFrame([(1, 100.5), (2, 6.0)], "k int, v double")
    got = {(r.k, r.column) for r in checks.compare_by_key(a, b, ["k"], ["v"], 0.01).collect()}
    assert got == {(2, "v"), (3, "(row)")}
    assert checks.single_row(df).count() == 1 and checks.flagged(df, "x").first().failures == 3
    assert views.staleness_level(F.lit(2)) is not None and spark.range(1).select(views.staleness_level(F.lit(2)), views.staleness_label(F.lit(0))).first()[:] == ("warning", "today")


def test_starters(spark, tmp_path):
    c = spark.createDataFrame([("v1", "A", "beer", 1000), ("v2", "B", "Beer ", 500), ("v3", "C", None, 100)], "variation_id string, item_name string, category_name string, price_cents long")
    assert [tuple(r) for r in sinks.category_override_starter(c).collect()] == [("BEER", "BEER", 2)]
    rows = {r.variation_id: r for r in sinks.vendor_cost_template(c, {"Beer": "Brewer"}, "Other").collect()}
    assert rows["v1"].vendor_name == "Brewer" and rows["v3"].vendor_name == "Other" and 550 <= int(rows["v1"].unit_cost_cents) <= 750
    sinks.export_csv(c, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 3


def test_stream_merges_pages(spark, tmp_path):
    write(spark, tmp_path, "orders", [{"id": "O", "state": "COMPLETED", "updated_at": T2, "line_items": [{"uid": "1", "gross_sales_money": money(2000)}]}])
    t = merge.VersionedTable(spark, str(tmp_path / "fact"))

    def to_fact(batch):
        pages = batch.select(F.posexplode("payload.orders").alias("position", "record"), F.col("metadata.extracted_at").alias("extracted_at"), F.lit("").alias("file"))
        lines = staging.stg_order_lines(silver.order_lines(pages))
        return lines.select(scalar.surrogate_key("order_id", "line_item_uid").alias("order_line_key"), "order_updated_at", "net_sales_cents")

    for _ in range(2):  # the second run finds nothing new
        bronze_stream.merge_stream(bronze_stream.page_stream(spark, str(tmp_path), "orders"), to_fact, t, str(tmp_path / "check")).awaitTermination()
    assert [r.net_sales_cents for r in t.current().collect()] == [2000]


def test_a_writer_that_dies_leaves_the_table(spark, tmp_path):
    t = merge.VersionedTable(spark, str(tmp_path / "t"))
    rows = lambda n: spark.createDataFrame([(str(n), dt.datetime(2026, 1, 1), n)], LINE)
    t.publish(rows(1))
    (tmp_path / "t" / "version-torn").mkdir()  # a version that was never named
    (tmp_path / "t" / "pointers" / ".version-torn").write_text("version-torn")  # and a pointer that never appeared
    assert [r.net_sales_cents for r in t.current().collect()] == [1] and t.version() == 1
    t.publish(rows(2))
    old = t.current()
    with pytest.raises(FileExistsError):  # a second writer that began from version 1
        t.publish(rows(3), 1)
    assert [r.net_sales_cents for r in t.current().collect()] == [2] and t.version() == 2
    t.publish(rows(4))
    assert [r.net_sales_cents for r in old.collect()] == [2]  # who reads an old version keeps it


def test_late_rows_of_a_stream(spark):
    day = lambda n: dt.datetime(2026, 1, n)
    target = spark.createDataFrame([("a", day(20), 1), ("b", day(20), 2), ("u", None, 3)], LINE)
    batch = spark.createDataFrame([("a", day(10), 9), ("late", day(2), 4), ("b", day(21), 5), ("b", day(19), 8), ("u", day(1), 6), ("n", None, 7)], LINE)
    want = {"a": 1, "b": 5, "u": 6, "late": 4, "n": 7}  # no lookback, no older row over a newer one, the newest of a batch
    got = merge.newest_wins(target, batch)
    assert {r.order_line_key: r.net_sales_cents for r in got.collect()} == want
    assert {r.order_line_key: r.net_sales_cents for r in merge.newest_wins(got, batch).collect()} == want


def test_history_sink(spark, tmp_path):
    v = "variation_id string, item_name string, variation_name string, category_name string, price_cents long, currency string, sku string, is_deleted boolean"
    source = lambda *rows: spark.createDataFrame([(k, n, "R", "BEER", 1, "USD", None, False) for k, n in rows], v)
    t = merge.VersionedTable(spark, str(tmp_path / "h"))
    t1, t2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1)
    assert merge.scd2_snapshot(t, source(("a", "A"), ("b", "B")), t1).count() == 2
    got = merge.scd2_snapshot(t, source(("a", "New"), ("b", "B")), t2)
    assert sorted((r.variation_id, r.item_name, r.valid_from, r.valid_to) for r in got.collect() if r.variation_id == "a") == [("a", "A", t1, t2), ("a", "New", t2, None)] and got.count() == 3
    with pytest.raises(ValueError):
        merge.scd2_snapshot(t, source(("a", "A")), dt.datetime(2026, 3, 1), full_refresh=True)
    with pytest.raises(ValueError):
        merge.scd2_snapshot(t, source(("a", "A")), t2)  # the same capture again
    assert t.current().count() == 3


def test_checks_see_what_is_spoiled(spark, sf):
    """Each check of the star passes on the data and fails once that is spoiled."""
    s = retail.build(spark, sf)
    spoiled = lambda **tables: checks_star(s, **tables)
    day = F.to_date(F.lit("1980-01-01"))
    first = s.lines.where("closed_at is not null and item_key is not null").orderBy("order_line_key").first().order_line_key
    one = F.col("order_line_key") == first
    early = s.lines.withColumn("sale_date", F.when(one, day).otherwise(F.col("sale_date")))
    assert checks.calendar_covers_sales(spoiled(lines=early, dates=s.dates)).count() == 1 and checks.local_time_is_right(spoiled(lines=early)).count() >= 1
    undated = s.lines.withColumn("sale_date", F.when(~one, F.col("sale_date")))
    assert [r.failure for r in checks.local_time_is_right(spoiled(lines=undated)).collect()] == ["nullability_mismatch"]
    unmoved = s.lines.withColumn("closed_at_local", F.col("closed_at"))
    assert {r.failure for r in checks.local_time_is_right(spoiled(lines=unmoved)).collect()} == {"offset_or_date_mismatch"}
    assert checks.item_key_resolves(spoiled(lines=s.lines.withColumn("catalog_object_id", F.when(one, "Q").otherwise(F.col("catalog_object_id"))))).count() == 1
    assert {r["column"] for r in checks.fact_matches_source(spoiled(lines=s.lines.where(~one))).collect()} >= {"rows", "keys", "net"}
    f = spark.createDataFrame([(1.0,), (-1.0,), (None,), (float("nan"),)], "forecast_units double")
    assert checks.forecast_is_sane(f).count() == 3
    p = spark.createDataFrame([("7", 1, dt.date(2026, 1, 3), 5, 1, 1), ("30", 2, dt.date(2026, 1, 1), 4, 1, 1)], "period_label string, period_order int, period_start date, orders long, units long, gross_sales_cents long")
    assert [(r.narrow, r.wide) for r in checks.narrower_within_wider(p).collect()] == [("7", "30")]
    assert checks.period_coverage(p.where("period_order = 1"), p).count() == 1 and checks.period_grain(p.union(p)).count() == 2
    wrong = spoiled(periods=s.periods.withColumn("period_start", F.when(F.col("period_order") == 2, F.date_sub("period_start", 40)).otherwise(F.col("period_start"))))
    wrong.__dict__["lines"] = s.lines
    own = kpi.RANGES["weekday"](s, windows.Windows(s.periods)).where("period_order = 2")
    longer = kpi.RANGES["weekday"](wrong, windows.Windows(wrong.periods)).where("period_order = 2")
    assert checks.compare_by_key(own, longer, ["day_of_week"], ["net_sales_cents"]).count() >= 5
    history = s.item_history.unionByName(s.item_history)
    assert checks.history_fan_out_of(s.lines.where(one), history).count() == 1


def checks_star(s, **tables):
    """A star with some of its tables replaced."""
    out = star.Star(s.staged, s.as_of, s.lottery)
    out.__dict__.update(tables)
    return out


def test_gold_tables(spark, sf, tmp_path):
    """Every table of the star is written and rebuilt; a day's filter reaches the files."""
    s = retail.build(spark, sf)
    rows = gold.written_tables(s, str(tmp_path))
    assert rows["fact_order_line"] == rows["fact_order_line_margin"] == s.lines.count() and rows["dim_period"] == 5
    assert gold.written_tables(s, str(tmp_path)) == rows
    read = spark.read.parquet(str(tmp_path / "fact_order_line")).where("sale_date = date'2001-07-01'")
    assert "PushedFilters: [IsNotNull(sale_date), EqualTo(sale_date" in read._jdf.queryExecution().toString()


def test_only_active_and_catalogue(spark):
    places = spark.createDataFrame([("L", "ACTIVE"), ("M", "CLOSED")], "location_id string, status string")
    assert [r.location_id for r in bronze.only_active(spark.createDataFrame([("L",), ("M",), ("N",)], "location_id string"), places).collect()] == ["L"]
    assert {r.relation for r in star.range_catalogue(spark).collect()} == {"range_window", *(f"range_{n}" for n in kpi.RANGES)}


def test_published_relations(spark, sf):
    s = retail.build(spark, sf)
    names = kpi.publish(s, dt.date(2001, 5, 1), dt.date(2001, 5, 31))
    assert {"range_window", "range_summary"} <= set(names) and all(spark.table(n).columns for n in names)
    assert spark.sql("select count(*) as n from range_summary join range_window using (period_start)").first().n == 1
