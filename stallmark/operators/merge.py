"""Stateful batch operators: incremental merge, type-2 history, point-in-time join."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalar import surrogate_key
from ..sources.gold import freed_shuffles, parts_by_hash
from ..sources.versions import HASHES, Segment, VersionedTable, content_hashes

LOOKBACK_DAYS = 7
#: Rows of changes (or closed versions) that lie beside their files until they are folded in, as a share of the rows there.
FOLD_SHARE = 0.2
BROADCAST_ROWS = 200_000
TRACKED = ("item_name", "variation_name", "category_name", "price_cents", "sku", "is_deleted")


def merge_delta(target: DataFrame, source: DataFrame, updated: str = "order_updated_at", lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """The source rows to merge: not dated, or from `lookback` days before the target's latest update on.

    The bound is one value, read to the driver so that it is a literal in the scan of the source.
    """
    last = target.agg(F.max(F.col(updated).cast("date"))).first()[0]
    bound = last - dt.timedelta(lookback) if last else dt.date(1970, 1, 1)
    return source.where(F.col(updated).isNull() | (F.col(updated) >= F.lit(dt.datetime.combine(bound, dt.time())).cast("timestamp_ntz")))


def merge(target: DataFrame, source: DataFrame, key: str = "order_line_key", updated: str = "order_updated_at", lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows of the delta replace those of their key; others stay as they are, also if the source lost them. Columns follow the source."""
    delta = merge_delta(target, source, updated, lookback)
    kept = target.join(delta.select(key), key, "left_anti")
    return kept.unionByName(delta, allowMissingColumns=True).select(*source.columns)


def _few(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def replaced(table: VersionedTable, segments: list[Segment], schema: StructType, rows: DataFrame, key: str) -> list[Segment]:
    """The segments after rows took the place of those of their key, and others were added: copy on write.

    Rows that are stored with the same content are left out. Of the base only the key, the hashes and the place in a file
    are read; the files that hold a changed key are written again without it, all others are named again. A large base is
    gone through in parts by hash of the key, so that the disk for shuffles follows a part.
    """
    base = table.read(segments, schema, "base")
    stored = base.select(F.col(key).alias("_key"), *(F.col(h).alias(f"old{h}") for h in HASHES), table.file_of(base).alias("_file"))
    new = rows.withColumns(content_hashes(rows.columns))
    same = F.col("old_h1").eqNullSafe(F.col("_h1")) & F.col("old_h2").eqNullSafe(F.col("_h2"))
    changed = new.join(stored, new[key].eqNullSafe(stored["_key"]), "left").where(F.col("_file").isNull() | ~same).select(*rows.columns, "_file")
    staging = f"{table.path}/staging/{uuid.uuid4().hex}"
    parts = parts_by_hash(key, sum(s.rows for s in segments if s.part == "base"))  # one after the other, each with its own shuffles
    for part in parts:
        own = changed if part is None else changed.where(part)
        with freed_shuffles(table.spark):
            own.write.mode("append").option("compression", "zstd").parquet(staging)
    changed = table.spark.read.schema(changed.schema).parquet(staging)
    n = changed.count()
    if n:
        touched = [r["_file"] for r in changed.select("_file").where("_file is not null").distinct().collect()]  # at most the table's files
        fresh = changed.drop("_file").distinct()
        if touched:
            own = table.spark.read.schema(base.schema).parquet(*(f"{table.path}/data/{f}" for f in touched)).drop(*HASHES)
            keys = _few(changed.select(F.col(key).alias("_key")).distinct(), n)
            kept = own.join(keys, own[key].eqNullSafe(F.col("_key")), "left_anti")
            fresh = kept.unionByName(fresh)
        fresh = fresh.select(*schema.names)
        added = [table.write(fresh if part is None else fresh.where(part), ordered=True) for part in parts]
        segments = [*table.without(segments, touched), *(s for s in added if s)]
    path = table.spark._jvm.org.apache.hadoop.fs.Path(staging)
    table._fs.delete(path, True)
    return [s for s in segments if not (s.part == "base" and s.gone and table.read([s], schema, "base").isEmpty())]


def incremental(table: VersionedTable, source: DataFrame, full_refresh: bool = False, key: str = "order_line_key", updated: str = "order_updated_at", lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """Merges into a stored table, or rebuilds it; the table's new content. What is written follows the files that hold changed keys."""
    n = table.version()
    segments, schema = table.state(n)
    if full_refresh or schema is None:
        table.publish(source, n)
        return table.current()
    now = table.current()
    if now.select(*sorted(now.columns)).dtypes != source.select(*sorted(source.columns)).dtypes:
        table.publish(merge(now, source, key, updated, lookback), n)  # other columns: every file changes
        return table.current()
    if any(s.part == "changes" for s in segments):
        segments = folded(table, segments, schema, key, updated)
    delta = merge_delta(now, source, updated, lookback)
    table.commit(replaced(table, segments, schema, delta.select(*schema.names), key), schema, n)
    return table.current()


# Changes of a stream: rows that lie beside the base until they are folded in.


def append_changes(table: VersionedTable, rows: DataFrame, key: str = "order_line_key", updated: str = "order_updated_at") -> bool:
    """Adds the newest row of each key of a batch as changes: what it reads and writes is the batch, whatever the table's size. True if changes were folded.

    Readers resolve changes (with_changes). When these are more than FOLD_SHARE of the base, they are folded into its
    files, so that the work for each row stays bounded.
    """
    n = table.version()
    segments, schema = table.state(n)
    if schema is None:
        table.publish(newest_rows(rows, key, updated), n)
        return False
    own = newest_rows(rows, key, updated).select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))
    added = table.write(own, "changes")
    if added is None:
        return False
    segments = [*segments, added]
    rows_of = lambda part: sum(s.rows for s in segments if s.part == part)
    fold = rows_of("changes") > FOLD_SHARE * rows_of("base")
    if fold:
        segments = folded(table, segments, schema, key, updated)
    table.commit(segments, schema, n)
    return fold


def _numbered_changes(table: VersionedTable, segments: list[Segment], schema: StructType) -> DataFrame:
    """The changes with _seq, the place of their segment: a later batch wins where rows are equally new."""
    own = [s for s in segments if s.part == "changes"]
    rows = table.read(own, schema, "changes")
    places = F.create_map(*(F.lit(x) for k, s in enumerate(own) for x in (s.folder.split("/")[1], k)))
    return rows.withColumn("_seq", places[F.substring_index(table.file_of(rows), "/", 1)]).drop(*HASHES)


def with_changes(table: VersionedTable, segments: list[Segment], schema: StructType, key: str = "order_line_key", updated: str = "order_updated_at") -> DataFrame:
    """The base with its changes, the newest row of each key."""
    base = table.read(segments, schema, "base").drop(*HASHES)
    return newest_wins(base, _numbered_changes(table, segments, schema), key, updated, "_seq").select(*schema.names)


def folded(table: VersionedTable, segments: list[Segment], schema: StructType, key: str, updated: str) -> list[Segment]:
    """The segments after the changes went into the base's files, copy on write."""
    base = table.read(segments, schema, "base")
    win = winners(base, _numbered_changes(table, segments, schema), key, updated, "_seq").select(*schema.names)
    base_only = [s for s in segments if s.part != "changes"]
    return replaced(table, base_only, schema, win, key)


_BEGINNING = "0001-01-01"


def newest_rows(batch: DataFrame, key: str, updated: str, order: str | None = None) -> DataFrame:
    """The newest row of each key (undated ones as the oldest); by `order` where two are equally new."""
    at = F.coalesce(F.col(updated).cast("timestamp_ntz"), F.lit(_BEGINNING).cast("timestamp_ntz"))
    by = F.struct(at, F.col(order)) if order else at
    return batch.groupBy(key).agg(F.max_by(F.struct(*batch.columns), by).alias("row")).select("row.*")


def winners(target: DataFrame, batch: DataFrame, key: str, updated: str, order: str | None = None) -> DataFrame:
    """The newest row of each key of a batch that is at least as new as the target's."""
    rows = newest_rows(batch, key, updated, order)
    old = target.select(F.col(key), F.col(updated).alias("_old"), F.lit(True).alias("_known"))
    late = F.col("_known") & F.col("_old").isNotNull() & (F.col(updated).isNull() | (F.col(updated) < F.col("_old")))
    return rows.join(old, key, "left").where(~F.coalesce(late, F.lit(False))).select(*batch.columns)


def newest_wins(target: DataFrame, batch: DataFrame, key: str = "order_line_key", updated: str = "order_updated_at", order: str | None = None) -> DataFrame:
    """The target with the rows of a batch that are at least as new as its own of that key, however late they come.

    The batch is only a part of the source, so there is no lookback; of several rows of a key the newest counts
    (undated ones as the oldest).
    """
    columns = [c for c in batch.columns if c != order]
    win = winners(target, batch, key, updated, order).select(*columns)
    return target.join(win.select(key), key, "left_anti").unionByName(win, allowMissingColumns=True).select(*columns)


def _differs(columns: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    return out


def scd2(history: DataFrame, source: DataFrame, captured_at: dt.datetime, key: str = "variation_id", tracked: tuple[str, ...] = TRACKED) -> DataFrame:
    """The history after a capture: changed versions close and new ones open; others, and keys that vanished, stay."""
    at = F.lit(captured_at).cast("timestamp_ntz")
    columns = history.columns
    opened = {"item_version_key": surrogate_key(key, at), "valid_from": at, "valid_to": F.lit(None).cast("timestamp_ntz"), "version_captured_at": at}
    old = history.where("valid_to is null").alias("old")
    both = old.join(source.alias("new"), F.col(f"old.{key}") == F.col(f"new.{key}"), "full")
    known, there = F.col(f"old.{key}").isNotNull(), F.col(f"new.{key}").isNotNull()
    changed = known & there & _differs(tracked)
    closed = both.where(known).select(*(F.when(changed, at).otherwise(F.col("old.valid_to")).alias(c) if c == "valid_to" else F.col(f"old.{c}") for c in columns))
    fresh = both.where(there & (~known | changed)).select("new.*").withColumns(opened)
    return history.where("valid_to is not null").unionByName(closed).unionByName(fresh.select(*columns))


# A stored history. Versions are in three parts: `open`, `closing` (closed versions whose open rows still lie in the files of
# `open`) and `closed` (those whose open rows are gone). None of them is written again when a capture closes others.


def history_rows(table: VersionedTable, segments: list[Segment], schema: StructType) -> DataFrame:
    """All versions of a stored history."""
    done = table.read(segments, schema, "closed", "closing").drop(*HASHES)
    return open_versions(table, segments, schema).unionByName(done)


def open_versions(table: VersionedTable, segments: list[Segment], schema: StructType) -> DataFrame:
    """The versions that are still open: the rows of `open` but for those that were closed since they were written."""
    closing = table.read(segments, schema, "closing").select("item_version_key")
    closing = _few(closing, sum(s.rows for s in segments if s.part == "closing"))
    return table.read(segments, schema, "open").drop(*HASHES).join(closing, "item_version_key", "left_anti")


def scd2_snapshot(table: VersionedTable, source: DataFrame, captured_at: dt.datetime, full_refresh: bool = False, key: str = "variation_id", tracked: tuple[str, ...] = TRACKED) -> DataFrame:
    """Captures the source into a stored history; its new content. A history cannot be made again, so a full refresh is refused.

    Only open versions are compared with the source; what is written are the versions that close and those that open. When
    closed versions are more than FOLD_SHARE of the rows of `open`, the open ones are written once without them.
    """
    if full_refresh:
        raise ValueError("a history holds what its source no longer has; it is never rebuilt")
    n = table.version()
    segments, schema = table.state(n)
    if schema is None:
        times = F.lit(None).cast("timestamp_ntz")
        schema = source.limit(0).select(F.lit("").alias("item_version_key"), *source.columns, *(times.alias(c) for c in ("valid_from", "valid_to", "version_captured_at"))).schema
    else:
        last = table.read(segments, schema, "open", "closing", "closed").agg(F.max(F.greatest("valid_from", "valid_to"))).first()[0]
        if last is not None and last >= captured_at:
            raise ValueError(f"the history already reaches {last}; a capture must be later")
    now = open_versions(table, segments, schema)
    after = scd2(now, source, captured_at, key, tracked)
    at = F.lit(captured_at).cast("timestamp_ntz")
    changes = after.where((F.col("valid_from") == at) | F.col("valid_to").isNotNull())
    added = [table.write(changes.where("valid_to is not null"), "closing"), table.write(changes.where("valid_to is null"), "open")]
    segments = [*segments, *(s for s in added if s)]
    rows_of = lambda part: sum(s.rows for s in segments if s.part == part)
    if rows_of("closing") > FOLD_SHARE * rows_of("open"):
        left = table.write(open_versions(table, segments, schema), "open")
        done = [replace(s, part="closed") if s.part == "closing" else s for s in segments if s.part != "open"]
        segments = [*done, *([left] if left else [])]
    table.commit(segments, schema, n)
    return table.current()


def as_of_join(facts: DataFrame, history: DataFrame, at: str = "closed_at", key: str = "item_key") -> DataFrame:
    """Each fact with the version that was valid at its time; none is legal, facts then drop out."""
    h = history.select(*(F.col(c).alias(f"h_{c}") for c in history.columns))
    inside = (F.col(at) >= F.col("h_valid_from")) & (F.col("h_valid_to").isNull() | (F.col(at) < F.col("h_valid_to")))
    return facts.join(h, (F.col(key) == F.col(f"h_{key}")) & inside)
