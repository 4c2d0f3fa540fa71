"""Raw pages as a stream, merged into the stored fact batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.merge import VersionedTable, append_changes


def page_stream(spark: SparkSession, root: str, entity: str, source: str = "square") -> DataFrame:
    """New pages of an entity as they arrive; text rows, one page each."""
    key = schemas.LIST_KEYS[entity]
    return spark.readStream.schema(schemas.envelope(key)).option("multiLine", True).option("recursiveFileLookup", True).json(f"{root}/{source}/{entity}")


def merge_stream(stream: DataFrame, to_fact: Callable[[DataFrame], DataFrame], table: VersionedTable, checkpoint: str, keep: int | None = None) -> StreamingQuery:
    """Each micro-batch, turned into fact rows, is added to the table's changes, the newest row of each key winning: neither late rows nor replays of a batch lose or revert any.

    A batch costs what its own rows cost, whatever the table's size; see merge.append_changes. With `keep`, files that the last
    `keep` versions do not name go whenever changes were folded: for a table that nobody reads at older versions and only this stream writes.
    """

    def apply(batch: DataFrame, _: int) -> None:
        if append_changes(table, to_fact(batch)) and keep:
            table.vacuum(keep)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
