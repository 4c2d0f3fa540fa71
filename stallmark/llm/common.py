"""Helpers that the operators of this subpackage share.

Work that must outlive an executor is written as Parquet under the shared folder
(`spark.checkpoint.dir`) and read again; nothing is kept on one machine.
"""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_folders: list[str] = []
_stored: list[str] = []


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared one. A session without one gets a local folder if its master is local (tests), else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "local")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        base = "file://" + tempfile.mkdtemp(prefix="stallmark-")
        spark.conf.set("spark.checkpoint.dir", base)
    _folders.append(f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}")
    return _folders[-1]


def removed_folder(spark: SparkSession, folder: str) -> None:
    """Removes a folder of the shared one, on any file system that Spark knows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Removes every folder that this process has made; for when the results that were read from them are stored."""
    while _stored:
        spark.sql(f"DROP TABLE IF EXISTS {_stored.pop()}")
    while _folders:
        removed_folder(spark, _folders.pop())


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Writes df to the shared folder and reads it again: cuts the lineage and survives lost executors."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, purpose: str, key: str, buckets: int) -> DataFrame:
    """One row of df for each key, in the shared folder in buckets by hash of the key, one file each.

    Joins on the key with rows dealt out alike, `repartition(buckets, key)`, leave the stored rows in place. Spark knows
    buckets only of tables in its catalog; the table is an external one over the folder, and release drops it.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    own = free_name(df, "bucket")
    dealt = df.withColumn(own, F.pmod(F.hash(key), F.lit(buckets))).repartitionById(buckets, own).dropDuplicates([key, own]).drop(own)
    dealt.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    _stored.append(name)
    return spark.table(name)


def named(column: str) -> Column:
    """The column of this very name, whatever signs it holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that df does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def file_place(df: DataFrame) -> Column | None:
    """Where a row lies: the hash of its file and its number there, the same however files are split; None if df is not read from Parquet files."""
    try:
        own = df.metadataColumn("_metadata")
        place = F.struct(F.xxhash64(own["file_path"]).alias("file"), own["row_index"].alias("at"))
        df.select(place)  # names are resolved here
    except AnalysisException:
        return None
    return place


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and len+1 offsets into them; a null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def gathered(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The values of pieces of buf, one after the other."""
    at = np.cumsum(size) - size
    return buf[np.arange(int(size.sum())) + np.repeat(start - at, size)]


def segments(offs: np.ndarray, limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `limit` bytes in all (one row at least), so that work arrays stay small."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


@functools.lru_cache(maxsize=32)
def byte_values(seed: int = 0, lower: bool = False) -> np.ndarray:
    """A random 64-bit value for each byte; with lower, A-Z have those of a-z."""
    out = np.random.default_rng(20240229 + seed).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    if lower:
        out[65:91] = out[97:123]
    return out


BYTE, LOWER = byte_values(), byte_values(lower=True)
#: Word separators of the contracts: space and \x09 to \x0D.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            grown = np.full(size, base, np.uint64)
            grown[0] = 1
            _powers[name] = np.cumprod(grown, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums: out[j] - out[i] holds values[i:j] times base**i."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words `[^\\x20\\x09-\\x0D]+`, and len+1 offsets of the rows' words."""
    if len(buf) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    space = SPACE[buf]
    cut = np.zeros(len(buf) + 1, bool)  # a word may start here: at a row's start or after a space
    cut[offs] = True
    before = cut[:-1].copy()
    before[1:] |= space[:-1]
    after = cut[1:].copy()
    after[-1] = True
    after[:-1] |= space[1:]
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(after & ~space) + 1
    return starts, ends, np.searchsorted(starts, offs).astype(np.int64)


def piece_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece of buf, from a value for each byte."""
    sums = prefix_hashes(values[buf])
    h = (sums[ends] - sums[starts]) * powers(len(buf) + 1)[1][starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (A-Z as a-z), and len+1 offsets of the rows' words."""
    starts, ends, at = word_bounds(buf, offs)
    return piece_hashes(buf, starts, ends, LOWER), at


def broadcast_if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """A broadcast hint only where the counted rows are within the limit; else Spark shuffles."""
    return F.broadcast(df) if rows <= limit else df


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for the ids of undirected edges; component is the smallest id reached.

    Alternates large-star and small-star steps, each written to the shared folder, until no
    edge changes; hubs are aggregated map-side and their joins left to skew handling.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    now = written(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            e = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        j = e.join(least, "u")
        if large:
            out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = j.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = mark(now)
    while seen[0]:
        last, now = now, written(star(star(now, True), False), "edges")
        new = mark(now)
        removed_folder(edges.sparkSession, last.inputFiles()[0].rsplit("/", 1)[0])  # its successor is stored
        if new == seen:
            break
        seen = new
    child = now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")
    roots = now.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return child.union(roots.join(child.select("id"), "id", "left_anti"))
