"""Sorted hash arrays in the shared folder, memory-mapped by the tasks that look things up.

A task packs what it has gathered into one row per hash bucket; one task per bucket (beyond `MOST_TASKS`,
per range of buckets, one after the other) merges them and writes the bucket's columns into one file; later
tasks map these files. Files appear by an atomic rename, so a repeated task rewrites the same content and a
lost executor loses nothing. The driver and every task know the buckets that were written, at a bit each: one
of these that a task cannot find is an error, not an empty bucket.

Buckets are ranges of the hash. Their number follows from the bytes of text (`bucket_count`), so a bucket
fits a worker's memory whatever the number of partitions is. What reaches the driver for them is a row for
32,768 buckets (`told`): at 100 TB, 12.5 million buckets, 400 rows and 1.6 MB.
"""

from __future__ import annotations

import io
import json
import mmap
import os
import sys
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK48 = np.uint64((1 << 48) - 1)

#: Bytes of text that one bucket stands for, and the least number of buckets.
BUCKET_BYTES, LEAST_BUCKETS = 8 << 20, 16
#: Tasks of a stage that merges buckets; more buckets share these.
MOST_TASKS = 16_384


def bucket_count(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, text: str = "text") -> int:
    """The number of buckets for the texts of docs: from their bytes, which are summed first."""
    total = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")).cast("long"))).first()[0] or 0
    return max(LEAST_BUCKETS, -(-total // bucket_bytes))


def bucket48(h: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of 48-bit hashes: ranges of the hash in ascending order."""
    return ((h >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)


def bucket64(h: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of 64-bit hashes, likewise."""
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def pack48(h: np.ndarray) -> bytes:
    """48-bit numbers as a plane of their high 16 bits (sorted input compresses) and one of the low 32."""
    return (h >> np.uint64(32)).astype("<u2").tobytes() + (h & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()


def unpack48(data: bytes) -> np.ndarray:
    n = len(data) // 6
    high, low = np.frombuffer(data, "<u2", n), np.frombuffer(data, "<u4", n, 2 * n)
    return (high.astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)


def ranges(sorted_buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of each run of equal buckets."""
    if len(sorted_buckets):
        edge = np.flatnonzero(np.diff(sorted_buckets)) + 1
        for lo, hi in zip(np.append(0, edge), np.append(edge, len(sorted_buckets))):
            yield int(sorted_buckets[lo]), int(lo), int(hi)


def by_bucket(rows: DataFrame, buckets: int, merge: Callable[[pa.Table], pa.Table], schema: str, most_tasks: int = MOST_TASKS) -> DataFrame:
    """merge(rows of a bucket) for every bucket that has rows, each in a task of its own; beyond most_tasks buckets,
    a task sorts the rows of its range of buckets and holds those of one at a time."""

    def merged(got: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if got:
            out = merge(pa.Table.from_batches(got))
            got.clear()
            pa.default_memory_pool().release_unused()  # the worker may serve other tasks after this one
            yield from out.to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for b in batches:
            for bucket, lo, hi in ranges(b.column("bucket").to_numpy()):
                if bucket != now:
                    yield from merged(held)
                    now = bucket
                held.append(b.slice(lo, hi - lo))
        yield from merged(held)

    if buckets <= most_tasks:
        return rows.repartitionById(buckets, "bucket").mapInArrow(lambda batches: merged([b for b in batches if b.num_rows]), schema)
    task = F.expr(f"cast(cast(bucket as bigint) * {most_tasks} div {buckets} as int)")
    return rows.repartitionById(most_tasks, task).sortWithinPartitions("bucket").mapInArrow(run, schema)


class Buckets:
    """A set of bucket numbers, at a bit each."""

    def __init__(self, numbers: Iterable[int] = ()):
        at = np.fromiter(numbers, np.int64)
        bits = np.zeros(int(at.max()) + 1 if len(at) else 0, bool)
        bits[at] = True
        self.bits = np.packbits(bits, bitorder="little")

    def __contains__(self, bucket: int) -> bool:
        return 0 <= bucket >> 3 < len(self.bits) and bool(self.bits[bucket >> 3] >> (bucket & 7) & 1)

    def __iter__(self) -> Iterator[int]:
        return iter(np.flatnonzero(np.unpackbits(self.bits, bitorder="little")).tolist())


def told(rows: DataFrame, bucket: str = "n", /, **sums: Column) -> tuple[Buckets, dict[str, int]]:
    """The bucket numbers (0 on) that rows tell of, and sums over all rows. A row for 32,768 buckets reaches the driver; rows without a bucket only count in sums."""
    at = F.col(bucket).cast("long") + 1  # the functions count from 1
    own = [F.sum(x).alias(f"sum_{k}") for k, x in sums.items()]
    got = rows.groupBy(F.bitmap_bucket_number(at).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"), *own).collect()
    out = Buckets()
    blocks = {r.block - 1: np.frombuffer(bytes(r.bits), np.uint8) for r in got if r.block is not None}
    if blocks:
        size = len(next(iter(blocks.values())))
        out.bits = np.zeros((max(blocks) + 1) * size, np.uint8)
        for k, x in blocks.items():
            out.bits[k * size : (k + 1) * size] = x
    return out, {k: sum(r[f"sum_{k}"] or 0 for r in got) for k in sums}


def smallest(x: np.ndarray) -> np.ndarray:
    """Numbers from 0 on in the smallest unsigned kind that holds them."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def _local(folder: str) -> str | None:
    if folder.startswith("file:"):
        return "/" + folder[5:].lstrip("/")
    return folder if "://" not in folder else None


def _written(out, columns: dict[str, np.ndarray]) -> None:
    """A line of JSON (name, kind, length and place of each column), then the columns, each at a multiple of 64 bytes."""
    at, told = 0, []
    for name, x in columns.items():
        told.append((name, x.dtype.str, len(x), at))
        at += -(-x.nbytes // 64) * 64
    head = json.dumps(told).encode()
    out.write(head + b" " * (-(len(head) + 1) % 64) + b"\n")
    for x in columns.values():
        out.write(np.ascontiguousarray(x).data)
        out.write(bytes(-x.nbytes % 64))


def save(folder: str, name: str, **columns: np.ndarray) -> None:
    """Writes the columns of a bucket as one file."""
    path = _local(folder)
    if path is None:
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(folder)
        held = io.BytesIO()
        _written(held, columns)
        with store.open_output_stream(f"{at}/{name}.arrays") as f:
            f.write(held.getvalue())
        return
    os.makedirs(path, exist_ok=True)
    fd, part = tempfile.mkstemp(dir=path, suffix=".part")
    with os.fdopen(fd, "wb") as f:
        _written(f, columns)
    os.replace(part, f"{path}/{name}.arrays")


def mapped(path: str) -> dict[str, np.ndarray]:
    """The columns of a file, mapped without holding a file descriptor where Python can do so (3.13)."""
    with open(path, "rb") as f:
        told = json.loads(f.readline())
        begin = f.tell()
        own = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, **({"trackfd": False} if sys.version_info >= (3, 13) else {}))
    return {name: np.frombuffer(own, kind, n, begin + at) if n else np.zeros(0, kind) for name, kind, n, at in told}


class Arrays:
    """The columns of all buckets, mapped on first use. Buckets that are not among the written ones are empty."""

    def __init__(self, folder: str, buckets: int, written: Buckets | Iterable[int]):
        self.folder, self.buckets, self.written = folder, buckets, written if isinstance(written, Buckets) else Buckets(written)
        self._open: dict[str, dict[str, np.ndarray]] = {}

    def __getstate__(self):
        return {"folder": self.folder, "buckets": self.buckets, "written": self.written, "_open": {}}

    def columns(self, bucket: int) -> dict[str, np.ndarray]:
        """The bucket's columns; none if it was never written."""
        if bucket not in self.written:
            return {}
        name = f"{bucket}.arrays"
        if name not in self._open:
            path = _local(self.folder)
            if path is None:  # a store without local paths: one copy for this worker, unlinked at once
                from pyarrow import fs

                store, at = fs.FileSystem.from_uri(self.folder)
                with store.open_input_stream(f"{at}/{name}") as f, tempfile.NamedTemporaryFile(suffix=".arrays") as own:
                    while block := f.read(8 << 20):
                        own.write(block)
                    own.flush()
                    self._open[name] = mapped(own.name)
            else:
                self._open[name] = mapped(f"{path}/{name}")  # a missing file raises: the result would not be whole
        return self._open[name]

    def lookup(self, keys: np.ndarray, buckets: np.ndarray, columns: tuple[str, ...]) -> tuple[np.ndarray, ...]:
        """For ascending keys: whether each is there, and its values (0 if not). The key column is `key`."""
        there = np.zeros(len(keys), bool)
        out = [np.zeros(len(keys), np.int64) for _ in columns]
        for b, lo, hi in ranges(buckets):
            own = self.columns(b)
            if not own or not len(own["key"]):
                continue
            at = np.searchsorted(own["key"], keys[lo:hi])
            at[at == len(own["key"])] = 0
            hit = own["key"][at] == keys[lo:hi]
            there[lo:hi] = hit
            for x, c in zip(out, columns):
                x[lo:hi][hit] = own[c][at[hit]]
        return there, *out


# Tables of 64-bit keys at five bytes each: the leading bits by an index, then 32 and 8 bits in columns.


def key_columns(keys: np.ndarray, name: str) -> dict[str, np.ndarray]:
    """The columns of a set of ascending, distinct keys."""
    bits = min(max(int(len(keys)).bit_length() - 5, 0), 20)
    top = (keys >> np.uint64(64 - bits)) if bits else np.zeros(len(keys), np.uint64)
    index = np.searchsorted(top, np.arange((1 << bits) + 1, dtype=np.uint64))
    low = (keys >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)
    return {f"{name}_index": index.astype(np.uint32 if len(keys) < 1 << 32 else np.uint64), f"{name}_low": low.astype(np.uint32), f"{name}_tag": (keys >> np.uint64(24 - bits)).astype(np.uint8)}


def find(own: dict[str, np.ndarray], name: str, keys: np.ndarray) -> np.ndarray:
    """The place of each key in a set, -1 where it is not there."""
    index, low, tag = (own[f"{name}_{c}"] for c in ("index", "low", "tag"))
    if not len(low) or not len(keys):
        return np.full(len(keys), -1)
    bits = (len(index) - 1).bit_length() - 1
    top = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    want, mark = ((keys >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32), (keys >> np.uint64(24 - bits)).astype(np.uint8)
    at, stop = index[top].astype(np.int64), index[top + 1].astype(np.int64)
    end = stop.copy()
    for _ in range(int((stop - at).max()).bit_length()):
        mid = (at + stop) >> 1
        less = (at < stop) & (low[np.minimum(mid, len(low) - 1)] < want)
        at, stop = np.where(less, mid + 1, at), np.where(less, stop, mid)
    inside = np.minimum(at, len(low) - 1)
    same = (at < end) & (low[inside] == want)
    out = np.where(same & (tag[inside] == mark), at, -1)
    left = np.flatnonzero(same & (out < 0))
    while len(left):  # keys that agree in the leading bits and these 32
        at[left] += 1
        left = left[(at[left] < end[left])]
        left = left[low[at[left]] == want[left]]
        hit = tag[at[left]] == mark[left]
        out[left[hit]] = at[left[hit]]
        left = left[~hit]
    return out


def table_columns(keys: np.ndarray, values: list[np.ndarray], usual: tuple[int, ...]) -> dict[str, np.ndarray]:
    """The columns of a table. Keys with the usual values are a set of their own; the others have a code of their row of values."""
    order = np.argsort(keys)
    keys, values = keys[order], np.stack([v[order] for v in values], 1)
    plain = (values == np.array(usual)).all(1)
    rest = values[~plain]
    spread = np.lexsort(rest.T[::-1])
    new = np.append(True, (rest[spread][1:] != rest[spread][:-1]).any(1)) if len(rest) else np.zeros(0, bool)
    code = np.empty(len(rest), np.int64)
    code[spread] = np.cumsum(new) - 1
    rows = rest[spread][new]
    return key_columns(keys[plain], "plain") | key_columns(keys[~plain], "other") | {"code": smallest(code)} | {f"value{k}": rows[:, k].copy() for k in range(rows.shape[1])}


def table_values(arrays: Arrays, keys: np.ndarray, buckets: np.ndarray, usual: tuple[int, ...]) -> list[np.ndarray]:
    """The values of each key (in any order), 0 where it is not in its bucket's table."""
    out = [np.zeros(len(keys), np.int64) for _ in usual]
    order = np.argsort(smallest(buckets), kind="stable")
    for b, lo, hi in ranges(buckets[order]):
        own = arrays.columns(b)
        if not own:
            continue
        rows = order[lo:hi]
        plain = find(own, "plain", keys[rows]) >= 0
        for x, v in zip(out, usual):
            x[rows[plain]] = v
        rows = rows[~plain]
        at = find(own, "other", keys[rows])
        rows, at = rows[at >= 0], at[at >= 0]
        code = own["code"][at]
        for k, x in enumerate(out):
            x[rows] = own[f"value{k}"][code]
    return out
