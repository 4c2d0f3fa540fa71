"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte goes if it is covered by a `LENGTH`-byte string that also starts in a document with a smaller
id, as judged on the input. Three scans, with sorted hash arrays in the shared folder between them:

1. Each window of LENGTH bytes has an anchor, the least hash of its GRAM-byte strings (mixed again); equal
   windows have equal anchors. Runs of windows with one anchor are counted; anchors in more than one document are kept.
2. The runs with a kept anchor go, with their bytes (sorted and compressed), to one task per hash range, once for each
   distinct run and task. There the windows of runs that share an anchor but differ are sorted as suffixes:
   a mergesort whose comparisons find the common extension by binary search over prefix polynomial
   hashes. Neighbours that agree over LENGTH bytes are verified byte by byte. Every window learns the
   smallest id that holds it. Runs of very common anchors are split into single windows, keyed by
   their own bytes, so that no anchor gathers in one task. Should two different runs have one hash, the
   step is done anew with other byte values.
3. Each document looks its runs up and drops the covered bytes.

Defined cases: a null text is empty; repeated rows have equal ids and do not count against each other; a
row without an id is neither removed from nor compared with; texts shorter than LENGTH are kept; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import BYTE, byte_values, gathered, mix, named, powers, prefix_hashes, segments, shared_folder, utf8
from .hash_arrays import MASK48, Arrays, bucket48, bucket_count, by_bucket, pack48, ranges, save, smallest, told, unpack48

LENGTH = 50
#: 24 bytes: much shorter strings meet by chance in large corpora, longer ones make more and shorter runs.
GRAM = 24
RUN = 64
#: Runs of an anchor with more occurrences are split into single windows.
COMMON = 1000
#: Runs that a task gathers before it sorts and packs them, and bytes of them.
HELD_RUNS, HELD_BYTES = 1_000_000, 12 << 20
NO_ID = np.iinfo(np.int64).max
SEEDS = 4


def gram_hashes(buf: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the `gram` bytes at each place, built by doubling."""
    step = lambda k: np.uint64(pow(0xC2B2AE3D27D4EB4F, k, 1 << 64))
    h, size, out, done = BYTE[buf], 1, None, 0
    while True:
        if gram & size:
            n = len(buf) - done - size + 1
            out = h if out is None else out[:n] * step(size) + h[done : done + n]
            done += size
        if size * 2 > gram:
            return mix(out)
        h = h[:-size] * step(size) + h[size:]
        size *= 2


def anchors(buf: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The anchor of the window at each place of buf (48 bits); places without a whole window are missing."""
    m = gram_hashes(buf) & MASK48
    wide, size = length - GRAM + 1, 1
    while size * 2 <= wide:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    least = np.minimum(m[: len(m) - (wide - size)], m[wide - size :]) if wide > size else m
    return mix(least) & MASK48  # least hashes are small numbers: spread them over the buckets


def runs(buf: np.ndarray, offs: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(start, windows, anchor, row) of each run of at most RUN windows with one anchor, within rows."""
    if len(buf) < length:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none
    m = anchors(buf, length)
    mark = np.zeros(len(m) + 1, np.int32)  # 1 where a window lies within one row
    own = offs[1:] - offs[:-1] >= length
    np.add.at(mark, offs[:-1][own], 1)
    np.add.at(mark, offs[1:][own] - length + 1, -1)
    inside = np.cumsum(mark[:-1]) > 0
    new = inside.copy()
    new[1:] &= (m[1:] != m[:-1]) | ~inside[:-1]
    new[offs[:-1][own]] = True
    start = np.flatnonzero(new)
    row = np.searchsorted(offs, start, "right") - 1
    stop = np.minimum(np.append(start[1:], len(buf)), offs[row + 1] - length + 1)
    n = stop - start
    if len(n) and n.max() > RUN:
        parts = -(-n // RUN)
        at = np.repeat(start, parts) + RUN * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        n = np.minimum(RUN, np.repeat(stop, parts) - at)
        start, row = at, np.repeat(row, parts)
    return start, n, m[start], row


def content_keys(sums: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes at start."""
    h = (sums[start + size] - sums[start]) * powers(len(sums))[1][start]
    return mix(h ^ size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def run_keys(content: np.ndarray, size: np.ndarray, seed: int, limit: int = 4 << 20) -> np.ndarray:
    """The keys of runs whose bytes follow one another, some MB at a time."""
    offs, out = np.append(0, np.cumsum(size)), [np.zeros(0, np.uint64)]
    for lo, hi in segments(offs, limit):
        part = content[offs[lo] : offs[hi]]
        out.append(content_keys(prefix_hashes(byte_values(seed)[part]), offs[lo:hi] - offs[lo], size[lo:hi]))
    return np.concatenate(out)


def shared_runs(buf: np.ndarray, offs: np.ndarray, known: Arrays, sums: np.ndarray, length: int, common: int) -> tuple[np.ndarray, ...]:
    """(start, windows, group, key, row) of the runs with a shared anchor, those of common anchors window by window.

    The group is the anchor, or for single windows their own hash; the key is the hash of the run's bytes.
    """
    start, n, anchor, row = runs(buf, offs, length)
    order = np.argsort(anchor)
    ascending = anchor[order]
    there, count = known.lookup(ascending, bucket48(ascending, known.buckets), ("count",))
    keep = np.sort(order[there])
    split = np.zeros(len(start), bool)
    split[order[there & (count > common)]] = True
    split = split[keep]
    start, n, anchor, row = start[keep], n[keep], anchor[keep], row[keep]
    parts = np.where(split, n, 1)
    at = np.repeat(start, parts) + np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    single = np.repeat(split, parts)
    n = np.where(single, 1, np.repeat(n, parts))
    key = content_keys(sums, at, n + length - 1)
    group = np.where(single, key & MASK48, np.repeat(anchor, parts))
    return at, n, group, key, np.repeat(row, parts)


class Suffixes:
    """Comparison of the strings of `length` bytes at places of a buffer, by hashes of their parts."""

    def __init__(self, buf: np.ndarray, length: int):
        self.buf, self.length = buf, length
        self.sums, self.down = prefix_hashes(BYTE[buf]), powers(len(buf) + 1)[1]
        padded = np.append(buf, np.zeros(8, np.uint8)).astype(np.uint64)
        self.eight = np.zeros(len(buf), np.uint64)  # eight bytes from each place, big-endian
        for k in range(8):
            self.eight |= padded[k : k + len(buf)] << np.uint64(56 - 8 * k)

    def common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """How many bytes agree from p and q on, up to length: a binary search over hashed parts."""
        same = np.zeros(len(p), np.int64)
        step = 1 << (self.length.bit_length() - 1)
        while step:
            a, b = p + same, q + same
            fits = same + step <= self.length
            ae, be = np.where(fits, a + step, a), np.where(fits, b + step, b)
            equal = (self.sums[ae] - self.sums[a]) * self.down[a] == (self.sums[be] - self.sums[b]) * self.down[b]
            same += np.where(fits & equal, step, 0)
            step >>= 1
        return same

    def less(self, p: np.ndarray, q: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether the string at p sorts before that at q (or is equal, where asked)."""
        same = self.common(p, q)
        whole = same >= self.length
        at = np.where(whole, 0, same)
        return np.where(whole, or_equal, self.buf[p + at] < self.buf[q + at])

    def equal_bytes(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether the strings agree, byte by byte."""
        out = np.ones(len(p), bool)
        for k in [*range(0, self.length - 7, 8), self.length - 8]:
            out &= self.eight[p + k] == self.eight[q + k]
        return out

    def sort(self, place: np.ndarray, group: np.ndarray) -> np.ndarray:
        """An order of the places by group, then by their strings: a mergesort of all groups at once.

        Groups are first parted by the strings' first eight bytes; runs of 1, 2, 4, ... within what
        remains are merged by ranking each member in the other run with a binary search.
        """
        order = np.lexsort((self.eight[place], group))
        g, e = group[order], self.eight[place[order]]
        new = np.append(True, (g[1:] != g[:-1]) | (e[1:] != e[:-1])) if len(g) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(g)))
        base, total = np.repeat(begin, size), np.repeat(size, size)
        local = np.arange(len(g)) - base
        width = 1
        while len(size) and width < size.max():
            live = np.flatnonzero(total > width)  # only groups that still have runs to merge
            block = local[live] // (2 * width) * (2 * width)
            right = local[live] - block >= width
            other = np.where(right, block, np.minimum(block + width, total[live]))
            stop = np.where(right, block + width, np.minimum(block + 2 * width, total[live]))
            lo, hi = other.copy(), stop.copy()
            mine = place[order[live]]
            while True:
                open_ = np.flatnonzero(lo < hi)
                if not len(open_):
                    break
                mid = (lo[open_] + hi[open_]) // 2
                that = place[order[base[live[open_]] + mid]]
                # members of the left run go before equal ones of the right run
                before = self.less(that, mine[open_], right[open_])
                lo[open_] = np.where(before, mid + 1, lo[open_])
                hi[open_] = np.where(before, hi[open_], mid)
            to = base[live] + block + (local[live] - block - np.where(right, width, 0)) + (lo - other)
            moved = order.copy()
            moved[to] = order[live]
            order = moved
            width *= 2
        return order


def smallest_ids(buf: np.ndarray, piece_start: np.ndarray, windows: np.ndarray, group: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """For each window of each piece, in order, the smallest id among all equal windows of its group."""
    n = int(windows.sum())
    at = np.cumsum(windows) - windows
    place = np.arange(n) + np.repeat(piece_start - at, windows)
    group, own = np.repeat(group, windows), np.repeat(ids, windows)
    s = Suffixes(buf, length)
    order = s.sort(place, group)
    p, g = place[order], group[order]
    same = (g[1:] == g[:-1]) & (s.common(p[1:], p[:-1]) >= length)
    if not s.equal_bytes(p[1:][same], p[:-1][same]).all():
        # A collision of hashes: sort these strings by their bytes instead.
        raw = np.lib.stride_tricks.sliding_window_view(buf, length)[place]
        order = np.lexsort((*raw.T[::-1], group))
        g = group[order]
        same = (g[1:] == g[:-1]) & (raw[order][1:] == raw[order][:-1]).all(1)
    first = np.flatnonzero(np.append(True, ~same))
    least = np.minimum.reduceat(own[order], first)
    out = np.empty(n, np.int64)
    out[order] = np.repeat(least, np.diff(np.append(first, n)))
    return out


def _same_bytes(buf: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray, rows: int = 10_000) -> bool:
    """Whether the pieces at a and b agree, a few at a time."""
    parts = (slice(lo, lo + rows) for lo in range(0, len(a), rows))
    return all(np.array_equal(gathered(buf, a[p], size[p]), gathered(buf, b[p], size[p])) for p in parts)


def _answers(group: np.ndarray, key: np.ndarray, low: np.ndarray, high: np.ndarray, windows: np.ndarray, content: np.ndarray, length: int) -> tuple[np.ndarray, ...] | None:
    """(key, first, size, ids): for each run that some larger id must drop, its windows' smallest ids. None if two different runs have one key."""
    size = windows + length - 1
    start = np.cumsum(size) - size
    order = np.lexsort((low, key, group))
    g, k = group[order], key[order]
    new = np.append(True, (g[1:] != g[:-1]) | (k[1:] != k[:-1]))
    first = np.flatnonzero(new)
    head = order[first]  # of each distinct run, the copy with the smallest id
    low_, high_ = np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)
    copies = order[~new]
    of = head[np.cumsum(new) - 1][~new]
    if (size[copies] != size[of]).any() or not _same_bytes(content, start[copies], start[of], size[copies]):
        return None
    if len(np.unique(key[head])) < len(head):  # of different groups, so of different bytes
        return None
    g = group[head]
    alone = np.ones(len(g), bool)
    alone[1:] &= g[1:] != g[:-1]
    alone[:-1] &= g[1:] != g[:-1]
    keys, sizes, ids = [key[head][alone & (low_ < high_)]], [windows[head][alone & (low_ < high_)]], [np.repeat(low_[alone & (low_ < high_)], windows[head][alone & (low_ < high_)])]
    many = np.flatnonzero(~alone)
    edge = np.append(True, g[many][1:] != g[many][:-1]) if len(many) else np.zeros(0, bool)
    bounds = np.append(np.flatnonzero(edge), len(many))
    upto = np.append(0, np.cumsum(size[head[many]]))
    lo = 0
    while lo < len(bounds) - 1:  # whole groups, about a MB at a time
        hi = lo + 1
        while hi < len(bounds) - 1 and upto[bounds[hi + 1]] - upto[bounds[lo]] <= 1 << 20:
            hi += 1
        own = many[bounds[lo] : bounds[hi]]
        part, w = gathered(content, start[head[own]], size[head[own]]), windows[head[own]]
        at = np.cumsum(size[head[own]]) - size[head[own]]
        least = smallest_ids(part, at, w, g[own], low_[own], length)
        # A run matters if a document that holds it has a larger id than one of its windows' smallest.
        drop = np.minimum.reduceat(least, np.cumsum(w) - w) < high_[own]
        keys.append(key[head[own]][drop])
        sizes.append(w[drop])
        ids.append(least[np.repeat(drop, w)])
        lo = hi
    key, size, ids = np.concatenate(keys), np.concatenate(sizes), np.concatenate(ids)
    order = np.argsort(key, kind="stable")
    ids = gathered(ids, (np.cumsum(size) - size)[order], size[order])
    size = size[order]
    return key[order], np.cumsum(size) - size, size, ids


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False)


def shared_anchors(docs: DataFrame, buckets: int, length: int = LENGTH) -> Arrays:
    """Scan 1: the anchors that occur in more than one document, with their numbers of occurrences."""
    folder = shared_folder(docs.sparkSession, "anchors")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            a = np.sort(np.concatenate(held))
            first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
            n, a = np.diff(np.append(first, len(a))), a[first]
            rows = [(b, pack48(a[lo:hi]), n[lo:hi].astype("<u4").tobytes()) for b, lo, hi in ranges(bucket48(a, buckets))]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "anchor", "n"])

        for batch in batches:
            buf, offs = utf8(batch.column(0))
            for lo, hi in segments(offs):
                _, _, anchor, row = runs(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], length)
                order = np.lexsort((row, anchor))  # an anchor counts once in a document
                a, r = anchor[order], row[order]
                new = np.append(True, (a[1:] != a[:-1]) | (r[1:] != r[:-1])) if len(a) else np.zeros(0, bool)
                held.append(a[new])
                size += len(held[-1])
                if size >= HELD_RUNS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def merge(got: pa.Table) -> pa.Table:
        a = np.concatenate([unpack48(x) for x in got.column("anchor").to_pylist()])
        n = np.concatenate([np.frombuffer(x, "<u4") for x in got.column("n").to_pylist()]).astype(np.int64)
        order = np.argsort(a, kind="stable")
        a, n = a[order], n[order]
        first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        a, n = a[first], np.add.reduceat(n, first)
        bucket = got.column("bucket")[0].as_py()
        save(folder, str(bucket), key=a[n > 1], count=smallest(n[n > 1]))
        return pa.table([pa.array([bucket])], names=["n"])

    packed = docs.where(F.col("doc_id").isNotNull()).select(F.col("text").cast("string")).mapInArrow(gather, "bucket int, anchor binary, n binary")
    return Arrays(folder, buckets, told(by_bucket(packed, buckets, merge, "n long"))[0])


def packed_runs(group: np.ndarray, low: np.ndarray, high: np.ndarray, windows: np.ndarray) -> bytes:
    """Runs with ascending groups, compressed: groups as differences, all as planes of bytes."""
    columns = [np.diff(group, prepend=np.uint64(0)), low.astype(np.uint64), (high - low).astype(np.uint64)]
    planes = [x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for x in columns]
    return pa.compress(b"".join([*planes, windows.astype(np.uint8).tobytes()]), "zstd", asbytes=True)


def unpacked_runs(data: bytes, n: int) -> tuple[np.ndarray, ...]:
    raw = np.frombuffer(pa.decompress(data, 25 * n, "zstd", asbytes=True), np.uint8)
    group, low, more = (raw[8 * n * k : 8 * n * (k + 1)].reshape(8, n).T.copy().view("<u8").ravel() for k in range(3))
    low = low.astype(np.int64)
    return np.cumsum(group, dtype=np.uint64), low, low + more.astype(np.int64), raw[24 * n :].astype(np.int64)


def window_ids(docs: DataFrame, known: Arrays, length: int = LENGTH, common: int = COMMON, seed: int = 0) -> Arrays | None:
    """Scan 2: for the runs that some document must drop, the smallest ids of their windows. None if two different runs have one hash."""
    buckets, folder = known.buckets, shared_folder(docs.sparkSession, "windows")
    schema = "bucket int, n long, runs binary, content binary"

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            n, group, key, low, high = (np.concatenate([h[k] for h in held]) for k in range(5))
            content = np.concatenate([h[5] for h in held])
            whole = n + length - 1
            start = np.cumsum(whole) - whole
            order = np.lexsort((key, group))
            first = np.flatnonzero(np.append(True, (key[order][1:] != key[order][:-1]) | (group[order][1:] != group[order][:-1])))
            low, high, own = np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first), order[first]
            rows = []
            for b, lo, hi in ranges(bucket48(group[own], buckets)):
                o = own[lo:hi]
                parts = [gathered(content, start[q], whole[q]).tobytes() for q in np.array_split(o, 1 + len(o) // 10_000)]
                rows.append((b, len(o), packed_runs(group[o], low[lo:hi], high[lo:hi], n[o]), pa.compress(b"".join(parts), "zstd", asbytes=True)))
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in schema.split(", ")])

        for batch in batches:
            ids = _ids(batch.column(0))
            buf_all, offs_all = utf8(batch.column(1))
            for lo, hi in segments(offs_all):
                buf, offs = buf_all[offs_all[lo] : offs_all[hi]], offs_all[lo : hi + 1] - offs_all[lo]
                sums = prefix_hashes(byte_values(seed)[buf])
                start, n, group, key, row = shared_runs(buf, offs, known, sums, length, common)
                if not len(start):
                    continue
                # Copies within the segment meet here already; their bytes are kept once.
                order = np.lexsort((key, group))
                new = np.append(True, (key[order][1:] != key[order][:-1]) | (group[order][1:] != group[order][:-1]))
                first, id_ = np.flatnonzero(new), ids[lo + row]
                low, high, own = np.minimum.reduceat(id_[order], first), np.maximum.reduceat(id_[order], first), order[first]
                held.append((n[own], group[own], key[own], low, high, gathered(buf, start[own], n[own] + length - 1)))
                size += len(held[-1][5]) + 40 * len(own)
                if size >= HELD_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def merge(got: pa.Table) -> pa.Table:
        bucket = got.column("bucket")[0].as_py()
        parts, contents = [], []
        for n, runs_, data in zip(*(got.column(c).to_pylist() for c in ("n", "runs", "content"))):
            parts.append(unpacked_runs(runs_, n))
            contents.append(np.frombuffer(pa.decompress(data, int((parts[-1][3] + length - 1).sum()), "zstd", asbytes=True), np.uint8))
        content = np.concatenate(contents)
        del contents
        group, low, high, windows = (np.concatenate(x) for x in zip(*parts))
        size = windows + length - 1
        answers = _answers(group, run_keys(content, size, seed), low, high, windows, content, length)
        if answers is None:
            return pa.table([pa.array([None], pa.int64())], names=["n"])
        key, first, size, ids = answers
        # Runs with one smallest id for all windows keep it once.
        some = len(size) > 0
        least = np.minimum.reduceat(ids, first) if some else ids
        one = least == np.maximum.reduceat(ids, first) if some else np.zeros(0, bool)
        kept = np.where(one, 1, size)
        at = np.cumsum(kept) - kept
        flat = gathered(ids, first, kept)
        save(folder, str(bucket), key=key, first=smallest(at), one=one, ids=flat)
        return pa.table([pa.array([bucket])], names=["n"])

    own = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    done, sums = told(by_bucket(own.mapInArrow(gather, schema), buckets, merge, "n long"), clashes=F.col("n").isNull().cast("int"))
    return None if sums["clashes"] else Arrays(folder, buckets, done)


@dataclass
class Repeats:
    """What the first two scans found, and how they were made."""

    known: Arrays
    answers: Arrays
    length: int
    common: int
    seed: int


def repeats(docs: DataFrame, length: int = LENGTH, common: int = COMMON) -> Repeats:
    """Scans 1 and 2, the second anew with another seed where two different runs have one hash."""
    known = shared_anchors(docs, bucket_count(docs), length)
    for seed in range(SEEDS):
        answers = window_ids(docs, known, length, common, seed)
        if answers is not None:
            return Repeats(known, answers, length, common, seed)
    raise ValueError(f"two different runs have one hash under each of {SEEDS} seeds")


def removed(buf: np.ndarray, offs: np.ndarray, ids: np.ndarray, found: Repeats) -> np.ndarray:
    """Which bytes of the rows go."""
    length, answers = found.length, found.answers
    mark = np.zeros(len(buf) + 1, np.int32)
    sums = prefix_hashes(byte_values(found.seed)[buf])
    start, n, group, key, row = shared_runs(buf, offs, found.known, sums, length, found.common)
    own = ids[row] != NO_ID
    start, n, group, key, row = start[own], n[own], group[own], key[own], row[own]
    order = np.lexsort((key, bucket48(group, answers.buckets)))
    for b, lo, hi in ranges(bucket48(group[order], answers.buckets)):
        held = answers.columns(b)
        if not held or not len(held["key"]):
            continue
        keys = held["key"]
        o = order[lo:hi]
        at = np.searchsorted(keys, key[o])
        at[at == len(keys)] = 0
        hit = keys[at] == key[o]
        o, at = o[hit], at[hit]
        size, first, one = n[o], held["first"][at].astype(np.int64), held["one"][at]
        inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        least = held["ids"][np.repeat(first, size) + np.where(np.repeat(one, size), 0, inner)]
        gone = (np.repeat(start[o], size) + inner)[least < np.repeat(ids[row[o]], size)]
        np.add.at(mark, gone, 1)
        np.add.at(mark, gone + length, -1)
    return np.cumsum(mark[:-1]) > 0


def _apply(docs: DataFrame, columns: list[Column], schema: StructType | str, make, length: int, common: int) -> DataFrame:
    """Scan 3: make(batch, rows, buffer, offsets, removed) of every document's bytes; ids and texts are the first columns."""
    found = repeats(docs, length, common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch.column(0))
            buf, offs = utf8(batch.column(1))
            for lo, hi in segments(offs):
                own, o = buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
                yield make(batch.slice(lo, hi - lo), own, o, removed(own, o, ids[lo:hi], found))

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *columns)
    return own.mapInArrow(run, schema)


def repeated_bytes(docs: DataFrame, length: int = LENGTH, common: int = COMMON) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every document."""

    def make(batch: pa.RecordBatch, buf: np.ndarray, offs: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
        before = np.append(0, np.cumsum(gone))
        starts = gone.copy()
        starts[1:] &= ~gone[:-1]
        starts[offs[:-1][offs[:-1] < len(gone)]] = gone[offs[:-1][offs[:-1] < len(gone)]]
        spans = np.append(0, np.cumsum(starts))
        sha = []
        for a, b in zip(offs[:-1], offs[1:]):
            own = buf[a:b]
            sha.append(hashlib.sha256(own[~gone[a:b]].tobytes() if before[b] > before[a] else own.tobytes()).hexdigest())
        count = lambda x: pa.array(x[offs[1:]] - x[offs[:-1]], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offs), pa.int64()), count(before), count(spans), pa.array(sha)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _apply(docs, [], "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", make, length, common)


def without_repeats(docs: DataFrame, length: int = LENGTH, common: int = COMMON) -> DataFrame:
    """The documents with their repeated bytes removed from the text; bytes of cut characters go too."""
    names = docs.columns
    rest = [n for n in names if n not in ("doc_id", "text")]
    places = [f"c{k}" for k in range(len(rest))]  # columns go by their place, as mapInArrow does not take every name

    def make(batch: pa.RecordBatch, buf: np.ndarray, offs: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
        nulls = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        texts = [None if null else buf[a:b][~gone[a:b]].tobytes().decode("utf-8", "ignore") for a, b, null in zip(offs[:-1], offs[1:], nulls)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), *batch.columns[2:]], names=["doc_id", "text", *places])

    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), *(StructField(c, docs.schema[n].dataType) for c, n in zip(places, rest))])
    out = _apply(docs, [named(n).alias(c) for c, n in zip(places, rest)], schema, make, length, common).toDF("doc_id", "text", *rest)
    return out.select(*(named(n) for n in names))


ORACLE_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
data AS MATERIALIZED (SELECT doc_id, b, CAST(octet_length(b) AS BIGINT) AS n_bytes FROM d),
windows AS MATERIALIZED (
  SELECT doc_id, i, md5_number(array_slice(b, i, i + 49)) AS w
  FROM (SELECT doc_id, b, unnest(range(1, n_bytes - 48)) AS i FROM data WHERE n_bytes >= 50)
), firsts AS MATERIALIZED (SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
gone AS MATERIALIZED (SELECT doc_id, i FROM windows JOIN firsts USING (w) WHERE first_id < doc_id),
marked AS (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS opens FROM gone),
spans AS MATERIALIZED (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS z FROM (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked) GROUP BY doc_id, run),
kept AS (
  SELECT doc_id, hex(array_slice(b, z0, a - 1)) AS part, z0, 0 AS last FROM (
    SELECT s.doc_id, b, a, coalesce(lag(z) OVER (PARTITION BY s.doc_id ORDER BY a), 1) AS z0 FROM spans s JOIN data USING (doc_id))
  UNION ALL
  SELECT doc_id, hex(array_slice(b, z, n_bytes)), z, 1 FROM (SELECT doc_id, max(z) AS z FROM spans GROUP BY doc_id) JOIN data USING (doc_id)
), summary AS (SELECT doc_id, CAST(sum(z - a) AS BIGINT) AS n_removed, CAST(count(*) AS BIGINT) AS n_spans FROM spans GROUP BY doc_id),
rest AS (SELECT doc_id, string_agg(part, '' ORDER BY z0, last) AS h FROM kept GROUP BY doc_id)
SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(coalesce(unhex(rest.h), data.b)) AS kept_sha256
FROM data LEFT JOIN summary USING (doc_id) LEFT JOIN rest USING (doc_id)
"""
