"""Interpolated modified Kneser-Ney n-gram model, counted in Spark and memory-mapped by workers.

Words are 64-bit hashes with a second hash of 32 bits beside them; where two words meet in one hash but
not in the other, counting begins anew with other byte values. The steps, for a model of order N:

1. Words are counted and numbered, frequent ones first (by powers of two of their count, then by hash).
2. Tasks count the N-grams of their training documents as word numbers and pack them, sorted and compressed,
   by hash bucket of all words but the last; one task per bucket merges the counts and writes them as a
   table of 64-bit keys, and what they say of each context (total, and how many words follow it once, twice
   or more often) as another.
3. Each merged N-gram hands its last N-1 words on: how many different words precede these. That is the input of
   the same step one order below, down to pairs, whose contexts and last words are summed by word number.
4. Scoring maps the tables and looks up the keys of the documents' n-grams.

    p(w | u v) = max(c(u v w) - D(c), 0) / c(u v .) + g(u v) p(w | v), with continuation counts below the top
    p(w)       = max(n(w) - D'(n), 0) / sum of n + g' / (V + 1),   n(w): distinct words before w

Discounts D for counts 1, 2 and 3 or more come from each order's counts of counts. The mass over known words and
one unknown word is 1. N-grams that begin at a document's start keep their own counts at every order, since
only the start precedes them. Pairs whose first word makes up more than a bucket's share of all tokens are
dealt by both words, so no frequent word gathers in one task. Only bucket lists, totals and counts of
counts reach the driver; word numbers are summed in ranges of CHUNK.

Defined cases: a null text is empty, with one token, its end; null ids are kept and repeated rows
count each time; without training documents every probability is 1; an empty table gives an
empty result; further columns are ignored. Keys of n-grams are hashes of word numbers, of which a table
keeps 40 bits besides the leading ones that its index takes; words, and so the columns that count them, are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_values, fold, gathered, mix, piece_hashes, segments, shared_folder, utf8, word_bounds, written
from .hash_arrays import BUCKET_BYTES, Arrays, bucket64, bucket_count, by_bucket, ranges, save, smallest, table_columns, table_values, told

FOLDS, HELD_OUT = 7, 2
#: The order of the registered query.
ORDER = 3
#: Tokens that a task gathers before it sorts and packs them, and scores at a time.
TOKENS = 2_000_000
#: Word numbers in one range.
CHUNK = 4_000_000
#: Buckets whose words' bases lie in one file.
BASE_BLOCK = 4_096
END = np.uint64(0x5D2C_91E4_A703_77B1)
START, UNKNOWN = 0, 0xFFFFFFFF
SEEDS = 4
_STEP = np.uint64(0x9FB21C651E98DF25)
_PACKED = "bucket int, kind int, n long, data binary"
GRAMS, CONTEXTS, CONTINUED, COUNTS = 0, 1, 2, 3


def tokens(texts: pa.Array, seed: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, words, checks, places, offsets) for runs of rows: the distinct words in ascending order, their second
    hashes, the place of each token's word among them, and len+1 offsets of the rows' tokens. Each row's last token is its end."""
    buf, offs = utf8(texts)
    values, others = byte_values(seed, lower=True), byte_values(seed + SEEDS, lower=True)
    for lo, hi in segments(offs):
        own = buf[offs[lo] : offs[hi]]
        starts, ends, at = word_bounds(own, offs[lo : hi + 1] - offs[lo])
        h, rows = piece_hashes(own, starts, ends, values), hi - lo
        owner = np.repeat(np.arange(rows), np.diff(at))
        all_ = np.full(len(h) + rows, END, np.uint64)
        all_[np.arange(len(h)) + owner] = h
        words, first, places = np.unique(all_, return_index=True, return_inverse=True)
        offsets = at + np.arange(rows + 1)
        real = np.flatnonzero(words != END)
        w = first[real] - (np.searchsorted(offsets, first[real], "right") - 1)
        size = ends[w] - starts[w]
        stop = np.cumsum(size)
        checks = np.zeros(len(words), np.uint32)
        checks[real] = piece_hashes(gathered(own, starts[w], size), stop - size, stop, others) >> np.uint64(32)
        yield lo, words, checks, places, offsets


def packed(columns: list[np.ndarray], *values: np.ndarray) -> bytes:
    """Ascending rows of word numbers and whole numbers beside them: the first column as differences, all as planes of bytes, compressed."""
    first = np.diff(columns[0], prepend=columns[0].dtype.type(0))
    planes = [x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for x in (first, *columns[1:])]
    planes += [x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for x in values]
    return pa.compress(b"".join(planes), "zstd", asbytes=True)


def unpacked(data: bytes, n: int, width: int, values: int = 1) -> list[np.ndarray]:
    """The columns of word numbers and those of values."""
    raw = np.frombuffer(pa.decompress(data, n * (4 * width + 8 * values), "zstd", asbytes=True), np.uint8)
    columns = [raw[4 * n * k : 4 * n * (k + 1)].reshape(4, n).T.copy().view("<u4").ravel() for k in range(width)]
    columns[0] = np.cumsum(columns[0], dtype=np.uint32)
    rest = raw[4 * n * width :]
    return columns + [rest[8 * n * k : 8 * n * (k + 1)].reshape(8, n).T.copy().view("<u8").ravel().astype(np.int64) for k in range(values)]


def combined(columns: list[np.ndarray], counts: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows in ascending order and the sums of their counts (each 1 if not given)."""
    pairs = [columns[k].astype(np.uint64) << np.uint64(32) | columns[k + 1] for k in range(0, len(columns) - 1, 2)]
    keys = [*pairs, *columns[2 * len(pairs) :]]
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    first = np.flatnonzero(new)
    sums = np.diff(np.append(first, len(order))) if counts is None else np.add.reduceat(counts[order], first) if len(first) else np.zeros(0, np.int64)
    return [c[order][first] for c in columns], sums


def gram_key(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit key of each row of word numbers; of a single word or a pair without clashes."""
    h = columns[0].astype(np.uint64)
    if len(columns) > 1:
        h = h << np.uint64(32) | columns[1]
    h = mix(h + np.uint64(len(columns) * int(_STEP) % (1 << 64)))
    for c in columns[2:]:
        h = mix(h * _STEP + c)
    return h


def dealt(columns: list[np.ndarray], buckets: int, frequent: int) -> np.ndarray:
    """The bucket of each row: by all words but the last, for pairs with a frequent first word by both."""
    h = gram_key(columns[:-1])
    if len(columns) == 2:
        h = np.where(columns[0] < frequent, gram_key(columns), h)
    return bucket64(mix(h ^ _STEP), buckets)


def context_bucket(columns: list[np.ndarray], buckets: int) -> np.ndarray:
    """The bucket of contexts of two words or more."""
    return bucket64(mix(gram_key(columns) ^ _STEP), buckets)


def counts_of_counts(c: np.ndarray) -> np.ndarray:
    return np.array([(c == k).sum() for k in (1, 2, 3, 4)], np.int64)


def discounts(n: np.ndarray) -> np.ndarray:
    """Discounts for counts 1, 2 and 3 or more from the numbers of things that occur 1 to 4 times."""
    n1, n2, n3, n4 = (float(x) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)])


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Counts less their discounts; 0 stays 0."""
    return np.maximum(c - np.where(c > 0, d[np.clip(c, 1, 3) - 1], 0.0), 0)


def _rows(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows) if rows else ((),) * 4, kinds)], names=[c.split()[0] for c in _PACKED.split(", ")])


def gram_rows(columns: list[np.ndarray], counts: np.ndarray, buckets: int, frequent: int) -> list[tuple]:
    """A packed row for each bucket of ascending n-grams."""
    bucket = dealt(columns, buckets, frequent)
    order = np.argsort(smallest(bucket), kind="stable")
    return [(b, GRAMS, hi - lo, packed([c[order[lo:hi]] for c in columns], counts[order[lo:hi]])) for b, lo, hi in ranges(bucket[order])]


@dataclass
class Vocabulary:
    """The words' hashes by bucket; a word's number is its rank within bucket and power of two of its count, plus the base
    of these, which is stored (`bases`, a file for `block` buckets). `first` has the bases of bucket 0."""

    arrays: Arrays
    bases: Arrays
    block: int
    first: np.ndarray
    size: int
    tokens: int
    seed: int

    def numbers(self, words: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, count) of ascending words; UNKNOWN and 0 for those that are not known."""
        bucket = bucket64(words, self.arrays.buckets)
        there, check, count, rank = self.arrays.lookup(words, bucket, ("check", "count", "rank"))
        there &= check == checks
        base, bucket, p = np.zeros(len(words), np.int64), bucket.astype(np.int64), power(count)
        for block, lo, hi in ranges(bucket // self.block):
            own = self.bases.columns(block)
            if own:
                base[lo:hi] = own["base"].reshape(-1, 64)[bucket[lo:hi] - block * self.block, p[lo:hi]]
        number = np.where(there, base + rank, UNKNOWN)
        return number.astype(np.uint32), np.where(there, count, 0)


def power(count: np.ndarray) -> np.ndarray:
    """The power of two below a count."""
    return np.maximum(np.frexp(count.astype(float))[1] - 1, 0)


def vocabulary(docs: DataFrame, buckets: int) -> Vocabulary:
    """Step 1. Begins anew with another seed if two words have one hash."""
    for seed in range(SEEDS):
        found = _counted_words(docs, buckets, seed)
        if found:
            return found
    raise ValueError(f"two words have one hash under each of {SEEDS} seeds")


def _counted_words(docs: DataFrame, buckets: int, seed: int) -> Vocabulary | None:
    """The vocabulary, or none if two words have one hash."""
    folder = shared_folder(docs.sparkSession, "vocabulary")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            w, check, n = merged_words(*(np.concatenate(x) for x in zip(*held)))
            rows = [(b, w[lo:hi].tobytes(), check[lo:hi].tobytes(), n[lo:hi].tobytes()) for b, lo, hi in ranges(bucket64(w, buckets))]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 3))], names=["bucket", "word", "check", "n"])

        for batch in batches:
            for _, words, checks, places, _ in tokens(batch.column(0), seed):
                held.append((words, checks, np.bincount(places, minlength=len(words))))
                size += len(words)
                if size >= TOKENS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def merge(got: pa.Table) -> pa.Table:
        of = lambda c, kind: np.concatenate([np.frombuffer(x, kind) for x in got.column(c).to_pylist()])
        w, check, n = merged_words(of("word", "<u8"), of("check", "<u4"), of("n", "<i8"))
        p = power(n)
        order = np.argsort(p.astype(np.uint8), kind="stable")
        rank = np.empty(len(w), np.int64)
        rank[order] = np.arange(len(w)) - np.searchsorted(p[order], p[order])
        bucket = got.column("bucket")[0].as_py()
        save(folder, str(bucket), key=w, check=check, count=smallest(n), rank=smallest(rank))
        return pa.table([pa.array([x]) for x in (bucket, int((w[1:] == w[:-1]).sum()), int(n.sum()))] + [pa.array([np.bincount(p, minlength=64)])], names=["n", "clashes", "tokens", "sizes"])

    found = docs.select(F.col("text").cast("string")).mapInArrow(gather, "bucket int, word binary, check binary, n binary")
    merged = written(by_bucket(found, buckets, merge, "n long, clashes long, tokens long, sizes array<long>"), "sizes")
    done, sums = told(merged, clashes=F.col("clashes"), tokens=F.col("tokens"))
    if sums["clashes"]:
        return None
    bases, first, size = _bases(merged, buckets, BASE_BLOCK)
    return Vocabulary(Arrays(folder, buckets, done), bases, BASE_BLOCK, first, size, sums["tokens"], seed)


def _bases(merged: DataFrame, buckets: int, block: int) -> tuple[Arrays, np.ndarray, int]:
    """The numbers before the words of each bucket and power (the most frequent words first, then by bucket), stored; those of bucket 0; the number of words.

    Only sums of `block` buckets reach the driver; a task adds up those within a block.
    """
    blocks, folder = -(-buckets // block), shared_folder(merged.sparkSession, "bases")
    rows = merged.select(F.expr(f"cast(n div {block} as int)").alias("bucket"), "n", "sizes")
    sums = np.zeros((blocks, 64), np.int64)
    for r in rows.groupBy("bucket").agg(F.array(*(F.sum(F.get("sizes", F.lit(k))) for k in range(64))).alias("sums")).collect():
        sums[r["bucket"]] = r["sums"]
    flat = sums[:, ::-1].T.ravel()
    start = (1 + np.cumsum(flat) - flat).reshape(64, blocks).T[:, ::-1].copy()

    def store(got: pa.Table) -> pa.Table:
        own = got.column("bucket")[0].as_py()
        sizes = np.zeros((min(block, buckets - own * block), 64), np.int64)
        sizes[got.column("n").to_numpy() - own * block] = np.stack(got.column("sizes").to_numpy())
        save(folder, str(own), base=(start[own] + np.cumsum(sizes, 0) - sizes).ravel())
        return pa.table({"n": pa.array([own], pa.int64())})

    return Arrays(folder, blocks, told(by_bucket(rows, blocks, store, "n long"))[0]), start[0], int(sums.sum())


def merged_words(words: np.ndarray, checks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (word, check) in ascending order and the sums of their counts."""
    order = np.lexsort((checks, words))
    w, c = words[order], checks[order]
    first = np.flatnonzero(np.append(True, (w[1:] != w[:-1]) | (c[1:] != c[:-1]))) if len(w) else np.zeros(0, np.int64)
    return w[first], c[first], np.add.reduceat(counts[order], first) if len(first) else counts


def gram_columns(numbers: np.ndarray, offs: np.ndarray, order: int) -> list[np.ndarray]:
    """The word numbers of each token's n-gram, oldest first; START before the rows' starts."""
    columns = [numbers]
    for _ in range(order - 1):
        before = np.empty_like(numbers)
        before[1:] = columns[-1][:-1]
        before[offs[:-1]] = START
        columns.append(before)
    return columns[::-1]


@dataclass
class Model:
    """Where the tables are, the totals and the discounts."""

    order: int
    words: Vocabulary
    grams: dict[int, Arrays]
    contexts: dict[int, Arrays]
    chunks: Arrays
    frequent: int
    continuations: int
    discounts: dict[int, np.ndarray]
    spread: float

    def dense(self, numbers: np.ndarray) -> list[np.ndarray]:
        """What is summed of each word number: (total, followers once, twice, more often, words before)."""
        out = [np.zeros(len(numbers), np.int64) for _ in range(5)]
        chunk = (numbers // CHUNK).astype(np.int64)
        chunk[numbers == UNKNOWN] = -1
        for c in np.unique(chunk):
            own = self.chunks.columns(int(c))
            if own:
                rows = np.flatnonzero(chunk == c)
                at = numbers[rows].astype(np.int64) - c * CHUNK
                for x, name in zip(out, ("total", "n1", "n2", "n3", "before")):
                    x[rows] = own[name][at]
        return out

    def log10(self, columns: list[np.ndarray]) -> np.ndarray:
        """log10 p(last word | the words before it) for n-grams of word numbers."""
        total, n1, n2, n3, before = self.dense(np.concatenate(columns[-2:]))
        k = len(columns[0])
        p = discounted(before[k:], self.discounts[1]) / max(self.continuations, 1) + self.spread / (self.words.size + 1)
        follow = [x[:k] for x in (total, n1, n2, n3)]
        for n in range(2, self.order + 1):
            own = columns[self.order - n :]
            if n > 2:
                follow = table_values(self.contexts[n - 1], gram_key(own[:-1]), context_bucket(own[:-1], self.contexts[n - 1].buckets), (1, 1, 0, 0))
            (count,) = table_values(self.grams[n], gram_key(own), dealt(own, self.grams[n].buckets, self.frequent), (1,))
            d = self.discounts[n]
            all_, kept = follow[0], d[0] * follow[1] + d[1] * follow[2] + d[2] * follow[3]
            some = np.maximum(all_, 1)
            p = discounted(count, d) / some + np.where(all_ > 0, kept / some, 1.0) * p
        return np.log10(p)


def _merge(k: int, buckets: int, frequent: int, gram_folder: str, context_folder: str):
    """Step 2 and 3 for the n-grams of k words of one bucket."""

    def run(got: pa.Table) -> pa.Table:
        bucket = got.column("bucket")[0].as_py()
        parts, out = [], []
        for kind, n, data in zip(*(got.column(c).to_pylist() for c in ("kind", "n", "data"))):
            if kind == COUNTS:
                out.append((0, COUNTS, n, data))
            else:
                parts.append(unpacked(data, n, k))
        if not parts:
            return _rows(out)
        *columns, c = (np.concatenate(x) for x in zip(*parts))
        del parts
        columns, c = combined(columns, c)
        save(gram_folder, str(bucket), **table_columns(gram_key(columns), [c], (1,)))
        out.append((0, COUNTS, k, np.append(counts_of_counts(c), bucket).tobytes()))
        new = np.ones(len(c), bool)
        new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in columns[:-1]])
        first = np.flatnonzero(new)
        follow = [np.add.reduceat(x, first) for x in (c, *((c == j).astype(np.int64) for j in (1, 2)), (c >= 3).astype(np.int64))]
        context = [x[first] for x in columns[:-1]]
        if k > 2:
            save(context_folder, str(bucket), **table_columns(gram_key(context), follow, (1, 1, 0, 0)))
            # Words after a document's start keep their counts: nothing else precedes them.
            rest, n = combined(columns[1:], np.where(columns[1] == START, c, 1))
            return _rows([*out, *gram_rows(rest, n, buckets, frequent)])
        last, n = np.unique(columns[-1], return_counts=True)
        for kind, numbers, values in ((CONTEXTS, context[0], follow), (CONTINUED, last, [n])):
            out += [(chunk, kind, hi - lo, packed([numbers[lo:hi]], *(v[lo:hi] for v in values))) for chunk, lo, hi in ranges(numbers // CHUNK)]
        return _rows(out)

    return run


def _merge_words(folder: str):
    """The end of step 3: sums by word number, in a range of these."""

    def run(got: pa.Table) -> pa.Table:
        chunk, out = got.column("bucket")[0].as_py(), []
        sums = np.zeros((5, CHUNK), np.int64)
        for kind, n, data in zip(*(got.column(c).to_pylist() for c in ("kind", "n", "data"))):
            if kind == COUNTS:
                out.append([COUNTS, n, *np.frombuffer(data, np.int64)])
            else:
                own = slice(0, 4) if kind == CONTEXTS else slice(4, 5)
                numbers, *values = unpacked(data, n, 1, own.stop - own.start)
                for x, v in zip(sums[own], values):
                    np.add.at(x, numbers.astype(np.int64) - chunk * CHUNK, v)
        before = sums[4]
        if sums.any():
            size = int(np.flatnonzero(sums.any(0))[-1]) + 1
            save(folder, str(chunk), **{name: smallest(x[:size]) for name, x in zip(("total", "n1", "n2", "n3", "before"), sums)})
            out.append([CONTINUED, chunk, *counts_of_counts(before), (before >= 3).sum(), before.sum()])
        return pa.table([pa.array(out, pa.list_(pa.int64()))], names=["told"])

    return run


def train(docs: DataFrame, order: int = 2, bucket_bytes: int = BUCKET_BYTES) -> Model:
    """Counts the n-grams of up to `order` words (2 at least) of all given documents (column `text`)."""
    spark = docs.sparkSession
    buckets = bucket_count(docs, bucket_bytes)
    words = vocabulary(docs, buckets)
    share = max(words.tokens // buckets, 1)
    frequent = int(words.first[max(share.bit_length() - 2, 0)])  # words from this number on are below a bucket's share
    folders = {n: shared_folder(spark, f"{n}-grams") for n in range(2, order + 1)}
    contexts = {n: shared_folder(spark, f"{n}-contexts") for n in range(1, order)}

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in runs_of_tokens(batches, 0, words.seed, TOKENS):
            numbers, _, offs = joined(held, words)
            grams, counts = combined(gram_columns(numbers, offs, order), None)
            yield from _rows(gram_rows(grams, counts, buckets, frequent)).to_batches()

    found = docs.select(F.col("text").cast("string")).mapInArrow(gather, _PACKED)
    for n in range(order, 1, -1):
        found = by_bucket(found, buckets, _merge(n, buckets, frequent, folders[n], contexts[n - 1]), _PACKED)
    dense = shared_folder(spark, "words")
    ends = written(by_bucket(found, words.size // CHUNK + 1, _merge_words(dense), "told array<long>"), "counted")
    ends, t = ends.select(*(F.get("told", F.lit(k)).alias(f"t{k}") for k in range(8))), {f"t{k}": F.col(f"t{k}") for k in range(8)}
    own = {n: told(ends.where((t["t0"] == COUNTS) & (t["t1"] == n)), "t6", **{k: t[k] for k in ("t2", "t3", "t4", "t5")}) for n in folders}
    d = {n: discounts(np.array(list(sums.values()), np.int64)) for n, (_, sums) in own.items()}
    chunks, sums = told(ends.where(t["t0"] == CONTINUED), "t1", **{f"t{k}": t[f"t{k}"] for k in range(2, 8)})
    n = np.array(list(sums.values()), np.int64)
    d[1] = discounts(n[:4])
    spread = float(d[1] @ [n[0], n[1], n[4]] / n[5]) if n[5] else 1.0
    arrays = {n: Arrays(folders[n], buckets, done) for n, (done, _) in own.items()}
    around = {n - 1: Arrays(contexts[n - 1], buckets, arrays[n].written) for n in folders if n > 2}
    return Model(order, words, arrays, around, Arrays(dense, 0, chunks), frequent, int(n[5]), d, spread)


def runs_of_tokens(batches: Iterator[pa.RecordBatch], column: int, seed: int, most: int) -> Iterator[list[tuple]]:
    """What tokens() gives of the batches, as lists of about `most` tokens; each entry begins with its batch."""
    held, size = [], 0
    for batch in batches:
        for lo, *rest in tokens(batch.column(column), seed):
            held.append((batch, lo, *rest))
            size += len(rest[2])
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def joined(held: list[tuple], words: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word numbers, the words' training counts, offsets) of the tokens of some runs of rows."""
    every, checks = np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held])
    order = np.lexsort((checks, every))
    w, c = every[order], checks[order]
    new = np.append(True, (w[1:] != w[:-1]) | (c[1:] != c[:-1]))
    number, count = words.numbers(w[new], c[new])
    at = np.empty(len(every), np.int64)
    at[order] = np.cumsum(new) - 1
    begin = np.cumsum([0, *(len(h[2]) for h in held)])
    places = np.concatenate([at[b + h[4]] for b, h in zip(begin, held)])
    sizes = np.concatenate([np.diff(h[5]) for h in held])
    return number[places], count[places], np.append(0, np.cumsum(sizes))


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Scores every document; see SCORED for the columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = np.log10(model.words.tokens + model.words.size + 1)
        for held in runs_of_tokens(batches, 2, model.words.seed, TOKENS // 2):
            numbers, count, offs = joined(held, model.words)
            logs = model.log10(gram_columns(numbers, offs, model.order))
            sizes = np.diff(offs)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            add = lambda x: np.bincount(owner, x, len(sizes))
            rows = pa.Table.from_batches([h[0].slice(h[1], len(h[5]) - 1).select([0, 1]) for h in held])
            columns = [
                *rows.columns, pa.array(sizes, pa.int64()), pa.array(add(count > 0).astype(np.int64)), pa.array(np.full(len(sizes), model.words.tokens, np.int64)),
                pa.array(add(np.log10(count + 1) - floor)), pa.array(add(logs)),
            ]
            yield from pa.table(columns, names=[c.split()[0] for c in SCORED.split(", ")]).to_batches()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, SCORED)


def perplexities(docs: DataFrame, order: int = 2) -> DataFrame:
    """Trains on the documents that are not held out and scores all."""
    return score(docs, train(docs.where(fold("doc_id", FOLDS) != HELD_OUT), order))
