"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Bounded-space online best-fit: each task keeps at most `open_bins` bins, in a bitset keyed
by free space. A piece goes to the open bin with the least free space that holds it; when one bin
too many is open, the fullest closes. Pieces arrive in runs of `run` pieces, longest first.

Defined cases: a null text counts as empty (one end id); null ids, ties and repeated rows are
packed as rows of their own; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

CAPACITY = 2048
END_ID = 0
OPEN_BINS = 4096
RUN = 4096
#: Pieces that one task packs; the number of tasks follows from the number of pieces.
PIECES_PER_TASK = 40_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(ranks_file: str = "byte_bpe_50k.tiktoken") -> tiktoken.Encoding:
    """The vocabulary of byte_bpe_50k.json as ranks: the same ids (tested), several times as fast."""
    if ranks_file not in _encodings:
        with open(public_tokenizers.path(ranks_file), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[ranks_file] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})
    return _encodings[ranks_file]


@functools.lru_cache(maxsize=1)
def tokenizer(file: str = "byte_bpe_50k.json") -> tokenizers.Tokenizer:
    """The vocabulary itself, for the texts that the ranks cannot encode."""
    return tokenizers.Tokenizer.from_file(public_tokenizers.path(file))


def token_ids(text: str | None) -> np.ndarray:
    """The ids of a text and the end id, as unsigned 32-bit little-endian numbers."""
    try:
        ids = encoding().encode_to_numpy(text, allowed_special="all") if text else np.zeros(0, np.uint32)
    except ValueError:  # its pattern gives up on a run of about a million spaces
        ids = np.array(tokenizer().encode(text, add_special_tokens=False).ids, np.uint32)
    return np.append(ids, END_ID).astype("<u4")


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole capacities, of which only the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """A row for each piece of each document; with_ids adds the ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rows: list[list] = [[] for _ in range(6)]
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = token_ids(text)
                    for k, (s, n) in enumerate(cuts(len(ids), capacity)):
                        own = ids[s : s + n]
                        for to, x in zip(rows, (doc_id, k, s, n, zlib.crc32(own.tobytes()), own.tolist() if with_ids else None)):
                            to.append(x)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                k = 6 if with_ids else 5
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows[:k], kinds)], names=names[:k])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES + ", ids array<long>" * with_ids)


class OpenBins:
    """At most `most` open bins, found by free space through a bitset."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.count, self.made = capacity, most, 0, 0
        self.bits = 0  # bit f is set if a bin with free space f is open
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, length: int) -> tuple[int, int]:
        """The bin and the offset in it for a piece of this length."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_ = self.by_free[free].pop()
            self.count -= 1
            if not self.by_free[free]:
                self.bits ^= 1 << free
        else:
            free, bin_ = self.capacity, self.made
            self.made += 1
        rest = free - length
        if rest:
            self.by_free[rest].append(bin_)
            self.bits |= 1 << rest
            self.count += 1
            if self.count > self.most:
                fullest = (self.bits & -self.bits).bit_length() - 1
                self.by_free[fullest].pop()
                self.count -= 1
                if not self.by_free[fullest]:
                    self.bits ^= 1 << fullest
        return bin_, self.capacity - free


def pack(found: DataFrame, n_pieces: int, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces with a `length` of 1 to `capacity`."""
    tasks = max(1, -(-n_pieces // PIECES_PER_TASK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, task, base = OpenBins(capacity, open_bins), TaskContext.get().partitionId(), 0
        got = list(batches)
        if not got:
            return
        all_ = pa.Table.from_batches(got)
        order = np.lexsort([all_.column(c).to_numpy() for c in ("piece", "doc_key")])
        all_ = all_.take(order)
        length = all_.column("length").to_numpy()
        seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for lo in range(0, len(length), RUN):
            for i in lo + np.argsort(-length[lo : lo + RUN], kind="stable"):
                seq[i], off[i] = bins.put(int(length[i]))
        out = all_.drop_columns(["doc_key"]).append_column("sequence_id", pa.array(seq + (task << 32))).append_column("offset", pa.array(off))
        yield from out.to_batches(max_chunksize=20_000)

    keyed = found.withColumn("doc_key", F.xxhash64("doc_id", "ids_crc32")).repartition(tasks, "doc_key")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema) + ", sequence_id long, offset long"
    return keyed.mapInArrow(run, schema)


def best_fit(docs: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """Tokenises, cuts and packs documents: a row for each piece with its place."""
    found = written(pieces(docs, capacity), "pieces")
    return pack(found, found.count(), capacity, open_bins)


def sequences(docs: DataFrame, placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: (sequence_id, ids), from documents and their placement; ids that occur twice are refused."""
    if not placed.groupBy("doc_id", "piece").count().where("count > 1 or doc_id is null").isEmpty():
        raise ValueError("pieces meet their ids by doc_id: give every document an id of its own")
    ids = pieces(docs, capacity, with_ids=True).select("doc_id", "piece", "ids")
    joined = placed.select("doc_id", "piece", "sequence_id", "offset").join(ids, ["doc_id", "piece"])
    rows = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(F.flatten(rows.getField("ids")).alias("ids"))
