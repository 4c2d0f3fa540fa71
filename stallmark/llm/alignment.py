"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes of a text.

Both tokenizers' token ends are byte offsets. Where both end, a group ends. Groups are found by diagonal run skipping:
at the current shift between the two end arrays, blocks of doubling length are compared; as long as they agree the
tokens are one to one and are jumped over. Where they stop, the irregular group is resolved by walking both arrays to
the next common end, and the shift is that of the places after it. The texts of a batch are cut into lanes at
common ends, and all lanes take these steps together, as arrays. Blocks are compared by prefix hashes of the
ends; every stretch that was jumped is compared end by end afterwards.

The id pairs of each text are stored (distinct ones, with their number); the documents of each pair are counted in
Spark after each task has summed its own. The counts are sorted arrays for ranges of A ids in the shared folder,
mapped by the tasks that sum them up for each text. Their size is bounded by the product of the vocabularies, not
by the documents.

Defined cases: a text that is null or empty, or that a tokenizer does not give back byte for byte, has no tokens;
null ids, ties and repeated rows are rows (and documents) of their own; texts of any length are encoded whole; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathered, mix, segments, shared_folder, utf8, written
from .hash_arrays import Arrays, by_bucket, ranges, save
from .packing import encoding

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Files of pair counts: ranges of A ids.
BUCKETS = 64
#: Groups with more links than this count their pairs by distinct ids.
WIDE = 1024
#: Pairs that a task sums up before it gives them out.
HELD_PAIRS = 2_000_000
#: A tokens of a lane, and bytes of text that are aligned together.
LANE, TOGETHER = 64, 2_000_000
#: Words whose B ids a worker keeps, and their longest.
KEPT_WORDS, KEPT_CHARS = 200_000, 48


class Vocabulary:
    """The bytes of each token, one after the other."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(x) for x in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return gathered(self.flat, self.start[ids], self.size[ids])


class Pair:
    """The two tokenizers, the bytes of their tokens, and the decimal names of their ids with what follows them."""

    def __init__(self, a_file: str = A_FILE, b_file: str = B_FILE):
        self.a_file, self.a = a_file, encoding(a_file.replace(".json", ".tiktoken"))  # the same ids (tested), faster
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b_file))
        self.n_a, self.n_b = self.a.n_vocab, self.b.vocab_size()
        self.a_bytes = Vocabulary([self.a.decode_single_token_bytes(k) for k in range(self.n_a)])
        self.b_bytes = Vocabulary([self._piece(k) for k in range(self.n_b)])
        # No piece holds a space behind another character: words can be encoded by themselves.
        self.by_word = not any(b" " in self._piece(k).lstrip(b" ") for k in range(self.n_b)) and self.n_b < 1 << 16
        self._words: dict[str, bytes] = {}
        self.names = Vocabulary([b"%d%c" % (k, c) for n, signs in ((self.n_a, b",|"), (self.n_b, b",;")) for c in signs for k in range(n)])

    def _piece(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode()

    @functools.cached_property
    def _slow_a(self) -> tokenizers.Tokenizer:
        own = tokenizers.Tokenizer.from_file(public_tokenizers.path(self.a_file))
        own.encode_special_tokens = True
        return own

    def a_ids(self, text: str) -> np.ndarray:
        try:
            return self.a.encode_to_numpy(" " + text, disallowed_special=())
        except ValueError:  # its pattern gives up on a run of about a million spaces
            return np.array(self._slow_a.encode(" " + text, add_special_tokens=False).ids, np.uint32)

    def b_ids(self, texts: list[str | None]) -> list[np.ndarray]:
        """B's ids of each text, word by word where single spaces part the words: each word of all texts is encoded once, frequent ones are kept."""
        split = [t.split(" ") if self.by_word and t and t[0] != " " != t[-1] and "  " not in t else None for t in texts]
        known = self._words
        new = list({w for words in split if words for w in words if w not in known})
        for w, ids in zip(new, self.b.encode(new, num_threads=1)):
            known[w] = np.array(ids, "<u2").tobytes()
        out = [np.frombuffer(b"".join(map(known.__getitem__, words)), "<u2") if words else np.array(self.b.encode(t or ""), np.uint32) for t, words in zip(texts, split)]
        room = KEPT_WORDS - (len(known) - len(new))
        for w in (w for k, w in enumerate(new) if k >= room or len(w) > KEPT_CHARS):
            del known[w]
        return out

    def encoded(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of both for each text with a space in front; none for a null, an empty text and one that does not come back."""
        none = np.zeros(0, np.uint32)
        a = [self.a_ids(t) if t else none for t in texts]
        b = self.b_ids(texts)
        whole = [bool(t) and int(self.a_bytes.size[x].sum()) == int(self.b_bytes.size[y].sum()) for t, x, y in zip(texts, a, b)]
        data = [f" {t}".encode() if w else b"" for t, w in zip(texts, whole)]
        # A's tokens are bytes of the text by themselves; B's text may have been normalised.
        of = [y if w and int(self.b_bytes.size[y].sum()) == len(d) else none for w, y, d in zip(whole, b, data)]
        ends = np.append(0, np.cumsum([len(d) if len(x) else 0 for d, x in zip(data, of)]))
        found = self.b_bytes.joined(np.concatenate(of)) if of else np.zeros(0, np.uint8)
        differs = found != np.frombuffer(b"".join(d for d, x in zip(data, of) if len(x)), np.uint8)
        wrong = np.append(0, np.cumsum(differs))[ends]
        for k, x in enumerate(of):
            if not len(x) or wrong[k] != wrong[k + 1]:
                a[k] = b[k] = none
        return a, b


@functools.lru_cache(maxsize=2)
def pair_of(a_file: str = A_FILE, b_file: str = B_FILE) -> Pair:
    return Pair(a_file, b_file)


def lanes(ea: np.ndarray, eb: np.ndarray, size: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Where lanes of about `size` A tokens begin in both arrays: at their starts and behind common ends."""
    at = np.arange(size, len(ea), size)
    there = np.searchsorted(eb, ea[at - 1])
    common = eb[there] == ea[at - 1]
    return np.append(0, at[common]), np.append(0, there[common] + 1)


def irregular(ea: np.ndarray, eb: np.ndarray, size: int = LANE) -> np.ndarray:
    """(first A, last A, first B, last B) of each group that is not one to one, in order; ea and eb ascend and end alike.

    All other tokens are one to one. Every lane jumps blocks of doubling length that agree at its shift; a block that
    does not is halved until no token agrees, then the group is walked and the lane goes on behind it.
    """
    if not len(ea):
        return np.zeros((0, 4), np.int64)
    with np.errstate(over="ignore"):
        ha, hb = (np.append(np.uint64(0), np.cumsum(mix(e.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))) for e in (ea, eb))
    i, j = lanes(ea, eb, size)
    stop, stop_b = np.append(i[1:], len(ea)), np.append(j[1:], len(eb))
    step, shrink = np.ones(len(i), np.int64), np.zeros(len(i), bool)
    x, y = i.copy(), j.copy()
    found = []
    while len(i):
        # Skipping: blocks at the shift.
        fits = (step > 0) & (i + step <= stop) & (j + step <= stop_b)
        n = np.where(fits, step, 0)
        agree = fits & (ha[i + n] - ha[i] == hb[j + n] - hb[j])
        n = np.where(agree, n, 0)
        i, j = i + n, j + n
        walks = step == 0
        step = np.where(agree & ~shrink, step * 2, step // 2)
        shrink |= ~agree
        begins = (step == 0) & ~walks
        x, y = np.where(begins, i, x), np.where(begins, j, y)
        # Walking: the array that is behind, until both end.
        w = np.flatnonzero((step == 0) & (i < stop))
        p, q = ea[i[w]], eb[j[w]]
        i[w] += p < q
        j[w] += q < p
        met = w[p == q]
        if len(met):
            found.append(np.stack([x[met], i[met], y[met], j[met]], 1))
            i[met] += 1
            j[met] += 1
            step[met], shrink[met] = 1, False
        on = i < stop
        if not on.all():
            i, j, stop, stop_b, step, shrink, x, y = (v[on] for v in (i, j, stop, stop_b, step, shrink, x, y))
    out = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    out = out[np.argsort(out[:, 0])]
    single_a, single_b = (outside(len(e), out[:, k], out[:, k + 1] + 1) for e, k in ((ea, 0), (eb, 2)))
    if not np.array_equal(ea[single_a], eb[single_b]):
        raise ArithmeticError("two blocks of ends have one hash")
    return out


def outside(n: int, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """True for the places from 0 to n that lie in none of the ranges, which do not overlap."""
    step = np.zeros(n + 1, np.int8)
    step[first] += 1
    step[stop] -= 1
    return np.cumsum(step[:-1], dtype=np.int8) == 0


class Alignment:
    """The groups of texts; last_a and last_b mark the tokens that end one."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], of: Pair):
        self.of = of
        self.at_a, self.at_b = (np.append(0, np.cumsum([len(x) for x in t])) for t in (a, b))  # each text's tokens
        self.a, self.b = (np.concatenate(t).astype(np.int64) if t else np.zeros(0, np.int64) for t in (a, b))
        self.odd = irregular(np.cumsum(of.a_bytes.size[self.a]), np.cumsum(of.b_bytes.size[self.b]))
        self.last_a, self.last_b = (outside(len(t), self.odd[:, k], self.odd[:, k + 1]) for t, k in ((self.a, 0), (self.b, 2)))
        self.groups = np.append(0, np.cumsum(self.last_a))[self.at_a]  # groups before each text

    def texts(self) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3` of each text."""
        n, m = self.of.n_a, self.of.n_b
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        group_a, group_b = (np.cumsum(x) - x for x in (self.last_a, self.last_b))  # the group of each token
        ends_a, ends_b = np.flatnonzero(self.last_a) + 1, np.append(0, np.flatnonzero(self.last_b) + 1)
        codes[np.arange(len(self.a)) + ends_b[group_a]] = self.a + np.where(self.last_a, n, 0)
        codes[np.arange(len(self.b)) + ends_a[group_b]] = 2 * n + self.b + np.where(self.last_b, m, 0)
        upto = np.append(0, np.cumsum(self.of.names.size[codes]))[self.at_a + self.at_b]
        data = self.of.names.joined(codes).tobytes()
        return [data[lo : max(lo, hi - 1)] for lo, hi in zip(upto[:-1].tolist(), upto[1:].tolist())]

    def links(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each text the distinct pairs (A id times B's number of ids plus B id), ascending, and how many links each has."""
        m = self.of.n_b
        x0, x1, y0, y1 = self.odd.T
        text_of = lambda at: np.searchsorted(self.at_a, at, "right") - 1
        pair = lambda i, j: (text_of(i) << 40) + self.a[i] * m + self.b[j]
        single = [np.flatnonzero(outside(len(t), self.odd[:, k], self.odd[:, k + 1] + 1)) for t, k in ((self.a, 0), (self.b, 2))]
        na, nb = x1 - x0 + 1, y1 - y0 + 1
        wide = na * nb > WIDE
        fa, fb, width, size = x0[~wide], y0[~wide], nb[~wide], (na * nb)[~wide]
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        w = np.repeat(width, size)
        keys, count = np.unique(np.concatenate([pair(*single), pair(np.repeat(fa, size) + at // w, np.repeat(fb, size) + at % w)]), return_counts=True)
        for g0, g1, h0, h1 in self.odd[wide]:
            (ua, ca), (ub, cb) = (np.unique(t[lo : hi + 1], return_counts=True) for t, lo, hi in ((self.a, g0, g1), (self.b, h0, h1)))
            new = (int(text_of(g0)) << 40) + ua[:, None] * m + ub
            keys, count = summed(np.append(keys, new.ravel()), np.append(count, (ca[:, None] * cb).ravel()))
        edges = np.searchsorted(keys, np.arange(len(self.at_a), dtype=np.int64) << 40)
        keys &= (1 << 40) - 1
        return [(keys[lo:hi], count[lo:hi]) for lo, hi in zip(edges[:-1], edges[1:])]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def packed(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending keys as the planes of their differences' bytes, and counts in the fewest bytes; b'' if all are 1."""
    diff = np.diff(keys, prepend=0).astype("<u4" if len(keys) == 0 or keys[-1] < 1 << 32 else "<u8")
    width = diff.dtype.itemsize
    planes = bytes([width]) + diff.view(np.uint8).reshape(-1, width).T.tobytes()
    if not len(counts) or counts.max() == 1:
        return planes, b""
    kind = np.min_scalar_type(int(counts.max()))
    return planes, bytes([kind.itemsize]) + counts.astype(kind.newbyteorder("<")).tobytes()


def unpacked(planes: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    width = planes[0]
    diff = np.frombuffer(planes, np.uint8, offset=1).reshape(width, -1).T.copy().view(f"<u{width}")[:, 0]
    keys = np.cumsum(diff.astype(np.int64))
    return keys, np.frombuffer(counts, f"<u{counts[0]}", offset=1).astype(np.int64) if counts else np.ones(len(keys), np.int64)


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def aligned(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, with_groups: bool = False) -> DataFrame:
    """Token and group numbers, the digest of the groups and the id pairs of each text; with_groups adds the groups as text."""
    kinds = [*[pa.int64()] * 5, pa.string(), pa.binary(), pa.binary()] + [pa.string()] * with_groups
    names = [c.split()[0] for c in ALIGNED.split(", ")] + ["groups"] * with_groups

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = pair_of(a_file, b_file)
        for batch in batches:
            for lo, hi in segments(utf8(batch.column(1))[1], TOGETHER):
                part = batch.slice(lo, hi - lo)
                a, b = of.encoded(part.column(1).to_pylist())
                own = Alignment(a, b, of)
                groups, links = own.texts(), own.links()
                told = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
                data = [packed(*x) for x in links]
                rows = [part.column(0), *map(np.diff, (own.at_a, own.at_b, own.groups)), [int(c.sum()) for _, c in links], told, *zip(*data)]
                rows += [[g.decode() for g in groups]] * with_groups
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ALIGNED + ", groups string" * with_groups)


def pair_counts(found: DataFrame) -> DataFrame:
    """pair, n: how many rows hold each pair; each task sums its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for planes in batch.column(0):
                held.append(unpacked(planes.as_py(), b"")[0])
                n += len(held[-1])
                if n > HELD_PAIRS:
                    keys, counts = summed(np.concatenate([keys, *held]), np.concatenate([counts, np.ones(n, np.int64)]))
                    held, n = [], 0
                    if len(keys) > HELD_PAIRS:
                        yield from out(keys, counts)
                        keys, counts = keys[:0], counts[:0]
        yield from out(*summed(np.concatenate([keys, *held]), np.concatenate([counts, np.ones(n, np.int64)])))

    def out(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(keys[lo : lo + 100_000]), pa.array(counts[lo : lo + 100_000])], names=["pair", "n"])

    return found.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def stored_counts(counts: DataFrame, a_size: int, b_size: int) -> Arrays:
    """The counts as sorted arrays (key, n, best) for ranges of A ids; best: no pair of the A id has more."""
    folder = shared_folder(counts.sparkSession, "pairs")

    def merge(rows: pa.Table) -> pa.Table:
        keys, n = rows.column("pair").to_numpy(), rows.column("n").to_numpy()
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        a = keys // b_size
        first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        most = np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(keys))))
        save(folder, str(rows.column("bucket")[0].as_py()), key=keys, n=n, best=(n == most).astype(np.uint8))
        return pa.table({"bucket": rows.column("bucket")[:1]})

    a = F.floor(F.col("pair") / b_size).cast("long")
    rows = counts.withColumn("bucket", F.floor(a * BUCKETS / a_size).cast("int"))
    return Arrays(folder, BUCKETS, [r.bucket for r in by_bucket(rows, BUCKETS, merge, "bucket int").collect()])  # at most BUCKETS rows


def linked_sums(found: DataFrame, known: Arrays, a_size: int, b_size: int) -> DataFrame:
    """The rows of `aligned` with n_best and count_sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, total = [], []
            for planes, counts in zip(batch.column("pairs"), batch.column("times")):
                keys, times = unpacked(planes.as_py(), counts.as_py())
                b = t = 0
                buckets = keys // b_size * BUCKETS // a_size
                for bucket, lo, hi in ranges(buckets):
                    own = known.columns(bucket)
                    at = np.searchsorted(own["key"], keys[lo:hi])
                    b += int(times[lo:hi] @ own["best"][at].astype(np.int64))
                    t += int(times[lo:hi] @ own["n"][at])
                best.append(b)
                total.append(t)
            own = [batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(best, pa.int64()), pa.array(total, pa.int64()), batch.column("groups_sha256")], names=names)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return found.mapInArrow(run, ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in names))


def vocabulary_map(docs: DataFrame) -> DataFrame:
    """a_id, b_id, n: for each A id its most frequent partners, ties included."""
    of = pair_of()
    m = of.n_b
    counts = written(pair_counts(written(aligned(docs), "aligned")), "counts")
    own = counts.select(F.floor(F.col("pair") / m).cast("long").alias("a_id"), (F.col("pair") % m).alias("b_id"), "n")
    most = own.groupBy("a_id").agg(F.max("n").alias("n"))  # at most one row for each A id
    return own.join(F.broadcast(most), ["a_id", "n"]).select("a_id", "b_id", "n")


def cross_alignment(docs: DataFrame) -> DataFrame:
    """Token, group and link numbers of every text, with the corpus-wide counts of its links; see the module's text."""
    of = pair_of()
    sizes = of.n_a, of.n_b
    found = written(aligned(docs), "aligned")
    return linked_sums(found, stored_counts(pair_counts(found), *sizes), *sizes)
