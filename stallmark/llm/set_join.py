"""Exact n-gram Jaccard join with skipping by set relations.

A document is the set of its distinct word shingles (64-bit hashes). Documents link when
100 * |intersection| >= 80 * |union|. The steps:

1. Shingles are counted per hash bucket; those in two documents or more are kept with their document
   frequency as sorted arrays in the shared folder, which later tasks map. A shingle of one document only
   links nothing, so a document with more than a fifth of such shingles is done: it links with nothing.
2. Equal sets become one node. A node's shingles are ordered by frequency, rarest first; two nodes that
   link share one of their first n - ceil(0.8 n) + 1 shingles, and its place bounds their overlap.
   These prefixes form index lists.
3. In every list each node is compared with one leader only (the one whose shingles
   are the most frequent): stars, not pairs. Verified links give components.
4. Index-level skipping: lists whose nodes lie in one component are skipped; other lists are sorted by size
   and cut into blocks, and a block is skipped where its sizes or places cannot reach the threshold. Only
   pairs across components remain.
5. Answer-level skipping: a node's overlap with its leader is a computed answer. For two nodes B, C of one
   leader R the overlap of B and C is at most min(|B R|, |C R|) + min(|B - R|, |C - R|), counted without
   shingles of one document; pairs below the threshold are skipped, the others are verified exactly.

Lists are gathered by hash bucket, a task for each. A list may be long only if its shingle is in more than
LONGEST documents. Entries of such shingles stay rows: their leader is an aggregate, its comparisons a salted
join, and step 4 cuts the list into blocks of LONG_BLOCK nodes that meet in groups of their own; what lies in the
list's largest component is not compared with itself.

The nodes are stored in buckets by hash. Components and leaders come to them there, the lists get prefixes only, and
only nodes of a pair leave their bucket to be verified: whole sets are shuffled once, to be stored, and once more where they are compared.

Pairs within a component are never expanded, so a group of copies costs a star, and no link
between different components is lost. Only counters reach the driver.

Defined cases: a text with fewer words than the shingle has its whole word sequence as one shingle; without
words or text the set is empty and links with nothing; repeated rows and equal texts are equal sets; rows
without an id have a null component and link nothing; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, mix, segments, shared_folder, stored_by, utf8, word_hashes, written
from .hash_arrays import LEAST_BUCKETS, MASK48, MOST_TASKS, Arrays, bucket48, bucket64, bucket_count, by_bucket, pack48, ranges, save, smallest, told, unpack48

WORDS = 5
#: The similarity as a fraction of whole numbers.
NUMERATOR, DENOMINATOR = 80, 100
HELD_SHINGLES = 4_000_000
#: Nodes of an index list in one block.
BLOCK = 64
SALTS = 32
#: A shingle of more documents than this has its list spread over tasks, in blocks of this many nodes.
LONGEST, LONG_BLOCK = 20_000, 4096
#: Nodes lie in one bucket for so many buckets of shingles: each task that makes index lists sends a row to nearly every bucket of these.
NODE_SHARE = 8
#: The fields of an entry of an index list.
FIELDS = ("node", "n", "rare", "place", "central", "component", "leader", "overlap")
_MULTIPLIER = np.uint64(0x9FB21C651E98DF25)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, offsets) for runs of rows: each row's distinct shingle hashes, ascending."""
    buf_all, offs_all = utf8(texts)
    for lo, hi in segments(offs_all):
        h, at = word_hashes(buf_all[offs_all[lo] : offs_all[hi]], offs_all[lo : hi + 1] - offs_all[lo])
        count = np.diff(at)
        n = np.where(count >= words, count - words + 1, np.minimum(count, 1))
        owner = np.repeat(np.arange(hi - lo), n)
        place = np.repeat(at[:-1], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        size = np.minimum(count, words)[owner]
        s = np.zeros(len(place), np.uint64)
        for k in range(words):
            inside = size > k
            s[inside] = mix(s[inside] * _MULTIPLIER + h[place[inside] + k])
        s = mix(s + size.astype(np.uint64))
        order = np.lexsort((s, owner))
        s, owner = s[order], owner[order]
        new = np.append(True, (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])) if len(s) else np.zeros(0, bool)
        s, owner = s[new], owner[new]
        yield lo, s, np.searchsorted(owner, np.arange(hi - lo + 1))


def least_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest overlap with which sets of these sizes link."""
    return -(-NUMERATOR * (a + b) // (NUMERATOR + DENOMINATOR))


def least_of_self(n: np.ndarray) -> np.ndarray:
    """The smallest overlap of any link of a set of this size."""
    return -(-NUMERATOR * n // DENOMINATOR)


def shared_shingles(docs: DataFrame, buckets: int, words: int = WORDS, longest: int = LONGEST) -> tuple[Arrays, int]:
    """Step 1: the shingles (48 bits) in two documents or more, with their frequency; and how many are in more than `longest`.

    A clash of two shingles in 48 bits only makes a list longer; sets are compared by 64 bits.
    """
    folder = shared_folder(docs.sparkSession, "shingles")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            s = np.sort(np.concatenate(held))
            first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
            n, s = np.diff(np.append(first, len(s))), s[first]
            rows = [(b, pack48(s[lo:hi]), n[lo:hi].astype("<u4").tobytes()) for b, lo, hi in ranges(bucket48(s, buckets))]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "shingle", "n"])

        for batch in batches:
            for _, s, _ in shingle_sets(batch.column(0), words):
                if len(s):
                    held.append(s & MASK48)
                    size += len(s)
                if size >= HELD_SHINGLES:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def merge(got: pa.Table) -> pa.Table:
        s = np.concatenate([unpack48(x) for x in got.column("shingle").to_pylist()])
        n = np.concatenate([np.frombuffer(x, "<u4") for x in got.column("n").to_pylist()]).astype(np.int64)
        order = np.argsort(s, kind="stable")
        s, n = s[order], n[order]
        first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        s, n = s[first], np.add.reduceat(n, first)
        bucket = got.column("bucket")[0].as_py()
        save(folder, str(bucket), key=s[n > 1], count=smallest(n[n > 1]))
        return pa.table([pa.array([bucket]), pa.array([int((n > longest).sum())])], names=["n", "frequent"])

    packed = docs.where(F.col("doc_id").isNotNull()).select(F.col("text").cast("string")).mapInArrow(gather, "bucket int, shingle binary, n binary")
    done, sums = told(by_bucket(packed, buckets, merge, "n long, frequent long"), frequent=F.col("frequent"))
    return Arrays(folder, buckets, done), sums["frequent"]


def document_sets(docs: DataFrame, known: Arrays, words: int = WORDS) -> DataFrame:
    """Step 2, first half: doc_id, n_shingles and, where links are possible, node (hash of the set), rare, central, shingles.

    central: the mean logarithm of the shingles' frequencies, in millionths.
    The shingles (rarest first, without the `rare` ones of one document) come once for each node and task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column(0)
            for lo, s, offs in shingle_sets(batch.column(1), words):
                rows = len(offs) - 1
                low = s & MASK48
                order = np.argsort(low)
                _, df = known.lookup(low[order], bucket48(low[order], known.buckets), ("count",))
                count = np.empty_like(df)
                count[order] = df
                n = np.diff(offs)
                owner = np.repeat(np.arange(rows), n)
                rare = np.bincount(owner, count < 2, rows).astype(np.int64)
                id_ok = ids.slice(lo, rows).is_valid().to_numpy(zero_copy_only=False)
                live = (n > 0) & (n - rare >= least_of_self(n)) & id_ok
                central = np.bincount(owner, np.log2(np.maximum(count, 1)), rows) / np.maximum(n, 1)
                by_freq = np.lexsort((s, count, owner))
                nodes, blobs = [None] * rows, [None] * rows
                for r in np.flatnonzero(live):
                    a, z = offs[r], offs[r + 1]
                    node = int(mix(np.add.reduce(mix(s[a:z])).reshape(1) ^ np.uint64(z - a))[0].astype(np.int64))
                    nodes[r] = node
                    if node not in seen:
                        seen.add(node)
                        blobs[r] = s[by_freq[a + rare[r] : z]].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, rows), pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(rare, pa.int64()), pa.array((central * 1e6).astype(np.int64)), pa.array(blobs, pa.binary())],
                    names=["doc_id", "n_shingles", "node", "rare", "central", "shingles"],
                )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, n_shingles long, node long, rare long, central long, shingles binary")


def prefixed(nodes: DataFrame) -> DataFrame:
    """The nodes with the shingles of their prefixes only."""
    length = F.expr(f"cast(8 * (n + 1 - rare - ({NUMERATOR} * n + {DENOMINATOR - 1}) div {DENOMINATOR}) as int)")
    return nodes.withColumn("shingles", F.substring("shingles", F.lit(1), length))


def _prefixes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The prefix shingles of a batch of nodes, ascending, and the FIELDS of each."""
    node, n, rare, central, comp, leader, overlap = (batch.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in FIELDS if c != "place")
    length = n - least_of_self(n) + 1 - rare
    sets = [np.frombuffer(x, "<u8") for x in batch.column("shingles").to_pylist()]
    take = np.minimum(length, [len(x) for x in sets])
    entries = np.concatenate([x[:k] for x, k in zip(sets, take)])
    owner = np.repeat(np.arange(len(node)), take)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(take) - take, take) + rare[owner]
    order = np.argsort(entries)
    o = owner[order]
    return entries[order], np.stack([node[o], n[o], rare[o], place[order], central[o], comp[o], leader[o], overlap[o]])


def _frequent(entries: np.ndarray, known: Arrays, longest: int) -> np.ndarray:
    """Whether each shingle is in more than `longest` documents."""
    low = entries & MASK48
    order = np.argsort(low)
    out = np.zeros(len(low), bool)
    out[order] = known.lookup(low[order], bucket48(low[order], known.buckets), ("count",))[1] > longest
    return out


def index_lists(nodes: DataFrame, buckets: int, known: Arrays | None = None, longest: int = LONGEST) -> DataFrame:
    """Prefix entries packed by hash bucket, with `known` without those of frequent shingles. nodes: node, n, rare, central, shingles, component, leader, overlap (the last three may be null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries, fields = _prefixes(batch)
            if known is not None:
                short = ~_frequent(entries, known, longest)
                entries, fields = entries[short], fields[:, short]
            rows = [(b, entries[lo:hi].tobytes(), fields[:, lo:hi].tobytes()) for b, lo, hi in ranges(bucket64(entries, buckets))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else ((), (), ()), (pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "entry", "fields"])

    return nodes.select("shingles", *(c for c in FIELDS if c != "place")).mapInArrow(run, "bucket int, entry binary, fields binary")


def long_lists(nodes: DataFrame, known: Arrays, longest: int = LONGEST) -> DataFrame:
    """The entries that index_lists leaves out: a row of entry and FIELDS for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries, fields = _prefixes(batch)
            long = _frequent(entries, known, longest)
            yield pa.RecordBatch.from_arrays([pa.array(entries[long].astype(np.int64)), *map(pa.array, fields[:, long])], names=["entry", *FIELDS])

    return nodes.select("shingles", *(c for c in FIELDS if c != "place")).mapInArrow(run, "entry long, " + ", ".join(f"{c} long" for c in FIELDS))


def _beside(entries: DataFrame, lists: DataFrame) -> DataFrame:
    """The entries joined with a row for each list; a list's entries lie in SALTS partitions."""
    salted = lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return entries.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(salted, ["entry", "salt"]).drop("salt")


def long_star_pairs(entries: DataFrame) -> DataFrame:
    """Step 3 for long lists: a, b as of star_pairs."""
    first = F.max_by(F.struct("node", "n", "place"), F.struct("central", F.bitwise_not("node"))).alias("head")
    each = _beside(entries, entries.groupBy("entry").agg(first))
    enough = (NUMERATOR + DENOMINATOR) * F.least(F.col("n") - F.col("place"), F.expr("head.n - head.place")) >= NUMERATOR * (F.col("n") + F.col("head.n"))
    return each.where((F.col("node") != F.col("head.node")) & enough).select(F.col("head.node").alias("a"), F.col("node").alias("b"))


def long_cross_pairs(entries: DataFrame, block: int = LONG_BLOCK) -> DataFrame:
    """Steps 4 and 5 for long lists: every node outside a list's largest component meets all of the list, block by block."""
    parts = entries.groupBy("entry", "component").agg(F.count("*").alias("nodes"))
    lists = parts.groupBy("entry").agg(F.sum("nodes").alias("nodes"), F.max("nodes").alias("most"), F.max_by("component", F.struct("nodes", "component")).alias("main"))
    lists = lists.where("most < nodes")  # else the whole list is answered
    blocks = lambda n: F.ceil(n / block).cast("int")
    lists = lists.select("entry", "main", blocks(F.col("nodes") - F.col("most")).alias("minor_blocks"), blocks(F.col("nodes")).alias("all_blocks"))
    each = _beside(entries, lists)
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keep = ["entry", *FIELDS]
    minor = each.where("component <> main").select(*keep, F.lit(True).alias("minor"), own("minor_blocks").alias("i"), every("all_blocks").alias("j"))
    rest = each.select(*keep, F.lit(False).alias("minor"), every("minor_blocks").alias("i"), own("all_blocks").alias("j"))
    return minor.union(rest).groupBy("entry", "i", "j").applyInArrow(block_pairs, "a long, b long")


def block_pairs(got: pa.Table) -> pa.Table:
    """The pairs of two blocks of a list, across components, that sizes, places and known answers leave open."""
    minor = got.column("minor").to_numpy(zero_copy_only=False).astype(bool)
    fields = np.stack([got.column(c).to_numpy() for c in FIELDS])
    own, others = fields[:, minor], fields[:, ~minor]
    node, n, rare, place, _, comp, leader, overlap = others[:, np.argsort(others[1], kind="stable")]
    found = []
    for node_i, n_i, rare_i, place_i, _, comp_i, leader_i, overlap_i in own.T:
        lo, hi = np.searchsorted(n, least_of_self(n_i)), np.searchsorted(n, n_i * DENOMINATOR // NUMERATOR, "right")
        j = slice(lo, hi)
        need = least_overlap(n_i, n[j])
        can = (comp[j] != comp_i) & (np.minimum(n_i - place_i, n[j] - place[j]) >= need)
        if leader_i:
            bound = np.minimum(overlap_i, overlap[j]) + np.minimum(n_i - rare_i - overlap_i, n[j] - rare[j] - overlap[j])
            can &= (leader[j] != leader_i) | (bound >= need)
        if can.any():
            other = node[j][can]
            found.append(np.stack([np.minimum(node_i, other), np.maximum(node_i, other)]))
    return _pairs(found)


def _lists(got: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
    """The lists of a bucket with two nodes or more: node, n, rare, place, central, component, leader, overlap of each entry."""
    entry = np.concatenate([np.frombuffer(x, "<u8") for x in got.column("entry").to_pylist()])
    fields = np.concatenate([np.frombuffer(x, np.int64).reshape(8, -1) for x in got.column("fields").to_pylist()], 1)
    order = np.argsort(entry, kind="stable")
    entry, fields = entry[order], fields[:, order]
    for _, lo, hi in ranges(entry):
        if hi - lo > 1:
            yield tuple(fields[:, lo:hi])


def _pairs(found: list[np.ndarray]) -> pa.Table:
    ab = np.concatenate(found, 1) if found else np.zeros((2, 0), np.int64)
    ab = np.unique(ab, axis=1)
    return pa.table([pa.array(ab[0]), pa.array(ab[1])], names=["a", "b"])


def star_pairs(got: pa.Table) -> pa.Table:
    """Step 3: each node of a list with the list's leader, where sizes and places allow a link.

    The leader has the most frequent shingles on average (then the smallest hash): edits add rare ones, so
    it is the text from which the list's variants were made, or the nearest to it.
    """
    found = []
    for node, n, _, place, central, *_ in _lists(got):
        k = int(np.lexsort((node, -central))[0])
        need = least_overlap(n, n[k])
        can = (np.minimum(n - place, n[k] - place[k]) >= need) & (node != node[k])
        found.append(np.stack([np.full(int(can.sum()), node[k]), node[can]]))
    return _pairs(found)


def cross_pairs(got: pa.Table) -> pa.Table:
    """Steps 4 and 5: pairs of a list across components that sizes, places and known answers leave open."""
    found = []
    for node, n, rare, place, _, comp, leader, overlap in _lists(got):
        if (comp == comp[0]).all():
            continue  # the whole list is answered
        order = np.argsort(n, kind="stable")
        node, n, rare, place, comp, leader, overlap = (x[order] for x in (node, n, rare, place, comp, leader, overlap))
        rest = n - place
        extra = n - rare - overlap  # shingles beyond the leader's that others may have
        edges = np.arange(0, len(n), BLOCK)
        most_rest = np.maximum.reduceat(rest, edges)
        top = np.minimum(n * DENOMINATOR // NUMERATOR, n[-1])
        upto = np.searchsorted(n, top, "right")
        for i in range(len(n) - 1):
            first, last = (i + 1) // BLOCK, (upto[i] - 1) // BLOCK
            for b in range(first, last + 1):
                lo, hi = max(i + 1, b * BLOCK), min(upto[i], (b + 1) * BLOCK)
                if lo >= hi or min(rest[i], most_rest[b]) < least_overlap(n[i], n[lo]):
                    continue  # no node of the block has enough left after its place
                j = slice(lo, hi)
                need = least_overlap(n[i], n[j])
                can = (comp[j] != comp[i]) & (np.minimum(rest[i], rest[j]) >= need)
                if leader[i]:
                    bound = np.minimum(overlap[i], overlap[j]) + np.minimum(extra[i], extra[j])
                    can &= (leader[j] != leader[i]) | (bound >= need)
                if can.any():
                    other = node[j][can]
                    found.append(np.stack([np.minimum(node[i], other), np.maximum(node[i], other)]))
        if len(found) > 2000:
            found = [np.unique(np.concatenate(found, 1), axis=1)]
    return _pairs(found)


def nodes_of(pairs: DataFrame, nodes: DataFrame, buckets: int) -> DataFrame:
    """The nodes (stored in so many buckets) that are in a pair."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().repartition(buckets, "node")
    return nodes.join(ids, "node", "left_semi")


def verified(pairs: DataFrame, nodes: DataFrame, buckets: int) -> DataFrame:
    """a, b, overlap, link of each pair (stored ones, they are read twice), exactly. nodes: stored in so many buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            own: dict[bytes, np.ndarray] = {}
            out = np.zeros(batch.num_rows, np.int64)
            for k, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"))):
                x, y = x.as_py(), y.as_py()
                sets = []
                for blob in (x, y):
                    if blob not in own:
                        if len(own) > 64:
                            own.clear()
                        own[blob] = np.sort(np.frombuffer(blob, "<u8"))
                    sets.append(own[blob])
                s, t = sets
                at = np.searchsorted(t, s)
                at[at == len(t)] = 0
                out[k] = (t[at] == s).sum() if len(t) else 0
            link = out >= least_overlap(na, nb)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out), pa.array(link)], names=["a", "b", "overlap", "link"])

    # Written, so that these joins deal them out anew and Spark can split the pairs of a frequent leader.
    met = written(nodes_of(pairs, nodes, buckets).select("node", "n", "shingles"), "met")
    a = met.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    b = met.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    return pairs.join(b, "b").join(a, "a").mapInArrow(run, "a long, b long, overlap long, link boolean")


def jaccard_components(docs: DataFrame, words: int = WORDS, longest: int = LONGEST, block: int = LONG_BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id for every document."""
    buckets = bucket_count(docs)
    shared, frequent = shared_shingles(docs, buckets, words, longest)
    sets = written(document_sets(docs, shared, words), "sets")
    live = sets.where("node is not null")
    # Copies meet in tasks first: one row with shingles for each node and task.
    least = live.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    bodies = live.where("shingles is not null").select("node", F.col("n_shingles").alias("n"), "rare", "central", "shingles")
    stored = min(max(LEAST_BUCKETS, buckets // NODE_SHARE), MOST_TASKS)
    nodes = stored_by(bodies, "nodes", "node", stored)
    starts = prefixed(nodes)

    none = starts.withColumns({c: F.lit(None).cast("long") for c in ("component", "leader", "overlap")})
    apart = shared if frequent else None  # without frequent shingles no list is long
    stars = by_bucket(index_lists(none, buckets, apart, longest), buckets, star_pairs, "a long, b long")
    if frequent:
        stars = stars.union(long_star_pairs(written(long_lists(none, shared, longest), "long")))
    checked = written(verified(written(stars.distinct(), "pairs"), nodes, stored), "stars")
    components = connected_components(checked.where("link")).withColumnRenamed("id", "node").repartition(stored, "node")
    leaders = checked.groupBy("b").agg(F.max_by(F.struct("a", "overlap"), F.struct("overlap", "a")).alias("l")).select(F.col("b").alias("node"), F.col("l.a").alias("leader"), F.col("l.overlap").alias("overlap"))
    known = starts.join(components, "node", "left").join(leaders.repartition(stored, "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    # The leader itself has its whole set in common with itself.
    heads = leaders.select(F.col("leader").alias("node")).distinct().repartition(stored, "node").withColumn("is_head", F.lit(True))
    known = known.join(heads, "node", "left").withColumns({
        "overlap": F.when(F.col("is_head"), F.col("n") - F.col("rare")).otherwise(F.col("overlap")),
        "leader": F.when(F.col("is_head"), F.col("node")).otherwise(F.col("leader")),
    })
    crossing = by_bucket(index_lists(known, buckets, apart, longest), buckets, cross_pairs, "a long, b long")
    if frequent:
        crossing = crossing.union(long_cross_pairs(written(long_lists(known, shared, longest), "long"), block))
    crossing = crossing.distinct()
    crossing = crossing.join(checked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    more = verified(written(crossing, "pairs"), nodes, stored).where("link").select("a", "b")
    links = checked.where("link").select("a", "b").union(more)
    components = connected_components(written(links, "links")).withColumnRenamed("id", "node")

    of_node = least.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = of_node.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_node = of_node.join(smallest, "component").select("node", "component_id")
    salted = by_node.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    linked = live.select("doc_id", "n_shingles", "node", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    linked = linked.join(salted, ["node", "salt"]).select("doc_id", "n_shingles", "component_id")
    alone = sets.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone)


ORACLE_SQL = """
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) >= 5 THEN array_to_string(words[i:i + 4], ' ') ELSE array_to_string(words, ' ') END AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (max(na.n) + max(nb.n) - count(*))
), edges AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  WITH RECURSIVE r(id, to_id) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, e.b FROM r JOIN edges e ON e.a = r.to_id)
  SELECT id, min(to_id) AS component_id FROM r GROUP BY id
)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id FROM documents LEFT JOIN n USING (doc_id) JOIN reach ON reach.id = doc_id
"""
