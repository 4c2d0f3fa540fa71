"""Merkle manifest of a dataset with incremental witnesses.

Every row is a leaf. The rows of a source, in the order of their ids, are appended to a tree in which FAN
neighbours make a node; the sources' roots are appended to one more tree. A subtree that is still open holds the
nodes of its run; each member's witness refers to that run and its own place in it, so it is partial as long as
the run is open, and every later sibling that is completed extends the witnesses of all before it.

Spark deals the leaves out in aligned blocks of BLOCK leaves (whole subtrees), each appended in one task as a sorted
stream. The roots of these blocks are further appends: they are numbered within their source, dealt out in aligned
blocks of their own, and so on until each source has one root (three rounds for 10**12 rows); the sources go the
same way. A block's witness is that of its root in the round above. The leaves' own witnesses are not
stored: a block row holds the leaves, and appending them again gives them back.

`manifest` makes the block rows, `append` extends them: of the rows of before only each source's open block is
read again, all whole blocks stay as they are. `witnesses` gives a proof for each leaf.

Defined cases: nulls in any column are `-` in the leaf; rows without a source are a source of their own, the first;
rows without an id come first in theirs; rows of one id are ordered by their leaf, so repeated rows are leaves of
their own; texts of any length and empty ones are hashed whole; an empty table has no rows and no root;
further columns are ignored. Appended rows must not precede the rows of their source (`append` raises).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import broadcast_if_small, written

FAN = 16
#: Leaves of a block row, and nodes of a block in the rounds above: powers of FAN.
BLOCK, UPPER = FAN**2, FAN**3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
BROADCAST_ROWS = 200_000

BLOCKS = "grp binary, block long, first_id long, last_id long, ids array<long>, leaves array<string>, claims array<string>, root string, whole string, n long"
SIBLINGS = "array<struct<before:string,after:string>>"


def h(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def levels(n: int) -> int:
    """How many levels are above n nodes until one is left."""
    k = 0
    while n > 1:
        n, k = -(-n // FAN), k + 1
    return k


class Run:
    """Up to FAN neighbours; `parent` is their node's place (run, index) once they are complete or closed."""

    __slots__ = ("nodes", "parent")

    def __init__(self):
        self.nodes: list[str] = []
        self.parent: tuple[Run, int] | None = None


class Subtree:
    """An aligned subtree that is appended to from the left; `height` is the level at which its root lies."""

    def __init__(self, height: int):
        self.height = height
        self.open = [Run() for _ in range(height)]  # the open run of each level
        self.root: str | None = None

    def append(self, digest: str, level: int = 0) -> tuple[Run, int] | None:
        """Adds a node; its witness so far is its place in the open run (None if it is the root itself)."""
        if level == self.height:
            self.root = digest
            return None
        run = self.open[level]
        run.nodes.append(digest)
        at = run, len(run.nodes) - 1
        if len(run.nodes) == FAN:
            self._complete(level)
        return at

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], Run()
        run.parent = self.append(h("".join(run.nodes)), level + 1)

    def close(self) -> str:
        """Completes the open runs, the lowest first; no node may be added after it."""
        for level in range(self.height):
            if self.open[level].nodes:
                self._complete(level)
        return self.root

    @staticmethod
    def witness(at: tuple[Run, int] | None) -> Iterator[tuple[str, str]]:
        """The siblings before and after on each level, the lowest first."""
        while at:
            run, k = at
            yield "".join(run.nodes[:k]), "".join(run.nodes[k + 1 :])
            at = run.parent


def appended(digests: list[str], height: int) -> tuple[str, list[tuple[Run, int] | None]]:
    """The root of a subtree of this height over the digests, and the place of each."""
    tree = Subtree(height)
    places = [tree.append(d) for d in digests]
    return tree.close(), places


def folded(digest: str, witness: list[tuple[str, str]]) -> str:
    """The root that a digest and its siblings lead to."""
    for before, after in witness:
        digest = h(before + digest + after)
    return digest


# Leaves


def leaf(text: Column | None = None) -> Column:
    """The digest of a row: of each column `-` if it is null, else its length in bytes, a colon and its value."""

    def part(c: Column) -> Column:
        value = c.cast("string")
        return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*(part(text if c == "text" and text is not None else F.col(c)) for c in COLUMNS)), 256)


def group_of(source: Column) -> Column:
    """The bytes by which sources are ordered: none for a null, else one byte and the source's."""
    return F.when(source.isNull(), F.unhex(F.lit(""))).otherwise(F.concat(F.unhex(F.lit("01")), source.cast("string").cast("binary")))


def leaves(docs: DataFrame, claim: Column | None = None) -> DataFrame:
    """grp (see group_of), key (the id), digest and claim: a digest that is to be held against the manifest, null where it is the leaf."""
    claim = F.lit(None).cast("string") if claim is None else claim
    return docs.select(group_of(F.col("source")).alias("grp"), F.col("doc_id").cast("long").alias("key"), leaf().alias("digest"), claim.alias("claim"))


def numbered(rows: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """rows (grp, key, digest, ...) with pos: their number within grp, by key and digest; start has (grp, start) where a group begins later.

    Range partitions split a group of any size. Each partition's rows are sorted and numbered as they lie, and what
    lies before a partition follows from a row for each partition and group.
    """
    tie = F.monotonically_increasing_id()  # equal rows may be split; which is which makes no difference
    sort = written(rows.withColumn("tie", tie), "leaves")
    sort = sort.repartitionByRange("grp", "key", "digest", "tie").sortWithinPartitions("grp", "key", "digest", "tie").drop("tie")
    sort = written(sort.withColumn("at", F.monotonically_increasing_id()), "sorted").withColumn("part", F.shiftright("at", 33))
    counts = sort.groupBy("part", "grp").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("grp").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = written(counts.select("part", "grp", (before - F.col("first")).alias("shift")), "parts")
    if start is not None:
        counts = counts.join(start, "grp", "left").select("part", "grp", (F.col("shift") + F.coalesce("start", F.lit(0))).alias("shift"))
    out = sort.join(broadcast_if_small(counts, counts.count(), BROADCAST_ROWS), ["part", "grp"])
    return out.withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def with_count(nodes: DataFrame) -> DataFrame:
    """Adds total: how many nodes grp has."""
    totals = written(nodes.groupBy("grp").agg(F.count("*").alias("total")), "totals")
    return nodes.join(broadcast_if_small(totals, totals.count(), BROADCAST_ROWS), "grp")


# Blocks of leaves


def _blocks(rows: DataFrame) -> DataFrame:
    """Block rows of numbered leaves (grp, key, digest, claim, pos)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, [], []

        def done() -> None:
            if held:
                ids, digests, claims = (list(x) for x in zip(*held))
                root, _ = appended(digests, levels(BLOCK))
                whole = root if len(ids) > FAN else appended(digests, levels(len(ids)))[0]
                known = [x for x in ids if x is not None]
                out.append((*now, known[0] if known else None, known[-1] if known else None, ids, digests, claims, root, whole, len(ids)))

        for batch in batches:
            for grp, block, *row in zip(*(batch.column(c).to_pylist() for c in ("grp", "block", "key", "digest", "claim"))):
                if (grp, block) != now:
                    done()
                    now, held = (grp, block), []
                held.append(row)
            if len(out) >= 64:
                yield _batch(out, _BLOCK_FIELDS)
                out.clear()
        done()
        yield _batch(out, _BLOCK_FIELDS)

    rows = rows.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long"))
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "pos").mapInArrow(run, BLOCKS)


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


_LIST = pa.list_(pa.string())
_BLOCK_FIELDS = [
    ("grp", pa.binary()), ("block", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("leaves", _LIST),
    ("claims", _LIST), ("root", pa.string()), ("whole", pa.string()), ("n", pa.int64()),
]


def manifest(docs: DataFrame, claim: Column | None = None) -> DataFrame:
    """The block rows of a table, written to the shared folder."""
    return written(_blocks(numbered(leaves(docs, claim))), "blocks")


def append(blocks: DataFrame, docs: DataFrame, claim: Column | None = None) -> DataFrame:
    """The block rows of `blocks` and further rows, none of which may precede the ones that its source has."""
    new = written(leaves(docs, claim), "new")
    ends = blocks.groupBy("grp").agg(F.max("last_id").alias("last"), F.sum("n").alias("total"))
    begins = new.groupBy("grp").agg(F.min("key").alias("first"), F.max(F.col("key").isNull()).alias("none"))
    touched = written(begins.join(ends, "grp", "left"), "touched")
    early = touched.where((F.col("first") <= F.col("last")) | F.col("none") & F.col("total").isNotNull()).take(1)
    if early:
        raise ValueError(f"rows of {early[0].grp!r} precede rows that are in the manifest")
    is_open = F.col("n") < BLOCK
    reopened = blocks.where(is_open).join(touched.select("grp"), "grp", "left_semi")
    again = reopened.select("grp", F.explode(F.arrays_zip("ids", "leaves", "claims")).alias("x"))
    again = again.select("grp", F.col("x.ids").alias("key"), F.col("x.leaves").alias("digest"), F.col("x.claims").alias("claim"))
    start = touched.where("total is not null").select("grp", (F.floor(F.col("total") / BLOCK) * BLOCK).cast("long").alias("start"))
    added = _blocks(numbered(again.unionByName(new), start))
    kept = blocks.where(~is_open).unionByName(blocks.where(is_open).join(touched.select("grp"), "grp", "left_anti").select(*blocks.columns))
    return written(kept.unionByName(added), "blocks")


# Rounds above the blocks


def _rounds(nodes: DataFrame) -> DataFrame:
    """grp, pos, siblings (the lowest level first) and root, the root of grp, for nodes (grp, pos, digest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, [], []

        def done() -> None:
            if held:
                height = min(levels(now[2]), levels(UPPER))
                root, places = appended([d for _, d in held], height)
                for (pos, _), at in zip(held, places):
                    out.append((now[0], now[1], pos, [{"before": b, "after": a} for b, a in Subtree.witness(at)], root))

        for batch in batches:
            for grp, block, pos, digest, total in zip(*(batch.column(c).to_pylist() for c in ("grp", "block", "pos", "digest", "total"))):
                if (grp, block, total) != now:
                    done()
                    now, held = (grp, block, total), []
                    for lo in range(0, len(out), 256):
                        yield _batch(out[lo : lo + 256], fields)
                    out.clear()
                held.append((pos, digest))
        done()
        yield _batch(out, fields)

    siblings = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    fields = [("grp", pa.binary()), ("block", pa.int64()), ("pos", pa.int64()), ("siblings", siblings), ("root", pa.string())]
    counted = with_count(nodes).withColumn("block", F.floor(F.col("pos") / UPPER).cast("long"))
    most = counted.agg(F.max("total")).first()[0] or 0
    dealt = counted.repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")
    own = written(dealt.mapInArrow(run, f"grp binary, block long, pos long, siblings {SIBLINGS}, root string"), "round")
    if most <= UPPER:
        return own.drop("block")
    above = _rounds(own.groupBy("grp", F.col("block").alias("pos")).agg(F.first("root").alias("digest")))
    above = above.select("grp", F.col("pos").alias("block"), F.col("siblings").alias("more"), F.col("root").alias("top"))
    joined = own.join(above, ["grp", "block"])
    return written(joined.select("grp", "pos", F.concat("siblings", "more").alias("siblings"), F.col("top").alias("root")), "round")


def block_witnesses(blocks: DataFrame) -> DataFrame:
    """grp, block, siblings (from the block's root up to the root), subroot, root and in_source (leaves of grp) of every block."""
    sizes = written(blocks.groupBy("grp").agg(F.sum("n").alias("leaves")), "sizes")
    own = blocks.select("grp", F.col("block").alias("pos"), "root", "whole").join(broadcast_if_small(sizes, sizes.count(), BROADCAST_ROWS), "grp")
    # A source within one block has a tree of its own height: `whole` is its root.
    nodes = own.select("grp", "pos", F.when(F.col("leaves") <= BLOCK, F.col("whole")).otherwise(F.col("root")).alias("digest"))
    per_source = _rounds(written(nodes, "nodes"))
    subroots = written(per_source.where("pos = 0").select("grp", F.col("root").alias("subroot")), "subroots")
    # The sources are the leaves of the last tree: one group, in the order of their bytes.
    ranked = numbered(subroots.select(F.unhex(F.lit("")).alias("grp"), F.col("grp").alias("key"), F.col("subroot").alias("digest")))
    ranked = written(ranked, "ranked")
    top = _rounds(ranked.select("grp", "pos", "digest"))
    top = ranked.join(top.drop("grp"), "pos").select(F.col("key").alias("grp"), F.col("digest").alias("subroot"), F.col("siblings").alias("last"), "root")
    top = written(top, "top")
    few = top.count()
    out = per_source.drop("root").join(broadcast_if_small(top, few, BROADCAST_ROWS), "grp")
    out = out.join(broadcast_if_small(sizes, sizes.count(), BROADCAST_ROWS), "grp")
    return written(out.select("grp", F.col("pos").alias("block"), F.concat("siblings", "last").alias("siblings"), "subroot", "root", F.col("leaves").alias("in_source")), "above")


def witnesses(blocks: DataFrame, digests_only: bool = False) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (the siblings, level by level) and folded_root (from the claim or the leaf) for every leaf.

    With digests_only, proof_sha256 (the digest of the joined siblings) stands for the proof.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
                _, places = appended(row["leaves"], min(levels(row["in_source"]), levels(BLOCK)))
                above = [(s["before"], s["after"]) for s in row["siblings"]]
                rest, ends = "".join(b + a for b, a in above), {}
                out = []
                for doc_id, digest, claim, at in zip(row["ids"], row["leaves"], row["claims"], places):
                    own = list(Subtree.witness(at))
                    top = folded(claim or digest, own)
                    if top not in ends:
                        ends[top] = folded(top, above)
                    if digests_only:
                        proof = h("".join(b + a for b, a in own) + rest)
                    else:
                        proof = [{"before": b, "after": a} for b, a in own + above]
                    out.append((doc_id, digest, row["subroot"], row["root"], proof, ends[top]))
                yield _batch(out, fields)

    kind = pa.string() if digests_only else pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    name = "proof_sha256" if digests_only else "proof"
    fields = [("doc_id", pa.int64()), *((c, pa.string()) for c in ("leaf", "subroot", "root")), (name, kind), ("folded_root", pa.string())]
    above = block_witnesses(blocks)
    joined = blocks.select("grp", "block", "ids", "leaves", "claims").join(broadcast_if_small(above, above.count(), BROADCAST_ROWS // 10), ["grp", "block"])
    schema = f"doc_id long, leaf string, subroot string, root string, {name} {'string' if digests_only else SIBLINGS}, folded_root string"
    return joined.mapInArrow(run, schema)


def tampered() -> Column:
    """The leaf of a row whose text was lower-cased (A-Z), for one id of five; null elsewhere."""
    lower = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, leaf(lower))


def verified(docs: DataFrame) -> DataFrame:
    """The manifest of docs with every witness, folded from tampered rows where an id's crc32 is divisible by 5."""
    out = witnesses(manifest(docs, tampered()), digests_only=True)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle_sql() -> str:
    """DuckDB SQL of `verified`: levels by recursion, a node a row, each leaf's siblings gathered level by level."""
    parts = " || ".join(f"coalesce(octet_length(encode({c}::varchar)) || ':' || {{{c}}}, '-')" for c in COLUMNS)
    own = {c: f"{c}::varchar" for c in COLUMNS}
    plain, changed = parts.format(**own), parts.format(**own | {"text": "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"})
    crc_table = "(SELECT list(v ORDER BY k) FROM (SELECT k, v FROM crc WHERE bit = 8))"
    return f"""
WITH RECURSIVE crc AS (
  SELECT 0 AS bit, k, k::UBIGINT AS v FROM range(256) t(k)
  UNION ALL
  SELECT bit + 1, k, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::UBIGINT) ELSE v // 2 END FROM crc WHERE bit < 8
), crc_table AS MATERIALIZED (SELECT {crc_table} AS tab),
letters AS (
  SELECT doc_id, 0 AS k, 4294967295::UBIGINT AS state, doc_id::varchar AS id FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, k + 1, xor(state // 256, (SELECT tab FROM crc_table)[(xor(state % 256, ascii(id[k + 1])::UBIGINT) + 1)::BIGINT]), id FROM letters WHERE k < length(id)
), marked AS (SELECT doc_id FROM letters WHERE k = length(id) AND (4294967295::UBIGINT - state) % 5 = 0),
leaf AS (
  SELECT doc_id, coalesce('s' || source, '') AS grp, sha256({plain}) AS leaf,
    CASE WHEN doc_id IN (SELECT doc_id FROM marked) THEN sha256({changed}) END AS claim
  FROM documents
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, row_number() OVER (ORDER BY grp, doc_id NULLS FIRST, leaf) AS id FROM leaf
), tree AS (
  SELECT 0 AS level, grp, pos, leaf AS digest, count(*) OVER (PARTITION BY grp) AS n FROM numbered
  UNION ALL
  SELECT level + 1, grp, pos // {FAN}, sha256(string_agg(digest, '' ORDER BY pos)), (n + {FAN - 1}) // {FAN} FROM tree WHERE n > 1 GROUP BY level, grp, pos // {FAN}, n
), subroots AS (SELECT grp, digest AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS level, pos, subroot AS digest, (SELECT count(*) FROM subroots) AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // {FAN}, sha256(string_agg(digest, '' ORDER BY pos)), (n + {FAN - 1}) // {FAN} FROM top WHERE n > 1 GROUP BY level, pos // {FAN}, n
), nodes AS (
  SELECT grp, level, pos, digest FROM tree WHERE n > 1
), runs AS (
  SELECT grp, level, pos // {FAN} AS run, list(digest ORDER BY pos) AS digests FROM nodes GROUP BY ALL
), top_runs AS (SELECT level, pos // {FAN} AS run, list(digest ORDER BY pos) AS digests FROM top WHERE n > 1 GROUP BY ALL),
path AS (
  SELECT id, grp, 0 AS level, pos, '' AS proof, coalesce(claim, leaf) AS found, false AS done FROM numbered
  UNION ALL
  SELECT p.id, p.grp, CASE WHEN r.run IS NULL THEN 0 ELSE p.level + 1 END,
    CASE WHEN r.run IS NULL THEN s.pos ELSE p.pos // {FAN} END,
    p.proof || CASE WHEN r.run IS NULL THEN '' ELSE array_to_string(r.digests[1:p.pos % {FAN}], '') || array_to_string(r.digests[p.pos % {FAN} + 2:], '') END,
    CASE WHEN r.run IS NULL THEN p.found ELSE sha256(array_to_string(r.digests[1:p.pos % {FAN}], '') || p.found || array_to_string(r.digests[p.pos % {FAN} + 2:], '')) END,
    r.run IS NULL
  FROM path p LEFT JOIN runs r ON r.grp = p.grp AND r.level = p.level AND r.run = p.pos // {FAN} JOIN subroots s ON s.grp = p.grp WHERE NOT p.done
), upper_path AS (
  SELECT id, 0 AS level, pos, proof, found FROM path WHERE done
  UNION ALL
  SELECT p.id, p.level + 1, p.pos // {FAN}, p.proof || array_to_string(r.digests[1:p.pos % {FAN}], '') || array_to_string(r.digests[p.pos % {FAN} + 2:], ''),
    sha256(array_to_string(r.digests[1:p.pos % {FAN}], '') || p.found || array_to_string(r.digests[p.pos % {FAN} + 2:], ''))
  FROM upper_path p JOIN top_runs r ON r.level = p.level AND r.run = p.pos // {FAN}
), ends AS (SELECT id, arg_max(proof, level) AS proof, arg_max(found, level) AS found FROM upper_path GROUP BY id),
root AS (SELECT digest AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, found AS folded_root, found = root AS verified
FROM numbered JOIN subroots USING (grp) JOIN ends USING (id) CROSS JOIN root
"""
