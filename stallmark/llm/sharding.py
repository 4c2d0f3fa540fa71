"""Resharding by minimum-cost flow.

Rows are numbered as they lie in their files; they lie in blocks (a hash of that number, so no id or copy gathers in one), blocks in old shards. From the old shards' sizes and the new
shards' capacities a flow that moves the fewest bytes is solved; each donor gives the tail
of its rows, in block order, to the receivers that the flow names. Only block statistics (at most
`blocks` rows) and the flow (old x new shards) reach the driver.

Law `bytes`: every new shard gets its capacity but for the rows at its cuts, that is to within the
size of the longest rows. Defined cases: a null text has size 1 and crc 0; null ids and repeated rows
are rows of their own; an empty table gives an empty result; further columns are ignored. Equal
texts (groups) need not share a shard under this law.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import file_place, free_name, shared_folder, written

BLOCKS = 4096
OLD_SHARDS = 12
NEW_SHARDS = 16


def min_cost_flow(supply: list[int], demand: list[int], cost) -> dict[tuple[int, int], int]:
    """How many units go from i to j at least total cost, by shortest augmenting paths; totals must agree."""
    n, m = len(supply), len(demand)
    left, need, flow = list(supply), list(demand), {}
    while any(left):
        # Bellman-Ford over residual edges: i to j always, j to i where flow can be taken back.
        dist = {("s", i): 0 for i in range(n) if left[i]}
        back: dict = {}
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    c = cost(i, j)
                    if ("s", i) in dist and dist["s", i] + c < dist.get(("t", j), float("inf")):
                        dist["t", j], back["t", j], changed = dist["s", i] + c, ("s", i), True
                    if flow.get((i, j)) and ("t", j) in dist and dist["t", j] - c < dist.get(("s", i), float("inf")):
                        dist["s", i], back["s", i], changed = dist["t", j] - c, ("t", j), True
        at = min((("t", j) for j in range(m) if need[j]), key=lambda x: dist[x])
        path, node = [], at
        while node in back:
            path.append((back[node], node))
            node = back[node]
        amount = min([left[node[1]], need[at[1]], *(flow[b[1], a[1]] for a, b in path if a[0] == "t")])
        for a, b in path:
            edge = (a[1], b[1]) if a[0] == "s" else (b[1], a[1])
            flow[edge] = flow.get(edge, 0) + (amount if a[0] == "s" else -amount)
        left[node[1]] -= amount
        need[at[1]] -= amount
    return {k: v for k, v in flow.items() if v}


def even(total: int, parts: int) -> list[int]:
    return [total // parts + (k < total % parts) for k in range(parts)]


def reshard(docs: DataFrame, old_shards: int = OLD_SHARDS, new_shards: int = NEW_SHARDS, blocks: int = BLOCKS, capacities: list[int] | None = None) -> DataFrame:
    """row (its number), doc_id, size, text_crc32, old_shard, shard, slot and place for every row; see the module's text.

    place is where the row lies in its file (common.file_place), null if docs is not read from Parquet files.
    """
    place = file_place(docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
        (F.lit(None).cast("struct<file:long,at:long>") if place is None else place).alias("place"),
    )
    rows = written(rows, "rows").withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    order = W.partitionBy("block").orderBy("row")
    rows = rows.withColumn("rn", F.row_number().over(order)).withColumn("upto", F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)))
    rows = written(rows, "blocks")
    stats = {r.block: r.b for r in rows.groupBy("block").agg(F.sum("size").alias("b")).collect()}

    # Old layout: block k lies in old shard k % old_shards, in block order.
    start, held = {}, [0] * old_shards
    for k in range(blocks):
        if k in stats:
            start[k] = held[k % old_shards]
            held[k % old_shards] += stats[k]
    goal = capacities or even(sum(held), new_shards)
    flow = min_cost_flow(held, goal, lambda i, j: 0 if i == j else 1)
    cuts: list[list[tuple[int, int]]] = []  # for each old shard: from which byte on rows go to which shard
    for i in range(old_shards):
        own, at = [], 0
        for j in sorted((j for a, j in flow if a == i), key=lambda j: (j != i, j)):
            own.append((at, j))
            at += flow[i, j]
        cuts.append(own or [(0, i % new_shards)])
    plan = []
    for k, at in start.items():
        own = cuts[k % old_shards]
        inside = [x for n, x in enumerate(own) if x[0] < at + stats[k] and (n + 1 == len(own) or own[n + 1][0] > at)]
        plan.append((k, k % old_shards, at, inside))
    spark = docs.sparkSession
    plan_df = spark.createDataFrame(plan, "block int, old_shard int, at long, cuts array<struct<from:long,to:int>>")
    middle = F.col("at") + F.col("upto") - F.col("size") / 2
    to = F.coalesce(F.element_at(F.filter("cuts", lambda c: c["from"] <= F.col("middle")), -1)["to"], F.col("cuts")[0]["to"])
    moved = rows.join(F.broadcast(plan_df), "block").withColumn("middle", middle).withColumn("shard", to).drop("cuts", "middle", "at", "upto")

    # Rows of a block that go to one shard are neighbours, so slots follow from counts per block and shard.
    runs = sorted(tuple(r) for r in moved.groupBy("shard", "block").agg(F.count("*").alias("n"), F.min("rn").alias("first")).collect())
    at_, base = {}, []
    for shard, block, n, first in runs:
        base.append((shard, block, at_.get(shard, 0) - first))
        at_[shard] = at_.get(shard, 0) + n
    base_df = spark.createDataFrame(base, "shard int, block int, base long")
    out = moved.join(F.broadcast(base_df), ["shard", "block"])
    return out.select("row", "doc_id", "size", "text_crc32", "old_shard", "shard", (F.col("base") + F.col("rn")).alias("slot"), "place")


def rewrite_affected(docs: DataFrame, placed: DataFrame, out: str | None = None) -> str:
    """Writes, by shard, the files of every shard whose rows change; unaffected shards keep theirs.

    Rows meet their places by where they lie in their Parquet files, so rows without an id and repeated rows are written
    once each, and files may be split in another way than when they were placed. Rows that come from elsewhere
    meet by their number, which holds only while they are dealt out as then. What was written is read
    again: a shard whose rows or texts (count, sum of the crc32) are not those that were placed is an error.
    """
    out = out or shared_folder(docs.sparkSession, "shards")
    changed = placed.where("shard <> old_shard")
    affected = changed.select("shard").union(changed.select(F.col("old_shard").alias("shard"))).distinct()  # at most old and new shards
    target = placed.join(F.broadcast(affected), "shard", "left_semi")
    place = file_place(docs)
    by = "row" if place is None or not placed.where("place is null").isEmpty() else "place"
    own = {c: free_name(docs, c) for c in (by, "shard", "slot")}
    met = target.select(*(F.col(c).alias(to) for c, to in own.items()))
    rows = docs.withColumn(own[by], F.monotonically_increasing_id() if by == "row" else place).join(met, own[by]).drop(own[by])
    rows.repartition(own["shard"], F.floor(F.col(own["slot"]) / 100_000)).write.partitionBy(own["shard"]).parquet(out)
    sums = lambda crc: (F.count("*").alias("n"), F.sum(crc).alias("crc"))
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    want = {tuple(r) for r in target.groupBy("shard").agg(*sums("text_crc32")).collect()}  # a row for each new shard
    got = {tuple(r) for r in docs.sparkSession.read.schema(rows.schema).parquet(out).groupBy(own["shard"]).agg(*sums(F.crc32(text))).collect()} if want else want
    if got != want:
        raise RuntimeError(f"{out} does not hold the rows that were placed: shards {sorted(x[0] for x in got ^ want)} (shard, rows, crc32 sums) differ")
    return out
