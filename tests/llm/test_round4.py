"""The Jaccard join moves whole sets once to store them, and again only where they are compared."""

import os
import random

from pyspark.sql import functions as F

from stallmark.llm import common, set_join


def shuffled(spark, since=-1):
    """Bytes that stages after one have written for shuffles, and the last stage."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    own = [(s.stageId(), s.shuffleWriteBytes()) for s in (stages.apply(i) for i in range(stages.size()))]
    return sum(b for k, b in own if k > since), max((k for k, _ in own), default=-1)


def test_sets_that_meet_no_other_are_not_shuffled_again(spark):
    """Texts that lie in longer ones: every shingle is shared, but sizes allow few pairs. Two edits link, and their lists are long."""
    rng = random.Random(4)
    small = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(300)) for _ in range(300)]
    large = [" ".join(small[k : k + 3]) for k in range(0, 300, 3)]
    edits = [small[0] + f" e{k}" for k in range(6)]
    texts = small + large + edits
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as between large tables
    try:
        since = shuffled(spark)[1]
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in set_join.jaccard_components(docs, longest=4, block=2).collect()}
        moved = shuffled(spark, since)[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    linked = {0, *range(400, 406)}
    assert got == {k: (len(t.split()) - 4, 0 if k in linked else k) for k, t in enumerate(texts)}
    whole = 8 * sum(n for n, _ in got.values())
    assert moved < 4 * whole, moved / whole


def test_stored_rows_stay_in_their_buckets(spark):
    """One row of each key and one file of each bucket; a join on the key moves only the other side; release drops the table."""
    rows = spark.range(400).select((F.col("id") % 300).alias("node"), F.concat(F.lit("x" * 50), F.col("id") % 300).alias("bucket"))
    got = common.stored_by(rows, "kept", "node", 5)
    assert sorted(map(tuple, got.collect())) == sorted((k, "x" * 50 + str(k)) for k in range(300))
    files = got.inputFiles()
    assert len(files) == 5
    ids = spark.range(0, 600, 7).withColumnRenamed("id", "node").hint("merge").repartition(5, "node")
    found = got.join(ids, "node", "left_semi")
    assert {r.node for r in found.collect()} == set(range(0, 300, 7))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "ENSURE_REQUIREMENTS" not in plan
    folder = files[0].removeprefix("file:").rsplit("/", 1)[0]
    name = os.path.basename(folder).replace("-", "_")
    assert spark.catalog.tableExists(name)
    common.release(spark)
    assert not spark.catalog.tableExists(name) and not os.path.exists("/" + folder.lstrip("/"))
