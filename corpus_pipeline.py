"""The corpus pipeline: quality, near-duplicate join, repeated bytes, decontamination, packing.

Each stage takes (spark, docs, sf_dir), returns a DataFrame, and works on all that the stage before
kept; run() writes each result as Parquet to the shared folder and reads it for the next. Stages add
their own columns under names that docs does not have, so any further column passes through; only doc_id and
text must be there. Where rows must be told apart they are numbered once, in a stored copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallmark.llm import decontamination, packing, quality, set_join, suffix_dedup
from stallmark.llm.common import broadcast_if_small, free_name, named, table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects (score below quality.THRESHOLD).

    Defined cases: null and empty texts are judged as texts of no words; rows without an id and repeated rows
    are judged each by its text, so equal texts share their fate; a text of any length is read whole; an
    empty table stays empty; without labels of both kinds every row gets the smoothed share of good labels.
    """
    to = free_name(docs, "quality_score")
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")), keep_text=True, to=to)
    return scored.where(F.col(to) >= quality.THRESHOLD).select(*(named(c) for c in docs.columns))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked documents: the one with the smallest id.

    Defined cases: null and empty texts link with nothing and stay; a row without an id takes part, but stays only
    if its whole group has none; of rows with the smallest id (repeated rows) the first one stays; texts
    of any length are compared whole; an empty table stays empty.
    """
    row = free_name(docs, "row")
    keyed = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")  # one number, whatever reads it and however often
    found = written(set_join.jaccard_components(keyed.select(F.col(row).alias("doc_id"), "text")), "components")
    linked = found.where("component_id < doc_id").select(F.col("doc_id").alias("member"), F.col("component_id").alias("in_group"))
    linked = linked.unionByName(linked.select(F.col("in_group").alias("member"), "in_group").distinct())
    ids = keyed.select(F.col(row).alias("member"), F.col("doc_id").cast("long").alias("id"))
    linked = written(linked.join(ids, "member"), "linked")
    stays = linked.groupBy("in_group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "member")).alias("first"))
    drop = written(linked.select("member").join(stays.select(F.col("first.member").alias("member")), "member", "left_anti"), "near")
    few = broadcast_if_small(drop.withColumnRenamed("member", row), drop.count(), decontamination.BROADCAST_ROWS)
    return keyed.join(few, row, "left_anti").select(*(named(c) for c in docs.columns))


def repeated_bytes_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts byte strings that a document with a smaller id holds; n_chars, where there is one, follows the text.

    Defined cases: a null text stays null and an empty one empty; rows without an id stay as they are and cut nothing;
    rows of one id do not count against each other; texts below suffix_dedup.LENGTH bytes stay; bytes of cut
    characters go too; texts of any length are read whole; an empty table stays empty.
    """
    out = suffix_dedup.without_repeats(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*(named(c) for c in docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold benchmark items.

    Defined cases: null and empty texts hold none; rows without an id are not looked at and stay; rows of one id count
    as one document and go together; texts of any length are read whole; an empty table (or benchmark)
    leaves all as it is.
    """
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokens of what is left: a row for each piece, with its sequence and place.

    Defined cases: a null text is empty, one end id; rows without an id and repeated rows are packed as rows of their
    own; texts of any length are tokenised whole and cut into pieces; an empty table packs to none; further
    columns are left out.
    """
    return packing.best_fit(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("suffix-array dedup", repeated_bytes_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: SQL cannot express the classifier or the packing; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
