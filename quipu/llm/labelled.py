"""Labelled documents for fitting, and the split that no model may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.storage import stage

FOLDS = 5
_PARTS = 16  # tasks that a training table is worked on by


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from fitting: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, float | None]:
    """A bounded sample (doc_id, text, label) of the labelled rows outside the held-out fold, and the share of label 1.

    At most ``per_class`` ids of each label are chosen, by a digest of the id, from the
    labels alone; then only their texts are fetched, whole, into a table of the shared folder. Labels
    other than 0 and 1, ids without a text and ids with both labels are left out; of several texts
    with one id the least counts.
    """
    known = labels.select("doc_id", F.col(label).alias("label")).filter("label in (0, 1) and doc_id is not null")
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).filter("label = most")
    known = known.filter(~held_out(F.col("doc_id"))).withColumn("turn", F.md5(F.concat(F.lit("fit:"), F.col("doc_id").cast("string")).cast("binary")))
    share = known.agg(F.avg("label")).first()[0]
    chosen = None
    for value in (0, 1):
        part = known.filter(F.col("label") == value).orderBy("turn", "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("_id"), "label"))  # at most 2 * per_class rows
    texts = docs.select("doc_id", "text").filter("text is not null")
    found = texts.join(chosen, texts["doc_id"] == chosen["_id"]).groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    return stage(found.repartition(_PARTS, "doc_id"), "training"), share


def with_scores(docs: DataFrame, score: Column, threshold: float) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
