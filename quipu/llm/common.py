"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.operators.ordering import PART, SLOT, attach, part_totals, range_sorted

SPACE = r"\x20\x09-\x0D"


def word_count(text: Column) -> Column:
    """Number of runs of characters other than blank and 0x09-0x0D; 0 for null."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]*+[^{SPACE}]++[{SPACE}]*+", ".")
    return F.length(F.translate(marks, " \t\n\x0b\x0c\r", "")).cast("bigint")


def packed(df: DataFrame) -> Column:
    """All columns of a row in one struct, so that no name of theirs can meet a working column."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def earlier_total(df: DataFrame, by: list[str], order: list[Column], weight: str, name: str) -> DataFrame:
    """``df`` with the sum of ``weight`` over the earlier rows of its ``by`` key, in ``order``.

    Rows are range-sorted, so a key with a third of all rows is shared by many tasks;
    only one total per sorted partition and key is accumulated.
    """
    stored = range_sorted(df, *[F.col(k).asc_nulls_last() for k in by], *order)
    totals = part_totals(stored, by, F.col(weight)).select(PART, *by, "_earlier")
    before = Window.partitionBy(PART, *by).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    inside = stored.withColumn("_inside", F.coalesce(F.sum(weight).over(before), F.lit(0)))
    return attach(inside, totals, by).select(*df.columns, (F.col("_earlier") + F.col("_inside")).cast("bigint").alias(name))
