"""Joins and key sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Inner or left join in which missing keys match missing keys; key columns come once.

    Spark chooses the join by the sizes it sees and splits skewed partitions.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"{how} joins would lose the keys of the right side; swap the sides")
    side = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in on], *[c for c in right.columns if c not in on]
    )
    same = F.lit(True)
    for k in on:
        same = same & left[k].eqNullSafe(side[f"_right_{k}"])
    return left.join(side, same, how).drop(*[f"_right_{k}" for k in on])


def count_by_label(facts: DataFrame, key: str, labels: DataFrame, label: str) -> DataFrame:
    """Rows per label, counted per key before the join."""
    counted = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return (
        counted.join(labels.select(key, label), key)
        .groupBy(label)
        .agg(F.sum("_n").alias("n"))
    )


def with_membership(df: DataFrame, key: str, members: DataFrame, name: str) -> DataFrame:
    """True where the key is among the members' keys."""
    known = members.select(F.col(key).alias("_member")).distinct()
    return (
        df.join(known, df[key] == known["_member"], "left")
        .withColumn(name, F.col("_member").isNotNull())
        .drop("_member")
    )


def _both(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """The different rows of ``a``, with ``_found`` where ``b`` has them too.

    Repeats are folded by each task before the join, so a hot key is one row. Semi and
    anti joins would be moved below that fold by the optimizer, so none is used.
    """
    left = a.distinct()
    side = b.toDF(*[f"_right_{c}" for c in b.columns]).distinct().withColumn("_found", F.lit(True))
    same = F.lit(True)
    for mine, other in zip(left.columns, side.columns):
        same = same & left[mine].eqNullSafe(side[other])
    return left.join(side, same, how).select(*[left[c] for c in left.columns], "_found")


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both tables, once; missing values equal each other."""
    return _both(a, b, "inner").drop("_found")


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of the first table that the second lacks, once; missing values equal each other."""
    return _both(a, b, "left").filter("_found IS NULL").drop("_found")


def most(df: DataFrame, figure: str) -> DataFrame:
    """All rows that share the largest figure."""
    return df.filter(F.col(figure) == df.agg(F.max(figure)).scalar())
