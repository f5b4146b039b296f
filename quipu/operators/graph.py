"""Citation graphs held as (src, dst) edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_degree(edges: DataFrame) -> DataFrame:
    """How often each node is pointed at; counts are folded before the shuffle."""
    return edges.groupBy("dst").agg(F.count(F.lit(1)).alias("in_degree"))


def most_cited(edges: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` nodes pointed at most often, ties by the smaller id."""
    return in_degree(edges).orderBy(F.desc("in_degree"), "dst").limit(k)
