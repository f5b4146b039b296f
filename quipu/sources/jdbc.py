"""Tables of a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A table or a bracketed query. Filters and aggregates are pushed to the database.

    With a numeric ``split_on`` column and its bounds, ``partitions`` tasks read
    separate ranges; without them a single connection reads everything.
    """
    if split_on is None:
        return spark.read.jdbc(url, table, properties=properties)
    if bounds is None:
        raise ValueError("split_on needs the column's bounds")
    return spark.read.jdbc(
        url,
        table,
        column=split_on,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=partitions,
        properties=properties,
    )


def read_query(spark: SparkSession, url: str, sql: str, properties: dict[str, str]) -> DataFrame:
    """The result of a query that the database runs."""
    return spark.read.jdbc(url, f"({sql}) AS q", properties=properties)
