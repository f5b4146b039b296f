"""Shape, types, counts and summary statistics of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.operators.quantiles import summaries


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating column."""
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.col(column).isNull() | F.isnan(column)
    return F.col(column).isNull()


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def one_row_per_column(df: DataFrame, **facts) -> DataFrame:
    """One aggregate over the table, laid out as a row per column.

    Each fact maps a column name to an aggregate or to a literal.
    """
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[make(c).alias(f) for f, make in facts.items()])
            for c in df.columns
        ]
    )
    return df.agg(rows.alias("_rows")).select(F.inline("_rows"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def schema_info(df: DataFrame) -> DataFrame:
    """Name, type and number of present values of every column."""
    kinds = dict(df.dtypes)
    return one_row_per_column(
        df, type=lambda c: F.lit(kinds[c]), non_null=lambda c: F.count_if(~is_missing(df, c))
    )


def null_counts(df: DataFrame) -> DataFrame:
    return one_row_per_column(df, missing=lambda c: F.count_if(is_missing(df, c)))


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


def _value_slots(df: DataFrame, column: str) -> list[Column] | None:
    """A present value as (whole number, double, text), two of them null; None for nested types."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    none = [F.lit(None).cast("bigint"), F.lit(None).cast("double"), F.lit(None).cast("string")]
    if isinstance(kind, _WHOLE):
        return [value.cast("bigint"), *none[1:]]
    if isinstance(kind, T.DateType):
        return [F.unix_date(value).cast("bigint"), *none[1:]]
    if isinstance(kind, T.TimestampType):
        return [F.unix_micros(value), *none[1:]]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return [none[0], value.cast("double"), none[2]]
    if isinstance(kind, (T.StringType, T.DecimalType, T.TimestampNTZType)):
        return [*none[:2], value.cast("string")]
    return [*none[:2], F.hex(value)] if isinstance(kind, T.BinaryType) else None


def nunique(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct present values of every column.

    All columns but nested ones are folded at once over (column number, value), by each
    task before the one shuffle.
    """

    def present(c: str) -> Column:
        return F.when(~is_missing(df, c), F.col(f"`{c}`"))

    slots = {} if approximate else {i: s for i, c in enumerate(df.columns) if (s := _value_slots(df, c))}
    names = ("column", "whole", "real", "text")
    cells = [
        F.when(~is_missing(df, df.columns[i]), F.struct(*[v.alias(name) for v, name in zip([F.lit(i), *s], names)])) for i, s in slots.items()
    ]
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    rest = [distinct(present(c)).alias(str(i)) for i, c in enumerate(df.columns) if i not in slots]
    parts = [df.agg(*rest)] if rest else []
    if cells:
        values = df.select(F.explode(F.array_compact(F.array(*cells))).alias("cell")).select("cell.*").distinct()
        parts.append(values.agg(*[F.count_if(F.col("column") == i).alias(str(i)) for i in slots]))
    counts = parts[0] if len(parts) == 1 else parts[0].select("*", *[parts[1].select(f"`{c}`").scalar().alias(c) for c in parts[1].columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{i}`").alias("n_distinct")) for i, c in enumerate(df.columns)]
    return counts.select(F.inline(F.array(*rows)))


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of numeric columns."""
    columns = columns or numeric_columns(df)
    found = summaries(df, columns, [0.25, 0.5, 0.75]).withColumnRenamed("column", "column_name")
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return every.join(F.broadcast(found), "column_name", "left").withColumn("count", F.coalesce("count", F.lit(0)))


def with_total(df: DataFrame, column: str, name: str) -> DataFrame:
    """The sum of a whole column, repeated on every row."""
    return df.withColumn(name, df.agg(F.coalesce(F.sum(column), F.lit(0))).scalar())


def with_share(df: DataFrame, column: str, name: str) -> DataFrame:
    """Each value as a share of the column's sum; null when the sum is zero."""
    return df.withColumn(name, F.try_divide(F.col(column), df.agg(F.sum(column)).scalar()))
