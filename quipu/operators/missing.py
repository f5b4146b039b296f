"""Missing values and duplicate rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.operators.profile import is_missing, numeric_columns
from quipu.storage import is_short, stage

_FILLS = {"mean": F.avg, "max": F.max, "min": F.min, "sum": F.sum}


def missing_mask(df: DataFrame, keys: list[str]) -> DataFrame:
    """True where a value is missing; the key columns are kept as they are."""
    others = [c for c in df.columns if c not in keys]
    return df.select(*keys, *[is_missing(df, c).alias(c) for c in others])


def fill_with(df: DataFrame, how: dict[str, str]) -> DataFrame:
    """Fill each named column with its own mean, max, min or sum.

    All figures come from one aggregate, read back as a scalar subquery.
    """
    present = {c: F.when(~is_missing(df, c), F.col(c)) for c in how}
    figures = df.agg(
        F.struct(*[_FILLS[h](present[c]).alias(c) for c, h in how.items()])
    ).scalar()
    return df.withColumns({c: F.coalesce(present[c], figures.getField(c)) for c in how})


def fill_mean(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return fill_with(df, {c: "mean" for c in columns or numeric_columns(df)})


_FIXED = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz"}
_NARROW = 3  # fixed-width columns: such a row is no wider than its digest


def row_digest(df: DataFrame) -> Column:
    """128 bits of a row's values, with which of them are missing."""
    values = [F.col(f"`{c}`") for c in df.columns]
    flags = [v.isNull() for v in values]
    return F.struct(F.xxhash64(*values, *flags).alias("a"), F.xxhash64(F.lit(1), *flags, *values).alias("b"))


def _repeated_digests(df: DataFrame, digest: Column | None) -> DataFrame | None:
    """Digests that more than one row has; None if rows are narrow, or those digests many, so rows are better dealt whole."""
    if digest is None and len(df.columns) <= _NARROW and all(kind in _FIXED for _, kind in df.dtypes):
        return None
    digests = df.select((row_digest(df) if digest is None else digest).alias("_again"))
    again = stage(digests.groupBy("_again").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_again"), "repeated")
    return F.broadcast(again) if is_short(again) else None


def drop_duplicates(df: DataFrame, digest: Column | None = None) -> DataFrame:
    """One of each set of equal rows.

    Digests are shuffled first. Rows whose digest is their own stay where they are; only
    the others are dealt out whole and compared by value, so a clash of digests loses nothing.
    """
    again = _repeated_digests(df, digest)
    if again is None:
        return df.dropDuplicates()
    same = (row_digest(df) if digest is None else digest) == F.col("_again")
    return df.join(again, same, "left_anti").unionByName(df.join(again, same, "left_semi").dropDuplicates())


def duplicate_count(df: DataFrame, digest: Column | None = None) -> DataFrame:
    """How many rows repeat an earlier one; found as in ``drop_duplicates``."""
    again = _repeated_digests(df, digest)
    if again is not None:
        df = df.join(again, (row_digest(df) if digest is None else digest) == F.col("_again"), "left_semi")
    repeats = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg((F.count(F.lit(1)) - 1).alias("_extra"))
    return repeats.agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("duplicates"))


def first_duplicate(df: DataFrame, value: str, position: str) -> DataFrame:
    """The value that occurs more than once and whose first place is earliest."""
    seen = df.groupBy(value).agg(
        F.count(F.lit(1)).alias("occurrences"), F.min(position).alias("first_position")
    )
    return seen.filter("occurrences > 1").orderBy("first_position").limit(1)


def blank_tokens(df: DataFrame, tokens: list[str], columns: list[str] | None = None) -> DataFrame:
    """Null wherever a text column holds one of the tokens that stand for missing."""

    def cleaned(c: str) -> Column:
        return F.when(~F.col(c).isin(*tokens), F.col(c))

    names = columns or [c for c, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: cleaned(c) for c in names})
