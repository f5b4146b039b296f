"""Group reports and pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.storage import broadcast_if_short


def value_counts(df: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    """Rows per present value: most frequent first and ties by value, or all in order of the value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(column) if by_value else counts.orderBy(F.desc("n"), F.asc(column))


def sales_summary(
    sales: DataFrame,
    zone: str,
    product: str,
    amount: Column,
    zones: DataFrame | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """Sales by zone, sales by product, total sales and number of records.

    ``zones`` and ``products`` map the key column to ``label``; rows without a label are
    left out. The facts are read once and folded per key before the labels are joined,
    so neither a hot key nor the width of the facts reaches a shuffle.
    """
    facts = sales.select(F.col(zone).alias("_zone"), F.col(product).alias("_product"), amount.alias("_amount"))
    sets = facts.groupingSets([["_zone"], ["_product"], []], "_zone", "_product")
    folded = sets.agg(F.sum("_amount").alias("_sum"), F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set"))
    by_zone, by_product, whole = F.col("_set") == 1, F.col("_set") == 2, F.col("_set") == 3
    named = folded
    for labels, key, fact, here, name in (
        (zones, zone, "_zone", by_zone, "_zone_label"), (products, product, "_product", by_product, "_product_label"),
    ):
        if labels is None:
            named = named.withColumn(name, F.col(fact).cast("string"))
        else:
            side = labels.select(F.col(key).alias("_key"), F.col("label").alias(name))
            named = named.join(side, here & (F.col(fact) == F.col("_key")), "left").drop("_key")
    kind = folded.schema["_sum"].dataType
    # The words of the report.
    lines = F.when(by_zone, F.array(_line("_zone_label", "_sum", "Zonas")))
    lines = lines.when(by_product, F.array(_line("_product_label", "_sum", "Productos")))
    records = F.struct(F.lit("Registros").alias("descripcion"), F.col("_n").cast(kind).alias("valor"), F.lit("Resumen").alias("tipo"))
    total = F.struct(F.lit("Venta").alias("descripcion"), F.col("_sum").alias("valor"), F.lit("Resumen").alias("tipo"))
    lines = lines.when(whole, F.array(total, records))
    spread = named.select(F.inline(lines)).filter("descripcion IS NOT NULL")
    # An empty table has no grouping sets, but a total of nothing.
    zero = sales.sparkSession.createDataFrame([("Venta", "Resumen"), ("Registros", "Resumen")], "descripcion string, tipo string")
    zero = zero.select("descripcion", F.lit(0).cast(kind).alias("valor"), "tipo")
    sums = spread.unionByName(zero).groupBy("descripcion", "tipo").agg(F.sum("valor").cast(kind).alias("valor"))
    return sums.select("descripcion", "valor", "tipo")


def _line(label: str, figure: str, kind: str) -> Column:
    return F.struct(F.col(label).alias("descripcion"), F.col(figure).alias("valor"), F.lit(kind).alias("tipo"))


MOST_COLUMNS = 1000  # a wider cross table is refused: its maps hold any number of columns


def _spread(df: DataFrame, column: str, values: list | None, most: int) -> tuple[Column, list[str]]:
    """The label of every row's column value, and all labels in order.

    Without ``values`` the labels are read from the data, at most ``most`` of them. A
    missing value is labelled "null". With ``values`` a row that has another value,
    or none, fails the query instead of being dropped.
    """
    text = F.col(column).cast("string")
    label = F.coalesce(text, F.lit("null"))
    if values is not None:
        unlisted = F.raise_error(F.format_string("value %s of %s is not listed", label, F.lit(column)))
        return F.when(text.isin(*map(str, values)), text).otherwise(unlisted), [str(v) for v in values]
    found = df.select(text.alias("text"), F.col(column).alias("value")).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values; use the maps of pivot_unique_maps or pivot_maps")
    if None in (known := [r["text"] for r in found]) and "null" in known:
        raise ValueError(f"{column} has both missing values and the text 'null'")
    present = sorted((r for r in found if r["text"] is not None), key=lambda r: r["value"])
    return label, [r["text"] for r in present] + ["null"] * (None in known)


def _unique_cells(df: DataFrame, index: str, column: str, label: Column, measures: list[str]) -> DataFrame:
    """(index, _label, measures...), one row per cell; fails if a cell is filled twice."""
    cells = df.groupBy(index, label.alias("_label")).agg(F.count(F.lit(1)).alias("_n"), *[F.first(m).alias(m) for m in measures])
    repeated = F.raise_error(F.format_string("two rows for one cell of %s and %s", F.lit(index), F.lit(column)))
    return cells.select(index, "_label", *[F.when(F.col("_n") > 1, repeated).otherwise(F.col(m)).alias(m) for m in measures])


def pivot_unique(
    df: DataFrame, index: str, column: str, measures: list[str], values: list | None = None, most: int = MOST_COLUMNS
) -> DataFrame:
    """Long to wide without aggregation; fails if a cell is filled twice.

    The columns are the values found, or exactly ``values`` (see ``_spread``).
    """
    label, labels = _spread(df, column, values, most)
    checked = _unique_cells(df, index, column, label, measures)
    firsts = [F.first(m).alias(m) for m in measures]
    return checked.groupBy(index).pivot("_label", labels).agg(*firsts)


def pivot_table(
    df: DataFrame,
    index: str,
    column: str,
    aggregates: list[Column],
    values: list | None = None,
    fill=None,
    most: int = MOST_COLUMNS,
) -> DataFrame:
    """Cross table of aggregates; the columns are the values found, or exactly ``values``."""
    label, labels = _spread(df, column, values, most)
    wide = df.withColumn("_label", label).groupBy(index).pivot("_label", labels).agg(*aggregates)
    return wide if fill is None else wide.na.fill(fill)


def _labelled(df: DataFrame, column: str) -> Column:
    """The label of every row's column value; "null" for a missing one, so that text must not occur as well."""
    text = F.col(column).cast("string")
    clash = df.agg((F.bool_or(text.isNull()) & F.bool_or(F.coalesce(text == "null", F.lit(False)))).alias("clash")).first()["clash"]
    if clash:
        raise ValueError(f"{column} has both missing values and the text 'null'")
    return F.coalesce(text, F.lit("null"))


MOST_LABELS = 100_000  # of one row's maps, about


def _parts(df: DataFrame, index: str, label: Column, most: int) -> DataFrame:
    """(_index, _parts): into how many rows an index with more than about ``most`` labels is cut; no other index is there."""
    counts = df.groupBy(F.col(index).alias("_index")).agg(F.approx_count_distinct(label).alias("_n"))
    return counts.filter(F.col("_n") > most).select("_index", F.ceil(F.col("_n") / most).alias("_parts"))


def _as_maps(cells: DataFrame, index: str, measures: list[str], parts: DataFrame) -> DataFrame:
    """Cells (index, _label, measures...) folded to one row per index: a map from label to value for each measure.

    An index named in ``parts`` gets so many rows, its labels dealt out by their hash, so that a task holds a bounded
    number of cells. All maps of a row have the same labels in the same order.
    """
    keys = [index]
    if not parts.isEmpty():
        cut = cells.join(broadcast_if_short(parts), F.col(index).eqNullSafe(F.col("_index")), "left")
        cells = cut.withColumn("_part", F.pmod(F.xxhash64("_label"), F.coalesce("_parts", F.lit(1))))
        keys = [index, "_part"]
    lists = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_label", *measures))).alias("_cells"))

    def one(measure: str) -> Column:
        return F.map_from_entries(F.transform("_cells", lambda c: F.struct(c["_label"], c[measure]))).alias(measure)

    return lists.select(index, *[one(m) for m in measures])


def pivot_unique_maps(df: DataFrame, index: str, column: str, measures: list[str], most: int = MOST_LABELS) -> DataFrame:
    """``pivot_unique`` for any number of columns: one map per measure, from column label to value.

    A cell that is absent from the data is absent from the map; one that is there without
    a value is null in it. Labels stand in order. An index with more than about ``most``
    labels has several rows, each with other labels.
    """
    label = _labelled(df, column)
    return _as_maps(_unique_cells(df, index, column, label, measures), index, measures, _parts(df, index, label, most))


def pivot_maps(df: DataFrame, index: str, column: str, aggregates: dict[str, Column], most: int = MOST_LABELS) -> DataFrame:
    """``pivot_table`` for any number of columns: one map per named aggregate, from column label to its value.

    Rows, labels and ``most`` as in ``pivot_unique_maps``.
    """
    label = _labelled(df, column)
    cells = df.groupBy(index, label.alias("_label")).agg(*[c.alias(name) for name, c in aggregates.items()])
    return _as_maps(cells, index, list(aggregates), _parts(df, index, label, most))
