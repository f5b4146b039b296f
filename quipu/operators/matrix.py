"""Matrices and pixel tables as (i, j, v) cells.

Means, sorts, slices that are set and functions of single cells take the cells that are
there; ``filled`` adds the absent ones of a matrix as zeros. ``eye`` and ``from_diagonal``
store only their diagonal. Sums, products, ``elementwise`` and ``with_vector`` count an
absent cell as zero by themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.operators.ordering import with_position


def cells(df: DataFrame, row: str, values: str) -> DataFrame:
    """Cells of a table that holds one array per row."""
    spread = df.select(F.col(row).alias("i"), F.posexplode(values).alias("j", "v"))
    return spread.select("i", F.col("j").cast("bigint").alias("j"), F.col("v").cast("double").alias("v"))


def extent(a: DataFrame) -> tuple[int, int]:
    """Rows and columns, from the largest indexes."""
    top = a.agg(F.max("i").alias("i"), F.max("j").alias("j")).first()
    return (0, 0) if top is None or top["i"] is None else (top["i"] + 1, top["j"] + 1)


def full(spark: SparkSession, rows: int, columns: int, value: float) -> DataFrame:
    """Every cell with the same value: zeros, ones."""
    return spark.range(rows * columns).select(
        F.floor(F.col("id") / columns).alias("i"), (F.col("id") % columns).alias("j"), F.lit(float(value)).alias("v")
    )


def filled(a: DataFrame, rows: int, columns: int) -> DataFrame:
    """Every cell of a matrix of that shape; absent ones are zero."""
    grid = a.sparkSession.range(rows).select(
        F.col("id").alias("i"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(columns - 1).cast("bigint"))).alias("j")
    )
    return grid.join(a, ["i", "j"], "left").select("i", "j", F.coalesce("v", F.lit(0.0)).alias("v"))


def eye(spark: SparkSession, n: int, dense: bool = False) -> DataFrame:
    """Identity matrix; its zeros are rows only if ``dense``."""
    if dense:
        return full(spark, n, n, 0.0).withColumn("v", (F.col("i") == F.col("j")).cast("double"))
    return spark.range(n).select(F.col("id").alias("i"), F.col("id").alias("j"), F.lit(1.0).alias("v"))


def elementwise(a: DataFrame, b: DataFrame, op: Callable[[Column, Column], Column]) -> DataFrame:
    """``op`` on the cells at the same place; one that only one side has meets a zero.

    Cells absent on both sides stay absent, so fill them where ``op(0, 0)`` is not zero.
    """
    other = b.withColumnRenamed("v", "_w")
    v, w = F.coalesce("v", F.lit(0.0)), F.coalesce("_w", F.lit(0.0))
    return a.join(other, ["i", "j"], "full").select("i", "j", op(v, w).alias("v"))


def with_vector(a: DataFrame, vector: DataFrame, op: Callable[[Column, Column], Column]) -> DataFrame:
    """``op`` on every cell and the entry of a (j, v) vector in its column, zero if absent.

    Spark broadcasts the vector or joins by shuffle, by the size it finds.
    """
    other = vector.select("j", F.col("v").alias("_w"))
    return a.join(other, "j", "left").select("i", "j", op(F.col("v"), F.coalesce("_w", F.lit(0.0))).alias("v"))


def take(a: DataFrame, rows: slice = slice(None), columns: slice = slice(None)) -> DataFrame:
    """Rows and columns from start to before stop, counted from zero again."""
    if min(rows.start or 0, rows.stop or 0, columns.start or 0, columns.stop or 0) < 0 or rows.step or columns.step:
        raise ValueError("slices of cells start and stop at places from 0, without a step")
    out = a
    for axis, part in (("i", rows), ("j", columns)):
        if part.start:
            out = out.filter(F.col(axis) >= part.start)
        if part.stop is not None:
            out = out.filter(F.col(axis) < part.stop)
    return out.select(
        (F.col("i") - (rows.start or 0)).alias("i"), (F.col("j") - (columns.start or 0)).alias("j"), "v"
    )


def assign_rows(a: DataFrame, start: int, stop: int, value: float | DataFrame) -> DataFrame:
    """Rows start to before stop set to a number, or to the cells of a table."""
    inside = (F.col("i") >= start) & (F.col("i") < stop)
    if not isinstance(value, DataFrame):
        return a.withColumn("v", F.when(inside, F.lit(float(value))).otherwise(F.col("v")))
    return a.filter(~inside).unionByName(value.filter(inside).select("i", "j", "v"))


def reshape(a: DataFrame, columns: int, new_columns: int) -> DataFrame:
    """The same cells in row order, laid out with another row length."""
    flat = F.col("i") * columns + F.col("j")
    return a.select(F.floor(flat / new_columns).alias("i"), (flat % new_columns).alias("j"), "v")


def transpose(a: DataFrame) -> DataFrame:
    return a.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def sort_axis(a: DataFrame, axis: int = 1) -> DataFrame:
    """Values sorted within each row (axis 1) or column (axis 0).

    A long row or column is sorted by many tasks.
    """
    fixed, moved = ("i", "j") if axis == 1 else ("j", "i")
    placed = with_position(a, F.col("v"), F.col(moved), by=[fixed], name="_place")
    return placed.select(F.col(fixed), F.col("_place").alias(moved), "v").select("i", "j", "v")


def _blocks(a: DataFrame, block: int, names: tuple[str, str]) -> DataFrame:
    """The non-zero cells packed by block: places inside it and values, as two arrays."""
    row, column = (F.floor(F.col(c) / block) for c in ("i", "j"))
    place = ((F.col("i") % block) * block + F.col("j") % block).cast("int")
    cells = a.filter("v <> 0").select(row.alias(names[0]), column.alias(names[1]), F.struct(place.alias("at"), "v").alias("cell"))
    packed = cells.groupBy(*names).agg(F.collect_list("cell").alias("cells"))  # at most block * block
    return packed.select(*names, F.col("cells.at").alias(f"{names[0]}_at"), F.col("cells.v").alias(f"{names[0]}_v"))


TILE = 4  # row blocks and column blocks of one grid cell
INNER = 64  # inner blocks that a grid cell adds up


def _groups(blocks: DataFrame, name: str, size: int) -> int:
    """How many groups of ``size`` blocks reach to the last one along ``name``."""
    last = blocks.agg(F.max(name)).first()[0]
    return 0 if last is None else int(last) // size + 1


def grid_cells(a: DataFrame, b: DataFrame, block: int = 256, tile: int = TILE, inner: int = INNER) -> DataFrame:
    """The blocks of both factors, dealt to the cells of a (row, column, inner) grid of block groups.

    Rows (gi, gj, gk, bk, side, at_block, at, v): a block of the left factor is copied once
    for each group of column blocks, one of the right factor once for each group of row
    blocks, as counted from the shapes. A cell has at most ``2 * tile * inner`` blocks.
    """
    left, right = _blocks(a, block, ("bi", "bk")), _blocks(b, block, ("bk", "bj"))
    across, down = _groups(right, "bj", tile), _groups(left, "bi", tile)

    def copies(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>") if n else F.array().cast("array<bigint>"))

    place = ["gi", "gj", F.floor(F.col("bk") / inner).alias("gk"), "bk"]
    left = left.select("*", F.floor(F.col("bi") / tile).alias("gi"), copies(across).alias("gj"))
    right = right.select("*", F.floor(F.col("bj") / tile).alias("gj"), copies(down).alias("gi"))
    left = left.select(*place, F.lit(0).alias("side"), F.col("bi").alias("at_block"), F.col("bi_at").alias("at"), F.col("bi_v").alias("v"))
    right = right.select(*place, F.lit(1).alias("side"), F.col("bj").alias("at_block"), F.col("bk_at").alias("at"), F.col("bk_v").alias("v"))
    return left.unionByName(right)


def multiply(a: DataFrame, b: DataFrame, block: int = 256, tile: int = TILE, inner: int = INNER) -> DataFrame:
    """Matrix product by blocks on a grid.

    Cells are packed into square blocks before anything is copied. A task works off the
    cells of the grid one by one: inner block for inner block it multiplies the few left
    and right blocks there are and adds the products up, so it holds no more than
    ``2 * tile`` blocks and ``tile * tile`` sums. No key has more than a grid cell's
    blocks, however long the inner side or however short. Zeros of the product are left out.
    """

    def grid(at, v) -> np.ndarray:
        out = np.zeros(block * block)
        np.add.at(out, np.asarray(at), np.asarray(v))
        return out.reshape(block, block)

    def written(sums: dict[tuple[int, int], np.ndarray]) -> Iterator[pd.DataFrame]:
        for (bi, bj), out in sums.items():
            r, c = np.nonzero(out)
            yield pd.DataFrame({"i": bi * block + r, "j": bj * block + c, "v": out[r, c]})

    def product(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, bk, held, sums = None, None, [], {}
        for part in parts:
            for row in part.itertuples(index=False):
                if (row.gi, row.gj, row.gk) != cell:
                    yield from written(sums)
                    cell, bk, sums = (row.gi, row.gj, row.gk), None, {}
                if row.bk != bk:
                    bk, held = row.bk, []
                if not row.side:  # left blocks come first
                    held.append((row.at_block, grid(row.at, row.v)))
                elif held:
                    right = grid(row.at, row.v)
                    for bi, left in held:
                        key = (bi, row.at_block)
                        sums[key] = sums[key] + left @ right if key in sums else left @ right
        yield from written(sums)

    cells = grid_cells(a, b, block, tile, inner)
    dealt = cells.repartition("gi", "gj", "gk").sortWithinPartitions("gi", "gj", "gk", "bk", "side", "at_block")
    parts = dealt.mapInPandas(product, "i bigint, j bigint, v double")
    return parts.groupBy("i", "j").agg(F.sum("v").alias("v")).filter("v <> 0")


def diagonal(a: DataFrame) -> DataFrame:
    return a.filter("i = j").select("i", "v")


def from_diagonal(vector: DataFrame) -> DataFrame:
    """Square matrix with an (i, v) vector on its diagonal."""
    return vector.select("i", F.col("i").alias("j"), "v")


def trace(a: DataFrame) -> DataFrame:
    return a.filter("i = j").agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias("trace"))


def gray_mean(pixels: DataFrame) -> DataFrame:
    """Mean over the channels of every pixel of (img, y, x, channel, v) rows."""
    return pixels.groupBy("img", "y", "x").agg(F.avg("v").alias("v"))
