"""Array arithmetic on the embedding matrix: one row per vector, 64 columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from quipu.operators import matrix
from quipu.plans.catalog import Tables, query

_CELLS = """cells AS (SELECT vec_id AS i, CAST(place - 1 AS BIGINT) AS j, CAST(embedding[place] AS DOUBLE) AS v
    FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS place FROM embeddings))"""
_WITH = f"WITH {_CELLS} "


def _cells(t: Tables):
    return matrix.cells(t.embeddings, "vec_id", "embedding")


def _filled(t: Tables):
    """The matrix without its negative cells, which are then filled by zeros."""
    present = _cells(t).filter("v >= 0")
    return matrix.filled(present, t.embeddings.agg(F.max("vec_id")).first()[0] + 1, 64)


_FILLED = _WITH.replace("cells AS", "all_cells AS") + ", cells AS (SELECT i, j, CASE WHEN v >= 0 THEN v ELSE 0.0 END AS v FROM all_cells) "


def _weights(t: Tables):
    """A vector of one weight per column."""
    return _cells(t).groupBy("j").agg(F.round(F.max("v"), 4).alias("v"))


_WEIGHTS = ", weights AS (SELECT j, round(max(v), 4) AS v FROM cells GROUP BY j) "


@query(
    "mat_elementwise",
    _WITH + _WEIGHTS
    + """, b AS (SELECT i, j, c.v, CASE WHEN c.v >= 0 THEN c.v * w.v ELSE 0.0 END AS w FROM cells c JOIN weights w USING (j))
         SELECT i, j, round(v + w, 12) + 0.0 AS added, round(v * w, 12) + 0.0 AS multiplied, v > w AS larger FROM b""",
)
def mat_elementwise(t: Tables):
    a = _cells(t)
    b = matrix.with_vector(a.filter("v >= 0"), _weights(t), lambda v, w: v * w)  # absent cells count as zero
    both = matrix.elementwise(a, b, lambda v, w: F.struct(v.alias("v"), w.alias("w")))
    v, w = F.col("v.v"), F.col("v.w")
    return both.select(
        "i", "j",
        (F.round(v + w, 12) + F.lit(0.0)).alias("added"),
        (F.round(v * w, 12) + F.lit(0.0)).alias("multiplied"),
        (v > w).alias("larger"),
    )


@query("mat_scalar", _WITH + "SELECT i, j, v * 5 AS times_five, sqrt(abs(v)) AS root FROM cells")
def mat_scalar(t: Tables):
    v = F.col("v")
    return _cells(t).select("i", "j", (v * 5).alias("times_five"), F.sqrt(F.abs(v)).alias("root"))


@query("mat_broadcast", _FILLED + _WEIGHTS + "SELECT i, j, c.v + w.v AS v FROM cells c JOIN weights w USING (j)")
def mat_broadcast(t: Tables):
    return matrix.with_vector(_filled(t), _weights(t), lambda v, w: v + w)


@query("mat_slice", _WITH + "SELECT i - 10 AS i, j - 1 AS j, v FROM cells WHERE i >= 10 AND j >= 1 AND j < 33")
def mat_slice(t: Tables):
    return matrix.take(_cells(t), slice(10, None), slice(1, 33))


@query(
    "mat_assign_slice",
    _FILLED + "SELECT i, j, CASE WHEN i >= 5 AND i < 8 THEN 0 WHEN i >= 20 AND i < 30 THEN v * 2 ELSE v END AS v FROM cells",
)
def mat_assign_slice(t: Tables):
    a = _filled(t)
    zeroed = matrix.assign_rows(a, 5, 8, 0.0)
    return matrix.assign_rows(zeroed, 20, 30, a.withColumn("v", F.col("v") * 2))


@query("mat_reshape", _WITH + "SELECT (i * 64 + j) // 16 AS i, (i * 64 + j) % 16 AS j, v FROM cells")
def mat_reshape(t: Tables):
    return matrix.reshape(_cells(t), 64, 16)


@query("mat_transpose", _WITH + "SELECT j AS i, i AS j, v FROM cells")
def mat_transpose(t: Tables):
    return matrix.transpose(_cells(t))


@query(
    "mat_reduce",
    _FILLED + "SELECT round(avg(v), 9) + 0.0 AS mean, round(sum(v), 6) + 0.0 AS total, min(v) AS low, max(v) AS high FROM cells",
)
def mat_reduce(t: Tables):
    return _filled(t).agg(
        (F.round(F.avg("v"), 9) + F.lit(0.0)).alias("mean"),
        (F.round(F.sum("v"), 6) + F.lit(0.0)).alias("total"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
    )


@query("mat_row_mean", _FILLED + "SELECT i, round(avg(v), 9) + 0.0 AS v FROM cells GROUP BY i")
def mat_row_mean(t: Tables):
    return _filled(t).groupBy("i").agg((F.round(F.avg("v"), 9) + F.lit(0.0)).alias("v"))


@query("mat_col_mean", _FILLED + "SELECT j, round(avg(v), 9) + 0.0 AS v FROM cells GROUP BY j")
def mat_col_mean(t: Tables):
    return _filled(t).groupBy("j").agg((F.round(F.avg("v"), 9) + F.lit(0.0)).alias("v"))


@query("mat_sort_axis", _FILLED + "SELECT i, row_number() OVER (PARTITION BY i ORDER BY v) - 1 AS j, v FROM cells")
def mat_sort_axis(t: Tables):
    return matrix.sort_axis(_filled(t), 1)


@query("mat_sort_columns", _FILLED + "SELECT row_number() OVER (PARTITION BY j ORDER BY v) - 1 AS i, j, v FROM cells")
def mat_sort_columns(t: Tables):
    return matrix.sort_axis(_filled(t), 0)


@query(
    "matmul",
    _WITH
    + """SELECT a.j AS i, b.j AS j, round(sum(a.v * b.v), 9) + 0.0 AS v
         FROM cells a JOIN cells b ON a.i = b.i GROUP BY a.j, b.j""",
)
def matmul(t: Tables):
    """The transposed matrix times the matrix: the inner side grows with the table."""
    a = _cells(t)
    product = matrix.multiply(matrix.transpose(a), a)
    return product.withColumn("v", F.round("v", 9) + F.lit(0.0))


@query("mat_trace", _WITH + "SELECT round(sum(v), 9) AS trace FROM cells WHERE i = j")
def mat_trace(t: Tables):
    return matrix.trace(_cells(t)).withColumn("trace", F.round("trace", 9))


@query("mat_diag", _WITH + "SELECT i, i AS j, v FROM cells WHERE i = j")
def mat_diag(t: Tables):
    return matrix.from_diagonal(matrix.diagonal(_cells(t)))


@query(
    "gray_mean",
    _FILLED
    + """SELECT i AS img, j // 12 AS y, (j % 12) // 3 AS x, round(avg(v), 9) + 0.0 AS v
         FROM cells GROUP BY ALL""",
)
def gray_mean(t: Tables):
    """Vectors seen as images four pixels wide with three channels."""
    j = F.col("j")
    pixels = _filled(t).select(
        F.col("i").alias("img"),
        F.floor(j / 12).alias("y"),
        F.floor((j % 12) / 3).alias("x"),
        (j % 3).alias("channel"),
        "v",
    )
    return matrix.gray_mean(pixels).withColumn("v", F.round("v", 9) + F.lit(0.0))
