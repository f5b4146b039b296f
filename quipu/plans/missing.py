"""Missing values and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from quipu.operators import missing, profile
from quipu.plans import shapes
from quipu.plans.catalog import Tables, query

_WITH = f"WITH {shapes.GAPPY_SQL} "


@query(
    "isna_mask",
    _WITH + "SELECT p_partkey, p_size IS NULL AS p_size, p_retailprice IS NULL AS p_retailprice FROM gappy",
)
def isna_mask(t: Tables):
    return missing.missing_mask(shapes.gappy(t), ["p_partkey"])


@query(
    "null_counts",
    _WITH
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM gappy"
        for c in ("p_partkey", "p_size", "p_retailprice")
    ),
)
def null_counts(t: Tables):
    return profile.null_counts(shapes.gappy(t))


@query("dropna", _WITH + "SELECT * FROM gappy WHERE p_size IS NOT NULL AND p_retailprice IS NOT NULL")
def dropna(t: Tables):
    return shapes.gappy(t).na.drop("any")


@query(
    "fill_const",
    _WITH + "SELECT p_partkey, coalesce(p_size, 0) AS p_size, coalesce(p_retailprice, 0) AS p_retailprice FROM gappy",
)
def fill_const(t: Tables):
    return shapes.gappy(t).na.fill(0)


@query(
    "fill_mean",
    _WITH
    + """SELECT p_partkey, round(coalesce(p_size, (SELECT avg(p_size) FROM gappy)), 6) AS p_size,
         round(coalesce(p_retailprice, (SELECT avg(p_retailprice) FROM gappy)), 6) AS p_retailprice FROM gappy""",
)
def fill_mean(t: Tables):
    filled = missing.fill_mean(shapes.gappy(t), ["p_size", "p_retailprice"])
    return filled.withColumns({c: F.round(c, 6) for c in ("p_size", "p_retailprice")})


@query(
    "fill_per_column",
    _WITH
    + """SELECT p_partkey, round(coalesce(p_size, (SELECT avg(p_size) FROM gappy)), 6) AS p_size,
         coalesce(p_retailprice, (SELECT max(p_retailprice) FROM gappy)) AS p_retailprice FROM gappy""",
)
def fill_per_column(t: Tables):
    filled = missing.fill_with(shapes.gappy(t), {"p_size": "mean", "p_retailprice": "max"})
    return filled.withColumn("p_size", F.round("p_size", 6))


@query(
    "dup_count",
    """SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM
       (SELECT DISTINCT l_partkey, l_linenumber, l_quantity FROM lineitem)) AS duplicates""",
)
def dup_count(t: Tables):
    return missing.duplicate_count(t.lineitem.select("l_partkey", "l_linenumber", "l_quantity"))


@query("drop_dups", "SELECT DISTINCT l_partkey, l_linenumber, l_quantity FROM lineitem")
def drop_dups(t: Tables):
    return missing.drop_duplicates(t.lineitem.select("l_partkey", "l_linenumber", "l_quantity"))


@query(
    "dup_count_wide",
    """SELECT (SELECT count(*) FROM documents) - (SELECT count(*) FROM
       (SELECT DISTINCT text, lang, source, n_chars FROM documents)) AS duplicates""",
)
def dup_count_wide(t: Tables):
    return missing.duplicate_count(t.documents.select("text", "lang", "source", "n_chars"))


@query("drop_dups_wide", "SELECT DISTINCT text, lang, n_chars FROM documents")
def drop_dups_wide(t: Tables):
    return missing.drop_duplicates(t.documents.select("text", "lang", "n_chars"))


@query(
    "find_duplicate",
    """SELECT o_custkey, count(*) AS occurrences, min(o_orderkey) AS first_position FROM orders
       GROUP BY o_custkey HAVING count(*) > 1 ORDER BY first_position LIMIT 1""",
)
def find_duplicate(t: Tables):
    return missing.first_duplicate(t.orders, "o_custkey", "o_orderkey")
