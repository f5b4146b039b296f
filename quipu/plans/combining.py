"""Joins, unions and key sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from quipu.operators import combining
from quipu.plans.catalog import Tables, query


def _customers(t: Tables):
    """Every third customer has a key without a partner, and some have none."""
    key = F.expr("nullif(c_nationkey + CASE WHEN c_custkey % 3 = 0 THEN 1000 ELSE 0 END, 3)")
    return t.customer.select("c_custkey", key.alias("nationkey"), "c_acctbal")


def _nations(t: Tables):
    return t.nation.select(F.expr("nullif(n_nationkey, 3)").alias("nationkey"), "n_name")


_SIDES = """WITH c AS (SELECT c_custkey, nullif(c_nationkey + CASE WHEN c_custkey % 3 = 0 THEN 1000 ELSE 0 END, 3) AS nationkey,
        c_acctbal FROM customer),
    n AS (SELECT nullif(n_nationkey, 3) AS nationkey, n_name FROM nation)
    SELECT c_custkey, c.nationkey, c_acctbal, n_name FROM c """


@query("join_inner", _SIDES + "JOIN n ON c.nationkey IS NOT DISTINCT FROM n.nationkey")
def join_inner(t: Tables):
    return combining.merge(_customers(t), _nations(t), ["nationkey"])


@query("join_left", _SIDES + "LEFT JOIN n ON c.nationkey IS NOT DISTINCT FROM n.nationkey")
def join_left(t: Tables):
    return combining.merge(_customers(t), _nations(t), ["nationkey"], "left")


@query(
    "join_large",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, o_custkey, o_orderstatus
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def join_large(t: Tables):
    """Two tables that both grow: left to Spark, which splits skewed partitions."""
    items = t.lineitem.select(
        F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_partkey", "l_extendedprice"
    )
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_custkey", "o_orderstatus")
    return items.join(orders, "orderkey").withColumnRenamed("orderkey", "l_orderkey")


@query(
    "sql_join_group",
    """SELECT n_name AS categoria, count(*) AS total_peliculas FROM nation JOIN customer ON n_nationkey = c_nationkey
       GROUP BY n_name ORDER BY total_peliculas DESC""",
)
def sql_join_group(t: Tables):
    categories = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("categoria"))
    return (
        combining.count_by_label(t.customer, "c_nationkey", categories, "categoria")
        .withColumnRenamed("n", "total_peliculas")
        .orderBy(F.desc("total_peliculas"), "categoria")
    )


@query(
    "concat_rows",
    """SELECT c_custkey AS id, c_name AS nombre, NULL::DOUBLE AS saldo FROM customer
       UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier""",
)
def concat_rows(t: Tables):
    first = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nombre"))
    second = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("saldo"))
    return first.unionByName(second, allowMissingColumns=True)


@query(
    "concat_same",
    """SELECT c_custkey AS id, c_name AS nombre, c_acctbal AS saldo FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""",
)
def concat_same(t: Tables):
    first = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("nombre"), F.col("c_acctbal").alias("saldo")
    )
    second = t.supplier.select(
        F.col("s_acctbal").alias("saldo"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("nombre")
    )
    return first.unionByName(second)


def _sets(t: Tables):
    """Two whole key columns; some keys of each are moved out of the other's range."""
    return (
        t.lineitem.select(F.expr("l_partkey + CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END").alias("k")),
        t.part.select(F.expr("p_partkey * 2").alias("k")),
    )


_A = "SELECT l_partkey + CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END AS k FROM lineitem"
_B = "SELECT p_partkey * 2 AS k FROM part"


@query("set_union", f"{_A} UNION {_B}")
def set_union(t: Tables):
    a, b = _sets(t)
    return a.union(b).distinct()


@query("set_intersect", f"{_A} INTERSECT {_B}")
def set_intersect(t: Tables):
    return combining.intersection(*_sets(t))


@query("set_difference", f"{_A} EXCEPT {_B}")
def set_difference(t: Tables):
    return combining.difference(*_sets(t))


@query("set_dedupe", "SELECT DISTINCT l_suppkey FROM lineitem")
def set_dedupe(t: Tables):
    return t.lineitem.select("l_suppkey").distinct()


@query(
    "membership",
    """SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) AS is_member
       FROM customer""",
)
def membership(t: Tables):
    buyers = t.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return combining.with_membership(t.customer.select("c_custkey"), "c_custkey", buyers, "is_member")
