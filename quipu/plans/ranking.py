"""Sorting, top rows, ranks and row numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from quipu.operators import ordering
from quipu.plans import shapes
from quipu.plans.catalog import Tables, query

_HOURS = f"WITH {shapes.HOURS_SQL} "


@query("sort_one", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC")
def sort_one(t: Tables):
    return t.customer.select("c_custkey", "c_acctbal").orderBy(F.desc_nulls_last("c_acctbal"))


@query(
    "sort_multi",
    "SELECT c_mktsegment, c_acctbal, c_custkey FROM customer ORDER BY c_mktsegment, c_acctbal DESC",
)
def sort_multi(t: Tables):
    return t.customer.select("c_mktsegment", "c_acctbal", "c_custkey").orderBy(
        F.asc_nulls_last("c_mktsegment"), F.desc_nulls_last("c_acctbal")
    )


@query("sort_values_list", "SELECT l_extendedprice FROM lineitem ORDER BY l_extendedprice")
def sort_values_list(t: Tables):
    return t.lineitem.select("l_extendedprice").orderBy(F.asc_nulls_last("l_extendedprice"))


@query(
    "bottom_city",
    _HOURS
    + """SELECT ciudad, CAST(sum(horas_dia + horas_noche) AS BIGINT) AS horas_totales FROM hours
         GROUP BY ciudad ORDER BY horas_totales, ciudad LIMIT 1""",
)
def bottom_city(t: Tables):
    worked = t.orders.groupBy("o_custkey").agg(
        F.sum(F.floor("o_totalprice") % 41 + F.col("o_orderkey") % 20).alias("horas")
    )
    return (
        worked.join(shapes.people(t), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("ciudad")
        .agg(F.sum("horas").alias("horas_totales"))
        .orderBy("horas_totales", "ciudad")
        .limit(1)
    )


@query(
    "actor_ranking",
    _HOURS
    + """SELECT id, nombre, ciudad, horas_dia + horas_noche AS horas_totales,
         rank() OVER (ORDER BY horas_dia + horas_noche DESC) AS puesto
         FROM hours WHERE horas_dia + horas_noche > 45""",
)
def actor_ranking(t: Tables):
    rows = shapes.hours(t).withColumn("horas_totales", F.col("horas_dia") + F.col("horas_noche"))
    best = rows.filter("horas_totales > 45").select("id", "nombre", "ciudad", "horas_totales")
    return ordering.with_rank(best, "horas_totales", "id", name="puesto")


@query(
    "enumerate_rows",
    """SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS position
       FROM orders""",
)
def enumerate_rows(t: Tables):
    return ordering.with_position(
        t.orders.select("o_orderkey", "o_totalprice"), F.desc("o_totalprice"), F.col("o_orderkey")
    )


@query(
    "enumerate_in_group",
    """SELECT o_orderkey, o_orderstatus, row_number() OVER
       (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) - 1 AS position FROM orders""",
)
def enumerate_in_group(t: Tables):
    return ordering.with_position(
        t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"),
        F.col("o_totalprice"),
        F.col("o_orderkey"),
        by=["o_orderstatus"],
    ).drop("o_totalprice")
