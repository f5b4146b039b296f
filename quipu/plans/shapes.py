"""Tables shaped like everyday inputs, derived from the standard tables.

Each DataFrame has its SQL twin, so queries and checks start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.plans.catalog import Tables


def hours(t: Tables) -> DataFrame:
    """Hours worked: one row per order, with the person, city and region."""
    worked = t.orders.select(
        F.col("o_orderkey").alias("id"),
        "o_custkey",
        (F.floor("o_totalprice") % 41).alias("horas_dia"),
        (F.col("o_orderkey") % 20).alias("horas_noche"),
    )
    return (
        worked.join(people(t), worked["o_custkey"] == F.col("c_custkey"))
        .select("id", "nombre", "ciudad", "region", "horas_dia", "horas_noche")
    )


def people(t: Tables) -> DataFrame:
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "c_custkey",
            F.col("c_name").alias("nombre"),
            F.col("n_name").alias("ciudad"),
            F.col("r_name").alias("region"),
        )
    )


HOURS_SQL = """hours AS (
    SELECT o_orderkey AS id, c_name AS nombre, n_name AS ciudad, r_name AS region,
           CAST(floor(o_totalprice) AS BIGINT) % 41 AS horas_dia, o_orderkey % 20 AS horas_noche
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def zones(t: Tables) -> DataFrame:
    """Zone of every supplier."""
    return (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("l_suppkey"), F.col("r_name").alias("label"))
    )


def products(t: Tables) -> DataFrame:
    """Product of every part."""
    return t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("label"))


def gappy(t: Tables) -> DataFrame:
    """Parts with missing sizes and prices."""
    return t.part.select(
        "p_partkey",
        F.expr("nullif(p_size, 11)").alias("p_size"),
        F.expr("CASE WHEN p_brand <> 'Brand#7' THEN p_retailprice END").alias("p_retailprice"),
    )


GAPPY_SQL = """gappy AS (
    SELECT p_partkey, nullif(p_size, 11) AS p_size,
           CASE WHEN p_brand <> 'Brand#7' THEN p_retailprice END AS p_retailprice FROM part)"""


def passengers(t: Tables) -> DataFrame:
    """Labelled documents seen as passengers: outcome, class, group, size."""
    return t.labels.join(t.documents, "doc_id").select(
        "doc_id",
        F.col("quality").alias("survived"),
        F.col("source").alias("pclass"),
        F.col("lang").alias("sex"),
        F.when(F.col("toxic") == 0, F.col("n_chars").cast("double")).alias("age"),
    )


PASSENGERS_SQL = """passengers AS (
    SELECT doc_id, quality AS survived, source AS pclass, lang AS sex,
           CASE WHEN toxic = 0 THEN CAST(n_chars AS DOUBLE) END AS age
    FROM labels JOIN documents USING (doc_id))"""


def sellers(t: Tables) -> DataFrame:
    """Offers as text, with a flag in mixed case and blank prices."""
    return t.lineitem.select(
        F.expr("CASE l_returnflag WHEN 'A' THEN 'Best Seller' WHEN 'R' THEN 'BEST SELLER' ELSE 'No badge' END").alias("is_best_seller"),
        F.expr("CASE WHEN l_discount = 0 THEN '' ELSE CAST(l_extendedprice AS STRING) END").alias("original_price"),
        F.col("l_quantity").cast("string").alias("product_rating"),
    )


SELLERS_SQL = """sellers AS (
    SELECT CASE l_returnflag WHEN 'A' THEN 'Best Seller' WHEN 'R' THEN 'BEST SELLER' ELSE 'No badge' END AS is_best_seller,
           CASE WHEN l_discount = 0 THEN '' ELSE CAST(l_extendedprice AS VARCHAR) END AS original_price,
           CAST(l_quantity AS VARCHAR) AS product_rating FROM lineitem)"""


def rides(t: Tables) -> DataFrame:
    """Rides as text, where the word null marks a missing figure."""
    return t.orders.select(
        "o_orderkey",
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Cancelled' ELSE 'Incomplete' END").alias("booking_status"),
        F.expr("CASE WHEN o_orderpriority = '5-LOW' THEN 'null' ELSE CAST(o_totalprice AS STRING) END").alias("booking_value"),
        F.expr("CASE WHEN o_totalprice < 20000 THEN 'null' ELSE CAST(o_custkey AS STRING) END").alias("ride_distance"),
        F.expr("CASE WHEN o_orderdate >= '2000-01-01' THEN 'null' ELSE CAST(month(o_orderdate) AS STRING) END").alias("driver_ratings"),
    )


RIDES_SQL = """rides AS (
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Cancelled' ELSE 'Incomplete' END AS booking_status,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'null' ELSE CAST(o_totalprice AS VARCHAR) END AS booking_value,
           CASE WHEN o_totalprice < 20000 THEN 'null' ELSE CAST(o_custkey AS VARCHAR) END AS ride_distance,
           CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'null' ELSE CAST(month(o_orderdate) AS VARCHAR) END AS driver_ratings
    FROM orders)"""
RIDE_FIGURES = ["booking_value", "ride_distance", "driver_ratings"]
