"""Aggregates, group reports and pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from quipu.operators import combining, grouping
from quipu.plans import shapes
from quipu.plans.catalog import Tables, query
from quipu.plans.profile import completed_rides, only_best_sellers

_HOURS = f"WITH {shapes.HOURS_SQL} "
_PASSENGERS = f"WITH {shapes.PASSENGERS_SQL} "


@query(
    "agg_global",
    """SELECT round(avg(l_quantity), 6) AS mean, CAST(sum(l_quantity) AS DOUBLE) AS total, min(l_quantity) AS low,
       max(l_quantity) AS high, count(*) AS n FROM lineitem""",
)
def agg_global(t: Tables):
    return t.lineitem.agg(
        F.round(F.avg("l_quantity"), 6).alias("mean"),
        F.coalesce(F.sum("l_quantity"), F.lit(0.0)).alias("total"),
        F.min("l_quantity").alias("low"),
        F.max("l_quantity").alias("high"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "avg_empty_zero",
    """SELECT round(coalesce(avg(l_tax), 0), 6) AS every_row,
       coalesce(avg(CASE WHEN l_quantity < 0 THEN l_tax END), 0) AS no_row FROM lineitem""",
)
def avg_empty_zero(t: Tables):
    none = F.when(F.col("l_quantity") < 0, F.col("l_tax"))
    return t.lineitem.agg(
        F.round(F.coalesce(F.avg("l_tax"), F.lit(0.0)), 6).alias("every_row"),
        F.coalesce(F.avg(none), F.lit(0.0)).alias("no_row"),
    )


@query(
    "max_empty_null",
    "SELECT max(l_tax) AS every_row, max(CASE WHEN l_quantity < 0 THEN l_tax END) AS no_row FROM lineitem",
)
def max_empty_null(t: Tables):
    none = F.when(F.col("l_quantity") < 0, F.col("l_tax"))
    return t.lineitem.agg(F.max("l_tax").alias("every_row"), F.max(none).alias("no_row"))


@query(
    "avg_columns_rounded",
    f"""WITH {shapes.RIDES_SQL}
        SELECT round(avg(CAST(booking_value AS DOUBLE)), 2) AS booking_value,
               round(avg(CAST(ride_distance AS DOUBLE)), 2) AS ride_distance,
               round(avg(CAST(driver_ratings AS DOUBLE)), 2) AS driver_ratings
        FROM rides WHERE booking_status = 'Completed' AND booking_value <> 'null'
        AND ride_distance <> 'null' AND driver_ratings <> 'null'""",
)
def avg_columns_rounded(t: Tables):
    return completed_rides(t).agg(
        *[F.round(F.avg(F.col(c).cast("double")), 2).alias(c) for c in shapes.RIDE_FIGURES]
    )


@query(
    "avg_after_filter",
    f"""WITH {shapes.SELLERS_SQL}
        SELECT count(*) AS best_sellers, round(avg(CAST(product_rating AS DOUBLE)), 6) AS rating,
               round(avg(CAST(original_price AS DOUBLE)), 4) AS price
        FROM sellers WHERE lower(is_best_seller) = 'best seller' AND original_price <> ''""",
)
def avg_after_filter(t: Tables):
    return only_best_sellers(t).agg(
        F.count(F.lit(1)).alias("best_sellers"),
        F.round(F.avg(F.col("product_rating").cast("double")), 6).alias("rating"),
        F.round(F.avg(F.col("original_price").cast("double")), 4).alias("price"),
    )


@query("group_sum", "SELECT l_returnflag, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY l_returnflag")
def group_sum(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))


@query("group_mean", "SELECT l_returnflag, round(avg(l_extendedprice), 4) AS mean FROM lineitem GROUP BY l_returnflag")
def group_mean(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.avg("l_extendedprice"), 4).alias("mean"))


@query("group_count", "SELECT event_type, count(value) AS n FROM events GROUP BY event_type")
def group_count(t: Tables):
    return t.events.groupBy("event_type").agg(F.count("value").alias("n"))


@query("group_size2", "SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY p_brand, p_type")
def group_size2(t: Tables):
    return t.part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "group_sum2",
    "SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY ALL",
)
def group_sum2(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("total")
    )


@query(
    "group_multi_agg",
    """SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS price_sum,
       round(avg(l_extendedprice), 4) AS price_mean, round(avg(l_quantity), 6) AS quantity_mean
       FROM lineitem GROUP BY ALL""",
)
def group_multi_agg(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("price_sum"),
        F.round(F.avg("l_extendedprice"), 4).alias("price_mean"),
        F.round(F.avg("l_quantity"), 6).alias("quantity_mean"),
    )


@query("group_rate", _PASSENGERS + "SELECT sex, round(avg(survived), 6) AS rate FROM passengers GROUP BY sex")
def group_rate(t: Tables):
    return shapes.passengers(t).groupBy("sex").agg(F.round(F.avg("survived"), 6).alias("rate"))


@query(
    "hours_groups",
    _HOURS
    + """, by_city AS (SELECT ciudad, avg(horas_dia) AS dia, avg(horas_noche) AS noche FROM hours GROUP BY ciudad)
    SELECT 'mean_day_by_city' AS report, ciudad AS label, round(dia, 6) AS figure FROM by_city
    UNION ALL SELECT 'total_by_region', region, CAST(sum(horas_dia + horas_noche) AS DOUBLE) FROM hours GROUP BY region
    UNION ALL SELECT 'top_mean_night', ciudad, round(noche, 6) FROM by_city WHERE noche = (SELECT max(noche) FROM by_city)""",
)
def hours_groups(t: Tables):
    """Orders are summed per customer before the join, so a busy customer is one row."""
    orders = t.orders.select(
        "o_custkey",
        (F.floor("o_totalprice") % 41).alias("horas_dia"),
        (F.col("o_orderkey") % 20).alias("horas_noche"),
    )
    sums = orders.groupBy("o_custkey").agg(
        F.sum("horas_dia").alias("dia"), F.sum("horas_noche").alias("noche"), F.count(F.lit(1)).alias("n")
    )
    placed = sums.join(shapes.people(t), F.col("o_custkey") == F.col("c_custkey"))
    cities = placed.groupBy("region", "ciudad").agg(
        F.sum("dia").alias("dia"), F.sum("noche").alias("noche"), F.sum("n").alias("n")
    )
    by_city = cities.select(
        F.col("ciudad").alias("label"), (F.col("dia") / F.col("n")).alias("dia"), (F.col("noche") / F.col("n")).alias("noche")
    )
    day = by_city.select(F.lit("mean_day_by_city").alias("report"), "label", F.round("dia", 6).alias("figure"))
    region = cities.groupBy(F.col("region").alias("label")).agg(
        F.sum(F.col("dia") + F.col("noche")).cast("double").alias("figure")
    )
    night = combining.most(by_city, "noche").select(
        F.lit("top_mean_night").alias("report"), "label", F.round("noche", 6).alias("figure")
    )
    return day.unionByName(region.withColumn("report", F.lit("total_by_region"))).unionByName(night)


@query("value_counts", "SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def value_counts(t: Tables):
    return grouping.value_counts(t.events, "event_type")


@query(
    "value_counts_by_value",
    "SELECT l_quantity, count(*) AS n FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY l_quantity ORDER BY l_quantity",
)
def value_counts_by_value(t: Tables):
    return grouping.value_counts(t.lineitem, "l_quantity", by_value=True)


@query("class_report", "SELECT count(*) AS cantidad, c_mktsegment AS clase FROM customer GROUP BY c_mktsegment")
def class_report(t: Tables):
    return (
        t.customer.groupBy(F.col("c_mktsegment").alias("clase"))
        .agg(F.count(F.lit(1)).alias("cantidad"))
        .select("cantidad", "clase")
        .orderBy(F.desc("cantidad"), "clase")
    )


@query(
    "sales_summary",
    """WITH sales AS (SELECT l_suppkey, l_partkey,
        CAST(l_quantity AS DECIMAL(7, 0)) * CAST(l_extendedprice AS DECIMAL(10, 2)) AS total FROM lineitem)
    SELECT r_name AS descripcion, CAST(sum(total) AS DOUBLE) AS valor, 'Zonas' AS tipo FROM sales
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
    UNION ALL SELECT p_brand, CAST(sum(total) AS DOUBLE), 'Productos' FROM sales JOIN part ON l_partkey = p_partkey GROUP BY p_brand
    UNION ALL SELECT 'Venta', CAST(sum(total) AS DOUBLE), 'Resumen' FROM sales
    UNION ALL SELECT 'Registros', CAST(count(*) AS DOUBLE), 'Resumen' FROM sales""",
)
def sales_summary(t: Tables):
    """Money is summed as decimals, so the order of addition does not matter."""
    report = grouping.sales_summary(
        t.lineitem,
        "l_suppkey",
        "l_partkey",
        F.col("l_quantity").cast("decimal(7,0)") * F.col("l_extendedprice").cast("decimal(10,2)"),
        zones=shapes.zones(t),
        products=shapes.products(t),
    )
    return report.withColumn("valor", F.col("valor").cast("double"))


def _cells(t: Tables):
    return t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top")
    )


_CELLS = """SELECT o_orderpriority, o_orderstatus, count(*) AS n, max(o_totalprice) AS top,
    round(sum(o_totalprice), 2) AS "sum", round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY ALL"""


@query(
    "pivot_single",
    f"SELECT * FROM (PIVOT (SELECT o_orderpriority, o_orderstatus, n FROM ({_CELLS})) ON o_orderstatus IN ('F', 'O', 'P') USING first(n))",
)
def pivot_single(t: Tables):
    return grouping.pivot_unique(_cells(t), "o_orderpriority", "o_orderstatus", ["n"])


@query(
    "pivot_multi_values",
    f"""SELECT * FROM (PIVOT (SELECT o_orderpriority, o_orderstatus, n, top FROM ({_CELLS}))
        ON o_orderstatus IN ('F', 'O', 'P') USING first(n) AS n, first(top) AS top)""",
)
def pivot_multi_values(t: Tables):
    return grouping.pivot_unique(_cells(t), "o_orderpriority", "o_orderstatus", ["n", "top"])


@query(
    "pivot_table",
    f"""SELECT * FROM (PIVOT (SELECT o_orderpriority, o_orderstatus, n, "sum", mean FROM ({_CELLS}))
        ON o_orderstatus IN ('F', 'O', 'P') USING coalesce(first("sum"), 0) AS "sum", coalesce(first(mean), 0) AS mean,
        coalesce(first(n), 0) AS "count")""",
)
def pivot_table(t: Tables):
    price = F.col("o_totalprice")
    return grouping.pivot_table(
        t.orders,
        "o_orderpriority",
        "o_orderstatus",
        [F.round(F.sum(price), 2).alias("sum"), F.round(F.avg(price), 4).alias("mean"), F.count(price).alias("count")],
        fill=0,
    )


@query(
    "pivot_rate",
    _PASSENGERS
    + """SELECT * FROM (PIVOT (SELECT pclass, sex, round(avg(survived), 6) AS rate FROM passengers GROUP BY ALL)
         ON sex IN ('de', 'en', 'es', 'fr') USING first(rate))""",
)
def pivot_rate(t: Tables):
    return grouping.pivot_table(shapes.passengers(t), "pclass", "sex", [F.round(F.avg("survived"), 6)])


@query(
    "pivot_maps",
    """SELECT o_orderpriority, CAST(o_custkey AS VARCHAR) AS customer, count(*) AS n, max(o_totalprice) AS top
       FROM orders GROUP BY o_orderpriority, o_custkey""",
)
def pivot_maps(t: Tables):
    """A column for every customer: far too many for a wide table, so its maps, laid out again to be compared."""
    wide = grouping.pivot_maps(t.orders, "o_orderpriority", "o_custkey", {"n": F.count(F.lit(1)), "top": F.max("o_totalprice")})
    # Maps of a row have the same labels in the same order; looking each label up would take the square of their number.
    names = F.map_keys("n").alias("customer"), F.map_values("n").alias("n"), F.map_values("top").alias("top")
    return wide.select("o_orderpriority", F.inline(F.arrays_zip(*names)))


@query(
    "pivot_unique_maps",
    "SELECT c_nationkey, CAST(c_custkey AS VARCHAR) AS customer, c_acctbal AS balance FROM customer",
)
def pivot_unique_maps(t: Tables):
    wide = grouping.pivot_unique_maps(t.customer, "c_nationkey", "c_custkey", ["c_acctbal"])
    return wide.select("c_nationkey", F.explode("c_acctbal").alias("customer", "balance"))
