"""Projection, derivation, filters and table profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from quipu.functions import numbers
from quipu.operators import ordering, profile
from quipu.plans import shapes
from quipu.plans.catalog import Tables, query


@query("select_cols", "SELECT l_partkey, l_suppkey FROM lineitem")
def select_cols(t: Tables):
    return t.lineitem.select("l_partkey", "l_suppkey")


@query("rename", "SELECT c_custkey AS cliente, c_mktsegment AS segmento, c_acctbal AS saldo FROM customer")
def rename(t: Tables):
    return t.customer.select("c_custkey", "c_mktsegment", "c_acctbal").withColumnsRenamed(
        {"c_custkey": "cliente", "c_mktsegment": "segmento", "c_acctbal": "saldo"}
    )


@query("const_col", "SELECT c_custkey, c_name, 'Chile' AS pais FROM customer")
def const_col(t: Tables):
    return t.customer.select("c_custkey", "c_name", F.lit("Chile").alias("pais"))


@query(
    "derive_arith",
    "SELECT l_orderkey, l_quantity, l_extendedprice, l_quantity * l_extendedprice AS total FROM lineitem",
)
def derive_arith(t: Tables):
    return t.lineitem.select("l_orderkey", "l_quantity", "l_extendedprice").withColumn(
        "total", F.col("l_quantity") * F.col("l_extendedprice")
    )


@query(
    "scalar_broadcast",
    "SELECT event_id, value + 10 AS plus_ten, value * 2 AS doubled, sqrt(value) AS root FROM events",
)
def scalar_broadcast(t: Tables):
    value = F.col("value")
    return t.events.select(
        "event_id",
        (value + 10).alias("plus_ten"),
        (value * 2).alias("doubled"),
        F.sqrt(value).alias("root"),
    )


@query("bool_col", "SELECT p_partkey, p_size, p_size > 30 AS mayor_30 FROM part")
def bool_col(t: Tables):
    return t.part.select("p_partkey", "p_size", (F.col("p_size") > 30).alias("mayor_30"))


@query(
    "total_broadcast",
    "SELECT p_partkey, p_size, CAST((SELECT sum(p_size) FROM part) AS BIGINT) AS size_total FROM part",
)
def total_broadcast(t: Tables):
    return profile.with_total(t.part.select("p_partkey", "p_size"), "p_size", "size_total")


@query(
    "share_of_total",
    """SELECT c_mktsegment, count(*) AS n, round(count(*) / (SELECT count(*) FROM customer), 8) AS share
       FROM customer GROUP BY c_mktsegment""",
)
def share_of_total(t: Tables):
    counts = t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return profile.with_share(counts, "n", "share").withColumn("share", F.round("share", 8))


@query("filter_cmp", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 300000")
def filter_cmp(t: Tables):
    return t.orders.filter(F.col("o_totalprice") >= 300000).select("o_orderkey", "o_totalprice")


@query(
    "filter_and",
    "SELECT p_partkey, p_type, p_size FROM part WHERE p_type = 'ECONOMY' AND p_size > 25",
)
def filter_and(t: Tables):
    return t.part.filter((F.col("p_type") == "ECONOMY") & (F.col("p_size") > 25)).select(
        "p_partkey", "p_type", "p_size"
    )


@query(
    "filter_or",
    "SELECT l_orderkey, l_quantity, l_discount FROM lineitem WHERE l_quantity < 3 OR l_quantity > 48 OR l_discount = 0.1",
)
def filter_or(t: Tables):
    wanted = (F.col("l_quantity") < 3) | (F.col("l_quantity") > 48) | (F.col("l_discount") == 0.1)
    return t.lineitem.filter(wanted).select("l_orderkey", "l_quantity", "l_discount")


@query(
    "comparisons",
    """SELECT l_orderkey, l_linenumber * 7 AS x, l_quantity AS y, x = y AS eq, x <> y AS ne, x > y AS gt,
              x < y AS lt, x >= y AS ge, x <= y AS le FROM lineitem""",
)
def comparisons(t: Tables):
    x, y = F.col("x"), F.col("y")
    pairs = t.lineitem.select(
        "l_orderkey", (F.col("l_linenumber") * 7).alias("x"), F.col("l_quantity").alias("y")
    )
    return pairs.select(
        "l_orderkey", "x", "y",
        (x == y).alias("eq"), (x != y).alias("ne"), (x > y).alias("gt"),
        (x < y).alias("lt"), (x >= y).alias("ge"), (x <= y).alias("le"),
    )


@query(
    "filter_derived",
    f"""WITH {shapes.HOURS_SQL}
        SELECT id, nombre, ciudad, horas_dia + horas_noche AS horas_totales FROM hours
        WHERE horas_dia + horas_noche > 12 AND NOT (ciudad = 'NATION_3' AND horas_dia + horas_noche < 40)""",
)
def filter_derived(t: Tables):
    total = F.col("horas_totales")
    rows = shapes.hours(t).withColumn("horas_totales", F.col("horas_dia") + F.col("horas_noche"))
    return rows.filter((total > 12) & ~((F.col("ciudad") == "NATION_3") & (total < 40))).select(
        "id", "nombre", "ciudad", "horas_totales"
    )


@query(
    "clean_sentinels",
    f"""WITH {shapes.RIDES_SQL}
        SELECT * FROM rides WHERE booking_status = 'Completed' AND booking_value <> 'null'
        AND ride_distance <> 'null' AND driver_ratings <> 'null'""",
)
def clean_sentinels(t: Tables):
    return completed_rides(t)


def completed_rides(t: Tables):
    rides = shapes.rides(t).filter(F.col("booking_status") == "Completed")
    for figure in shapes.RIDE_FIGURES:
        rides = rides.filter(F.col(figure) != "null")
    return rides


@query(
    "best_sellers",
    f"""WITH {shapes.SELLERS_SQL}
        SELECT * FROM sellers WHERE lower(is_best_seller) = 'best seller' AND original_price <> ''""",
)
def best_sellers(t: Tables):
    return only_best_sellers(t)


def only_best_sellers(t: Tables):
    return shapes.sellers(t).filter(
        (F.lower("is_best_seller") == "best seller") & (F.col("original_price") != "")
    )


@query(
    "non_blank_labelled",
    """SELECT doc_id, text, CAST(quality AS VARCHAR) AS label FROM documents LEFT JOIN labels USING (doc_id)
       WHERE text <> '' AND quality IS NOT NULL""",
)
def non_blank_labelled(t: Tables):
    """Keeps the label '0' too: a text is false only when it is empty."""
    news = t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id", "text", F.col("quality").cast("string").alias("label")
    )
    return news.filter(numbers.truthy_text(F.col("label")) & (F.col("text") != ""))


@query("head", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 7")
def head(t: Tables):
    return t.orders.select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(7)


@query(
    "tail",
    "SELECT * FROM (SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey DESC LIMIT 5) ORDER BY o_orderkey",
)
def tail(t: Tables):
    last = t.orders.select("o_orderkey", "o_custkey").orderBy(F.desc("o_orderkey")).limit(5)
    return last.orderBy("o_orderkey")


@query(
    "row_slice",
    """SELECT o_orderkey, o_totalprice FROM
       (SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS place, count(*) OVER () AS n FROM orders)
       WHERE place >= 100 AND place < n - 200""",
)
def row_slice(t: Tables):
    return ordering.row_slice(
        t.orders.select("o_orderkey", "o_totalprice"), 100, -200, F.col("o_totalprice"), F.col("o_orderkey")
    )


@query(
    "row_slice_short",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 41 OFFSET 20",
)
def row_slice_short(t: Tables):
    return ordering.row_slice(
        t.orders.select("o_orderkey", "o_totalprice"), 20, 60, F.col("o_totalprice"), F.col("o_orderkey"), inclusive=True
    )


@query("distinct_values", "SELECT DISTINCT p_brand FROM part")
def distinct_values(t: Tables):
    return t.part.select("p_brand").distinct()


@query("shape", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def shape(t: Tables):
    return profile.shape(t.lineitem)


def _per_column_sql(table: str, kinds: dict[str, str], fact: str, with_type: bool = False) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, " + (f"'{kind}' AS type, " if with_type else "") + fact.format(c=c) + f" FROM {table}"
        for c, kind in kinds.items()
    )


_ORDERS = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


@query("schema_info", _per_column_sql("orders", _ORDERS, "count({c}) AS non_null", with_type=True))
def schema_info(t: Tables):
    return profile.schema_info(t.orders)


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "describe",
    _per_column_sql(
        "lineitem",
        dict.fromkeys(_MEASURES, ""),
        "count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min,"
        " max({c}) AS max, round(quantile_cont({c}, 0.25), 6) AS q25,"
        " round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75",
    ),
)
def describe(t: Tables):
    rounded = {c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")}
    return profile.describe(t.lineitem.select(*_MEASURES)).withColumns(rounded)


@query("nunique", _per_column_sql("orders", _ORDERS, "count(DISTINCT {c}) AS n_distinct"))
def nunique(t: Tables):
    return profile.nunique(t.orders)
