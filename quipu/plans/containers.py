"""List, set and dict expressions on array and map columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.functions import arrays
from quipu.plans.catalog import Tables, query


def _lists(t: Tables) -> DataFrame:
    """Two short lists per line item, with repeats."""
    n = F.col("l_linenumber").cast("bigint")
    p, s = F.col("l_partkey") % 10, F.col("l_suppkey") % 10
    return t.lineitem.select(
        "l_orderkey", F.array(n, p, s, n, p + 1).alias("a"), F.array(s, n + 2, p).alias("b")
    )


_LISTS = """lists AS (SELECT l_orderkey, [n, p, s, n, p + 1] AS a, [s, n + 2, p] AS b FROM
    (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS n, l_partkey % 10 AS p, l_suppkey % 10 AS s FROM lineitem))"""
_WITH = f"WITH {_LISTS} "


def _text(a: Column) -> Column:
    return F.array_join(a.cast("array<string>"), ",")


def _list_query(name: str, columns, sql: str):
    """Register expressions over the two lists."""

    @query(name, f"{_WITH}SELECT l_orderkey, {sql} FROM lists")
    def build(t: Tables):
        made = columns(F.col("a"), F.col("b"))
        return _lists(t).select("l_orderkey", *[c.alias(name) for name, c in made.items()])

    return build


def _join(expression: str, name: str) -> str:
    return f"array_to_string({expression}, ',') AS {name}"


@query(
    "arr_reduce",
    """SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, round(list_sum(CAST(embedding AS DOUBLE[])), 9) + 0.0 AS total,
       list_max(embedding)::DOUBLE AS high, list_min(embedding)::DOUBLE AS low FROM embeddings""",
)
def arr_reduce(t: Tables):
    a = F.col("embedding")
    return t.embeddings.select(
        "vec_id",
        F.size(a).alias("n"),
        (F.round(arrays.total(a), 9) + F.lit(0.0)).alias("total"),
        F.array_max(a).cast("double").alias("high"),
        F.array_min(a).cast("double").alias("low"),
    )


_list_query(
    "arr_access",
    lambda a, b: {"first": arrays.item(a, 0), "second": arrays.item(a, 1), "last": arrays.item(a, -1), "beyond": arrays.item(b, 7)},
    "a[1] AS first, a[2] AS second, a[-1] AS last, b[8] AS beyond",
)
_list_query(
    "arr_slice",
    lambda a, b: {
        "middle": _text(arrays.cut(a, 1, 4)), "head": _text(arrays.cut(a, stop=3)),
        "rest": _text(arrays.cut(a, 2)), "stepped": _text(arrays.cut(a, step=2)), "but_last": _text(arrays.cut(a, 0, -1)),
    },
    ", ".join([_join("a[2:4]", "middle"), _join("a[1:3]", "head"), _join("a[3:]", "rest"), _join("a[1:5:2]", "stepped"), _join("a[1:4]", "but_last")]),
)
_list_query(
    "arr_edit",
    lambda a, b: {
        "appended": _text(F.array_append(a, F.lit(99).cast("bigint"))),
        "inserted": _text(arrays.insert_at(a, 1, F.lit(77).cast("bigint"))),
        "removed": _text(arrays.remove_first(a, arrays.item(a, 3))),
        "popped": _text(arrays.pop_at(a, -1)),
        "popped_at": _text(arrays.pop_at(a, 1)),
        "assigned": _text(arrays.set_at(a, 2, F.lit(55).cast("bigint"))),
    },
    ", ".join(
        [
            _join("list_append(a, 99)", "appended"),
            _join("list_concat(list_concat(a[1:1], [77]), a[2:])", "inserted"),
            _join("list_concat(a[1:list_position(a, a[4]) - 1], a[list_position(a, a[4]) + 1:])", "removed"),
            _join("a[1:4]", "popped"),
            _join("list_concat(a[1:1], a[3:])", "popped_at"),
            _join("list_concat(list_concat(a[1:2], [55]), a[4:])", "assigned"),
        ]
    ),
)
_list_query(
    "arr_index",
    lambda a, b: {"place": arrays.index_of(a, F.lit(5).cast("bigint"))},
    "CAST(nullif(coalesce(list_position(a, 5), 0), 0) - 1 AS BIGINT) AS place",
)
_list_query(
    "arr_count",
    lambda a, b: {"n": arrays.count_of(a, arrays.item(a, 0))},
    "CAST(len(list_filter(a, lambda x: x = a[1])) AS INTEGER) AS n",
)
_list_query(
    "arr_contains",
    lambda a, b: {"has_five": F.array_contains(a, 5), "has_own": F.array_contains(a, arrays.item(b, 0))},
    "list_contains(a, 5) AS has_five, list_contains(a, b[1]) AS has_own",
)
_list_query(
    "arr_sort",
    lambda a, b: {"up": _text(F.array_sort(a)), "down": _text(F.sort_array(a, asc=False))},
    ", ".join([_join("list_sort(a)", "up"), _join("list_reverse_sort(a)", "down")]),
)
_list_query("arr_reverse", lambda a, b: {"turned": _text(F.reverse(a))}, _join("list_reverse(a)", "turned"))
_list_query("arr_concat", lambda a, b: {"both": _text(F.concat(a, b))}, _join("list_concat(a, b)", "both"))
_list_query(
    "arr_repeat",
    lambda a, b: {"thrice": _text(arrays.times(b, 3))},
    _join("list_concat(list_concat(b, b), b)", "thrice"),
)
_list_query(
    "arr_compare",
    lambda a, b: {"lt": a < b, "le": a <= b, "eq": a == b, "gt": a > b, "same": a == a},
    "a < b AS lt, a <= b AS le, a = b AS eq, a > b AS gt, a = a AS same",
)
_list_query(
    "arr_nested",
    lambda a, b: {"row": _text(F.array(a, b)[1]), "cell": F.array(a, b)[1][2]},
    _join("[a, b][2]", "row") + ", [a, b][2][3] AS cell",
)
_list_query(
    "arr_sets",
    lambda a, b: {
        "joined": _text(F.array_sort(F.array_union(a, b))),
        "common": _text(F.array_sort(F.array_intersect(a, b))),
        "only_first": _text(F.array_sort(F.array_except(a, b))),
    },
    ", ".join(
        [
            _join("list_sort(list_distinct(list_concat(a, b)))", "joined"),
            _join("list_sort(list_distinct(list_filter(a, lambda x: list_contains(b, x))))", "common"),
            _join("list_sort(list_distinct(list_filter(a, lambda x: NOT list_contains(b, x))))", "only_first"),
        ]
    ),
)


@query(
    "squares_to_n",
    "SELECT l_orderkey, l_linenumber AS n, array_to_string(list_transform(range(0, l_linenumber + 1), lambda i: i * i), ',') AS squares FROM lineitem",
)
def squares_to_n(t: Tables):
    n = F.col("l_linenumber")
    squares = F.transform(F.sequence(F.lit(0), n), lambda i: i * i)
    return t.lineitem.select("l_orderkey", n.alias("n"), _text(squares).alias("squares"))


@query(
    "range_gen",
    """SELECT p_partkey, array_to_string(range(2, p_size, 3), ',') AS stepped,
       array_to_string(list_transform(range(1, 11), lambda i: p_size || ' x ' || i || ' = ' || p_size * i), '; ') AS times_table FROM part""",
)
def range_gen(t: Tables):
    size = F.col("p_size")
    last = F.greatest(size - 1, F.lit(2))
    stepped = F.when(size > 2, F.sequence(F.lit(2), last, F.lit(3))).otherwise(F.array().cast("array<int>"))
    table = F.transform(
        F.sequence(F.lit(1), F.lit(10)), lambda i: F.format_string("%d x %d = %d", size, i, size * i)
    )
    return t.part.select(
        "p_partkey", _text(stepped).alias("stepped"), F.array_join(table, "; ").alias("times_table")
    )


@query(
    "grade_stats",
    """SELECT l_orderkey, CASE WHEN l_discount = 0 THEN 0.0 ELSE round((n + p + s) / 3, 9) END AS average,
       CASE WHEN l_discount = 0 THEN 0.0 ELSE CAST(greatest(n, p, s) AS DOUBLE) END AS best,
       CASE WHEN l_discount = 0 THEN 0.0 ELSE CAST(least(n, p, s) AS DOUBLE) END AS worst,
       l_discount <> 0 AND (n + p + s) / 3 >= 4 AS passed FROM
       (SELECT l_orderkey, l_discount, l_linenumber AS n, l_partkey % 8 AS p, l_suppkey % 8 AS s FROM lineitem)""",
)
def grade_stats(t: Tables):
    grades = F.when(F.col("l_discount") == 0, F.array().cast("array<bigint>")).otherwise(
        F.array(F.col("l_linenumber").cast("bigint"), F.col("l_partkey") % 8, F.col("l_suppkey") % 8)
    )
    stats = t.lineitem.select("l_orderkey", arrays.grade_summary(grades).alias("s"))
    return stats.select("l_orderkey", "s.*").withColumn("average", F.round("average", 9))


def _maps(t: Tables) -> DataFrame:
    """A map per line item; the discount is there only if it is not zero."""
    base = F.create_map(F.lit("quantity"), F.col("l_quantity"), F.lit("tax"), F.col("l_tax"))
    more = F.map_concat(base, F.create_map(F.lit("discount"), F.col("l_discount")))
    return t.lineitem.select("l_orderkey", F.when(F.col("l_discount") > 0, more).otherwise(base).alias("m"))


def _m() -> Column:
    return F.col("m")


@query(
    "map_get",
    """SELECT l_orderkey, l_quantity AS quantity, CASE WHEN l_discount > 0 THEN l_discount END AS discount,
       CASE WHEN l_discount > 0 THEN l_discount ELSE -1 END AS or_default FROM lineitem""",
)
def map_get(t: Tables):
    return _maps(t).select(
        "l_orderkey",
        arrays.get(_m(), F.lit("quantity")).alias("quantity"),
        arrays.get(_m(), F.lit("discount")).alias("discount"),
        arrays.get(_m(), F.lit("discount"), F.lit(-1.0)).alias("or_default"),
    )


@query(
    "map_keys_values",
    """SELECT l_orderkey, CASE WHEN l_discount > 0 THEN 'quantity,tax,discount' ELSE 'quantity,tax' END AS keys,
       CASE WHEN l_discount > 0 THEN concat_ws(',', l_quantity, l_tax, l_discount) ELSE concat_ws(',', l_quantity, l_tax) END AS vals
       FROM lineitem""",
)
def map_keys_values(t: Tables):
    return _maps(t).select(
        "l_orderkey", F.array_join(F.map_keys(_m()), ",").alias("keys"), _text(F.map_values(_m())).alias("vals")
    )


@query(
    "map_entries",
    """SELECT l_orderkey, 'quantity' AS key, l_quantity AS value FROM lineitem
       UNION ALL SELECT l_orderkey, 'tax', l_tax FROM lineitem
       UNION ALL SELECT l_orderkey, 'discount', l_discount FROM lineitem WHERE l_discount > 0""",
)
def map_entries(t: Tables):
    return _maps(t).select("l_orderkey", F.explode(_m()))


@query(
    "map_put",
    """SELECT l_orderkey, 1.5::DOUBLE AS discount, l_tax AS tax, 3 AS n FROM lineitem""",
)
def map_put(t: Tables):
    changed = arrays.put(_m(), F.lit("discount"), F.lit(1.5))
    return _maps(t).select(
        "l_orderkey", changed["discount"].alias("discount"), changed["tax"].alias("tax"), F.size(changed).alias("n")
    )


@query(
    "map_delete",
    "SELECT l_orderkey, NULL::DOUBLE AS tax, CASE WHEN l_discount > 0 THEN 2 ELSE 1 END AS n FROM lineitem",
)
def map_delete(t: Tables):
    changed = arrays.without_key(_m(), F.lit("tax"))
    return _maps(t).select("l_orderkey", arrays.get(changed, F.lit("tax")).alias("tax"), F.size(changed).alias("n"))


@query(
    "map_setdefault",
    "SELECT l_orderkey, CASE WHEN l_discount > 0 THEN l_discount ELSE 9 END AS discount, 3 AS n FROM lineitem",
)
def map_setdefault(t: Tables):
    changed = arrays.set_default(_m(), F.lit("discount"), F.lit(9.0))
    return _maps(t).select("l_orderkey", changed["discount"].alias("discount"), F.size(changed).alias("n"))


@query("map_contains", "SELECT l_orderkey, l_discount > 0 AS has_discount, true AS has_tax FROM lineitem")
def map_contains(t: Tables):
    return _maps(t).select(
        "l_orderkey",
        F.map_contains_key(_m(), "discount").alias("has_discount"),
        F.map_contains_key(_m(), "tax").alias("has_tax"),
    )


@query(
    "nested_lookup",
    "SELECT p_partkey, p_name AS nombre, p_size * 2 AS nota, NULL::VARCHAR AS ausente FROM part",
)
def nested_lookup(t: Tables):
    student = F.struct(F.col("p_name").alias("nombre"), F.col("p_size").alias("nota"))
    other = F.struct(F.col("p_brand").alias("nombre"), (F.col("p_size") * 2).alias("nota"))
    students = t.part.select("p_partkey", F.create_map(F.lit("A001"), student, F.lit("A002"), other).alias("m"))
    return students.select(
        "p_partkey",
        _m()["A001"]["nombre"].alias("nombre"),
        _m()["A002"]["nota"].alias("nota"),
        F.try_element_at(_m(), F.lit("A009"))["nombre"].alias("ausente"),
    )
