"""Text, number, cast and conditional expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quipu.functions import numbers, strings
from quipu.plans.catalog import Tables, query

_SPACE = r"E' \t\r\n\v\f'"


def _text_query(name: str, expression, sql: str):
    """Register one expression over all document texts."""

    @query(name, f"SELECT doc_id, {sql} AS result FROM documents")
    def build(t: Tables):
        return t.documents.select("doc_id", expression(F.col("text")).alias("result"))

    return build


_text_query("str_len", F.char_length, "CAST(length(text) AS INTEGER)")
_text_query("str_lower", F.lower, "lower(text)")
_text_query("str_upper", F.upper, "upper(replace(text, 'ß', 'ss'))")
_text_query(
    "str_swapcase",
    strings.swapcase,
    """array_to_string(list_transform(string_split(replace(text, 'ß', 'ss'), ''),
       lambda c: CASE WHEN c = upper(c) AND c <> lower(c) THEN lower(c) ELSE upper(c) END), '')""",
)
_text_query("str_capitalize", strings.capitalize, "upper(left(text, 1)) || lower(substr(text, 2))")
_text_query(
    "str_title",
    strings.title,
    r"""array_to_string(list_transform(regexp_extract_all(text, '[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+'),
        lambda w: upper(left(regexp_replace(w, '^ß', 'ss'), 1)) || lower(substr(regexp_replace(w, '^ß', 'ss'), 2))), '')""",
)
_text_query("str_trim", lambda s: strings.strip(F.concat(F.lit(" \t"), s, F.lit("\n "))), f"trim(text, {_SPACE})")
_text_query("str_ltrim", lambda s: strings.lstrip(F.concat(F.lit(" \t"), s)), f"ltrim(text, {_SPACE})")
_text_query("str_rtrim", lambda s: strings.rstrip(F.concat(s, F.lit("\n "))), f"rtrim(text, {_SPACE})")
_text_query("str_replace", lambda s: F.replace(s, F.lit("the"), F.lit("THE")), "replace(text, 'the', 'THE')")
_text_query("str_find", lambda s: strings.find(s, "the"), "CAST(instr(text, 'the') - 1 AS INTEGER)")
_text_query(
    "str_count",
    lambda s: strings.count(s, "on"),
    "CAST((length(text) - length(replace(text, 'on', ''))) // 2 AS INTEGER)",
)
_text_query(
    "vowel_count",
    lambda s: strings.count_any(s, "aeiouAEIOU"),
    "CAST(length(regexp_replace(text, '[^aeiouAEIOU]', '', 'g')) AS INTEGER)",
)


@query("str_split", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS piece FROM part")
def str_split(t: Tables):
    return t.part.select("p_partkey", F.explode(strings.split_at(F.col("p_name"), " ")).alias("piece"))


@query("str_join", "SELECT p_partkey, replace(p_name, ' ', ' - ') AS joined FROM part")
def str_join(t: Tables):
    pieces = strings.split_at(F.col("p_name"), " ")
    return t.part.select("p_partkey", F.array_join(pieces, " - ").alias("joined"))


@query(
    "str_isalpha",
    r"SELECT p_partkey, regexp_full_match(p_type, '\p{L}+') AS type_alpha, regexp_full_match(p_name, '\p{L}+') AS name_alpha FROM part",
)
def str_isalpha(t: Tables):
    return t.part.select(
        "p_partkey",
        strings.is_alpha(F.col("p_type")).alias("type_alpha"),
        strings.is_alpha(F.col("p_name")).alias("name_alpha"),
    )


@query(
    "str_isdigit",
    r"SELECT p_partkey, regexp_full_match(CAST(p_size AS VARCHAR), '\d+') AS size_digit, regexp_full_match(p_brand, '\d+') AS brand_digit FROM part",
)
def str_isdigit(t: Tables):
    return t.part.select(
        "p_partkey",
        strings.is_digit(F.col("p_size").cast("string")).alias("size_digit"),
        strings.is_digit(F.col("p_brand")).alias("brand_digit"),
    )


@query("str_concat", "SELECT p_partkey, p_name || ' ' || p_brand AS joined FROM part")
def str_concat(t: Tables):
    return t.part.select("p_partkey", F.concat("p_name", F.lit(" "), "p_brand").alias("joined"))


@query("str_repeat", "SELECT p_partkey, repeat(p_name, 3) AS repeated FROM part")
def str_repeat(t: Tables):
    return t.part.select("p_partkey", F.repeat("p_name", F.lit(3)).alias("repeated"))


@query(
    "str_format",
    """SELECT c_custkey, printf('Hola, me llamo %s y tengo %d', c_name, c_nationkey) AS greeting,
       printf('%.2f', c_acctbal) AS balance, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS padded FROM customer""",
)
def str_format(t: Tables):
    return t.customer.select(
        "c_custkey",
        F.format_string("Hola, me llamo %s y tengo %d", "c_name", "c_nationkey").alias("greeting"),
        F.format_string("%.2f", "c_acctbal").alias("balance"),
        strings.zfill(F.col("c_nationkey").cast("string"), 3).alias("padded"),
    )


@query(
    "str_chars",
    """SELECT p_partkey, CAST(place - 1 AS INTEGER) AS place, substr(p_name, place, 1) AS letter
       FROM (SELECT p_partkey, p_name, unnest(range(1, length(p_name) + 1)) AS place FROM part)""",
)
def str_chars(t: Tables):
    return t.part.select("p_partkey", F.posexplode(strings.characters(F.col("p_name"))).alias("place", "letter"))


@query(
    "word_lengths",
    r"""SELECT conv_id, turn, word, CAST(length(word) AS INTEGER) AS letters FROM
        (SELECT conv_id, turn, unnest(string_split_regex(text, '[ \t\n\r\v\f]+')) AS word FROM conversations) WHERE word <> ''""",
)
def word_lengths(t: Tables):
    spread = t.conversations.select("conv_id", "turn", F.explode(strings.words(F.col("text"))).alias("word"))
    return spread.withColumn("letters", F.char_length("word"))


def _operands(t: Tables):
    """An odd number, a number that no double holds, and a divisor of either sign or zero."""
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    return t.lineitem.select(
        "l_orderkey",
        (F.col("l_linenumber") * 2 - 7).cast("bigint").alias("a"),
        (F.col("l_orderkey") * 2 + F.lit(2**53 + 1)).alias("big"),
        (F.col("l_suppkey") % 4 * sign).alias("b"),
    )


_OPERANDS = """operands AS (SELECT l_orderkey, CAST(l_linenumber * 2 - 7 AS BIGINT) AS a,
    CAST(l_orderkey * 2 + 9007199254740993 AS BIGINT) AS big,
    nullif(l_suppkey % 4 * (CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END), 0) AS d,
    l_suppkey % 4 * (CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) AS b FROM lineitem)"""


@query(
    "math_ops",
    f"""WITH {_OPERANDS} SELECT l_orderkey, a, b, a + b AS added, a - b AS subtracted, a * b AS multiplied,
        a / d AS divided, CAST(floor(a / d) AS BIGINT) AS floored, a - CAST(floor(a / d) AS BIGINT) * d AS rest,
        big // d - CASE WHEN big % d <> 0 AND d < 0 THEN 1 ELSE 0 END AS big_floored,
        round(pow(a, b), 9) AS raised, a + b * 0.5::DOUBLE AS mixed FROM operands""",
)
def math_ops(t: Tables):
    a, b = F.col("a"), F.col("b")
    return _operands(t).select(
        "l_orderkey", "a", "b",
        (a + b).alias("added"),
        (a - b).alias("subtracted"),
        (a * b).alias("multiplied"),
        F.try_divide(a, b).alias("divided"),
        numbers.floor_div(a, b).alias("floored"),
        numbers.floor_mod(a, b).alias("rest"),
        numbers.floor_div(F.col("big"), b).alias("big_floored"),
        F.round(F.pow(a, b), 9).alias("raised"),
        (a + b * 0.5).alias("mixed"),
    )


_UFUNCS = {
    "abs": F.abs, "sqrt": lambda x: F.sqrt(F.abs(x)), "exp": F.exp, "log": lambda x: numbers.log_ieee(x + 2),
    "log10": lambda x: F.log10(x + 2), "log2": lambda x: F.log2(x + 2), "log1p": lambda x: F.log1p(x + 2),
    "cos": F.cos, "cosh": F.cosh, "sin": F.sin, "sinh": F.sinh, "tan": F.tan, "tanh": F.tanh,
}
_UFUNC_SQL = {
    "abs": "abs(x)", "sqrt": "sqrt(abs(x))", "exp": "exp(x)", "log": "ln(x + 2)", "log10": "log10(x + 2)",
    "log2": "log2(x + 2)", "log1p": "ln(1 + (x + 2))", "cos": "cos(x)", "cosh": "cosh(x)", "sin": "sin(x)",
    "sinh": "sinh(x)", "tan": "tan(x)", "tanh": "tanh(x)",
}


# At and below the edge of their range, as text.
_EDGES = {
    "log": (0, "ln(x)", numbers.log_ieee), "log10": (0, "log10(x)", numbers.log10_ieee),
    "log2": (0, "log2(x)", numbers.log2_ieee), "log1p": (-1, "ln(1 + x)", numbers.log1p_ieee),
}


@query(
    "math_ufuncs",
    "SELECT l_orderkey, x, "
    + ", ".join(f"round({sql}, 9) + 0.0 AS f_{name}" for name, sql in _UFUNC_SQL.items())
    + "".join(
        f", CASE WHEN x > {edge} THEN CAST(round({sql}, 6) + 0.0 AS VARCHAR) WHEN x = {edge} THEN '-inf' ELSE 'nan' END AS e_{name}"
        for name, (edge, sql, _) in _EDGES.items()
    )
    + " FROM (SELECT l_orderkey, l_tax * 20 - l_discount * 10 AS x FROM lineitem)",
)
def math_ufuncs(t: Tables):
    numbers_in = t.lineitem.select("l_orderkey", (F.col("l_tax") * 20 - F.col("l_discount") * 10).alias("x"))
    x = F.col("x")
    return numbers_in.select(
        "l_orderkey", "x", *[(F.round(f(x), 9) + F.lit(0.0)).alias(f"f_{name}") for name, f in _UFUNCS.items()],
        *[numbers.to_text(F.round(f(x), 6) + F.lit(0.0)).alias(f"e_{name}") for name, (_, _, f) in _EDGES.items()],
    )


@query(
    "math_binary",
    """SELECT l_orderkey, x + y AS added, x - y AS subtracted, x * y AS multiplied, x / y AS divided,
       floor(x / y) AS floored, x - floor(x / y) * y AS rest, round(pow(x, y), 4) AS raised,
       greatest(x, y) AS maximum, least(x, y) AS minimum
       FROM (SELECT l_orderkey, l_quantity AS x, CAST(l_linenumber AS DOUBLE) AS y FROM lineitem)""",
)
def math_binary(t: Tables):
    x, y = F.col("x"), F.col("y")
    pairs = t.lineitem.select(
        "l_orderkey", F.col("l_quantity").alias("x"), F.col("l_linenumber").cast("double").alias("y")
    )
    return pairs.select(
        "l_orderkey",
        (x + y).alias("added"),
        (x - y).alias("subtracted"),
        (x * y).alias("multiplied"),
        (x / y).alias("divided"),
        numbers.floor_div_real(x, y).alias("floored"),
        numbers.floor_mod(x, y).alias("rest"),
        F.round(F.pow(x, y), 4).alias("raised"),
        numbers.maximum(x, y).alias("maximum"),
        numbers.minimum(x, y).alias("minimum"),
    )


def _size(name: str, expression, sql: str):
    """Register one expression over all part sizes."""

    @query(name, f"SELECT p_partkey, p_size, {sql} AS result FROM part")
    def build(t: Tables):
        return t.part.select("p_partkey", "p_size", expression(F.col("p_size")).alias("result"))

    return build


_size("area_circle", lambda r: F.round(numbers.circle_area(r), 6), "round(pi() * p_size * p_size, 6)")
_size("area_rect", lambda b: b * F.col("p_retailprice"), "p_size * p_retailprice")
_size("square", lambda n: F.pow(n, F.lit(2)).cast("bigint"), "CAST(p_size * p_size AS BIGINT)")
_size("is_even", lambda n: n % 2 == 0, "p_size % 2 = 0")


@query(
    "factorial",
    """WITH RECURSIVE f(n, high, low) AS (SELECT 0, 0::HUGEINT, 1::HUGEINT UNION ALL
        SELECT n + 1, high * (n + 1) + low * (n + 1) // e30, low * (n + 1) % e30
        FROM f, (SELECT CAST('1000000000000000000000000000000' AS HUGEINT) AS e30) WHERE n < 50)
       SELECT p_partkey, p_size, CASE WHEN high = 0 THEN CAST(low AS VARCHAR)
        ELSE CAST(high AS VARCHAR) || lpad(CAST(low AS VARCHAR), 30, '0') END AS result FROM part JOIN f ON n = p_size""",
)
def factorial(t: Tables):
    return t.part.select("p_partkey", "p_size", numbers.factorial_text(F.col("p_size")).alias("result"))


@query(
    "divisible_flags",
    """SELECT l_partkey, l_partkey % 5 = 0 AS by_five, l_partkey % 3 = 0 AS by_three,
       CASE WHEN l_partkey % 5 = 0 THEN 'five' WHEN l_partkey % 3 = 0 THEN 'three' END AS first_match FROM lineitem""",
)
def divisible_flags(t: Tables):
    five, three = F.col("l_partkey") % 5 == 0, F.col("l_partkey") % 3 == 0
    return t.lineitem.select(
        "l_partkey",
        five.alias("by_five"),
        three.alias("by_three"),
        F.when(five, "five").when(three, "three").alias("first_match"),
    )


@query(
    "largest_of_three",
    "SELECT l_orderkey, greatest(l_quantity, l_linenumber * 6, l_discount * 300) AS largest FROM lineitem",
)
def largest_of_three(t: Tables):
    return t.lineitem.select(
        "l_orderkey",
        F.greatest("l_quantity", F.col("l_linenumber") * 6, F.col("l_discount") * 300).alias("largest"),
    )


@query(
    "calc_dispatch",
    f"""SELECT o_orderkey, CASE op WHEN '+' THEN a + b WHEN '-' THEN a - b WHEN '*' THEN a * b
        WHEN '/' THEN a / nullif(b, 0) END AS result,
        CASE WHEN op = '/' AND b = 0 THEN '{numbers.DIVISION_BY_ZERO}' WHEN op = '?' THEN '{numbers.UNKNOWN_OPERATION}' END AS error
        FROM (SELECT o_orderkey, o_totalprice AS a, CAST(o_custkey % 7 AS DOUBLE) AS b,
        CASE o_orderpriority WHEN '1-URGENT' THEN '+' WHEN '2-HIGH' THEN '-' WHEN '3-MEDIUM' THEN '*'
        WHEN '4-NOT SPECIFIED' THEN '/' ELSE '?' END AS op FROM orders)""",
)
def calc_dispatch(t: Tables):
    inputs = t.orders.select(
        "o_orderkey",
        F.col("o_totalprice").alias("a"),
        (F.col("o_custkey") % 7).cast("double").alias("b"),
        F.expr(
            "CASE o_orderpriority WHEN '1-URGENT' THEN '+' WHEN '2-HIGH' THEN '-' WHEN '3-MEDIUM' THEN '*'"
            " WHEN '4-NOT SPECIFIED' THEN '/' ELSE '?' END"
        ).alias("op"),
    )
    result, error = numbers.calculate(F.col("a"), F.col("b"), F.col("op"))
    return inputs.select("o_orderkey", result.alias("result"), error.alias("error"))


@query(
    "cast_int",
    """SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS cut, CAST(substr(c_name, 10) AS BIGINT) AS from_text,
       NULL::BIGINT AS from_words FROM customer""",
)
def cast_int(t: Tables):
    return t.customer.select(
        "c_custkey",
        numbers.to_int(F.col("c_acctbal")).alias("cut"),
        numbers.text_to_int(F.substr("c_name", F.lit(10))).alias("from_text"),
        numbers.text_to_int(F.col("c_mktsegment")).alias("from_words"),
    )


@query(
    "cast_float",
    "SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS from_int, c_acctbal AS from_text, NULL::DOUBLE AS from_words FROM customer",
)
def cast_float(t: Tables):
    return t.customer.select(
        "c_custkey",
        F.col("c_nationkey").cast("double").alias("from_int"),
        F.col("c_acctbal").cast("string").try_cast("double").alias("from_text"),
        F.col("c_mktsegment").try_cast("double").alias("from_words"),
    )


@query(
    "cast_str",
    """SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS whole, CAST(l_extendedprice AS VARCHAR) AS price,
       CAST(l_extendedprice * 1000 AS VARCHAR) AS large, CAST(l_quantity AS VARCHAR) AS quantity,
       CASE WHEN l_discount = 0 THEN '0.0' ELSE CAST(l_linenumber AS VARCHAR) || 'e-' || lpad(CAST(l_linenumber + 4 AS VARCHAR), 2, '0') END AS tiny,
       CAST(l_linenumber AS VARCHAR) || '.5e+' || (l_linenumber + 15) AS huge,
       CASE l_linenumber % 3 WHEN 0 THEN 'nan' WHEN 1 THEN 'inf' ELSE '-inf' END AS edge
       FROM lineitem""",
)
def cast_str(t: Tables):
    n = F.col("l_linenumber")
    special = {0: "NaN", 1: "Infinity", 2: "-Infinity"}
    edge = F.element_at(F.create_map(*[F.lit(x) for pair in special.items() for x in pair]), n % 3)
    # One function for all doubles: each is worked out once, and the code of six would be too long for the JVM to compile.
    doubles = {
        "tiny": F.when(F.col("l_discount") == 0, 0.0).otherwise(F.concat(n, F.lit("E-"), n + 4).cast("double")),
        "huge": F.concat(n, F.lit(".5E"), n + 15).cast("double"),
        "edge": edge.cast("double"),
        "price": F.col("l_extendedprice"),
        "large": F.col("l_extendedprice") * 1000,
        "quantity": F.col("l_quantity"),
    }
    texts = F.transform(F.array(*doubles.values()), numbers.to_text)
    found = t.lineitem.select("l_orderkey", n.cast("string").alias("whole"), texts.alias("texts"))
    return found.select("l_orderkey", "whole", *[F.col("texts")[i].alias(name) for i, name in enumerate(doubles)])


@query(
    "cast_bool",
    """SELECT l_orderkey, l_discount <> 0 AS from_number, l_discount <> 0 AS from_text FROM lineitem""",
)
def cast_bool(t: Tables):
    text: Column = F.when(F.col("l_discount") == 0, "").otherwise("0")
    return t.lineitem.select(
        "l_orderkey",
        numbers.truthy_number(F.col("l_discount")).alias("from_number"),
        numbers.truthy_text(text).alias("from_text"),
    )


@query(
    "type_of",
    """SELECT event_id, 'int' AS id_type, 'float' AS value_type, 'str' AS kind_type, 'bool' AS flag_type FROM events""",
)
def type_of(t: Tables):
    return t.events.select(
        "event_id",
        numbers.python_type(F.col("event_id")).alias("id_type"),
        numbers.python_type(F.col("value")).alias("value_type"),
        numbers.python_type(F.col("event_type")).alias("kind_type"),
        numbers.python_type(F.col("value") > 1).alias("flag_type"),
    )


@query(
    "where_label",
    """SELECT l_orderkey, CASE WHEN l_quantity > 30 THEN 'Mayor' ELSE 'Menor o igual' END AS one,
       CASE WHEN l_quantity > 30 AND l_extendedprice < 50000 THEN 'Cumple' ELSE 'No cumple' END AS two FROM lineitem""",
)
def where_label(t: Tables):
    big = F.col("l_quantity") > 30
    return t.lineitem.select(
        "l_orderkey",
        numbers.where(big, "Mayor", "Menor o igual").alias("one"),
        numbers.where(big & (F.col("l_extendedprice") < 50000), "Cumple", "No cumple").alias("two"),
    )


@query(
    "where_positions",
    """SELECT vec_id, place - 1 AS place FROM
       (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS place FROM embeddings)
       WHERE CAST(embedding[place] AS DOUBLE) > 0.2""",
)
def where_positions(t: Tables):
    cells = t.embeddings.select("vec_id", F.posexplode("embedding").alias("place", "v"))
    return cells.filter(F.col("v").cast("double") > 0.2).select("vec_id", F.col("place").cast("bigint").alias("place"))


# The labels of each scale.
_DAYS = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]


@query(
    "bands",
    "SELECT p_partkey, CASE WHEN nota >= 6 THEN 'Excelente' WHEN nota >= 4 THEN 'Aprobado' ELSE 'Reprobado' END AS grade,"
    " CASE dia " + " ".join(f"WHEN {i + 1} THEN '{d}'" for i, d in enumerate(_DAYS)) + " ELSE 'Número inválido' END AS weekday,"
    """ CASE WHEN grados > 30 AND humedad > 70 THEN 'Día muy caluroso y húmedo' WHEN grados > 30 THEN 'Día caluroso'
        WHEN grados >= 20 THEN 'Día agradable' ELSE 'Día frío' END AS weather,
        CASE WHEN grados < 15 THEN 'Hace frío' WHEN grados <= 25 THEN 'Está templado' ELSE 'Hace calor' END AS temperature,
        CASE WHEN edad < 12 THEN 'Niño' WHEN edad <= 17 THEN 'Adolescente' ELSE 'Adulto' END AS age,
        CASE WHEN nota >= 4 AND humedad >= 75 THEN 'Aprobado' ELSE 'Reprobado' END AS attendance,
        CASE WHEN humedad >= 40 THEN 'Aprobado' ELSE 'Reprobado' END AS pass_mark
        FROM (SELECT p_partkey, p_size % 8 AS nota, p_size % 9 AS dia, p_size AS grados, p_partkey % 100 AS humedad,
        p_size % 25 AS edad FROM part)""",
)
def bands(t: Tables):
    scales = t.part.select(
        "p_partkey",
        (F.col("p_size") % 8).alias("nota"),
        (F.col("p_size") % 9).alias("dia"),
        F.col("p_size").alias("grados"),
        (F.col("p_partkey") % 100).alias("humedad"),
        (F.col("p_size") % 25).alias("edad"),
    )
    nota, dia, grados, humedad, edad = (F.col(c) for c in ("nota", "dia", "grados", "humedad", "edad"))
    return scales.select(
        "p_partkey",
        numbers.bands((nota >= 6, "Excelente"), (nota >= 4, "Aprobado"), otherwise="Reprobado").alias("grade"),
        numbers.bands(*[(dia == i + 1, d) for i, d in enumerate(_DAYS)], otherwise="Número inválido").alias("weekday"),
        numbers.bands(
            ((grados > 30) & (humedad > 70), "Día muy caluroso y húmedo"),
            (grados > 30, "Día caluroso"),
            (grados >= 20, "Día agradable"),
            otherwise="Día frío",
        ).alias("weather"),
        numbers.bands((grados < 15, "Hace frío"), (grados <= 25, "Está templado"), otherwise="Hace calor").alias("temperature"),
        numbers.bands((edad < 12, "Niño"), (edad <= 17, "Adolescente"), otherwise="Adulto").alias("age"),
        numbers.where((nota >= 4) & (humedad >= 75), "Aprobado", "Reprobado").alias("attendance"),
        numbers.where(humedad >= 40, "Aprobado", "Reprobado").alias("pass_mark"),
    )
