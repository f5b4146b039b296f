"""Column expressions against the Python they stand for."""

import math

import pytest
from pyspark.sql import functions as F

from quipu.functions import arrays, numbers, strings

TEXTS = [
    "", " ", "hola mundo", "Hola Mundo", "o'hara they're 3rd-party", "  \t padded \n", "a,b,,c,", "BANANA banana",
    "straße ßa", "àé ÑANDÚ", "12-3", "123", "abc", "abc\n", "x y", "+7", "-42", "00042", "a\nb c",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, s string")


def run(texts, expression):
    return [r["r"] for r in texts.orderBy("id").select(expression.alias("r")).collect()]


@pytest.mark.parametrize(
    "ours, python",
    [
        (lambda s: strings.strip(s), str.strip),
        (lambda s: strings.lstrip(s), str.lstrip),
        (lambda s: strings.rstrip(s), str.rstrip),
        (lambda s: strings.words(s), str.split),
        (lambda s: strings.split_at(s, ","), lambda t: t.split(",")),
        (lambda s: strings.characters(s), list),
        (lambda s: strings.capitalize(s), str.capitalize),
        (lambda s: strings.title(s), str.title),
        (lambda s: strings.swapcase(s), str.swapcase),
        (lambda s: strings.find(s, "an"), lambda t: t.find("an")),
        (lambda s: strings.count(s, "an"), lambda t: t.count("an")),
        (lambda s: strings.count_any(s, "aeiouAEIOU"), lambda t: sum(c in "aeiouAEIOU" for c in t)),
        (lambda s: strings.is_alpha(s), str.isalpha),
        (lambda s: strings.is_digit(s), str.isdigit),
        (lambda s: strings.zfill(s, 5), lambda t: t.zfill(5)),
        (lambda s: F.char_length(s), len),
        (lambda s: F.upper(s), str.upper),
        (lambda s: F.lower(s), str.lower),
        (lambda s: numbers.truthy_text(s), bool),
    ],
)
def test_text(texts, ours, python):
    assert run(texts, ours(F.col("s"))) == [python(t) for t in TEXTS]


PAIRS = [(7, 3), (7, -3), (-7, 3), (-7, -3), (6, 3), (-6, 3), (0, 5), (1, 0), (2**53 + 1, 1), (-(2**62) - 1, 2), (2**62 + 1, -3)]


def test_floor_division_and_remainder(spark):
    df = spark.createDataFrame(PAIRS, "a bigint, b bigint")
    a, b = F.col("a"), F.col("b")
    got = df.select("a", "b", numbers.floor_div(a, b).alias("d"), numbers.floor_mod(a, b).alias("m")).collect()
    for r in got:
        if r["b"] == 0:
            assert r["d"] is None and r["m"] is None
        else:
            assert (r["d"], r["m"]) == divmod(r["a"], r["b"])


def test_nan_rules(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, nan), (nan, 2.0), (3.0, 2.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    rows = df.select(
        numbers.maximum(a, b).alias("mx"), numbers.minimum(a, b).alias("mn"),
        numbers.fmax(a, b).alias("fx"), numbers.fmin(a, b).alias("fn"),
    ).collect()
    assert all(math.isnan(r["mx"]) and math.isnan(r["mn"]) for r in rows[:2])
    assert [(r["fx"], r["fn"]) for r in rows] == [(1.0, 1.0), (2.0, 2.0), (3.0, 2.0)]
    assert (rows[2]["mx"], rows[2]["mn"]) == (3.0, 2.0)


@pytest.mark.parametrize(
    "name, edge, at_one",
    [("log_ieee", 0.0, math.e), ("log10_ieee", 0.0, 10.0), ("log2_ieee", 0.0, 2.0), ("log1p_ieee", -1.0, math.e - 1)],
)
def test_log_at_its_edge_and_below(spark, name, edge, at_one):
    df = spark.createDataFrame([(edge,), (edge - 1,), (at_one,), (None,)], "x double")
    zero, below, one, missing = (r[0] for r in df.select(getattr(numbers, name)(F.col("x"))).collect())
    assert zero == -math.inf and math.isnan(below) and one == pytest.approx(1.0) and missing is None


def test_floor_division_of_doubles(spark):
    pairs = [(7.5, 2.0), (-7.5, 2.0), (1e300, 1e-5), (3.0, -0.7), (0.0, 5.0)]
    df = spark.createDataFrame(pairs, "a double, b double")
    got = [r[0] for r in df.select(numbers.floor_div_real(F.col("a"), F.col("b"))).collect()]
    assert got == [math.floor(a / b) if abs(a / b) < 1e16 and a / b == a / b else a / b for a, b in pairs]
    assert all(isinstance(v, float) for v in got)


def test_factorial_of_any_size(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 5, 20, 21, 34, 100, 170, -1, None)], "n int")
    got = [r[0] for r in df.select(numbers.factorial_text(F.col("n"))).collect()]
    assert got == [str(math.factorial(n)) for n in (0, 1, 5, 20, 21, 34, 100, 170)] + [None, None]


def test_doubles_as_text(spark):
    values = [1e-5, 1.25e-7, -3e-12, 1e16, 1.25e17, -2e300, math.inf, -math.inf, math.nan, 0.0, -0.0, 2.5e-308, None, 1e-4, 9999999999999998.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(numbers.to_text(F.col("x"))).collect()] == [None if v is None else str(v) for v in values]


def test_casts(spark):
    values = [3.9, -3.9, 0.0, 23.0, 12345678.9, 0.1 + 0.2, 1234567890123.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select(numbers.to_int(F.col("x")).alias("i"), numbers.to_text(F.col("x")).alias("t"),
                     numbers.truthy_number(F.col("x")).alias("b")).collect()
    assert [r["i"] for r in rows] == [int(v) for v in values]
    assert [r["t"] for r in rows] == [str(v) for v in values]
    assert [r["b"] for r in rows] == [bool(v) for v in values]
    words = spark.createDataFrame([("42",), (" 7 ",), ("3.9",), ("word",)], "s string")
    assert [r[0] for r in words.select(numbers.text_to_int(F.col("s"))).collect()] == [42, 7, None, None]


def test_calculation(spark):
    df = spark.createDataFrame([(10.0, 5.0, "+"), (10.0, 5.0, "/"), (1.0, 0.0, "/"), (1.0, 2.0, "%")], "a double, b double, op string")
    result, error = numbers.calculate(F.col("a"), F.col("b"), F.col("op"))
    assert [tuple(r) for r in df.select(result, error).collect()] == [
        (15.0, None), (2.0, None), (None, "Error: división por cero"), (None, "Operación no válida"),
    ]


def test_where_treats_null_as_false(spark):
    df = spark.createDataFrame([(5,), (1,), (None,)], "a int")
    assert [r[0] for r in df.select(numbers.where(F.col("a") > 3, "Mayor", "")).collect()] == ["Mayor", "", ""]


LISTS = [[], [4], [2, 7, 2, 9], [1, 2, 3, 4, 5, 6, 7]]


@pytest.fixture(scope="module")
def lists(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(LISTS)], "id int, a array<bigint>")


@pytest.mark.parametrize("start, stop, step", [(0, None, 1), (1, 4, 1), (0, 3, 1), (2, None, 1), (0, None, 2), (0, -1, 1), (-2, None, 1), (5, 2, 1)])
def test_slices(lists, start, stop, step):
    got = [r[0] for r in lists.orderBy("id").select(arrays.cut(F.col("a"), start, stop, step)).collect()]
    assert got == [v[start:stop:step] for v in LISTS]


def test_list_edits(lists):
    a = F.col("a")
    two = F.lit(2).cast("bigint")
    row = lists.filter("id = 2").select(
        arrays.insert_at(a, 1, two).alias("insert"), arrays.insert_at(a, 9, two).alias("insert_end"),
        arrays.remove_first(a, two).alias("remove"), arrays.pop_at(a, -1).alias("pop"),
        arrays.pop_at(a, 1).alias("pop_at"), arrays.set_at(a, -1, two).alias("set"),
        arrays.index_of(a, two).alias("index"), arrays.count_of(a, two).alias("count"),
        arrays.times(a, 2).alias("times"), arrays.item(a, -2).alias("item"), arrays.item(a, 9).alias("none"),
    ).first()
    assert row.asDict() == {
        "insert": [2, 2, 7, 2, 9], "insert_end": [2, 7, 2, 9, 2], "remove": [7, 2, 9], "pop": [2, 7, 2],
        "pop_at": [2, 2, 9], "set": [2, 7, 2, 2], "index": 0, "count": 2, "times": [2, 7, 2, 9] * 2,
        "item": 2, "none": None,
    }


def test_grades(spark):
    df = spark.createDataFrame([([],), ([5, 6, 7, 3, 8],), ([1, 2],)], "a array<int>")
    got = [tuple(r[0]) for r in df.select(arrays.grade_summary(F.col("a"))).collect()]
    assert got == [(0.0, 0.0, 0.0, False), (5.8, 8.0, 3.0, True), (1.5, 2.0, 1.0, False)]


def test_maps(spark):
    df = spark.createDataFrame([({"a": 1, "b": None},)], "m map<string, int>")
    m = F.col("m")
    row = df.select(
        arrays.get(m, F.lit("a")).alias("a"), arrays.get(m, F.lit("z"), F.lit(9)).alias("z"),
        arrays.get(m, F.lit("b"), F.lit(9)).alias("b"), arrays.put(m, F.lit("a"), F.lit(5)).alias("put"),
        arrays.set_default(m, F.lit("a"), F.lit(5)).alias("kept"), arrays.set_default(m, F.lit("c"), F.lit(5)).alias("added"),
        arrays.without_key(m, F.lit("a")).alias("deleted"),
    ).first()
    assert row.asDict() == {
        "a": 1, "z": 9, "b": None, "put": {"a": 5, "b": None}, "kept": {"a": 1, "b": None},
        "added": {"a": 1, "b": None, "c": 5}, "deleted": {"b": None},
    }


def test_type_names(spark):
    row = spark.range(1).select(
        numbers.python_type(F.lit(2)), numbers.python_type(F.lit(2.0)), numbers.python_type(F.lit("Hola")),
        numbers.python_type(F.lit(True)), numbers.python_type(F.lit(None)), numbers.python_type(F.array(F.lit(1))),
    ).first()
    assert list(row) == ["int", "float", "str", "bool", "NoneType", "list"]


def test_text_of_doubles_at_the_edges_of_each_form(spark):
    values = [1e-9, 9.999999999999999e-10, 1e-10, 2.5e-7, 9.9e-5, 1e-4, 0.00012345678901234567, 9.87e-4, 1e-3, 9999999.5, 1e7, 10000000.25,
              123456789.0, 1e15 + 0.5, 9007199254740994.0, 9999999999999998.0, 1e16, 1.25e100, 1e-300, 1.7e308]
    values += [-v for v in values]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(numbers.to_text(F.col("x"))).collect()] == [str(v) for v in values]


def test_text_of_doubles_takes_no_patterns(spark):
    text = spark.range(1).select(numbers.to_text(F.rand())).select("*")._jdf.queryExecution().toString()
    assert "regexp" not in text and "split(" not in text
