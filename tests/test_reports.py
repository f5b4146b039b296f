"""Reports, pivots, joins and missing values on small fixtures."""

import math

import pytest
from pyspark.sql import functions as F

from quipu.operators import combining, grouping, missing, profile, statistics

NAN = float("nan")


@pytest.fixture(scope="module")
def sales(spark):
    rows = [
        ("Norte", "Uva", 2, 100), ("Norte", "Pera", 1, 50), ("Sur", "Uva", 3, 100), ("Online", "Piña", 1, 700),
        (None, "Uva", 1, 10), ("Sur", None, 2, 5),
    ]
    return spark.createDataFrame(rows, "zona string, producto string, cantidad int, precio bigint")


def test_sales_summary(sales):
    got = grouping.sales_summary(sales, "zona", "producto", F.col("cantidad") * F.col("precio"))
    assert got.columns == ["descripcion", "valor", "tipo"]
    assert sorted(map(tuple, got.collect())) == sorted(
        [
            ("Norte", 250, "Zonas"), ("Sur", 310, "Zonas"), ("Online", 700, "Zonas"),
            ("Uva", 510, "Productos"), ("Pera", 50, "Productos"), ("Piña", 700, "Productos"),
            ("Venta", 1270, "Resumen"), ("Registros", 6, "Resumen"),
        ]
    )


def test_sales_summary_of_nothing(sales):
    got = grouping.sales_summary(sales.filter("precio < 0"), "zona", "producto", F.col("cantidad") * F.col("precio"))
    assert sorted(map(tuple, got.collect())) == [("Registros", 0, "Resumen"), ("Venta", 0, "Resumen")]


def test_sales_summary_with_labels(spark, sales):
    labels = spark.createDataFrame([("Norte", "N"), ("Sur", "S"), ("Online", "S")], "zona string, label string")
    got = grouping.sales_summary(sales, "zona", "producto", F.col("cantidad") * F.col("precio"), zones=labels)
    zones = {r["descripcion"]: r["valor"] for r in got.collect() if r["tipo"] == "Zonas"}
    assert zones == {"N": 250, "S": 1010}


@pytest.fixture(scope="module")
def cells(spark):
    rows = [("kayak", "lago", 11, 2), ("remo", "lago", 7, 9), ("kayak", "mar", 4, 1), ("vela", "mar", 25, 3), ("vela", None, 6, 5)]
    return spark.createDataFrame(rows, "item string, place string, sold int, buyers int")


def test_pivot_unique_finds_its_columns(cells):
    one = grouping.pivot_unique(cells, "item", "place", ["sold"])
    assert one.columns == ["item", "lago", "mar", "null"]
    assert sorted(map(tuple, one.collect())) == [("kayak", 11, 4, None), ("remo", 7, None, None), ("vela", None, 25, 6)]
    two = grouping.pivot_unique(cells, "item", "place", ["sold", "buyers"])
    assert two.columns[1:3] == ["lago_sold", "lago_buyers"]


def test_pivot_unique_refuses_repeated_cells(cells):
    doubled = cells.unionByName(cells.filter("place = 'mar'"))
    with pytest.raises(Exception, match="two rows for one cell"):
        grouping.pivot_unique(doubled, "item", "place", ["sold"]).collect()


def test_pivot_refuses_what_is_not_listed(cells):
    for values in (["lago"], ["lago", "mar"]):
        with pytest.raises(Exception, match="is not listed"):
            grouping.pivot_table(cells, "item", "place", [F.sum("sold")], values).collect()
    with pytest.raises(ValueError, match="more than 2"):
        grouping.pivot_unique(cells, "item", "place", ["sold"], most=2)
    known = grouping.pivot_table(cells.filter("place IS NOT NULL"), "item", "place", [F.sum("sold")], ["mar", "lago"])
    assert known.columns == ["item", "mar", "lago"] and known.count() == 3


def test_pivot_table_sums_and_fills(cells):
    got = grouping.pivot_table(cells.unionByName(cells), "item", "place", [F.sum("sold")], fill=0)
    assert sorted(map(tuple, got.collect())) == [("kayak", 22, 8, 0), ("remo", 14, 0, 0), ("vela", 0, 50, 12)]


def test_counts_in_order_of_the_value(spark):
    df = spark.createDataFrame([(v,) for v in (8, 3, 3, 5, None, 8, 3)], "v int")
    assert [tuple(r) for r in grouping.value_counts(df, "v", by_value=True).collect()] == [(3, 3), (5, 1), (8, 2)]


def test_sets_fold_repeats_and_match_missing(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (None,), (None,), (4,)], "j int")
    assert sorted(map(str, (r[0] for r in combining.intersection(a, b).collect()))) == ["1", "None"]
    assert [r[0] for r in combining.difference(a, b).collect()] == [2]


def test_value_counts_leave_out_missing(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "v string")
    assert [tuple(r) for r in grouping.value_counts(df, "v").collect()] == [("b", 2), ("a", 1)]


def test_merge_matches_missing_keys(spark):
    left = spark.createDataFrame([(1, "p"), (2, "q"), (None, "r")], "id int, left_text string")
    right = spark.createDataFrame([(2, "x"), (None, "y"), (4, "z")], "id int, right_text string")
    inner = combining.merge(left, right, ["id"]).collect()
    assert sorted(map(str, map(tuple, inner))) == ["(2, 'q', 'x')", "(None, 'r', 'y')"]
    assert combining.merge(left, right, ["id"], "left").count() == 3
    with pytest.raises(ValueError):
        combining.merge(left, right, ["id"], "right")


def test_membership_keeps_rows_once(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    members = spark.createDataFrame([(2,), (2,), (3,)], "k int")
    got = combining.with_membership(df, "k", members, "m").collect()
    assert {r["k"]: r["m"] for r in got} == {1: False, 2: True, None: False} and len(got) == 3


def test_most_keeps_ties(spark):
    df = spark.createDataFrame([("north", 7.5), ("south", 7.5), ("east", 1.0)], "c string, v double")
    assert sorted(r["c"] for r in combining.most(df, "v").collect()) == ["north", "south"]


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame([("ax", 12.0, 40.0), ("by", 20.0, NAN), ("cz", None, 90.0)], "n string, age double, pay double")


def test_fill(gaps):
    got = missing.fill_with(gaps, {"age": "mean", "pay": "max"}).orderBy("n").collect()
    assert [tuple(r) for r in got] == [("ax", 12.0, 40.0), ("by", 20.0, 90.0), ("cz", 16.0, 90.0)]
    means = missing.fill_mean(gaps).orderBy("n").collect()
    assert [r["pay"] for r in means] == [40.0, 65.0, 90.0]


def test_masks_and_counts(gaps):
    assert [tuple(r) for r in missing.missing_mask(gaps, ["n"]).orderBy("n").collect()] == [
        ("ax", False, False), ("by", False, True), ("cz", True, False),
    ]
    assert {r["column_name"]: r["missing"] for r in profile.null_counts(gaps).collect()} == {"n": 0, "age": 1, "pay": 1}
    assert {r["column_name"]: r["n_distinct"] for r in profile.nunique(gaps).collect()} == {"n": 3, "age": 2, "pay": 2}


def test_describe(gaps):
    row = {r["column_name"]: r for r in profile.describe(gaps).collect()}["pay"]
    assert (row["count"], row["mean"], row["min"], row["max"], row["q25"], row["q50"], row["q75"]) == (2, 65.0, 40.0, 90.0, 52.5, 65.0, 77.5)
    assert row["std"] == pytest.approx(math.sqrt(1250))


def test_duplicates(spark):
    df = spark.createDataFrame([(1, NAN), (1, NAN), (1, None), (1, None), (1, None), (2, 1.0)], "a int, b double")
    assert missing.duplicate_count(df).first()[0] == 3
    values = spark.createDataFrame(list(enumerate([6, 2, 90, 2, 31, 14, 6])), "pos int, v int")
    assert tuple(missing.first_duplicate(values, "v", "pos").first()) == (6, 2, 0)
    assert missing.first_duplicate(values.filter("pos < 3"), "v", "pos").count() == 0


def test_totals_and_shares(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v int")
    assert {r["k"]: r["t"] for r in profile.with_total(df, "v", "t").collect()} == {"a": 4, "b": 4}
    assert {r["k"]: r["s"] for r in profile.with_share(df, "v", "s").collect()} == {"a": 0.25, "b": 0.75}
    assert profile.with_total(df.filter("v > 9"), "v", "t").count() == 0


def test_histogram_edges(spark):
    import numpy as np

    values = [0.0, 0.1, 0.3, 0.5, 0.7, 0.7, 0.9, 1.0, 1.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = statistics.histogram(df, "v", 10).orderBy("bin").collect()
    counts, edges = np.histogram([v for v in values if v is not None], 10)
    assert [r["n"] for r in got] == counts.tolist()
    assert np.allclose([r["left"] for r in got] + [got[-1]["right"]], edges)
    one = statistics.histogram(spark.createDataFrame([(5.0,), (5.0,)], "v double"), "v", 4).orderBy("bin").collect()
    counts, edges = np.histogram([5.0, 5.0], 4)
    assert [r["n"] for r in one] == counts.tolist() and one[0]["left"] == edges[0]


def test_density_integrates_to_about_one(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    values = rng.normal(size=400)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = statistics.density(df, "v", points=101).orderBy("point").collect()
    width = values.std(ddof=1) * 400 ** -0.2
    for r in got[::25]:
        expected = np.exp(-0.5 * ((r["x"] - values) / width) ** 2).sum() / (400 * width * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(expected)


def test_corr_leaves_out_missing_pairs(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.0, None), (3.0, NAN, 1.0), (4.0, 8.5, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["a"], r["b"]): r["r"] for r in statistics.corr_matrix(df, ["a", "b", "c"]).collect()}
    import pandas as pd

    expected = pd.DataFrame(rows, columns=["a", "b", "c"]).corr()
    for (a, b), r in got.items():
        assert r == pytest.approx(expected.loc[a, b])
