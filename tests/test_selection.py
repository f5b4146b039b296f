"""Wide cross tables, digest-first duplicates, value folds, co-moments, slices by rank and grid products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quipu import storage
from quipu.operators import grouping, matrix, missing, ordering, profile, statistics
from quipu.plans import load
from tests.test_plans import plan

NAN = math.nan


# Cross tables without a limit of columns


@pytest.fixture(scope="module")
def wide(spark):
    rows = [(f"r{i % 3}", i // 3, i, float(i) if i % 7 else None) for i in range(15_000)]
    return spark.createDataFrame(rows, "item string, place int, sold int, price double").repartition(8)


def test_maps_hold_every_cell_of_5000_columns(wide):
    got = {r["item"]: r for r in grouping.pivot_unique_maps(wide, "item", "place", ["sold", "price"]).collect()}
    assert set(got) == {"r0", "r1", "r2"}
    for k in range(3):
        row = got[f"r{k}"]
        assert row["sold"] == {str(p): 3 * p + k for p in range(5000)}
        assert row["price"] == {str(p): float(3 * p + k) if (3 * p + k) % 7 else None for p in range(5000)}
    keys = grouping.pivot_unique_maps(wide, "item", "place", ["sold"]).select(F.map_keys("sold").alias("k")).first()["k"]
    assert keys == sorted(map(str, range(5000)))
    sums = grouping.pivot_maps(wide.unionByName(wide), "item", "place", {"n": F.count("*"), "top": F.max("sold")}).collect()
    assert all(set(r["n"].values()) == {2} and len(r["n"]) == 5000 for r in sums)
    assert {r["item"]: r["top"] for r in sums} == {f"r{k}": {str(p): 3 * p + k for p in range(5000)} for k in range(3)}


def test_maps_of_many_columns_are_cut_and_lose_no_cell(spark, wide):
    few = spark.createDataFrame([(None, p, p, 1.0) for p in range(1500)] + [("few", p, p, 1.0) for p in range(3)], wide.schema)
    maps = grouping.pivot_maps(wide.unionByName(few), "item", "place", {"n": F.count("*"), "top": F.max("sold")}, most=1000)
    rows = maps.select("*", F.map_keys("n").alias("places"), F.map_keys("top").alias("same")).collect()
    per = {k: [r for r in rows if r["item"] == k] for k in ("r0", "r1", "r2", None, "few")}
    assert len(per["few"]) == 1 and len(per[None]) == 2 and all(4 <= len(per[f"r{k}"]) <= 6 for k in range(3))
    assert all(r["places"] == r["same"] == sorted(r["n"]) and len(r["n"]) < 2000 for r in rows)
    for k in range(3):
        cells = [c for r in per[f"r{k}"] for c in r["top"].items()]
        assert len(cells) == 5000 and dict(cells) == {str(p): 3 * p + k for p in range(5000)}
    assert sorted(c for r in per[None] for c in r["top"].items()) == sorted((str(p), p) for p in range(1500))
    once = grouping.pivot_unique_maps(wide, "item", "place", ["sold"], most=1000).collect()
    assert len(once) >= 12 and sum(len(r["sold"]) for r in once) == 15_000


def test_no_label_is_looked_up_in_a_map(spark):
    text = plan(load()["pivot_maps"](spark, "/root/testdata/sf0.001"))
    assert "element_at" not in text


def test_wide_tables_name_the_way_that_holds(wide):
    with pytest.raises(ValueError, match="pivot_maps"):
        grouping.pivot_table(wide, "item", "place", [F.sum("sold")])


def test_maps_refuse_repeated_cells_and_double_labels(spark, wide):
    with pytest.raises(Exception, match="two rows for one cell"):
        grouping.pivot_unique_maps(wide.unionByName(wide.limit(1)), "item", "place", ["sold"]).collect()
    mixed = spark.createDataFrame([("a", None, 1), ("a", "null", 2)], "i string, c string, v int")
    with pytest.raises(ValueError, match="missing values and the text"):
        grouping.pivot_maps(mixed, "i", "c", {"v": F.sum("v")})
    known = grouping.pivot_maps(mixed.filter("c IS NULL"), "i", "c", {"v": F.sum("v")}).first()
    assert known["v"] == {"null": 1}
    assert grouping.pivot_maps(mixed.filter("false"), "i", "c", {"v": F.sum("v")}).collect() == []


# Duplicates


def repeated_rows(spark, n=600):
    rng = random.Random(2)
    rows = [(rng.randrange(40), rng.choice(["x" * 200, "y", None]), rng.choice([0.0, -0.0, NAN, None]), [rng.randrange(2)]) for _ in range(n)]
    return spark.createDataFrame(rows, "a int, `b.c` string, d double, e array<int>").repartition(6)


@pytest.mark.parametrize("digest", [None, "1", "a % 3"])
def test_digests_first(spark, digest):
    """Also where digests clash, for some rows or for all."""
    df, digest = repeated_rows(spark), digest and F.expr(digest)
    plain = df.dropDuplicates()
    key = lambda rows: sorted(str(r).replace("-0.0", "0.0") for r in rows)
    got = missing.drop_duplicates(df, digest)
    assert got.columns == df.columns and key(got.collect()) == key(plain.collect())
    assert missing.duplicate_count(df, digest).first()[0] == df.count() - plain.count()


def test_unique_wide_rows_are_not_shuffled(spark):
    df = spark.range(0, 4000, 1, 8).select("id", F.repeat(F.col("id").cast("string"), 300).alias("text"))
    got = missing.drop_duplicates(df.unionByName(df.limit(3)))
    assert got.count() == 4000
    text = plan(missing.drop_duplicates(df))
    assert "LeftAnti" in text and "BroadcastHashJoin" in text


def test_missing_values_have_their_own_digests(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (1, 1)], "a int, b int")
    assert df.select(missing.row_digest(df)).distinct().count() == 3


def test_duplicates_of_nothing(spark):
    empty = repeated_rows(spark).filter("false")
    assert missing.drop_duplicates(empty).count() == 0 and missing.duplicate_count(empty).first()[0] == 0


# Distinct values


def test_nunique_in_one_fold(spark):
    rng = random.Random(3)
    kinds = ["int", "bigint", "double", "float", "string", "boolean", "date", "timestamp", "timestamp_ntz", "decimal(12,3)", "binary"]
    columns = [F.when(F.col("id") % (i + 2) > 0, (F.hash("id", F.lit(i)) % (i * 3 + 1))).alias(f"n{i}") for i in range(20)]
    numbers = spark.range(0, 3000, 1, 6).select("id", *columns)
    casts = [F.col(f"n{i}").cast(k if k in ("int", "bigint", "double", "float", "string", "boolean", "decimal(12,3)") else "int").alias(f"n{i}") for i, k in enumerate(kinds)]
    df = numbers.select("id", *casts, *[f"n{i}" for i in range(len(kinds), 20)])
    df = df.withColumns({"n6": F.date_add(F.lit("2020-01-01"), F.col("n6")), "n7": F.timestamp_seconds("n7"), "n10": F.col("n10").cast("string").cast("binary")})
    df = df.withColumn("n8", F.lit("2021-05-06 07:08:09").cast("timestamp_ntz")).withColumn("nest", F.array("n0", "n1"))
    df = df.withColumn("d", F.when(F.col("id") % 3 == 0, F.lit(NAN)).when(F.col("id") % 3 == 1, F.lit(-0.0)).otherwise(F.lit(0.0)))
    got = {r["column_name"]: r["n_distinct"] for r in profile.nunique(df).collect()}
    rows = [r.asDict() for r in df.collect()]
    for c in df.columns:
        values = [r[c] for r in rows if r[c] is not None and r[c] == r[c]]
        assert got[c] == len({tuple(v) if isinstance(v, list) else bytes(v) if isinstance(v, bytearray) else v for v in values}), c
    flat = profile.nunique(numbers)
    assert "Expand" not in plan(flat) and rng
    assert profile.nunique(numbers.filter("false")).filter("n_distinct > 0").count() == 0


# Correlations


def plain_corr(x, y):
    both = ~(np.isnan(x) | np.isnan(y))
    x, y = x[both], y[both]
    if len(x) < 2 or x.std() == 0 or y.std() == 0:
        return None
    return float(np.corrcoef(x, y)[0, 1])


@pytest.mark.parametrize("shift", [0.0, 1e9])
def test_corr_with_missing_values_and_large_means(spark, shift):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 6)) @ rng.normal(size=(6, 6)) + shift
    x[:, 4] = 3.0
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 5] = np.nan
    x[0, 5] = 1.0
    names = [f"c.{i}" for i in range(6)]
    df = spark.createDataFrame([tuple(float(v) for v in r) for r in x], ", ".join(f"`{c}` double" for c in names)).repartition(5)
    got = {(r["a"], r["b"]): r["r"] for r in statistics.corr_matrix(df, names).collect()}
    assert len(got) == 36
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            want = plain_corr(x[:, i], x[:, j])
            assert got[a, b] is None if want is None else got[a, b] == pytest.approx(want, abs=1e-7 if shift else 1e-12), (a, b)
            assert got[a, b] == got[b, a]


def test_corr_of_500_columns(spark):
    n, d = 300, 500
    df = spark.range(0, n, 1, 6).select(*[(F.sin(F.col("id") * (i + 1) * 0.37) * 5 + F.cos(F.col("id") * 0.11)).alias(f"c{i}") for i in range(d)]).cache()
    x = np.array([list(r) for r in df.collect()])
    want = np.corrcoef(x, rowvar=False)
    names = {f"c{i}": i for i in range(d)}
    got = statistics.corr_matrix(df, list(names)).toPandas()
    assert len(got) == d * d
    assert np.allclose(got["r"], want[got["a"].map(names), got["b"].map(names)], atol=1e-9)


def test_corr_of_nothing(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert statistics.corr_matrix(df, ["a", "b"]).filter("r IS NOT NULL").count() == 0


# Slices


def slice_rows():
    rng = random.Random(4)
    return [(i, rng.choice([None, 1.5, 2.0, NAN, rng.random()]), rng.choice(["a", None, "é", "b"])) for i in range(3000)]


@pytest.mark.parametrize("start, stop", [(700, 2100), (-300, None), (None, -2999), (1500, 1503), (2990, 99999), (10, 5), (-5000, 40)])
def test_slices_by_rank(spark, start, stop):
    rows = slice_rows()
    df = spark.createDataFrame(rows, "id long, v double, s string").repartition(7)
    got = ordering.row_slice(df, start, stop, ordering.Descending(F.col("s")), F.col("v"), F.col("id"), sorted_rows=60)
    text = lambda s: (s is None, [-b for b in (s or "").encode()])
    number = lambda v: (v is not None, v is not None and v != v, 0 if v is None or v != v else v)
    want = sorted(rows, key=lambda r: (text(r[2]), number(r[1]), r[0]))[start:stop]
    assert sorted(r["id"] for r in got.collect()) == sorted(r[0] for r in want)
    assert got.columns == df.columns


def test_slices_sort_few_rows(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(ordering, "stage", lambda df, label: stored.append(storage.stage(df, label)) or stored[-1])
    df = spark.range(0, 20_000, 1, 8).select(F.xxhash64("id").alias("v"), "id", F.lit("x").alias("_row"))
    got = ordering.row_slice(df, 5_000, -5_000, F.col("v"), sorted_rows=500)
    assert got.count() == 10_000
    assert sum(s.count() for s in stored) < 3_000
    want = sorted(r["v"] for r in df.collect())[5_000:-5_000]
    assert sorted(r["v"] for r in got.collect()) == want


def test_slice_of_one_value_and_of_nothing(spark):
    same = spark.range(0, 5000, 1, 6).select(F.lit(1).alias("v"))
    assert ordering.row_slice(same, 100, 300, F.col("v"), sorted_rows=50).count() == 200
    assert ordering.row_slice(same.filter("false"), 0, 5, F.col("v")).count() == 0


# Matrix products


def as_cells(spark, x):
    return spark.createDataFrame([(int(i), int(j), float(v)) for (i, j), v in np.ndenumerate(x) if v], "i long, j long, v double")


@pytest.mark.parametrize("shape", [(37, 3, 41), (3, 90, 2), (20, 20, 20), (1, 1, 1)])
def test_products_on_a_grid(spark, shape):
    rng = np.random.default_rng(5)
    a, b = rng.integers(-3, 4, shape[:2]), rng.integers(-3, 4, shape[1:])
    got = matrix.multiply(as_cells(spark, a), as_cells(spark, b), block=4, tile=2, inner=3)
    out = np.zeros((shape[0], shape[2]))
    for r in got.collect():
        assert r["v"] != 0
        out[r["i"], r["j"]] = r["v"]
    assert (out == a @ b).all()


def test_a_short_inner_side_is_no_hot_key(spark):
    """All blocks share the one inner block; the grid still deals them to many keys."""
    rng = np.random.default_rng(6)
    a, b = as_cells(spark, rng.integers(1, 5, (80, 4))), as_cells(spark, rng.integers(1, 5, (4, 80)))
    cells = matrix.grid_cells(a, b, block=4, tile=2, inner=3)
    sizes = [r["count"] for r in cells.groupBy("gi", "gj", "gk").count().collect()]
    assert len(sizes) == 100 and max(sizes) == 4


def test_a_long_inner_side_is_shared(spark):
    a = as_cells(spark, np.ones((4, 200)))
    cells = matrix.grid_cells(a, matrix.transpose(a), block=4, tile=2, inner=5)
    assert max(r["count"] for r in cells.groupBy("gi", "gj", "gk").count().collect()) == 10


def test_product_with_nothing(spark):
    a = as_cells(spark, np.ones((2, 2)))
    assert matrix.multiply(a, a.filter("false")).count() == 0 and matrix.multiply(a.filter("false"), a).count() == 0


# Density curves


@pytest.mark.parametrize("kind", ["normal", "heavy", "two"])
def test_density_equals_the_sum_over_all_values(spark, kind):
    rng = np.random.default_rng(7)
    x = {"normal": rng.normal(50, 3, 5000), "heavy": rng.standard_cauchy(3000), "two": np.repeat([1.0, 2.0], [5, 900])}[kind]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (NAN,)], "v double").repartition(6)
    got = statistics.density(df, "v", points=77).orderBy("point").collect()
    width = x.std(ddof=1) * len(x) ** -0.2
    at = np.linspace(x.min(), x.max(), 77)
    want = np.exp(-0.5 * ((at[:, None] - x[None, :]) / width) ** 2).sum(axis=1) / (len(x) * width * math.sqrt(2 * math.pi))
    assert [r["point"] for r in got] == list(range(77))
    assert np.allclose([r["x"] for r in got], at)
    assert np.abs(np.array([r["density"] for r in got]) - want).max() < 1e-14 * len(x) * want.max()
    assert np.abs(np.array([r["density"] for r in got]) - want).max() < 1e-12 * want.max()


def test_density_folds_before_it_meets_the_points(spark):
    df = spark.range(0, 50_000, 1, 8).select((F.col("id") / 7.0).alias("v"))
    text = plan(statistics.density(df, "v", points=200))
    # Upwards: the fold to cells, then the points, then their sums.
    assert text.rindex("sum((cast(_n") > text.index("Generate") if "sum((cast(_n" in text else text.index("Generate") < text.rindex("HashAggregate")


def test_density_without_spread(spark):
    same = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert statistics.density(same, "v").collect() == [] and statistics.density(same.filter("false"), "v").collect() == []
