"""Positions, ranks and quantiles on skewed rows, against plain Python."""

import os
import random
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from quipu import storage
from quipu.operators import matrix, ordering, quantiles


@pytest.fixture(scope="module")
def rows():
    """A third of the rows share one key, and a third of those share one value."""
    rng = random.Random(7)
    out = []
    for i in range(6000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        value = 5.0 if i % 9 == 0 else round(rng.gauss(0, 30), 1)
        out.append((i, key, value))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "id bigint, key string, value double").repartition(6).cache()


def test_position_over_all_rows(table, rows):
    got = ordering.with_position(table, F.col("value"), F.col("id")).collect()
    expected = {r[0]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])))}
    assert {r["id"]: r["position"] for r in got} == expected


def test_position_within_skewed_keys(table, rows):
    got = ordering.with_position(table, F.col("value"), F.col("id"), by=["key"]).collect()
    expected, seen = {}, {}
    for i, key, value in sorted(rows, key=lambda r: (r[2], r[0])):
        expected[i] = seen.get(key, 0)
        seen[key] = expected[i] + 1
    assert {r["id"]: r["position"] for r in got} == expected


def test_position_keeps_rows_with_equal_order_and_missing_keys(spark):
    same = spark.createDataFrame([(None, 1)] * 500 + [("a", 1)] * 300, "k string, v int").repartition(5)
    got = ordering.with_position(same, F.col("v"), by=["k"]).collect()
    for key, n in ((None, 500), ("a", 300)):
        assert sorted(r["position"] for r in got if r["k"] == key) == list(range(n))


def test_hot_key_is_spread_over_sorted_partitions(table):
    stored = ordering.range_sorted(table, F.col("key"), F.col("value"))
    assert stored.filter("key = 'hot'").select("_part").distinct().count() > 1


def test_one_value_is_spread_over_sorted_partitions(spark):
    stored = ordering.range_sorted(spark.range(20000).select(F.lit(1).alias("v")), F.col("v"))
    assert stored.select("_part").distinct().count() > 1


def test_rank_shares_the_best_place(table, rows):
    got = {r["id"]: r["rank"] for r in ordering.with_rank(table, "value", "id").collect()}
    values = [r[2] for r in rows]
    ordered = sorted(values, reverse=True)
    first = {}
    for n, v in enumerate(ordered, 1):
        first.setdefault(v, n)
    assert got == {r[0]: first[r[2]] for r in rows}


@pytest.mark.parametrize("start, stop", [(100, 250), (0, -1), (-5, None), (None, 3), (7, 7), (-4, -2), (10**6, None), (5, -(10**6))])
def test_row_slice_counts_as_python_does(table, rows, start, stop):
    expected = [r[0] for r in sorted(rows, key=lambda r: (r[2], r[0]))][start:stop]
    got = ordering.row_slice(table, start, stop, F.col("value"), F.col("id"))
    assert sorted(r["id"] for r in got.collect()) == sorted(expected)


def test_row_slice_may_keep_its_end(table, rows):
    expected = [r[0] for r in sorted(rows, key=lambda r: (r[2], r[0]))]
    for start, stop, ids in ((2, 5, expected[2:6]), (3, 3, expected[3:4]), (-3, -1, expected[-3:])):
        got = ordering.row_slice(table, start, stop, F.col("value"), F.col("id"), inclusive=True)
        assert sorted(r["id"] for r in got.collect()) == sorted(ids)


def test_quantiles_per_key(table, rows):
    got = quantiles.quantiles(table, ["value"], [0, 0.1, 0.5, 0.975, 1], ["key"])
    for r in got.collect():
        values = [v for _, k, v in rows if k == r["key"]]
        assert r["n"] == len(values)
        expected = np.quantile(values, [0, 0.1, 0.5, 0.975, 1])
        assert np.allclose([r["q0"], r["q10"], r["q50"], r["q97_5"], r["q100"]], expected)


def test_quantiles_skip_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (4.0,)], "v double")
    row = quantiles.quantiles(df, ["v"], [0.5]).first()
    assert (row["n"], row["q50"]) == (2, 2.5)


def test_box_stats(table, rows):
    for r in quantiles.box_stats(table, "value", ["key"]).collect():
        values = np.array([v for _, k, v in rows if k == r["key"]])
        q1, q2, q3 = np.quantile(values, [0.25, 0.5, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = values[(values >= low) & (values <= high)]
        assert np.allclose([r["q1"], r["median"], r["q3"]], [q1, q2, q3])
        assert (r["whisker_low"], r["whisker_high"]) == (inside.min(), inside.max())
        assert r["outliers"] == len(values) - len(inside)


def test_iqr_outliers(table, rows):
    values = np.array([r[2] for r in rows])
    q1, q3 = np.quantile(values, [0.25, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    got = {r["id"] for r in quantiles.iqr_outliers(table, "value").collect()}
    assert got == {r[0] for r in rows if r[2] < low or r[2] > high} and got


def _dense(df, shape):
    out = np.zeros(shape)
    for r in df.collect():
        out[r["i"], r["j"]] = r["v"]
    return out


@pytest.fixture(scope="module")
def two(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(23, 17)), rng.normal(size=(17, 9))

    def cells(m):
        return spark.createDataFrame(
            [(i, j, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])],
            "i bigint, j bigint, v double",
        )

    return a, b, cells(a), cells(b)


@pytest.mark.parametrize("block", [4, 5, 256])
def test_multiply_by_blocks(two, block):
    a, b, x, y = two
    assert np.allclose(_dense(matrix.multiply(x, y, block), (23, 9)), a @ b)


def test_multiply_sparse_cells(spark):
    a = spark.createDataFrame([(0, 5, 2.0), (7, 1, 3.0)], "i bigint, j bigint, v double")
    b = spark.createDataFrame([(5, 0, 4.0), (1, 2, 5.0)], "i bigint, j bigint, v double")
    got = {(r["i"], r["j"]): r["v"] for r in matrix.multiply(a, b, 4).collect() if r["v"]}
    assert got == {(0, 0): 8.0, (7, 2): 15.0}


def test_sort_axis(two):
    a, _, x, _ = two
    assert np.allclose(_dense(matrix.sort_axis(x, 1), a.shape), np.sort(a, axis=1))
    assert np.allclose(_dense(matrix.sort_axis(x, 0), a.shape), np.sort(a, axis=0))


def test_take_reshape_assign_and_trace(two):
    a, _, x, _ = two
    assert np.allclose(_dense(matrix.take(x, slice(1, 2), slice(None, 2)), (1, 2)), a[1:2, :2])
    assert np.allclose(_dense(matrix.take(x, slice(2, None)), (21, 17)), a[2:, :])
    assert np.allclose(_dense(matrix.reshape(x, 17, 23), (17, 23)), a.reshape(17, 23))
    assert np.allclose(_dense(matrix.transpose(x), (17, 23)), a.T)
    changed = a.copy()
    changed[5:8] = 0
    assert np.allclose(_dense(matrix.assign_rows(x, 5, 8, 0.0), a.shape), changed)
    assert np.isclose(matrix.trace(x).first()["trace"], np.trace(a))


def test_generators(spark):
    assert np.allclose(_dense(matrix.eye(spark, 3), (3, 3)), np.eye(3))
    assert matrix.eye(spark, 3, dense=True).count() == 9
    assert matrix.full(spark, 4, 6, 0.0).count() == 24


def test_absent_cells_are_zero(spark, two):
    a, _, x, _ = two
    present = x.filter("v > 0")
    dense = np.where(a > 0, a, 0)
    whole = matrix.filled(present, *a.shape)
    assert whole.count() == a.size and np.allclose(_dense(whole, a.shape), dense)
    assert np.allclose(_dense(matrix.sort_axis(whole, 1), a.shape), np.sort(dense, axis=1))
    added = matrix.elementwise(matrix.full(spark, 3, 3, 1.0), matrix.eye(spark, 3), lambda v, w: v + w)
    assert added.count() == 9 and np.allclose(_dense(added, (3, 3)), 1 + np.eye(3))
    vector = spark.createDataFrame([(0, 2.0)], "j bigint, v double")
    shifted = matrix.with_vector(matrix.full(spark, 2, 2, 1.0), vector, lambda v, w: v + w)
    assert np.allclose(_dense(shifted, (2, 2)), [[3, 1], [3, 1]])
    with pytest.raises(ValueError):
        matrix.take(x, slice(-2, None))


def test_stored_tables_go_with_their_owner(spark):
    kept = storage.stage(spark.range(3), "kept")
    with storage.stored_tables(spark):
        table = storage.stage(spark.range(5), "short")
        place = table.inputFiles()[0].removeprefix("file:")
        assert table.count() == 5 and os.path.exists(place)
    assert not os.path.exists(place) and kept.count() == 3


def test_no_folder_means_no_storage():
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError):
        storage.shared_folder(bare)


def test_broadcast_is_refused_beyond_the_limits(spark):
    few = spark.range(10).withColumn("s", F.repeat(F.lit("x"), F.lit(1000)))
    assert storage.is_short(few)
    assert not storage.is_short(few, rows=9)
    assert not storage.is_short(few, size=5000)
    assert storage.is_short(few.filter("id < 0"), rows=0, size=0)


def test_positions_without_broadcast(table, rows, monkeypatch):
    """The way for tables whose keys are too many to broadcast."""
    monkeypatch.setattr(ordering, "broadcast_if_short", lambda df: df)
    got = ordering.with_position(table, F.col("value"), F.col("id"), by=["key"])
    expected = {}
    for key in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0]))
        expected.update({r[0]: n for n, r in enumerate(own)})
    assert {r["id"]: r["position"] for r in got.collect()} == expected
