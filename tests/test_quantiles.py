"""Bracketed selection: narrow and missed brackets, repeats, infinities, hot keys, and its plans."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quipu import storage
from quipu.operators import profile, quantiles
from tests.test_plans import plan

PROBS = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
NAMES = ["q0", "q1", "q25", "q50", "q99", "q100"]


def values():
    rng = random.Random(1)
    rows = [("hot", rng.gauss(0, 1)) for _ in range(4000)] + [("hot", 0.25)] * 2500
    rows += [("two", float(rng.random() < 0.5)) for _ in range(900)] + [("two", rng.random()) for _ in range(60)]
    rows += [("same", 7.0)] * 300 + [("one", 3.0), (None, 1.0), (None, 2.0)]
    rows += [("spread", 10.0 ** rng.randrange(-9, 9) * rng.random()) for _ in range(2000)]
    rows += [("none", None), ("none", math.nan), ("zero", -0.0), ("zero", 0.0), ("zero", 1.0)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(values(), "key string, v double").repartition(8).cache()


def expected():
    keys = {k for k, v in values() if v is not None and not math.isnan(v)}
    return {k: [v for key, v in values() if key == k and v is not None and not math.isnan(v)] for k in keys}


def same(got):
    want = expected()
    assert {r["key"] for r in got} == set(want) and len(got) == len(want)
    for r in got:
        assert r["n"] == len(want[r["key"]])
        assert np.allclose([r[c] for c in NAMES], np.quantile(want[r["key"]], PROBS), rtol=1e-12, atol=0)


@pytest.mark.parametrize("few, accuracy", [(1_000_000, 5_000), (40, 30), (5, 200)])
def test_brackets_of_any_width(table, few, accuracy):
    same(quantiles.quantiles(table, ["v"], PROBS, ["key"], few=few, accuracy=accuracy).collect())


def test_brackets_that_miss_are_opened(table, monkeypatch):
    """Every first bracket is wrong: the ranks lie beyond it, on either side."""
    kept = quantiles._sketched

    def wrong(*given):
        state = kept(*given)
        moved = {f"_from{i}": F.lit(0.2 if i % 2 else 5.0) for i in range(len(PROBS))}
        return storage.stage(state.withColumns(moved | {f"_to{i}": F.lit(0.21 if i % 2 else 5.1) for i in range(len(PROBS))}), "wrong")

    monkeypatch.setattr(quantiles, "_sketched", wrong)
    same(quantiles.quantiles(table, ["v"], PROBS, ["key"]).collect())


def test_infinities(spark):
    rows = [-math.inf] * 3 + [1.0, 2.0, 3.0] + [math.inf] * 2
    got = quantiles.quantiles(spark.createDataFrame([(v,) for v in rows], "v double"), ["v"], [0.0, 0.5, 1.0], few=2, accuracy=20).first()
    assert (got["q0"], got["q50"], got["q100"]) == (-math.inf, 1.5, math.inf)


def test_no_sort_and_no_stored_column(spark, table, monkeypatch):
    legs, kept = [], []

    def watched(df, label):
        legs.append(plan(df))
        kept.append(storage.stage(df, label))
        return kept[-1]

    monkeypatch.setattr(quantiles, "stage", watched)
    quantiles.quantiles(table, ["v"], [0.5], ["key"], few=40, accuracy=30)
    assert all("rangepartitioning" not in leg for leg in legs)
    assert all(df.count() <= len(expected()) for df in kept)  # a row per key


def test_describe_reads_the_table_twice(spark, monkeypatch):
    legs = []
    monkeypatch.setattr(quantiles, "stage", lambda df, label: legs.append(plan(df)) or storage.stage(df, label))
    items = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_quantity", "l_tax")
    profile.describe(items).collect()
    assert sum(leg.count("lineitem.parquet") for leg in legs) == 2


def test_describe_of_columns_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, math.nan)], "a double, b double")
    got = {r["column_name"]: r for r in profile.describe(df).collect()}
    assert (got["a"]["count"], got["a"]["mean"], got["a"]["q50"]) == (2, 2.0, 2.0)
    assert (got["b"]["count"], got["b"]["mean"], got["b"]["q50"]) == (0, None, None)
