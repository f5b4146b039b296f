"""Column-oriented documents of one large object, read in splits."""

import json
import random

import pytest
from pyspark.sql import types as T

from quipu.sources import documents
from tests.test_splits import small_splits  # noqa: F401

KINDS = {"name, first": T.StringType(), "points": T.DoubleType(), "many": T.ArrayType(T.IntegerType()), "flag": T.BooleanType(), "n": T.LongType()}
SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in KINDS.items()])
TEXTS = ["plain", "a, b", 'say "x", "y"', "back\\slash\\", "{[,]}", "é,ü\n", "", None, '\\",', "x" * 90]


def document(seed, n, spaces=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append((rng.choice(TEXTS), rng.choice([1.5, -2.0, None, 1e9]), rng.choice([None, [], [1, 2, 3]]), rng.choice([True, False]), i * 7))
    names = [f.name for f in SCHEMA.fields]
    content = {c: {str(i): r[k] for i, r in enumerate(rows)} for k, c in enumerate(names)}
    content["empty"] = {}
    content["other, column"] = {"0": "left out"}
    if n > 3:
        del content["n"]["2"]  # an index that one column lacks
        rows[2] = (*rows[2][:4], None)
    order = list(content)
    rng.shuffle(order)
    return json.dumps({c: content[c] for c in order}, indent=1 if spaces else None, ensure_ascii=bool(seed % 2)), rows


@pytest.mark.parametrize("size, spaces", [(1 << 20, False), (400, False), (97, True), (2000, True)])
def test_one_object_in_splits(spark, tmp_path, small_splits, size, spaces):  # noqa: F811
    text, rows = document(size, 120, spaces)
    (tmp_path / "t.json").write_text(text, encoding="utf-8")
    small_splits(size)
    if size < 2000:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    flat = T.StructType([f for f in SCHEMA.fields if f.name != "many"])
    got = documents.read_large_columns(spark, str(tmp_path), flat).collect()
    want = sorted((i, *r[:2], *r[3:]) for i, r in enumerate(rows))
    assert sorted(map(tuple, got), key=lambda r: r[0]) == want


def test_nested_values_and_several_files(spark, tmp_path):
    want = []
    for k in range(3):
        text, rows = document(k, 5 * k)
        (tmp_path / f"{k}.json").write_text(text, encoding="utf-8")
        want += [(f"{k}.json", i, *r) for i, r in enumerate(rows)]
    got = documents.read_large_columns(spark, str(tmp_path), SCHEMA, keep_file=True).collect()
    assert sorted(((r[0].rsplit("/", 1)[1], *r[1:]) for r in got), key=lambda r: r[:2]) == sorted(want, key=lambda r: r[:2])


def test_equal_to_the_reader_of_short_documents(spark, tmp_path):
    text, _ = document(9, 60)
    (tmp_path / "t.json").write_text(text, encoding="utf-8")
    key = lambda rows: sorted(map(str, rows))
    assert key(documents.read_large_columns(spark, str(tmp_path), SCHEMA).collect()) == key(documents.read_columns(spark, str(tmp_path), SCHEMA).collect())


def test_empty_document(spark, tmp_path):
    (tmp_path / "t.json").write_text("{}")
    assert documents.read_large_columns(spark, str(tmp_path), SCHEMA).collect() == []
