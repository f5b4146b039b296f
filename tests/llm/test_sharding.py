import random

from quipu.llm import sharding

SCHEMA = "doc_id long, text string, shard int, bytes string, bits string"


def check(rows, found, limit):
    shards = {}
    for r in found:
        shards.setdefault(r["shard"], []).append(r["bytes"])
    assert sorted((r["doc_id"], r["text"]) if r["doc_id"] is not None else (-1, "") for r in found) == sorted(
        (i, t) if i is not None else (-1, "") for i, t, *_ in rows
    )
    for sizes in shards.values():
        assert sum(sizes) <= limit or len(sizes) == 1
    names = [s for s in shards if "-" not in s]
    assert not any(a != b and b.startswith(a) for a in names for b in names)  # the directory has no overlaps
    return shards


def test_fits_and_splits_only_where_needed(spark):
    rng = random.Random(5)
    rows = [(i, "x" * rng.choice([0, 10, 200, 900]), 1, "b", "c") for i in range(300)]
    rows += [(1000, "é" * 4000, 1, "b", "c"), (None, None, None, None, None)]
    out = sharding.sharded(spark.createDataFrame(rows, SCHEMA), limit=3000)
    found = out.collect()
    shards = check(rows, found, 3000)
    assert any(sizes == [8000] for sizes in shards.values())
    by = {}
    for r in found:
        by.setdefault(r["shard"], 0)
        by[r["shard"]] += r["bytes"]
    for name in by:  # the parent of every shard was too large
        parent = name[:-1]
        assert sum(v for k, v in by.items() if k.startswith(parent)) > 3000 or name == "s"


def test_repeated_rows_go_to_numbered_shards(spark):
    rows = [(7, "y" * 100, 1, "b", "c")] * 50 + [(i, "z" * 50, 1, "b", "c") for i in range(20)]
    found = sharding.sharded(spark.createDataFrame(rows, SCHEMA), limit=250).collect()
    shards = check(rows, found, 250)
    assert sum("-" in s for s in shards) == 25


def test_small_and_empty(spark):
    one = sharding.sharded(spark.createDataFrame([(1, "a", 0, "", "")], SCHEMA)).collect()
    assert [(r["shard"], r["bytes"]) for r in one] == [("s", 1)]
    assert sharding.sharded(spark.createDataFrame([], SCHEMA)).count() == 0
