import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quipu.llm import mixing

SCHEMA = "doc_id long, text string, source string, size long, row string, n_chars int"


def words(n, tag="w"):
    return " ".join(f"{tag}{i}" for i in range(n))


def plain_targets(sizes, weights=(1, 2, 3), repeats=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        open_ = [s for s in order if s not in capped]
        level = (total - sum(repeats * sizes[s] for s in capped)) / max(sum(w[s] for s in open_), 1)
        over = {s for s in open_ if w[s] * level > repeats * sizes[s]}
        if not over:
            return {s: float(repeats * sizes[s]) if s in capped else w[s] * level for s in order}
        capped |= over


def docs(spark):
    rows = [(i, words(40 + i % 7), "big", 1, "x", 5) for i in range(120)]
    rows += [(200 + i, words(3 + i), "small", 1, "x", 5) for i in range(4)]
    rows += [(300 + i, words(30), "Zeta", 1, "x", 5) for i in range(5)] + [(400, words(9), None, 1, "x", 5), (None, words(11), None, 1, None, None)]
    rows += [(500, None, "none", 1, "x", None), (501, " \t ", "none", 1, "x", 0)]
    rows += [rows[0], rows[0], (3, words(2000), "big", 1, "x", 5)]  # repeated rows, and one id with two sizes
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("block", [16, 1024])
def test_targets_and_takes(spark, block):
    rows, table = docs(spark)
    mix = mixing.Mix(table, block=block)
    found = mix.per_document().collect()
    assert len(found) == len(rows)
    size = lambda t: len((t or "").split())
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += size(r[1])
    expected = plain_targets(sizes)
    by_id = {(r[0], size(r[1])): r[2] for r in rows}
    taken, targets = defaultdict(int), {}
    for r in found:
        source = by_id[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(expected[source])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
        targets[source] = r["target"]
    for source, words_taken in taken.items():
        assert targets[source] - 4 <= words_taken <= targets[source]
    again = mixing.Mix(table.repartition(5), block=block).per_document().collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_schedule_is_spread_and_takes_each_block_once(spark):
    _, table = docs(spark)
    mix = mixing.Mix(table, block=16)
    slots = mix.schedule.collect()
    assert len({r["slot"] for r in slots}) == len(slots)
    quotas = {r["s"]: r["quota"] for r in mix.sources.collect()}
    for s, quota in quotas.items():
        mine = sorted((r["slot"], r["block"]) for r in slots if r["s"] == s)
        assert [b for _, b in mine] == list(range(-(-quota // 16)))
    # Any prefix holds each source to within a few slots of its share.
    order = [r["s"] for r in sorted(slots, key=lambda r: r["slot"])]
    for n in range(1, len(order)):
        for s in quotas:
            share = order.count(s) / len(order)
            assert abs(order[:n].count(s) - n * share) <= 6
    pieces = mix.pieces().groupBy("slot").agg(F.sum("words").alias("n")).collect()
    assert all(p["n"] <= 16 for p in pieces) and sum(p["n"] for p in pieces) == sum(quotas.values())


def test_mixed_rows_are_whole_or_first_words(spark):
    rows, table = docs(spark)
    table = table.filter("doc_id != 3")
    mix = mixing.Mix(table)
    taken = defaultdict(int)
    for r in mix.per_document().collect():
        taken[r["doc_id"]] += r["taken"]
    out = mixing.mixed(table)
    assert out.columns == table.columns
    texts = {(r[0], len((r[1] or "").split())): r[1] for r in rows}
    got = defaultdict(int)
    for r in out.collect():
        whole = next(t for (i, _), t in texts.items() if i == r["doc_id"])
        assert whole.startswith(r["text"]) and r["n_chars"] == len(r["text"])
        got[r["doc_id"]] += len(r["text"].split())
    assert {i: n for i, n in taken.items() if n} == dict(got)


@pytest.mark.parametrize("doc_id, copies, size, others, target", [(7, 10, 3, 30, 15), (None, 1000, 1, 600, 266)])
def test_repeated_rows_lose_no_words(spark, doc_id, copies, size, others, target):
    """Ten copies of three words with a target of 15; a thousand rows without an id and with a target of 266.7."""
    rows = [(doc_id, words(size), "a", 1, "x", 5)] * copies
    if doc_id:
        rows += [(100 + i, words(3), "b", 1, "x", 5) for i in range(5)]
    else:
        rows = [(None, f"w{i % 50}", "a", i, "x", 5) for i in range(1000)] + [(1, words(600), "b", 1, "x", 5)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    mix = mixing.Mix(table)
    quota = {r["source"]: r["quota"] for r in mix.sources.collect()}["a"]
    found = [r["taken"] for r in mix.per_document().collect() if r["size"] == size]
    assert len(found) >= copies and max(found) <= 3 * size
    mine = mix.taken().filter("source = 'a'").agg(F.sum("taken")).first()[0]
    assert mine == quota
    assert quota == target if doc_id else quota >= target
    out = mixing.mixed(table).filter("source = 'a'").collect()
    assert sum(len(r["text"].split()) for r in out) == quota


def test_any_prefix_is_close_to_the_weights(spark):
    rng = random.Random(2)
    rows = [(i, words(rng.randrange(1, 60)), rng.choice("aaab") + rng.choice("xy"), 1, "x", 5) for i in range(1500)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(6)
    mix = mixing.Mix(table, block=64)
    quotas = {r["source"]: r["quota"] for r in mix.sources.collect()}
    out = mixing.mixed(table, slot_col="slot", block=64).collect()
    assert [r["slot"] for r in out] == sorted(r["slot"] for r in out)  # put out in order
    seen, total = defaultdict(int), 0
    whole = sum(quotas.values())
    for r in out:
        n = len(r["text"].split())
        seen[r["source"]] += n
        total += n
        for source, quota in quotas.items():
            assert abs(seen[source] - total * quota / whole) <= 64 * 4 + 120
    assert dict(seen) == quotas
    plain = [tuple(r) for r in mixing.mixed(table, block=64).collect()]
    assert plain == [tuple(r)[:-1] for r in out] and mixing.mixed(table, block=64).columns == table.columns


def test_sources_without_end_are_levelled_at_once(spark):
    sizes = {f"s{i:03}": (i * 37) % 101 + 1 for i in range(300)} | {None: 5000}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(table.repartition(5)).collect()}
    want = plain_targets(sizes)
    assert set(got) == set(want) and all(got[s] == pytest.approx(want[s]) for s in want)


def test_partial_text_keeps_its_blanks(spark):
    text = "  one\ttwo \n three  "
    got = spark.createDataFrame([(text,)], "t string").select(mixing._first_words(F.col("t"), F.lit(2))).first()[0]
    assert got == "  one\ttwo"


def test_empty_and_wordless(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.Mix(empty).per_document().count() == 0 and mixing.mixed(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None, 1, None, None)], SCHEMA)
    row = mixing.Mix(blank).per_document().collect()
    assert [tuple(r) for r in row] == [(1, 0, 0, 0.0, 0, None, 0)]
    key = spark.range(1).select(mixing.shuffle_key(F.lit(5))).first()[0]
    assert key == hashlib.md5(b"mix:5").hexdigest()
