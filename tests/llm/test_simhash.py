import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quipu.llm import simhash

SCHEMA = "doc_id long, text string, digest string, component_id int, row string"


def plain_fingerprint(text, n=3):
    raw = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for c in "\t\n\x0b\x0c\r":
        raw = raw.replace(c, " ")
    words = [w for w in raw.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(ids, prints):
    label = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    least = {}
    for i, x in zip(ids, label):
        if i is not None:
            least[x] = min(least.get(x, i), i)
    return [least.get(x) for x in label]


TEXTS = [
    None, "", " \t\n ", "One", "one two", "ONE  TWO", "É é É", "a b c d e f", "a b c d e f", "\x1c x \x85 y z", "A B\x0bC d",
    " ".join(f"w{i % 97}" for i in range(200_000)),
]


def test_against_brute_force(spark):
    rng = random.Random(1)
    words = [f"word{i}" for i in range(40)]
    texts = list(TEXTS)
    for _ in range(20):
        base = [rng.choice(words) for _ in range(60)]
        for _ in range(6):
            base[rng.randrange(60)] = rng.choice(words)
            texts.append(" ".join(base))
    rows = [(i * 3 % 101 if i else None, t, "x", 7, "en") for i, t in enumerate(texts)]
    rows += rows[3:6]  # repeated rows
    found = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    prints = [plain_fingerprint(r[1]) for r in rows]
    expected = [(i, p, c) for (i, *_), p, c in zip(rows, prints, plain_components([r[0] for r in rows], prints))]
    got = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted(expected, key=key)
    shown = spark.range(1).select(simhash.hexadecimal(F.lit(-1).cast("bigint")).alias("h"), simhash.hexadecimal(F.lit(10).cast("bigint")).alias("k")).first()
    assert tuple(shown) == ("f" * 16, "0" * 15 + "a")


def ball(center, n, seed):
    rng = random.Random(seed)
    found = {center}
    while len(found) < n:
        found.add(rng.choice(sorted(found)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    return sorted(found)


@pytest.mark.parametrize("bucket_rows", [4096, 3])
def test_links_connect_dense_groups_with_and_without_finer_buckets(spark, bucket_rows):
    prints = ball(0x0123456789ABCDEF, 120, 2) + ball(0xFEDCBA9876543210, 60, 3) + [5, 5 << 40]
    prints = sorted(set(prints))
    fps = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    found = simhash.links(fps, bucket_rows)
    assert all(bin((r["a"] ^ r["b"]) % (1 << 64)).count("1") <= 3 for r in found.collect())
    labels = {r["node"] % (1 << 64): r["label"] for r in simhash.components(found).collect()}
    expected = plain_components(list(range(len(prints))), prints)
    groups = {}
    for p, c in zip(prints, expected):
        groups.setdefault(c, []).append(p)
    for group in groups.values():
        if len(group) > 1:
            assert len({labels[p] for p in group}) == 1
        else:
            assert group[0] not in labels
    assert len(set(labels.values())) == sum(len(g) > 1 for g in groups.values())


def test_a_long_chain_is_one_component(spark):
    rows = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000)]
    labels = {r["node"]: r["label"] for r in simhash.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert {labels[i] for i in range(301)} == {0} and labels[1001] == 1000 and len(labels) == 303


def test_forest_spans():
    members = np.array([0, 1, 3, 7, 0xFFFF << 40, (0xFFFF << 40) + 1], np.int64)
    assert len(simhash.forest(members)) == 4
    assert simhash.forest(np.array([-1, 1], np.int64)) == [] and simhash.forest(np.array([-1, -2, (1 << 63) - 1], np.int64))[1:] == [(-1, (1 << 63) - 1)]


def test_one_of_each_keeps_whole_rows(spark):
    rows = [(4, "a b c d", "x", 1, None), (2, "A b c d", "y", 2, "de"), (2, "A b c d", "y", 2, "de"), (9, "z y x w", None, 3, "en"), (None, "q r s t", None, 4, None), (None, "m n o p", None, 4, None), (9, "l k j i", None, 3, "en")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "digest", "component_id", "row"]
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, [rows[1], *rows[3:]]))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.one_of_each(empty).count() == 0
