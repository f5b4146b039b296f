import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quipu.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, id int, query_id string, vector string"
def asks():
    return F.pmod(F.col("id"), F.lit(20)) == 0


def plain(rows, nearest=20):
    good = {}
    for i, v, *_ in rows:
        if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v):
            good[i] = np.array(v, np.float32).astype(float)
    length = max({len(v) for v in good.values()}, key=lambda n: sum(len(v) == n for v in good.values()), default=0)
    good = {i: v for i, v in good.items() if len(v) == length}
    out = {}
    for q in (i for i in good if i % 20 == 0):
        out[q] = sorted((-float(v @ good[q]), i) for i, v in good.items() if i != q)[:nearest]
    return out


def compare(spark, rows, least, **options):
    found = neighbours.search(spark.createDataFrame(rows, SCHEMA), asks(), **options).collect()
    expected = plain(rows)
    vectors = {r[0]: np.array(r[1], float) for r in rows if r[1] and None not in r[1]}
    got = {}
    for r in found:
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    assert set(got) <= set(expected)
    for q, best in expected.items():
        mine = sorted(got.get(q, []))
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1))
        assert [(-m[2], m[1]) for m in mine] == sorted((-m[2], m[1]) for m in mine)
        assert all(abs(m[2] - vectors[q] @ vectors[m[1]]) < 1e-5 for m in mine)
        hits += len({m[1] for m in mine} & {i for _, i in best})
        total += len(best)
    assert hits >= least * total
    return got


def clash(rows):
    return [(i, v, 1, "c", "c") for i, v in rows]


def test_recall_on_spread_vectors_of_any_length(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=16) * rng.uniform(0.2, 3)).tolist()) for i in range(1500)]
    compare(spark, clash(rows), 0.9)
    compare(spark, clash(rows[:300]), 0.9, chunk=16)  # hot buckets are cut into chunks
    compare(spark, clash(rows[:300]), 0.9, chunk=16, asks_at_once=2, tables=3)  # and what asks of them is dealt out
    compare(spark, clash(rows[:300]), 0.9, tables=1)


def test_copies_ties_and_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(200)]  # one common vector
    rows += [(i, rng.normal(size=3).tolist()) for i in range(200, 260)]
    rows += [(300, None), (301, []), (302, [0.0, 0.0, 0.0]), (303, [None, 1.0, 1.0]), (304, [math.nan, 1.0, 1.0]), (305, [math.inf, 1.0, 1.0])]
    rows += [(None, [1.0, 2.0, 3.0]), (320, [1.0, 2.0]), (-20, [1.0, 0.0, 0.5]), (40, [1.0, 0.0, 0.5])]
    got = compare(spark, clash(rows), 0.9)
    assert 320 not in got and 300 not in got
    expected = plain(rows)
    for q in (0, 40, 100, -20):
        assert [m[1] for m in sorted(got[q])] == [i for _, i in expected[q]]


def test_fewer_candidates_and_none(spark):
    rows = clash([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (20, [1.0, 1.0])])
    assert {q: len(m) for q, m in compare(spark, rows, 1.0).items()} == {0: 2, 20: 2}
    assert neighbours.search(spark.createDataFrame([], SCHEMA), asks()).count() == 0
    assert neighbours.search(spark.createDataFrame(rows[:1], SCHEMA), asks()).count() == 0


def test_probes_come_in_order_of_chance_and_start_at_home():
    rng = np.random.default_rng(3)
    index = neighbours.fit(rng.normal(size=(300, 8)), 300, 5.0, 20)
    place = index.places(0, neighbours.as_queries(rng.normal(size=(1, 8))))[0]
    codes = index.probes(0, place, 0.9)
    assert len(set(codes.tolist())) == len(codes) and index.codes(np.floor(place)[None, :])[0] in codes[:3]
    assert len(index.probes(0, place, 0.99)) > len(index.probes(0, place, 0.5))


def mixed_vectors(group):
    """Four fifths in tight clusters, the others spread, in mixed order."""
    rng = np.random.default_rng(group)
    centers = rng.normal(size=(1600 // group, 64))
    near = np.repeat(centers, group, axis=0) + 0.1 * rng.normal(size=(1600 // group * group, 64))
    spread = rng.normal(size=(2000 - len(near), 64))
    vectors = np.concatenate((near, spread))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    order = rng.permutation(2000)
    return vectors[order], {i for i, at in enumerate(order) if at >= len(near)}


@pytest.mark.parametrize("group", [40, 100])
def test_recall_of_spread_vectors_among_clusters(spark, group):
    vectors, lonely = mixed_vectors(group)
    rows = clash([(i, v.tolist()) for i, v in enumerate(vectors)])
    got, expected = compare(spark, rows, 0.9), plain(rows)
    spread = [q for q in expected if q in lonely]
    hits = sum(len({m[1] for m in got.get(q, [])} & {i for _, i in expected[q]}) for q in spread)
    assert spread and hits >= 0.9 * 20 * len(spread)


def test_a_query_with_far_neighbours_names_all_buckets_or_enough():
    rng = np.random.default_rng(3)
    index = neighbours.fit(rng.normal(size=(300, 8)), 300, 5.0, 20)
    place = index.places(0, neighbours.as_queries(rng.normal(size=(1, 8))))[0]
    assert len(index.probes(0, place, 0.9, 2 * index.distance)) > len(index.probes(0, place, 0.9))
    assert index.probes(0, place, 0.9, 1e6) is None
