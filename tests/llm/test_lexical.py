import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from quipu.llm import lexical

DOCS = "doc_id long, text string, item long, score string, n int"
ITEMS = "item_id long, text string, doc_id int"


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain(docs, items, keep=20):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, total = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c, n in counted:
            m = 75 + 25 * n * n_docs // total
            parts = (math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            scores.append((-sum(parts), i is None, i or 0))
        best = sorted(s for s in scores if s[0] < 0)[:keep]
        out += [(item, k + 1, None if nameless else i, -s) for k, (s, nameless, i) in enumerate(best)]
    return sorted(out, key=str)


def tables(seed=3, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "naïve", "x1", "THE", "The", "日本"]
    text = lambda k: rng.choice([" ", ", ", "-", "\n"]).join(rng.choice(words) for _ in range(k))
    docs = [(i, text(rng.randrange(1, 60))) for i in range(n)]
    docs += [(n + i, "the same text w1 w2") for i in range(60)]  # ties beyond the kept rows
    docs += [(900, None), (901, ""), (902, "!?"), (None, "w1 w3"), (5, "w1 " * 40_000), (5, "w1"), (5, "w1"), (None, "w1 w3")]
    items = [(i, text(12)) for i in range(30)]
    items += [(77, None), (78, "..."), (79, "unseen term"), (None, "w1 w1 w1 THE"), (80, "the the " * 50), (80, "the the " * 50), (80, "w2")]
    return docs, items


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, 1, "s", 2) for i, t in docs], DOCS)
    q = spark.createDataFrame([(i, t, 9) for i, t in items], ITEMS)
    out = lexical.search(d.repartition(5), q, **options)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("group_terms", [lexical.GROUP_TERMS, 40])
def test_against_brute_force(spark, group_terms):
    docs, items = tables()
    assert found(spark, docs, items, group_terms=group_terms) == plain(docs, items)


def test_small_tiles(spark, monkeypatch):
    docs, items = tables(4, 80)
    monkeypatch.setattr(lexical, "DOCS", 16)
    assert found(spark, docs, items, nearest=7) == plain(docs, items, 7)


def test_products_are_exact_with_large_weights():
    rng = np.random.default_rng(1)
    terms_, docs_ = 50, 30
    weights = rng.integers(1, 1 << 45, (4, terms_))
    rows, columns = np.divmod(np.arange(4 * terms_), terms_)
    tile = lexical.Tile(np.arange(4), np.arange(terms_), rows, columns, weights.ravel())
    impacts = rng.integers(1, 1 << 10, (terms_, docs_))
    at, doc = np.divmod(np.arange(terms_ * docs_), docs_)
    got = lexical.products(tile, at, doc, impacts.ravel(), docs_, block=16)
    assert (got == weights @ impacts).all()


def test_long_texts_are_split_between_terms(monkeypatch):
    monkeypatch.setattr(lexical, "_SPLIT_BYTES", 7)
    text = " Ab, cdefghijklm n;o " * 9
    n, counts = lexical.counted(text.encode(), {b"ab": 0, b"cdefghijklm": 1, b"zz": 2})
    assert (n, dict(counts)) == (36, {0: 9, 1: 9})


def test_norm_beyond_64_bits():
    n = np.array([1, 1 << 40], np.int64)
    assert lexical.norms(n, 1 << 30, 1 << 50).tolist() == [75 + 25 * x * (1 << 30) // (1 << 50) for x in (1, 1 << 40)]


def test_empty_tables(spark):
    docs, items = tables()
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, [(1, None)], items) == []
