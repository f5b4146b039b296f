import random
import re

import pytest
from pyspark.sql import functions as F

from quipu.llm import decontamination as dec

DOCS = "doc_id long, text string, contamination string, n_hit int"
ITEMS = "item_id long, text string, item string"


def plain(text, items, window=10):
    def words(t):
        low = (t or "").translate(dec._TO_LOWER)
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)

    w = words(text)
    hit, owners = set(), set()
    for item, t in items:
        iw = words(t)
        n = min(len(iw), window)
        pieces = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in pieces:
                hit |= set(range(i, i + n))
                owners.add("" if item is None else str(item))
    return len(w), len(hit), sorted(owners)


def samples():
    rng = random.Random(4)
    vocabulary = ["Ax", "bx", "Éa", "ñ", "7", "cx", "dx", "ex"]
    items = [(i % 9, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 4, 10, 12, 30])))) for i in range(14)]
    items += [(None, "ex ex ex ex"), (50, None), (51, "  ..."), items[0], (3, "zz Zz, ZZ!")]
    docs = [None, "", "...", "zz-zz\nZZ", "ex ex", "azz zz zz"]
    for _ in range(40):
        parts = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))]
        parts.insert(rng.randrange(len(parts)), rng.choice(items[:14])[1].upper().replace("É", "Éa"[0]))
        docs.append(rng.choice([" ", ", ", "\n"]).join(parts))
    docs.append(" ".join(rng.choice(vocabulary[:2]) for _ in range(100_000)))
    return items, docs


@pytest.mark.parametrize("size", [dec.PART_WINDOWS, 40])
def test_one_automaton_or_many_against_brute_force(spark, size):
    items, docs = samples()
    rows = [(i % 40 if i else None, t, "c", 1) for i, t in enumerate(docs)]
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], ITEMS)
    found = dec.contamination(spark.createDataFrame(rows, DOCS).drop("contamination"), bench, part_windows=size)
    got = [(r["doc_id"], r["n_hit"], *[r["contamination"][k] for k in ("n_words", "n_hit", "items")]) for r in found.collect()]
    expected = [(i, 1, *plain(t, items)) for (i, t, *_) in rows]
    assert sorted(map(str, got)) == sorted(map(str, expected))
    for r in dec.contamination(spark.createDataFrame(rows, DOCS), bench, part_windows=size).collect():
        words = [dec.words_of(r["text"][s["start"] : s["end"]]) for s in r["contamination"]["spans"]]
        assert sum(map(len, words)) == r["contamination"]["n_hit"]
        assert all(a["end"] < b["start"] for a, b in zip(r["contamination"]["spans"], r["contamination"]["spans"][1:]))


def test_columns_of_any_name_come_back(spark):
    docs = spark.createDataFrame([(1, "a b c d", 7, 8, "r")], "doc_id long, text string, _row int, id int, `row.x` string")
    bench = spark.createDataFrame([(i, f"a b c d {i}" if i else "c d", None) for i in range(30)], ITEMS)
    for size in (1000, 4):
        out = dec.contamination(docs, bench, part_windows=size)
        assert out.columns == [*docs.columns, "contamination"] and out.first()["_row"] == 7 and out.first()["contamination"]["n_hit"] == 2


def test_spans_point_into_the_original():
    scanner = dec.Scanner([(w, "1") for w in dec.windows_of(dec.words_of("Die ÄPFEL sind (rot)"))])
    text = "x DIE -- äPFEL sind rot!"
    assert scanner.scan(text)["runs"] == []  # only A-Z is lowered: Ä and ä differ
    text = "x DIE -- ÄPFEL SIND, rot! y die ÄPFEL sind rot"
    spans = scanner.scan(text)["runs"]
    assert [text[s["start"] : s["end"]] for s in spans] == ["DIE -- ÄPFEL SIND, rot", "die ÄPFEL sind rot"]


def test_empty_tables_and_filter(spark):
    docs = spark.createDataFrame([(1, "a b c", "k", 0), (2, "q", "k", 0), (2, "q", "k", 0), (3, None, None, None)], DOCS)
    none = spark.createDataFrame([], ITEMS)
    assert dec.without_contaminated(docs, none).count() == 4
    bench = spark.createDataFrame([(1, "A-B", None)], ITEMS)
    kept = dec.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 2, 3]
    assert dec.contamination(docs.limit(0), bench).select(F.col("contamination.n_hit")).count() == 0
