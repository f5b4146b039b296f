import random
from collections import Counter

import numpy as np
import pytest

from quipu.llm import repeats

SCHEMA = "doc_id long, text string, id string, row int, key long"


def plain(texts, length):
    """Per text: spans of bytes covered by a repeated window, and the rest."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 2, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i + 1 : i + length + 1] = True
        edges = np.flatnonzero(gone[1:] != gone[:-1]).tolist()
        out.append((list(zip(edges[::2], edges[1::2])), bytes(b for b, g in zip(r, gone[1:]) if not g)))
    return out


def texts(seed=1, n=60, alphabet="abcdefgh é"):
    rng = random.Random(seed)
    make = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    passages = [make(rng.randrange(150, 700)) for _ in range(6)]
    line = make(90)
    out = [None, "", "short", make(199), "x" * 3000, "ab" * 400, make(5000), make(30) + line * 4 + make(40), make(230) + make(70) * 3]
    for _ in range(n):
        text = make(rng.randrange(50, 900))
        for p in rng.sample(passages, rng.randrange(0, 3)):
            a, b = sorted(rng.sample(range(len(p)), 2))
            text += p[a:b] + make(rng.randrange(0, 40))
        out.append(text)
    return out + out[7:20] + [make(100) + out[9] for _ in range(3)]


def check(spark, given, length, parts=5, **options):
    rows = [(i if i % 11 else None, t, "x", 1, 2) for i, t in enumerate(given)]
    rows += rows[12:15]  # repeated rows
    rows += [(5, given[10], "y", 3, None)] * 2
    table = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    out = repeats.deduplicated(table, length=length, **options)
    assert out.columns == [*table.columns, "repeats"]
    expected = sorted((str(r), len((r[1] or "").encode()), spans, kept) for r, (spans, kept) in zip(rows, plain([r[1] for r in rows], length)))
    got = [(str(tuple(r)[:5]), r["repeats"]["n_bytes"], [(s["start"], s["end"]) for s in r["repeats"]["spans"]], bytes(r["repeats"]["kept"])) for r in out.collect()]
    assert sorted(got) == expected


def test_against_brute_force(spark):
    check(spark, texts(), 200)


def test_short_windows(spark):
    """Few letters and short windows: nearly every key has many forms."""
    check(spark, texts(2, 40, "ab"), 12)


def test_levels_shards_and_hot_keys(spark):
    """Tiny batches and shards, and keys that are cut anew down to whole windows."""
    check(spark, texts(3, 40, "abc "), 24, shard_windows=300, hot_windows=40, batch_windows=25)


def test_common_phrase_in_ever_new_surroundings(spark):
    rng = random.Random(5)
    make = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    phrase = make(150)
    check(spark, [make(300) + phrase + make(300) for _ in range(150)], 200, hot_windows=500)


@pytest.mark.parametrize("batch", [1, 3, 8])
def test_family(batch):
    rng = random.Random(batch)
    given = ["".join(rng.choice("ab\0") for _ in range(rng.randrange(9, 40))).encode() for _ in range(37)]
    family = repeats.Family(9)
    for at in range(0, len(given), batch):
        family.add(given[at : at + batch])
    windows = [t[i : i + 9] for t in given for i in range(len(t) - 8)]
    seen = Counter(windows)
    assert family.repeated.tolist() == [seen[w] > 1 for w in windows]
    batches = -(-37 // batch)
    assert [level is not None for level in family.levels] == [bool(batches >> i & 1) for i in range(batches.bit_length())]
    for level in family.levels:
        if level is not None:
            assert (level[0][1:] > level[0][:-1]).all()


def test_equal_windows_have_equal_keys():
    rng = random.Random(7)
    shared = bytes(rng.randrange(256) for _ in range(400))
    keys = []
    for before in (0, 17, 300):
        text = bytes(rng.randrange(256) for _ in range(before)) + shared
        found = {}
        for _, start, windows, key, *_ in repeats.fragments([text], 100, 16):
            for s, w, k in zip(start, windows, key):
                found |= {int(s) + i - before: int(k) for i in range(w)}
        assert sorted(found) == list(range(-before, len(shared) - 99))
        keys.append([found[i] for i in range(len(shared) - 99)])
    assert keys[0] == keys[1] == keys[2]


def test_long_texts_are_cut_with_an_overlap(monkeypatch):
    monkeypatch.setattr(repeats, "_BLOCK", 64)
    given = [b"x" * 5, b"a b c d " * 50, b"y" * 20, b"abcdefghij" * 9]
    places = [(int(t), int(s) + i) for part in repeats.fragments(given, 20, 5) for t, s, w, *_ in zip(*part) for i in range(w)]
    assert sorted(places) == [(n, i) for n, t in enumerate(given) for i in range(len(t) - 19)]


def test_hashes_follow_the_bytes():
    data = np.frombuffer(b"abcabcabcabcabd" * 3, np.uint8)
    for k in (1, 2, 3, 7, 12):
        h = repeats.gram_hashes(data, k)
        grams = [bytes(data[i : i + k]) for i in range(len(data) - k + 1)]
        assert len(h) == len(grams) and len(set(zip(grams, h.tolist()))) == len(set(grams)) == len(set(h.tolist()))


def test_empty(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert repeats.deduplicated(table).collect() == []
