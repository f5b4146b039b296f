import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quipu.llm import labelled, quality, toxicity

DOCS = "doc_id long, text string, score string, label int, held_out string"
LABELS = "doc_id long, quality int, toxic int, text string"


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(["ba", "ko", "mi", "tur", "len", "sa"]) for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    insults = ["grobzak", "vixnurf", "plethquod", "dwimbok"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(40, 200))]
        toxic, good = int(rng.random() < 0.3), int(rng.random() < 0.8)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        if not good:
            words = [w + rng.choice(["!!", "###", "$$$"]) for w in words] if rng.random() < 0.5 else words[:1] * len(words)
        docs.append((i, " ".join(words), "clash", 9, "clash"))
        labels.append((i, good, toxic if good else 0, "clash"))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    odd = [(None, "lost", "c", 1, ""), (1001, None, None, None, None), (1002, "", "c", 1, ""), (1003, " \n", "c", 1, ""), docs[0], (1004, "word " * 30_000, "c", 1, "")]
    labels += [(None, 1, 1, ""), (1001, 1, 0, ""), (5, None, None, ""), (6, 7, 9, ""), labels[3], (9000, 0, 1, "")]
    return spark.createDataFrame(docs + odd, DOCS), spark.createDataFrame(labels, LABELS), docs, labels


def test_fold_is_crc32_of_the_id_as_text(spark):
    rows = spark.range(-50, 500).select("id", labelled.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


def test_training_rows_are_bounded_and_outside_the_fold(tables):
    docs, labels, *_ = tables
    table, share = labelled.training_rows(docs, labels, "toxic", 30)
    rows = table.toPandas()
    assert 0 < share < 1 and len(rows) <= 60 and rows["doc_id"].is_unique
    assert not any(zlib.crc32(str(i).encode()) % 5 == 0 for i in rows["doc_id"])
    whole = labelled.training_rows(docs, labels, "toxic", 10**6)[0].toPandas()
    assert 6 not in set(whole["doc_id"]) and 1001 not in set(whole["doc_id"]) and 9000 not in set(whole["doc_id"])
    texts = {r["doc_id"]: r["text"] for r in docs.filter("doc_id is not null").collect()}
    assert all(t == texts[i] for i, t in zip(whole["doc_id"], whole["text"]))  # never cut


def plain_toxicity(text, model):
    """The score window by window, with nothing of the operator's but its model and compressor settings."""
    flat = (" " + " ".join((text or "").lower().split()) + " ").encode()
    gains, at = [], 0
    while at < len(flat) - 1:
        end = min(at + 64, len(flat) - 1)
        blank = flat.find(b" ", end, end + 64)
        end = blank if blank >= 0 else min(end + 64, len(flat) - 1)
        piece = flat[at : end + 1]
        gains.append(len(toxicity._compressor(model.ordinary).compress(piece)) - len(toxicity._compressor(model.toxic).compress(piece)))
        at = end
    up = sorted([g for g in gains if g > 0], reverse=True) + [0, 0]
    x = [1.0, min(up[0], 12), min(up[1], 12), np.log(1 + sum(up)), np.log(1 + sum(g > 0 for g in gains)), np.log(1 + len(gains))]
    return 1 / (1 + np.exp(-sum(w * v for w, v in zip(model.weights, x))))


def test_toxicity_window_by_window(tables):
    docs, labels, *_ = tables
    model = toxicity.trained(docs, labels)
    some = docs.filter("doc_id < 40 or doc_id > 1000 or doc_id is null").filter("doc_id is null or doc_id <> 1004").select("text")
    for r in some.select("text", toxicity.toxicity(F.col("text"), model).alias("s")).collect():
        assert r["s"] == pytest.approx(plain_toxicity(r["text"], model), abs=1e-9)


def test_toxic_words_far_into_a_text_are_learnt(spark):
    """All evidence stands behind tens of thousands of plain characters."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice(["ba", "ko", "mi", "tur", "len", "sa"]) for _ in range(3)) for _ in range(200)]
    docs, labels = [], []
    for i in range(120):
        words = [rng.choice(vocabulary) for _ in range(3000)]
        docs.append((i, " ".join(words + ["grobzak", "vixnurf"] * 3 * (i % 2)), "", 1, ""))
        labels.append((i, 1, i % 2, ""))
    model = toxicity.trained(spark.createDataFrame(docs, DOCS).repartition(8), spark.createDataFrame(labels, LABELS))
    assert b"grobzak" in model.toxic and b"grobzak" not in model.ordinary


def plain_quality_features(text):
    words = (text or "").split()
    if not words:
        return [0.0] * 14
    n, chars = len(words), sum(len(w) for w in words)
    lines = [x for x in text.split("\n") if x.strip()]
    last = [w[-1] for w in words]
    return [
        np.log(1 + n), chars / n, sum(w.isupper() for w in words) / n,
        sum(not c.isalnum() and c not in ".,;:?'\"()-" for c in last) / n, sum(w == "|" for w in words) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, max(words.count(w) for w in set(words)) / n,
        sum(len(set(words[i : i + 200])) for i in range(0, n, 200)) / n, len(set(lines)) / len(lines),
        sum(c in "0123456789" for c in text) / chars, sum(c in "!*$#&%@|<>{}[]=_~^\\/+" for c in text) / chars,
        sum(len(w) > 12 for w in words) / n, np.log(1 + n / len(lines)), sum(c in ".," for c in last) / n,
    ]


def test_quality_feature_by_feature(tables):
    docs, labels, *_ = tables
    rows = [r["text"] for r in docs.filter("doc_id is null or doc_id <> 1004").select("text").limit(60).collect()]
    rows += ["A| b! c, d. 12 | |\n\nx_y LONGLONGLONGWORD LONGLONGLONGWORD", "é ñ\nÉ"]
    for text in rows:
        assert np.allclose(quality.features(text), plain_quality_features(text))
    model = quality.trained(docs, labels)
    table, share = labelled.training_rows(docs, labels, "quality", quality.PER_CLASS)
    known = sorted(table.collect(), key=lambda r: r["doc_id"])
    again = quality.fit(np.array([plain_quality_features(r["text"]) for r in known]), np.array([r["label"] for r in known]), share)
    x = np.array([plain_quality_features(t) for t in rows])
    assert np.allclose(model.score(x), again.score(x), atol=1e-6)


@pytest.mark.parametrize("name, module, threshold", [("toxic", toxicity, 0.5), ("quality", quality, 0.3)])
def test_held_out_accuracy_and_odd_rows(tables, name, module, threshold):
    docs, labels, plain, known = tables
    model = module.trained(docs, labels)
    score = (module.toxicity if name == "toxic" else module.quality)(F.col("text"), model)
    found = labelled.with_scores(docs.select("doc_id", "text"), score, threshold).collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    label = {i: (t if name == "toxic" else q) for i, q, t, _ in known[: len(plain)]}
    held = [r for r in found if r["held_out"] and r["doc_id"] in label]
    assert len(held) > 40
    assert np.mean([r["predicted"] == label[r["doc_id"]] for r in held]) >= 0.9


def test_one_kind_of_label_or_no_rows(spark, tables):
    docs, labels, *_ = tables
    for part, marks in ((docs, labels.filter("toxic = 0")), (docs.limit(0), labels), (docs, labels.limit(0))):
        assert toxicity.trained(part, marks) is None
    assert quality.trained(docs, labels.limit(0)) is None
    assert docs.limit(0).select(toxicity.toxicity(F.col("text"), None), quality.quality(F.col("text"), None)).count() == 0


def test_windows_cover_the_whole_text():
    rng = random.Random(2)
    for _ in range(200):
        text = toxicity.normal(" ".join("x" * rng.randrange(1, 300) for _ in range(rng.randrange(0, 20))))
        pieces = list(toxicity.windows(text))
        assert b"".join(p[:-1] for p in pieces) + text[-1:] == (text if pieces else text[-1:])
        assert all(len(p) <= 2 * toxicity.WINDOW + 1 for p in pieces)


def test_tables_add_up_to_the_trees(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(quality.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(int)  # only a pair of features tells
    model = quality.fit(x, y)
    assert np.mean((model.score(x) >= 0.5) == y) > 0.85
    assert any({i, j} == {0, 1} for i, j, _ in model.pairs)
    total = [model.intercept + sum(t[np.searchsorted(e, v)] for t, e, v in zip(model.tables, model.edges, row)) for row in x[:5]]
    total = [
        z + sum(t[np.searchsorted(model.edges[i], row[i]), np.searchsorted(model.edges[j], row[j])] for i, j, t in model.pairs)
        for z, row in zip(total, x[:5])
    ]
    assert np.allclose(model.score(x[:5]), 1 / (1 + np.exp(-np.array(total))))


def test_split_and_features():
    assert quality._split(np.array([-5.0, -5.0, 5.0, 5.0]), np.ones(4))[1] == 2
    assert quality._split(np.zeros(1), np.ones(1)) == (0.0, 0)
    assert quality.features(None) == quality.features(" \n") == [0.0] * len(quality.FEATURES)
    row = dict(zip(quality.FEATURES, quality.features("A A b!! |\nx 12")))
    assert row["repeated_next"] == pytest.approx(1 / 6) and row["bars"] == pytest.approx(1 / 6) and row["digits"] == pytest.approx(2 / 9)
