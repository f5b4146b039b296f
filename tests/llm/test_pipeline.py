"""The pipeline's stages, each on the rows its predecessor kept, against brute force."""

from collections import defaultdict

import pytest

import corpus_pipeline
from quipu.llm import toxicity
from tests.llm.test_decontamination import plain as plain_contamination
from tests.llm.test_mixing import plain_targets
from tests.llm.test_simhash import plain_components, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    made = [("documents", docs)]
    for name, function in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        function(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        made.append((name, docs))
    return {name: ([r.asDict() for r in table.collect()], table.columns) for name, table in made}


def rows_of(stages, name):
    return sorted((r["doc_id"], r["text"]) for r in stages[name][0])


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert all(stages[n][1] == stages["documents"][1] for n in ("toxicity", "near_duplicates", "decontamination", "mixing"))
    assert stages["sharding"][1] == [*stages["documents"][1], "shard", "bytes"]


def test_toxicity(spark, stages):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.trained(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scorer = toxicity.Scorer(model.ordinary, model.toxic, model.weights) if model else None
    expected = [(i, t) for i, t in rows_of(stages, "documents") if not scorer or scorer.score(t) < 0.5]
    assert rows_of(stages, "toxicity") == expected


def test_near_duplicates(stages):
    before = rows_of(stages, "toxicity")
    classes = plain_components([i for i, _ in before], [plain_fingerprint(t) for _, t in before])
    assert rows_of(stages, "near_duplicates") == [row for row, c in zip(before, classes) if row[0] == c]


def test_decontamination(spark, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = [(i, t) for i, t in rows_of(stages, "near_duplicates") if plain_contamination(t, items)[1] == 0]
    assert rows_of(stages, "decontamination") == kept


def test_mixing(stages):
    before = {r["doc_id"]: r for r in stages["decontamination"][0]}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in before.values():
        sizes[r["source"]] += len(r["text"].split())
    passes = defaultdict(int)
    for r in stages["mixing"][0]:
        assert before[r["doc_id"]]["text"].startswith(r["text"]) and r["text"]
        taken[r["source"]] += len(r["text"].split())
        passes[r["doc_id"]] += 1
    assert max(passes.values()) <= 3
    for source, target in plain_targets(sizes).items():
        assert target - 1 <= taken[source] <= target


def test_sharding(stages):
    assert rows_of(stages, "sharding") == rows_of(stages, "mixing")
    sizes = defaultdict(list)
    for r in stages["sharding"][0]:
        assert r["bytes"] == len(r["text"].encode())
        sizes[r["shard"]].append(r["bytes"])
    assert all(sum(v) <= 1 << 20 or len(v) == 1 for v in sizes.values())


def test_run_gives_the_same_rows(spark, stages):
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r["doc_id"], r["text"], r["shard"]) for r in found) == sorted((r["doc_id"], r["text"], r["shard"]) for r in stages["sharding"][0])
