"""Registered queries of the subpackage next to their SQL, and over the smallest folder where there is none."""

import pytest

from quipu.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLE_SQL[name]) == []


@pytest.mark.parametrize("name", ["op6_toxicity", "op9_quality"])
def test_scores_of_every_document(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    least = {"op6_toxicity": 0.5, "op9_quality": 0.3}[name]
    assert all(r["predicted"] == int(r["score"] >= least) for r in rows)
    assert {r["held_out"] for r in rows} == {True, False}


def _counted(spark, tmp_path, name, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return {r["doc_id"]: r for r in QUERIES[name](spark, str(tmp_path)).collect()}


def test_secrets_are_counted_by_kind_wherever_they_stand(spark, tmp_path):
    access, digest = "AKIA" + "Q7" * 8, "0123456789abcdef" * 2
    texts = [access, digest, f"{digest} {access} token=abcdef", "token=abcdef " * 3, f"{digest} " * 4, None]
    rows = _counted(spark, tmp_path, "op1_secrets", texts)
    assert [(rows[i]["n_assign"], rows[i]["n_access"], rows[i]["n_hex"]) for i in range(6)] == [
        (0, 1, 0), (0, 0, 1), (1, 1, 1), (3, 0, 0), (0, 0, 4), (0, 0, 0),
    ]


def test_personal_data_is_counted_by_kind_wherever_it_stands(spark, tmp_path):
    email, ip, card, phone = "a.b@c.org", "10.0.0.1", "4111 1111 1111 1111", "+49 30 1234567"
    texts = [email, ip, card, phone, f"{phone}, {card}, {ip}, {email}", f"{email}, " * 3, f"{ip}, " * 5, None]
    rows = _counted(spark, tmp_path, "op10_pii", texts)
    assert [(rows[i]["n_email"], rows[i]["n_ip"], rows[i]["n_card"], rows[i]["n_phone"]) for i in range(8)] == [
        (1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1), (1, 1, 1, 1), (3, 0, 0, 0), (0, 5, 0, 0), (0, 0, 0, 0),
    ]
