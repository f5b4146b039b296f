"""Readers and writers on small files, and documents in rows."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.operators import text
from quipu.sources import documents, files, jdbc


def put(path, content):
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_delimited_round_trip_keeps_text(spark, tmp_path):
    rows = [("Viña del Mar", 29, 1.5), (' spaced "quoted"; text ', 3, None), ("", None, 2.0)]
    df = spark.createDataFrame(rows, "ciudad string, dia int, valor double")
    files.write_csv(df, str(tmp_path / "out"), sep=";", single_file=True)
    back = files.read_csv(spark, str(tmp_path / "out"), df.schema, sep=";")
    expected = [(c or None, d, v) for c, d, v in rows]  # an empty field reads as missing
    assert sorted(map(str, map(tuple, back.collect()))) == sorted(map(str, expected))


def test_three_tokens_for_missing(spark, tmp_path):
    path = put(tmp_path / "t.csv", "title,country,year\nA,Not Given,2001\nB,NaN,NaN\nC,,1999\n")
    schema = T.StructType.fromDDL("title string, country string, year int")
    got = files.read_csv_na(spark, path, schema, ["", "NaN", "Not Given"])
    assert [tuple(r) for r in got.orderBy("title").collect()] == [("A", None, 2001), ("B", None, None), ("C", None, 1999)]


def test_all_text_with_quoted_newline(spark, tmp_path):
    path = put(tmp_path / "t.csv", 'id,text\n1,"two\nlines, one ""field"""\n2,\n')
    got = files.read_csv_strings(spark, path, quoted_newlines=True)
    assert got.columns == ["id", "text"] and [t for _, t in got.dtypes] == ["string", "string"]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [("1", 'two\nlines, one "field"'), ("2", "")]


def test_lines_heads_and_numbers(spark, tmp_path):
    folder = tmp_path / "texts"
    folder.mkdir()
    put(folder / "a.txt", "  uno\ndos\t\ntres\ncuatro")
    put(folder / "b.txt", "sola\n")
    assert sorted(r[0] for r in files.read_lines(spark, str(folder)).collect()) == ["cuatro", "dos", "sola", "tres", "uno"]
    heads = files.text_head(spark, str(folder), 3).orderBy("file", "line_no").collect()
    assert [(r["file"][-5:], r["line_no"], r["line"]) for r in heads] == [
        ("a.txt", 0, "uno"), ("a.txt", 1, "dos"), ("a.txt", 2, "tres"), ("b.txt", 0, "sola"),
    ]
    assert files.read_whole(spark, str(folder)).count() == 2


def test_line_numbers_of_a_file_in_many_splits(spark, tmp_path):
    path = put(tmp_path / "long.txt", "\n".join(f"line {i}" for i in range(5000)))
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 2
        got = files.read_numbered_lines(spark, path).collect()
        heads = files.text_head(spark, path, 3).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)
    assert sorted((r["line_no"], r["line"]) for r in got) == [(i, f"line {i}") for i in range(5000)]
    assert sorted(r["line"] for r in heads) == ["line 0", "line 1", "line 2"]


def test_edges(spark, tmp_path):
    path = put(tmp_path / "edges.txt", "12 34 header\n1\t2\n 3   4 \nonly\n\n5 6 7\n1 4\n")
    got = files.read_edges(spark, path)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2), (1, 4), (3, 4)]
    header_like = put(tmp_path / "edges2.txt", "9 9\n1 2\n")
    assert [tuple(r) for r in files.read_edges(spark, header_like).collect()] == [(1, 2)]


def test_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "people")
    rows = spark.createDataFrame([("lit é", 3), ("oak", 8)], "tree string, age int")
    files.append_csv(rows, path)
    files.append_csv(rows, path)
    assert files.read_csv(spark, path, rows.schema, header=False).count() == 4
    lines = str(tmp_path / "lines")
    for word in ("viejo", "nuevo"):
        files.overwrite_text(spark.createDataFrame([(word,)], "value string"), lines)
    assert [r[0] for r in spark.read.text(lines).collect()] == ["nuevo"]


def test_json_lines_keep_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    files.write_json(df, str(tmp_path / "j"))
    back = spark.read.schema(df.schema).json(str(tmp_path / "j"))
    assert sorted(map(tuple, back.collect()), key=str) == [(1, None), (2, "x")]
    assert all("b" in json.loads(r[0]) for r in spark.read.text(str(tmp_path / "j")).collect())


def test_column_oriented_json(spark):
    doc = {"kind": {"0": "moss", "1": "fern", "10": "reed"}, "count": {"0": 41, "1": None, "10": 7}}
    df = spark.createDataFrame([(json.dumps(doc),)], "doc string")
    got = documents.columns_to_rows(df, "doc", T.StructType.fromDDL("kind string, count bigint"))
    assert [tuple(r) for r in got.orderBy("index").collect()] == [(0, "moss", 41), (1, "fern", None), (10, "reed", 7)]


def test_column_oriented_json_files(spark, tmp_path):
    put(tmp_path / "c.json", '{"kind": {"0": "moss"}, "count": {"0": 4}}\n{"kind": {"3": null}, "count": {"3": 5}}\n')
    got = documents.read_columns(spark, str(tmp_path / "c.json"), T.StructType.fromDDL("kind string, count bigint"))
    assert [tuple(r) for r in got.orderBy("index").collect()] == [(0, "moss", 4), (3, None, 5)]


def test_normalize_and_record_path(spark):
    doc = {"info": {"page": 2}, "results": [{"gender": "f", "name": {"first": "Ana", "last": "P"}}, {"gender": "m", "name": {"first": "Juan", "last": "Q"}}]}
    schema = "info struct<page: bigint>, results array<struct<gender: string, name: struct<first: string, last: string>>>"
    df = spark.createDataFrame([(json.dumps(doc),)], "doc string").select(F.from_json("doc", schema).alias("d")).select("d.*")
    rows = documents.explode_records(df, "results", ["info.page"])
    flat = documents.normalize(rows)
    assert flat.columns == ["gender", "name.first", "name.last", "info.page"]
    assert [tuple(r) for r in flat.orderBy("gender").collect()] == [("f", "Ana", "P", 2), ("m", "Juan", "Q", 2)]


def test_response_gate(spark):
    landed = spark.createDataFrame(
        [("ana", 200, '{"gender": "female", "probability": 0.98}'), ("x", 500, "oops"), ("y", None, None)],
        "name string, status int, body string",
    )
    good, refused = documents.split_responses(landed, "gender string, probability double")
    assert [tuple(r) for r in good.collect()] == [("ana", "female", 0.98)]
    assert sorted((r["name"], r["report"]) for r in refused.collect()) == [("x", "Error: 500"), ("y", "Error: null")]


def test_series(spark):
    doc = {"serie": [{"fecha": "2024-05-02T04:00:00.000Z", "valor": 37.5}, {"fecha": "2024-05-01T04:00:00.000Z", "valor": 37.0}]}
    df = spark.createDataFrame([("uf", json.dumps(doc))], "codigo string, doc string")
    got = documents.series(df, "doc", ["codigo"]).orderBy("fecha").collect()
    assert [(r["codigo"], str(r["fecha"]), r["valor"]) for r in got] == [("uf", "2024-05-01", 37.0), ("uf", "2024-05-02", 37.5)]


def test_invoices(spark, tmp_path):
    # The names of elements and attributes.
    def invoice(number, name, amount, day):
        return f'<factura id="{number}"><cliente>{name}</cliente><monto moneda="X">{amount}</monto><fecha>{day}</fecha></factura>'

    rows = [("0031", "Lumen", 12, "2031-02-03"), ("4", "Río & hijos", 9, "2031-02-04")]
    body = "".join(invoice(n, c.replace("&", "&amp;"), a, d) for n, c, a, d in rows)
    path = put(tmp_path / "f.xml", f'<?xml version="1.0"?><facturacion>{body}</facturacion>')
    got = documents.read_invoices(spark, path).orderBy("id")
    assert got.dtypes == [("id", "string"), ("cliente", "string"), ("monto", "int"), ("fecha", "string")]
    assert [tuple(r) for r in got.collect()] == rows


def test_jdbc_needs_bounds_to_split(spark):
    with pytest.raises(ValueError):
        jdbc.read_table(spark, "jdbc:none", "t", {}, split_on="id")


def test_word_frequency(spark):
    df = spark.createDataFrame([("The cat\tsaw the CAT",), ("",), ("  dog cat don't",), (None,)], "text string")
    counts = {r["word"]: r["n"] for r in text.word_frequency(df, "text").collect()}
    assert counts == {"cat": 3, "saw": 1, "dog": 1}
    top = text.top_words(text.word_frequency(df, "text"), 2).collect()
    assert [(r["word"], r["n"]) for r in top] == [("cat", 3), ("dog", 1)]
    assert len(text.ENGLISH_STOP_WORDS) == len(set(text.ENGLISH_STOP_WORDS)) == 179
