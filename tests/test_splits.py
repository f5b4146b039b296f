"""Delimited files whose quoted fields span lines, read in many splits, against one task per file."""

import csv
import io
import random

import pytest

from quipu.sources import files


def content(seed, n, newline="\n"):
    rng = random.Random(seed)
    words = ["a", 'say ""x""'.replace('""', '"'), "two\nlines", "\n\n", "é,ü", "", '"', "long " * 30, "a\r\nb", " spaced "]
    rows = [[str(i), " ".join(rng.sample(words, rng.randrange(0, 4))), rng.choice(words)] for i in range(n)]
    out = io.StringIO()
    writer = csv.writer(out, quoting=csv.QUOTE_MINIMAL, lineterminator=newline)
    writer.writerows([["id", "text", "more"], *rows])
    return out.getvalue(), rows


@pytest.fixture
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield use
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [64, 700, 20_000])
def test_one_file_in_many_splits(spark, tmp_path, small_splits, size):
    """Splits shorter than records, about as long, and longer."""
    text, rows = content(1, 400)
    (tmp_path / "t.csv").write_bytes(text.encode())
    whole = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(str(tmp_path)).na.fill("")
    expected = sorted(map(tuple, whole.collect()))
    assert [r[0] for r in expected] == sorted(r[0] for r in rows)
    small_splits(size)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 1
    got = files.read_csv_strings(spark, str(tmp_path), quoted_newlines=True)
    assert got.columns == ["id", "text", "more"]
    assert sorted(map(tuple, got.collect())) == expected


def test_several_files_with_headers(spark, tmp_path, small_splits):
    expected = []
    for k in range(5):
        text, rows = content(10 + k, 30 * k)
        (tmp_path / f"{k}.csv").write_bytes(text.encode())
        expected += rows
    small_splits(900)
    got = files.read_csv_strings(spark, str(tmp_path), quoted_newlines=True)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected))


def test_typed_columns_and_no_header(spark, tmp_path, small_splits):
    (tmp_path / "t.csv").write_bytes(b'1;"a\nb";2.5\r\n2;;\r\n\r\n3;"x ""y""";7\r\n')
    small_splits(5)
    got = files.read_csv(spark, str(tmp_path), "id int, text string, v double", sep=";", header=False, quoted_newlines=True)
    assert sorted(map(tuple, got.collect())) == [(1, "a\nb", 2.5), (2, None, None), (3, 'x "y"', 7.0)]


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(500))
    (tmp_path / "t.csv").write_text(f'id,text\n1,"{long}"\n2,b\n')
    small_splits(128)
    got = files.read_csv_strings(spark, str(tmp_path), quoted_newlines=True)
    assert sorted(map(tuple, got.collect())) == [("1", long), ("2", "b")]


def test_tasks_of_one_large_file(spark, tmp_path, small_splits):
    text, rows = content(3, 3000)
    (tmp_path / "t.csv").write_text(text)
    small_splits(16_000)
    lines = files._placed_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 10
    assert files.read_csv_strings(spark, str(tmp_path), quoted_newlines=True).count() == len(rows)


def test_empty_file(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,text\n")
    assert files.read_csv_strings(spark, str(tmp_path), quoted_newlines=True).collect() == []
