"""Text and delimited files. Every reader takes a schema; nothing is inferred."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.functions.strings import strip, words
from quipu.operators.missing import blank_tokens
from quipu.operators.ordering import with_position
from quipu.storage import is_short, stage

_UNUSED = "\u0001"  # a separator that no line holds, so a line stays one field


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ",",
    encoding: str = "UTF-8",
    header: bool = True,
    quoted_newlines: bool = False,
) -> DataFrame:
    """Delimited text with doubled quotes inside quoted fields; empty fields are missing.

    ``quoted_newlines`` lets fields span lines. Files in UTF-8 are split over many tasks all
    the same (see ``quoted_records``); others take one task each.
    """
    if quoted_newlines and encoding.upper().replace("-", "") == "UTF8":
        kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        return _parsed(quoted_records(spark, path, header), kind, sep)
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", quoted_newlines)
        .csv(path)
    )


def read_csv_na(
    spark: SparkSession, path: str, schema: T.StructType, tokens: list[str], sep: str = ","
) -> DataFrame:
    """Delimited text in which several tokens stand for a missing value.

    Columns are read as text first, as one of the tokens may fill a number column.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    cleaned = blank_tokens(read_csv(spark, path, text, sep), tokens)
    return cleaned.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def read_csv_strings(
    spark: SparkSession, path: str, sep: str = ",", quoted_newlines: bool = False
) -> DataFrame:
    """Delimited text with all fields as text, named by the header line.

    An empty field is empty text, not a missing value. With ``quoted_newlines`` fields may
    span lines, and files are split over many tasks all the same; the header is one line.
    """
    reader = spark.read.option("header", True).option("inferSchema", False).option("sep", sep).option("quote", '"').option("escape", '"')
    rows = reader.csv(path)
    if quoted_newlines:
        rows = _parsed(quoted_records(spark, path, True), rows.schema, sep)  # the names alone are taken from the first line
    return rows.na.fill("")


def _quotes(lines: DataFrame) -> DataFrame:
    """(file, _block, _open): whether a quoted field is open where a split of a file begins."""
    marks = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    splits = lines.groupBy("file", "_block").agg(F.sum(marks).alias("_marks"))
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    is_open = F.coalesce(F.sum("_marks").over(earlier), F.lit(0)) % 2 == 1
    return stage(splits.select(F.col("file").alias("_file"), F.col("_block").alias("_at"), is_open.alias("_open")), "splits")


def _split_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, block, open, line) in order to rows (file, block, first, part, text).

    ``part`` is 0 for a whole record, 1 for the end of one that began in an earlier split,
    2 for the beginning of one that a later split ends, and 3 for a split inside a record.
    ``first`` says that the record begins the file.
    """
    names = ["file", "block", "first", "part", "text"]

    def rows(file, block, texts, parts, first):
        n = len(texts)
        arrays = [pa.array([file] * n), pa.array([block] * n, pa.int64()), pa.array([first] + [False] * (n - 1)), pa.array(parts, pa.int32())]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string())], names=names)

    split, held, inside, before, fresh = None, [], False, False, True

    def rest():
        if held:  # the split ends inside a record
            yield rows(*split, ["\n".join(held)], [3 if before else 2], fresh and not before and not split[1])

    for batch in batches:
        if not batch.num_rows:
            continue
        marks = pc.count_substring(batch.column(3), '"').to_numpy(zero_copy_only=False)
        blocks = batch.column(1).to_numpy()
        files = batch.column(0).dictionary_encode()
        code = files.indices.to_numpy()
        cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | (code[1:] != code[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(blocks)]):
            here = (files.dictionary[int(code[a])].as_py(), int(blocks[a]))
            if here != split:
                yield from rest()
                split, held, fresh = here, [], True
                inside = before = batch.column(2)[a].as_py()
            lines = batch.column(3).slice(a, b - a).to_pylist()
            ends = np.flatnonzero((np.cumsum(marks[a:b]) + inside) % 2 == 0).tolist()
            texts, parts, at = [], [], 0
            for end in ends:
                texts.append("\n".join([*held, *lines[at : end + 1]]) if held or end > at else lines[end])
                parts.append(1 if before else 0)
                held, before, at = [], False, end + 1
            held += lines[at:]
            inside = bool((marks[a:b].sum() + inside) % 2)
            if texts:
                yield rows(*split, texts, parts, fresh and parts[0] == 0 and not split[1])
                fresh = False
    yield from rest()


def quoted_records(spark: SparkSession, path: str, header: bool) -> DataFrame:
    """The records (one column ``text``) of delimited files whose quoted fields may span lines, without headers.

    Files are read in splits. The quotes of each split are counted first; sums of those
    say whether a split begins inside a quoted field. Every task then joins the lines of its
    records, and only the pieces of records that cross the end of a split, two for each
    split, are dealt out and joined. Quotes stand around fields, and doubled inside them.
    """
    lines = _placed_lines(spark, path)
    splits = _quotes(lines)
    same = (F.col("file") == F.col("_file")) & (F.col("_block") == F.col("_at"))
    if is_short(splits):  # a row per split
        marked = lines.join(F.broadcast(splits), same)
    else:
        marked = lines.join(splits, same).repartition("file", "_block").sortWithinPartitions("file", "_block", "_scan")
    kind = "file string, block long, first boolean, part int, text string"
    # Stored, as whole records and pieces are told apart below.
    found = stage(marked.select("file", "_block", "_open", "line").mapInArrow(_split_records, kind), "records")
    pieces = found.filter("part > 0")
    order = Window.partitionBy("file").orderBy("block", "part")  # two pieces per split; an end stands before a beginning
    begun = F.sum(F.when(F.col("part") == 2, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = pieces.withColumn("record", begun)
    joined = numbered.groupBy("file", "record").agg(
        F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("block", "part", "text"))).alias("pieces")
    )
    joined = joined.select("first", F.array_join("pieces.text", "\n").alias("text"))
    records = found.filter("part = 0").select("first", "text").unionByName(joined)
    if header:
        records = records.filter(~F.col("first"))
    return records.select(F.regexp_replace("text", r"\r$", "").alias("text")).filter("text <> ''")


def _parsed(records: DataFrame, schema: T.StructType, sep: str) -> DataFrame:
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true"}
    fields = ", ".join("`{}` {}".format(f.name.replace("`", "``"), f.dataType.simpleString()) for f in schema.fields)
    return records.select(F.from_csv("text", fields, options).alias("row")).select("row.*")


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return read_csv(spark, path, schema, sep="\t")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, without surrounding white space."""
    return spark.read.option("lineSep", "\n").text(path).select(strip(F.col("value")).alias("line"))


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    """One row per file. For small files; larger ones are read by line."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), "value"
    )


def _placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with what orders them in a file: their split's offset, then scan order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_scan"),
        F.col("value").alias("line"),
    )


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line), numbered from 0 in each file, however large the file."""
    lines = _placed_lines(spark, path)
    numbered = with_position(lines, F.col("_block"), F.col("_scan"), by=["file"], name="line_no")
    return numbered.select("file", "line_no", "line")


def text_head(spark: SparkSession, path: str, n: int = 3) -> DataFrame:
    """First ``n`` lines of every file.

    The row-number filter is pushed below the shuffle, so a split sends ``n`` lines.
    """
    first = Window.partitionBy("file").orderBy("_block", "_scan")
    ranked = _placed_lines(spark, path).withColumn("_nth", F.row_number().over(first))
    return ranked.filter(F.col("_nth") <= n).select(
        "file", (F.col("_nth") - 1).alias("line_no"), strip(F.col("line")).alias("line")
    )


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """Directed edges after one header line: lines of exactly two whole numbers.

    Read as one-field delimited text, whose header line is dropped per file while
    large files are still split over many tasks.
    """
    lines = (
        spark.read.schema("value string")
        .option("header", True)
        .option("sep", _UNUSED)
        .option("quote", "")
        .csv(path)
    )
    pair = words(F.col("value"))
    return lines.filter(F.size(pair) == 2).select(
        pair[0].cast("bigint").alias("src"), pair[1].cast("bigint").alias("dst")
    )


def _delimited(df: DataFrame, mode: str, sep: str) -> DataFrameWriter:
    return (
        df.write.mode(mode)
        .option("sep", sep)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def write_csv(
    df: DataFrame, path: str, sep: str = ";", mode: str = "errorifexists", single_file: bool = False
) -> None:
    """Delimited text with a header. ``single_file`` is for short reports only."""
    out = df.repartition(1) if single_file else df  # the report is still computed by many tasks
    _delimited(out, mode, sep).option("header", True).csv(path)


def append_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Add rows, without a header, to what is there."""
    _delimited(df, "append", sep).csv(path)


def overwrite_text(df: DataFrame, path: str) -> None:
    """Replace what is there by the lines of a one-column table."""
    df.write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line, which can be split when read back."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
