"""Nested documents: JSON texts, XML elements, landed API responses."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.storage import is_short, stage


def records(df: DataFrame, document: str, schema: str, path: str, keep: list[str] | None = None) -> DataFrame:
    """Rows of the record list at ``path`` inside JSON texts.

    ``schema`` describes the whole document, for example
    ``results array<struct<name: string>>``.
    """
    parsed = df.select(*(keep or []), F.from_json(document, schema).alias("_doc"))
    return parsed.select(*(keep or []), F.inline(F.col(f"_doc.{path}")))


def read_records(spark: SparkSession, path: str, schema: str, records_path: str) -> DataFrame:
    """Rows of the record list of JSON documents stored one per line."""
    return spark.read.schema(schema).json(path).select(F.inline(records_path))


def columns_to_rows(
    df: DataFrame, document: str, schema: T.StructType, keep: list[str] | None = None, index: str = "index"
) -> DataFrame:
    """Rows of JSON texts laid out as column -> row index -> value.

    Each text is unfolded where it is: its columns become maps, and the union of
    their indexes is exploded, so no shuffle is needed.
    """
    maps = T.StructType(
        [T.StructField(f.name, T.MapType(T.StringType(), f.dataType)) for f in schema.fields]
    )
    parsed = df.select(*(keep or []), F.from_json(document, maps).alias("_doc"))
    columns = [F.col("_doc")[f.name] for f in schema.fields]
    empty = F.array().cast("array<string>")
    indexes = F.array_distinct(F.flatten(F.array(*[F.coalesce(F.map_keys(c), empty) for c in columns])))
    rows = parsed.select(*(keep or []), "_doc", F.explode(indexes).alias("_index"))
    return rows.select(
        *(keep or []),
        F.col("_index").cast("int").alias(index),
        *[
            F.try_element_at(F.col("_doc")[f.name], F.col("_index")).alias(f.name)
            for f in schema.fields
        ],
    )


def read_columns(spark: SparkSession, path: str, schema: T.StructType, index: str = "index") -> DataFrame:
    """Rows of column-oriented JSON files, one document per line."""
    return columns_to_rows(spark.read.text(path), "value", schema, index=index)


_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.S)
_ESCAPED = re.compile(r"\\.", re.S)
_COLUMN = re.compile(r'[\s{]*("(?:[^"\\]|\\.)*")\s*:\s*\{', re.S)
_ENTRY = re.compile(r'\s*("(?:[^"\\]|\\.)*")\s*:(.*)', re.S)


def _depth(text: str) -> int:
    """Brackets opened less those closed, outside strings."""
    bare = _STRING.sub("", text)
    return bare.count("{") + bare.count("[") - bare.count("}") - bare.count("]")


def _whole(pieces: Iterator[tuple[str, int, bool, str]]) -> Iterator[tuple[str, int, int, str]]:
    """Pieces between commas (file, block, open, text) in order to (file, block, part, text), joined where a string goes on.

    ``part`` is 0 for a whole one, 1 for the end of one that began in an earlier split, 2 for
    the beginning of one that a later split ends, 3 for a split that lies inside one.
    """
    split, held, inside, before = None, [], False, False
    for file, block, is_open, text in pieces:
        if (file, block) != split:
            if held:
                yield *split, 3 if before else 2, ",".join(held)
            split, held, inside = (file, block), [], is_open
            before = is_open
        held.append(text)
        inside ^= bool(_ESCAPED.sub("", text).count('"') % 2)  # no escape reaches over a comma
        if not inside:
            yield *split, 1 if before else 0, ",".join(held)
            held, before = [], False
    if held:
        yield *split, 3 if before else 2, ",".join(held)


def _columns_of(pieces: Iterator[tuple[str, int, str]]) -> Iterator[tuple[str, int, str | None, str | None, str | None]]:
    """Pieces (file, block, text) in order to entries (file, block, column, index, value), column null before the first one of a split."""
    split, column, held, depth = None, None, [], 0
    for file, block, text in pieces:
        if (file, block) != split:
            split, column, held, depth = (file, block), None, [], 0
        if not held and (found := _COLUMN.match(text)):
            column, text = json.loads(found[1]), text[found.end() :]
        held.append(text)
        depth += _depth(text)
        if depth > 0:  # a comma inside a value
            continue
        entry = _ENTRY.match(",".join(held))
        held, depth = [], 0
        if entry:
            value = entry[2]
            for _ in range(max(-_depth(value), 0)):  # the column ends here, or the document
                value = value.rstrip()[:-1]
            yield file, block, column, json.loads(entry[1]), value.strip()
        else:
            yield file, block, column, None, None  # an empty column still says where it begins


def read_large_columns(spark: SparkSession, path: str, schema: T.StructType, index: str = "index", keep_file: bool = False) -> DataFrame:
    """Rows of column-oriented JSON files of one document each, however long.

    A file is read in splits, cut at its commas. The quotes of every split are counted first,
    which tells whether it begins inside a string; then its pieces are joined where a comma
    stands in a string, and those that reach over the end of a split, two for each split,
    are joined apart. Each task reads off columns, indexes and values; entries before the first
    column of a split belong to the last column of an earlier one. Values are JSON texts
    parsed as their column's type: null if they are not one. Nested values must lie in one split or be numbers,
    texts, booleans or null; columns that the schema does not name are left out.
    """
    pieces = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_scan"), "value"
    )
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    splits = pieces.groupBy("file", "block").agg(F.sum(F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))).alias("_marks"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    is_open = F.coalesce(F.sum("_marks").over(earlier), F.lit(0)) % 2 == 1
    splits = stage(splits.select(F.col("file").alias("_file"), F.col("block").alias("_block"), is_open.alias("_open")), "splits")
    same = (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block"))
    if is_short(splits):
        marked = pieces.join(F.broadcast(splits), same)
    else:
        marked = pieces.join(splits, same).repartition("file", "block").sortWithinPartitions("file", "block", "_scan")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(4))))
        numbered = ((n, *row) for n, row in enumerate(_whole(rows)))  # rising within a split
        yield from _batched(numbered, [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.string()], ["at", "file", "block", "part", "text"])

    found = marked.select("file", "block", "_open", "value").mapInArrow(joined, "at long, file string, block long, part int, text string")
    found = stage(found, "pieces")
    # A piece over several splits belongs to the one that it begins in, as its last.
    over = found.filter("part > 0")
    order = Window.partitionBy("file").orderBy("block", "part")  # two pieces per split; an end stands before a beginning
    over = over.withColumn("n", F.sum(F.when(F.col("part") == 2, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    over = over.groupBy("file", "n").agg(F.min("block").alias("block"), F.array_sort(F.collect_list(F.struct("block", "part", "text"))).alias("p"))
    over = over.select("file", "block", F.array_join("p.text", ",").alias("last"))
    rows = found.filter("part = 0").select("file", "block", "text", "at").unionByName(over.select("file", "block", F.col("last").alias("text"), F.lit(1 << 62).cast("bigint").alias("at")))
    rows = rows.repartition("file", "block").sortWithinPartitions("file", "block", "at")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(3))))
        numbered = ((n, *row) for n, row in enumerate(_columns_of(rows)))
        names = ["at", "file", "block", "column", "place", "value"]
        yield from _batched(numbered, [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()], names)

    entries = rows.select("file", "block", "text").mapInArrow(read, "at long, file string, block long, column string, place string, value string")
    entries = stage(entries, "entries")
    ends = entries.filter("column IS NOT NULL").groupBy("file", "block").agg(F.max_by("column", "at").alias("named"))
    ends = entries.groupBy("file", "block").agg(F.lit(1).alias("_")).join(ends, ["file", "block"], "left")
    carried = F.last("named", ignorenulls=True).over(earlier)
    ends = stage(ends.select(F.col("file").alias("_file"), F.col("block").alias("_block"), carried.alias("_carried")), "carried")
    ends = F.broadcast(ends) if is_short(ends) else ends
    known = entries.join(ends, same).withColumn("column", F.coalesce("column", "_carried")).filter("place IS NOT NULL")
    names = [f.name for f in schema.fields]
    known = known.filter(F.col("column").isin(names))
    laid = known.groupBy("file", "place").agg(*[F.max(F.when(F.col("column") == n, F.col("value"))).alias(f"_v{i}") for i, n in enumerate(names)])
    parsed = [
        F.from_json(F.concat(F.lit('{"v":'), F.col(f"_v{i}"), F.lit("}")), T.StructType([T.StructField("v", f.dataType)]))["v"].alias(f.name)
        for i, f in enumerate(schema.fields)
    ]
    return laid.select(*(["file"] if keep_file else []), F.col("place").cast("int").alias(index), *parsed)


def _batched(rows: Iterator[tuple], kinds: list[pa.DataType], names: list[str], size: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def normalize(df: DataFrame, sep: str = ".") -> DataFrame:
    """Struct columns flattened to their leaves, named by the path to them."""

    def leaves(kind: T.StructType, at: Column | None, name: str) -> list[Column]:
        out = []
        for f in kind.fields:
            here = F.col(f"`{f.name}`") if at is None else at.getField(f.name)
            path = f.name if at is None else f"{name}{sep}{f.name}"
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, here, path)
            else:
                out.append(here.alias(path))
        return out

    return df.select(*leaves(df.schema, None, ""))


def explode_records(df: DataFrame, record_path: str, meta: list[str], sep: str = ".") -> DataFrame:
    """One row per nested record, with chosen fields of its parent beside it."""
    parents = [F.col(m).alias(m.replace(".", sep)) for m in meta]
    rows = df.select(*parents, F.explode(record_path).alias("_record"))
    names = [f"`{m.replace('.', sep)}`" for m in meta]
    return rows.select("_record.*", *names)


def split_responses(df: DataFrame, schema: str, status: str = "status", body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Fields of the bodies that came with status 200, and a report of the others."""
    good = F.coalesce(F.col(status) == 200, F.lit(False))
    others = [c for c in df.columns if c not in (status, body)]
    fields = df.filter(good).select(*others, F.from_json(body, schema).alias("_body")).select(*others, "_body.*")
    refused = df.filter(~good).select(
        *others, status, F.format_string("Error: %s", F.col(status).cast("string")).alias("report")
    )
    return fields, refused


def series(df: DataFrame, document: str, keep: list[str] | None = None) -> DataFrame:
    """Dated values of indicator documents, as (fecha, valor) rows."""
    schema = "serie array<struct<fecha: string, valor: double>>"
    rows = records(df, document, schema, "serie", keep)
    return rows.withColumn("fecha", F.to_date(F.substring("fecha", 1, 10)))


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str) -> DataFrame:
    """One row per element; attributes are ``_name`` and mixed text is ``_VALUE``."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def read_invoices(spark: SparkSession, path: str) -> DataFrame:
    schema = "_id string, cliente string, monto struct<_VALUE: bigint, _moneda: string>, fecha string"
    return read_xml(spark, path, "factura", schema).select(
        F.col("_id").alias("id"), "cliente", F.col("monto._VALUE").cast("int").alias("monto"), "fecha"
    )
