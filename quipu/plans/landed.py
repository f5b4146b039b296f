"""Sources and sinks: the given tables are written out, then read back.

JSON, XML and text inputs are derived from the tables, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.plans.catalog import Tables, query
from quipu.sources import documents, files
from quipu.storage import fresh_path

_ITEMS = "l_orderkey bigint, l_quantity double, l_returnflag string"


def _items(t: Tables):
    return t.lineitem.select("l_orderkey", "l_quantity", "l_returnflag")


@query("scan_csv", "SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem")
def scan_csv(t: Tables):
    path = fresh_path(t.spark, "items-csv")
    files.write_csv(_items(t), path, sep=";")
    return files.read_csv(t.spark, path, _ITEMS, sep=";")


@query(
    "scan_csv_na",
    """SELECT c_custkey, CASE WHEN c_mktsegment NOT IN ('MACHINERY', 'FURNITURE') THEN c_mktsegment END AS segment,
       CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer""",
)
def scan_csv_na(t: Tables):
    path = fresh_path(t.spark, "tokens-csv")
    written = t.customer.select(
        "c_custkey",
        F.expr("CASE c_mktsegment WHEN 'MACHINERY' THEN 'Not Given' WHEN 'FURNITURE' THEN '' ELSE c_mktsegment END").alias("segment"),
        F.expr("CASE WHEN c_acctbal < 0 THEN 'NaN' ELSE CAST(c_acctbal AS STRING) END").alias("balance"),
    )
    files.write_csv(written, path, sep=",")
    schema = T.StructType.fromDDL("c_custkey bigint, segment string, balance double")
    return files.read_csv_na(t.spark, path, schema, ["", "NaN", "Not Given"])


@query(
    "scan_csv_strings",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, CAST(n_chars AS VARCHAR) AS n_chars FROM documents",
)
def scan_csv_strings(t: Tables):
    path = fresh_path(t.spark, "texts-csv")
    files.write_csv(t.documents.select("doc_id", "text", "lang", "n_chars"), path, sep=",")
    return files.read_csv_strings(t.spark, path, quoted_newlines=True)


@query("scan_tsv", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def scan_tsv(t: Tables):
    path = fresh_path(t.spark, "parts-tsv")
    files.write_csv(t.part.select("p_partkey", "p_name", "p_size", "p_retailprice"), path, sep="\t")
    return files.read_tsv(t.spark, path, "p_partkey bigint, p_name string, p_size int, p_retailprice double")


@query("scan_text", r"SELECT trim(unnest(string_split(text, chr(10))), E' \t\r\n\v\f') AS line FROM documents")
def scan_text(t: Tables):
    path = fresh_path(t.spark, "lines")
    files.overwrite_text(t.documents.select("text"), path)
    return files.read_lines(t.spark, path)


@query(
    "text_head",
    r"""SELECT batch, line_no, trim(line, E' \t\r\n\v\f') AS line FROM
       (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY doc_id, place) - 1 AS line_no FROM
        (SELECT doc_id // 100 AS batch, doc_id, unnest(range(1, len(lines) + 1)) AS place, unnest(lines) AS line FROM
         (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)))
       WHERE line_no < 3""",
)
def text_head(t: Tables):
    """One text file per hundred documents, in order of their id; then the first lines of every file."""
    path = fresh_path(t.spark, "heads")
    texts = t.documents.select(F.expr("doc_id div 100").alias("batch"), "doc_id", "text")
    texts = texts.repartition("batch").sortWithinPartitions("batch", "doc_id")
    texts.select("batch", "text").write.partitionBy("batch").text(path)
    heads = files.text_head(t.spark, path, 3)
    batch = F.regexp_extract("file", "batch=([^/]+)/", 1).cast("bigint")
    return heads.select(batch.alias("batch"), F.col("line_no").cast("bigint").alias("line_no"), "line")


@query(
    "scan_json_columns",
    """SELECT c_custkey AS cliente, CAST(place AS INTEGER) AS "index", CASE place WHEN 0 THEN c_name ELSE c_mktsegment END AS nombre,
       CASE place WHEN 0 THEN CAST(c_nationkey AS BIGINT) ELSE c_custkey END AS clave
       FROM customer, range(2) AS r(place)""",
)
def scan_json_columns(t: Tables):
    first, second = F.lit("0"), F.lit("1")
    path = fresh_path(t.spark, "columns-json")
    texts = t.customer.select(
        F.to_json(
            F.struct(
                F.create_map(first, "c_custkey", second, "c_custkey").alias("cliente"),
                F.create_map(first, "c_name", second, "c_mktsegment").alias("nombre"),
                F.create_map(first, F.col("c_nationkey").cast("bigint"), second, F.col("c_custkey")).alias("clave"),
            )
        ).alias("doc"),
    )
    files.overwrite_text(texts, path)
    return documents.read_columns(t.spark, path, T.StructType.fromDDL("cliente bigint, nombre string, clave bigint"))


@query(
    "scan_json_large",
    "SELECT c_nationkey AS nation, CAST(c_custkey AS INTEGER) AS \"index\", c_name AS nombre, c_acctbal AS saldo FROM customer",
)
def scan_json_large(t: Tables):
    """One document per nation and file, with an entry for each of its customers."""
    path = fresh_path(t.spark, "nations-json")

    def column(name: str):
        return F.map_from_entries(F.collect_list(F.struct(F.col("c_custkey").cast("string"), name)))

    document = F.to_json(F.struct(column("c_name").alias("nombre"), column("c_acctbal").alias("saldo"))).alias("doc")
    t.customer.groupBy("c_nationkey").agg(document).write.partitionBy("c_nationkey").text(path)
    schema = T.StructType.fromDDL("nombre string, saldo double")
    rows = documents.read_large_columns(t.spark, path, schema, keep_file=True)
    nation = F.regexp_extract("file", "c_nationkey=([0-9]+)/", 1).cast("int")
    return rows.select(nation.alias("nation"), "index", "nombre", "saldo")


def _user_documents(t: Tables):
    """One landed document per event: a list of two records under ``results``."""
    record = F.struct(
        F.col("event_type").alias("gender"),
        F.struct(F.col("user_id").alias("first"), F.col("value").alias("last")).alias("name"),
    )
    other = F.struct(
        F.lit("none").alias("gender"),
        F.struct((F.col("user_id") + 1).alias("first"), (F.col("value") * 2).alias("last")).alias("name"),
    )
    return t.events.select(
        F.to_json(F.struct(F.col("event_id").alias("page"), F.array(record, other).alias("results"))).alias("value")
    )


_USERS = "page bigint, results array<struct<gender: string, name: struct<first: bigint, last: double>>>"
_USERS_SQL = """(SELECT event_id AS page, event_type AS gender, user_id AS first, value AS last FROM events
    UNION ALL SELECT event_id, 'none', user_id + 1, value * 2 FROM events)"""


@query("scan_json_records", f"SELECT gender, first, last FROM {_USERS_SQL}")
def scan_json_records(t: Tables):
    path = fresh_path(t.spark, "users-json")
    files.overwrite_text(_user_documents(t), path)
    return documents.read_records(t.spark, path, _USERS, "results").select("gender", "name.first", "name.last")


@query("json_normalize", f"""SELECT gender, first AS name_first, last AS name_last FROM {_USERS_SQL}""")
def json_normalize(t: Tables):
    return documents.normalize(documents.records(_user_documents(t), "value", _USERS, "results"), sep="_")


@query("json_record_path", f"""SELECT page, gender, first AS name_first, last AS name_last FROM {_USERS_SQL}""")
def json_record_path(t: Tables):
    parsed = _user_documents(t).select(F.from_json("value", _USERS).alias("doc")).select("doc.*")
    return documents.normalize(documents.explode_records(parsed, "results", ["page"]), sep="_")


@query(
    "response_gate",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN event_type = 'error' THEN 'Error: 404' END AS report FROM events""",
)
def response_gate(t: Tables):
    landed = t.events.select(
        "event_id",
        F.when(F.col("event_type") == "error", 404).otherwise(200).alias("status"),
        F.col("props").alias("body"),
    )
    fields, refused = documents.split_responses(landed, "k bigint")
    return fields.unionByName(refused.drop("status"), allowMissingColumns=True)


@query(
    "indicator_series",
    """SELECT event_type AS codigo, strftime(CAST(ts AS DATE) + CAST(day AS INTEGER), '%Y-%m-%d') AS fecha, value + day AS valor
       FROM events, range(3) AS r(day)""",
)
def indicator_series(t: Tables):
    days = [
        F.struct(
            F.concat(F.date_add(F.to_date("ts"), d).cast("string"), F.lit("T03:00:00.000Z")).alias("fecha"),
            (F.col("value") + d).alias("valor"),
        )
        for d in range(3)
    ]
    landed = t.events.select(
        F.col("event_type").alias("codigo"), F.to_json(F.struct(F.array(*days).alias("serie"))).alias("doc")
    )
    return documents.series(landed, "doc", keep=["codigo"]).withColumn("fecha", F.col("fecha").cast("string"))


@query(
    "scan_xml",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS cliente,
       CAST(floor(o_totalprice) AS INTEGER) AS monto, strftime(o_orderdate, '%Y-%m-%d') AS fecha FROM orders""",
)
def scan_xml(t: Tables):
    path = fresh_path(t.spark, "invoices-xml")
    invoices = t.orders.select(
        F.col("o_orderkey").alias("_id"),
        F.col("o_orderpriority").alias("cliente"),
        F.struct(F.floor("o_totalprice").alias("_VALUE"), F.lit("CLP").alias("_moneda")).alias("monto"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha"),
    )
    invoices.write.format("xml").option("rootTag", "facturacion").option("rowTag", "factura").save(path)
    return documents.read_invoices(t.spark, path)


@query("scan_edges", "SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem")
def scan_edges(t: Tables):
    path = fresh_path(t.spark, "edges")
    files.write_csv(t.lineitem.select("l_partkey", "l_suppkey"), path, sep="\t")
    return files.read_edges(t.spark, path)


@query(
    "literal_table",
    """SELECT event_type, nombre, count(*) AS n FROM events LEFT JOIN (VALUES ('click', 'A'), ('view', 'B'), ('purchase', 'C'))
       AS names(event_type, nombre) USING (event_type) GROUP BY event_type, nombre""",
)
def literal_table(t: Tables):
    names = t.spark.createDataFrame(
        [("click", "A"), ("view", "B"), ("purchase", "C")], "event_type string, nombre string"
    )
    counts = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(names, "event_type", "left").select("event_type", "nombre", "n")


@query("sink_csv", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS total FROM lineitem GROUP BY ALL")
def sink_csv(t: Tables):
    path = fresh_path(t.spark, "report-csv")
    report = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("total"))
    files.write_csv(report, path, sep=";", single_file=True)
    return files.read_csv(t.spark, path, report.schema, sep=";")


@query("sink_append", "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def sink_append(t: Tables):
    path = fresh_path(t.spark, "appended-csv")
    people = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    files.append_csv(people, path)
    files.append_csv(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), path)
    return files.read_csv(t.spark, path, people.schema, header=False)


@query("sink_overwrite", "SELECT c_name AS value FROM customer")
def sink_overwrite(t: Tables):
    path = fresh_path(t.spark, "replaced-text")
    files.overwrite_text(t.supplier.select("s_name"), path)
    files.overwrite_text(t.customer.select("c_name"), path)
    return t.spark.read.text(path)


@query("sink_json", "SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem")
def sink_json(t: Tables):
    path = fresh_path(t.spark, "items-json")
    files.write_json(_items(t), path)
    return t.spark.read.schema(_ITEMS).json(path)
