"""Registered queries of this subpackage and, where SQL can say the same, their checking SQL.

Every query reads its whole tables and returns one digest per row of the operator's
own results; the operators keep their general interface.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.llm import (
    chat, decontamination, lexical, mixing, neighbours, pii, quality, repeats, secrets, sharding, simhash, toxicity, whitening,
)
from quipu.llm.labelled import with_scores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLE_SQL[name] = sql
        return build

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _of_kind(spans: Column, kind: int) -> Column:
    """Number of spans of a kind. The function has one parameter: ``filter`` would hand the place in the array to a second one."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


@_query(
    "op2_mixing",
    """
    WITH sized AS (
      SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
             md5(coalesce(text, '')) AS digest
      FROM documents),
    src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
    weighed AS (
      SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS most,
             sum(source_size) OVER () AS words
      FROM src),
    levels AS (
      SELECT weight, most, k, CAST(words - given AS DOUBLE) / CAST(open AS DOUBLE) AS level
      FROM (
        SELECT *, row_number() OVER o AS k,
               coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
               sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
        FROM weighed WINDOW o AS (ORDER BY most * 1.0 / weight, source NULLS LAST))),
    chosen AS (SELECT min_by(level, k) AS level FROM levels WHERE weight * level <= most),
    aimed AS (
      SELECT source, source_size, CASE WHEN weight * level > most THEN CAST(most AS DOUBLE) ELSE weight * level END AS target
      FROM weighed, chosen),
    slotted AS (
      SELECT *, CAST(floor(target) AS BIGINT) AS quota, (CAST(floor(target) AS BIGINT) + 1023) // 1024 AS slots,
             row_number() OVER (ORDER BY source NULLS LAST) AS s
      FROM aimed),
    ranges AS (
      SELECT s, slots, CAST(coalesce(sum(slots) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
             len(ltrim(bin(CAST(greatest(sum(slots) OVER () - 1, 0) AS BIGINT)), '0')) AS bits
      FROM slotted),
    turned AS (
      SELECT s, CAST(coalesce(list_sum([((point >> i) & 1) << (bits - 1 - i) FOR i IN range(0, bits)]), 0) AS BIGINT) AS slot
      FROM (SELECT s, bits, unnest(range(start, start + slots)) AS point FROM ranges)),
    schedule AS (SELECT s, slot, row_number() OVER (PARTITION BY s ORDER BY slot) - 1 AS block FROM turned),
    laid AS (
      SELECT row_number() OVER () AS r, d.doc_id, d.size, a.source_size, a.target, a.quota, a.s,
             CAST(coalesce(sum(d.size) OVER (PARTITION BY a.s
               ORDER BY md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), d.doc_id, d.size, d.digest
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place
      FROM sized d JOIN slotted a ON d.source IS NOT DISTINCT FROM a.source),
    passed AS (
      SELECT r, s, p, p * source_size + place AS first, least(p * source_size + place + size, quota) AS past
      FROM (SELECT *, unnest(range(0, 3)) AS p FROM laid WHERE size > 0) WHERE p * source_size + place < quota),
    takes AS (
      SELECT r, CAST(sum(past - first) AS BIGINT) AS taken, min_by(slot, p) AS first_slot,
             CAST(sum((past - 1) // 1024 - first // 1024 + 1) AS BIGINT) AS n_slots
      FROM passed JOIN schedule ON passed.s = schedule.s AND passed.first // 1024 = schedule.block GROUP BY r)
    SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_slot, coalesce(n_slots, 0) AS n_slots
    FROM laid LEFT JOIN takes USING (r)
    """,
)
def op2_mixing(spark, folder):
    return mixing.Mix(_table(spark, folder, "documents")).per_document()


@_query(
    "op4_decontamination",
    """
    WITH docs AS (
      SELECT doc_id, row_number() OVER () AS r,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
      FROM documents),
    items AS (
      SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
      FROM benchmark),
    patterns AS (
      SELECT DISTINCT item, least(len(words), 10) AS n, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS pattern
      FROM (SELECT *, unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS i FROM items WHERE len(words) > 0)),
    looked AS (
      SELECT r, n, i, array_to_string(words[i:i + n - 1], ' ') AS pattern
      FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i
            FROM docs, (SELECT DISTINCT n FROM patterns) WHERE len(words) >= n)),
    hits AS (SELECT r, item, n, i FROM looked JOIN patterns USING (n, pattern)),
    covered AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM hits) GROUP BY r),
    owners AS (
      SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
      FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN covered USING (r) LEFT JOIN owners USING (r)
    """,
)
def op4_decontamination(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, _table(spark, folder, "benchmark"))
    return found.select("doc_id", "contamination").select(
        "doc_id",
        "contamination.n_words",
        "contamination.n_hit",
        F.size("contamination.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "contamination.items").cast("binary"), 256).alias("items_sha256"),
        (F.col("contamination.n_hit") > 0).alias("contaminated"),
    )


@_query(
    "op7_sharding",
    """
    WITH hashed AS (
      SELECT doc_id, row_number() OVER () AS r, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes,
             lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')), 1, 16)
                           AS UBIGINT)), 64, '0') AS bits
      FROM documents),
    prefixes AS (SELECT r, doc_id, bytes, d, substr(bits, 1, d) AS prefix FROM (SELECT *, unnest(range(0, 65)) AS d FROM hashed)),
    fits AS (
      SELECT d, prefix FROM prefixes GROUP BY d, prefix HAVING sum(bytes) <= 1048576 OR count(*) = 1)
    SELECT doc_id, bytes, 's' || min_by(prefix, d) AS shard
    FROM prefixes JOIN fits USING (d, prefix) GROUP BY r, doc_id, bytes
    """,
)
def op7_sharding(spark, folder):
    return sharding.sharded(_table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "bytes", "shard")


@_query("op8_simhash")
def op8_simhash(spark, folder):
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@_query("op6_toxicity")
def op6_toxicity(spark, folder):
    docs = _table(spark, folder, "documents")
    model = toxicity.trained(docs, _table(spark, folder, "labels"))
    return with_scores(docs, toxicity.toxicity(F.col("text"), model), 0.5)


@_query("op1_secrets")
def op1_secrets(spark, folder):
    found = secrets.secrets(_table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    counts = [_of_kind(base, k).alias(f"n_{secrets.KINDS[k]}") for k in range(3)]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans")
    )


@_query("op9_quality")
def op9_quality(spark, folder):
    docs = _table(spark, folder, "documents")
    model = quality.trained(docs, _table(spark, folder, "labels"))
    return with_scores(docs, quality.quality(F.col("text"), model), 0.3)


@_query("op10_pii")
def op10_pii(spark, folder):
    docs = _table(spark, folder, "documents")
    found = docs.select("doc_id", pii.personal_data(F.col("text"), pii.trained(docs)).alias("spans"))
    base = F.filter("spans", lambda s: s["known"])
    counts = [_of_kind(base, k).alias(f"n_{pii.KINDS[k]}") for k in range(4)]
    return found.select(
        "doc_id", *counts, F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans")
    )


@_query("op5_neighbours")
def op5_neighbours(spark, folder):
    return neighbours.search(_table(spark, folder, "embeddings"), F.pmod(F.col("id"), F.lit(20)) == 0)


@_query(
    "op3_chat",
    """
    WITH placed AS (
      SELECT conv_id, role, text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) - 1 AS place,
             count(*) OVER (PARTITION BY conv_id) AS n_turns
      FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)),
    marked AS (
      SELECT *, string_agg(coalesce('r' || role, 'n') || chr(1) || coalesce('t' || text, 'n'), chr(2))
                  OVER (PARTITION BY conv_id ORDER BY place) AS prefix
      FROM placed),
    kept AS (
      SELECT min(conv_id) AS conv_id, count(*) AS copies FROM marked WHERE place = n_turns - 1
      GROUP BY prefix HAVING prefix NOT IN (SELECT prefix FROM marked WHERE place < n_turns - 1))
    SELECT conv_id, n_turns, copies, CAST(place // 256 AS BIGINT) AS segment,
           string_agg('<|im_start|>' || regexp_replace(coalesce(role, 'unknown'), '<\\|(im_start|im_end)\\|>', '< |\\1|>', 'g') || chr(10)
             || regexp_replace(coalesce(text, ''), '<\\|(im_start|im_end)\\|>', '< |\\1|>', 'g') || '<|im_end|>' || chr(10), '' ORDER BY place) AS text
    FROM marked JOIN kept USING (conv_id) GROUP BY conv_id, n_turns, copies, place // 256
    """,
)
def op3_chat(spark, folder):
    return chat.conversations(_table(spark, folder, "conversations"))


@_query(
    "op13_lexical",
    """
    WITH docs AS (
      SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
      FROM documents),
    items AS (
      SELECT row_number() OVER () AS q, * FROM (
        SELECT DISTINCT item_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
        FROM benchmark)),
    asked AS (SELECT q, item_id, term, count(*) AS repeats FROM (SELECT q, item_id, unnest(words) AS term FROM items) GROUP BY ALL),
    totals AS (SELECT count(*) AS nd, CAST(sum(len(words)) AS BIGINT) AS l FROM docs WHERE len(words) > 0),
    counted AS (
      SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(words) AS n, unnest(words) AS term FROM docs)
      WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weights AS (
      SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(nd) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM counted, totals GROUP BY term),
    scored AS (
      SELECT q, item_id, r, doc_id,
             CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // l)))) AS BIGINT) AS score
      FROM asked JOIN counted USING (term) JOIN weights USING (term), totals GROUP BY ALL)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0
    QUALIFY rank <= 20
    """,
)
def op13_lexical(spark, folder):
    return lexical.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@_query("op12_whitening")
def op12_whitening(spark, folder):
    return whitening.whitened(_table(spark, folder, "embeddings"))


@_query(
    "op11_repeats",
    """
    WITH docs AS (
      SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n
      FROM documents),
    pieces AS MATERIALIZED (
      SELECT r, n, 256 * c AS base, substr(h, 512 * c + 1, 910) AS g
      FROM (SELECT r, h, n, unnest(range(0, (n + 255) // 256)) AS c FROM docs)),
    bytes AS MATERIALIZED (
      SELECT r, base + k AS i, substr(g, 2 * k + 1, 2) AS x,
             CASE WHEN base + k + 200 <= n THEN md5_number(substr(g, 2 * k + 1, 400)) END AS w
      FROM (SELECT r, n, base, g, unnest(range(0, least(256, n - base))) AS k FROM pieces)),
    twice AS (SELECT w FROM bytes WHERE w IS NOT NULL GROUP BY w HAVING count(*) > 1),
    covered AS (
      SELECT r, i, x, coalesce(i - max(CASE WHEN t.w IS NOT NULL THEN i END) OVER (PARTITION BY r ORDER BY i ROWS UNBOUNDED PRECEDING) < 200, false) AS gone
      FROM bytes b LEFT JOIN twice t USING (w)),
    edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), false) AS opens FROM covered),
    rest AS (
      SELECT r, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
             string_agg(x, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept
      FROM edges GROUP BY r)
    SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
           sha256(unhex(coalesce(kept, ''))) AS kept_sha256
    FROM docs LEFT JOIN rest USING (r)
    """,
)
def op11_repeats(spark, folder):
    found = repeats.deduplicated(_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "repeats.n_bytes",
        F.aggregate("repeats.spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("repeats.spans").cast("bigint").alias("n_spans"),
        F.sha2("repeats.kept", 256).alias("kept_sha256"),
    )
