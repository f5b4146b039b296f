"""Word counts, job schedules and citations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quipu.operators import graph, schedule, text
from quipu.plans.catalog import Tables, query

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in text.ENGLISH_STOP_WORDS)
_WORDS_SQL = f"""WITH counts AS (SELECT word, count(*) AS n FROM
    (SELECT unnest(string_split_regex(lower(text), '[ \\t\\n\\r\\v\\f]+')) AS word FROM documents)
    WHERE word <> '' AND word NOT IN ({_STOP}) GROUP BY word) """


def _counts(t: Tables):
    return text.word_frequency(t.documents, "text")


@query("word_freq", _WORDS_SQL + "SELECT * FROM counts")
def word_freq(t: Tables):
    return _counts(t)


@query("top_k", _WORDS_SQL + "SELECT * FROM counts ORDER BY n DESC, word LIMIT 10")
def top_k(t: Tables):
    return text.top_words(_counts(t), 10)


@query("top_word", _WORDS_SQL + "SELECT * FROM counts ORDER BY n DESC, word LIMIT 1")
def top_word(t: Tables):
    return text.top_words(_counts(t), 1)


# Crontab lines made of events: a user is a crontab, an error is a heading.
_LINE = """CASE event_type
    WHEN 'error' THEN concat('#SECCION ', k)
    WHEN 'click' THEN concat('00 ', k % 24, ',', k * 7 % 24, ' * * *  run.sh ', event_id)
    WHEN 'view' THEN concat('30 ', k % 12, '-', k % 12 + k % 5, ',23 * * MON view.sh >> log  2>&1')
    WHEN 'purchase' THEN concat('  15 00,* 1 * * buy.sh')
    ELSE concat('05 ', k % 24) END"""


def _crontabs(t: Tables):
    events = t.events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return events.select(
        F.col("user_id").alias("source"), F.col("event_id").alias("line_no"), F.expr(_LINE).alias("line")
    )


@query(
    "cron_expand",
    f"""WITH lines AS (SELECT user_id AS source, event_id AS line_no, trim({_LINE}) AS line FROM
        (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)),
    carried AS (SELECT *, last_value(CASE WHEN line LIKE '#%' THEN trim(replace(line, '#', '')) END IGNORE NULLS)
        OVER (PARTITION BY source ORDER BY line_no) AS seccion FROM lines),
    jobs AS (SELECT *, string_split_regex(line, ' +') AS parts FROM carried WHERE line NOT LIKE '#%'),
    items AS (SELECT *, unnest(string_split(parts[2], ',')) AS item FROM jobs WHERE len(parts) >= 6),
    hours AS (SELECT *, unnest(CASE WHEN item = '*' THEN range(0, 24)
        WHEN contains(item, '-') THEN range(CAST(split_part(item, '-', 1) AS INTEGER), CAST(split_part(item, '-', 2) AS INTEGER) + 1)
        ELSE [CAST(item AS BIGINT)] END) AS hour FROM items)
    SELECT source, line_no, seccion, parts[1] AS minuto, lpad(CAST(hour AS VARCHAR), 2, '0') AS hora, parts[3] AS dia,
        parts[4] AS mes, parts[5] AS dia_semana, array_to_string(parts[6:], ' ') AS comando FROM hours""",
)
def cron_expand(t: Tables):
    return schedule.expand_crontab(_crontabs(t))


def _edges(t: Tables):
    return t.lineitem.select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))


@query(
    "in_degree_top",
    "SELECT l_suppkey AS dst, count(*) AS in_degree FROM lineitem GROUP BY l_suppkey ORDER BY in_degree DESC, dst LIMIT 1",
)
def in_degree_top(t: Tables):
    return graph.most_cited(_edges(t))
