"""Exploratory statistics: what a plot would show, as rows."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from quipu.operators import quantiles, statistics
from quipu.plans import shapes
from quipu.plans.catalog import Tables, query


def bin_sql(x: str, lo: str, hi: str, bins: int) -> str:
    """Equal-width bin, with the same correction at the edges as the operator."""
    step = f"(({hi} - {lo}) / {bins})"
    guess = f"least(floor(({x} - {lo}) * {bins} / ({hi} - {lo})), {bins - 1})"
    return (
        f"CAST(CASE WHEN {x} < {lo} + {guess} * {step} THEN {guess} - 1"
        f" WHEN {guess} < {bins - 1} AND {x} >= {lo} + ({guess} + 1) * {step} THEN {guess} + 1"
        f" ELSE {guess} END AS INTEGER)"
    )


def _histogram_sql(table: str, column: str, bins: int) -> str:
    return f"""SELECT * EXCLUDE (n), coalesce(n, 0) AS n FROM
    (SELECT CAST(range AS INTEGER) AS bin, lo + range * ((hi - lo) / {bins}) AS "left",
            CASE WHEN range = {bins - 1} THEN hi ELSE lo + (range + 1) * ((hi - lo) / {bins}) END AS "right"
     FROM range({bins}), (SELECT min({column}) AS lo, max({column}) AS hi FROM {table}))
    LEFT JOIN (SELECT {bin_sql(column, 'lo', 'hi', bins)} AS bin, count(*) AS n
     FROM {table}, (SELECT min({column}) AS lo, max({column}) AS hi FROM {table})
     WHERE {column} IS NOT NULL GROUP BY 1) USING (bin)"""


def rounded(df, digits: int, *columns: str):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "histogram",
    f"""SELECT bin, round("left", 6) AS "left", round("right", 6) AS "right", n
        FROM ({_histogram_sql('lineitem', 'l_extendedprice', 20)})""",
)
def histogram(t: Tables):
    return rounded(statistics.histogram(t.lineitem, "l_extendedprice", 20), 6, "left", "right")


def _density_sql(masses: str) -> str:
    return f"""WITH s AS (SELECT count(l_extendedprice) AS n, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
        stddev_samp(l_extendedprice) * pow(count(l_extendedprice), -0.2) AS width FROM lineitem), m AS ({masses})
    SELECT CAST(range AS INTEGER) AS point, round(lo + range * ((hi - lo) / 49), 6) AS x,
           round(sum(w * exp(-0.5 * pow((lo + range * ((hi - lo) / 49) - v) / width, 2))) / any_value(n * width * {math.sqrt(2 * math.pi)!r}), 12) AS density
    FROM range(50), s, m GROUP BY range, lo, hi"""


@query(
    "binned_kde",
    _density_sql(
        f"""SELECT ("left" + "right") / 2 AS v, n AS w FROM ({_histogram_sql('lineitem', 'l_extendedprice', 100)})"""
    ),
)
def binned_kde(t: Tables):
    curve = statistics.density(t.lineitem, "l_extendedprice", points=50, bins=100)
    return curve.select("point", F.round("x", 6).alias("x"), F.round("density", 12).alias("density"))


@query(
    "exact_kde",
    """WITH s AS (SELECT count(l_quantity) AS n, min(l_quantity) AS lo, max(l_quantity) AS hi,
        stddev_samp(l_quantity) * pow(count(l_quantity), -0.2) AS width FROM lineitem),
    m AS (SELECT l_quantity AS v, count(*) AS w FROM lineitem GROUP BY 1)
    SELECT CAST(range AS INTEGER) AS point, round(lo + range * ((hi - lo) / 199), 6) AS x,
           round(sum(w * exp(-0.5 * pow((lo + range * ((hi - lo) / 199) - v) / width, 2)))
                 / any_value(n * width * sqrt(2 * pi())), 8) AS density
    FROM range(200), s, m GROUP BY range, lo, hi""",
)
def exact_kde(t: Tables):
    curve = statistics.density(t.lineitem, "l_quantity")
    return curve.select("point", F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


@query(
    "box_stats",
    """WITH q AS (SELECT l_returnflag, count(*) AS n, quantile_cont(l_extendedprice, 0.25) AS q1,
        quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3
        FROM lineitem GROUP BY l_returnflag)
    SELECT l_returnflag, 'l_extendedprice' AS "column", any_value(n) AS n, round(any_value(q1), 4) AS q1,
        round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3,
        min(l_extendedprice) FILTER (l_extendedprice BETWEEN q1 - 0.25 * (q3 - q1) AND q3 + 0.25 * (q3 - q1)) AS whisker_low,
        max(l_extendedprice) FILTER (l_extendedprice BETWEEN q1 - 0.25 * (q3 - q1) AND q3 + 0.25 * (q3 - q1)) AS whisker_high,
        count(*) FILTER (l_extendedprice NOT BETWEEN q1 - 0.25 * (q3 - q1) AND q3 + 0.25 * (q3 - q1)) AS outliers
    FROM lineitem JOIN q USING (l_returnflag) GROUP BY l_returnflag""",
)
def box_stats(t: Tables):
    """A short reach, as evenly spread prices have no outliers at the usual 1.5."""
    boxes = quantiles.box_stats(t.lineitem, "l_extendedprice", ["l_returnflag"], reach=0.25)
    return rounded(boxes, 4, "q1", "median", "q3")


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) + 0.0 AS r FROM lineitem" for a in _CORR for b in _CORR
    ),
)
def corr_matrix(t: Tables):
    r: Column = F.round("r", 8) + F.lit(0.0)
    return statistics.corr_matrix(t.lineitem, _CORR).withColumn("r", r)


@query(
    "quantile",
    """SELECT p_type, 'p_retailprice' AS "column", count(*) AS n, round(quantile_cont(p_retailprice, 0.25), 6) AS q25,
       round(quantile_cont(p_retailprice, 0.75), 6) AS q75 FROM part GROUP BY p_type""",
)
def quantile(t: Tables):
    """Takes the way for long tables, whatever the size."""
    quartiles = quantiles.quantiles(t.part, ["p_retailprice"], [0.25, 0.75], ["p_type"])
    return rounded(quartiles, 6, "q25", "q75")


@query(
    "iqr_outliers",
    """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
    SELECT event_id, value FROM events, q WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
)
def iqr_outliers(t: Tables):
    return quantiles.iqr_outliers(t.events.select("event_id", "value"), "value")


@query(
    "recode",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 END AS code,
       value * 50 + 20 AS size FROM events""",
)
def recode(t: Tables):
    codes = F.create_map(*[F.lit(x) for pair in {"click": 0, "view": 1, "purchase": 2}.items() for x in pair])
    return t.events.select(
        "event_id", F.try_element_at(codes, "event_type").alias("code"), (F.col("value") * 50 + 20).alias("size")
    )


_PAIRS = [("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_extendedprice", "l_discount")]
_SPREAD = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in ("l_quantity", "l_extendedprice", "l_discount"))


@query(
    "bins_2d",
    " UNION ALL ".join(
        f"""SELECT l_returnflag AS hue, '{a}' AS x, '{b}' AS y, {bin_sql(a, 'lo_' + a, 'hi_' + a, 10)} AS x_bin,
            {bin_sql(b, 'lo_' + b, 'hi_' + b, 10)} AS y_bin, count(*) AS n
            FROM lineitem, (SELECT {_SPREAD} FROM lineitem) GROUP BY ALL"""
        for a, b in _PAIRS
    ),
)
def bins_2d(t: Tables):
    return statistics.bins_2d(t.lineitem, _PAIRS, 10, hue="l_returnflag")
