"""Crontab expansion: rows worked out by hand, and long tables by what their lines were made of."""

import random

from quipu.operators import graph, schedule

FIELDS = ["line_no", "seccion", "minuto", "hora", "dia", "mes", "dia_semana", "comando"]


def table(spark, lines, source="main"):
    return spark.createDataFrame([(source, n, t) for n, t in lines], "source string, line_no bigint, line string")


def rows(df):
    return sorted((tuple(r[f] for f in FIELDS) for r in df.collect()), key=str)


def test_one_job(spark):
    got = rows(schedule.expand_crontab(table(spark, [(1, "## night  "), (2, " 5 2,9-10 1 * 7 wash   --all ")])))
    assert got == [(2, "night", "5", h, "1", "*", "7", "wash --all") for h in ("02", "09", "10")]


def test_every_hour_repeats_and_empty_ranges(spark):
    lines = [(1, "0 * * * * tick"), (2, "0 4,4 * * * twice"), (3, "0 8-6 * * * none"), (4, "0 4 * * short"), (5, "")]
    got = rows(schedule.expand_crontab(table(spark, lines)))
    assert [r[3] for r in got if r[-1] == "tick"] == [f"{h:02}" for h in range(24)]
    assert [r[3] for r in got if r[-1] == "twice"] == ["04", "04"]
    assert len(got) == 26 and {r[1] for r in got} == {None}


def test_a_commented_job_is_a_heading_or_is_skipped(spark):
    lines = table(spark, [(1, "# water"), (2, "#7 3 * * * pump"), (3, "1 3 * * * rinse")])
    assert [r[1] for r in rows(schedule.expand_crontab(lines))] == ["7 3 * * * pump"]
    assert [r[1] for r in rows(schedule.expand_crontab(lines, commented_jobs_are_sections=False))] == ["water"]


def test_headings_of_long_tables(spark, monkeypatch):
    """Each job names the heading that was made before it, and how many hours it was given."""
    monkeypatch.setattr(schedule, "_BLOCK_BITS", 2)
    rng = random.Random(11)
    lines, current, expected = [], "None", 0
    for n in range(900):
        if rng.random() < (0.01 if 300 < n < 800 else 0.25):
            current = f"part {n}"
            lines.append((5 * n, f"# {current}"))
        else:
            low, length = rng.randrange(12), rng.randrange(3)
            expected += length + 1
            lines.append((5 * n, f"0 {low}-{low + length} * * * job of {current}"))
    got = rows(schedule.expand_crontab(table(spark, lines)))
    assert len(got) == expected
    assert all(r[-1] == f"job of {r[1]}" for r in got)


def test_sources_do_not_mix(spark):
    both = table(spark, [(1, "#first"), (2, "0 1 * * * run")], "a").unionByName(table(spark, [(1, "0 1 * * * run")], "b"))
    got = schedule.expand_crontab(both).collect()
    assert {(r["source"], r["seccion"]) for r in got} == {("a", "first"), ("b", None)}


def test_most_cited(spark):
    edges = spark.createDataFrame([(5, 30), (6, 30), (7, 20), (8, 20), (30, 5)], "src bigint, dst bigint")
    assert [tuple(r) for r in graph.most_cited(edges).collect()] == [(20, 2)]
