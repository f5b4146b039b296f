"""Job schedules: crontab lines to one row per hour of the day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quipu.functions.strings import strip, words, zfill
from quipu.storage import stage

_BLOCK_BITS = 12  # a window holds up to 4096 rows of one source
_LEVELS = 2  # blocks of rows, then blocks of blocks


def _heading_before(rows: DataFrame, source: str, place: str, levels: int = _LEVELS) -> DataFrame:
    """Add ``_before``: the latest ``_heading`` at a smaller place of the same source.

    Headings are carried within blocks of places, then the last heading of each
    block is carried over the blocks in the same way, so that a source of any
    length is spread over many tasks.
    """
    earlier = (Window.unboundedPreceding, -1)
    if levels == 0:
        whole = Window.partitionBy(source).orderBy(place).rowsBetween(*earlier)
        return rows.withColumn("_before", F.last("_heading", ignorenulls=True).over(whole))
    block = f"_block{levels}"
    blocked = rows.withColumn(block, F.shiftright(place, _BLOCK_BITS))
    inside = Window.partitionBy(source, block).orderBy(place).rowsBetween(*earlier)
    local = blocked.withColumn("_local", F.last("_heading", ignorenulls=True).over(inside))
    lasts = stage(_last_headings(blocked, source, place, block), "headings")
    carried = _heading_before(lasts, source, block, levels - 1).select(
        F.col(source).alias("_s"), F.col(block).alias("_b"), F.col("_before").alias("_carried")
    )
    same = local[source].eqNullSafe(carried["_s"]) & (local[block] == carried["_b"])
    return (
        local.join(carried, same)
        .withColumn("_before", F.coalesce("_local", "_carried"))
        .drop("_s", "_b", "_carried", "_local", block)
    )


def _last_headings(blocked: DataFrame, source: str, place: str, block: str) -> DataFrame:
    """One row per block with its last heading.

    The heading's place is found by a hash aggregate over numbers; its text is
    then joined from the heading lines, which are few.
    """
    headed = F.when(F.col("_heading").isNotNull(), F.col(place))
    places = blocked.groupBy(source, block).agg(F.max(headed).alias("_at"))
    headings = blocked.filter(F.col("_heading").isNotNull()).select(
        F.col(source).alias("_s"), F.col(place).alias("_p"), "_heading"
    )
    same = places[source].eqNullSafe(headings["_s"]) & (places["_at"] == headings["_p"])
    return places.join(headings, same, "left").select(source, block, "_heading")


def expand_crontab(
    lines: DataFrame,
    source: str = "source",
    line_no: str = "line_no",
    line: str = "line",
    commented_jobs_are_sections: bool = True,
) -> DataFrame:
    """One row per job and hour, with the heading above the job as its section.

    Headings start with ``#``. A job that was commented out looks like a heading
    and by default becomes one; pass False to skip such lines instead. An hour
    named twice in a list gives two rows.
    """
    stripped = lines.select(source, line_no, strip(F.col(line)).alias("_line"))
    heading = strip(F.replace(F.col("_line"), F.lit("#"), F.lit("")))
    is_heading = F.col("_line").startswith("#")
    if not commented_jobs_are_sections:
        looks_like_job = heading.rlike(r"\A[0-9*,/-]+\s+[0-9*,/-]+\s+\S+\s+\S+\s+\S+\s+\S")
        is_heading = is_heading & ~looks_like_job
    marked = stripped.withColumn("_heading", F.when(is_heading, heading))
    carried = _heading_before(marked, source, line_no).withColumnRenamed("_before", "seccion")
    jobs = (
        carried.filter(~F.col("_line").startswith("#"))
        .withColumn("_parts", words(F.col("_line")))
        .filter(F.size("_parts") >= 6)
    )
    part = F.col("_parts")

    def hours_of(item):
        ends = F.transform(F.split(item, "-"), lambda x: x.cast("int"))
        span = F.when(ends[0] <= ends[1], F.sequence(ends[0], F.greatest(ends[0], ends[1])))
        return (
            F.when(item.contains("-"), F.coalesce(span, F.array().cast("array<int>")))
            .when(item == "*", F.sequence(F.lit(0), F.lit(23)))
            .otherwise(F.array(item.cast("int")))
        )

    hours = F.flatten(F.transform(F.split(part[1], ","), hours_of))
    expanded = jobs.select(
        source, line_no, "seccion", part.alias("_parts"), F.explode(hours).alias("_hour")
    )
    return expanded.select(
        source,
        line_no,
        "seccion",
        part[0].alias("minuto"),
        zfill(F.col("_hour").cast("string"), 2).alias("hora"),
        part[2].alias("dia"),
        part[3].alias("mes"),
        part[4].alias("dia_semana"),
        F.array_join(F.slice(part, F.lit(6), F.size(part)), " ").alias("comando"),
    )
