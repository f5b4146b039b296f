"""Chat formatting: snapshots that a longer conversation continues are dropped before rendering.

Logs often hold a conversation once per turn. A turn's digest (its place, role and text)
gives four numbers of 32 bits, and a prefix of a conversation has their running sums: sums
of any two stretches add up, so a conversation with a third of all turns is summed in chunks
by many tasks. A conversation whose sums (with its length) appear inside a longer one is a
snapshot of it; an anti-join keeps the others. Rendered text comes in segments of a bounded
number of turns, so that no row grows with its conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.operators.ordering import with_position
from quipu.storage import stage

CHUNK_TURNS, SEGMENT_TURNS = 1024, 256
_LANES = ("_a", "_b", "_c", "_d")


def _turn_digest() -> Column:
    role = F.coalesce(F.concat(F.lit("r"), "role"), F.lit("n"))
    text = F.coalesce(F.concat(F.lit("t"), "text"), F.lit("n"))
    size = F.length(role).cast("string")
    return F.md5(F.concat_ws(":", F.col("position").cast("string"), size, role, text).cast("binary"))


def prefixes(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows (conv_id, position, role, text, n_turns, prefix): each turn with the signature of all turns up to it.

    Turns stand in the order of their number (null last), role and text; rows that repeat
    each other count once. Rows without a conversation id form one conversation.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")
    ).distinct()
    order = [F.col(c).asc_nulls_last() for c in ("turn", "role", "text")]
    placed = with_position(rows, *order, by=["conv_id"]).withColumn("_digest", _turn_digest())
    lanes = {lane: F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("bigint") for i, lane in enumerate(_LANES)}
    placed = stage(placed.withColumns(lanes).withColumn("_chunk", F.expr(f"position div {CHUNK_TURNS}")).drop("_digest", "turn"), "turns")
    sums = placed.groupBy("conv_id", "_chunk").agg(F.count("*").alias("_turns"), *[F.sum(lane).alias(f"{lane}_sum") for lane in _LANES])
    whole = Window.partitionBy("conv_id")  # one row per chunk
    before = whole.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    earlier = {f"{lane}_before": F.coalesce(F.sum(f"{lane}_sum").over(before), F.lit(0)) for lane in _LANES}
    chunks = sums.withColumns({**earlier, "n_turns": F.sum("_turns").over(whole)})
    chunks = stage(chunks.select(F.col("conv_id").alias("_conv"), F.col("_chunk").alias("_at"), "n_turns", *earlier), "chunks")
    inside = Window.partitionBy("conv_id", "_chunk").orderBy("position")
    summed = placed.withColumns({lane: F.sum(lane).over(inside) for lane in _LANES})
    joined = summed.join(chunks, summed["conv_id"].eqNullSafe(chunks["_conv"]) & (summed["_chunk"] == chunks["_at"]))
    signature = F.concat_ws("-", F.col("position") + 1, *[F.col(lane) + F.col(f"{lane}_before") for lane in _LANES])
    return joined.select("conv_id", "position", "role", "text", "n_turns", signature.alias("prefix"))


def maximal(marked: DataFrame) -> DataFrame:
    """Of the rows of ``prefixes``: one row (conv_id, n_turns, copies) per conversation that no longer one continues.

    Conversations with the same turns are copies of one, which is named by the smallest id.
    """
    whole = marked.filter("position = n_turns - 1").groupBy("prefix")
    whole = whole.agg(F.min("conv_id").alias("conv_id"), F.first("n_turns").alias("n_turns"), F.count("*").alias("copies"))
    inner = marked.filter("position < n_turns - 1").select("prefix").distinct()
    return whole.join(inner, "prefix", "left_anti").select("conv_id", "n_turns", "copies")


def rendered_turn(role: Column, text: Column) -> Column:
    """One turn between its marks; marks inside a text are broken up, a null role is "unknown"."""
    body = F.regexp_replace(F.coalesce(text, F.lit("")), r"<\|(im_start|im_end)\|>", "< |$1|>")
    name = F.regexp_replace(F.coalesce(role, F.lit("unknown")), r"<\|(im_start|im_end)\|>", "< |$1|>")
    return F.concat(F.lit("<|im_start|>"), name, F.lit("\n"), body, F.lit("<|im_end|>\n"))


def conversations(turns: DataFrame, segment: int = SEGMENT_TURNS, **columns: str) -> DataFrame:
    """Rendered conversations that are no snapshot of another: conv_id, n_turns, copies, segment, text.

    A conversation of up to ``segment`` turns is one row; longer ones go on in further
    segments. A null text renders as empty; no rows give no rows. Other columns are not read.
    """
    marked = stage(prefixes(turns, **columns), "prefixes")
    kept = stage(maximal(marked), "maximal").withColumnRenamed("conv_id", "_kept")
    lines = marked.select("conv_id", "position", rendered_turn(F.col("role"), F.col("text")).alias("line"))
    lines = lines.withColumn("segment", F.expr(f"position div {segment}"))
    pieces = lines.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list(F.struct("position", "line"))).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "")
    joined = pieces.join(kept, pieces["conv_id"].eqNullSafe(kept["_kept"]))
    return joined.select("conv_id", "n_turns", "copies", "segment", text.alias("text"))
