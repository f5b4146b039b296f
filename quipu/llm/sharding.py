"""Sharding by extendible hashing, by DataFrame functions alone.

A document's digest is a string of bits. The directory starts with one bucket, and a
bucket above the byte limit, and only such a bucket, splits on its next bit. The
splits are found on sums per long prefix (folded by task before the shuffle), some 64
to a shard, never on the documents themselves.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import packed
from quipu.operators.ordering import with_position
from quipu.storage import broadcast_if_short, stage

LIMIT = 1 << 20
BITS = 64
_SPARE = 6  # bits below the expected depth that are summed in the first round


def digest_bits(doc_id: Column, text: Column) -> Column:
    """64 bits of the digest of id and text, as a string of 0 and 1."""
    shown = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.coalesce(text, F.lit("")))
    return F.lpad(F.conv(F.substring(F.md5(shown.cast("binary")), 1, 16), 16, 2), BITS, "0")


def _shards(leaves: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """Per leaf (a prefix of ``high`` bits, with bytes and n) its shard: the shortest prefix that fits, or null."""
    prefixes = leaves.select("leaf", "bytes", "n", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
    prefixes = prefixes.withColumn("prefix", F.substring("leaf", F.lit(1), F.col("depth")))
    sums = prefixes.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    fits = stage(sums.filter((F.col("bytes") <= limit) | (F.col("n") == 1)).select("depth", "prefix"), "fits")
    # Short prefixes, which many leaves share, seldom fit: they stay out of the join.
    least = fits.agg(F.min("depth")).first()[0]
    tried = prefixes.select("leaf", "depth", "prefix").filter(F.col("depth") >= F.lit(high if least is None else least))
    found = tried.join(fits, ["depth", "prefix"]).groupBy("leaf").agg(F.min("depth").alias("depth"))
    return leaves.join(found, "leaf", "left").select("leaf", "bytes", F.substring("leaf", F.lit(1), F.col("depth")).alias("shard"))


def directory(rows: DataFrame, limit: int = LIMIT) -> list[tuple[int, DataFrame]]:
    """The directory of rows (bits, bytes): per round, the prefix length and (leaf, shard).

    A leaf without a shard is still too large; its rows alone go on to a round of
    longer prefixes, up to all 64 bits.
    """
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    low, high = 0, min(max(math.ceil(math.log2(max(total / limit, 1))), 0) + _SPARE, BITS)
    rounds = []
    while True:
        leaves = rows.groupBy(F.substring("bits", 1, high).alias("leaf")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        found = stage(_shards(leaves, low, high, limit), "directory")
        rounds.append((high, found.select("leaf", "shard")))
        large = found.filter("shard is null").select(F.col("leaf").alias("_large"))
        if high == BITS or large.isEmpty():
            return rounds
        rows = stage(rows.join(broadcast_if_short(large), F.substring("bits", 1, high) == F.col("_large"), "left_semi"), "large")
        low, high = high + 1, min(high + 10, BITS)


def sharded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``shard`` (its bits after an "s") and ``bytes`` (of its UTF-8 text).

    Every shard holds at most ``limit`` bytes, but for one document that is larger by
    itself and then stands alone. Null texts count 0 bytes. Repeated rows share all
    bits; where they exceed the limit together they are dealt out in turn to shards
    numbered after the bits ("s0101...-3"). No rows give no rows. A column of ``docs``
    named shard or bytes is replaced.
    """
    plain = docs.drop("shard", "bytes")
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("bigint")
    rows = stage(plain.select(digest_bits(F.col(id_col), F.col(text_col)).alias("bits"), size.alias("bytes")), "hashes")
    rounds = directory(rows, limit)
    bits = digest_bits(F.col(id_col), F.col(text_col))
    out = plain.select(packed(plain), bits.alias("bits"), size.alias("bytes"), F.lit(None).cast("string").alias("shard"))
    for length, found in rounds:
        side = broadcast_if_short(found.filter("shard is not null").select("leaf", F.col("shard").alias("found")))
        out = out.join(side, F.substring("bits", 1, length) == F.col("leaf"), "left")
        out = out.withColumn("shard", F.coalesce("shard", "found")).drop("leaf", "found")
    out = out.withColumn("shard", F.concat(F.lit("s"), "shard"))
    length, found = rounds[-1]
    if length == BITS and not found.filter("shard is null").isEmpty():
        same = with_position(out.filter("shard is null"), F.col("bytes"), by=["bits"], name="place")
        each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("bytes", F.lit(1))))
        same = same.withColumn("shard", F.concat(F.lit("s"), "bits", F.lit("-"), F.floor(F.col("place") / each).cast("string")))
        out = out.filter("shard is not null").unionByName(same.drop("place"))
    return out.select("row.*", "shard", "bytes")
