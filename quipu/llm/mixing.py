"""Mixing sources to target weights with a low-discrepancy schedule, by DataFrame functions alone.

Every source's documents are shuffled and laid end to end as one stream of words, cut
into blocks of equal length. Slots of the mix are points of the van der Corput sequence:
slot ``i`` of ``2**m`` stands at its reversed bits over ``2**m``, and falls to the source
whose cumulative weight interval holds that point. The j-th slot of a source, in slot
order, takes the source's j-th block. Any prefix of the schedule is close to the weights,
and the whole of it meets them exactly.

The intervals are whole numbers of slots, so the points of one source are a range of
integers. They are written from the source's side (in two steps, so that a source with a
third of all slots is spread over many tasks), which needs no range join.

Every row has a place of its own in its source's stream, repeated rows too: rows that agree
in source, id and text are numbered, and the n-th of them stands n texts further on. A row
belongs to the slot of the block that its words begin in, and the mix is put out in the
order of slots, so any first part of it is close to the weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import earlier_total, packed, word_count
from quipu.operators.ordering import with_position
from quipu.storage import broadcast_if_short, stage

BLOCK_WORDS = 1024
REPEATS = 3
WEIGHTS = (1, 2, 3)
_SLOTS_AT_ONCE = 4096


def shuffle_key(doc_id: Column) -> Column:
    """Place of a document in its source's shuffled order: a digest of its id."""
    return F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def text_digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Sources (source, source_size) with their place ``s``, ``weight`` and ``target``.

    Sources stand in code-point order, null last, and weigh ``weights`` in turn. All
    words are shared by weight; a target above ``repeats`` times its source's size
    stops there, and the level of the others is raised until no further one stops: with
    the sources in order of what they hold to their weight, the level is that of the first
    one that its share does not pass.
    """
    placed = with_position(sources, F.col("source").asc_nulls_last(), name="s")
    cycle = F.array(*[F.lit(w) for w in weights])
    placed = placed.withColumn("weight", F.element_at(cycle, (F.col("s") % len(weights) + 1).cast("int")).cast("bigint"))
    placed = stage(placed.withColumn("_most", F.col("source_size") * repeats), "sources")
    order = [F.col("_most") / F.col("weight"), F.col("s")]
    running = earlier_total(earlier_total(placed, [], order, "_most", "_given"), [], order, "weight", "_passed")
    found = placed.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words = found["words"] or 0
    level = (F.lit(words) - F.col("_given")) / (F.lit(found["weight"] or 0) - F.col("_passed"))
    levels = running.select((F.col("_most") / F.col("weight")).alias("full"), "s", level.alias("level"), "weight", "_most")
    first = levels.filter(F.col("weight") * F.col("level") <= F.col("_most")).agg(F.min(F.struct("full", "s", "level")).alias("least")).first()["least"]
    share = F.col("weight") * F.lit(float(first["level"]) if words else 0.0)
    target = F.when(share > F.col("_most"), F.col("_most").cast("double")).otherwise(share)
    return placed.withColumn("target", target).withColumn("weight", F.col("weight").cast("int")).drop("_most")


def _schedule(sources: DataFrame, block: int) -> DataFrame:
    """Rows (s, slot, block): the slots of the mix in order, and the block each one takes."""
    counted = sources.select("s", F.ceil(F.col("quota") / block).cast("bigint").alias("slots"))
    placed = stage(earlier_total(counted, [], [F.col("s")], "slots", "first"), "slots")
    total = placed.agg(F.sum("slots")).first()[0] or 0
    bits = max(total - 1, 0).bit_length()
    steps = placed.filter("slots > 0").select("s", "first", "slots", F.expr(f"explode(sequence(0L, slots - 1, {_SLOTS_AT_ONCE}L))").alias("step"))
    steps = steps.repartition("s", "step")
    points = steps.select("s", F.expr(f"explode(sequence(first + step, first + least(step + {_SLOTS_AT_ONCE}, slots) - 1))").alias("point"))
    if bits:
        turned = F.reverse(F.lpad(F.bin("point"), bits, "0"))
        slots = points.select("s", F.conv(turned, 2, 10).cast("bigint").alias("slot"), F.lit(1).alias("_one"))
    else:
        slots = points.select("s", F.col("point").alias("slot"), F.lit(1).alias("_one"))
    return earlier_total(slots, ["s"], [F.col("slot")], "_one", "block").drop("_one")


class Mix:
    """The tables of one mix: ``sources``, ``rows`` (one per document), ``units`` and ``schedule``."""

    def __init__(
        self,
        docs: DataFrame,
        id_col: str = "doc_id",
        text_col: str = "text",
        source_col: str = "source",
        block: int = BLOCK_WORDS,
        weights: tuple[int, ...] = WEIGHTS,
        repeats: int = REPEATS,
    ):
        """Documents that agree in source, id and text are copies in one unit of the stream, one after another.

        A null or wordless text has size 0 and takes nothing. Sources may be null; a
        table without words has targets of 0 and an empty schedule. Only the three
        named columns of ``docs`` are read.
        """
        text = F.col(text_col)
        sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text).alias("size"), text_digest(text).alias("digest"))
        folded = stage(sized.groupBy("source", "doc_id", "size", "digest").agg(F.count("*").alias("copies")), "units")
        sums = folded.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
        found = targets(sums, weights, repeats).withColumn("quota", F.floor("target").cast("bigint"))
        self.sources = stage(found, "targets")
        side = broadcast_if_short(self.sources.withColumnRenamed("source", "_source"))
        named = folded.join(side, folded["source"].eqNullSafe(side["_source"])).drop("_source")
        named = named.withColumn("length", F.col("size") * F.col("copies"))
        order = [shuffle_key(F.col("doc_id")), F.col("doc_id"), F.col("size"), F.col("digest")]
        self.units = stage(earlier_total(named, ["s"], order, "length", "at"), "streams")
        self.schedule = stage(_schedule(self.sources, block), "schedule")
        self.block, self.repeats = block, repeats

    def pieces(self) -> DataFrame:
        """The mix itself: rows (slot, s, block, source, doc_id, size, at, start, words).

        ``start`` is the place in the source's stream, passes counted on; a slot's
        words are its pieces in order of ``start``.
        """
        passes = F.explode(F.sequence(F.lit(0), F.lit(self.repeats - 1))).alias("pass")
        laid = self.units.filter("length > 0").select("*", passes)
        laid = laid.withColumn("_from", F.col("pass") * F.col("source_size") + F.col("at"))
        laid = laid.withColumn("_to", F.least(F.col("_from") + F.col("length"), F.col("quota"))).filter("_from < _to")
        cut = laid.withColumn("block", F.expr(f"explode(sequence(_from div {self.block}, (_to - 1) div {self.block}))"))
        cut = cut.withColumn("start", F.greatest(F.col("_from"), F.col("block") * self.block))
        cut = cut.withColumn("words", F.least(F.col("_to"), (F.col("block") + 1) * self.block) - F.col("start"))
        columns = ["s", "block", "source", "doc_id", "size", "digest", "copies", "at", "start", "words"]
        return cut.select(*columns).join(self.schedule, ["s", "block"])

    def taken(self) -> DataFrame:
        """One row per document: source, doc_id, size, digest, copies, nth, source_size, target, and what the mix takes.

        ``nth`` numbers the copies of a unit. ``taken`` is the words of all passes, ``passes`` a list of
        (pass, words, slot), ``first_slot`` the slot that the first of them begins in, and ``n_slots`` the
        slots that the passes reach into, added up.
        """
        # A unit of many copies is written out by many tasks.
        steps = self.units.select("*", F.expr(f"explode(sequence(0L, copies - 1, {_SLOTS_AT_ONCE}L))").alias("step"))
        many = steps.filter(F.col("copies") > _SLOTS_AT_ONCE).repartition("s", "at", "step")
        steps = steps.filter(F.col("copies") <= _SLOTS_AT_ONCE).unionByName(many)
        rows = steps.select("*", F.expr(f"explode(sequence(step, least(step + {_SLOTS_AT_ONCE}, copies) - 1))").alias("nth"))
        rows = rows.withColumn("_place", F.col("at") + F.col("nth") * F.col("size"))
        count = F.expr("CASE WHEN size > 0 AND quota > _place THEN (quota - _place - 1) div source_size END")
        rows = rows.select("*", F.explode_outer(F.sequence(F.lit(0).cast("bigint"), count)).alias("pass"))
        rows = rows.withColumn("_from", F.col("pass") * F.col("source_size") + F.col("_place"))
        rows = rows.withColumn("_to", F.least(F.col("_from") + F.col("size"), F.col("quota")))
        rows = rows.withColumn("block", F.expr(f"_from div {self.block}"))
        reach = F.expr(f"(_to - 1) div {self.block} - block + 1")
        key = ["source", "doc_id", "size", "digest", "copies", "nth", "source_size", "target"]
        met = rows.select("s", *key, "pass", "block", (F.col("_to") - F.col("_from")).alias("words"), reach.alias("_slots"))
        met = met.join(self.schedule, ["s", "block"], "left")
        one = F.when(F.col("pass").isNotNull(), F.struct("pass", "words", "slot"))
        return met.groupBy(*key).agg(
            F.coalesce(F.sum("words"), F.lit(0)).cast("bigint").alias("taken"),
            F.min_by("slot", "pass").alias("first_slot"),
            F.coalesce(F.sum("_slots"), F.lit(0)).cast("bigint").alias("n_slots"),
            F.array_sort(F.collect_list(one)).alias("passes"),  # of one document: as many as ``repeats`` at most
        )

    def per_document(self) -> DataFrame:
        """One row per document: doc_id, size, source_size, target, taken, first_slot, n_slots."""
        return self.taken().select("doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots")


def _first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, blanks kept."""
    words = F.slice(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), 1, n)
    gaps = F.slice(F.split(text, r"[^\x20\x09-\x0D]+"), 1, n)
    return F.array_join(F.zip_with(gaps, words, lambda gap, word: F.concat(gap, word)), "")


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", slot_col: str | None = None, **options
) -> DataFrame:
    """``docs`` as the mix takes them, with their own columns, sorted by slot.

    A document taken whole three times gives three rows; the last pass over a document
    may take its first words only, and a document not taken gives no row. A column
    ``n_chars`` follows the text. ``slot_col`` names a column to add with the slot that the
    row's words begin in; one of ``docs`` with that name is replaced. Null and wordless texts are never
    taken; repeated rows are taken each for itself.
    """
    mix = Mix(docs, id_col, text_col, source_col, **options)
    taken = mix.taken().filter("taken > 0")
    units = taken.select(*[F.col(c).alias(f"_{c}") for c in ("source", "doc_id", "size", "digest", "nth")], "copies", "passes")
    units = stage(units, "taken")
    text = F.col(text_col)
    rows = docs.select(packed(docs), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), text_digest(text).alias("digest"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source")) & F.col("digest").eqNullSafe(F.col("_digest"))
    # The units grow with the texts, so they are merged at every size, never broadcast.
    met = rows.join(units.filter("copies = 1").hint("merge"), same).select("row", "_size", "passes")
    repeated = units.filter("copies > 1")
    if not repeated.isEmpty():
        some = repeated.groupBy("_source", "_doc_id", "_digest").agg(F.max("copies").alias("copies"))
        again = rows.join(some.hint("merge"), same).select("row", "source", "doc_id", "digest")
        again = with_position(again, F.xxhash64(F.to_json("row")), by=["source", "doc_id", "digest"], name="nth")
        # Also among rows without end that agree: the number is part of the key.
        met = met.unionByName(again.join(repeated.hint("merge"), same & (F.col("nth") == F.col("_nth"))).select("row", "_size", "passes"))
    passes = met.select("row", "_size", F.inline("passes"))
    whole = F.col("row").getField(text_col)
    cut = F.when(F.col("words") >= F.col("_size"), whole).otherwise(_first_words(whole, F.col("words").cast("int")))
    out = passes.select("row", "slot", "pass", F.xxhash64(whole).alias("tie"), cut.alias("cut"))
    out = out.withColumn("row", F.col("row").withField(f"`{text_col}`", F.col("cut")))
    if "n_chars" in docs.columns:
        length = F.length("cut").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("row", F.col("row").withField("n_chars", length))
    if slot_col:
        out = out.withColumn("row", F.col("row").withField(f"`{slot_col}`", F.col("slot")))
    return out.orderBy("slot", "tie", "pass").select("row.*")
