"""Repeated passages by sparse suffix arrays, kept as a logarithmic family of levels.

A byte goes if some string of ``length`` bytes (a window) that covers it also starts
anywhere else. A suffix array over every byte would be many times the text, so the suffixes
are first dealt out by content: among the ``k``-grams inside a window the one of least
hash is its key, so equal windows have equal keys wherever they stand. Neighbouring windows
mostly share their key; such a run is one fragment of the text, of which only key, digest
and place are shuffled. A key that occurs once holds no repeat. Fragments that are equal as
a whole are folded, and one of each form stands for all of them.

What is left are keys with several forms, and fragments in which a window may stand twice. Their windows are dealt to shards of a bounded
number of windows, and each shard is an index family: a batch of fragments gets a suffix
array (its windows, sorted), is merge-scanned against the levels there are for equal
windows, on both sides, and goes in as a level of one batch; two levels of equal size merge
to one of twice the size, and on. No window meets another outside its shard's family, and
the family takes new batches without sorting the older ones again.

A key with more windows than a family should hold (a phrase that stands in every third
document) is cut anew with longer ``k``-grams, in the end with whole windows, of which
equal ones fold. So no key, form or group of copies has to fit into one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import packed
from quipu.storage import stage

LENGTH = 200
SHARD_WINDOWS = 50_000  # of one index family, about
HOT_WINDOWS = 50_000  # of one key; beyond that it is cut anew
BATCH_WINDOWS = 16_384  # that get a suffix array at once
_RUN = 256  # windows of a fragment, at most
_BLOCK = 1 << 18  # bytes hashed at once
_ODD = 0x9E3779B97F4A7C15  # multipliers of the rolling hash and its last mixing
_MIX = 0xBF58476D1CE4E5B9


def gram_lengths(length: int) -> list[int]:
    """Lengths of the k-grams that deal out windows: from about a sixth of a window to all of it."""
    return sorted({max(1, length * part // 25) for part in (4, 14, 21, 25)})


def _bits(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, 256, np.uint64)


_BYTES = _bits(11)


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` bytes from every place on, by doubling their number."""
    power, size, out, done = _BYTES[data], 1, None, 0
    while True:
        if k & size:
            if out is None:
                out = power
            else:  # ``done`` bytes first, then ``size`` more
                n = len(out) - size
                out = out[:n] * np.uint64(pow(_ODD, size, 1 << 64)) + power[done : done + n]
            done += size
        size *= 2
        if size > k:
            break
        half = size // 2
        n = len(power) - half
        power = power[:n] * np.uint64(pow(_ODD, half, 1 << 64)) + power[half:]
    out = (out ^ (out >> np.uint64(31))) * np.uint64(_MIX)
    return out ^ (out >> np.uint64(29))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` values from every place on."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _cut(pieces: list[tuple[int, int, bytes]], length: int, k: int) -> tuple[np.ndarray, ...]:
    """Fragments (text number, start in the text, windows, key, digest, twin) of pieces (text number, start, bytes).

    A fragment is a ``twin`` if its least gram stands in it more than once; in any other one all windows differ.
    """
    raw = b"".join(p for *_, p in pieces)
    sizes = np.array([len(p) for *_, p in pieces])
    first = np.cumsum(sizes) - sizes
    last = first + sizes - length + 1  # end of the piece's windows
    hashes = gram_hashes(np.frombuffer(raw, np.uint8), k)
    least = window_minima(hashes, length - k + 1)
    starts = np.unique(np.concatenate((np.flatnonzero(least[1:] != least[:-1]) + 1, first, last)))
    starts = starts[starts < len(least)]
    piece = np.searchsorted(first, starts, "right") - 1
    inside = starts < last[piece]  # else the window would cross into the next piece
    ends = np.append(starts[1:], len(least))[inside]
    starts, piece = starts[inside], piece[inside]
    parts = -(-(ends - starts) // _RUN)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    starts, ends, piece = (np.repeat(a, parts) for a in (starts, ends, piece))
    starts = starts + nth * _RUN
    windows = np.minimum(ends - starts, _RUN)
    view, digest = memoryview(raw), xxhash.xxh3_64_intdigest
    reach = (starts + windows + length - 1).tolist()
    digests = np.array([digest(view[a:b]) for a, b in zip(starts.tolist(), reach)], np.uint64)
    text = np.array([n for n, *_ in pieces])[piece]
    shift = np.array([s for _, s, _ in pieces])[piece] - first[piece]
    leads = np.concatenate(([0], np.cumsum(hashes[: len(least)] == least)))  # windows that begin with their least gram
    twin = leads[starts + windows - 1] > leads[starts]
    return text, starts + shift, windows, least[starts].view(np.int64), digests.view(np.int64), twin


def fragments(texts: list[bytes], length: int, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """All windows of the texts as fragments, some blocks at a time; long texts are cut with an overlap."""
    held, size = [], 0
    for n, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, _BLOCK):
            held.append((n, at, text[at : at + _BLOCK + length - 1]))
            size += len(held[-1][2])
            if size >= _BLOCK:
                yield _cut(held, length, k)
                held, size = [], 0
    if held:
        yield _cut(held, length, k)


def _fragmented(strings: DataFrame, length: int, k: int) -> DataFrame:
    """Rows (id, start, windows, key, digest, twin) for strings (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            for text, start, windows, *rest in fragments(texts, length, k):
                columns = [batch.column(0).take(pa.array(text)), *[pa.array(a, pa.int32()) for a in (start, windows)], *map(pa.array, rest)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "windows", "key", "digest", "twin"])

    kind = strings.schema["id"].dataType.simpleString()
    return strings.select("id", "text").mapInArrow(run, f"id {kind}, start int, windows int, key long, digest long, twin boolean")


class Family:
    """Levels of sorted windows, each of twice the batches of the one before, or empty.

    ``repeated`` says of every window, by its number, whether it occurs more than once.
    """

    def __init__(self, length: int):
        self.length = length
        self.levels: list[tuple[np.ndarray, np.ndarray] | None] = []  # distinct windows in order, and their numbers
        self.repeated = np.zeros(0, bool)

    def add(self, texts: list[bytes]) -> None:
        """Take in the windows of a batch of texts, numbered on in their order."""
        base = len(self.repeated)
        data = np.frombuffer(b"".join(texts), np.uint8)
        counts = np.array([len(t) - self.length + 1 for t in texts])
        sizes = np.array([len(t) for t in texts])
        starts = np.arange(counts.sum()) + np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(counts) - counts), counts)
        windows = np.lib.stride_tricks.sliding_window_view(data, self.length)[starts]
        windows = np.ascontiguousarray(windows).view(f"S{self.length}").ravel()
        self.repeated = np.append(self.repeated, np.zeros(len(windows), bool))
        order = np.argsort(windows, kind="stable")
        windows, numbers = windows[order], order + base
        same = windows[1:] == windows[:-1]
        self.repeated[numbers[1:][same]] = True
        self.repeated[numbers[:-1][same]] = True
        first = np.append(True, ~same)
        level = (windows[first], numbers[first])
        for known in self.levels:
            if known is not None:
                self._scan(known, level)
        size = 0
        while size < len(self.levels) and self.levels[size] is not None:
            level, self.levels[size] = self._merged(self.levels[size], level), None
            size += 1
        if size == len(self.levels):
            self.levels.append(None)
        self.levels[size] = level

    @staticmethod
    def _meeting(known, level) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows of ``level`` go among the known ones, and which of them are there."""
        at = np.searchsorted(known[0], level[0])
        met = at < len(known[0])
        met[met] = known[0][at[met]] == level[0][met]
        return at, met

    def _scan(self, known, level) -> None:
        at, met = self._meeting(known, level)
        self.repeated[level[1][met]] = True
        self.repeated[known[1][at[met]]] = True

    def _merged(self, known, level):
        at, met = self._meeting(known, level)
        return tuple(np.insert(a, at[~met], b[~met]) for a, b in zip(known, level))


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False]))))
    return edges[::2], edges[1::2] - edges[::2]


def _compared(length: int, batch_windows: int):
    """Sorted rows (shard, key, digest, n, piece) to rows (key, digest, start, windows): repeated windows of forms that occur once."""

    def marked(keys: list[tuple[int, int, int]], texts: list[bytes]) -> pa.RecordBatch:
        family, batch, size = Family(length), [], 0
        for text in texts:
            batch.append(text)
            size += len(text) - length + 1
            if size >= batch_windows:
                family.add(batch)
                batch, size = [], 0
        if batch:
            family.add(batch)
        out, at = [], 0
        for (key, digest, n), text in zip(keys, texts):
            end = at + len(text) - length + 1
            if n == 1:  # the others are repeated as a whole
                out += [(key, digest, a, b) for a, b in zip(*(x.tolist() for x in runs(family.repeated[at:end])))]
            at = end
        columns = list(zip(*out)) or [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "digest", "start", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, keys, texts = None, [], []
        for batch in batches:
            for number, key, digest, n, piece in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if number != shard:
                    if texts:
                        yield marked(keys, texts)
                    shard, keys, texts = number, [], []
                if not keys or keys[-1] != (key, digest, n):  # repeated rows of the table bring a form twice
                    keys.append((key, digest, n))
                    texts.append(piece)
        if texts:
            yield marked(keys, texts)

    return run


def repeated(
    strings: DataFrame,
    length: int = LENGTH,
    grams: list[int] | None = None,
    shard_windows: int = SHARD_WINDOWS,
    hot_windows: int = HOT_WINDOWS,
    batch_windows: int = BATCH_WINDOWS,
) -> DataFrame:
    """Rows (id, found): runs (start, windows) of windows of ``strings`` (id, text as bytes) that occur elsewhere too.

    A string has a row for each of its fragments that hold some. Rows with one id must be
    copies. Strings shorter than ``length`` have no windows.
    """
    grams = grams or gram_lengths(length)
    strings = strings.filter(F.octet_length("text") >= length)
    found = stage(_fragmented(strings, length, grams[0]), "fragments")
    keys = found.groupBy("key").agg(F.count("*").alias("n"), F.max("twin").alias("twin"))
    keys = keys.filter("n > 1 or twin").select(F.col("key").alias("often"))
    found = stage(found.join(keys, F.col("key") == F.col("often")).drop("often"), "often")
    one = F.min(F.struct("id", "start", "windows", "twin")).alias("one")
    forms = stage(found.groupBy("key", "digest").agg(F.count("*").alias("n"), one).select("key", "digest", "n", "one.*"), "forms")
    whole = forms.filter("n > 1").select("key", "digest", F.array(F.struct(F.lit(0).alias("start"), "windows")).alias("runs"))

    # Keys with several forms or with twins, unless each form occurs twice anyway.
    figures = [F.sum("windows").alias("together"), F.count("*").alias("forms"), F.min("n").alias("least"), F.max("twin").alias("twins")]
    mixed = forms.groupBy("key").agg(*figures).filter("(forms > 1 or twins) and least = 1").select(F.col("key").alias("mixed"), "together")
    apart = stage(forms.join(mixed, F.col("key") == F.col("mixed")).drop("mixed"), "mixed")
    state = apart.agg(F.sum("windows").alias("windows"), F.max("together").alias("most")).first()
    marks = whole
    if state["windows"]:
        places = apart.groupBy("id").agg(F.collect_list(F.struct("key", "digest", "n", "start", "windows", "together")).alias("places"))
        texts = strings.select(F.col("id").alias("_id"), "text")
        pieces = places.join(texts, F.col("id") == F.col("_id")).select("text", F.inline("places"))
        pieces = pieces.select("key", "digest", "n", "together", F.expr(f"substring(text, start + 1, windows + {length - 1})").alias("piece"))
        pieces = stage(pieces, "pieces")
        few = pieces if len(grams) == 1 else pieces.filter(F.col("together") <= hot_windows)
        shards = max(1, -(-state["windows"] // shard_windows))
        dealt = few.select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "key", "digest", "n", "piece")
        dealt = dealt.repartition("shard").sortWithinPartitions("shard", "key", "digest")
        compared = dealt.mapInArrow(_compared(length, batch_windows), "key long, digest long, start int, windows int")
        marks = marks.unionByName(compared.groupBy("key", "digest").agg(F.collect_list(F.struct("start", "windows")).alias("runs")))
        if len(grams) > 1 and state["most"] > hot_windows:
            hot = pieces.filter(F.col("together") > hot_windows).dropDuplicates(["key", "digest"])
            hot = stage(hot.select(F.struct("key", "digest", "n").alias("id"), F.col("piece").alias("text")), "hot")
            finer = repeated(hot, length, grams[1:], shard_windows, hot_windows, batch_windows).filter("id.n = 1")
            finer = finer.groupBy("id").agg(F.flatten(F.collect_list("found")).alias("found"))
            marks = marks.unionByName(finer.select("id.key", "id.digest", _joined(F.col("found")).alias("runs")))
    # One row per form: repeated as a whole, compared, or cut anew.
    marks = stage(marks.select(F.col("key").alias("_key"), F.col("digest").alias("_digest"), "runs"), "marks")
    met = found.join(marks, (F.col("key") == F.col("_key")) & (F.col("digest") == F.col("_digest")))
    shifted = F.transform("runs", lambda r: F.struct((F.col("start") + r["start"]).alias("start"), r["windows"].alias("windows")))
    return met.select("id", shifted.alias("found"))


def _joined(marks: Column) -> Column:
    """Runs (start, windows) of one fragment, in order and with neighbours joined; a fragment has few windows."""
    empty = F.array().cast("array<struct<start:int,windows:int>>")

    def add(out: Column, mark: Column) -> Column:
        last = F.get(out, F.size(out) - 1)
        far = F.greatest(last["start"] + last["windows"], mark["start"] + mark["windows"])
        longer = F.struct(last["start"].alias("start"), (far - last["start"]).alias("windows"))
        joins = F.coalesce(last["start"] + last["windows"] >= mark["start"], F.lit(False))
        return F.when(joins, F.concat(F.slice(out, 1, F.size(out) - 1), F.array(longer))).otherwise(F.concat(out, F.array(mark)))

    return F.aggregate(F.array_sort(marks), empty, add)


RESULT = "struct<spans:array<struct<start:int,end:int>>,kept:binary>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_ARROW = pa.struct([("spans", _SPANS), ("kept", pa.binary())])


def without(text: bytes, found: list[tuple[int, int]], length: int) -> tuple[list[dict], bytes]:
    """Maximal removed runs of bytes, and the rest, for runs (start, windows) of repeated windows."""
    spans: list[list[int]] = []
    for start, windows in sorted(found):
        end = start + windows + length - 1
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    edges = [0, *[e for span in spans for e in span], len(text)]
    kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
    return [{"start": a, "end": b} for a, b in spans], kept


def _without(text: Column, found: Column, length: int) -> Column:
    @F.arrow_udf(RESULT)
    def build(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for some, places in texts:
            out = []
            for t, p in zip(some, places):
                spans, kept = without(t.as_py(), [(x["start"], x["windows"]) for x in p.as_py()], length) if t.is_valid else (None, None)
                out.append({"spans": spans, "kept": kept})
            yield pa.array(out, _ARROW)

    return build(text, found)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **options) -> DataFrame:
    """``docs`` with a struct ``repeats``: n_bytes, spans (start, end) of removed bytes, and the bytes ``kept``.

    Every byte covered by a string of ``length`` bytes that also starts anywhere else in the
    table, the same text included, is removed; strings never cross texts and are judged on
    the input. Texts are taken as UTF-8 bytes, null as empty; a text shorter than ``length``
    stays whole. Repeated rows are copies of each other, with or without an id. All rows and
    columns come back, whatever their names, but a column named repeats is replaced.
    """
    columns = [c for c in docs.columns if c != "repeats"]
    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")).cast("binary")
    marked = docs.select(packed(docs.select(*[F.col(f"`{c}`") for c in columns])), text.alias("text"), F.unhex(F.md5(F.concat(name, F.lit(b":"), text))).alias("id"))
    found = repeated(marked.select("id", "text"), length, **options)
    # Repeated rows share an id; a set holds what they find once.
    found = found.groupBy("id").agg(F.flatten(F.collect_set("found")).alias("found")).withColumnRenamed("id", "_id")
    # The list grows with the texts, so it is merged at every size, never broadcast.
    joined = marked.join(found.hint("merge"), F.col("id") == F.col("_id"), "left")
    cut = _without(F.when(F.col("found").isNotNull(), F.col("text")), F.col("found"), length)
    spans = F.coalesce(F.col("cut.spans"), F.array().cast("array<struct<start:int,end:int>>"))
    result = F.struct(F.octet_length("text").cast("bigint").alias("n_bytes"), spans.alias("spans"), F.coalesce("cut.kept", "text").alias("kept"))
    return joined.select("row", "text", cut.alias("cut")).select("row.*", result.alias("repeats"))
