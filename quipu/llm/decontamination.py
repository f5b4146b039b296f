"""Benchmark decontamination: one Aho-Corasick scan with offsets back into the text.

The windows of all items are the patterns of one automaton. A text is normalised to
its words, joined by single blanks, and scanned once; the end of a match gives the
words it covers, and the words' own places give the span in the original text.

An automaton takes some 3 KB of a worker's memory for each window. So a benchmark of any
size is numbered off, window by window, into parts of a bounded number of windows; the
texts are scanned with the automaton of one part after another, and what the parts find is
united. One part or many, the method and the results are the same.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import packed
from quipu.operators.ordering import with_position
from quipu.storage import stage

WINDOW = 10
PART_WINDOWS = 50_000  # (window, item) pairs of one automaton
# Lower case is taken of A-Z alone, so the words of both sides are found by one pattern.
_WORD = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")
_SPARK_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = str.maketrans(_UPPER, _LOWER)

# Runs of hit words: first and last word, and the place of the run in the text.
RUNS = "array<struct<first:int,last:int,start:int,end:int>>"
FOUND = f"struct<n_words:bigint,items:array<string>,runs:{RUNS}>"
_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("runs", pa.list_(pa.struct([(c, pa.int32()) for c in ("first", "last", "start", "end")]))),
    ]
)


def words_of(text: str | None) -> list[str]:
    return [w.translate(_TO_LOWER) for w in _WORD.findall(text)] if text else []


def windows_of(words: list[str], window: int = WINDOW) -> list[str]:
    """The windows of an item, each with a blank at both ends; a shorter item is one window."""
    if not words:
        return []
    last = max(len(words) - window, 0)
    return [f" {' '.join(words[i : i + window])} " for i in range(last + 1)]


class Scanner:
    """The automaton over (window, item) pairs."""

    def __init__(self, pairs: Iterable[tuple[str, str]]):
        owners: dict[str, set[str]] = {}
        for pattern, item in pairs:
            owners.setdefault(pattern, set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for pattern, ids in owners.items():
            self.automaton.add_word(pattern, (len(pattern), pattern.count(" ") - 1, tuple(ids)))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def scan(self, text: str | None) -> dict:
        """Number of words, items, and the runs of hit words with their places (code points, end exclusive)."""
        if not text:
            return {"n_words": 0, "items": [], "runs": []}
        normal = f" {' '.join(_WORD.findall(text))} ".translate(_TO_LOWER)
        n_words = normal.count(" ") - 1 if len(normal) > 2 else 0
        found = [] if self.empty or not n_words else list(self.automaton.iter(normal))
        if not found:
            return {"n_words": n_words, "items": [], "runs": []}
        words = list(_WORD.finditer(text))
        starts = np.cumsum([0] + [len(w[0]) + 1 for w in words])  # of the blank before each word
        hit = np.zeros(n_words + 1, np.int64)
        items: set[str] = set()
        first = np.searchsorted(starts, [end + 1 - value[0] for end, value in found])
        for at, (_, (_, length, ids)) in zip(first, found):
            hit[at] += 1
            hit[at + length] -= 1
            items.update(ids)
        covered = np.cumsum(hit)[:-1] > 0
        edges = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])))).tolist()
        runs = [{"first": a, "last": b - 1, "start": words[a].start(), "end": words[b - 1].end()} for a, b in zip(edges[::2], edges[1::2])]
        return {"n_words": n_words, "items": sorted(items), "runs": runs}


_scanners: dict[str, Scanner] = {}  # one automaton per Python worker and broadcast


def _scanned(text: Column, pairs: list[tuple[str, str]]) -> Column:
    key = uuid.uuid4().hex

    @F.arrow_udf(FOUND)
    def scan(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if key not in _scanners:
            _scanners.clear()
            _scanners[key] = Scanner(pairs)
        scanner = _scanners[key]
        for batch in texts:
            yield pa.array([scanner.scan(t.as_py()) for t in batch], _ARROW)

    return scan(text)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(_SPARK_WORD), F.lit(0))


def _parts(benchmark: DataFrame, id_col: str, text_col: str, window: int, size: int) -> DataFrame:
    """Rows (part, pattern, item): each window of each item once, numbered off into parts of ``size``."""
    item = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item")
    words = benchmark.select(item, _words(F.col(text_col).cast("string")).alias("words")).filter(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    cut = words.select("item", "words", length.alias("length"), F.explode(F.sequence(F.lit(1), F.size("words") - length + 1)).alias("at"))
    pattern = F.concat(F.lit(" "), F.array_join(F.slice("words", F.col("at"), F.col("length")), " "), F.lit(" "))
    pairs = cut.select(pattern.alias("pattern"), "item").distinct()
    numbered = with_position(pairs, F.col("pattern"), F.col("item"), name="place")
    return stage(numbered.select(F.expr(f"place div {size}L").alias("part"), "pattern", "item"), "windows")


def _united(runs: Column) -> Column:
    """Runs of several parts in order, with those that meet joined; of one document."""

    def add(out: Column, run: Column) -> Column:
        last = F.get(out, F.size(out) - 1)
        meets = F.coalesce(run["first"] <= last["last"] + 1, F.lit(False))
        far = run["last"] > last["last"]
        longer = F.struct(
            last["first"].alias("first"), F.when(far, run["last"]).otherwise(last["last"]).alias("last"),
            last["start"].alias("start"), F.when(far, run["end"]).otherwise(last["end"]).alias("end"),
        )
        return F.when(meets, F.concat(F.slice(out, 1, F.size(out) - 1), F.array(longer))).otherwise(F.concat(out, F.array(run)))

    return F.aggregate(F.array_sort(runs), F.array().cast(RUNS), add)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    part_windows: int = PART_WINDOWS,
) -> DataFrame:
    """``docs`` with a struct ``contamination``: n_words, n_hit, items, spans.

    Words are runs of digits, letters and characters beyond ASCII, A-Z in lower case.
    A word inside any occurrence of a window is hit; spans are runs of hit words in
    the original text (code points, end exclusive). A column of ``docs`` named contamination
    is replaced; no other name of theirs matters. A null or wordless text has no
    words; a null or wordless item has no window; an item without an id is listed as
    the empty string; items with one id count once. Every row of ``docs`` comes back
    once, repeated rows too, with all its columns.
    """
    parts = _parts(benchmark, item_id, item_text, window, part_windows)
    last = parts.agg(F.max("part")).first()[0] or 0
    columns = [c for c in docs.columns if c != "contamination"]
    rows = docs.select(packed(docs.select(*[F.col(f"`{c}`") for c in columns])), F.col(f"`{text_col}`").alias("text"))

    def pairs(part: int) -> list[tuple[str, str]]:
        return [(r["pattern"], r["item"]) for r in parts.filter(F.col("part") == part).select("pattern", "item").collect()]  # part_windows at most

    if not last:
        found = rows.select("row", _scanned(F.col("text"), pairs(0)).alias("found"))
    else:
        keyed = stage(rows.withColumn("id", F.monotonically_increasing_id()), "texts")
        hits = [stage(keyed.select("id", _scanned(F.col("text"), pairs(p)).alias("f")).filter(F.size("f.runs") > 0), "hits") for p in range(last + 1)]
        every = hits[0]
        for more in hits[1:]:
            every = every.unionByName(more)
        joined = every.groupBy(F.col("id").alias("_id")).agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("f.items")))).alias("items"),  # of one document
            _united(F.flatten(F.collect_list("f.runs"))).alias("runs"),
        )
        n_words = F.size(_words(F.col("text"))).cast("bigint")
        none = [F.array().cast("array<string>"), F.array().cast(RUNS)]
        whole = F.struct(n_words.alias("n_words"), F.coalesce("items", none[0]).alias("items"), F.coalesce("runs", none[1]).alias("runs"))
        found = keyed.join(joined, F.col("id") == F.col("_id"), "left").select("row", whole.alias("found"))
    n_hit = F.aggregate("found.runs", F.lit(0).cast("bigint"), lambda n, r: n + r["last"] - r["first"] + 1)
    spans = F.transform("found.runs", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end")))
    result = F.struct("found.n_words", n_hit.alias("n_hit"), "found.items", spans.alias("spans"))
    return found.select("row.*", result.alias("contamination"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, as they are."""
    found = contamination(docs.select(packed(docs), F.col(f"`{text_col}`").alias("text")), benchmark)
    return found.filter("contamination.n_hit = 0").select("row.*")
