"""Ranked lexical search: dense blocked products of item tiles and document tiles in float64.

A document's impact for a term and an item's weight for it are whole numbers, so a score
is a sum of whole products. One pass over the texts keeps each document's counts of the
items' own terms. The second pass lays 1,024 terms of a tile of items (256 at most) and of
a tile of documents (2,048 at most) out as dense float64 matrices and multiplies them:
weights are cut into limbs of 23 bits and impacts have 20, so a sum over 1,024 terms
stays below 2**53 and is exact; limbs and term blocks are added in 64-bit integers.

Each task keeps the best documents of every item over all its tiles, ties at the edge
settled by id, and hands on no more rows than that. Items are worked off in groups of a
bounded number of terms; only such a group is sent to the workers, so neither the items
nor the documents need fit into one place.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.llm.common import earlier_total
from quipu.operators.ordering import with_position
from quipu.storage import broadcast_if_short, stage

GROUP_TERMS = 500_000  # (item, term) pairs sent to the workers at once, and one more item at most
ITEMS, TERMS, DOCS = 256, 1024, 2048  # of a tile
_LIMB = 23  # bits of a weight; with impacts below 2**20 and 2**10 terms the sums stay below 2**53
_SPLIT_BYTES = 1 << 20  # of a text split into terms at once
_SALTS = 64
_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_TO_TERMS = bytes(b if b in _WORD_BYTES else 0x20 for b in bytes(range(256)).lower())
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time: a long text is split at blanks between terms."""
    plain = text.translate(_TO_TERMS)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + _SPLIT_BYTES)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split(b" ")
        at = end


def counted(text: bytes | None, places: dict[bytes, int]) -> tuple[int, dict[int, int]]:
    """Number of terms of a text, and how often each term of ``places`` occurs in it."""
    found: Counter = Counter()
    n = 0
    for words in _pieces(text or b""):
        n += len(words) - words.count(b"")
        found.update(map(places.get, words))
    found.pop(None, None)
    return n, found


def _postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Rows (doc_id, n, terms, counts) of the documents with at least one term; ``terms`` are places in ``vocabulary``."""
    encoded = [t.encode() for t in vocabulary]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {t: i for i, t in enumerate(encoded)}
        for batch in batches:
            ids, lengths, terms, counts = [], [], [], []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                n, found = counted(text.as_py(), places)
                if n:
                    ids.append(doc_id.as_py())
                    lengths.append(n)
                    terms.append(list(found.keys()))
                    counts.append(list(found.values()))
            arrays = [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "terms", "counts"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


@dataclass(frozen=True)
class Tile:
    """Items (their numbers), their terms (places in the vocabulary), and the weight of ``row`` for ``column``."""

    items: np.ndarray
    terms: np.ndarray
    rows: np.ndarray
    columns: np.ndarray
    weights: np.ndarray


def tiled(entries: list[tuple[int, int, int]], weights: np.ndarray, items: int = ITEMS) -> list[Tile]:
    """Entries (item, term, repeats) as tiles of so many items; terms of weight 0 are left out."""
    known = np.array(sorted((q, t, c) for q, t, c in entries if weights[t] > 0), np.int64).reshape(-1, 3)
    numbers = np.unique(known[:, 0])
    tiles = []
    for at in range(0, len(numbers), items):
        mine = numbers[at : at + items]
        rows = known[(known[:, 0] >= mine[0]) & (known[:, 0] <= mine[-1])]
        terms, columns = np.unique(rows[:, 1], return_inverse=True)
        tiles.append(Tile(mine, terms, np.searchsorted(mine, rows[:, 0]), columns, weights[rows[:, 1]] * rows[:, 2]))
    return tiles


def products(tile: Tile, columns: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int, block: int = TERMS) -> np.ndarray:
    """Scores (items by documents, exact) from impacts at (column of the tile, document), ``columns`` in rising order."""
    scores = np.zeros((len(tile.items), n_docs), np.int64)
    limbs = max(1, math.ceil(int(tile.weights.max(initial=0)).bit_length() / _LIMB))
    order = np.argsort(tile.columns, kind="stable")
    for start in range(0, len(tile.terms), block):
        a, b = np.searchsorted(columns, [start, start + block])
        if a == b:
            continue
        right = np.zeros((min(block, len(tile.terms) - start), n_docs))
        right[columns[a:b] - start, docs[a:b]] = impacts[a:b]
        mine = order[slice(*np.searchsorted(tile.columns[order], [start, start + block]))]
        for limb in range(limbs):
            part = tile.weights[mine] >> (_LIMB * limb) & ((1 << _LIMB) - 1)
            if part.any():
                left = np.zeros((len(tile.items), right.shape[0]))
                left[tile.rows[mine], tile.columns[mine] - start] = part
                scores += (left @ right).astype(np.int64) << (_LIMB * limb)
    return scores


def norms(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """A document's m: 100 - 25 + 25 * n * N div L, also where the product passes 64 bits."""
    if 25 * int(n.max(initial=0)) * documents < 1 << 63:
        return 75 + 25 * n * documents // terms
    return np.array([75 + 25 * int(x) * documents // terms for x in n], np.int64)


class _Best:
    """The best documents of one item so far, by falling score and, for equal ones, rising id, null last."""

    def __init__(self, keep: int):
        self.keep = keep
        self.scores, self.ids, self.nameless = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        edge = self.scores[-1] if len(self.scores) == self.keep else 1
        near = np.flatnonzero(scores >= edge)  # ties at the edge included
        if len(near) > self.keep:
            edge = np.partition(scores[near], len(near) - self.keep)[len(near) - self.keep]
            near = near[scores[near] >= edge]
        if not len(near):
            return
        scores = np.concatenate((self.scores, scores[near]))
        ids = np.concatenate((self.ids, ids[near]))
        nameless = np.concatenate((self.nameless, nameless[near]))
        first = np.lexsort((ids, nameless, -scores))[: self.keep]
        self.scores, self.ids, self.nameless = scores[first], ids[first], nameless[first]


def _scored(postings: DataFrame, tiles: list[Tile], size: int, documents: int, terms: int, keep: int) -> DataFrame:
    """Rows (item, doc_id, score): the best documents of every item in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[_Best(keep) for _ in tile.items] for tile in tiles]
        column = np.full(size, -1, np.int32)
        for batch in (b.slice(at, DOCS) for b in batches for at in range(0, b.num_rows, DOCS)):
            nameless = np.asarray(batch.column(0).is_null())
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            found = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            tf = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            docs = np.repeat(np.arange(len(ids)), np.diff(batch.column(2).offsets.to_numpy()))
            m = norms(batch.column(1).to_numpy(), documents, terms)[docs]
            impacts = 1_000_000_000 * tf // (1000 * tf + 12 * m)
            for tile, kept in zip(tiles, best):
                column[:] = -1
                column[tile.terms] = np.arange(len(tile.terms))
                at = column[found]
                inside = np.flatnonzero(at >= 0)
                inside = inside[np.argsort(at[inside], kind="stable")]
                scores = products(tile, at[inside], docs[inside], impacts[inside], len(ids))
                most = scores.max(axis=1, initial=0)
                for i in np.flatnonzero(most > 0):
                    if len(kept[i].scores) < keep or most[i] >= kept[i].scores[-1]:
                        kept[i].add(scores[i], ids, nameless)
        for tile, kept in zip(tiles, best):
            lengths = [len(b.scores) for b in kept]
            if sum(lengths):
                ids = pa.array(np.concatenate([b.ids for b in kept]), mask=np.concatenate([b.nameless for b in kept]))
                scores = pa.array(np.concatenate([b.scores for b in kept]))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(tile.items, lengths)), ids, scores], names=["item", "doc_id", "score"])

    return postings.mapInArrow(run, "item long, doc_id long, score long")


def _best_rows(rows: DataFrame, by: list[str], keep: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), F.lit(_TERM), F.lit(0))


def search(
    docs: DataFrame,
    items: DataFrame,
    nearest: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    group_terms: int = GROUP_TERMS,
) -> DataFrame:
    """For each row of ``items`` its ``nearest`` documents: rows (item_id, rank from 1, doc_id, score).

    Terms are runs of digits, letters and characters beyond ASCII, A-Z in lower case. With N
    documents that have a term, L terms in all and df documents that hold a term, the term
    weighs floor(1000 * ln((2N + 2) / (2 df + 1))); a document of n terms has
    m = 75 + 25 * n * N div L, and each occurrence of a term in the item adds
    weight * (10**9 * tf div (1000 * tf + 12 * m)). Documents of score 0 are left out; equal
    scores stand by rising id, null last.

    Null, empty and wordless texts have no terms: such items give no rows and such documents
    are not counted. Repeated rows of ``docs`` are ranked each for itself; repeated rows of
    ``items`` (id and text) count once, and items that share an id are ranked apart. Ids of
    documents are whole numbers; no other columns, whatever their names, are read.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    asked = items.select(F.col(item_id).alias("item_id"), _words(F.col(item_text)).alias("words")).filter(F.size("words") > 0).distinct()
    asked = stage(with_position(asked, F.col("item_id").asc_nulls_last(), F.col("words"), name="item"), "items")
    pairs = asked.select("item", F.explode("words").alias("term")).groupBy("item", "term").agg(F.count("*").alias("repeats"))
    pairs = stage(pairs, "item_terms")
    sizes = pairs.groupBy("item").agg(F.count("*").alias("terms"))
    placed = earlier_total(sizes, [], [F.col("item")], "terms", "before").select("item", F.expr(f"before div {group_terms}L").alias("group"))
    grouped = stage(pairs.join(placed, "item").select("group", "item", "term", "repeats"), "item_groups")
    found = None
    totals = None
    for group in [r["group"] for r in grouped.select("group").distinct().orderBy("group").collect()]:  # one per group_terms pairs
        entries = grouped.filter(F.col("group") == group).collect()  # at most group_terms, and one more item
        vocabulary = sorted({e["term"] for e in entries})
        place = {t: i for i, t in enumerate(vocabulary)}
        postings = stage(_postings(texts, vocabulary), "postings")
        if totals is None:
            totals = postings.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
        held = np.zeros(len(vocabulary), np.int64)
        for row in postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():  # of one vocabulary
            held[row["term"]] = row["df"]
        if not totals["documents"]:
            break
        weights = np.array([math.floor(1000 * math.log((2 * totals["documents"] + 2) / (2 * int(df) + 1))) for df in held], np.int64)
        tiles = tiled([(e["item"], place[e["term"]], e["repeats"]) for e in entries], weights)
        best = _scored(postings, tiles, len(vocabulary), totals["documents"], totals["terms"], nearest)
        best = best.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(_SALTS)))
        best = stage(_best_rows(best, ["item", "salt"], nearest).drop("salt", "rank"), "best")
        found = best if found is None else found.unionByName(best)
    if found is None:
        empty = asked.filter("false")
        return empty.select("item_id", F.lit(1).alias("rank"), F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("score"))
    ranked = _best_rows(found, ["item"], nearest)
    names = asked.select(F.col("item").alias("_item"), "item_id")
    return ranked.join(broadcast_if_short(names), F.col("item") == F.col("_item")).select("item_id", "rank", "doc_id", "score")
