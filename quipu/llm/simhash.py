"""SimHash near-duplicates: pigeonhole blocks, Hamming check, connected components.

A fingerprint has 64 bits. Cut into six blocks, two fingerprints that differ in at
most three bits agree on at least three blocks, so each fingerprint is written once
per choice of three blocks (20 rows) and compared only inside equal choices.

Equal fingerprints are folded before that, so a group of exact copies of any size is
one row. A bucket never writes its pairs: it returns the links of a spanning forest.
Buckets of more than ``BUCKET_ROWS`` different fingerprints are dealt out again by
56 finer choices of the bits still free; those share 51 bits, so no group of the
second round can hold more than 8192 fingerprints and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import packed
from quipu.storage import stage

BITS, DISTANCE = 64, 3
BUCKET_ROWS = 4096
FINER_ROWS = 8192  # at most 13 bits are free in a bucket of the second round
_SEED = 42
_HASHES_AT_ONCE = 1 << 16  # bounds the memory of one very long text


def _spans(lengths: list[int]) -> list[tuple[int, int]]:
    starts, spans = 0, []
    for n in lengths:
        spans.append((starts, starts + n))
        starts += n
    return spans


_BLOCKS = _spans([11, 11, 11, 11, 10, 10])


def _mask(spans: list[tuple[int, int]]) -> int:
    return sum(((1 << (end - start)) - 1) << start for start, end in spans)


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


TABLES = [_mask(list(chosen)) for chosen in combinations(_BLOCKS, 3)]


def fingerprint_of(text: bytes | None, shingle: int = 3) -> int:
    """SimHash of the shingles of whitespace-separated words, A-Z in lower case; 0 without words."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return digest(joined, _SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _HASHES_AT_ONCE):
        pairs = zip(starts[at : at + _HASHES_AT_ONCE], ends[at : at + _HASHES_AT_ONCE])
        hashes = np.array([digest(joined[a:b], _SEED) for a, b in pairs], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(starts)).tolist())


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The fingerprint of each text as a bigint holding its 64 bits."""

    @F.arrow_udf("bigint")
    def build(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array((_signed(fingerprint_of(t.as_py(), shingle)) for t in batch), pa.int64())

    return build(text.cast("binary"))


def forest(members: np.ndarray) -> list[tuple[int, int]]:
    """Links of at most DISTANCE bits that connect ``members`` as all such links would."""
    links, rest = [], members.view(np.uint64)  # bits of a signed number are counted without its sign
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            node = reached.pop()
            near = np.bitwise_count(rest ^ node) <= DISTANCE
            if near.any():
                found = rest[near]
                links += [(_signed(int(node)), _signed(int(other))) for other in found]
                reached += list(found)
                rest = rest[~near]
    return links


def _bucket_links(bucket_rows: int):
    """Sorted rows (table, bucket, fp) to links, or to the rows of a bucket that is too large."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("table", pa.int32())])

    def emit(links, table, large):
        a = [x for x, _ in links]
        b = [y for _, y in links]
        columns = [np.array(a + large, np.int64), np.array(b + large, np.int64), np.array([-1] * len(a) + [table] * len(large), np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the bucket at the end of a batch may go on in the next
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(3)]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            table, bucket, fp = columns
            if not len(fp):
                continue
            cuts = np.flatnonzero((table[1:] != table[:-1]) | (bucket[1:] != bucket[:-1])) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(fp)]))
            held = [c[starts[-1] :] for c in columns]
            yield from groups(table, fp, starts[:-1], ends[:-1])
        if held is not None:
            yield from groups(held[0], held[2], np.array([0]), np.array([len(held[2])]))

    def groups(table, fp, starts, ends):
        links = []
        for k in np.flatnonzero(ends - starts > 1).tolist():
            members = fp[starts[k] : ends[k]]
            if len(members) > bucket_rows:
                for at in range(0, len(members), 10_000):
                    yield emit([], int(table[starts[k]]), members[at : at + 10_000].tolist())
            else:
                links += forest(members)
            if len(links) >= 10_000:
                yield emit(links, 0, [])
                links = []
        if links:
            yield emit(links, 0, [])

    return run


def _dealt(rows: DataFrame, bucket_rows: int) -> DataFrame:
    """Rows (table, bucket, fp) grouped by bucket and turned into links."""
    return (
        rows.repartition("table", "bucket")
        .sortWithinPartitions("table", "bucket", "fp")
        .mapInArrow(_bucket_links(bucket_rows), "a long, b long, table int")
    )


def _finer(table: Column, free_blocks: int = 8) -> Column:
    """Buckets of the second round: per first choice, five of eight cuts of the free bits."""
    choices = []
    for mask in TABLES:
        free = [i for i in range(BITS) if not mask >> i & 1]
        cuts = [sum(1 << int(i) for i in part) for part in np.array_split(free, free_blocks)]
        keys = [mask | sum(kept) for kept in combinations(cuts, free_blocks - DISTANCE)]
        choices.append(F.array(*[F.lit(_signed(k)) for k in keys]))
    return F.element_at(F.array(*choices), table + 1)


def links(fps: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) that connect the distinct bigint column ``fp`` as all pairs within DISTANCE bits would."""
    masks = F.array(*[F.lit(_signed(m)) for m in TABLES])
    rows = fps.select("fp", F.posexplode(masks).alias("table", "mask"))
    found = stage(_dealt(rows.select("table", F.expr("fp & mask").alias("bucket"), "fp"), bucket_rows), "links")
    large = found.filter("table >= 0")
    if not large.isEmpty():
        rows = large.select(F.col("a").alias("fp"), "table", F.posexplode(_finer(F.col("table"))).alias("cut", "mask"))
        rows = rows.select(F.expr("table * 56 + cut").alias("table"), F.expr("fp & mask").alias("bucket"), "fp")
        found = found.unionByName(stage(_dealt(rows, FINER_ROWS), "links"))
    return found.filter("table < 0").select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): one row (node, label) per linked node.

    The label is the component's smallest node. Every round hooks each node and its
    root to the smallest label next to it and then halves the way to the root, so
    the rounds grow with the logarithm of the size. All minima are folded by task
    before the shuffle; every round is a table in the shared folder.
    """
    edges = stage(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = stage(edges.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        hooks = labels.join(near, labels["node"] == near["a"]).filter("near < label").select("node", "label", "near")
        hooks = hooks.select(F.explode(F.array_distinct(F.array("node", "label"))).alias("hooked"), "near")
        hooks = stage(hooks.groupBy("hooked").agg(F.min("near").alias("near")), "hooks")
        if hooks.isEmpty():
            return labels
        hooked = labels.join(hooks, labels["node"] == hooks["hooked"], "left")
        hooked = stage(hooked.select("node", F.least("label", "near").alias("label")), "labels")
        roots = hooked.select(F.col("node").alias("root"), F.col("label").alias("above"))
        labels = stage(hooked.join(roots, hooked["label"] == roots["root"]).select("node", F.col("above").alias("label")), "labels")


def _classified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (doc_id, digest of the text, fp, class label, component_id), one per document."""
    text = F.col(text_col)
    marked = stage(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("digest"), fingerprint(text).alias("fp")), "fingerprints")
    folded = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "folded")
    labels = components(links(folded.select("fp")))
    named = folded.join(labels, folded["fp"] == labels["node"], "left")
    named = named.select("fp", F.coalesce("label", "fp").alias("label"), "first_id")
    first = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    classes = stage(named.join(first, "label").select(F.col("fp").alias("class_fp"), "label", "component_id"), "classes")
    return marked.join(classes, marked["fp"] == classes["class_fp"]).drop("class_fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, fingerprint (bigint ``fp``) and ``component_id``.

    ``component_id`` is the smallest id that can be reached over links of at most
    three differing bits. Texts that are null or hold no word have fingerprint zero
    and link like any other. Repeated rows stay; a null id is never the smallest, so
    it shows as component only where no id is known. No rows give no rows; other
    columns of ``docs``, whatever their names, are not read.
    """
    return _classified(docs, id_col, text_col).select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole rows of ``docs``: of each component the document with the smallest id.

    Rows that repeat that id with the same text count as the same document, of which
    one stays; so does one of a component without ids. All columns are kept. The texts
    meet the list of kept documents in one join; only repeated rows are dealt again.
    """
    found = _classified(docs, id_col, text_col).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    rows = found.groupBy("label", "doc_id", "digest").agg(F.count("*").alias("n"))
    first = F.min(F.struct("digest", "n")).alias("first")  # rows of one label here share their id
    kept = rows.groupBy("label", "doc_id").agg(first).select(F.col("doc_id").alias("kept_id"), "first.*")
    kept = stage(kept.withColumnRenamed("digest", "kept_digest"), "kept")
    marked = docs.select(packed(docs), F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("digest"))

    def among(part: DataFrame) -> DataFrame:
        same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest"))
        # The list grows with the texts, so it is merged at every size, never broadcast.
        return marked.join(part.select("kept_id", "kept_digest").hint("merge"), same, "left_semi")

    out = among(kept.filter("n = 1"))
    repeated = kept.filter("n > 1")
    if not repeated.isEmpty():
        out = out.unionByName(among(repeated).dropDuplicates(["doc_id", "digest"]))
    return out.select("row.*")
