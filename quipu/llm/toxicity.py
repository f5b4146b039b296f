"""Toxicity by compression distance: two zstandard dictionaries and calibrated thresholds.

The ordinary dictionary holds text of documents labelled 0. The toxic dictionary holds
the words of documents labelled 1 that are characteristic of them, before the same
ordinary text, so both shorten ordinary prose alike and a window is shorter under the
toxic dictionary only where it repeats toxic text. Every whole text is cut into windows
at blanks; the differences of the two compressed lengths, strongest first, are weighed
by a logistic calibration fitted on documents that the dictionaries had not seen.

The labelled rows that are fitted on are a bounded sample, but each is read whole, in tasks:
they count grams and words, offer pieces of ordinary text and compress the windows. Only
grams that tell, the dictionaries' contents and a few figures per row come to the driver.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.labelled import training_rows
from quipu.storage import stage

PER_CLASS = 2_500  # labelled rows of each class that are fitted on, at most
WINDOW = 64
ORDINARY_BYTES = 96 * 1024
TOXIC_BYTES = 24 * 1024
GRAMS = (4, 5, 6)
# Least share of toxic documents among those with a gram, as a lower confidence bound; the best of these is chosen.
EVIDENCE = (0.6, 0.8, 0.95)
TELLING = 200_000  # grams above the first of these that are kept, the surest first
_PIECE = 256  # bytes of a piece of ordinary text
_HALVES, _ALL = (0, 1), 2  # what dictionaries are made from: either half of the rows, and all


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


def normal(text: str) -> bytes:
    return f" {' '.join(text.lower().split())} ".encode()


def windows(text: bytes, size: int = WINDOW) -> Iterator[bytes]:
    """Consecutive pieces of about ``size`` bytes; each ends at the next blank, if that is near."""
    start, last = 0, len(text) - 1
    while start < last:
        end = min(start + size, last)
        blank = text.find(b" ", end, end + size)
        end = blank if blank >= 0 else min(end + size, last)
        yield text[start : end + 1]
        start = end


def _grams(word: str) -> set[str]:
    word = f" {word} "
    return {word[i : i + n] for n in GRAMS for i in range(len(word) - n + 1)}


def _lower(hits: Column, n: Column, z: float = 1.96) -> Column:
    """Lower confidence bound of the share hits / n."""
    share = hits / n
    spread = z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    return (share + z * z / (2 * n) - spread) / (1 + z * z / n)


def _telling(rows: DataFrame) -> dict[int, dict[str, float]]:
    """For each set of rows: the grams whose least share of toxic documents reaches the first level of EVIDENCE."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], Counter[str]] = defaultdict(Counter)
        for batch in batches:
            for half, label, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                counts[half, label].update(set().union(*map(_grams, set(normal(text).decode().split()))))
        for (half, label), grams in counts.items():
            n = len(grams)
            arrays = [pa.array([half] * n, pa.int32()), pa.array([label] * n, pa.int32()), pa.array(list(grams)), pa.array(list(grams.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["half", "label", "gram", "n"])

    found = rows.select("half", "label", "text").mapInArrow(count, "half int, label int, gram string, n long")
    sets = found.withColumn("half", F.explode(F.array("half", F.lit(_ALL))))
    sums = sets.groupBy("half", "gram").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("hits"))
    surest = stage(sums.select("half", "gram", _lower(F.col("hits"), F.col("n")).alias("lower")).filter(F.col("lower") >= EVIDENCE[0]), "grams")
    return {
        half: {r["gram"]: r["lower"] for r in surest.filter(F.col("half") == half).orderBy(F.desc("lower"), "gram").limit(TELLING).collect()}
        for half in (*_HALVES, _ALL)
    }


def _characteristic(rows: DataFrame) -> dict[int, list[bytes]]:
    """For each set of rows and level of EVIDENCE: the words of toxic documents with a telling gram, the most frequent last."""
    telling = _telling(rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, str], float] = {}  # of the grams of a word
        found: Counter[tuple[int, str]] = Counter()
        for batch in batches:
            for half, text in zip(*(batch.column(i).to_pylist() for i in range(2))):
                for word in set(normal(text).decode().split()):
                    for part in (half, _ALL):
                        if (part, word) not in best:
                            best[part, word] = max((telling[part].get(g, 0.0) for g in _grams(word)), default=0.0)
                        if best[part, word]:
                            found[part, word] += 1
        if found:
            parts, words = zip(*found)
            arrays = [pa.array(parts, pa.int32()), pa.array(words), pa.array([best[k] for k in found], pa.float64()), pa.array(list(found.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["half", "word", "best", "n"])

    words = rows.filter("label = 1").select("half", "text").mapInArrow(count, "half int, word string, best double, n long")
    words = words.filter(F.octet_length("word") <= TOXIC_BYTES).groupBy("half", "word").agg(F.max("best").alias("best"), F.sum("n").alias("n"))
    words = stage(words, "words")
    most = TOXIC_BYTES // 3  # no more words than that fill a dictionary
    contents: dict[int, list[bytes]] = {}
    for half in (*_HALVES, _ALL):
        contents[half] = []
        for least in EVIDENCE:
            chosen = words.filter((F.col("half") == half) & (F.col("best") >= least)).orderBy(F.desc("n"), F.desc("word")).limit(most).collect()
            ranked = sorted((r["n"], r["word"]) for r in chosen)
            contents[half].append("".join(f" {w} " for _, w in ranked).encode()[-TOXIC_BYTES:])
    return contents


def _common(rows: DataFrame) -> dict[int, bytes]:
    """For each set of rows: pieces of ordinary texts, chosen by their digests, up to ORDINARY_BYTES."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half, text in zip(*(batch.column(i).to_pylist() for i in range(2))):
                pieces = list(set(windows(normal(text), _PIECE)))
                if pieces:
                    yield pa.RecordBatch.from_arrays([pa.array([half] * len(pieces), pa.int32()), pa.array(pieces, pa.binary())], names=["half", "piece"])

    pieces = rows.filter("label = 0").select("half", "text").mapInArrow(cut, "half int, piece binary")
    pieces = stage(pieces.withColumn("half", F.explode(F.array("half", F.lit(_ALL)))).distinct().withColumn("turn", F.xxhash64("piece")), "pieces")
    out = {}
    for half in (*_HALVES, _ALL):
        # Most pieces are longer than _PIECE, and a shorter one ends its text.
        some = pieces.filter(F.col("half") == half).orderBy("turn", "piece").limit(2 * ORDINARY_BYTES // _PIECE).collect()
        out[half] = b"".join(bytes(r["piece"]) for r in some)[:ORDINARY_BYTES] or b" "
    return out


def _compressor(content: bytes) -> zstd.ZstdCompressor:
    parameters = zstd.ZstdCompressionParameters(
        window_log=17, hash_log=16, chain_log=16, search_log=4, min_match=4, strategy=zstd.STRATEGY_LAZY2,
        write_content_size=0, write_checksum=0, write_dict_id=0, format=zstd.FORMAT_ZSTD1_MAGICLESS,
    )
    dictionary = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zstd.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


class Scorer:
    def __init__(self, ordinary: bytes, toxic: bytes, weights: tuple[float, ...] = ()):
        self.ordinary = _compressor(ordinary).compress
        self.toxic = _compressor(toxic).compress
        self.weights = np.array(weights)

    def features(self, text: bytes) -> list[float]:
        """Of the window differences: the two largest, the sum and number of the positive ones; the windows."""
        best = second = total = positive = n = 0
        for window in windows(text):
            gain = len(self.ordinary(window)) - len(self.toxic(window))
            n += 1
            if gain > 0:
                positive += 1
                total += gain
                if gain > best:
                    best, second = gain, best
                elif gain > second:
                    second = gain
        return [1.0, min(best, 12), min(second, 12), np.log1p(total), np.log1p(positive), np.log1p(n)]

    def score(self, text: str | None) -> float:
        z = float(self.weights @ self.features(normal(text or "")))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _calibrated(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """Logistic weights, and the mean log loss they leave."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w += np.clip(step, -5, 5)
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-6, 1 - 1e-6)
    return float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))), w


def _measured(rows: DataFrame, common: dict[int, bytes], contents: dict[int, list[bytes]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels, and features for each level of EVIDENCE, of rows seen through the other half's dictionaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = {}
        for batch in batches:
            out = []
            for half, text in zip(*(batch.column(i).to_pylist() for i in (1, 3))):
                if half not in made:
                    made[half] = [Scorer(common[1 - half], words + common[1 - half]) for words in contents[1 - half]]
                out.append([float(x) for scorer in made[half] for x in scorer.features(normal(text))])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "half", "label", "text").mapInArrow(run, f"doc_id {kind}, label int, x array<double>").toPandas().sort_values("doc_id")
    x = np.array(found["x"].tolist()).reshape(len(found), len(EVIDENCE), -1)
    return found["label"].to_numpy(), [x[:, level] for level in range(len(EVIDENCE))]


def fit(rows: DataFrame, share: float | None = None) -> Model | None:
    """Fitted on rows (doc_id, text, label); None unless both labels occur.

    The calibration sees each half of the rows through dictionaries of the other half,
    and chooses the level of EVIDENCE. ``share`` is the toxic share of the population,
    where the rows are not a plain sample of it.
    """
    if rows.select("label").distinct().count() < 2:
        return None
    rows = rows.select("doc_id", "text", F.col("label").cast("int").alias("label"), F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half"))
    contents, common = _characteristic(rows), _common(rows)
    y, features = _measured(rows, common, contents)
    tried = [(*_calibrated(x, y), level) for level, x in enumerate(features)]
    _, weights, level = min(tried, key=lambda t: t[0])
    if share is not None and 0 < share < 1:
        weights[0] += np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
    return Model(common[_ALL], contents[_ALL][level] + common[_ALL], tuple(map(float, weights)))


_scorers: dict[str, Scorer] = {}  # one per Python worker and model


def toxicity(text: Column, model: Model | None) -> Column:
    """Score from 0 to 1, higher: likelier toxic. Null and empty texts have one window-free score.

    Without a model (labels of one kind only) every score is 0.
    """
    if model is None:
        return F.lit(0.0)
    key = uuid.uuid4().hex

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if key not in _scorers:
            _scorers.clear()
            _scorers[key] = Scorer(model.ordinary, model.toxic, model.weights)
        for batch in texts:
            yield pa.array((_scorers[key].score(t.as_py()) for t in batch), pa.float64())

    return score(text)


def trained(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model | None:
    """A model of the labelled rows outside the held-out fold, ``per_class`` of each label at most, whole texts.

    Null ids and texts and doubtful labels are left out (see ``training_rows``), repeated rows
    count once, and no columns but doc_id, text and the label are read. None without both labels.
    """
    rows, share = training_rows(docs, labels, "toxic", per_class)
    return fit(rows, share)
