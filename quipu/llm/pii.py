"""Personal data: four known shapes, and a skip-chain conditional random field over what else looks alike.

The shapes give spans that always stay. Every further stretch of a text that looks like a
number with many digits, or like a written-out address, is a node, and so are the spans of
the shapes, whose labels are known. Neighbours in the text are linked (the chain), and so
are distant nodes that repeat each other or agree in their last digits or in their address
name (the skips). Loopy belief propagation passes the known labels along both kinds of
links, so that a telephone number that is given in full once is also found where it is
repeated without its country code.

Nothing is labelled by hand, the known shapes are the labels: the node weights are a softmax
regression on shape features of a bounded sample of the documents with a known shape. The
links have a table of potentials each, label by label, from counts over all documents: along
the chain how much oftener two labels are neighbours than by chance, for the skips which
labels a node of some kind repeats as. Both are counted from whole texts in the tasks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.storage import stage

SAMPLE = 3_000  # documents whose nodes are fitted on, at most
THRESHOLD, ROUNDS = 0.5, 15
KINDS = ("email", "ip", "card", "phone")
_OTHER = len(KINDS)  # the label of a node that is no personal data
_NODE_BOUND, _CHAIN_BOUND, _SKIP_BOUND = 4.0, 1.0, 8.0
_LEAST_SHARE = 1e-4  # added to the shares of agreeing and other links

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match always starts at the first digit of a run, and takes runs whole.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NUMBER = re.compile(r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[\x20().\-/]{0,2}[0-9])++")
_WRITTEN = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}){0,8}")
_MIN_DIGITS, _KEY_DIGITS, _MOST_DIGITS = 7, 7, 19
_GROUP = re.compile(r"[0-9]+")


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number holds."""
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Addresses, found from each @ outwards, so that a long run without one costs nothing."""
    spans, last, sign = [], 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, sign + 1) if start < sign else None
        if domain:
            spans.append((start, domain.end()))
            last = domain.end()
        sign = text.find("@", max(sign + 1, last))
    return spans


def known(text: str) -> list[tuple[int, int, int]]:
    """Spans (start, kind, end) of the four shapes, in order."""
    spans = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
                spans.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                spans.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m[0])) <= 15:
                    spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def _numbers(text: str) -> Iterator[tuple[int, int]]:
    """Stretches that look like one number; one of more digits than any number has is cut between its groups."""
    for m in _NUMBER.finditer(text):
        start, end, digits = m.start(), m.start(), 0
        for group in _GROUP.finditer(text, m.start(), m.end()):
            n = group.end() - group.start()
            if digits and digits + n > _MOST_DIGITS:
                yield start, end
                start, digits = group.start(), 0
            end, digits = group.end(), digits + n
        yield start, end


def nodes_of(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Nodes (start, label, end) in order: the known spans, and the unlabelled (-1) stretches clear of them."""
    found = []
    if _DIGIT.search(text):
        for start, end in _numbers(text):
            if end - start >= _MIN_DIGITS and not text[end : end + 1].isalnum() and len(_digits(text[start:end])) >= _MIN_DIGITS:
                found.append((start, end))
    if "@" in text or "(at)" in text or "[at]" in text:
        found += [m.span() for m in _WRITTEN.finditer(text)]
    nodes, last, at = list(base), 0, 0
    covered = sorted((a, b) for a, _, b in base)
    for start, end in sorted(found):
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        clear = all(a >= end or b <= start for a, b in covered[max(at - 1, 0) : at + 4])
        if start >= last and clear:
            nodes.append((start, -1, end))
            last = end
    return sorted(nodes)


_SHAPES = 14
_SURE = [1, 3, 6, 8]  # an @, a plus, four parts up to 255, a right check digit


def shape(text: str) -> np.ndarray:
    """Features of the look of a node."""
    d = _digits(text)
    parts = text.split(".")
    letters = sum(map(str.isalpha, text))
    x = np.zeros(_SHAPES)
    x[0] = 1
    x[1] = "@" in text
    x[2] = letters > 0
    x[3] = text.startswith("+")
    x[4] = "(" in text
    x[5] = len(parts) == 4
    x[6] = len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    x[7] = 14 <= len(d) <= 19
    x[8] = 14 <= len(d) <= 19 and luhn(d)
    x[9] = 10 <= len(d) <= 13
    x[10] = len(d) > 19
    x[11] = "-" in text
    x[12] = " " in text
    x[13] = text.isdigit()
    return x


def keys(text: str) -> set[str]:
    """What a node shares with the nodes that repeat it or look like it."""
    found = {"=" + text.lower()}
    d = _digits(text)
    if "@" in text or "at)" in text or "at]" in text:
        found.add("@" + re.split(r"\x20?(?:@|\(at\)|\[at\])", text.lower())[0])
    elif len(d) >= _KEY_DIGITS:
        found |= {"#" + d, "#" + d[-_KEY_DIGITS:]}
    return found


def links_of(text: str, nodes: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Links (i, j, kind): 0 along the chain, 1 to the nearest earlier node with a common key, and to the nearest known one.

    Each node starts a few links only, so their number grows with the nodes.
    """
    found = [(i, i + 1, 0) for i in range(len(nodes) - 1)]
    skips: set[tuple[int, int]] = set()
    for way in (range(len(nodes)), range(len(nodes) - 1, -1, -1)):
        last: dict[str, int] = {}
        last_known: dict[str, int] = {}
        for i in way:
            start, label, end = nodes[i]
            for key in keys(text[start:end]):
                for seen in (last, last_known):
                    if key in seen:
                        skips.add((min(i, seen[key]), max(i, seen[key])))
                last[key] = i
                if label >= 0:
                    last_known[key] = i
    return found + [(i, j, 1) for i, j in sorted(skips)]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # shape features by label
    tables: tuple[np.ndarray, np.ndarray]  # log potentials by both labels: of the links of the chain, and of the skips

    @property
    def strength(self) -> tuple[float, float]:
        """How much agreement is worth, along the chain and over the skips, for the kind where it is worth most."""
        chain, skip = (float(np.diag(t)[:_OTHER].max()) for t in self.tables)
        return chain, skip

    def potentials(self, shapes: np.ndarray) -> np.ndarray:
        z = shapes @ self.weights
        z -= z.max(axis=1, keepdims=True)
        return np.maximum(z, -_NODE_BOUND)


def marginals(node: np.ndarray, links: list[tuple[int, int, int]], tables: tuple, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities by loopy belief propagation; ``node`` holds log potentials.

    ``tables`` has a symmetric matrix of log potentials for each kind of link, or a number that agreement is worth.
    """
    n, k = node.shape
    i = np.array([a for a, b, _ in links] + [b for a, b, _ in links], int)
    j = np.array([b for a, b, _ in links] + [a for a, b, _ in links], int)
    worth = np.exp(np.array([t * np.eye(k) if np.ndim(t) == 0 else t for t in tables]))
    kinds = np.array([kind for _, _, kind in links] * 2, int)
    back = np.concatenate((np.arange(len(links)) + len(links), np.arange(len(links))))
    message = np.zeros((2 * len(links), k))  # log, from i to j
    for _ in range(rounds):
        belief = node.copy()
        np.add.at(belief, j, message)
        out = belief[i] - message[back]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        new = np.zeros_like(message)
        for kind, table in enumerate(worth):
            new[kinds == kind] = np.log(out[kinds == kind] @ table)
        new -= new.max(axis=1, keepdims=True)
        if len(new) == 0 or np.abs(new - message).max() < 1e-6:
            message = new
            break
        message = 0.5 * (message + new)  # damped, so that loops settle
    belief = node.copy()
    np.add.at(belief, j, message)
    belief = np.exp(belief - belief.max(axis=1, keepdims=True))
    return belief / belief.sum(axis=1, keepdims=True)


def spans_of(text: str | None, model: Model | None) -> list[tuple[int, int, int, bool]]:
    """All spans (start, kind, end, known): those of the shapes, and nodes whose likeliest label is a kind."""
    base = known(text or "")
    sure = [(*span, True) for span in base]
    if model is None:
        return sure
    nodes = nodes_of(text or "", base)
    if all(label >= 0 for _, label, _ in nodes):
        return sure
    potentials = model.potentials(np.array([shape(text[a:b]) for a, _, b in nodes]))
    for row, (_, label, _) in zip(potentials, nodes):
        if label >= 0:
            row[:] = -30.0
            row[label] = 0.0
    found = marginals(potentials, links_of(text, nodes), model.tables)
    best = found.argmax(axis=1)
    added = [
        (a, int(kind), b, False)
        for (a, label, b), kind, share in zip(nodes, best, found.max(axis=1))
        if label < 0 and kind != _OTHER and share >= THRESHOLD
    ]
    return sorted(sure + added)


_Look = tuple[int, int]  # features as bits, and the label
_LABELS = len(KINDS) + 1
_PAIRS = 2 * _LABELS * _LABELS


def _place(kind: int, a: int, b: int) -> int:
    return (kind * _LABELS + a) * _LABELS + b


def pair_tables(pairs: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Log potentials of chain and skips from counts of joined labels; shares, so that they do not grow with the table.

    Chain: how much oftener two labels are neighbours than by chance. Skips: the share of the
    links from a kind that lead to a kind, against almost none; that both ends are other is worth as much
    as that both are of a kind, so that a link alone says nothing.
    """
    chain, skip = np.array(pairs, float).reshape(2, _LABELS, _LABELS)
    total = max(chain.sum(), 1)
    ends = chain.sum(axis=1) / total
    near = np.log((chain / total + _LEAST_SHARE) / (np.outer(ends, ends) + _LEAST_SHARE))
    share = skip / np.maximum(skip.sum(axis=1, keepdims=True), 1)
    far = np.log((np.maximum(share, share.T) + _LEAST_SHARE) / _LEAST_SHARE)
    far[_OTHER, _OTHER] = np.diag(far)[:_OTHER].max()
    return np.clip(near, -_CHAIN_BOUND, _CHAIN_BOUND), np.minimum(far, _SKIP_BOUND)


def evidence(text: str | None) -> tuple[Counter[_Look], list[int]] | None:
    """The looks of a text's nodes, and how often its links join which labels. None without a known span.

    Links are counted from both ends, in a table for the chain and one for the skips, row by
    row. In the chain a node without a known label counts as other; of the skips only those between known spans count,
    as the others are what is to be found out.
    """
    base = known(text or "")
    if not base:
        return None
    nodes = nodes_of(text, base)
    looks = Counter((int(shape(text[a:b]) @ (1 << np.arange(_SHAPES))), label if label >= 0 else _OTHER) for a, label, b in nodes)
    pairs = [0] * _PAIRS
    for i, j, kind in links_of(text, nodes):
        a, b = nodes[i][1], nodes[j][1]
        if kind == 0 or (a >= 0 and b >= 0):
            a, b = (_OTHER if x < 0 else x for x in (a, b))
            pairs[_place(kind, a, b)] += 1
            pairs[_place(kind, b, a)] += 1
    return looks, pairs


def fit(texts: list[str], ridge: float = 1.0, steps: int = 200) -> Model | None:
    """Node weights and link tables of texts; None without any known span."""
    found = [e for e in map(evidence, texts) if e]
    return fitted(sum((e[0] for e in found), Counter()), [sum(e[1][k] for e in found) for k in range(_PAIRS)], ridge, steps)


def fitted(counts: Counter[_Look], pairs: list[int], ridge: float = 1.0, steps: int = 200) -> Model | None:
    """Node weights of counted looks, and the tables of the links; None without a known span."""
    seen = sorted(counts)
    if all(label == _OTHER for _, label in seen):
        return None
    x = np.array([[code >> i & 1 for i in range(_SHAPES)] for code, _ in seen], float)
    y, n = np.array([label for _, label in seen]), np.array([counts[look] for look in seen], float)
    # A look that lacks what makes its kind sure counts as other, so that by itself it stays
    # doubtful and only a link can decide; so does every single feature.
    bare = x[y != _OTHER].copy()
    bare[:, _SURE] = 0
    n = np.concatenate((n, n[y != _OTHER], np.full(_SHAPES, 2.0)))
    x = np.concatenate((x, bare, np.eye(_SHAPES)))
    y = np.concatenate((y, np.full(len(bare) + _SHAPES, _OTHER)))
    w = np.zeros((_SHAPES, len(KINDS) + 1))
    target = np.eye(len(KINDS) + 1)[y]
    rate = 4.0 / (n.sum() * max((x**2).sum(axis=1).max(), 1) / 2 + ridge)
    for _ in range(steps):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        w += rate * (x.T @ ((target - p) * n[:, None]) - ridge * w)
    return Model(w, pair_tables(pairs))


_EVIDENCE = "struct<looks:array<struct<code:int,label:int,n:bigint>>,pairs:array<bigint>>"


def _evidence(text: Column) -> Column:
    kind = pa.struct([("looks", pa.list_(pa.struct([("code", pa.int32()), ("label", pa.int32()), ("n", pa.int64())]))), ("pairs", pa.list_(pa.int64()))])

    @F.arrow_udf(_EVIDENCE)
    def build(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = (evidence(t.as_py()) for t in batch)
            yield pa.array([e and {"looks": [{"code": c, "label": k, "n": n} for (c, k), n in sorted(e[0].items())], "pairs": e[1]} for e in found], kind)

    return build(text)


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE) -> Model | None:
    """A model of the documents that hold a known shape: links of all of them, nodes of at most ``most``, chosen by a digest of the id.

    Null and empty texts hold nothing; rows that repeat an id count each for its links and once for
    its nodes. Only the two named columns are read. None if no document holds a known shape.
    """
    text = F.col(text_col)
    held = docs.filter(text.rlike("[0-9@]")).select(F.col(id_col).alias("doc_id"), _evidence(text).alias("found"))
    held = stage(held.filter("found is not null").select("doc_id", "found.*"), "evidence")
    pairs = held.agg(*[F.coalesce(F.sum(F.col("pairs")[k]), F.lit(0)) for k in range(_PAIRS)]).first()
    each = held.groupBy("doc_id").agg(F.max("looks").alias("looks"))  # a repeated id is drawn once
    turn = F.md5(F.concat(F.lit("fit:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    drawn = each.orderBy(turn, "doc_id").limit(most).select(F.explode("looks").alias("look"))
    looks = drawn.groupBy("look.code", "look.label").agg(F.sum("look.n").alias("n")).collect()  # bounded by the number of looks
    return fitted(Counter({(r["code"], r["label"]): r["n"] for r in looks}), list(pairs))


_SPANS = "array<struct<start:int,kind:int,end:int,known:boolean>>"
_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("known", pa.bool_())]))


def personal_data(text: Column, model: Model | None) -> Column:
    """Spans of a text, as an array of (start, kind, end, known); kinds number KINDS.

    Places count code points, ends are exclusive. A null text counts as empty and has no
    spans. Without a model (no known span in the table) only the known shapes are found.
    """

    @F.arrow_udf(_SPANS)
    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = (spans_of(t.as_py(), model) for t in batch)
            yield pa.array([[dict(zip(("start", "kind", "end", "known"), s)) for s in spans] for spans in found], _ARROW)

    return find(text)


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    shown = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(shown, ",")
