"""Secret scan: three known shapes, and a randomness test battery, by DataFrame functions alone.

Known shapes are regular expressions. Other long tokens are tested. The token's
characters give its encoding (hexadecimal, base 32, 36, 62, 64, letters alone), and
three statistics are taken over that alphabet: chi-squared against equal frequencies,
the number of runs of character classes, and the lag-1 serial correlation of places in
the alphabet. A secret must pass two questions:

* it is not rejected as random (no test below ``RANDOM_LEVEL``, two-sided), and
* it is rejected as ordinary text: each statistic has a p-value under the figures of
  written text, which shrinks with the token's length; the three are combined by the
  Cauchy rule, which allows for their dependence, and the false discovery rate over
  all tested tokens of the table is held at ``FDR`` by Benjamini and Hochberg's rule
  with weights in proportion to the length (up to 64), so that short tokens need more
  evidence. The rule is applied to a histogram of at most some 80 bins.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.storage import stage

FDR, RANDOM_LEVEL = 0.001, 0.001
KINDS = ("assign", "access", "hex", "random")
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
_BLOCK = 256
_BINS_PER_DECADE = 4

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Encodings in the order they are tried: characters, alphabet, and the figures of written text
# over it: sum of squared frequencies, rate of class changes, serial correlation (None: no test).
ENCODINGS = (
    ("[0-9a-f]+", _DIGITS + "abcdef", 0.11, 0.15, None),
    ("[0-9A-F]+", _DIGITS + "ABCDEF", 0.11, 0.15, None),
    ("[a-z]+", _LOWER, 0.066, 0.60, None),
    ("[A-Z]+", _UPPER, 0.066, 0.60, None),
    ("[A-Z2-7]+", _UPPER + "234567", 0.066, 0.15, 0.4),
    ("[a-z0-9]+", _LOWER + _DIGITS, 0.066, 0.15, 0.4),
    ("[A-Z0-9]+", _UPPER + _DIGITS, 0.066, 0.15, 0.4),
    ("[A-Za-z]+", _UPPER + _LOWER, 0.055, 0.35, None),
    ("[A-Za-z0-9]+", _UPPER + _LOWER + _DIGITS, 0.050, 0.15, 0.4),
    ("[A-Za-z0-9+/]+", _UPPER + _LOWER + _DIGITS + "+/", 0.050, 0.15, 0.4),
    ("[A-Za-z0-9_-]+", _UPPER + _LOWER + _DIGITS + "-_", 0.050, 0.15, 0.4),
    ("[A-Za-z0-9+/_-]+", _UPPER + _LOWER + _DIGITS + "+/-_", 0.050, 0.15, 0.4),
)
_VOWELS = "aeiouAEIOU"


def class_of_letters(alphabet: str) -> str:
    """Class of each character of an alphabet, as a digit at its place."""
    if alphabet in (_LOWER, _UPPER):
        return "".join("0" if c in _VOWELS else "1" for c in alphabet)
    return "".join("0" if c in _DIGITS else "1" if c in _LOWER else "2" if c in _UPPER else "3" for c in alphabet)


def random_change_rate(alphabet: str) -> float:
    """Chance that two random characters of the alphabet differ in class."""
    classes = class_of_letters(alphabet)
    return 1 - sum((classes.count(c) / len(classes)) ** 2 for c in set(classes))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _starts(gaps: Column, matches: Column) -> Column:
    """Places of matches, from the pieces of text before each of them.

    Lengths are summed by blocks first, so the work grows far less than with the
    square of the number of matches.
    """

    def placed(lengths: Column, before: Column) -> Column:
        def within(i: Column) -> Column:
            block = F.floor(i / _BLOCK).cast("int")
            inside = F.slice(lengths, block * _BLOCK + 1, i - block * _BLOCK)
            return _sum(F.slice(before, F.lit(1), block)) + _sum(inside) + F.length(F.element_at(gaps, i + 1))

        return F.transform(F.sequence(F.lit(0), F.size(matches) - 1), within)

    def blocks(lengths: Column) -> Column:
        last = F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: _sum(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))))

    lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda g, m: (F.length(g) + F.length(m)).cast("bigint"))
    return _let(lengths, lambda ls: _let(blocks(ls), lambda before: placed(ls, before)))


def found(text: Column, pattern: str, value_group: int = 0) -> Column:
    """All matches in order: array of (start, end, match, value)."""
    parts = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("values"),
        F.split(text, pattern, -1).alias("gaps"),
    )

    def spans(p: Column) -> Column:
        zipped = F.arrays_zip(_starts(p["gaps"], p["matches"]).alias("start"), p["matches"].alias("match"), p["values"].alias("value"))
        return F.transform(
            zipped,
            lambda x: F.struct(
                x["start"].cast("int").alias("start"),
                (x["start"] + F.length(x["match"])).cast("int").alias("end"),
                x["match"].alias("match"),
                x["value"].alias("value"),
            ),
        )

    none = F.array().cast("array<struct<start:int,end:int,match:string,value:string>>")
    return F.when(text.rlike(pattern), _let(parts, spans)).otherwise(none)


def _upper_tail(z: Column) -> Column:
    """P(Z >= z) of a standard normal; a rational approximation with small relative error."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * series
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _statistics(token: Column) -> Column:
    """Struct (n, chi, changes, serial, and the figures of the encoding) of a token."""
    body = F.regexp_replace(token, "=+$", "")

    def figure(pick) -> Column:
        out = None
        for pattern, *rest in ENCODINGS:
            value = F.lit(pick(*rest))
            here = body.rlike(f"^{pattern}$")
            out = F.when(here, value) if out is None else out.when(here, value)
        return out

    alphabet = figure(lambda a, *_: a)
    classes = figure(lambda a, *_: class_of_letters(a))

    def stats(v: Column) -> Column:
        chars = F.split(v["body"], "")
        places = F.transform(chars, lambda c: F.instr(v["alphabet"], c).cast("double"))
        n = F.length(v["body"]).cast("double")
        squares = F.aggregate(
            F.array_distinct(chars),
            F.lit(0.0),
            lambda a, c: a + F.pow(n - F.length(F.replace(v["body"], c, F.lit(""))), F.lit(2.0)),
        )
        marks = F.transform(places, lambda p: F.substring(v["classes"], p.cast("int"), F.lit(1)))

        def pairs(values: Column) -> Column:
            return F.zip_with(F.slice(values, F.lit(1), F.size(values) - 1), F.slice(values, F.lit(2), F.size(values) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

        changes = F.aggregate(pairs(marks), F.lit(0.0), lambda s, p: s + F.when(p["a"] != p["b"], 1.0).otherwise(0.0))
        mean = F.aggregate(places, F.lit(0.0), lambda s, p: s + p) / n
        spread = _let(mean, lambda m: F.aggregate(places, F.lit(0.0), lambda s, p: s + (p - m) * (p - m)))
        shared = _let(mean, lambda m: F.aggregate(pairs(places), F.lit(0.0), lambda s, p: s + (p["a"] - m) * (p["b"] - m)))
        size = F.length(v["alphabet"]).cast("double")
        return F.struct(
            n.alias("n"),
            size.alias("k"),
            (size / n * squares - n).alias("chi"),
            changes.alias("changes"),
            F.when(spread > 0, shared / spread).otherwise(F.lit(1.0)).alias("serial"),
            v["squares"].alias("squares"),
            v["change"].alias("change"),
            v["random_change"].alias("random_change"),
            v["text_serial"].alias("text_serial"),
        )

    shape = F.struct(
        body.alias("body"),
        alphabet.alias("alphabet"),
        classes.alias("classes"),
        figure(lambda a, squares, *_: squares).alias("squares"),
        figure(lambda a, s, change, r: change).alias("change"),
        figure(lambda a, *_: random_change_rate(a)).alias("random_change"),
        figure(lambda a, s, c, serial: serial).cast("double").alias("text_serial"),
    )
    return _let(shape, lambda v: _let(v, stats))


def _evidence(s: Column) -> Column:
    """Struct (weight, random, score): whether a token may be random, and -log10 of the weighted p-value as text."""
    n, k = s["n"], s["k"]
    third = F.lit(RANDOM_LEVEL / 3)
    # As random characters: Wilson and Hilferty for chi-squared, normal for the other two.
    cube = F.pow(s["chi"] / (k - 1), F.lit(1 / 3))
    p_chi = _upper_tail((cube - (1 - 2 / (9 * (k - 1)))) / F.sqrt(2 / (9 * (k - 1))))
    rate = s["random_change"]
    p_runs = 2 * _upper_tail(F.abs(s["changes"] - (n - 1) * rate) / F.sqrt((n - 1) * rate * (1 - rate)))
    p_serial = 2 * _upper_tail(F.abs(s["serial"] + 1 / n) * F.sqrt(n))
    random = (p_chi >= third) & (p_runs >= third) & (p_serial >= third)
    # As written text: noncentral chi-squared, class changes and serial correlation at the rates of text.
    off = n * (k * s["squares"] - 1)
    t_chi = _upper_tail((k - 1 + off - s["chi"]) / F.sqrt(2 * (k - 1) + 4 * off))
    letters = s["change"] > 0.5  # vowels and consonants alternate in text: fewer changes speak for chance
    gap = (s["changes"] - (n - 1) * s["change"]) / F.sqrt((n - 1) * s["change"] * (1 - s["change"]))
    t_runs = _upper_tail(F.when(letters, -gap).otherwise(gap))

    def fisher(r: Column) -> Column:
        return 0.5 * F.log((1 + r) / (1 - r))

    bounded = F.greatest(F.least(s["serial"], F.lit(0.999)), F.lit(-0.999))
    t_serial = _upper_tail((fisher(s["text_serial"]) - fisher(bounded)) * F.sqrt(n - 3))

    def cauchy(p: Column) -> Column:
        return F.tan((0.5 - F.greatest(F.least(p, F.lit(1 - 1e-12)), F.lit(1e-15))) * math.pi)

    total = F.when(s["text_serial"].isNull(), (cauchy(t_chi) + cauchy(t_runs)) / 2).otherwise((cauchy(t_chi) + cauchy(t_runs) + cauchy(t_serial)) / 3)
    # 0.5 - atan(x) / pi loses all digits for large x, where it is 1 / (pi x).
    p = F.when(total > 1e6, 1 / (math.pi * total)).otherwise(F.greatest(0.5 - F.atan(total) / math.pi, F.lit(1e-15)))
    weight = F.least(n, F.lit(64.0))
    return F.struct(weight.alias("weight"), random.alias("random"), (F.log10(weight) - F.log10(p)).alias("score"))


def tested(token: Column) -> Column:
    """The evidence of one token, as a struct (weight, random, score)."""
    return _let(_statistics(token), _evidence)


def _cutoff(tests: DataFrame, fdr: float) -> float:
    """Least score of a discovery, from the columns ``score`` and ``weight`` of all tests."""
    bins = tests.groupBy(F.floor(F.least("score", F.lit(20.0)) * _BINS_PER_DECADE).cast("int").alias("bin"))
    rows = sorted(bins.agg(F.count("*").alias("n"), F.sum("weight").alias("weight")).collect(), key=lambda r: -r["bin"])
    total = sum(r["weight"] for r in rows)  # number of tests times their mean weight
    cutoff, above = math.inf, 0
    for r in rows:
        above += r["n"]
        edge = r["bin"] / _BINS_PER_DECADE
        if 10**-edge <= fdr * above / total:
            cutoff = edge
    return cutoff


def _span(kind: int, start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """One row per document: doc_id and ``spans``, an array of (start, kind, end).

    Kinds number KINDS. The spans of the three known shapes always stay; a random token
    is added where it overlaps none of them. A null text counts as empty and has no
    span; repeated rows stay; without any tested token there is nothing to add. Places
    count code points, ends are exclusive. Only the two named columns are read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    shapes = [
        F.transform(F.filter(found(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= 6), lambda m: _span(0, m["start"], m["end"])),
        F.transform(found(text, ACCESS), lambda m: _span(1, m["start"], m["end"])),
        F.transform(found(text, HEX), lambda m: _span(2, m["start"], m["end"])),
    ]
    digits = "^[0-9]+=*$"  # a long number is no secret
    tokens = F.filter(found(text, TOKEN), lambda m: ~m["match"].rlike(digits))
    tests = F.transform(tokens, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), tested(m["match"]).alias("test")))
    seen = docs.select(F.col(id_col).alias("doc_id"), F.concat(*shapes).alias("base"), tests.alias("tests"))
    seen = stage(seen, "secrets")
    each = seen.select(F.explode("tests.test").alias("t")).select("t.score", "t.weight")
    cutoff = _cutoff(each, fdr)
    free = F.filter(
        F.filter("tests", lambda t: t["test"]["random"] & (t["test"]["score"] >= F.lit(cutoff))),
        lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    added = F.transform(free, lambda t: _span(3, t["start"], t["end"]))
    return seen.select("doc_id", F.array_sort(F.concat("base", added)).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    shown = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(shown, ",")
