import math
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from quipu.llm import secrets

SCHEMA = "doc_id long, text string, spans string, base int, tests string"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_base(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def plain_evidence(token):
    """The battery by plain loops: (may be random, -log10 p + log10 weight)."""
    body = token.rstrip("=")
    pattern, alphabet, squares, change, serial0 = next(e for e in secrets.ENCODINGS if re.fullmatch(e[0], body))
    n, k = len(body), len(alphabet)
    tail = lambda z: 0.5 * math.erfc(z / math.sqrt(2))
    chi = k / n * sum(body.count(c) ** 2 for c in set(body)) - n
    classes = secrets.class_of_letters(alphabet)
    marks = [classes[alphabet.index(c)] for c in body]
    changes = sum(a != b for a, b in zip(marks, marks[1:]))
    places = [alphabet.index(c) + 1 for c in body]
    mean = sum(places) / n
    spread = sum((p - mean) ** 2 for p in places)
    serial = sum((a - mean) * (b - mean) for a, b in zip(places, places[1:])) / spread if spread else 1.0
    rate = 1 - sum((classes.count(c) / k) ** 2 for c in set(classes))
    random_p = [
        tail(((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))),
        2 * tail(abs(changes - (n - 1) * rate) / math.sqrt((n - 1) * rate * (1 - rate))),
        2 * tail(abs(serial + 1 / n) * math.sqrt(n)),
    ]
    off = n * (k * squares - 1)
    gap = (changes - (n - 1) * change) / math.sqrt((n - 1) * change * (1 - change))
    text_p = [tail((k - 1 + off - chi) / math.sqrt(2 * (k - 1) + 4 * off)), tail(-gap if change > 0.5 else gap)]
    if serial0 is not None:
        text_p.append(tail((math.atanh(serial0) - math.atanh(max(min(serial, 0.999), -0.999))) * math.sqrt(n - 3)))
    cauchy = sum(math.tan((0.5 - max(min(p, 1 - 1e-12), 1e-15)) * math.pi) for p in text_p) / len(text_p)
    p = 1 / (math.pi * cauchy) if cauchy > 1e6 else max(0.5 - math.atan(cauchy) / math.pi, 1e-15)
    return all(q >= secrets.RANDOM_LEVEL / 3 for q in random_p), math.log10(min(n, 64)) - math.log10(p)


def tokens():
    rng = random.Random(3)
    sets = [string.ascii_letters + string.digits, "0123456789abcdef", string.ascii_lowercase, string.ascii_uppercase + "234567", string.ascii_letters + string.digits + "+/"]
    found = ["".join(rng.choice(s) for _ in range(n)) for s in sets for n in (20, 23, 40, 90)]
    found += ["donaudampfschifffahrtsgesellschaft", "the-end-of-the-road-2020", "/usr/share/documentation/readme", "a" * 30, "ab" * 15 + "=="]
    return found


def test_battery_against_plain_loops(spark):
    found = tokens()
    rows = spark.createDataFrame([(t,) for t in found], "t string").select("t", secrets.tested(F.col("t")).alias("e")).collect()
    for r in rows:
        random_, score = plain_evidence(r["t"])
        assert r["e"]["random"] == random_, r["t"]
        assert r["e"]["score"] == pytest.approx(score, abs=0.02), r["t"]


TEXTS = [
    None, "", "no secrets", "password=abcdef", "PassWd : 'abc123'", "secret: token: abcdefgh", "api_key==xyz.123", "apikey=ab", "toKen=ſecret12", "ſecret=abcdef",
    "AKIA" + "A1" * 8, "xAKIAAKIA" + "B" * 20, "AKIA123", "é " + "0123456789abcdef" * 2 + " z", "F" + "a" * 24 + "g" + "b" * 23, "password=" + "ab12" * 10,
    "a password=aaaaaa" * 700, "\U0001f600 token=\"abcdef\"\n", "k " + "token=abcdef " * 3 + "AKIA" + "Z" * 16,
]


def test_spans_against_plain_search(spark):
    rng = random.Random(8)
    secret = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(40))
    texts = [*TEXTS, f"é key {secret}, end", f"password={secret}", *[f"word{i} Donaudampfschifffahrtsgesellschaft" for i in range(30)]]
    rows = [(i if i else None, t, "clash", 1, "x") for i, t in enumerate(texts)]
    rows += rows[3:5]
    found = secrets.secrets(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(str, (r["doc_id"] for r in found))) == sorted(map(str, (r[0] for r in rows)))
    by_id = {r["doc_id"]: r["spans"] for r in found}
    for i, text, *_ in rows:
        base = [tuple(s) for s in by_id[i] if s["kind"] < 3]
        assert base == plain_base(text or ""), text and text[:60]
    added = {(i, *s) for i, spans in by_id.items() for s in map(tuple, spans) if s[1] == 3}
    at = texts.index(f"é key {secret}, end")
    assert added == {(at, 6, 3, 46)}


def test_false_discoveries_are_held_and_short_tokens_need_more(spark):
    rng = random.Random(9)
    draw = lambda n: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
    syllables = ["ung", "heit", "schaft", "keit", "ver", "be", "ein", "lich", "ster", "gan", "mo"]
    prose = [(1000 + i, " ".join("".join(rng.choice(syllables) for _ in range(7)) for _ in range(20))) for i in range(60)]
    planted = [(i, f"see {draw(40)} there") for i in range(40)]
    rows = [(i, t, "", 0, "") for i, t in prose + planted]
    found = {r["doc_id"]: len(r["spans"]) for r in secrets.secrets(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(found[i] for i, _ in planted) >= 38
    assert sum(found[i] for i, _ in prose) <= 1


def test_empty_table_and_listing(spark):
    empty = secrets.secrets(spark.createDataFrame([], SCHEMA))
    assert empty.select("doc_id", secrets.listed(F.col("spans"))).count() == 0
    one = spark.createDataFrame([(1, "token=abcdef AKIA" + "Q" * 16, "", 0, "")], SCHEMA)
    assert secrets.secrets(one).select(secrets.listed(F.col("spans"))).first()[0] == "assign:0:12,access:13:33"
