import random
import re

import numpy as np
from pyspark.sql import functions as F

from quipu.llm import pii

SCHEMA = "doc_id long, text string, spans string, known int"
PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def plain_known(text):
    spans = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                kind == 0
                or (kind == 1 and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == 2 and 14 <= len(digits) <= 19 and plain_luhn(digits))
                or (kind == 3 and 10 <= len(digits) <= 15)
            )
            if good:
                spans.append((m.start(), kind, m.end()))
    return sorted(spans)


def test_known_shapes_against_plain_search():
    rng = random.Random(2)
    texts = ["a@b.c", "a@@b.c", "a@b c@d.e.f,", "x@y.z@u.v", "@a.b", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.02.3.255", "+1 (808) 555-1705", "++12345678901", "4652 2885-2408 6166", "é 4652288524086166é"]
    for _ in range(3000):
        texts.append("".join(rng.choice("ab@.-+12 903()é%") for _ in range(rng.randrange(40))))
    for _ in range(300):
        texts.append("".join(rng.choice("0123456789 -") for _ in range(60)))
    for text in texts:
        assert pii.known(text) == plain_known(text), text


def test_long_runs_take_no_quadratic_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "1 " * 150_000 + "x", "@" * 100_000, "+1" * 100_000, "1" * 5000 + ".1.1.1"):
        assert pii.spans_of(text, None) == [] or text.startswith("1.")


def test_belief_propagation_is_exact_on_a_tree_and_settles_on_loops():
    rng = np.random.default_rng(1)
    node = rng.normal(size=(4, 5))
    strength = (0.7, 2.0)
    tree = [(0, 1, 0), (1, 2, 1), (1, 3, 0)]
    joint = np.zeros((5,) * 4)
    for state in np.ndindex(joint.shape):
        z = sum(node[i, s] for i, s in enumerate(state))
        joint[state] = np.exp(z + sum(strength[k] * (state[i] == state[j]) for i, j, k in tree))
    joint /= joint.sum()
    for i in range(4):
        exact = joint.sum(axis=tuple(j for j in range(4) if j != i))
        assert np.allclose(pii.marginals(node, tree, strength, rounds=100)[i], exact, atol=1e-4)
    loop = pii.marginals(node, [*tree, (2, 3, 1), (0, 3, 1)], strength, rounds=100)
    assert np.allclose(loop.sum(axis=1), 1)
    assert pii.marginals(node[:1], [], strength).shape == (1, 5)


def corpus():
    rng = random.Random(5)
    texts = []
    for i in range(300):
        phone = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        card = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        card += next(d for d in "0123456789" if plain_luhn(card + d))
        mail = f"user{i}.{rng.randrange(99)}@mail{i % 9}.example.com"
        texts.append(f"first {phone} then {phone} and {card} or {card}; {mail} {mail} 10.{i % 250}.3.4 10.{i % 250}.3.4 no {rng.randrange(10**8)}")
    return texts


def test_repeats_and_likenesses_get_the_label_and_strangers_none():
    model = pii.fit(corpus())
    text = "Call +1 (808) 555-1705, later (808) 555-1705; card 4652288524086166 or 4652.2885.2408.6166; me@x.org, me (at) x.org"
    shown = [(pii.KINDS[k], text[a:b], sure) for a, k, b, sure in pii.spans_of(text, model)]
    assert ("phone", "(808) 555-1705", False) in shown
    assert ("card", "4652.2885.2408.6166", False) in shown
    assert ("email", "me (at) x.org", False) in shown
    assert [s[2] for s in shown].count(True) == 3
    for clean in ("order 4652288524086167", "2024-01-02 10:11:12", "call (808) 555-1705", "you (at) there", "12345678 1234567"):
        assert pii.spans_of(clean, model) == [], clean


def test_over_a_table(spark):
    texts = [*corpus()[:40], None, "", "nothing", "word " * 50_000 + "a@b.org"]
    rows = [(i if i else None, t, "clash", 0) for i, t in enumerate(texts)] + [(1, texts[1], "clash", 0)]
    table = spark.createDataFrame(rows, SCHEMA)
    model = pii.trained(table)
    found = table.drop("spans", "known").select("doc_id", "text", pii.personal_data(F.col("text"), model).alias("spans")).collect()
    assert len(found) == len(rows)
    for r in found:
        base = [(s["start"], s["kind"], s["end"]) for s in r["spans"] if s["known"]]
        assert base == plain_known(r["text"] or "")
    empty = table.limit(0)
    assert pii.trained(empty) is None
    assert empty.select(pii.listed(pii.personal_data(F.col("text"), None))).count() == 0
    assert pii.fit(["no data at all 12345678"]) is None


def test_rare_data_among_many_numbers_is_fitted_on_and_few_repeats_suffice(spark):
    rng = random.Random(3)
    rows = [(i, f"listing {rng.randrange(100, 999)} at {rng.randrange(1000, 9999)}", "clash", 0) for i in range(400)]
    rows += [(400, "word " * 4000 + "call +1 (808) 555-1705 or +1 (808) 555-1705", "clash", 0)]  # beyond 10,000 characters
    model = pii.trained(spark.createDataFrame(rows, SCHEMA), most=20)
    assert model is not None and model.strength[1] > 4
    many = pii.fit(corpus() * 3)
    assert np.allclose(many.strength, pii.fit(corpus()).strength)  # rates
    text = "Call +1 (212) 555-1234, later (212) 555-1234"
    assert [(text[a:b], sure) for a, _, b, sure in pii.spans_of(text, model)] == [("+1 (212) 555-1234", True), ("(212) 555-1234", False)]


def test_neighbouring_numbers_are_nodes_of_their_own():
    text = "7536784127813050 4845168114407329 and 4652 2885 2408 6166 4845 1681 1440 7329, " + "9" * 30 + " 1234567 89"
    shown = [text[a:b] for a, _, b in pii.nodes_of(text, [])]
    assert shown == ["7536784127813050", "4845168114407329", "4652 2885 2408 6166", "4845 1681 1440 7329", "9" * 30, "1234567 89"]
    model = pii.fit(corpus())
    pair = "7536784127813050 4845168114407320"  # the check digit of the first one holds, that of the second does not
    assert plain_luhn(pair[:16]) and not plain_luhn(pair[17:])
    assert pii.spans_of(pair, model) == [(0, 2, 16, False)]


def test_each_kind_of_link_alone_decides():
    """A doubtful node takes its label from its neighbours where labels keep company, or from a repeat far away."""
    n = pii._LABELS
    pairs = np.zeros((2, n, n), int)
    pairs[0] = 5  # cards stand next to telephones, addresses alone
    pairs[0][3, 2] = pairs[0][2, 3] = 4000
    pairs[0][4, 4], pairs[0][0, 4], pairs[0][4, 0] = 4000, 500, 500
    pairs[1][3, 3] = pairs[1][2, 2] = 50
    tables = pii.pair_tables(pairs.ravel().tolist())
    assert tables[0][3, 2] == 1.0 and tables[0][3, 4] < -0.9 and np.allclose(tables[0], tables[0].T)
    doubtful = np.array([-9, -9, 0.0, -9, 0.5])  # card or other, other a little likelier
    phone = np.full(n, -30.0)
    phone[3] = 0
    alone = pii.marginals(doubtful[None], [], tables)
    assert alone[0].argmax() == 4
    beside = pii.marginals(np.array([phone, doubtful]), [(0, 1, 0)], tables)
    assert beside[1].argmax() == 2  # by the chain
    card, strange = np.full(n, -30.0), np.full(n, -30.0)
    card[2], strange[4] = 0, 0
    nodes = np.array([card, strange, strange, doubtful - [0, 0, 3, 0, 0]])
    chain = [(0, 1, 0), (1, 2, 0), (2, 3, 0)]
    assert pii.marginals(nodes, chain, tables)[3].argmax() == 4
    assert pii.marginals(nodes, [*chain, (0, 3, 1)], tables)[3].argmax() == 2  # by the skip
    assert (pii.pair_tables([0] * pii._PAIRS)[1] == 0).all()


def test_pairs_are_learnt_from_neighbours():
    chain, skip = pii.fit(corpus()).tables
    assert skip[3, 3] > 4 and skip[0, 3] == 0 and skip[4, 4] >= skip[3, 3]
    assert chain[3, 3] > 0 and chain[3, 1] < 0  # telephones are followed by telephones, never by addresses of machines
    company = [f"mail a{i}@x.org call +1 (808) 555-{1000 + i} ok" for i in range(80)] + [f"at 10.0.0.{i} and 10.1.0.{i}" for i in range(80)]
    table = pii.fit(company).tables[0]
    assert table[0, 3] > 0.5 and table[0, 1] < -0.5
