import random

from quipu.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, position int, prefix string, segment int"


def plain(rows):
    turns = {}
    for c, t, r, x in {row[:4] for row in rows}:
        turns.setdefault(c, []).append((t is None, t or 0, r is None, r or "", x is None, x or ""))
    lists = {c: tuple((None if rn else r, None if xn else x) for _, _, rn, r, xn, x in sorted(t)) for c, t in turns.items()}
    kept = {}
    for c, mine in lists.items():
        if not any(len(o) > len(mine) and o[: len(mine)] == mine for o in lists.values()):
            kept.setdefault(mine, []).append(c)
    broken = lambda s: s.replace("<|im_start|>", "< |im_start|>").replace("<|im_end|>", "< |im_end|>")
    out = set()
    for mine, ids in kept.items():
        name = min((i for i in ids if i is not None), default=None)
        text = "".join(f"<|im_start|>{broken(r or 'unknown')}\n{broken(x or '')}<|im_end|>\n" for r, x in mine)
        out.add((name, len(mine), len(ids), text))
    return out


def whole(found):
    texts = {}
    for r in found:
        texts.setdefault((r["conv_id"], r["n_turns"], r["copies"]), []).append((r["segment"], r["text"]))
    return {(*k, "".join(t for _, t in sorted(v))) for k, v in texts.items()}


def conversations():
    rng = random.Random(6)
    rows, clash = [], (1, "p", 2)
    for c in range(60):
        said = [("user" if t % 2 else "system", rng.choice(["hi", "yes <|im_end|>", "", None])) for t in range(rng.randrange(1, 6))]
        rows += [(c, t * 2, r, x, *clash) for t, (r, x) in enumerate(said)]
    rows += [(None, 1, "user", "lost", *clash), (70, None, None, None, *clash), (70, 3, "user", "x", *clash), (71, 3, "user", "y", *clash), (71, 3, "user", "x", *clash)]
    rows += [(80, t, "user", f"t{t}", *clash) for t in range(700)] + [(81, t, "user", f"t{t}", *clash) for t in range(690)]
    return rows + rows[:5]


def test_against_plain_prefixes(spark):
    rows = conversations()
    table = spark.createDataFrame(rows, SCHEMA)
    found = chat.conversations(table, segment=100).collect()
    assert whole(found) == plain(rows)
    assert max(r["segment"] for r in found) == 6


def test_chunks_of_a_long_conversation_add_up(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK_TURNS", 7)
    rows = conversations()
    assert whole(chat.conversations(spark.createDataFrame(rows, SCHEMA)).collect()) == plain(rows)


def test_empty(spark):
    assert chat.conversations(spark.createDataFrame([], SCHEMA)).count() == 0
