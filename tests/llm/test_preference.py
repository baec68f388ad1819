from __future__ import annotations

import random

from namewright.llm.preference import format_pairs, preference_format, rival_replies

SCHEMA = "pair_id long, turn long, role string, text string, _place int, prompt string"


def plain(chosen, rejected):
    def ordered(turns):
        clean = [((t[1] is not None, t[1] or 0), t[2] or "", t[3] or "") for t in turns]
        return [(role, text) for _, role, text in sorted(clean)]

    pairs = {}
    for side, turns in enumerate((chosen, rejected)):
        for t in turns:
            if t[0] is not None:
                pairs.setdefault(t[0], ([], []))[side].append(t)
    out = {}
    for pair, sides in pairs.items():
        a, b = map(ordered, sides)
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1

        def shown(turns):
            text, spans = "", []
            for role, content in turns:
                text += f"<|{role}|>\n"
                begin = len(text)
                text += f"{content}<|end|>\n"
                if role == "assistant":
                    spans.append((begin, len(text)))
            return text, spans

        (c, cm), (r, rm) = shown(a[n:]), shown(b[n:])
        out[pair] = (n, shown(a[:n])[0], c, r, cm, rm, bool(cm and rm))
    return out


def check(spark, chosen, rejected):
    frames = (spark.createDataFrame(t, SCHEMA) for t in (chosen, rejected))
    got = {
        r["pair_id"]: (r["n_common"], r["prompt"], r["chosen"], r["rejected"], [tuple(m) for m in r["chosen_mask"]], [tuple(m) for m in r["rejected_mask"]], r["usable"])
        for r in preference_format(*frames).collect()
    }
    assert got == plain(chosen, rejected)
    return got


def test_against_plain_form(spark):
    draw = random.Random(5)
    sides = ([], [])
    for pair in range(60):
        common = [(draw.choice(("user", "assistant", "system")), f"tür {draw.randrange(4)} 😀") for _ in range(draw.randrange(5))]
        for side in sides:
            turns = common + [(draw.choice(("user", "assistant")), f"x{draw.randrange(3)}") for _ in range(draw.randrange(4))]
            side.extend((pair, i, role, text, 1, "p") for i, (role, text) in enumerate(turns))
    check(spark, *sides)


def test_awkward_turns(spark):
    chosen = [
        (1, 0, "user", "a", 1, ""), (1, 0, "user", "a", 1, ""), (1, None, None, None, 1, ""), (1, 1, "assistant", "", 1, ""), (2, 0, "user", "alone", 1, ""),
        (3, 0, "assistant", "same", 1, ""), (None, 0, "user", "no pair", 1, ""), (4, 0, "assistant", "w" * 200_000, 1, ""),
    ]
    rejected = [(1, 0, "user", "a", 1, ""), (1, None, None, None, 1, ""), (3, 0, "assistant", "same", 1, ""), (5, 0, "user", "other", 1, ""), (4, 0, "assistant", "w" * 199_999, 1, "")]
    got = check(spark, chosen, rejected)
    assert got[1][0] == 2 and got[3][:4] == (1, "<|assistant|>\nsame<|end|>\n", "", "") and not got[2][-1] and got[4][-1]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert preference_format(none, none).count() == 0


def test_rival_replies(spark):
    turns = [
        (0, 0, "user", "q0"), (0, 1, "assistant", "a0"), (0, 2, "user", "more"), (1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (2, 0, "user", "q2"), (2, 1, "assistant", "a2"),
        (4, 0, "user", "q4"), (5, 0, "user", "q5"), (5, 1, "assistant", None), (None, 0, "user", "lost"), (6, None, "assistant", "first"), (6, 3, None, "then"),
    ]
    pairs = rival_replies(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    got = {r["pair_id"]: ([t["text"] for t in r["chosen"]], [t["text"] for t in r["rejected"]]) for r in pairs.collect()}
    assert got == {
        0: (["q0", "a0"], ["q0", "a1"]), 1: (["q1", "a1"], ["q1", "a0"]), 2: (["q2", "a2"], ["q2"]), 4: (["q4"], ["q4"]), 5: (["q5", ""], ["q5"]), 6: (["first"], []),
    }
    assert format_pairs(pairs).count() == 6
