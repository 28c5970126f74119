"""Formats learned from labelled credentials: planted ones without a label, and a brute-force scorer."""

import math
import random
import string

import numpy as np
import pytest

from apronlake.llm import secrets as S

ALNUM = string.ascii_letters + string.digits
FORMATS = (
    lambda r: "ghp_" + "".join(r.choices(ALNUM, k=36)),
    lambda r: "sk_live_" + "".join(r.choices(ALNUM, k=24)),
    lambda r: "xoxb-" + "".join(r.choices(string.digits, k=12)) + "-" + "".join(r.choices(ALNUM, k=24)),
    lambda r: "".join(r.choices("0123456789abcdef", k=24)),
)


def _corpus(seed):
    """(texts, planted spans off the base patterns of each text)."""
    r = random.Random(seed)
    syllables = ["ta", "ren", "mo", "lis", "ka", "tion", "der", "ing", "ver", "ste", "pro", "con"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randrange(1, 7)))
    say = lambda: " ".join([word() for _ in range(r.randrange(5, 60))] + [r.choice(["http-equiv", "2024-11-28", "/usr/share/lib", "Mixed-Case.Name", "version=1.2.3", "1234567890123"])])
    texts, planted = [], []
    for _ in range(400):
        texts.append(f"{say()} token = \"{r.choice(FORMATS)(r)}\" {say()}")
        planted.append(set())
    for _ in range(200):
        head, secret = say(), r.choice(FORMATS)(r)
        texts.append(f"{head} {secret} {say()}")
        planted.append({(len(head) + 1, len(head) + 1 + len(secret))})
    texts += [say() for _ in range(400)]
    return texts, planted + [set()] * 400


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_credentials_are_found(spark, seed):
    texts, planted = _corpus(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = S.learn_format(docs)
    got = {r.doc_id: {tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if x.startswith("format")} for r in S.find_secrets(docs, known).collect()}
    hits = sum(len(got[i] & p) for i, p in enumerate(planted))
    found, wanted = sum(map(len, got.values())), sum(map(len, planted))
    print("recall", hits / wanted, "precision", hits / found, "states", len(known.automaton.to))
    assert hits >= 0.9 * wanted and hits >= 0.9 * found


def test_scores_equal_brute_force():
    r = random.Random(5)
    good = [r.choice(FORMATS)(r) for _ in range(200)]
    plain = ["".join(r.choices("etaoinshr", k=r.randrange(8, 15))) for _ in range(200)]
    known = S.Format(good, plain)
    pairs, firsts = {}, {}
    symbols = 26 + 10 + len("+/_.=-")
    for t in plain[::2]:
        for a, b in zip(["^", *t], [*t, "$"]):
            pairs[a, b] = pairs.get((a, b), 0) + 1
            firsts[a] = firsts.get(a, 0) + 1
    for token in [*good[:20], *plain[:20], "A", "x" * 3000]:
        t = token.lower()
        chance = lambda a, b: 0.8 * pairs.get((a, b), 0) / firsts[a] + 0.2 / symbols if a in firsts else 1 / symbols
        background = sum(math.log(chance(a, b)) for a, b in zip(["^", *t], [*t, "$"]))
        want = known.automaton.likelihood(token) - background / (len(t) + 1)
        assert known.scores([token])[0] == pytest.approx(want)


def test_automaton_keeps_all_states_that_differ():
    a = S.Automaton([f"{'ab'[i % 2] * 20}{'cd'[i // 2 % 2] * 20}" for i in range(400)])
    assert a.likelihood("a" * 20 + "c" * 20) > -0.2 > a.likelihood("a" * 20 + "b" * 20)
    assert len(a.to) > 20


def test_long_tokens_and_ordinary_outliers():
    r = random.Random(6)
    good = [FORMATS[0](r) for _ in range(300)]
    plain = ["".join(r.choices("etaoinshr", k=10)) for _ in range(300)] + [FORMATS[0](r) for _ in range(9)]
    known = S.Format(good, plain)
    fresh = known.scores([FORMATS[0](r) for _ in range(200)])
    assert (fresh > known.threshold).mean() >= 0.9 and (known.scores(plain[:300]) > known.threshold).mean() < 0.01
    assert np.isfinite(known.scores(["z" * 200_000])).all()
