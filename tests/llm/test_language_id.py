"""Language ID: filters against exact sets, held-out accuracy, and odd rows."""

import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from apronlake.llm import language_id

TEXTS = {
    "el": "η γλώσσα είναι το μέσο με το οποίο οι άνθρωποι μιλούν και γράφουν κάθε μέρα",
    "ru": "язык это средство которым люди говорят и пишут каждый день и всегда",
    "it": "la lingua e il mezzo con cui gli uomini parlano e scrivono ogni giorno della vita",
    "nl": "de taal is het middel waarmee mensen elke dag spreken en schrijven over het leven",
}


def corpus():
    r = random.Random(4)
    out = []
    for lang, t in TEXTS.items():
        w = t.split()
        out += [(" ".join(r.choice(w) for _ in range(r.randrange(3, 30))), lang) for _ in range(40)]
    return out + [(None, "it"), ("", "it"), ("senza lingua", None), ("123 !?", "nl")]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, t, lang, "x", i) for i, (t, lang) in enumerate(corpus())], "doc_id long, text string, lang string, gram string, n int").repartition(3)


def exact(texts):
    """N-grams of each language by their definition, on decoded texts."""
    counts = defaultdict(Counter)
    for t, lang in texts:
        if t is None or lang is None:
            continue
        clean = "".join(c.lower() if unicodedata.category(c)[0] in "LM" else " " for c in t)
        for word in clean.split():
            word = f" {word} "
            counts[lang].update(word[i : i + n] for n in language_id.ORDERS for i in range(len(word) - n + 1))
    return counts


def hashed(grams):
    """Hashes of n-grams, as the operator makes them from words with borders."""
    out = set()
    for g in grams:
        x = np.array([0 if c == " " else ord(c) for c in g], dtype=np.uint64)
        h = np.full(1, len(g), dtype=np.uint64)
        for c in x:
            h = h * language_id._BASE + c
        out.add(int(language_id.mix(h)[0]))
    return out


def test_filters_hold_exactly_the_languages_of_each_gram_but_for_false_positives(rows):
    counts = exact(corpus())
    model = language_id.learn(rows, least_share=0.002, least_ratio=0.05)
    assert model.languages == sorted(TEXTS)
    share = {lang: {g: n / c.total() for g, n in c.items()} for lang, c in counts.items()}
    top = Counter()
    for s in share.values():
        top |= Counter(s)
    every, wrong = {g for s in share.values() for g in s}, 0
    for k, lang in enumerate(model.languages):
        assert model.grams[k] == counts[lang].total()
        for g in every:
            v = share[lang].get(g, 0)
            held = bool((int(model.holders(np.array([next(iter(hashed([g])))], dtype=np.uint64))[0, 0]) >> k) & 1)
            if v >= 0.002 and v >= 0.05 * top[g]:
                assert held, (lang, g)
            else:
                wrong += held
    assert wrong <= 0.05 * len(every) * 4


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.op12_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    r = got.where("held_out AND lang_pred <> 'und'").agg(F.count("*").alias("n"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("share"), F.min("score"), F.max("score")).first()
    assert r.n > 250 and r.share >= 0.99 and 0 <= r[2] <= r[3] <= 1


def test_odd_rows(spark, rows):
    model = language_id.learn(rows)
    odd = [(1, None), (2, ""), (3, "12 34 ..."), (4, "́"), (5, "漢字"), (6, "x"), (None, "la lingua"), (7, "ΤΗΣ ΓΛΏΣΣΑΣ είναι"), (7, "люди " * 30_000)]
    got = {(r.doc_id, r.lang_pred, r.score > 0.5) for r in language_id.identify(spark.createDataFrame([(*x, "s") for x in odd], "doc_id long, text string, score string"), model).collect()}
    most = max(exact(corpus()).items(), key=lambda x: x[1].total())[0]
    assert got == {*((i, "und", False) for i in (1, 2, 3, 4)), (5, most, False), (6, most, False), (None, "it", True), (7, "el", True), (7, "ru", True)}
    assert language_id.identify(rows.where("doc_id < -9"), model).collect() == []


def test_nothing_learned(rows):
    model = language_id.learn(rows.where("lang = 'xx'"))
    assert {(r.lang_pred, r.score) for r in language_id.identify(rows, model).collect()} == {("und", 0.0)}
    with pytest.raises(ValueError):
        language_id.learn(rows, most_languages=3)


def test_more_languages_than_a_word_has_bits(spark):
    r = random.Random(9)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 900)]
    own = {f"l{k:02d}": letters[10 * k : 10 * k + 10] for k in range(80)}
    say = lambda k: " ".join("".join(r.choice(own[k]) for _ in range(4)) for _ in range(30))
    docs = spark.createDataFrame([(i, say(k), k) for i, k in enumerate(list(own) * 3)], "doc_id long, text string, lang string")
    model = language_id.learn(docs)
    assert model.bits.shape[1] == 2
    got = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("lang <> lang_pred").count() == 0
