"""The CRF's arithmetic against enumeration, and held-out accuracy on the given documents."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from apronlake.llm import toxicity as T


def test_marginals_equal_enumeration():
    r = np.random.default_rng(2)
    crf = T.Crf(np.zeros(1), 0.0, r.normal(size=2), r.normal(size=(2, 2)))
    emit, begins = r.normal(size=9), np.array([0, 4, 5])
    p, expected = T.marginals(crf, emit, begins)
    want, moves = np.zeros(9), np.zeros((3, 2))
    for a, b in ((0, 4), (4, 5), (5, 9)):
        total = 0.0
        marg, mv = np.zeros(b - a), np.zeros((3, 2))
        for tags in itertools.product((0, 1), repeat=b - a):
            s = crf.start[tags[0]] + sum(crf.move[x, y] for x, y in zip(tags, tags[1:])) + sum(e for e, t in zip(emit[a:b], tags) if t)
            w = np.exp(s)
            total += w
            marg += w * np.array(tags)
            mv[2, tags[0]] += w
            for x, y in zip(tags, tags[1:]):
                mv[x, y] += w
        want[a:b] = marg / total
        moves += mv / total
    assert np.allclose(p, want) and np.allclose(expected, moves)


def test_long_chains_do_not_depend_on_blocks():
    r = np.random.default_rng(3)
    crf = T.Crf(np.zeros(1), 0.0, np.array([0.0, -1.0]), np.array([[0.0, -3.0], [-1.0, 0.5]]))
    emit = r.normal(size=2000) * 3
    begins = np.array([0, 1, 700, 701, 1999])
    whole, _ = T.marginals(crf, emit, begins)
    for a, b in zip(begins, np.append(begins[1:], 2000)):
        assert np.allclose(whole[a:b], T.marginals(crf, emit[a:b], np.array([0]))[0])


@pytest.fixture(scope="module")
def scored(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = T.learn(docs, labels)
    return docs, labels, model


def test_held_out_accuracy(scored):
    docs, labels, model = scored
    x = T.score_documents(docs, model).join(labels, "doc_id").where(T.held_out(F.col("doc_id"))).toPandas()
    hit = x[x.predicted == 1]
    assert hit.toxic.mean() > 0.97 and (x[x.toxic == 1].predicted == 1).mean() > 0.8
    assert (hit.spans != "").mean() > 0.9


def test_edge_cases(spark, scored):
    docs, labels, model = scored
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !!"), (4, "you idiot moron scum trash " * 3), (4, "x " * 50000)], "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = {(r.doc_id, r.spans != ""): r for r in T.score_documents(odd, model).collect()}
    assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert got[(4, True)].predicted == 1 and got[(1, False)].predicted == 0
    kept = T.reject_toxic(odd, model)
    assert kept.columns == odd.columns and kept.count() == 4
    none = T.learn(docs, labels.where("toxic = 0"))
    assert none.crf is None and T.score_documents(odd, none).where("predicted = 1").count() == 0
    assert T.score_documents(docs.where("doc_id < 0"), model).count() == 0
