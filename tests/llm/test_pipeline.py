"""The pipeline's stages, each held against a brute-force version on its own input."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from apronlake.llm import toxicity

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Output of each stage, written and read again, the input first."""
    out = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(f"{out}/{k}")
        docs = spark.read.parquet(f"{out}/{k}")
        found.append(docs)
    return found


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_names_and_columns(steps):
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "token_files"]
    assert all(s.columns == steps[0].columns for s in steps[:-1])


def test_toxicity(spark, steps):
    model = toxicity.learn(steps[0], spark.read.parquet(f"{SF}/labels.parquet"))
    want = {r.doc_id for r in toxicity.score_documents(steps[0], model).where("predicted = 0").collect()}
    assert set(texts(steps[1])) == want


def test_near_dedup(steps):
    before = {i: WORDS.findall(t or "") for i, t in texts(steps[1]).items()}
    bags = {i: Counter(tuple(w[j : j + 5]) for j in range(max(len(w) - 4, 1))) if w else Counter() for i, w in before.items()}
    parent = {i: i for i in bags}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in bags:
        for j in bags:
            if j < i and bags[i] and bags[j] and sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values()):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    assert set(texts(steps[2])) == {find(i) for i in bags}


def test_decontamination(spark, steps):
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = ITEM.findall((r.text or "").translate(LOWER))
        windows |= {tuple(w[j : j + 13]) for j in range(max(len(w) - 13, 0) + 1)} if w else set()
    keep = set()
    for i, t in texts(steps[2]).items():
        w, hit = ITEM.findall((t or "").translate(LOWER)), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit.update(range(j, j + n))
        if not (hit and 20 * len(hit) >= len(w)):
            keep.add(i)
    assert set(texts(steps[3])) == keep


def test_mixing(steps):
    before, after = steps[3].collect(), steps[4].collect()
    size = {r.doc_id: len(WORDS.findall(r.text or "")) for r in before}
    copies = Counter(r.doc_id for r in after)
    assert all(1 <= n <= 3 for n in copies.values()) and all(size[i] for i in copies)
    source = {r.doc_id: r.source for r in before}
    whole, taken = Counter(), Counter()
    for i, n in size.items():
        whole[source[i]] += n
        taken[source[i]] += n * copies[i]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(whole))}
    level = {s: 0.0 for s in whole}
    open_ = set(whole)
    while True:  # cap, then share the rest again
        left = sum(whole.values()) - sum(3 * whole[s] for s in whole if s not in open_)
        level = {s: left * weight[s] / sum(weight[x] for x in open_) if s in open_ else 3 * whole[s] for s in whole}
        over = {s for s in open_ if level[s] > 3 * whole[s]}
        if not over:
            break
        open_ -= over
    longest = max(size.values())
    assert all(abs(taken[s] - level[s]) <= longest for s in whole)


def test_token_files(steps):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at, want = 0, []
    for r in sorted(steps[4].collect(), key=lambda r: (r.doc_id, r.text)):
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [0]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, steps[5].collect())) == sorted(want)


def test_messy_input(spark, steps):
    rows = [(1, None), (2, ""), (3, "a b c d e f g h"), (3, "a b c d e f g h"), (4, "a b c d e f g h"), (None, "alone here it is")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"source": F.lit(None).cast("string"), "score": F.lit(1)})
    toxic_free = P.drop_toxic(spark, docs, SF)
    assert toxic_free.columns == docs.columns and toxic_free.count() == 6
    kept = P.drop_near_copies(spark, docs, SF)
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "alone here it is"), (1, ""), (2, ""), (3, "a b c d e f g h")]
    assert P.drop_contaminated(spark, kept, SF).count() == 4
    mixed = P.mix_sources(spark, kept, SF)
    assert mixed.columns == docs.columns and {r.text for r in mixed.collect()} <= {"alone here it is", "a b c d e f g h"}
    none = docs.where("doc_id < 0")
    for _, stage in P.STAGES:
        assert stage(spark, none, SF).count() == 0
