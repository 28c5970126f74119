"""Alignment of two tokenizers against a brute force that encodes whole texts and compares all byte ranges."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from apronlake.llm import token_align

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows():
    r = random.Random(5)
    words = ["the", "naïve", "Straße", "tokenization", "漢字", "😀", "x=1;", "foo_bar", "\n", "\t", "12345", "…", "é"]
    texts = [None, "", " ", "  ", "a", " a", "a ", "\n", "two  spaces   three", "<|endoftext|> in <s> text </s><unk>", "literal ▁ piece", "nul\x00byte", "non break 　 wide", "ﬁ ligature", "a\r\nb", "x" * 3000, "word " * 20_000]
    texts += ["  end  ", "漢字" * 900, "longer-than-a-remembered-piece-" * 3]
    texts += [" ".join(r.choice(words) for _ in range(r.randrange(1, 40))) for _ in range(60)] + ["same text"] * 3
    out = [(i if i != 7 else None, t, "clash", i) for i, t in enumerate(texts)]
    return [*out, (4, "an id again", "clash", 0), ((1 << 60) + 1, "large id", "clash", 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), "doc_id long, text string, pair string, docs int").repartition(3)


@pytest.fixture(scope="module")
def brute():
    ta, tb = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    ta.encode_special_tokens = True
    letter = token_align._byte_letters()
    found = []
    for doc_id, text, *_ in rows():
        want = f" {text}".encode() if text else b""
        a = ta.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = tb.encode(text) if text else []
        ba = [bytes(letter[c] for c in ta.id_to_token(i)) for i in a]
        bb = [bytes([int(tb.id_to_piece(i)[3:5], 16)]) if tb.is_byte(i) else tb.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(ba) != want or b"".join(bb) != want:
            a, b, ba, bb = [], [], [], []
        spans = []
        for parts in (ba, bb):
            at, own = 0, []
            for p in parts:
                own.append((at, at + len(p)))
                at += len(p)
            spans.append(own)
        links, j = [], 0
        for i, (x, y) in enumerate(spans[0]):
            while spans[1][j][1] <= x:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < y:
                links.append((a[i], b[k]))
                k += 1
        ends = sorted({y for _, y in spans[0]} & {y for _, y in spans[1]})
        groups, i, j = [], 0, 0
        for e in ends:
            ga, gb = [], []
            while i < len(a) and spans[0][i][1] <= e:
                ga.append(a[i])
                i += 1
            while j < len(b) and spans[1][j][1] <= e:
                gb.append(b[j])
                j += 1
            groups.append((ga, gb))
        found.append((doc_id, a, b, groups, links))
    counts, most = defaultdict(int), defaultdict(int)
    for *_, links in found:
        for p in set(links):
            counts[p] += 1
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for doc_id, a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(counts[p] == most[p[0]] for p in links)
        out.append((doc_id, len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out, key=repr), found


@pytest.mark.parametrize("hot", [0, 40, 1 << 21])
def test_counts_equal_brute_force(docs, brute, hot):
    got = token_align.alignment_counts(docs, A, B, hot).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == brute[0]


def test_groups_and_ids(docs, brute):
    got = sorted(((r.doc_id, r.a_ids, r.b_ids, r.a_sizes, r.b_sizes) for r in token_align.align(token_align.encode(docs, A, B), A, B).collect()), key=repr)
    assert got == sorted(((d, a, b, [len(x) for x, _ in g], [len(y) for _, y in g]) for d, a, b, g, _ in brute[1]), key=repr)


def test_long_texts_are_aligned_by_stretches(monkeypatch):
    monkeypatch.setattr(token_align, "STRETCH", 7)
    r = random.Random(2)
    a, b = (np.array(sorted(r.sample(range(1000), n))) for n in (300, 420))
    x, y = token_align.common_ends(a, b)
    both = sorted(set(a.tolist()) & set(b.tolist()))
    assert a[x].tolist() == both and b[y].tolist() == both


def test_query_and_empty_table(spark, docs, tmp_path, brute):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, token_align.op11_token_align(spark, str(tmp_path)).select(*COLUMNS).collect()), key=repr) == brute[0]
    assert token_align.alignment_counts(docs.where("doc_id < -9"), A, B).collect() == []
