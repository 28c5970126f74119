"""Fill-in-the-middle against a brute force over decoded texts."""

import hashlib
import random
import re

import numpy as np
import pytest

from apronlake.llm import fill_middle

LINE = re.compile(r"[^\n]*\n|[^\n]+")
TEXTS = [None, "", "\n", "\n\n\n", "one line", "a\nb\nc", "é\n😀😀\nß漢字\n", "\r\n\r\n", "no <P> cut\nhere", "<S>", "x<M>y", "a b\u0085c\n\x0bd", "<\nP>\n<", "long line " * 30_000, "zeile\n" * 20_000, "日本\n" * 5_000]


def rows():
    r = random.Random(11)
    alphabet = ["a", "b ", "\n", "\n", "é", "漢", "😀", "<", "P>", "\t"]
    texts = TEXTS + ["".join(r.choice(alphabet) for _ in range(r.randrange(1, 60))) for _ in range(150)]
    out = [(i if i != 5 else None, t, "clash", i) for i, t in enumerate(texts)]
    return out + [(3, "again\nthe same id\n", "clash", 0), ((1 << 60) + 1, "large\nid\n", "clash", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), "doc_id long, text string, form string, n int").repartition(3)


def brute(doc_id, text, unit="lines", rate=100, spm=50, seed=7):
    t = text or ""
    u = LINE.findall(t) if unit == "lines" else list(t)
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i : 8 * i + 8], 16) for i in range(4)]
    i, j = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    a, m, s = "".join(u[:i]), "".join(u[i:j]), "".join(u[j:])
    if not t or any(k in t for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, len(u), "plain", None, None, t
    spm_form = h[3] % 100 < spm
    return doc_id, len(u), "spm" if spm_form else "psm", len(a), len(m), f"<S>{s}<P>{a}<M>{m}" if spm_form else f"<P>{a}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit,rate,spm,seed", [("lines", 100, 50, 7), ("characters", 100, 50, 7), ("characters", 60, 20, 1), ("lines", 0, 50, 7)])
def test_outputs_equal_brute_force(docs, unit, rate, spm, seed):
    out = fill_middle.fill_in_middle(docs, unit, rate, spm, seed)
    key = lambda r: tuple(map(repr, r))
    got = sorted((tuple(r) for r in out.collect()), key=key)
    assert got == sorted((brute(d, t, unit, rate, spm, seed) for d, t, *_ in rows()), key=key)
    back = out.select("doc_id", fill_middle.restored(out.output, out.form).alias("t")).collect()
    assert sorted((repr(r.doc_id), r.t) for r in back) == sorted((repr(d), t or "") for d, t, *_ in rows())


def test_query_digests(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) for r in fill_middle.op13_fill_middle(spark, str(tmp_path)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {(*brute(d, t)[:5], sha(brute(d, t)[5]), sha(t or "")) for d, t, *_ in rows()}


def test_empty_table_and_unknown_unit(docs):
    assert fill_middle.fill_in_middle(docs.where("doc_id < -9")).collect() == []
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(docs, "words")


def test_index_converts_every_cut():
    t = "aé漢😀b" * 7
    data = np.frombuffer(t.encode(), dtype=np.uint8)
    index = fill_middle.ByteIndex.of(data)
    cut = np.array([len(t[:i].encode()) for i in range(len(t) + 1)])
    assert index.characters(cut).tolist() == list(range(len(t) + 1))
    assert index.bytes(np.arange(len(t) + 1)).tolist() == cut.tolist()
    plain = fill_middle.ByteIndex.of(np.frombuffer(b"ascii only", dtype=np.uint8))
    assert len(plain.at) == 0 and plain.characters(np.array([4])).tolist() == [4]
