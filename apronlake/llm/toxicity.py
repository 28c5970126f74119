"""Toxicity: a linear-chain CRF tags toxic words; marginals give spans and a document score.

Tokens are runs of letters (ASCII letters in lower case, and all bytes from 0x80 on),
each O or T. The score of T is a sum of hashed features of the word (the word, prefixes
of 4 to 8 bytes, its last 3 bytes, a bias); transitions have a weight for each pair.
Labels are given per document, so token labels come from the training rows themselves:
in a toxic training document a word is T if it is in clearly more toxic than other
training documents (lower bound of the log odds ratio, 5 toxic documents at least).
The CRF is fitted by AdaGrad on the exact gradient (forward-backward). The sums,
maximum and density of a document's marginals enter a logistic regression, fitted on
training rows that the CRF has not seen.

``max_labelled`` bounds the labelled rows that are fitted on the driver: those of lowest
hash of their doc_id. Scoring reads every whole text, in tasks, by the same two passes
for any length; doc_id, source, language and labels are never inputs of a score.

Cases. Null, empty or letterless text: no marginals, the regression's intercept gives
the score. Repeated label rows: the greatest label counts. Labels of one class only, or
none: every score is the smoothed share of toxic labels. Empty table: no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import table
from .wordhash import Words, find_words, mix, slices

_U = np.uint64
LETTERS = np.zeros(256, dtype=bool)
LETTERS[0x61:0x7B] = LETTERS[0x80:] = True
FEATURES = 1 << 18
PREFIXES = (4, 5, 6, 7, 8)
BLOCK = 256


@dataclass
class Crf:
    weight: np.ndarray  # of T, by hashed feature
    bias: float
    start: np.ndarray  # of O and T
    move: np.ndarray  # from, to


@dataclass
class Model:
    crf: Crf | None
    coef: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    base: float


def features(w: Words) -> np.ndarray:
    """Feature indices, one column a kind."""
    kinds = [w.hashes(1)]
    size = w.end - w.start
    for n in PREFIXES:
        cut = Words(w.data, w.offsets, w.start, np.minimum(w.start + n, w.end), w.ptr, w.doc)
        kinds.append(cut.hashes(10 + n) + np.where(size > n, _U(0), _U(1)))
    cut = Words(w.data, w.offsets, np.maximum(w.end - 3, w.start), w.end, w.ptr, w.doc)
    kinds.append(cut.hashes(30))
    return np.stack([(mix(k) & _U(FEATURES - 1)).astype(np.int32) for k in kinds], axis=1)


def _chain(m: tuple[np.ndarray, ...], first: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Normalised row vectors v_t = v_(t-1) M_t for all t; m = (m00, m01, m10, m11).

    Blocks of positions go side by side: first each block's product, then the vector
    with which each block begins, then the vectors within the blocks.
    """
    n = len(m[0])
    blocks = -(-n // BLOCK)
    pad = blocks * BLOCK - n
    a, b, c, d = (np.concatenate([x, np.full(pad, f)]).reshape(blocks, BLOCK).T.copy() for x, f in zip(m, (1.0, 0.0, 0.0, 1.0)))
    p, q, r, s = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)
    for i in range(BLOCK):
        p, q, r, s = p * a[i] + q * c[i], p * b[i] + q * d[i], r * a[i] + s * c[i], r * b[i] + s * d[i]
        z = p + q + r + s
        p, q, r, s = p / z, q / z, r / z, s / z
    x, y = first
    xs, ys = np.empty(blocks), np.empty(blocks)
    for k, (p1, q1, r1, s1) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist())):
        xs[k], ys[k] = x, y
        x, y = x * p1 + y * r1, x * q1 + y * s1
        x, y = x / (x + y), y / (x + y)
    out_x, out_y = np.empty((BLOCK, blocks)), np.empty((BLOCK, blocks))
    for i in range(BLOCK):
        xs, ys = xs * a[i] + ys * c[i], xs * b[i] + ys * d[i]
        z = xs + ys
        xs, ys = xs / z, ys / z
        out_x[i], out_y[i] = xs, ys
    return out_x.T.reshape(-1)[:n], out_y.T.reshape(-1)[:n]


def marginals(crf: Crf, emit: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(T) of each token, and expected moves (2 x 2) with starts as a third row.

    ``begins`` are the tokens that begin a document; there the chain forgets what was before.
    """
    n = len(emit)
    e = np.exp(np.clip(emit, -30, 30))
    move, start = np.exp(crf.move), np.exp(crf.start)
    m = [np.full(n, move[0, 0]), move[0, 1] * e, np.full(n, move[1, 0]), move[1, 1] * e]
    for i in (0, 2):
        m[i][begins] = start[0]
    for i in (1, 3):
        m[i][begins] = start[1] * e[begins]
    ao, at = _chain(tuple(m), (0.5, 0.5))
    # Backwards: u_t = M_(t+1) u_(t+1), a chain over transposed matrices in reverse.
    back = [np.append(m[i][1:], 1.0)[::-1] for i in (0, 2, 1, 3)]
    back[1][0], back[2][0] = 0.0, 0.0
    bo, bt = (x[::-1] for x in _chain(tuple(back), (0.5, 0.5)))
    p = at * bt / (ao * bo + at * bt)
    # Expected moves between neighbours of one document.
    inner = np.ones(n, dtype=bool)
    inner[begins] = False
    k = np.flatnonzero(inner)
    pair = [ao[k - 1] * m[0][k] * bo[k], ao[k - 1] * m[1][k] * bt[k], at[k - 1] * m[2][k] * bo[k], at[k - 1] * m[3][k] * bt[k]]
    z = sum(pair)
    expected = np.array([[(x / z).sum() for x in pair[:2]], [(x / z).sum() for x in pair[2:]], [(1 - p[begins]).sum(), p[begins].sum()]])
    return p, expected


def _scores(crf: Crf, f: np.ndarray) -> np.ndarray:
    e = np.full(len(f), crf.bias)
    for i in range(f.shape[1]):
        e += crf.weight[f[:, i]]
    return e


def fit_crf(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], epochs: int = 6, rate: float = 0.25, l2: float = 1e-7) -> Crf:
    """AdaGrad over parts (features, 0/1 labels, begins) on the exact gradient."""
    crf = Crf(np.zeros(FEATURES), -4.0, np.array([0.0, -2.0]), np.array([[0.0, -2.0], [0.0, 0.0]]))
    seen_w, seen = np.full(FEATURES, 1.0), np.full((3, 2), 1.0)
    seen_b = 1.0
    for _ in range(epochs):
        for f, y, begins in parts:
            p, expected = marginals(crf, _scores(crf, f), begins)
            g = y - p
            gw = np.zeros(FEATURES)
            for i in range(f.shape[1]):
                gw += np.bincount(f[:, i], weights=g, minlength=FEATURES)
            gw -= l2 * len(y) * crf.weight
            seen_w += gw * gw
            crf.weight += rate * gw / np.sqrt(seen_w)
            gb = g.sum()
            seen_b += gb * gb
            crf.bias += rate * gb / np.sqrt(seen_b)
            inner = np.ones(len(y), dtype=bool)
            inner[begins] = False
            k = np.flatnonzero(inner)
            real = np.zeros((3, 2))
            np.add.at(real, (y[k - 1].astype(int), y[k].astype(int)), 1)
            np.add.at(real[2], y[begins].astype(int), 1)
            gm = real - expected
            seen += gm * gm
            step = rate * gm / np.sqrt(seen)
            crf.move += step[:2]
            crf.start += step[2]
    return crf


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Coefficients, intercept first, by damped Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    c = np.zeros(x.shape[1])
    c[0] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    ridge = np.full(len(c), l2)
    ridge[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * c)
        c += step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return c


def summaries(p: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Per document: log sum, maximum, log of confident words, density.

    Marginals under 0.2 are left out of the sum, or a long clean text would add up to a toxic one.
    """
    n = len(ptr) - 1
    doc = np.repeat(np.arange(n), np.diff(ptr))
    total = np.bincount(doc, weights=np.where(p >= 0.2, p, 0.0), minlength=n)
    sure = np.bincount(doc, weights=p > 0.5, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, doc, p)
    size = np.maximum(np.diff(ptr), 1)
    return np.column_stack([np.log1p(total), most, np.log1p(sure), np.sqrt(total / size)])


def _lexicon(parts: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray) -> np.ndarray:
    """Word hashes that mark toxic documents; ``parts`` are (word hashes, their documents), documents in order."""
    words, of = [], []
    for h, doc in parts:
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        words.append(h[new])
        of.append(toxic[doc[new]] == 1)
    every, of = np.concatenate(words), np.concatenate(of)
    u, n = np.unique(every, return_counts=True)
    bad, k = np.unique(every[of], return_counts=True)
    n1 = np.zeros(len(u), dtype=np.int64)
    n1[np.searchsorted(u, bad)] = k
    n0 = n - n1
    odds = np.log((n1 + 0.5) / (n0 + 0.5)) - np.log((toxic.sum() + 1) / ((1 - toxic).sum() + 1))
    low = odds - 1.64 * np.sqrt(1 / (n1 + 0.5) + 1 / (n0 + 0.5))
    return u[(n1 >= 5) & (low >= 1.5)]


def fit(texts: pa.Array, toxic: np.ndarray, part_bytes: int = 1 << 20) -> Model:
    """The CRF on two thirds of the rows, the document regression on the rest."""
    base = (toxic.sum() + 0.5) / (len(toxic) + 2.0)  # under a half where nothing is known
    plain = Model(None, np.zeros(5), np.zeros(4), np.ones(4), float(base))
    if len(texts) < 30 or toxic.sum() < 5 or (1 - toxic).sum() < 5:
        return plain
    for_crf = np.arange(len(texts)) % 3 != 2

    def pieces() -> Iterator[tuple[int, int, Words]]:
        for a, b, data, offsets in slices(texts, part_bytes):
            yield a, b, find_words(data, offsets, LETTERS, lower=True)

    hashed = []
    for a, b, w in pieces():
        mine = for_crf[a:b][w.doc]
        hashed.append((w.hashes(1)[mine], w.doc[mine] + a))
    marks = _lexicon(hashed, toxic)
    del hashed
    if not len(marks):
        return plain
    parts = []
    for a, b, w in pieces():
        mine = for_crf[a:b][w.doc]
        d = w.doc[mine]
        if len(d):
            y = (np.isin(w.hashes(1)[mine], marks) & (toxic[a:b][d] == 1)).astype(np.int8)
            parts.append((features(w)[mine], y, np.flatnonzero(np.append(True, d[1:] != d[:-1]))))
    crf = fit_crf(parts)
    del parts
    xs, ys = [], []
    for a, b, w in pieces():
        p = marginals(crf, _scores(crf, features(w)), w.ptr[:-1][np.diff(w.ptr) > 0])[0] if len(w.start) else np.zeros(0)
        keep = ~for_crf[a:b]
        xs.append(summaries(p, w.ptr)[keep])
        ys.append(toxic[a:b][keep])
    x, y = np.concatenate(xs), np.concatenate(ys)
    if y.sum() < 2:
        return plain
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    return Model(crf, _logistic((x - mean) / scale, y), mean, scale, float(base))


def score_slice(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Scores of the documents of a slice and their toxic spans (code points, "start:end,...")."""
    n = len(offsets) - 1
    if model.crf is None:
        return np.full(n, model.base), [""] * n
    w = find_words(data, offsets, LETTERS, lower=True)
    p = np.zeros(0)
    if len(w.start):
        p, _ = marginals(model.crf, _scores(model.crf, features(w)), w.ptr[:-1][np.diff(w.ptr) > 0])
    x = (summaries(p, w.ptr) - model.mean) / model.scale
    score = 1 / (1 + np.exp(-np.clip(model.coef[0] + x @ model.coef[1:], -30, 30)))
    spans: list[list[str]] = [[] for _ in range(n)]
    hit = np.flatnonzero(p >= 0.5)
    if len(hit):
        point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        run = np.flatnonzero(np.append(True, (np.diff(hit) > 1) | (np.diff(w.doc[hit]) > 0)))
        for i, j in zip(run, np.append(run[1:], len(hit))):
            d = w.doc[hit[i]]
            zero = point[offsets[d]]
            spans[d].append(f"{point[w.start[hit[i]]] - zero}:{point[w.end[hit[j - 1]]] - zero}")
    return score, [",".join(s) for s in spans]


def _scorer(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [n for n in batch.schema.names if n != "_text"]
            for a, b, data, offsets in slices(batch.column(batch.schema.names.index("_text"))):
                s, spans = score_slice(model, data, offsets)
                kept = [batch.column(n).slice(a, b - a) for n in rest]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.array(spans)], names=[*rest, "score", "predicted", "spans"])

    return score


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = 8000) -> Model:
    """Fit on at most ``max_labelled`` labelled rows that are not held out."""
    marked = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(sample), "doc_id").select("text", "toxic").toArrow()
    # A fixed order of the sample, whatever order its rows arrive in.
    order = np.argsort([zlib.crc32(t.as_buffer()) for t in rows["text"]], kind="stable") if len(rows) else []
    rows = rows.take(pa.array(order, pa.int64()))
    return fit(rows["text"].combine_chunks(), rows["toxic"].to_numpy().astype(float))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted, spans) of every row."""
    return docs.select("doc_id", F.col("text").alias("_text")).mapInArrow(_scorer(model), "doc_id long, score double, predicted int, spans string")


def reject_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs`` that are not predicted toxic, with their columns; no row moves."""
    whole = docs.select(F.struct("*").alias("row"), F.col("text").alias("_text"))
    schema = T.StructType([whole.schema["row"], *T.StructType.fromDDL("score double, predicted int, spans string")])
    return whole.mapInArrow(_scorer(model), schema).where("predicted = 0").select("row.*")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("long"))
    model = learn(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "spans")
