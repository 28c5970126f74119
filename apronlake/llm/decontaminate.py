"""Benchmark decontamination by a prefix-filtered set join on rare shingles.

Every run of ``window`` words of an item (all words of a shorter item) is a window; a
document is hit where it contains one. Containment of a window needs all its shingles,
so its necessary prefix is one shingle, and any order of the shingles is right. They are
ordered by rarity: frequencies over all documents of the shingles of the benchmark are
counted first, and each window is indexed by its rarest shingle and that shingle's
position. In a document only positions that carry an indexed shingle are candidates;
the positional and length bounds say where the window must start and end, within one
document; then the window's words are compared one by one by their bytes.

The benchmark is cut into blocks of at most ``block_windows`` windows, so what a task
receives has a bound whatever the benchmark's size; all documents are read against each
block (one block for a benchmark of usual size). No document moves between tasks: only
hit runs (doc_id, block, from, to) do, and only where there are several blocks.

Cases. Null and empty texts have no words: never hit, not contaminated. Very long texts
are read whole. Equal windows of several items count for each item. Repeated rows are
judged each by itself. Null doc_id: a row like any other; null item_id: an item without a
name, which adds hits but no item. Empty tables: no hits, or no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import NO_ID, distil, table, with_key
from .wordhash import ALNUM, LOWER, Words, find_words, grams, slices

RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


class WindowIndex:
    """Windows of one block of the benchmark, indexed by one shingle each."""

    def __init__(self, items: list[tuple], window: int, shingle: int):
        self.shingle = shingle
        words = [[w for w in _words(text)] for _, text in items]
        self.windows: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        for (item, _), ws in zip(items, words):
            for i in range(max(len(ws) - window, 0) + 1 if ws else 0):
                self.windows[tuple(ws[i : i + window])] |= set() if item is None else {str(item)}
        self.order = list(self.windows)

    def shingles(self) -> list[tuple[int, int, int]]:
        """(window, position, shingle hash) of every shingle of every window."""
        out = []
        for k, ws in enumerate(self.order):
            n = min(self.shingle, len(ws))
            h = _hash_words(list(ws))
            out += [(k, i, int(x)) for i, x in enumerate(_runs(h, n))]
        return out

    def choose(self, counts: dict[int, int]) -> None:
        """Index each window by its rarest shingle."""
        best: dict[int, tuple] = {}
        for k, i, h in self.shingles():
            best[k] = min(best.get(k, (np.inf,)), (counts.get(h, 0), i, h))
        lengths: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for k, (_, i, h) in best.items():
            lengths[min(self.shingle, len(self.order[k]))][h].append((i, k))
        self.index = {n: (np.sort(np.fromiter(of, dtype=np.uint64, count=len(of))), dict(of)) for n, of in lengths.items()}
        self.items = [sorted(self.windows[ws]) for ws in self.order]


def _words(text: str | None) -> list[bytes]:
    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
    w = find_words(data, np.array([0, len(data)]), ALNUM, lower=True)
    raw = w.data.tobytes()
    return [raw[a:b] for a, b in zip(w.start, w.end)]


def _hash_words(ws: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(ws), dtype=np.uint8)
    end = np.cumsum([len(w) for w in ws])
    start = end - [len(w) for w in ws]
    return Words(data, np.array([0, len(data)]), start, end, np.array([0, len(ws)]), np.zeros(len(ws), int)).hashes()


def _runs(h: np.ndarray, n: int) -> np.ndarray:
    one = Words(None, None, None, None, np.array([0, len(h)]), np.zeros(len(h), int))
    return grams(one, h, n)[0]


def _lengths(index: WindowIndex) -> list[int]:
    return sorted({min(index.shingle, len(ws)) for ws in index.order})


def _counter(sent: Broadcast):
    """Counts of the wanted shingles in the documents of a task, one row each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: dict[int, np.ndarray] = sent.value
        totals = {n: np.zeros(len(hs), dtype=np.int64) for n, hs in wanted.items()}
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                w = find_words(data, offsets, ALNUM, lower=True)
                h = w.hashes()
                for n, hs in wanted.items():
                    g = grams(w, h, n)[0]
                    at = np.minimum(np.searchsorted(hs, g), len(hs) - 1)
                    totals[n] += np.bincount(at[hs[at] == g], minlength=len(hs))
        for n, hs in wanted.items():
            seen = totals[n] > 0
            yield pa.RecordBatch.from_pydict({"h": hs[seen].view(np.int64), "n": totals[n][seen]})

    return count


def _cover(n: int, runs: list[tuple[int, int]]) -> int:
    total, reach = 0, 0
    for a, b in sorted(runs):
        if b > reach:
            total += b - max(a, reach)
            reach = b
    return total


def _hits(index: WindowIndex, w: Words, h: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Document of the slice: (first word, end word, window) of every occurrence."""
    found: dict[int, list] = defaultdict(list)
    raw = None
    for n, (hs, of) in index.index.items():
        g, doc, first = grams(w, h, n)
        at = np.minimum(np.searchsorted(hs, g), len(hs) - 1)
        for j in np.flatnonzero(hs[at] == g):
            d, p = int(doc[j]), int(first[j])
            lo, hi = int(w.ptr[d]), int(w.ptr[d + 1])
            for i, k in of[int(g[j])]:
                ws = index.order[k]
                a = p - i
                if a < lo or a + len(ws) > hi:
                    continue
                raw = raw if raw is not None else w.data.tobytes()
                if all(raw[w.start[a + x] : w.end[a + x]] == ws[x] for x in range(len(ws))):
                    found[d].append((a - lo, a - lo + len(ws), k))
    return found


def _judge(n_words: int, runs: list[tuple[int, int]], items: set[str]) -> tuple:
    hit = _cover(n_words, runs)
    names = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return n_words, hit, len(items), names, hit > 0 and 20 * hit >= n_words


def _matcher(sent: Broadcast, whole: bool, block: int):
    """Rows of the result if this block is the whole benchmark, else runs and items of this block."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: WindowIndex = sent.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a, b, data, offsets in slices(batch.column(1)):
                w = find_words(data, offsets, ALNUM, lower=True)
                found = _hits(index, w, w.hashes()) if index.order else {}
                rows = []
                for d in range(b - a):
                    of = found.get(d, [])
                    items = {x for _, _, k in of for x in index.items[k]}
                    runs = [(x, y) for x, y, _ in of]
                    n = int(w.ptr[d + 1] - w.ptr[d])
                    if whole:
                        rows.append((ids[a + d], *_judge(n, runs, items)))
                    else:
                        flat = [v for r in runs for v in r]
                        rows.append((ids[a + d], block, hashlib.md5(data[offsets[d] : offsets[d + 1]].tobytes()).hexdigest(), n, flat, sorted(items)))
                if whole:
                    names = [x.split()[0] for x in RESULT.split(", ")]
                    types = [pa.int64()] * 4 + [pa.string(), pa.bool_()]
                else:
                    names = ["doc_id", "block", "digest", "n_words", "runs", "items"]
                    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string())]
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return match


def _clean(sent: Broadcast):
    """Rows (row, text) of clean documents, where one block is the whole benchmark."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: WindowIndex = sent.value
        for batch in batches:
            keep = np.ones(len(batch), dtype=bool)
            for a, _, data, offsets in slices(batch.column(1)):
                w = find_words(data, offsets, ALNUM, lower=True)
                for d, of in (_hits(index, w, w.hashes()) if index.order else {}).items():
                    keep[a + d] = not _judge(int(w.ptr[d + 1] - w.ptr[d]), [(x, y) for x, y, _ in of], set())[-1]
            yield batch.filter(pa.array(keep))

    return clean


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    runs = [tuple(r[i : i + 2]) for r in pdf["runs"] for i in range(0, len(r), 2)]
    items = {x for xs in pdf["items"] for x in xs}
    doc = pdf["doc_id"].iloc[0]
    row = (None if pd.isna(doc) else int(doc), *_judge(int(pdf["n_words"].iloc[0]), runs, items), pdf["digest"].iloc[0])
    rows = [row] * int((pdf["block"] == 0).sum())  # repeated rows stay
    return pd.DataFrame(rows, columns=[*(x.split()[0] for x in RESULT.split(", ")), "digest"]).astype({"doc_id": "Int64"})


def _blocks(benchmark: DataFrame, window: int, block_windows: int) -> Iterator[list[tuple]]:
    """Items in blocks of at most ``block_windows`` windows; a larger item is cut, its pieces overlapping by a window."""
    block, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where("text IS NOT NULL").orderBy("item", "text").toLocalIterator():
        words = _words(r.text)
        for at in range(0, max(1, len(words) + 1 - window), block_windows):
            piece = words[at : at + block_windows + window - 1]
            n = max(1, len(piece) + 1 - window)
            if block and size + n > block_windows:
                yield block
                block, size = [], 0
            block.append((r.item, b" ".join(piece).decode()))
            size += n
    yield block


def _ready(docs: DataFrame, block: list[tuple], window: int, shingle: int) -> Broadcast:
    """The block's windows, indexed by the shingle that is rarest in all documents."""
    spark = docs.sparkSession
    index = WindowIndex(block, window, shingle)
    wanted = {n: np.unique(np.array([h for k, _, h in index.shingles() if min(shingle, len(index.order[k])) == n], dtype=np.uint64)) for n in _lengths(index)}
    counts = {}
    if wanted:
        seen = docs.select("text").mapInArrow(_counter(spark.sparkContext.broadcast(wanted)), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
        # At most one row for each shingle of this block.
        counts = {r.h & (1 << 64) - 1: r.n for r in seen.collect()}
    index.choose(counts)
    index.windows = None
    return spark.sparkContext.broadcast(index)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, shingle: int = 5, block_windows: int = 50_000) -> DataFrame:
    """One row per document: words, hit words, items, their digest, and the verdict."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = _found(docs, benchmark, window, shingle, block_windows)
    if len(parts) == 1:
        return parts[0]
    return reduce(DataFrame.unionByName, parts).groupBy("doc_id", "digest").applyInPandas(_merge, RESULT + ", digest string").drop("digest")


def _found(docs: DataFrame, benchmark: DataFrame, window: int, shingle: int, block_windows: int) -> list[DataFrame]:
    """The result if the benchmark is one block, else what each block finds."""
    parts = []
    blocks = _blocks(benchmark, window, block_windows)
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)
        whole = following is None and not parts
        schema = RESULT if whole else "doc_id long, block long, digest string, n_words long, runs array<long>, items array<string>"
        parts.append(docs.mapInArrow(_matcher(_ready(docs, block, window, shingle), whole, len(parts)), schema))
        block = following
    return parts


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13, shingle: int = 5, block_windows: int = 50_000) -> DataFrame:
    """Rows of ``docs`` that are not contaminated; where the benchmark is one block no row moves."""
    blocks = _blocks(benchmark, window, block_windows)
    block, more = next(blocks), next(blocks, None)
    if more is None:
        pairs = docs.select(F.struct("*").alias("row"), F.col("text").alias("_text"))
        return pairs.mapInArrow(_clean(_ready(docs, block, window, shingle)), pairs.schema).select("row.*")
    def contaminated() -> DataFrame:
        parts = _found(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, window, shingle, block_windows)
        rows = reduce(DataFrame.unionByName, parts).groupBy("doc_id", "digest").applyInPandas(_merge, RESULT + ", digest string")
        return rows.where("contaminated").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_at"), F.col("digest").alias("_digest")).distinct()

    bad = distil(contaminated, docs.sparkSession, "contaminated")
    return with_key(docs).join(bad.hint("merge"), ["_at", "_digest"], "left_anti").select(*docs.columns)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of the whole ``benchmark`` in the whole of ``documents``."""
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns)),
m AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw ON bw.n = dw.n AND bw.g = dw.g),
h AS (SELECT doc_id, count(DISTINCT p) AS hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS k, string_agg(s, ',' ORDER BY s) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(hit, 0)::BIGINT AS n_hit, coalesce(k, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(hit, 0) > 0 AND 20 * coalesce(hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
