"""Language ID: bit-sliced Bloom filters of n-grams; popcounts by language decide.

N-grams are runs of 2 to 4 characters within words (letters and marks in lower case, with a
border before and after each word). A language holds an n-gram if that is at least
``least_share`` of the language's n-grams and ``least_ratio`` of the largest such share of
any language, so that stray words and wrong labels enter no profile, at any size of the
corpus. A language has therefore 1 / least_share n-grams at most, whatever the corpus.

All languages share one array of 64-bit words (a row of words for more than 64 languages):
bit l of a position is language l's own Bloom filter, and one look-up of ``hashes`` positions,
joined by AND, returns the mask of all languages that hold an n-gram. The array grows with
the largest profile, so it has at most 2 * bits / least_share positions of 8 bytes for each 64
languages (16 MB), and that is what tasks get; more languages than ``most_languages`` are an
error. A document's popcount of a language is corrected for that
slice's false positives, p = fill ** hashes: (hits - p * n) / (1 - p).

Counts are combined in each task before they move, and their keys are (language, n-gram),
so no language is one task's. Texts are read twice (learn, identify) and never move.

Cases. Null text, or text without a letter: ``und``, score 0. Letters of no known n-gram:
score 0, and the language with most n-grams learned (then the smaller name), which also
wins ties. No labelled row: everything is ``und``. Repeated rows count each. Very long
texts are read whole. Empty table: no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import distil, table
from .wordhash import mix, slices

ORDERS = (2, 3, 4)
UNKNOWN = "und"
#: N-grams that a task holds before it combines them, and combined ones before it gives them away.
HELD, COMBINED = 1 << 22, 1 << 21
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)


@dataclass
class Filters:
    languages: list[str]
    grams: np.ndarray  # learned, of each language
    bits: np.ndarray  # (positions, words)
    hashes: int

    def __post_init__(self) -> None:
        at = range(len(self.languages))
        fill = [((self.bits[:, i >> 6] >> _U(i & 63)) & _U(1)).mean() if len(self.bits) else 0.0 for i in at]
        self.false = np.array(fill) ** self.hashes
        self.first = np.array(sorted(at, key=lambda i: (-self.grams[i], self.languages[i])), dtype=np.int64)

    def holders(self, gram: np.ndarray) -> np.ndarray:
        """(n-grams, words): the mask of the languages that hold each."""
        low, step = gram & _U(0x7FFFFFFF), (gram >> _U(32)) | _U(1)
        out = None
        for i in range(self.hashes):
            found = self.bits[((low + _U(i) * step) & _U(len(self.bits) - 1)).astype(np.int64)]
            out = found if out is None else out & found
        return out

    def decide(self, gram: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language, share of the n-grams it holds) of texts whose n-grams are ``ptr[d]`` to ``ptr[d + 1]``."""
        n = np.diff(ptr)
        mask = self.holders(gram)
        held = np.zeros((len(n), len(self.languages)))
        for i in range(len(self.languages)):
            have = (mask[:, i >> 6] >> _U(i & 63)) & _U(1)
            hits = np.diff(np.concatenate([[0], np.cumsum(have, dtype=np.int64)])[ptr])
            held[:, i] = np.clip((hits - self.false[i] * n) / max(1 - self.false[i], 1e-9), 0, n)
        best = self.first[np.argmax(held[:, self.first], axis=1)]
        return best, held[np.arange(len(n)), best] / np.maximum(n, 1)


@lru_cache(1)
def _alphabet() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the letter or mark in lower case (0: neither), and whether it is a letter."""
    fold, letter = np.zeros(0x110000, dtype=np.uint32), np.zeros(0x110000, dtype=bool)
    for i in range(0x110000):
        c = chr(i)
        kind = unicodedata.category(c)[0]
        if kind in "LM":
            low = c.lower()
            fold[i], letter[i] = ord(low) if len(low) == 1 else i, kind == "L"
    return fold, letter


def grams_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hashes of n-grams, the text of each in order, letters of each text)."""
    fold, letter = _alphabet()
    point = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    letters = np.diff(np.concatenate([[0], np.cumsum(letter[point])])[at])
    x = np.insert(fold[point], at[:-1], 0)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at) + 1)
    keep = np.append(True, (x[1:] != 0) | (x[:-1] != 0) | (doc[1:] != doc[:-1]))
    x, doc = np.append(x[keep], 0).astype(np.uint64), np.append(doc[keep], len(at) - 2)
    word = x != 0
    out, of = [], []
    for n in ORDERS:
        m = max(len(x) - n + 1, 0)
        ok = word[:m] | word[1 : 1 + m]
        g = np.full(m, n, dtype=np.uint64)
        for i in range(n):
            g = g * _BASE + x[i : i + m]
            if 0 < i < n - 1:
                ok = ok & word[i : i + m]  # borders stand at the ends only
        out.append(mix(g[ok]))
        of.append(doc[:m][ok])
    gram, doc = np.concatenate(out), np.concatenate(of)
    order = np.argsort(doc, kind="stable")
    return gram[order], doc[order], letters


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, gram, n) from (lang, text), combined."""
    loose: dict[int, list[np.ndarray]] = defaultdict(list)
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    held = 0

    def combine() -> int:
        for k, parts in loose.items():
            g, n = np.unique(np.concatenate(parts), return_counts=True)
            if k in sums:
                g, at = np.unique(np.concatenate([sums[k][0], g]), return_inverse=True)
                n = np.bincount(at, np.concatenate([sums[k][1], n])).astype(np.int64)
            sums[k] = g, n
        loose.clear()
        return sum(len(g) for g, _ in sums.values())

    def given() -> Iterator[pa.RecordBatch]:
        for k, (g, n) in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array(np.full(len(g), k), pa.int32()), "gram": pa.array(g.view(np.int64)), "n": pa.array(n, pa.int64())})
        sums.clear()

    for batch in batches:
        lang = batch.column(0).to_numpy()
        for a, b, data, offsets in slices(batch.column(1)):
            gram, doc, _ = grams_of(data, offsets)
            of = lang[a:b][doc]
            for k in np.unique(lang[a:b]).tolist():
                loose[k].append(gram[of == k])
            held += len(gram)
            if held > HELD:
                held = 0
                if combine() > COMBINED:
                    yield from given()
    combine()
    yield from given()


def learn(docs: DataFrame, least_share: float = 1e-5, least_ratio: float = 0.05, bits: int = 10, hashes: int = 4, most_languages: int = 1024) -> Filters:
    """Filters of the languages in ``docs`` (text, lang); rows without either teach nothing."""
    spark = docs.sparkSession
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text")
    names = sorted(r.lang for r in rows.select("lang").distinct().limit(most_languages + 1).collect())
    if len(names) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    if not names:
        return Filters([], np.zeros(0, dtype=np.int64), np.zeros((0, 1), dtype=np.uint64), hashes)
    known = spark.createDataFrame(list(enumerate(names)), "k int, lang string")
    numbered = rows.join(F.broadcast(known), "lang").select("k", "text")
    counts = distil(lambda: numbered.mapInArrow(_count, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), spark, "gram-counts")
    totals = dict(counts.groupBy("lang").agg(F.sum("n")).collect())  # a row a language
    of = F.broadcast(spark.createDataFrame(list(totals.items()) or [(0, 1)], "lang int, total long"))
    shares = counts.join(of, "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("share")).where(F.col("share") >= least_share)
    held = shares.groupBy("gram").agg(F.max("share").alias("top"), F.collect_list(F.struct("lang", "share")).alias("of")).select("gram", "top", F.inline("of"))
    held = distil(lambda: held.where(F.col("share") >= least_ratio * F.col("top")).select("lang", "gram"), spark, "gram-holders")
    largest = held.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    positions = 1 << (int(largest * bits) - 1).bit_length()
    low, step = F.col("gram").bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned("gram", 32).bitwiseOR(F.lit(1))
    at = F.explode(F.array(*((low + F.lit(i) * step).bitwiseAND(F.lit(positions - 1)) for i in range(hashes)))).alias("at")
    bit = F.expr("shiftleft(1L, lang % 64)")
    set_ = held.select((F.col("lang") / 64).cast("int").alias("word"), bit.alias("bit"), at).groupBy("at", "word").agg(F.bit_or("bit").alias("bit")).toArrow()
    array = np.zeros((positions, (len(names) + 63) // 64), dtype=np.uint64)
    array[set_["at"].to_numpy(), set_["word"].to_numpy()] = set_["bit"].to_numpy().view(np.uint64)
    return Filters(names, np.array([totals.get(i, 0) for i in range(len(names))]), array, hashes)


def identify(docs: DataFrame, model: Filters) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = sent.value
        names = np.array([*filters.languages, UNKNOWN], dtype=object)
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                best, score = np.full(b - a, -1), np.zeros(b - a)
                if filters.languages:
                    gram, doc, letters = grams_of(data, offsets)
                    best, score = filters.decide(gram, np.searchsorted(doc, np.arange(b - a + 1)))
                    best, score = np.where(letters > 0, best, -1), np.where(letters > 0, score, 0.0)
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(a, b - a), "lang_pred": pa.array(names[best], pa.string()), "score": pa.array(score)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of the whole of ``documents``, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    doc_id = F.col("doc_id").cast("long")
    model = learn(docs.where(doc_id.isNotNull() & ~held_out(doc_id)))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
