"""Substring dedup: suffix automata of reference shards, documents' matching statistics.

A window is ``window`` (13) consecutive words of a document; a word goes if a window over
it also starts in a document of smaller doc_id. To stream every document against the
automata of the whole corpus would take (shards x corpus) work, so candidates come first:

0. Texts move once, into a table bucketed by doc_id; all later joins with them are there.
1. Anchors. The 6-word run of lowest hash in each window (its minimizer; one word in five
   begins one) is the same wherever the window stands. Anchors that stand in two
   documents are shared; windows without a shared anchor occur once.
2. Owners. Windows over shared anchors are counted by hash: the smallest doc_id that has a
   window owns it. Runs of windows that a document owns and others share are the
   reference; each repeated window is in it, in its owner's run.
3. Shards. A window's piece is its place over ``piece_words`` (the largest, of all its
   documents); (owner, piece) is hashed to shards of about ``shard_words`` reference words,
   so that a long document's reference is dealt to many shards. A document's candidate passages (maximal runs of windows over shared
   anchors) go to the shards that own windows in them, from the first of a shard's windows
   to the last. A shard with many words to stream is copied to as many salts as are needed.
4. Automata. A task builds the suffix automaton of its shard's runs (words, not hashes),
   each state marked with the document it is from, and streams the passages through it.
   Where the matching statistic is at least ``window`` at a state of a smaller doc_id, the
   last ``window`` words are a repeat; maximal spans of these go.

So hashes only choose what is compared; what goes is decided by the automata on words. A
reference string of ``window`` words or more has one owner, so a state's document is
sure. Equal texts are one reference: later copies of a text have every word in such a
window (if they have 13) and take no part in 1 to 4. Reference shards reach the tasks by a
salted co-group, not a broadcast, as reference text grows with the corpus. Tasks hold one
shard at a time; all groupings are by hash, document or bounded shard, with partial
aggregation before the shuffle.

Cases. Null, empty and short texts: nothing goes. Null doc_id: neither smaller nor
larger than another, nothing goes. Repeated rows of one doc_id: same id, so neither
takes from the other, whether their texts are equal or not. Very long texts are read whole. Empty table: no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import distil, settle, settle_by, table
from .wordhash import Words, find_words, grams, mix, slices

ANCHOR = 6
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_U = np.uint64


class SuffixAutomaton:
    """Generalised suffix automaton of sequences of words, each of one document."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.owner = [-1]

    def add(self, words: list[str], owner: int = -1) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w, owner)

    def _split(self, p: int, w: str, q: int) -> int:
        """A clone of q for the strings that reach it through p."""
        clone = len(self.next)
        self.next.append(self.next[q].copy())
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.owner.append(self.owner[q])
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, w: str, owner: int) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        self.owner.append(owner)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def repeats(self, words: list[str], least: int, before: int | None = None) -> list[tuple[int, int]]:
        """Maximal (start, end) covered by matches of at least ``least`` words, with documents below ``before`` if given."""
        out: list[tuple[int, int]] = []
        state = size = 0
        for i, w in enumerate(words):
            while state and w not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            to = self.next[state].get(w)
            state, size = (to, size + 1) if to is not None else (0, 0)
            if size >= least and (before is None or self.owner[state] < before):
                a = i + 1 - least
                if out and out[-1][1] >= a:
                    out[-1] = (out[-1][0], i + 1)
                else:
                    out.append((a, i + 1))
        return out


def window_anchors(w: Words, h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, document, first word) of each window."""
    total = len(h) - window + 1
    if total <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, int)
    g = np.zeros(len(h) - ANCHOR + 1, dtype=np.uint64)
    for i in range(ANCHOR):
        g *= _U(0x9E3779B97F4A7C15)
        g += h[i : i + len(g)]
    g ^= g >> _U(29)
    g *= _U(0xBF58476D1CE4E5B9)
    g ^= g >> _U(32)
    least = g[:total].copy()
    for i in range(1, window - ANCHOR + 1):
        np.minimum(least, g[i : i + total], out=least)
    same = w.doc[:total] == w.doc[window - 1 :]
    first = np.flatnonzero(same)
    return least[first], w.doc[first], first


def _anchors(window: int):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                w = find_words(data, offsets)
                h, doc, _ = window_anchors(w, w.hashes(), window)
                # Neighbouring windows mostly share their anchor.
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                h, doc = h[new], pa.array(doc[new] + a)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column(0).take(doc)], names=["anchor", "doc_id"])

    return anchors


def _words_of(text: str) -> list[bytes]:
    """Words of a text; the white space of bytes.split() is ``[\\x20\\x09-\\x0D]``."""
    return text.encode().split()


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _shared_windows(w: Words, h: np.ndarray, window: int, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, whether it stands over a shared anchor) of each window of one text."""
    anchor = window_anchors(w, h, window)[0].view(np.int64)
    return grams(w, h, window)[0].view(np.int64), np.isin(anchor, anchors)


def _words_in(text: str) -> tuple[Words, np.ndarray]:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    w = find_words(data, np.array([0, len(data)]))
    return w, w.hashes()


def _windows(window: int, piece_words: int):
    """(window hash, doc_id, piece) of the windows over shared anchors, once a text."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, anchors in zip(*(batch.column(i).to_pylist() for i in range(3))):
                w, h = _words_in(text)
                g, over = _shared_windows(w, h, window, np.array(anchors, dtype=np.int64))
                at = np.flatnonzero(over)
                g, first = np.unique(g[at], return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(np.full(len(g), doc)), pa.array(at[first] // piece_words)], names=["w", "doc_id", "piece"])

    return windows


def _runs_of(kind: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first, end, kind) of maximal runs of one kind, those of kind -1 left out."""
    cut = np.flatnonzero(np.append(True, kind[1:] != kind[:-1])) if len(kind) else []
    for x, y in zip(cut, [*cut[1:], len(kind)]):
        if kind[x] >= 0:
            yield int(x), int(y), int(kind[x])


def _spans(window: int, shards: int):
    """Runs of owned windows (query false), and passages with windows of others' shards (query true)."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "query", "doc_id", "digest", "start", "n_words", "words"]
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            rows = []
            for doc, digest, text, anchors, hs, owners, pieces in zip(*(batch.column(i).to_pylist() for i in range(7))):
                w, h = _words_in(text)
                g, over = _shared_windows(w, h, window, np.array(anchors, dtype=np.int64))
                hs, owners, pieces = (np.array(x, dtype=np.int64) for x in (hs, owners, pieces))
                order = np.argsort(hs)
                hs, owners, pieces = hs[order], owners[order], pieces[order]
                at = np.minimum(np.searchsorted(hs, g), len(hs) - 1)
                known = over & (hs[at] == g)
                shard = _shard(owners[at], pieces[at], shards)
                words = _words_of(text)

                def span(x: int, y: int, of: int, query: bool) -> None:
                    rows.append((of, query, doc, digest, x, y + window - 1 - x, b" ".join(words[x : y + window - 1]).decode()))

                for x, y, of in _runs_of(np.where(known & (owners[at] == doc), shard, -1)):
                    span(x, y, of, False)
                others = np.where(known & (owners[at] != doc), shard, -1)
                for x, y, _ in _runs_of(np.where(over, 0, -1)):
                    of, first = np.unique(others[x:y], return_index=True)
                    last = y - x - np.unique(others[x:y][::-1], return_index=True)[1]
                    for k in np.flatnonzero(of >= 0):
                        span(x + int(first[k]), x + int(last[k]), int(of[k]), True)
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return spans


def _shard(owner: np.ndarray, piece: np.ndarray, shards: int) -> np.ndarray:
    return (mix(owner.view(np.uint64) * _U(0x9E3779B97F4A7C15) + piece.view(np.uint64)) % _U(shards)).astype(np.int64)


def _stream(window: int):
    def stream(reference: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        automaton = SuffixAutomaton()
        for doc, words in zip(reference["doc_id"], reference["words"]):
            automaton.add(words.split(" "), doc)
        rows = []
        for doc, digest, start, words in zip(queries["doc_id"], queries["digest"], queries["start"], queries["words"]):
            rows += [(doc, digest, start + a, start + b) for a, b in automaton.repeats(words.split(" "), window, doc)]
        return pd.DataFrame(rows, columns=["doc_id", "digest", "a", "b"]).astype({"doc_id": "int64", "digest": "str", "a": "int64", "b": "int64"})

    return stream


def _finish(window: int):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, digest, text, first, spans in zip(*(batch.column(i).to_pylist() for i in range(5))):
                words = _words_of(text)
                gone = np.zeros(len(words), dtype=bool)
                gone[:] = first is not None and len(words) >= window
                for s in spans or ():
                    if s["digest"] == digest:
                        gone[s["a"] : s["b"]] = True
                kept = [x for x, out in zip(words, gone) if not out] if gone.any() else words
                rows.append((doc, len(words), int(gone.sum()), _digest(kept)))
            columns = list(zip(*rows)) or [()] * 4
            types = [pa.int64()] * 3 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return finish


def _texts(named: DataFrame, title: str) -> DataFrame:
    """(doc_id, digest, text, first: smaller doc_id of an equal text), bucketed by doc_id: here texts move."""
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ids = named.select("doc_id", F.md5("text").alias("digest"))
    copies = ids.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    firsts = ids.join(copies, "digest").where("first < doc_id").groupBy("doc_id").agg(F.map_from_entries(F.collect_set(F.struct("digest", "first"))).alias("firsts"))
    texts = settle_by(named.withColumn("digest", F.md5("text")), "doc_id", "texts", firsts, title, size)
    return texts.withColumn("first", F.col("firsts")[F.col("digest")]).drop("firsts")


def _shared_anchors(texts: DataFrame, window: int) -> DataFrame:
    """(doc_id, anchors) of documents that share anchors with others."""
    anchors = texts.where("first IS NULL").select("doc_id", "text").mapInArrow(_anchors(window), "anchor long, doc_id long")
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi").select("anchor")
    return settle(anchors.join(shared, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors")), "shared-anchors")


def _owned_windows(open_: DataFrame, window: int, piece_words: int) -> DataFrame:
    """(doc_id, of: list of (w, owner, piece)) of documents with repeated windows."""
    # Written, as both uses below would else make the windows from the texts.
    windows = settle(open_.select("doc_id", "text", "anchors").mapInArrow(_windows(window, piece_words), "w long, doc_id long, piece long"), "windows")
    owners = windows.groupBy("w").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.max("piece").alias("piece")).where("owner < last").drop("last")
    return settle(windows.select("w", "doc_id").join(owners, "w").groupBy("doc_id").agg(F.collect_list(F.struct("w", "owner", "piece")).alias("of")), "owned-windows")


def _span_table(open_: DataFrame, owned: DataFrame, window: int, shard_words: int) -> DataFrame:
    """Reference and query spans with their shard."""
    size = owned.agg(F.sum(F.size(F.filter("of", lambda x: x["owner"] == F.col("doc_id"))))).first()[0] or 0
    joined = open_.join(owned.hint("merge"), "doc_id").select("doc_id", "digest", "text", "anchors", F.col("of.w").alias("w"), F.col("of.owner").alias("owner"), F.col("of.piece").alias("piece"))
    kinds = "shard long, query boolean, doc_id long, digest string, start long, n_words long, words string"
    return settle(joined.mapInArrow(_spans(window, int(1 + size // shard_words)), kinds), "spans")


def _removed_spans(spans: DataFrame, window: int, query_words: int) -> DataFrame:
    """(doc_id, gone: list of (digest, a, b)) from the shards' automata."""
    salts = spans.where("query").groupBy("shard").agg((F.floor(F.sum("n_words") / query_words) + 1).cast("int").alias("salts"))
    salted = spans.join(salts, "shard")
    reference = salted.where("NOT query").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    queries = salted.where("query").withColumn("salt", F.pmod(F.xxhash64("doc_id", "digest", "start"), F.col("salts")).cast("int"))
    left = reference.select(F.col("shard").alias("of"), F.col("salt").alias("copy"), F.col("doc_id").alias("doc_id"), F.col("words").alias("words"))
    right = queries.select("shard", "salt", "doc_id", "digest", "start", F.col("words").alias("words"))
    cogroup = left.groupBy("of", "copy").cogroup(right.groupBy("shard", "salt"))
    gone = cogroup.applyInPandas(_stream(window), "doc_id long, digest string, a long, b long")
    return gone.groupBy("doc_id").agg(F.collect_set(F.struct("digest", "a", "b")).alias("gone"))


def drop_repeats(docs: DataFrame, window: int = 13, shard_words: int = 20_000, query_words: int = 200_000, piece_words: int = 2_000) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of ``docs``.

    The result is written and what it took to get there removed: the folders, and the
    catalog's entry of the text table.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    nameless, named = docs.where("doc_id IS NULL"), docs.where("doc_id IS NOT NULL")
    title = f"scratch_{uuid.uuid4().hex}"

    def finished() -> DataFrame:
        texts = _texts(named, title)
        open_ = texts.where("first IS NULL").join(_shared_anchors(texts, window).hint("merge"), "doc_id")
        removed = lambda: _removed_spans(_span_table(open_, _owned_windows(open_, window, piece_words), window, shard_words), window, query_words)
        gone = distil(removed, spark, "removed-spans")
        whole = texts.join(gone.hint("merge"), "doc_id", "left").select("doc_id", "digest", "text", "first", "gone")
        alone = nameless.select("doc_id", F.lit("").alias("digest"), "text", F.lit(None).cast("long").alias("first"), F.lit(None).cast(gone.schema["gone"].dataType).alias("gone"))
        return whole.mapInArrow(_finish(window), RESULT).unionByName(alone.mapInArrow(_finish(window), RESULT))

    try:
        return distil(finished, spark, "substring-result")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {title}")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats of 13 words in the whole of ``documents``."""
    return drop_repeats(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
own AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) < doc_id AS again FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM own WHERE again),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT word.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY word.p) AS t FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY word.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""
