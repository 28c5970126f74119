"""Cross-tokenizer alignment: two tokenizers' tokens of a text, in the smallest common groups.

Each text is encoded by a byte-level BPE (A, of a space and the text) and by a
sentencepiece model (B, which adds that space itself). Dictionaries from the byte at which
a token ends to its index are intersected; the sorted common ends slice both id lists into
groups, and links (pairs of tokens whose bytes overlap) are expanded slice by slice. A
slice with one token on a side links that with all of the other side; otherwise each piece
between two neighbouring ends of either side is one link. Ends are bytes of a short
stretch, so a dictionary is a table with a slot a byte (a hash of no collisions); it covers
``STRETCH`` bytes at a time, and a very long text needs no more memory than others.

B never merges across a space that follows another character (no piece holds one; checked
when the model is loaded, else texts are encoded whole), so its texts are cut there and
frequent pieces are encoded once.

How often an id pair is linked: each task counts, for each pair, its documents, and what
is summed after that are (pair, documents) rows. The pairs of ``hot_pairs`` highest counts
(by powers of two, 17 bytes each) go to all tasks; links of other pairs are rare, and leave
their task as rows that meet the counts in a join on the pair. Both ways give the same
numbers; no pair is dropped. Texts are read and encoded once; their ids are written, and
groups and links are made from ids where they are needed.

Cases. Null and empty texts, and texts whose tokens' joined bytes differ from space and
text (those with U+2581, which B takes for a space), have no tokens: zeros and ''. Null
and repeated doc_ids: each row is a document. Strings of special tokens are plain text.
Very long texts are aligned whole. Empty table: no rows. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import distil, settle, table
from .token_files import PieceEncoder
from .wordhash import release, slices

SLICE = 1 << 19
STRETCH = 1 << 20
#: Links that a task holds before it combines them, and combined ones before it gives them away.
HELD, COMBINED = 1 << 22, 1 << 21


class Vocabulary:
    """Bytes of the tokens of a vocabulary, by id."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.flat[np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size - self.begin[ids], size)]


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteTokens(PieceEncoder):
    """Side A; strings of special tokens are ordinary text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.added = []
        letters = _byte_letters()
        n = self.tokenizer.get_vocab_size(with_added_tokens=True)
        names = [self.tokenizer.id_to_token(i) or "" for i in range(n)]
        self.vocabulary = Vocabulary([bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in names])


class PieceTokens:
    """Side B; remembers the ids of pieces: spaces and what follows up to the next space."""

    MOST, LONG = 250_000, 48
    SPACE = "▁"

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        self.vocabulary = Vocabulary([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(self.SPACE, " ").encode() for i, p in enumerate(names)])
        across = re.compile(f"[^{self.SPACE}]{self.SPACE}")
        self.cut = None if any(across.search(p) for p in names) else re.compile(" +[^ ]*")
        # The model adds its space to no empty text; a last lone space is the piece of a space.
        self.lone = (self.model.piece_to_id(self.SPACE),)
        self.known: dict[str, tuple[int, ...]] = {" ": self.lone}

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each); texts begin with the space that the model adds, or are empty."""
        if self.cut:
            pieces = [self.cut.findall(t) for t in texts]
            new = list({p for x in pieces for p in x} - self.known.keys())
            made = zip(new, map(tuple, self.model.encode([p[1:] for p in new], num_threads=1)))
            if len(self.known) + len(new) > self.MOST:
                self.known = {" ": self.lone}
                new = list({p for x in pieces for p in x} - self.known.keys())
                made = zip(new, map(tuple, self.model.encode([p[1:] for p in new], num_threads=1)))
            self.known.update(made)
            got = [list(chain.from_iterable(map(self.known.__getitem__, x))) for x in pieces]
            for p in new:
                if len(p) > self.LONG:
                    del self.known[p]
        else:
            got = self.model.encode([t[1:] for t in texts], num_threads=1)
        n = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        return np.fromiter(chain.from_iterable(got), dtype=np.int64, count=int(n.sum())), n


@lru_cache(4)
def _sides(a: str, b: str) -> tuple[ByteTokens, PieceTokens]:
    return ByteTokens(a), PieceTokens(b)


def _equal(vocabulary: Vocabulary, ids: np.ndarray, n: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether the joined bytes of each text's tokens are the text's."""
    of = np.repeat(np.arange(len(n)), n)
    length = np.diff(offsets)
    same = np.bincount(of, vocabulary.size[ids], minlength=len(n)).astype(np.int64) == length
    want = data[np.repeat(same, length)]
    unlike = np.flatnonzero(vocabulary.joined(ids[same[of]]) != want)
    same[np.repeat(np.arange(len(n)), length)[np.repeat(same, length)][unlike]] = False
    return same


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices in both of the ends that both have; ends ascend."""
    found_a, found_b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    last = int(max(a[-1], b[-1])) if len(a) and len(b) else -1
    for low in range(0, last + 1, STRETCH):
        (i, j), (k, m) = np.searchsorted(a, [low, low + STRETCH]), np.searchsorted(b, [low, low + STRETCH])
        index_b = np.full(STRETCH, -1, dtype=np.int64)  # end to index
        index_b[b[k:m] - low] = np.arange(k, m)
        at = index_b[a[i:j] - low]
        both = at >= 0
        found_a.append(np.flatnonzero(both) + i)
        found_b.append(at[both])
    return np.concatenate(found_a), np.concatenate(found_b)


def _runs(n: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(n)])


def tokens(sides: tuple[ByteTokens, PieceTokens], data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(A ids, B ids, A ids of each text, B ids of each); none where either side's bytes are not the text's."""
    raw = data.tobytes()
    texts = [raw[x:y].decode() for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    (a, n_a), (b, n_b) = sides[0].encode(data, offsets), sides[1].encode(texts)
    good = _equal(sides[0].vocabulary, a, n_a, data, offsets) & _equal(sides[1].vocabulary, b, n_b, data, offsets)
    return a[np.repeat(good, n_a)].astype(np.int64), b[np.repeat(good, n_b)], n_a * good, n_b * good


@dataclass
class Aligned:
    """Tokens of some texts: ids, tokens of each text, and tokens of each group, on both sides."""

    sides: tuple[ByteTokens, PieceTokens]
    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    n_groups: np.ndarray

    @classmethod
    def of(cls, sides: tuple[ByteTokens, PieceTokens], a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> Aligned:
        """Group tokens whose joined bytes are the same on both sides."""
        last_a, last_b = common_ends(np.cumsum(sides[0].vocabulary.size[a]), np.cumsum(sides[1].vocabulary.size[b]))
        n_groups = np.diff(np.searchsorted(last_a, _runs(n_a)))
        return cls(sides, a, b, n_a, n_b, np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1), n_groups)

    @property
    def n_links(self) -> np.ndarray:
        """Links of each text: a group of m and n tokens has m + n - 1."""
        return self.n_a + self.n_b - self.n_groups

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Token indices in ``a`` and ``b`` of all links, in order."""
        m, n = self.group_a, self.group_b
        count = m + n - 1
        nth = np.arange(int(count.sum())) - np.repeat(_runs(count)[:-1], count)
        x = np.repeat(_runs(m)[:-1], count) + np.where(np.repeat(m > 1, count), nth, 0)
        y = np.repeat(_runs(n)[:-1], count) + np.where(np.repeat(n > 1, count), nth, 0)
        many = (m > 1) & (n > 1)
        if many.any():
            end_a, end_b = np.cumsum(self.sides[0].vocabulary.size[self.a]), np.cumsum(self.sides[1].vocabulary.size[self.b])
            ends = np.union1d(end_a[np.repeat(many, m)], end_b[np.repeat(many, n)])
            at = np.repeat(many, count)
            x[at], y[at] = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        return x, y

    def pairs(self) -> np.ndarray:
        """Id pair of each link, as one number."""
        x, y = self.links()
        return self.a[x] * len(self.sides[1].vocabulary.size) + self.b[y]

    def written(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        m, n = self.group_a, self.group_b
        group_a, group_b = np.repeat(np.arange(len(m)), m), np.repeat(np.arange(len(n)), n)
        after_a, after_b = np.zeros(len(self.a), dtype=np.int64), np.zeros(len(self.b), dtype=np.int64)
        after_a[_runs(m)[1:] - 1] = 1
        after_b[_runs(n)[1:] - 1] = 2
        after_b[_runs(self.n_b)[1:][self.n_b > 0] - 1] = 3
        code = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        code[np.arange(len(self.a)) + _runs(n)[:-1][group_a]] = 4 * self.a + after_a
        code[np.arange(len(self.b)) + _runs(m)[1:][group_b]] = 4 * self.b + after_b
        parts = _decimals(max(len(s.vocabulary.size) for s in self.sides))[code].tolist()
        ends = _runs(self.n_a + self.n_b).tolist()
        return ["".join(parts[x:y]) for x, y in zip(ends[:-1], ends[1:])]


@lru_cache(2)
def _decimals(most: int) -> np.ndarray:
    """Each id in decimal, followed by each of the four marks."""
    return np.array([f"{i}{mark}" for i in range(most) for mark in (",", "|", ";", "")], dtype=object)


def _kinds(sides: tuple[ByteTokens, PieceTokens]) -> list[str]:
    """The narrowest unsigned type of each side's ids."""
    return ["<u2" if len(s.vocabulary.size) <= 1 << 16 else "<u4" for s in sides]


def encode(docs: DataFrame, a: str, b: str) -> DataFrame:
    """(row, doc_id, a, b) of every row of ``docs``: ids of both sides as flat unsigned integers; ``row`` numbers rows once written."""
    paths = a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(*paths)
        kinds = _kinds(sides)
        for batch in batches:
            for x, y, data, offsets in slices(batch.column(0), SLICE):
                *ids, n_a, n_b = tokens(sides, data, offsets)
                flat = [pa.LargeBinaryArray.from_buffers(pa.large_binary(), y - x, [None, pa.py_buffer(_runs(n) * int(k[2])), pa.py_buffer(i.astype(k))]).cast(pa.binary()) for i, n, k in zip(ids, (n_a, n_b), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(2).slice(x, y - x), batch.column(1).slice(x, y - x), *flat], names=["row", "doc_id", "a", "b"])

    text = F.when(F.col("text") != "", F.concat(F.lit(" "), F.col("text"))).alias("text")
    rows = docs.select(text, F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(run, "row long, doc_id long, a binary, b binary")


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, first id of each row and the end) of a column of flat ids."""
    width = int(kind[2])
    column = column.cast(pa.large_binary())
    begin = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    n = int(begin[-1] - begin[0]) // width
    ids = np.frombuffer(body, dtype=kind, count=n, offset=int(begin[0])) if n else np.zeros(0, dtype=kind)
    return ids, (begin - begin[0]) // width


def _aligned(batches: Iterator[pa.RecordBatch], paths: tuple[str, str]) -> Iterator[tuple[pa.RecordBatch, int, int, Aligned]]:
    """Encoded rows (a and b first) as aligned slices of about ``SLICE`` tokens."""
    sides = _sides(*paths)
    for batch in batches:
        (a, at_a), (b, at_b) = (_flat(batch.column(i), k) for i, k in enumerate(_kinds(sides)))
        x, n = 0, batch.num_rows
        while x < n:
            y = max(x + 1, int(np.searchsorted(at_a + at_b, at_a[x] + at_b[x] + SLICE, side="right")) - 1)
            own_a, own_b = a[at_a[x] : at_a[y]].astype(np.int64), b[at_b[x] : at_b[y]].astype(np.int64)
            yield batch, x, y, Aligned.of(sides, own_a, own_b, np.diff(at_a[x : y + 1]), np.diff(at_b[x : y + 1]))
            x = y
        release()


def align(encoded: DataFrame, a: str, b: str) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_sizes, b_sizes) of encoded rows: both sides' ids, and the tokens of each group on both."""
    paths = a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = lambda n, x: pa.ListArray.from_arrays(pa.array(_runs(n), pa.int32()), pa.array(x, pa.int32()))
        for batch, x, y, t in _aligned(batches, paths):
            columns = [batch.column(2).slice(x, y - x), lists(t.n_a, t.a), lists(t.n_b, t.b), lists(t.n_groups, t.group_a), lists(t.n_groups, t.group_b)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"])

    kind = "array<int>"
    return encoded.select("a", "b", "doc_id").mapInArrow(run, f"doc_id long, a_ids {kind}, b_ids {kind}, a_sizes {kind}, b_sizes {kind}")


def pair_counts(encoded: DataFrame, a: str, b: str) -> DataFrame:
    """(pair, docs): in how many encoded rows an A id and a B id are linked; pair = A id * size of B + B id."""
    paths = a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loose: list[np.ndarray] = []
        pair, docs, held = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 0

        def combined() -> tuple[np.ndarray, np.ndarray]:
            new, n = np.unique(np.concatenate([pair[:0], *loose]), return_counts=True)
            both, at = np.unique(np.concatenate([pair, new]), return_inverse=True)
            loose.clear()
            return both, np.bincount(at, np.concatenate([docs, n]), minlength=len(both)).astype(np.int64)

        give = lambda: pa.RecordBatch.from_pydict({"pair": pa.array(pair), "docs": pa.array(docs)})
        for *_, t in _aligned(batches, paths):
            span = len(t.sides[0].vocabulary.size) * len(t.sides[1].vocabulary.size)
            of = np.repeat(np.arange(len(t.n_a)), t.n_links)
            loose.append(np.unique(of * span + t.pairs()) % span)
            held += len(loose[-1])
            if held > HELD:
                (pair, docs), held = combined(), 0
                if len(pair) > COMBINED:
                    yield give()
                    pair, docs = pair[:0], docs[:0]
        pair, docs = combined()
        yield give()

    return encoded.select("a", "b").mapInArrow(run, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs"))


@dataclass
class Hot:
    """Pairs of high counts, ascending, with their documents, and whether no pair of the A id has more."""

    pair: np.ndarray
    docs: np.ndarray
    best: np.ndarray


def split_counts(counts: DataFrame, hot_pairs: int) -> tuple[Hot, DataFrame]:
    """``counts`` (pair, docs, best) as at most ``hot_pairs`` of highest counts, and the other rows."""
    power = F.floor(F.log2("docs")).cast("int").alias("power")
    least, so_far = 63, 0
    for r in counts.groupBy(power).count().orderBy(F.desc("power")).collect():  # 63 rows at most
        so_far += r["count"]
        if so_far > hot_pairs:
            break
        least = r.power
    hot = counts.where(power >= least).orderBy("pair").toArrow()
    return Hot(*(hot[c].to_numpy() for c in ("pair", "docs", "best"))), counts.where(power < least)


def _sums(paths: tuple[str, str], sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = sent.value
        for batch, a, b, t in _aligned(batches, paths):
            pair = t.pairs()
            spot = np.minimum(np.searchsorted(hot.pair, pair), max(len(hot.pair) - 1, 0))
            known = hot.pair[spot] == pair if len(hot.pair) else np.zeros(len(pair), dtype=bool)
            count, best = np.zeros(len(pair), dtype=np.int64), np.zeros(len(pair), dtype=np.int64)
            count[known], best[known] = hot.docs[spot[known]], hot.best[spot[known]]
            run_ = _runs(t.n_links)
            per = lambda x: pa.array(np.diff(_runs(x)[run_]), pa.int64())
            sha = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in t.written()]
            rare = pa.ListArray.from_arrays(pa.array(_runs(~known)[run_], pa.int32()), pa.array(pair[~known], pa.int64()))
            yield pa.RecordBatch.from_pydict(
                {
                    "row": batch.column(3).slice(a, b - a), "doc_id": batch.column(2).slice(a, b - a), "n_a": pa.array(t.n_a, pa.int64()), "n_b": pa.array(t.n_b, pa.int64()),
                    "n_groups": pa.array(t.n_groups, pa.int64()), "n_links": pa.array(t.n_links, pa.int64()), "n_best": per(best), "count_sum": per(count), "groups_sha256": pa.array(sha, pa.string()), "rare": rare,
                }
            )

    return run


SUMS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, rare array<long>"


def alignment_counts(docs: DataFrame, a: str, b: str, hot_pairs: int = 1 << 21) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``."""
    spark = docs.sparkSession
    encoded = settle(encode(docs, a, b), "encoded")
    pieces = len(_sides(a, b)[1].vocabulary.size)

    def counted() -> DataFrame:
        counts = settle(pair_counts(encoded, a, b), "pair-counts").withColumn("_a", F.expr(f"pair div {pieces}"))
        most = counts.groupBy("_a").agg(F.max("docs").alias("most"))  # a row an id of A
        return counts.join(F.broadcast(most), "_a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))

    hot, rare = split_counts(distil(counted, spark, "pairs"), hot_pairs)
    rows = encoded.select("a", "b", "doc_id", "row").mapInArrow(_sums((a, b), spark.sparkContext.broadcast(hot)), SUMS)
    if rare.limit(1).count():
        rows = settle(rows, "aligned")
        met = rows.select("row", F.explode("rare").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("n")).join(rare, "pair")
        more = met.groupBy("row").agg(F.sum(F.col("n") * F.col("docs")).alias("more"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("more_best"))
        plus = lambda c, d: (F.col(c) + F.coalesce(d, F.lit(0))).alias(c)
        rows = rows.join(more, "row", "left").withColumns({"count_sum": plus("count_sum", "more"), "n_best": plus("n_best", "more_best")})
    return rows.drop("row", "rare", "more", "more_best")


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE against sentencepiece on the whole of ``documents``."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import public_tokenizers

    return alignment_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
