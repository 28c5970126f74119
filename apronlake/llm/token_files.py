"""Token-ID files: flat unsigned integers, 64-bit document offsets, memory-mapped reads.

``write_token_files`` range-partitions the documents by id, encodes each partition in
ascending order and writes three flat files per partition to the shared folder:
``.ids`` (unsigned integers, an end id after each document), ``.off`` (unsigned 64-bit
starts within the file, one more than documents) and ``.doc`` (signed 64-bit document
ids). A file's name holds the task attempt, and the manifest row that the successful
attempt returns names it, so a retried or speculative task never mixes with another.
Bases of the partitions are prefix sums over the manifest, one row a file.

Encoding. Byte-level BPE with the usual split pattern puts a token border before a
single space between non-spaces and between a letter or digit and ASCII punctuation,
whatever stands around it. A text is therefore cut there, each distinct piece of a
slice is encoded once by the tokenizers library (with a bounded cache across slices),
and ids are gathered per document. Pieces are looked up by hash, but each one's bytes are
compared with those that were encoded; pieces that only collide are encoded by
themselves. Tokenizers of another kind encode whole texts.

Files hold about ``file_bytes`` of text each (more where there would be over ``most_files``,
less where cores would be idle), and are read back by ranges of documents: mapped where
the file system is local, by ranged reads elsewhere.

Cases. Null or empty text: only the end id. Repeated document ids: kept, ordered by
text. Null document id: first, read back as null. Very long texts are one range. Empty
table: no files, no rows. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from pathlib import PurePosixPath
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import settle, shared_dir, table
from .wordhash import Words, chunks_of, eight_bytes, slices

NO_ID = np.iinfo(np.int64).min
CACHE_PIECES = 1_500_000
#: Bytes of text whose pieces are looked up at once; each look-up of new ones sorts the cache.
SLICE = 4 << 20


def _flags(*spans: tuple[int, int]) -> np.ndarray:
    x = np.zeros(256, dtype=bool)
    for a, b in spans:
        x[a : b + 1] = True
    return x


_ALNUM = _flags((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
_PUNCT = _flags((0x21, 0x7E)) & ~_ALNUM
_BEFORE = _flags((0x21, 0x7E), (0x80, 0xFF))
#: Bytes that can begin a white-space character outside ASCII are left out.
_AFTER = _BEFORE & ~_flags((0xC2, 0xC2), (0xE1, 0xE3))


class PieceEncoder:
    """Encodes many texts; caches pieces of byte-level BPE by 64-bit hash, and compares their bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.added = [x["content"].encode() for x in spec.get("added_tokens") or []]
        self.by_piece = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.int64)
        self.starts = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)
        self.bytes = np.zeros(0, dtype=np.uint8)
        self.begins = np.zeros(1, dtype=np.int64)
        self.odd: dict[bytes, int] = {}

    def _add(self, pieces: list[bytes]) -> np.ndarray:
        """Places of newly encoded pieces."""
        got = [x.ids for x in self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
        sizes = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        flat = np.fromiter((i for x in got for i in x), dtype=np.uint32, count=int(sizes.sum()))
        at = len(self.starts) - 1 + np.arange(len(pieces))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, flat])
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum([len(p) for p in pieces], dtype=np.int64)])
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(pieces), dtype=np.uint8)])
        return at

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        at = self._add(pieces)
        every = np.concatenate([self.keys, keys])
        order = np.argsort(every, kind="stable")
        self.keys, self.at = every[order], np.concatenate([self.at, at])[order]

    def _unlike(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Pieces whose bytes are not those of the known piece at their place."""
        b, e = self.begins[at], self.begins[at + 1]
        bad = end - start != e - b
        fit = np.flatnonzero(~bad)
        if len(fit):
            x, size, _, first = chunks_of(start[fit], end[fit])
            y = chunks_of(b[fit], e[fit])[0]
            bad[fit] = np.add.reduceat(eight_bytes(data, x, size) != eight_bytes(self.bytes, y, size), first) > 0
        return np.flatnonzero(bad)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, number of ids of each)."""
        n = len(offsets) - 1
        if not self.by_piece:
            raw = data.tobytes()
            got = [self.tokenizer.encode(raw[a:b].decode(), add_special_tokens=False).ids for a, b in zip(offsets[:-1], offsets[1:])]
            sizes = np.fromiter(map(len, got), dtype=np.int64, count=n)
            return np.fromiter((i for x in got for i in x), dtype=np.uint32, count=int(sizes.sum())), sizes
        cut = np.zeros(len(data) + 1, dtype=bool)
        if len(data) > 1:
            here, last = data[1:], data[:-1]
            cut[1:-1] = _ALNUM[last] & _PUNCT[here]
            cut[1:-2] |= (here[:-1] == 0x20) & _BEFORE[last[:-1]] & _AFTER[here[1:]]
        cut[offsets] = True
        raw = data.tobytes()
        for token in self.added:  # a text with such a token in it is one piece
            at = raw.find(token)
            while at >= 0:
                d = int(np.searchsorted(offsets, at, side="right"))
                cut[offsets[d - 1] + 1 : offsets[d]] = False
                at = raw.find(token, int(offsets[d]))
        border = np.flatnonzero(cut)
        start, end = border[:-1], border[1:]
        h = Words(data, offsets, start, end, border, border).hashes()
        u, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) > CACHE_PIECES:
            self._clear()
        spot = np.searchsorted(self.keys, u)
        known = np.zeros(len(u), dtype=bool)
        ok = spot < len(self.keys)
        known[ok] = self.keys[spot[ok]] == u[ok]
        new = np.flatnonzero(~known)
        if len(new):
            self._learn(u[new], [raw[start[i] : end[i]] for i in first[new]])
            spot = np.searchsorted(self.keys, u)
        at = self.at[spot][inverse]
        unlike = self._unlike(data, start, end, at)
        if len(unlike):
            odd = [raw[start[i] : end[i]] for i in unlike]
            fresh = list(dict.fromkeys(p for p in odd if p not in self.odd))
            if fresh:
                self.odd.update(zip(fresh, self._add(fresh).tolist()))
            at[unlike] = [self.odd[p] for p in odd]
        sizes = self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        source = np.arange(total) - np.repeat(ends - sizes - self.starts[at], sizes)
        piece_end = np.concatenate([[0], ends])
        per_doc = piece_end[np.searchsorted(start, offsets)]
        return self.ids[source], np.diff(per_doc)


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a full URI, and the path there."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), parts.path
    return pafs.FileSystem.from_uri(uri)


def full_uri(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark would read it by."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


def _writer(folder: str, tokenizer: str, end_id: int, dtype: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId()
        name = f"part-{part:06d}-{context.taskAttemptId()}"
        fs, root = _open_fs(folder)
        streams, encoder = None, _encoder(tokenizer)
        docs = tokens = 0
        for batch in batches:
            ids = batch.column(0).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            for a, b, data, offsets in slices(batch.column(1), SLICE):
                if streams is None:
                    fs.create_dir(root, recursive=True)
                    streams = [fs.open_output_stream(str(PurePosixPath(root, f"{name}.{x}"))) for x in ("ids", "off", "doc")]
                    streams[1].write(np.zeros(1, dtype="<u8").tobytes())
                flat, sizes = encoder.encode(data, offsets)
                flat = np.insert(flat, np.cumsum(sizes), end_id)
                ends = tokens + np.cumsum(sizes + 1)
                streams[0].write(flat.astype(dtype).tobytes())
                streams[1].write(ends.astype("<u8").tobytes())
                streams[2].write(ids[a:b].astype("<i8").tobytes())
                docs, tokens = docs + b - a, int(ends[-1])
        for s in streams or []:
            s.close()
        if docs:
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "docs": [docs], "tokens": [tokens]})

    return write


def _files(size: int, cores: int, file_bytes: int, most: int) -> int:
    """Files for ``size`` bytes of text: of ``file_bytes`` each, or larger ones if that were more than ``most``; of small tables one a core, of a megabyte at least."""
    return max(1, min(most, max(-(-size // file_bytes), min(cores, size >> 20))))


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, dtype: str = "<u4", file_bytes: int = 32 << 20, most_files: int = 200_000) -> DataFrame:
    """Write the files; the manifest has (part, file, docs, tokens, base_doc, base_token), a row a file."""
    spark = docs.sparkSession
    folder = full_uri(spark, folder)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = _files(size, spark.sparkContext.defaultParallelism, file_bytes, most_files)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    rows = settle(ordered.mapInArrow(_writer(folder, tokenizer, end_id, dtype), "part long, file string, docs long, tokens long"), "token-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # most_files rows at most
    return rows.select("*", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(b) for c, b in (("docs", "base_doc"), ("tokens", "base_token"))))


class _Ranged:
    """An array in a file, read by ranges; mapped where the file is local."""

    def __init__(self, fs: pafs.FileSystem, path: str, kind: str):
        self.kind = np.dtype(kind)
        local = isinstance(fs, pafs.LocalFileSystem)
        self.mapped = np.memmap(path, dtype=kind, mode="r") if local and os.path.getsize(path) else None
        self.file = None if local else fs.open_input_file(path)

    def get(self, a: int, b: int) -> np.ndarray:
        if self.file is not None:
            return np.frombuffer(self.file.read_at((b - a) * self.kind.itemsize, a * self.kind.itemsize), dtype=self.kind)
        return self.mapped[a:b] if self.mapped is not None else np.zeros(0, dtype=self.kind)


def _reader(folder: str, dtype: str, rows: int = 1024):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open_fs(folder)
        for batch in batches:
            for r in batch.to_pylist():
                ids, off, doc = (_Ranged(fs, f"{root}/{r['file']}.{x}", k) for x, k in (("ids", dtype), ("off", "<u8"), ("doc", "<i8")))
                for a in range(0, r["docs"], rows):
                    b = min(a + rows, r["docs"])
                    at = off.get(a, b + 1).astype(np.int64)
                    own = ids.get(int(at[0]), int(at[-1]))
                    crc = [zlib.crc32(np.ascontiguousarray(own[x:y], dtype="<u4")) for x, y in zip(at[:-1] - at[0], at[1:] - at[0])]
                    d = np.array(doc.get(a, b))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(d, pa.int64(), mask=d == NO_ID),
                            "start": pa.array(r["base_token"] + at[:-1], pa.int64()),
                            "n_tokens": pa.array(np.diff(at), pa.int64()),
                            "ids_crc32": pa.array(crc, pa.int64()),
                        }
                    )

    return read


def read_token_files(manifest: DataFrame, folder: str, dtype: str = "<u4") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the mapped files."""
    spark = manifest.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n).mapInArrow(_reader(full_uri(spark, folder), dtype), "doc_id long, start long, n_tokens long, ids_crc32 long")


def id_type(tokenizer: str) -> str:
    """The narrowest unsigned type that holds every id of the vocabulary."""
    return "<u2" if _encoder(tokenizer).tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def token_table(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and read them back."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    folder = shared_dir(docs.sparkSession, "token-files")
    dtype = id_type(tokenizer)
    return read_token_files(write_token_files(docs, folder, tokenizer, dtype=dtype), folder, dtype)


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of the whole of ``documents``, read back."""
    return token_table(table(spark, sf_dir, "documents"))
