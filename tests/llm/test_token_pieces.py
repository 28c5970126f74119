"""Pieces that collide in their hash still get the tokenizer's own ids; files of fixed size, ranged reads."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from tokenizers import Tokenizer

from apronlake.llm import token_files
from apronlake.llm.wordhash import Words, slices

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _thue_morse(n):
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def _encoded(texts):
    encoder, out = token_files.PieceEncoder(PATH), []
    for _, _, data, offsets in slices(pa.array(texts), 300):
        ids, sizes = encoder.encode(data, offsets)
        ends = np.cumsum(sizes)
        out += [ids[e - n : e].tolist() for e, n in zip(ends, sizes)]
    return out


def _texts():
    r = random.Random(2)
    words = ["a", "bb", "the", "été", "it's", "12", "x!", "longer-word", "  two", "\n\n"]
    return [" ".join(r.choice(words) for _ in range(r.randrange(0, 40))) for _ in range(60)] + list(_thue_morse(11))


def test_colliding_pieces(monkeypatch):
    texts = _texts()
    known = Tokenizer.from_file(PATH)
    want = [known.encode(t, add_special_tokens=False).ids for t in texts]
    assert _encoded(texts) == want
    for weak in (lambda self, seed=0: np.zeros(len(self.start), np.uint64), lambda self, seed=0: (self.end - self.start).astype(np.uint64)):
        monkeypatch.setattr(Words, "hashes", weak)
        assert _encoded(texts) == want


def test_thue_morse_words_do_not_collide():
    a, b = _thue_morse(11)
    data = np.frombuffer((a + b).encode(), dtype=np.uint8)
    at = np.array([0, len(a), 2 * len(a)])
    h = Words(data, at, at[:-1], at[1:], np.array([0, 1, 2]), np.array([0, 1])).hashes()
    assert h[0] != h[1]


def test_many_small_files(spark):
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder = token_files.shared_dir(spark, "small-files")
    manifest = token_files.write_token_files(docs, folder, PATH, file_bytes=1000)
    assert manifest.count() > 3
    got = sorted(token_files.read_token_files(manifest, folder).collect())
    assert got == sorted(token_files.token_table(docs).collect()) and len(got) == len(texts)
    assert token_files.full_uri(spark, "/tmp/x").startswith("file:")


def test_ranged_reads_equal_mapped_ones(tmp_path):
    np.arange(100, dtype="<u2").tofile(tmp_path / "x.ids")
    mapped = token_files._Ranged(pafs.LocalFileSystem(), str(tmp_path / "x.ids"), "<u2")
    ranged = token_files._Ranged(pafs.SubTreeFileSystem(str(tmp_path), pafs.LocalFileSystem()), "x.ids", "<u2")
    assert ranged.file is not None
    assert ranged.get(7, 31).tolist() == mapped.get(7, 31).tolist() == list(range(7, 31))
