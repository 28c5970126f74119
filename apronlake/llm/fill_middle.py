"""Fill-in-the-middle: texts cut in prefix, middle and suffix, and put in another order.

A text is cut in units (lines, or characters) at two places that hashes of its doc_id
choose; a document is plain, psm or spm by two hashes more. Cuts of lines are byte
positions and are wanted in characters; cuts of characters are wanted in bytes. A sparse
exception index says the one from the other: it has only the multibyte characters of a
slice of texts, where each begins and how many bytes over one have gone before, so a
searchsorted converts any cut, and between two exceptions (all of an ASCII text) a
position is converted by one subtraction. Nothing is decoded.

Rows stay where they are: no shuffle, and no task holds more than a slice of texts beside
its Arrow batch. The choice of cuts depends on doc_id and seed alone, so reruns, retried
tasks and other partitionings agree.

Cases. Null text counts as empty; empty texts and texts that hold a marker are plain, with
null prefix_chars and middle_chars. A null doc_id hashes as the seed with nothing after
it. Rows of one doc_id have the same hashes; each is cut by its own units. A last line
without a line feed is a unit; a line feed ends one, and no other character does. Very
long texts are read whole. Empty table: no rows. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table
from .wordhash import slices

#: Markers of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass
class ByteIndex:
    """Multibyte characters of some UTF-8 bytes: the first byte of each, and the excess bytes before and with it."""

    at: np.ndarray
    excess: np.ndarray  # one more than characters: the sum before each, and the whole

    @classmethod
    def of(cls, data: np.ndarray) -> ByteIndex:
        at = np.flatnonzero(data >= 0xC0)
        lead = data[at]
        over = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        return cls(at, np.concatenate([[0], np.cumsum(over)]))

    def characters(self, cut: np.ndarray) -> np.ndarray:
        """Characters before byte cuts that fall between two characters."""
        return cut - self.excess[np.searchsorted(self.at, cut)]

    def bytes(self, cut: np.ndarray) -> np.ndarray:
        """Bytes before cuts given in characters."""
        return cut + self.excess[np.searchsorted(self.at - self.excess[:-1], cut)]


def _line_cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends of lines as bytes, lines before each text and in all)."""
    end = data == 0x0A
    last = offsets[1:][np.diff(offsets) > 0] - 1
    end[last] = True
    ends = np.flatnonzero(end) + 1
    return ends, np.searchsorted(ends, offsets, side="right")


def cuts(data: np.ndarray, offsets: np.ndarray, h: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(units, byte cuts, character cuts) of each text; cuts are (2, texts) and count from the text's start."""
    index = ByteIndex.of(data)
    begin = offsets[:-1]
    first = index.characters(offsets)
    if unit == "lines":
        ends, before = _line_cuts(data, offsets)
        n = np.diff(before)
        place = np.sort(h[:2] % (n + 1), axis=0)
        at = np.where(place == 0, begin, np.append(ends, 0)[before[:-1] + place - 1])
        return n, at - begin, index.characters(at) - first[:-1]
    n = np.diff(first)
    place = np.sort(h[:2] % (n + 1), axis=0)
    return n, index.bytes(first[:-1] + place) - begin, place


def _forms(h: np.ndarray, marked: np.ndarray, rate: int, spm: int) -> np.ndarray:
    """0 plain, 1 psm, 2 spm."""
    return np.where(marked | (h[2] % 100 >= rate), 0, np.where(h[3] % 100 < spm, 2, 1))


def _rewrite(unit: str, rate: int, spm: int):
    marks = [m.encode() for m in MARKS]
    p, s, m = marks

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.stack([batch.column(2 + i).to_numpy() for i in range(4)])
            for a, b, data, offsets in slices(batch.column(1)):
                h = hashes[:, a:b]
                n, at, chars = cuts(data, offsets, h, unit)
                raw = data.tobytes()
                texts = [raw[x:y] for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                marked = np.fromiter((not t or any(x in t for x in marks) for t in texts), dtype=bool, count=len(texts))
                form = _forms(h, marked, rate, spm)
                out = []
                for t, kind, x, y in zip(texts, form.tolist(), *at.tolist()):
                    if kind == 0:
                        out.append(t)
                    elif kind == 1:
                        out.append(b"".join((p, t[:x], s, t[y:], m, t[x:y])))
                    else:
                        out.append(b"".join((s, t[y:], p, t[:x], m, t[x:y])))
                plain = form == 0
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).slice(a, b - a),
                        "n": pa.array(n, pa.int64()),
                        "form": pa.array(np.array(["plain", "psm", "spm"], dtype=object)[form], pa.string()),
                        "prefix_chars": pa.array(chars[0], pa.int64(), mask=plain),
                        "middle_chars": pa.array(chars[1] - chars[0], pa.int64(), mask=plain),
                        "output": pa.array(out, pa.binary()).cast(pa.string()),
                    }
                )

    return rewrite


def _hash(doc_id: Column, seed: int, i: int) -> Column:
    """The i-th eight hex digits of sha256("seed:doc_id"), as a number."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(named, 256), 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i}")


def fill_in_middle(docs: DataFrame, unit: str = "lines", rate: int = 100, spm: int = 50, seed: int = 7) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs``.

    ``unit``: "lines" or "characters". ``rate``: per cent of texts that are cut; ``spm``: per
    cent of these whose suffix comes first.
    """
    if unit not in ("lines", "characters"):
        raise ValueError(f"unit is lines or characters, not {unit}")
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), "text", *(_hash(doc_id, seed, i) for i in range(4)))
    return rows.mapInArrow(_rewrite(unit, rate, spm), SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of: its parts, cut at the markers, in their old order."""
    part = F.split(output, "|".join(MARKS), -1)
    one, two, middle = part[1], part[2], part[3]
    return F.when(form == "plain", output).when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents``, cut at lines; digests of the output and of the text rebuilt from it."""
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256")
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
h AS (
  SELECT doc_id, t, u, len(u)::BIGINT AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
         ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d),
f AS (
  SELECT doc_id, t, u, n, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT *, array_to_string(u[1:i], '') AS a, array_to_string(u[i + 1:j], '') AS m, array_to_string(u[j + 1:], '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || a || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p
"""
