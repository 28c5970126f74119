"""CSV files of differing headers as one table.

Headers are read in tasks, a few kilobytes of each file, up to the end of the first record
(which may hold quoted commas, quotes and line breaks). Data is one scan of all files by
position; each file's rows find a field at the place that its own header gives it, so no
list of files or headers reaches the driver, and Spark packs files of any header together.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apronlake.operators.joins import small

from .landing import strings

#: Bytes of a file that are read first; more only while its first record has not ended.
FIRST_BYTES = 4096


def first_record(read, size: int) -> tuple[list[str], int]:
    """(cells of the first record, bytes read); ``read(n)`` gives the next n bytes of a file of ``size``."""
    got = b""
    while True:
        got += read(max(FIRST_BYTES, 3 * len(got)))
        text = got.decode("utf-8-sig", "ignore")
        quoted = False
        for i, c in enumerate(text):
            quoted ^= c == '"'
            if c in "\r\n" and not quoted:
                return next(csv.reader(io.StringIO(text[:i], newline="")), []), len(got)
        if len(got) >= size:
            return next(csv.reader(io.StringIO(text, newline="")), []), len(got)


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for path, size, file in zip(frame["path"], frame["length"], frame["file"]):
            parts = urlparse(path)
            fs, name = (pafs.LocalFileSystem(), unquote(parts.path)) if parts.scheme in ("", "file") else pafs.FileSystem.from_uri(path)
            with fs.open_input_stream(name) as f:
                names, n = first_record(f.read, int(size))
            rows.append((path, file, [x.strip() for x in names], n))
        yield pd.DataFrame(rows, columns=["path", "file", "names", "bytes"])


def read_headers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, file, names, bytes): the header of each file, and how much of it was read; ``file`` as ``_metadata`` spells it."""
    files = spark.read.format("binaryFile").load(paths).select("path", "length", F.col("_metadata.file_path").alias("file"))  # no content is read
    return files.mapInPandas(_read, "path string, file string, names array<string>, bytes long")


def conform(spark: SparkSession, paths: str | list[str], keep: list[str], id_name: str = "_station_id", split: bool = False) -> DataFrame:
    """The wanted fields of all files as strings, verbatim, NULL where a file has no such field, and the file's name.

    Of equal names in a header the first counts. Records shorter than the header have NULL
    for what they lack. ``split``: no cell holds a line break, so large files are read in parts.
    """
    headers = read_headers(spark, paths)
    widest = headers.agg(F.max(F.size("names"))).first()[0] or 1
    place = lambda k: F.nullif(F.array_position("names", k), F.lit(0)).cast("int")
    places = headers.select(F.col("file").alias("_of"), *(place(k).alias(f"_{i}") for i, k in enumerate(keep)))
    raw = spark.read.schema(strings([f"c{i}" for i in range(widest)])).options(header=True, enforceSchema=True, multiLine=not split, escape='"').csv(paths)
    rows = raw.select("*", F.col("_metadata.file_path").alias("_file"))
    met = rows.join(small(places), F.col("_file") == F.col("_of"))
    cells = F.array(*(F.col(f"c{i}") for i in range(widest)))
    name = F.regexp_extract(F.url_decode(F.replace("_file", F.lit("+"), F.lit("%2B"))), r"([^/]+)\.[^./]*$", 1)
    return met.select(name.alias(id_name), *(F.get(cells, F.col(f"_{i}") - 1).alias(k) for i, k in enumerate(keep)))

