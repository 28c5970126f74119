"""License scans row by row, whole texts, and the SQL on the same odd rows."""

import os
from collections import Counter

import duckdb
import pytest

from apronlake.llm import licenses as L

FOLDER = "/usr/share/common-licenses"
FILES = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}


def _rows():
    notice = "Released under the MIT License."
    known = {name: text for name, text in L.KNOWN if len(text) > 200}
    texts = [notice, notice, f"{notice}\n{notice}", None, "plain", *known.values()]
    heads = ["Copyright 2020 A", "Copyright notice of this text", "copyright A. Person", "(c) x", "All rights reserved", " * Copyright (c) B", "copyright holders may"]
    texts += [f"{h}\n\n{known['BSD-3-Clause']}" for h in heads]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[2]), (None, notice), (None, "plain"), (None, None)]
    return rows + [(10 + i, t) for i, t in enumerate(texts)]


def test_rows_are_told_apart(spark):
    docs = spark.createDataFrame(_rows(), "doc_id long, text string")
    got = Counter((r.doc_id, r.whole, r.n_notices, r.licenses) for r in L.scan_licenses(docs).collect())
    assert got[(1, "MIT", 1, "MIT")] == 2 and got[(1, None, 2, "MIT")] == 1
    assert got[(None, "MIT", 1, "MIT")] == 1 and got[(None, None, 0, "")] == 2
    assert {"BSD-2-Clause", "BSD-3-Clause", "0BSD", "Zlib", "MIT", "ISC"} <= {k[1] for k in got}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", _rows())
    assert Counter(con.execute(L.ORACLE_SQL).fetchall()) == got


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no license texts on this machine")
def test_whole_texts_of_long_licenses(spark):
    rows = [(i, open(f"{FOLDER}/{f}", encoding="utf-8").read()) for i, f in enumerate(FILES)]
    docs = spark.createDataFrame([*rows, (99, rows[0][1][:-200])], "doc_id long, text string")
    got = {r.doc_id: r.whole for r in L.scan_licenses(docs).collect()}
    assert [got[i] for i in range(len(rows))] == list(FILES.values()) and got[99] is None
