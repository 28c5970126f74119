"""Long licenses in other layouts than that of the file from which their digest was made."""

import os
import re
import textwrap

import duckdb
import pytest

from apronlake.llm import licenses as L

FOLDER = "/usr/share/common-licenses"
FILES = {
    "Apache-2.0": "Apache-2.0", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0",
    "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3",
}


def layouts(text):
    """The words of each paragraph at several widths, and each paragraph in one line."""
    parts = [" ".join(p.split()) for p in re.split(r"\n\s*\n", text) if p.strip()]
    yield text
    for width in (60, 72, 80):
        yield "\n\n".join(textwrap.fill(p, width, break_on_hyphens=False, break_long_words=False) for p in parts)
    yield "\n\n".join(parts)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no license texts on this machine")
def test_long_licenses_at_every_width(spark):
    texts = {n: open(f"{FOLDER}/{f}", encoding="utf-8").read() for f, n in FILES.items() if os.path.exists(f"{FOLDER}/{f}")}
    rows = [(n, k, t) for n, text in texts.items() for k, t in enumerate(layouts(text))]
    docs = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(rows)], "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.whole for r in L.scan_licenses(docs).collect()}
    missed = [(n, k) for i, (n, k, _) in enumerate(rows) if got[i] != n]
    assert not missed
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, (_, _, t) in enumerate(rows)])
    assert {r[0]: r[1] for r in con.execute(L.ORACLE_SQL).fetchall()} == got


def test_spellings_are_of_whole_words():
    assert L.canonical_text("an unauthorised licence, in favour of licencees") == "an unauthorized license in favor of licencees"
    assert L.canonical_text("favourite organisational licences") == "favourite organisational licenses"


def test_statements_stand_alone():
    body = "Permission is given\nCopyright law, and (c) you must keep it\nwhole"
    kept = L.canonical_text(body)
    assert kept == "permission is given copyright law and c you must keep it whole"
    for head in ("Copyright 2020 A\n", "(c) 2020 A\n\n", "\n\n© A\nAll rights reserved\n\n", "Title\n\nCopyright A\n\n"):
        assert L.canonical_text(head + body) in (kept, f"title {kept}")
    assert L.canonical_text("(c) You must retain, in the Source form of any Derivative Works") != ""
    assert L.canonical_text("Copyright 2020 A\n" * 20_000 + body) == kept
