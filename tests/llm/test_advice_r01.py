"""Whole results where a first form of an operator cut them short."""

import random
import textwrap
from collections import Counter

import pytest

from apronlake.llm import html_text, licenses, near_dedup
from apronlake.llm.wordhash import slices


def _runs(text, n=5):
    w = text.split()
    return Counter(tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1)))


def _near(a, b):
    a, b = _runs(a), _runs(b)
    return sum((a & b).values()) >= 0.8 * sum((a | b).values())


def _crowd():
    """Pairs of near copies that all share one bucket of a single band, and are unlike all but their partner."""
    import pyarrow as pa

    r = random.Random(11)
    base = [f"w{r.randrange(500)}" for _ in range(200)]
    texts = []
    for i in range(80):
        w = list(base)
        for k in range(0, 200, 25):
            w[k + i % 7] = f"own{i}x{k}"
        texts += [" ".join(w), " ".join([*w, f"more{i}"])]
    _, _, data, offsets = next(slices(pa.array(texts)))
    doc, run, count = near_dedup.weighted_runs(data, offsets)
    hashes = near_dedup.band_hashes(near_dedup.dart_signatures(doc, run, count, len(texts), 1), 1)[:, 0].tolist()
    usual = Counter(hashes).most_common(1)[0][0]
    return [t for i in range(80) for t in texts[2 * i : 2 * i + 2] if hashes[2 * i] == hashes[2 * i + 1] == usual]


@pytest.mark.parametrize("block_rows", [2000, 9])
def test_near_dedup_finishes_crowded_buckets(spark, block_rows):
    texts = _crowd()
    assert len(texts) > 40
    parent = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if _near(texts[i], texts[j]):
                x, y = parent[i], parent[j]
                parent = [min(x, y) if p in (x, y) else p for p in parent]
    assert len(set(parent)) > 10
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(docs, bands=1, rows=1, block_rows=block_rows).collect()}
    assert got == dict(enumerate(parent))


def test_licenses_in_wrapped_layouts(spark):
    full = [(name, text) for name, text in licenses.KNOWN if len(text) > 200]
    wrap = lambda t, n: "\n".join(textwrap.fill(x, n) for x in t.split("\n"))
    for _, text in full:
        assert {licenses.canonical_text(wrap(text, n)) for n in range(20, 140)} == {licenses.canonical_text(text)}
    isc = next(t for n, t in full if n == "ISC").replace("the above copyright", "the above\ncopyright")
    heads = ["Copyright (c) 2020 Somebody", "Copyright 2019-2021 A and B", "(c) 2020 A", "(c) A", "© A", "Copyright Somebody Ltd.", " * Copyright: 2020 by A", "(C) Copyright A 2001", "(Copyright 2020, A)", "Copyright [yyyy] [name of copyright owner]", "All rights reserved."]
    texts = [isc, *(f"{h}\n\n{wrap(isc, 60)}" for h in heads)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.whole for r in sorted(licenses.scan_licenses(docs).collect())] == ["ISC"] * len(texts)
    own = ["copyright notice and this", "copyright holders be liable", "copyright owner that is", "copyright"]
    assert all(licenses.canonical_text(x) for x in own)
    assert licenses.canonical_text("\n".join(heads)) == ""


def test_html_text_takes_no_other_hosts_wrapper(spark):
    page = "<html><body><div class='content'><h1>Head {n}</h1><p>Words of page {n}</p></div></body></html>"
    other = "<html><body><article><p>Story {n} of the other host</p></article></body></html>"
    odd = "<html><body><div class='content'><p>Small box</p></div><main><article><p>The story itself</p></article></main></body></html>"
    rows = [(i, f"http://a.example/{i}", page.format(n=i)) for i in range(4)] + [(10 + i, f"http://b.example/{i}", other.format(n=i)) for i in range(40)]
    df = spark.createDataFrame([*rows, (99, "http://b.example/odd", odd)], "page_id long, url string, html string")
    small, large = ({r.page_id: r.text for r in html_text.extract_pages(df, broadcast_paths=n).collect()} for n in (1000, 0))
    assert small == large and small[99] == "The story itself" and small[2] == "Head 2\nWords of page 2"


def test_html_text_keeps_text_whose_names_hold_a_role_word():
    own = "<h2 id='search-results'>A</h2><h2 id='search'>B</h2><p id='notice-1'>C</p><section id='related-work'><p>D</p></section><figure class='banner'><figcaption>E</figcaption></figure><div class='alert-box'>F</div><p class='notice'>G</p>"
    aside = "<div class='wide ad'>x</div><ul id=menu><li>x</ul><section class='comments'>x</section><div role=dialog>x</div><nav>x</nav><form>x</form>"
    assert html_text.main_text(f"<body><article>{own}{aside}</article>", "#/html/body/article") == "\n".join("ABCDEFG")
