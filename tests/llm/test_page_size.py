"""Wide, deep and long pages: matching costs little more than the page, and folding loses no text."""

import random
import time
import tracemalloc
from collections import Counter

import pytest

from apronlake.llm import html_text as H


def table_page(rows, seed=1):
    r = random.Random(seed)
    cell = lambda i: f"<td>{i}</td><td>{'<a>x</a>' if r.random() < 0.5 else ''}<p>text {i}</p></td>" if r.random() < 0.7 else f"<th>{i}</th>"
    return f"<html><body><div class='c'><table>{''.join(f'<tr>{cell(i)}</tr>' for i in range(rows))}</table></div><p>end</p></body></html>"


def test_a_table_of_thousands_of_rows():
    page = table_page(5000)
    start = time.time()
    tracemalloc.start()
    tree = H.skeleton(H.parse(page))
    found = H.align(tree, H.skeleton(H.parse(table_page(5000, seed=2))))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 200e6 and time.time() - start < 60 and found


def test_many_siblings_of_their_own_labels():
    page = "<body>" + "".join(f"<div class='i{i}'><p>text {i}</p></div>" for i in range(6000)) + "</body>"
    tree = H.skeleton(H.parse(page))
    start = time.time()
    found = H.align(tree, tree)
    assert time.time() - start < 30 and len(found) == 6000 and all(node >= 0 for node, *_ in found)


def test_deep_nesting_and_stray_end_tags():
    start = time.time()
    root = H.parse("<div>" * 20_000 + "x" + "</p></div>" * 20_000 + "</b>" * 20_000 + "<p>after")
    assert time.time() - start < 20 and H.blocks(root) == ["x", "after"]


def _texts_by_path(root):
    """(path, hash) of every text of a tree as it was parsed, without folding."""
    out, todo = Counter(), [(root, root.label, 0)]
    while todo:
        x, path, depth = todo.pop()
        text, kids = ("", []) if x.aside else H.own_text(x)
        if text:
            out[path, H.text_hash(text)] += len(text)
        todo += [(k, path if depth >= H.DEEP else f"{path}/{k.label}", depth + 1) for k in kids]
    return out


@pytest.mark.parametrize("wide", [0, 2, 32])
def test_folding_keeps_every_text_at_its_path(monkeypatch, wide):
    monkeypatch.setattr(H, "WIDE", wide)
    r = random.Random(wide)

    def tree(depth):
        if not depth or r.random() < 0.2:
            return f"w{r.randrange(9)}"
        tag = r.choice(["div", "div class=a", "div class=b", "p", "ul", "li", "table", "tr", "td", "section"])
        return f"<{tag}>{r.choice(['', 'own '])}{''.join(tree(depth - 1) for _ in range(r.randrange(5)))}</{tag.split()[0]}>"

    for _ in range(60):
        root = H.parse("<body>" + "".join(tree(4) for _ in range(r.randrange(8))) + "</body>")
        got = Counter()
        for _, path, _, h, n in H.align(H.skeleton(root), H.skeleton(root)):
            got[path, h] += n
        assert got == _texts_by_path(root)


def test_one_rule_for_every_number_of_pages(spark):
    """A constant paragraph goes where its share is evidence enough, by one bound: at 14 pages and more."""
    page = "<body><div class=head>The Site</div><div class=body-text><h1>Head {n}</h1><p>Words of story {n}, told at some length, with {n} more.</p><div class=join><p>Join us</p></div></div></body>"
    rows = [(100 * k + i, f"http://h{k}.example/{i}", page.format(n=i)) for k in (9, 13, 14, 40) for i in range(k)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    has = {}
    for r in H.extract_pages(df).collect():
        has.setdefault(r.page_id // 100, set()).add("Join us" in r.text)
    assert has == {9: {True}, 13: {True}, 14: {False}, 40: {False}}
