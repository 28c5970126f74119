"""Wrapper induction: alignment by brute force, pages without an article, templates inside the content, odd rows."""

import random
from collections import Counter
from functools import cache

import pytest

from apronlake.llm import html_text as H


def _nested(r, depth):
    return [r.choice("abc"), 0, 0, 0, [_nested(r, depth - 1) for _ in range(r.randrange(4))] if depth else []]


def _freeze(t):
    return t[0], tuple(_freeze(c) for c in t[4])


@cache
def _brute(a, b):
    """Largest order-preserving match, all ways to pair the first children tried."""
    if a[0] != b[0]:
        return 0

    @cache
    def rows(i, j):
        if i == len(a[1]) or j == len(b[1]):
            return 0
        return max(rows(i + 1, j), rows(i, j + 1), _brute(a[1][i], b[1][j]) + rows(i + 1, j + 1))

    return 1 + rows(0, 0)


def test_tree_match_equals_brute_force():
    r = random.Random(8)
    for _ in range(150):
        a, b = _nested(r, 3), _nested(r, 3)
        b[0] = a[0] if r.random() < 0.8 else b[0]
        assert H.tree_match(a, b) == _brute(_freeze(a), _freeze(b))


def test_alignment_names_the_same_nodes():
    page = lambda n, extra="": H.skeleton(H.parse(f"<body><div class=top>Site</div>{extra}<div class=text><p>Story {n}</p></div></body>"))
    rows = {path.rsplit("/", 1)[-1]: node for node, path, *_ in H.align(page(1), page(2, "<div class=new>Extra</div>"))}
    plain = {path.rsplit("/", 1)[-1]: node for node, path, *_ in H.align(page(1), page(1))}
    assert rows["div.new"] == -1 and rows["div.top"] == plain["div.top"] and rows["p"] == plain["p"]


PAGE = "<body><div class=head><p>The Site</p><p>All the news of {h}</p></div><div class=side><p>Best of {h}</p><p>More of {h}</p></div><div class=body-text><h1>Head {n}</h1><p>Words of story {n}, told at some length.</p><p>{tail}</p><div class=join><p>Join us on the list</p></div></div><div class=end>Imprint of {h}</div></body>"


def _texts(spark, rows, **how):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return H.extract_pages(df, **how).collect()


def test_content_without_an_article_and_template_inside_it(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.format(n=i, h="a", tail=f"Ending {i % 4}")) for i in range(20)]
    got = {r.page_id: r.text for r in _texts(spark, rows)}
    for i in range(20):
        assert got[i] == f"Head {i}\nWords of story {i}, told at some length.\nEnding {i % 4}"
        assert H.main_text(rows[i][2], "#/none") != got[i]  # without a wrapper the whole body comes


def test_copies_of_one_page_lose_nothing(spark):
    story = "".join(f"<p>Paragraph {k} of the one story</p>" for k in range(8))
    rows = [(i, f"http://c.example/{i}", f"<body><div class=x><h1>Copy {i}</h1>{story}</div></body>") for i in range(30)]
    rows += [(100 + i, f"http://c.example/{i}", rows[0][2]) for i in range(30)]
    want = "\n".join(f"Paragraph {k} of the one story" for k in range(8))
    assert all(r.text.endswith(want) for r in _texts(spark, rows))


@pytest.mark.parametrize("paths", [1000, 0])
def test_null_and_repeated_rows_come_back(spark, paths):
    rows = [(i, f"http://a.example/{i}", PAGE.format(n=i, h="a", tail="z")) for i in range(6)]
    rows += [(None, "http://a.example/n", PAGE.format(n="n", h="a", tail="z")), (3, "http://a.example/other", PAGE.format(n="other", h="a", tail="z")), rows[2], (None, None, None), (50, "http://b.example/", "")]
    got = Counter((r.page_id, r.url, "Head" in r.text) for r in _texts(spark, rows, broadcast_paths=paths))
    assert got == Counter((p, u, bool(h)) for p, u, h in rows)
    assert sum(r.n_chars != len(r.text) for r in _texts(spark, rows, broadcast_paths=paths)) == 0


def test_deep_pages(spark):
    deep = lambda n: "<body>" + "<div>" * n + "Low <b>down</b>" + "</div>" * n + "<blockquote>" * n + "End"
    rows = [(i, "http://d.example/", deep(5000 + i)) for i in range(3)]
    assert {r.text for r in _texts(spark, rows)} == {"Low down\nEnd"}


def test_an_odd_pivot_does_not_spoil_its_host(spark):
    rows = [(0, "http://a.example/0", "<body><table><tr><td>Odd</td></tr></table></body>")]
    rows += [(i, f"http://a.example/{i}", PAGE.format(n=i, h="a", tail="z")) for i in range(1, 9)]
    got = {r.page_id: r.text for r in _texts(spark, rows)}
    assert got[0] == "Odd" and got[4].startswith("Head 4\nWords of story 4") and "Site" not in got[4]


def test_role_words_are_whole_class_names():
    page = "<body><div class='content no-sidebar'><p class=related-work>Kept</p><div class=sidebar>gone</div></div></body>"
    assert H.main_text(page, "#/html/body") == "Kept"
