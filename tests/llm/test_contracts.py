"""Operators against brute force on small messy tables: nulls, empty, long and repeated rows, extra columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from apronlake.llm import decontaminate, exact_dedup, html_text, licenses, mixing, near_dedup, queries, secrets, substring_dedup, token_files

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _texts():
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["été", "the", "of,", "x y"]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage, base = say(20), say(120).split(" ")
    out = [None, "", " \t\n", "one", "a b c", "a  b\tc", say(5000)]
    for i in range(12):  # near copies
        w = list(base)
        for k in range(i % 4):
            w[(17 * k + 29 * i) % 120] = f"edit{i}{k}"
        out.append(" ".join(w))
    out += [" ".join(base), "  " + "\n".join(base), " ".join(base)]
    out += [f"{say(30)} {passage} {say(30)}" for _ in range(6)] + [passage, f"{passage} {passage}", (say(7) + "\n") * 9]
    return out + [say(r.randrange(1, 80)) for _ in range(30)]


@pytest.fixture(scope="module")
def texts():
    return _texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", None if i % 7 == 0 else f"s{i % 5}", len(t or ""), i * 2, "clash", 0.5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rank long, digest string, score double").repartition(3).cache()


def table(df):
    return {r.doc_id: r for r in df.collect()}


def empty(docs):
    return docs.where("doc_id < -1")


def words(t):
    return WORDS.findall(t or "")


def runs(t, n=5):
    w = words(t)
    return Counter(tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))) if w else Counter()


def test_near_dedup_finds_all_classes(docs, texts):
    got = table(near_dedup.near_classes(docs))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [runs(t) for t in texts]
    for i, a in enumerate(bags):
        for j in range(i):
            if a and bags[j] and sum((a & bags[j]).values()) >= 0.8 * sum((a | bags[j]).values()):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    assert len(got) == len(texts)
    assert {i: got[i].class_id for i in got} == {i: find(i) for i in range(len(texts))}
    sizes = Counter(find(i) for i in range(len(texts)))
    assert all(got[i].class_size == sizes[find(i)] and got[i].kept == (i == find(i)) for i in got)
    assert near_dedup.near_classes(empty(docs)).count() == 0


def test_dart_signatures_estimate_weighted_similarity():
    r = np.random.default_rng(5)
    n, k = 400, 512
    element = np.arange(n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a, b = r.gamma(1.0, 2.0, n), r.gamma(1.0, 2.0, n)
    b[:250] = a[:250]
    doc = np.repeat([0, 1, 2], n)
    sig = near_dedup.dart_signatures(doc, np.tile(element, 3), np.concatenate([a, b, a * 0.5]), 3, k)
    assert (sig != 0).all()
    for other, x, y in ((1, a, b), (2, a, a * 0.5)):
        want = np.minimum(x, y).sum() / np.maximum(x, y).sum()
        assert abs((sig[0] == sig[other]).mean() - want) < 4 * np.sqrt(want * (1 - want) / k)
    assert near_dedup.weighted_jaccard(pa.array(["a b c d e f", "x"]), pa.array(["a b c d e g", "x"])).tolist() == pytest.approx([1 / 3, 1.0])


def test_substring_dedup(docs, texts):
    got = table(substring_dedup.drop_repeats(docs, shard_words=40, query_words=60))
    owner = {}
    for i, t in enumerate(texts):
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - 12):
            if owner.setdefault(tuple(w[j : j + 13]), i) < i:
                gone[j : j + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()), i
    assert substring_dedup.drop_repeats(empty(docs)).count() == 0
    odd = docs.where("doc_id IN (7, 19)").withColumn("doc_id", F.lit(None).cast("long")).union(docs.where("doc_id = 7")).union(docs.where("doc_id = 7"))
    assert [r.n_removed for r in substring_dedup.drop_repeats(odd).collect()] == [0, 0, 0, 0]


def test_suffix_automaton_matches_brute_force():
    r = random.Random(9)
    for _ in range(60):
        sides = [[[r.choice("abc") for _ in range(r.randrange(1, 14))] for _ in range(3)] for _ in range(2)]
        sam = substring_dedup.SuffixAutomaton()
        for s in sides[0]:
            sam.add(s)
        known = {tuple(s[i : i + 4]) for s in sides[0] for i in range(len(s) - 3)}
        for q in sides[1]:
            want = [False] * len(q)
            for i in range(len(q) - 3):
                if tuple(q[i : i + 4]) in known:
                    want[i : i + 4] = [True] * 4
            have = [False] * len(q)
            for a, b in sam.repeats(q, 4):
                have[a:b] = [True] * (b - a)
            assert have == want


@pytest.mark.parametrize("block_windows", [50_000, 4])
def test_decontamination(spark, docs, texts, block_windows):
    bench = [(1, " ".join(words(texts[22])[40:53])), (2, "A B, c"), (3, None), (4, ""), (10, texts[28]), (5, texts[28])]
    bench = [(i, t) for i, t in bench]
    got = table(decontaminate.find_contamination(docs, spark.createDataFrame(bench, "item_id long, text string"), block_windows=block_windows))
    windows = defaultdict(set)
    for i, t in bench:
        w = ITEM.findall((t or "").translate(LOWER))
        for j in range(max(len(w) - 13, 0) + 1 if w else 0):
            windows[tuple(w[j : j + 13])].add(str(i))
    for i, t in enumerate(texts):
        w = ITEM.findall((t or "").translate(LOWER))
        hit, items = set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    items |= windows[tuple(w[j : j + n])]
        want = (len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
        assert tuple(got[i])[1:] == want, i
    assert any(r.contaminated for r in got.values())
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(docs, nothing).where("n_hit > 0").count() == 0
    assert decontaminate.find_contamination(empty(docs), nothing).count() == 0


def test_secrets_base_spans_and_format(spark):
    r = random.Random(4)
    key = lambda: "".join(r.choice("0123456789abcdef") for _ in range(40))
    texts = [f"été word token = \"{key()}\" and more{i}" for i in range(40)] + [None, "", "Password: short", "API-key=abcdefgh1 apikey='x.y/z+w=1234'", f"lost {key().upper()} here", "AKIA" + "Z" * 14, "aKIA" + "Q" * 20, "token token= abcdefgh 7844238401328224 7844238401328225"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = secrets.learn_format(docs)
    got = table(secrets.find_secrets(docs, known))
    assign = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
    for i, t in enumerate(texts):
        t = t or ""
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 8]
        spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
        base = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        row = got[i]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == x for _, k, _ in spans) for x in range(3))
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) - {""} <= set(row.spans.split(","))
    assert got[44].spans == "format:5:45"  # the learned format, in another case
    assert "format" not in got[47].spans
    assert secrets.learn_format(docs.where("doc_id = 41")) is None
    assert secrets.find_secrets(docs.where("doc_id < 0"), None).count() == 0


def test_automaton_learns_length_and_symbols():
    a = secrets.Automaton(["x" * 40] * 200)
    assert a.likelihood("x" * 40) > -0.1 > a.likelihood("x" * 20) and a.likelihood("d" * 40) < -1


def test_exact_dedup_and_index(spark, docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    want = {r[0]: r for r in con.execute(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({exact_dedup.ORACLE_SQL})").fetchall()}
    assert {i: tuple(r) for i, r in table(exact_dedup.exact_classes(docs, keys_per_shard=7)).items()} == want
    assert exact_dedup.exact_classes(empty(docs)).count() == 0
    one = spark.createDataFrame([("ab" * 32, 3, 7, 2), ("cd" * 32, 1, 8, 1)], "digest string, n_chars long, keep_id long, rows long")
    index = exact_dedup.apply_batch(exact_dedup.empty_index(spark), one, 2)
    less = spark.createDataFrame([("ab" * 32, 0, 7, -1), ("cd" * 32, 0, 8, -1), ("ef" * 32, 0, 9, -1)], one.schema)
    assert [(r.digest[:2], r.group_size) for r in exact_dedup.apply_batch(index, less, 2).collect()] == [("ab", 1)]


def test_cuckoo_index_grows_and_verifies():
    index = exact_dedup.CuckooIndex(4)
    keys = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(3000)]
    for i, k in enumerate(keys):
        index.insert(k, 1, i, 1)
    assert index.buckets > 512 and all(index.find(k) for k in keys)
    assert not any(index.find(hashlib.sha256(f"no{i}".encode()).hexdigest()) for i in range(3000))
    for k in keys[:1500]:
        index.delete(k, 1)
    assert not any(index.find(k) for k in keys[:1500]) and all(index.find(k) for k in keys[1500:])


def test_mixing(spark, docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas())
    con.execute("CREATE TABLE d2 AS SELECT doc_id::BIGINT AS doc_id, text, source FROM documents")
    got = {i: (r["size"], r.source_size, r.target, r.taken) for i, r in table(mixing.mix(docs)).items()}
    want = {r[0]: r[1:] for r in con.execute(mixing.ORACLE_SQL.replace("FROM documents", "FROM d2")).fetchall()}
    assert {i: (a, b, round(c, 6), e) for i, (a, b, c, e) in got.items()} == {i: (a, b, round(c, 6), e) for i, (a, b, c, e) in want.items()}
    assert got == {i: (r["size"], r.source_size, r.target, r.taken) for i, r in table(mixing.mix(docs.repartition(5))).items()}
    assert all(t <= 3 * s for s, _, _, t in got.values())
    assert mixing.mix(empty(docs)).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0)] * 2
    sizes = spark.createDataFrame([("a", 53.0), ("b", 24.0), ("c", 23.0)], "k string, v double").withColumn("seats", F.lit(7))
    seats = mixing.sainte_lague(sizes, [], "k", "v", "seats", "got")
    assert {r.k: r.got for r in seats.collect()} == {"a": 3, "b": 2, "c": 2}


def test_token_files_round_trip(docs, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    more = ["it's  two  spaces  x a　 b'll don't 'tis", "tabs\t\tand\n\n new  lines ", "12ab!?34 <|endoftext|> x", " lead", "emoji 🙂🙂 ok"]
    rows = docs.select("doc_id", "text").unionByName(docs.sparkSession.createDataFrame([(1000 + i, x) for i, x in enumerate(more)], "doc_id long, text string"))
    got = sorted(token_files.token_table(rows).collect())
    at = 0
    every = [(i, x) for i, x in enumerate(texts)] + [(1000 + i, x) for i, x in enumerate(more)]
    assert len(got) == len(every)
    for (i, x), r in zip(every, got):
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        assert tuple(r) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert token_files.token_table(rows.where("doc_id < 0")).count() == 0
    word = token_files.token_table(rows.where("doc_id IN (3, 4)"), public_tokenizers.path("word_bpe_49k.json"))
    assert [r.n_tokens for r in sorted(word.collect())] == [len(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(x, add_special_tokens=False).ids) + 1 for x in ("one", "a b c")]


def test_licenses(spark):
    mit = licenses.KNOWN[0][1]
    texts = [None, "", "***", "Released under the MIT licence!", f"Copyright (c) 2020 Somebody\n\n{mit}", f"before\n\n{mit.upper()}\n\nafter", "not released under the MIT license", "x\nLicensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {i: (r.whole, r.n_notices, r.licenses) for i, r in table(licenses.scan_licenses(docs)).items()}
    assert got == {0: (None, 0, ""), 1: (None, 0, ""), 2: (None, 0, ""), 3: ("MIT", 1, "MIT"), 4: ("MIT", 0, "MIT"), 5: (None, 0, "MIT"), 6: (None, 0, ""), 7: (None, 3, "CC-BY-NC-4.0,MIT")}
    assert licenses.scan_licenses(docs.where("doc_id < 0")).count() == 0
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert {r[0]: (r[1] if isinstance(r[1], str) else None, r[2], r[3]) for r in con.execute(licenses.ORACLE_SQL).fetchall()} == got


PAGE = "<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><ul><li><a href='/'>Home</a></ul></nav><div class=ad>Buy {n}</div><article><h1>Head {n}</h1><p>One &amp;\n two<b>bold</b> {n}<p>Shared line</p><form><p>Send</p></form><div class='comments'><p>Nice {n}</p></div></article><aside>Side {n}</aside><footer>&copy; {n}</footer></body></html>"


def test_html_text(spark):
    pages = [(i, f"https://Host.example/{i}", PAGE.format(n=i)) for i in range(6)]
    pages += [(10, "http://other.example/x", "<body><div class='main-col'><h2>A</h2>a < b<p>c<br>d</div><div id=footer>f"), (11, None, None), (12, "not a url [", ""), (13, "http://other.example/y", "plain &lt;text&gt;"), (14, "http://h.example", "<article><p>broken 'quote <b x='1>still</p></article>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r for r in html_text.extract_pages(df).collect()}
    for i in range(6):
        assert got[i].text == f"Head {i}\nOne & twobold {i}\nShared line"
    assert (got[10].text, got[11].text, got[12].text, got[13].text) == ("A\na < b\nc d", "", "", "plain <text>")
    assert all(r.n_chars == len(r.text) for r in got.values()) and len(got) == len(pages)
    wrappers, usual = html_text.learn_wrappers(df.select("page_id", "url", "html"))
    assert ("host.example", "#/html/body/article") in {tuple(r) for r in wrappers.collect()} and usual.endswith("article")
    shuffled = {r.page_id: r.text for r in html_text.extract_pages(df, broadcast_paths=0).collect()}
    assert shuffled == {i: r.text for i, r in got.items()}
    assert html_text.extract_pages(df.where("page_id < 0")).count() == 0


def test_tree_match():
    leaf = lambda x: [x, 0, 0, 0, []]
    a, b = ["r", 0, 0, 0, [leaf("x"), leaf("y"), leaf("z")]], ["r", 0, 0, 0, [leaf("x"), leaf("z"), leaf("y")]]
    assert html_text.tree_match(a, b) == 3 and html_text.tree_match(a, a) == 4 and html_text.tree_match(leaf("q"), a) == 0


def test_queries_are_registered():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES)
