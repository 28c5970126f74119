"""Exact dedup of large and null ids in one shard."""

from collections import defaultdict

from apronlake.llm import exact_dedup


def test_large_ids_beside_a_null_in_one_shard(spark):
    big = 1 << 60
    rows = [(big + 1, "a b"), (big + 2, "ab"), (big + 3, "a  b"), (None, "a b"), (None, "only null"), (None, "only  null"), (-(1 << 63), "low"), ((1 << 63) - 1, "low"), (7, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    groups = defaultdict(list)
    for doc, t in rows:
        groups["".join((t or "").split())].append((doc, len(t or "")))
    want = []
    for g in groups.values():
        keep = max(g, key=lambda x: (x[1], x[0] is not None, -(x[0] or 0)))[0]
        want += [(doc, keep, len(g), doc == keep) for doc, _ in g]
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_classes(docs, keys_per_shard=1000).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_index_keeps_large_ids_through_batches(spark):
    big = 1 << 61
    digest = "ab" * 32
    change = lambda *rows: spark.createDataFrame([(digest, n, i, r) for n, i, r in rows], "digest string, n_chars long, keep_id long, rows long")
    index = exact_dedup.apply_batch(exact_dedup.empty_index(spark), change((3, big + 5, 1), (3, None, 1)), 1)
    index = exact_dedup.apply_batch(index, change((3, big + 3, 1), (3, None, -1)), 1)
    assert [(r.keep_id, r.group_size) for r in index.collect()] == [(big + 3, 2)]
