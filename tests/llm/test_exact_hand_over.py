"""A deleted row that stayed hands its place to the best of the rest."""

from pyspark.sql import functions as F

from apronlake.llm import exact_dedup as X


def _changes(docs, sign):
    return docs.select(X.digest_of(F.col("text")).alias("digest"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), F.col("doc_id").alias("keep_id"), F.lit(sign).cast("long").alias("rows"))


def test_hand_over(spark):
    rows = [(1, "a  b"), (2, "a b"), (3, "ab"), (4, "a\tb"), (5, "other"), (6, None), (7, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = X.settle(X.apply_batch(X.empty_index(spark), _changes(docs, 1), 3), "test-index")
    for gone in ([1], [2, 5], [7]):
        less, docs = docs.where(F.col("doc_id").isin(gone)), docs.where(~F.col("doc_id").isin(gone))
        index = X.settle(X.hand_over(X.apply_batch(index, _changes(less, -1), 3), docs), "test-index")
        want = {(r.text_sha256, r.keep_id, r.group_size) for r in X.exact_classes(docs).collect()}
        assert {(r.digest, r.keep_id, r.group_size) for r in index.collect()} == want
