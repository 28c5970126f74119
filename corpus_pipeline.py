"""The corpus pipeline: toxicity, near-dedup, decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the
last return the columns of ``docs``. A stage decides on hashes, ids and counts; texts move
once in near-dedup's verification and once in each stage that drops or repeats rows by
what other rows hold (near-dedup, mixing) and in the token files' sort, nowhere else.

Cases. Rows of null or empty text pass the filters; the mix takes no row without words.
Null and repeated doc_ids: rows are named by id and digest of the text. Repeated rows of
one text are near copies, one stays. Very long texts are read whole. Ties: smallest
doc_id. Empty tables: no rows. Further columns of ``docs`` come back as they are,
whatever their names (but those that begin with an underscore).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from apronlake.llm import decontaminate, mixing, near_dedup, token_files, toxicity
from apronlake.llm.shared import distil, settle, table, with_key


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on labelled rows of ``docs``, does not reject."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.reject_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one of smallest doc_id (then digest)."""
    return near_dedup.drop_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the benchmark's windows cover less than a twentieth."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix takes them.

    A shard's quota ends within one document at most; that one is taken if half of it is.
    """
    key = ["_at", "_digest"]
    copies = F.floor(F.col("taken") / F.col("size") + F.lit(0.5)).cast("int").alias("_copies")
    times = distil(lambda: mixing.mix(with_key(docs), carry=tuple(key)).where("taken > 0").select(*key, copies).where("_copies > 0"), spark, "copies")
    named = with_key(docs)
    if times.groupBy(*key).count().where("count > 1").limit(1).count():  # repeated rows: the n-th takes the n-th's copies
        nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1))).alias("_nth")
        named, times, key = named.select("*", nth), times.select("*", nth), [*key, "_nth"]
    out = named.join(times.hint("merge"), key)
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; a row a document as read back from them."""
    return token_files.token_table(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: A CRF, signatures and a tokenizer are beyond SQL: tests/llm holds stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = settle(docs, f"stage-{name}")
    return docs
