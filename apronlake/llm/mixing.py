"""Mixing sources to target weights by Sainte-Laguë apportionment (native).

Every document is laid on the seeded tape of its shard (a shard is a hash slice of
one source, of about ``docs_per_shard`` rows). A tape is cut into blocks of
``block_words`` words. All blocks of the mix are dealt to the sources by highest
quotients target / (2 j - 1), then each source's blocks to its shards in the same way
by their sizes. A shard's quota takes the first blocks of its tape; a quota beyond the
tape runs round it again, three times at most. The order on the tape comes from
md5(seed, doc_id), so the taken blocks are a seeded random choice and reruns agree.

Cases. Null text: size 0, nothing taken. Null source: a source of its own, last in
order. Very long texts are counted whole. Repeated rows: each is a row of its own. Ties of quotients: smaller source,
then smaller shard. No words at all: every target and every take is 0. Empty table:
no rows. Other columns of the input are ignored; clashing names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import settle, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """Target of each source: its weight's share of all words, at most ``most`` times its size.

    ``sources`` has (source, source_size), one row a source. What a capped source leaves
    is shared among the others by weight until none is above its cap: in ascending order
    of cap / weight, a source is capped while cap / weight <= what is left per weight.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    every = W.partitionBy(F.lit(1))
    at = F.row_number().over(by_name)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(at - 1, F.lit(len(weights))) + 1).cast("int"))
    x = sources.select("source", "source_size", at.alias("at"), weight.cast("long").alias("weight"), (F.col("source_size") * most).alias("cap"))
    x = x.withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    before = W.orderBy("ratio", "at").rowsBetween(W.unboundedPreceding, -1)
    x = x.withColumns(
        {
            "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0)),
            "words": F.sum("source_size").over(every),
            "weights": F.sum("weight").over(every),
        }
    )
    x = x.withColumn("level", (F.col("words") - F.col("cap_before")).cast("double") / (F.col("weights") - F.col("weight_before")))
    x = x.withColumn("capped", F.col("ratio") <= F.col("level"))
    x = x.withColumn("open_level", F.max(F.when(~F.col("capped"), F.col("level"))).over(every))
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("open_level"))
    return x.select("source", "at", "source_size", target.alias("target"))


def sainte_lague(votes: DataFrame, group: list[str], key: str, vote: str, seats: str, out: str) -> DataFrame:
    """Seats of each row of a group by the highest quotients vote / (2 j - 1).

    ``seats`` is the group's number of seats, equal on its rows. With n rows and V votes
    a row gets between vote (seats - n) / V and vote (seats + n) / V seats, rounded out,
    so only the quotients between those bounds compete: about three a row in all.
    """
    of = W.partitionBy(*(group or [F.lit(1)]))
    v, n, s = F.col("_votes"), F.col("_rows"), F.col(seats)
    x = votes.withColumns({"_votes": F.sum(vote).over(of), "_rows": F.count(F.lit(1)).over(of)})
    share = F.when(v > 0, F.col(vote) / v).otherwise(0.0)
    x = x.withColumn("_sure", F.greatest(F.floor(share * (s - n)), F.lit(0)).cast("long"))
    x = x.withColumn("_most", F.when(F.col(vote) > 0, F.ceil(share * (s + n)) + 1).otherwise(F.lit(0)).cast("long"))
    x = x.withColumn("_left", F.col(seats) - F.sum("_sure").over(of))
    tried = x.where("_most > _sure").select(
        *group, key, vote, "_left", F.explode(F.sequence(F.col("_sure") + 1, F.col("_most"))).alias("_j")
    )
    best = W.partitionBy(*(group or [F.lit(1)])).orderBy((F.col(vote) / (2 * F.col("_j") - 1)).desc(), key, "_j")
    won = tried.withColumn("_rank", F.row_number().over(best)).where("_rank <= _left").groupBy(*group, key).agg(F.count(F.lit(1)).alias("_won"))
    got = (F.col("_sure") + F.coalesce("_won", F.lit(0))).alias(out)
    return x.join(won, [*group, key], "left").select(*votes.columns, got)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, block_words: int = 64, docs_per_shard: int = 4096, seed: int = 7, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, source, source_size, target, taken) of every document, and the columns to ``carry``."""
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sized = settle(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mark.alias("mark"), *carry), "mix-sizes")
    known = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    rows = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    known = known.join(rows, known["source"].eqNullSafe(rows["source"])).select(
        known["source"], "at", "source_size", "target", F.ceil(F.col("n") / docs_per_shard).cast("long").alias("shards")
    )
    known = known.withColumn("blocks", F.round(F.sum("source_size").over(W.partitionBy(F.lit(1))) / block_words).cast("long"))
    known = settle(sainte_lague(known, [], "at", "target", "blocks", "quota"), "mix-sources")

    of = known.select(F.col("source").alias("of"), "at", "source_size", "target", "shards", "quota")
    shard = F.pmod(F.conv(F.substring("mark", 1, 8), 16, 10).cast("long"), F.col("shards"))
    placed = sized.join(of, sized["source"].eqNullSafe(of["of"])).select(
        "doc_id", "source", "size", "mark", "at", "source_size", "target", "quota", shard.alias("shard"), *carry
    )
    tapes = placed.groupBy("at", "shard").agg(F.sum("size").alias("tape"), F.max("quota").alias("quota"))
    quotas = sainte_lague(tapes, ["at"], "shard", "tape", "quota", "dealt").select("at", "shard", "tape", (F.col("dealt") * block_words).alias("words"))
    on = W.partitionBy("at", "shard").orderBy("mark", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    laid = placed.withColumn("start", F.sum("size").over(on) - F.col("size")).join(quotas, ["at", "shard"])
    passes = F.when(F.col("tape") > 0, F.floor(F.col("words") / F.col("tape"))).otherwise(0).cast("long")
    rest = F.least(F.greatest(F.col("words") - passes * F.col("tape") - F.col("start"), F.lit(0)), F.col("size"))
    taken = F.least(passes * F.col("size") + rest, F.col("size") * most).cast("long")
    return laid.select("doc_id", "size", "source", "source_size", "target", taken.alias("taken"), *carry)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole of ``documents`` mixed to weights 5, 2, 1."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('7:' || coalesce(doc_id::VARCHAR, 'null')) AS mark
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n,
         row_number() OVER (ORDER BY source NULLS LAST) AS sn
  FROM sized GROUP BY source),
w AS (
  SELECT *, ([5, 2, 1])[((sn - 1) % 3 + 1)::INT]::BIGINT AS weight, source_size * 3 AS cap,
         ceil(n / 4096.0)::BIGINT AS shards, sum(source_size) OVER ()::BIGINT AS words FROM src),
r AS (SELECT *, cap::DOUBLE / weight AS ratio, sum(weight) OVER ()::BIGINT AS weights FROM w),
p AS (
  SELECT *, (words - coalesce(sum(cap) OVER b, 0)::BIGINT)::DOUBLE / (weights - coalesce(sum(weight) OVER b, 0)::BIGINT) AS level
  FROM r WINDOW b AS (ORDER BY ratio, sn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT *, max(level) FILTER (ratio > level) OVER () AS open_level FROM p),
known AS (
  SELECT source, sn, source_size, shards, CASE WHEN ratio <= level THEN cap::DOUBLE ELSE weight * open_level END AS target,
         round(words / 64.0)::BIGINT AS blocks FROM o),
q1 AS (
  SELECT sn, row_number() OVER (ORDER BY target / (2 * j - 1) DESC, sn, j) AS rk, blocks
  FROM (SELECT sn, target, blocks, unnest(range(1, (ceil(target / 64.0) + (SELECT count(*) FROM known) + 3)::BIGINT)) AS j FROM known WHERE target > 0)),
quota AS (SELECT sn, count(*) AS quota FROM q1 WHERE rk <= blocks GROUP BY sn),
placed AS (
  SELECT s.*, k.sn, k.source_size, k.target, coalesce(q.quota, 0) AS quota,
         (('0x' || substr(s.mark, 1, 8))::BIGINT % k.shards) AS shard
  FROM sized s JOIN known k ON s.source IS NOT DISTINCT FROM k.source LEFT JOIN quota q ON q.sn = k.sn),
tapes AS (SELECT sn, shard, sum(size)::BIGINT AS tape, max(quota) AS quota FROM placed GROUP BY sn, shard),
q2 AS (
  SELECT sn, shard, quota, row_number() OVER (PARTITION BY sn ORDER BY tape / (2 * j - 1)::DOUBLE DESC, shard, j) AS rk
  FROM (SELECT *, unnest(range(1, (ceil(quota * (tape / nullif(sum(tape) OVER (PARTITION BY sn), 0))) + (count(*) OVER (PARTITION BY sn)) + 3)::BIGINT)) AS j
        FROM tapes) WHERE tape > 0),
dealt AS (SELECT sn, shard, count(*) * 64 AS words FROM q2 WHERE rk <= quota GROUP BY sn, shard),
laid AS (
  SELECT p.*, t.tape, coalesce(d.words, 0)::BIGINT AS words,
         (sum(p.size) OVER (PARTITION BY p.sn, p.shard ORDER BY p.mark, p.doc_id, p.size ROWS UNBOUNDED PRECEDING))::BIGINT - p.size AS start
  FROM placed p JOIN tapes t ON t.sn = p.sn AND t.shard = p.shard
  LEFT JOIN dealt d ON d.sn = p.sn AND d.shard = p.shard)
SELECT doc_id, size, source_size, target,
       CASE WHEN tape = 0 THEN 0 ELSE least((words // tape) * size + least(greatest(words - (words // tape) * tape - start, 0), size), 3 * size) END::BIGINT AS taken
FROM laid
"""
