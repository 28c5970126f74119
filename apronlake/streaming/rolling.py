"""Rolling tables: each micro-batch is reduced to partial rows, and partial rows to results when read.

A batch's watermark is the greatest event time of the batches before it, less the delay.
Rows behind it are late: they change no result and are counted by window and key in a side
table, so that results and late counts together are all rows that ever came. Partial rows
of a batch go to a folder of its own and become valid by one entry of a commit log
(``sources/commits.py``), which also holds the watermark; a batch that a restart runs
again finds its entry, or writes its folder anew. Folders are merged four at a time into
the next level, so a batch costs its own rows and, over time, a logarithm of all batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from apronlake.operators.joins import small
from apronlake.sources.commits import Log, file_system, read_landed

#: Folders of one level that become one of the next.
MERGED = 4


@dataclass
class Rolling:
    """A table fed by a stream.

    ``reduce`` makes partial rows of on-time rows, ``combine`` one row of the partial rows of
    a key; combining in any order and grouping must give the same. ``keys`` are what late
    rows are counted by, beside the window of ``ts``.
    """

    path: str
    ts: str
    keys: list[str]
    window: str
    delay: str
    reduce: Callable[[DataFrame], DataFrame]
    combine: Callable[[DataFrame], DataFrame]

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Feed the table from ``stream``; by default what is there now, then stop."""
        return stream.writeStream.foreachBatch(self.take).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

    def take(self, batch: DataFrame, number: int) -> None:
        """Add one micro-batch; a number that is in the log changes nothing."""
        spark = batch.sparkSession
        log, n = Log(spark, self.path), number + 1
        last = log.latest()
        if n <= last:
            return
        before = log.entry(last) if last else {"parts": [], "late": [], "seen": None}
        rows = batch.persist()
        try:
            mark = self._watermark(before["seen"])
            late = F.coalesce(F.col(self.ts) < mark, F.lit(False)) if before["seen"] else F.lit(False)
            parts = self._write(self.reduce(rows.where(~late)), "parts", n)
            counted = self._write(self._count(rows.where(late)), "late", n) if before["seen"] else None
            seen = rows.agg(F.max(self.ts).cast("timestamp_ntz").cast("string")).first()[0]
        finally:
            rows.unpersist()
        entry = {
            "parts": self._merged(spark, [*before["parts"], [parts, 0]], "parts", n),
            "late": self._merged(spark, [*before["late"], *([[counted, 0]] if counted else [])], "late", n),
            "seen": max(filter(None, (before["seen"], seen)), default=None),
        }
        log.complete(n, entry)

    def read(self, spark: SparkSession) -> DataFrame:
        """Results of all on-time rows so far."""
        return self.combine(self._folders(spark, "parts"))

    def late(self, spark: SparkSession) -> DataFrame:
        """(window_start, keys, n): late rows so far."""
        return self._sum(self._folders(spark, "late"))

    def watermark(self, spark: SparkSession) -> str | None:
        """The instant behind which rows of the next batch are late."""
        n = Log(spark, self.path).latest()
        seen = Log(spark, self.path).entry(n)["seen"] if n else None
        return spark.range(1).select(self._watermark(seen).cast("timestamp_ntz").cast("string")).first()[0] if seen else None

    def _watermark(self, seen: str | None) -> Column:
        return F.lit(seen).cast("timestamp_ntz") - F.expr(f"INTERVAL {self.delay}")

    def _count(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.window(self.ts, self.window).start.alias("window_start"), *self.keys).agg(F.count(F.lit(1)).alias("n"))

    def _sum(self, counts: DataFrame) -> DataFrame:
        return counts.groupBy("window_start", *self.keys).agg(F.sum("n").alias("n"))

    def _write(self, df: DataFrame, kind: str, n: int) -> str:
        name = f"{kind}/{n:08d}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{name}")
        return name

    def _merged(self, spark: SparkSession, folders: list, kind: str, n: int) -> list:
        """Folders with the last four of one level made one, as often as that is so."""
        while len(folders) >= MERGED and len({level for _, level in folders[-MERGED:]}) == 1:
            *rest, level = *folders[:-MERGED], folders[-1][1]
            rows = spark.read.parquet(*(f"{self.path}/{name}" for name, _ in folders[-MERGED:]))
            folders = [*rest, [self._write((self.combine if kind == "parts" else self._sum)(rows), kind, n), level + 1]]
        return folders

    def _folders(self, spark: SparkSession, kind: str) -> DataFrame:
        log = Log(spark, self.path)
        n = log.latest()
        if not n:
            raise FileNotFoundError(f"nothing was taken to {self.path}")
        folders = [f"{self.path}/{name}" for name, _ in log.entry(n)[kind]]
        if folders:
            return spark.read.parquet(*folders)
        first = spark.read.parquet(f"{self.path}/{log.entry(n)['parts'][0][0]}")
        return first.select(*(F.col(c) for c in ("window_start", *self.keys)), F.lit(0).cast("long").alias("n")).where("false")


def rolling_sums(path: str, ts: str, keys: list[str], value: str, window: str, delay: str) -> Rolling:
    """Rows and sum of ``value`` by tumbling window and keys."""

    def reduce(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.window(ts, window).start.alias("window_start"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("sum_value"))

    def combine(parts: DataFrame) -> DataFrame:
        return parts.groupBy("window_start", *keys).agg(F.sum("n").alias("n"), F.sum("sum_value").alias("sum_value"))

    return Rolling(path, ts, keys, window, delay, reduce, combine)


def rolling_best(path: str, ts: str, keys: list[str], order: dict[str, Column], window: str, delay: str) -> Rolling:
    """The best row of each window and key: the least by ``order`` (name: expression), then by its other columns.

    State is one row a window and key, not one a row; no window function, so a hot key is
    combined in each task before it moves.
    """

    def best(rows: DataFrame) -> DataFrame:
        ranked = rows.withColumns({f"_order_{n}": c for n, c in order.items()})
        rest = [c for c in ranked.columns if c not in keys and not c.startswith("_order_") and c != "window_start"]
        least = F.min(F.struct(*(f"_order_{n}" for n in order), *rest)).alias("_b")
        return ranked.groupBy("window_start", *keys).agg(least).select("window_start", *keys, *(f"_b.{c}" for c in rest))

    return Rolling(path, ts, keys, window, delay, lambda rows: best(rows.withColumn("window_start", F.window(ts, window).start)), best)


def stream_best(stream: DataFrame, ts: str, keys: list[str], order: dict[str, Column], window: str, delay: str) -> DataFrame:
    """``rolling_best`` in the engine's own state: the best row of a window and key leaves when the watermark passes the window (append mode)."""
    rest = [c for c in stream.columns if c not in keys]
    ranked = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).groupBy(F.window(ts, window).alias("_w"), *keys)
    best = ranked.agg(F.min(F.struct(*(c.alias(f"_order_{n}") for n, c in order.items()), *rest)).alias("_b"))
    return best.select(F.col("_w.start").alias("window_start"), *keys, *(f"_b.{c}" for c in rest))


def score_stream(stream: DataFrame, lookup: str, key: str, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Rows with the ``rate`` of their key from a landed table, as of the last commit when their micro-batch begins.

    A new commit of ``lookup`` is used from the next micro-batch on, without a restart; the
    lookup is broadcast only if its count allows it. A batch's rows go to a folder of their
    own with ``lookup_version``, so a batch that runs again replaces them.
    """

    def score(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        version = Log(spark, lookup).latest()
        rates = read_landed(spark, lookup, version).select(F.col(key).alias("_key"), "rate")
        scored = batch.join(small(rates), F.col(key) == F.col("_key"), "left").drop("_key").withColumn("lookup_version", F.lit(version))
        scored.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def forget(spark: SparkSession, table: Rolling) -> int:
    """Remove folders that the last log entry does not name; how many."""
    log = Log(spark, table.path)
    entry = log.entry(log.latest())
    fs, make = file_system(spark, table.path)
    gone = 0
    for kind in ("parts", "late"):
        where = make(f"{table.path}/{kind}")
        for s in fs.listStatus(where) if fs.exists(where) else []:
            if f"{kind}/{s.getPath().getName()}" not in {name for name, _ in entry[kind]}:
                fs.delete(s.getPath(), True)
                gone += 1
    return gone
