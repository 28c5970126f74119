"""Raw files to tables: all-string readers, landing with manifests, partitioned writes.

Every file column is read as a string and typed later; partitions come from the folders.
A landing is idempotent: partitions that the manifest holds with the same version are
skipped, others are replaced whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apronlake.operators.joins import small


def strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def clean_header(header: list[str], renames: dict[str, str]) -> list[str]:
    """Column names of a header: renamed, an empty one named, equal ones (in any case) rejected."""
    names = [renames.get(h, h) or "trailing_empty" for h in header]
    seen: set[str] = set()
    for n in names:
        if n.lower() in seen:
            raise ValueError(f"duplicate column {n!r} in the header")
        seen.add(n.lower())
    return names


def read_raw_csv(spark: SparkSession, path: str, header: list[str], renames: dict[str, str] | None = None) -> DataFrame:
    """Hive-partitioned CSV with a header line; every file column a string."""
    return spark.read.schema(strings(clean_header(header, renames or {}))).option("header", True).option("enforceSchema", True).csv(path)


def read_raw_jsonl(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """Hive-partitioned JSON lines (gzip or plain); fields that are not listed are ignored."""
    return spark.read.schema(strings(fields)).json(path)


def conform_heterogeneous_csv(spark: SparkSession, paths: list[str], keep: list[str], id_name: str = "_station_id") -> DataFrame:
    """CSV files of differing headers as one table of the wanted fields and the file's name (see ``headers.conform``)."""
    from .headers import conform

    return conform(spark, paths, keep, id_name)


def check_row_parity(df: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """(key, n_rows, rows) where counts differ from the manifest's, or one side has no such key."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return n.join(manifest.select(key, "rows"), key, "full").where(~F.col("n_rows").eqNullSafe(F.col("rows")))


def stale_partitions(src: DataFrame, manifest: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """Partitions of ``src`` that the manifest does not hold in this version."""
    return src.select(*keys, *version).distinct().join(manifest.select(*keys, *version).distinct(), [*keys, *version], "left_anti")


def union_years(frames: list[DataFrame], cols: list[str]) -> DataFrame:
    out = frames[0].select(cols)
    for f in frames[1:]:
        out = out.unionByName(f.select(cols))
    return out


def load_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A small CSV with trimmed cells, blanks as NULL, broadcast in joins."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    cells = [F.nullif(F.trim(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema]
    return df.select(*cells)


def validate_landing(df: DataFrame, required: list[str], identity: Column, part: str, least: int, most: int) -> DataFrame:
    """(part, problem, n): missing columns, too few or too many rows, rows that are not of their part.

    ``identity`` is true for a row that belongs to its partition; all rows are tested.
    """
    spark = df.sparkSession
    gone = [(None, f"missing column {c}", 1) for c in required if c not in df.columns]
    out = spark.createDataFrame(gone, "part string, problem string, n long")
    of = df.groupBy(F.col(part).cast("string").alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.coalesce(identity, F.lit(False))).alias("foreign"))
    few = of.where(F.col("rows") < least).select("part", F.lit("too few rows").alias("problem"), F.col("rows").alias("n"))
    many = of.where(F.col("rows") > most).select("part", F.lit("too many rows").alias("problem"), F.col("rows").alias("n"))
    wrong = of.where("foreign > 0").select("part", F.lit("rows of another partition").alias("problem"), F.col("foreign").alias("n"))
    return out.unionByName(few).unionByName(many).unionByName(wrong)


def manifest(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rows, version): a version is the sum of the rows' hashes, so it does not depend on order."""
    h = F.xxhash64(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("version"))


def missing_months(manifest_: DataFrame, start: str, end: str, month: str = "month_start") -> DataFrame:
    """Months of a span that the manifest lacks."""
    span = manifest_.sparkSession.sql(f"SELECT explode(sequence(DATE '{start}', DATE '{end}', INTERVAL 1 MONTH)) AS {month}")
    return span.join(manifest_.select(month).distinct(), month, "left_anti")


def land_partitions(df: DataFrame, path: str, keys: list[str], force: bool = False) -> DataFrame:
    """Land the partitions of ``df`` in ``path``; (keys, status) with landed or skipped.

    For files that other tools read as a plain folder; ``commits.land`` is the form that
    readers see whole or not at all. Partitions already there in the same version are
    skipped; others, and all with ``force``, are replaced whole. The manifest lies beside the data and is partitioned
    alike, so a lost manifest is healed by landing again.
    """
    spark = df.sparkSession
    want = manifest(df, keys)
    try:
        have = spark.read.schema(want.schema).parquet(f"{path}/_manifest")
        stale = want if force else stale_partitions(want, have, keys, ["rows", "version"])
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        stale = want
    stale = spark.createDataFrame(stale.select(*keys).collect(), want.select(*keys).schema)  # one row a partition
    fresh = df.join(small(stale), keys, "left_semi")
    write = {"partitionOverwriteMode": "dynamic"}
    fresh.write.mode("overwrite").options(**write).partitionBy(*keys).parquet(f"{path}/data")
    want.join(small(stale), keys, "left_semi").write.mode("overwrite").options(**write).partitionBy(*keys).parquet(f"{path}/_manifest")
    landed = stale.withColumn("_landed", F.lit(True))
    return want.select(*keys).join(landed, keys, "left").select(*keys, F.when(F.col("_landed"), "landed").otherwise("skipped").alias("status"))


def build_airports(raw: DataFrame, zones: dict[str, str], supplements: DataFrame, countries: list[str], least: int = 500) -> DataFrame:
    """Reference places: wanted countries and kinds, one for each three-letter code (lowest id), time zones filled.

    ``supplements`` fill codes that are absent. Raises if fewer than ``least`` rows result.
    """
    known = raw.where(F.col("country").isin(countries) & (F.col("type") == "airport") & F.col("iata").rlike("^[A-Z]{3}$"))
    first = known.groupBy("iata").agg(F.min_by(F.struct(*known.columns), "id").alias("r")).select("r.*")
    fill = F.create_map(*(F.lit(x) for kv in zones.items() for x in kv)) if zones else F.create_map().cast("map<string,string>")
    first = first.withColumn("tz", F.coalesce("tz", fill[F.col("iata")]))
    out = first.unionByName(supplements.join(first.select("iata"), "iata", "left_anti"), allowMissingColumns=True)
    n = out.count()
    if n < least:
        raise ValueError(f"only {n} airports, {least} expected at least")
    return out


def write_table(df: DataFrame, path: str, date: str, cluster_by: list[str]) -> None:
    """Month partitions, rows clustered within files, so that row groups can be skipped."""
    out = df.withColumn("p_month", F.trunc(date, "month"))
    out.repartitionByRange("p_month", *cluster_by).sortWithinPartitions("p_month", *cluster_by).write.mode("overwrite").partitionBy("p_month").parquet(path)


def read_table(spark: SparkSession, path: str, date: str, lo: str, hi: str) -> DataFrame:
    """Rows of [lo, hi], with the predicate on the partitions derived from that on the date."""
    x = spark.read.parquet(path)
    months = F.col("p_month").between(F.trunc(F.lit(lo).cast("date"), "month"), F.trunc(F.lit(hi).cast("date"), "month"))
    return x.where(months & F.col(date).between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))


def freshness(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(table, newest): newest file of each table."""
    out = None
    for name, path in paths.items():
        one = spark.read.parquet(path).agg(F.lit(name).alias("table"), F.max("_metadata.file_modification_time").alias("newest"))
        out = one if out is None else out.unionByName(one)
    return out


def write_report(df: DataFrame, path: str) -> None:
    """A small report as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)
