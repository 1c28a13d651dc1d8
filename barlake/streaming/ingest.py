"""Validate, deduplicate and route a stream of raw messages.

Input rows carry ``key``, ``value``, ``partition`` and ``offset``. The first valid event
of a key, in partition and offset order, claims the key once and forever: in a
micro-batch by one aggregate per key, across batches by the claims. Repeats are dropped and
counted; everything else goes to the dead-letter side with its reason.

Claims are a Parquet table of (key, query, batch) by trading day beside Bronze. A key holds
its event time, so a batch reads the claims of its own days and nothing else, however many
batches came before: no old batch folder is listed, no Bronze record parsed. Each batch adds
a few files to its days; a day with many files is written anew as one. Claims follow the
Bronze write, and a batch never looks at its own, so a retry after any failure comes to the
same rows.

Every batch writes to ``query=<id>/batch=<n>``, with the id that the checkpoint keeps. A
retried batch replaces its own folder only; another query, or the same one with a new
checkpoint, adds folders beside it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.operators import events as E
from barlake.runtime import stage, unstage

OUTCOMES = ("accepted", "duplicate", "dead_lettered")


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a streaming query keeps in its checkpoint; Spark writes it at the start."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def first_per_key(valid: DataFrame) -> DataFrame:
    """The row of each key with the smallest (partition, offset), combined before the shuffle."""
    whole = F.struct(*valid.columns)
    first = valid.groupBy("key").agg(F.min_by(whole, F.struct("partition", "offset")).alias("first"))
    return first.select("first.*")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


#: Files of a day from which its claims are written anew together.
COMPACT_FILES = 32
_CLAIM = "key string, query string, batch string"


def claims_path(bronze_root: str) -> str:
    """Beside Bronze, under a name that readers of Bronze pass over."""
    return f"{bronze_root.rstrip('/')}/_claims"


def _day_folders(spark: SparkSession, bronze_root: str, days: list[str]) -> list[str]:
    folders = [f"{claims_path(bronze_root)}/day={day}" for day in days]
    return [folder for folder in folders if _exists(spark, folder)]


def add_claims(accepted: DataFrame, bronze_root: str, query: str, batch: str) -> None:
    """Claims of a batch's accepted rows (key and fields.trading_date); repeats do no harm."""
    rows = accepted.select(
        "key", F.lit(query).alias("query"), F.lit(batch).alias("batch"), F.col("fields")["trading_date"].alias("day")
    )
    rows.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(claims_path(bronze_root))


def rebuild_claims(spark: SparkSession, bronze_root: str) -> None:
    """Claims of all that Bronze holds, for a Bronze layer that has none yet."""
    held = (
        spark.read.option("basePath", bronze_root)
        .schema("value string, query string, batch string, symbol string, timeframe string, trading_date string")
        .text(f"{bronze_root}/query=*/batch=*")
    )
    key = F.get_json_object("value", "$.kafka_key").alias("key")
    rows = held.select(key, "query", "batch", F.col("trading_date").cast("string").alias("day"))
    rows.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(claims_path(bronze_root))


def compact_claims(spark: SparkSession, bronze_root: str, days: list[str], most: int = COMPACT_FILES) -> None:
    """Write days of more than ``most`` files anew: the new files arrive before the old ones go.

    Run by the one query that adds claims. A failure in between leaves rows twice, which reads
    the same.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path_of = jvm.org.apache.hadoop.fs.Path
    for folder in _day_folders(spark, bronze_root, days):
        fs = path_of(folder).getFileSystem(conf)
        old = [f.getPath() for f in fs.listStatus(path_of(folder)) if f.getPath().getName().endswith(".parquet")]
        if len(old) <= most:
            continue
        fresh = f"{claims_path(bronze_root)}/_compact-{uuid.uuid4().hex}"
        rows = spark.read.schema(_CLAIM).parquet(*[f.toString() for f in old])
        rows.distinct().hint("rebalance").write.parquet(fresh)
        for file in fs.listStatus(path_of(fresh)):
            if file.getPath().getName().endswith(".parquet"):
                fs.rename(file.getPath(), path_of(folder, file.getPath().getName()))
        for file in old:
            fs.delete(file, False)
        fs.delete(path_of(fresh), True)


def batch_days(rows: DataFrame) -> list[str]:
    """Trading days of a batch: one value a day, however many rows."""
    day = F.col("fields")["trading_date"]
    return sorted(r[0] for r in rows.select(day.alias("day")).distinct().collect() if r[0] is not None)


def unclaimed(first: DataFrame, bronze_root: str, query: str, batch: str) -> DataFrame:
    """Rows whose key no other batch has claimed; claims of an earlier try of this one count as none."""
    spark = first.sparkSession
    if not _exists(spark, claims_path(bronze_root)):
        if not _exists(spark, bronze_root):
            return first
        rebuild_claims(spark, bronze_root)
    folders = _day_folders(spark, bronze_root, batch_days(first))
    if not folders:
        return first
    held = spark.read.schema(_CLAIM).parquet(*folders)
    other = held.where((F.col("query") != query) | (F.col("batch") != batch)).select(F.col("key").alias("held"))
    return first.join(other, F.col("key") == F.col("held"), "left_anti")


def write_bronze_batch(accepted: DataFrame, root: str, folder: str) -> None:
    """JSON lines under ``<folder>/symbol=/timeframe=/trading_date=``.

    The folder is replaced when its micro-batch is retried. Partition columns also stay in
    the record, so readers need not interpret directories.
    """
    records = E.bronze_records(accepted)
    folders = {f"p_{c}": F.col(c) for c in ("symbol", "timeframe", "trading_date")}
    body = F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("value")
    (
        records.withColumns(folders)
        .select(body, *folders)
        .withColumnsRenamed({name: name[2:] for name in folders})
        .hint("rebalance", "symbol", "timeframe", "trading_date")
        .write.mode("overwrite")
        .partitionBy("symbol", "timeframe", "trading_date")
        .text(f"{root}/{folder}")
    )


def write_dead_letter_batch(invalid: DataFrame, root: str, folder: str) -> None:
    E.dead_letters(invalid).write.mode("overwrite").json(f"{root}/{folder}")


def start_ingest(
    messages: DataFrame,
    bronze_root: str,
    dead_letter_root: str,
    checkpoint: str,
    trigger: dict | None = None,
    send_dead_letters: Callable[[DataFrame, int], None] | None = None,
    outcomes_root: str | None = None,
) -> StreamingQuery:
    """Start the ingestion query.

    ``trigger`` defaults to ``{"availableNow": True}``: read what is there, then
    stop. Pass ``{"processingTime": "10 seconds"}`` to keep running. Offsets commit
    after both writes, so a failed batch is repeated. With ``outcomes_root`` each batch
    also writes its accepted, duplicate and dead-lettered counts there.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = query_id(spark, checkpoint), str(batch_id)
        folder = "query={}/batch={}".format(*own)
        # Written once: the source is read, decoded and checked a single time a batch.
        checked = stage(batch, "ingest-batch")
        accepted = stage(
            unclaimed(first_per_key(checked.filter("error_type IS NULL")), bronze_root, *own), "ingest-accepted"
        )
        try:
            invalid = checked.filter("error_type IS NOT NULL")
            if accepted.isEmpty() and not _exists(spark, f"{bronze_root}/{folder}"):
                pass  # nothing to add, and no earlier try to replace
            else:
                write_bronze_batch(accepted, bronze_root, folder)
                add_claims(accepted, bronze_root, *own)
                compact_claims(spark, bronze_root, batch_days(accepted))
            if send_dead_letters is None:
                write_dead_letter_batch(invalid, dead_letter_root, folder)
            else:
                send_dead_letters(E.dead_letters(invalid), batch_id)
            if outcomes_root is not None:
                taken = F.lit(accepted.count())
                checked.agg(
                    taken.alias("accepted"),
                    (F.count_if(F.col("error_type").isNull()) - taken).alias("duplicate"),
                    F.count_if(F.col("error_type").isNotNull()).alias("dead_lettered"),
                ).write.mode("overwrite").parquet(f"{outcomes_root}/{folder}")
        finally:
            unstage(spark, checked, accepted)

    return (
        E.validate_messages(messages)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def run_outcomes(spark: SparkSession, outcomes_root: str) -> DataFrame:
    """Rows per outcome over all batches written under ``outcomes_root``."""
    batches = spark.read.schema("accepted bigint, duplicate bigint, dead_lettered bigint").parquet(
        f"{outcomes_root}/query=*/batch=*"
    )
    totals = batches.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in OUTCOMES])
    return totals.unpivot([], list(OUTCOMES), "outcome", "rows")


def count_outcomes(messages: DataFrame, known_keys: DataFrame | None = None) -> DataFrame:
    """Batch form of the routing: rows per outcome.

    ``known_keys`` are keys accepted by earlier runs. Each valid key is accepted
    once unless it is known; its other rows are duplicates. Keys reduce on the map
    side, so a key repeated many times is one row per task in the shuffle.
    """
    checked = E.validate_messages(messages).withColumn("ok", F.col("error_type").isNull())
    per_key = checked.groupBy(F.when(F.col("ok"), F.col("key")).alias("key"), "ok").agg(
        F.count(F.lit(1)).alias("n")
    )
    fresh = F.when(F.col("ok"), 1).otherwise(0)
    if known_keys is not None:
        seen = known_keys.select(F.col("key").alias("seen")).distinct()
        per_key = per_key.join(seen, F.col("key") == F.col("seen"), "left")
        fresh = F.when(F.col("ok") & F.col("seen").isNull(), 1).otherwise(0)
    totals = per_key.agg(
        F.coalesce(F.sum(fresh), F.lit(0)).alias("accepted"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("n") - fresh)), F.lit(0)).alias("duplicate"),
        F.coalesce(F.sum(F.when(~F.col("ok"), F.col("n"))), F.lit(0)).alias("dead_lettered"),
    )
    return totals.unpivot([], list(OUTCOMES), "outcome", "rows").select(
        "outcome", F.col("rows").cast("bigint").alias("rows")
    )
