"""

The given tables stand in for market data. ``events`` rows are one-minute bars
(symbol = event type, price = value + 1, volume = the number in ``props``);
``lineitem`` rows are raw bar events, which hold repeats and rule violations of
their own. The SQL side lives in ``oracles.py``.
"""

from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles
from barlake.operators import dedupe, events, labels, models, quality, training
from barlake.operators.contract_features import contract_features
from barlake.operators.features import (
    FEATURE_COLUMNS,
    add_features,
    build_features,
    feature_families,
    feature_summary,
)
from barlake.operators.resample import resample
from barlake.operators.series import with_position
from barlake.plans.batch import run_batch
from barlake.plans.gold import build_gold
from barlake.plans.landing import load_summary
from barlake.runtime import scratch_path
from barlake.schema import BUSINESS_KEY, MARKET_ZONE, NUMERICS, PRICES
from barlake.sinks import layers
from barlake.sources import history_csv, payloads
from barlake.sources.lake import read_silver
from barlake.sources.raw_events import read_raw_events
from barlake.streaming import ingest, publish

SMOKE_DIR = "/root/testdata/sf0.001"


# ---- inputs -------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as canonical bars; events of one type may share a time, and all of them count."""
    at = F.col("ts").cast("timestamp")
    price = F.col("value") + 1
    return _table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        at.alias("event_time"),
        F.to_date(F.from_utc_timestamp(at, MARKET_ZONE)).alias("trading_date"),
        F.lit("1m").alias("timeframe"),
        *[price.alias(name) for name in PRICES],
        F.regexp_extract("props", "[0-9]+", 0).cast("double").alias("volume"),
        F.lit("events").alias("source"),
        F.col("event_id").cast("string").alias("source_record_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("ingest_run_id"),
        at.alias("ingested_at"),
        F.lit("valid").alias("quality_status"),
    )


def raw_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as raw events: unit prices with tax and discount as the range.

    Some closes leave the range, some volumes are negative and most line numbers
    give a timeframe outside the contract, so every rule finds rows of its own.
    """
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    stamp = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")
    seen = F.date_format(F.col("l_shipdate") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss")
    return lineitem.select(
        F.lit("ohlcv_raw_v1").alias("schema_version"),
        F.concat("l_returnflag", "l_linestatus").alias("symbol"),
        F.concat(stamp, F.lit("Z")).alias("event_time"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("trading_date"),
        F.concat((F.col("l_linenumber") * 5).cast("string"), F.lit("m")).alias("timeframe"),
        unit.alias("open"),
        (unit * (1 + F.col("l_tax"))).alias("high"),
        (unit * (1 - F.col("l_discount"))).alias("low"),
        (unit * (1 + 2 * F.col("l_tax") - F.col("l_discount"))).alias("close"),
        (F.col("l_quantity") - 3).alias("volume"),
        F.lit("lineitem").alias("source"),
        F.col("l_partkey").cast("string").alias("source_record_id"),
        F.concat(F.lit("r"), F.col("l_suppkey").cast("string")).alias("ingest_run_id"),
        F.concat(stamp, F.lit("Z")).alias("published_at"),
        F.lit(None).cast("string").alias("kafka_key"),
        F.col("l_linenumber").cast("int").alias("kafka_partition"),
        F.col("l_orderkey").alias("kafka_offset"),
        F.concat(seen, F.lit("Z")).alias("consumed_at"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from_lineitem(_table(spark, sf_dir, "lineitem"))


def minutes_from_events(table: DataFrame) -> DataFrame:
    """``events`` as raw events on whole minutes: repeats per minute, low values out of range."""
    at = F.col("ts").cast("timestamp")
    minute = F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:00"), F.lit("Z"))
    day = F.date_format(F.from_utc_timestamp(at, MARKET_ZONE), "yyyy-MM-dd")
    value = F.col("value")
    return table.select(
        F.lit("ohlcv_raw_v1").alias("schema_version"),
        F.col("event_type").alias("symbol"),
        minute.alias("event_time"),
        day.alias("trading_date"),
        F.lit("1m").alias("timeframe"),
        (value + 1).alias("open"),
        (value * 2).alias("high"),
        F.least(value, F.lit(1.0)).alias("low"),
        value.alias("close"),
        F.regexp_extract("props", "[0-9]+", 0).cast("double").alias("volume"),
        F.lit("events").alias("source"),
        F.lit(None).cast("string").alias("source_record_id"),
        F.lit("r1").alias("ingest_run_id"),
        minute.alias("published_at"),
        F.lit(None).cast("string").alias("kafka_key"),
        F.lit(0).alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("consumed_at"),
    )


def minute_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minutes_from_events(_table(spark, sf_dir, "events"))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.flag_events(raw_events(spark, sf_dir))


def as_messages(raw: DataFrame) -> DataFrame:
    """Raw events as Kafka-shaped messages, at the position they carry."""
    position = {"partition": F.col("kafka_partition"), "offset": F.col("kafka_offset")}
    return events.to_messages(raw.withColumnRenamed("kafka_key", "_k"), position)


def _naive(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as DuckDB reads the tables."""
    stamps = [n for n, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in stamps})


# ---- quality, dedupe, resample ------------------------------------------------


def _resample(timeframe: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bars = resample(event_bars(spark, sf_dir), timeframe, unique_keys=False)
        return _naive(bars.drop("source_record_id", "quality_status"))

    return run


def landing_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.contract_report(event_bars(spark, sf_dir), quality.landing_rules())


def silver_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = quality.as_feature_input(flagged(spark, sf_dir))
    return quality.contract_report(bars, quality.silver_rules())


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _naive(quality.duplicate_keys(flagged(spark, sf_dir)))


def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ("kafka_offset", "kafka_partition", *BUSINESS_KEY, "trading_date", "quality_status")
    return _naive(flagged(spark, sf_dir).select(*cols, *NUMERICS))


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.quality_metrics(dedupe.key_stats(flagged(spark, sf_dir)))


def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flagged(spark, sf_dir)
    counted = dedupe.with_duplicate_counts(rows, dedupe.key_stats(rows))
    return _naive(dedupe.layer_projection(counted))


def _newest(scope: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = dedupe.newest_per_key(flagged(spark, sf_dir), scope)
        return _naive(dedupe.layer_projection(rows))

    return run


def _batch_folders(root: str, raw: str) -> list[str]:
    return [f"{root}/{name}" for name in (raw, "layer", "silver", "report")]


def batch_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch job over JSON files; returns the Silver layer read back."""
    root = scratch_path(spark, "batch-job")
    minute_events(spark, sf_dir).write.json(f"{root}/raw")
    run_batch(spark, *_batch_folders(root, "raw"))
    return _naive(read_silver(spark, f"{root}/silver"))


def batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "batch-job")
    minute_events(spark, sf_dir).write.json(f"{root}/raw")
    run_batch(spark, *_batch_folders(root, "raw"))
    return spark.read.parquet(f"{root}/report/parquet").drop(
        "run_id", "generated_at", "input_root"
    )


# ---- files and payloads -------------------------------------------------------


def history_csv_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` written as CSV in market time and loaded as history."""
    root = scratch_path(spark, "history")
    local = F.from_utc_timestamp("event_time", MARKET_ZONE)
    event_bars(spark, sf_dir).select(
        F.date_format(local, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Date"),
        *[F.col(n).alias(n.capitalize()) for n in NUMERICS],
    ).write.option("header", "true").csv(root)
    bars = history_csv.read_history(spark, root, "ALL")
    return _naive(bars.drop("source_record_id", "ingest_run_id", "ingested_at"))


def history_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as one CSV file for each type, loaded as history: rows and times of each run id."""
    root = scratch_path(spark, "history-files")
    rows = event_bars(spark, sf_dir).select(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS'Z'").alias("Date"),
        *[F.col(n).alias(n.capitalize()) for n in NUMERICS],
        F.col("symbol").alias("type"),
    )
    sorted_files = rows.repartition("type").sortWithinPartitions("type", "Date")
    sorted_files.write.option("header", "true").partitionBy("type").csv(root)
    row = F.col("source_record_id").cast("bigint")
    runs = history_csv.read_history(spark, root, "ALL").groupBy("ingest_run_id").agg(
        F.count(F.lit(1)).alias("bars"),
        F.min_by("event_time", row).alias("first_time"),
        F.max_by("event_time", row).alias("last_time"),
        F.max(row).alias("last_row"),
        F.round(F.sum(row * F.col("close")), 2).alias("placed"),
    )
    return _naive(runs.drop("ingest_run_id"))


def landing_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1m and 15m bars written twice to one landing layer: the second write replaces."""
    root = scratch_path(spark, "landing")
    bars = event_bars(spark, sf_dir).withColumn("ingest_run_id", F.lit("run:1"))
    both = bars.unionByName(resample(bars, "15m", unique_keys=False))
    layers.write_landing(both, root)
    layers.write_landing(both, root)
    return (
        spark.read.parquet(root)
        .groupBy("symbol", "timeframe", "trading_date", "ingest_run_id")
        .agg(F.count(F.lit(1)).alias("bars"), F.sum("volume").alias("volume"))
    )


def landing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = event_bars(spark, sf_dir)
    return load_summary(bars, resample(bars, "30m", unique_keys=False), "events", "30m")


def payload_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per event with two bars; shape and time unit vary by event type."""
    seconds = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    millis = F.col("event_type").isin("view", "click")
    t = [F.when(millis, s * 1000).otherwise(s) for s in (seconds, seconds + 60)]
    low = [F.col("value"), F.col("value") * 2]
    parts = [
        {"t": a, "o": b + 1, "h": b + 2, "l": b, "c": b + 0.5, "v": b} for a, b in zip(t, low)
    ]
    arrays = F.struct(*[F.array(*[p[k] for p in parts]).alias(k) for k in "tohlcv"])
    records = F.array(
        *[
            F.struct(
                p["t"].alias("timestamp"),
                p["o"].alias("open"),
                p["h"].alias("high"),
                p["l"].alias("low"),
                p["c"].alias("close"),
            )
            for p in parts
        ]
    )
    payload = (
        F.when(F.col("event_type") == "error", F.to_json(records))
        .when(F.col("event_type") == "view", F.to_json(F.struct(arrays.alias("data"))))
        .otherwise(F.to_json(arrays))
    )
    responses = _table(spark, sf_dir, "events").select(
        payload.alias("payload"), F.col("event_type").alias("symbol"), F.lit("5").alias("resolution")
    )
    parsed = payloads.parse_payloads(responses)
    return _naive(payloads.payload_bars(parsed, "market_api", "api"))


def payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One two-bar response per event, each event type broken in its own way."""
    low, kind = F.col("value"), F.col("event_type")
    pair = {n: F.array(low + d, low + d) for n, d in zip("ohlc", (1, 2, 0, 0.5))}
    pair["h"] = F.when(kind == "click", F.array(low + 2)).otherwise(pair["h"])
    pair["v"] = F.array(low, F.when(kind == "purchase", -1.0).otherwise(low))
    stamps = F.array(F.lit(1_700_000_000), F.when(kind == "signup", 1_700_000_000).otherwise(1_700_000_060))
    whole = F.to_json(F.struct(stamps.alias("t"), *[pair[n].alias(n) for n in "ohlcv"]))
    responses = _table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "error", F.substring(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole).alias("payload"),
        kind.alias("symbol"),
        F.when(F.col("event_id") % 10 == 0, "2").otherwise("5").alias("resolution"),
    )
    return payloads.rejected_payloads(payloads.parse_payloads(responses)).select("event_id", "timeframe", "error")


# ---- events and streaming -----------------------------------------------------


def event_json_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = events.build_events(event_bars(spark, sf_dir))
    messages = events.to_messages(built)
    checked = events.validate_messages(messages)
    return checked.select(
        "key", *[c for c in events.event_columns()], F.col("error").alias("error")
    ).drop("published_at")


def event_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = events.validate_messages(as_messages(raw_events(spark, sf_dir)))
    return checked.groupBy("key", "error_type", "error").agg(F.count(F.lit(1)).alias("rows"))


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = events.validate_messages(as_messages(raw_events(spark, sf_dir)))
    rows = events.dead_letters(checked.filter("error IS NOT NULL"))
    sent = F.from_json("payload", "symbol string, source_record_id string, low double, volume double")
    return rows.withColumn("sent", sent).select("schema_version", "original_key", "error_type", "error", "sent.*")


def foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events under keys that are partly another event's, or none."""
    messages = events.to_messages(raw_events(spark, sf_dir), {"part": F.col("source_record_id").cast("bigint")})
    sent = F.when(F.col("part") % 7 == 0, F.concat("key", F.lit("x"))).when(F.col("part") % 5 != 0, F.col("key"))
    checked = events.validate_messages(messages.withColumn("key", sent))
    return checked.groupBy("error_type", "error", (F.col("part") % 35).alias("part")).agg(F.count(F.lit(1)).alias("rows"))


def ingest_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.count_outcomes(as_messages(raw_events(spark, sf_dir)))


def _run_stream(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "stream")
    schema = _table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    query = ingest.start_ingest(
        as_messages(minutes_from_events(stream)),
        f"{root}/bronze",
        f"{root}/dlq",
        f"{root}/cp",
        outcomes_root=f"{root}/outcomes",
    )
    query.awaitTermination()
    return root


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events accepted by a Structured Streaming run over ``events``, whole records."""
    bronze = read_raw_events(spark, f"{_run_stream(spark, sf_dir)}/bronze")
    return bronze.drop("consumed_at", "_corrupt_record")


def stream_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.run_outcomes(spark, f"{_run_stream(spark, sf_dir)}/outcomes")


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of the stream through the batch job; returns the Silver layer."""
    root = _run_stream(spark, sf_dir)
    run_batch(spark, *_batch_folders(root, "bronze"))
    return _naive(read_silver(spark, f"{root}/silver"))


def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    dlq = spark.read.json(f"{_run_stream(spark, sf_dir)}/dlq/query=*/batch=*")
    sent = {c: F.get_json_object("payload", f"$.{c}") for c in ("symbol", "trading_date", "close")}
    return dlq.withColumns(sent).groupBy("error", "symbol", "trading_date").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum(F.col("close").cast("double")), 4).alias("closes")
    )


def publish_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first thousand bars in series and time order, as message keys."""
    rows = publish.first_rows(event_bars(spark, sf_dir), 1000)
    return events.to_messages(events.build_events(rows)).select("key")


# ---- features -----------------------------------------------------------------


def _quarter_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(event_bars(spark, sf_dir), "15m", validate=False)


def _family(name: str) -> Callable[[SparkSession, str], DataFrame]:
    columns = feature_families()[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        built = add_features(with_position(_quarter_hours(spark, sf_dir)))
        digits = oracles.digits(name)
        return _naive(
            built.select("symbol", "event_time", *[F.round(c, digits).alias(c) for c in columns])
        )

    return run


def feature_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = build_features(_quarter_hours(spark, sf_dir))
    return _naive(
        built.select("symbol", "event_time", "available_at", "feature_set_version", "feature_status")
    )


def contract_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract-only columns of the quarter hours, but for the exponential means."""
    made = contract_features(_quarter_hours(spark, sf_dir))
    rounded = [F.round(c, 5).alias(c) for c in oracles.CONTRACT_WINDOW_COLUMNS]
    return _naive(made.select("symbol", "event_time", *rounded, "hour", "day_of_week", "is_session_end"))


def long_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as one series over several blocks: one bar for each order line."""
    price = F.col("l_extendedprice")
    lines = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min(price).alias("low"), F.max(price).alias("high"), F.max("l_quantity").alias("volume")
    )
    at = F.timestamp_seconds(F.lit(946_684_800) + 60 * (8 * F.col("l_orderkey") + F.col("l_linenumber")))
    bars = lines.select(
        F.lit("ALL").alias("symbol"),
        at.alias("event_time"),
        F.to_date(F.from_utc_timestamp(at, MARKET_ZONE)).alias("trading_date"),
        F.lit("1m").alias("timeframe"),
        F.col("low").alias("open"), "high", "low", F.col("high").alias("close"),
        F.col("volume").cast("double").alias("volume"),
    )
    built = build_features(bars)
    return _naive(built.select("symbol", "event_time", *[F.round(c, 5).alias(c) for c in oracles.LONG_SERIES]))


def feature_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_summary(build_features(event_bars(spark, sf_dir), unique_keys=False))


def gold_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written, features built from it, Gold read back per day."""
    root = scratch_path(spark, "gold")
    layers.write_layer(_quarter_hours(spark, sf_dir), f"{root}/silver")
    build_gold(spark, f"{root}/silver", f"{root}/gold")
    return (
        spark.read.parquet(f"{root}/gold")
        .groupBy("feature_set_version", "symbol", "timeframe", "trading_date", "feature_status")
        .agg(
            F.count(F.lit(1)).alias("bars"),
            F.round(F.sum("mom_points_1"), 4).alias("moves"),
            *[F.round(F.sum(c), 3).alias(c) for c in oracles.GOLD_SUMS],
        )
    )


# ---- text preparation ----------------------------------------------------------


def _text_modules() -> tuple:
    """The text operators' queries and the pipeline, as far as they are installed."""
    if not importlib.util.find_spec("barlake.llm"):
        return ()
    names = ["barlake.llm.queries", "corpus_pipeline"]
    return tuple(importlib.import_module(name) for name in names if importlib.util.find_spec(name))


# ---- labels and gaps ------------------------------------------------------------


def forward_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the quarter hours with their time split."""
    made = labels.forward_labels(_quarter_hours(spark, sf_dir), 4, 0.05)
    split = labels.time_split(F.col("event_time"), "2024-01-10", "2024-01-20")
    return _naive(made.withColumns({"future_return": F.round("future_return", 9), "split": split}))


def time_quantile_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter hours of all series split 60/20/20 by time."""
    split = labels.quantile_split(_quarter_hours(spark, sf_dir))
    return _naive(split.select("symbol", "event_time", "split"))


def binary_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = labels.forward_labels(_quarter_hours(spark, sf_dir), 4, 0.05)
    kept = training.binary_labels(made).select("symbol", "event_time", "target", F.round("future_return", 9).alias("future_return"))
    return _naive(kept)


def _training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter hours with their time split; full hours miss their volume."""
    rows = labels.quantile_split(_quarter_hours(spark, sf_dir))
    return rows.withColumn("volume", F.when(F.minute("event_time") != 0, F.col("volume")))


def preparation_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = training.fit_preparation(_training_rows(spark, sf_dir), ("close", "high", "volume"))
    return found.select("column", *[F.round(c, 6).alias(c) for c in ("median", "mean", "scale")])


def prepared_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every split's rows, imputed and scaled by what the train rows taught."""
    rows = _training_rows(spark, sf_dir)
    done = training.apply_preparation(rows, training.fit_preparation(rows, ("close", "high", "volume")))
    return _naive(done.select("symbol", "event_time", *[F.round(c, 6).alias(c) for c in ("close", "high", "volume")]))


def feature_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bar columns by how far they tell the symbols apart in the train rows."""
    ranked = training.rank_features(_training_rows(spark, sf_dir), ("close", "high", "low", "volume"), "symbol")
    return ranked.withColumn("f_value", F.round("f_value", 6))


def candidate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every classifier candidate on the features and labels of the quarter hours."""
    bars = _quarter_hours(spark, sf_dir)
    ahead = labels.forward_labels(bars, 4, 0.05).select(*BUSINESS_KEY, "label")
    rows = labels.quantile_split(build_features(bars).join(ahead, list(BUSINESS_KEY)))
    return models.compare_candidates(rows.where("feature_status = 'ready'"), FEATURE_COLUMNS, "label")


def gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.gap_report(_quarter_hours(spark, sf_dir))


def missing_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _naive(labels.missing_bars(_quarter_hours(spark, sf_dir)))


def missing_in_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _naive(labels.missing_in_sessions(_quarter_hours(spark, sf_dir)))


def signal_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels taken for signals: the report of their contract."""
    made = labels.forward_labels(_quarter_hours(spark, sf_dir), 1, 0.01)
    signals = made.withColumns(
        {
            "pipeline_run_id": F.lit("run"),
            "strategy_name": F.lit("ahead"),
            "signal": F.coalesce("label", F.lit("CLOSE")),
            "position": F.when(F.col("label") == "LONG", 1).when(F.col("label") == "SHORT", -1).otherwise(0),
            "confidence": F.abs("future_return"),
            "close": F.lit(1.0),
        }
    )
    return quality.contract_report(signals, labels.signal_rules(), labels.SIGNAL_KEY)


# ---- contract -----------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the full feature build over 15-minute bars."""
    return build_features(_quarter_hours(spark, SMOKE_DIR)).select(
        *BUSINESS_KEY, "trading_date", *NUMERICS, *FEATURE_COLUMNS, "feature_status"
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {f"resample_{t}": _resample(t) for t in ("5m", "15m", "30m")}
    out |= {
        "landing_contract": landing_contract,
        "silver_contract": silver_contract,
        "duplicate_keys": duplicate_keys,
        "quality_flags": quality_flags,
        "quality_metrics": quality_metrics,
        "bronze_rows": bronze_rows,
        "dedupe_silver": _newest("all"),
        "dedupe_silver_valid_scope": _newest("valid"),
        "batch_silver": batch_silver,
        "batch_report": batch_report,
        "history_csv_bars": history_csv_bars,
        "history_runs": history_runs,
        "landing_layer": landing_layer,
        "landing_summary": landing_summary,
        "payload_bars": payload_bars,
        "payload_rejects": payload_rejects,
        "event_json_key": event_json_key,
        "event_errors": event_errors,
        "dead_letters": dead_letters,
        "foreign_keys": foreign_keys,
        "ingest_outcomes": ingest_outcomes,
        "stream_bronze": stream_bronze,
        "stream_outcomes": stream_outcomes,
        "stream_silver": stream_silver,
        "stream_dead_letters": stream_dead_letters,
        "publish_first": publish_first,
    }
    out |= {f"ft_{name}": _family(name) for name in feature_families()}
    out |= {
        "ft_status": feature_status,
        "ft_counts": feature_counts,
        "ft_long_series": long_series,
        "contract_columns": contract_columns,
        "gold_layer": gold_layer,
        "forward_labels": forward_labels,
        "time_quantile_split": time_quantile_split,
        "binary_labels": binary_labels,
        "preparation_parameters": preparation_parameters,
        "prepared_rows": prepared_rows,
        "feature_ranking": feature_ranking,
        "candidate_scores": candidate_scores,
        "gap_report": gap_report,
        "missing_bars": missing_bars,
        "missing_in_sessions": missing_in_sessions,
        "signal_contract": signal_contract,
    }
    for module in _text_modules():
        out |= module.queries()
    return out


def oracle_sql() -> dict[str, str]:
    out = oracles.all_queries()
    for module in _text_modules():
        out |= module.oracle_sql()
    return out
