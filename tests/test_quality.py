"""Row rules, dedupe, the batch job, history files and resampling."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from barlake.functions import bars, times
from barlake.operators import dedupe, quality
from barlake.operators.resample import resample
from barlake.operators.series import with_position
from barlake.plans.batch import run_batch
from barlake.plans.landing import load_history
from barlake.runtime import stage
from barlake.schema import RAW_SCHEMA, ContractError
from barlake.sinks import layers
from barlake.sources.history_csv import content_run_ids, read_history
from barlake.sources.lake import read_silver
from barlake.sources.raw_events import read_raw_events

CSV = """Date,Open,High,Low,Close,Volume
2026-02-10 10:00:00,40.0,43.0,38.5,41.0,7.0
2026-02-10 10:07:00,41.0,44.5,39.0,42.5,1.0
2026-02-10 10:12:00,42.5,43.5,40.0,40.5,5.0
2026-02-10 10:15:00,40.5,41.0,36.0,37.0,9.0
2026-02-10 10:29:00,37.0,39.5,36.5,39.0,4.0
"""


def event(**changes):
    base = dict(
        schema_version="ohlcv_raw_v1",
        symbol="AAA",
        event_time="2026-01-05T02:00:00Z",
        trading_date="2026-01-05",
        timeframe="1m",
        open=10.0,
        high=11.0,
        low=9.0,
        close=10.5,
        volume=5.0,
        source="t",
        source_record_id=None,
        ingest_run_id="r",
        published_at="2026-01-05T02:01:00Z",
        kafka_key="k",
        kafka_partition=0,
        kafka_offset=1,
        consumed_at="2026-01-05T02:02:00Z",
    )
    return base | changes


def write_events(root, events, extra=()):
    folder = root / "raw" / "symbol=AAA"
    folder.mkdir(parents=True)
    lines = [json.dumps(e) for e in events] + list(extra)
    (folder / "events.json").write_text("\n".join(lines) + "\n")
    return str(root / "raw")


BAD = [
    dict(schema_version="v0"),
    dict(symbol="  "),
    dict(symbol=None),
    dict(event_time="never"),
    dict(published_at=None),
    dict(trading_date="2026-1-5"),
    dict(trading_date="2026-01-04"),
    dict(timeframe="2m"),
    dict(open=None),
    dict(close=0.0),
    dict(volume=-1.0),
    dict(high=10.0),
    dict(low=10.2),
    dict(source=None),
    dict(ingest_run_id=None),
    dict(high=float("inf")),
    dict(volume=float("nan")),
    dict(open="text"),
]


def test_every_rule_rejects_its_row(spark, tmp_path):
    root = write_events(tmp_path, [event(), *[event(**b) for b in BAD]], ["{broken", ""])
    rows = quality.flag_events(read_raw_events(spark, root))
    counts = {r["quality_status"]: r["count"] for r in rows.groupBy("quality_status").count().collect()}
    assert counts == {"valid": 1, "rejected": len(BAD) + 1}
    lenient = quality.flag_events(read_raw_events(spark, root), reject_non_finite=False)
    assert lenient.filter("quality_status = 'valid'").count() == 3


def history(spark):
    later, other = "2026-01-05T03:00:00Z", "2026-01-05T02:05:00Z"
    rows = [
        event(open=10.1),
        event(open=10.2, consumed_at=later),
        event(open=10.3, consumed_at=later, kafka_offset=7),
        event(event_time=other, open=10.4),
        event(event_time=other, open=-1.0, consumed_at=later),
        event(symbol=None),
        event(symbol=None),
    ]
    fields = RAW_SCHEMA.fields[:-1]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    return spark.createDataFrame([tuple(r[f.name] for f in fields) for r in rows], ddl)


def test_counts_and_newest(spark):
    rows = quality.flag_events(history(spark))
    stats = dedupe.key_stats(rows)
    m = dedupe.quality_metrics(stats).first().asDict()
    assert m == dict(
        input_rows=7, distinct_business_keys=2, duplicate_rows=7, valid_rows=4, rejected_rows=3
    )
    counted = dedupe.with_duplicate_counts(rows, stats)
    assert sorted(r["duplicate_count"] for r in counted.collect()) == [2, 2, 2, 2, 3, 3, 3]
    newest = dedupe.newest_per_key(rows).collect()
    assert [(r["open"], r["duplicate_count"]) for r in newest] == [(10.3, 3)]
    valid = dedupe.newest_per_key(rows, "valid").collect()
    assert sorted(r["open"] for r in valid) == [10.3, 10.4]


def executed_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_is_split_by_measured_size(spark):
    """Half of the rows hold one key: its partition is split, and rows and counts are scanned once each."""
    at = F.timestamp_seconds(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") - F.col("id") % 4))
    made = spark.range(0, 120_000, 1, 12).select(
        F.when(F.col("id") % 2 == 1, "S").alias("symbol"), at.alias("event_time"), F.lit("1m").alias("timeframe"),
        F.lit("valid").alias("quality_status"), F.xxhash64("id").alias("payload"),
    )
    rows = stage(made, "rows")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        counted = dedupe.with_duplicate_counts(rows, dedupe.key_stats(rows))
        got = counted.select("symbol", "duplicate_count", "is_duplicate")
        found = {}
        for r in got.collect():
            found[tuple(r)] = found.get(tuple(r), 0) + 1
        plan = executed_plan(got).split("Initial Plan")[0]
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert found == {(None, 60_000, True): 60_000, ("S", 2, True): 60_000}
    assert "skew=true" in plan and plan.count("FileScan parquet") == 2


def test_resampling_takes_two_exchanges(spark):
    rows = [("A", datetime(2024, 1, 2, 1, m), "x" if m else "first", f"r{m % 2}", float(m)) for m in range(40)]
    bars = spark.createDataFrame(rows, "symbol string, event_time timestamp, source string, ingest_run_id string, open double")
    bars = bars.withColumns({c: F.col("open") for c in ("high", "low", "close", "volume")}).withColumns(
        {"trading_date": F.to_date("event_time"), "ingested_at": F.col("event_time"), "timeframe": F.lit("1m")}
    )
    made = resample(bars.repartition(5), "15m", validate=False)
    plan = executed_plan(made)
    assert plan.count("Exchange hashpartitioning") == 2
    got = [tuple(r) for r in made.orderBy("event_time").select("open", "high", "low", "close", "volume", "source", "ingest_run_id").collect()]
    assert got == [(lo, hi, lo, hi, sum(range(int(lo), int(hi) + 1)), "first", "r0") for lo, hi in ((0.0, 14.0), (15.0, 29.0), (30.0, 39.0))]
    assert {r["ingested_at"].minute for r in made.collect()} == {39}


def shared_times(spark):
    """Bars of which several share a symbol and time."""
    rows = [("A", datetime(2024, 1, 2, 1, m), float(p), f"r{p}") for m in (0, 1, 14, 20) for p in (3, 1, 2)]
    bars = spark.createDataFrame(rows, "symbol string, event_time timestamp, open double, ingest_run_id string")
    return bars.withColumns({c: F.col("open") for c in ("high", "low", "close", "volume")}).withColumns(
        {
            "trading_date": F.to_date("event_time"),
            "timeframe": F.lit("1m"),
            "source": F.lit("s"),
            "source_record_id": F.lit(None).cast("string"),
            "ingested_at": F.col("event_time"),
            "quality_status": F.lit("valid"),
        }
    )


def test_bars_that_share_a_time_all_count(spark):
    bars = shared_times(spark)
    with pytest.raises(ContractError, match="duplicate business key"):
        resample(bars, "15m")
    for parts in (1, 5):
        made = resample(bars.repartition(parts), "15m", unique_keys=False).orderBy("event_time")
        got = [tuple(r) for r in made.select("open", "high", "low", "close", "volume", "ingest_run_id").collect()]
        assert got == [(1.0, 3.0, 1.0, 3.0, 18.0, "r1"), (1.0, 3.0, 1.0, 3.0, 6.0, "r1")]
    broken = bars.withColumn("low", F.when(F.minute("event_time") == 20, F.col("high") + 1).otherwise(F.col("low")))
    with pytest.raises(ContractError, match="high is below"):
        resample(broken, "15m", unique_keys=False)


@pytest.mark.parametrize("name", ["ft_counts", "resample_5m", "resample_15m", "resample_30m", "landing_layer", "landing_summary"])
def test_event_bars_may_share_a_time(spark, tmp_path, name):
    import __spark_entry__ as entry

    rows = [(n, datetime(2024, 1, 2, 1, n % 20), 7, "view", 1.0 + n % 3, '{"k": 2}') for n in range(60)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.write.parquet(str(tmp_path / "events.parquet"))
    found = entry.queries()[name](spark, str(tmp_path)).collect()
    if name == "ft_counts":
        assert [tuple(r) for r in found] == [(60, 116, 0, 60)]
    elif name == "landing_summary":
        assert (found[0]["source_rows"], found[0]["output_rows"]) == (60, 1)
    elif name == "landing_layer":
        assert sorted((r["timeframe"], r["bars"], r["volume"]) for r in found) == [("15m", 2, 120.0), ("1m", 60, 120.0)]
    else:
        assert sum(r["volume"] for r in found) == 120.0
        assert len(found) == {"resample_5m": 4, "resample_15m": 2, "resample_30m": 1}[name]


def test_batch_job_is_repeatable(spark, tmp_path):
    root = write_events(tmp_path, [event(), event(kafka_offset=2, open=10.6), event(close=0.0)], ["{x"])
    bronze, silver, report = (str(tmp_path / n) for n in ("bronze", "silver", "report"))
    first, second = (run_batch(spark, root, bronze, silver, report, run_id="one") for _ in range(2))
    assert [(r["run_id"], r["input_rows"], r["valid_rows"], r["rejected_rows"]) for r in (first, second)] == [("one", 4, 2, 2)] * 2
    assert spark.read.parquet(bronze).count() == 4
    assert [r["open"] for r in read_silver(spark, silver).collect()] == [10.6]
    assert spark.read.json(f"{report}/json").first()["duplicate_rows"] == 3
    (tmp_path / "none").mkdir()
    with pytest.raises(ContractError, match="no events"):
        run_batch(spark, str(tmp_path / "none"), "b", "s", "r")


def test_history_and_resample(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text(CSV)
    bars = read_history(spark, str(path), "AAA")
    rows = bars.orderBy("event_time").collect()
    assert len(bars.columns) == 14 and [r["source_record_id"] for r in rows] == list("01234")
    assert rows[0]["ingest_run_id"].startswith("csv_") and len(rows[0]["ingest_run_id"]) == 20
    assert bars.filter("event_time = timestamp'2026-02-10 03:00:00'").count() == 1
    coarse = resample(bars, "15m").orderBy("event_time").collect()
    got = [tuple(r[n] for n in ("open", "high", "low", "close", "volume")) for r in coarse]
    assert got == [(40.0, 44.5, 38.5, 40.5, 13.0), (40.5, 41.0, 36.0, 39.0, 13.0)]
    out = str(tmp_path / "landing")
    summary = load_history(spark, str(path), out, "AAA")
    assert (summary["source_rows"], summary["output_rows"]) == (5, 2)
    load_history(spark, str(path), out, "AAA")
    assert spark.read.parquet(out).count() == 7


def test_bad_history_is_refused(spark, tmp_path):
    bad_high = tmp_path / "a.csv"
    bad_high.write_text(CSV.replace("43.0,38.5", "1.0,38.5"))
    with pytest.raises(ContractError, match="high"):
        resample(read_history(spark, str(bad_high), "AAA"), "15m")
    bad_time = tmp_path / "b.csv"
    bad_time.write_text(CSV.replace("2026-02-10 10:07:00", "soon"))
    with pytest.raises(ContractError, match=r"rows \[1\]"):
        read_history(spark, str(bad_time), "AAA")
    with pytest.raises(ContractError, match="volume"):
        no_volume = tmp_path / "c.csv"
        no_volume.write_text(CSV.replace("Volume", "Other"))
        read_history(spark, str(no_volume), "AAA")
    with pytest.raises(ContractError, match="timeframe"):
        resample(read_history(spark, str(bad_high), "AAA"), "2m")


def run_id(spark, path):
    return {r["ingest_run_id"] for r in content_run_ids(spark, str(path)).collect()}


def test_run_id_follows_content_and_order_not_splits(spark, tmp_path):
    lines = CSV.splitlines()
    (tmp_path / "a.csv").write_text(CSV)
    (tmp_path / "b.csv").write_text("\n".join(lines[:1] + lines[:0:-1]) + "\n")
    first = run_id(spark, tmp_path / "a.csv")
    assert len(first) == 1 and first != run_id(spark, tmp_path / "b.csv")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        assert run_id(spark, tmp_path / "a.csv") == first
        ids = [r["source_record_id"] for r in read_history(spark, str(tmp_path / "a.csv"), "A").orderBy("event_time").collect()]
        assert ids == list("01234")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text(CSV)
    swapped = "Date,Close,High,Low,Open,Volume"
    (tmp_path / "b.csv").write_text(CSV.replace(CSV.splitlines()[0], swapped))
    with pytest.raises(Exception, match="(?i)header"):
        read_history(spark, str(tmp_path), "AAA").collect()


def canonical(spark, tmp_path):
    (tmp_path / "h.csv").write_text(CSV)
    return stage(read_history(spark, str(tmp_path / "h.csv"), "AAA"), "bars")


def test_null_keys_and_nan_are_named(spark, tmp_path):
    bars = canonical(spark, tmp_path)
    for check in (quality.assert_landing, quality.assert_silver):
        assert check(bars) == 5
        with pytest.raises(ContractError, match="null or non-numeric"):
            check(bars.withColumn("volume", F.lit(float("nan"))))
        with pytest.raises(ContractError, match="key must not be null"):
            check(bars.withColumn("symbol", F.lit(None).cast("string")))
    loose = bars.withColumn("symbol", F.when(F.col("volume") > 4, F.col("symbol")))
    assert sorted(r["pos"] for r in with_position(loose).collect()) == [0, 0, 1, 1, 2]


def test_names_that_look_alike_stay_apart(spark, tmp_path):
    bars, root = canonical(spark, tmp_path), str(tmp_path / "landing")
    for name in ("run:1", "run/1", "run_1", "run:1"):
        layers.write_landing(bars.withColumn("ingest_run_id", F.lit(name)), root)
    counts = {r["ingest_run_id"]: r["count"] for r in spark.read.parquet(root).groupBy("ingest_run_id").count().collect()}
    assert counts == {"run:1": 5, "run/1": 5, "run_1": 5}


def test_files_of_a_layer_are_in_time_order(spark, tmp_path):
    root = str(tmp_path / "layer")
    layers.write_layer(canonical(spark, tmp_path).orderBy(F.desc("event_time")), root)
    rows = spark.read.parquet(root).select("event_time", F.monotonically_increasing_id().alias("n")).orderBy("n").collect()
    assert [r["event_time"] for r in rows] == sorted(r["event_time"] for r in rows)


def test_times(spark):
    texts = ["2026-03-29 02:30:00", "2026-10-25 02:30:00", "2026-07-01 12:00:00", "2026-07-01T12:00:00+02:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(times.utc_iso(times.parse_market_time(F.col("t"), "Europe/Paris"))).collect()]
    assert got == [None, None, "2026-07-01T10:00:00Z", "2026-07-01T10:00:00Z"]
    micro = spark.createDataFrame([(datetime(2026, 1, 1, 0, 0, 0, 5),)], "t timestamp")
    assert micro.select(times.utc_iso(F.col("t"))).first()[0].endswith("00.000005Z")


def test_short_ways_read_texts_as_the_long_ones_do(spark):
    stamps = ["2024-01-02T03:04:05Z", " 2024-01-02T03:04:05Z ", "2024-01-02T03:04:05", "2024-01-02 03:04 +07:00", "Z", "", None,
              "2024-01-02T03:04:05z", "2024-01-02T03:04:05.5Z", "2024-01-02T03:04:05Z\n", "x2024-01-02T03:04:05Z", "3:04 UTC"]
    numbers = [" 1.5 ", "1e3", "NaN", " nan", "Infinity ", "-inf", "1,5", "", " ", "\t2", "1d", "0x1p3", "true", None, "1 2"]
    rows = spark.createDataFrame([(t,) for t in stamps + numbers], "t string")
    long_way = rows.select(F.trim("t").rlike(times._AWARE).alias("a"), F.trim("t").try_cast("double").alias("n"))
    short_way = rows.select(times.has_offset(F.col("t")).alias("a"), bars.to_number(F.col("t")).alias("n"))
    assert str(short_way.collect()) == str(long_way.collect())
    plan = executed_plan(rows.select(bars.to_number(F.col("t"))))
    assert "trim" not in plan
