"""Event contract, payloads, publishing and streaming ingestion."""

import json
import random

import pytest
from pyspark.sql import functions as F

from barlake.operators import events as E
from barlake.schema import ContractError
from barlake.sources import payloads as P
from barlake.sources.kafka import as_text
from barlake.sources.raw_events import read_raw_events
from barlake.streaming import ingest
from barlake.streaming.ingest import (
    count_outcomes,
    first_per_key,
    query_id,
    run_outcomes,
    start_ingest,
    unclaimed,
    write_bronze_batch,
)
from barlake.streaming.publish import first_rows, publish

GOOD = dict(
    schema_version="ohlcv_raw_v1",
    symbol="AAA",
    event_time="2026-03-11T02:15:00Z",
    trading_date="2026-03-11",
    timeframe="1m",
    open=87.25,
    high=88.5,
    low=86.75,
    close=88.0,
    volume=640.0,
    source="test",
    ingest_run_id="r",
    published_at="2026-03-11T02:16:00Z",
)
KEY = "AAA|2026-03-11T02:15:00Z|1m"

CASES = [
    ({}, None),
    ({"open": "87.25"}, None),
    ({"timeframe": "2m", "key": "AAA|2026-03-11T02:15:00Z|2m"}, None),
    ({"schema_version": "v9", "volume": -1}, "Unsupported schema_version: v9"),
    ({"symbol": " "}, "symbol and timeframe must not be empty"),
    ({"symbol": None}, "symbol and timeframe must not be empty"),
    ({"event_time": "2026-03-11T02:15:00"}, "Invalid event value: timestamps must be timezone-aware"),
    ({"event_time": "x"}, "Invalid event value: unreadable timestamp"),
    ({"close": "x"}, "Invalid event value: not a number"),
    ({"close": "Infinity"}, "OHLCV values must be finite numbers"),
    ({"low": 0}, "OHLC prices must be greater than zero"),
    ({"high": 87.5}, "OHLC bounds are invalid"),
    ({"volume": -1}, "volume must not be negative"),
    ({"trading_date": "2026-03-10"}, "trading_date does not match event_time"),
    ({"key": "wrong-key"}, "Kafka message key does not match the event business key"),
]


def message(changes):
    key = changes.get("key", KEY)
    body = GOOD | {k: v for k, v in changes.items() if k != "key"}
    return key, json.dumps(body)


def test_first_broken_rule_wins(spark):
    rows = [(n, *message(c)) for n, (c, _) in enumerate(CASES)]
    extra = [("k", "{"), ("k", "[1]"), ("k", '{"bad": true}')]
    rows += [(len(CASES) + n, *m) for n, m in enumerate(extra)]
    df = spark.createDataFrame(rows, "n int, key string, value string")
    got = {r["n"]: r for r in E.validate_messages(df).collect()}
    for n, (_, reason) in enumerate(CASES):
        assert got[n]["error"] == reason, CASES[n]
    tail = [got[len(CASES) + n] for n in range(3)]
    assert [t["error_type"] for t in tail] == ["MalformedPayload", "ContractViolation", "ContractViolation"]
    assert tail[2]["error"].startswith("Missing event fields: close, event_time")


def bars(spark):
    row = ("aaa ", "2026-03-11 02:15:00", "1m", 87.25, 88.5, 86.75, 88.0, 640.0)
    ddl = "symbol string, t string, timeframe string, open double, high double, low double, close double, volume double"
    df = spark.createDataFrame([row], ddl)
    return df.withColumn("event_time", F.to_timestamp("t")).drop("t")


def test_publish(spark, tmp_path):
    out = str(tmp_path / "topic")
    assert publish(bars(spark), lambda m: m.write.json(out), source="test") == 1
    sent = spark.read.json(out).first()
    event = json.loads(sent["value"])
    assert sent["key"] == KEY and event["trading_date"] == "2026-03-11" and event["source"] == "test"
    assert event["source_record_id"] is None and event["ingest_run_id"]
    with pytest.raises(ContractError, match="bounds"):
        publish(bars(spark).withColumn("high", F.lit(1.0)), lambda m: None)
    with pytest.raises(ValueError):
        publish(bars(spark), lambda m: None, limit=0)


DDL = "key string, value string, `partition` int, offset long"


def run_stream(spark, root, checkpoint="cp"):
    stream = spark.readStream.schema(DDL).json(str(root / "in"))
    places = (str(root / n) for n in ("bronze", "dlq", checkpoint))
    query = start_ingest(stream, *places, outcomes_root=str(root / "outcomes"))
    query.awaitTermination()
    return query


def put(root, name, rows):
    (root / "in").mkdir(exist_ok=True)
    names = ("key", "value", "partition", "offset")
    (root / "in" / name).write_text("\n".join(json.dumps(dict(zip(names, r))) for r in rows))


def outcomes(spark, root):
    return {r["outcome"]: r["rows"] for r in run_outcomes(spark, str(root / "outcomes")).collect()}


def test_stream_routes_and_remembers(spark, tmp_path):
    good = message({})
    put(tmp_path, "a.json", [(*good, 0, 1), (*good, 0, 2), ("wrong-key", '{"bad": true}', 0, 3)])
    query = run_stream(spark, tmp_path)
    assert query.lastProgress["numInputRows"] == 3  # the source is read once
    assert outcomes(spark, tmp_path) == {"accepted": 1, "duplicate": 1, "dead_lettered": 1}
    put(tmp_path, "b.json", [(*good, 0, 4)])
    run_stream(spark, tmp_path)
    assert outcomes(spark, tmp_path) == {"accepted": 1, "duplicate": 2, "dead_lettered": 1}
    bronze = read_raw_events(spark, str(tmp_path / "bronze")).collect()
    assert [(r["kafka_key"], r["symbol"], r["open"], r["kafka_offset"]) for r in bronze] == [(KEY, "AAA", 87.25, 1)]
    dead = spark.read.json(str(tmp_path / "dlq" / "query=*" / "batch=*")).collect()
    assert [(d["original_key"], d["payload"]) for d in dead] == [("wrong-key", '{"bad": true}')]
    batch = spark.read.schema(DDL).json(str(tmp_path / "in"))
    counts = {r["outcome"]: r["rows"] for r in count_outcomes(batch).collect()}
    assert counts == {"accepted": 1, "duplicate": 2, "dead_lettered": 1}
    known = spark.createDataFrame([(KEY,)], "key string")
    counts = {r["outcome"]: r["rows"] for r in count_outcomes(batch, known).collect()}
    assert counts == {"accepted": 0, "duplicate": 3, "dead_lettered": 1}


def test_stream_keeps_the_first_event_of_each_key(spark, tmp_path):
    rows = []
    for n in range(12):
        at = f"2026-03-11T02:{n:02d}:00Z"
        for offset, volume in ((n, 1.0), (100 + n, 2.0), (50 + n, 3.0)):
            changes = {"event_time": at, "volume": volume, "key": f"AAA|{at}|1m"}
            rows.append((*message(changes), n % 2, offset))
    put(tmp_path, "a.json", rows[::-1])
    run_stream(spark, tmp_path)
    bronze = read_raw_events(spark, str(tmp_path / "bronze")).collect()
    assert sorted((r["kafka_offset"], r["volume"]) for r in bronze) == [(n, 1.0) for n in range(12)]
    # A new checkpoint on the same layer reads everything again and adds nothing.
    run_stream(spark, tmp_path, "other")
    assert read_raw_events(spark, str(tmp_path / "bronze")).count() == 12
    # A batch that is retried replaces its own folder and takes the same events.
    first = query_id(spark, str(tmp_path / "cp"))
    checked = E.validate_messages(spark.read.schema(DDL).json(str(tmp_path / "in")))
    folder = f"query={first}/batch=0"
    again = unclaimed(first_per_key(checked), str(tmp_path / "bronze"), first, "0")
    write_bronze_batch(again, str(tmp_path / "bronze"), folder)
    bronze = read_raw_events(spark, str(tmp_path / "bronze")).collect()
    assert sorted((r["kafka_offset"], r["volume"]) for r in bronze) == [(n, 1.0) for n in range(12)]


def day_rows(day, minutes, offset=0):
    """Messages of one trading day."""
    out = []
    for n in minutes:
        at = f"{day}T02:{n:02d}:00Z"
        changes = {"event_time": at, "trading_date": day, "key": f"AAA|{at}|1m"}
        out.append((*message(changes), 0, offset + n))
    return out


def test_a_batch_reads_the_claims_of_its_days_only(spark, tmp_path):
    root = str(tmp_path / "bronze")
    days = [f"2026-03-{d:02d}" for d in (9, 10, 11)]
    for n, day in enumerate(days):
        put(tmp_path, f"{n}.json", day_rows(day, range(4)))
        run_stream(spark, tmp_path)
    # Late rows of the first day: two are repeats, one is new.
    put(tmp_path, "late.json", day_rows(days[0], range(2, 5), 50))
    run_stream(spark, tmp_path)
    assert outcomes(spark, tmp_path) == {"accepted": 13, "duplicate": 2, "dead_lettered": 0}
    checked = E.validate_messages(spark.read.schema(DDL).json(str(tmp_path / "in" / "late.json")))
    left = unclaimed(first_per_key(checked), root, "other", "0")
    claims = [f for f in left.inputFiles() if "/bronze/" in f]
    assert left.isEmpty() and claims and all(f"/_claims/day={days[0]}/" in f for f in claims)
    # A day's files become one, with the same claims; a layer without claims gets them from Bronze.
    held = lambda: sorted(map(tuple, spark.read.parquet(ingest.claims_path(root)).collect()), key=str)
    before = held()
    ingest.compact_claims(spark, root, days, most=1)
    day_files = list((tmp_path / "bronze" / "_claims" / f"day={days[0]}").glob("*.parquet"))
    assert held() == before and len(before) == 13 and len(day_files) == 1
    (tmp_path / "bronze" / "_claims").rename(tmp_path / "old-claims")
    run_stream(spark, tmp_path, "other")
    assert read_raw_events(spark, root).count() == 13 and held() == before


def test_first_rows_at_any_limit(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", "c", None]), f"2024-01-{rng.randrange(1, 4):02d} {n // 60:02d}:{n % 60:02d}:00", n) for n in range(200)]
    rows += [("a", None, 900), (None, None, 901)]
    bars = spark.createDataFrame(rows, "symbol string, at string, n int").selectExpr("symbol", "CAST(at AS timestamp) event_time", "n")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or ""))
    for limit in (1, 2, 37, 50, 101, 150, 202, 500):
        first = first_rows(bars, limit)
        assert sorted(r["n"] for r in first.collect()) == sorted(r[2] for r in order[:limit]), limit
    plan = first_rows(bars, 37)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "rangepartitioning" not in plan and "SinglePartition" not in plan


def test_empty_names_fall_through(spark):
    built = E.build_events(bars(spark).withColumn("source", F.lit("")), ingest_run_id="").first()
    assert built["source"] == "unknown" and len(built["ingest_run_id"]) == 36


T0 = 1741658400  # 2025-03-11T02:00:00Z
ARRAYS = {"t": [T0, T0 + 60], "o": [51, 53], "h": [55, 56], "l": [50, 52], "c": [54, 52], "v": [3, 8]}
RECORD = {"timestamp": T0, "open": 51, "high": 55, "low": 50, "close": 54}


def test_payload_shapes_and_errors(spark):
    cases = [
        (ARRAYS, "1m", None, 2),
        ({"data": ARRAYS}, 1, None, 2),
        ([RECORD], 5, None, 1),
        ([], 5, None, 0),
        (ARRAYS | {"t": [T0 * 1000, (T0 + 60) * 1000]}, 1, None, 2),
        (ARRAYS | {"t": ["2025-03-11T02:00:00Z", "2025-03-11T02:01:00Z"]}, 1, None, 2),
        (ARRAYS | {"h": [40, 56]}, 1, "OHLC bounds are violated", 0),
        (ARRAYS | {"t": [T0, T0]}, 1, "duplicate timestamps", 0),
        (ARRAYS | {"o": [1]}, 1, "arrays have inconsistent lengths", 0),
        (ARRAYS | {"v": [1, -1]}, 1, "negative volume", 0),
        (ARRAYS | {"c": ["x", 52]}, 1, "non-numeric values", 0),
        (ARRAYS | {"t": ["x", 1]}, 1, "invalid timestamp", 0),
        ({k: v for k, v in ARRAYS.items() if k != "c"}, 1, "missing fields: c", 0),
        (ARRAYS, 7, "unsupported resolution", 0),
        ([RECORD | {"volume": None}], 5, "non-numeric values", 0),
        (ARRAYS | {"v": None}, 1, "non-numeric values", 0),
        ([RECORD | {"volume": 2}, RECORD | {"timestamp": T0 + 60}], 1, "non-numeric values", 0),
    ]
    rows = [(n, json.dumps(p), "aaa", str(r)) for n, (p, r, _, _) in enumerate(cases)]
    rows.append((len(cases), "{", "aaa", "1"))
    df = spark.createDataFrame(rows, "n int, payload string, symbol string, resolution string")
    parsed = P.parse_payloads(df)
    errors = {r["n"]: r["error"] for r in parsed.select("n", "error").collect()}
    assert [errors[n] for n in range(len(cases))] == [e for _, _, e, _ in cases]
    assert errors[len(cases)] == "payload is not valid JSON"
    assert P.rejected_payloads(parsed).count() == 1 + sum(e is not None for _, _, e, _ in cases)
    got = P.payload_bars(parsed, "market_api", "api")
    assert got.count() == sum(k for _, _, _, k in cases)
    five = got.filter("timeframe = '5m'").first()
    assert five["volume"] == 0.0 and five["symbol"] == "AAA"
    assert five["source_record_id"] == "api:AAA:2025-03-11T02:00:00+00:00"


def test_broken_bytes_become_replacement_characters(spark):
    data = [b'{"a": 1}', b'\xff{"a"', b"ok \xe2\x82 cut", "grüß".encode(), b"\xc3\x28\x80", b"", None]
    rows = spark.createDataFrame([(bytearray(d) if d is not None else None,) for d in data], "value binary")
    got = [r["text"] for r in rows.select(as_text(F.col("value")).alias("text")).collect()]
    assert got == [d if d is None else d.decode("utf-8", "replace") for d in data]
