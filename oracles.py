"""DuckDB SQL for the registered queries, written from the definitions.

Exponential means are spelled out as weighted sums over all earlier rows and
rolling windows as plain frames, so nothing here mirrors the Spark plans.
"""

from __future__ import annotations



def digits(family: str) -> int:
    """Rounding of feature values; returns are ratios with ties at five digits."""
    return 9 if family == "returns" else 5

_BARS = """
bars AS (
  SELECT event_type AS symbol, ts AS event_time,
         CAST(ts + INTERVAL 7 HOUR AS DATE) AS trading_date, '1m' AS timeframe,
         value + 1 AS open, value + 1 AS high, value + 1 AS low, value + 1 AS close,
         CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS volume,
         'events' AS source, CAST(event_id AS VARCHAR) AS source_record_id,
         'u' || user_id AS ingest_run_id, ts AS ingested_at
  FROM events)"""


def _resampled(minutes: int) -> str:
    return f"""
binned AS (
  SELECT *, time_bucket(INTERVAL '{minutes} minutes', event_time) AS bin FROM bars),
origin AS (
  SELECT symbol, trading_date, arg_min(source, event_time) AS source,
         arg_min(ingest_run_id, event_time) AS ingest_run_id, max(ingested_at) AS ingested_at
  FROM bars GROUP BY ALL),
coarse AS (
  SELECT symbol, trading_date, bin AS event_time, '{minutes}m' AS timeframe,
         arg_min(open, event_time) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, event_time) AS close, sum(volume) AS volume
  FROM binned GROUP BY symbol, trading_date, bin)"""


def _resample_query(minutes: int) -> str:
    return f"""WITH {_BARS}, {_resampled(minutes)}
SELECT c.*, o.source, o.ingest_run_id, o.ingested_at
FROM coarse c JOIN origin o USING (symbol, trading_date)"""


_RAW = """
prices AS (
  SELECT *, l_extendedprice / l_quantity AS unit FROM lineitem),
raw AS (
  SELECT l_returnflag || l_linestatus AS symbol, l_shipdate AS event_time,
         CAST(l_shipdate AS DATE) AS trading_date, (l_linenumber * 5) || 'm' AS timeframe,
         unit AS open, unit * (1 + l_tax) AS high, unit * (1 - l_discount) AS low,
         unit * (1 + 2 * l_tax - l_discount) AS close, l_quantity - 3 AS volume,
         'lineitem' AS source, CAST(l_partkey AS VARCHAR) AS source_record_id,
         'r' || l_suppkey AS ingest_run_id, l_shipdate AS published_at,
         l_shipdate + INTERVAL 1 DAY AS consumed_at, CAST(NULL AS VARCHAR) AS kafka_key,
         l_linenumber AS kafka_partition, l_orderkey AS kafka_offset
  FROM prices),
checked AS (
  SELECT *, 'ohlcv_raw_v1' AS schema_version,
         least(open, high, low, close) <= 0 AS not_positive,
         high < greatest(open, close, low) OR low > least(open, close, high) AS out_of_bounds,
         volume < 0 AS negative
  FROM raw),
flagged AS (
  SELECT *, CASE WHEN NOT not_positive AND NOT out_of_bounds AND NOT negative
                  AND timeframe IN ('1m', '5m', '15m', '30m')
                 THEN 'valid' ELSE 'rejected' END AS quality_status
  FROM checked),
counted AS (
  SELECT *, count(*) OVER (PARTITION BY symbol, event_time, timeframe) AS duplicate_count
  FROM flagged)"""

_LAYER = """schema_version, symbol, event_time, trading_date, timeframe, open, high, low, close,
  volume, source, source_record_id, ingest_run_id, published_at, consumed_at, kafka_key,
  kafka_partition, kafka_offset, quality_status, duplicate_count > 1 AS is_duplicate,
  duplicate_count"""

_NEWEST = "ORDER BY consumed_at DESC NULLS LAST, kafka_offset DESC NULLS LAST"


_MINUTES = """
minutes AS (
  SELECT event_type AS symbol, date_trunc('minute', ts) AS event_time,
         CAST(ts + INTERVAL 7 HOUR AS DATE) AS trading_date, '1m' AS timeframe,
         value + 1 AS open, value * 2 AS high, least(value, 1.0) AS low, value AS close,
         CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS volume,
         ts AS consumed_at, event_id AS kafka_offset
  FROM events),
counted AS (
  SELECT *, count(*) OVER (PARTITION BY symbol, event_time, timeframe) AS duplicate_count,
         CASE WHEN value_ok AND high >= open THEN 'valid' ELSE 'rejected' END AS quality_status
  FROM (SELECT *, close > 0 AS value_ok FROM minutes))"""


def _newest(scope: str, columns: str = _LAYER, raw: str = _RAW) -> str:
    keep = "quality_status = 'valid'"
    source = "counted" if scope == "all" else f"(SELECT * FROM counted WHERE {keep})"
    return f"""WITH {raw}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, event_time, timeframe {_NEWEST}) AS rnk
  FROM {source})
SELECT {columns} FROM ranked WHERE rnk = 1 AND {keep}"""


_METRICS = """WITH {0}
SELECT count(*) AS input_rows,
       count(DISTINCT (symbol, event_time, timeframe)) AS distinct_business_keys,
       CAST(sum(CASE WHEN duplicate_count > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_rows,
       CAST(sum(CASE WHEN quality_status = 'valid' THEN 1 ELSE 0 END) AS BIGINT) AS valid_rows,
       CAST(sum(CASE WHEN quality_status = 'valid' THEN 0 ELSE 1 END) AS BIGINT) AS rejected_rows
FROM counted"""

# The event contract accepts any non-empty timeframe.
_MESSAGES = f"""{_RAW},
messages AS (
  SELECT symbol || '|' || strftime(event_time, '%Y-%m-%dT%H:%M:%S') || 'Z|' || timeframe AS key,
         symbol, strftime(event_time, '%Y-%m-%dT%H:%M:%S') || 'Z' AS event_time, timeframe,
         strftime(trading_date, '%Y-%m-%d') AS trading_date, source_record_id, low, volume,
         CASE WHEN not_positive THEN 'OHLC prices must be greater than zero'
              WHEN out_of_bounds THEN 'OHLC bounds are invalid'
              WHEN negative THEN 'volume must not be negative' END AS error
  FROM checked)"""

_OUTCOMES = f"""WITH {_MESSAGES},
totals AS (
  SELECT count(DISTINCT CASE WHEN error IS NULL THEN key END) AS accepted,
         count(*) FILTER (error IS NULL) AS valid,
         count(*) FILTER (error IS NOT NULL) AS dead
  FROM messages)
SELECT 'accepted' AS outcome, accepted AS rows FROM totals
UNION ALL SELECT 'duplicate', valid - accepted FROM totals
UNION ALL SELECT 'dead_lettered', dead FROM totals"""

_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'"


_MINUTE_MESSAGES = f"""{_MINUTES},
messages AS (
  SELECT symbol || '|' || strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') || '|1m' AS key, symbol,
         strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') AS event_time, timeframe,
         strftime(trading_date, '%Y-%m-%d') AS trading_date,
         CASE WHEN least(high, low, close) <= 0 THEN 'OHLC prices must be greater than zero'
              WHEN high < open THEN 'OHLC bounds are invalid' END AS error,
         open, high, low, close, volume, kafka_offset
  FROM minutes)"""

#: Gold columns that are summed for each day, beside the price moves.
GOLD_SUMS = ("close", "volume", "minute", "close_to_low", "mom_points_5")

#: The first valid message of each key, by offset.
_FIRST_MESSAGES = f"""{_MINUTE_MESSAGES},
firsts AS (
  SELECT * FROM messages WHERE error IS NULL
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY kafka_offset) = 1)"""


# ---- features -------------------------------------------------------------------

E = "1e-12"
W = "(PARTITION BY symbol ORDER BY i)"


def _lag(x: str, n: int) -> str:
    return f"lag({x}, {n}) OVER {W}"


def _roll(call: str, n: int, first: int = 0) -> str:
    frame = f"(PARTITION BY symbol ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN i >= {first + n - 1} THEN {call} OVER {frame} END"


def _features(
    ctes: str, last: str, features: dict[str, str], places: int = 5, bars: str = f"{_BARS}, {_resampled(15)}"
) -> str:
    body = ",\n  ".join(f"{sql} AS {name}" for name, sql in features.items())
    out = ",\n  ".join(
        f"round(lag({n}, 1) OVER {W}, {places}) + 0.0 AS {n}" for n in features
    )
    return f"""WITH {bars},
x AS (
  SELECT symbol, event_time, open AS o, high AS h, low AS l, close AS c, volume AS v,
         CAST(row_number() OVER (PARTITION BY symbol ORDER BY event_time) - 1 AS BIGINT) AS i
  FROM coarse),
moves AS (
  SELECT *, c / {_lag('c', 1)} - 1 AS ret, (h - l) / c AS rng,
         greatest(c - {_lag('c', 1)}, 0) + 0 * {_lag('c', 1)} AS gain,
         greatest({_lag('c', 1)} - c, 0) + 0 * {_lag('c', 1)} AS loss,
         CASE WHEN i = 0 THEN h - l
              ELSE greatest(h - l, abs(h - {_lag('c', 1)}), abs(l - {_lag('c', 1)})) END AS tr,
         h - {_lag('h', 1)} AS hd, {_lag('l', 1)} - l AS ld
  FROM x),
dm AS (
  SELECT *, CASE WHEN hd > ld AND hd > 0 THEN hd ELSE 0 END AS up,
            CASE WHEN ld > hd AND ld > 0 THEN ld ELSE 0 END AS down
  FROM moves){ctes},
f AS (
  SELECT symbol, event_time, i, {body}
  FROM {last})
SELECT symbol, event_time, {out}
FROM f"""


def _ewm(
    name: str, source: str, means: dict[str, tuple[str, float, int, int]], reach: int | None = None
) -> str:
    """CTE ``name``: ``source`` plus exponential means (column, alpha, seed, min periods).

    ``reach`` ends the sums after so many rows, where what is left is beyond a double's digits.
    """
    earlier = f"{source} b ON a.symbol = b.symbol AND b.i <= a.i"
    if reach:
        earlier = f"{source} b ON b.symbol = a.symbol AND b.i = a.j"
    sums = ",\n         ".join(
        f"CASE WHEN a.i >= {seed + periods - 1} THEN sum(CASE WHEN b.i < {seed} THEN 0"
        f" WHEN b.i = {seed} THEN b.{x} ELSE {alpha!r} * b.{x} END"
        f" * pow({1 - alpha!r}, a.i - b.i)) END AS {out}"
        for out, (x, alpha, seed, periods) in means.items()
    )
    names = ", ".join(means)
    return f""",
{name}_sums AS (
  SELECT a.symbol, a.i, {sums}
  FROM {f"(SELECT symbol, i, unnest(range(i - {reach}, i + 1)) AS j FROM {source})" if reach else source} a
  JOIN {earlier}
  GROUP BY a.symbol, a.i),
{name} AS (
  SELECT s.*, {names} FROM {source} s JOIN {name}_sums USING (symbol, i))"""


def _span(s: int) -> tuple[str, float, int, int]:
    return ("c", 2 / (s + 1), 0, s)


def _wilder(x: str, p: int, seed: int = 0) -> tuple[str, float, int, int]:
    return (x, 1 / p, seed, p)


def _simple(features: dict[str, str]) -> str:
    return _features("", "dm", features)


def _ft_returns() -> str:
    out = {}
    for n in (1, 2, 3, 5, 8, 13, 21, 34, 55):
        out[f"ret_{n}"] = f"c / {_lag('c', n)} - 1"
        out[f"mom_points_{n}"] = f"c - {_lag('c', n)}"
    return _features("", "dm", out, digits("returns"))


def _ft_price_windows() -> str:
    out = {}
    for n in (5, 10, 20, 40, 80):
        out[f"zclose_{n}"] = f"(c - {_roll('avg(c)', n)}) / ({_roll('stddev_pop(c)', n)} + {E})"
        out[f"volatility_{n}"] = _roll("stddev_pop(ret)", n, 1)
        out[f"range_mean_{n}"] = _roll("avg(rng)", n)
    return _simple(out)


def _ft_ema() -> str:
    spans = (8, 13, 21, 34, 55)
    ctes = _ewm("e", "dm", {f"ema_{s}": _span(s) for s in spans})
    return _features(ctes, "e", {f"ema_dist_{s}": f"(c - ema_{s}) / (ema_{s} + {E})" for s in spans})


#: Features of the series that crosses blocks: lagged, rolling and exponential ones.
LONG_SERIES = ("ret_55", "mom_points_1", "zclose_80", "volatility_20", "ema_dist_8", "ema_dist_13", "close_to_low")


def _ft_long_series() -> str:
    bars = """coarse AS (
  SELECT 'ALL' AS symbol, TIMESTAMP '2000-01-01' + to_minutes(8 * l_orderkey + l_linenumber) AS event_time,
         min(l_extendedprice) AS open, max(l_extendedprice) AS high, min(l_extendedprice) AS low,
         max(l_extendedprice) AS close, max(l_quantity) AS volume
  FROM lineitem GROUP BY l_orderkey, l_linenumber)"""
    means = {"ema_8": _span(8), "ema_13": _span(13)}
    made = {
        "ret_55": f"c / {_lag('c', 55)} - 1",
        "mom_points_1": f"c - {_lag('c', 1)}",
        "zclose_80": f"(c - {_roll('avg(c)', 80)}) / ({_roll('stddev_pop(c)', 80)} + {E})",
        "volatility_20": _roll("stddev_pop(ret)", 20, 1),
        "ema_dist_8": f"(c - ema_8) / (ema_8 + {E})",
        "ema_dist_13": f"(c - ema_13) / (ema_13 + {E})",
        "close_to_low": f"(c - l) / (c + {E})",
    }
    return _features(_ewm("e", "dm", means, 260), "e", made, bars=bars)


def _ft_rsi() -> str:
    means, out = {}, {}
    for p in (7, 14, 28):
        means[f"g{p}"], means[f"l{p}"] = _wilder("gain", p, 1), _wilder("loss", p, 1)
        out[f"rsi_{p}"] = f"100 - 100 / (1 + g{p} / (l{p} + {E}))"
    return _features(_ewm("e", "dm", means), "e", out)


def _ft_atr() -> str:
    ctes = _ewm("e", "dm", {"a14": _wilder("tr", 14), "a20": _wilder("tr", 20)})
    mean, std = _roll("avg(a14)", 80, 13), _roll("stddev_samp(a14)", 80, 13)
    return _features(
        ctes,
        "e",
        {
            "atr_14": "a14",
            "atr_20": "a20",
            "atr_pct_14": f"a14 / (c + {E})",
            "atr_z_80": f"(a14 - {mean}) / ({std} + {E})",
        },
    )


def _ft_adx() -> str:
    means, dx, second = {}, [], {}
    for p in (8, 14):
        means |= {f"t{p}": _wilder("tr", p), f"u{p}": _wilder("up", p), f"d{p}": _wilder("down", p)}
        plus, minus = f"(100 * u{p} / (t{p} + {E}))", f"(100 * d{p} / (t{p} + {E}))"
        dx.append(f"100 * abs({plus} - {minus}) / ({plus} + {minus} + {E}) AS dx{p}")
        second[f"x{p}"] = _wilder(f"dx{p}", p, p - 1)
    ctes = _ewm("e", "dm", means) + f", e2 AS (SELECT *, {', '.join(dx)} FROM e)"
    ctes += _ewm("e3", "e2", second)
    return _features(ctes, "e3", {f"adx_{p}": f"x{p}" for p in (8, 14)})


def _ft_regime() -> str:
    ctes = _ewm("e", "dm", {"a20": _wilder("tr", 20), "a60": _wilder("tr", 60)})
    ratio = f"a20 / (a60 + {E})"
    flag = f"CASE WHEN {ratio} < 1.1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    return _features(ctes, "e", {"atr_fast_slow_ratio": ratio, "vol_regime_low": flag})


def _ft_midline() -> str:
    z, out = [], {}
    periods = (10, 14, 20, 30, 40)
    for p in periods:
        line = f"regr_intercept(c, i) OVER w{p} + regr_slope(c, i) OVER w{p} * i"
        z.append(f"CASE WHEN i >= {p - 1} THEN (c - ({line})) / (1.1 * a20 + {E}) END AS z{p}")
    frames = ", ".join(
        f"w{p} AS (PARTITION BY symbol ORDER BY i ROWS BETWEEN {p - 1} PRECEDING AND CURRENT ROW)"
        for p in periods
    )
    ctes = _ewm("e", "dm", {"a20": _wilder("tr", 20)})
    ctes += f", e2 AS (SELECT *, {', '.join(z)} FROM e WINDOW {frames})"
    for p in periods:
        before = _lag(f"z{p}", 1)
        out[f"lr_atr_z_{p}"] = f"z{p}"
        out[f"lr_atr_z_abs_{p}"] = f"abs(z{p})"
        out[f"lr_atr_z_mom1_{p}"] = f"z{p} - {before}"
        out[f"lr_atr_z_mom3_{p}"] = f"z{p} - {_lag(f'z{p}', 3)}"
        up, down = f"{before} < 0.7 AND z{p} >= 0.7", f"{before} > -0.7 AND z{p} <= -0.7"
        out[f"lr_atr_cross_up_{p}"] = f"CASE WHEN {up} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
        out[f"lr_atr_cross_down_{p}"] = f"CASE WHEN {down} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    return _features(ctes, "e2", out)


def _ft_trend() -> str:
    means, out = {"a20": _wilder("tr", 20)}, {}
    for s in (50, 80, 120):
        means[f"ema_{s}"] = _span(s)
        step = f"(ema_{s} - {_lag(f'ema_{s}', 1)})"
        out[f"trend_dir_{s}"] = f"CAST(sign({step}) AS DOUBLE)"
        out[f"trend_strength_{s}"] = f"{step} / (a20 + {E})"
    return _features(_ewm("e", "dm", means), "e", out)


def _ft_bands() -> str:
    out = {}
    for n, k in ((13, 1.2), (13, 1.8), (20, 2.0)):
        tag = f"bb_{n}_{str(k).replace('.', '_')}"
        mid, half = _roll("avg(c)", n), f"{k} * ({_roll('stddev_pop(c)', n)})"
        mid = f"({mid})"
        upper, lower = f"({mid} + {half})", f"({mid} - {half})"
        out[f"{tag}_width"] = f"({upper} - {lower}) / ({mid} + {E})"
        out[f"{tag}_pos"] = f"(c - {mid}) / ({upper} - {lower} + {E})"
        out[f"{tag}_break_up"] = f"CASE WHEN c > {upper} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
        out[f"{tag}_break_down"] = f"CASE WHEN c < {lower} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    return _simple(out)


def _ft_candle() -> str:
    return _simple(
        {
            "body_pct": f"abs(c - o) / (c + {E})",
            "upper_wick_pct": f"(h - greatest(o, c)) / (c + {E})",
            "lower_wick_pct": f"(least(o, c) - l) / (c + {E})",
            "close_to_high": f"(h - c) / (c + {E})",
            "close_to_low": f"(c - l) / (c + {E})",
            "intrabar_return": f"(c - o) / (o + {E})",
        }
    )


def _ft_volume() -> str:
    out = {}
    for n in (10, 20, 50, 100):
        mean = f"({_roll('avg(v)', n)})"
        out[f"volume_z_{n}"] = f"(v - {mean}) / ({_roll('stddev_pop(v)', n)} + {E})"
        out[f"relative_volume_{n}"] = f"v / ({mean} + {E})"
    return _simple(out)


def _ft_session() -> str:
    hour = "hour(event_time + INTERVAL 7 HOUR)"
    minute = "minute(event_time)"
    return _simple(
        {
            "hour": f"CAST({hour} AS DOUBLE)",
            "minute": f"CAST({minute} AS DOUBLE)",
            "bar_of_day": f"CAST({hour} * 60 + {minute} AS DOUBLE)",
            "morning_session": f"CAST({hour} < 12 AS DOUBLE)",
            "afternoon_session": f"CAST({hour} >= 12 AS DOUBLE)",
        }
    )


# A row is ready once its longest look-back is full: 121 bars for the slowest trend.
_STATUS = "CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY event_time) > 121 THEN 'ready' ELSE 'warmup' END"


#: Contract columns that plain windows give; the others are exponential means.
CONTRACT_WINDOW_COLUMNS = (
    "bb_upper", "bb_middle", "bb_lower", "bb_width", "z_score", "lr_midline_14",
    *(f"close_lag_{k}" for k in range(1, 6)), *(f"return_{k}" for k in range(1, 4)), "volume_change",
)


def _contract_columns(coarse: str) -> str:
    by = "PARTITION BY symbol ORDER BY event_time"
    made = {
        "bb_upper": "m + 2 * sd", "bb_middle": "m", "bb_lower": "m - 2 * sd", "bb_width": "4 * sd / nullif(m, 0)",
        "z_score": "(close - m) / nullif(sd, 0)", "lr_midline_14": "m14 + 6.5 * slope",
    }
    made |= {f"close_lag_{k}": f"c{k}" for k in range(1, 6)}
    made |= {f"return_{k}": f"close / nullif(c{k}, 0) - 1" for k in range(1, 4)}
    made["volume_change"] = "volume / nullif(v1, 0) - 1"
    rounded = ", ".join(f"round({made[c]}, 5) AS {c}" for c in CONTRACT_WINDOW_COLUMNS)
    lags = ", ".join(f"lag(close, {k}) OVER ({by}) AS c{k}" for k in range(1, 6))
    return f"""{coarse}, p AS (SELECT *, row_number() OVER ({by}) AS n FROM coarse), w AS (
  SELECT *, {lags}, lag(volume) OVER ({by}) AS v1, lead(trading_date) OVER ({by}) AS next_day,
         CASE WHEN n >= 20 THEN avg(close) OVER w20 END AS m, CASE WHEN n >= 20 THEN stddev_pop(close) OVER w20 END AS sd,
         CASE WHEN n >= 14 THEN avg(close) OVER w14 END AS m14, regr_slope(close, n) OVER w14 AS slope
  FROM p WINDOW w20 AS ({by} ROWS 19 PRECEDING), w14 AS ({by} ROWS 13 PRECEDING))
SELECT symbol, event_time, {rounded}, hour(event_time + INTERVAL 7 HOUR) AS hour,
       dayofweek(event_time + INTERVAL 7 HOUR) + 1 AS day_of_week, next_day <> trading_date AS is_session_end
FROM w"""


def all_queries() -> dict[str, str]:
    coarse15 = f"WITH {_BARS}, {_resampled(15)}"
    learned = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", m AS median, (SELECT avg(coalesce({c}, m)) FROM prep WHERE split = 'train') AS mean,
  (SELECT stddev_samp(coalesce({c}, m)) FROM prep WHERE split = 'train') AS scale
FROM (SELECT quantile_disc({c}, 0.5) AS m FROM prep WHERE split = 'train')"""
        for c in ("close", "high", "volume")
    )
    training = f"""{coarse15}, o AS (
  SELECT *, count(*) OVER (ORDER BY event_time) AS through, count(*) OVER () AS total FROM coarse
), b AS (SELECT min(event_time) FILTER (through >= total * 0.6) AS t1, min(event_time) FILTER (through >= total * 0.8) AS t2 FROM o
), prep AS (
  SELECT symbol, event_time, high, low, close, CASE WHEN minute(event_time) <> 0 THEN volume END AS volume,
    CASE WHEN event_time <= t1 THEN 'train' WHEN event_time <= t2 THEN 'validation' ELSE 'test' END AS split
  FROM o, b
), par AS ({learned})"""
    out = {f"resample_{m}m": _resample_query(m) for m in (5, 15, 30)}
    out |= {
        "landing_contract": f"""WITH {_BARS}, k AS (
  SELECT symbol, event_time, timeframe, count(*) AS n,
         min(CASE WHEN open <= 0 THEN 5 WHEN volume < 0 THEN 6 END) AS bad FROM bars GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) FILTER (n > 1) AS duplicate_keys,
       CAST(min(least(bad, CASE WHEN n > 1 THEN 0 END)) AS INTEGER) AS first_broken_rule FROM k""",
        "silver_contract": f"""WITH {_RAW}, k AS (
  SELECT symbol, event_time, timeframe, count(*) AS n,
         min(CASE WHEN not_positive THEN 4 WHEN negative THEN 5
                  WHEN high < greatest(open, close, low) THEN 6
                  WHEN low > least(open, close, high) THEN 7 END) AS bad
  FROM checked GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) FILTER (n > 1) AS duplicate_keys,
       CAST(min(least(bad, CASE WHEN n > 1 THEN 3 END)) AS INTEGER) AS first_broken_rule FROM k""",
        "duplicate_keys": f"""WITH {_RAW}
SELECT symbol, event_time, timeframe, count(*) AS duplicate_count
FROM raw GROUP BY ALL HAVING count(*) > 1""",
        "quality_flags": f"""WITH {_RAW}
SELECT kafka_offset, kafka_partition, symbol, event_time, timeframe, trading_date,
       quality_status, open, high, low, close, volume FROM flagged""",
        "quality_metrics": _METRICS.format(_RAW),
        "bronze_rows": f"WITH {_RAW} SELECT {_LAYER} FROM counted",
        "dedupe_silver": _newest("all"),
        "dedupe_silver_valid_scope": _newest("valid"),
        "batch_silver": _newest(
            "all",
            "symbol, event_time, trading_date, timeframe, open, high, low, close, volume",
            _MINUTES,
        ),
        "batch_report": _METRICS.format(_MINUTES),
        "history_csv_bars": f"""WITH {_BARS}
SELECT 'ALL' AS symbol, event_time, trading_date, timeframe, open, high, low, close, volume,
       'historical_csv' AS source, 'valid' AS quality_status FROM bars""",
        "history_runs": """WITH placed AS (
  SELECT event_type, ts, value, row_number() OVER (PARTITION BY event_type ORDER BY ts) - 1 AS i FROM events)
SELECT count(*) AS bars, min(ts) AS first_time, max(ts) AS last_time, max(i) AS last_row,
       round(sum(i * (value + 1)), 2) AS placed
FROM placed GROUP BY event_type""",
        "landing_layer": f"""{coarse15}, both_frames AS (
  SELECT symbol, timeframe, trading_date, volume FROM bars
  UNION ALL SELECT symbol, timeframe, trading_date, volume FROM coarse)
SELECT symbol, timeframe, trading_date, 'run:1' AS ingest_run_id, count(*) AS bars,
       sum(volume) AS volume FROM both_frames GROUP BY ALL""",
        "landing_summary": f"""WITH {_BARS}, {_resampled(30)}
SELECT 'events' AS input_path, (SELECT count(*) FROM bars) AS source_rows,
       count(*) AS output_rows, '1m' AS source_timeframe, '30m' AS output_timeframe,
       strftime(min(event_time), '%Y-%m-%dT%H:%M:%SZ') AS min_event_time,
       strftime(max(event_time), '%Y-%m-%dT%H:%M:%SZ') AS max_event_time,
       (SELECT min(ingest_run_id) FROM (
          SELECT ingest_run_id FROM bars UNION ALL SELECT ingest_run_id FROM origin))
         AS ingest_run_id
FROM coarse""",
        "payload_bars": """WITH two AS (
  SELECT upper(event_type) AS symbol, event_type = 'error' AS records,
         date_trunc('second', ts) AS event_time, value AS p FROM events
  UNION ALL
  SELECT upper(event_type), event_type = 'error',
         date_trunc('second', ts) + INTERVAL 60 SECOND, value * 2 FROM events)
SELECT symbol, event_time, CAST(event_time + INTERVAL 7 HOUR AS DATE) AS trading_date,
       '5m' AS timeframe, p + 1 AS open, p + 2 AS high, p AS low, p + 0.5 AS close,
       CASE WHEN records THEN 0.0 ELSE p END AS volume, 'market_api' AS source,
       'api:' || symbol || ':' || strftime(event_time, '%Y-%m-%dT%H:%M:%S+00:00')
         AS source_record_id
FROM two""",
        "payload_rejects": """SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN '5m' END AS timeframe,
  CASE WHEN event_id % 10 = 0 THEN 'unsupported resolution'
       WHEN event_type = 'error' THEN 'payload is not valid JSON'
       WHEN event_type = 'click' THEN 'arrays have inconsistent lengths'
       WHEN event_type = 'purchase' THEN 'negative volume'
       WHEN event_type = 'signup' THEN 'duplicate timestamps' END AS error
FROM events WHERE event_id % 10 = 0 OR event_type IN ('error', 'click', 'purchase', 'signup')""",
        "event_json_key": f"""WITH {_BARS}, built AS (
  SELECT upper(symbol) AS symbol, timeframe,
         CASE WHEN date_trunc('second', event_time) = event_time
              THEN strftime(event_time, '%Y-%m-%dT%H:%M:%SZ')
              ELSE {_ISO.format('event_time')} END AS event_time,
         strftime(trading_date, '%Y-%m-%d') AS trading_date, open, high, low, close, volume,
         source, source_record_id, ingest_run_id FROM bars)
SELECT symbol || '|' || event_time || '|' || timeframe AS key,
       'ohlcv_raw_v1' AS schema_version, *, CAST(NULL AS VARCHAR) AS error FROM built""",
        "event_errors": f"""WITH {_MESSAGES}
SELECT key, CASE WHEN error IS NOT NULL THEN 'ContractViolation' END AS error_type, error,
       count(*) AS rows FROM messages GROUP BY ALL""",
        "dead_letters": f"""WITH {_MESSAGES}
SELECT 'ohlcv_raw_dlq_v1' AS schema_version, key AS original_key,
       'ContractViolation' AS error_type, error, symbol, source_record_id, low, volume
FROM messages WHERE error IS NOT NULL""",
        "foreign_keys": f"""WITH {_MESSAGES}, sent AS (
  SELECT CAST(source_record_id AS BIGINT) AS part,
         CASE WHEN error IS NOT NULL THEN error WHEN part % 7 = 0 OR part % 5 = 0
              THEN 'Kafka message key does not match the event business key' END AS error
  FROM messages)
SELECT CASE WHEN error IS NOT NULL THEN 'ContractViolation' END AS error_type, error, part % 35 AS part,
       count(*) AS rows FROM sent GROUP BY ALL""",
        "ingest_outcomes": _OUTCOMES,
        "stream_bronze": f"""WITH {_FIRST_MESSAGES}
SELECT 'ohlcv_raw_v1' AS schema_version, symbol, event_time, trading_date, timeframe, open, high,
       low, close, volume, 'events' AS source, CAST(NULL AS VARCHAR) AS source_record_id,
       'r1' AS ingest_run_id, event_time AS published_at, key AS kafka_key,
       0 AS kafka_partition, kafka_offset
FROM firsts""",
        "stream_outcomes": f"""WITH {_FIRST_MESSAGES}, totals AS (
  SELECT (SELECT count(*) FROM firsts) AS accepted, count(*) FILTER (error IS NULL) AS valid,
         count(*) FILTER (error IS NOT NULL) AS dead FROM messages)
SELECT 'accepted' AS outcome, accepted AS rows FROM totals
UNION ALL SELECT 'duplicate', valid - accepted FROM totals
UNION ALL SELECT 'dead_lettered', dead FROM totals""",
        "stream_silver": f"""WITH {_FIRST_MESSAGES}
SELECT symbol, CAST(strptime(event_time, '%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP) AS event_time,
       CAST(trading_date AS DATE) AS trading_date, timeframe, open, high, low, close, volume
FROM firsts""",
        "stream_dead_letters": f"""WITH {_MINUTE_MESSAGES}
SELECT error, symbol, trading_date, count(*) AS rows, round(sum(close), 4) AS closes
FROM messages WHERE error IS NOT NULL GROUP BY ALL""",
        "publish_first": f"""WITH {_BARS}, top AS (
  SELECT * FROM bars ORDER BY symbol, event_time LIMIT 1000)
SELECT upper(symbol) || '|' || CASE WHEN date_trunc('second', event_time) = event_time
         THEN strftime(event_time, '%Y-%m-%dT%H:%M:%SZ')
         ELSE {_ISO.format('event_time')} END || '|' || timeframe AS key FROM top""",
        "ft_returns": _ft_returns(),
        "ft_price_windows": _ft_price_windows(),
        "ft_ema": _ft_ema(),
        "ft_rsi": _ft_rsi(),
        "ft_atr": _ft_atr(),
        "ft_adx": _ft_adx(),
        "ft_regime": _ft_regime(),
        "ft_midline": _ft_midline(),
        "ft_trend": _ft_trend(),
        "ft_bands": _ft_bands(),
        "ft_candle": _ft_candle(),
        "ft_volume": _ft_volume(),
        "ft_session": _ft_session(),
        "ft_long_series": _ft_long_series(),
        "ft_status": f"""{coarse15}
SELECT symbol, event_time, event_time AS available_at, 'features_v1' AS feature_set_version,
       {_STATUS} AS feature_status FROM coarse""",
        "ft_counts": f"""WITH {_BARS}, s AS (SELECT {_STATUS} AS st FROM bars)
SELECT count(*) AS rows, CAST(116 AS BIGINT) AS feature_count,
       count(*) FILTER (st = 'ready') AS ready_rows,
       count(*) FILTER (st <> 'ready') AS warmup_rows FROM s""",
        "gold_layer": f"""{coarse15}, s AS (
  SELECT *, {_STATUS} AS feature_status,
         lag(close, 1) OVER w - lag(close, 2) OVER w AS move,
         lag(close, 1) OVER w - lag(close, 6) OVER w AS move_5,
         lag((close - low) / (close + {E}), 1) OVER w AS above_low,
         lag(minute(event_time), 1) OVER w AS minute_before
  FROM coarse WINDOW w AS (PARTITION BY symbol ORDER BY event_time))
SELECT 'features_v1' AS feature_set_version, symbol, timeframe, trading_date, feature_status,
       count(*) AS bars, round(sum(move), 4) + 0.0 AS moves, round(sum(close), 3) AS close,
       round(sum(volume), 3) AS volume, round(sum(CAST(minute_before AS DOUBLE)), 3) AS minute,
       round(sum(above_low), 3) AS close_to_low, round(sum(move_5), 3) + 0.0 AS mom_points_5
FROM s GROUP BY ALL""",
        "contract_columns": _contract_columns(coarse15),
        "forward_labels": f"""{coarse15}, l AS (
  SELECT *, lead(close, 4) OVER (PARTITION BY symbol ORDER BY event_time) / close - 1 AS r FROM coarse)
SELECT symbol, event_time, timeframe, trading_date, CAST(4 AS BIGINT) AS horizon_bars,
       CAST(0.05 AS DOUBLE) AS threshold, round(r, 9) AS future_return,
       CASE WHEN r > 0.05 THEN 'LONG' WHEN r < -0.05 THEN 'SHORT' WHEN r IS NOT NULL THEN 'HOLD' END
         AS label, 'labels_v1' AS label_version,
       CASE WHEN event_time < TIMESTAMP '2024-01-10' THEN 'train'
            WHEN event_time < TIMESTAMP '2024-01-20' THEN 'validation' ELSE 'test' END AS split
FROM l""",
        "binary_labels": f"""{coarse15}, l AS (
  SELECT *, lead(close, 4) OVER (PARTITION BY symbol ORDER BY event_time) / close - 1 AS r FROM coarse)
SELECT symbol, event_time, CAST(r > 0.05 AS INTEGER) AS target, round(r, 9) AS future_return FROM l WHERE abs(r) > 0.05""",
        "preparation_parameters": f"""{training}
SELECT "column", round(median, 6) AS median, round(mean, 6) AS mean, round(scale, 6) AS scale FROM par""",
        "prepared_rows": f"""{training}
SELECT symbol, event_time, {", ".join(
    f"round((coalesce({c}, (SELECT median FROM par WHERE \"column\" = '{c}')) - (SELECT mean FROM par WHERE \"column\" = '{c}'))"
    f" / (SELECT scale FROM par WHERE \"column\" = '{c}'), 6) AS {c}" for c in ("close", "high", "volume"))}
FROM prep""",
        "feature_ranking": f"""{training}, v AS (
  UNPIVOT (SELECT symbol, close, high, low, volume FROM prep WHERE split = 'train') ON close, high, low, volume
  INTO NAME "column" VALUE x
), g AS (SELECT "column", symbol, count(x) AS n, avg(x) AS m, var_pop(x) * count(x) AS w FROM v GROUP BY ALL),
t AS (SELECT "column", avg(x) AS grand FROM v GROUP BY ALL),
f AS (SELECT "column", (sum(n * (m - grand) ** 2) / (count(*) - 1)) / (sum(w) / (sum(n) - count(*))) AS f FROM g JOIN t USING ("column") GROUP BY "column")
SELECT "column", round(f, 6) AS f_value, CAST(row_number() OVER (ORDER BY f DESC, "column") AS INTEGER) AS rank FROM f""",
        "time_quantile_split": f"""{coarse15}, o AS (
  SELECT symbol, event_time, count(*) OVER (ORDER BY event_time) AS through, count(*) OVER () AS n FROM coarse
), b AS (SELECT min(event_time) FILTER (through >= n * 0.6) AS t1, min(event_time) FILTER (through >= n * 0.8) AS t2 FROM o)
SELECT symbol, event_time,
  CASE WHEN event_time <= t1 THEN 'train' WHEN event_time <= t2 THEN 'validation' ELSE 'test' END AS split
FROM o, b""",
        "gap_report": f"""{coarse15}, g AS (
  SELECT symbol, timeframe, trading_date, count(*) AS present,
         CAST((epoch(max(event_time)) - epoch(min(event_time))) / 900 + 1 AS BIGINT) AS expected
  FROM coarse GROUP BY ALL)
SELECT *, expected - present AS missing FROM g""",
        "missing_bars": f"""{coarse15}, g AS (
  SELECT symbol, timeframe, trading_date,
         unnest(generate_series(low, high, INTERVAL 15 MINUTE)) AS event_time
  FROM (SELECT symbol, timeframe, trading_date, min(event_time) AS low, max(event_time) AS high
        FROM coarse GROUP BY ALL))
SELECT * FROM g ANTI JOIN coarse USING (symbol, timeframe, trading_date, event_time)""",
        "missing_in_sessions": f"""{coarse15}, k AS (
  SELECT symbol, timeframe, trading_date, event_time,
         CAST(epoch(event_time + INTERVAL 7 HOUR) AS BIGINT) % 86400 AS second FROM coarse
), d AS (SELECT DISTINCT symbol, timeframe, trading_date FROM k
), n AS (SELECT symbol, timeframe, count(*) AS days FROM d GROUP BY ALL
), c AS (SELECT symbol, timeframe, second FROM k JOIN n USING (symbol, timeframe) GROUP BY symbol, timeframe, second, days
  HAVING count(*) >= 0.5 * days)
SELECT symbol, timeframe, trading_date, CAST(trading_date AS TIMESTAMP) + to_seconds(second) - INTERVAL 7 HOUR AS event_time
FROM d JOIN c USING (symbol, timeframe)
WHERE (symbol, timeframe, trading_date, second) NOT IN (SELECT symbol, timeframe, trading_date, second FROM k)""",
        "signal_contract": f"""{coarse15}, l AS (
  SELECT lead(close) OVER (PARTITION BY symbol ORDER BY event_time) / close - 1 AS r FROM coarse)
SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS duplicate_keys,
       CASE WHEN max(abs(r)) > 1 THEN 4 END AS first_broken_rule FROM l""",
    }
    return out
