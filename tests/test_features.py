"""Features against plain-Python brute force, and the leakage and isolation rules."""

import math
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from barlake.operators import labels, training
from barlake.operators.contract_features import CONTRACT_COLUMNS, contract_features
from barlake.operators.features import (
    FEATURE_COLUMNS,
    FeatureConfig,
    add_features,
    build_features,
    feature_families,
)
from barlake.operators.series import in_blocks, with_position
from barlake.schema import ContractError

START = datetime(2024, 1, 1, 2, tzinfo=timezone.utc)
COLUMNS = "symbol string, event_time timestamp, trading_date date, timeframe string, " + (
    "open double, high double, low double, close double, volume double"
)


def wave(rows, symbol="AAA", scale=1.0, flat_from=None):
    out = []
    for k in range(rows):
        n = k if flat_from is None or k < flat_from else flat_from
        close = (1200 + 0.7 * (n % 977) + 3 * math.sin(n / 4)) * scale
        at = START + timedelta(minutes=15 * k)
        day = (at + timedelta(hours=7)).date()
        flat = n != k
        high, low = (close, close) if flat else (close + 1.2, close - 1.1)
        start = close if flat else close - 0.4
        out.append((symbol, at, day, "15m", start, high, low, close, 1000.0 + 2 * (n % 53)))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def ewm(xs, alpha, periods):
    out, y, seen = [], None, 0
    for x in xs:
        if x is not None:
            y = x if y is None else (1 - alpha) * y + alpha * x
            seen += 1
        out.append(y if seen >= periods else None)
    return out


def window(xs, n, i):
    part = xs[max(0, i - n + 1) : i + 1]
    return part if len(part) == n and None not in part else None


def moments(part, ddof=0):
    if part is None:
        return None, None
    mean = math.fsum(part) / len(part)
    return mean, math.sqrt(math.fsum((x - mean) ** 2 for x in part) / (len(part) - ddof))


def brute(rows):
    """A sample of every family, unshifted, one dict per bar."""
    o, h, l, c, v = ([r[k] for r in rows] for k in (4, 5, 6, 7, 8))
    n, eps = len(rows), 1e-12
    prev = [None, *c[:-1]]
    diff = [None if p is None else x - p for x, p in zip(c, prev)]
    gain = [None if d is None else max(d, 0.0) for d in diff]
    loss = [None if d is None else max(-d, 0.0) for d in diff]
    tr = [
        h[i] - l[i] if i == 0 else max(h[i] - l[i], abs(h[i] - c[i - 1]), abs(l[i] - c[i - 1]))
        for i in range(n)
    ]
    ret = [None if p is None else x / p - 1 for x, p in zip(c, prev)]
    up, down = [0.0], [0.0]
    for i in range(1, n):
        a, b = h[i] - h[i - 1], l[i - 1] - l[i]
        up.append(a if a > b and a > 0 else 0.0)
        down.append(b if b > a and b > 0 else 0.0)
    atr = {p: ewm(tr, 1 / p, p) for p in (8, 14, 20, 60)}
    ema = {s: ewm(c, 2 / (s + 1), s) for s in (8, 55, 120)}
    g, lo = ewm(gain, 1 / 28, 28), ewm(loss, 1 / 28, 28)
    u8, d8 = ewm(up, 1 / 8, 8), ewm(down, 1 / 8, 8)
    dx = []
    for a, b, t in zip(u8, d8, atr[8]):
        if a is None:
            dx.append(None)
            continue
        p, m = 100 * a / (t + eps), 100 * b / (t + eps)
        dx.append(100 * abs(p - m) / (p + m + eps))
    adx = ewm(dx, 1 / 8, 8)
    out = []
    for i in range(n):
        f = {}
        f["ret_55"] = None if i < 55 else c[i] / c[i - 55] - 1
        for w in (5, 13, 40, 80):
            mean, std = moments(window(c, w, i))
            if w != 13:
                f[f"zclose_{w}"] = None if mean is None else (c[i] - mean) / (std + eps)
            elif mean is not None:
                f["bb_13_1_2_width"] = 2.4 * std / (mean + eps)
        f["volatility_80"] = moments(window(ret, 80, i))[1]
        mean, _ = moments(window([(a - b) / x for a, b, x in zip(h, l, c)], 80, i))
        f["range_mean_80"] = mean
        for w in (50, 100):
            mean, std = moments(window(v, w, i))
            f[f"volume_z_{w}"] = None if mean is None else (v[i] - mean) / (std + eps)
        for s in (8, 55):
            e = ema[s][i]
            f[f"ema_dist_{s}"] = None if e is None else (c[i] - e) / (e + eps)
        f["rsi_28"] = None if g[i] is None else 100 - 100 / (1 + g[i] / (lo[i] + eps))
        f["atr_14"], f["adx_8"] = atr[14][i], adx[i]
        mean, std = moments(window(atr[14], 80, i), 1)
        f["atr_z_80"] = None if mean is None else (atr[14][i] - mean) / (std + eps)
        f["atr_fast_slow_ratio"] = None if atr[60][i] is None else atr[20][i] / (atr[60][i] + eps)
        if i and ema[120][i - 1] is not None:
            f["trend_strength_120"] = (ema[120][i] - ema[120][i - 1]) / (atr[20][i] + eps)
        for p in (14, 30, 40):
            part = window(c, p, i)
            if part is not None and atr[20][i] is not None:
                mid, xm = math.fsum(part) / p, (p - 1) / 2
                slope = math.fsum((k - xm) * (y - mid) for k, y in enumerate(part))
                slope /= math.fsum((k - xm) ** 2 for k in range(p))
                z = (c[i] - (mid + slope * xm)) / (1.1 * atr[20][i] + eps)
                f[f"lr_atr_z_{p}"] = z
        f["close_to_high"] = (h[i] - c[i]) / (c[i] + eps)
        f["bar_of_day"] = float((2 * 60 + 7 * 60 + 15 * i) % 1440)
        out.append(f)
    return out


def compare(got, rows, shift):
    want = brute(rows)
    for i, row in enumerate(got):
        expected = want[i - shift] if i >= shift else {}
        for name in want[-1]:
            a, b = row[name], expected.get(name)
            if a is None or b is None:
                assert a is None and b is None, (i, name, a, b)
            else:
                assert a == pytest.approx(b, rel=1e-7, abs=1e-7), (i, name)


def features_of(spark, rows, config=FeatureConfig(), symbol="AAA"):
    built = add_features(with_position(frame(spark, rows), max_bucket_rows=50), config)
    return built.filter(F.col("symbol") == symbol).orderBy("event_time").collect()


def test_feature_list():
    assert len(FEATURE_COLUMNS) == len(set(FEATURE_COLUMNS)) == 116
    assert sum(len(v) for v in feature_families().values()) == 116


@pytest.mark.parametrize("shift", [1, 3])
def test_one_block_matches_brute_force(spark, shift):
    rows = wave(300)
    compare(features_of(spark, rows, FeatureConfig(shift_bars=shift)), rows, shift)


def test_many_blocks_match_brute_force(spark):
    """10,000 bars in blocks of about 4,400: carries and halos cross every boundary."""
    rows = wave(10_000)
    config = FeatureConfig(core_rows=1)
    assert 10_000 > 2 * config.halo_rows
    compare(features_of(spark, rows, config), rows, 1)


def test_a_build_of_many_blocks_matches_brute_force(spark):
    """Blocks of whole buckets, of unequal size: ranks and features come from one wide shuffle."""
    rows = wave(10_000)
    built = build_features(frame(spark, rows).repartition(5), FeatureConfig(core_rows=400))
    compare(built.orderBy("event_time").collect(), rows, 1)


def test_blocks_of_buckets_hold_the_ranks_and_their_halo(spark):
    rows = [r for r in wave(3000) if r[1].day % 3 or r[1].hour < 9] + wave(700, "BBB")
    bars = frame(spark, rows).withColumn("symbol", F.when(F.col("symbol") == "AAA", "AAA")).repartition(4)
    made = in_blocks(bars, 400, 150, 96)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    found = {}
    for r in made.collect():
        found.setdefault((r["symbol"], r["block"]), []).append((r["pos"], r["event_time"], r["is_core"]))
    ranks = {(r["symbol"], r["event_time"]): r["pos"] for r in with_position(bars).collect()}
    seen = []
    for (symbol, block), held in found.items():
        held.sort()
        own = [p for p, _, core in held if core]
        assert all(ranks[symbol, at] == p for p, at, _ in held)
        assert [p for p, _, _ in held] == list(range(held[0][0], held[-1][0] + 1)) and len(own) <= 496
        if own and own[0]:
            assert own[0] - held[0][0] >= 150
        seen += [(symbol is None, p) for p in own]
    assert len(seen) == len(set(seen)) == len(rows)
    assert in_blocks(bars.limit(0), 400, 150).isEmpty()


def test_contract_columns_match_brute_force(spark):
    """6,000 bars over several blocks; a session ends where the next bar has another date."""
    rows = wave(6000)
    got = contract_features(frame(spark, rows).repartition(3), core_rows=400).orderBy("event_time").collect()
    assert len(got) == 6000 and got[0].asDict().keys() >= set(CONTRACT_COLUMNS)
    high, low, close, volume = ([r[k] for r in rows] for k in (5, 6, 7, 8))
    tr = [max(h - l, *([abs(h - p), abs(l - p)] if p else [0.0])) for h, l, p in zip(high, low, [None, *close])]
    moves = [(b - a) for a, b in zip(close, close[1:])]
    gain, loss = ([None, *[max(0.0, s * m) for m in moves]] for s in (1, -1))
    ups, downs = [0.0], [0.0]
    for i in range(1, 6000):
        up, down = high[i] - high[i - 1], low[i - 1] - low[i]
        ups.append(up if up > down and up > 0 else 0.0)
        downs.append(down if down > up and down > 0 else 0.0)
    atr, g, l, pu, pd = (ewm(x, 1 / 14, 14) for x in (tr, gain, loss, ups, downs))
    dx = [None if u is None else 100 * abs(u - d) / (u + d) if u + d > 0 else 0.0 for u, d in zip(pu, pd)]
    adx, ema = ewm(dx, 1 / 14, 14), ewm(close, 2 / 21, 20)
    for i, r in enumerate(got):
        part = window(close, 20, i)
        mean = sum(part) / 20 if part else None
        std = math.sqrt(sum((c - mean) ** 2 for c in part) / 20) if part else None
        line = window(close, 14, i)
        slope = sum((k - 6.5) * c for k, c in enumerate(line)) / 227.5 if line else None
        want = {
            "atr_14": atr[i], "adx_14": adx[i], "ema_20": ema[i],
            "rsi_14": None if g[i] is None else 100 * g[i] / (g[i] + l[i]),
            "ema_slope": None if i == 0 or ema[i - 1] is None else ema[i] - ema[i - 1],
            "bb_middle": mean, "bb_upper": mean and mean + 2 * std, "bb_lower": mean and mean - 2 * std,
            "bb_width": mean and 4 * std / mean, "z_score": mean and (close[i] - mean) / std,
            "lr_midline_14": line and sum(line) / 14 + 6.5 * slope,
            "close_lag_5": close[i - 5] if i >= 5 else None, "return_3": close[i] / close[i - 3] - 1 if i >= 3 else None,
            "volume_change": volume[i] / volume[i - 1] - 1 if i else None,
            "is_session_end": rows[i][2] != rows[i + 1][2] if i < 5999 else None,
        }
        for name, value in want.items():
            assert r[name] == (value if value is None else pytest.approx(value, rel=1e-7, abs=1e-7)), (i, name)
        assert (r["hour"], r["day_of_week"]) == ((rows[i][1].hour + 7) % 24, rows[i][2].isoweekday() % 7 + 1)
        assert r["available_at"] - r["event_time"] == timedelta(minutes=15)
    assert contract_features(frame(spark, rows).limit(0)).isEmpty()


def test_flat_prices_give_exact_zeros(spark):
    got = features_of(spark, wave(300, flat_from=100))
    assert got[250]["zclose_80"] == 0.0 and got[250]["volatility_80"] == 0.0
    assert got[250]["bb_20_2_0_pos"] == 0.0


def test_status_counts_and_finite_values(spark):
    built = build_features(frame(spark, wave(180)))
    counts = {r["feature_status"]: r["count"] for r in built.groupBy("feature_status").count().collect()}
    assert counts == {"warmup": 121, "ready": 59}
    first = built.orderBy("event_time").first()
    assert all(first[n] is None for n in FEATURE_COLUMNS)


def test_no_leakage(spark):
    rows = wave(180)
    changed = [list(r) for r in rows]
    changed[120][4:8] = [x * 1.5 for x in changed[120][4:8]]
    a, b = features_of(spark, rows), features_of(spark, [tuple(r) for r in changed])
    assert [a[120][n] for n in FEATURE_COLUMNS] == [b[120][n] for n in FEATURE_COLUMNS]
    assert [a[121][n] for n in FEATURE_COLUMNS] != [b[121][n] for n in FEATURE_COLUMNS]


def test_series_are_isolated(spark):
    one, two = wave(140), wave(140, "BBB", 2.0)
    together = features_of(spark, one + two)
    alone = features_of(spark, one)
    assert [tuple(r) for r in together] == [tuple(r) for r in alone]


def test_silver_contract_is_enforced(spark):
    rows = wave(5)
    with pytest.raises(ContractError, match="duplicate"):
        build_features(frame(spark, rows + rows[:1]))
    with pytest.raises(ContractError, match="empty"):
        build_features(frame(spark, []))
    bad = list(rows[0])
    bad[5] = 1.0
    with pytest.raises(ContractError, match="high"):
        build_features(frame(spark, [tuple(bad)]))


def test_split_by_time_shares_never_parts_a_time(spark):
    rows = [(n, f"2024-01-{1 + n // 40:02d} 00:{n % 40 // 2:02d}:00") for n in range(99)] + [(99, None)]
    table = spark.createDataFrame(rows, "n int, at string").selectExpr("n", "CAST(at AS timestamp) event_time")
    got = {r["n"]: r["split"] for r in labels.quantile_split(table).collect()}
    times = sorted(at for _, at in rows if at)
    first, second = times[math.ceil(0.6 * 99) - 1], times[math.ceil(0.8 * 99) - 1]
    for n, at in rows:
        assert got[n] == (None if at is None else "train" if at <= first else "validation" if at <= second else "test")
    assert labels.quantile_split(table.limit(0)).count() == 0
    one = labels.quantile_split(table.where("n = 5")).first()
    assert one["split"] == "train"


def training_rows(spark):
    rows = [(n, "train" if n < 60 else "test", "ab"[n % 2], float(n % 7) if n % 5 else None, float("nan") if n == 3 else n * (1.0 + n % 2), 4.0, None) for n in range(90)]
    schema = "n int, split string, label string, x double, y double, flat double, none double"
    return rows, spark.createDataFrame(rows, schema).repartition(3)


def test_preparation_learns_from_train_rows_only(spark):
    rows, table = training_rows(spark)
    names = ("x", "y", "flat", "none")
    got = {r["column"]: r for r in training.fit_preparation(table, names).collect()}
    changed = table.withColumn("x", F.when(F.col("split") == "train", F.col("x")).otherwise(1e9))
    assert training.fit_preparation(changed, names).collect() == list(got.values())
    for at, name in enumerate(names, 3):
        held = sorted(r[at] for r in rows if r[1] == "train" and r[at] is not None and r[at] == r[at])
        median = held[(len(held) - 1) // 2] if held else 0.0
        full = [median if r[at] is None or r[at] != r[at] else r[at] for r in rows if r[1] == "train"]
        mean = sum(full) / len(full)
        scale = math.sqrt(sum((v - mean) ** 2 for v in full) / (len(full) - 1)) or 1.0
        assert [got[name][c] for c in ("median", "mean", "scale")] == pytest.approx([median, mean, scale])
    done = training.apply_preparation(table, training.fit_preparation(table, names))
    sums = done.where("split = 'train'").agg(F.avg("x"), F.stddev_samp("y"), F.max("none")).first()
    assert list(sums) == pytest.approx([0, 1, 0], abs=1e-9) and done.where("x IS NULL OR isnan(y)").isEmpty()
    empty = training.fit_preparation(table.limit(0), names).collect()
    assert [(r["median"], r["mean"], r["scale"]) for r in empty] == [(0, 0, 1)] * 4


def test_ranking_equals_the_f_of_each_column(spark):
    rows, table = training_rows(spark)
    table = table.withColumn("told", F.when(F.col("label") == "a", 1.0).otherwise(2.0))
    got = {r["column"]: r for r in training.rank_features(table, ("x", "y", "flat", "none", "told"), "label").collect()}
    for name, at in (("x", 3), ("y", 4)):
        by = {k: [r[at] for r in rows if r[1] == "train" and r[2] == k and r[at] is not None and r[at] == r[at]] for k in "ab"}
        every = by["a"] + by["b"]
        grand, means = sum(every) / len(every), {k: sum(v) / len(v) for k, v in by.items()}
        across = sum(len(v) * (means[k] - grand) ** 2 for k, v in by.items())
        inside = sum((x - means[k]) ** 2 for k, v in by.items() for x in v) / (len(every) - 2)
        assert got[name]["f_value"] == pytest.approx(across / inside)
    assert got["told"]["rank"] == 1 and got["told"]["f_value"] == math.inf
    assert got["flat"]["f_value"] is None and got["none"]["f_value"] is None
    ranking = training.rank_features(table, ("x", "y", "flat"), "label")
    assert training.select_features(ranking, 2) == ["y", "x"]


def test_binary_labels_drop_noise(spark):
    made = spark.createDataFrame([("LONG", 1), ("HOLD", 2), ("SHORT", 3), (None, 4)], "label string, n int")
    assert sorted((r["n"], r["target"]) for r in training.binary_labels(made).collect()) == [(1, 1), (3, 0)]


def test_breaks_are_no_missing_bars(spark):
    """Two sessions with a break; one bar is lost inside, one at an end, one strays into the break."""
    minutes = [*range(9 * 60, 11 * 60, 30), *range(13 * 60, 15 * 60, 30)]
    rows = [(s, d, m) for s in ("a", None) for d in range(1, 6) for m in minutes]
    lost = {("a", 2, 9 * 60 + 30), ("a", 3, 9 * 60), (None, 4, 14 * 60 + 30)}
    rows = [r for r in rows if r not in lost] + [("a", 5, 12 * 60), ("a", 5, 12 * 60)]
    made = [(s, f"2024-01-{d:02d}", f"2024-01-{d:02d} {m // 60 - 7:02d}:{m % 60:02d}:00", "30m") for s, d, m in rows]
    bars = spark.createDataFrame(made, "symbol string, day string, at string, timeframe string").selectExpr(
        "symbol", "CAST(day AS date) trading_date", "CAST(at AS timestamp) event_time", "timeframe"
    )
    found = {(r["symbol"], r["trading_date"].day, str(r["at"])) for r in labels.missing_in_sessions(bars).withColumn("at", F.date_format("event_time", "HH:mm")).collect()}
    assert found == {(s, d, f"{m // 60 - 7:02d}:{m % 60:02d}") for s, d, m in lost}
    assert labels.missing_in_sessions(bars.limit(0)).isEmpty()
