"""The feature columns that only the table contract names, computed up to the bar's own close.

Unlike the 116 lagged features these see the bar they are attached to, so ``available_at`` is
the close of the bar. ``is_session_end`` alone looks at the next bar's trading date (a fact of
the calendar, no price), for which each block also gets the first rows of the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.operators import quality
from barlake.operators.features import CORE_ROWS
from barlake.operators.recurrence import (
    BlockLayout,
    ExpMean,
    add_columns,
    memory_rows,
    span_alpha,
    wilder_alpha,
    with_exp_means,
)
from barlake.operators.series import SERIES, in_blocks
from barlake.schema import FEATURE_INPUTS, MARKET_ZONE, TIMEFRAME_MINUTES

# --- Fixed values: columns of the feature contract and the periods they name. ---
CONTRACT_COLUMNS = (
    "atr_14", "rsi_14", "bb_upper", "bb_middle", "bb_lower", "bb_width", "lr_midline_14", "z_score",
    "ema_20", "ema_slope", "adx_14", "close_lag_1", "close_lag_2", "close_lag_3", "close_lag_4", "close_lag_5",
    "return_1", "return_2", "return_3", "volume_change", "hour", "day_of_week", "is_session_end",
)
PERIOD, BAND_ROWS, BAND_WIDTH, EMA_SPAN = 14, 20, 2.0, 20
# --- end of fixed values ---

#: A mean of means forgets after twice the rows of one.
HALO_ROWS = 2 * memory_rows(wilder_alpha(PERIOD)) + 64


def _line_end(n: int) -> str:
    """End of the least-squares line through the last ``n`` closes, as a weighted sum of them."""
    middle, spread = (n - 1) / 2, n * (n * n - 1) / 12
    return " + ".join(f"{1 / n + (middle - k) * middle / spread!r}D * {f'x_c{k}' if k else 'close'}" for k in range(n))


def _safe(value: str, base: str) -> str:
    return f"CASE WHEN {base} != 0 THEN {value} / {base} END"


def contract_features(
    bars: DataFrame, version: str = "contract_v1", zone: str = MARKET_ZONE, core_rows: int = CORE_ROWS
) -> DataFrame:
    """Bars with ``CONTRACT_COLUMNS``, ``feature_set_version`` and ``available_at``; one wide shuffle.

    ``atr``, ``rsi`` and ``adx`` are Wilder means, ``ema_20`` an exponential mean of span 20 and
    ``ema_slope`` its change. Bands are two population deviations around the mean of 20 closes,
    ``bb_width`` their distance over that mean, ``z_score`` the close in deviations. Rows whose
    window is not full, and ratios to zero, are null; so is ``is_session_end`` on a series' last bar.
    ``day_of_week`` counts from 1, Sunday, in ``zone``. Null symbols are a series of their own.
    """
    silver = quality.as_feature_input(bars)
    largest = max(1, core_rows // 8)
    df = in_blocks(silver, max(core_rows, HALO_ROWS + largest), HALO_ROWS, largest, ahead=True)
    layout = BlockLayout((*SERIES, "block"), "pos")
    df = layout.add_segment(df)
    back = {f"x_c{k}": layout.back("close", k) for k in range(1, PERIOD)}
    back |= {"x_h1": layout.back("high", 1), "x_l1": layout.back("low", 1), "x_v1": layout.back("volume", 1)}
    frame = f"OVER ({layout.block} ROWS BETWEEN {BAND_ROWS - 1} PRECEDING AND CURRENT ROW)"
    back |= {"x_mean": f"avg(close) {frame}", "x_std": f"stddev_pop(close) {frame}"}
    back |= {"x_next": f"lead(trading_date, 1) OVER ({layout.block})"}
    up, down = "(high - x_h1)", "(x_l1 - low)"
    moves = {
        "x_tr": "greatest(high - low, abs(high - x_c1), abs(low - x_c1))",
        "x_gain": "CASE WHEN close > x_c1 THEN close - x_c1 ELSE 0D END",
        "x_loss": "CASE WHEN close < x_c1 THEN x_c1 - close ELSE 0D END",
        "x_up": f"CASE WHEN {up} > {down} AND {up} > 0D THEN {up} ELSE 0D END",
        "x_down": f"CASE WHEN {down} > {up} AND {down} > 0D THEN {down} ELSE 0D END",
    }
    df = add_columns(add_columns(df, back), moves)
    alpha = wilder_alpha(PERIOD)
    means = [ExpMean("ema_20", "close", span_alpha(EMA_SPAN), 0, EMA_SPAN)]
    means += [ExpMean(f"x_mean_{s}", f"x_{s}", alpha, 1, PERIOD) for s in ("gain", "loss")]
    means += [ExpMean("atr_14", "x_tr", alpha, 0, PERIOD)]
    means += [ExpMean(f"x_mean_{s}", f"x_{s}", alpha, 0, PERIOD) for s in ("up", "down")]
    df = with_exp_means(df, layout, means)
    turn = "abs(x_mean_up - x_mean_down) / (x_mean_up + x_mean_down)"
    df = add_columns(df, {"x_dx": f"CASE WHEN x_mean_up + x_mean_down > 0 THEN 100D * {turn} ELSE 0D END"})
    df = with_exp_means(df, layout, [ExpMean("adx_14", "x_dx", alpha, PERIOD - 1, PERIOD)])
    df = add_columns(df, {"x_ema1": layout.back("ema_20", 1)}).where("is_core")
    minutes = " ".join(f"WHEN '{name}' THEN {n}" for name, n in TIMEFRAME_MINUTES.items())
    local = f"from_utc_timestamp(event_time, '{zone}')"
    full = f"pos >= {BAND_ROWS - 1}"
    gains = "(x_mean_gain + x_mean_loss)"
    made = {
        "feature_set_version": f"'{version}'",
        "available_at": f"event_time + make_dt_interval(0, 0, CASE timeframe {minutes} END, 0)",
        "atr_14": "atr_14",
        "rsi_14": f"CASE WHEN {gains} > 0 THEN 100D * x_mean_gain / {gains} END",
        "bb_upper": f"CASE WHEN {full} THEN x_mean + {BAND_WIDTH!r}D * x_std END",
        "bb_middle": f"CASE WHEN {full} THEN x_mean END",
        "bb_lower": f"CASE WHEN {full} THEN x_mean - {BAND_WIDTH!r}D * x_std END",
        "bb_width": f"CASE WHEN {full} THEN {_safe(f'{2 * BAND_WIDTH!r}D * x_std', 'x_mean')} END",
        "lr_midline_14": f"CASE WHEN pos >= {PERIOD - 1} THEN {_line_end(PERIOD)} END",
        "z_score": f"CASE WHEN {full} THEN {_safe('(close - x_mean)', 'x_std')} END",
        "ema_20": "ema_20",
        "ema_slope": "ema_20 - x_ema1",
        "adx_14": "adx_14",
    }
    made |= {f"close_lag_{k}": f"x_c{k}" for k in range(1, 6)}
    made |= {f"return_{k}": f"{_safe('close', f'x_c{k}')} - 1D" for k in range(1, 4)}
    made |= {
        "volume_change": f"{_safe('volume', 'x_v1')} - 1D",
        "hour": f"CAST(hour({local}) AS bigint)",
        "day_of_week": f"CAST(dayofweek({local}) AS bigint)",
        "is_session_end": "x_next != trading_date",
    }
    return df.select(*FEATURE_INPUTS, *[F.expr(sql).alias(name) for name, sql in made.items()])
