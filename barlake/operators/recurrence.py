"""Exponential means ``y = (1-a) * y_prev + a * x`` as ordered window sums.

Written out, ``y_j = q^j * sum(w_i * q^-i)`` with ``q = 1-a``: a running sum. The
powers stay inside double range by restarting the sum every ``SEGMENT`` rows and
adding what the previous segments left behind, decayed. Both parts are running
frames over one sort order, so the cost per row does not depend on the span.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT = 2200
NEGLIGIBLE = 1e-30
_SMALLEST_POWER = 1e-270


def span_alpha(span: int) -> float:
    return 2.0 / (span + 1)


def wilder_alpha(period: int) -> float:
    return 1.0 / period


def memory_rows(alpha: float) -> int:
    """Rows after which an old value weighs less than ``NEGLIGIBLE``."""
    return math.ceil(math.log(NEGLIGIBLE) / math.log1p(-alpha))


def add_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``selectExpr`` of everything plus the named SQL expressions."""
    return df.selectExpr("*", *[f"{sql} AS {name}" for name, sql in columns.items()])


@dataclass(frozen=True)
class ExpMean:
    """``name`` = exponential mean of ``source``; first value at position ``seed``."""

    name: str
    source: str
    alpha: float
    seed: int
    min_periods: int


@dataclass(frozen=True)
class BlockLayout:
    """Window clauses over bounded blocks of a series.

    ``pos`` counts rows from the first value of the series and is negative before
    it. Every clause sorts by (keys, segment, pos), so windows share one sort.
    """

    keys: tuple[str, ...]
    pos: str
    segment_rows: int = SEGMENT

    def add_segment(self, df: DataFrame) -> DataFrame:
        in_segment = F.pmod(F.col(self.pos), F.lit(self.segment_rows))
        return df.withColumn("in_segment", in_segment.cast("int")).withColumn(
            "segment", F.expr(f"({self.pos} - in_segment) div {self.segment_rows}")
        )

    @property
    def block(self) -> str:
        return f"PARTITION BY {', '.join(self.keys)} ORDER BY segment, {self.pos}"

    @property
    def segment(self) -> str:
        return f"PARTITION BY {', '.join(self.keys)}, segment ORDER BY {self.pos}"

    def back(self, column: str, n: int) -> str:
        return f"lag({column}, {n}) OVER ({self.block})"

    def running(self, value: str) -> str:
        """Sum from the start of the segment to this row."""
        frame = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
        return f"sum({value}) OVER ({self.segment} {frame})"

    def previous_end(self, column: str) -> str:
        """Value of ``column`` on the last row of the segment before this one."""
        at_end = f"CASE WHEN in_segment = {self.segment_rows - 1} THEN {column} END"
        frame = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
        return f"last({at_end}) IGNORE NULLS OVER ({self.block} {frame})"


def _local_sum(layout: BlockLayout, m: ExpMean) -> str:
    """Exponential sum that starts at zero in every segment."""
    q = 1.0 - m.alpha
    if q**layout.segment_rows < _SMALLEST_POWER:
        raise ValueError(f"{m.name}: segment too long for alpha={m.alpha}")
    pos = layout.pos
    weighted = (
        f"CASE WHEN {pos} < {m.seed} THEN 0D WHEN {pos} = {m.seed} THEN {m.source}"
        f" ELSE {m.alpha!r}D * {m.source} END"
    )
    decayed = layout.running(f"({weighted}) * power({q!r}D, -in_segment)")
    return f"{decayed} * power({q!r}D, in_segment)"


@dataclass(frozen=True)
class Extra:
    """Further columns for one carry step: block windows, then plain expressions."""

    windows: Mapping[str, str]
    plain: Mapping[str, str]


def with_exp_means(
    df: DataFrame, layout: BlockLayout, means: list[ExpMean], extras: list[Extra] | None = None
) -> DataFrame:
    """Add the exponential means; null before ``min_periods`` values have been seen.

    One carry step reaches one segment back. Means whose memory is longer than a
    segment repeat the step until the weight left out is below ``NEGLIGIBLE``.
    ``extras[k]`` is evaluated together with carry step ``k + 1``, which saves a
    pass over the block; it may use ``sum{k}_<name>``, the unmasked means so far.
    """
    extras = extras or []
    df = add_columns(df, {f"sum0_{m.name}": _local_sum(layout, m) for m in means})
    steps = {m.name: -(-memory_rows(m.alpha) // layout.segment_rows) for m in means}
    for step in range(1, max(*steps.values(), len(extras)) + 1):
        extra = extras[step - 1] if step <= len(extras) else Extra({}, {})
        active = [m for m in means if steps[m.name] >= step]
        carries = {
            f"carry{step}_{m.name}": layout.previous_end(f"sum{step - 1}_{m.name}")
            for m in active
        }
        sums = {
            f"sum{step}_{m.name}": f"sum0_{m.name} + coalesce(carry{step}_{m.name}, 0D)"
            f" * power({1.0 - m.alpha!r}D, in_segment + 1)"
            for m in active
        }
        df = add_columns(df, carries | extra.windows)
        df = add_columns(df, sums | extra.plain)
    masked = {
        m.name: f"CASE WHEN {layout.pos} >= {m.seed + m.min_periods - 1}"
        f" THEN sum{steps[m.name]}_{m.name} END"
        for m in means
    }
    helpers = {f"{kind}{n}_{m.name}" for m in means for kind in ("sum", "carry") for n in range(9)}
    return add_columns(df, masked).drop(*[c for c in df.columns if c in helpers])
