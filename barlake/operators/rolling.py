"""Rolling moments by merging adjacent row ranges.

A sliding frame re-reads its whole window for every row. Here the first few rows
come from lags, and longer windows join two shorter ones that sit side by side:
``mean`` and ``m2`` (sum of squared deviations) of 20 rows from those of the last
10 rows and of the 10 rows before. Work per row grows with the logarithm of the
window, nothing is subtracted from running totals, and a flat window gives its
value and an ``m2`` of zero exactly.

All functions return SQL text. ``age`` is 0 for the newest row of a window.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Moments:
    """Column names of the moments of the last ``n`` rows."""

    name: str
    n: int

    @property
    def mean(self) -> str:
        return f"m_{self.name}_{self.n}"

    @property
    def m2(self) -> str:
        return f"q_{self.name}_{self.n}"

    @property
    def trend(self) -> str:
        """Sum of ``(age - middle age) * value``."""
        return f"k_{self.name}_{self.n}"

    def at(self, rows_back: int, column: str) -> str:
        return f"{column}_b{rows_back}"


def aged(name: str, n: int) -> list[str]:
    """Columns of the last ``n`` values, newest first: x, x1, x2, ..."""
    return [name if age == 0 else f"{name}{age}" for age in range(n)]


def _total(terms: list[str]) -> str:
    return "(" + " + ".join(terms) + ")"


def from_values(target: Moments, values: list[str], with_m2: bool = True) -> dict[str, str]:
    """Moments of a short window from its values, relative to the newest one."""
    gaps = [f"({v} - {values[0]})" for v in values[1:]]
    total = _total(gaps)
    out = {target.mean: f"{values[0]} + {total} / {target.n}D"}
    if with_m2:
        squares = _total([f"{g} * {g}" for g in gaps])
        out[target.m2] = f"greatest({squares} - {total} * {total} / {target.n}D, 0D)"
    return out


def trend_from_values(target: Moments, values: list[str]) -> dict[str, str]:
    middle = (target.n - 1) / 2
    terms = [f"{age - middle!r}D * ({v} - {values[0]})" for age, v in enumerate(values) if age]
    return {target.trend: _total(terms)}


def back_columns(layout, part: Moments, rows_back: int, *columns: str) -> dict[str, str]:
    """Moments of ``part`` as they stood ``rows_back`` rows ago."""
    return {part.at(rows_back, c): layout.back(c, rows_back) for c in columns}


def merged_mean(means: list[str]) -> str:
    """Mean of equally long neighbouring ranges."""
    gaps = _total([f"({m} - {means[0]})" for m in means[1:]])
    return f"{means[0]} + {gaps} / {len(means)}D"


def merge(new: tuple[str, str, int], old: tuple[str, str, int]) -> tuple[str, str, int]:
    """(mean, m2, rows) of two neighbouring ranges joined."""
    (mean_a, m2_a, a), (mean_b, m2_b, b) = new, old
    gap = f"({mean_b} - {mean_a})"
    mean = f"({mean_a} + {gap} * {b / (a + b)!r}D)"
    m2 = f"({m2_a} + {m2_b} + {gap} * {gap} * {a * b / (a + b)!r}D)"
    return mean, m2, a + b


def joined(target: Moments, new: Moments, old: Moments) -> dict[str, str]:
    """Moments of ``target`` from the last rows and the rows right before them."""
    back = new.n
    mean, m2, n = merge(
        (new.mean, new.m2, new.n), (old.at(back, old.mean), old.at(back, old.m2), old.n)
    )
    assert n == target.n
    return {target.mean: mean, target.m2: m2}


def merged_trend(target: Moments, part: Moments, backs: list[int]) -> dict[str, str]:
    """Trend of a window made of equally long neighbouring parts."""
    means = [part.mean] + [part.at(b, part.mean) for b in backs]
    trends = [part.trend] + [part.at(b, part.trend) for b in backs]
    middle = (target.n - 1) / 2
    shifts = [
        f"{(age + (part.n - 1) / 2 - middle) * part.n!r}D * ({mean} - {means[0]})"
        for age, mean in zip(backs, means[1:])
    ]
    return {target.trend: _total(trends + shifts)}


def line_end(window: Moments) -> str:
    """Value of the least-squares line at the newest row of the window."""
    n = window.n
    spread = n * (n * n - 1) / 12
    return f"({window.mean} - {window.trend} * {(n - 1) / 2 / spread!r}D)"


def std_pop(window: Moments) -> str:
    return f"sqrt({window.m2} / {window.n}D)"


def std_samp(window: Moments) -> str:
    return f"sqrt({window.m2} / {window.n - 1}D)"
