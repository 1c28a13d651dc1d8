"""Preparation of training rows: two-class labels, imputing and scaling, feature ranking.

What is learned is learned from rows of the ``train`` split alone, in one aggregate that
combines before its shuffle, and comes back as a small table of parameters, one row a column.
Applying it is a projection, so validation and test rows can never change it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Accuracy of a median: its rank is off by at most rows / MEDIAN_ACCURACY.
MEDIAN_ACCURACY = 10_000


def binary_labels(labelled: DataFrame) -> DataFrame:
    """Rows of ``forward_labels`` that moved, with ``target`` 1 for LONG and 0 for SHORT.

    Moves within the threshold are noise and go, as do rows without a later bar.
    """
    return labelled.where(F.col("label").isin("LONG", "SHORT")).withColumn(
        "target", (F.col("label") == "LONG").cast("int")
    )


def _finite(column: str) -> Column:
    """The value, null where it is missing, NaN or infinite."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def _by_column(row: DataFrame, columns: Sequence[str], parts: Sequence[str], *keys: str) -> DataFrame:
    """One row a column from wide aggregates named ``<part>_<number of the column>``."""
    structs = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{p}_{n}").alias(p) for p in parts]) for n, c in enumerate(columns)
    ]
    return row.select(*keys, F.inline(F.array(*structs)))


def fit_preparation(rows: DataFrame, columns: Sequence[str], split_col: str = "split") -> DataFrame:
    """(column, median, mean, scale) of the ``train`` rows.

    ``median`` replaces missing values; ``mean`` and ``scale`` (sample standard deviation) are
    those of the column after that. A column without any value has median 0; a scale of 0, or
    of fewer than two rows, counts as 1.
    """
    train = rows.where(F.col(split_col) == "train")
    wide = []
    for n, column in enumerate(columns):
        value = _finite(column)
        wide += [
            F.percentile_approx(value, 0.5, MEDIAN_ACCURACY).alias(f"median_{n}"),
            F.count(value).alias(f"held_{n}"),
            F.count(F.lit(1)).alias(f"all_{n}"),
            F.avg(value).alias(f"avg_{n}"),
            (F.var_pop(value) * F.count(value)).alias(f"spread_{n}"),
        ]
    found = _by_column(train.agg(*wide), columns, ("median", "held", "all", "avg", "spread"))
    median = F.coalesce("median", F.lit(0.0))
    missing = F.col("all") - F.col("held")
    average = F.coalesce("avg", F.lit(0.0))
    mean = F.when(F.col("all") > 0, (F.col("held") * average + missing * median) / F.col("all")).otherwise(0.0)
    moved = found.select("column", median.alias("median"), mean.alias("mean"), "all", "held", missing.alias("missing"), average.alias("avg"), F.coalesce("spread", F.lit(0.0)).alias("spread"))
    off = lambda c: (F.col(c) - F.col("mean")) ** 2
    total = F.col("spread") + F.col("held") * off("avg") + F.col("missing") * off("median")
    scale = F.when(F.col("all") > 1, F.sqrt(total / (F.col("all") - 1)))
    return moved.select("column", "median", "mean", F.when(scale > 0, scale).otherwise(1.0).alias("scale"))


def apply_preparation(rows: DataFrame, parameters: DataFrame) -> DataFrame:
    """``rows`` with every column of ``parameters`` imputed, centred and scaled."""
    learned = {r["column"]: r for r in parameters.collect()}  # one row a column
    return rows.withColumns(
        {c: (F.coalesce(_finite(c), F.lit(r["median"])) - r["mean"]) / r["scale"] for c, r in learned.items()}
    )


def rank_features(
    rows: DataFrame, columns: Sequence[str], label_col: str, split_col: str | None = "split"
) -> DataFrame:
    """(column, f_value, rank): one-way F of each column between the labels of the train rows.

    Counts, means and spreads by label come from one aggregate; the rest works on one row a
    label and column. Missing values are left out of their column. A column that is constant
    inside every label but differs between them ranks first (infinite F); one without two
    labels or enough rows ranks last (null F). Ties go by name.
    """
    train = rows if split_col is None else rows.where(F.col(split_col) == "train")
    train = train.where(F.col(label_col).isNotNull())
    wide = []
    for n, column in enumerate(columns):
        value = _finite(column)
        wide += [
            F.count(value).alias(f"n_{n}"),
            F.avg(value).alias(f"mean_{n}"),
            (F.var_pop(value) * F.count(value)).alias(f"spread_{n}"),
        ]
    found = _by_column(train.groupBy(F.col(label_col).alias("_label")).agg(*wide), columns, ("n", "mean", "spread"), "_label")
    whole = Window.partitionBy("column")
    grand = F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole)
    sums = (
        found.where("n > 0")
        .withColumn("grand", grand)
        .groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("labels"),
            F.sum("n").alias("n"),
            F.sum(F.col("n") * (F.col("mean") - F.col("grand")) ** 2).alias("between"),
            F.sum("spread").alias("within"),
        )
    )
    inside, across = F.col("within") / (F.col("n") - F.col("labels")), F.col("between") / (F.col("labels") - 1)
    value = F.when(
        (F.col("labels") > 1) & (F.col("n") > F.col("labels")),
        F.when(inside > 0, across / inside).when(across > 0, F.lit(float("inf"))),
    )
    every = found.select("column").distinct().join(sums.select("column", value.alias("f_value")), "column", "left")
    place = F.row_number().over(Window.orderBy(F.desc_nulls_last("f_value"), "column"))
    return every.select("column", "f_value", place.alias("rank"))


def select_features(ranking: DataFrame, top: int) -> list[str]:
    """Names of the ``top`` best columns, in rank order."""
    return [r["column"] for r in ranking.where(F.col("rank") <= top).orderBy("rank").collect()]
