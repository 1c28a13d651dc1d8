"""Positions and bounded blocks inside long series.

A single series may hold a large share of the table, so feature windows never
span a whole series. Rows get their position in the series, positions are cut
into blocks of fixed size, and each block also receives the last rows of the
block before it (the halo), enough for every look-back. A window partitioned by
``(series, block)`` then sees a bounded number of rows and any series spreads
over as many tasks as it has blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.runtime import stage
from barlake.schema import NUMERICS

SERIES = ("symbol", "timeframe")
_BUCKET_MICROS = (86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000, 1_000, 1)
_BUCKETS_PER_GROUP = 4096


def _bucket(micros: int) -> Column:
    # Whole-number arithmetic; pmod keeps instants before 1970 in order.
    return F.expr(f"(unix_micros(event_time) - pmod(unix_micros(event_time), {micros})) div {micros}")


def _bucket_counts(bars: DataFrame, micros: int) -> DataFrame:
    return bars.groupBy(*SERIES, _bucket(micros).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _join_series(left: DataFrame, right: DataFrame, extra: str) -> DataFrame:
    """Inner join on the series and ``extra`` in which a null part equals a null part."""
    names = {name: f"_{name}" for name in (*SERIES, extra)}
    other = right.withColumnsRenamed(names)
    same = [F.col(name).eqNullSafe(F.col(alias)) for name, alias in names.items()]
    return left.join(other, same).drop(*names.values())


def _bucket_starts(counts: DataFrame) -> DataFrame:
    """Rows before each bucket of each series, by a two-level prefix sum."""
    before = (Window.unboundedPreceding, -1)
    grouped = counts.withColumn("grp", F.floor(F.col("bucket") / _BUCKETS_PER_GROUP))
    in_group = Window.partitionBy(*SERIES, "grp").orderBy("bucket").rowsBetween(*before)
    groups = grouped.groupBy(*SERIES, "grp").agg(F.sum("n").alias("n"))
    in_series = Window.partitionBy(*SERIES).orderBy("grp").rowsBetween(*before)
    group_start = groups.select(
        *SERIES, "grp", F.coalesce(F.sum("n").over(in_series), F.lit(0)).alias("group_start")
    )
    placed = grouped.withColumn("in_group", F.coalesce(F.sum("n").over(in_group), F.lit(0)))
    return _join_series(placed, group_start, "grp").select(
        *SERIES, "bucket", "n", (F.col("group_start") + F.col("in_group")).alias("start")
    )


def _fitting_buckets(bars: DataFrame, max_bucket_rows: int) -> tuple[int, DataFrame]:
    """The widest bucket whose fullest occurrence fits, and the rows of each of its buckets."""
    for micros in _BUCKET_MICROS:
        counts = stage(_bucket_counts(bars, micros), "bucket-counts")
        if (counts.agg(F.max("n")).first()[0] or 0) <= max_bucket_rows:
            break
    return micros, counts


def with_position(bars: DataFrame, max_bucket_rows: int = 1_000_000) -> DataFrame:
    """Add ``pos``, the zero-based rank of the row in its series by ``event_time``.

    Rows are ranked inside time buckets, and a staged table holds how many rows
    precede each bucket. The bucket is the widest one whose fullest occurrence
    fits ``max_bucket_rows``; event times are unique in a series, so the narrowest
    bucket always fits. Spark picks the join by the size of the staged table.
    """
    micros, counts = _fitting_buckets(bars, max_bucket_rows)
    starts = stage(_bucket_starts(counts).drop("n"), "bucket-starts")
    order = Window.partitionBy(*SERIES, "bucket").orderBy("event_time")
    ranked = bars.withColumn("bucket", _bucket(micros)).withColumn(
        "rank", F.row_number().over(order)
    )
    return (
        _join_series(ranked, starts, "bucket")
        .withColumn("pos", F.col("start") + F.col("rank") - 1)
        .drop("bucket", "rank", "start")
    )


def with_blocks(positioned: DataFrame, core: int, halo: int) -> DataFrame:
    """Send each row to its block and, near the block's end, also to the next one.

    ``block`` names the block a copy belongs to; ``is_core`` is false on halo copies.
    """
    if halo > core:
        raise ValueError("halo must not exceed the block size")
    own = F.expr(f"pos div {core}")
    near_end = F.pmod(F.col("pos"), F.lit(core)) >= core - halo
    return positioned.withColumn("own", own).select(
        *positioned.columns,
        F.explode(
            F.when(near_end, F.array("own", F.col("own") + 1)).otherwise(F.array("own"))
        ).alias("block"),
        "own",
    ).withColumn("is_core", F.col("block") == F.col("own")).drop("own")


def in_blocks(
    bars: DataFrame, core: int, halo: int, max_bucket_rows: int | None = None, ahead: bool = False
) -> DataFrame:
    """Add ``pos``, ``block`` and ``is_core`` as ``with_position`` and ``with_blocks`` do, in one wide shuffle.

    A block is a run of whole time buckets, chosen from the buckets' measured counts alone, so
    rows go to their block without having been ranked before; they are ranked there, by the
    partitioning that the windows of features use too. Buckets that reach into the last
    ``halo`` rows of a block also go to the next one. A block has at least ``core`` less
    one bucket's rows and at most ``core`` plus one bucket's, besides its halo. A bucket holds
    at most ``max_bucket_rows`` (an eighth of ``core`` if not given), unless event times repeat. With
    ``ahead`` a block also gets the first bucket of the next one, for a look at the next row.
    """
    largest = max(1, core // 8) if max_bucket_rows is None else max_bucket_rows
    if halo + largest > core:
        raise ValueError("halo and one bucket must fit into a block")
    micros, counts = _fitting_buckets(bars, largest)
    placed = _bucket_starts(counts).withColumn("own", F.expr(f"start div {core}"))
    whole = Window.partitionBy(*SERIES, "own")
    reaches = F.col("start") + F.col("n") > F.max(F.col("start") + F.col("n")).over(whole) - halo
    opens = F.col("start") == F.min("start").over(whole)
    buckets = stage(placed.withColumns({"reaches": reaches, "opens": opens}).drop("n"), "bucket-blocks")
    next_one = F.when(F.col("reaches"), F.array(F.col("own") + 1)).otherwise(F.array())
    last_one = F.when(F.col("opens") & F.lit(ahead), F.array(F.col("own") - 1)).otherwise(F.array())
    homes = F.concat(F.array("own"), next_one, last_one)
    sent = _join_series(bars.withColumn("bucket", _bucket(micros)), buckets, "bucket").select(
        *bars.columns, "start", "own", F.explode(homes).alias("block")
    )
    # Bars of one time are ranked alike wherever they are sent.
    order = Window.partitionBy(*SERIES, "block").orderBy("event_time", *NUMERICS)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pos = F.first("start").over(so_far) + F.row_number().over(order) - 1
    return sent.withColumns({"pos": pos, "is_core": F.col("own") == F.col("block")}).select(
        *bars.columns, "pos", "block", "is_core"
    )
