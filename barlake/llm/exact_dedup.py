"""Exact deduplication with the frequent digests split off.

A Misra-Gries summary (``approx_top_k``, whose frequent-items sketch is a mergeable
Misra-Gries counter set of fixed size) names the digests that may be frequent. Their
winners are then verified: counted and chosen exactly by an aggregate that combines
before its shuffle. At most ``heavy`` winners are broadcast, so rows of frequent digests
are settled where they lie; all other digests take an ordinary shuffle, in which no
digest holds more than about ``3.5 / tracked`` of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import BLANK, text_of, without_rows
from barlake.runtime import stage

#: Counters of the summary, and how many digests it may name.
TRACKED, HEAVY = 10_000, 1_000


def text_digest(text_col: str):
    """SHA-256 (hex) of the text with each run of white space as one space."""
    return F.sha2(F.encode(F.regexp_replace(text_of(text_col), BLANK, " "), "UTF-8"), 256)


def frequent_digests(keyed: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """Digests that the summary reports more than once: at most ``heavy`` rows."""
    top = keyed.agg(F.expr(f"approx_top_k(text_sha256, {heavy}, {tracked})").alias("top"))
    return (
        top.select(F.explode("top").alias("t"))
        .where("t.count > 1 AND t.item IS NOT NULL")
        .select(F.col("t.item").alias("text_sha256"))
    )


def _winner() -> list:
    """Smallest id (nulls last), then the earliest row, and the size of the group."""
    first = F.min(F.struct(F.col("_id").isNull().alias("n"), F.col("_id"), F.col("_row")))
    return [first.alias("_first"), F.count(F.lit(1)).alias("group_size")]


def _settle(keyed: DataFrame, heavy: int, tracked: int) -> DataFrame:
    """``keyed`` (_id, _row, text_sha256; staged) with its group's winner and size."""
    named = frequent_digests(keyed, heavy, tracked)
    winners = stage(
        keyed.join(F.broadcast(named), "text_sha256").groupBy("text_sha256").agg(*_winner()),
        "dedup-winners",
    )
    settled = keyed.join(F.broadcast(winners), "text_sha256")
    rest = keyed.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
    shuffled = rest.join(rest.groupBy("text_sha256").agg(*_winner()), "text_sha256")
    return settled.unionByName(shuffled).withColumn("kept", F.col("_row") == F.col("_first._row"))


def assign(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    heavy: int = HEAVY,
    tracked: int = TRACKED,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, and empty texts are equal. Of rows that repeat an id,
    one stays. A null id loses against any other; keep_id is null only if all ids of a
    group are. Other columns are ignored, an empty table gives an empty result.
    """
    keyed = stage(
        docs.select(
            F.col(id_col).alias("_id"),
            F.monotonically_increasing_id().alias("_row"),
            text_digest(text_col).alias("text_sha256"),
        ),
        "dedup-digests",
    )
    return _settle(keyed, heavy, tracked).select(
        F.col("_id").alias(id_col),
        F.col("_first._id").alias("keep_id"),
        "group_size",
        "kept",
        "text_sha256",
    )


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    heavy: int = HEAVY,
    tracked: int = TRACKED,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; same rules as ``assign``."""
    rows = stage(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
            F.col(id_col).alias("_id"),
            F.monotonically_increasing_id().alias("_row"),
            text_digest(text_col).alias("text_sha256"),
        ),
        "dedup-rows",
    )
    keyed = rows.select("_id", "_row", "text_sha256")
    return without_rows(rows, _settle(keyed, heavy, tracked).where("NOT kept")).select("_doc.*")
