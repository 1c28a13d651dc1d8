"""Mixing sources to target weights by capped water-filling.

Sources rise together in proportion to their weights; one that reaches ``max_epochs``
times its size stops there, and what it leaves is shared among the others by weight
until none is above. A document is then repeated ``whole`` times plus once more if its
seeded hash is not beyond the source's cutoff, which is set so that the source's taken
words come as near to the target as whole documents allow.

The cutoff is found from word sums of 65,536 hash ranges per source, then of 65,536
ranges inside the one it falls into, then among the few hashes left. No source's
documents meet in one task, and every rerun takes the same documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import WORD, numbered, text_of
from barlake.runtime import stage

#: Fixed values of the contract: weights in source order, share of all words, epochs.
WEIGHTS, SHARE, MAX_EPOCHS = (5, 2, 1), 1.5, 2


def sample_key(id_col: str, seed: int) -> Column:
    """Seeded hash of an id as hex digits, the same in any engine that has MD5."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))


def water_level(sources: DataFrame, total: float) -> float:
    """Words per unit of weight once no source lies above its cap.

    ``sources`` has ``cap`` and ``weight``. Each round reads two sums; it ends when a
    round clamps no further source.
    """
    level, clamped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > F.col("cap")
        row = sources.agg(
            F.sum(F.when(over, F.col("cap")).otherwise(0.0)),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))),
            F.count_if(over),
        ).first()
        if not row[1] or row[2] == clamped:
            return level
        level, clamped = (total - row[0]) / row[1], row[2]


def _targets(sized: DataFrame, weights: Sequence[int], share: float, max_epochs: int) -> DataFrame:
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(by_source, [F.asc_nulls_last("source")], "_rank", "mix-sources")
    cycle = F.array(*[F.lit(w) for w in weights])
    sources = ranked.select(
        "source",
        "source_size",
        (F.col("source_size") * F.lit(float(max_epochs))).alias("cap"),
        F.get(cycle, (F.col("_rank") % len(weights)).cast("int")).alias("weight"),
    )
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(sources, share * words)
    target = F.least(F.col("cap"), F.col("weight") * F.lit(level))
    whole = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0)
    return stage(
        sources.select("source", "source_size", target.alias("target"), whole.cast("long").alias("whole"))
        .withColumn("part", F.col("target") - F.col("whole") * F.col("source_size")),
        "mix-targets",
    )


def _crossing(sums: DataFrame, part: str) -> DataFrame:
    """The first range of each source whose running sum goes beyond what is wanted."""
    running = Window.partitionBy("source").orderBy("range")
    first = Window.partitionBy("source")
    return (
        sums.withColumn("through", F.sum("size").over(running))
        .where(F.col("through") > F.col(part))
        .withColumn("_least", F.min("range").over(first))
        .where("range = _least")
        .select("source", "range", (F.col(part) - (F.col("through") - F.col("size"))).alias("left"))
    )


def _cutoffs(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source the largest hash that is taken once more."""
    rows = sized.withColumn("s1", F.col("source")).drop("source")
    same = F.col("s1").eqNullSafe(F.col("source"))

    def sums(found: DataFrame, left: str, digits: int) -> DataFrame:
        return found.groupBy("source", left, F.substring("key", 1, digits).alias("range")).agg(
            F.sum("size").alias("size")
        )

    wanted = targets.select("source", "part")
    first = stage(_crossing(sums(rows.join(wanted, same), "part", 4), "part"), "mix-range-1")
    inside = rows.join(first, same & (F.substring("key", 1, 4) == F.col("range"))).drop("range")
    second = stage(_crossing(sums(inside, "left", 8), "left"), "mix-range-2")
    last = rows.join(second, same & (F.substring("key", 1, 8) == F.col("range")))
    by_key = last.groupBy("source", "left", "range", "key").agg(F.sum("size").alias("size"))
    through = F.sum("size").over(Window.partitionBy("source").orderBy("key"))
    before = F.col("through") - F.col("size")
    fits = (F.col("through") <= F.col("left")) | (
        (before <= F.col("left")) & (F.col("through") - F.col("left") < F.col("left") - before)
    )
    return (
        by_key.withColumn("through", through)
        .groupBy("source", "range")
        .agg(F.max(F.when(fits, F.col("key"))).alias("taken"))
        .select("source", F.coalesce("taken", "range").alias("cutoff"))
    )


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 7,
) -> tuple[DataFrame, DataFrame]:
    """Staged (id, source, size, key) rows, and per source its size, target and cutoff."""
    sized = stage(
        docs.select(
            F.col(id_col).alias("_id"),
            F.col(source_col).cast("string").alias("source"),
            F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
            sample_key(id_col, seed).alias("key"),
        ),
        "mix-sizes",
    )
    targets = _targets(sized, weights, share, max_epochs)
    cut = _cutoffs(sized, targets).withColumnRenamed("source", "_s")
    plan = targets.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s", "part")
    return sized, stage(plan, "mix-plan")


def repeats() -> Column:
    return F.col("whole") + F.when(F.col("key") <= F.col("cutoff"), 1).otherwise(0)


def assign(docs: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """One row per document: id, size, source_size, target, taken.

    Null or blank texts have size 0 and give nothing. A null source is a source of its
    own, last in order. Rows that repeat an id are taken or left together. Other columns
    are ignored, an empty table gives an empty result.
    """
    sized, plan = mix_plan(docs, id_col, **settings)
    plan = plan.withColumnRenamed("source", "_s")
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("_s")))
    return rows.select(
        F.col("_id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("size") * repeats()).alias("taken"),
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: int = 7, **settings
) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as it is taken, all columns kept.

    Texts without words have no size to aim at; they follow their source's repetitions.
    """
    _, plan = mix_plan(docs, id_col, source_col=source_col, seed=seed, **settings)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.col(source_col).cast("string").alias("_source"),
        sample_key(id_col, seed).alias("key"),
    )
    counted = rows.join(plan, F.col("_source").eqNullSafe(F.col("source")))
    times = counted.withColumn("_times", repeats()).where("_times > 0")
    return times.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_doc.*")
