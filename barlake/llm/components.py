"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.runtime import stage


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); roots are nodes of their component.

    Each round every node moves to the least of its neighbours and itself, in the order
    of a hash, and the edges are drawn anew between the places taken. The hash order
    makes the number of nodes fall by a constant factor a round on any shape, chains
    included. A hub costs a partial aggregate and a join whose large partitions Spark can
    split; no neighbourhood is gathered.
    """
    kind = edges.schema["a"].dataType
    current = stage(edges.where("a <> b").select("a", "b"), label)
    moves: list[DataFrame] = []
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        place = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
        nearest = both.groupBy("a").agg(F.min(place("b")).alias("least"))
        move = stage(
            nearest.select(F.col("a").alias("node"), F.least(place("a"), F.col("least"))["n"].alias("root")),
            label,
        )
        moves.append(move)
        start = move.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        end = move.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        current = stage(
            current.join(start, "a")
            .join(end, "b")
            .where("ra <> rb")
            .select(F.col("ra").alias("a"), F.col("rb").alias("b"))
            .distinct(),
            label,
        )
    if not moves:
        return edges.sparkSession.range(0).select(
            F.lit(None).cast(kind).alias("node"), F.lit(None).cast(kind).alias("root")
        )
    found = moves.pop()
    while moves:
        later = found.select(F.col("node").alias("root"), F.col("root").alias("last"))
        found = (
            moves.pop()
            .join(later, "root", "left")
            .select("node", F.coalesce("last", "root").alias("root"))
        )
    return stage(found, label)
