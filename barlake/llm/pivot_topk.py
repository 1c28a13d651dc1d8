"""Exact top-k search by inner product over a pivot-distance index.

Every vector v gets one more coordinate, sqrt(M^2 - |v|^2) with M the largest norm; a
query q gets 0 there. Then |q' - v'|^2 = |q|^2 + M^2 - 2 q.v, so the largest inner
products are the nearest neighbours of a metric, and the triangle inequality holds.

The index keys each vector by its nearest pivot and the distance to it. A query first
searches its own pivot's cell, which gives a k-th best score. It then visits only the
cells, and inside a cell only the annuli of the sorted distances, whose bound
``(|q|^2 + M^2 - max(0, |d(q,p) - d(v,p)|)^2) / 2`` still reaches that score.

Pivots are fitted on a bounded sample; every row is indexed, and the result is exact.
Cells are cut into chunks of at most ``MOST_CHUNK`` vectors, queries are dealt out in
blocks. A chunk is sent to the blocks that visit it only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.runtime import stage

K, SCALE, QUERY_STEP = 20, 64.0, 20
#: Vectors that pivots are fitted on, and the most pivots.
SAMPLE, MAX_PIVOTS = 4_096, 256
#: Vectors of an annulus, queries of a block, vectors of a chunk at least and at most (about).
ANNULUS, QUERY_BLOCK, LEAST_CHUNK, MOST_CHUNK = 512, 8_192, 512, 65_536
#: Distances are rounded; bounds leave this much room, relative to the largest norm.
ROOM = 1e-7


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """Staged (_row, vec_id, v, norm2) with v = floor(scale * x), without unusable rows."""
    x = F.col(vector_col)
    usable = F.col(id_col).isNotNull() & x.isNotNull() & ~F.exists(
        x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf"))
    )
    whole = F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("double"))
    rows = vectors.where(usable).select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("vec_id"), whole.alias("v")
    )
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    return stage(rows.withColumn("norm2", square), "topk-vectors")


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, shorter ones ending in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def fit_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """A few rounds of Lloyd's algorithm from evenly spread rows of the sample."""
    pivots = np.unique(sample, axis=0)
    pivots = pivots[np.linspace(0, len(pivots) - 1, min(count, len(pivots))).astype(int)]
    for _ in range(6):
        near = _distances(sample, pivots).argmin(axis=1)
        for p in np.unique(near):
            pivots[p] = sample[near == p].mean(axis=0)
    return pivots


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def _top(q: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best candidates of each query, grouped by query."""
    order = np.lexsort((rows, ids, -score, q))
    first = np.concatenate([[0], np.flatnonzero(np.diff(q[order])) + 1]) if len(q) else np.zeros(0, int)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return order[rank < k]


def search_cell(queries: dict, cell: dict, limit2: float, k: int) -> tuple[np.ndarray, ...]:
    """The k best of a cell for each query that its annuli can still serve.

    queries: row, v, norm2, d (distance to the cell's pivot), bound (score to reach);
    cell: row, vec_id, v, d. Returns (query place, cell place, score).
    """
    order = np.argsort(cell["d"], kind="stable")
    d, v = cell["d"][order], cell["v"][order]
    ids, rows = cell["vec_id"][order], cell["row"][order]
    bound = queries["bound"].copy()
    room = ROOM * (1 + np.sqrt(limit2))
    starts = np.arange(0, len(d), ANNULUS)
    middle = np.array([d[min(s + ANNULUS // 2, len(d) - 1)] for s in starts])
    got_q, got_v, got_s = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    for s in starts[np.argsort(np.abs(middle - np.median(queries["d"])), kind="stable")]:
        ring = slice(s, s + ANNULUS)
        low, high = d[ring][0], d[ring][-1]
        gap = np.maximum(0, np.maximum(low - queries["d"], queries["d"] - high) - room)
        live = np.flatnonzero((queries["norm2"] + limit2 - gap * gap) / 2 + room >= bound)
        if not len(live):
            continue
        scores = queries["v"][live] @ v[ring].T
        keep = (scores >= bound[live][:, None]) & (queries["row"][live][:, None] != rows[ring][None, :])
        qi, vi = np.nonzero(keep)
        if not len(qi):
            continue
        got_q = np.concatenate([got_q, live[qi]])
        got_v = np.concatenate([got_v, vi + s])
        got_s = np.concatenate([got_s, scores[qi, vi]])
        best = _top(got_q, got_s, ids[got_v], rows[got_v], k)
        got_q, got_v, got_s = got_q[best], got_v[best], got_s[best]
        full, count = np.unique(got_q, return_counts=True)
        last = np.cumsum(count) - 1
        bound[full[count == k]] = np.maximum(bound[full[count == k]], got_s[last[count == k]])
    return got_q, order[got_v], got_s


def top_k(
    vectors: DataFrame,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_step: int = QUERY_STEP,
    scale: float = SCALE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each query row.

    Queries are the rows whose id is divisible by ``query_step``; every other row is a
    candidate, also one that repeats the query's id. Rows with a null id, a null vector
    or a null or non-finite component take no part. Shorter vectors count as ending in
    zeros. Scores are exact while ``scale * |x|`` stays below about 2^23. Other columns
    are ignored, an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col, scale)
    n, n_queries, limit2, width = rows.agg(
        F.count("*"), F.count_if(F.col("vec_id") % query_step == 0), F.max("norm2"), F.max(F.size("v"))
    ).first()
    if not n or not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    picked = rows.orderBy(F.xxhash64("_row")).limit(SAMPLE).select("v", "norm2").toArrow()
    lifted = np.sqrt(np.maximum(limit2 - picked["norm2"].to_numpy(), 0))
    sample = np.column_stack([_matrix(picked["v"], width), lifted])
    pivots = fit_pivots(sample, max(1, min(MAX_PIVOTS, int(n**0.5 / 4))))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, norm2 = _matrix(batch.column("v"), width), batch.column("norm2").to_numpy()
            far = _distances(np.column_stack([v, np.sqrt(np.maximum(limit2 - norm2, 0))]), pivots)
            near = far.argmin(axis=1)
            added = [pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(near)), near])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "pivot", "d"])

    index = stage(
        rows.mapInArrow(key, "_row long, vec_id long, v array<double>, norm2 double, pivot int, d double"), "topk-index"
    )
    # A row for each pivot, so at most MAX_PIVOTS.
    cells = {r[0]: r[1:] for r in index.groupBy("pivot").agg(F.count("*"), F.min("d"), F.max("d")).collect()}
    chunk = min(MOST_CHUNK, max(LEAST_CHUNK, 2 * n // len(pivots)))
    chunks = {p: -(-c[0] // chunk) for p, c in cells.items()}
    blocks = -(-n_queries // QUERY_BLOCK)
    count_of = F.create_map(*[F.lit(x) for pair in sorted(chunks.items()) for x in pair])
    placed = index.withColumn("chunk", F.pmod(F.xxhash64("_row"), count_of[F.col("pivot")]).cast("int"))
    names = sorted(cells)
    low, high = np.array([cells[p][1] for p in names]), np.array([cells[p][2] for p in names])
    parts = np.array([chunks[p] for p in names])

    def visits(first: bool):
        """Query rows with the cells to visit: the nearest pivot's first chunk, or the others."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            room = ROOM * (1 + np.sqrt(limit2))
            for batch in batches:
                v, norm2 = _matrix(batch.column("v"), width), batch.column("norm2").to_numpy()
                far = _distances(np.column_stack([v, np.zeros(len(v))]), pivots[names])
                home = far.argmin(axis=1)
                if first:
                    at, cell, part = np.arange(len(v)), home, np.zeros(len(v), int)
                else:
                    bound = batch.column("bound").to_numpy()
                    gap = np.maximum(0, np.maximum(low - far, far - high) - room)
                    open_ = (norm2[:, None] + limit2 - gap * gap) / 2 + room >= bound[:, None]
                    at, cell = np.nonzero(open_)
                    times = parts[cell]
                    at, cell = np.repeat(at, times), np.repeat(cell, times)
                    part = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
                    other = (cell != home[at]) | (part != 0)
                    at, cell, part = at[other], cell[other], part[other]
                taken = batch.take(pa.array(at))
                added = [np.array(names, np.int32)[cell], part.astype(np.int32), far[at, cell]]
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, *map(pa.array, added)], names=[*batch.schema.names, "pivot", "chunk", "d"]
                )

        return run

    def search(queries: pa.Table, cell: pa.Table) -> pa.Table:
        out = (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        if queries.num_rows and cell.num_rows:
            asked = {c: queries[c].to_numpy() for c in ("norm2", "d", "bound")}
            asked |= {"row": queries["_row"].to_numpy(), "v": _matrix(queries["v"], width)}
            kept = {"row": cell["_row"].to_numpy(), "vec_id": cell["vec_id"].to_numpy()}
            kept |= {"d": cell["d"].to_numpy(), "v": _matrix(cell["v"], width)}
            out = search_cell(asked, kept, limit2, k)
        qi, vi, score = map(pa.array, out)
        return pa.table(
            {
                "_row": queries["_row"].take(qi),
                "query_id": queries["vec_id"].take(qi),
                "vec_id": cell["vec_id"].take(vi),
                "other": cell["_row"].take(vi),
                "score": score.cast(pa.int64()),
            }
        )

    found = "_row long, query_id long, vec_id long, other long, score long"
    asked = "_row long, vec_id long, v array<double>, norm2 double, block int, bound double"
    visit = asked + ", pivot int, chunk int, d double"
    cell_key = ["pivot", "chunk", "block"]
    asking = rows.where(F.col("vec_id") % query_step == 0).withColumn(
        "block", F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int")
    )

    def meet(queries: DataFrame, first: bool) -> DataFrame:
        led = queries.mapInArrow(visits(first), visit)
        # At most a row for each chunk and block; distances to pivots are computed again for it.
        visited = led.select("pivot", "chunk", F.col("block").alias("_block")).distinct()
        shelf = placed.join(visited, ["pivot", "chunk"]).select(*placed.columns, F.col("_block").alias("block"))
        return led.groupBy(*cell_key).cogroup(shelf.groupBy(*cell_key)).applyInArrow(search, found)

    unbound = asking.withColumn("bound", F.lit(float("-inf")))
    near = stage(meet(unbound, True), "topk-near")
    bounds = near.groupBy("_row").agg(
        F.when(F.count("*") >= k, F.min("score")).otherwise(float("-inf")).cast("double").alias("bound")
    )
    bounded = asking.join(bounds, "_row", "left").select(
        *asking.columns, F.coalesce("bound", F.lit(float("-inf"))).alias("bound")
    )
    every = near.unionByName(meet(bounded, False))
    best = Window.partitionBy("_row").orderBy(F.desc("score"), "vec_id", "other")
    ranked = every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
