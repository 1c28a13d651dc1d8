"""Near-duplicate join of word-shingle sets over trees of count vectors.

Two documents link when their sets of 5-word shingles have a Jaccard similarity of at
least 0.75. Steps:

1. Documents with the same set are one class; from here on a class stands for them.
2. Classes are dealt into blocks: a pair that links shares one of its rarest shingles,
   the first ``n - ceil(0.75 n) + 1`` of each set in one order of all shingles. Shingles
   that a bounded sample shows to be frequent come last in that order, which only saves
   work: any order keeps every pair. A pair is kept in the block of its first common shingle,
   where what follows in both sets must still hold enough; members whose places in the order
   allow them no partner of the block leave it. Blocks over ``BLOCK`` members are cut into parts.
3. Shingles are hashed into groups, and a class is the point of its counts by group. An
   R-tree over a block's points bounds the overlap of two subtrees, and of two points, by
   the sum of the smaller coordinates; members without a partner that could still link
   drop out. The others' pairs are verified on their sets, again under a tree. First each
   member goes to the fullest of its blocks alone, twice over; blocks whose members are
   all connected by then need no further test. Blocks that are left and hang together
   become one task if they have at most ``FAMILY`` members, so that a set is sent once for
   all its blocks; others stay apart. Pairs that are connected already are skipped, so a
   task returns at most a spanning forest of its links, never all pairs.
4. Connected components of the links give every document its component.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import WordHashes, arrow_rows, lower_words, mix, record_batch, without_rows
from barlake.llm.components import connected_components
from barlake.runtime import release, stage, staged_paths

WORDS, PERCENT = 5, 75
#: Members that blocks which hang together may have to become one task.
FAMILY = 4_096
#: Rounds in which a member goes to one block only.
ROUNDS = 2
#: Members of a block part, points of a tree leaf, groups of a point at least.
BLOCK, LEAF, GROUPS = 1_024, 24, 128
#: Up to so many class names are broadcast to the scan of the texts; more are shuffled.
BROADCAST_ROWS = 1_000_000
#: Rows of an Arrow batch of texts, and rarest shingles that a task sends at once.
TEXTS, SENT = 1_000, 1 << 20
#: Bytes of a shingle inside its hash range.
LOW = 5
#: Documents that the frequent shingles are taken from, and how many of them hold one.
SAMPLE, FREQUENT = 20_000, 4


def shingles(words: list[bytes], hashes: WordHashes, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit shingles; a shorter text is one shingle of all its words."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    own = hashes.of(words)
    k = min(size, n)
    value = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + own[i : n - k + 1 + i])
    return np.unique(value)


def set_digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def prefix(n, percent: int = PERCENT):
    """How many of its n shingles a set shows, of which every linking set holds one."""
    return n - -(-percent * n // 100) + 1


def largest_partner(n, place, percent: int = PERCENT):
    """Size up to which a set can link that agrees with a set of n from ``place`` on at the earliest."""
    return (100 * n - (100 + percent) * place) // percent


def rarest(own: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The part of a set that every linking set meets."""
    n = len(own)
    keep = prefix(n, percent)
    if len(frequent):
        common = frequent[np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)] == own
        own = np.concatenate([own[~common], own[common]])
    return own[:keep]


# ---- tree of count vectors -------------------------------------------------------


class _Node:
    __slots__ = ("children", "members", "most", "least_n", "most_n")

    def __init__(self, members: np.ndarray, counts: np.ndarray, n: np.ndarray):
        self.members, self.children = members, ()
        self.most = counts[members].max(axis=0)
        self.least_n, self.most_n = int(n[members].min()), int(n[members].max())
        if len(members) > LEAF:
            # Split at the median of the widest coordinate; the set size is one of them.
            points = np.column_stack([counts[members], n[members]])
            axis = int(points.std(axis=0).argmax())
            order = members[np.argsort(points[:, axis], kind="stable")]
            half = len(order) // 2
            self.children = (_Node(order[:half], counts, n), _Node(order[half:], counts, n))


def _can_link(bound, n_a, n_b, percent: int):
    """100 overlap >= percent (n_a + n_b - overlap), with a bound in place of the overlap."""
    return bound * (100 + percent) >= percent * (n_a + n_b)


def _leaf_pairs(a: _Node, b: _Node, percent: int) -> Iterator[tuple[_Node, _Node]]:
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if a.most_n * 100 < percent * b.least_n or b.most_n * 100 < percent * a.least_n:
            continue
        if not _can_link(int(np.minimum(a.most, b.most).sum()), a.least_n, b.least_n, percent):
            continue
        if a is b and a.children:
            x, y = a.children
            todo += [(x, x), (x, y), (y, y)]
        elif a.children and (not b.children or len(a.members) >= len(b.members)):
            todo += [(x, b) for x in a.children]
        elif b.children:
            todo += [(a, x) for x in b.children]
        else:
            yield a, b


def _trees(counts: np.ndarray, n: np.ndarray, side: np.ndarray) -> tuple[_Node, _Node]:
    """The trees to hold against each other: one with itself, or those of the two sides."""
    trees = [_Node(np.flatnonzero(side == s), counts, n) for s in np.unique(side)]
    return trees[0], trees[-1]


def _bounds(a: _Node, b: _Node, counts: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Overlap bounds of two leaves' points, and which pairs could link (each pair once)."""
    bound = np.minimum(counts[a.members][:, None, :], counts[b.members][None, :, :]).sum(axis=2)
    could = _can_link(bound, n[a.members][:, None], n[b.members][None, :], percent)
    if a is b:
        could &= np.tri(len(a.members), k=-1, dtype=bool)
    return bound, could


def count_vector(own: np.ndarray, groups: int = 0) -> np.ndarray:
    """Counts by group: the low bits of a shingle, at least a group for every four shingles.

    With fewer groups the counts of unrelated long texts would agree too well.
    """
    groups = groups or max(GROUPS, 1 << (len(own) // 4).bit_length())
    return np.bincount((own & np.uint64(groups - 1)).astype(np.int64), minlength=groups)


def _fold(point: np.ndarray, groups: int) -> np.ndarray:
    """A point over fewer groups, as its shingles would have given it."""
    return point.reshape(-1, groups).sum(axis=0)


def could_link(points: list[np.ndarray], n: np.ndarray, side: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Which points have a partner within the bound; the tree works on the coarsest groups."""
    found = np.zeros(len(n), bool)
    counts = np.array([_fold(p, GROUPS) for p in points], dtype=np.int32)
    for a, b in _leaf_pairs(*_trees(counts, n, side), percent):
        if found[a.members].all() and found[b.members].all():
            continue
        _, could = _bounds(a, b, counts, n, percent)
        for i, j in np.argwhere(could).tolist():
            x, y = a.members[i], b.members[j]
            if found[x] and found[y]:
                continue
            groups = min(len(points[x]), len(points[y]))
            bound = np.minimum(_fold(points[x], groups), _fold(points[y], groups)).sum()
            if _can_link(int(bound), n[x], n[y], percent):
                found[x] = found[y] = True
    return found


def links(
    sets: list[np.ndarray], side: np.ndarray, joined: list | None = None, percent: int = PERCENT
) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets``, or between the two sides if there are two.

    Sets with equal entries in ``joined`` are connected from the start.
    """
    n = np.array([len(s) for s in sets], dtype=np.int64)
    groups = 1 << int(np.clip(int(np.median(n)) // 2, 8, 2048)).bit_length()
    counts = np.array([count_vector(own, groups) for own in sets], dtype=np.int32)
    first: dict = {}
    root = [first.setdefault(j, i) for i, j in enumerate(joined)] if joined else list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for a, b in _leaf_pairs(*_trees(counts, n, side), percent):
        bound, could = _bounds(a, b, counts, n, percent)
        near = np.argwhere(could)
        for i, j in near[np.argsort(-bound[could], kind="stable")].tolist():
            x, y = int(a.members[i]), int(b.members[j])
            if find(x) != find(y):
                shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if _can_link(shared, n[x], n[y], percent):
                    root[find(x)] = find(y)
                    out.append((x, y))
    return out


# ---- blocks ----------------------------------------------------------------------


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = F.col("_row") if "_row" in docs.columns else F.monotonically_increasing_id()
    return docs.select(
        F.col(id_col).cast("long").alias("_id"),
        row.alias("_row"),
        F.xxhash64(text).alias("_hash"),
        text.cast("binary").alias("text"),
    )


def _sets(batch: pa.RecordBatch, hashes: WordHashes) -> Iterator[np.ndarray]:
    for text in batch.column("text"):
        yield shingles(lower_words(text.as_py()), hashes)
        hashes.trim()


def _small(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs, after a byte that tells how many."""
    kind = np.min_scalar_type(int(counts.max(initial=0)))
    return bytes([kind.itemsize]) + counts.astype(kind).tobytes()


def _counts(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1).astype(np.uint32)


def _ref(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        sets = [(set_digest(s), len(s), _small(count_vector(s))) for s in _sets(batch, hashes)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_id"),
                batch.column("_row"),
                batch.column("_hash"),
                pa.array([s[0] for s in sets], pa.binary()),
                pa.array([_ref(s[0]) for s in sets], pa.int64()),
                pa.array([s[1] for s in sets], pa.int64()),
                pa.array([s[2] for s in sets], pa.binary()),
            ],
            names=["_id", "_row", "_hash", "digest", "ref", "n", "counts"],
        )


def _frequent_shingles(texts: DataFrame, rows: int) -> np.ndarray:
    """Shingles that at least ``FREQUENT`` of the sampled documents hold, sorted."""
    share = min(1.0, SAMPLE / max(1, rows))
    some = texts.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_003)) < int(1_000_003 * share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            own = [*_sets(batch, hashes)]
            value, times = np.unique(np.concatenate(own) if own else np.zeros(0, np.uint64), return_counts=True)
            value, times = value[times > 1], times[times > 1]  # seen once here: hardly frequent
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(times)], names=["s", "c"])

    counts = some.mapInArrow(run, "s long, c long").groupBy("s").agg(F.sum("c").alias("c"))
    return np.sort(counts.where(F.col("c") >= FREQUENT).select("s").toArrow()["s"].to_numpy().view(np.uint64))


def _emit_rarest(shards: int, carried) -> callable:
    """Tasks send the rarest shingles of their classes as packed arrays by hash range.

    Of a shingle its ``LOW`` low bytes, of its place in the order a 255th part of the shown
    ones: shingles that fall together, and places taken too early, only add members.
    """
    shift = np.uint64(64 - shards.bit_length() + 1)
    names, kinds = ["shard", "s", "ref", "n", "place"], [pa.int32(), *[pa.binary()] * 4]

    def packed_rows(values: list, refs: list[int], sizes: list[int]) -> pa.RecordBatch:
        value, lengths = np.concatenate(values), [len(v) for v in values]
        ref, size = np.repeat(np.array(refs, np.int64), lengths), np.repeat(np.array(sizes, np.uint32), lengths)
        place = np.concatenate([np.arange(n) * 255 // n for n in lengths]).astype(np.uint8)
        order = np.argsort(value, kind="stable")
        value, ref, size, place = value[order], ref[order], size[order], place[order]
        low = value.view(np.uint8).reshape(-1, 8)[:, :LOW]
        edges = np.flatnonzero(np.diff((value >> shift).astype(np.int64), prepend=-1, append=shards))
        rows = [
            (int(value[lo] >> shift), low[lo:hi].tobytes(), ref[lo:hi].tobytes(), _small(size[lo:hi]), place[lo:hi].tobytes())
            for lo, hi in zip(edges[:-1], edges[1:])
        ]
        return record_batch(rows, names, kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, frequent = WordHashes(), carried.value
        seen, values, refs, sizes, sent = set(), [], [], [], 0
        for batch in batches:
            for own in _sets(batch, hashes):
                digest = set_digest(own)
                if len(own) and digest not in seen:
                    seen.add(digest)
                    values.append(rarest(own, frequent).copy())  # else the whole set stays in memory
                    refs.append(_ref(digest))
                    sizes.append(len(own))
                    sent += len(values[-1])
                    if sent >= SENT:
                        yield packed_rows(values, refs, sizes)
                        seen, values, refs, sizes, sent = set(), [], [], [], 0
        if values:
            yield packed_rows(values, refs, sizes)

    return run


def partnered(n: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which members of a block, by size, may link with another one: both sizes within what the other allows.

    In a block over 256 members the one that allows most may stay without such a partner.
    """
    if len(n) <= 256:
        fits = n[:, None] <= most[None, :]
        fits &= fits.T
        np.fill_diagonal(fits, False)
        return fits.any(axis=1)
    within = np.searchsorted(n, most, side="right")
    return (within > 0) & (np.maximum.accumulate(most)[np.maximum(within, 1) - 1] >= n)


def _blocks(table: pa.Table) -> pa.Table:
    """Members of every block of a hash range: (block key, part, whether there are more, ref)."""
    low = np.concatenate([np.frombuffer(x, np.uint8) for x in table["s"].to_pylist()]).reshape(-1, LOW)
    s = np.zeros((len(low), 8), np.uint8)
    s[:, :LOW] = low
    s = s.view(np.uint64).ravel()
    ref = np.concatenate([np.frombuffer(x, np.int64) for x in table["ref"].to_pylist()])
    n = np.concatenate([_counts(x) for x in table["n"].to_pylist()]).astype(np.int64)
    place = np.concatenate([np.frombuffer(x, np.uint8) for x in table["place"].to_pylist()])
    most = largest_partner(n, place * prefix(n) // 255)
    order = np.lexsort((-most, ref, n, s))
    s, ref, n, most = s[order], ref[order], n[order], most[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (ref[1:] != ref[:-1])
    s, ref, n, most = s[new], ref[new], n[new], most[new]
    # A new block begins with another shingle, or where the sizes leave too wide a gap.
    cut = np.ones(len(s), bool)
    cut[1:] = (s[1:] != s[:-1]) | (n[1:] * PERCENT > n[:-1] * 100)
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(s))
    # Most blocks have two members: those are judged at once.
    last = ends - 1
    open_ = (ends - starts > 2) | (ends - starts == 2) & (n[starts] <= most[last]) & (n[last] <= most[starts])
    keys, parts, large, members = [], [], [], []
    for lo, hi in zip(starts[open_], ends[open_]):
        own = ref[lo:hi]
        if hi - lo > 2:
            own = own[partnered(n[lo:hi], most[lo:hi])]
            if len(own) < 2:
                continue
        key = int.from_bytes(hashlib.blake2b(np.sort(own).tobytes(), digest_size=8).digest(), "little", signed=True)
        # Members are in size order, so a part holds neighbours in size.
        keys.append(np.full(len(own), key))
        parts.append(np.arange(len(own), dtype=np.int32) // BLOCK)
        large.append(np.full(len(own), len(own) > BLOCK))
        members.append(own)
    joined = lambda a, kind: pa.array(np.concatenate([np.zeros(0, kind), *a]))
    return pa.table(
        {
            "key": joined(keys, np.int64),
            "a": joined(parts, np.int32),
            "large": joined(large, bool),
            "ref": joined(members, np.int64),
        }
    )


def _prune(table: pa.Table) -> pa.Table:
    """Members of a task that could link with another one by their points."""
    points = [_counts(x) for x in table["counts"].to_pylist()]
    kept = could_link(points, table["n"].to_numpy(), table["side"].to_numpy())
    return table.drop_columns(["counts"]).filter(pa.array(kept))


_BLOCK_KEY = ["key", "a", "b"]


def _fullest(members: DataFrame) -> DataFrame:
    """Each member in one of its blocks, the one with the most members."""
    sizes = members.groupBy("key", "a").agg(F.count("*").alias("size"))
    block = F.struct("key", "a")
    best = F.max_by(block, F.struct("size", "key", "a")).alias("t")
    chosen = members.join(sizes, ["key", "a"]).groupBy("digest").agg(best, F.min("root").alias("root"))
    return _alone(chosen.select("t.*", "digest", "root"))


def _alone(members: DataFrame) -> DataFrame:
    """Parts as tasks of their own."""
    return members.withColumns({"b": F.col("a"), "side": F.lit(0)})


def _open_blocks(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, with their component, of blocks that hold more than one component."""
    named = members.drop("root").join(roots.withColumnRenamed("node", "digest"), "digest", "left")
    named = named.withColumn("root", F.coalesce("root", "digest"))
    mixed = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return named.join(mixed.select("key"), "key", "left_semi")


def _delegates(members: DataFrame) -> DataFrame:
    """Small blocks as they are; of a large one a member for each component, in new parts."""
    one = members.where("large").groupBy("key", "root").agg(F.min("digest").alias("digest"), F.first("large").alias("large"))
    sizes = one.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    dealt = F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int").alias("a")
    few = one.join(sizes, "key").select("key", dealt, "large", "digest", "root")
    return members.where("NOT large").select(*few.columns).unionByName(few)


def _part_pairs(members: DataFrame) -> DataFrame:
    """Tasks for the parts of large blocks, each with itself and with every later one.

    Only where two components are left, and only where sizes can link.
    """
    parts = members.groupBy("key", "a").agg(
        *[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("root", "n")]
    )
    other = parts.select("key", *[F.col(c).alias(f"o_{c}") for c in parts.columns if c != "key"])
    low, high = F.least("min_root", "o_min_root"), F.greatest("max_root", "o_max_root")
    near = (F.col("o_min_n") * PERCENT <= F.col("max_n") * 100) & (F.col("min_n") * PERCENT <= F.col("o_max_n") * 100)
    pairs = parts.join(other, "key").where((F.col("a") <= F.col("o_a")) & (low != high) & near)
    sides = F.when(F.col("a") == F.col("o_a"), F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("part")))).otherwise(
        F.array(*[F.struct(F.lit(n).alias("side"), F.col(c).alias("part")) for n, c in enumerate(("a", "o_a"))])
    )
    tasks = pairs.select("key", "a", F.col("o_a").alias("b"), F.inline(sides))
    held = members.select("key", F.col("a").alias("part"), "ref", "digest", "root")
    return tasks.join(held, ["key", "part"]).drop("part")


def _families(members: DataFrame) -> DataFrame:
    """Members of blocks that hang together as one task, as far as these are small."""
    name = F.concat(F.lit("block "), F.col("key").cast("string")).cast("binary")
    edges = members.select(F.col("digest").alias("a"), name.alias("b")).distinct()
    family = connected_components(edges, "join-families").select(
        F.col("node").alias("digest"), F.col("root").alias("family")
    )
    named = members.join(family, "digest")
    sizes = named.groupBy("family").agg(F.count_distinct("digest").alias("size"))
    small = F.col("size") <= FAMILY
    tasks = named.join(sizes, "family").select(
        F.when(small, F.xxhash64("family")).otherwise(F.col("key")).alias("key"),
        F.when(small, F.lit(0)).otherwise(F.col("a")).alias("a"),
        "digest",
        "root",
    )
    return _alone(tasks.distinct())


def _member_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed texts: a third of the size of the sets, which are made where they are compared."""
    for batch in batches:
        small = [zlib.compress(text.as_py(), 1) for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(small, pa.binary())], names=["digest", "own"])


def _verify(table: pa.Table) -> pa.Table:
    place: dict[bytes, int] = {}  # a text that is there twice counts once
    columns = (table[c].to_pylist() for c in ("digest", "side", "root"))
    side, root, own, hashes = [], [], [], WordHashes()
    for n, (digest, at, joined) in enumerate(zip(*columns)):
        if digest not in place:
            place[digest] = len(side)
            side.append(at)
            root.append(joined)
            own.append(shingles(lower_words(zlib.decompress(table["own"][n].as_py())), hashes))
            hashes.trim()
    names = list(place)
    found = links(own, np.array(side), root) if len(own) > 1 else []
    return pa.table(
        {
            "a": pa.array([names[i] for i, _ in found], pa.binary()),
            "b": pa.array([names[j] for _, j in found], pa.binary()),
        }
    )


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Staged (_id, _row, digest, n, root): one row for each row of ``docs``.

    ``root`` names the component of sets that have shingles; a column ``_row`` of ``docs`` is
    kept as the row's name.
    """
    spark = docs.sparkSession
    earlier = staged_paths(spark)
    texts = _texts(docs, id_col, text_col)
    row = "_id long, _row long, _hash long, digest binary, ref long, n long, counts binary"
    with arrow_rows(spark, TEXTS):
        described = stage(texts.mapInArrow(_describe, row), "join-sets")
        rows = described.count()
        frequent = spark.sparkContext.broadcast(_frequent_shingles(texts, rows))
    shards = 1 << max(4, (rows // 500).bit_length())
    rare = texts.mapInArrow(_emit_rarest(shards, frequent), "shard int, s binary, ref binary, n binary, place binary")
    found = rare.groupBy("shard").applyInArrow(_blocks, "key long, a int, large boolean, ref long")
    with arrow_rows(spark, TEXTS):
        blocks = stage(found.distinct(), "join-blocks")
    frequent.destroy()
    points = described.groupBy("ref").agg(F.min("counts").alias("counts"), F.min("n").alias("n"))
    member = "key long, a int, b int, side int, ref long, n long"
    small = _alone(blocks.where("NOT large").drop("large")).join(points, "ref")
    pruned = small.groupBy(*_BLOCK_KEY).applyInArrow(_prune, member).select("key", "a", "ref", "n", F.lit(False).alias("large"))
    whole = blocks.where("large").join(points.select("ref", "n"), "ref").select(*pruned.columns)
    survivors = stage(pruned.unionByName(whole), "join-survivors")
    # One text for each class that is left in a block; a class is named by its digest now.
    chosen = described.groupBy("digest", "ref").agg(F.min(F.struct("_hash", "_id")).alias("r"))
    members = stage(
        survivors.join(chosen.select("ref", "digest"), "ref").withColumn("root", F.col("digest")), "join-members"
    )
    holders = stage(
        chosen.join(members.select("digest").distinct(), "digest", "left_semi").select(
            "digest", F.col("r._hash").alias("h"), F.col("r._id").alias("i")
        ),
        "join-holders",
    )
    few = holders.count() <= BROADCAST_ROWS
    own = (F.col("_hash") == F.col("h")) & F.col("_id").eqNullSafe(F.col("i"))
    carried = texts.join(F.broadcast(holders) if few else holders, own)
    with arrow_rows(spark, TEXTS):
        sets = stage(
            carried.select("digest", "text").mapInArrow(_member_texts, "digest binary, own binary"), "join-member-texts"
        )
    has_large = not members.where("large").isEmpty()

    def verified(tasks: DataFrame) -> DataFrame:
        found = tasks.join(sets, "digest").groupBy(*_BLOCK_KEY).applyInArrow(_verify, "a binary, b binary")
        return stage(found, "join-links")

    def joined(found: DataFrame) -> DataFrame:
        return connected_components(found.distinct(), "join-components")

    found = verified(_fullest(members))
    roots = joined(found)
    for _ in range(ROUNDS - 1):
        members = stage(_open_blocks(members, roots), "join-open-blocks")
        found = found.unionByName(verified(_fullest(_delegates(members))))
        roots = joined(found)
    members = stage(_open_blocks(members, roots), "join-open-blocks")
    found = found.unionByName(verified(_families(members.where("NOT large"))))
    if has_large:
        roots = joined(found)
        members = stage(_open_blocks(members.where("large"), roots), "join-open-blocks")
        tasks = _part_pairs(members).join(points, "ref")
        close = tasks.groupBy(*_BLOCK_KEY).applyInArrow(_prune, f"{member}, digest binary, root binary")
        found = found.unionByName(verified(stage(close.drop("ref", "n"), "join-part-pairs")))
    roots = joined(found)
    # Sets without shingles are all equal but link with nothing.
    named = described.join(roots.withColumnRenamed("node", "digest"), "digest", "left")
    result = stage(
        named.select("_id", "_row", "digest", "n", F.when(F.col("n") > 0, F.coalesce("root", "digest")).alias("root")),
        "join-result",
    )
    release(spark, staged_paths(spark) - earlier, result)
    return result


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id.

    Null texts are empty; a text without words has no shingles and links with nothing. A
    text of fewer than five words is one shingle. Rows that repeat an id count each by
    its own text. A null id never names a component that holds another id. Other columns
    are ignored, an empty table gives an empty result.
    """
    found = components(docs.select(id_col, text_col), id_col, text_col)
    # Combined before the shuffle, then joined by component, of which Spark can split a large one.
    least = found.where("root IS NOT NULL").groupBy("root").agg(F.min("_id").alias("first"))
    return found.join(least, "root", "left").select(
        F.col("_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("_id")).otherwise(F.col("first")).alias("component_id"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, all columns kept: the smallest id (nulls last), then the earliest row.

    Texts without words link with nothing and stay. Rows that repeat an id are judged each
    by its own text.
    """
    rows = stage(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "join-rows",
    )
    # Texts are staged once: id and text are read out of the document.
    own = F.col("_doc").getField(id_col).alias("_id"), F.col("_doc").getField(text_col).alias("_text")
    found = components(rows.select(*own, "_row"), "_id", "_text").where("root IS NOT NULL")
    order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")
    first = found.groupBy("root").agg(F.min(order)["_row"].alias("_first"))
    losers = found.join(first, "root").where("_row <> _first").select("_row")
    return without_rows(rows, losers).select("_doc.*")
