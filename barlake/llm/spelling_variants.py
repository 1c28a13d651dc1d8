"""Spelling variants by a dictionary of trie-node pairs.

All words are put into two tries, one by their letters and one by their reversed letters,
and the nodes of both are numbered. A word cut at position ``i`` is then a pair of
integers, the prefix node and the suffix node. Skipping the letter at ``i`` gives the pair
(prefix of ``i`` letters, suffix after the letter), cutting without a skip gives (prefix of
``i`` letters, suffix from there on). Two words that both skip a letter at one pair differ by
that letter; a word that skips a letter at a pair where another one is cut is that other word
with a letter inserted. So exact neighbours meet on equal pairs, and nothing has to be
verified.

Numbering needs no trie in memory: in sorted order a word adds the nodes that it does not
share with the word before it, so a range of sorted words numbers its own nodes while it is
streamed. A node that several ranges share lies on the path of a range's first word; those
numbers (one path a range) are unified on the driver. A node that one word alone passes
cannot bring two words together, so paths end where the neighbours in sorted order part.

A pair has at most one word that is cut there and one word a letter of the alphabet that
skips there (90 letters), so its members are settled by counts and the two best of them;
pairs of words are never listed.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import mix, text_of
from barlake.runtime import stage, unstage

#: Fixed values of the contract: least letters and occurrences, the ratio between a form and
#: its variant, and the remainder by which letters go.
LEAST_LETTERS, LEAST_COUNT, RATIO, DROP_EVERY = 7, 2, 10, 31
#: Words a range of the sorted order, words a shard of pairs, and what a task holds before it
#: sends it on: different words while counting, pairs while joining.
RANGE_WORDS, SHARD_WORDS, HELD_WORDS, HELD_PAIRS = 50_000, 25_000, 200_000, 1_000_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_RUN = re.compile(r"[A-Za-z\u00C0-\u00FF]{%d,}" % LEAST_LETTERS)
#: Kinds of a pair's members, in the low bits of a code: a skip that also counts as an
#: insertion (the first of a run of equal letters), another skip, a cut.
_SKIP, _SKIP_ONLY, _CUT = 0, 1, 2


# ---- words -----------------------------------------------------------------------


def _emit(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        for name, value in zip(batch.column(0).to_pylist(), texts):
            text = value.as_py().translate(_LOWER).decode()
            for run, n in Counter(_RUN.findall(text)).items():
                hashed = zlib.crc32(f"{name}:{run}".encode())
                if hashed % DROP_EVERY == 0:
                    at = hashed % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < LEAST_LETTERS:
                        continue
                counts[run] += n
            if len(counts) > HELD_WORDS:
                yield _emit(counts)
                counts.clear()
    yield _emit(counts)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of enough letters and occurrences; a null id counts as ``null``."""
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("_id"), text_of(text_col).alias("_text")
    )
    counted = rows.mapInArrow(_count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# ---- numbered tries --------------------------------------------------------------


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    for n, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return n
    return min(len(a), len(b))


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to sorted rows (key first): range, row in the range, node path, nodes so far.

    Nodes are numbered from 0 in each range. A path ends where both neighbours have parted
    from it; the range's first and last word keep whole paths, as other ranges go on there.
    """
    part = TaskContext.get().partitionId()
    row = fresh = 0
    before, path = "", []
    shared: list[int] = []  # by word: letters shared with the word before it

    def build(batch: pa.RecordBatch, paths: list, nodes: list, then: int) -> pa.RecordBatch:
        """The batch with its columns; ``then`` letters are shared with the word after it."""
        first = row - len(paths)
        ends = map(max, shared, [*shared[1:], then])
        added = [
            pa.array([part] * len(paths), pa.int32()),
            pa.array(range(first, row), pa.int64()),
            pa.array([p[:end] for p, end in zip(paths, ends)], pa.list_(pa.int64())),
            pa.array(nodes, pa.int64()),
        ]
        names = [*batch.schema.names, "range", "row", "path", "nodes"]
        return pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    waiting = None  # a batch goes out when the word after it is known
    for batch in batches:
        keys = batch.column(0).to_pylist()
        if not keys:
            continue
        if waiting is not None:
            yield build(*waiting, _common(before, keys[0]))
        paths, nodes, shared = [], [], []
        for key in keys:
            common = _common(before, key)
            path = path[:common] + list(range(fresh, fresh + len(key) - common))
            fresh += len(key) - common
            paths.append(path)
            nodes.append(fresh)
            shared.append(common if row else len(key))
            row += 1
            before = key
        waiting = (batch, paths, nodes)
    if waiting is not None:
        yield build(*waiting, len(before))


def _numbered(words: DataFrame, ranges: int, label: str) -> DataFrame:
    """``words`` (key first, all different) in sorted ranges with their paths; staged."""
    key = words.columns[0]
    dealt = words.repartitionByRange(ranges, key).sortWithinPartitions(key)
    schema = ", ".join(f"{c} {t}" for c, t in words.dtypes)
    return stage(
        dealt.mapInArrow(_paths, f"{schema}, range int, row bigint, path array<bigint>, nodes bigint"), label
    )


def _starts(numbered: DataFrame) -> DataFrame:
    """Per range: rows and nodes before it, and the final numbers of its first word's nodes.

    One row a range is collected: its first and last word and the last word's path.
    """
    key = numbered.columns[0]
    ends = numbered.groupBy("range").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("nodes").alias("nodes"),
        F.min(key).alias("first"),
        F.max(F.struct("row", F.col(key).alias("key"), "path")).alias("last"),
    )
    table, rows, nodes = [], 0, 1  # the root is node 0
    last, last_path = None, []
    for r in sorted(ends.collect(), key=lambda r: r["range"]):
        fixed = last_path[: _common(last, r["first"])] if last is not None else []
        table.append((r["range"], rows, nodes, fixed))
        last = r["last"]["key"]
        last_path = [fixed[n] if n < len(fixed) else n + nodes for n in r["last"]["path"]]
        rows += r["rows"]
        nodes += r["nodes"]
    return numbered.sparkSession.createDataFrame(
        table, "range int, before bigint, offset bigint, fixed array<bigint>"
    )


def _global(numbered: DataFrame) -> DataFrame:
    """``numbered`` with final node numbers, and the row's place in the whole order."""
    final = F.expr("transform(path, n -> IF(n < size(fixed), fixed[CAST(n AS INT)], n + offset))")
    return numbered.join(F.broadcast(_starts(numbered)), "range").withColumns(
        {"path": final, "row": F.col("row") + F.col("before")}
    )


# ---- pairs -----------------------------------------------------------------------


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts`` its index as often as it says, and the number within."""
    at = np.repeat(np.arange(len(counts)), counts)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of a list column, starts and lengths."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False), offsets[:-1], np.diff(offsets)


def _pairs_of(batch: pa.RecordBatch) -> np.ndarray:
    """(prefix node, suffix node, code, n) of the rows (word, row, n, path, back)."""
    words = batch.column(0).to_pylist()
    rank, n = (batch.column(c).to_numpy() for c in (1, 2))
    nodes, starts, depth = _lists(batch.column(3))
    back_nodes, back_starts, back_depth = _lists(batch.column(4))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    length = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(length) - length
    out = []
    for skip in (1, 0):
        # The prefix has i letters, the suffix length - i - skip; both must be shared nodes.
        low = np.maximum(length - skip - back_depth, 0)
        high = np.minimum(depth, length - skip)
        at, i = _spread(np.maximum(high - low + 1, 0))
        i = i + low[at]
        j = length[at] - i - skip
        prefix = np.where(i, nodes[np.minimum(starts[at] + i - 1, len(nodes) - 1)], 0) if len(nodes) else i * 0
        suffix = (
            np.where(j, back_nodes[np.minimum(back_starts[at] + j - 1, len(back_nodes) - 1)], 0)
            if len(back_nodes)
            else j * 0
        )
        if skip:
            here = letters[first[at] + i]
            again = (i > 0) & (here == letters[first[at] + np.maximum(i - 1, 0)])
            kind = np.where(again, _SKIP_ONLY, _SKIP)
        else:
            kind = np.full(len(at), _CUT)
        out.append(np.stack([prefix, suffix, rank[at] * 4 + kind, n[at]], axis=1))
    return np.concatenate(out)


def _deal(shards: int):
    """Pairs of a task, packed by the shard of their key."""

    def pack(held: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(held)
        with np.errstate(over="ignore"):
            hashed = mix(mix(rows[:, 0].astype(np.uint64)) + rows[:, 1].astype(np.uint64))
        shard = (hashed % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        rows, shard = rows[order], shard[order]
        cuts = np.flatnonzero(np.diff(shard)) + 1
        blobs = [zlib.compress(np.ascontiguousarray(part.T).tobytes(), 1) for part in np.split(rows, cuts)]
        return pa.RecordBatch.from_arrays(
            [pa.array(shard[np.concatenate([[0], cuts])], pa.int64()), pa.array(blobs, pa.binary())],
            names=["shard", "pairs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            rows = _pairs_of(batch)
            held.append(rows)
            size += len(rows)
            if size > HELD_PAIRS:
                yield pack(held)
                held, size = [], 0
        if size:
            yield pack(held)

    return run


def links(prefix: np.ndarray, suffix: np.ndarray, code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Members of equal pairs: (row, near words, n of the best, row of the best), if any are near."""
    rank, kind = code >> 2, code & 3
    order = np.lexsort((rank, -n, kind == _CUT, suffix, prefix))
    prefix, suffix, rank, kind, n = (a[order] for a in (prefix, suffix, rank, kind, n))
    new = np.ones(len(rank), bool)
    new[1:] = (prefix[1:] != prefix[:-1]) | (suffix[1:] != suffix[:-1])
    group, start = np.cumsum(new) - 1, np.flatnonzero(new)
    cut, own = kind == _CUT, kind == _SKIP
    skips = np.bincount(group[~cut], minlength=len(start))
    cut_at = np.full(len(start), -1)
    cut_at[group[cut]] = np.flatnonzero(cut)
    inserted = np.bincount(group[own], minlength=len(start))
    own_at = np.flatnonzero(own)
    own_first = np.full(len(start), -1)
    own_first[group[own_at[::-1]]] = own_at[::-1]

    near, rows, best = [], [], []
    # Both skip a letter: the best is the first member, for that one itself the second.
    at = np.flatnonzero(~cut & (skips[group] > 1))
    top = start[group[at]]
    rows.append(at), near.append(skips[group[at]] - 1), best.append(np.where(top == at, top + 1, top))
    # One skips where the other is cut.
    at = np.flatnonzero(own & (cut_at[group] >= 0))
    rows.append(at), near.append(np.ones(len(at), np.int64)), best.append(cut_at[group[at]])
    at = np.flatnonzero(cut & (inserted[group] > 0))
    rows.append(at), near.append(inserted[group[at]]), best.append(own_first[group[at]])
    at, best_at = np.concatenate(rows), np.concatenate(best)
    return rank[at], np.concatenate(near), n[best_at], rank[best_at]


def _join_shard(table: pa.Table) -> pa.Table:
    parts = [np.frombuffer(zlib.decompress(b.as_py()), np.int64).reshape(4, -1) for b in table.column("pairs")]
    columns = [pa.array(c, pa.int64()) for c in links(*np.concatenate(parts, axis=1))]
    return pa.table(columns, names=["row", "near", "best_n", "best"])


def neighbours(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``words`` (word, n; staged, all different) as (row, word, n), and their links.

    ``row`` is the place in code-point order; links are (row, n_near, best_n, best): the number
    of words one edit away, and the most frequent of them (ties: the smallest).
    """
    count = words.count()
    ranges, shards = count // RANGE_WORDS + 1, count // SHARD_WORDS + 1
    forward = _numbered(words, ranges, "variants-forward")
    placed = _global(forward).select(F.reverse("word").alias("key"), "word", "row", "n", F.col("path").alias("prefixes"))
    # The second numbering names its own columns row and path.
    placed = placed.withColumnRenamed("row", "place")
    backward = _numbered(placed, ranges, "variants-backward")
    whole = _global(backward).select("word", "place", "n", "prefixes", "path")
    dealt = whole.mapInArrow(_deal(shards), "shard bigint, pairs binary")
    found = dealt.groupBy("shard").applyInArrow(_join_shard, "row bigint, near bigint, best_n bigint, best bigint")
    best = F.max(F.struct("best_n", (-F.col("best")).alias("order")))
    linked = stage(
        found.groupBy("row")
        .agg(F.sum("near").alias("n_near"), best.alias("b"))
        .select("row", "n_near", F.col("b.best_n").alias("best_n"), (-F.col("b.order")).alias("best")),
        "variants-links",
    )
    listed = stage(backward.select(F.col("place").alias("row"), "word", "n"), "variants-words")
    unstage(words.sparkSession, forward, backward)
    return listed, linked


def _roots(forms: DataFrame) -> DataFrame:
    """(row, form, root) of the rows that have a form.

    A form has a multiple of its variant's occurrences, so chains are no longer than the
    digits of a count; each round doubles how far they are followed.
    """
    current = stage(forms.select("row", "form", F.col("form").alias("root")), "variants-roots")
    while True:
        on = current.select(F.col("row").alias("root"), F.col("root").alias("_further"))
        if current.join(on, "root", "left_semi").isEmpty():
            return current
        moved = stage(
            current.join(on, "root", "left").select("row", "form", F.coalesce("_further", "root").alias("root")),
            "variants-roots",
        )
        unstage(forms.sparkSession, current)
        current = moved


def group_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Null and empty texts have no words, repeated rows count each, a null id is hashed as
    ``null``, other columns are ignored, an empty table gives an empty result. Words of any
    length are kept whole.
    """
    words = stage(word_counts(docs, id_col, text_col), "variants-counts")
    listed, linked = neighbours(words)
    known = listed.join(linked, "row", "left")
    formed: Column = F.col("best_n") >= ratio * F.col("n")
    forms = known.where(formed).select("row", F.col("best").alias("form"))
    rooted = _roots(forms)
    name = lambda c: listed.select(F.col("row").alias(f"_{c}"), F.col("word").alias(c))
    named = (
        rooted.select("row", F.col("form").alias("_form"), F.col("root").alias("_root"))
        .join(name("form"), "_form")
        .join(name("root"), "_root")
        .select("row", "form", "root")
    )
    unstage(docs.sparkSession, words)
    return known.join(named, "row", "left").select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"),
    )
