"""Filter interaction audit by truth-table survival words.

Five filters have 32 subsets. A document that fails the filters in mask ``f`` survives
exactly the subsets disjoint from ``f``: bit ``S`` of its 32-bit survival word is set where
``S & f`` is 0. The number of words with bit ``S`` set is the number of survivors of subset
``S``, so one positional popcount per part and label answers every order of the filters.
Words are counted by carry-save adders: three words become a sum word and a carry word of
twice the weight, 32 counters at a time, until few words a weight are left.

A filter removes at a step what survives the filters before it and not those with it;
redundant rows, unique failures, label losses and the sums over all orders are differences
of the same 32 counts. Only those counts, at most ``3 * 32`` a part and task, are shuffled
for the audit; documents are shuffled as ids, digests and masks, never as texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import text_of
from barlake.llm.exact_dedup import frequent_digests
from barlake.runtime import stage

#: The filters and their limits.
LETTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 200, 50, 3
MARKS = b"#$%&*|"

SUBSETS = 1 << len(LETTERS)
#: Rows counted: all, those labelled good, those labelled toxic.
LABELS = ("all", "good", "toxic")
#: The survival word of each mask of failed filters.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & f) for f in range(SUBSETS)], np.uint32)
_UPPER = bytes(range(65, 91))
_BLANKS = re.compile(rb"[^\x20\x09-\x0D]+")
#: Texts beyond this many bytes are cut into words one at a time.
LONG = 1 << 22


# ---- one document ----------------------------------------------------------------


def own_failures(text: bytes) -> int:
    """Mask of the filters A to D that a UTF-8 text fails."""
    if len(text) > LONG:
        distinct, words = set(), 0
        for m in _BLANKS.finditer(text):
            words += 1
            distinct.add(m.group())
    else:
        parts = text.split()
        words, distinct = len(parts), set(parts)
    upper = len(text) - len(text.translate(None, _UPPER))
    points = int((np.frombuffer(text, np.int8) > -65).sum())
    return (
        (words < LEAST_WORDS)
        | (100 * len(distinct) < DISTINCT_PERCENT * words) << 1
        | (100 * upper > UPPER_PERCENT * points) << 2
        | (len(text.translate(None, MARKS)) < len(text)) << 3
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2).cast(pa.large_binary())
        masks, digests = [], []
        for value in texts:
            text = value.as_py()
            masks.append(own_failures(text))
            digests.append(hashlib.sha256(text).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(digests, pa.string()), pa.array(masks, pa.int32())],
            names=["_id", "part", "text_sha256", "mask"],
        )


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(_id, part, mask) per row of ``docs``; bit n of the mask is the n-th filter.

    Null texts are empty, a null part is the empty string. A row fails E if a smaller id has
    the same text; a null id is not smaller than any id and no id is smaller than it.

    Digests of many rows (at most 1,000, by a summary of fixed size) meet their least id by
    a broadcast, the others by a shuffle in which no digest is frequent.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text_of(text_col).alias("_text"),
    )
    kind = rows.schema["_id"].dataType.simpleString()
    rows = stage(
        rows.mapInArrow(_measure, f"_id {kind}, part string, text_sha256 string, mask int"), "audit-masks"
    )
    named = frequent_digests(rows)
    least = F.min("_id").alias("_least")
    hot = stage(
        rows.join(F.broadcast(named), "text_sha256").groupBy("text_sha256").agg(least), "audit-frequent"
    )
    settled = rows.join(F.broadcast(hot), "text_sha256")
    rest = rows.join(F.broadcast(hot.select("text_sha256")), "text_sha256", "left_anti")
    copied = rest.groupBy("text_sha256").agg(least, F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    marked = settled.unionByName(rest.join(copied, "text_sha256", "left"))
    repeated = F.coalesce(F.col("_id") > F.col("_least"), F.lit(False))
    return marked.select("_id", "part", F.expr("mask").bitwiseOR(F.when(repeated, 16).otherwise(0)).alias("mask"))


# ---- counting --------------------------------------------------------------------


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of ``words`` have each of the 32 bits set, by carry-save adders."""
    counts = np.zeros(32, np.int64)
    bits = np.arange(32, dtype=np.uint32)
    weight, level = 1, words.astype(np.uint32, copy=False)
    while len(level):
        carries = []
        while len(level) > 2:
            third = len(level) // 3
            a, b, c = level[:third], level[third : 2 * third], level[2 * third : 3 * third]
            odd = a ^ b
            carries.append((a & b) | (odd & c))
            level = np.concatenate([odd ^ c, level[3 * third :]])
        for word in level:
            counts += weight * ((word >> bits) & np.uint32(1)).astype(np.int64)
        level = np.concatenate(carries) if carries else level[:0]
        weight *= 2
    return counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, label, counts) of the rows (part, mask, good, toxic) of a task."""
    for batch in batches:
        coded = batch.column(0).dictionary_encode()
        words = WORDS[batch.column(1).to_numpy(zero_copy_only=False)]
        codes = coded.indices.to_numpy(zero_copy_only=False)
        chosen = [np.ones(len(words), bool)]
        chosen += [batch.column(n).to_numpy(zero_copy_only=False).astype(bool) for n in (2, 3)]
        order = np.argsort(codes, kind="stable")
        ends = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
        parts, labels, counts = [], [], []
        for code, part in enumerate(coded.dictionary.to_pylist()):
            own = order[ends[code] : ends[code + 1]]
            for label, rows in zip(LABELS, chosen):
                parts.append(part)
                labels.append(label)
                counts.append(positional_popcount(words[own[rows[own]]]))
        flat = pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64))
        offsets = pa.array(np.arange(len(parts) + 1, dtype=np.int32) * 32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.string()), pa.array(labels, pa.string()), pa.ListArray.from_arrays(offsets, flat)],
            names=["part", "label", "counts"],
        )


def survivors(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """(part, label, subset, survivors): rows that pass every filter of each subset.

    ``label`` is all, good (some label of the id has quality 1) or toxic (some label of
    the id has toxic 1). Rows that repeat an id count each.
    """
    marked = failures(docs, id_col, text_col, part_col)
    told = (
        labels.where(F.col(id_col).isNotNull() & ((F.col("quality") == 1) | (F.col("toxic") == 1)))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(*[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(n) for c, n in (("quality", "_good"), ("toxic", "_toxic"))])
    )
    flags = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("_good", "_toxic")]
    words = marked.join(told, "_id", "left").select("part", "mask", *flags)
    counted = words.mapInArrow(_count, "part string, label string, counts array<bigint>")
    return (
        counted.select("part", "label", F.posexplode("counts").alias("subset", "n"))
        .groupBy("part", "label", "subset")
        .agg(F.sum("n").alias("survivors"))
    )


# ---- orders ----------------------------------------------------------------------


def _orders(rows: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> list[tuple]:
    """The audit of one part from the survivors of each subset."""
    every = SUBSETS - 1
    fails = [int(rows[0] - rows[1 << f]) for f in range(len(LETTERS))]
    unique = [int(rows[every & ~(1 << f)] - rows[every]) for f in range(len(LETTERS))]
    out, total = [], [0] * len(LETTERS)
    for order in permutations(range(len(LETTERS))):
        name, before = "".join(LETTERS[f] for f in order), 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            removed = int(rows[before] - rows[after])
            total[f] += removed
            lost = [int(n[before] - n[after]) for n in (good, toxic)]
            out.append((name, step, int(rows[after]), removed, fails[f] - removed, unique[f], *lost, f))
            before = after
    return [(*row[:-1], total[row[-1]]) for row in out]


_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, *counts in zip(*[column.to_pylist() for column in batch.columns]):
            rows = list(zip(*_orders(*[np.array(c, np.int64) for c in counts])))
            columns = [pa.array([part] * len(rows[0]), pa.string()), pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int32())]
            columns += [pa.array(column, pa.int64()) for column in rows[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *_COUNTS])


def audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    An empty table has no parts and gives an empty result; without labels the label losses
    are 0. Other columns are ignored.
    """
    counts = survivors(docs, labels, id_col, text_col, part_col)
    sums = [
        F.sum(F.when((F.col("label") == label) & (F.col("subset") == s), F.col("survivors")).otherwise(0)).alias(f"{label}{s}")
        for label in LABELS
        for s in range(SUBSETS)
    ]
    by_part = counts.groupBy("part").agg(*sums)
    arrays = [F.array(*[F.col(f"{label}{s}") for s in range(SUBSETS)]).alias(label) for label in LABELS]
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in _COUNTS)
    return by_part.select("part", *arrays).mapInArrow(_audit, schema)
