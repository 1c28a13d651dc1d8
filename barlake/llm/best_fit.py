"""Best-fit packing of token sequences by a configuration linear program.

Whole documents of at most ``width`` tokens and the pieces of longer ones are counted by
length: a table of at most ``width`` rows, however large the corpus is. A configuration
is a multiset of lengths that fits one sequence. The program

    minimise sum x_c   with   sum_c n_c(l) x_c >= count(l) for every length l

is solved by multiplicative weights: lengths that are covered too little gain weight, a
knapsack dynamic program over the weights prices the next configuration. The fractional
solution is rounded down, and what is left is priced once more by the knapsack program, one
whole configuration after the other. That plan is a table of ranges "the n-th to
m-th piece of length l lie at offset o of the sequences from s on", by which Spark
places the pieces.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from barlake.llm.common import arrow_rows
from barlake.runtime import stage

WIDTH, END_ID = 1024, 2
#: Whole texts in one Arrow batch.
BATCH_ROWS = 1000
#: Fixed value: the pattern by which a byte-level vocabulary cuts texts before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class _Encoder:
    """Token ids of texts by a ``tokenizers`` file of a byte-level BPE.

    The file's vocabulary is in merge order, so its ids are merge ranks, and ``tiktoken``
    finds the same ids from them in a third of the time. Texts that hold the string of a
    special token go to ``tokenizers`` itself, as do those on which ``tiktoken``'s pattern
    gives up (a million white-space characters in a row).
    """

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as file:
            described = json.load(file)
        # Printable Latin-1 characters stand for their own bytes, later ones for the rest.
        later = iter(range(256, 512))
        byte_of = {(chr(b) if chr(b).isprintable() and b != 32 else chr(next(later))): b for b in range(256)}
        self.special = [t["content"] for t in described["added_tokens"]]
        vocab = described["model"]["vocab"].items()
        ranks = {bytes(map(byte_of.__getitem__, t)): n for t, n in vocab if t not in self.special}
        self.fast = tiktoken.Encoding("ids", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.path, self.whole = vocabulary, None

    def _by_file(self, text: str) -> list[int]:
        self.whole = self.whole or Tokenizer.from_file(self.path)
        return self.whole.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            ids = self._by_file(text)
        else:
            try:
                ids = self.fast.encode_to_numpy(text, disallowed_special=())
            except ValueError as error:
                if "Max stack size exceeded" not in str(error):
                    raise
                ids = self._by_file(text)
        return np.asarray(ids, dtype="<u4").tobytes()


def cut(length: int, width: int = WIDTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first of several may be shorter."""
    if length <= width:
        return [(0, length)]
    first = length % width
    starts = ([0] if first else []) + list(range(first, length, width))
    return [(s, (first if first and s == 0 else width)) for s in starts]


_PIECES = T.StructType(
    [
        T.StructField("_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def token_pieces(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of every document; an empty or null text is the end token alone."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _Encoder(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                for n, (start, length) in enumerate(cut(len(ids) // 4, width)):
                    piece = ids[4 * start : 4 * (start + length)]
                    rows.append((doc, n, start, length, zlib.crc32(piece)))
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=_PIECES.names
            )

    chosen = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string"))
    return chosen.mapInArrow(run, _PIECES)


# ---- the plan over lengths -------------------------------------------------------


def _best_configuration(weights: dict[int, float], width: int) -> Counter:
    """Knapsack with repeats: the multiset of lengths with the largest weight."""
    lengths = np.array(sorted(weights))
    worth = np.array([weights[n] for n in lengths])
    best = np.zeros(width + 1)
    pick = np.full(width + 1, -1)
    for room in range(1, width + 1):
        best[room], pick[room] = best[room - 1], -1
        n = int(np.searchsorted(lengths, room, "right"))
        if n:
            value = best[room - lengths[:n]] + worth[:n]
            i = int(value.argmax())
            if value[i] > best[room]:
                best[room], pick[room] = value[i], i
    out: Counter = Counter()
    room = width
    while room > 0:
        if pick[room] < 0:
            room -= 1
        else:
            out[int(lengths[pick[room]])] += 1
            room -= int(lengths[pick[room]])
    return out


def solve(
    counts: dict[int, int], width: int = WIDTH, rounds: int = 300, step: float = 0.3, slack: float = 5e-4
) -> list[tuple[Counter, float]]:
    """Configurations with fractional multiplicities that cover ``counts``.

    Ends early once the cover is within ``slack`` of the tokens' own room, a lower bound.
    """
    demand = {n: c for n, c in counts.items() if 0 < n <= width and c > 0}
    if not demand:
        return []
    lengths = sorted(demand)
    need = np.array([float(demand[n]) for n in lengths])
    bound = sum(n * c for n, c in demand.items()) / width
    log_weight = np.log(np.array(lengths, dtype=float) * need)
    covered = np.zeros(len(lengths))
    used: dict[tuple, float] = {}
    for n in range(rounds):
        weight = np.exp(log_weight - log_weight.max()) + 1e-12
        config = _best_configuration(dict(zip(lengths, weight / need)), width)
        amounts = np.array([config.get(n, 0) for n in lengths], dtype=float)
        full = amounts > 0
        # as often as the scarcest of its lengths allows: that constraint is then met once
        times = float((need[full] / amounts[full]).min())
        key = tuple(sorted(config.items()))
        used[key] = used.get(key, 0.0) + times
        gained = amounts * times / need
        covered += gained
        log_weight -= step * gained
        if n % 20 == 19 and covered.min() > 0 and sum(used.values()) / covered.min() < bound * (1 + slack):
            break
    # Partly covered lengths are left to the rounding, so scale by what is typical.
    scale = 1.0 / max(1.0, float(np.quantile(covered, 0.9)))
    return [(Counter(dict(k)), v * scale) for k, v in used.items()]


def lower_bound(counts: dict[int, int], width: int = WIDTH) -> int:
    """Sequences that any packing needs: by room, and for pieces of which no two fit together."""
    room = -(-sum(n * c for n, c in counts.items()) // width)
    return max(room, sum(c for n, c in counts.items() if 2 * n > width))


def _fill_table(lengths: np.ndarray, width: int) -> np.ndarray:
    """The most tokens that lengths (each as often as wanted) put into each room up to ``width``."""
    best = np.zeros(width + 1, np.int64)
    for room in range(1, width + 1):
        fits = lengths[: int(np.searchsorted(lengths, room, "right"))]
        best[room] = max(best[room - 1], (best[room - fits] + fits).max(initial=0))
    return best


def round_up(counts: dict[int, int], width: int = WIDTH) -> list[tuple[Counter, int]]:
    """Whole configurations for what rounding down has left.

    Prices are the program's where its bound by room is met: a length's worth is its tokens,
    so every full sequence is as good. Each configuration starts with the longest piece that
    is left and is filled along the knapsack table by the longest pieces that are still to be
    had; the table is made anew when those cannot reach its value any more.
    """
    lengths = np.array(sorted(n for n, c in counts.items() if c), dtype=np.int64)
    left = np.array([counts[n] for n in lengths.tolist()], dtype=np.int64)
    out: list[tuple[Counter, int]] = []
    best, fresh = _fill_table(lengths, width), True
    while left.any():
        trial = left.copy()
        used: Counter = Counter()
        i, room = int(np.flatnonzero(left)[-1]), width
        while i is not None:
            trial[i] -= 1
            used[i] += 1
            room -= int(lengths[i])
            i = None
            while room > 0 and i is None:
                n = int(np.searchsorted(lengths, room, "right"))
                good = np.flatnonzero((trial[:n] > 0) & (best[room - lengths[:n]] + lengths[:n] >= best[room]))
                if len(good):
                    i = int(good[-1])
                elif best[room] == best[room - 1] or fresh:
                    room -= 1
                else:
                    break
        if room > 0:
            best, fresh = _fill_table(lengths[left > 0], width), True
            continue
        fresh = False
        times = min(int(left[i]) // k for i, k in used.items())
        for i, k in used.items():
            left[i] -= k * times
        out.append((Counter({int(lengths[i]): k for i, k in used.items()}), times))
    return out


def plan_sequences(counts: dict[int, int], width: int = WIDTH, rounds: int = 300) -> list[tuple[Counter, int]]:
    """Configurations with whole multiplicities that hold exactly ``counts``.

    The fractional multiplicities are rounded down, and further where what is left would
    need more sequences than all pieces did; ``round_up`` holds the rest. Configurations of
    short pieces alone wait until no piece is over half a sequence: what is left of those
    needs short ones beside it.
    """
    left = {n: c for n, c in counts.items() if c}
    halves = any(2 * n > width for n in left)
    chosen: list[tuple[Counter, int]] = []
    spare = lower_bound(left, width)
    for config, amount in sorted(solve(counts, width, rounds), key=lambda c: -c[1]):
        times = min([int(amount), *(left[n] // k for n, k in config.items())])
        if halves and 2 * max(config) <= width:
            continue
        while times > 0:
            rest = left | {n: left[n] - k * times for n, k in config.items()}
            if times + lower_bound(rest, width) <= spare:
                chosen.append((config, times))
                left, spare = rest, spare - times
                break
            times //= 2
    return chosen + round_up(left, width)


def slots(plan: list[tuple[Counter, int]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """By length: (first rank, pieces per sequence, first sequence, offset of the first)."""
    taken: Counter = Counter()
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for config, times in plan:
        offset = 0
        for n, k in sorted(config.items(), reverse=True):
            out.setdefault(n, []).append((taken[n], k, sequence, offset))
            taken[n] += k * times
            offset += n * k
        sequence += times
    return out


_PLACED = T.StructType(
    [
        *[f for f in _PIECES.fields],
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)


def pack(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    end_id: int = END_ID,
    rounds: int = 300,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts give one piece, the end token. Repeated rows are packed as often
    as they occur. Other columns are ignored, an empty table gives an empty result.
    """
    pieces = token_pieces(docs, vocabulary, id_col, text_col, width, end_id)
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        cut_up = stage(pieces.withColumn("_task", F.spark_partition_id()), "pack-pieces")
    by_task = cut_up.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("n"))
    # At most `width` lengths reach the driver.
    counts = {r[0]: r[1] for r in by_task.groupBy("length").agg(F.sum("n")).collect()}
    table = slots(plan_sequences(counts, width, rounds))
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_task.select("length", "_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_task", "length").orderBy("_id", "piece", "start", "ids_crc32")
    ranked = (
        cut_up.join(starts, ["length", "_task"])
        .withColumn("_rank", F.col("_base") + F.row_number().over(inside) - 1)
        .select(*_PIECES.names, "_rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = {n: np.array(rows, dtype=np.int64) for n, rows in table.items()}
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                rows = arrays[int(n)]
                slot = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                inner = rank[at] - slot[:, 0]
                sequence[at] = slot[:, 2] + inner // slot[:, 1]
                offset[at] = slot[:, 3] + inner % slot[:, 1] * n
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in _PIECES.names], pa.array(sequence), pa.array(offset)],
                names=_PLACED.names,
            )

    return ranked.mapInArrow(place, _PLACED).withColumnRenamed("_id", id_col)
