"""Language-model scoring from a log-frequency Bloom filter.

Counts of single words and word pairs are quantised to levels 1 + floor(log_b c), and a
pair of level q enters the filter once for each level up to q. A reader probes level
after level until one is missing, so a count is found by repeated membership tests: a
false positive can only raise it, and seldom by more than one level.

    p1(w) = (c(w) + 1) / (N + V + 1)        p(w | h) = (c(h w) + k p1(w)) / (c(h) + k)

Texts are staged once as chunks of numbered words. Of each chunk the distinct keys go to
their hash ranges as packed arrays with their training counts; the number of ranges follows
the number of rows, and each range is merged on its own. The filter takes about
``BITS_PER_ENTRY`` bits an entry however many there are. One up to ``MAX_BYTES`` is
broadcast. A larger one stays in its ranges: a merged range still knows which of its keys
each chunk asks for, so its part of the filter is built and probed there, a key once for all
chunks, and only levels go back to the chunks. The scores are those of a broadcast filter of
that size. Word counts stay exact for the base score: the most frequent ``HEAD`` words are
broadcast, all others meet their counts in a shuffle join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import arrow_rows, in_fold, lower_words, mix, packed, record_batch, unpacked
from barlake.runtime import release, stage, staged_paths, unstage

BASE, HASHES, BITS_PER_ENTRY, MAX_BYTES = 1.5, 3, 10, 1 << 22
#: Bits of a key inside its range.
LOW_BITS = 40
#: Chunks or merged ranges of an Arrow batch.
ROWS = 8
_RANGE = ["shard", "words", "counts", "keys", "levels"]
HEAD, PRIOR = 150_000, 2_000.0
#: Tokens handled at once, words a worker remembers besides the head, rows of an Arrow batch of texts.
CHUNK, REMEMBERED, TEXTS = 1_000_000, 500_000, 1_000
END = b""
xxh64 = xxhash.xxh64_intdigest

_SALT = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _SALT[0] + (second ^ _SALT[1]))


def narrow(keys: np.ndarray, shards: int) -> np.ndarray:
    """Keys as they are entered and asked for: the bits that name the range and the lowest ``LOW_BITS``.

    Two of n keys fall together with probability n * n / (shards << LOW_BITS) / 2, and the
    number of ranges follows the input; what falls together adds up like any hash collision.
    """
    low = _low_bits(shards)
    top = shards.bit_length() - 1
    return keys & np.uint64(((1 << top) - 1) << (64 - top) | (1 << low) - 1)


def _low_bits(shards: int) -> int:
    return min(LOW_BITS, 64 - (shards.bit_length() - 1))


def pack_keys(keys: np.ndarray, shards: int) -> bytes:
    """Sorted narrow keys of one range: differences of their low bits."""
    low = keys & np.uint64((1 << _low_bits(shards)) - 1)
    return packed(np.diff(low, prepend=np.uint64(0)))


def unpack_keys(data: bytes, shard: int, shards: int) -> np.ndarray:
    top = shards.bit_length() - 1
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64) | np.uint64(shard << (64 - top) if top else 0)


def levels(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log_b c), safe at the borders."""
    return (1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9)).astype(np.uint8)


#: The expected count of each level; level 0 is an absent entry.
EXPECTED = np.array([0.0] + [(BASE ** (j - 1) + BASE**j - 1) / 2 for j in range(1, 120)])


class Filter:
    """Bit array in ``shards`` equal parts; the high bits of a key name its part."""

    def __init__(self, bits: np.ndarray, shards: int):
        self.bits = bits
        self.shift = np.uint64(64 - shards.bit_length() + 1)
        self.part_bits = len(bits) * 8 // shards
        self.one_part = shards == 1

    def _present(self, keys: np.ndarray, level: int, n: int) -> np.ndarray:
        at = place(keys, level, n, self.part_bits)
        if not self.one_part:
            at += (keys >> self.shift) * np.uint64(self.part_bits)
        byte = self.bits[at >> np.uint64(3)]
        return (byte >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)

    def level(self, keys: np.ndarray) -> np.ndarray:
        """The last level up to which every probe finds the key."""
        out = np.zeros(len(keys), np.uint8)
        live = np.arange(len(keys))
        for level in range(1, len(EXPECTED)):
            for n in range(HASHES):
                live = live[self._present(keys[live], level, n)]
            if not len(live):
                break
            out[live] = level
        return out


def place(keys: np.ndarray, level: int, n: int, part_bits: int) -> np.ndarray:
    """Bit of the n-th hash of (key, level) inside the key's part; part_bits is a power of 2."""
    salt = np.uint64((level * 8 + n + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    return mix(keys + salt) & np.uint64(part_bits - 1)


def filter_part(keys: np.ndarray, level: np.ndarray, part_bits: int) -> bytes:
    """One part of the filter with all levels of its keys entered."""
    flags = np.zeros(part_bits, bool)
    for j in range(1, int(level.max(initial=0)) + 1):
        there = keys[level >= j]
        for n in range(HASHES):
            flags[place(there, j, n, part_bits)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def word_hash(words: list[bytes]) -> np.ndarray:
    return np.array([xxh64(w) for w in words], dtype=np.uint64)


def word_key(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes + _SALT[2])


class _Index(dict):
    """Numbers words in the order they come up."""

    def __init__(self, words: list[bytes]):
        super().__init__(zip(words, range(len(words))))
        self.words = list(words)

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.words)
        self.words.append(word)
        return n


# ---- counting --------------------------------------------------------------------

_CHUNKS = "chunk long, ids array<long>, held array<boolean>, lengths binary, flat binary, words binary"
_PACKED = "shard int, chunk long, words binary, times binary, keys binary, counts binary"
_TABLE = (
    "shard int, words binary, counts binary, keys binary, levels binary,"
    " tokens long, types long, entries long, chunks array<long>, asked array<binary>"
)


def _chunks(texts: DataFrame) -> DataFrame:
    """Staged chunks of about ``CHUNK`` tokens: documents, their word numbers, the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _CHUNKS.split(", ")]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 3]
        first, n = TaskContext.get().partitionId() << 32, 0
        index, docs, ids, size = _Index([END]), [], [], 0

        def chunk() -> pa.RecordBatch:
            lengths = np.array([len(x) for x in ids], np.int64)
            flat = packed(np.concatenate(ids))
            row = (first + n, [d for d, _ in docs], [h for _, h in docs], lengths.tobytes(), flat, b" ".join(index.words))
            return record_batch([row], names, kinds)

        for batch in batches:
            for doc, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                docs.append((doc, held))
                ids.append(np.array([*map(index.__getitem__, lower_words(text.as_py())), 0], dtype=np.int32))
                size += len(ids[-1])
                if size >= CHUNK:
                    yield chunk()
                    index, docs, ids, size, n = _Index([END]), [], [], 0, n + 1
        if docs:
            yield chunk()

    with arrow_rows(texts.sparkSession, TEXTS):
        return stage(texts.mapInArrow(run, _CHUNKS), "lm-chunks")


def _chunk_keys(words: list[bytes], flat: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Filter keys by word number, and of the pair that ends at each token."""
    hashes = word_hash(words)
    # Every text ends with the end token, so the word before a text's first is that one too.
    pairs = pair_hash(hashes[np.concatenate([[0], flat[:-1]])], hashes[flat])
    return narrow(word_key(hashes), shards), narrow(pairs, shards)


def distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in order, by a sort: numpy's ``unique`` alone may build a hash table, many times slower."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def _places(own: np.ndarray, of_pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a chunk's word keys and pair keys among its distinct keys in order."""
    _, at = np.unique(np.concatenate([own, of_pair]), return_inverse=True)
    return at[: len(own)], at[len(own) :]


def _send_chunk(row: dict, shards: int) -> Iterator[tuple]:
    """What a chunk counts and asks for, by hash range: training words, and the keys of all its words and pairs."""
    top = shards.bit_length() - 1
    part = (lambda k: (k >> np.uint64(64 - top)).astype(np.int64)) if top else (lambda k: np.zeros(len(k), np.int64))
    words, flat = row["words"].split(b" "), unpacked(row["flat"], np.int32)
    lengths = np.frombuffer(row["lengths"], np.int64)
    train = np.repeat(~np.array(row["held"], dtype=bool), lengths)
    own, of_pair = _chunk_keys(words, flat, shards)
    counts = np.bincount(flat[train], minlength=len(words))
    seen = np.flatnonzero(counts)
    seen = seen[np.argsort(part(own[seen]), kind="stable")]
    word_ends = np.searchsorted(part(own[seen]), np.arange(shards + 1))
    pairs, times = np.unique(of_pair[train], return_counts=True)
    keys = distinct(np.concatenate([own, pairs, of_pair[~train]]))
    by_key = np.zeros(len(keys), np.int64)
    by_key[np.searchsorted(keys, pairs)] = times
    key_ends = np.searchsorted(part(keys), np.arange(shards + 1))
    for shard in np.flatnonzero(np.diff(key_ends)).tolist():  # a word's key is among its range's keys
        mine = seen[word_ends[shard] : word_ends[shard + 1]]
        at = slice(key_ends[shard], key_ends[shard + 1])
        named, often = b" ".join([words[i] for i in mine]), packed(counts[mine])
        yield shard, row["chunk"], named, often, pack_keys(keys[at], shards), packed(by_key[at])


def _merge(table: pa.Table, shards: int) -> pa.Table:
    """One hash range: exact word counts, its keys with the levels of pairs, which keys each chunk asks for."""
    shard = table["shard"][0].as_py()
    totals: dict[bytes, int] = {}
    keys, counts = [], []
    for words, often, own, times in zip(*(table[c] for c in ("words", "times", "keys", "counts"))):
        for word, n in zip(words.as_py().split(b" "), unpacked(often.as_py(), np.int64).tolist()):
            totals[word] = totals.get(word, 0) + n
        keys.append(unpack_keys(own.as_py(), shard, shards))
        counts.append(unpacked(times.as_py(), np.int64))
    every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    pair_counts = np.bincount(inverse, np.concatenate(counts), len(every))
    level = np.zeros(len(every), np.uint8)
    level[pair_counts > 0] = levels(pair_counts[pair_counts > 0])
    own = np.array(list(totals.values()), dtype=np.int64)
    asked = np.split(inverse.astype(np.uint32), np.cumsum([len(k) for k in keys])[:-1])
    out = {
        "shard": [shard],
        "words": [b" ".join(totals)],
        "counts": [own.tobytes()],
        "keys": [pack_keys(every, shards)],
        "levels": [packed(level)],
        "tokens": [int(own.sum())],
        "types": [len(own)],
        "entries": [int(level.sum(dtype=np.int64) + levels(own).sum(dtype=np.int64))],
        "chunks": [table["chunk"].to_pylist()],
        "asked": [[packed(np.diff(x, prepend=np.uint32(0))) for x in asked]],
    }
    kinds = [pa.int32(), *[pa.binary()] * 4, *[pa.int64()] * 3, pa.list_(pa.int64()), pa.list_(pa.binary())]
    return pa.table({n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds)})


def count_ngrams(chunks: DataFrame, shards: int) -> DataFrame:
    """Staged counts of words and levels of pairs, a row for each hash range, with what the chunks ask for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _PACKED.split(", ")]
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
        for batch in batches:
            for n in range(batch.num_rows):
                yield record_batch(list(_send_chunk(batch.slice(n, 1).to_pylist()[0], shards)), names, kinds)

    with arrow_rows(chunks.sparkSession, ROWS):
        sent = chunks.mapInArrow(run, _PACKED).groupBy("shard")
        return stage(sent.applyInArrow(lambda t: _merge(t, shards), _TABLE), "lm-counts")


def _entered(row: dict, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All keys of a merged range; the keys that its filter part holds, and their levels."""
    every, level = unpack_keys(row["keys"], row["shard"], shards), unpacked(row["levels"], np.uint8)
    words = row["words"].split(b" ") if row["counts"] else []
    own = narrow(word_key(word_hash(words)), shards)
    there = np.flatnonzero(level)
    entered = np.concatenate([own, every[there]])
    return every, entered, np.concatenate([levels(np.frombuffer(row["counts"], np.int64)), level[there]])


def filter_part_bits(shards: int, entries: int) -> int:
    """Bits of each part of the filter, a power of 2 that follows the entries."""
    wanted = max(1024, BITS_PER_ENTRY * entries // shards)
    return 1 << (wanted - 1).bit_length()


def build_filter(table: DataFrame, shards: int, part_bits: int) -> Filter:
    """The filter, built by range and put together on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["shard"], filter_part(*_entered(r, shards)[1:], part_bits)) for r in batch.to_pylist()]
            yield record_batch(rows, ["shard", "bits"], [pa.int32(), pa.binary()])

    bits = np.zeros(shards * part_bits // 8, np.uint8)
    for row in table.select(*_RANGE).mapInArrow(run, "shard int, bits binary").toLocalIterator():
        at = row["shard"] * part_bits // 8
        bits[at : at + part_bits // 8] = np.frombuffer(row["bits"], np.uint8)
    return Filter(bits, shards)


def word_counts(table: DataFrame) -> DataFrame:
    """Staged exact counts (word, c)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = row["words"].split(b" ") if row["counts"] else []
                counts = np.frombuffer(row["counts"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts)], names=["word", "c"])

    return stage(table.select("words", "counts").mapInArrow(run, "word binary, c long"), "lm-words")


def frequent_words(counts: DataFrame, head: int) -> tuple[list[bytes], np.ndarray, int]:
    """The most frequent words, at most ``head``, their counts, and the least count among them."""
    bin_of = F.floor(F.log(F.col("c").cast("double")) / math.log(1.02))
    left, least = head, 1 << 62
    for row in sorted(counts.groupBy(bin_of.alias("b")).agg(F.count("*").alias("n"), F.min("c").alias("c")).collect(), reverse=True):
        if row["n"] > left:
            break
        left, least = left - row["n"], row["c"]
    rows = counts.where(F.col("c") >= least).toArrow()
    return rows["word"].to_pylist(), rows["c"].to_numpy(), least


# ---- scoring ---------------------------------------------------------------------

_SCORED = (
    "_id long, held_out boolean, n_tokens long, head_log double, head_known long,"
    " score double, tail array<binary>, times array<int>"
)


def _score_rows(
    docs: list[tuple],
    ids: list[np.ndarray],
    head_at: np.ndarray,
    head_log_count: np.ndarray,
    words: list[bytes],
    counts: np.ndarray,
    pairs: np.ndarray,
    end: int,
    total: float,
    prior: float,
) -> list[tuple]:
    """Rows of documents, given (id, held_out) and the numbers of their words.

    By token: place in the head (or -1) and estimated count of the pair; by word number:
    the word and its estimated count.
    """
    flat = np.concatenate(ids)
    starts = np.cumsum([0] + [len(x) for x in ids[:-1]])
    context = counts[np.concatenate([[end], flat[:-1]])]
    single = (counts[flat] + 1.0) / total
    logs = np.log10((np.minimum(pairs, context) + prior * single) / (context + prior))
    scores = np.add.reduceat(logs, starts)
    in_head = head_at >= 0
    head_logs = np.zeros(len(flat))
    head_logs[in_head] = head_log_count[head_at[in_head]]
    head_log = np.add.reduceat(head_logs, starts)
    known = np.add.reduceat(in_head.astype(np.int64), starts)
    doc_of = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    rare, times = np.unique(doc_of[~in_head] * len(words) + flat[~in_head], return_counts=True)
    ends = np.searchsorted(rare, np.arange(len(ids) + 1) * len(words)).tolist()
    tail, times = [words[i] for i in (rare % len(words)).tolist()], times.tolist()
    out = []
    for n, (doc, held) in enumerate(docs):
        at = slice(ends[n], ends[n + 1])
        out.append((doc, held, len(ids[n]), head_log[n], known[n], scores[n], tail[at], times[at]))
    return out


class _Scorer:
    def __init__(
        self, bits: Filter, shards: int, head: list[bytes], head_counts: np.ndarray, total: float, prior: float
    ):
        self.filter, self.shards, self.head, self.total, self.prior = bits, shards, head, total, prior
        self.log_count = np.log10(head_counts + 1.0)
        self.fresh()

    def fresh(self) -> None:
        self.index = _Index(self.head)
        self.hashes = self.counts = np.zeros(0)
        self.known = 0

    def extend(self) -> None:
        """Hashes and estimated counts of words that came up since the last chunk."""
        new = word_hash(self.index.words[self.known :])
        found = EXPECTED[self.filter.level(narrow(word_key(new), self.shards))]
        self.hashes = np.concatenate([self.hashes, new]) if self.known else new
        self.counts = np.concatenate([self.counts, found]) if self.known else found
        self.known = len(self.hashes)

    def score(self, docs: list[tuple]) -> list[tuple]:
        end = self.index[END]
        ids = [np.array([*map(self.index.__getitem__, lower_words(t)), end], dtype=np.int64) for _, _, t in docs]
        self.extend()
        flat = np.concatenate(ids)
        before = np.concatenate([[end], flat[:-1]])
        keys = narrow(pair_hash(self.hashes[before], self.hashes[flat]), self.shards)
        pairs = EXPECTED[self.filter.level(keys)]
        out = _score_rows(
            [d[:2] for d in docs],
            ids,
            np.where(flat < len(self.head), flat, -1),
            self.log_count,
            self.index.words,
            self.counts,
            pairs,
            end,
            self.total,
            self.prior,
        )
        if len(self.index) > len(self.head) + REMEMBERED:
            self.fresh()
        return out


# ---- scoring with a filter that is not broadcast ---------------------------------


def _asked_levels(table: DataFrame, shards: int, part_bits: int) -> DataFrame:
    """(chunk, shard, levels): answers to a chunk's distinct keys, in key order inside a range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["chunk", "shard", "levels"], [pa.int64(), pa.int32(), pa.binary()]
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                every, *entered = _entered(row, shards)
                found = Filter(np.frombuffer(filter_part(*entered, part_bits), np.uint8), 1).level(every)
                told = [found[np.cumsum(unpacked(x, np.uint32), dtype=np.uint32)] for x in row["asked"]]
                rows = [(chunk, row["shard"], packed(x)) for chunk, x in zip(row["chunks"], told)]
                yield record_batch(rows, names, kinds)

    with arrow_rows(table.sparkSession, ROWS):
        asked = table.select(*_RANGE, "chunks", "asked")
        return stage(asked.mapInArrow(run, "chunk long, shard int, levels binary"), "lm-answers")


#: The head a worker met last, and the places of its words.
_met: list = [None, {}]


def _places_of(head: list[bytes]) -> dict[bytes, int]:
    if _met[0] is not head:
        _met[:] = head, {w: n for n, w in enumerate(head)}
    return _met[1]


def _score_chunks(chunks: DataFrame, answers: DataFrame, shards: int, carried, total: float, prior: float) -> DataFrame:
    """Scored rows as of ``_Scorer``, the filter's parts probed where they lie."""
    names = [part.split()[0] for part in _SCORED.split(", ")]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32())]

    def finish(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        _, head, head_counts = carried.value
        row = chunk.to_pylist()[0]
        words, flat = row["words"].split(b" "), unpacked(row["flat"], np.int32)
        own_at, pair_at = _places(*_chunk_keys(words, flat, shards))
        # Ranges are the high bits of a key, so answers in range order are in key order.
        told = sorted(zip(answers["shard"].to_pylist(), answers["levels"].to_pylist()))
        found = EXPECTED[np.concatenate([unpacked(x, np.uint8) for _, x in told])]
        place_of = _places_of(head)
        head_at = np.array([place_of.get(w, -1) for w in words], dtype=np.int64)
        ids = np.split(flat, np.cumsum(np.frombuffer(row["lengths"], np.int64))[:-1])
        rows = _score_rows(
            list(zip(row["ids"], row["held"])),
            ids,
            head_at[flat],
            np.log10(head_counts + 1.0),
            words,
            found[own_at],
            found[pair_at],
            0,
            total,
            prior,
        )
        return pa.Table.from_batches([record_batch(rows, names, kinds)])

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, _SCORED)


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 7,
    held_fold: int = 2,
    head: int = HEAD,
    prior: float = PRIOR,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A filter over ``max_bytes`` is probed by range instead of broadcast, with the same
    scores. Null texts are empty: one end token. Repeated rows are scored each for itself; a null
    id is in the training fold or not as the text "null" is. Without training texts every
    probability is 1 and the scores are 0. Other columns are ignored, an empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        in_fold(id_col, folds, held_fold).alias("held_out"),
        F.col(text_col).cast("string").cast("binary").alias("text"),
    )
    earlier = staged_paths(spark)
    shards = 1 << max(4, (docs.count() // 1000).bit_length())
    chunks = _chunks(texts)
    table = count_ngrams(chunks, shards)
    tokens, types, entries = table.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "types", "entries")]).first()
    counts = word_counts(table)
    words, times, least = frequent_words(counts, head)
    total = float(tokens + types + 1)
    part_bits = filter_part_bits(shards, entries)
    fits = shards * part_bits <= max_bytes * 8
    held_bits = build_filter(table, shards, part_bits).bits if fits else None
    carried = spark.sparkContext.broadcast((held_bits, words, times))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32())]
        names = [part.split()[0] for part in _SCORED.split(", ")]
        held, words, times = carried.value
        scorer = _Scorer(Filter(held, shards), shards, words, times, total, prior)
        for batch in batches:
            docs, size = [], 0
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = row[2].as_py()
                docs.append((row[0], row[1], text))
                size += len(text or b"")
                if size >= 6 * CHUNK:
                    yield record_batch(scorer.score(docs), names, kinds)
                    docs, size = [], 0
            if docs:
                yield record_batch(scorer.score(docs), names, kinds)

    if fits:
        unstage(spark, chunks, table)
        rows = texts.mapInArrow(run, _SCORED)
    else:
        answers = _asked_levels(table, shards, part_bits)
        unstage(spark, table)
        rows = _score_chunks(chunks, answers, shards, carried, total, prior)
    with arrow_rows(spark, TEXTS):
        scored = stage(rows.withColumn("_row", F.monotonically_increasing_id()), "lm-scored")
    carried.destroy()
    rare = scored.select("_row", F.explode(F.arrays_zip("tail", "times")).alias("t")).select(
        "_row", F.col("t.tail").alias("word"), F.col("t.times").alias("times")
    )
    met = rare.join(counts.where(F.col("c") < least), "word")
    sums = met.groupBy("_row").agg(
        F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("tail_log"), F.sum("times").alias("tail_known")
    )
    none = F.lit(0)
    result = scored.join(sums, "_row", "left").select(
        F.col("_id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", none)).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (
            F.col("head_log") + F.coalesce("tail_log", none.cast("double")) - F.col("n_tokens") * math.log10(total)
        ).alias("base_score"),
        "score",
    )
    release(spark, staged_paths(spark) - earlier, result)
    return result
