"""Removal of long byte strings that an earlier document holds, by a run-length index.

A 50-byte string is removed from a document where a document with a smaller id holds it
too, wherever it starts there. Steps:

1. Equal texts are one class under their smallest id. A class's 50-byte windows are cut
   into stretches that share a minimizer, so equal windows always lie in stretches of the
   same minimizer. Minimizers that only one class has are left out (a packed exchange by
   hash range finds them); the rest of the stretches are dealt out by minimizer.
2. A task holds the distinct stretches of a range of minimizers. It builds their
   Burrows-Wheeler transform, run-compressed, with the suffix positions sampled at run
   ends: for a run's first row its own position, the position before it in suffix order,
   and the length they share. Streaming over the text then gives every position's
   matching statistics from the last sample: inside a run, moving on one byte shortens
   the match by one and moves its partner on by one.
3. Positions whose match is 50 bytes or longer are chained to their partners; the chain's
   smallest id decides for all its members. Marked windows return to their documents,
   where overlapping ones are joined and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import arrow_rows, mix, record_batch
from barlake.runtime import stage

#: Fixed value of the contract: bytes of a repeated string.
LENGTH = 50
#: Bytes of a minimizer, so many that common words do not fill it; windows that are hashed at once, bytes that are sent at once.
GRAM, BLOCK, CHUNK = 24, 1 << 18, 4_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_PLACE = np.uint64((1 << 24) - 1)
NO_ID = (1 << 63) - 1
#: The lowest bit in which eight bytes differ is below the first of these that it is under.
_WHOLE_BYTES = np.uint64(1) << np.arange(8, 64, 8, dtype=np.uint64)
#: Texts of an Arrow batch.
BATCH_ROWS = 1_000
#: Partly covered stretches that are looked through at once.
MIXED = 200_000


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from every position on: of 16 by doubling, then 8 more."""

    def joined(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
        right = right[size:]
        return left[: len(right)] * _STEP + (right ^ (right >> np.uint64(29)))

    h2 = joined(_BYTE[data], _BYTE[data], 1)
    h4 = joined(h2, h2, 2)
    h8 = joined(h4, h4, 4)
    return mix(joined(joined(h8, h8, 8), h8, 16))


def stretches(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, minimizer hash) of every stretch of the joined texts.

    Windows lie inside one text. The minimizer is the least hash of a window, the first of
    equal ones, which depends on the window's bytes alone. Bytes are hashed in blocks of
    ``BLOCK`` windows; a stretch over a border comes in two parts.
    """
    found = [
        _block_stretches(data[lo : lo + BLOCK + LENGTH - 1], ends - lo, lo)
        for lo in range(0, max(1, len(data) - LENGTH + 1), BLOCK)
    ]
    return tuple(map(np.concatenate, zip(*found)))


def _block_stretches(data: np.ndarray, ends: np.ndarray, offset: int) -> tuple[np.ndarray, ...]:
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    if len(data) < LENGTH:
        return none
    hashes = gram_hashes(data)
    width = LENGTH - GRAM + 1
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    count = len(data) - LENGTH + 1
    least = np.minimum(least[:count], least[width - size : width - size + count])
    at = (least & _PLACE).astype(np.int64)
    start = np.arange(count)
    text = np.searchsorted(ends, start, "right")
    inside = start + LENGTH <= ends[np.minimum(text, len(ends) - 1)]
    start, text, at = start[inside], text[inside], at[inside]
    if not len(start):
        return none
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return text[first], start[first] + offset, np.diff(np.append(first, len(start))), hashes[at[first]]


def _joined(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts in groups of about ``CHUNK`` bytes: (first text, bytes, ends)."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= CHUNK):
            size += len(texts[end])
            end += 1
        yield at, np.frombuffer(b"".join(texts[at:end]), np.uint8), np.cumsum([len(t) for t in texts[at:end]])
        at = end


# ---- run-length index ------------------------------------------------------------


class RunIndex:
    """Run-compressed BWT of texts (each at least one byte), sampled at run ends.

    ``sample``, ``partner`` and ``shared`` hold, in text order, the position of each run's
    first row, the position of the row before it, and the length the two suffixes share.
    """

    def __init__(self, texts: list[bytes]):
        joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        lengths = np.array([len(t) for t in texts])
        stops = np.cumsum(lengths + 1) - 1
        symbols = joined.astype(np.int64) + 1
        symbols[stops] = 0  # text ends, smaller than any byte; equal ones in text order
        self.size = len(symbols)
        self.to_stop = np.repeat(stops, lengths + 1) - np.arange(self.size)
        order = self._suffix_order(symbols)
        before = symbols[order - 1]
        edge = np.ones(self.size, bool)
        edge[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        heads = np.flatnonzero(edge)
        self.run_symbols, self.run_lengths = before[heads], np.diff(np.append(heads, self.size))
        own, other = order[heads], order[np.maximum(heads - 1, 0)]
        shared = self._shared(joined, own, other)
        shared[heads == 0] = 0
        by_text = np.argsort(own)
        self.sample, self.partner, self.shared = own[by_text], other[by_text], shared[by_text]

    def _suffix_order(self, symbols: np.ndarray) -> np.ndarray:
        """Suffixes up to their text's end in order, by doubling.

        A key packs the ranks of two halves with the position, so that plain sorting of
        numbers sorts positions too; positions also break ties. Beyond 2^21 symbols the
        position no longer fits, and an index sort takes its place.
        """
        n, room = self.size, self.to_stop
        bits = n.bit_length()
        packed = 3 * bits <= 63
        mask = (1 << bits) - 1
        wide = int(symbols.max()).bit_length()
        size = max(1, (63 - bits if packed else 63) // wide)
        key = np.zeros(n, np.int64)
        for k in range(size):
            key <<= wide
            key[: n - k] |= np.where(room[: n - k] >= k, symbols[k:], 0)
        places, longest = np.arange(n), int(room.max()) + 1
        while True:
            if packed:
                ranked = np.sort(key << bits | places)
                order, ranked = ranked & mask, ranked >> bits
            else:
                order = np.argsort(key, kind="stable")
                ranked = key[order]
            new = np.ones(n, bool)
            new[1:] = ranked[1:] != ranked[:-1]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new)
            if size >= longest or new.all():
                return order
            key = rank << bits
            key[: n - size] |= np.where(room[: n - size] >= size, rank[size:], 0)
            size *= 2

    def _shared(self, data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of suffixes, inside their texts; eight bytes a step."""
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(data), "<u8", padded, strides=(1,)).copy()
        most = np.minimum(self.to_stop[a], self.to_stop[b])
        out = np.zeros(len(a), np.int64)
        live = np.flatnonzero(most > 0)
        while len(live):
            at = out[live]
            differ = eight[a[live] + at] ^ eight[b[live] + at]
            same = np.searchsorted(_WHOLE_BYTES, differ & (~differ + np.uint64(1)), "right")
            same[differ == 0] = 8
            out[live] = np.minimum(at + same, most[live])
            live = live[(same == 8) & (at + 8 < most[live])]
        return out

    def matching_statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """(length, partner) of every position: its longest match with the suffix before it.

        Streams from sample to sample: between two, every step takes a byte off the match.
        """
        last = np.searchsorted(self.sample, np.arange(self.size), "right") - 1
        moved = np.arange(self.size) - self.sample[last]
        return np.maximum(self.shared[last] - moved, 0), self.partner[last] + moved


def first_holders(texts: list[bytes], ids: np.ndarray) -> np.ndarray:
    """For every position of the joined texts, the smallest id whose text holds the
    ``LENGTH`` bytes from there on (positions: texts one after another, one byte between)."""
    index = RunIndex(texts)
    length, partner = index.matching_statistics()
    head = np.arange(index.size)
    long = length >= LENGTH
    head[long] = partner[long]
    while True:  # each chain's positions jump to its head
        jumped = head[head]
        if (jumped == head).all():
            break
        head = jumped
    owner = np.repeat(ids, [len(t) + 1 for t in texts])
    least = np.full(index.size, NO_ID, np.int64)
    np.minimum.at(least, head, owner)
    return least[head]


# ---- Spark -----------------------------------------------------------------------


def _find_minimizers(shards: int):
    """Tasks send the minimizers of their texts as packed arrays by hash range."""
    shift = np.uint64(64 - shards.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs = batch.column(0).to_numpy()
            keep = np.unique(refs, return_index=True)[1]
            chosen = batch.take(pa.array(np.sort(keep)))
            refs, texts = chosen.column(0).to_numpy(), chosen.column(1).to_pylist()
            for at, data, ends in _joined(texts):
                text, _, _, value = stretches(data, ends)
                if not len(value):
                    continue
                ref = refs[at + text]
                order = np.argsort(value, kind="stable")
                value, ref = value[order], ref[order]
                new = np.ones(len(value), bool)
                new[1:] = (value[1:] != value[:-1]) | (ref[1:] != ref[:-1])
                value, ref = value[new], ref[new]
                edges = np.flatnonzero(np.diff((value >> shift).astype(np.int64), prepend=-1, append=shards))
                rows = [
                    (int(value[lo] >> shift), (value[lo:hi] >> np.uint64(16)).astype(np.uint32).tobytes(), ref[lo:hi].tobytes())
                    for lo, hi in zip(edges[:-1], edges[1:])
                ]
                yield record_batch(rows, ["shard", "m", "ref"], [pa.int32(), pa.binary(), pa.binary()])

    return run


def _shared_minimizers(table: pa.Table) -> pa.Table:
    """(ref, m) of the minimizers of a hash range that two or more classes have."""
    m = np.concatenate([np.frombuffer(x, np.uint32) for x in table["m"].to_pylist()]).astype(np.int64)
    ref = np.concatenate([np.frombuffer(x, np.int64) for x in table["ref"].to_pylist()])
    order = np.lexsort((ref, m))
    m, ref = m[order], ref[order]
    new = np.ones(len(m), bool)
    new[1:] = (m[1:] != m[:-1]) | (ref[1:] != ref[:-1])
    m, ref = m[new], ref[new]
    first = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
    size = np.diff(np.append(first, len(m)))
    many = np.repeat(size > 1, size)
    key = (m[many] << 16) | table["shard"][0].as_py()
    return pa.table({"ref": pa.array(ref[many]), "m": pa.array(key)})


def _cut_stretches(shards: int):
    """Tasks send the stretches of shared minimizers, packed by hash range."""
    shift = np.uint64(64 - shards.bit_length() + 1)
    names = ["shard", "ref", "first", "start", "entry", "windows", "data"]
    kinds = [pa.int32(), *[pa.binary()] * 6]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            refs, firsts = batch.column("ref").to_numpy(), batch.column("first").to_numpy()
            wanted = [np.asarray(x, np.int64) for x in batch.column("ms").to_pylist()]
            texts = [unpack.decompress(x) for x in batch.column("text").to_pylist()]
            for at, data, ends in _joined(texts):
                text, start, windows, value = stretches(data, ends)
                shard = (value >> shift).astype(np.int64)
                key = ((value >> np.uint64(16)).astype(np.uint32).astype(np.int64) << 16) | shard
                # Of one text only: (text, key) pairs against those that are wanted.
                held = np.concatenate([np.unique(x) for x in wanted[at : at + len(ends)]])
                of = np.repeat(np.arange(len(ends)), [len(np.unique(x)) for x in wanted[at : at + len(ends)]])
                pair = mix(held.astype(np.uint64) * _STEP + of.astype(np.uint64))
                keep = np.isin(mix(key.astype(np.uint64) * _STEP + text.astype(np.uint64)), pair)
                text, start, windows, shard = text[keep], start[keep], windows[keep], shard[keep]
                order = np.argsort(shard, kind="stable")
                edges = np.flatnonzero(np.diff(shard[order], prepend=-1, append=shards))
                begin = np.concatenate([[0], ends[:-1]])
                whole = data.tobytes()
                rows = []
                for lo, hi in zip(edges[:-1], edges[1:]):
                    own = order[lo:hi]
                    t, s, w = text[own], start[own], windows[own]
                    # Each distinct stretch is sent once, whatever a text repeats.
                    seen: dict[bytes, int] = {}
                    entry = [
                        seen.setdefault(whole[a:b], len(seen)) for a, b in zip(s.tolist(), (s + w + LENGTH - 1).tolist())
                    ]
                    rows.append(
                        (
                            int(shard[own[0]]),
                            refs[at + t].tobytes(),
                            firsts[at + t].tobytes(),
                            (s - begin[t]).tobytes(),
                            np.array(entry, np.uint32).tobytes(),
                            np.array([len(x) - LENGTH + 1 for x in seen], np.uint8).tobytes(),
                            b"".join(seen),
                        )
                    )
                yield record_batch(rows, names, kinds)

    return run


def _mark(table: pa.Table) -> pa.Table:
    """Covered intervals (ref, a, b) of one range's stretches."""
    ref, first, start = (
        np.concatenate([np.frombuffer(x, np.int64) for x in table[c].to_pylist()]) for c in ("ref", "first", "start")
    )
    # Equal stretches are one entry of the index, under their smallest id.
    number: dict[bytes, int] = {}
    entries = []
    for entry, windows, data in zip(*(table[c].to_pylist() for c in ("entry", "windows", "data"))):
        ends = np.cumsum(np.frombuffer(windows, np.uint8).astype(np.int64) + LENGTH - 1)
        own = [data[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]
        numbers = np.array([number.setdefault(t, len(number)) for t in own], dtype=np.int64)
        entries.append(numbers[np.frombuffer(entry, np.uint32)])
    entry = np.concatenate(entries)
    least = np.full(len(number), NO_ID, np.int64)
    np.minimum.at(least, entry, first)
    distinct = list(number)
    lengths = np.array([len(t) for t in distinct])
    begin = np.cumsum(lengths + 1) - lengths - 1
    windows = lengths - LENGTH + 1
    holder = first_holders(distinct, least)
    # Most stretches are covered whole or not at all; the others go window by window.
    inside = np.repeat(begin - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())
    edges = np.cumsum(windows) - windows
    low, high = np.minimum.reduceat(holder[inside], edges), np.maximum.reduceat(holder[inside], edges)
    whole = high[entry] < first
    found = [(ref[whole], start[whole], windows[entry[whole]])]
    mixed = np.flatnonzero((low[entry] < first) & ~whole)
    for lo in range(0, len(mixed), MIXED):
        own = mixed[lo : lo + MIXED]
        count = windows[entry[own]]
        of = np.repeat(own, count)
        at = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        hit = holder[begin[entry[of]] + at] < first[of]
        found.append((ref[of[hit]], start[of[hit]] + at[hit], np.ones(hit.sum(), np.int64)))
    r, a, w = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((a, r))
    r, a, b = r[order], a[order], (a + w)[order] + LENGTH - 1
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (a[1:] > b[:-1])
    begins = np.flatnonzero(new)
    last = np.append(begins[1:], len(r))[: len(begins)] - 1
    return pa.table({"ref": pa.array(r[begins]), "a": pa.array(a[begins]), "b": pa.array(b[last])})


def _pack_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        small = [pack.compress(x) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(small, pa.binary())], names=["ref", "id", "text"])


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for ref, packed, spans in zip(*(batch.column(c).to_pylist() for c in ("ref", "text", "spans"))):
            text = unpack.decompress(packed)
            kept, at, removed, runs = hashlib.sha256(), 0, 0, 0
            end = -1
            for a, b in sorted((s["a"], s["b"]) for s in spans):
                if a > end:
                    runs += 1
                    kept.update(text[at:a])
                    removed -= a
                    removed += b
                elif b > end:
                    removed += b - end
                end = max(end, b)
                at = end
            kept.update(text[at:])
            rows.append((ref, removed, runs, kept.hexdigest()))
        yield record_batch(rows, ["ref", "removed", "spans", "sha"], [pa.int64(), pa.int64(), pa.int64(), pa.string()])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256.

    Null texts are empty. Documents that repeat an id do not cover each other; a null id
    counts as larger than any other. Other columns are ignored, an empty table gives an
    empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.xxhash64(text).alias("ref"), F.col(id_col).cast("long").alias("id"), text.cast("binary").alias("text"))
    rows = stage(
        texts.select("ref", "id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")),
        "repeat-documents",
    )
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        shards = 1 << min(15, max(3, (rows.count() // 200).bit_length()))
        long = texts.where(F.octet_length("text") >= LENGTH)
        found = long.select("ref", "text").mapInArrow(_find_minimizers(shards), "shard int, m binary, ref binary")
        shared = found.groupBy("shard").applyInArrow(_shared_minimizers, "ref long, m long")
        wanted = stage(shared.groupBy("ref").agg(F.collect_list("m").alias("ms")), "repeat-minimizers")
        classes = rows.groupBy("ref").agg(F.min("id").alias("first"))
        held = wanted.join(classes, "ref").withColumnRenamed("ref", "r")
        packed = long.mapInArrow(_pack_text, "ref long, id long, text binary")
        own = (F.col("ref") == F.col("r")) & F.col("id").eqNullSafe(F.col("first"))
        carried = packed.join(held, own).select("ref", F.coalesce("first", F.lit(NO_ID)).alias("first"), "ms", "text")
        cut = carried.mapInArrow(
            _cut_stretches(shards), "shard int, ref binary, first binary, start binary, entry binary, windows binary, data binary"
        )
        marks = stage(cut.groupBy("shard").applyInArrow(_mark, "ref long, a long, b long"), "repeat-marks")
        spans = marks.groupBy("ref").agg(F.collect_set(F.struct("a", "b")).alias("spans")).join(classes, "ref").withColumnRenamed("ref", "r")
        results = stage(
            packed.join(spans, own).select("ref", "text", "spans").mapInArrow(_cut_out, "ref long, removed long, spans long, sha string"),
            "repeat-results",
        ).dropDuplicates(["ref"])
    named = classes.join(results.withColumnRenamed("sha", "kept"), "ref", "left").withColumnRenamed("ref", "r")
    joined = rows.join(named, F.col("ref") == F.col("r"))
    # A later copy of a whole text is covered by the first one from end to end.
    later = (F.coalesce("id", F.lit(NO_ID)) > F.coalesce("first", F.lit(NO_ID))) & (F.col("n_bytes") >= LENGTH)
    none = F.lit(0).cast("long")
    return joined.select(
        F.col("id").alias(id_col),
        "n_bytes",
        F.when(later, F.col("n_bytes")).otherwise(F.coalesce("removed", none)).alias("n_removed"),
        F.when(later, none + 1).otherwise(F.coalesce("spans", none)).alias("n_spans"),
        F.when(later, hashlib.sha256(b"").hexdigest()).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )
