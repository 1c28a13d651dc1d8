"""Pieces that several of the operators share."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.runtime import stage

#: White space and words of the contracts.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: For bytes.translate: A-Z only, so that no other letter changes.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def text_of(column: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lower_words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text with A-Z in lower case; bytes split at exactly those blanks."""
    return text.translate(_LOWER).split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def packed(values: np.ndarray) -> bytes:
    """Compressed with the bytes of equal weight together: small numbers take less than a byte."""
    return zlib.compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes(), 1)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    """The values of ``packed``."""
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


class WordHashes(dict):
    """64-bit hashes of words, remembered; ``trim`` keeps the memory bounded."""

    def __init__(self):
        super().__init__()
        self.table = np.zeros(1 << 16, np.uint64)

    def __missing__(self, word: bytes) -> int:
        place = len(self)
        if place == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[place] = xxhash.xxh64_intdigest(word)
        self[word] = place
        return place

    def of(self, words: list[bytes]) -> np.ndarray:
        places = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.table[places]

    def trim(self, most: int = 150_000) -> None:
        if len(self) > most:
            self.clear()


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Smaller Arrow batches for what is staged meanwhile: whole texts make large rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def record_batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder ``fold``; a null id counts as "null"."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    return F.crc32(text.cast("binary")) % folds == fold


#: Row numbers that are broadcast at most (some 100 MB as a hashed relation).
BROADCAST_ROWS = 1_000_000


def without_rows(rows: DataFrame, losers: DataFrame) -> DataFrame:
    """``rows`` without those whose ``_row`` is in ``losers``; texts are shuffled only if these are many."""
    gone = stage(losers.select("_row"), "rows-out")
    few = gone.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(gone) if few else gone, "_row", "left_anti")


def numbered(df: DataFrame, order: list[Column], column: str, label: str, tasks: int = 16) -> DataFrame:
    """``df`` staged with a rank from 0 in ``order``, without a window over all rows.

    Rows are dealt out by range; the rank is the row number inside the range plus
    the sizes of the ranges before it (at most ``tasks`` of them).
    """
    dealt = stage(
        df.repartitionByRange(tasks, *order).withColumn("_range", F.spark_partition_id()), label
    )
    starts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        dealt.join(F.broadcast(starts), "_range")
        .withColumn(column, F.col("_start") + place - 1)
        .drop("_range", "_start")
    )
