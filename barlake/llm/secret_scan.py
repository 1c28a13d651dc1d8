"""Secret spans by patterns and by the token-efficiency test.

Three patterns give the base spans: values assigned to a secret's name, access keys and
hex strings. The token-efficiency test adds what no pattern names: a byte-pair vocabulary
spends few tokens on language and on names made of words, and one token for every one or
two characters of a random string. So every run of token-like characters whose characters
per token stay under a threshold is a span of kind ``random``, unless it is a known digest
(hex of a digest's length, a UUID, a ``sha256-`` integrity value) or an identifier (a
number, a word, or words joined by case, digits or separators), or meets a base span.

A text is scanned as a whole. Tokens of a run are counted in consecutive stretches of
``SEGMENT`` characters and summed, so that the work stays linear in the run's length.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.best_fit import PATTERN
from barlake.llm.common import text_of

#: Characters per token up to which a run counts as random, its least length, and the
#: characters that are tokenised at once.
RATIO, LEAST, SEGMENT = 2.0, 20, 64
#: The base kinds in their order, their patterns and least lengths.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{14,}"), re.compile(r"[0-9a-f]{16,}")
LEAST_VALUE = 12
#: Hex lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)

_ORDER = {kind: n for n, kind in enumerate((*BASE_KINDS, "random"))}
_DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile(r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}")
_INTEGRITY = re.compile(r"sha(?:1|256|384|512)-[A-Za-z0-9+/_-]+={0,2}")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SPAN = "array<struct<kind:string,start:int,end:int,ratio:double>>"


def is_known_digest(value: str) -> bool:
    if _DIGEST.fullmatch(value):
        return len(value) in DIGEST_LENGTHS
    return bool(_UUID.fullmatch(value) or _INTEGRITY.fullmatch(value))


def is_identifier(value: str) -> bool:
    """A number, or words of four letters on average with at most a number at each joint."""
    parts = _PART.findall(value)
    words = [p for p in parts if not p[0].isdigit()]
    if not words:
        return True
    joints = 1 + sum(map(value.count, "_/+-"))
    long_words = sum(map(len, words)) >= 4 * len(words) and min(map(len, words)) > 1
    return long_words and len(parts) - len(words) <= joints


class Scanner:
    """Spans of a text; one per task, as the vocabulary is read once."""

    def __init__(self, vocabulary: str, ratio: float = RATIO, least: int = LEAST):
        with open(vocabulary, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.tokens = tiktoken.Encoding("ids", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.run = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % least)
        self.ratio = ratio

    def efficiency(self, value: str) -> float:
        """Characters per token."""
        cut = [value[at : at + SEGMENT] for at in range(0, len(value), SEGMENT)]
        return len(value) / sum(len(self.tokens.encode_ordinary(piece)) for piece in cut)

    def _random(self, text: str, base: list[tuple]) -> Iterator[tuple]:
        taken = sorted((start, end) for _, start, end, _ in base)
        at, reach = 0, -1
        for m in self.run.finditer(text):
            start, end = m.span()
            while at < len(taken) and taken[at][0] < end:
                reach = max(reach, taken[at][1])
                at += 1
            value = m.group()
            if reach > start or is_known_digest(value) or is_identifier(value):
                continue
            ratio = self.efficiency(value)
            if ratio <= self.ratio:
                yield "random", start, end, ratio

    def spans(self, text: str) -> list[tuple]:
        """(kind, start, end, characters per token or None), by start, then kind."""
        found = [
            ("assign", *m.span(), None) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE
        ]
        found += [("access", *m.span(), None) for m in ACCESS.finditer(text)]
        found += [("hex", *m.span(), None) for m in HEX.finditer(text)]
        found += list(self._random(text, found))
        return sorted(found, key=lambda s: (s[1], _ORDER[s[0]]))


def _span_array(rows: list[list[tuple]]) -> pa.Array:
    flat = [s for row in rows for s in row]
    kinds, starts, ends, ratios = zip(*flat) if flat else ([], [], [], [])
    values = pa.StructArray.from_arrays(
        [pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(ratios, pa.float64())],
        names=["kind", "start", "end", "ratio"],
    )
    offsets = np.concatenate([[0], np.cumsum([len(row) for row in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def find_spans(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    ratio: float = RATIO,
    least: int = LEAST,
) -> DataFrame:
    """One row per document: id and ``spans``, an array of (kind, start, end, ratio).

    Offsets are code points, ends exclusive; ``ratio`` is null for base kinds. A null text
    has no spans, a null id stays null, repeated rows are scanned each, and an empty table
    gives an empty result. No other column is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(vocabulary, ratio, least)
        for batch in batches:
            found = [scanner.spans(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), _span_array(found)], names=["_id", "spans"])

    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    return rows.mapInArrow(run, f"_id {kind}, spans {_SPAN}").withColumnRenamed("_id", id_col)


def redact(
    docs: DataFrame,
    vocabulary: str,
    text_col: str = "text",
    ratio: float = RATIO,
    least: int = LEAST,
) -> DataFrame:
    """``docs`` with each run of overlapping spans replaced by ``[SECRET]``; null texts stay null."""
    place = docs.columns.index(text_col)

    def clean(scanner: Scanner, text: str | None) -> str | None:
        if not text:
            return text
        out, end = [], 0
        for _, start, stop, _ in scanner.spans(text):
            if start >= end:
                out += [text[end:start], "[SECRET]"]
            end = max(end, stop)
        return "".join([*out, text[end:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(vocabulary, ratio, least)
        for batch in batches:
            texts = pa.array([clean(scanner, t.as_py()) for t in batch.column(place)], batch.column(place).type)
            columns = [texts if n == place else c for n, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    plain = docs.toDF(*[f"c{n}" for n in range(len(docs.columns))])  # names may hold dots
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def _joined(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")


def report(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts of the base kinds, a hash of the base spans, all spans as text."""
    counts = {f"n_{kind}": F.expr(f"CAST(size(filter(spans, s -> s.kind = '{kind}')) AS BIGINT)") for kind in BASE_KINDS}
    base = _joined("filter(spans, s -> s.kind <> 'random')")
    return find_spans(docs, vocabulary, id_col, text_col).select(
        F.col(id_col),
        *[column.alias(name) for name, column in counts.items()],
        F.sha2(F.encode(base, "UTF-8"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
    )
