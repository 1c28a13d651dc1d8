"""The corpus pipeline: quality, exact copies, near copies, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. Its
result is written to the session's shared folder and read again as the next one's docs. A
stage deletes what earlier ones staged, as far as its own docs do not read it.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barlake.llm import best_fit, exact_dedup, jaccard_join, mixing, site_quality
from barlake.llm.queries import table, tokenizer_file
from barlake.runtime import release, stage, staged_paths

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Step = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Folders that stages have staged in this session and that may be needed still.
_staged: set[str] = set()


def _clean(step: Step) -> Step:
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _staged, docs)
        before = staged_paths(spark)
        _staged.intersection_update(before)
        result = step(spark, docs, sf_dir)
        _staged.update(staged_paths(spark) - before)
        return result

    return functools.wraps(step)(run)


@_clean
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the hierarchical quality model keeps."""
    return site_quality.keep_good(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


@_clean
def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts."""
    return exact_dedup.deduplicate(docs).select(*COLUMNS)


@_clean
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the shingle join links."""
    return jaccard_join.keep_first(docs).select(*COLUMNS)


@_clean
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as their sources' targets ask for."""
    return mixing.mix(docs).select(*COLUMNS)


@_clean
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents, placed in sequences."""
    return best_fit.pack(docs, tokenizer_file())


STAGES: list[tuple[str, Step]] = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: The classifier and the tokenizer have no SQL form; the tests hold the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = staged_paths(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        release(spark, staged_paths(spark) - before, docs)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}
