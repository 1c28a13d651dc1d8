"""Document quality by hierarchical empirical Bayes.

A logistic model over the shape of a text gives each document its own evidence. Hosts
and the paths below them are then judged by all their documents: a document counts with
its own probability. Those counts are
grouped per path; the host mean is shrunk toward the global mean, the path mean toward
its host, each with a strength that the spread between the groups themselves sets (method
of moments), so sparse sites stay near the prior. A document's final log odds are its own
plus what its path's posterior adds to the global mean.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.common import arrow_rows
from barlake.llm.toxicity import fit_logistic, training_rows
from barlake.runtime import stage

#: At most about so many labelled documents teach the text model.
TRAIN_ROWS, THRESHOLD, FOLDS, HELD_FOLD = 40_000, 0.5, 3, 1
#: Rows of an Arrow batch of texts; Spark holds a batch several times outside its heap.
TEXTS = 1_000
#: Most documents a site's prior strength may stand for.
MOST_STRENGTH = 1e6
_symbols = re.compile(r"[#$%&*|!<>{}\[\]=+~^_\\/@]").findall
FEATURES = 11


def features(text: str) -> list[float]:
    """Shape of a whole text; an empty one has its own mark."""
    tokens = text.split()
    if not tokens:
        return [1.0] + [0.0] * (FEATURES - 1)
    n, size = len(tokens), len(text)
    counts = Counter(tokens)
    lines = [x for x in text.split("\n") if x]
    stretches = Counter(zip(tokens, tokens[1:], tokens[2:]))
    upper = sum(t.isupper() and len(t) > 1 for t in tokens) / n
    marked = sum(not t[-1].isalnum() and t[-1] not in ".,;:?" for t in tokens) / n
    return [
        0.0,
        math.log(n) / 5,
        len(_symbols(text)) / size * 10,
        upper,
        marked,
        sum(map(str.isdigit, text)) / size * 10,
        len(counts) / n,
        max(counts.values()) / n,
        1 - len(stretches) / max(1, n - 2),
        1 - len(set(lines)) / max(1, len(lines)),
        size / n / 20,
    ]


def _expand(x: np.ndarray) -> np.ndarray:
    """Squares and roots beside the features, for bends the plain ones cannot follow."""
    return np.column_stack([x, x[:, 2:] ** 2, np.sqrt(np.maximum(x[:, 2:], 0))])


def _probabilities(batches: Iterator[pa.RecordBatch], beta: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.array([features(t.as_py() or "") for t in batch.column(0)], dtype=float).reshape(-1, FEATURES)
        if beta is None:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column(1)], names=["x", "label"])
        else:
            z = np.column_stack([np.ones(len(x)), _expand(x)]) @ beta
            names = [*batch.schema.names[1:], "own"]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(np.clip(z, -12, 12))], names=names)


def fit(labelled: DataFrame) -> np.ndarray:
    """Weights from staged (text, label) rows; a bounded number of feature rows is collected."""
    with arrow_rows(labelled.sparkSession, TEXTS):
        rows = labelled.mapInArrow(lambda b: _probabilities(b, None), "x array<double>, label int").toArrow()
    y = rows["label"].to_numpy().astype(float)
    width = _expand(np.zeros((1, FEATURES))).shape[1]
    if not len(y) or y.min() == y.max():
        share = y.mean() if len(y) else 1.0
        return np.array([10.0 * (2 * share - 1)] + [0.0] * width)
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, FEATURES)
    return fit_logistic(_expand(x), y, 0.02)


def strength(groups: DataFrame, mean: str, n: str, good: str) -> float:
    """Documents that a prior is worth: the spread of group means beyond chance, by moments."""
    p = F.col(good) / F.col(n)
    chance = F.col(mean) * (1 - F.col(mean))
    row = groups.where(F.col(n) >= 2).agg(
        F.sum(F.col(n) * (p - F.col(mean)) ** 2), F.sum(chance), F.sum(F.col(n) * chance)
    ).first()
    if not row[1] or not row[2]:
        return MOST_STRENGTH
    beyond = (row[0] - row[1]) / row[2]
    return min(MOST_STRENGTH, max(1.0, 1 / beyond)) if beyond > 0 else MOST_STRENGTH


def _logit(p):
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _judged(
    docs: DataFrame,
    labels: DataFrame,
    passed: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    path_cols: Sequence[str] = ("lang",),
    label_col: str = "quality",
    threshold: float = THRESHOLD,
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """One row per document: _passed, host, path, text_score, site_score, quality, keep."""
    labelled = training_rows(docs, labels, id_col, text_col, label_col, FOLDS, HELD_FOLD, train_rows)
    beta = fit(labelled)
    chosen = docs.select(
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        passed.alias("_passed"),
        F.col(host_col).cast("string").alias("host"),
        F.to_json(F.array(*[F.col(c).cast("string") for c in path_cols])).alias("path"),
    )
    schema = T.StructType([*chosen.schema.fields[1:], T.StructField("own", T.DoubleType())])
    with arrow_rows(docs.sparkSession, TEXTS):
        judged = stage(chosen.mapInArrow(lambda b: _probabilities(b, beta), schema), "quality-own")
    # Grouped evidence: combined before the shuffle, a row for each path.
    good = 1 / (1 + F.exp(-F.col("own")))
    paths = stage(
        judged.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"), F.sum(good).alias("good")), "quality-paths"
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    n, total = hosts.agg(F.sum("host_n"), F.sum("host_good")).first()
    mean = total / n if n else 0.5
    hosts = hosts.withColumn("mean", F.lit(mean))
    host_prior = strength(hosts, "mean", "host_n", "host_good")
    hosts = stage(
        hosts.select(
            F.col("host").alias("_host"),
            ((F.col("host_good") + host_prior * mean) / (F.col("host_n") + host_prior)).alias("host_mean"),
        ),
        "quality-hosts",
    )
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    path_prior = strength(paths, "host_mean", "n", "good")
    posterior = (F.col("good") + path_prior * F.col("host_mean")) / (F.col("n") + path_prior)
    sites = stage(
        paths.select(F.col("host").alias("_host"), F.col("path").alias("_path"), posterior.alias("site_score")), "quality-sites"
    )
    joined = judged.join(
        sites, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path"))
    )
    final = F.col("own") + _logit(F.col("site_score")) - _logit(F.lit(mean))
    return joined.select(
        "_passed",
        "host",
        "path",
        good.alias("text_score"),
        "site_score",
        (1 / (1 + F.exp(-final))).alias("quality"),
    ).withColumn("keep", F.col("quality") >= threshold)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """One row per document: id, host, path, text_score, site_score, quality, keep.

    Null texts are empty. Null hosts and null path parts are sites of their own. Labels
    of the held-out fold teach nothing. Of repeated labels the largest counts; repeated
    rows are judged alike. Other columns are ignored, an empty table gives an empty
    result.
    """
    judged = _judged(docs, labels, F.col(id_col).cast("long"), id_col, **settings)
    return judged.withColumnRenamed("_passed", id_col)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` that ``score`` keeps, all columns kept.

    Each row is judged by its own text and site, also if it repeats an id or has none.
    Whole rows are written once beside their text's score; only site rows are joined to them.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return _judged(docs, labels, whole, id_col, **settings).where("keep").select("_passed.*")
