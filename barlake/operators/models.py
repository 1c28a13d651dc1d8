"""Classifiers over feature rows: class weights, candidates, held-out scores.

Everything a classifier learns (imputing, scaling, chosen columns, class weights and the
model) comes from rows of the ``train`` split. Training rows are written once, so that each
pass of an iterative fit reads a narrow table; what reaches the driver is bounded by the number
of columns and classes. Scores of every split come from one aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Model, classification
from pyspark.ml.base import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.operators import training
from barlake.runtime import stage, unstage

#: Classes a classifier may have; more than this is taken for a mistaken label column.
MAX_CLASSES = 100
_FLOOR = 1e-15
_INPUT = {"featuresCol": "_inputs", "labelCol": "_class"}


# --- Fixed values: settings of the candidates. ---
def logistic() -> Estimator:
    return classification.LogisticRegression(
        **_INPUT, weightCol="_weight", regParam=0.08, elasticNetParam=0.0, maxIter=200, standardization=True
    )


def forest() -> Estimator:
    return classification.RandomForestClassifier(
        **_INPUT, weightCol="_weight", numTrees=200, maxDepth=5, minInstancesPerNode=80, featureSubsetStrategy="sqrt", seed=42
    )


def boosted() -> Estimator:
    return classification.GBTClassifier(**_INPUT, weightCol="_weight", maxIter=20, maxDepth=3, minInstancesPerNode=80, seed=42)


TOP_LOGISTIC, TOP_FOREST, TOP_BOOSTED = 36, 44, 24
# --- end of fixed values ---


@dataclass(frozen=True)
class Candidate:
    """A classifier to try: how many of the ranked columns it gets, and its estimator.

    ``one_vs_rest`` fits one two-class model a class, for estimators that know only two.
    """

    name: str
    top: int
    make: Callable[[], Estimator]
    one_vs_rest: bool = False


CANDIDATES = (
    Candidate("logistic", TOP_LOGISTIC, logistic),
    Candidate("forest", TOP_FOREST, forest),
    Candidate("boosted", TOP_BOOSTED, boosted, one_vs_rest=True),
)


def class_weights(rows: DataFrame, label_col: str) -> DataFrame:
    """(label, rows, weight): every class of the train rows weighs the same in all.

    The weight of a class is all / (classes * its rows), so that weights sum up to the number
    of rows. Rows without a label do not count.
    """
    train = rows.where((F.col("split") == "train") & F.col(label_col).isNotNull())
    held = train.groupBy(F.col(label_col).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    whole = held.agg(F.sum("rows").alias("all"), F.count(F.lit(1)).alias("classes"))
    return held.crossJoin(F.broadcast(whole)).select("label", "rows", (F.col("all") / (F.col("classes") * F.col("rows"))).alias("weight"))


@dataclass(frozen=True)
class Fitted:
    """A trained candidate; ``predict`` is a projection over any rows that hold its columns."""

    name: str
    columns: tuple[str, ...]
    classes: tuple[str, ...]
    parameters: dict[str, tuple[float, float, float]]
    models: tuple[Model, ...]

    def _assembled(self, rows: DataFrame) -> DataFrame:
        named = {f"_in_{n}": _prepared(c, *self.parameters[c]) for n, c in enumerate(self.columns)}
        return VectorAssembler(inputCols=list(named), outputCol="_inputs").transform(rows.withColumns(named)).drop(*named)

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``probabilities`` (an array in the order of ``classes``), ``predicted``
        (the likeliest class, ties to the first in order) and ``confidence`` (its probability).

        Missing values are imputed, so every row gets a prediction. One model gives its own
        distribution; one-vs-rest gives each class's probability divided by their sum.
        """
        scored = self._assembled(rows)
        parts = []
        for n, model in enumerate(self.models):
            model = model.copy().setProbabilityCol(f"_p{n}").setRawPredictionCol(f"_r{n}").setPredictionCol(f"_y{n}")
            scored = model.transform(scored).drop(f"_r{n}", f"_y{n}")
            parts.append(vector_to_array(f"_p{n}"))
        if len(parts) == 1:
            probabilities = parts[0]
        else:
            alone = F.array(*[p[1] for p in parts])
            total = F.aggregate(alone, F.lit(0.0), lambda a, b: a + b)
            probabilities = F.transform(alone, lambda p: F.when(total > 0, p / total).otherwise(1.0 / len(parts)))
        scored = scored.withColumn("probabilities", probabilities).drop("_inputs", *[f"_p{n}" for n in range(len(parts))])
        best = F.array_max("probabilities")
        names = F.array(*[F.lit(c) for c in self.classes])
        likeliest = F.element_at(names, F.array_position("probabilities", best).cast("int"))
        return scored.withColumns({"predicted": likeliest, "confidence": best})


def _prepared(column: str, median: float, mean: float, scale: float) -> Column:
    return (F.coalesce(training._finite(column), F.lit(median)) - mean) / scale


@dataclass(frozen=True)
class Learned:
    """What the train rows taught before any model: shared by all candidates."""

    ranked: tuple[str, ...]
    parameters: dict[str, tuple[float, float, float]]
    weights: dict[str, float]


def learn_columns(rows: DataFrame, columns: Sequence[str], label_col: str) -> Learned:
    """Rank of the columns, their preparation and the class weights, from the labelled train rows.

    Columns are ranked by their one-way F between the labels; those without an F value are
    left out. Fewer than two classes, more than ``MAX_CLASSES``, or no column that tells any
    class apart are refused with ``ValueError``. One aggregate each.
    """
    train = rows.where((F.col("split") == "train") & F.col(label_col).isNotNull())
    weights = {r["label"]: r["weight"] for r in class_weights(rows, label_col).limit(MAX_CLASSES + 1).collect()}
    if not 2 <= len(weights) <= MAX_CLASSES:
        raise ValueError(f"no classifier for {len(weights)} classes in the train rows")
    ranking = training.rank_features(train, columns, label_col).where(F.col("f_value").isNotNull())
    ranked = tuple(training.select_features(ranking, len(columns)))
    if not ranked:
        raise ValueError("no column tells the classes of the train rows apart")
    fitted = training.fit_preparation(train, ranked).collect()  # one row a column
    return Learned(ranked, {r["column"]: (r["median"], r["mean"], r["scale"]) for r in fitted}, weights)


def fit_candidate(
    rows: DataFrame,
    columns: Sequence[str],
    label_col: str,
    candidate: Candidate,
    balanced: bool = True,
    learned: Learned | None = None,
) -> Fitted:
    """Train ``candidate`` on the labelled ``train`` rows of ``rows``, with the best ``candidate.top`` columns.

    Classes are in text order. Null labels do not train. ``learned`` spares the passes of
    ``learn_columns`` when several candidates share their rows.
    """
    train = rows.where((F.col("split") == "train") & F.col(label_col).isNotNull())
    learned = learned or learn_columns(rows, columns, label_col)
    chosen, classes, found = learned.ranked[: candidate.top], tuple(sorted(learned.weights)), learned.weights
    parameters = {c: learned.parameters[c] for c in chosen}
    fitted = Fitted(candidate.name, chosen, classes, parameters, ())
    label = F.col(label_col).cast("string")
    number = F.array_position(F.array(*[F.lit(c) for c in classes]), label).cast("double") - 1
    weight = F.create_map(*[F.lit(x) for pair in found.items() for x in pair])[label] if balanced else F.lit(1.0)
    table = stage(fitted._assembled(train).select("_inputs", number.alias("_class"), weight.alias("_weight")), "train")
    try:
        if candidate.one_vs_rest and len(classes) > 2:
            targets = [table.withColumn("_class", (F.col("_class") == n).cast("double")) for n in range(len(classes))]
            models = tuple(candidate.make().fit(target) for target in targets)
        else:
            models = (candidate.make().fit(table),)
    finally:
        unstage(rows.sparkSession, table)
    return Fitted(candidate.name, chosen, classes, parameters, models)


def scores(predicted: DataFrame, fitted: Fitted, label_col: str) -> DataFrame:
    """(model, split, rows, accuracy, base_accuracy, log_loss, balanced_accuracy) of labelled rows.

    ``base_accuracy`` is what always naming the split's commonest class would reach. A label that
    the train rows do not hold counts as wrong, with the floor probability of 1e-15 for the log loss.
    """
    label = F.col(label_col).cast("string")
    at = F.array_position(F.array(*[F.lit(c) for c in fitted.classes]), label).cast("int")
    own = F.when(at > 0, F.element_at("probabilities", F.when(at > 0, at).otherwise(1))).otherwise(0.0)
    by_class = (
        predicted.where(F.col(label_col).isNotNull() & F.col("split").isNotNull())
        .groupBy("split", label.alias("label"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("predicted") == label).alias("right"),
            F.sum(-F.log(F.greatest(own, F.lit(_FLOOR)))).alias("loss"),
        )
    )
    return by_class.groupBy("split").agg(
        F.lit(fitted.name).alias("model"),
        F.sum("n").alias("rows"),
        (F.sum("right") / F.sum("n")).alias("accuracy"),
        (F.max("n") / F.sum("n")).alias("base_accuracy"),
        (F.sum("loss") / F.sum("n")).alias("log_loss"),
        F.avg(F.col("right") / F.col("n")).alias("balanced_accuracy"),
    )


def compare_candidates(
    rows: DataFrame, columns: Sequence[str], label_col: str, candidates: Sequence[Candidate] = CANDIDATES
) -> DataFrame:
    """Scores of every candidate and split, with ``chosen`` on the one whose validation log loss is least.

    Test rows have no say in the choice; ties go to the earlier candidate. Without validation
    rows none is chosen. ``rows`` is computed once, and only its columns named here are kept.
    """
    spark = rows.sparkSession
    rows = stage(rows.select("split", label_col, *columns), "labelled")
    learned = learn_columns(rows, columns, label_col)
    reports = None
    for place, candidate in enumerate(candidates):
        fitted = fit_candidate(rows, columns, label_col, candidate, learned=learned)
        report = scores(fitted.predict(rows), fitted, label_col).withColumn("place", F.lit(place))
        reports = report if reports is None else reports.unionByName(report)
    reports = stage(reports, "scores")  # a row a candidate and split
    unstage(spark, rows)
    order = F.struct("log_loss", "place")
    best = reports.where("split = 'validation'").agg(F.min_by("model", order).alias("best"))
    picked = F.coalesce(F.col("model") == F.col("best"), F.lit(False))
    return reports.crossJoin(F.broadcast(best)).withColumn("chosen", picked).drop("best", "place")
