"""Training, choosing and applying risk classifiers with ``pyspark.ml``."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import hand_off, interim
from ..sources.published import Versions, observed_write
from ..functions import nan_to_null
from .clean import fit_scaler
from .fit_ledger import LAST_FIT, LINE, FitLedger, leaderboard, mean_scores
from .neighbours import smote
from .sampling import flip_labels, hash_split, stratified_folds

# Search grids. A forest without a depth limit gets Spark's deepest
# tree; a minimum split size s becomes ceil(s / 2) rows per node; two column
# samples per tree and level multiply. The least gain of a split is a sum over the loss
# there and a reduction of variance per node here, where 0.1 would stop most trees at the root: it is 0. Leaf
# numbers, L1 and L2 terms of boosted trees and the solver of the regression have no counterpart.
RANDOM_FOREST_GRID = {
    "numTrees": [15, 25, 35, 50, 100],
    "maxDepth": [3, 5, 7, 11, 30],
    "minInstancesPerNode": [1, 2, 3],
}
LOGISTIC_GRID = {"inverseStrength": [0.01, 0.1, 1, 10]}
BOOSTING_A_GRID = {
    "maxIter": [50],
    "maxDepth": [3, 5],
    "stepSize": [0.01, 0.05],
    "minInstancesPerNode": [10, 20],
    "subsamplingRate": [0.7, 0.8],
    "featureSubsetStrategy": ["0.7", "0.8"],
    "minInfoGain": [0.0],
}
BOOSTING_B_GRID = {
    "maxIter": [50, 100],
    "maxDepth": [3, 5],
    "stepSize": [0.01, 0.05],
    "minInstancesPerNode": [3, 5],
    "minInfoGain": [0.0],
    "subsamplingRate": [0.7, 0.8],
    "featureSubsetStrategy": ["0.49", "0.56", "0.64"],
    "positiveWeight": [3, 5],
}


# Added to the seed, so that label noise, test rows and folds are cut in orders of their own: in one and the same
# order the flipped labels would all be test rows, or all in the first fold.
SPLIT_SEED, FOLD_SEED = 2, 3


@dataclass(frozen=True)
class Spec:
    """A named estimator with its grid.

    Two grid entries are not parameters of the estimator itself:
    ``inverseStrength`` is a regularisation strength C relative to the number of
    training rows, ``positiveWeight`` the weight of rows labelled 1.
    """

    name: str
    estimator: Estimator
    grid: Mapping[str, Sequence] = field(default_factory=dict)


def default_specs(seed: int = 42) -> list[Spec]:
    return [
        Spec("random_forest", RandomForestClassifier(seed=seed), RANDOM_FOREST_GRID),
        Spec(
            "logistic_regression",
            LogisticRegression(maxIter=1000, elasticNetParam=0.0, standardization=False),
            LOGISTIC_GRID,
        ),
        Spec("boosting_a", GBTClassifier(seed=seed), BOOSTING_A_GRID),
        Spec("boosting_b", GBTClassifier(seed=seed), BOOSTING_B_GRID),
    ]


@dataclass(frozen=True)
class Tuned:
    """Fitted models by name, their leaderboard, best first, and the lines of all fits."""

    models: dict[str, PipelineModel]
    leaderboard: DataFrame
    lines: DataFrame


def _weight_name(weight: object) -> str:
    return f"__weight_{weight}"


def _grid_points(spec: Spec) -> list[dict]:
    """All settings of the grid, by the names of the grid, in order."""
    return [dict(zip(spec.grid, values, strict=True)) for values in product(*spec.grid.values())]


def _param_map(spec: Spec, point: Mapping, rows: float) -> dict:
    """Spark's parameters for one setting, where ``rows`` rows are fitted on."""
    out = {}
    for name, value in point.items():
        if name == "inverseStrength":
            name, value = "regParam", 1.0 / (value * rows)
        elif name == "positiveWeight":
            name, value = "weightCol", _weight_name(value)
        out[spec.estimator.getParam(name)] = value
    return out


def _setting(point: Mapping) -> str:
    return ", ".join(f"{name}={point[name]}" for name in sorted(point))


def _signature(estimator: Estimator) -> str:
    """The kind of an estimator and what was set on it."""
    chosen = {p.name: estimator.getOrDefault(p) for p in estimator.params if estimator.isSet(p)}
    return f"{type(estimator).__name__}{sorted(chosen.items())}"


def _fit(spec: Spec, params: Mapping, rows: DataFrame):
    """The fitted model without its training summary.

    The summary holds the session, which goes to tasks with the model; in this version of Spark that fails once any result
    of the session was observed, as ``publish`` does.
    """
    model = spec.estimator.fit(rows, dict(params))
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(rows.sparkSession._jvm.scala.Option.empty())
    return model


def _accuracy(scored: DataFrame) -> float:
    # An evaluator of its own: tasks carry it along, and it is written to when it is used.
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    return float(evaluator.evaluate(scored))


# Rows of one task of a fit: small sets are fitted by few tasks, as a fit is a long chain of short jobs.
FIT_TASK_ROWS = 50_000


def grid_search(
    train: DataFrame,
    test: DataFrame,
    specs: Sequence[Spec],
    *,
    features: Sequence[str],
    label: str = "target",
    ident: str,
    folds: int = 3,
    parallelism: int = 8,
    seed: int = 42,
    stages: Sequence[Transformer] = (),
    ledger: str | None = None,
) -> Tuned:
    """Cross-validated grid search by accuracy over stratified folds; refits the best of
    each spec on all training rows and measures it on ``test``.

    Of equal scores the first setting of the grid wins. ``inverseStrength`` is taken relative to the rows that
    a fit sees: two thirds of them in three folds, all of them in the last fit. ``stages`` are
    fitted steps, such as ``fit_preprocessing`` gives, that every stored model begins with. Interim tables are
    dropped at the end. Fits of all specs and folds run side by side, ``parallelism`` at a time; each fold is stored
    as a folder of its own, so a fit reads the rows it needs.

    ``ledger`` is a folder in which every finished fit leaves a line and every last fit its model. A search that was stopped
    and is started again with the same rows, features, folds and estimators runs only the fits that are missing; one over a larger
    grid only the new ones.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    weights = {w for s in specs for w in s.grid.get("positiveWeight", ())}

    def prepared(df: DataFrame) -> DataFrame:
        out = assembler.transform(df.withColumn("label", F.col(label).cast("double")))
        return out.withColumns(
            {_weight_name(w): F.when(F.col("label") == 1, float(w)).otherwise(1.0) for w in weights}
        )

    keep = ["label", "features", *map(_weight_name, sorted(weights))]
    before = PipelineModel([*stages])
    spark = train.sparkSession
    with interim(spark):
        # Read by the cuts of the folds and by the fold numbers.
        balanced = hand_off(train, "balanced")
        folded = before.transform(stratified_folds(balanced, ident, label, folds=folds, seed=seed + FOLD_SEED, output="fold"))
        folded = hand_off(folded.select("fold", label, *features), "folded")
        held = hand_off(before.transform(test).select(label, *features), "test-rows")
        digest = [F.count(F.lit(1)), F.sum(F.xxhash64("fold", label, *features).cast("decimal(38,0)"))]
        n, total = folded.agg(*digest).first()
        if n == 0:
            raise ValueError("no training rows")
        digest = held.agg(F.count(F.lit(1)), F.sum(F.xxhash64(label, *features).cast("decimal(38,0)"))).first()
        run = f"{n}|{total}|{tuple(digest)}|{list(features)}|{folds}|{seed}"
        tasks = max(1, -(-n // FIT_TASK_ROWS))
        part = lambda rows: hand_off(prepared(rows).select(*keep).coalesce(tasks), "fit-rows")
        by_fold = [part(folded.where(F.col("fold") == k)) for k in range(folds)]
        testing = part(held)
        books = {s.name: FitLedger(ledger, f"{run}|{_signature(s.estimator)}") for s in specs} if ledger else {}
        done = {(r.family, r.setting, r.fold): r.score for book in books.values() for r in book.lines(spark).collect()}

        def fit(spec: Spec, place: int, fold: int):
            """The line of one fit; that of the ledger if it is there."""
            point, book = _grid_points(spec)[place], books.get(spec.name)
            setting, model = _setting(point), None
            score = done.get((spec.name, setting, fold))
            if score is None:
                others = [rows for k, rows in enumerate(by_fold) if k != fold]
                params = _param_map(spec, point, n if fold == LAST_FIT else n * (folds - 1) / folds)
                model = _fit(spec, params, reduce(DataFrame.unionByName, others).coalesce(tasks))
                score = _accuracy(model.transform(testing if fold == LAST_FIT else by_fold[fold]))
                if fold == LAST_FIT:
                    model = PipelineModel([*stages, assembler, model])
                    if book:
                        book.keep_model(spec.name, setting, model)
                if book:
                    book.add(spark, spec.name, place, setting, fold, score)
            elif fold == LAST_FIT:
                model = book.model(spec.name, setting)
            return (run, spec.name, place, setting, fold, score), model

        with ThreadPool(max(1, parallelism)) as pool:
            several = lambda jobs: pool.starmap(inheritable_thread_target(spark)(fit), jobs, chunksize=1)
            crossed = [(s, p, k) for s in specs for p in range(len(_grid_points(s))) for k in range(folds)]
            lines = [line for line, _ in several(crossed)]
            means = mean_scores(spark.createDataFrame(lines, LINE)).collect()
            best = {s.name: min((-m.cv_score, m.place) for m in means if m.family == s.name)[1] for s in specs}
            last = several([(s, best[s.name], LAST_FIT) for s in specs])
    models = {line[1]: model for line, model in last}
    lines = spark.createDataFrame([*lines, *(line for line, _ in last)], LINE)
    return Tuned(models, leaderboard(lines), lines)


def feature_columns(df: DataFrame, drop: Sequence[str], label: str = "target") -> list[str]:
    """All columns that are neither listed nor the label; listed names may be absent."""
    return [c for c in df.columns if c not in {*drop, label}]


def _oversampled(df: DataFrame, ident: str, features: Sequence[str], label: str, k: int, seed: int) -> DataFrame:
    packed = df.select(ident, label, F.array(*[F.col(c).cast("double") for c in features]).alias("__x"))
    out = smote(packed, ident, "__x", label, k=k, seed=seed)
    return out.select(ident, label, *[F.col("__x")[i].alias(c) for i, c in enumerate(features)])


def training_sets(
    panel: DataFrame,
    *,
    ident: str,
    features: Sequence[str],
    label: str = "target",
    day: str | None = None,
    start: date | None = None,
    end: date | None = None,
    noise: float = 0.1,
    test_fraction: float = 0.2,
    k: int = 5,
    seed: int = 42,
    reference_order: bool = False,
    max_fit_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows: complete rows of the day range, some labels flipped,
    classes balanced, one fifth held out.

    ``max_fit_rows`` bounds the labelled rows that models are fitted on, by default not at all: of more rows an
    exact sample in hash order is taken before labels are flipped, so balancing, which
    compares the rows of a class with each other, does not grow with the table.

    By default the test rows are set aside before classes are balanced, so no new
    row is made from them. ``reference_order`` balances first and splits after.
    """
    rows = panel
    if start is not None and end is not None:
        rows = rows.where(F.to_date(F.col(day)).between(F.lit(start), F.lit(end)))
    rows = rows.select(ident, label, *features).dropna()
    if max_fit_rows is not None:
        known = hand_off(rows, "complete")
        share = min(1.0, max_fit_rows / max(1, known.count()))
        rows = hash_split(known, ident, share, seed=seed + 1, output="__fit").where("__fit = 1").drop("__fit")
    if noise:
        rows = flip_labels(rows, ident, label, ratio=noise, seed=seed)
    rows = hand_off(rows, "labelled")
    if rows.isEmpty():
        raise ValueError("no complete rows in the training range")
    if reference_order:
        rows = hand_off(_oversampled(rows, ident, features, label, k, seed), "balanced")
    split = hand_off(hash_split(rows, ident, test_fraction, seed=seed + SPLIT_SEED, output="__test"), "split")
    train = split.where("__test = 0").drop("__test")
    test = split.where("__test = 1").drop("__test")
    if not reference_order:
        train = _oversampled(train, ident, features, label, k, seed)
    return train, test


def score(
    df: DataFrame,
    model: PipelineModel,
    ids: Sequence[str],
    *,
    features: Sequence[str],
    day: str | None = None,
    on: date | None = None,
) -> DataFrame:
    """Class and probability of class 1 for the rows of one day, with identifiers and features.

    The classifiers refuse empty cells; fill them first, for example with ``fit_imputer``.
    """
    rows = df if on is None else df.where(F.to_date(F.col(day)) == F.lit(on))
    scored = model.transform(rows.select(*ids, *[F.col(c).cast("double").alias(c) for c in features]))
    return scored.select(
        *ids,
        *features,
        F.col("prediction").cast("int").alias("predicted_risk"),
        vector_to_array("probability")[1].alias("risk_probability"),
    )


def _replacing(cols: Mapping[str, str]) -> SQLTransformer:
    """A stored step that replaces columns by SQL expressions."""
    names = ", ".join(f"`{c}`" for c in cols)
    new = ", ".join(f"{e} AS `{c}`" for c, e in cols.items())
    return SQLTransformer(statement=f"SELECT * EXCEPT ({names}), {new} FROM __THIS__")


def fit_imputer(df: DataFrame, features: Sequence[str], *, empty: float = 0.0) -> PipelineModel:
    """Mean of each feature for its empty cells, to be applied before ``score``.

    NaN counts as empty. A feature without any value gets ``empty`` throughout. The means are part of the
    step, so a stored one fills later tables as it filled the first.
    """
    typed = nan_to_null(df.select(*[F.col(c).cast("double").alias(c) for c in features]))
    means = typed.agg(*[F.avg(c).alias(c) for c in features]).first()
    value = {c: empty if means[c] is None else means[c] for c in features}
    return PipelineModel([_replacing({c: f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {value[c]!r}D)" for c in features})])


def fit_preprocessing(train: DataFrame, features: Sequence[str], scaled: Sequence[str]) -> list[Transformer]:
    """Stored steps fitted on training rows: empty cells to means, then ``scaled`` columns centred and scaled.

    Pass them to ``grid_search`` as ``stages``: they are saved with every model, and scoring repeats them
    with the numbers of the training rows.
    """
    imputer = fit_imputer(train, features)
    if not scaled:
        return [*imputer.stages]
    fit = fit_scaler(imputer.transform(train), list(scaled)).first()
    scale = {c: f"(`{c}` - {fit[c]['mean'] or 0.0!r}D) / {fit[c]['scale'] or 1.0!r}D" for c in scaled}
    return [*imputer.stages, _replacing(scale)]


def choose(tuned: Tuned, select: str = "best") -> PipelineModel:
    """The model at the top of the leaderboard, or a named one."""
    if select != "best":
        return tuned.models[select]
    return tuned.models[tuned.leaderboard.first()["model"]]


def save_models(tuned: Tuned, folder: str) -> None:
    for name, model in tuned.models.items():
        model.write().overwrite().save(os.path.join(folder, name))


def load_model(folder: str, name: str) -> PipelineModel:
    return PipelineModel.load(os.path.join(folder, name))


def save_version(tuned: Tuned, folder: str) -> int:
    """Store all models with their leaderboard as the next version of ``folder``; gives its number.

    Models bring their preprocessing along. A version is shown by a file that is written last: a save that stops midway leaves the
    one before it the current one.
    """
    spark, versions = tuned.leaderboard.sparkSession, Versions(folder)
    place = versions.new_place()
    save_models(tuned, os.path.join(place, "models"))
    facts = observed_write(tuned.lines.coalesce(1), os.path.join(place, "lines"))
    return versions.show(spark, place, facts)


def load_version(spark: SparkSession, folder: str, version: int | None = None) -> Tuned:
    """Models, leaderboard and lines of the current version, or of a numbered one."""
    place = Versions(folder).place(spark, version)
    lines = spark.read.schema(LINE).parquet(os.path.join(place, "lines"))
    board = leaderboard(lines)
    models = {r.model: load_model(os.path.join(place, "models"), r.model) for r in board.collect()}
    return Tuned(models, board, lines)
