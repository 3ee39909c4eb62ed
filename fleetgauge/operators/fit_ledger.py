"""A record of finished fits, so that a search that was stopped goes on where it ended."""

from __future__ import annotations

import os
from dataclasses import dataclass
from hashlib import sha256

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..sources.scan import _load

# ``place`` is the setting's number in the grid; fold -1 is the last fit, on all training rows, scored on the test rows.
LINE = "run string, family string, place int, setting string, fold int, score double"
LAST_FIT = -1


@dataclass(frozen=True)
class FitLedger:
    """``folder`` keeps one line per finished fit and, for each family, the model of the last fit.

    ``run`` names the data, the estimator and the way of searching: lines of other runs in the same folder do not count. A line is its own
    small folder, which appears as a whole or not at all, so fits may end side by side and at any time.
    """

    folder: str
    run: str

    def lines(self, spark: SparkSession) -> DataFrame:
        """All lines of this run."""
        stored = _load(spark.read.format("json").schema(LINE), os.path.join(self.folder, "lines", "*"))
        if stored is None:
            return spark.createDataFrame([], LINE)
        return stored.where(F.col("run") == self.run)

    def _name(self, *parts: object) -> str:
        return sha256("|".join(map(str, (self.run, *parts))).encode()).hexdigest()[:32]

    def add(self, spark: SparkSession, family: str, place: int, setting: str, fold: int, score: float) -> None:
        line = spark.createDataFrame([(self.run, family, place, setting, fold, score)], LINE).coalesce(1)
        line.write.mode("overwrite").json(os.path.join(self.folder, "lines", self._name(family, setting, fold)))

    def _model(self, family: str, setting: str) -> str:
        return os.path.join(self.folder, "models", self._name(family, setting))

    def keep_model(self, family: str, setting: str, model: PipelineModel) -> None:
        """To be called before the line of the last fit is added: a line promises a model."""
        model.write().overwrite().save(self._model(family, setting))

    def model(self, family: str, setting: str) -> PipelineModel:
        return PipelineModel.load(self._model(family, setting))


def mean_scores(lines: DataFrame) -> DataFrame:
    """family, place, setting, folds and the mean score over the folds."""
    return lines.where(F.col("fold") != LAST_FIT).groupBy("family", "place", "setting").agg(F.count(F.lit(1)).alias("folds"), F.avg("score").alias("cv_score"))


def leaderboard(lines: DataFrame) -> DataFrame:
    """model, best_cv_score, test_accuracy, best_parameters: the best setting of each family, best family first.

    Of equal scores the first setting of the grid wins. Families without a last fit have no test accuracy yet.
    """
    first = W.partitionBy("family").orderBy(F.col("cv_score").desc(), "place")
    best = mean_scores(lines).withColumn("rank", F.row_number().over(first)).where("rank = 1")
    last = lines.where(F.col("fold") == LAST_FIT).select("family", "place", F.col("score").alias("test_accuracy"))
    return best.join(last, ["family", "place"], "left").select(
        F.col("family").alias("model"), F.col("cv_score").alias("best_cv_score"), "test_accuracy", F.col("setting").alias("best_parameters")
    ).orderBy(F.desc("best_cv_score"), "model")
