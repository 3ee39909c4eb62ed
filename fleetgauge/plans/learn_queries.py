"""Oversampling and learning."""

from __future__ import annotations

import os
from datetime import date

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import functions as fn
from ..operators import learn, neighbours, sampling
from ..session import hand_off, scratch_folder, work_folder
from ..sources import union_all
from .registry import query, table

NEAREST = """nearest AS (
    SELECT * FROM (
      SELECT vec_id, neighbour, distance, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour) AS INTEGER) AS rank
      FROM (SELECT a.vec_id, b.vec_id AS neighbour,
                   list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS distance
            FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id))
    WHERE rank <= 5)"""


@query(f"WITH {NEAREST} SELECT vec_id, rank, neighbour, round(distance, 6) AS distance FROM nearest")
def smote_neighbors(spark, sf_dir):
    near = neighbours.nearest_neighbours(
        table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", k=5
    )
    return near.withColumn("distance", fn.round_to("distance", 6))


@query(f"WITH {NEAREST} SELECT vec_id, rank, neighbour, round(distance, 6) AS distance FROM nearest")
def smote_neighbors_by_tree(spark, sf_dir):
    """The same through a tree of several levels; the small cells are what makes it deep."""
    near = neighbours.nearest_neighbours(
        table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", k=5, block_rows=10, fan=3
    )
    return near.withColumn("distance", fn.round_to("distance", 6))


def _share(seed: int) -> str:
    text = f"'{seed}|' || CAST(vec_id AS VARCHAR) || '|' || CAST(copy AS VARCHAR)"
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE))"


@query(
    f"""
    WITH {NEAREST},
    sizes AS (SELECT label, count(*) AS c, max(count(*)) OVER () AS top FROM embeddings GROUP BY label),
    base AS (SELECT e.vec_id, e.label, CAST(e.embedding AS DOUBLE[]) AS x, c, top,
                    row_number() OVER (PARTITION BY e.label ORDER BY md5('42|' || CAST(vec_id AS VARCHAR)), vec_id) AS r
             FROM embeddings e JOIN sizes s ON s.label = e.label),
    copies AS (SELECT *, unnest(generate_series(1, (top - c) // c + CASE WHEN r <= (top - c) % c THEN 1 ELSE 0 END)) AS copy
               FROM base WHERE c < top),
    drawn AS (SELECT *, CAST(1 + floor({_share(42)} * least(5, c - 1)) AS INTEGER) AS pick, {_share(43)} AS u FROM copies),
    new AS (SELECT CAST(d.vec_id AS VARCHAR) || '#' || CAST(copy AS VARCHAR) AS vec_id, d.label, 1 AS synthetic,
                   x[1] + u * (y.embedding[1]::DOUBLE - x[1]) AS first,
                   list_sum(x) + u * (list_sum(CAST(y.embedding AS DOUBLE[])) - list_sum(x)) AS total
            FROM drawn d JOIN nearest n ON n.vec_id = d.vec_id AND n.rank = d.pick
            JOIN embeddings y ON y.vec_id = n.neighbour)
    SELECT vec_id, label, synthetic, round(first, 6) + 0.0 AS first, round(total, 6) + 0.0 AS total FROM new
    UNION ALL
    SELECT CAST(vec_id AS VARCHAR), label, 0, round(x[1], 6) + 0.0, round(list_sum(x), 6) + 0.0 FROM base
    """
)
def smote_samples(spark, sf_dir):
    out = neighbours.smote(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return out.select(
        "vec_id",
        "label",
        "synthetic",
        fn.round_to(F.col("embedding")[0], 6).alias("first"),
        fn.round_to(total, 6).alias("total"),
    )


@query(
    """
    SELECT label, CAST(max(count(*)) OVER () AS BIGINT) AS n FROM embeddings GROUP BY label
    """
)
def smote_balance(spark, sf_dir):
    out = neighbours.smote(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


FEATURES = ["n", "total", "purchases"]
RULE = "purchases >= 1"  # a label that every family must learn without an error


def labelled_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User days, labelled by a rule on one of the features."""
    sums = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.count_if(F.col("event_type") == "purchase").alias("purchases")
    )
    named = sums.withColumn("ident", F.concat_ws("|", "user_id", F.date_format("day", "yyyy-MM-dd")))
    return hand_off(named.withColumn("target", F.expr(f"CASE WHEN {RULE} THEN 1 ELSE 0 END")), "labelled-panel")


def _tuned(panel: DataFrame) -> learn.Tuned:
    """All four families, each over two settings, trained on the days up to 29 January."""
    train, test = learn.training_sets(
        panel, ident="ident", features=FEATURES, day="day", start=date(2024, 1, 1), end=date(2024, 1, 29), noise=0,
    )
    train = hand_off(train, "train")
    specs = [
        learn.Spec("random_forest", RandomForestClassifier(seed=42, featureSubsetStrategy="all"), {"maxDepth": [3, 5]}),
        learn.Spec("logistic_regression", LogisticRegression(maxIter=1000, standardization=False), {"inverseStrength": [1, 10]}),
        learn.Spec("boosting_a", GBTClassifier(seed=42), {"maxDepth": [3, 5], "minInfoGain": [0.0]}),
        learn.Spec("boosting_b", GBTClassifier(seed=42), {"maxDepth": [3, 5], "positiveWeight": [3]}),
    ]
    # Two queries use these models; the second finds the fits of the first.
    return learn.grid_search(
        train, test, specs, features=FEATURES, ident="ident", stages=learn.fit_preprocessing(train, FEATURES, FEATURES), ledger=_ledger(panel.sparkSession)
    )


def _ledger(spark: SparkSession) -> str:
    return os.path.join(work_folder(spark), "fit-ledger")


@query(
    """
    SELECT * FROM (VALUES
      ('boosting_a', 1.0::DOUBLE, 1.0::DOUBLE, 'maxDepth=3, minInfoGain=0.0'), ('boosting_b', 1.0, 1.0, 'maxDepth=3, positiveWeight=3'),
      ('logistic_regression', 1.0, 1.0, 'inverseStrength=1'), ('random_forest', 1.0, 1.0, 'maxDepth=3'))
      AS t(model, best_cv_score, test_accuracy, best_parameters)
    """
)
def model_leaderboard(spark, sf_dir):
    return _tuned(labelled_panel(spark, sf_dir)).leaderboard


DAY_PURCHASES = """
    SELECT user_id, CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'purchase') AS purchases FROM events GROUP BY ALL"""


@query(
    f"""
    WITH d AS ({DAY_PURCHASES})
    SELECT user_id, day, name AS model, CASE WHEN purchases >= 1 THEN 1 ELSE 0 END AS predicted_risk, purchases >= 1 AS likely
    FROM d, (VALUES ('random_forest'), ('logistic_regression'), ('boosting_a'), ('boosting_b')) AS m(name)
    WHERE day = DATE '2024-01-30'
    """
)
def score_day(spark, sf_dir):
    """Scores of one day by every family, from models that bring their preprocessing along."""
    panel = labelled_panel(spark, sf_dir)
    tuned = _tuned(panel)

    def scored(name):
        rows = learn.score(panel, learn.choose(tuned, name), ["user_id", "day"], features=FEATURES, day="day", on=date(2024, 1, 30))
        return rows.select("user_id", "day", F.lit(name).alias("model"), "predicted_risk", (F.col("risk_probability") > 0.5).alias("likely"))

    return union_all([scored(name) for name in tuned.models])


@query(
    f"""
    WITH d AS ({DAY_PURCHASES})
    SELECT user_id, day, CASE WHEN purchases >= 1 THEN 1 ELSE 0 END AS predicted_risk, CAST(4 AS BIGINT) AS models, CAST(1 AS BIGINT) AS version FROM d WHERE day > DATE '2024-01-28'
    """
)
def scores_of_stored_models(spark, sf_dir):
    """All models stored as a version and loaded again; the days are scored by the boosted ones, whatever the leaderboard says.

    Features are the columns that a list of others leaves.
    """
    panel = labelled_panel(spark, sf_dir)
    folder = scratch_folder(spark, "models")
    version = learn.save_version(_tuned(panel), folder)
    stored = learn.load_version(spark, folder)
    features = learn.feature_columns(panel, ["user_id", "day", "ident", "not_there"])
    days = panel.where(F.col("day") > F.lit(date(2024, 1, 28)))
    rows = learn.score(days, learn.choose(stored, "boosting_b"), ["user_id", "day"], features=features)
    return rows.select("user_id", "day", "predicted_risk", F.lit(len(stored.models)).cast("long").alias("models"), F.lit(version).cast("long").alias("version"))


NOISY = f"""d AS (SELECT user_id || '|' || strftime(day, '%Y-%m-%d') AS ident, CASE WHEN purchases >= 1 THEN 1 ELSE 0 END AS truth, day FROM ({DAY_PURCHASES})),
    z AS (SELECT *, row_number() OVER (PARTITION BY truth ORDER BY md5('42|' || ident), ident) AS r, count(*) OVER (PARTITION BY truth) AS c FROM d),
    y AS (SELECT ident, truth, day, CASE WHEN truth = 0 AND r <= floor(c * CAST(0.1 AS DOUBLE)) THEN 1 ELSE truth END AS target FROM z),
    train AS (SELECT ident, truth, target, row_number() OVER (PARTITION BY target ORDER BY md5('45|' || ident), ident) AS r, count(*) OVER (PARTITION BY target) AS c
              FROM y WHERE day < DATE '2024-01-25'),
    folded AS (SELECT truth, target, CAST((r > floor(c / 3)) AS INTEGER) + CAST((r > floor(c * 2 / 3)) AS INTEGER) AS fold FROM train
               UNION ALL SELECT truth, target, -1 FROM y WHERE day >= DATE '2024-01-25')"""
# What the settings come to on these labels: the rule itself, the larger class, or always 1.
SETTINGS = [
    ("random_forest", "maxDepth=1, minInfoGain=0.0, subsamplingRate=0.8", "truth"),
    ("random_forest", "maxDepth=1, minInfoGain=0.6, subsamplingRate=0.8", "0"),
    ("logistic_regression", "inverseStrength=1e-09", "0"),
    ("logistic_regression", "inverseStrength=10", "truth"),
    ("boosting_a", "minInfoGain=0.0, stepSize=0.05, subsamplingRate=0.7", "truth"),
    ("boosting_a", "minInfoGain=0.0, stepSize=0.05, subsamplingRate=0.8", "truth"),
    ("boosting_a", "minInfoGain=5.0, stepSize=0.05, subsamplingRate=0.7", "0"),
    ("boosting_a", "minInfoGain=5.0, stepSize=0.05, subsamplingRate=0.8", "0"),
    ("boosting_b", "positiveWeight=1, stepSize=0.1", "truth"),
    ("boosting_b", "positiveWeight=50, stepSize=0.1", "1"),
]


@query(
    f"""
    WITH {NOISY},
    settings AS (SELECT * FROM (VALUES {", ".join(f"('{f}', '{s}', '{k}')" for f, s, k in SETTINGS)}) AS t(family, setting, says)),
    scored AS (SELECT family, setting, fold, CASE says WHEN 'truth' THEN truth ELSE CAST(says AS INTEGER) END = target AS hit FROM folded, settings),
    lines AS (SELECT family, setting, fold, avg(CASE WHEN hit THEN 1 ELSE 0 END) AS score FROM scored GROUP BY ALL),
    best AS (SELECT family, setting FROM lines WHERE fold >= 0 GROUP BY family, setting QUALIFY row_number() OVER (PARTITION BY family ORDER BY round(avg(score), 9) DESC, setting) = 1)
    SELECT family, setting, fold, round(score, 6) AS score FROM lines WHERE fold >= 0 OR (family, setting) IN (SELECT (family, setting) FROM best)
    """
)
def search_ledger(spark, sf_dir):
    """Every fit of a search over noisy labels, as the ledger has it; fold -1 is the last fit, scored on the test days."""
    panel = labelled_panel(spark, sf_dir)
    noisy = hand_off(sampling.flip_labels(panel, "ident", "target", ratio=0.1), "noisy")
    split = F.col("day") >= F.lit(date(2024, 1, 25))
    specs = [
        learn.Spec("random_forest", RandomForestClassifier(seed=42, numTrees=5, featureSubsetStrategy="all"), {"maxDepth": [1], "minInfoGain": [0.0, 0.6], "subsamplingRate": [0.8]}),
        learn.Spec("logistic_regression", LogisticRegression(maxIter=1000, standardization=False), {"inverseStrength": [1e-9, 10]}),
        learn.Spec("boosting_a", GBTClassifier(seed=42, maxIter=3, maxDepth=1), {"minInfoGain": [0.0, 5.0], "stepSize": [0.05], "subsamplingRate": [0.7, 0.8]}),
        learn.Spec("boosting_b", GBTClassifier(seed=42, maxIter=3, maxDepth=1), {"positiveWeight": [1, 50], "stepSize": [0.1]}),
    ]
    folder = os.path.join(work_folder(spark), "noisy-ledger")
    train, test = noisy.where(~split), noisy.where(split)
    stages = learn.fit_preprocessing(train, FEATURES, FEATURES)
    tuned = learn.grid_search(train, test, specs, features=FEATURES, ident="ident", stages=stages, ledger=folder)
    return tuned.lines.select("family", "setting", "fold", fn.round_to("score", 6).alias("score"))
