import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from fleetgauge.operators import learn, metric_tree, neighbours
from fleetgauge.session import hand_off


def brute_force(points, k):
    """(id, rank) -> (neighbour, distance) by measuring every pair of a class."""
    want = {}
    for i, c, x in points:
        others = sorted((float(np.sqrt(((x - y) ** 2).sum())), j) for j, d, y in points if d == c and j != i)
        for r, (dist, j) in enumerate(others[:k], 1):
            want[i, r] = (j, dist)
    return want


@pytest.mark.parametrize("block_rows", [None, 40, 7])
def test_neighbours_equal_brute_force(spark, block_rows):
    rng = np.random.default_rng(7)
    # clusters, a third of all rows copies of one point, and a second small class
    centres = rng.normal(size=(4, 3)) * 20
    points = [(i, 1, centres[i % 4] + rng.normal(size=3)) for i in range(200)]
    points += [(i, 1, centres[0]) for i in range(200, 300)]
    points += [(i, 2, rng.normal(size=3)) for i in range(300, 304)]
    df = spark.createDataFrame([(i, c, x.tolist()) for i, c, x in points], "id long, c int, x array<double>")
    got = neighbours.nearest_neighbours(df, "id", "x", "c", k=5, block_rows=block_rows, fan=4)
    found = {(r.id, r["rank"]): (r.neighbour, r.distance) for r in got.collect()}
    want = brute_force(points, 5)
    assert found.keys() == want.keys()
    for key, (j, dist) in want.items():
        assert found[key][0] == j and found[key][1] == pytest.approx(dist, abs=1e-12)


def test_parts_of_a_split_are_larger_than_its_leaves(spark, monkeypatch):
    parts, store = [], metric_tree.hand_off

    def kept(df, label):
        out = store(df, label)
        if label == "large-cells":
            parts.append(out.agg(F.sum("__salts")).first()[0])
        return out

    monkeypatch.setattr(metric_tree, "hand_off", kept)
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, 1, x.tolist()) for i, x in enumerate(rng.normal(size=(400, 3)))], "__id long, __class int, __x array<double>")
    df = hand_off(df, "points")
    cells = lambda tree: rows(tree.rows, "__id", "__cell", "__away")
    small = cells(metric_tree.build(df, 20, fan=4))
    few = len(parts)
    assert cells(metric_tree.build(df, 20, part_rows=1_000, fan=4)) == small
    assert parts[0] == 20 and parts[few] == 1  # groups of the first level


class Named(str):
    compared = 0
    __hash__ = str.__hash__

    def __eq__(self, other):
        Named.compared += 1
        return str.__eq__(self, other)


@pytest.mark.parametrize("ident", [lambda i: i, lambda i: Named(f"n{i % 1000}|{i}")])
def test_a_task_does_not_compare_names_of_all_pairs(ident, monkeypatch):
    rng = np.random.default_rng(11)
    long = np.round(np.sort(rng.uniform(0, 60, 2_400)), 2)  # many equal values, so that neighbours tie
    x = np.stack([rng.integers(1, 4, len(long)), long, rng.integers(1, 3, len(long))], axis=1).astype("float64")
    ids = [ident(i) for i in range(len(x))]
    leaf = [f"/{i // 100:02d}" for i in range(len(x))]
    order = rng.permutation(len(x))
    queries = pd.DataFrame({"__id": ids, "__x": list(x), "__leaf": leaf, "__limit": np.inf}).iloc[order]
    block = queries.drop(columns="__limit").rename(columns={c: f"__of{c}" for c in ("__id", "__x", "__leaf")})

    monkeypatch.setattr(Named, "compared", 0)
    found = neighbours._kernel(5)(queries, block)
    assert Named.compared <= 20 * len(x)

    got = {}
    for i, j, away in sorted(zip(found["__id"], found["distance"], found["__nn"], strict=True)):
        got.setdefault(i, []).append((j, away))
    for i in range(len(x)):
        apart = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        assert got[ids[i]] == sorted((apart[j], ids[j]) for j in range(len(x)) if j != i)[:5]


def test_a_number_that_is_missing_is_no_row_of_its_own():
    frame = pd.DataFrame({"__id": [1.0, np.nan, 3.0], "__x": [[0.0], [1.0], [5.0]], "__leaf": "", "__limit": np.inf})
    block = frame.drop(columns="__limit").rename(columns={c: f"__of{c}" for c in ("__id", "__x", "__leaf")})
    found = neighbours._kernel(1)(frame, block).fillna(-1)
    assert sorted(found.itertuples(index=False, name=None)) == [(-1, -1, 0.0), (1, -1, 1.0), (3, -1, 4.0)]


def test_small_groups_of_a_cell_may_be_empty(spark):
    rng = np.random.default_rng(5)
    points = [(f"n{i:02d}", 1, rng.normal(size=8)) for i in range(60)]
    df = spark.createDataFrame([(i, c, x.tolist()) for i, c, x in points], "id string, c int, x array<double>")
    # thirty groups of about two rows each: some have none
    found = {(r.id, r["rank"]): r.neighbour for r in neighbours.nearest_neighbours(df, "id", "x", "c", k=3, block_rows=2, fan=3).collect()}
    assert found == {key: j for key, (j, _) in brute_force(points, 3).items()}


@pytest.mark.parametrize("width", [1, 3])
def test_blocks_of_narrow_rows_are_bounded(spark, width, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 60)
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 9)
    asked = []
    search = neighbours._search
    monkeypatch.setattr(neighbours, "_search", lambda q, c, pairs, k, seed: asked.append((c, pairs)) or search(q, c, pairs, k, seed))
    rng = np.random.default_rng(11)
    points = [(f"{i}", i % 2, np.round(rng.normal(size=width) * 30, 1)) for i in range(500)] + [(f"{i}", 0, np.zeros(width)) for i in range(500, 600)]
    df = spark.createDataFrame([(i, c, x.tolist()) for i, c, x in points], "id string, c int, x array<double>")
    found = {(r.id, r["rank"]): (r.neighbour, r.distance) for r in neighbours.nearest_neighbours(df, "id", "x", "c").collect()}
    want = brute_force(points, 5)
    assert found.keys() == want.keys()
    for key, (j, dist) in want.items():
        assert found[key][0] == j and found[key][1] == pytest.approx(dist, abs=1e-12)
    for rows_of, pairs in asked:
        sizes = {(r["__class"], r["__cell"]): r["count"] for r in rows_of.groupBy("__class", "__cell").count().collect()}
        assert len(sizes) > 8 and all(sizes[r["__class"], r.c] <= 60 * r.c_blocks for r in pairs.collect())


def test_queries_out_of_reach_of_a_cell_are_not_sent(spark):
    """Of a cell that may look into another, only the rows whose own k-th neighbour is as far away as that."""
    at = [(0, 0.0, 1.0), (1, 9.0, 1.0), (2, 8.5, 1.0), (3, 0.0, 8.5), (4, 0.0, float("inf")), (5, float("nan"), 1.0)]
    queries = spark.createDataFrame([(1, i, [x], "/1", limit) for i, x, limit in at], "__class int, __id long, __x array<double>, __cell string, __limit double")
    known = spark.createDataFrame([(1, "/1", "/2", [10.0], 1.5)], "__class int, q string, c string, c_p array<double>, c_radius double")
    assert {r["__id"] for r in neighbours._asking(queries, known).collect()} == {1, 2, 3, 4, 5}
    whole = known.withColumn("c_p", F.lit(None).cast("array<double>"))  # a class that is one cell
    assert neighbours._asking(queries, whole).count() == len(at)


def clustered(spark, seed=3):
    rng = np.random.default_rng(seed)
    centres = np.array([[x, y] for x in (0, 1000) for y in (0, 1000)], dtype=float)
    points = [(i, 1, centres[i % 4] + rng.normal(size=2)) for i in range(240)]
    return points, spark.createDataFrame([(c, i, x.tolist()) for i, c, x in points], "__class int, __id long, __x array<double>")


def test_tree_of_several_levels(spark):
    points, df = clustered(spark)
    tree = metric_tree.build(df, 12, fan=3)
    assert len(tree.levels) >= 4  # three splits
    at = {r["__id"]: np.array(r["__x"]) for r in df.collect()}
    leaves = {r["__cell"]: r for r in tree.leaves.collect()}
    placed = tree.rows.collect()
    assert sorted(r["__id"] for r in placed) == sorted(at) and max(leaf.n for leaf in leaves.values()) <= 12
    for r in placed:
        leaf = leaves[r["__cell"]]
        away = np.linalg.norm(at[r["__id"]] - np.array(leaf["__p"]))
        assert r["__away"] == pytest.approx(away) and away <= leaf.radius + 1e-9
    for level in tree.levels[1:]:
        for node in level.collect():
            inside = [at[r["__id"]] for r in placed if r["__cell"] == node["__cell"] or r["__cell"].startswith(node["__cell"] + "/")]
            assert len(inside) == node.n
            assert max(np.linalg.norm(x - np.array(node["__p"])) for x in inside) == pytest.approx(node.radius)


def test_far_cells_are_not_searched(spark):
    points, df = clustered(spark)
    tree = metric_tree.build(df, 20, fan=4)
    leaves = {r["__cell"]: r for r in tree.leaves.collect()}
    gap = lambda a, b: np.linalg.norm(np.array(leaves[a]["__p"]) - np.array(leaves[b]["__p"])) - leaves[a].radius - leaves[b].radius
    at = {}
    for r in tree.rows.collect():
        at.setdefault(r["__cell"], []).append(r["__x"])
    nearest = lambda a, b: np.sqrt(((np.array(at[a])[:, None] - np.array(at[b])[None]) ** 2).sum(axis=2)).min()
    near = {(a, b) for a in leaves for b in leaves if a != b and nearest(a, b) <= 0.5}
    far = {(a, b) for a in leaves for b in leaves if a != b and gap(a, b) > 100}
    assert near and len(far) > 100
    reach = tree.leaves.select("__class", "__cell", F.lit(0.5).alias("reach"))
    pairs = [(r.q, r.c) for r in metric_tree.leaf_pairs(tree, reach, 5).collect()]
    assert len(pairs) == len(set(pairs)) and near <= set(pairs) and not far & set(pairs)
    # nothing known of the leaves: bounded by nodes of more than k rows
    blind = tree.leaves.select("__class", "__cell", F.lit(float("inf")).alias("reach"))
    loose = {(r.q, r.c) for r in metric_tree.leaf_pairs(tree, blind, 5).collect()}
    assert set(pairs) <= loose and not far & loose


def test_labels_of_many_values_are_refused(spark):
    df = spark.range(1100).selectExpr("id", "id AS y", "array(1.0D) AS x")
    with pytest.raises(ValueError):
        neighbours.smote(df, "id", "x", "y")


def test_smote_balances_and_stays_between(spark):
    items = [(i, 0, [float(i), 0.0]) for i in range(20)] + [(100 + i, 1, [float(i), float(i * i)]) for i in range(7)]
    df = spark.createDataFrame(items, "id long, y int, x array<double>")
    out = neighbours.smote(df, "id", "x", "y").cache()
    assert rows(out.groupBy("y").count()) == [(0, 20), (1, 20)]
    assert out.select("id").distinct().count() == 40
    minority = [np.array(x) for _, y, x in items if y == 1]
    for r in out.where("synthetic = 1").collect():
        p, base = np.array(r.x), np.array(items[20 + int(r.id.split("#")[0]) - 100][2])
        gaps = [np.linalg.norm(p - base) + np.linalg.norm(p - q) - np.linalg.norm(base - q) for q in minority]
        assert min(abs(g) for g in gaps) < 1e-9
    again = neighbours.smote(df, "id", "x", "y")
    assert rows(again.select("id", "x")) == rows(out.select("id", "x"))


def test_smote_makes_many_copies_of_few_rows(spark):
    items = [(i, 0, [float(i)]) for i in range(3000)] + [(9000 + i, 1, [float(i)]) for i in range(2)]
    out = neighbours.smote(spark.createDataFrame(items, "id long, y int, x array<double>"), "id", "x", "y")
    assert rows(out.groupBy("y").count()) == [(0, 3000), (1, 3000)]
    with pytest.raises(ValueError):
        neighbours.smote(spark.createDataFrame(items[:-1], "id long, y int, x array<double>"), "id", "x", "y")


@pytest.fixture(scope="module")
def labelled(spark):
    df = spark.range(400).select(
        "id",
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 8).cast("int")).alias("d"),
        F.sin("id").alias("a"),
        F.cos(F.col("id") * 3).alias("b"),
    )
    return df.withColumn("target", (F.col("a") + F.col("b") > 0.9).cast("int"))


@pytest.mark.parametrize("reference_order", [False, True])
def test_training_sets(labelled, reference_order):
    train, test = learn.training_sets(
        labelled, ident="id", features=["a", "b"], day="d", start=dt.date(2024, 1, 1), end=dt.date(2024, 1, 7),
        reference_order=reference_order,
    )
    counts = dict(train.groupBy("target").count().collect())
    synthetic_tests = test.where("id like '%#%'").count()
    if reference_order:
        assert synthetic_tests > 0
    else:
        assert counts[0] == counts[1] and synthetic_tests == 0 and test.count() == 70
    with pytest.raises(ValueError):
        learn.training_sets(labelled, ident="id", features=["a"], day="d", start=dt.date(2025, 1, 1), end=dt.date(2025, 1, 7))


def test_search_score_and_reload(spark, labelled, tmp_path):
    train, test = learn.training_sets(labelled, ident="id", features=["a", "b"], noise=0)
    specs = [
        learn.Spec("forest", RandomForestClassifier(seed=1), {"numTrees": [5], "maxDepth": [2, 4]}),
        learn.Spec("logistic", LogisticRegression(maxIter=50, standardization=False), {"inverseStrength": [1, 10]}),
        learn.Spec("boosting", GBTClassifier(seed=1, maxIter=3), {"positiveWeight": [3]}),
    ]
    tuned = learn.grid_search(train, test, specs, features=["a", "b"], ident="id", parallelism=4)
    board = tuned.leaderboard.collect()
    assert {r.model for r in board} == {"forest", "logistic", "boosting"}
    assert board[0].best_cv_score > 0.8 and all(0 < r.test_accuracy <= 1 for r in board)
    learn.save_models(tuned, str(tmp_path))
    for name in (board[0].model, "boosting"):
        model = learn.load_model(str(tmp_path), name)
        out = learn.score(labelled, model, ["d", "id"], features=["a", "b"], day="d", on=dt.date(2024, 1, 8))
        assert out.count() == 50 and out.columns == ["d", "id", "a", "b", "predicted_risk", "risk_probability"]
        bad = out.where("predicted_risk <> int(risk_probability > 0.5) or risk_probability not between 0 and 1")
        assert bad.count() == 0
    assert learn.choose(tuned) is tuned.models[board[0].model]
    assert learn.choose(tuned, "boosting") is tuned.models["boosting"]
    holes = labelled.withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a")))
    filled = learn.fit_imputer(holes, ["a", "b"]).transform(holes)
    assert learn.score(filled, learn.choose(tuned), ["id"], features=["a", "b"]).count() == 400


def test_default_grids():
    sizes = {s.name: len(learn._grid_points(s)) for s in learn.default_specs()}
    assert sizes == {"random_forest": 75, "logistic_regression": 4, "boosting_a": 32, "boosting_b": 192}


def test_feature_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 0)], "id int, a int, b int, target int")
    assert learn.feature_columns(df, ["id", "b", "not_there"]) == ["a"]


def test_strength_of_the_last_fit(spark, labelled):
    train, test = learn.training_sets(labelled, ident="id", features=["a", "b"], noise=0)
    spec = learn.Spec("logistic", LogisticRegression(maxIter=5), {"inverseStrength": [1, 10]})
    tuned = learn.grid_search(train, test, [spec], features=["a", "b"], ident="id")
    strength = tuned.leaderboard.first().best_parameters.split("=")[1]
    assert tuned.models["logistic"].stages[-1].getRegParam() == pytest.approx(1 / (float(strength) * train.count()))


def test_imputer_keeps_its_means_and_takes_empty_columns(spark, tmp_path):
    nan = float("nan")
    df = spark.createDataFrame([(1, 2.0, None, nan), (2, None, None, 4.0), (3, nan, None, 8.0)], "id int, a double, b double, c double")
    fitted = learn.fit_imputer(df, ["a", "b", "c"], empty=-1.0)
    assert rows(fitted.transform(df)) == [(1, 2.0, -1.0, 6.0), (2, 2.0, -1.0, 4.0), (3, 2.0, -1.0, 8.0)]
    fitted.write().save(str(tmp_path / "imputer"))
    later = spark.createDataFrame([(9, None, 5.0, None)], df.schema)
    assert rows(learn.load_model(str(tmp_path), "imputer").transform(later)) == [(9, 2.0, 5.0, 6.0)]


def test_models_bring_their_preprocessing(spark, labelled, tmp_path):
    holes = labelled.withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a")))
    train, test = learn.training_sets(labelled, ident="id", features=["a", "b"], noise=0)
    stages = learn.fit_preprocessing(train, ["a", "b"], ["b"])
    spec = learn.Spec("forest", RandomForestClassifier(seed=1, numTrees=3), {"maxDepth": [2]})
    tuned = learn.grid_search(train, test, [spec], features=["a", "b"], ident="id", stages=stages)
    learn.save_models(tuned, str(tmp_path))

    def scores(model, df):
        return rows(learn.score(df, model, ["id"], features=["a", "b"]), "id", "risk_probability")

    stored = learn.load_model(str(tmp_path), "forest")
    assert scores(stored, holes) == scores(tuned.models["forest"], holes)
    # The numbers come from training, so a part of a table is scored like the whole.
    part = holes.where("id < 40")
    assert scores(stored, part) == [r for r in scores(stored, holes) if r[0] < 40]


def test_bounded_fit(spark, labelled):
    train, test = learn.training_sets(labelled, ident="id", features=["a", "b"], noise=0, max_fit_rows=100, test_fraction=0.2)
    assert test.count() == 20 and train.where("target = 0").count() == train.where("target = 1").count()


def test_a_stopped_search_goes_on(spark, labelled, tmp_path, monkeypatch):
    train, test = learn.training_sets(labelled, ident="id", features=["a", "b"], noise=0)
    train, test = hand_off(train, "train"), hand_off(test, "test")
    forest = RandomForestClassifier(seed=1, numTrees=3)
    specs = [
        learn.Spec("forest", forest, {"maxDepth": [2, 3]}),
        learn.Spec("logistic", LogisticRegression(maxIter=5), {"inverseStrength": [1]}),
    ]
    search = lambda s: learn.grid_search(train, test, s, features=["a", "b"], ident="id", parallelism=1, ledger=str(tmp_path))
    plain, fits = learn._fit, []

    def stopping(spec, params, rows):
        if len(fits) == 5:
            raise RuntimeError("stopped")
        fits.append(spec.name)
        return plain(spec, params, rows)

    monkeypatch.setattr(learn, "_fit", stopping)
    with pytest.raises(RuntimeError):
        search(specs)
    monkeypatch.setattr(learn, "_fit", lambda *args: fits.append(args[0].name) or plain(*args))
    tuned = search(specs)
    assert len(fits) == 3 * 3 + 2  # each fit once over both runs
    board, lines = rows(tuned.leaderboard), rows(tuned.lines)
    assert len(lines) == 11 and rows(learn.grid_search(train, test, specs, features=["a", "b"], ident="id").leaderboard) == board
    del fits[:]
    again = search(specs)  # nothing is left to fit; models come from the ledger
    assert fits == [] and rows(again.leaderboard) == board
    scored = [rows(learn.score(labelled, t.models["forest"], ["id"], features=["a", "b"]), "id", "risk_probability") for t in (tuned, again)]
    assert scored[0] == scored[1]
    search([learn.Spec("forest", forest, {"maxDepth": [1, 2, 3]}), specs[1]])
    assert len(fits) in (3, 4)  # the new setting, and a last fit if it is the best
    del fits[:]
    search([learn.Spec("forest", RandomForestClassifier(seed=2, numTrees=3), {"maxDepth": [2]})])
    assert len(fits) == 4  # another estimator under the same name


def test_versions_of_models(spark, labelled, tmp_path, monkeypatch):
    train, test = (hand_off(df, "rows") for df in learn.training_sets(labelled, ident="id", features=["a", "b"], noise=0))
    stages = learn.fit_preprocessing(train, ["a", "b"], ["b"])
    specs = [learn.Spec(name, RandomForestClassifier(seed=1, numTrees=2), {"maxDepth": [depth]}) for name, depth in (("flat", 1), ("deep", 4))]
    tuned = learn.grid_search(train, test, specs, features=["a", "b"], ident="id", stages=stages)
    folder = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        learn.load_version(spark, folder)
    assert learn.save_version(tuned, folder) == 1
    other = learn.grid_search(train, test, specs[:1], features=["a", "b"], ident="id", stages=stages)
    plain = learn.observed_write
    monkeypatch.setattr(learn, "observed_write", lambda *_: 1 / 0)  # stops after the models, before the version is shown
    with pytest.raises(ZeroDivisionError):
        learn.save_version(other, folder)
    now = learn.load_version(spark, folder)
    assert set(now.models) == {"flat", "deep"} and rows(now.leaderboard) == rows(tuned.leaderboard)
    score = lambda t, name: rows(learn.score(labelled, learn.choose(t, name), ["id"], features=["a", "b"]), "id", "risk_probability")
    assert score(now, "best") == score(tuned, "best") and score(now, "flat") == score(tuned, "flat")
    monkeypatch.setattr(learn, "observed_write", plain)
    assert learn.save_version(other, folder) == 2
    assert set(learn.load_version(spark, folder).models) == {"flat"} and set(learn.load_version(spark, folder, 1).models) == {"flat", "deep"}
