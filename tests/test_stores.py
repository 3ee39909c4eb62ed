import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F, types as T

from fleetgauge import sources as io
from fleetgauge.sources import published as pub, relational, schemas as rec

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_versions_are_shown_as_a_whole(spark, tmp_path):
    folder, df = str(tmp_path / "t"), spark.range(10).select("id", F.when(F.col("id") > 3, F.col("id")).alias("x.y"))
    with pytest.raises(FileNotFoundError):
        io.read_published(spark, folder)
    version, facts = io.publish(df, folder, io.Gate(least_rows=5, most_rows=10, most_nulls={"x.y": 0.4}))
    assert (version, facts.rows, dict(facts.nulls)) == (1, 10, {"id": 0, "x.y": 4})
    for bad, reason in ((df.limit(3), "fewer than"), (df.union(df), "more than"), (df.where("id < 6"), "have no x.y")):
        with pytest.raises(io.RefusedError, match=reason) as refused:
            io.publish(bad, folder, io.Gate(least_rows=5, most_rows=10, most_nulls={"x.y": 0.4}))
        assert refused.value.facts.rows == bad.count()
    assert rows(io.read_published(spark, folder)) == rows(df) and len(list((tmp_path / "t" / "data").iterdir())) == 1
    boom = F.raise_error(F.lit("boom")).cast("long")
    with pytest.raises(Exception, match="boom"):
        io.publish(df.select(F.when(F.col("id") == 9, boom).otherwise(F.col("id")).alias("id")), folder)
    assert rows(io.read_published(spark, folder)) == rows(df)
    assert io.publish(df.limit(0), folder)[0] == 2 and io.read_published(spark, folder).count() == 0
    assert io.read_published(spark, folder, 1).count() == 10
    with pytest.raises(FileNotFoundError):
        io.read_published(spark, folder, 7)


def test_the_plan_runs_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    facts = pub.observed_write(spark.range(1000).mapInArrow(look, "id long"), str(tmp_path / "t"))
    assert facts.rows == 1000 and seen.value == 1000


def test_widest_types():
    wide = lambda a, b: rec._wider(*(T.StructType.fromDDL(f"x {k}")["x"].dataType for k in (a, b))).simpleString()
    for a, b, want in [
        ("int", "bigint", "bigint"), ("smallint", "int", "int"), ("bigint", "double", "double"), ("float", "int", "double"), ("int", "string", "string"),
        ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "string", "string"), ("decimal(10,2)", "int", "decimal(12,2)"),
        ("decimal(38,2)", "decimal(38,10)", "double"), ("decimal(5,2)", "double", "double"), ("boolean", "int", "string"), ("boolean", "boolean", "boolean"),
    ]:
        assert wide(a, b) == wide(b, a) == want, (a, b)
    with pytest.raises(TypeError):
        wide("array<int>", "string")


def test_rows_that_do_not_fit_are_set_aside(spark):
    a = spark.createDataFrame([(1, "7", "x"), (2, "7.0", None), (3, " 8 ", "y"), (4, "7.5", "z"), (5, "x", "z"), (6, None, "z"), (7, "NaN", "z")], "id int, n string, t string")
    b = spark.createDataFrame([(float("nan"), 1.0, 2.0), (8.0, 3.5, 12.0), (9.5, 4.0, 1.25)], "id double, n double, t double")
    good, bad = io.reconcile({"a": a, "b": b, "c": b.limit(0)}, {"id": "bigint", "n": "int", "t": "string"})
    assert good.dtypes == [("id", "bigint"), ("n", "int"), ("t", "string")]
    assert rows(good) == rows(spark.createDataFrame([(1, 7, "x"), (2, 7, None), (3, 8, "y"), (6, None, "z"), (None, 1, "2")], good.schema))
    got = {(r.source, tuple(r.reasons)) for r in bad.collect()}
    assert got == {("a", ("n: 7.5 is no int",)), ("a", ("n: x is no int",)), ("a", ("n: NaN is no int",)), ("b", ("n: 3.5 is no int",)), ("b", ("id: 9.5 is no bigint",))}
    assert {r.row for r in bad.where("source = 'b'").collect()} == {'{"id":8.0,"n":3.5,"t":12.0}', '{"id":9.5,"n":4.0,"t":1.25}'}
    widest, none = io.reconcile({"a": a, "b": b})
    assert widest.dtypes == [("id", "double"), ("n", "string"), ("t", "string")] and none.isEmpty() and widest.count() == 10


def test_balanced_parts_of_a_crowded_key(spark):
    url = "jdbc:derby:memory:balanced;create=true"
    skewed = spark.range(4000).select(F.when(F.col("id") % 10 == 0, F.col("id") * 1000).otherwise(F.col("id") % 400).alias("K"), "id").withColumnRenamed("id", "ID")
    skewed = skewed.unionByName(spark.createDataFrame([(None, -1)], "K long, ID long"))
    io.jdbc_write(skewed, url, "S", options=DERBY)
    back = io.jdbc_read_balanced(spark, url, "S", "K", 8, options=DERBY)
    sizes = [r[1] for r in back.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4001 and back.select("ID").distinct().count() == 4001 and len(sizes) == 8 and max(sizes) <= 2 * 4001 / 8
    even = io.jdbc_read(spark, url, "S", partition=("K", 0, 4_000_000, 8), options=DERBY)
    assert max(r[1] for r in even.groupBy(F.spark_partition_id()).count().collect()) > 3000
    io.jdbc_write(skewed.limit(0), url, "E", skip_empty=False, options=DERBY)
    assert io.jdbc_read_balanced(spark, url, "E", "K", 8, options=DERBY).count() == 0
    one = relational.quantile_predicates(spark.createDataFrame([(5,)] * 9, "K long"), 4)
    assert one == ["K <= 5 OR K IS NULL", "K > 5"]


def test_a_batch_is_written_once(spark, monkeypatch):
    url = "jdbc:derby:memory:batches;create=true"
    day = lambda n: spark.range(100 * n, 100 * n + 100, 1, 4).select(F.col("id").alias("ID"), F.concat(F.lit("r"), "id").alias("Name"))
    write = lambda df, batch: io.jdbc_append_once(df, url, "Target", batch, column_types="Name VARCHAR(20)", options=DERBY)
    stored = lambda: sorted(r.ID for r in io.jdbc_read(spark, url, "Target", options=DERBY).collect())
    assert write(day(0), "day 0") and not write(day(0), "day 0")
    assert stored() == list(range(100))

    plain = relational._stage

    def stopped(rows, *args):  # the job ends after some tasks have written
        plain(rows.where("ID < 150"), *args)
        raise RuntimeError("stopped")

    monkeypatch.setattr(relational, "_stage", stopped)
    with pytest.raises(RuntimeError):
        write(day(1), "day 1")
    assert stored() == list(range(100))

    def repeated(rows, url, stage, batchsize, types, parts, options):  # two tasks are run again after they had written
        plain(rows, url, stage, batchsize, types, parts, options)
        again = rows.where("w_part < 2").withColumn("w_attempt", F.col("w_attempt") + 1)
        io.jdbc_write(again, url, stage, mode="append", options=options)

    monkeypatch.setattr(relational, "_stage", repeated)
    assert write(day(1), "day 1") and not write(day(1), "day 1")
    assert stored() == list(range(200))
    monkeypatch.setattr(relational, "_stage", plain)
    assert write(day(2).limit(0), "day 2") and write(day(2), "day 2, second part")
    assert stored() == list(range(300))
    with relational._connection(spark, url, DERBY) as connection:
        assert not [t for t in ("stage_",) if relational._table_exists(connection, t)]


def test_a_failed_batch_leaves_the_table(spark):
    url = "jdbc:derby:memory:failing;create=true"
    bad = spark.range(0, 40, 1, 4).select(F.when(F.col("id") == 39, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")).alias("ID"))
    with pytest.raises(Exception, match="boom"):
        io.jdbc_append_once(bad, url, "T", "x", options=DERBY)
    assert io.jdbc_append_once(spark.range(40).withColumnRenamed("id", "ID"), url, "T", "x", options=DERBY)
    assert io.jdbc_read(spark, url, "T", options=DERBY).count() == 40


def test_models_are_fitted_in_a_session_that_observed(spark, tmp_path):
    """Spark cannot send a model's training summary to tasks any more; the search leaves it out."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier

    from fleetgauge.operators import learn
    from fleetgauge.session import hand_off

    io.publish(spark.range(3), str(tmp_path / "t"))
    df = hand_off(spark.range(90).selectExpr("id", "sin(id) AS a", "int(sin(id) > 0.2) AS target"), "rows")
    specs = [learn.Spec("forest", RandomForestClassifier(seed=1, numTrees=2), {}), learn.Spec("logistic", LogisticRegression(maxIter=3), {})]
    tuned = learn.grid_search(df.where("id > 20"), df.where("id <= 20"), specs, features=["a"], ident="id")
    assert all(learn.score(df, tuned.models[name], ["id"], features=["a"]).count() == 90 for name in ("forest", "logistic"))
