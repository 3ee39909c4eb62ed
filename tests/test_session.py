import os

from fleetgauge import session
from fleetgauge.session import drop_hand_offs, hand_off, interim, work_folder


def test_hand_off_is_stored_in_the_named_folder(spark):
    assert work_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = hand_off(spark.range(10), "test")
    path = df.inputFiles()[0].removeprefix("file://")
    assert path.startswith(work_folder(spark)) and df.count() == 10
    assert drop_hand_offs(spark) >= 1 and not os.path.exists(path)
    assert drop_hand_offs(spark) == 0


def test_scope_drops_only_its_own_tables(spark):
    kept = hand_off(spark.range(3), "kept")
    before = set(os.listdir(work_folder(spark)))
    with interim(spark):
        n = hand_off(spark.range(5), "inner").count()
    assert n == 5 and kept.count() == 3 and set(os.listdir(work_folder(spark))) == before


def test_wide_steps_stay_small_enough_to_be_compiled(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        session.compile_wide_rows(spark)
        assert spark.conf.get(name) == "8000"
        spark.conf.set(name, "5000")
        session.compile_wide_rows(spark)
        assert spark.conf.get(name) == "5000"
    finally:
        spark.conf.set(name, before)
