import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleetgauge.operators import carry, clean, fill, incremental, moments, panel
from fleetgauge.sources.days import DayTable, days_around

D = dt.date(2024, 3, 1)


def day(n):
    return D + dt.timedelta(days=n)


def panel_rows(seed, keys=5, days=16):
    rnd = random.Random(seed)
    return [(k, day(d), rnd.choice([None, 1.0, 2.5, 7.0]), rnd.randint(0, 9)) for k in range(keys) for d in range(days) if rnd.random() < 0.7]


def frame(spark, items):
    return spark.createDataFrame(items, "k long, day date, x double, n int")


def steps_of(items, seed):
    """Days in three steps, one row in eight one or two steps late."""
    rnd = random.Random(seed)
    out = [[], [], []]
    for r in items:
        step = min(2, (r[1] - D).days // 6 + (rnd.choice([1, 2]) if rnd.random() < 0.12 else 0))
        out[step].append(r)
    return out


def near(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        for x, y in zip(a, b, strict=True):
            assert x == y or x == pytest.approx(y, rel=1e-9, abs=1e-9), (a, b)


@pytest.mark.parametrize("exclude_current", [True, False])
def test_rolling_in_steps_equals_one_run(spark, tmp_path, exclude_current):
    items = panel_rows(1)
    base, rolled = (DayTable(str(tmp_path / n), ("k",)) for n in ("base", "rolled"))
    wanted = {"x": ["mean", "std", "max"], "n": ["sum"]}
    for step in steps_of(items, 2):
        incremental.update_rolling(base, rolled, frame(spark, step), wanted, days=5, exclude_current=exclude_current)
    want = panel.rolling(frame(spark, items), ["k"], "day", wanted, days=5, exclude_current=exclude_current)
    cols = want.columns
    near(rows(rolled.read(spark), *cols), rows(want, *cols))
    changed = incremental.update_rolling(base, rolled, frame(spark, [(2, day(3), 100.0, 1)]), wanted, days=5, exclude_current=exclude_current)
    there = {r[1] for r in items if r[0] == 2} | {day(3)}
    assert changed == [day(n) for n in range(3, 8) if day(n) in there]
    items = [r for r in items if r[:2] != (2, day(3))] + [(2, day(3), 100.0, 1)]
    want = panel.rolling(frame(spark, items), ["k"], "day", wanted, days=5, exclude_current=exclude_current)
    near(rows(rolled.read(spark), *cols), rows(want, *cols))


def test_only_touched_days_are_read_and_written(spark, tmp_path):
    base, rolled = (DayTable(str(tmp_path / n), ("k",)) for n in ("base", "rolled"))
    incremental.update_rolling(base, rolled, frame(spark, panel_rows(3)), ["n"], ["sum"], days=3)
    before = {p.name: {f.name for f in p.glob("*.parquet")} for p in (tmp_path / "rolled").glob("day=*")}
    incremental.update_rolling(base, rolled, frame(spark, [(0, day(10), 1.0, 5), (None, day(2), 1.0, 5), (1, None, 1.0, 5)]), ["n"], ["sum"], days=3)
    after = {p.name: {f.name for f in p.glob("*.parquet")} for p in (tmp_path / "rolled").glob("day=*")}
    changed = {d for d in after if after[d] != before.get(d)}
    assert f"day={day(10)}" in changed and changed <= {f"day={d}" for d in days_around([day(10)], 0, 2)}
    plan = base.read(spark, [day(10)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [(day" in plan
    assert incremental.update_rolling(base, rolled, frame(spark, []), ["n"], ["sum"], days=3) == []
    with pytest.raises(ValueError):
        incremental.update_rolling(base, rolled, frame(spark, [(1, day(1), 1.0, 1)] * 2), ["n"], ["sum"])


def values_of(df, cols):
    return [tuple(v) if v is not None else None for c in cols for v in [df.first()[c]]]


def test_merged_days_equal_the_rows(spark, tmp_path):
    rnd = random.Random(4)
    items = [(k, day(d), rnd.choice([None, 0.0, float("nan"), 1e9 + rnd.random()]), 3) for k in range(40) for d in range(12)]
    df = frame(spark, items)
    states = DayTable(str(tmp_path / "states"), ())
    moments.update_moments(states, df.where(F.col("day") < day(5)), ["x", "n"], ignore_zero=["x"])
    wrong = df.where(F.col("day").between(day(5), day(11))).withColumn("x", F.lit(7.0))
    moments.update_moments(states, wrong, ["x", "n"], ignore_zero=["x"])
    moments.update_moments(states, df.where(F.col("day") >= day(5)), ["x", "n"], ignore_zero=["x"])  # in place of the wrong days
    some = clean.nan_to_null(df.where(F.col("day").between(day(2), day(9))), ["x"])
    state = moments.stored_moments(states, spark, ["x", "n"], start=day(2), end=day(9))
    assert state.first()["rows"] == some.count()
    for got, want in zip(
        values_of(moments.sigma_bounds_of(state, ["x", "n"]), ["x", "n"]), values_of(clean.sigma_bounds(some, ["x", "n"], ignore_zero=True), ["x", "n"]), strict=True
    ):
        assert got == pytest.approx(want, rel=1e-15, abs=1e-5)
    nonzero = some.withColumn("x", F.when(F.col("x") != 0, F.col("x")))
    for got, want in zip(values_of(moments.scaler_of(state, ["x", "n"]), ["x", "n"]), values_of(clean.fit_scaler(nonzero, ["x", "n"]), ["x", "n"]), strict=True):
        assert got == pytest.approx(want, rel=1e-7)  # of values about 1e9
    all_days, part = moments.stored_moments(states, spark, ["x", "n"]), moments.stored_moments(states, spark, ["x", "n"], end=day(5))
    rest = moments.take_out(all_days, part, ["x", "n"]).first()
    want = moments.stored_moments(states, spark, ["x", "n"], start=day(6)).first()
    assert rest["rows"] == want["rows"] and tuple(rest["x"])[:2] == pytest.approx(tuple(want["x"])[:2])
    assert rest["x"]["m2"] == pytest.approx(want["x"]["m2"], rel=1e-4)
    assert rest["n"]["low"] is None  # the part reaches it


def test_states_of_groups_and_of_nothing(spark, tmp_path):
    df = frame(spark, panel_rows(5))
    states = DayTable(str(tmp_path / "states"), ("k",))
    for part in (F.col("day") < day(9), F.col("day") >= day(9)):
        moments.update_moments(states, df.where(part), ["x"])
    stats = moments.group_means_of(moments.stored_moments(states, spark, ["x"]), ["k"], ["x"])
    near(rows(clean.group_mean_fill(df, ["k"], ["x"], stats=stats)), rows(clean.group_mean_fill(df, ["k"], ["x"])))
    empty = moments.merge_moments(moments.moments(df.limit(0), ["x"]), ["x"]).first()
    assert empty["rows"] == 0 and tuple(empty["x"]) == (0, None, None, None, None)
    none = moments.sigma_bounds_of(moments.moments(df.limit(0), ["x"]), ["x"]).first()["x"]
    assert tuple(none) == (None, None)
    with pytest.raises(ValueError):
        moments.stored_moments(DayTable(str(tmp_path / "none"), ()), spark, ["x"])


def test_carried_fill_equals_one_run(spark, tmp_path):
    items = panel_rows(6, keys=6, days=18)
    base, filled = (DayTable(str(tmp_path / n), ("k",)) for n in ("base", "filled"))
    state = carry.CarriedState(str(tmp_path / "state"), ("k",), ("x",))
    cols = ["k", "day", "x", "n"]
    done = []
    first = [r for r in items if r[1] == day(0)] or [(0, day(0), None, 1)]
    for step in [first, *steps_of([r for r in items if r not in first], 7)]:
        carry.advance(base, filled, state, frame(spark, step))
        done += step
        want = fill.forward_fill(frame(spark, done), ["k"], ["day"], ["x"])
        assert rows(filled.read(spark), *cols) == rows(want, *cols)
    for as_of in state.days(spark):
        until = fill.forward_fill(frame(spark, [r for r in done if r[1] <= as_of]), ["k"], ["day"], ["x"])
        last = {}
        for r in sorted(until.collect(), key=lambda r: r.day):
            last[r.k] = r.x
        assert dict(state.read(spark, as_of).collect()) == last
    assert carry.advance(base, filled, state, frame(spark, [])) == []


def test_rows_from_before_the_first_state(spark, tmp_path):
    base, filled = (DayTable(str(tmp_path / n), ("k",)) for n in ("base", "filled"))
    state = carry.CarriedState(str(tmp_path / "state"), ("k",), ("x",))
    carry.advance(base, filled, state, frame(spark, [(1, day(3), 1.0, 0), (1, day(5), None, 0), (2, day(5), float("nan"), 0)]))
    carry.advance(base, filled, state, frame(spark, [(1, day(2), 4.0, 0), (2, day(2), 9.0, 0)]))  # nothing is stored before them
    assert rows(filled.read(spark), "k", "day", "x") == [(1, day(2), 4.0), (1, day(3), 1.0), (1, day(5), 1.0), (2, day(2), 9.0), (2, day(5), 9.0)]
    with pytest.raises(ValueError):
        carry.advance(base, filled, state, frame(spark, [(3, day(4), 4.0, 0)]))
