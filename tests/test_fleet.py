"""The composed plan on a small made-up fleet, against plain Python."""

import datetime as dt
import os
import random
from collections import Counter, defaultdict
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from fleetgauge.operators import join, learn
from fleetgauge.plans import fleet
from fleetgauge.session import work_folder
from fleetgauge.sources import RefusedError, read_published, write_parquet

START = dt.date(2024, 3, 1)
DAYS = 20


def epoch(day, second):
    return int(dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc).timestamp()) + second


@pytest.fixture(scope="module")
def raw():
    rng = random.Random(5)
    drivers = [f"{1000 + i}" for i in range(10)]
    plates = [f"P{i}" for i in range(6)]
    out = defaultdict(list)
    for i, d in enumerate(drivers):
        out["drivers"].append((i + 1, f"name{i}", f"{'4403' if i % 2 else '1101'}01198{i % 10}0{1 + i % 9}1500{i % 10}X", d, "1" if i else "?", START - dt.timedelta(days=3000 + i), None if i == 3 else START - dt.timedelta(days=900), 3, i, 1, 2, 0))
    for i, p in enumerate(plates):
        out["vehicles"].append((i + 1, p, 500 + i, None if i == 2 else ("CK-R1" if i % 2 else "other"), dt.datetime(2023, 1, 1)))
    out["vehicles"].append((99, "P0", 599, "CK-R1", dt.datetime(2022, 1, 1)))  # an older row of P0
    for n in range(DAYS):
        day = START + dt.timedelta(days=n)
        for i, d in enumerate(drivers):
            if rng.random() < 0.25:
                continue
            plate = plates[(i + n // 7) % 6]
            device = 500 + (i + n // 7) % 6
            out["logins"].append((epoch(day, 100), int(d), 1))
            for t in range(rng.randint(1, 4)):
                out["trips"].append((epoch(day, 3600 + t), d, plate, 100.0 * rng.randint(0, 50), 500.0 * rng.randint(1, 40), rng.choice(["600", "1200", "bad"]), 60.0 * rng.randint(0, 30), 100.0 * rng.randint(5, 60), rng.randint(1, 5), rng.choice(["0", "1", "2"])))
            for t in range(rng.randint(0, 6)):
                out["alarms"].append((epoch(day, 4000 + t), d, plate, rng.randint(1, 5), rng.choice([18006, 18007, 30087, 56002, 56003, 56004, 3010, 30144, 30173, 1]), rng.choice([0, 1, 2]), rng.choice([0, 9])))
                out["over_speed"].append((epoch(day, 4000 + t), d, plate, rng.choice([10.0, 30.0, 80.0, 260.0, None]), 1, 0))
                out["warnings"].append((epoch(day, 5000 + t), d, str(device), rng.choice(["1", "2", "3", "4", "5"]), rng.choice(["0", "1", "2", "3", "4"])))
            if rng.random() < 0.8:
                out["positions"].append((epoch(day, 6000), str(device), d, 1000.0 + 50 * n + i, rng.choice([0.0, 4.0, 40.0, 60.0])))
            if rng.random() < 0.5:
                out["statuses"].append((dt.datetime(day.year, day.month, day.day, 8), device - 499, plate, f"D{device}", rng.randint(0, 1), 1, rng.randint(0, 1)))
            if rng.random() < 0.2:
                out["violations"].append((dt.datetime(day.year, day.month, day.day, 9), device - 499, i + 1, rng.choice([1, 2, 3])))
            if rng.random() < 0.2:
                out["accidents"] += [(dt.datetime(day.year, day.month, day.day, 10), device - 499, i + 1)] * 2
    out["alarms"].append((epoch(START, 1), None, "P0", 1, 1, 1, 0))
    out["holidays"].append((0, START + dt.timedelta(days=4), "public_holiday"))
    return out


SCHEMAS = {
    "alarms": "alarmTime long, jobNumber string, vehicleNumber string, categoryId int, alarmType int, handleStatus int, handleTime long",
    "warnings": "TimeSatellite long, DriverID string, DeviceID string, warningType string, AebsStatus string",
    "over_speed": "alarmTime long, jobNumber string, vehicleNumber string, speed double, handleStatus int, handleTime long",
    "trips": "Addtime long, certificateId string, carNo string, freeMileage double, mileage double, passengerTime string, waitTime double, money double, judge int, passengerCount string",
    "positions": "gpsTime long, deviceNo string, jobNumber string, mileage double, speed double",
    "logins": "time long, certification long, status int",
    "drivers": "DriverID int, DriverName string, IDNumber string, Certified string, DriverTypeID string, DrivingLicenseStartDate date, EntryDate date, ExamNum int, TrainNum int, ViolateNum int, ViolationNum int, AccidentNum int",
    "vehicles": "VehicleID int, VehicleLic string, TerminalEquipmentID int, TerminalEquipmentManufacturer string, AddTime timestamp_ntz",
    "violations": "ViolationTime timestamp_ntz, VehicleID int, DriverID int, Type int",
    "statuses": "TimeSatellite timestamp_ntz, VehicleID int, VehicleLic string, DeviceID string, IsGps int, IsCamera int, IsAeb int",
    "accidents": "AccidentTime timestamp_ntz, VehicleID int, DriverID int",
    "holidays": "position int, date date, type string",
}


@pytest.fixture(scope="module")
def feeds(spark, raw):
    return fleet.Feeds(**{name: spark.createDataFrame(raw[name], schema) for name, schema in SCHEMAS.items()})


@pytest.fixture(scope="module")
def wide(spark, feeds, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wide"))
    write_parquet(fleet.wide_panel(feeds, excluded={"driver": ["1009"], "plate": ["none"]}), path)
    return spark.read.parquet(path)


def utc_day(seconds):
    return dt.datetime.fromtimestamp(seconds, dt.timezone.utc).date()


def test_wide_panel(raw, wide):
    got = {(r.driver, r.day, r.plate): r for r in wide.collect()}
    keys = {(t[1], utc_day(t[0]), t[2]) for t in raw["trips"] if t[1] != "1009"}
    assert got.keys() == keys and wide.count() == len(keys)
    accel, fast, mile = Counter(), Counter(), defaultdict(float)
    for t, d, p, _, kind, status, handled in raw["alarms"]:
        if kind == 18006 and ((status == 0 and handled == 0) or status == 1):
            accel[d, utc_day(t), p] += 1
    for t, d, p, speed, *_ in raw["over_speed"]:
        if speed is not None and 20 < speed < 250:
            fast[d, utc_day(t), p] += 1
    for t, d, p, _, mileage, *_ in raw["trips"]:
        mile[d, utc_day(t), p] += mileage
    hurt = {(a[2], a[0].date(), a[1]) for a in raw["accidents"]}
    days = defaultdict(set)
    for t, d, _ in raw["logins"]:
        days[str(d)].add(utc_day(t))
    for key, r in got.items():
        driver, day, plate = key
        assert (r.harsh_accel or 0) == accel[key] and (r.over_speed_cnt or 0) == fast[key]
        assert r.mileage == mile[key]
        number, vehicle = int(driver) - 999, int(plate[1:]) + 1
        assert r.target == int((number, day, vehicle) in hurt)
        streak = 0
        while day - dt.timedelta(days=streak + 1) in days[driver]:
            streak += 1
        assert r.streak_before == streak
        assert r.TEM == (None if vehicle == 3 else vehicle % 2 == 0)
        assert r.in_region == (number - 1) % 2 and r.driveAge == (day - START).days + 3000 + number - 1
        assert r.date_type == ("public_holiday" if day == START + dt.timedelta(days=4) else "workday" if day.weekday() < 5 else "weekend")


def test_wide_panel_refuses_repeated_certificates(spark, feeds, raw):
    twice = raw["drivers"] + [(77, "other", "440301198001011234", "1001", "1", None, None, 0, 0, 0, 0, 0)]
    with pytest.raises(join.FanOutError):
        fleet.wide_panel(replace(feeds, drivers=spark.createDataFrame(twice, SCHEMAS["drivers"])))


def test_a_panel_that_grew_is_not_published(spark, feeds, raw, wide, tmp_path):
    folder = str(tmp_path / "panel")
    version, facts = fleet.publish_panel(feeds, folder, most_nulls={"target": 0.0})
    stored = read_published(spark, folder)
    assert version == 1 and facts.rows == stored.count() and facts.nulls["target"] == 0
    assert facts.nulls["TEM"] == stored.where("TEM IS NULL").count() > 0
    twice = raw["drivers"] + [(77, "other", "440301198001011234", "1001", "1", None, None, 0, 0, 0, 0, 0)]
    grown = replace(feeds, drivers=spark.createDataFrame(twice, SCHEMAS["drivers"]))
    with pytest.raises(RefusedError) as refused:
        fleet.publish_panel(grown, folder, gate=False)
    assert refused.value.facts.rows > facts.rows
    with pytest.raises(RefusedError, match="TEM"):
        fleet.publish_panel(feeds, folder, most_nulls={"TEM": 0.0})
    assert rows(read_published(spark, folder)) == rows(stored)


def test_the_panel_in_buckets_is_the_same(feeds, wide):
    got = fleet.wide_panel(feeds, excluded={"driver": ["1009"], "plate": ["none"]}, layout=fleet.Layout(("driver", "day"), 4))
    assert rows(got, *wide.columns) == rows(wide)


def test_speed_and_violations(feeds, raw):
    speed = {(r.day, r.driver): r for r in fleet.driver_speed(feeds.positions).collect()}
    moving = Counter((utc_day(p[0]), p[2]) for p in raw["positions"] if p[4] > 5)
    assert {k: r.speed_count for k, r in speed.items()} == moving
    seen = fleet.violation_counts(feeds.violations, fleet.clean_drivers(feeds.drivers))
    total = seen.agg(F.sum("traffic_violation"), F.sum("rule_breach")).first()
    assert tuple(total) == tuple(sum(v[3] == t for v in raw["violations"]) for t in (1, 2))


# ---- features, recomputed row by row ---------------------------------------------------


def mean(xs):
    xs = [x for x in xs if x is not None]
    return sum(xs) / len(xs) if xs else None


def dev(xs, less):
    m = mean(xs)
    return (sum((x - m) ** 2 for x in xs) / (len(xs) - less)) ** 0.5


def clip(rows, col, zeros_too):
    xs = [r[col] for r in rows if r[col] is not None and (zeros_too or r[col] != 0)]
    if len(xs) < 2:
        return [False] * len(rows)
    lo, hi = mean(xs) - 3 * dev(xs, 1), mean(xs) + 3 * dev(xs, 1)
    hit = []
    for r in rows:
        x = r[col]
        out = x is not None and (zeros_too or x != 0) and len(set(xs)) > 1 and not lo <= x <= hi
        hit.append(out)
        if out:
            r[col] = lo if x < lo else hi
    return hit


def group_fill(rows, cols):
    groups = defaultdict(list)
    for r in rows:
        groups[r["plate"], r["DriverName"]].append(r)
    for c in cols:
        for g in groups.values():
            m = mean([r[c] for r in g])
            for r in g:
                r[c] = m if r[c] is None else r[c]
        m = mean([r[c] for r in rows])
        for r in rows:
            r[c] = m if r[c] is None else r[c]
    return groups


def expected_features(rows):
    rows = sorted(rows, key=lambda r: (r["plate"], r["day"], r["DriverName"]))
    by_plate = defaultdict(list)
    for r in rows:
        r["totalmileage"] = r["totalmileage"] if (r["totalmileage"] or 0) > 0 else None
        by_plate[r["plate"]].append(r)
    for g in by_plate.values():
        known = [r["totalmileage"] for r in g]
        for i, r in enumerate(g):
            earlier = [x for x in known[: i + 1] if x is not None]
            later = [x for x in known[i:] if x is not None]
            r["totalmileage"] = earlier[-1] if earlier else later[0] if later else -1
    rows = sorted(rows, key=lambda r: (r["plate"], r["DriverName"], r["day"]))
    for r in rows:
        for c, unit in fleet.UNIT_DIVISORS.items():
            r[c] = None if r[c] is None else r[c] / unit
    hits = [clip(rows, c, True) for c in fleet.WARNING_FIELDS]
    for i, r in enumerate(rows):
        if r["IsAeb"] == 1 and any(h[i] for h in hits):
            r["IsAeb"] = 0
    for c in fleet.ALARM_FIELDS:
        clip(rows, c, False)
    for c in fleet.FLAGS:
        last = None
        for r in rows:
            last = r[c] if r[c] is not None else last
            r[c] = last
    for r in rows:
        for c in fleet.ZERO_FILLED:
            r[c] = r[c] or 0
    groups = group_fill(rows, fleet.COUNT_FIELDS)
    for g in groups.values():
        for r in g:
            frame = [q for q in g if 0 <= (r["day"] - q["day"]).days < 8]
            for c, funcs in fleet.ROLLING.items():
                xs = [q[c] for q in frame if q[c] is not None]
                others = len(xs) - 1
                ok = others > 0 and r[c] is not None
                for f in funcs:
                    r[f"{c}_8d_{f}"] = {
                        "mean": (sum(xs) - r[c]) / others if ok else None,
                        "sum": sum(xs) - r[c] if ok else None,
                        "std": dev(xs, 1) if others > 0 else None,
                    }[f]
    group_fill(rows, fleet.ROLLED)
    for r in rows:
        r["distance"] = r["freeMileage_8d_mean"] + r["mileage_8d_mean"]
        r["empty_distance_ratio"] = r["freeMileage_8d_mean"] / r["distance"]
        r["dangerous_total"] = sum(r[f"{c}_8d_sum"] for c in ("crosswalk_no_yield", "physical_conflict", "crosswalk_speeding"))
    for c in fleet.SCALED:
        xs = [r[c] for r in rows]
        m, s = mean(xs), dev(xs, 0) if len(set(xs)) > 1 else 1.0
        for r in rows:
            r[c] = (r[c] - m) / s
    return {(r["plate"], r["DriverName"], r["day"]): r for r in rows}


@pytest.fixture(scope="module")
def features(spark, wide, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("features"))
    write_parquet(fleet.prepare_features(wide, run_date=START + dt.timedelta(days=DAYS)), path)
    return spark.read.parquet(path)


def test_features_equal_a_row_by_row_computation(wide, features):
    recent = wide.where(F.col("day") >= START + dt.timedelta(days=DAYS - 15))
    want = expected_features([r.asDict() for r in recent.collect()])
    got = {(r.plate, r.DriverName, r.day): r for r in features.collect()}
    assert got.keys() == want.keys()
    checked = [*fleet.SCALED, *fleet.PARTS, "distance", "empty_distance_ratio", "dangerous_total", "IsAeb", "streak_before", "age"]
    for key, w in want.items():
        for c in checked:
            assert got[key][c] == pytest.approx(w[c], abs=1e-6), (key, c)


def test_train_and_score(features, tmp_path):
    day = START + dt.timedelta(days=DAYS - 1)
    specs = [
        learn.Spec("random_forest", RandomForestClassifier(seed=1, numTrees=3), {"maxDepth": [2]}),
        learn.Spec("boosting_b", GBTClassifier(seed=1, maxIter=2, maxDepth=2), {"positiveWeight": [3]}),
    ]
    before = set(os.listdir(work_folder(features.sparkSession)))
    tuned = fleet.train_models(features, start=START, end=day - dt.timedelta(days=1), specs=specs)
    assert tuned.leaderboard.count() == 2
    assert set(os.listdir(work_folder(features.sparkSession))) == before  # interim tables are gone
    learn.save_models(tuned, str(tmp_path))
    scored = fleet.score_panel(features, learn.load_model(str(tmp_path), "boosting_b"), day)
    assert scored.count() == features.where(F.col("day") == day).count() > 0
    assert scored.columns == [*fleet.IDS, *fleet.FEATURES, "predicted_risk", "risk_probability"]
    assert scored.where("risk_probability is null").count() == 0
