"""The composed work: raw feeds to daily tables, one wide panel, features, model, scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, functions as F

from .. import functions as fn
from ..functions.codes import (
    ALARM_CATEGORIES,
    ALARM_TYPES,
    BRAKE_WARNING_TYPE,
    DAY_TYPES,
    DEVICE_MAKER_TEXT,
    FLAGS,
    LOGIN_STATUSES,
    MOVING_SPEED,
    NEGATIVE_REVIEWS,
    OVER_SPEED_RANGE,
    REGION_PREFIX,
    ROLLED_MEANS,
    RUN_MEASURES,
    UNIT_DIVISORS,
    VIOLATION_TYPES,
    WARNING_CLASSES,
    WARNING_FIELDS,
    WARNING_TYPES,
    ZERO_FILLED,
)
from ..operators import clean, dims, fill, join, learn, panel, rollup
from ..operators.layout import Layout
from ..session import compile_wide_rows, hand_off, interim
from ..sources import Gate, publish, scan_days
from ..sources.published import Facts

# ---- daily tables from event feeds --------------------------------------------


def _alarms(df: DataFrame, day_tz: str) -> DataFrame:
    return df.where(fn.valid_alarm("handleStatus", "handleTime")).withColumns(
        {
            "day": fn.epoch_to_day("alarmTime", day_tz),
            "driver": fn.as_text(df, "jobNumber"),
            "plate": F.col("vehicleNumber"),
        }
    )


def alarm_counts(alarms: DataFrame, day_tz: str = "UTC") -> DataFrame:
    """Valid alarms per day, driver and plate, by category and by type."""
    return rollup.code_counts(
        _alarms(alarms, day_tz).dropna(subset=["driver"]),
        ["day", "driver", "plate"],
        {"categoryId": ALARM_CATEGORIES, "alarmType": ALARM_TYPES},
    )


def over_speed_counts(alarms: DataFrame, day_tz: str = "UTC") -> DataFrame:
    """Valid over-speed alarms per day, driver and plate."""
    fast = _alarms(alarms.where(fn.open_range("speed", *OVER_SPEED_RANGE)), day_tz)
    return rollup.daily_agg(
        fast, ["day", "driver", "plate"], aggs={"over_speed_cnt": F.count(F.lit(1))}
    )


def collision_counts(warnings: DataFrame, day_tz: str = "UTC") -> DataFrame:
    """Collision warnings per day, driver and device, by class."""
    typed = warnings.withColumns(
        {
            "kind": fn.as_text(warnings, "warningType"),
            "status": fn.as_text(warnings, "AebsStatus"),
        }
    ).where(F.col("kind").isin(*WARNING_TYPES, BRAKE_WARNING_TYPE))
    classed = typed.withColumns(
        {
            "day": fn.epoch_to_day("TimeSatellite", day_tz),
            "driver": fn.as_text(warnings, "DriverID"),
            "device": fn.as_text(warnings, "DeviceID"),
            "class": fn.warning_class("kind", "status"),
        }
    )
    return rollup.code_counts(
        classed, ["day", "driver", "device"], {"class": {c: c for c in WARNING_CLASSES}}
    )


def run_totals(trips: DataFrame, day_tz: str = "UTC") -> DataFrame:
    """Distance, time, money, bad reviews and occupied trips per driver, day and plate."""
    keyed = trips.withColumns(
        {
            "driver": fn.as_text(trips, "certificateId"),
            "day": fn.epoch_to_day("Addtime", day_tz),
            "plate": F.col("carNo"),
        }
    ).dropna(subset=["driver", "day", "plate"])
    return rollup.daily_agg(
        keyed,
        ["driver", "day", "plate"],
        sums={
            **{m: F.col(m) for m in RUN_MEASURES if m != "passengerTime"},
            "passengerTime": fn.to_number(trips, "passengerTime"),
            "NegativeReview": fn.flag(F.col("judge").isin(*NEGATIVE_REVIEWS)),
            "CarryPassengerNum": fn.flag(fn.to_number(trips, "passengerCount", "double") > 0),
        },
    )


def device_mileage(positions: DataFrame, day_tz: str = "UTC") -> DataFrame:
    """Largest odometer value and number of positions per day and device."""
    keyed = positions.withColumns(
        {"day": fn.epoch_to_day("gpsTime", day_tz), "device": fn.as_text(positions, "deviceNo")}
    )
    return rollup.daily_agg(
        keyed,
        ["day", "device"],
        aggs={"totalmileage": F.max("mileage"), "daily_record_count": F.count(F.lit(1))},
    )


def driver_speed(positions: DataFrame, day_tz: str = "UTC") -> DataFrame:
    """Speed statistics of moving positions per day and driver."""
    moving = positions.where((F.col("speed") > MOVING_SPEED) & fn.has_text("jobNumber")).withColumns(
        {"day": fn.epoch_to_day("gpsTime", day_tz), "driver": fn.as_text(positions, "jobNumber")}
    )
    return rollup.speed_stats(moving, ["day", "driver"], "speed")


def login_counts(logins: DataFrame, day_tz: str = "UTC") -> DataFrame:
    """Sign-outs and sign-ins per day and driver."""
    keyed = fn.normalise_ids(logins, "certification").withColumns(
        {"day": fn.epoch_to_day("time", day_tz), "driver": F.col("certification")}
    )
    return rollup.crosstab(keyed, ["day", "driver"], "status", LOGIN_STATUSES)


def login_streaks(logins: DataFrame, day_tz: str = "UTC") -> DataFrame:
    """Days in a row with any login up to the day before, per driver and login day."""
    return panel.streak_before(login_counts(logins, day_tz), ["driver"], "day")


# ---- dimensions ------------------------------------------------------------------


def clean_drivers(
    drivers: DataFrame,
    *,
    order: Sequence[str] = ("DriverID",),
    region: str = REGION_PREFIX,
    excluded: Sequence[str] = (),
) -> DataFrame:
    """One row per identity number and certificate, with attributes read from the number."""
    one = dims.latest_per_key(drivers, ["IDNumber", "Certified"], list(order))
    typed = fn.normalise_ids(one, "DriverID", "Certified").withColumn(
        "DriverTypeID", fn.to_number(one, "DriverTypeID")
    )
    kept = fn.exclude(typed, {"Certified": list(excluded)}) if excluded else typed
    return kept.where(F.length("IDNumber") == 18).withColumns(
        {
            "in_region": fn.prefix_flag("IDNumber", region),
            "sex": fn.digit_parity("IDNumber", 17),
            "birthday": fn.compact_date("IDNumber", 7),
            "DrivingLicenseStartDate": F.to_date("DrivingLicenseStartDate"),
            "EntryDate": F.to_date("EntryDate"),
        }
    )


def clean_vehicles(vehicles: DataFrame, *, maker_text: str = DEVICE_MAKER_TEXT) -> DataFrame:
    """The latest row per plate, with a flag for the device maker."""
    latest = dims.latest_per_key(vehicles, ["VehicleLic"], ["AddTime", "VehicleID"])
    named = fn.normalise_ids(latest, "VehicleID", "TerminalEquipmentID")
    return named.select(
        F.col("VehicleLic").alias("plate"),
        F.col("VehicleID").alias("vehicle"),
        F.col("TerminalEquipmentID").alias("device"),
        fn.contains_flag("TerminalEquipmentManufacturer", maker_text).alias("TEM"),
    ).dropna(subset=["plate"])


def violation_counts(violations: DataFrame, drivers: DataFrame) -> DataFrame:
    """Violations of known drivers per day, vehicle and certificate, by type."""
    known = drivers.select("DriverID", F.col("Certified").alias("driver"))
    own = fn.normalise_ids(violations, "DriverID", "VehicleID").join(known, "DriverID")
    keyed = own.withColumns(
        {"day": F.to_date("ViolationTime"), "vehicle": F.col("VehicleID")}
    )
    return rollup.crosstab(keyed, ["day", "vehicle", "driver"], "Type", VIOLATION_TYPES)


def vehicle_status(history: DataFrame) -> DataFrame:
    """The last status of a vehicle on each day."""
    keyed = fn.normalise_ids(history, "VehicleID").withColumn("day", F.to_date("TimeSatellite"))
    latest = dims.latest_per_key(keyed, ["day", "VehicleID"], ["TimeSatellite", "DeviceID"])
    return latest.select(
        "day", F.col("VehicleID").alias("vehicle"), "DeviceID", "IsGps", "IsCamera", "IsAeb"
    )


def accident_days(accidents: DataFrame) -> DataFrame:
    # The label join reduces them to one row per key; repeated rows need no step of their own.
    return fn.normalise_ids(accidents, "VehicleID", "DriverID").select(
        F.to_date("AccidentTime").alias("day"), "DriverID", F.col("VehicleID").alias("vehicle")
    )


# ---- the wide panel ----------------------------------------------------------------

PANEL_LAYOUT = Layout(("driver", "day"), 200)


@dataclass(frozen=True)
class Feeds:
    """Raw inputs, as read by ``sources``."""

    alarms: DataFrame
    warnings: DataFrame
    over_speed: DataFrame
    trips: DataFrame
    positions: DataFrame
    logins: DataFrame
    drivers: DataFrame
    vehicles: DataFrame
    violations: DataFrame
    statuses: DataFrame
    accidents: DataFrame
    holidays: DataFrame


def wide_panel(
    feeds: Feeds,
    *,
    day_tz: str = "UTC",
    excluded: Mapping[str, Sequence[str]] | None = None,
    gate: bool = True,
    layout: Layout | None = None,
    spine: DataFrame | None = None,
) -> DataFrame:
    """One row per driver, day and plate with everything known about it and the accident label.

    With a ``layout``, such as ``PANEL_LAYOUT``, the daily tables of a driver are stored in buckets and joined
    without another shuffle of the panel. ``spine`` may bring the stored run totals. ``excluded`` lists values of ``driver``, ``plate`` or ``vehicle`` to leave out
    of the result, such as test vehicles.
    """
    excluded = dict(excluded or {})
    drivers = clean_drivers(feeds.drivers, excluded=excluded.get("driver", ()))
    compile_wide_rows(feeds.trips.sparkSession)
    # Read by the checks of the join and by the join itself.
    spine = hand_off(run_totals(feeds.trips, day_tz), "spine") if spine is None else spine
    day_keys = ["day", "driver", "plate"]

    def rolled_up(name, df, on, drop=(), skewed=False):
        return join.Dim(name, df, on, drop=drop, unique=True, skewed=skewed)

    joined = join.wide_join(
        spine,
        [
            join.Dim("driver", drivers, {"driver": "Certified"}, drop=("IDNumber",), skewed=True),
            join.Dim("vehicle", clean_vehicles(feeds.vehicles), ["plate"], unique=True, skewed=True),
            # Rows of unmatched plates have no vehicle and no device: a hot null key on every day.
            rolled_up("status", vehicle_status(feeds.statuses), ["day", "vehicle"], skewed=True),
            rolled_up(
                "mileage", device_mileage(feeds.positions, day_tz), ["day", "device"],
                drop=("daily_record_count",), skewed=True,
            ),
            rolled_up("alarms", alarm_counts(feeds.alarms, day_tz), day_keys),
            rolled_up("warnings", collision_counts(feeds.warnings, day_tz), ["day", "device", "driver"], skewed=True),
            rolled_up("violations", violation_counts(feeds.violations, drivers), ["day", "vehicle", "driver"], skewed=True),
            rolled_up("logins", login_streaks(feeds.logins, day_tz), ["day", "driver"]),
            rolled_up("over_speed", over_speed_counts(feeds.over_speed, day_tz), day_keys),
        ],
        gate=gate,
        layout=layout,
    )
    starts = {"age": "birthday", "driveAge": "DrivingLicenseStartDate", "EntryAge": "EntryDate"}
    joined = joined.withColumns(
        {age: fn.days_between("day", start) for age, start in starts.items()}
    ).drop(*starts.values())
    typed = dims.day_type(joined, "day", feeds.holidays)
    labelled = dims.label_from_events(
        typed, accident_days(feeds.accidents), ["day", "DriverID", "vehicle"], skewed=join.may_be_hot(spine)
    )
    return fn.exclude(labelled, excluded) if excluded else labelled


def publish_panel(
    feeds: Feeds, folder: str, *, most_nulls: Mapping[str, float] | None = None, day_tz: str = "UTC", **options
) -> tuple[int, Facts]:
    """Write the panel as the next version of ``folder``; gives its number, and its rows and the nulls of each column.

    Counted while it is written, the panel must not have more rows than the run totals, nor more nulls than the shares in ``most_nulls``. One
    that does is refused, and the version before it stays the current one. ``options`` are those of ``wide_panel``.
    """
    with interim(feeds.trips.sparkSession):
        spine = hand_off(run_totals(feeds.trips, day_tz), "spine")
        wide = wide_panel(feeds, day_tz=day_tz, spine=spine, **options)
        return publish(wide, folder, Gate(most_rows=spine.count(), most_nulls=most_nulls or {}))


# ---- features ------------------------------------------------------------------------

PANEL_KEYS = ["plate", "DriverName"]
ALARM_FIELDS = [*ALARM_CATEGORIES.values(), *ALARM_TYPES.values()]
VIOLATION_FIELDS = list(VIOLATION_TYPES.values())
COUNT_FIELDS = [*ALARM_FIELDS, *WARNING_FIELDS, *VIOLATION_FIELDS]

WINDOW_DAYS = 8
ROLLING = {
    **{c: ["mean"] for c in (*ROLLED_MEANS, *FLAGS)},
    **{c: ["sum"] for c in ("NegativeReview", *COUNT_FIELDS, "over_speed_cnt")},
    "harsh_accel": ["sum", "std", "mean"],
    "harsh_decel": ["sum", "std", "mean"],
}
ROLLED = [panel.rolling_name(c, WINDOW_DAYS, f) for c, fs in ROLLING.items() for f in fs]
# Rolled columns that only feed the derived ones.
PARTS = [
    *[f"{c}_8d_mean" for c in ("freeMileage", "mileage", "passengerTime", "waitTime")],
    *[f"{c}_8d_sum" for c in ("phone_use", "smoking", "distraction")],
    *[f"{c}_8d_sum" for c in ("crosswalk_no_yield", "physical_conflict", "crosswalk_speeding")],
]
DERIVED = ["distance", "empty_distance_ratio", "duration", "idle_time_ratio", "distraction_total", "dangerous_total"]
SCALED = ["totalmileage", *[c for c in ROLLED if c not in PARTS]]
FEATURES = [
    "ExamNum", "TrainNum", "ViolateNum", "ViolationNum", "AccidentNum",
    "in_region", "sex", "age", "TEM", "streak_before",
    *SCALED,
    *[f"date_type_{d}" for d in DAY_TYPES],
    *DERIVED,
]


def derive(df: DataFrame) -> DataFrame:
    """Distance and duration with their idle shares, and two totals of risky conduct."""
    part = {c: F.col(c) for c in PARTS}
    sums = df.withColumns(
        {
            "distance": part["freeMileage_8d_mean"] + part["mileage_8d_mean"],
            "duration": part["passengerTime_8d_mean"] + part["waitTime_8d_mean"],
            "distraction_total": part["phone_use_8d_sum"] + part["smoking_8d_sum"] + part["distraction_8d_sum"],
            "dangerous_total": part["crosswalk_no_yield_8d_sum"] + part["physical_conflict_8d_sum"] + part["crosswalk_speeding_8d_sum"],
        }
    )
    return sums.withColumns(
        {
            "empty_distance_ratio": fn.ratio("freeMileage_8d_mean", "distance"),
            "idle_time_ratio": fn.ratio("waitTime_8d_mean", "duration"),
        }
    )


def prepare_features(
    wide: DataFrame,
    *,
    run_date: date | None = None,
    lookback_days: int = 15,
    flags_across_groups: bool = True,
    fit_days: tuple[date, date] | None = None,
    scale: bool = True,
) -> DataFrame:
    """Clean, fill, roll up, encode and scale the panel.

    ``scale=False`` leaves scaling to ``train_models``, which fits it on training rows and stores it.

    ``wide`` should be a stored table. Interim results are stored four times on
    the way, each time before a step that reads its input twice. ``fit_days``
    limits the rows the scaler is fitted on; by default all rows.
    """
    compile_wide_rows(wide.sparkSession)
    rows = wide if run_date is None else scan_days(wide, "day", run_date, lookback_days)
    order = ["day", "DriverName", "driver"]
    mileage = fill.fill_forward_backward(rows, ["plate"], order, "totalmileage")
    unique = dims.first_per_key(mileage, ["day", *PANEL_KEYS], ["driver"])
    base = hand_off(fn.scale_units(unique, UNIT_DIVISORS), "panel-base")

    clipped = clean.sigma_clip(base, WARNING_FIELDS)
    clipped = clean.reset_flag(clipped, "IsAeb", F.col("outlier_count") > 0)
    clipped = clean.sigma_clip(
        clipped, ALARM_FIELDS, ignore_zero=True,
        bounds=clean.sigma_bounds(base, ALARM_FIELDS, ignore_zero=True),
    )
    flagged = fill.forward_fill(
        clipped, PANEL_KEYS, ["day"], FLAGS, across_groups=flags_across_groups
    )
    zeroed = hand_off(flagged.na.fill(0, ZERO_FILLED), "panel-flags")
    filled = clean.group_mean_fill(zeroed, PANEL_KEYS, COUNT_FIELDS)

    rolled = hand_off(panel.rolling(filled, PANEL_KEYS, "day", ROLLING, days=WINDOW_DAYS), "panel-rolled")
    complete = clean.group_mean_fill(rolled, PANEL_KEYS, ROLLED)
    featured = hand_off(derive(fn.one_hot(complete, "date_type", DAY_TYPES)), "panel-features")

    if not scale:
        return featured.dropna(subset=["DriverName"])
    fit_on = featured
    if fit_days is not None:
        fit_on = featured.where(F.col("day").between(F.lit(fit_days[0]), F.lit(fit_days[1])))
    return clean.standardize(featured, SCALED, fit_on=fit_on).dropna(subset=["DriverName"])


# ---- model -----------------------------------------------------------------------------

IDS = ["day", "plate", "DriverName"]


def with_ident(features: DataFrame) -> DataFrame:
    """One text that names a panel row."""
    return features.withColumn(
        "ident", F.concat_ws("|", F.date_format("day", "yyyy-MM-dd"), "plate", "DriverName")
    )


def train_models(
    features: DataFrame,
    *,
    start: date,
    end: date,
    specs: Sequence[learn.Spec] | None = None,
    noise: float = 0.1,
    seed: int = 42,
    reference_order: bool = False,
    parallelism: int = 8,
    scaled: Sequence[str] = (),
    max_fit_rows: int | None = None,
    ledger: str | None = None,
) -> learn.Tuned:
    """Fit every spec on the days from ``start`` to ``end``.

    With a folder as ``ledger`` a search that was stopped goes on with the fits that are missing.

    The means for empty cells, and the scale of the columns ``scaled``, are fitted on the training rows and stored with
    each model. Pass ``scaled=SCALED`` for features prepared with ``scale=False``.
    """
    with interim(features.sparkSession):
        train, test = learn.training_sets(
            with_ident(features), ident="ident", features=FEATURES, day="day", start=start, end=end,
            noise=noise, seed=seed, reference_order=reference_order, max_fit_rows=max_fit_rows,
        )
        train = hand_off(train, "train")
        return learn.grid_search(
            train, test, specs or learn.default_specs(seed), features=FEATURES, ident="ident",
            parallelism=parallelism, seed=seed, stages=learn.fit_preprocessing(train, FEATURES, scaled), ledger=ledger,
        )


def score_panel(features: DataFrame, model: PipelineModel, on: date) -> DataFrame:
    """Risk of every driver, day and plate of one day.

    Empty cells get the mean of their column: that of the training rows where the model stores it, as
    ``train_models`` does, else that of the table.
    """
    typed = features.withColumns({c: F.col(c).cast("double") for c in FEATURES})
    if not isinstance(model.stages[0], SQLTransformer):  # a model without stored preprocessing
        typed = learn.fit_imputer(typed, FEATURES).transform(typed)
    return learn.score(typed, model, IDS, features=FEATURES, day="day", on=on)
