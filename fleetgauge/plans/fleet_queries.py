"""The composed panel, over feeds made of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import functions as fn
from ..functions.codes import (
    ALARM_CATEGORIES,
    ALARM_TYPES,
    DAY_TYPES,
    FLAGS,
    RUN_MEASURES,
    UNIT_DIVISORS,
    VIOLATION_TYPES,
    WARNING_CLASSES,
    WARNING_FIELDS,
    ZERO_FILLED,
)
from ..operators.layout import Layout
from ..session import hand_off
from . import fleet
from .dim_queries import ID_SQL, customer_ids
from .registry import query, table

# Counts that come with a driver, here a rest of the customer's number by each of these.
DRIVER_COUNTS = {"ExamNum": 7, "TrainNum": 11, "ViolateNum": 3, "ViolationNum": 4, "AccidentNum": 13}
OUT = [
    "day", "driver", "plate", *RUN_MEASURES, "NegativeReview", "CarryPassengerNum",
    "DriverID", "DriverName", *DRIVER_COUNTS, "in_region", "sex", "age", "driveAge", "EntryAge", "vehicle", "device", "TEM", *FLAGS, "totalmileage",
    *ALARM_CATEGORIES.values(), *ALARM_TYPES.values(), *WARNING_CLASSES, *VIOLATION_TYPES.values(),
    "streak_before", "over_speed_cnt", "date_type", "target",
]


def feeds(spark: SparkSession, sf_dir: str) -> fleet.Feeds:
    """Events and customers as telematics feeds; identifiers come as text, whole numbers and doubles."""
    e = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "ts", "event_type", "value", "try_cast(get_json_object(props, '$.k') AS int) AS k",
        "cast(unix_seconds(cast(ts AS timestamp)) AS double) AS secs", "concat('P', user_id % 40) AS plate",
    )

    def of(kind: str, *cols: str) -> DataFrame:
        return e.where(kind).selectExpr(*cols)

    alarm = ["k % 3 AS handleStatus", "k % 2 AS handleTime", "secs AS alarmTime", "user_id AS jobNumber", "plate AS vehicleNumber"]
    people = customer_ids(spark, sf_dir).where("c_custkey % 5 <> 0").selectExpr(
        "c_custkey + 1000 AS DriverID", "cast(c_custkey AS double) AS Certified", "idn AS IDNumber", "'1' AS DriverTypeID", "c_name AS DriverName",
        *[f"cast(c_custkey % {n} AS int) AS {c}" for c, n in DRIVER_COUNTS.items()],
        "date_add(date'2010-01-01', cast(c_custkey AS int)) AS DrivingLicenseStartDate", "date'2020-05-05' AS EntryDate",
    )
    cars = table(spark, sf_dir, "customer").where("c_custkey < 60").selectExpr(
        "concat('P', c_custkey % 35) AS VehicleLic", "c_custkey % 35 AS VehicleID", "c_custkey AS AddTime",
        "cast(c_custkey % 30 AS double) AS TerminalEquipmentID", "concat('maker ', IF(c_custkey % 2 = 0, 'CK-R', 'X')) AS TerminalEquipmentManufacturer",
    )
    return fleet.Feeds(
        alarms=of("event_type = 'error'", *alarm, "1 + k % 6 AS categoryId", "element_at(array(18006, 18007, 56002, 99999), 1 + k % 4) AS alarmType"),
        over_speed=of("event_type = 'signup'", *alarm, "k * 4 AS speed"),
        warnings=of("event_type = 'purchase'", "cast(1 + k % 5 AS double) AS warningType", "k % 4 AS AebsStatus", "secs AS TimeSatellite", "cast(user_id AS double) AS DriverID", "user_id % 30 AS DeviceID"),
        trips=of(
            "event_type IN ('view', 'click')", "cast(user_id AS double) AS certificateId", "secs AS Addtime", "plate AS carNo", "k AS freeMileage", "k * 2 AS mileage",
            "k AS waitTime", "k * 10 AS money", "concat(k, '.0') AS passengerTime", "k % 5 AS judge", "cast(k % 3 AS string) AS passengerCount",
        ),
        positions=of("true", "secs AS gpsTime", "user_id % 30 AS deviceNo", "k * 10 AS mileage", "k AS speed", "user_id AS jobNumber"),
        logins=of("event_type = 'click'", "secs AS time", "user_id AS certification", "k % 3 AS status"),
        drivers=people,
        vehicles=cars,
        violations=of("event_type = 'purchase' AND k % 4 < 2", "user_id + 1000 AS DriverID", "user_id % 40 AS VehicleID", "ts AS ViolationTime", "1 + k % 3 AS Type"),
        statuses=of("event_type = 'view'", "user_id % 40 AS VehicleID", "ts AS TimeSatellite", "event_id AS DeviceID", "k % 2 AS IsGps", "k % 3 AS IsCamera", "1 AS IsAeb"),
        accidents=of("value > 60", "ts AS AccidentTime", "user_id + 1000 AS DriverID", "cast(user_id % 40 AS double) AS VehicleID"),
        holidays=of("day(ts) % 10 = 1", "cast(ts AS date) AS date", "'public_holiday' AS type"),
    )


def _counts(col: str, names: dict) -> str:
    return ", ".join(f"count(*) FILTER ({col} = {code!r}) AS {name}" for code, name in names.items())


PANEL_SQL = f"""
    WITH e AS (SELECT *, CAST(ts AS DATE) AS day, CAST(user_id AS VARCHAR) AS driver, 'P' || CAST(user_id % 40 AS VARCHAR) AS plate,
                      CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
    spine AS (SELECT day, driver, plate, sum(k)::BIGINT AS freeMileage, sum(k * 2)::BIGINT AS mileage, sum(k)::BIGINT AS waitTime, sum(k * 10)::BIGINT AS money, sum(k)::BIGINT AS passengerTime,
                     count(*) FILTER (k % 5 IN (3, 4)) AS NegativeReview, count(*) FILTER (k % 3 > 0) AS CarryPassengerNum
              FROM e WHERE event_type IN ('view', 'click') GROUP BY ALL),
    people AS (SELECT CAST(c_custkey AS VARCHAR) AS driver, CAST(c_custkey + 1000 AS VARCHAR) AS DriverID, c_name AS DriverName,
                      {", ".join(f"CAST(c_custkey % {n} AS INTEGER) AS {c}" for c, n in DRIVER_COUNTS.items())}, CASE WHEN idn[1:2] = '44' THEN 1 ELSE 0 END AS in_region,
                      TRY_CAST(substr(idn, 17, 1) AS INTEGER) % 2 AS sex, CAST(try_strptime(substr(idn, 7, 8), '%Y%m%d') AS DATE) AS birthday,
                      DATE '2010-01-01' + CAST(c_custkey AS INTEGER) AS licensed
               FROM ({ID_SQL}) JOIN (SELECT c_custkey, c_name FROM customer) USING (c_custkey) WHERE length(idn) = 18 AND c_custkey % 5 <> 0),
    cars AS (SELECT 'P' || (c_custkey % 35) AS plate, CAST(c_custkey % 35 AS VARCHAR) AS vehicle, CAST(c_custkey % 30 AS VARCHAR) AS device,
                    CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS TEM
             FROM customer WHERE c_custkey < 60 QUALIFY row_number() OVER (PARTITION BY c_custkey % 35 ORDER BY c_custkey DESC) = 1),
    status AS (SELECT day, CAST(user_id % 40 AS VARCHAR) AS vehicle, k % 2 AS IsGps, k % 3 AS IsCamera, 1 AS IsAeb FROM e WHERE event_type = 'view'
               QUALIFY row_number() OVER (PARTITION BY day, user_id % 40 ORDER BY ts DESC, event_id DESC) = 1),
    odometer AS (SELECT day, CAST(user_id % 30 AS VARCHAR) AS device, max(k * 10) AS totalmileage FROM e GROUP BY ALL),
    valid AS (SELECT *, 1 + k % 6 AS category, [18006, 18007, 56002, 99999][1 + k % 4] AS kind FROM e WHERE (k % 3 = 0 AND k % 2 = 0) OR k % 3 = 1),
    alarms AS (SELECT day, driver, plate, {_counts("category", ALARM_CATEGORIES)}, {_counts("kind", ALARM_TYPES)}
               FROM valid WHERE event_type = 'error' GROUP BY ALL),
    warned AS (SELECT day, driver, CAST(user_id % 30 AS VARCHAR) AS device, CASE 1 + k % 5 WHEN 1 THEN 'fcw' WHEN 2 THEN 'hmw' WHEN 3 THEN 'ldw'
                      ELSE ['no_brake', 'stereo_brake', 'radar_brake', 'ultrasonic_brake'][1 + k % 4] END AS class
               FROM e WHERE event_type = 'purchase' AND 1 + k % 5 <= 4),
    warnings AS (SELECT day, driver, device, {_counts("class", {c: c for c in WARNING_CLASSES})} FROM warned GROUP BY ALL),
    violations AS (SELECT day, CAST(user_id % 40 AS VARCHAR) AS vehicle, e.driver, count(*) FILTER (1 + k % 3 = 1) AS traffic_violation, count(*) FILTER (1 + k % 3 = 2) AS rule_breach
                   FROM e JOIN people USING (driver) WHERE event_type = 'purchase' AND k % 4 < 2 GROUP BY ALL),
    login_days AS (SELECT DISTINCT driver, day FROM e WHERE event_type = 'click'),
    marked AS (SELECT *, CASE WHEN coalesce(datediff('day', lag(day) OVER w, day), 0) <> 1 THEN day END AS start FROM login_days WINDOW w AS (PARTITION BY driver ORDER BY day)),
    logins AS (SELECT driver, day, datediff('day', last_value(start IGNORE NULLS) OVER (PARTITION BY driver ORDER BY day ROWS UNBOUNDED PRECEDING), day) AS streak_before FROM marked),
    fast AS (SELECT day, driver, plate, count(*) AS over_speed_cnt FROM valid WHERE event_type = 'signup' AND k * 4 > 20 AND k * 4 < 250 GROUP BY ALL),
    accidents AS (SELECT DISTINCT day, CAST(user_id + 1000 AS VARCHAR) AS DriverID, CAST(user_id % 40 AS VARCHAR) AS vehicle, 1 AS target FROM e WHERE value > 60),
    joined AS (SELECT * FROM spine LEFT JOIN people USING (driver) LEFT JOIN cars USING (plate) LEFT JOIN status USING (day, vehicle) LEFT JOIN odometer USING (day, device)
        LEFT JOIN alarms USING (day, driver, plate) LEFT JOIN warnings USING (day, device, driver) LEFT JOIN violations USING (day, vehicle, driver)
        LEFT JOIN logins USING (day, driver) LEFT JOIN fast USING (day, driver, plate) LEFT JOIN accidents USING (day, DriverID, vehicle))
    SELECT * EXCLUDE (birthday, licensed) REPLACE (coalesce(target, 0) AS target),
           datediff('day', birthday, day) AS age, datediff('day', licensed, day) AS driveAge, CASE WHEN DriverID IS NOT NULL THEN datediff('day', DATE '2020-05-05', day) END AS EntryAge,
           CASE WHEN day(day) % 10 = 1 THEN 'public_holiday' WHEN isodow(day) < 6 THEN 'workday' ELSE 'weekend' END AS date_type
    FROM joined
"""


@query(PANEL_SQL)
def fleet_wide_panel(spark, sf_dir):
    """All feeds rolled up, joined behind the gate, typed by day and labelled."""
    return fleet.wide_panel(feeds(spark, sf_dir)).select(*OUT).withColumn("DriverID", F.col("DriverID").cast("string"))


@query(PANEL_SQL)
def fleet_panel_in_buckets(spark, sf_dir):
    """The same panel from tables stored in buckets of driver and day."""
    wide = fleet.wide_panel(feeds(spark, sf_dir), layout=Layout(("driver", "day"), 8))
    return wide.select(*OUT).withColumn("DriverID", F.col("DriverID").cast("string"))


def _each(cols, line: str) -> str:
    """One line of SQL for each column, which stands for ``{c}``."""
    return ", ".join(line.format(c=c) for c in cols)


def _interval(c: str, of: str) -> str:
    """Three deviations about the mean of an expression; a constant is its own interval."""
    same = f"CASE WHEN count({of}) > 1 AND min({of}) = max({of}) THEN min({of}) ELSE avg({of})"
    return f"{same} - 3 * stddev_samp({of}) END AS {c}_lo, {same} + 3 * stddev_samp({of}) END AS {c}_hi"


def _rolled(c: str, func: str) -> str:
    over = "OVER (PARTITION BY plate, DriverName ORDER BY day RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)"
    value = {
        "sum": f"CASE WHEN count({c}) {over} > 1 THEN sum({c}) {over} - {c} END",
        "mean": f"CASE WHEN count({c}) {over} > 1 THEN (sum({c}) {over} - {c}) / (count({c}) {over} - 1) END",
        "std": f"stddev_samp({c}) {over}",
    }[func]
    return f"{value} AS {c}_8d_{func}"


def _mean_filled(cols) -> tuple[str, str]:
    """Lists for two steps: the mean of the group, then that of the column so filled."""
    group = _each(cols, "coalesce({c}, CASE WHEN DriverName IS NOT NULL THEN avg({c}) OVER (PARTITION BY plate, DriverName) END) AS {c}")
    return group, _each(cols, "coalesce({c}, avg({c}) OVER ()) AS {c}")


COUNTS_FILLED, COUNTS_FULL = _mean_filled(fleet.COUNT_FIELDS)
ROLLED_FILLED, ROLLED_FULL = _mean_filled(fleet.ROLLED)
CLIPPED = _each(WARNING_FIELDS, "CASE WHEN {c} < {c}_lo THEN {c}_lo WHEN {c} > {c}_hi THEN {c}_hi ELSE CAST({c} AS DOUBLE) END AS {c}")
CLIPPED_ALARMS = _each(
    fleet.ALARM_FIELDS, "CASE WHEN {c} <> 0 AND {c} < {c}_lo THEN {c}_lo WHEN {c} <> 0 AND {c} > {c}_hi THEN {c}_hi ELSE CAST({c} AS DOUBLE) END AS {c}"
)
ORDERED = "PARTITION BY plate ORDER BY day, DriverName NULLS LAST, driver"


@query(
    f"""
    WITH wide AS ({PANEL_SQL}),
    valid AS (SELECT *, CASE WHEN totalmileage > 0 THEN totalmileage END AS v FROM wide),
    mileage AS (SELECT * EXCLUDE (v) REPLACE (coalesce(last_value(v IGNORE NULLS) OVER ({ORDERED} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                  first_value(v IGNORE NULLS) OVER ({ORDERED} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), -1) AS totalmileage) FROM valid),
    base AS (SELECT * REPLACE ({", ".join(f"{c} / CAST({n} AS DOUBLE) AS {c}" for c, n in UNIT_DIVISORS.items())}) FROM mileage
             QUALIFY row_number() OVER (PARTITION BY day, plate, DriverName ORDER BY driver) = 1),
    bounds AS (SELECT {", ".join([*[_interval(c, c) for c in WARNING_FIELDS], *[_interval(c, f"nullif({c}, 0)") for c in fleet.ALARM_FIELDS]])} FROM base),
    clipped AS (SELECT base.* REPLACE ({CLIPPED}, {CLIPPED_ALARMS}, CASE WHEN IsAeb = 1 AND
                  {" + ".join(f"(CASE WHEN {c} < {c}_lo OR {c} > {c}_hi THEN 1 ELSE 0 END)" for c in WARNING_FIELDS)} > 0 THEN 0 ELSE IsAeb END AS IsAeb)
                FROM base, bounds),
    flagged AS (SELECT * REPLACE ({_each(FLAGS, "last_value({c} IGNORE NULLS) OVER w AS {c}")}, {_each(ZERO_FILLED, "coalesce({c}, 0) AS {c}")}) FROM clipped
                WINDOW w AS (ORDER BY plate, DriverName NULLS LAST, day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    grouped AS (SELECT * REPLACE ({COUNTS_FILLED}) FROM flagged),
    filled AS (SELECT * REPLACE ({COUNTS_FULL}) FROM grouped),
    rolled AS (SELECT *, {", ".join(_rolled(c, f) for c, fs in fleet.ROLLING.items() for f in fs)} FROM filled WHERE DriverName IS NOT NULL),
    regrouped AS (SELECT * REPLACE ({ROLLED_FILLED}) FROM rolled),
    complete AS (SELECT * REPLACE ({ROLLED_FULL}) FROM regrouped),
    derived AS (SELECT *, freeMileage_8d_mean + mileage_8d_mean AS distance, passengerTime_8d_mean + waitTime_8d_mean AS duration,
                       phone_use_8d_sum + smoking_8d_sum + distraction_8d_sum AS distraction_total,
                       crosswalk_no_yield_8d_sum + physical_conflict_8d_sum + crosswalk_speeding_8d_sum AS dangerous_total,
                       {", ".join(f"CASE WHEN date_type = '{d}' THEN 1 ELSE 0 END AS date_type_{d}" for d in DAY_TYPES)} FROM complete),
    featured AS (SELECT *, freeMileage_8d_mean / nullif(distance, 0) AS empty_distance_ratio, waitTime_8d_mean / nullif(duration, 0) AS idle_time_ratio FROM derived),
    scaled AS (SELECT * REPLACE ({_each(fleet.SCALED, "({c} - avg({c}) OVER ()) / CASE WHEN min({c}) OVER () = max({c}) OVER () THEN 1 ELSE stddev_pop({c}) OVER () END AS {c}")}) FROM featured)
    SELECT day, plate, DriverName, target, {_each(fleet.FEATURES, "round(CAST({c} AS DOUBLE), 6) + 0.0 AS {c}")} FROM scaled
    """
)
def fleet_features(spark, sf_dir):
    """All features of the model, from raw feeds through panel, cleaning, windows and scaling."""
    wide = hand_off(fleet.wide_panel(feeds(spark, sf_dir)), "wide")
    rows = fleet.prepare_features(wide)
    return rows.select("day", "plate", "DriverName", "target", *[fn.round_to(F.col(c).cast("double"), 6).alias(c) for c in fleet.FEATURES])
