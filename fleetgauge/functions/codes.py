"""Fixed values of the telematics feeds."""

# Alarm category -> column
ALARM_CATEGORIES = {
    1: "adas_violation",
    2: "alarm",
    3: "reminder",
    4: "risk_control",
    5: "fault",
}

# Alarm type -> column
ALARM_TYPES = {
    18006: "harsh_accel",
    18007: "harsh_decel",
    30087: "severe_fatigue",
    56002: "phone_use",
    56003: "smoking",
    56004: "distraction",
    3010: "crosswalk_no_yield",
    30144: "physical_conflict",
    30173: "crosswalk_speeding",
}

# Warning type -> class; type 4 is told apart by its brake status
WARNING_TYPES = {"1": "fcw", "2": "hmw", "3": "ldw"}
BRAKE_WARNING_TYPE = "4"
BRAKE_STATUSES = {
    "0": "no_brake",
    "1": "stereo_brake",
    "2": "radar_brake",
    "3": "ultrasonic_brake",
}
INACTIVE_WARNING = "inactive_warning"
WARNING_CLASSES = [*WARNING_TYPES.values(), *BRAKE_STATUSES.values(), INACTIVE_WARNING]

# Violation type -> column, login status -> column
VIOLATION_TYPES = {1: "traffic_violation", 2: "rule_breach"}
LOGIN_STATUSES = {0: "sign_out", 1: "sign_in"}

# Reviews counted as negative
NEGATIVE_REVIEWS = (3, 4)

# Day types
HOLIDAY_TYPES = ("public_holiday", "transfer_workday")
DAY_TYPES = ("public_holiday", "transfer_workday", "workday", "weekend")

# Speeds counted as over-speed lie strictly between these, moving ones above the last
OVER_SPEED_RANGE = (20, 250)
MOVING_SPEED = 5

# Region prefix of an identity number, text in a device maker's name
REGION_PREFIX = "44"
DEVICE_MAKER_TEXT = "CK-R"

# Divisors from raw to reported units
UNIT_DIVISORS = {
    "freeMileage": 1000,
    "mileage": 1000,
    "passengerTime": 3600,
    "waitTime": 3600,
    "money": 100,
    "age": 365,
}

# Measures of a trip, in the order of the feed
RUN_MEASURES = ("freeMileage", "passengerTime", "waitTime", "mileage", "money")

# Warning counts that are clipped, device flags that are carried on, fields whose gaps are zero
WARNING_FIELDS = ["ldw", "fcw", "radar_brake", "hmw", "ultrasonic_brake", "stereo_brake"]
FLAGS = ["IsGps", "IsCamera", "IsAeb"]
ZERO_FILLED = ["streak_before", "over_speed_cnt", "ExamNum", "TrainNum"]

# Measures of which the panel keeps a rolling mean, besides the device flags
ROLLED_MEANS = ["freeMileage", "mileage", "passengerTime", "waitTime", "money", "CarryPassengerNum"]
