"""Dimension cleaning, joins and labels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import functions as fn
from ..functions.codes import DAY_TYPES
from ..operators import dims, join, panel, rollup, skew
from .registry import query, table


@query(
    """
    SELECT o_custkey, o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END DESC NULLS LAST,
                 o_totalprice DESC, o_orderkey DESC) AS r
      FROM orders) WHERE r = 1
    """
)
def latest_per_key(spark, sf_dir):
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    latest = dims.latest_per_key(
        table(spark, sf_dir, "orders"), ["o_custkey"], [known, "o_totalprice", "o_orderkey"]
    )
    return latest.select(
        "o_custkey", "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day")
    )


@query(
    """
    SELECT o_custkey, o_orderkey FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END DESC NULLS FIRST,
                 o_totalprice DESC, o_orderkey DESC) AS r
      FROM orders) WHERE r = 1
    """
)
def latest_per_key_null_wins(spark, sf_dir):
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    latest = dims.latest_per_key(
        table(spark, sf_dir, "orders"),
        ["o_custkey"],
        [known, "o_totalprice", "o_orderkey"],
        nulls_win=True,
    )
    return latest.select("o_custkey", "o_orderkey")


@query(
    """
    SELECT o_custkey, o_orderstatus, o_orderkey FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus
                                   ORDER BY o_orderdate, o_orderkey) AS r
      FROM orders) WHERE r = 1
    """
)
def first_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    twice = orders.unionByName(orders).dropDuplicates()
    return dims.first_per_key(
        twice, ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"]
    ).select("o_custkey", "o_orderstatus", "o_orderkey")


@query(
    """
    SELECT o_custkey, CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS f,
           CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS o
    FROM orders GROUP BY 1
    """
)
def crosstab_fixed_codes(spark, sf_dir):
    return rollup.crosstab(
        table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderstatus", {"F": "f", "O": "o"}
    )


ID_SQL = """
    SELECT c_custkey,
      (CASE WHEN c_custkey % 3 = 0 THEN '440301' ELSE '110101' END)
      || lpad(CAST(1950 + c_custkey % 50 AS VARCHAR), 4, '0')
      || lpad(CAST(c_custkey % 14 AS VARCHAR), 2, '0')
      || lpad(CAST(1 + c_custkey % 31 AS VARCHAR), 2, '0') || '00'
      || (CASE WHEN c_custkey % 17 = 0 THEN 'X' ELSE CAST(c_custkey % 10 AS VARCHAR) END)
      || (CASE WHEN c_custkey % 11 = 0 THEN '' ELSE '4' END) AS idn
    FROM customer
"""


def customer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eighteen-character identity numbers, among them bad dates, bad digits and short ones."""
    k = F.col("c_custkey")

    def padded(value, width):
        return F.lpad(value.cast("string"), width, "0")

    idn = F.concat(
        F.when(k % 3 == 0, "440301").otherwise("110101"),
        padded(1950 + k % 50, 4),
        padded(k % 14, 2),
        padded(1 + k % 31, 2),
        F.lit("00"),
        F.when(k % 17 == 0, "X").otherwise((k % 10).cast("string")),
        F.when(k % 11 == 0, "").otherwise("4"),
    )
    return table(spark, sf_dir, "customer").withColumn("idn", idn)


@query(
    f"""
    SELECT CAST(c_custkey AS VARCHAR) AS driver,
      CASE WHEN idn[1:2] = '44' THEN 1 ELSE 0 END AS is_region,
      TRY_CAST(substr(idn, 17, 1) AS INTEGER) % 2 AS sex,
      CAST(try_strptime(substr(idn, 7, 8), '%Y%m%d') AS DATE) AS birthday,
      CAST(datediff('day', CAST(try_strptime(substr(idn, 7, 8), '%Y%m%d') AS DATE), DATE '2024-01-01') AS INTEGER) AS age
    FROM ({ID_SQL}) WHERE length(idn) = 18 AND c_custkey <> 100
    """
)
def id_attributes(spark, sf_dir):
    ids = customer_ids(spark, sf_dir)
    kept = fn.exclude(ids, {"c_custkey": [100]}).where(F.length("idn") == 18)
    named = fn.normalise_ids(kept.withColumnRenamed("c_custkey", "driver"), "driver")
    return named.select(
        "driver",
        fn.prefix_flag("idn", "44").alias("is_region"),
        fn.digit_parity("idn", 17).alias("sex"),
        fn.compact_date("idn", 7).alias("birthday"),
        fn.days_between(F.lit(date(2024, 1, 1)), fn.compact_date("idn", 7)).alias("age"),
    )


@query(
    """
    SELECT c_custkey,
      CASE WHEN c_custkey % 7 <> 0 THEN CASE WHEN contains(c_mktsegment, 'MACH') THEN 1 ELSE 0 END END AS has_text
    FROM customer
    """
)
def contains_flag(spark, sf_dir):
    maker = F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", fn.contains_flag(maker, "MACH").alias("has_text")
    )


@query(
    """
    SELECT o_orderkey,
      CAST(CASE WHEN o_orderstatus <> 'P' THEN datediff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') END AS INTEGER) AS age
    FROM orders
    """
)
def age_columns(spark, sf_dir):
    start = F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fn.days_between(F.lit(date(2002, 1, 1)), start).alias("age")
    )


HOLIDAYS = [
    (0, date(1998, 1, 1), "public_holiday"),
    (1, date(1998, 1, 28), "public_holiday"),
    (2, date(1998, 1, 29), "school_holiday"),
    (3, date(1998, 2, 7), "transfer_workday"),
    (4, date(1998, 1, 1), "transfer_workday"),
    (5, date(1999, 5, 1), "public_holiday"),
    (6, date(1999, 5, 8), "transfer_workday"),
]
DAY_TYPE_SQL = """CASE
    WHEN CAST(o_orderdate AS DATE) IN (DATE '1998-01-01', DATE '1998-01-28', DATE '1999-05-01') THEN 'public_holiday'
    WHEN CAST(o_orderdate AS DATE) IN (DATE '1998-02-07', DATE '1999-05-08') THEN 'transfer_workday'
    WHEN isodow(o_orderdate) < 6 THEN 'workday' ELSE 'weekend' END"""


def order_day_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    holidays = spark.createDataFrame(HOLIDAYS, "position int, date date, type string")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return dims.day_type(orders, "o_orderdate", holidays).select("o_orderkey", "date_type")


@query(f"SELECT o_orderkey, {DAY_TYPE_SQL} AS date_type FROM orders")
def day_type(spark, sf_dir):
    return order_day_types(spark, sf_dir)


@query(
    f"""
    SELECT o_orderkey, {", ".join(f"CASE WHEN d = '{d}' THEN 1 ELSE 0 END AS date_type_{d}" for d in DAY_TYPES)}
    FROM (SELECT o_orderkey, {DAY_TYPE_SQL} AS d FROM orders)
    """
)
def one_hot_day_type(spark, sf_dir):
    return fn.one_hot(order_day_types(spark, sf_dir), "date_type", DAY_TYPES)


@query(
    """
    SELECT o_orderkey, k FROM (
      SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS k FROM orders)
    WHERE k IS NULL OR k NOT IN ('7', '12', '100')
    """
)
def exclude_null_keeping(spark, sf_dir):
    keyed = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("k"),
    )
    return fn.exclude(keyed, {"k": ["7", "12", "100"]})


@query(
    """
    SELECT o_orderkey, c_name, c_mktsegment
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k FROM orders) o
    JOIN customer ON k = c_custkey
    """
)
def inner_dim_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("c_custkey")
    )
    drivers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return orders.join(drivers, "c_custkey").drop("c_custkey")


def user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily panel: one row per user and day."""
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"), fn.round_to(F.sum("value"), 4).alias("total"))
    )


USER_DAYS = """user_days AS (
    SELECT user_id, CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total
    FROM events GROUP BY 1, 2)"""
STREAKS = """streaks AS (
    SELECT user_id, day, CAST(row_number() OVER (PARTITION BY user_id, island ORDER BY day) - 1 AS INTEGER) AS streak_before
    FROM (SELECT user_id, day, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS island
          FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events)))"""


@query(f"WITH {STREAKS} SELECT * FROM streaks")
def login_streak(spark, sf_dir):
    return panel.streak_before(
        table(spark, sf_dir, "events").withColumnRenamed("ts", "day"), ["user_id"], "day"
    )



def big_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where("event_type = 'purchase' AND value > 100")
        .select("user_id", F.to_date("ts").alias("day"))
    )


@query(
    f"""
    WITH {USER_DAYS}, bad AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events
                              WHERE event_type = 'purchase' AND value > 100)
    SELECT d.user_id, d.day, CASE WHEN b.user_id IS NOT NULL THEN 1 ELSE 0 END AS target
    FROM user_days d LEFT JOIN bad b ON b.user_id = d.user_id AND b.day = d.day
    """
)
def accident_label(spark, sf_dir):
    spine = user_days(spark, sf_dir).select("user_id", "day")
    return dims.label_from_events(spine, big_purchases(spark, sf_dir), ["user_id", "day"])


def panel_dims(spark: SparkSession, sf_dir: str) -> list[join.Dim]:
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    counts = rollup.code_counts(
        events.where("value > 20"),
        ["user_id", "day"],
        {"event_type": {"click": "clicks", "error": "errors"}},
    )
    return [
        join.Dim(
            "customer",
            table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0"),
            {"user_id": "c_custkey"},
            drop=("c_acctbal", "c_mktsegment"),
        ),
        join.Dim(
            "nation",
            table(spark, sf_dir, "nation"),
            {"c_nationkey": "n_nationkey"},
            drop=("n_regionkey",),
        ),
        join.Dim("counts", counts, ["user_id", "day"], unique=True),
        join.Dim(
            "streak",
            panel.streak_before(events, ["user_id"], "day"),
            ["user_id", "day"],
            unique=True,
        ),
    ]


@query(
    f"""
    WITH {USER_DAYS}, {STREAKS},
    counts AS (SELECT user_id, CAST(ts AS DATE) AS day,
                      CAST(count(*) FILTER (event_type = 'click') AS BIGINT) AS clicks,
                      CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS errors
               FROM events WHERE value > 20 GROUP BY 1, 2),
    bad AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events
            WHERE event_type = 'purchase' AND value > 100)
    SELECT d.user_id, d.day, d.n, d.total, c_name, c_nationkey, n_name, clicks, errors, streak_before,
           CASE WHEN b.user_id IS NOT NULL THEN 1 ELSE 0 END AS target
    FROM user_days d
    LEFT JOIN customer ON c_custkey = d.user_id AND c_custkey % 5 <> 0
    LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN counts c ON c.user_id = d.user_id AND c.day = d.day
    LEFT JOIN streaks s ON s.user_id = d.user_id AND s.day = d.day
    LEFT JOIN bad b ON b.user_id = d.user_id AND b.day = d.day
    """
)
def wide_join(spark, sf_dir):
    joined = join.wide_join(user_days(spark, sf_dir), panel_dims(spark, sf_dir))
    # the spine has one row per user and day
    return dims.label_from_events(joined, big_purchases(spark, sf_dir), ["user_id", "day"], skewed=False)


@query(
    """
    WITH u AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
    o AS (SELECT o_custkey, count(*) AS c FROM orders GROUP BY 1),
    n AS (SELECT count(*)::BIGINT AS once, sum(coalesce(c, 1))::BIGINT AS many FROM u LEFT JOIN o ON o_custkey = user_id)
    SELECT step, name, CASE WHEN step < 5 THEN once ELSE many END AS rows
    FROM n, (VALUES (0, 'spine'), (1, 'customer'), (2, 'nation'), (3, 'counts'), (4, 'streak'), (5, 'orders')) t(step, name)
    """
)
def join_row_trace(spark, sf_dir):
    # the last table has many rows per key
    orders = join.Dim("orders", table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), {"user_id": "o_custkey"})
    return join.row_trace(user_days(spark, sf_dir), [*panel_dims(spark, sf_dir), orders])


@query(
    """
    WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 9 <> 0 THEN o_custkey END AS k FROM orders),
    c AS (SELECT CASE WHEN c_custkey <> 9 THEN c_custkey END AS k, c_name FROM customer WHERE c_custkey % 9 <> 0 OR c_custkey = 9)
    SELECT o_orderkey, c_name FROM o LEFT JOIN c ON o.k IS NOT DISTINCT FROM c.k
    """
)
def null_safe_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 9 != 0, F.col("o_custkey")).alias("k")
    )
    named = table(spark, sf_dir, "customer").where("c_custkey % 9 <> 0 OR c_custkey = 9")
    named = named.select(F.when(F.col("c_custkey") != 9, F.col("c_custkey")).alias("k"), "c_name")
    return join.wide_join(orders, [join.Dim("customer", named, ["k"], null_safe=True)]).drop("k")


@query(
    """
    WITH e AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 7 WHEN event_id % 11 <> 0 THEN user_id END AS k FROM events)
    SELECT event_id, c_name FROM e LEFT JOIN customer ON k = c_custkey
    """
)
def skewed_dim_join(spark, sf_dir):
    # a third of all rows share one key, and a share has none; a low limit makes them hot
    k = F.when(F.col("event_id") % 3 == 0, 7).when(F.col("event_id") % 11 != 0, F.col("user_id"))
    events = table(spark, sf_dir, "events").select("event_id", k.alias("c_custkey"))
    named = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return skew.skew_join(events, named, ["c_custkey"], min_rows=200).drop("c_custkey")
