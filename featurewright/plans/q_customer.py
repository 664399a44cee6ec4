"""Registered queries: the customer lifetime-value feature table and its parts."""

from __future__ import annotations

from dataclasses import replace

from featurewright.plans.customer import (
    CustomerConfig,
    appointment_totals,
    customer_features,
    daily_value,
    first_purchase,
    in_window_sales,
    repurchase_dates,
    repurchase_days,
    sales_by_instant,
    sales_summary,
)
from featurewright.plans.registry import query, r_sql, rounded
from featurewright.sources.standins import (
    AS_OF,
    HOT_CUSTOMER,
    REPURCHASE_WINDOW_YEARS,
    SALES_SINCE,
    appointments,
    contacts,
    sales,
)
from featurewright.sources.tables import scan

CFG = CustomerConfig(
    as_of=AS_OF,
    since=SALES_SINCE,
    repurchase_window_years=REPURCHASE_WINDOW_YEARS,
    blank_squash_cols=("Segment",),
)
#: For readers of a few columns: no surrogate id, no scan for empty columns, and so no checkpoint for either.
PLAIN = replace(CFG, id_col=None, drop_all_null=False)

def oracle_ctes(customer: str = "o_custkey") -> str:
    """Oracle side of C1: sold lines marked with their buyer's window, then one row per buyer.

    The first priority purchase is a window minimum over the buyer's lines, so every
    figure of the window is a filtered aggregate of one grouping.  The multiplied
    lifetime value has a closed form: each value counts once per repurchase day.
    """
    return f"""
WITH line AS (
  SELECT {customer} AS who, o_orderdate AS bought,
         CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS amount,
         o_orderpriority = '1-URGENT' AS priority,
         o_orderstatus <> 'P' AND l_returnflag <> 'R' AND l_extendedprice * (1 - l_discount) > 0 AS valid,
         min(bought) FILTER (WHERE priority) OVER (PARTITION BY who) AS first_priority
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  WHERE o_orderdate >= TIMESTAMP '{SALES_SINCE}'
), marked AS (
  SELECT *, first_priority + INTERVAL 6 MONTH AS opens,
         first_priority + INTERVAL {12 * REPURCHASE_WINDOW_YEARS} MONTH AS closes,
         coalesce(valid AND bought BETWEEN opens AND closes, false) AS counts
  FROM line
), buyer AS (
  SELECT who, any_value(first_priority) AS first_priority, any_value(opens) AS opens, any_value(closes) AS closes,
         sum(amount) FILTER (WHERE counts) AS worth,
         count(DISTINCT CAST(bought AS DATE)) FILTER (WHERE counts AND priority) AS priority_days
  FROM marked WHERE first_priority IS NOT NULL GROUP BY who
), visit AS (
  SELECT buyer.who, sum(l_quantity) AS minutes, count(*) FILTER (WHERE l_linestatus = 'F') AS kept,
         count(*) FILTER (WHERE l_linestatus = 'O') AS missed
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN buyer ON buyer.who = {customer}
  WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '{SALES_SINCE}' AND buyer.opens
  GROUP BY buyer.who
)
"""


ORACLE_CTES = oracle_ctes()


def worth_sql(fanout: bool) -> str:
    return "worth * greatest(priority_days, 1)" if fanout else "worth"


def features_sql(fanout: bool = False, customer: str = "o_custkey") -> str:
    """The whole customer feature table for the oracle."""
    return oracle_ctes(customer) + f"""
SELECT c_custkey AS ContactCode, c_nationkey AS CountryCode, {r_sql('c_acctbal')} AS AccountBalance,
       replace(c_mktsegment, ' ', '_') AS Segment, CAST(c_nationkey AS VARCHAR) AS TerritoryCode,
       first_priority AS first_hi_purchase_date, opens AS repurchase_start_date, closes AS repurchase_end_date,
       {r_sql('minutes')} AS pre_repurchase_app_duration, kept AS pre_repurchase_app_attended,
       missed AS pre_repurchase_app_noshow,
       CASE WHEN worth IS NOT NULL THEN priority_days END AS hi_repurchases,
       CAST(trunc({worth_sql(fanout)}) AS BIGINT) AS lifetime_value,
       CAST(coalesce(closes < TIMESTAMP '{AS_OF}', false) AS INTEGER) AS repurchase_window_passed,
       CAST(coalesce(priority_days > 0, false) AS INTEGER) AS repurchase_flag,
       CAST(first_priority IS NOT NULL AS INTEGER) AS first_purchase_made,
       row_number() OVER (ORDER BY c_custkey) - 1 AS id
FROM customer LEFT JOIN buyer ON buyer.who = c_custkey LEFT JOIN visit ON visit.who = c_custkey
"""


def _sources(spark, sf_dir):
    return sales(spark, sf_dir), appointments(spark, sf_dir), contacts(spark, sf_dir)


def _pre_and_dates(spark, sf_dir):
    s = scan(sales(spark, sf_dir), ts_col="InvoiceDate", since=CFG.since)
    pre = sales_by_instant(s)
    return pre, repurchase_dates(first_purchase(pre), CFG)


@query("C1_customer_features", features_sql())
def c1_customer_features(spark, sf_dir):
    """Whole customer feature table, lifetime value as the plain sum (default)."""
    return rounded(customer_features(*_sources(spark, sf_dir), CFG))


@query("C1_customer_features_fanout", features_sql(fanout=True))
def c1_customer_features_fanout(spark, sf_dir):
    """C1 with the reference's fan-out lifetime value (Q1 parity mode)."""
    from dataclasses import replace

    return rounded(customer_features(*_sources(spark, sf_dir), replace(CFG, fanout=True)))


@query("A3_first_purchase", ORACLE_CTES + """SELECT who AS ContactCode, first_priority AS first_hi_purchase_date,
          opens AS repurchase_start_date, closes AS repurchase_end_date FROM buyer""")
def a3_first_purchase(spark, sf_dir):
    """A3 + F6: first HI purchase and the repurchase window per customer."""
    return _pre_and_dates(spark, sf_dir)[1]


@query(
    "A4_J1_appointment_totals",
    ORACLE_CTES + f"""SELECT who AS ContactCode, {r_sql('minutes')} AS pre_repurchase_app_duration,
                             kept AS pre_repurchase_app_attended, missed AS pre_repurchase_app_noshow FROM visit""",
)
def a4_appointments(spark, sf_dir):
    """J1 + A4: appointment sums up to the repurchase start (equi-join + residual <=)."""
    _, rd = _pre_and_dates(spark, sf_dir)
    a = scan(appointments(spark, sf_dir), ts_col="Date", since=CFG.since)
    return rounded(appointment_totals(a, rd))


@query("A5_J2_repurchase_days", ORACLE_CTES + """SELECT DISTINCT who AS ContactCode, CAST(bought AS DATE) AS invoice_date
                     FROM marked WHERE counts AND priority""")
def a5_repurchase_days(spark, sf_dir):
    """J2 + A5: distinct (customer, day) with a valid HI sale inside the window."""
    pre, rd = _pre_and_dates(spark, sf_dir)
    return repurchase_days(in_window_sales(pre, rd))


@query(
    "A6_daily_value",
    ORACLE_CTES + f"""SELECT who AS ContactCode, CAST(bought AS DATE) AS invoice_date, {r_sql('sum(amount)')} AS value
                      FROM marked WHERE counts GROUP BY ALL""",
)
def a6_daily_value(spark, sf_dir):
    """J2 + A6: per customer and day, valid sale value inside the window."""
    pre, rd = _pre_and_dates(spark, sf_dir)
    return rounded(daily_value(in_window_sales(pre, rd)))


@query(
    "A7_J3_sales_summary_fanout",
    ORACLE_CTES + f"""SELECT who AS ContactCode, priority_days AS hi_repurchases, {r_sql(worth_sql(True))} AS lifetime_value
                      FROM buyer WHERE worth IS NOT NULL""",
)
def a7_sales_summary_fanout(spark, sf_dir):
    """A7 + J3: COUNT(DISTINCT day) and SUM in one aggregate, reference fan-out."""
    pre, rd = _pre_and_dates(spark, sf_dir)
    return rounded(sales_summary(in_window_sales(pre, rd), fanout=True))


@query(
    "A7_J3_sales_summary",
    ORACLE_CTES + f"""SELECT who AS ContactCode, priority_days AS hi_repurchases, {r_sql(worth_sql(False))} AS lifetime_value
                      FROM buyer WHERE worth IS NOT NULL""",
)
def a7_sales_summary(spark, sf_dir):
    """A7 + J3: repurchase days and lifetime value, corrected (no fan-out)."""
    pre, rd = _pre_and_dates(spark, sf_dir)
    return rounded(sales_summary(in_window_sales(pre, rd)))


_HOT_SQL = f"CASE WHEN o_orderstatus = 'F' THEN {HOT_CUSTOMER} ELSE o_custkey END"


@query("C1_customer_features_hot_customer", features_sql(customer=_HOT_SQL))
def c1_customer_features_hot(spark, sf_dir):
    """C1 under skew: one customer holds every finished order (about a third of all rows).

    Sales collapse to (customer, instant) on the map side before any shuffle,
    so the hot customer reaches the joins as its distinct order dates only.
    """
    return rounded(customer_features(
        sales(spark, sf_dir, hot=True), appointments(spark, sf_dir, hot=True), contacts(spark, sf_dir), CFG
    ))
