"""Customer features: fan-out fixture, flags and bucket edges (FIXTURES.md)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from featurewright.functions.scalar import BucketRange, bucket
from featurewright.plans.customer import CustomerConfig, customer_features

# The reference configuration's lifetime-value classes.
REFERENCE_BUCKETS = (
    BucketRange(0, 223, 1698),
    BucketRange(1, 1698, 2730),
    BucketRange(2, 2730, 4317),
    BucketRange(3, 4317, 100000),
)


def test_bucket_edges(spark):
    vals = [(222.0,), (223.0,), (1698.0,), (1698.01,), (100000.0,), (100001.0,), (None,)]
    df = spark.createDataFrame(vals, "v double")
    got = [r[0] for r in df.select(bucket(F.coalesce("v", F.lit(0.0)), REFERENCE_BUCKETS)).collect()]
    assert got == [4, 0, 0, 1, 3, 4, 4]


def _fixture(spark):
    d0 = dt.datetime(2020, 1, 1)
    d1 = dt.datetime(2020, 8, 1)
    d2 = dt.datetime(2020, 9, 1)
    d3 = dt.datetime(2020, 10, 1)
    sales = spark.createDataFrame(
        [
            (1, d0, Decimal("5.0000"), 1, 1, None),   # first HI purchase
            (1, d1, Decimal("10.0000"), 1, 1, None),  # HI day 1
            (1, d2, Decimal("20.0000"), 1, 1, None),  # HI day 2
            (1, d3, Decimal("30.0000"), 0, 1, None),  # non-HI value day
            (1, d3, Decimal("99.0000"), 0, 1, "R"),   # returned: ignored
            (2, d0, Decimal("7.0000"), 0, 1, None),   # never HI
        ],
        "ContactCode bigint, InvoiceDate timestamp_ntz, NetAmountExclVAT decimal(18,4), IsHI int, IsSold int, "
        "ReturnReasonCode string",
    )
    appts = spark.createDataFrame(
        [(1, d0, 2.0, True, False), (1, dt.datetime(2020, 7, 1), 3.0, True, False),
         (1, dt.datetime(2020, 7, 2), 5.0, False, True)],
        "ContactCode bigint, Date timestamp_ntz, Duration double, Attended boolean, NoShow boolean",
    )
    contacts = spark.createDataFrame([(1, "DE", "a b"), (2, "DE", "c")],
                                     "ContactCode bigint, CountryCode string, Segment string")
    return sales, appts, contacts


def test_fanout_and_corrected(spark):
    sales, appts, contacts = _fixture(spark)
    cfg = CustomerConfig(as_of="2030-01-01", repurchase_window_years=2, blank_squash_cols=("Segment",),
                         drop_all_null=False)
    fixed = {r["ContactCode"]: r.asDict() for r in customer_features(sales, appts, contacts, cfg).collect()}
    fan = {r["ContactCode"]: r.asDict() for r in
           customer_features(sales, appts, contacts, CustomerConfig(**{**cfg.__dict__, "fanout": True})).collect()}
    assert fixed[1]["lifetime_value"] == 60 and fan[1]["lifetime_value"] == 120
    assert fixed[1]["hi_repurchases"] == 2 and fixed[1]["repurchase_flag"] == 1
    assert fixed[1]["first_purchase_made"] == 1 and fixed[1]["repurchase_window_passed"] == 1
    assert fixed[1]["pre_repurchase_app_duration"] == 5.0  # up to and including 2020-07-01
    assert fixed[1]["Segment"] == "a_b"
    assert fixed[2]["first_purchase_made"] == 0 and fixed[2]["lifetime_value"] is None
    assert fixed[2]["repurchase_flag"] == 0 and fixed[2]["repurchase_window_passed"] == 0
    assert sorted(r["id"] for r in fixed.values()) == [0, 1]


def test_events_between_inclusive_edges(spark):
    from featurewright.operators.joins import events_between, events_until

    lo, hi = dt.datetime(2020, 7, 1), dt.datetime(2021, 1, 1)
    us = dt.timedelta(microseconds=1)
    ev = spark.createDataFrame([(1, lo - us), (1, lo), (1, hi), (1, hi + us), (2, lo)],
                               "ContactCode bigint, t timestamp_ntz")
    ref = spark.createDataFrame([(1, lo, hi)], "ContactCode bigint, lo timestamp_ntz, hi timestamp_ntz")
    got = sorted(r["t"] for r in events_between(ev, ref, ["ContactCode"], "t", "lo", "hi").collect())
    assert got == [lo, hi]
    until = sorted(r["t"] for r in events_until(ev, ref, ["ContactCode"], "t", "lo").collect())
    assert until == [lo - us, lo]
