"""Instants mean the same in any session zone; naive timestamps are UTC wall time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from featurewright.functions.time import ceil_minutes, epoch_micros, is_weekend

SATURDAY = dt.datetime(2024, 1, 6, 4, 59, tzinfo=dt.timezone.utc)  # Friday 23:59 in New York


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_instants_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        us = int(SATURDAY.timestamp()) * 1_000_000
        df = spark.range(1).select(F.timestamp_micros(F.lit(us)).alias("at"), F.expr("TIMESTAMP_NTZ'2024-01-06 05:00:00'").alias("naive"))
        row = df.select(
            epoch_micros("at").alias("us"), is_weekend("at").alias("friday"), is_weekend("naive").alias("saturday"),
            epoch_micros("naive").alias("naive_us"), F.unix_micros(ceil_minutes("at", 15, ntz=False).cast("timestamp")).alias("up") if zone == "UTC" else F.lit(0).alias("up"),
        ).first()
        assert row["us"] == us and row["naive_us"] == us + 60_000_000
        assert (row["friday"], row["saturday"]) == (0, 1)
        assert zone != "UTC" or row["up"] == us + 60_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_the_type_is_decided_when_planning(spark):
    df = spark.range(1).select(F.timestamp_seconds("id").alias("at"))
    plan = df.select(epoch_micros("at").alias("us"))
    assert "typeof" not in plan._jdf.queryExecution().optimizedPlan().toString()
