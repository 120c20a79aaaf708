"""Assumptions of a month beside the rows they fill."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemart.plans.facts import add_assumption


def test_rows_of_one_country_stay_in_many_tasks(spark):
    assumed = spark.createDataFrame([("DE", dt.date(1996, 1, 1), 0.5), ("DE", dt.date(1999, 7, 1), 0.75), (None, dt.date(1990, 1, 1), 9.0)], "country string, month date, per_unit double")
    at = F.timestamp_add("DAY", F.col("id").cast("int"), F.lit("1995-12-01").cast("timestamp_ntz"))
    rows = spark.range(0, 2_000, 1, 8).select("id", F.lit("DE").alias("country"), at.alias("at"), F.when(F.col("id") % 5 == 0, 3.0).alias("cost"), F.lit(2).alias("units"))
    out = add_assumption(assumed, ["country"], "at", "cost", "units")(rows)
    placed = out.select("cost_or_estimate", F.spark_partition_id().alias("p"))
    assert len(placed.groupBy("p").agg(F.sum("cost_or_estimate")).collect()) == 8
    assert out.columns == [*rows.columns, "cost_or_estimate"]
    for r in out.collect():
        rate = 0.0 if r.at < dt.datetime(1996, 1, 1) else 0.5 if r.at < dt.datetime(1999, 7, 1) else 0.75
        assert r.cost_or_estimate == (3.0 if r.cost else 2 * rate)
