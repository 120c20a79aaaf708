"""Currency, assumptions, budgets, KPI bases, restatements, period-to-date."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions.semantics import join_keys, ratio, week_start_sunday
from tidemart.functions.text import date_range
from tidemart.operators.joins import effective_lookup
from tidemart.operators.scan import KeyPlan, Scan, ordered_scan
from tidemart.session import reused


def convert(amounts: DataFrame, rates: DataFrame, currency: str, moment: str, amount: str, out: str) -> DataFrame:
    """Amount at the rate valid at the moment; no rate means no result.

    rates: src_currency, effective_start, effective_end, exchange_rate.
    """
    ranged = rates.withColumnRenamed("src_currency", currency)
    hit = effective_lookup(amounts, ranged, [currency], moment, "effective_start", "effective_end", ["exchange_rate"])
    return hit.withColumn(out, (F.col(amount) * F.col("exchange_rate")).cast("decimal(28,6)")).drop("exchange_rate")


def daily_rates(rates: DataFrame, currency: str, first: Column, last: Column) -> DataFrame:
    """One rate per currency and calendar day from dated rates: the last one known on the day."""
    span = rates.select(currency).distinct().withColumns({"_a": first, "_b": last})
    days = date_range(span, "_a", "_b", "day").select(currency, "day")
    known = rates.select(currency, F.to_date("rate_datetime").alias("day"), "rate_datetime", "exchange_rate")
    known = known.groupBy(currency, "day").agg(F.max_by("exchange_rate", "rate_datetime").alias("_r"))
    grid = days.join(known, [currency, "day"], "full")
    filled = ordered_scan(grid, [currency], ["day"], [Scan("exchange_rate", "fill", "_r")], plan=KeyPlan())
    return filled.filter(F.col("day").between(first, last)).select(currency, "day", "exchange_rate")


def monthly_average(daily: DataFrame, currency: str) -> DataFrame:
    month = F.to_date(F.date_trunc("month", "day"))
    total = F.sum(F.col("exchange_rate").cast("decimal(18,6)"))
    return daily.groupBy(currency, month.alias("month")).agg((total.cast("double") / F.count("exchange_rate")).alias("average_rate"))


def carried_forward(assumptions: DataFrame, unit: Sequence[str], month: str, months: int = 3) -> DataFrame:
    """Assumptions of the last month repeated for the next months."""
    last = assumptions.agg(F.max(month)).scalar()
    newest = assumptions.filter(F.col(month) == last)
    steps = F.explode(F.sequence(F.lit(1), F.lit(months)))
    ahead = newest.withColumn("_k", steps).withColumn(month, F.add_months(F.col(month), F.col("_k"))).drop("_k")
    return assumptions.unionByName(ahead)


def rolling_ratio(monthly: DataFrame, unit: Sequence[str], month: str, amount: str, count: str, out: str, rows: int = 6) -> DataFrame:
    """Amount per count over the ``rows`` rows before the month; the input is one row per unit and month."""
    w = W.partitionBy(*unit).orderBy(month).rowsBetween(-rows, -1)
    return monthly.select("*", ratio(F.sum(amount).over(w), F.sum(count).over(w)).alias(out))


def previous_known(df: DataFrame, unit: Sequence[str], month: str, column: str) -> DataFrame:
    """NULL replaced by the last known value before it, 0 where there is none; one row per unit and month."""
    filled = ordered_scan(df, list(unit), [month], [Scan("_f", "fill", column)], plan=KeyPlan())
    return filled.withColumn(column, F.coalesce("_f", F.lit(0.0))).drop("_f")


def latest_versions(plans: DataFrame, grain: Sequence[str], version: str) -> DataFrame:
    """Rows of the newest version of each grain; ties of the newest version stay together."""
    newest = plans.groupBy(*grain).agg(F.max(version).alias(version))
    return plans.join(newest, [*grain, version], "left_semi")


def budget_forecast_actual(
    budget: DataFrame, forecast: DataFrame, actual: DataFrame, grain: Sequence[str], value: str
) -> DataFrame:
    """The three scenarios side by side with guarded ratios."""
    names = ("budget", "forecast", "actual")
    parts = [
        df.select(*grain, *[(F.col(value) if n == m else F.lit(0)).cast("decimal(28,4)").alias(n) for n in names])
        for m, df in zip(names, (budget, forecast, actual))
    ]
    union = reduce(lambda a, b: a.unionByName(b), parts)
    wide = union.groupBy(*grain).agg(*[F.sum(n).alias(n) for n in names])
    return wide.withColumn("to_budget", ratio("actual", "budget")).withColumn("to_forecast", ratio("actual", "forecast"))


def kpi_base(daily: DataFrame, dims: Sequence[str], day: str, measures: Sequence[str]) -> DataFrame:
    """Date x dimension scaffold with measures (0 where nothing happened) and their running totals within the month."""
    daily = reused(daily)
    span = daily.agg(F.struct(F.min(day).alias("a"), F.max(day).alias("b"))).scalar()
    units = daily.select(*dims).distinct().withColumn("_s", span)
    grid = units.select(*dims, F.explode(F.sequence(F.col("_s.a"), F.col("_s.b"))).alias(day))
    filled = join_keys(grid, daily, [*dims, day], "left").fillna(0, list(measures))
    filled = filled.withColumn("month", F.to_date(F.date_trunc("month", day)))
    return ordered_scan(filled, [*dims, "month"], [day], [Scan(f"{m}_mtd", "sum", m) for m in measures], plan=KeyPlan())


def restated(
    facts: DataFrame, dates: dict[str, str], currencies: dict[str, dict[str, str]], dims: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Every measure by date object (shipped, placed) and currency object (usd, local).

    ``dates``: label to date column; ``currencies``: label to {measure: column}. One pass: each row is exploded into its
    (date object, currency object) cells and summed once.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(d).alias("date_object"),
                F.to_date(c).alias("date"),
                F.lit(cur).alias("currency_object"),
                *[F.col(cols[m]).alias(m) for m in measures],
            )
            for d, c in dates.items()
            for cur, cols in currencies.items()
        ]
    )
    rows = facts.select(*dims, F.explode(cells).alias("x")).select(*dims, "x.*").filter(F.col("date").isNotNull())
    return rows.groupBy("date", "date_object", "currency_object", *dims).agg(*[F.sum(m).alias(m) for m in measures])


# Labels of the periods.
PERIODS = ("Weekly", "Monthly", "Quarterly", "Yearly")


def period_rows(day: Column, as_of: Column) -> Column:
    """The week, month, quarter and year a day lies in, ends capped at the day before ``as_of``."""
    last = F.date_sub(as_of, 1)
    months = {"Monthly": ("month", 1), "Quarterly": ("quarter", 3), "Yearly": ("year", 12)}
    rows = [(F.lit("Weekly"), week_start_sunday(day), F.date_add(week_start_sunday(day), 6))]
    for label, (unit, n) in months.items():
        start = F.to_date(F.date_trunc(unit, day))
        rows.append((F.lit(label), start, F.date_sub(F.add_months(start, n), 1)))
    return F.array(
        *[F.struct(p.alias("period"), a.alias("start_day"), F.least(b, last).alias("end_day")) for p, a, b in rows]
    )


def period_totals(daily: DataFrame, day: str, dims: Sequence[str], measures: Sequence[str], as_of: Column) -> DataFrame:
    """Period-to-date totals of all four period kinds in one pass over daily rows."""
    rows = daily.filter(F.col(day) < as_of).select(*dims, *measures, F.explode(period_rows(F.col(day), as_of)).alias("_p"))
    return rows.groupBy("_p.period", "_p.start_day", "_p.end_day", *dims).agg(*[F.sum(m).alias(m) for m in measures])


def open_hours(stores: DataFrame, store: str, weekdays: Sequence[str]) -> DataFrame:
    """Weekday columns such as '09:00-17:30' as rows: weekday, opening and closing hour; closed days give none."""
    rows = stores.unpivot([store], list(weekdays), "weekday", "hours").filter(
        F.col("hours").isNotNull() & (F.col("hours") != "closed")
    )
    minutes = lambda c: F.split_part(c, F.lit(":"), F.lit(1)).cast("int") * 60 + F.split_part(c, F.lit(":"), F.lit(2)).cast("int")
    part = lambda i: F.split_part("hours", F.lit("-"), F.lit(i))
    return rows.select(store, "weekday", minutes(part(1)).alias("opens"), minutes(part(2)).alias("closes"))


def traffic_in_hours(visits: DataFrame, hours: DataFrame, store: str, moment: str) -> DataFrame:
    """Visits per store and day within and outside the opening hours of the weekday."""
    placed = visits.withColumns(
        {
            "weekday": F.lower(F.date_format(moment, "EEE")),
            "_minute": F.hour(moment) * 60 + F.minute(moment),
            "day": F.to_date(moment),
        }
    )
    joined = placed.join(hours, [store, "weekday"], "left")
    inside = F.coalesce((F.col("_minute") >= F.col("opens")) & (F.col("_minute") < F.col("closes")), F.lit(False))
    return joined.groupBy(store, "day").agg(F.count_if(inside).alias("in_hours"), F.count_if(~inside).alias("out_of_hours"))


def forecast_by_horizon(stored: DataFrame, unit: Sequence[str], at: str, made_at: str, value: str) -> DataFrame:
    """Stored forecasts at their start hour beside the later forecasts made at that hour, and the actual of the hour.

    Rows with ``at = made_at`` are starts; the actual of an hour is stored with the start one hour later.
    """
    starts = stored.filter(F.col(at) == F.col(made_at)).select(*unit, F.col(at).alias("hour"), F.col(value).alias("forecast"), "actual_last_hour")
    later = stored.filter(F.col(at) != F.col(made_at)).select(*unit, F.col(made_at).alias("hour"), F.col(at).alias("target_hour"), F.col(value).alias("later_forecast"))
    actual = starts.select(*unit, (F.col("hour") - F.expr("INTERVAL 1 HOUR")).alias("hour"), F.col("actual_last_hour").alias("actual"))
    return (
        starts.drop("actual_last_hour")
        .join(later.distinct(), [*unit, "hour"], "left")
        .join(actual.distinct(), [*unit, "hour"], "left")
    )
