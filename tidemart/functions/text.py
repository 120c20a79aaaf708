"""The declared function surface: dates, zones, keys, texts, URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.semantics import as_col

# Suffixes of consolidated ids, one per company.
COMPANY_SUFFIXES = ("10", "20", "30", "40")
# Characters a delimited feed may not contain.
FORBIDDEN = r"[?~%/<>&\"”\n\r| ']"


def date_range(df: DataFrame, start: Column | str, end: Column | str, out: str) -> DataFrame:
    """One row per day from start to end, both included; none where the start is after the end."""
    return _series(df, F.to_date(as_col(start)), F.to_date(as_col(end)), F.expr("INTERVAL 1 DAY"), out)


def _series(df: DataFrame, first: Column, last: Column, step: Column, out: str) -> DataFrame:
    days = F.when(first <= last, F.sequence(first, F.greatest(first, last), step))
    return df.select("*", F.explode(days).alias(out))


def date_range_zoned(df: DataFrame, start: Column | str, end: Column | str, zone: str, out: str) -> DataFrame:
    """Days as the UTC moments of their midnight in a zone; days of a clock change stay one row each."""
    days = date_range(df, start, end, "_day")
    return days.withColumn(out, zoned_instant("_day", zone)).drop("_day")


def month_range(df: DataFrame, start: Column | str, end: Column | str, out: str) -> DataFrame:
    first = lambda c: F.to_date(F.date_trunc("month", as_col(c)))
    return _series(df, first(start), first(end), F.expr("INTERVAL 1 MONTH"), out)


def without_company(c: Column | str) -> Column:
    """Id without the company suffix, where it has one."""
    text = as_col(c).cast("string")
    return F.when(
        F.substring(text, -2, 2).isin(*COMPANY_SUFFIXES), F.regexp_replace(text, "..$", "").try_cast("long")
    ).otherwise(as_col(c).cast("long"))


def zoned_instant(local: Column | str, zone: str) -> Column:
    """UTC moment of a wall-clock moment in a zone; both without a zone, so the session zone plays no part."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), as_col(local).cast("timestamp_ntz"))


def local_time(instant: Column | str, zone: str) -> Column:
    """Wall-clock moment in a zone of a UTC moment."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), as_col(instant).cast("timestamp_ntz"))


def clean_field(c: Column | str) -> Column:
    """Trimmed text with characters a delimited feed cannot hold replaced by '_'."""
    return F.regexp_replace(F.trim(as_col(c)), FORBIDDEN, "_")


def without_repeats(c: Column | str, delimiter: str = " | ") -> Column:
    """Distinct parts of a delimited text in order of first appearance."""
    parts = F.transform(F.split(as_col(c), "\\Q" + delimiter.strip() + "\\E"), lambda p: F.trim(p))
    return F.array_join(F.array_distinct(parts), " | ")


def decoded_url(c: Column | str) -> Column:
    """Percent-decoded text; the input itself where its encoding is broken. A plus sign stays a plus sign."""
    plain = F.replace(as_col(c), F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(plain), as_col(c))


def shard_of_file(path: Column | str) -> Column:
    """Folder of the event source a file name starts with."""
    return F.split_part(as_col(path), F.lit("/"), F.lit(2))


def country_of_shard(shard: Column | str, home_brands: tuple[str, ...] = ()) -> Column:
    """Country part of a shard name ``family_brand_country``.

    Brands sold in the home country only count as 'us', so do shards without a country (their third part names the
    environment); app and server shards have no country.
    """
    part = lambda n: F.split_part(as_col(shard), F.lit("_"), F.lit(n))
    return (
        F.when(part(2).isin(*home_brands) if home_brands else F.lit(False), "us")
        .when(part(1).isin("react", "node") | (part(3) == "ecom"), "")
        .when(part(3).isin("production", "prod"), "us")
        .otherwise(part(3))
    )


def corrected_region(df: DataFrame, mapping: DataFrame, state: str, country: str) -> DataFrame:
    """Replace known wrong (state, country) pairs by their correction, and give all others in upper case."""
    key = lambda c: F.upper(F.trim(F.coalesce(F.col(c), F.lit(""))))
    m = mapping.select(
        F.upper("state").alias("_s"), F.upper("country").alias("_c"), "good_state", "good_country"
    )
    joined = df.withColumn("_s", key(state)).withColumn("_c", key(country)).join(m, ["_s", "_c"], "left")
    return joined.select(
        *[c for c in df.columns if c not in (state, country)],
        F.coalesce("good_state", F.upper(F.col(state))).alias(state),
        F.coalesce("good_country", F.upper(F.col(country))).alias(country),
    )


def clean_address(c: Column | str) -> Column:
    """Upper-case address text: punctuation to blanks, blanks squeezed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(as_col(c)), r"[^A-Z0-9 ]", " "), r" +", " "))


def standard_state(c: Column | str) -> Column:
    """Letters of the state in upper case, 'Unknown' when none is left."""
    letters = F.regexp_replace(F.upper(as_col(c)), "[^A-Z]", "")
    return F.when(F.length(letters) > 0, letters).otherwise("Unknown")


def standard_zip(c: Column | str) -> Column:
    """US postal code: five digits, or five and four with a dash; a broken extension is cut, the rest is 'Unknown'."""
    z = F.regexp_replace(F.ltrim(F.upper(as_col(c))), "[^0-9A-Z -]", "")
    return (
        F.when(z.contains("REMOVED"), "Unknown")
        .when(z.rlike(r"^[0-9]{5}(-[0-9]{4})?$"), z)
        .when(z.rlike(r"^[0-9]{9}$"), F.concat(F.left(z, F.lit(5)), F.lit("-"), F.right(z, F.lit(4))))
        .when(z.rlike(r"^[0-9]{5}-"), F.left(z, F.lit(5)))
        .otherwise("Unknown")
    )


def address_mismatch(df: DataFrame, first: Sequence[str], second: Sequence[str], out: str) -> DataFrame:
    """Names of the address parts that differ after cleaning; '' when the addresses agree."""
    parts = [
        F.when(~clean_address(a).eqNullSafe(clean_address(b)), F.lit(a)) for a, b in zip(first, second, strict=True)
    ]
    return df.withColumn(out, F.concat_ws(",", *parts))


def calendar(spark, start: str, days: int) -> DataFrame:
    """Calendar dimension; weeks start on Sunday."""
    day = F.date_add(F.lit(start).cast("date"), F.col("id").cast("int"))
    base = spark.range(days).select(day.alias("full_date"))
    return calendar_columns(base)


def calendar_columns(dates: DataFrame, day: str = "full_date") -> DataFrame:
    d = F.col(day)
    sunday = F.date_sub(d, F.dayofweek(d) - 1)
    return dates.select(
        F.date_format(d, "yyyyMMdd").cast("long").alias("date_key"),
        d.alias("full_date"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEE").alias("day_name"),
        F.date_format(d, "MMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        sunday.alias("week_start"),
        F.to_date(F.date_trunc("month", d)).alias("month_start"),
        F.last_day(d).alias("month_end"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
    )
