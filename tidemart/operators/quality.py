"""Validation, exception tables, reconciliation and contact-data protection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.semantics import as_col
from tidemart.session import reused


def flag_duplicates(stage: DataFrame, keys: Sequence[str], event: str | None = None) -> DataFrame:
    """Mark every copy of a repeated business key (with the event moment, where versions are expected) as error.

    The repeated keys come from a pre-aggregated count, joined back, so a key with very many copies is no hot group.
    """
    by = [*keys, event] if event else list(keys)
    repeated = stage.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    repeated = repeated.select(*[F.col(c).alias(f"r_{c}") for c in by], F.lit(True).alias("_dup"))
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"r_{c}"))
    marked = stage.join(repeated, on, "left")
    return marked.select(
        *stage.columns,
        F.when(F.col("_dup"), F.lit("error")).alias("meta_data_quality"),
        F.when(F.col("_dup"), F.lit("Duplicate business keys")).alias("excp_message"),
    )


def flag_nulls(stage: DataFrame, required: Sequence[str]) -> DataFrame:
    """Warn about NULL in required columns; such rows are still loaded. An error mark is kept."""
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    bad = missing != ""
    have = {"meta_data_quality", "excp_message"} <= set(stage.columns)
    quality = F.col("meta_data_quality") if have else F.lit(None).cast("string")
    message = F.col("excp_message") if have else F.lit(None).cast("string")
    names = [c for c in stage.columns if c not in ("meta_data_quality", "excp_message")]
    return stage.select(
        *names,
        F.when(quality == "error", quality).when(bad, F.lit("warning")).otherwise(quality).alias("meta_data_quality"),
        F.when(quality == "error", message)
        .when(bad, F.concat(F.lit("NULL in "), missing))
        .otherwise(message)
        .alias("excp_message"),
    )


def loadable(stage: DataFrame) -> DataFrame:
    """Rows that may be loaded: everything but errors."""
    return stage.filter(~F.col("meta_data_quality").eqNullSafe(F.lit("error")))


def update_exceptions(exceptions: DataFrame | None, stage: DataFrame) -> DataFrame:
    """Exception table after a run: earlier rows are no longer current, the new ones are appended."""
    fresh = stage.filter(F.col("meta_data_quality").isNotNull()).withColumn("meta_is_current_excp", F.lit(True))
    if exceptions is None:
        return fresh
    return exceptions.withColumn("meta_is_current_excp", F.lit(False)).unionByName(fresh, allowMissingColumns=True)


def set_difference(a: DataFrame, b: DataFrame, a_name: str, b_name: str) -> DataFrame:
    """Distinct rows found in one frame only, labelled by the frame that has them."""
    return (
        a.subtract(b)
        .withColumn("only_in", F.lit(a_name))
        .unionByName(b.subtract(a).withColumn("only_in", F.lit(b_name)))
    )


def long_metrics(df: DataFrame, grain: Sequence[str], metrics: Sequence[str], value: str) -> DataFrame:
    """Metric columns as rows, NULL values left out."""
    wide = df.select(*grain, *[F.col(m).cast("double") for m in metrics])
    return wide.unpivot(list(grain), list(metrics), "metric", value).filter(F.col(value).isNotNull())


def reconcile(
    a: DataFrame, b: DataFrame, grain: Sequence[str], metrics: Sequence[str], tolerance: float = 0.0
) -> DataFrame:
    """Metrics of two sources side by side where they differ by more than the tolerance (share of the second)."""
    left = long_metrics(a, grain, metrics, "a_value")
    right = long_metrics(b, grain, metrics, "b_value")
    both = left.join(right, [*grain, "metric"], "full")
    gap = F.coalesce("a_value", F.lit(0.0)) - F.coalesce("b_value", F.lit(0.0))
    return both.withColumn("difference", gap).withColumn(
        "variance", F.abs(F.col("difference")) / F.nullif(F.abs(F.coalesce("b_value", F.lit(0.0))), F.lit(0.0))
    ).filter((F.abs(F.col("difference")) > 0) & F.coalesce(F.col("variance") > tolerance, F.lit(True)))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose reference does not exist."""
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def over_threshold(df: DataFrame, limit: int, name: str) -> DataFrame:
    """One row with the count when it exceeds the limit, otherwise none."""
    return df.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select(F.lit(name).alias("check_name"), "n")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count per mandatory column; no row at all when every count is 0."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])
    return counted.filter(reduce(lambda x, y: x | y, [F.col(f"null_{c}") > 0 for c in columns]))


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def stale(tables: dict[str, tuple[DataFrame, str]], as_of: Column, max_age_days: int = 0) -> DataFrame:
    """Tables whose newest date lies before ``as_of`` less the allowed age."""
    newest = [
        df.agg(F.to_date(F.max(c)).alias("newest")).select(F.lit(name).alias("table_name"), "newest")
        for name, (df, c) in tables.items()
    ]
    union = reduce(lambda a, b: a.unionByName(b), newest)
    return union.filter(F.col("newest").isNull() | (F.col("newest") < F.date_sub(F.to_date(as_of), max_age_days)))


class CheckFailed(RuntimeError):
    """A check returned rows."""


def alert(rows: DataFrame, name: str, on_rows: str = "fail") -> bool:
    """True when the check is clean. Rows raise (``fail``), stop the branch (``skip``) or are let pass (``continue``)."""
    clean = rows.isEmpty()
    if not clean and on_rows == "fail":
        raise CheckFailed(f"{name} returned rows")
    return clean or on_rows == "continue"


def share_drift(rows: DataFrame, day: str, group: str, flag: Column, as_of: Column) -> DataFrame:
    """Percent of flagged rows per group: yesterday, on the same day last month, and the mean of the days between.

    The days compared are the last and the first day found in that span; both are left out of the mean.
    """
    yesterday = F.date_sub(F.to_date(as_of), 1)
    span = F.to_date(day).between(F.add_months(yesterday, -1), yesterday)
    daily = reused(
        rows.filter(span)
        .groupBy(F.to_date(day).alias("day"), group)
        .agg((F.count_if(flag) * 100 / F.count(F.lit(1))).alias("percent"))
    )
    ends = daily.agg(F.struct(F.min("day").alias("first"), F.max("day").alias("last"))).scalar()
    marked = daily.withColumn("_e", ends)
    at = lambda c: F.max(F.when(F.col("day") == F.col(c), F.col("percent")))
    between = (F.col("day") > F.col("_e.first")) & (F.col("day") < F.col("_e.last"))
    return marked.groupBy(group).agg(
        at("_e.last").alias("previous_date"),
        at("_e.first").alias("last_month_same_date"),
        F.avg(F.when(between, F.col("percent"))).alias("mean_percent"),
    )


def hourly_counts(sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row counts per hour, one column per source, hours missing in a source as 0."""
    parts = [
        df.groupBy(F.date_trunc("hour", F.col(c)).alias("hour")).agg(F.count(F.lit(1)).alias("n")).withColumn(
            "source", F.lit(name)
        )
        for name, (df, c) in sources.items()
    ]
    union = reduce(lambda a, b: a.unionByName(b), parts)
    return union.groupBy("hour").agg(
        *[F.coalesce(F.sum(F.when(F.col("source") == name, F.col("n"))), F.lit(0)).alias(name) for name in sources]
    )


def column_drift(a: DataFrame, b: DataFrame, ignore: Sequence[str] = ()) -> list[tuple[str, str]]:
    """Columns one layer has and the other lacks, compared without case: (column, 'missing in first|second')."""
    first = {c.lower() for c in a.columns} - {c.lower() for c in ignore}
    second = {c.lower() for c in b.columns} - {c.lower() for c in ignore}
    return [(c, "missing in second") for c in sorted(first - second)] + [
        (c, "missing in first") for c in sorted(second - first)
    ]


def drift_report(a: DataFrame, b: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Drifting columns with the number of values the other layer does not see."""
    parts = []
    for side, df in (("missing in second", a), ("missing in first", b)):
        names = [c for c, where in column_drift(a, b, ignore) if where == side]
        if names:
            counts = df.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "column_name", "values_hidden")
            parts.append(counts.withColumn("drift", F.lit(side)))
    if not parts:
        return a.sparkSession.createDataFrame([], "column_name string, values_hidden long, drift string")
    return reduce(lambda x, y: x.unionByName(y), parts)


def pattern_tags(df: DataFrame, column: str, patterns: dict[str, Sequence[str]], out: str = "tag") -> DataFrame:
    """Tag of the first pattern list (case-insensitive LIKE) a text matches."""
    text = F.col(column)
    chain = F.lit(None).cast("string")
    for tag, likes in reversed(list(patterns.items())):
        hit = reduce(lambda x, y: x | y, [text.ilike(p) for p in likes])
        chain = F.when(hit, F.lit(tag)).otherwise(chain)
    return df.withColumn(out, chain)


def mask(c: Column | str) -> Column:
    """Hex digest cut to the length of the text, so masked values keep their width."""
    c = as_col(c).cast("string")
    return F.substring(F.md5(c), F.lit(1), F.length(c))


def masked_view(df: DataFrame, private: Sequence[str]) -> DataFrame:
    """What restricted readers see."""
    return df.select(*[mask(c).alias(c) if c in private else F.col(c) for c in df.columns])


# Fixed patterns of contact data.
CONTACT_PATTERNS = {
    "email": r"[\w.+-]+@[\w-]+\.[\w.]+",
    "phone": r"\+?[0-9][0-9 ().-]{7,}[0-9]",
    "ip": r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}",
}


def contact_columns(df: DataFrame, table: str, min_share: float) -> DataFrame:
    """(table, column, kind) where at least ``min_share`` of the non-NULL texts contain the pattern."""
    texts = [c for c, t in df.dtypes if t == "string"]
    counts = df.agg(
        *[
            F.struct(
                F.count(F.col(c)).alias("rows"),
                *[F.count_if(F.col(c).rlike(p)).alias(kind) for kind, p in CONTACT_PATTERNS.items()],
            ).alias(c)
            for c in texts
        ]
    )
    cells = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit(kind).alias("kind"),
            F.col(f"{c}.{kind}").alias("hits"),
            F.col(f"{c}.rows").alias("rows"),
        )
        for c in texts
        for kind in CONTACT_PATTERNS
    ]
    return (
        counts.select(F.explode(F.array(*cells)).alias("x"))
        .select("x.*")
        .filter((F.col("hits") > 0) & (F.col("hits") >= F.col("rows") * F.lit(min_share)))
    )


def catalogue_merge(catalogue: DataFrame, candidates: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Insert-only merge of new candidates that are not excluded."""
    key = ["table_name", "column_name"]
    fresh = candidates.join(exclusions, key, "left_anti").join(catalogue, [*key, "kind"], "left_anti")
    return catalogue.unionByName(fresh.select(*catalogue.columns))


def normal_email(c: Column | str) -> Column:
    return F.lower(F.trim(as_col(c)))


def normal_phone(c: Column | str) -> Column:
    return F.regexp_replace(as_col(c).cast("string"), "[^0-9]", "")


def contact_hash(normal: Column) -> Column:
    """SHA-256 of a normalised contact value; empty values have no hash."""
    return F.when(F.length(normal) > 0, F.sha2(normal, 256))


def unsent(feed: DataFrame, sent: DataFrame, key: str, ts: str, low: Column, batch_rows: int) -> DataFrame:
    """New rows since the watermark that were not sent yet, in batches of at most ``batch_rows``."""
    from tidemart.operators.scan import Scan, ordered_scan

    new = feed.filter(F.col(ts) > low).join(sent.select(key), key, "left_anti")
    numbered = ordered_scan(new, [], [ts, key], [Scan("_rn", "number")])
    return numbered.select(*feed.columns, (F.floor((F.col("_rn") - 1) / batch_rows) + 1).alias("batch_no"))


def privacy_requests(requests: DataFrame, contacts: DataFrame, key: str) -> DataFrame:
    """Distinct requests with contact data; a second e-mail only when it really differs from the first."""
    joined = requests.distinct().join(contacts, key, "left")
    return joined.withColumn(
        "second_email", F.when(~F.col("second_email").eqNullSafe(F.col("email")), F.col("second_email"))
    ).distinct()
