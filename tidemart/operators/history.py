"""Change history from change feeds: incremental, full rebuild, brand split, archive repair."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.semantics import earliest_by, join_keys, latest_by, millis_before, ntz, OPEN_END, row_hash
from tidemart.operators.merge import apply_merge
from tidemart.operators.scan import Scan, key_plan, ordered_scan
from tidemart.session import reused


def delete_rows(log: DataFrame, keys: Sequence[str], ts: str, kind: str, like: DataFrame) -> DataFrame:
    """Delete-log rows in the shape of the archive; columns the log lacks are NULL.

    kind ``action``: rows with ``repl_action = 'D'`` are deletes, others plain versions; ``deleted``: every row is a
    delete at ``datetime_deleted``; ``added``: every row is a delete at ``datetime_added``.
    """
    moment = {"action": ts, "deleted": "datetime_deleted", "added": "datetime_added"}[kind]
    flag = (F.col("repl_action") == "D") if kind == "action" else F.lit(True)
    have = set(log.columns)
    cols = [
        F.col(moment).alias(c) if c == ts else F.col(c) if c in have else F.lit(None).cast(t).alias(c)
        for c, t in like.dtypes
    ]
    return log.select(*cols, flag.alias("meta_row_is_deleted"), F.lit(f"delete_log_{kind}").alias("meta_row_source"))


def change_history(
    history: DataFrame | None,
    archive: DataFrame,
    deletes: DataFrame | None,
    keys: Sequence[str],
    ts: str,
    first_ts: str | None,
    run_ts: Column,
    logged: Sequence[str] = (),
) -> DataFrame:
    """Incremental change history of an archive and a delete log (shaped by ``delete_rows``).

    One row per (key, moment), a delete wins over an update. Only rows whose content differs from the version before
    are kept, then each ends 1 ms before the next kept one. Delete rows take the columns their log lacks (all but
    ``logged``) from the last kept version before them in the batch, or from the current version.
    """
    keys = list(keys)
    cols = archive.columns
    rows = archive.select(
        *cols, F.lit(False).alias("meta_row_is_deleted"), F.lit("archive").alias("meta_row_source")
    )
    if deletes is not None:
        rows = rows.unionByName(deletes)
    content = [c for c in cols if c not in (*keys, ts)]
    filler = [c for c in content if c not in logged]
    filled = F.struct(*[F.col(c) for c in filler])
    stage = latest_by(rows, [*keys, ts], ["meta_row_is_deleted", *content]).withColumn(
        "meta_row_hash", row_hash(*content, "meta_row_is_deleted")
    )
    if history is None:
        joined = stage.select(
            "*", F.lit(None).cast("long").alias("t_hash"), F.when(F.lit(False), filled).alias("t_row")
        )
    else:
        current = history.filter("is_current").alias("t")
        on = F.lit(True)
        for k in keys:
            on = on & F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}"))
        joined = (
            stage.alias("s")
            .join(current, on, "left")
            .filter(F.col(f"t.{ts}").isNull() | (F.col(f"s.{ts}") >= F.col(f"t.{ts}")))
            .select(
                "s.*",
                F.col("t.meta_row_hash").alias("t_hash"),
                F.when(F.col("t.is_current"), F.struct(*[F.col(f"t.{c}").alias(c) for c in filler])).alias("t_row"),
            )
        )
    plan = key_plan(stage, keys)
    lagged = ordered_scan(
        joined, keys, [ts], [Scan("lag_hash", "lag", "meta_row_hash"), Scan("_n", "number")], plan=plan
    )
    previous = F.when(F.col("_n") == 1, F.col("t_hash")).otherwise(F.col("lag_hash"))
    changed = lagged.withColumn("previous_hash", previous).filter(
        ~F.col("meta_row_hash").eqNullSafe(F.col("previous_hash"))
    )
    donor = F.when(~F.col("meta_row_is_deleted"), filled)
    chained = ordered_scan(
        changed.drop("_n").withColumn("_donor", donor),
        keys,
        [ts],
        [Scan("next_ts", "lead", ts), Scan("rno", "number"), Scan("_fill", "fill", "_donor")],
        plan=plan,
    )
    chained = chained.withColumn("_fill", F.coalesce("_fill", "t_row"))
    start = F.col(ts)
    if first_ts:
        start = F.when(
            F.col("previous_hash").isNull() & (F.col("rno") == 1) & (F.col(first_ts) != F.col(ts)), F.col(first_ts)
        ).otherwise(F.col(ts))
    inserted = chained.select(
        *[
            F.when(F.col("meta_row_is_deleted") & F.col("_fill").isNotNull(), F.col(f"_fill.{c}"))
            .otherwise(F.col(c))
            .alias(c)
            if c in filler
            else F.col(c)
            for c in cols
        ],
        start.alias("effective_start_datetime"),
        F.coalesce(millis_before(F.col("next_ts")), ntz(OPEN_END)).alias("effective_end_datetime"),
        F.col("next_ts").isNull().alias("is_current"),
        "meta_row_is_deleted",
        "meta_row_source",
        "meta_row_hash",
        run_ts.alias("meta_create_datetime"),
        run_ts.alias("meta_update_datetime"),
        "rno",
    )
    if history is None:
        return inserted.drop("rno")
    inserted = reused(inserted)
    closing = inserted.filter("rno = 1").select(*keys, "effective_start_datetime")
    closed = apply_merge(
        history,
        closing,
        keys,
        unique_source=True,
        matched=lambda t, s: {
            "effective_end_datetime": millis_before(s("effective_start_datetime")),
            "is_current": F.lit(False),
            "meta_update_datetime": run_ts,
        },
        update_when=lambda t, s: t("is_current"),
        insert=False,
    )
    return closed.unionByName(inserted.drop("rno").select(*history.columns))


def rebuild_history(versions: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Full rebuild: contiguous ranges, each ending exactly where the next one starts."""
    scanned = ordered_scan(versions, keys, [ts], [Scan("_next", "lead", ts)])
    return scanned.select(
        *versions.columns,
        F.col(ts).alias("effective_start_datetime"),
        F.coalesce(F.col("_next"), ntz(OPEN_END)).alias("effective_end_datetime"),
        F.col("_next").isNull().alias("is_current"),
    )


def brand_split(
    target: DataFrame, history: DataFrame, owners: DataFrame, owner_key: str, keys: Sequence[str], company: int
) -> DataFrame:
    """Versions of one company's rows, added where (key, start) is not there yet."""
    mine = history.join(owners.filter(F.col("company_id") == company).select(owner_key), owner_key, "left_semi")
    key = [*keys, "effective_start_datetime"]
    absent = join_keys(mine, target.select(*key), key, "left_anti")
    return target.unionByName(absent.select(*target.columns))


def tagged_key(key: str, company: Column) -> Column:
    """Key made unique across sources by appending the company id; NULL and 0 have no identity."""
    return F.when(
        F.coalesce(F.col(key).cast("string"), F.lit("0")) != "0",
        F.concat(F.col(key).cast("string"), company.cast("string")).cast("long"),
    )


# Table kind to (has a data source id, has a company id). Without a company, ids stay as they are.
TABLE_KINDS = {
    "nsync": (False, False),
    "has_value_column": (False, True),
    "has_name_value_column": (True, True),
    "has_object_column": (False, False),
    "has_object_column_with_null": (True, False),
    "has_object_column_with_null_and_name_value_column": (True, False),
    "regular": (True, True),
    "regular_multiple_company_ids": (True, True),
}


def consolidate_delta(
    source: DataFrame,
    source_id: int,
    companies: Sequence[int],
    key: str,
    id_cols: Sequence[str],
    changed: str,
    low: Column,
    company_of: DataFrame | None = None,
    company_on: str | None = None,
    default_company: int = 40,
    look_back: str = "INTERVAL 5 MINUTES",
    kind: str = "regular",
) -> DataFrame:
    """Recent rows of one source in the consolidated shape: latest per key, company added, ids rewritten.

    A source without a company lookup (or a row the lookup misses) belongs to the default company. Rows of companies
    the source does not own are left out. The kind of table decides which id columns exist.
    """
    has_source, has_company = TABLE_KINDS[kind]
    source_col = [F.lit(source_id).alias("data_source_id")] if has_source else []
    recent = latest_by(source.filter(F.col(changed) >= low - F.expr(look_back)), [key], [changed])
    if not has_company:
        return recent.select(*source_col, *source.columns)
    if company_of is not None:
        recent = recent.join(company_of.select(company_on, F.col("company_id").alias("_company")), company_on, "left")
        company = F.coalesce(F.col("_company"), F.lit(default_company))
    else:
        company = F.lit(default_company)
    ids = [key, *[c for c in id_cols if c != key]]
    plain = [c for c in source.columns if c not in ids]
    return (
        recent.withColumn("company_id", company.cast("int"))
        .filter(F.col("company_id").isin(list(companies)))
        .select(
            *source_col,
            "company_id",
            *[tagged_key(c, F.col("company_id")).alias(c) for c in ids],
            *[F.col(c).alias(f"meta_original_{c}") for c in ids],
            *plain,
        )
    )


def consolidated_keys(columns: Sequence[str], keys: Sequence[str], by_company: bool = False) -> list[str]:
    """What tells rows of a consolidated table apart: the source, the company where one table holds several, and the original keys."""
    own = [f"meta_original_{k}" if f"meta_original_{k}" in columns else k for k in keys]
    return [*(["data_source_id"] if "data_source_id" in columns else []), *(["company_id"] if by_company else []), *own]


def consolidate(
    target: DataFrame | None, deltas: Sequence[DataFrame], keys: Sequence[str], changed: str, by_company: bool = False
) -> DataFrame:
    """Merge the deltas of all sources; a match by source and original keys is replaced only by a newer source row."""
    union = reduce(lambda a, b: a.unionByName(b), deltas)
    if target is None:
        return union
    return apply_merge(
        target,
        union,
        consolidated_keys(target.columns, keys, by_company),
        matched=lambda t, s: {c: s(c) for c in target.columns},
        update_when=lambda t, s: s(changed) > t(changed),
    )


def consolidate_history(
    target: DataFrame, deltas: Sequence[DataFrame], keys: Sequence[str], by_company: bool = False
) -> DataFrame:
    """Add versions absent by (source, original keys, start), then re-end the versions of the touched keys.

    A late version between two known ones repairs both ranges. Keys without news keep their rows untouched; NULL is a key like others,
    so a repeated delivery adds nothing.
    """
    keys = consolidated_keys(target.columns, keys, by_company)
    starts = [*keys, "effective_start_datetime"]
    union = earliest_by(
        reduce(lambda a, b: a.unionByName(b), deltas),
        starts,
        ["effective_end_datetime"],
    )
    absent = reused(join_keys(union, target.select(*starts), starts, "left_anti").select(*target.columns))
    touched = absent.select(*keys).distinct()
    untouched = join_keys(target, touched, keys, "left_anti")
    affected = join_keys(target, touched, keys, "left_semi").unionByName(absent)
    scanned = ordered_scan(
        affected, keys, ["effective_start_datetime"], [Scan("_next", "lead", "effective_start_datetime")]
    )
    repaired = scanned.withColumns(
        {
            "effective_end_datetime": F.coalesce(millis_before(F.col("_next")), ntz(OPEN_END)),
            "is_current": F.col("_next").isNull(),
        }
    )
    return untouched.unionByName(repaired.select(*target.columns))


def archive_merge(archive: DataFrame, old: DataFrame, keys: Sequence[str], delta: str) -> DataFrame:
    """Rows of an old archive that are missing by (key, version), appended once; unknown columns become NULL."""
    absent = join_keys(old, archive.select(*keys, delta), [*keys, delta], "left_anti")
    types = dict(archive.dtypes)
    shaped = absent.select(
        *[F.col(c) if c in absent.columns else F.lit(None).cast(types[c]).alias(c) for c in archive.columns]
    )
    others = [c for c in archive.columns if c not in (*keys, delta)]
    return archive.unionByName(latest_by(shaped, [*keys, delta], others).select(*archive.columns))


def dedupe_archive(archive: DataFrame, keys: Sequence[str], delta: str) -> DataFrame:
    """One row per (key, version)."""
    others = [c for c in archive.columns if c not in (*keys, delta)]
    return latest_by(archive, [*keys, delta], others)


def lake_into_archive(archive: DataFrame, lake: DataFrame, keys: Sequence[str], delta: str) -> DataFrame:
    """Insert-only: versions of the lake table the archive does not hold."""
    absent = join_keys(lake, archive.select(*keys, delta), [*keys, delta], "left_anti")
    return archive.unionByName(absent.select(*archive.columns))


def close_versions(target: DataFrame, keys_to_close: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    """End the current version of every key in a key set."""
    return apply_merge(
        target,
        keys_to_close.select(*keys).distinct(),
        keys,
        unique_source=True,
        matched=lambda t, s: {"effective_end_datetime": at, "is_current": F.lit(False)},
        update_when=lambda t, s: t("is_current"),
        insert=False,
    )
