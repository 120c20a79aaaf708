"""Classification by a table of rules.

A rule has a rank, a label and parts; each part asks that a field equals, contains, starts or ends with a literal (letter case aside), and all
parts must hold. Rules stay rows: of each rule one short piece of a literal, the one that the data holds least often, leads to it. A value
looks up the pieces it contains, only the rules these lead to are checked, and the least rank wins. So the plan does not grow with
the table, and no value meets all rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.semantics import join_keys
from tidemart.session import reused

PIECE = 4
KINDS = ("equals", "contains", "starts", "ends")


def _pieces(text: Column, length: Column) -> Column:
    """All distinct pieces of one length."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - length + 1), lambda i: F.substring(text, i, length)))


def _holds(part: Column, value: Column) -> Column:
    text, kind = part["text"], part["kind"]
    return (
        F.when(kind == "equals", value == text).when(kind == "contains", F.contains(value, text)).when(kind == "starts", F.startswith(value, text)).otherwise(F.endswith(value, text))
    )


def rule_index(values: DataFrame, parts: DataFrame, fields: Sequence[str], piece: int = PIECE) -> DataFrame:
    """rule, field, piece: for every rule the piece of its literals that stands in the fewest values (one that stands in none leads nowhere)."""
    text = F.col("text")
    length = F.least(F.length(text), F.lit(piece))
    offered = parts.filter(F.length(text) > 0).select("rule", "field", F.explode(_pieces(text, length)).alias("piece")).distinct()
    wanted = offered.select("field", "piece").distinct()
    counted = value_pieces(values, wanted, fields, piece).groupBy("field", "piece").agg(F.count(F.lit(1)).alias("n"))
    rated = join_keys(offered, counted, ["field", "piece"], "left")
    best = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "field", "piece")).alias("best")
    return rated.groupBy("rule").agg(best).select("rule", F.col("best.field").alias("field"), F.col("best.piece").alias("piece"))


def value_pieces(values: DataFrame, wanted: DataFrame, fields: Sequence[str], piece: int) -> DataFrame:
    """_id, field, piece of all wanted pieces in the values; only piece lengths that are wanted are cut (at most ``piece`` of them)."""
    lengths = sorted((r["field"], r["l"]) for r in wanted.select("field", F.length("piece").alias("l")).distinct().collect())
    none = F.array().cast("array<struct<field:string,piece:string>>")

    def cut(name: str, n: int) -> Column:
        named = F.transform(_pieces(F.col(name), F.lit(n)), lambda p: F.struct(F.lit(name).alias("field"), p.alias("piece")))
        return F.when(F.length(F.col(name)) >= n, named).otherwise(none)

    each = [cut(name, n) for name, n in lengths if name in fields]
    if not each:
        return values.select("_id", F.lit("").alias("field"), F.lit("").alias("piece")).limit(0)
    spread = values.select("_id", F.explode(F.concat(*each)).alias("p")).select("_id", "p.field", "p.piece")
    return join_keys(spread, wanted, ["field", "piece"], "left_semi")


def classify(df: DataFrame, fields: Sequence[str], rules: DataFrame, parts: DataFrame, out: str, otherwise: str | None = None, piece: int = PIECE) -> DataFrame:
    """Add the label of the rule of least rank (ties: least rule) whose parts all hold.

    rules: rule, rank, label; parts: rule, field, kind, text. A rule without parts, or with empty literals only that do not ask for equality,
    holds always; a null field fits no part. Every distinct combination of the fields is classified once.
    """
    fields = list(fields)
    lower = {f: F.lower(F.col(f)) for f in fields}
    distinct = df.select(*[c.alias(f) for f, c in lower.items()]).distinct()
    values = reused(distinct.withColumn("_id", F.struct(*fields)))
    asked = reused(parts.select("rule", "field", "kind", F.lower("text").alias("text")).distinct())
    grouped = asked.groupBy("rule").agg(F.collect_list(F.struct("field", "kind", "text")).alias("parts"), F.max(F.length("text")).alias("longest"))
    known = rules.join(grouped, "rule", "left").select("rule", "rank", "label", F.coalesce("parts", F.array().cast("array<struct<field:string,kind:string,text:string>>")).alias("parts"), F.coalesce("longest", F.lit(0)).alias("longest"))
    index = reused(rule_index(values, asked, fields, piece))
    led = join_keys(value_pieces(values, index.select("field", "piece").distinct(), fields, piece), index, ["field", "piece"]).select("_id", "rule").distinct()
    field_of = lambda p: F.coalesce(*[F.when(p["field"] == f, F.col(f"_id.{f}")) for f in fields])
    fits = F.forall("parts", lambda p: F.coalesce(_holds(p, field_of(p)), F.lit(False)))
    found = led.join(known, "rule").filter(fits).groupBy("_id").agg(F.min(F.struct("rank", "rule", "label")).alias("_found"))
    direct = _direct(known.filter(F.col("longest") == 0), known)
    both = values.join(found, "_id", "left").withColumn("_best", F.least(F.col("_found"), direct) if direct is not None else F.col("_found"))
    labels = both.filter(F.col("_best").isNotNull()).select(*[F.col(f).alias(f"_{f}") for f in fields], F.col("_best.label").alias("_label"))
    on = F.lit(True)
    for f in fields:
        on = on & lower[f].eqNullSafe(F.col(f"_{f}"))
    joined = df.join(labels, on, "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("_label", F.lit(otherwise)).alias(out))


def _direct(unled: DataFrame, known: DataFrame) -> Column | None:
    """The best of the rules that have no piece to look up, as an expression.

    They ask for nothing, or that a field is empty or not null, so of all that ask for the same only the best matters: four to the
    power of the fields at most, whatever their number.
    """
    asked = F.array_sort(F.array_distinct(F.transform("parts", lambda p: F.struct(p["field"].alias("field"), (p["kind"] == "equals").alias("empty")))))
    best = unled.groupBy(asked.alias("asked")).agg(F.min(F.struct("rank", "rule", "label")).alias("best")).collect()
    kind = known.select(F.struct("rank", "rule", "label").alias("s")).schema["s"].dataType
    if not best:
        return None
    cases = []
    for r in best:
        holds = F.lit(True)
        for field, empty in r["asked"]:
            holds = holds & ((F.coalesce(F.col(field) == "", F.lit(False))) if empty else F.col(field).isNotNull())
        row = F.struct(*[F.lit(r["best"][c]).alias(c) for c in ("rank", "rule", "label")]).cast(kind)
        cases.append(F.when(holds, row))
    return F.array_min(F.array(*cases))
