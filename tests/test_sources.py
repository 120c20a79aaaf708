"""File loads, table versions, watermarks, checks and streams."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemart.operators import quality as Q
from tidemart.operators import watermark as WM
from tidemart.functions.semantics import join_keys
from tidemart.operators.merge import apply_merge, insert_update
from tidemart.plans import logistics as LG
from tidemart.sources import export as E
from tidemart.sources import extract as X
from tidemart.sources import files as L
from tidemart.sources.tables import BucketedTable, VersionedTable
from tidemart.streaming import jobs as ST


def now():
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")


def test_csv_details(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;name;n\n1;"x;""y""";2\n2;;bad\n')
    fmt = L.CsvFormat(delimiter=";", header_rows=1)
    rows = L.read_csv(spark, str(tmp_path), "id int, name string, n int", fmt)
    staged = L.stage_rows(rows, now(), str(tmp_path / "stage"))
    got = sorted(tuple(r) for r in staged.select("id", "name", "n").collect())
    assert got == [(1, 'x;"y"', 2), (2, None, None)]
    report = L.file_report(staged)
    assert [(r.rows_parsed, r.rows_bad) for r in report.collect()] == [(2, 1)]
    assert L.check_load(report, 50)["rows_loaded"] == 1
    with pytest.raises(L.LoadFailed):
        L.check_load(report, 10)
    assert L.check_load(report.limit(0), 10)["warning"] == "no file"
    assert L.clean_rows(staged, 50).count() == 1 and L.clean_rows(staged, 10).count() == 0


def test_json_names_and_nested(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"ID": 1, "Tags": ["a", "b"], "x": null}\n{"id": "no"}\nbroken\n')
    rows = L.read_json(spark, str(tmp_path), "id int, tags array<string>").collect()
    assert sorted([(r.id, r.tags, r[L.CORRUPT] is None) for r in rows], key=repr) == sorted(
        [(1, ["a", "b"], True), (None, None, False), (None, None, False)], key=repr
    )


def test_nested_xml(spark):
    xml = "<asn><order><id>5</id><container><item><part>1</part></item><item><part>2</part></item></container></order></asn>"
    df = spark.createDataFrame([(xml,)], "x string")
    schema = "order struct<id: bigint, container: struct<item: array<struct<part: bigint>>>>"
    rows = L.explode_path(L.parse_xml(df, "x", schema, "a"), ("a.order.container.item", "i"))
    assert sorted((r.id, r.part) for r in rows.select("a.order.id", "i.part").collect()) == [(5, 1), (5, 2)]


def test_conversation_with_several_levels(spark):
    doc = '{"conversationId":"c","participants":[{"participantId":"p","sessions":[{"sessionId":"s","segments":[{"n":1},{"n":2}]},{"sessionId":"t","segments":[{"n":3}]}]},{"participantId":"q"}]}'
    schema = "conversationId string, participants array<struct<participantId: string, sessions: array<struct<sessionId: string, segments: array<struct<n: int>>>>>>"
    df = spark.createDataFrame([(doc,)], "d string").select(F.from_json("d", schema).alias("conversation"))
    got = sorted(map(tuple, LG.conversation_rows(df).collect()), key=repr)
    assert got == sorted([("c", "p", "s", 1), ("c", "p", "s", 2), ("c", "p", "t", 3), ("c", "q", None, None)], key=repr)


def test_incomplete_version_is_invisible(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.publish(spark.range(3))
    os.makedirs(tmp_path / "t" / "v=2")
    assert table.versions() == [1] and table.read().count() == 3
    table.publish(spark.range(5))
    assert table.versions() == [1, 2] and table.read(back=1).count() == 3


def test_failed_run_does_not_advance(spark, tmp_path):
    state, target = VersionedTable(spark, str(tmp_path / "s")), VersionedTable(spark, str(tmp_path / "t"))
    src = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 5))], "k int, ts timestamp_ntz")

    def load(df, fail=False):
        def transform(low):
            if fail:
                raise RuntimeError("boom")
            part = df.filter(F.col("ts") > F.lit(low("src")))
            return insert_update(target.read() if target.exists() else None, part, ["k"], ["ts"], now())

        return WM.run_incremental(spark, state, "fact", [WM.Dependency("src", df, "ts")], target, transform)

    load(src.filter("k = 1"))
    with pytest.raises(RuntimeError):
        load(src, fail=True)
    low = WM.get_watermark(state.read(), "FACT", "src").first().watermark
    assert low == dt.datetime(2024, 1, 1)
    assert load(src).count() == 2
    whole = insert_update(None, src, ["k"], ["ts"], now())
    assert sorted(r.k for r in whole.collect()) == sorted(r.k for r in target.read().collect())


def test_errored_keys_are_retried(spark):
    stage = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "c")], "k int, v string")
    flagged = Q.flag_nulls(Q.flag_duplicates(stage, ["k"]), ["v"])
    assert sorted(r.k for r in Q.loadable(flagged).collect()) == [2, 3]
    first = Q.update_exceptions(None, flagged)
    second = Q.update_exceptions(first, flagged.filter("k = 2"))
    assert second.filter("meta_is_current_excp").count() == 1 and second.count() == 4
    keys = WM.changed_keys("k", {}, None, [], exceptions=first)
    assert sorted(r.k for r in keys.collect()) == [1, 2]


def test_alert(spark):
    rows = spark.range(1)
    with pytest.raises(Q.CheckFailed):
        Q.alert(rows, "check")
    assert Q.alert(rows, "check", "skip") is False and Q.alert(rows, "check", "continue") is True
    assert Q.alert(rows.limit(0), "check") is True


def test_chunks():
    a, b = dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 1)
    chunks = X.datetime_chunks(a, b)
    assert chunks[0] == (a, dt.datetime(2024, 1, 31)) and len(chunks) == 2 and chunks[-1][1] >= b
    assert X.integer_chunks(0, 25_000_000) == [(0, 10_000_000), (10_000_000, 20_000_000), (20_000_000, 30_000_000)]
    assert X.chunk_predicates("id", [(0, 5)]) == ["id >= 0 AND id < 5"]


def test_warehouse_types():
    kinds = {"NUMBER(19,4)": "decimal(19,4)", "NUMBER(38,0)": "bigint", "VARCHAR(50)": "string", "TIMESTAMP_NTZ(9)": "timestamp_ntz"}
    assert {t: L.warehouse_type(t).simpleString() for t in kinds} == kinds


def test_feed_parts_and_backup(spark, tmp_path):
    df = spark.range(25).withColumn("flag", F.when(F.col("id") < 5, "x"))
    E.write_feed(df.coalesce(1), str(tmp_path / "feed"), part_rows=10)
    assert len([f for f in os.listdir(tmp_path / "feed") if f.endswith(".csv")]) == 3
    kept = E.backup(df, str(tmp_path / "b"), "parquet", F.col("flag") == "x", delete=True)
    assert kept.count() == 20 and spark.read.parquet(str(tmp_path / "b")).count() == 5


def test_stream_merge_is_repeatable(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, 1), (2, 1)], "k int, ver int").write.parquet(src)
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    stream = lambda: spark.readStream.schema("k int, ver int").parquet(src)
    ST.merge_stream(stream(), table, ["k"], ["ver"], str(tmp_path / "c1"), "2024-01-01 00:00:00").awaitTermination()
    spark.createDataFrame([(1, 2), (3, 1)], "k int, ver int").write.mode("append").parquet(src)
    ST.merge_stream(stream(), table, ["k"], ["ver"], str(tmp_path / "c1"), "2024-01-02 00:00:00").awaitTermination()
    assert sorted((r.k, r.ver) for r in table.read().collect()) == [(1, 2), (2, 1), (3, 1)]
    before = sorted(map(tuple, table.read().collect()))
    ST.merge_stream(stream(), table, ["k"], ["ver"], str(tmp_path / "c2"), "2024-01-03 00:00:00").awaitTermination()
    assert sorted(map(tuple, table.read().collect())) == before


def test_stream_slots_drop_late_rows(spark, tmp_path):
    src = str(tmp_path / "in")
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    schema = "ts timestamp, k string, v long"
    run = lambda: ST.write_slots(
        ST.slot_totals(spark.readStream.schema(schema).parquet(src), "ts", ["k"], "v"), str(tmp_path / "out"), str(tmp_path / "c")
    ).awaitTermination()
    spark.createDataFrame([(at(1, 5), "a", 1), (at(1, 20), "a", 2), (at(3, 0), "a", 9)], schema).write.parquet(src)
    run()
    spark.createDataFrame([(at(1, 25), "a", 100), (at(5, 0), "a", 1)], schema).write.mode("append").parquet(src)
    run()
    got = sorted((r.slot_start.hour, r.n, r.total) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, 2, 3), (3, 1, 9)]


def test_case_tags_with_and_without_repeats(spark):
    rows = [(1, 5, 10, "b", 1), (1, 6, 11, "a", 2), (1, 5, 12, "b", 3)]
    df = spark.createDataFrame(rows, "number int, case int, cust int, label string, t int")
    every = LG.case_tags(df, "number", "case", "cust", "label", ["t"]).first()
    assert (every.tags, every.cust, every.case_count) == ("b, a, b", 10, 2)
    assert LG.case_tags(df, "number", "case", "cust", "label", ["t"], repeats=False).first().tags == "b, a"


def test_bucketed_merge_leaves_other_files(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=8)
    rows = spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("ver"))
    load = lambda target, source: insert_update(target, source, ["k"], ["ver"], now())
    table.merge(rows, load)
    files = lambda: {f"{d}/{f}" for d, _, names in os.walk(tmp_path / "t") for f in names if f.endswith(".parquet")}
    before = files()
    news = rows.where("k = 7").withColumn("ver", F.lit(2))
    touched = table.merge(news, load)
    assert len(touched) == 1
    assert {f for f in before if f"_bucket={touched[0]}/" not in f} <= files()
    assert sorted((r.k, r.ver) for r in table.read().select("k", "ver").collect()) == [(k, 2 if k == 7 else 1) for k in range(200)]
    # A merge that empties a bucket removes its files.
    gone = table.read().where(table.bucket() == touched[0]).select("k")
    table.merge(gone, lambda target, source: target.join(source, "k", "left_anti"), deletes=True)
    assert not any(f"_bucket={touched[0]}/" in f for f in files()) and table.read().count() < 200


def test_join_keys_meets_null(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, v int")
    totals = rows.groupBy("g").agg(F.sum("v").alias("s"))
    assert sorted((r.v, r.s) for r in join_keys(rows, totals, ["g"]).collect()) == [(1, 3), (2, 3), (3, 3)]
    assert join_keys(rows, totals, ["g"], "left_anti").count() == 0


def test_a_second_source_row_fails_the_merge(spark):
    target = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int")
    source = spark.createDataFrame([(1, 5), (1, 6)], "k int, v int")
    with pytest.raises(Exception, match="several rows for one key"):
        apply_merge(target, source, ["k"], matched=lambda t, s: {"v": s("v")}).collect()


def test_feed_has_no_number_for_one_part(spark, tmp_path):
    assert E.write_feed(spark.range(5), str(tmp_path / "one"), "f") == ["f.csv"]
    names = E.write_feed(spark.range(1000), str(tmp_path / "many"), "f", part_bytes=900)
    assert names[0] == "f-000.csv" and all(os.path.getsize(tmp_path / "many" / n) <= 900 for n in names)


def test_many_parts_of_a_feed_are_few_tasks_and_written_once(spark, tmp_path, monkeypatch):
    """Rows of one length stand together; parts are bounded, hold all rows, and have numbers of more than three digits where they need them."""
    written = []
    plain = E.write_delimited
    monkeypatch.setattr(E, "write_delimited", lambda df, *a, **b: written.append(df.rdd.getNumPartitions()) or plain(df, *a, **b))
    monkeypatch.setattr(E, "FEW_PARTS", 4)
    df = spark.range(0, 700_000, 1, 4).select("id", F.repeat(F.lit("x"), F.when(F.col("id") < 350_000, 2).otherwise(6)).alias("text"))
    names = E.write_feed(df, str(tmp_path / "many"), "f", part_rows=3_000, part_bytes=6_000)
    assert len(written) == 1 and written[0] < len(names) / 20 and len(names) > 1000
    assert sorted(n for n in os.listdir(tmp_path / "many") if n.endswith(".csv")) == sorted(names) and names[1000] == "f-1000.csv"
    assert max(os.path.getsize(tmp_path / "many" / n) for n in names) <= 6_000
    back = spark.read.schema("id long, text string").option("header", "true").option("sep", "|").csv(str(tmp_path / "many"))
    assert back.agg(F.count("id"), F.sum("id"), F.sum(F.length("text"))).first() == (700_000, 700_000 * 699_999 // 2, 350_000 * 8)
