"""File loads and exports: the provided tables are written as files and loaded back through the operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from tidemart.functions.semantics import row_count

from tidemart.sources import export as E
from tidemart.sources import extract as X
from tidemart.sources import files as L
from tidemart.sources.tables import BucketedTable, VersionedTable
from tidemart.streaming import jobs as ST
from tidemart.workload.base import money, query, when

NOW = "2002-01-01 00:00:00"


@query("l01_csv_load", "SELECT o_orderkey, COALESCE(NULLIF(o_orderstatus, 'P'), '-') AS status, o_totalprice, o_orderdate::VARCHAR AS o_orderdate FROM orders")
def _(t):
    path = t.scratch("l01")
    o = t.orders.select("o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("status"), "o_totalprice", F.date_format("o_orderdate", "dd/MM/yyyy HH:mm").alias("d"))
    E.write_delimited(o, path, delimiter="|", quote_all=False)
    fmt = L.CsvFormat(delimiter="|", header_rows=1, timestamp_format="dd/MM/yyyy HH:mm")
    back = L.read_csv(t.spark, path, "o_orderkey long, status string, o_totalprice double, o_orderdate timestamp_ntz", fmt)
    return back.select("o_orderkey", F.coalesce("status", F.lit("-")).alias("status"), "o_totalprice", "o_orderdate")


@query("l02_json_load", "SELECT event_id, user_id, value, ts::VARCHAR AS ts FROM events")
def _(t):
    path = t.scratch("l02")
    t.events.select(F.col("event_id").alias("EVENT_ID"), F.col("user_id").alias("User_Id"), "value", F.col("ts").cast("string").alias("ts")).write.json(path)
    back = L.read_json(t.spark, path, "event_id long, user_id long, value double, ts string")
    return back.select("event_id", "user_id", "value", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("l03_parquet_declared", "SELECT c_custkey, c_name, c_acctbal::DECIMAL(19,4)::DOUBLE AS c_acctbal FROM customer")
def _(t):
    path = t.scratch("l03")
    L.write_parquet(t.customer, {"c_custkey": "INT", "c_name": "VARCHAR(25)", "c_acctbal": "NUMBER(19,4)"}, path, batch_rows=30_000)
    return t.spark.read.parquet(path)


@query("l04_load_select", "SELECT event_id, (json_extract(props, '$.k'))::BIGINT AS k, upper(event_type) AS kind FROM events")
def _(t):
    return L.load_select(t.events, event_id="event_id", k="cast(get_json_object(props, '$.k') as bigint)", kind="upper(event_type)")


@query("l05_file_metadata", "SELECT n_regionkey::BIGINT AS region, COUNT(*)::BIGINT AS n, 1::BIGINT AS folders, '2002-01-01 00:00:00' AS loaded FROM nation GROUP BY 1")
def _(t):
    path = t.scratch("l05")
    t.nation.write.partitionBy("n_regionkey").parquet(path)
    rows = t.spark.read.parquet(path).select("*", *L.file_columns(when(NOW)))
    folder = F.regexp_extract("meta_file_name", "n_regionkey=([0-9]+)", 0)
    return rows.groupBy(F.col("n_regionkey").alias("region")).agg(row_count().alias("n"), F.count_distinct(folder).alias("folders"), F.max("meta_create_datetime").alias("loaded"))


def _ragged(t, path):
    """One file folder per order status; in status F every urgent order is broken, in P every order."""
    bad = (F.col("o_orderstatus") == "P") | ((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
    key = F.when(bad, F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))).otherwise(F.col("o_orderkey").cast("string"))
    t.orders.select(F.concat_ws(",", key, F.col("o_totalprice").cast("string")).alias("value"), "o_orderstatus").write.partitionBy("o_orderstatus").text(path)
    return L.read_csv(t.spark, path, "o_orderkey long, o_totalprice double")


@query("l06_error_tolerance", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' OR (o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT')")
def _(t):
    staged = L.stage_rows(_ragged(t, t.scratch("l06")), when(NOW), t.scratch("l06-stage"))
    return L.clean_rows(staged, 50).select("o_orderkey", "o_totalprice")


@query("l07_unloaded_files", "SELECT o_orderstatus AS status, COUNT(*)::BIGINT AS n FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1")
def _(t):
    path = t.scratch("l07")
    t.orders.select("o_orderkey", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    rows = t.spark.read.parquet(path).select("*", *L.file_columns(when(NOW)))
    ledger = rows.filter("o_orderstatus = 'O'").select("meta_file_name").distinct()
    return L.unloaded(rows, ledger).groupBy(F.col("o_orderstatus").alias("status")).agg(row_count().alias("n"))


@query("l08_load_report", "SELECT o_orderstatus AS status, COUNT(*)::BIGINT AS parsed, COUNT(*) FILTER (o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'))::BIGINT AS bad FROM orders GROUP BY 1")
def _(t):
    report = L.file_report(L.stage_rows(_ragged(t, t.scratch("l08")), when(NOW), t.scratch("l08-stage")))
    status = F.regexp_extract("meta_file_name", "o_orderstatus=([A-Z])", 1)
    return report.groupBy(status.alias("status")).agg(F.sum("rows_parsed").alias("parsed"), F.sum("rows_bad").alias("bad"))


@query("l09_copy_table", "SELECT s_suppkey, 2::BIGINT AS copies, '2002-01-02 00:00:00' AS newest FROM supplier")
def _(t):
    path = t.scratch("l09")
    L.copy_table(t.supplier, when(NOW), path)
    L.copy_table(t.supplier, when("2002-01-02"), path)
    return t.spark.read.parquet(path).groupBy("s_suppkey").agg(row_count().alias("copies"), F.max("meta_create_datetime").alias("newest"))


@query("l10_raw_json_folders", "SELECT event_id, COALESCE(CASE WHEN event_type = 'click' THEN value END, -1)::DOUBLE AS value, COALESCE(CASE WHEN event_type = 'view' THEN user_id END, -1)::BIGINT AS user_id FROM events WHERE event_type IN ('click', 'view')")
def _(t):
    a, b = t.scratch("l10"), t.scratch("l10")
    t.events.filter("event_type = 'click'").select("event_id", "value").write.json(a)
    t.events.filter("event_type = 'view'").select("event_id", "user_id").write.json(b)
    rows = L.raw_json_folders(t.spark, [a, b], when(NOW))
    return rows.select("event_id", F.coalesce("value", F.lit(-1.0)).alias("value"), F.coalesce("user_id", F.lit(-1)).alias("user_id"))


@query("l11_stream_ingest", "SELECT event_id, user_id, (json_extract(props, '$.k'))::BIGINT AS k FROM events")
def _(t):
    src, out, ckpt = t.scratch("l11-in"), t.scratch("l11-out"), t.scratch("l11-ckpt")
    t.events.select("event_id", "user_id", F.get_json_object("props", "$.k").cast("long").alias("k")).write.json(src)
    ST.ingest_json(t.spark, src, out, ckpt).awaitTermination()
    doc = F.col("document")
    return t.spark.read.parquet(out).select(*[F.variant_get(doc, f"$.{c}", "long").alias(c) for c in ("event_id", "user_id", "k")])


@query("l12_stream_merge", "SELECT user_id, arg_max(event_id, ts) AS event_id, max(ts)::VARCHAR AS ts FROM events GROUP BY 1")
def _(t):
    src, ckpt = t.scratch("l12-in"), t.scratch("l12-ckpt")
    t.events.select("event_id", "user_id", "ts").repartition(4).write.parquet(src)
    stream = t.spark.readStream.schema("event_id long, user_id long, ts timestamp_ntz").option("maxFilesPerTrigger", 2).parquet(src)
    table = BucketedTable(t.spark, t.scratch("l12-table"), ["user_id"], buckets=8)
    ST.merge_stream(stream, table, ["user_id"], ["ts"], ckpt, NOW).awaitTermination()
    return table.read().select("user_id", "event_id", "ts")


@query("l13_xml_documents", "SELECT l_orderkey AS order_id, l_partkey AS part, l_quantity::BIGINT AS qty FROM lineitem UNION ALL SELECT l_orderkey, l_suppkey, l_linenumber::BIGINT FROM lineitem")
def _(t):
    node = lambda tag, c: F.concat(F.lit(f"<{tag}>"), c, F.lit(f"</{tag}>"))
    text = lambda c: F.col(c).cast("long").cast("string")
    item = lambda part, qty: node("item", F.concat(node("part", text(part)), node("qty", text(qty))))
    # One document per order line: order, container, two items.
    items = F.concat(item("l_partkey", "l_quantity"), item("l_suppkey", "l_linenumber"))
    order = F.concat(node("id", text("l_orderkey")), node("container", items))
    docs = t.lineitem.select(node("asn", node("order", order)).alias("xml_data"))
    schema = "order struct<id: bigint, container: struct<item: array<struct<part: bigint, qty: bigint>>>>"
    rows = L.explode_path(L.parse_xml(docs, "xml_data", schema, "asn"), ("asn.order.container.item", "item"))
    return rows.select(F.col("asn.order.id").alias("order_id"), F.col("item.part").alias("part"), F.col("item.qty").alias("qty"))


@query("l14_fixed_columns", "SELECT c_custkey::VARCHAR AS id, c_mktsegment AS segment, '-' AS cost FROM customer")
def _(t):
    path = t.scratch("l14")
    E.write_delimited(t.customer.select(F.col("c_custkey").alias("id"), "c_name", F.col("c_mktsegment").alias("segment")), path)
    raw = t.spark.read.option("header", "true").csv(path)
    return L.fixed_columns(raw, {"id": "string", "segment": "string", "cost": "double"}).withColumn("cost", F.coalesce(F.col("cost").cast("string"), F.lit("-")))


@query("l15_join_sheets", "SELECT COALESCE(a.k, b.k)::BIGINT AS nation, COALESCE(customers, 0)::BIGINT AS customers, COALESCE(suppliers, 0)::BIGINT AS suppliers FROM (SELECT c_nationkey AS k, COUNT(*) AS customers FROM customer WHERE c_acctbal < -500 GROUP BY 1) a FULL JOIN (SELECT s_nationkey AS k, COUNT(*) AS suppliers FROM supplier GROUP BY 1) b ON a.k = b.k")
def _(t):
    a = t.customer.filter("c_acctbal < -500").groupBy(F.col("c_nationkey").alias("nation")).agg(row_count().alias("v"))
    b = t.supplier.groupBy(F.col("s_nationkey").alias("nation")).agg(row_count().alias("v"))
    return L.join_sheets({"customers": a, "suppliers": b}, "nation").fillna(0)


@query("l16_export_delimited", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(t):
    path = t.scratch("l16")
    E.write_delimited(t.customer.select(F.col("c_custkey").alias("C_CUSTKEY"), "c_name", "c_mktsegment"), path, delimiter=";", gzip=True, quote_all=True)
    return t.spark.read.schema("c_custkey long, c_name string, c_mktsegment string").option("header", "true").option("sep", ";").csv(path)


@query("l17_export_parts", "SELECT COUNT(*)::BIGINT AS n, true AS within_part_size, true AS numbered FROM lineitem UNION ALL SELECT COUNT(*), true, false FROM nation")
def _(t):
    many, one = t.scratch("l17"), t.scratch("l17-one")
    E.write_feed(t.lineitem.select("l_orderkey", "l_partkey", "l_quantity"), many, "lines", part_rows=2_000, part_bytes=20_000)
    E.write_feed(t.nation, one, "nations")

    def report(path, schema):
        # Without a schema Spark looks for one in the driver, file by file.
        rows = t.spark.read.schema(schema).option("header", "true").option("sep", "|").csv(path).select(F.col("_metadata.file_name").alias("f"), F.col("_metadata.file_size").alias("size"))
        per = rows.groupBy("f").agg(row_count().alias("n"), F.max("size").alias("size"))
        return per.agg(
            F.sum("n").alias("n"), (F.max("n") <= 2_000).alias("rows_fit"), (F.max("size") <= 20_000).alias("bytes_fit"), F.bool_and(F.col("f").rlike("-[0-9]{3,}.csv$")).alias("numbered")
        )

    both = report(many, "l_orderkey long, l_partkey long, l_quantity double").unionByName(report(one, t.nation.schema))
    return both.select("n", (F.col("rows_fit") & F.col("bytes_fit")).alias("within_part_size"), "numbered")


@query("l18_file_per_key", "SELECT p_brand, COUNT(*)::BIGINT AS n, 1::BIGINT AS files FROM part GROUP BY 1")
def _(t):
    path = t.scratch("l18")
    E.write_per_key(t.part.select("p_partkey", "p_brand").repartition(4), path, "p_brand")
    # The key is read from the files, not from the folder names.
    rows = t.spark.read.option("header", "true").schema("p_partkey long, p_brand string").option("recursiveFileLookup", "true").csv(path)
    return rows.select("p_brand", F.col("_metadata.file_path").alias("f")).groupBy("p_brand").agg(row_count().alias("n"), F.count_distinct("f").alias("files"))


@query("l19_backup_and_delete", "SELECT 'kept' AS place, COUNT(*)::BIGINT AS n FROM orders WHERE (NULLIF(o_orderstatus, 'P') = 'F') IS NOT TRUE UNION ALL SELECT 'saved', COUNT(*) FROM orders WHERE NULLIF(o_orderstatus, 'P') = 'F'")
def _(t):
    path = t.scratch("l19")
    kept = E.backup(t.orders.select("o_orderkey", "o_orderstatus"), path, "json", F.expr("nullif(o_orderstatus, 'P') = 'F'"), delete=True)
    saved = t.spark.read.schema("o_orderkey long").json(path)
    return kept.agg(F.lit("kept").alias("place"), row_count().alias("n")).unionByName(saved.agg(F.lit("saved").alias("place"), row_count().alias("n")))


@query("l20_incremental_extract", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1999-03-01' AND o_orderdate < TIMESTAMP '1999-09-01'")
def _(t):
    return X.increment(t.orders, ["o_custkey", "o_orderstatus"], "o_orderdate", when("1999-03-01"), when("1999-09-01"))


@query("l21_chunked_extract", "SELECT ((o_orderdate::DATE - DATE '1995-01-01') // 30)::BIGINT AS chunk, COUNT(*)::BIGINT AS n FROM orders GROUP BY 1")
def _(t):
    days = t.orders.withColumn("d", F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")))
    low = F.datediff(F.lit("1995-01-01").cast("date"), F.lit("1970-01-01").cast("date"))
    return X.number_chunks(days, "d", low, F.lit(X.CHUNK_DAYS), "chunk").groupBy("chunk").agg(row_count().alias("n"))


@query("l22_change_range", "SELECT event_id, event_type FROM events WHERE event_id > 1000 AND event_id <= (SELECT max(event_id) - 100 FROM events)")
def _(t):
    high = t.events.agg(F.max("event_id") - 100).scalar()
    return X.change_range(t.events, "event_id", F.lit(1000), high).select("event_id", "event_type")


@query("l23_backfill", "SELECT o_orderkey, (o_totalprice::DECIMAL(18,2) - CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' THEN 0 ELSE 5 END)::DOUBLE AS total FROM orders")
def _(t):
    from tidemart.operators.merge import insert_update

    o = t.orders.select("o_orderkey", money("o_totalprice").alias("total"), F.col("o_orderdate").alias("day"))
    wrong = o.withColumn("total", (F.col("total") - 5).cast("decimal(18,2)"))
    target = insert_update(None, wrong, ["o_orderkey"], [], when(NOW))
    return X.backfill(target, o, ["o_orderkey"], "day", when("1997-01-01"), when("1998-01-01"), [], when(NOW)).select("o_orderkey", "total")


@query("s04_refreshed_view", "SELECT event_type, COUNT(*)::BIGINT AS n FROM events GROUP BY 1")
def _(t):
    src, ckpt = t.scratch("s04-in"), t.scratch("s04-ckpt")
    t.events.select("event_id", "event_type").write.parquet(src)
    stream = t.spark.readStream.schema("event_id long, event_type string").parquet(src)
    table = VersionedTable(t.spark, t.scratch("s04-table"))
    view = lambda: t.spark.read.parquet(src).groupBy("event_type").agg(row_count().alias("n"))
    ST.refresh_view(stream, table, view, ckpt).awaitTermination()
    return table.read()


@query("t22_stream_slots", "SELECT s::VARCHAR AS slot_start, event_type, n, total FROM (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS s, event_type, COUNT(*)::BIGINT AS n, SUM(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY 1, 2) WHERE s + INTERVAL 40 MINUTE <= (SELECT max(ts) FROM events)")
def _(t):
    src, out, ckpt = t.scratch("t22-in"), t.scratch("t22-out"), t.scratch("t22-ckpt")
    t.events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", money("value").alias("v")).write.parquet(src)
    stream = t.spark.readStream.schema("ts timestamp, event_type string, v decimal(18,2)").parquet(src)
    # Slots the clock of the stream has passed; the open ones wait for the next run.
    ST.write_slots(ST.slot_totals(stream, "ts", ["event_type"], "v"), out, ckpt).awaitTermination()
    return t.spark.read.parquet(out)
