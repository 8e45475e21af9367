"""Ingest from file streams, its supervision, sinks and the schedule."""

import json

import pytest
from pyspark.sql import functions as F

from tidewake.operators import mutations, synth
from tidewake.sources.records import Capture, bronze_history, file_stream, retained
from tidewake.sources.sinks import ensure_tables, load_tables, merge_sql, statements, upsert
from tidewake.streaming import bronze
from tidewake.streaming.bronze import behind, deduplicated, ingest, sessions, start_query, windowed_counts
from tidewake.streaming.simulator import RATES, due

NOW_AND_END = {"availableNow": True}


def table(spark, name):
    spark.catalog.refreshTable(name)  # batches are written from a session of their own
    return spark.table(name)


def put(spark, path, rows):
    spark.createDataFrame([(t, p, o, v and bytearray(v.encode())) for t, p, o, v in rows], "topic string, partition int, offset bigint, value binary").coalesce(1).write.mode("append").parquet(path)


def test_ingest_quarantine_and_replay(spark, tmp_path):
    assert ensure_tables(spark) == 9
    capture, source = Capture("orders"), str(tmp_path / "in")
    good = '{"op":"c","source":{"lsn":1,"ts_ms":0},"after":{"order_id":1}}'
    put(spark, source, [("cdc.orders", 0, i, good) for i in range(5)] + [("cdc.orders", 0, 5, "{x"), ("cdc.orders", 0, 6, None)])
    go = lambda check: start_query(file_stream(spark, source), capture, str(tmp_path / check), trigger=NOW_AND_END).awaitTermination()
    go("a")
    go("a")  # nothing is new
    rows = table(spark, "bronze.orders_cdc")
    assert rows.count() == 5 and table(spark, "bronze.dlq_events").count() == 2
    go("b")  # a lost checkpoint: rows come twice, with the same ids
    rows = table(spark, "bronze.orders_cdc")
    assert rows.count() == 10 and rows.select("event_id").distinct().count() == 5
    today = rows.select(F.max("ingestion_timestamp_date")).first()[0]
    assert bronze_history(spark, "bronze.orders_cdc", "cdc.orders", today).count() == 10
    assert "PartitionFilters: [isnotnull(ingestion_timestamp_date" in bronze_history(spark, "bronze.orders_cdc", since=today)._jdf.queryExecution().toString()


def test_only_bad_rows(spark, tmp_path):
    ensure_tables(spark)
    put(spark, str(tmp_path / "in"), [("cdc.payments", 1, 0, None)])
    start_query(file_stream(spark, str(tmp_path / "in")), Capture("payments"), str(tmp_path / "c"), trigger=NOW_AND_END).awaitTermination()
    rows = table(spark, "bronze.dlq_events").where("source_topic = 'cdc.payments'").collect()
    assert len(rows) == 1 and rows[0].original_event is None and rows[0].error_message == "value is null"


def test_a_failed_query_is_started_again(spark, tmp_path):
    """Its quarantine topic fails at first; the other query is not touched, and a query that always fails is given up."""
    names, calls, sent = ["customers", "inventory", "shipments"], dict.fromkeys(["customers", "inventory", "shipments"], 0), []
    for n in names:
        put(spark, str(tmp_path / n), [(f"cdc.{n}", 0, 0, '{"op":"c","source":{}}'), (f"cdc.{n}", 0, 1, f"broken {n}")])

    def dlq_of(capture):
        def send(rows):
            calls[capture.name] += 1
            if capture.name == "shipments" or capture.name == "inventory" and calls["inventory"] < 3:
                raise RuntimeError("the topic is not there")
            sent.append((capture.dlq_topic, [r.original_event for r in rows.collect()]))
        return send

    ended = ingest(spark, stream_of=lambda c: file_stream(spark, str(tmp_path / c.name)), checkpoint_of=lambda c: str(tmp_path / f"check-{c.name}"), dlq_of=dlq_of, captures=[Capture(n) for n in names], trigger=NOW_AND_END, retries=2)
    assert calls == {"customers": 1, "inventory": 3, "shipments": 3}
    assert sorted(sent) == [("cdc.customers.dlq", ["broken customers"]), ("cdc.inventory.dlq", ["broken inventory"])]
    assert {n: q.exception() is not None for n, q in ended.items()} == {"customers": False, "inventory": False, "shipments": True}
    # At least once: each failed try had landed the good row, with the same id.
    rows = table(spark, "bronze.inventory_cdc")
    assert rows.count() == 3 and rows.select("event_id").distinct().count() == 1


def test_lag():
    assert behind({"sources": [{"metrics": {"maxOffsetsBehindLatest": "7"}}, {"metrics": {"maxOffsetsBehindLatest": "2.0"}}]}) == 9
    assert behind({"sources": [{"metrics": None}]}) is None and isinstance(bronze.Progress(), bronze.StreamingQueryListener)


def test_streams_of_raw_rows(spark, tmp_path):
    rows = [(f"e{i % 7}", f"2026-01-01 00:{i % 7:02}:00", "cdc.x") for i in range(21)] + [("end", "2026-01-03 00:00:00", "cdc.x")]
    spark.createDataFrame(rows, "event_id string, at string, kafka_topic string").select("event_id", F.col("at").cast("timestamp").alias("source_timestamp"), "kafka_topic").write.parquet(str(tmp_path / "raw"))
    for name, f, want in (("once", deduplicated, 8), ("hours", windowed_counts, 1), ("runs", sessions, 1)):
        stream = f(spark.readStream.schema("event_id string, source_timestamp timestamp, kafka_topic string").parquet(str(tmp_path / "raw")))
        stream.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(**NOW_AND_END).start().awaitTermination()
        found = spark.table(name).collect()
        assert len(found) == want and (name == "once" or found[0]["count"] == 21)


def test_retention(spark):
    df = spark.createDataFrame([("2026-01-01",), ("2025-12-30",), ("2025-12-28",)], "at string").select(F.col("at").cast("timestamp").alias("at"))
    assert retained(df, "at", F.lit("2026-01-01").cast("timestamp")).count() == 2


def test_statements():
    script = "-- one; two\nCREATE X; /* a;b */ CREATE Y COMMENT 'not; -- the end' ;\n\nSELECT \"a;b\", `c--d`; -- last"
    assert statements(script) == ["CREATE X", "CREATE Y COMMENT 'not; -- the end'", 'SELECT "a;b", `c--d`']


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "state")
    change = lambda *rows: spark.createDataFrame(list(rows), "op string, id bigint, v string, lsn bigint")
    upsert(spark, path, change(*[("c", i, f"a{i}", 1) for i in range(40)]), "id", "lsn", buckets=8)
    upsert(spark, path, change(("u", 3, "late", 9), ("u", 3, "early", 8), ("d", 4, None, 5), ("c", 99, "new", 5), ("d", 98, None, 5)), "id", "lsn", buckets=8)
    got = {r.id: r.v for r in spark.read.parquet(path).collect()}
    assert got == {**{i: f"a{i}" for i in range(40) if i != 4}, 3: "late", 99: "new"}
    upsert(spark, path, change(*[("d", i, None, 10) for i in [*range(40), 99]]), "id", "lsn", buckets=8)
    assert not [f for f in (tmp_path / "state").rglob("*.parquet")]
    assert merge_sql("t", "c", "id", ["id", "v"]).startswith("MERGE INTO t t USING c c ON t.id = c.id WHEN MATCHED AND c.op = 'd' THEN DELETE")


def test_dependent_tables_are_loaded_together(spark, tmp_path):
    orders = spark.range(1, 2001).select(F.col("id").alias("order_id"), (F.col("id") % 50 + 1).alias("customer_id"), F.element_at(F.array(*[F.lit(x) for x in synth.PROGRESS_DAYS]), (F.col("id") % 5 + 1).cast("int")).alias("order_status"))
    orders = synth.created_times(orders, F.lit("2026-01-01").cast("timestamp"))
    for pool in (3, 500):
        products = spark.range(1, pool + 1).select((F.col("id") * 7).alias("product_id"), F.col("id").cast("decimal(10,2)").alias("price"))
        base = str(tmp_path / f"seed{pool}")
        written = load_tables(synth.seeded_tables(orders, products), base)
        read = {t: spark.read.parquet(f"{base}/{t}") for t in written}
        assert written == {t: df.count() for t, df in read.items()} and written["orders"] == 2000 and written["shipments"] == 1200
        items = read["order_items"]
        assert sorted(r[0] for r in items.select("order_item_id").collect()) == list(range(1, written["order_items"] + 1))
        assert items.select("order_id", "product_id").distinct().count() == written["order_items"]
        sizes = items.groupBy("order_id").count().withColumnRenamed("count", "size")
        assert tuple(sizes.agg(F.min("size"), F.max("size")).first()) == (1, min(4, pool))
        assert items.where("quantity NOT BETWEEN 1 AND 5 OR unit_price < 0.9 OR product_id % 7 <> 0").count() == 0
        assert read["orders"].join(synth.totals(items), ["order_id", "total_amount"], "left_anti").count() == 0
        assert read["shipments"].where("delivered_at < shipped_at").count() == 0 and read["orders"].where("updated_at < created_at").count() == 0


def test_ids_go_on_where_others_ended(spark):
    df = spark.createDataFrame([(k,) for k in [5, 40_001, 10_000, 9_999, 7, 25_000]], "k bigint")
    assert [(r.k, r.n) for r in synth.dense_ids(df, "k", [], "n", 21).orderBy("n").collect()] == [(5, 21), (7, 22), (9_999, 23), (10_000, 24), (25_000, 25), (40_001, 26)]
    assert synth.dense_ids(df.limit(0), "k", [], "n").count() == 0


@pytest.mark.parametrize("stock", [0, 1, 17, 300])
def test_reserve_agrees_with_one_by_one(spark, stock):
    """Also where one key has nearly all requests."""
    import random

    rng = random.Random(stock)
    asked = [(f"{rng.randrange(1 << 30):010}", 1 if rng.random() < 0.9 else 2, 1, rng.choice([1, 2, 3, 5, 40, 0])) for _ in range(3000)]
    left = {1: stock, 2: stock}
    for _, p, _, q in sorted(asked):
        if 0 < q <= left[p]:
            left[p] -= q
    inventory = spark.createDataFrame([(10 + p, p, 1, stock, 0) for p in (1, 2)], "inventory_id bigint, product_id bigint, warehouse_id bigint, available_quantity bigint, reserved_quantity bigint")
    got = {r.product_id: (r.available_quantity, r.reserved_quantity) for r in mutations.reserve(inventory, spark.createDataFrame(asked, "request_id string, product_id bigint, warehouse_id bigint, quantity int")).collect()}
    assert got == {p: (n, stock - n) for p, n in left.items() if n < stock}


def test_last_change_of_a_key_counts(spark):
    state = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", None)], "id bigint, v string, updated_at timestamp")
    rows = [("u", 1, "late", None, 7), ("u", 1, "early", None, 6), ("c", 9, "new", None, 1), ("d", 2, "b", None, 3), ("u", 8, "nobody", None, 1)]
    now = F.lit("2026-01-01").cast("timestamp")
    out = {r.id: (r.v, r.updated_at is not None) for r in mutations.apply_changes(state, spark.createDataFrame(rows, "op string, id bigint, v string, updated_at timestamp, lsn bigint"), "id", now, "lsn").collect()}
    assert out == {1: ("late", True), 3: ("c", False), 9: ("new", False)}


def test_change_images(spark):
    from tidewake.operators.changes import changes, envelopes

    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id bigint, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (4, "w")], "id bigint, v string")
    found = {json.loads(bytes(r.value))["op"]: json.loads(bytes(r.value)) for r in envelopes(changes(a, b, "id"), "cdc.t", F.col("key")).collect()}
    assert found["u"]["before"] == {"id": 2, "v": "y"} and found["u"]["after"] == {"id": 2, "v": "z"}
    assert found["c"]["before"] is None and found["d"]["after"] is None and found["d"]["before"] == {"id": 3, "v": None} and len(found) == 3


def test_schedule(spark):
    got = {r.event: r.n for r in due(spark, 120).groupBy("event").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert got == {k: 2 * v for k, v in RATES.items()}
