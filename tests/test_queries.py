"""Each query against its SQL, and the generators' invariants."""

import math
import re

import duckdb
import pytest

from pyspark.sql import functions as F

from tidewake.operators import audits, dealing, silver
from tidewake.plans import queries
from tidewake.plans.oracles import ORACLES
from tidewake.plans.queries import QUERIES
from tidewake.schemas import CHECKS

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(x):
    return ("nan" if math.isnan(x) else round(x, 6)) if isinstance(x, float) else x


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    found = duck.execute(ORACLES[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == sorted(df.columns)
    k = sorted(names)
    assert sorted(repr([plain(r[c]) for c in k]) for r in rows) == sorted(repr([plain(r[names.index(c)]) for c in k]) for r in found.fetchall())


def test_constraints_hold(spark):
    """As the rules make them, tables break no rule but what they are made from; planted violations of every rule are found."""
    tables = queries._tables(spark, SF)
    assert not [r for r in audits.check_violations(tables).collect() if r.violations]
    assert not [r for r in audits.unique_violations(tables).collect() if r.violations] and not audits.enum_violations(tables).collect()
    assert QUERIES["inventory_cross_seed"](spark, SF).where("reserved_quantity > available_quantity").count() == 0
    found = QUERIES["check_violations"](spark, SF).collect()
    assert {(r.table_name, r.rule) for r in found if r.violations} == {(t, rule) for t, rule, _ in CHECKS} and len(CHECKS) == 13
    assert all(r.violations for n in ("fk_violations", "unique_violations", "enum_violations") for r in QUERIES[n](spark, SF).collect())


def _dealt(df, column):
    """The rows of df, and how many parts each shuffle by the column made."""
    rows = df.collect()
    return rows, {int(n) for n in re.findall(rf"hashpartitioning\({column}#[^)]*, (\d+)\)", df._jdf.queryExecution().executedPlan().toString())}


def test_unique_audit_deals_out_its_rows(spark, monkeypatch):
    """F1 of round 3: one task made and counted all rows of inventory, as products are one file."""
    want = sorted(QUERIES["unique_violations"](spark, SF).collect())
    monkeypatch.setattr(dealing, "PART_ROWS", 25)
    stock = queries._tables(spark, SF)["inventory"]
    made = [r["count"] for r in stock.groupBy(F.spark_partition_id()).count().collect()]
    assert max(made) <= sum(made) / 20
    df = QUERIES["unique_violations"](spark, SF)
    rows, emails = _dealt(df, "email")
    _, places = _dealt(df, "product_id")
    assert sorted(rows) == want and emails == {6} and places == {sum(made) // 25}


def test_revenue_deals_out_its_rows(spark, monkeypatch, tmp_path):
    """F2 of round 3: tasks sorted and counted ever more items; here with orders and products twice, nulls, and one order with a third of all items."""
    con = duckdb.connect()
    odd = {
        "orders": "SELECT * FROM t UNION ALL SELECT * FROM t WHERE o_orderkey % 50 = 0", "part": "SELECT * REPLACE (CASE WHEN p_partkey % 7 > 0 THEN p_brand END AS p_brand) FROM t UNION ALL SELECT * FROM t WHERE p_partkey % 40 = 0",
        "lineitem": "SELECT * REPLACE (CASE WHEN l_linenumber = 2 THEN 7 WHEN l_partkey % 31 > 0 THEN l_orderkey END AS l_orderkey, CASE WHEN l_suppkey % 5 > 0 THEN l_quantity END AS l_quantity) FROM t", "customer": "SELECT * FROM t",
    }
    for t, sql in odd.items():
        con.execute(f"COPY (WITH t AS (SELECT * FROM '{SF}/{t}.parquet') {sql}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    monkeypatch.setattr(dealing, "PART_ROWS", 100)
    df = QUERIES["gold_revenue_by_category"](spark, str(tmp_path))
    rows, orders = _dealt(df, "order_id")
    _, products = _dealt(df, "product_id")
    n = -(-con.execute("SELECT count(*) FROM lineitem").fetchone()[0] // 100)
    found = con.execute(ORACLES["gold_revenue_by_category"])
    names = [x[0] for x in found.description]
    assert sorted(repr([r[c] for c in names]) for r in rows) == sorted(repr(list(r)) for r in found.fetchall())
    assert orders == products == {n} and "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size", [1, 7, 100_000])
def test_late_rows_are_found_in_any_ranges(spark, size):
    import random

    rng = random.Random(size)
    rows = [("t", p, o, 1000 * rng.randrange(200) if rng.random() < 0.9 else None) for p in range(2) for o in range(200)]
    latest, want = {}, 0
    for _, p, _, ms in rows:
        want += ms is not None and p in latest and latest[p] - ms > 50_000
        latest[p] = max(latest.get(p, 0), ms) if ms is not None else latest.get(p, -10**9)
    df = spark.createDataFrame(rows, "kafka_topic string, kafka_partition int, kafka_offset bigint, ms bigint").withColumn("source_timestamp", F.timestamp_millis("ms"))
    assert [(r.n, r.n_late) for r in silver.late(df, 50, size).collect()] == [(400, want)]


def test_statuses(spark):
    from tidewake.schemas import ORDER_TRANSITIONS, SEED_WEIGHTS

    assert sum(SEED_WEIGHTS.values()) == 100
    for r in QUERIES["legal_transitions"](spark, SF).limit(500).collect():
        assert (r.next_status in ORDER_TRANSITIONS[r.order_status]) if ORDER_TRANSITIONS[r.order_status] else r.next_status is None
