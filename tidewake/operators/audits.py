"""Constraints as queries: each returns the violations it finds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.operators.dealing import parts
from tidewake.schemas import CHECKS, ENUMS, FOREIGN_KEYS, UNIQUE


def check_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rule, violations) of all CHECKS of the given tables; one pass for each table."""
    parts = []
    for name, df in tables.items():
        rules = [(rule, p) for t, rule, p in CHECKS if t == name]
        if rules:
            counts = df.agg(*[F.count_if(~F.coalesce(F.expr(p), F.lit(True))).alias(rule) for rule, p in rules])
            pairs = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("violations")) for rule, _ in rules])
            parts.append(counts.select(F.lit(name).alias("table_name"), F.inline(pairs)))
    return reduce(DataFrame.unionByName, parts)


def enum_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, value, violations): values that an enumeration does not have."""
    parts = [tables[t].where(~F.col(c).isin(*known)).groupBy(F.col(c).alias("value")).agg(F.count("*").alias("violations")).select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "value", "violations") for t, c, known in ENUMS if t in tables]
    return reduce(DataFrame.unionByName, parts)


def fk_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(child, fk_column, violations): rows whose parent is missing."""
    parts = []
    for child, column, parent, key in FOREIGN_KEYS:
        if child in tables and parent in tables:
            lost = tables[child].where(F.col(column).isNotNull()).join(tables[parent].select(F.col(key).alias("_key")), F.col(column) == F.col("_key"), "left_anti")
            parts.append(lost.agg(F.count("*").alias("violations")).select(F.lit(child).alias("child"), F.lit(column).alias("fk_column"), "violations"))
    return reduce(DataFrame.unionByName, parts)


def unique_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, violations): values of a unique key that more than one row has.

    Nearly each row has its own value, so that counting in the tasks that read would only fill them; rows are dealt out first.
    Rows that share a value are counted in one task, which holds it once.
    """
    found = []
    for t, keys in UNIQUE:
        if t in tables:
            rows = tables[t].select(*keys)
            counts = rows.repartition(parts(rows, rows.count()), *keys).groupBy(*keys).count()
            found.append(counts.where("count > 1").agg(F.count("*").alias("violations")).select(F.lit(t).alias("table_name"), "violations"))
    return reduce(DataFrame.unionByName, found)
