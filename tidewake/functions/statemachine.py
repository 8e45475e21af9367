"""The orders' state machine."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewake.schemas import ORDER_TRANSITIONS


def transitions() -> Column:
    return F.create_map(*[x for k, v in ORDER_TRANSITIONS.items() for x in (F.lit(k), F.array(*[F.lit(s) for s in v]).cast("array<string>"))])


def next_statuses(status: Column) -> Column:
    return transitions()[status]


def is_terminal(status: Column) -> Column:
    return F.size(next_statuses(status)) == 0


def next_status(status: Column, pick: Column) -> Column:
    """One of the legal next states, by a whole number; null at the end."""
    found = next_statuses(status)
    return F.when(F.size(found) > 0, F.get(found, (pick % F.greatest(F.size(found), F.lit(1))).cast("int")))


def is_legal(before: Column, after: Column) -> Column:
    """Whether a row may go from one status to another; staying is legal, and so is any first status."""
    return before.isNull() | (before == after) | F.coalesce(F.array_contains(next_statuses(before), after), F.lit(False))


def status_history(changes: DataFrame, key: str = "order_id", status: str = "order_status", order: tuple[str, ...] = ("source_lsn", "kafka_offset")) -> DataFrame:
    """changes with previous_status and legal, in the order of the log."""
    w = Window.partitionBy(key).orderBy(*order)
    before = F.lag(status).over(w)
    return changes.withColumn("previous_status", before).withColumn("legal", is_legal(F.col("previous_status"), F.col(status)))
