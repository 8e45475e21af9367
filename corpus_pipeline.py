"""A corpus pipeline over `documents`: each stage is written as Parquet and read back as the next one's input.

Quality rules drop documents by ratios, whatever their length; line dedup rewrites texts (n_chars with them); of each
group of documents whose five-word shingles have a similarity of 0.8 or more one stays; mixing lays the rows out in the order of the mixture; the last
stage adds pieces and position, a row's number (from 0) in that order. Position comes from where
a row lies in the files that are read back; it is null for rows that come from no file. Stages need doc_id, text, lang, source and n_chars, whose nulls, ties and
repeats are treated as the operators' docstrings say. A stage's files go when the next one's are written.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewake.llm import linededup, mixing, pieces, quality, simhash
from tidewake.llm.common import discard, stored, table
from tidewake.llm.queries import PIECES_MODEL, WEIGHTS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, rules=quality.RATIOS, base=False).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = linededup.line_dedup(docs)
    return out.withColumn("n_chars", F.when(F.col("removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(docs, WEIGHTS)
    return mixing.in_order(mixed).select(*COLUMNS)


def positions(docs: DataFrame) -> DataFrame:
    """docs with position: a row's number over all its files, read one after the other by name."""
    docs = docs.drop("position")
    try:
        rows = docs.select(*docs.columns, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        rows.schema  # noqa: B018 - analyses the columns
    except AnalysisException:
        return docs.withColumn("position", F.lit(None).cast("bigint"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_name").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = rows.groupBy(F.col("_file").alias("_name")).agg(F.count("*").alias("n")).select("_name", before.alias("_before"))
    rows = rows.join(F.broadcast(files), F.col("_file") == F.col("_name"))
    return rows.select(*docs.columns, (F.col("_before") + F.col("_row")).alias("position"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_and_verify(positions(docs), pieces.load_model(PIECES_MODEL))


STAGES = [("quality", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mix), ("sentencepiece", sentencepiece)]

#: Hashes with a seed, and draws from the piece lattice, are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
