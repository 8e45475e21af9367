"""The pipeline's rows against a plain version: SQL for the rules and the line dedup, all pairs for SimHash."""

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import brute_similar
from tidewake.llm import linededup, mixing, pieces, queries

SF = "/root/testdata/sf0.001"


def plain_version():
    con = duckdb.connect()
    con.execute(f"CREATE TABLE numbered AS SELECT row_number() OVER () rid, * FROM '{SF}/documents.parquet'")
    con.execute(f"""CREATE TABLE documents AS WITH docs AS (SELECT rid, doc_id, lang, coalesce(text, '') t FROM numbered), {queries.QUALITY_SQL}
        SELECT n.* EXCLUDE (rid) FROM numbered n JOIN judged USING (rid) WHERE n_words >= 1 AND 100 * n_repeat_words <= 50 * n_words AND word_chars / n_words BETWEEN 2.0 AND 14.0 AND n_symbols / n_words <= 0.1
        AND n_dup_lines / n_lines <= 0.5 AND n_ellipsis / n_lines <= 0.3 AND n_bullets / n_lines <= 0.9 AND n_alpha / n_words >= 0.6""")
    rows = con.execute(f"SELECT o.doc_id, o.text FROM ({queries.ORACLES['op6_line_dedup']}) o").fetchall()
    root = brute_similar(rows)
    return {i: t for i, t in rows if root[i] == i}


def test_clean_documents_stay():
    """None of the documents labelled good, short ones included, is rejected by the quality stage's rules."""
    con = duckdb.connect()
    con.execute(f"""CREATE TABLE judged AS WITH docs AS (SELECT row_number() OVER () rid, doc_id, lang, coalesce(text, '') t FROM '{SF}/documents.parquet'), {queries.QUALITY_SQL} SELECT * FROM judged""")
    good = "n_words >= 1 AND 100 * n_repeat_words <= 50 * n_words AND n_symbols / n_words <= 0.1 AND n_dup_lines / n_lines <= 0.5 AND n_alpha / n_words >= 0.6"
    lost, many = con.execute(f"SELECT count(*) FILTER (WHERE NOT ({good})), count(*) FROM judged JOIN '{SF}/labels.parquet' USING (doc_id) WHERE quality = 1").fetchone()
    assert many > 50 and lost <= 0.01 * many


def test_run(spark):
    want = plain_version()
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert {r.doc_id: r.text for r in rows} == want and len(rows) == len(want)
    assert all(r.lossless and r.n_pieces == len(r.pieces) for r in rows)
    given = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in rows:
        old = given[r.doc_id]
        assert (r.lang, r.source) == (old.lang, old.source) and r.n_chars == (old.n_chars if r.text == old.text else len(r.text))


def test_stages_keep_columns_and_take_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == corpus_pipeline.COLUMNS and docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_long_texts_are_cut_out_alone(spark):
    line = lambda s: " ".join(f"{s}{i}" for i in range(60))
    long = "\n".join(line(f"l{k}x") for k in range(6000))  # megabytes
    df = spark.createDataFrame([(1, long), (2, "short"), (3, long + "\nown tail"), (4, None), (5, "")], "doc_id bigint, text string").coalesce(1)
    got = {r.doc_id: (r.text, r.removed_lines) for r in linededup.line_dedup(df).collect()}
    assert got == {1: (long, 0), 2: ("short", 0), 3: ("own tail", 6000), 4: (None, 0), 5: ("", 0)}
    back = pieces.encode_and_verify(df, pieces.load_model(queries.PIECES_MODEL)).where(F.col("text").isNotNull()).collect()
    assert len(back) == 4 and all(r.lossless for r in back)


def test_rows_follow_the_schedule(spark, tmp_path):
    """Files of several sizes, which Spark does not read in the order of their names."""
    rows = [(i if i % 50 else None, "x " * (i % 7) * (1 + 300 * (i % 11 == 0)), "en", f"src{i % 4}" if i % 5 else None, 1) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("n_chars", F.monotonically_increasing_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or there is one file
    corpus_pipeline.mix(spark, docs, SF).write.parquet(str(tmp_path / "mixed"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(str(tmp_path / "mixed"))
    assert back.select("_metadata.file_name").distinct().count() > 1
    out = sorted(corpus_pipeline.STAGES[-1][1](spark, back, SF).collect(), key=lambda r: r.position)
    assert [r.position for r in out] == list(range(len(rows)))
    want = sorted(mixing.mix_sources(docs, queries.WEIGHTS).collect(), key=lambda r: (r.slot, r.place))
    name = lambda r: r.source if r.source in queries.WEIGHTS else None
    assert [name(r) for r in out] == [name(r) for r in want]
    # Rows with one id and source may take each other's places.
    assert [r.doc_id for r in out] == [r.doc_id for r in want]


def test_run_numbers_all_rows(spark):
    rows = corpus_pipeline.run(spark, SF).select("position").collect()
    assert sorted(r.position for r in rows) == list(range(len(rows)))
