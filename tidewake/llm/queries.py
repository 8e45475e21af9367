"""The queries of this subpackage, and DuckDB's SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.llm import chat, licences, linededup, lm, mixing, pieces, quality, simhash, topk, warc
from tidewake.llm.common import table

#: The model for op1; a parameter of the operator.
PIECES_MODEL = os.environ.get("TIDEWAKE_PIECES_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: Target weights of op3.
WEIGHTS = {"src0": 0.24, **{f"src{i}": 0.04 for i in range(1, 20)}}


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode_and_verify(docs, pieces.load_model(PIECES_MODEL)).select("doc_id", "n_pieces", "lossless", "pieces")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.archived(table(spark, sf_dir, "pages"))
    return back.select(
        warc.page_number(F.col("record_id")).alias("page_id"), F.col("http_length").alias("payload_bytes"), "payload_digest", "record_type",
        warc.page_number(F.col("refers_to")).alias("refers_to"),
    )


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix_sources(docs, WEIGHTS)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    apart = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return lm.lm_scores(table(spark, sf_dir, "documents"), apart)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.line_dedup(docs)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no paths, so each is filed by its source, language and number."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    out = licences.licence_scan(docs.select("doc_id", path.alias("path"), "text"))
    return out.select("doc_id", "path", "licence", "cosine", "origin", "origin_id")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.reply_order(table(spark, sf_dir, "conversations"))


def chat_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplied conversations quote nothing, so here they are made to, by a rule."""
    return chat.reply_order(chat.quoting(table(spark, sf_dir, "conversations")))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_warc": op2_warc,
    "op3_source_mixing": op3_source_mixing,
    "op4_quality_rules": op4_quality_rules,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_line_dedup": op6_line_dedup,
    "op7_simhash": op7_simhash,
    "op8_licence_scan": op8_licence_scan,
    "op9_chat_format": op9_chat_format,
    "op10_topk": op10_topk,
    "chat_quotations": chat_quotations,
}

_STOP = ", ".join(f"'{form}'" for form in sorted({form for ws in quality.STOP_WORDS.values() for w in ws for form in (w, w.capitalize())}))

#: Base columns and rules of op4, of a relation docs(rid, doc_id, lang, t); used by the pipeline's SQL too.
QUALITY_SQL = rf"""
a AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) l FROM docs),
p AS (SELECT rid, unnest(w) x, generate_subscripts(w, 1) i FROM a),
g AS (SELECT rid, i, x || ' ' || lead(x) OVER (PARTITION BY rid ORDER BY i) || ' ' || lead(x, 2) OVER (PARTITION BY rid ORDER BY i) s FROM p),
c AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) n FROM g WHERE s IS NOT NULL),
r AS (SELECT rid, count(DISTINCT i + k) n FROM c, (VALUES (0), (1), (2)) v(k) WHERE n > 1 GROUP BY rid),
f AS (SELECT a.rid, doc_id, lang, len(w)::BIGINT n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT n_dup_lines, coalesce(r.n, 0)::BIGINT n_repeat_words, len(l) n_lines,
        len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) n_ellipsis,
        len(list_filter(l, lambda x: regexp_matches(x, '^\s*[-*•]'))) n_bullets,
        len(list_filter(list_distinct(w), lambda x: list_contains([{_STOP}], x))) stop_words,
        len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) n_alpha
      FROM a LEFT JOIN r USING (rid)),
v AS (SELECT *, n_words < {quality.BASE_LEAST_WORDS} OR 100 * n_repeat_words > {quality.BASE_MOST_REPEATED} * n_words base_failed FROM f),
judged AS (SELECT *, NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 14.0 AND n_symbols / n_words <= 0.1
        AND (coalesce(lang, '') NOT IN ('en', 'fr', 'de', 'es') OR stop_words >= 2) AND n_dup_lines / n_lines <= 0.5
        AND n_ellipsis / n_lines <= 0.3 AND n_bullets / n_lines <= 0.9 AND n_alpha / n_words >= 0.6 kept FROM v)
"""



def _chat(source: str, made: str = "") -> str:
    """Replies in the conversations of a relation."""
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH RECURSIVE {made}
c AS (SELECT row_number() OVER () rid, * FROM {source}),
x AS (SELECT rid, conv_id, turn, string_split(text, chr(10)) lines FROM c WHERE text IS NOT NULL),
y AS (SELECT rid, conv_id, turn, list_transform(lines, lambda l: {{'lev': length(regexp_replace(regexp_extract(l, '^[ \t]*>[> \t]*'), '[^>]', '', 'g')), 't': regexp_replace(l, '^[ \t]*>[> \t]*', '')}}) ls FROM x),
z AS (SELECT rid, conv_id, turn, ls, unnest(range(list_max(list_transform(ls, lambda l: l.lev)) + 1)) lev FROM y),
b AS (SELECT rid, conv_id, turn, lev, unnest(string_split_regex(array_to_string(list_transform(ls, lambda l: CASE WHEN l.lev = lev THEN l.t ELSE '' END), chr(10)), '\n[\x20\x09-\x0D]*\n')) p FROM z),
q AS (SELECT rid, conv_id, turn, lev, unnest(string_split(regexp_replace(p, '([.!?])[\x20\x09-\x0D]+', '\1' || chr(1), 'g'), chr(1))) p FROM b
      UNION ALL SELECT rid, conv_id, turn, lev, unnest(list_transform(list_filter(ls, lambda l: l.lev = lev), lambda l: l.t)) FROM z),
n AS (SELECT DISTINCT rid, conv_id, turn, lev, trim(regexp_replace({low.format('p')}, '[\x20\x09-\x0D]+', ' ', 'g')) p FROM q),
o AS (SELECT conv_id, p, min(turn) origin FROM n WHERE lev = 0 AND p <> '' GROUP BY ALL),
v AS (SELECT n.conv_id, n.turn, n.lev, o.origin, sum(length(n.p)) size FROM n JOIN o USING (conv_id, p) WHERE lev > 0 AND origin < n.turn GROUP BY ALL),
r AS (SELECT conv_id, turn, max((-lev, size, origin)) best FROM v GROUP BY ALL),
m AS (SELECT DISTINCT c.conv_id, c.turn, best[3] parent, (-best[1])::INTEGER parent_level FROM c LEFT JOIN r USING (conv_id, turn)),
t AS (SELECT conv_id, turn, turn root_turn, 0::BIGINT depth FROM m WHERE parent IS NULL
      UNION ALL SELECT m.conv_id, m.turn, t.root_turn, t.depth + 1 FROM m JOIN t ON m.conv_id = t.conv_id AND m.parent = t.turn)
SELECT c.conv_id, c.turn, c.role, array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(x, '^[ \t]*>')), chr(10)) AS text,
       m.parent parent_turn, m.parent_level, t.root_turn, t.depth FROM c JOIN m USING (conv_id, turn) JOIN t USING (conv_id, turn)"""


ORACLES: dict[str, str] = {
    "op2_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT payload_bytes, sha1(coalesce(html, '')) payload_digest FROM pages),
l AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END last FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN last > page_id THEN 'revisit' ELSE 'response' END record_type,
       CASE WHEN last > page_id THEN last END refers_to FROM l""",
    "op4_quality_rules": f"""
WITH docs AS (SELECT row_number() OVER () rid, doc_id, lang, coalesce(text, '') t FROM documents), {QUALITY_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged""",
    "op6_line_dedup": rf"""
WITH d AS (SELECT row_number() OVER () rid, doc_id, text FROM documents),
l AS (SELECT rid, doc_id, unnest(string_split(text, chr(10))) x, unnest(range(len(string_split(text, chr(10))))) i FROM d),
s AS (SELECT rid, doc_id, i, regexp_replace(regexp_replace(x, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') x FROM l),
c AS (SELECT *, len(string_split_regex(x, '[\x20\x09-\x0D]+')) n FROM s WHERE x <> ''),
t AS (SELECT *, sum(n) OVER (PARTITION BY rid ORDER BY i) upto FROM c),
e AS (SELECT a.rid, a.doc_id, a.i, min(b.i) till FROM t a JOIN t b ON a.rid = b.rid AND b.i >= a.i AND b.upto - a.upto + a.n >= {linededup.LEAST_WORDS} GROUP BY ALL
      UNION SELECT b.rid, b.doc_id, max(a.i), b.i FROM t a JOIN t b ON a.rid = b.rid AND b.i >= a.i AND b.upto - a.upto + a.n >= {linededup.LEAST_WORDS} GROUP BY ALL),
w AS (SELECT e.rid, e.doc_id, e.i, e.till, string_agg(t.x, chr(10) ORDER BY t.i) k FROM e JOIN t ON e.rid = t.rid AND t.i BETWEEN e.i AND e.till GROUP BY ALL),
f AS (SELECT *, first_value((rid, i, till)) OVER (PARTITION BY k ORDER BY doc_id, i) o FROM w),
g AS (SELECT rid, CASE WHEN rid = o[1] THEN greatest(i, o[3] + 1) ELSE i END i, till FROM f WHERE (rid, i) <> (o[1], o[2])),
gone AS (SELECT DISTINCT rid, unnest(range(i, till + 1)) i FROM g),
kept AS (SELECT l.rid, string_agg(l.x, chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL) text, count(gone.i) n FROM l LEFT JOIN gone ON l.rid = gone.rid AND l.i = gone.i GROUP BY 1)
SELECT doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text, coalesce(n, 0)::BIGINT removed_lines FROM d LEFT JOIN kept USING (rid)""",
    "op10_topk": f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) b FROM embeddings WHERE len(embedding) > 0),
p AS (SELECT q.vec_id query_id, e.vec_id neighbour_id, len(list_filter(list_zip(q.b, e.b), lambda z: z[1] <> z[2]))::INTEGER distance
      FROM e q JOIN e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id)::INTEGER rank, neighbour_id, distance FROM p
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) <= {topk.K}""",
    "op9_chat_format": _chat("conversations"),
    "chat_quotations": _chat("quoting", r"""
said AS (SELECT conv_id, turn, min(text) said FROM conversations GROUP BY ALL),
rule AS (SELECT *, (conv_id + turn) % 3 r FROM conversations),
flat AS (SELECT rule.* EXCLUDE (r), regexp_replace(a.said, '[\x20\x09-\x0D]+', ' ', 'g') one, regexp_replace(b.said, '[\x20\x09-\x0D]+', ' ', 'g') two FROM rule
  LEFT JOIN said a ON a.conv_id = rule.conv_id AND a.turn = CASE WHEN r = 0 THEN rule.turn - 1 WHEN r = 1 AND rule.turn > 0 THEN 0 END
  LEFT JOIN said b ON b.conv_id = rule.conv_id AND b.turn = CASE WHEN r = 0 THEN rule.turn - 2 END),
quoting AS (SELECT * EXCLUDE (one, two) REPLACE (CASE WHEN text IS NOT NULL THEN concat_ws(chr(10), '> > ' || regexp_replace(two, '(.{24,}?) ', '\1' || chr(10) || '> > ', 'g'),
  '> ' || regexp_replace(one, '(.{24,}?) ', '\1' || chr(10) || '> ', 'g'), text) END AS text) FROM flat),"""),
}
