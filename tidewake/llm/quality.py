"""Quality rules: a table of thresholds, compiled into one projection of ratios.

Everything is built-in functions over the row's own text, so a document never
leaves its task and nothing is shuffled. Null and empty texts have no words and
fail. Repeated rows are judged alike. A text is judged whole, by one task, however long; no rule sets a
longest length. An empty table stays empty. Other columns pass through, whatever their names, and the
columns that quality_features adds replace ones of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.llm.common import WHITE, packed, unpacked, words

#: Common function words of the languages that the stop-word rule covers.
STOP_WORDS = {
    "en": ["the", "be", "to", "of", "and", "that", "have", "with", "is", "in", "on", "for", "it", "as", "was", "by", "this", "are", "from", "at"],
    "fr": ["le", "la", "les", "de", "des", "et", "un", "une", "en", "que", "qui", "dans", "est", "pour", "par", "du", "au", "il", "elle", "sur"],
    "de": ["der", "die", "das", "und", "in", "zu", "den", "von", "mit", "ist", "des", "dem", "ein", "eine", "sich", "auf", "im", "nicht", "als", "auch"],
    "es": ["el", "la", "los", "las", "de", "que", "y", "en", "un", "una", "por", "con", "para", "se", "del", "es", "al", "lo", "como", "no"],
}


@dataclass(frozen=True)
class Rule:
    """A feature and the closed range that a good document has it in."""

    feature: str
    least: float | None = None
    most: float | None = None
    langs: tuple[str, ...] | None = None


#: Thresholds of the verdict.
RULES = (
    Rule("n_words", 50),
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbols_per_word", None, 0.1),
    Rule("stop_words", 2, None, tuple(STOP_WORDS)),
    Rule("dup_line_ratio", None, 0.5),
    Rule("ellipsis_line_ratio", None, 0.3),
    Rule("bullet_line_ratio", None, 0.9),
    Rule("alpha_word_ratio", 0.6, None),
)
#: The ratios alone, for filters that are to keep short texts, too: counts tell nothing of these.
RATIOS = (Rule("n_words", 1), *[r for r in RULES if r.feature not in ("n_words", "stop_words")])
BASE_LEAST_WORDS = 50
BASE_MOST_REPEATED = 50
#: Bits of a window's key that hold its place. A string has under 2**31 bytes, so under 2**30 words.
PLACE_BITS = 30
#: A word with a letter. It is tried at a word's start only and never steps back.
LETTER_WORD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]*+\p{L}"


def _without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def quality_features(df: DataFrame, text: str = "text", lang: str | None = "lang") -> DataFrame:
    """df with the counts and ratios that rules refer to.

    Words in repeated 3-word windows are found inside the row: window hashes
    carry their place in their low bits and are sorted as plain numbers, equal
    neighbours are candidates, and these are compared again as words, so that a
    shared hash cannot count.
    """
    own = {c.lower() for c in df.columns}
    mark = next("_" * i for i in range(1, 99) if not any(c.startswith("_" * i + "q_") for c in own))
    name = lambda c: f"{mark}q_{c}"  # noqa: E731 - no column of df has such a name
    t = F.coalesce(F.col(text), F.lit(""))
    place = (1 << PLACE_BITS) - 1
    stop = sorted({form for ws in STOP_WORDS.values() for w in ws for form in (w, w.capitalize())})
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.trim(x, F.lit(WHITE))) > 0)
    df = df.withColumns({name("words"): words(t), name("lines"): lines, "n_symbols": _without(t, "#*$%&|<>").cast("long"), "word_chars": (F.length(t) - _without(t, WHITE)).cast("long")})
    w, n = F.col(name("words")), F.size(name("words"))
    keys = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(F.lit(~place)).bitwiseOR(i.cast("long")))
    df = df.withColumns({
        "n_words": n.cast("long"),
        "n_lines": F.size(name("lines")).cast("long"),
        "n_dup_lines": (F.size(name("lines")) - F.size(F.array_distinct(name("lines")))).cast("long"),
        name("ellipsis"): F.size(F.filter(name("lines"), lambda x: x.rlike(r"(\.\.\.|…)\s*$"))),
        name("bullets"): F.size(F.filter(name("lines"), lambda x: x.rlike(r"^\s*[-*•]"))),
        "stop_words": F.size(F.array_intersect(w, F.array(*[F.lit(x) for x in stop]))).cast("long"),
        name("alpha"): F.regexp_count(F.col(text), F.lit(LETTER_WORD)),
        name("keys"): F.when(n >= 3, F.sort_array(keys)).otherwise(F.array().cast("array<bigint>")),
    })
    k = F.col(name("keys"))
    same = lambda a, b: F.shiftright(a, PLACE_BITS) == F.shiftright(b, PLACE_BITS)
    near = F.filter(k, lambda x, j: F.coalesce(same(x, F.get(k, j - 1)), F.lit(False)) | F.coalesce(same(x, F.get(k, j + 1)), F.lit(False)))
    near = F.transform(near, lambda x: x.bitwiseAND(F.lit(place)).cast("int"))
    df = df.withColumn(name("near"), F.sort_array(F.transform(near, lambda i: F.struct(F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"), i.alias("i")))))
    e = F.col(name("near"))
    equal = lambda x, y: F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))
    df = df.withColumn(name("at"), F.sort_array(F.transform(F.filter(e, lambda x, j: equal(x, F.get(e, j - 1)) | equal(x, F.get(e, j + 1))), lambda x: x["i"])))
    at = F.col(name("at"))
    gaps = F.aggregate(F.transform(at, lambda x, j: F.least(x - F.coalesce(F.get(at, j - 1), x - 3), F.lit(3))), F.lit(0), lambda a, b: a + b)
    per = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    df = df.withColumns({
        "n_repeat_words": F.when(F.size(at) > 0, F.lit(0) + gaps).otherwise(F.lit(0)).cast("long"),
        "mean_word_chars": per(F.col("word_chars"), F.col("n_words")),
        "symbols_per_word": per(F.col("n_symbols"), F.col("n_words")),
        "dup_line_ratio": per(F.col("n_dup_lines"), F.col("n_lines")),
        "ellipsis_line_ratio": per(F.col(name("ellipsis")), F.col("n_lines")),
        "bullet_line_ratio": per(F.col(name("bullets")), F.col("n_lines")),
        "alpha_word_ratio": per(F.coalesce(F.col(name("alpha")), F.lit(0)), F.col("n_words")),
    })
    return df.drop(name("words"), name("lines"), name("ellipsis"), name("bullets"), name("alpha"), name("keys"), name("near"), name("at"))


def verdict(rules: tuple[Rule, ...] = RULES, lang: str | None = "lang") -> Column:
    """One boolean of all rules; a rule for some languages leaves other rows alone."""
    out = F.lit(True)
    for r in rules:
        ok = F.lit(True)
        if r.least is not None:
            ok = ok & (F.col(r.feature) >= r.least)
        if r.most is not None:
            ok = ok & (F.col(r.feature) <= r.most)
        if r.langs is not None:
            ok = ok | ~F.coalesce(F.col(lang).isin(*r.langs), F.lit(False)) if lang else F.lit(True)
        out = out & ok
    return out


def quality_rules(df: DataFrame, text: str = "text", lang: str | None = "lang", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """df with its features, base_failed and kept."""
    df = quality_features(df, text, lang)
    failed = (F.col("n_words") < BASE_LEAST_WORDS) | (100 * F.col("n_repeat_words") > BASE_MOST_REPEATED * F.col("n_words"))
    return df.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(rules, lang))


def keep_good(df: DataFrame, text: str = "text", lang: str | None = "lang", rules: tuple[Rule, ...] = RULES, base: bool = True) -> DataFrame:
    """df's rows that the rules keep, as they are. base: whether texts of under BASE_LEAST_WORDS words go, too, whatever the rules; ones that repeat themselves always do.

    A filter on `kept` alone would be pushed below the projections, which writes their
    expressions out over and over inside each other. The row number is not the same from run
    to run, so the optimiser leaves the filter where it is.
    """
    judged = quality_features(packed(df, F.col(text).alias("text"), (F.col(lang) if lang else F.lit(None)).alias("lang")), "text")
    good = (100 * F.col("n_repeat_words") <= BASE_MOST_REPEATED * F.col("n_words")) & verdict(rules, "lang" if lang else None)
    judged = judged.select(*[F.col(f"_{i}_") for i in range(len(df.columns))], ((F.col("n_words") >= (BASE_LEAST_WORDS if base else 0)) & good).alias("kept"), F.monotonically_increasing_id().alias("row"))
    return judged.where("row >= 0 AND kept").select(*unpacked(columns=df.columns))
