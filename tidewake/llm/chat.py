"""Chat formatting: quotations are linked to the messages that they quote.

A line that begins with > signs (blanks between them allowed) is a quotation; their
number is its level, 0 for a message's own lines. Lines of one level that follow each other are a block, and a blank line ends
it. A block is reflowed into one line, so that it doesn't matter where a mailer broke it, and cut into
sentences. Each sentence, and each line as it stands, is a passage, normalised (ASCII lower case, white space collapsed) and
hashed. Its original is the first message of the same conversation that has it at level 0, if that is an earlier turn.

A message replies to the original of most characters of its passages at the lowest level that has any
(of ties, the latest). That is level 1 unless the direct parent is missing or was not found; deeper levels are
older text that the parent quoted itself, and then link the message to the nearest ancestor known. parent_level is the level of the link.
root_turn and depth follow the replies up, by pointer jumping, and rows in the order of (conv_id, root_turn, depth, turn)
are the conversations in reply order: each message comes after the one that it answers. text loses its quoted lines.

Keys that many rows may share (a passage, a message that everyone answers, a null conv_id) are dealt out by
attach(), and nothing is paired within a group: originals are first reduced to one for each passage. A message is
held by one task, however long. Null texts stay null and quote nothing, empty ones likewise; rows with a null
conv_id or turn neither quote nor are quoted. Rows that repeat a (conv_id, turn) get the same link. An
empty table stays empty. Other columns pass through, whatever their names; added ones (parent_turn, parent_level, root_turn,
depth) replace any of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.llm.common import ascii_lower, attach, discard, numbered, packed, spread, stored

QUOTED = r"^[ \t]*>[> \t]*"
WHITE_LINE = r"\n[\x20\x09-\x0D]*\n"
SENTENCE_END = r"(?<=[.!?])[\x20\x09-\x0D]+"


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, QUOTED, 0), r"[^>]", ""))


def passages_at(lines: Column, depth: Column) -> Column:
    """The distinct sentences of the blocks of one level, and its lines, with their level; other lines end a block."""
    own = F.transform(lines, lambda x: F.when(level(x) == depth, F.regexp_replace(x, QUOTED, "")).otherwise(F.lit("")))
    blocks = F.split(F.array_join(own, "\n"), WHITE_LINE)
    sentences = F.flatten(F.transform(blocks, lambda b: F.split(b, SENTENCE_END)))
    normal = F.transform(F.concat(sentences, own), lambda x: F.trim(F.regexp_replace(ascii_lower(x), r"[\x20\x09-\x0D]+", " ")))
    return F.transform(F.array_distinct(F.filter(normal, lambda x: x != "")), lambda x: F.struct(depth.alias("level"), x.alias("passage")))


def passages(df: DataFrame) -> DataFrame:
    """(conv_id, turn, level, hash, size) of the passages of df (conv_id, turn, text)."""
    lines = df.where("conv_id IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL").select("conv_id", "turn", F.split("text", "\n").alias("lines"))
    deepest = F.array_max(F.transform("lines", level))
    found = lines.select("conv_id", "turn", F.inline(F.flatten(F.transform(F.sequence(F.lit(0), deepest), lambda d: passages_at(F.col("lines"), d)))))
    return found.select("conv_id", "turn", "level", F.sha2(F.concat(F.col("conv_id").cast("string"), F.lit("\n"), "passage"), 256).alias("hash"), F.length("passage").alias("size"))


def quotations(df: DataFrame) -> DataFrame:
    """(conv_id, turn, level, size, origin): each quoted passage that is known, and the turn that it comes from."""
    all_of = stored(passages(df), "passages")
    quoted = all_of.where("level > 0")
    originals = all_of.where("level = 0").groupBy("hash").agg(F.min("turn").alias("origin"))
    asked = quoted.groupBy("hash").agg(F.count("*").alias("n"))
    known = originals.join(asked, "hash").select("hash", "origin", "n")
    out = attach(quoted, known, "hash", spread(F.col("conv_id"), F.col("turn")), quoted.count())
    return out.where("origin < turn").select("conv_id", "turn", "level", "size", "origin")


def replies(df: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, parent_level, root_turn, depth) of the messages that answer another. df: conv_id, turn, text."""
    votes = quotations(df).groupBy("conv_id", "turn", "level", "origin").agg(F.sum("size").alias("size"))
    best = F.max(F.struct((-F.col("level")).alias("less"), "size", "origin"))
    parents = votes.groupBy("conv_id", "turn").agg(best.alias("b")).select("conv_id", "turn", F.col("b.origin").alias("parent_turn"), (-F.col("b.less")).alias("parent_level"))
    jumps = stored(parents.withColumns({"up": F.col("parent_turn"), "depth": F.lit(1).cast("long")}), "replies")
    place = lambda turn: F.struct(F.col("conv_id"), F.col(turn).alias("turn"))
    while True:
        total = jumps.count()
        rows = jumps.withColumn("at", place("up"))
        asked = rows.groupBy("at").agg(F.count("*").alias("n"))
        above = jumps.select(place("turn").alias("at"), F.col("up").alias("next"), F.col("depth").alias("more")).join(asked, "at")
        joined = attach(rows, above, "at", spread(F.col("conv_id"), F.col("turn")), total)
        moved = F.col("next").isNotNull()
        old, jumps = jumps, stored(joined.select("conv_id", "turn", "parent_turn", "parent_level", F.coalesce("next", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), moved.alias("moved")), "replies")
        discard(old)
        if jumps.where("moved").isEmpty():
            return jumps.drop("moved").withColumnRenamed("up", "root_turn")


def without_quotes(text: Column) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.rlike(QUOTED)), "\n")


def reply_order(df: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """df with parent_turn, parent_level, root_turn, depth, and texts without quotations."""
    plain = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(text).alias("text"))
    key = F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), F.struct("conv_id", "turn"))
    rows = packed(df, F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(text).alias("text")).withColumn("key", key)
    found = replies(plain)
    many = rows.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"))
    links = found.select(F.struct("conv_id", "turn").alias("key"), "parent_turn", "parent_level", "root_turn", "depth").join(many, "key")
    out = attach(rows, links, "key", spread(F.col("text"), F.spark_partition_id()), df.count())
    added = ("parent_turn", "parent_level", "root_turn", "depth")
    rest = [without_quotes(F.col("text")).alias(c) if c == text else numbered(c, df.columns).alias(c) for c in df.columns if c.lower() not in added]
    return out.select(*rest, "parent_turn", "parent_level", F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0).cast("long")).alias("depth"))


def quoting(df: DataFrame, width: int = 24) -> DataFrame:
    """df (conv_id, turn, text and others) with quotations by a rule, for tables that have none.

    Of each three messages one quotes the turn before it and, at level 2 above that, the one before that; one quotes its
    conversation's turn 0; one quotes nothing. Quoted texts are broken into lines of a width of their own.
    """
    broken = lambda t, sign: F.concat(F.lit(sign), F.regexp_replace(F.regexp_replace(t, r"[\x20\x09-\x0D]+", " "), rf"(.{{{width},}}?) ", f"$1\n{sign}"))
    said = df.groupBy("conv_id", "turn").agg(F.min("text").alias("said"))
    rule = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(3))
    out = df.withColumns({"one": F.when(rule == 0, F.col("turn") - 1).when((rule == 1) & (F.col("turn") > 0), 0), "two": F.when(rule == 0, F.col("turn") - 2)})
    for name in ("one", "two"):
        side = said.select(F.col("conv_id").alias(f"{name}_conv"), F.col("turn").alias(f"{name}_turn"), F.col("said").alias(f"{name}_said"))
        out = out.join(side, (F.col("conv_id") == F.col(f"{name}_conv")) & (F.col(name) == F.col(f"{name}_turn")), "left")
    quote = F.concat_ws("\n", broken(F.col("two_said"), "> > "), broken(F.col("one_said"), "> "), F.col("text"))
    return out.select(*[F.when(F.col("text").isNotNull(), quote).alias("text") if c == "text" else F.col(c) for c in df.columns])
