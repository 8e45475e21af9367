"""Mixing sources to target weights, by Pfair scheduling of blocks.

A source's rows, in the order of a seeded hash, are cut into blocks. With w, the
source's weight over the sum of the weights, its k-th block (from 0) may not run before
slot floor(k / w) and must have run by ceil((k + 1) / w). In each slot the released block
with the earliest deadline runs (of ties, the source listed first). After any number of
slots of a phase each source then is less than one block from its target. Weights are
taken exactly, as they are written in decimals. The schedule repeats after as many slots
as their common denominator, so no more than one round of it is worked out, from the
weights and the sources' counts alone; rows find their slots in it by a projection. Of
sources with more than LONG slots in a round each block is listed, LIST_BLOCKS to a row.

When a source has no blocks left, a new phase begins with the weights of those that
have; so all rows are placed. Only if a resolution is given, weights become shares of it by
largest remainders, each at least one. Sources without a weight, and null, share
other_weight as one source, named null. Rows with a null id are told apart by their other columns, but for
maps and variants. Ties in the hash go by id; rows with one id and
source may take each other's places. Texts are not looked at, however long. An empty table stays empty. Other columns pass through,
whatever their names; added ones (slot, place, phase) replace any of the same name.
"""

from __future__ import annotations

import heapq
import json
import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewake.llm.common import packed, unpacked

BLOCK_ROWS = 64
#: Slots of a source in a round, up to which the round is kept and not its blocks' list; blocks to a row of the list.
LONG = 256
LIST_BLOCKS = 64
#: All sources' rows to one of the parts in which each is ranked, and the fewest parts.
PART_ROWS = 10_000
LEAST_PARTS = 64


def shares(weights: list[float], resolution: int) -> list[int]:
    """Whole numbers in proportion to the weights that add up to the resolution, each at least 1."""
    if len(weights) > resolution:
        raise ValueError("more sources than shares")
    total = sum(map(Fraction, weights))
    exact = [Fraction(w) / total * resolution for w in weights]
    out = [max(1, int(x)) for x in exact]
    by_rest = sorted(range(len(out)), key=lambda i: (out[i] - exact[i], i))
    while sum(out) != resolution:
        if sum(out) < resolution:
            i = min(by_rest, key=lambda i: (out[i] - exact[i], i))
            out[i] += 1
        else:
            i = max((i for i in by_rest if out[i] > 1), key=lambda i: (out[i] - exact[i], -i))
            out[i] -= 1
    return out


def exact_shares(weights: list[float]) -> list[int]:
    """The least whole numbers in exact proportion to the weights as written in decimals."""
    exact = [Fraction(str(w)) for w in weights]
    whole = [int(w * math.lcm(*(x.denominator for x in exact))) for w in exact]
    return [n // math.gcd(*whole) for n in whole]


def one_round(parts: list[int], left: list[int] | None = None) -> list[int]:
    """Which source runs in each slot of a round: earliest deadline first among the released blocks. Ends early when a source has run what it has left."""
    slots = sum(parts)
    done, out = [0] * len(parts), []
    waiting, ready = [(0, i) for i in range(len(parts))], []
    for t in range(slots):
        while waiting and waiting[0][0] <= t:
            i = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(done[i] + 1) * slots // parts[i]), i))
        i = heapq.heappop(ready)[1]
        done[i] += 1
        out.append(i)
        if left and done[i] == left[i]:
            break
        if done[i] < parts[i]:
            heapq.heappush(waiting, (done[i] * slots // parts[i], i))
    return out


def schedule(blocks: list[int], weights: list[float], resolution: int | None = None) -> list[dict]:
    """Rows (source, phase, from_block, to_block, start, share, slots): which blocks of a source run in a phase, and where in a round its blocks come."""
    left, begun, start, rows, phase = list(blocks), [0] * len(blocks), 0, [], 0
    while live := [i for i, n in enumerate(left) if n]:
        own_weights = [weights[i] for i in live]
        parts = exact_shares(own_weights) if resolution is None else shares(own_weights, max(resolution, len(live)))
        turn = one_round(parts, [left[i] for i in live])
        own: list[list[int]] = [[] for _ in live]
        for t, j in enumerate(turn):
            own[j].append(t)
        if any(len(own[j]) == left[i] for j, i in enumerate(live)):
            length = len(turn)  # ends in the first round
        else:
            length = min((left[i] - 1) // parts[j] * len(turn) + own[j][(left[i] - 1) % parts[j]] + 1 for j, i in enumerate(live))
        for j, i in enumerate(live):
            ran = length // len(turn) * len(own[j]) + sum(t < length % len(turn) for t in own[j])
            if ran:
                rows.append({"source": i, "phase": phase, "from_block": begun[i], "to_block": begun[i] + ran, "start": start, "share": len(own[j]), "slots": own[j], "round": len(turn)})
            begun[i] += ran
            left[i] -= ran
        start += length
        phase += 1
    return rows


def listed(rows: list[dict]) -> list[dict]:
    """Rows (source, part, phase, from_block, slots) of the schedule's rows: the slots of the blocks from from_block on in part from_block // LIST_BLOCKS."""
    out = []
    for r in rows:
        at = r["from_block"]
        while at < r["to_block"]:
            end = min((at // LIST_BLOCKS + 1) * LIST_BLOCKS, r["to_block"])
            ks = range(at - r["from_block"], end - r["from_block"])
            slots = [r["start"] + k // r["share"] * r["round"] + r["slots"][k % r["share"]] for k in ks]
            out.append({"source": r["source"], "part": at // LIST_BLOCKS, "phase": r["phase"], "from_block": at, "to_block": end, "slots": slots})
            at = end
    return out


def mix_sources(df: DataFrame, weights: dict[str, float], id_col: str = "doc_id", source: str = "source", other_weight: float = 0.01, block_rows: int = BLOCK_ROWS, resolution: int | None = None, seed: int = 0) -> DataFrame:
    """df with slot, place (within the slot's block) and phase; rows in the order of (slot, place) are the mixture."""
    names = list(weights)
    index = F.coalesce(F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])[F.col(source)] if names else F.lit(None), F.lit(len(names)))
    others = [F.col(f"`{f.name}`") for f in df.schema if f.dataType.typeName() not in ("map", "variant") and f.name.lower() != id_col.lower()]
    apart = F.when(F.col(id_col).isNull(), F.xxhash64(*others)) if others else F.lit(None).cast("long")
    rows = packed(df, index.alias("_source"), F.xxhash64(F.lit(seed), F.col(id_col), apart).alias("_hash"), F.col(id_col).alias("_id"))
    counts = {r["_source"]: r["n"] for r in rows.groupBy("_source").agg(F.count("*").alias("n")).collect()}  # one for each weight, and one
    total = sum(counts.values())
    order = [i for i in range(len(names) + 1) if (i == len(names) and other_weight > 0) or (i < len(names) and weights[names[i]] > 0) or not counts.get(i)]
    if unlisted := set(counts) - set(order):
        raise ValueError(f"sources without a weight over 0: {sorted(unlisted)}")
    table = schedule([-(-counts.get(i, 0) // block_rows) for i in range(len(names) + 1)], [*weights.values(), other_weight], resolution)

    parts = max(LEAST_PARTS, -(-total // PART_ROWS))
    rows = rows.withColumn("_part", F.shiftrightunsigned("_hash", 32) * parts / F.lit(1 << 32)).withColumn("_part", F.floor("_part").cast("long"))
    sizes = rows.groupBy("_source", "_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col("_source").alias("_s"), F.col("_part").alias("_p"), before.alias("_before"))
    # Hashes are unsigned in this order, as parts are.
    by = Window.partitionBy("_source", "_part").orderBy(F.shiftrightunsigned("_hash", 32), "_hash", "_id")
    rows = rows.withColumn("_rank", F.row_number().over(by) - 1)
    rows = rows.join(sizes, (F.col("_source") == F.col("_s")) & (F.col("_part") == F.col("_p"))).withColumn("_rank", F.col("_rank") + F.col("_before"))

    spark = df.sparkSession
    plan = lambda rows, shape: spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{shape}>>")))
    rounds = plan([r for r in table if len(r["slots"]) <= LONG], "source:int,phase:int,from_block:bigint,to_block:bigint,start:bigint,share:int,slots:array<int>,round:int")
    lists = listed([r for r in table if len(r["slots"]) > LONG])
    rows = rows.withColumn("_block", F.floor(F.col("_rank") / block_rows).cast("long"))
    inside = (F.col("_block") >= F.col("r.from_block")) & (F.col("_block") < F.col("r.to_block"))
    rows = rows.join(F.broadcast(rounds.select(F.col("source").alias("_of"), F.struct("*").alias("r"))), (F.col("_source") == F.col("_of")) & inside, "left")
    k = F.col("_block") - F.col("r.from_block")
    slot, phase = F.col("r.start") + F.floor(k / F.col("r.share")).cast("long") * F.col("r.round") + F.get("r.slots", (k % F.col("r.share")).cast("int")), F.col("r.phase")
    if lists:
        lists = plan(lists, "source:int,part:bigint,phase:int,from_block:bigint,to_block:bigint,slots:array<bigint>")
        inside = (F.col("_block") >= F.col("l.from_block")) & (F.col("_block") < F.col("l.to_block"))
        same = (F.col("_source") == F.col("_in")) & (F.floor(F.col("_block") / LIST_BLOCKS).cast("long") == F.col("_at"))
        rows = rows.join(F.broadcast(lists.select(F.col("source").alias("_in"), F.col("part").alias("_at"), F.struct("*").alias("l"))), same & inside, "left")
        slot, phase = F.coalesce(slot, F.get("l.slots", (F.col("_block") - F.col("l.from_block")).cast("int"))), F.coalesce(phase, "l.phase")
    return rows.select(*unpacked("slot", "place", "phase", columns=df.columns), slot.alias("slot"), (F.col("_rank") % block_rows).cast("int").alias("place"), phase.alias("phase"))


def in_order(mixed: DataFrame) -> DataFrame:
    """mixed, laid out so that its files, read one after the other by name, are the mixture. Adaptive execution joins small ones."""
    return mixed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place")
