"""SimHash near-duplicates: fingerprints, a trie self-join and components.

Fingerprints link at a small Hamming distance. The self-join walks a binary
trie of the distinct fingerprints, two nodes at a time: the pair of a node with
itself opens into (0,0), (1,1) and (0,1), a mixed pair into all four, each
adding one to the differing bits if the two go apart; a pair over the budget is
dropped with all below it.

To deal the walk out, four tries are built, each over the fingerprint rotated by
another quarter. Two fingerprints that differ in at most three bits agree on a
whole quarter, so in one of the tries they meet below the same node at depth 16,
and only pairs of such a node with itself start there. Nodes with more than a
HOT_PARTS-th of all fingerprints are opened further into pairs of nodes at depth
24, which then are dealt out separately. Inside a task the links found are
reduced to a spanning forest, so a dense group yields no more rows than it has
members; no link is lost to the components.

near_duplicates() links texts by one fingerprint of three-word shingles. keep_one() is for texts whose
five-word shingles have a Jaccard similarity of 0.8 or more. Such texts differ by 15 % of the
bits of a fingerprint of those shingles, too many for a trie, but in far fewer distinct words; so candidates are pairs that
in one of CODES fingerprints of distinct words agree on a quarter and differ in at most CODE_DISTANCE bits, found by the same tries, and a candidate
is a link if WIDE_BITS bits of a fingerprint of the shingles differ by no more than that similarity's share and one standard
error. Equal texts are one point from the start.

Null texts and texts without words have fingerprint zero and link like others.
Rows with a null id take part and have component_id as the others do; a component
with only null ids has a null one. Repeated rows get the same answer. A text is held by one task, however long;
its shingles are counted CHUNK at a time. An empty table gives an empty result. Any other
column is left alone, whatever its name.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm.common import attach, discard, key_of, mix, packed, slices, spread, stored, unpacked

SHINGLE = 3
SEED = 42
MAX_DISTANCE = 3
QUARTER = 16
#: Further bits by which a hot node is opened.
OPENED = 8
#: A node with more than one in so many fingerprints is hot, but none with fewer than LEAST_HOT.
NODE_PARTS = 1000
LEAST_HOT = 20_000
#: keep_one(): similarity and words of a shingle; fingerprints of distinct words; bits of the shingles' fingerprint.
SIMILARITY = 0.8
WORDS = 5
CODES = 6
CODE_DISTANCE = 5
WIDE_BITS = 512
BYTES_AT_ONCE = 4_000_000
#: Node pairs that are opened at a time.
PAIRS_AT_ONCE = 1 << 20
#: Fingerprints, four rows each, for a task of the walk.
ROWS_PER_TASK = 250_000
CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text in UTF-8."""
    from xxhash import xxh64_intdigest

    w = (text or b"").lower().split()
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(shingle)), strict=False)) if len(w) >= shingle else iter([b" ".join(w)])
    n = max(len(w) - shingle + 1, 1)
    counts = np.zeros(64, np.int64)
    hashes = map(xxh64_intdigest, grams, repeat(SEED))
    for at in range(0, n, CHUNK):
        a = np.fromiter(hashes, np.uint64, min(CHUNK, n - at))
        counts += np.unpackbits(a.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint as a signed 64-bit number."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(x.as_py(), shingle) for x in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=[id_col, "fp"])

    return df.select(F.col(id_col), F.col(text).cast("binary").alias("_t")).mapInArrow(run, f"`{id_col}` {kind}, fp bigint")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Forest:
    """Components of numbered points, joined by arrays of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            differ = x != y
            if not differ.any():
                return
            x, y = x[differ], y[differ]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def dense(roots: np.ndarray, a: np.ndarray, b: np.ndarray | None, linked: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Links among the points a, or between those of a and b, that join components. Each point is held only against those not yet in its component."""
    own = b is None
    points = a if own else np.concatenate([a, b])
    label, found = roots[points].copy(), []
    for i in range(len(a)):
        begin = i + 1 if own else len(a)
        js = begin + np.flatnonzero(label[begin:] != label[i])
        if not len(js):
            if (label == label[0]).all():
                break
            continue
        hit = js[linked(np.full(len(js), points[i]), points[js])]
        found += [(int(points[i]), int(points[j])) for j in hit]
        label[np.isin(label, label[hit])] = label[i]
    return found


def walk(x: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]], depth: int, budget: int, forest: Forest, verified: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> None:
    """Opens node pairs over x, sorted within each node, and joins what links.

    A node is a range of x whose members agree on the first depth bits. pairs:
    stacks of (from a, to a, from b, to b, differing bits); a pair with a == b is a
    node with itself. verified: what else a link needs.
    """
    if verified is None:
        verified = lambda p, q: np.ones(len(p), bool)
    todo = [(depth, p) for p in pairs]
    ones: dict[int, np.ndarray] = {}
    while todo:
        d, (a0, a1, b0, b1, bits) = todo.pop()
        if len(a0) > PAIRS_AT_ONCE:
            half = len(a0) // 2
            todo += [(d, tuple(v[:half] for v in (a0, a1, b0, b1, bits))), (d, tuple(v[half:] for v in (a0, a1, b0, b1, bits)))]
            continue
        keep = (a1 > a0) & (b1 > b0) & (bits <= budget) & ~((a0 == b0) & (a1 - a0 == 1))
        a0, a1, b0, b1, bits = (v[keep] for v in (a0, a1, b0, b1, bits))
        if not len(a0):
            continue
        leaf = (a1 - a0 == 1) & (b1 - b0 == 1)
        if leaf.any():
            p, q = a0[leaf], b0[leaf]
            near = (forest.root[p] != forest.root[q]) & (distance(x[p], x[q]) <= budget)
            p, q = p[near], q[near]
            near = verified(p, q)
            forest.join(p[near], q[near])
            a0, a1, b0, b1, bits = (v[~leaf] for v in (a0, a1, b0, b1, bits))
        if not len(a0):
            continue
        if d == 64:  # points with equal fingerprints
            own = a0 == b0
            for some in (own, ~own):
                found = [x for i in np.flatnonzero(some) for x in dense(forest.root, np.arange(a0[i], a1[i]), None if own[i] else np.arange(b0[i], b1[i]), verified)]
                if found:
                    forest.join(*np.array(found, np.int64).T)
            continue
        if d not in ones:
            ones[d] = np.concatenate([[0], np.cumsum((x >> np.uint64(63 - d)) & np.uint64(1), dtype=np.int64)])
        c = ones[d]
        am, bm = a1 - (c[a1] - c[a0]), b1 - (c[b1] - c[b0])
        own = a0 == b0
        other = ~own
        cat = lambda *v: np.concatenate(v)
        todo.append((d + 1, (
            cat(a0, am, a0, am[other]),
            cat(am, a1, am, a1[other]),
            cat(b0, bm, bm, b0[other]),
            cat(bm, b1, b1, bm[other]),
            cat(bits, bits, bits + 1, bits[other] + 1),
        )))


def _rotated(fp: np.ndarray, turn: np.ndarray) -> np.ndarray:
    by = (turn * QUARTER).astype(np.uint64)
    return np.where(by == 0, fp, (fp << by) | (fp >> ((np.uint64(64) - by) % np.uint64(64))))


def _links_of(keys: np.ndarray, turn: np.ndarray, fp: np.ndarray, opened: np.ndarray, other: np.ndarray, budget: int, wide: np.ndarray | None = None, most: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Places of spanning links of whole groups; keys: a number for each group. opened: -1 or the node at depth 24 that is paired with other. wide: rows of further bits, of which at most so many may differ."""
    x = _rotated(fp, turn)
    order = np.lexsort((x, keys))
    keys, x, opened, other = keys[order], x[order], opened[order], other[order]
    if wide is not None:
        wide = wide[order]
    verified = None if wide is None else lambda p, q: np.bitwise_count(wide[p] ^ wide[q]).sum(axis=1, dtype=np.int64) <= most
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(keys))
    forest, zero = Forest(len(x)), np.zeros(len(starts), np.int64)
    plain = opened[starts] < 0 if len(starts) else np.zeros(0, bool)
    walk(x, [(starts[plain], ends[plain], starts[plain], ends[plain], zero[plain])], QUARTER, budget, forest, verified)
    starts, ends = starts[~plain], ends[~plain]
    if len(starts):
        lower = np.concatenate([[0], np.cumsum(((x >> np.uint64(64 - QUARTER - OPENED)) & np.uint64((1 << OPENED) - 1)).astype(np.int64) == opened)])
        mids = starts + lower[ends] - lower[starts]
        same = opened[starts] == other[starts]
        bits = np.bitwise_count((opened[starts] ^ other[starts]).astype(np.uint64)).astype(np.int64)
        second = np.where(same, starts, mids)
        walk(x, [(starts, np.where(same, ends, mids), second, ends, bits)], QUARTER + OPENED, budget, forest, verified)
    child = np.flatnonzero(forest.root != np.arange(len(x)))
    return order[child], order[forest.root[child]]


def links(points: DataFrame, total: int, budget: int = MAX_DISTANCE, least_hot: int = LEAST_HOT, most: int = 0) -> DataFrame:
    """(a, b) of spanning forests of the links between points (node, code, fp, wide).

    Points link if fingerprints of one code number agree on a quarter, as all do that differ in three bits or fewer, and differ in at most
    budget bits, and if, unless it is null, wide differs in at most so many. total: how many points there are, at least.
    """
    turned = points.select("node", "code", "fp", "wide", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("turn"))
    # Rotated by turn quarters, a fingerprint begins with this quarter, and then has the next.
    quarter = lambda k: F.shiftrightunsigned("fp", 64 - QUARTER * (k % 4 + 1)).bitwiseAND(F.lit((1 << QUARTER) - 1))
    of_turn = lambda further: F.when(F.col("turn") == 0, quarter(further)).when(F.col("turn") == 1, quarter(1 + further)).when(F.col("turn") == 2, quarter(2 + further)).otherwise(quarter(3 + further))
    first, after = of_turn(0), of_turn(1)
    turned = turned.withColumn("quarter", first).withColumn("half", F.shiftright(after, QUARTER - OPENED).cast("int"))
    place = ["code", "turn", "quarter"]
    counts = turned.groupBy(*place).agg(F.count("*").alias("n"))
    bound = max(4 * total // NODE_PARTS, least_hot)  # so there are at most NODE_PARTS hot nodes
    hot = counts.where(F.col("n") > bound).select(*place, F.lit(True).alias("hot"))
    turned = turned.join(F.broadcast(hot), place, "left")
    near = [m for m in range(1 << OPENED) if bin(m).count("1") <= budget]
    halves = F.when(F.col("hot"), F.transform(F.array(*[F.lit(m) for m in near]), lambda m: F.col("half").bitwiseXOR(m))).otherwise(F.array(F.lit(-1)))
    dealt = turned.select("node", "fp", "wide", *place, "half", F.explode(halves).alias("with"))
    own = F.when(F.col("with") < 0, F.lit(-1))
    dealt = dealt.select("node", "fp", "wide", *place, own.otherwise(F.least("half", "with")).alias("opened"), own.otherwise(F.greatest("half", "with")).alias("other"))
    tasks = max(8, -(-4 * total // ROWS_PER_TASK))
    dealt = dealt.repartition(tasks, *place, "opened", "other")
    kind = points.schema["node"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (all_of := [b for b in batches if b.num_rows]):
            return
        t = pa.Table.from_batches(all_of)
        fp = t.column("fp").to_numpy().view(np.uint64)
        code, turn, quarter, opened, other = (t.column(c).to_numpy().astype(np.int64) for c in (*place, "opened", "other"))
        keys = (((code << 2 | turn) << QUARTER | quarter) << (OPENED + 1) | (opened + 1)) << (OPENED + 1) | (other + 1)
        wide = None
        if not t.column("wide").null_count:
            wide = np.frombuffer(b"".join(t.column("wide").to_pylist()), np.uint64).reshape(len(fp), -1)
        a, b = _links_of(keys, turn, fp, opened, other, budget, wide, most)
        node = t.column("node").combine_chunks()
        yield pa.RecordBatch.from_arrays([node.take(pa.array(a)), node.take(pa.array(b))], names=["a", "b"])

    return dealt.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for each node of the undirected links (a, b); root: the component's smallest node.

    Large-star and small-star steps in turn, until nothing changes. Each step
    leaves at most as many links as there were; each is written to the shared folder.
    """
    edges = stored(pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    digest = lambda e: tuple(e.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first())
    seen = digest(edges)
    while seen[0]:
        total = seen[0]
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("a", "m"))
        large = attach(both, least, "a", spread(F.col("b")), 2 * total).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = attach(large, least, "a", spread(F.col("b")), total).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        old, edges = edges, stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = digest(edges)
        discard(old)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, budget: int = MAX_DISTANCE, least_hot: int = LEAST_HOT) -> DataFrame:
    """(id, fp, component_id) for each row: the smallest id that links reach, its own included."""
    if not 0 <= budget <= 3:
        raise ValueError("four quarters cover at most three differing bits")
    rows = stored(fingerprints(df, id_col, text, shingle), "fingerprints")
    total = rows.count()
    reps = rows.groupBy("fp").agg(F.min(id_col).alias("least"), F.count("*").alias("n"))
    points = reps.select(F.col("fp").alias("node"), F.lit(0).alias("code"), "fp", F.lit(None).cast("binary").alias("wide"))
    roots = components(links(points, total, budget, least_hot))
    reps = stored(reps.join(roots, reps["fp"] == roots["node"], "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root")), "classes")
    ids = reps.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    classes = attach(reps, ids, "root", spread(F.col("fp")), total).select("fp", "component_id", "n")
    return attach(rows, classes, "fp", spread(F.col(id_col)), total)


def _bits_over_half(hashes: np.ndarray, longs: int) -> np.ndarray:
    """For each of so many 64-bit fingerprints, the bits that are set in over half of the hashes' mixtures."""
    counts = np.zeros(64 * longs, np.int64)
    turns = np.arange(1, longs + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(hashes), CHUNK):
        some = mix(hashes[at : at + CHUNK, None] + turns)
        counts += np.unpackbits(some.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)


def profile(text: bytes | None, hash_of: dict[bytes, int], shingle: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """CODES fingerprints of a text's distinct words, and WIDE_BITS bits of its distinct shingles."""
    w = np.fromiter(map(hash_of.__getitem__, (text or b"").lower().split()), np.uint64)
    if not len(w):
        return np.zeros(CODES, np.uint64), np.zeros(WIDE_BITS // 64, np.uint64)
    n, grams = max(len(w) - shingle + 1, 1), np.zeros(1, np.uint64)
    for i in range(min(shingle, len(w))):
        grams = mix(grams + w[i : i + n])
    return _bits_over_half(np.unique(w), CODES), _bits_over_half(np.unique(grams), WIDE_BITS // 64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        self[word] = h = xxh64_intdigest(word, SEED)
        return h


def profiles(docs: DataFrame, shingle: int = WORDS) -> DataFrame:
    """(node, key, codes, wide) of docs (key, t); node: 128 bits of the text's hash."""
    kind = docs.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        hash_of = WordHashes()
        for b in slices(batches, "t", BYTES_AT_ONCE):
            texts = b.column("t").to_pylist()
            found = [profile(t, hash_of, shingle) for t in texts]
            if len(hash_of) > 1 << 18:
                hash_of.clear()
            codes = pa.array([c.view(np.int64) for c, _ in found], pa.list_(pa.int64()))
            # Texts without words are one point, as are equal ones.
            nodes = [xxh3_128_digest(t) if t and t.strip() else b"" for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), b.column("key"), codes, pa.array([v.tobytes() for _, v in found], pa.binary())], names=["node", "key", "codes", "wide"])

    return docs.mapInArrow(run, f"node binary, key {kind}, codes array<bigint>, wide binary")


def most_differing(similarity: float = SIMILARITY, bits: int = WIDE_BITS) -> int:
    """Bits that sets of a Jaccard similarity differ in, on average, and one standard error."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(bits * share + math.sqrt(bits * share * (1 - share)))


def similar(df: DataFrame, id_col: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, shingle: int = WORDS, budget: int = CODE_DISTANCE) -> DataFrame:
    """(node, key, root) for each distinct text: its smallest key (null ids last), and its group."""
    docs = df.select(key_of(F.col(id_col), F.col(text)).alias("key"), F.col(text).cast("binary").alias("t"))
    each = profiles(docs, shingle).groupBy("node").agg(F.min("key").alias("key"), F.first("codes").alias("codes"), F.first("wide").alias("wide"))
    each = stored(each, "profiles")
    points = each.select("node", F.posexplode("codes").alias("code", "fp"), "wide")
    total = each.count() * CODES
    roots = components(links(points, total, budget, most=most_differing(similarity)))
    return each.select("node", "key").join(roots, "node", "left").select("node", "key", F.coalesce("root", "node").alias("root"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """df with one row of each group of similar texts: that with the smallest id, null coming last; of texts that share this id, that with the least hash; of equal rows, any."""
    keep = similar(df, id_col, text, similarity).groupBy("root").agg(F.min("key").alias("key")).select(F.col("key").alias("keep")).distinct()
    rows = packed(df, key_of(F.col(id_col), F.col(text)).alias("key")).dropDuplicates(["key"])
    return rows.join(keep, F.col("key") == F.col("keep"), "left_semi").select(*unpacked(columns=df.columns))


def hex_fingerprint() -> F.Column:
    return F.lpad(F.lower(F.hex("fp")), 16, "0")
