"""Language-model scoring with a log-frequency Bloom filter.

Training counts every word and every pair of neighbouring words (a text's end is
a token, and stands before its first word too). A count c is stored as its level
on a logarithmic scale: the n-gram is put into the filter once for each level from
1 to its own, each level a membership test. To read it, levels are probed until one is missing.

P(w | v) = (c(v, w) + MU * P(w)) / (c(v) + MU), P(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1)),
with c(v, w), c(v) and c(w) from the filter, c(v, w) at most c(v).

A filter that keeps every n-gram grows with the corpus, so it has no bound that would
let it be broadcast. It is cut into segments by the n-grams' hashes, the more of them
the more n-grams there are, and probes are sent to their segment instead:

1. Texts are cut into groups of GROUP_BYTES. A group is written as one row: the hashes of
   its distinct words and each text's words as numbers into them.
2. From that row the group's distinct n-grams go to their segments, with their counts in
   training rows. A segment's task sums the counts, makes its filter, as large as its
   entries need (ENTRY_BITS each, so no level of no count is left out), and answers each group's
   n-grams from it. It also answers the exact counts of words, told apart by 96 bits of hash.
3. A group's row meets its answers and is scored.

So a word or pair goes over the network once for each group that has it, however common it
is; nothing that grows with the corpus reaches the driver or is broadcast. A text
longer than a group is cut at white space and its parts are summed.

A null text has no words, only its end; an empty one likewise; with no training rows every
count is 0, and an empty table gives an empty result. Every row gets its own result, repeated ones equal
results. Rows with a null id count as held in if held_out is null for them. Other columns are not needed and
not returned, so none can clash.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.llm.common import mix, stored

#: Weight of P(w), in tokens; of 0.5 to 200 the one with the best held-out likelihood on sf0.1.
MU = 200.0
#: Levels: the k-th begins at the k-th of these counts.
BASE = 1.5
BLOCK_BITS = 512
PROBES = 4
#: Bits of the filter for each n-gram and level.
ENTRY_BITS = 12
#: Bits of an n-gram's hash.
GRAM_BITS = 48
GRAM_BYTES = 6
#: Bytes of text to a group; n-grams that groups send to a segment, about; groups that are scored by a task, about.
GROUP_BYTES = 4_500_000
SEGMENT_GRAMS = 1 << 20
TASK_GROUPS = 4
_M = np.uint64(0x9E3779B97F4A7C15)
#: Hash of the end token, whose second part is zero.
_END = np.uint64(0x5851F42D4C957F2D)
WHITE_BYTE = re.compile(rb"[\x20\x09-\x0D]")


def level_starts(most: int = 1 << 60) -> np.ndarray:
    out, x = [1], 1.0
    while out[-1] < most:
        x *= BASE
        if math.ceil(x) > out[-1]:
            out.append(math.ceil(x))
    return np.array(out, np.int64)


STARTS = level_starts()
#: What a level stands for: the mean of its counts; level 0 is a count of 0.
VALUES = np.concatenate([[0.0], (STARTS[:-1] + STARTS[1:] - 1) / 2])


def unigram(h: np.ndarray) -> np.ndarray:
    return mix(h ^ _M) >> np.uint64(64 - GRAM_BITS)


def bigram(before: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    """Of the hash of the word before, and mix() of the word's."""
    return mix(before * np.uint64(3) + mixed) >> np.uint64(64 - GRAM_BITS)


def segment_of(grams: np.ndarray, segments: int) -> np.ndarray:
    return (((grams >> np.uint64(GRAM_BITS - 32)) * np.uint64(segments)) >> np.uint64(32)).astype(np.int64)


def places(grams: np.ndarray, level: int, blocks: int) -> np.ndarray:
    """PROBES bits of each n-gram, all in one block, for a level."""
    h = mix(grams * _M + np.uint64(1))
    block = (h % np.uint64(blocks)).astype(np.int64) * BLOCK_BITS
    x = mix(h + np.uint64(level * 0xD6E8FEB86659FD93 & (1 << 64) - 1))
    return np.stack([block + ((x >> np.uint64(9 * p)) & np.uint64(BLOCK_BITS - 1)).astype(np.int64) for p in range(PROBES)])


@dataclass
class LogBloom:
    """One segment of the filter."""

    bits: np.ndarray

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The level of each n-gram, by probes."""
        out, left, level = np.zeros(len(grams), np.uint8), np.arange(len(grams)), 1
        blocks = 8 * len(self.bits) // BLOCK_BITS
        while blocks and len(left) and level < len(VALUES):
            there = np.ones(len(left), bool)
            for q in places(grams[left], level, blocks):
                there &= (self.bits[q >> 3] >> (q & 7).astype(np.uint8)) & 1 == 1
            left = left[there]
            out[left] = level
            level += 1
        return out


def made(grams: np.ndarray, counts: np.ndarray, entry_bits: float = ENTRY_BITS) -> LogBloom:
    """A segment of distinct n-grams and their counts."""
    level = np.searchsorted(STARTS, counts, "right")
    blocks = math.ceil(int(level.sum()) * entry_bits / BLOCK_BITS)
    bits = np.zeros(blocks * BLOCK_BITS, np.uint8)
    grams, level, k = grams[level > 0], level[level > 0], 1
    while len(grams):
        bits[places(grams, k, blocks).ravel()] = 1
        grams, level = grams[level > k], level[level > k]
        k += 1
    return LogBloom(np.packbits(bits, bitorder="little"))


class Words(dict):
    """word -> its number, by first use."""

    def __missing__(self, word: bytes | None) -> int:
        self[word] = at = len(self)
        return at


def parts(text: bytes, most: int) -> Iterator[bytes]:
    """text, cut at white space into parts of about so many bytes."""
    at = 0
    while len(text) - at > most:
        cut = WHITE_BYTE.search(text, at + most)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


@dataclass
class Group:
    """Texts, or parts of them, as numbers of words; each begins with the word before it (at first the end token, None)."""

    places: Words = field(default_factory=Words)
    numbers: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    ids: list = field(default_factory=list)
    held: list[bool] = field(default_factory=list)
    keys: list[int] = field(default_factory=list)
    bytes: int = 0

    def add(self, words: list[bytes | None], before: bytes | None, id: object, held: bool, key: int, size: int) -> None:
        self.numbers.append(self.places[before])
        self.numbers.extend(map(self.places.__getitem__, words))
        self.sizes.append(len(words) + 1)
        self.ids.append(id)
        self.held.append(held)
        self.keys.append(key)
        self.bytes += size

    def row(self, group: int) -> dict:
        """Words are numbered by how common they are, the commonest first, so that numbers compress well."""
        from xxhash import xxh3_128_digest

        words = list(self.places)
        pairs = np.frombuffer(b"".join(xxh3_128_digest(w or b"") for w in words), np.uint64).reshape(-1, 2)
        h, g = pairs[:, 0].copy(), (pairs[:, 1] >> np.uint64(32)).astype(np.uint32)
        if None in self.places:
            h[self.places[None]], g[self.places[None]] = _END, 0
        numbers = np.array(self.numbers, np.int64)
        order = np.argsort(-np.bincount(numbers, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        sizes, held = np.array(self.sizes, np.int32), np.array(self.held, bool)
        kind = np.uint16 if len(words) <= 1 << 16 else np.uint32
        return {
            "group": group, "ids": self.ids, "held": np.packbits(held).tobytes(), "keys": self.keys, "sizes": sizes.tobytes(), "h": h[order].tobytes(), "g": g[order].tobytes(), "numbers": pa.compress(rank[numbers].astype(kind).tobytes(), codec="zstd", asbytes=True),
            "n_grams": len(numbers) + len(words), "n_trained": int((sizes - 1)[~held].sum()),
        }


_GROUP = "group bigint, ids array<{kind}>, held binary, keys array<bigint>, sizes binary, h binary, g binary, numbers binary, n_grams bigint, n_trained bigint"


def groups(docs: DataFrame, group_bytes: int) -> DataFrame:
    """A row for each group of docs (id, t, held_out)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made, group, row = TaskContext.get().partitionId() << 24, Group(), 0
        of_id = None

        def out() -> pa.RecordBatch:
            r = group.row(made)
            ids = pa.ListArray.from_arrays(pa.array([0, len(r["ids"])], pa.int32()), pa.array([x.as_py() for x in r.pop("ids")], of_id))
            keys = pa.array([r.pop("keys")], pa.list_(pa.int64()))
            rest = {k: pa.array([v]) for k, v in r.items()}
            return pa.RecordBatch.from_pydict({"group": rest.pop("group"), "ids": ids, "held": rest.pop("held"), "keys": keys, **rest})

        for b in batches:
            of_id = b.column(0).type
            for id, t, held in zip(b.column(0), b.column(1), b.column(2).to_pylist(), strict=True):
                key, before = (TaskContext.get().partitionId() << 40) + row, None
                row += 1
                whole = t.as_py() or b""
                cut = list(parts(whole, group_bytes)) if len(whole) > group_bytes else [whole]
                for k, part in enumerate(cut):
                    words = part.lower().split()
                    last = words[-1] if words else before
                    group.add([*words, None] if k == len(cut) - 1 else words, before, id, held, key, len(part))
                    before = last
                    if group.bytes > group_bytes or len(group.sizes) >= 1 << 16:
                        yield out()
                        made, group = made + 1, Group()
        if group.sizes:
            yield out()

    return docs.select("id", "t", "held_out").mapInArrow(run, _GROUP.format(kind=kind))


@dataclass
class Pairs:
    """A group's distinct pairs of neighbouring words, in the order of their hashes, and which of them each token is."""

    h: np.ndarray
    g: np.ndarray
    words: np.ndarray
    trained_words: np.ndarray
    order: np.ndarray
    before: np.ndarray
    word: np.ndarray
    of_token: np.ndarray
    grams: np.ndarray
    trained: np.ndarray
    sizes: np.ndarray
    tokens: np.ndarray


def pairs_of(sizes: bytes, held: bytes, h: bytes, g: bytes, numbers: bytes) -> Pairs:
    own, wide = np.frombuffer(sizes, np.int32).astype(np.int64), np.frombuffer(h, np.uint64)
    n = int(own.sum())
    item = np.uint16 if len(wide) <= 1 << 16 else np.uint32
    seq = np.frombuffer(pa.decompress(numbers, decompressed_size=n * item().itemsize, codec="zstd", asbytes=True), item).astype(np.int64)
    token = np.ones(n, bool)
    token[np.cumsum(own) - own] = False
    word, before = seq[token], seq[np.flatnonzero(token) - 1]
    apart = np.repeat(np.unpackbits(np.frombuffer(held, np.uint8), count=len(own)).astype(bool), own - 1)
    codes, of_token = np.unique(before * len(wide) + word, return_inverse=True)
    before, own_word = codes // max(len(wide), 1), codes % max(len(wide), 1)
    grams = bigram(wide[before], mix(wide)[own_word])
    order = np.argsort(grams, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    of_token = place[of_token]
    trained = np.bincount(of_token[~apart], minlength=len(order))
    uni = unigram(wide)
    return Pairs(wide, np.frombuffer(g, np.uint32), uni, np.bincount(word[~apart], minlength=len(wide)), np.argsort(uni, kind="stable"), before[order], own_word[order], of_token, grams[order], trained, own - 1, word)


def _small(counts: np.ndarray) -> bytes:
    top = int(counts.max()) if len(counts) else 0
    return counts.astype(np.uint8 if top < 1 << 8 else np.uint32 if top < 1 << 32 else np.uint64).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, {1: np.uint8, 4: np.uint32, 8: np.uint64}[len(data) // n]).astype(np.int64) if n else np.zeros(0, np.int64)


_PROBES = "segment int, group bigint, grams binary, counts binary, h binary, g binary, word_counts binary"


def probes(rows: DataFrame, segments: int) -> DataFrame:
    """What each group sends to each segment: its n-grams and their counts in training rows. n-grams are sent byte by byte, as the high bytes of sorted ones compress."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for group, *data in zip(*(b.column(c).to_pylist() for c in ("group", "sizes", "held", "h", "g", "numbers")), strict=True):
                p = pairs_of(*data)
                cuts = np.searchsorted(segment_of(p.grams, segments), np.arange(segments + 1)).tolist()
                h, g, words, counted = p.h[p.order], p.g[p.order], p.words[p.order], p.trained_words[p.order]
                at = np.searchsorted(segment_of(words, segments), np.arange(segments + 1)).tolist()
                low = p.grams[:, None].view(np.uint8)[:, :GRAM_BYTES]
                some = [s for s in range(segments) if cuts[s + 1] > cuts[s] or at[s + 1] > at[s]]
                blob = lambda f: pa.array([f(s) for s in some], pa.binary())  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([
                    pa.array(some, pa.int32()), pa.array([group] * len(some), pa.int64()),
                    blob(lambda s: low[cuts[s] : cuts[s + 1]].T.tobytes()), blob(lambda s: _small(p.trained[cuts[s] : cuts[s + 1]])),  # noqa: B023
                    blob(lambda s: h[at[s] : at[s + 1]].tobytes()), blob(lambda s: g[at[s] : at[s + 1]].tobytes()), blob(lambda s: _small(counted[at[s] : at[s + 1]])),  # noqa: B023
                ], names=["segment", "group", "grams", "counts", "h", "g", "word_counts"])

    return rows.select("group", "sizes", "held", "h", "g", "numbers").mapInArrow(run, _PROBES)


def summed(keys: tuple[np.ndarray, ...], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the first of each distinct key, the sum of its counts, and which of them each row is."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    for k in keys:
        ks = k[order]
        same = ks[1:] == ks[:-1]
        new[1:] = ~same if k is keys[0] else new[1:] | ~same
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    return order[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts[:0], which


_ANSWERS = "segment int, group bigint, levels binary, word_levels binary, word_counts binary, distinct bigint, bits binary"


def answered(rows: list[tuple], entry_bits: float) -> tuple[list[tuple[bytes, bytes, bytes]], int, bytes]:
    """One segment: the answers to its rows (grams, counts, h, g, word_counts), its distinct trained words, and its filter's bits."""
    sizes = [len(r[0]) // GRAM_BYTES for r in rows]
    raw = np.zeros((sum(sizes), 8), np.uint8)
    at = 0
    for r, n in zip(rows, sizes, strict=True):
        raw[at : at + n, :GRAM_BYTES] = np.frombuffer(r[0], np.uint8).reshape(GRAM_BYTES, n).T
        at += n
    grams = raw.view(np.uint64)[:, 0]
    counts = np.concatenate([_wide(r[1], n) for r, n in zip(rows, sizes, strict=True)])
    words = [len(r[2]) // 8 for r in rows]
    h, g = np.frombuffer(b"".join(r[2] for r in rows), np.uint64), np.frombuffer(b"".join(r[3] for r in rows), np.uint32)
    counted = np.concatenate([_wide(r[4], n) for r, n in zip(rows, words, strict=True)])
    first, exact, of_word = summed((g, h), counted)
    own = unigram(h[first])
    # Words whose short hashes are equal count as one in the filter, like other n-grams.
    all_grams, all_counts = np.concatenate([grams, own]), np.concatenate([counts, exact])
    distinct, total, which = summed((all_grams,), all_counts)
    bloom = made(all_grams[distinct], total, entry_bits)
    level = bloom.levels(all_grams[distinct])[which]
    of_gram, of_own = level[: len(grams)], level[len(grams) :][of_word]
    to_row = exact[of_word]
    out, i, j = [], 0, 0
    for n, m in zip(sizes, words, strict=True):
        out.append((of_gram[i : i + n].tobytes(), of_own[j : j + m].tobytes(), _small(to_row[j : j + m])))
        i, j = i + n, j + m
    return out, int((exact > 0).sum()), bloom.bits.tobytes()


def answers(sent: DataFrame, segments: int, entry_bits: float = ENTRY_BITS) -> DataFrame:
    """A row for each row of probes, and one for each segment itself (group -1): its filter, and its number of trained words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for b in batches:
            for segment, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.setdefault(segment, []).append(row)
        for segment in sorted(held):
            rows = held.pop(segment)
            replies, distinct, bits = answered([r[1:] for r in rows], entry_bits)
            rows = [(segment, r[0], *a, None, None) for r, a in zip(rows, replies, strict=True)] + [(segment, -1, None, None, None, distinct, bits)]
            kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in _ANSWERS.split(", ")])

    return sent.repartitionById(segments, F.col("segment")).mapInArrow(run, _ANSWERS)


_SCORES = "id {kind}, held_out boolean, key bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def scored(data: tuple, replies: list[tuple], norm: float) -> tuple[np.ndarray, ...]:
    """Tokens, known tokens, base score and score of each part of a group. replies: (segment, levels, word_levels, word_counts)."""
    p = pairs_of(*data)
    replies = sorted(replies)
    join = lambda k: b"".join(r[k] for r in replies)
    pair = VALUES[np.frombuffer(join(1), np.uint8)]
    own, exact = np.empty(len(p.h)), np.empty(len(p.h), np.int64)
    own[p.order] = VALUES[np.frombuffer(join(2), np.uint8)]
    exact[p.order] = np.concatenate([_wide(r[3], len(r[2])) for r in replies]) if replies else 0
    context = own[p.before]
    likely = (np.minimum(pair, context) + MU * (own[p.word] + 0.5) / norm) / (context + MU)
    of_pair = np.log10(np.minimum(likely, 1.0))
    of_word, known = np.log10((exact + 0.5) / norm), (exact > 0).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(p.sizes)])
    total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[ends])
    # Sums by part, not differences of running sums, for the two scores: texts keep full precision.
    part = np.repeat(np.arange(len(p.sizes)), p.sizes)
    by_part = lambda x: np.bincount(part, x, minlength=len(p.sizes))
    return p.sizes, total(known[p.tokens]), by_part(of_word[p.tokens]), by_part(of_pair[p.of_token])


def scores(rows: DataFrame, replies: DataFrame, norm: float, tasks: int) -> DataFrame:
    """_SCORES of each part of the groups, each group with its answers."""
    kind = rows.schema["ids"].dataType.elementType.simpleString()
    none = lambda k: F.lit(None).cast(k)
    one = rows.select("group", none("int").alias("segment"), *[none("binary").alias(c) for c in ("levels", "word_levels", "word_counts")], "ids", "held", "keys", "sizes", "h", "g", "numbers")
    two = replies.where("group >= 0").select("group", "segment", "levels", "word_levels", "word_counts", none(f"array<{kind}>").alias("ids"), none("binary").alias("held"), none("array<bigint>").alias("keys"), *[none("binary").alias(c) for c in ("sizes", "h", "g", "numbers")])
    dealt = one.union(two).repartition(tasks, "group").sortWithinPartitions("group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            ids, held, keys, *data = whole
            tokens, known, base, score = scored((data[0], held, *data[1:]), got, norm)
            apart = np.unpackbits(np.frombuffer(held, np.uint8), count=len(tokens)).astype(bool)
            return pa.RecordBatch.from_arrays([ids, pa.array(apart), pa.array(keys, pa.int64()), pa.array(tokens), pa.array(known), pa.array(base), pa.array(score)], names=[x.split()[0] for x in _SCORES.split(", ")])

        group, whole, got = None, None, []
        for b in batches:
            columns = [b.column(c).to_pylist() for c in ("group", "segment", "levels", "word_levels", "word_counts")]
            for i, (own, segment, *reply) in enumerate(zip(*columns, strict=True)):
                if own != group:
                    if whole:
                        yield out()
                    group, whole, got = own, None, []
                if segment is None:
                    whole = (b.column("ids")[i].values, *(b.column(c)[i].as_py() for c in ("held", "keys", "sizes", "h", "g", "numbers")))
                else:
                    got.append((segment, *reply))
        if whole:
            yield out()

    return dealt.mapInArrow(run, _SCORES.format(kind=kind))


def lm_scores(df: DataFrame, held_out: Column, id_col: str = "doc_id", text: str = "text", group_bytes: int = GROUP_BYTES, segment_grams: int = SEGMENT_GRAMS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of df, trained on rows where held_out is false."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text).cast("binary").alias("t"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    rows = stored(groups(docs, group_bytes), "groups", compression="zstd")
    grams, total, many = rows.agg(F.coalesce(F.sum("n_grams"), F.lit(0)), F.coalesce(F.sum("n_trained"), F.lit(0)), F.count("*")).first()
    segments = max(8, -(-grams // segment_grams))
    replies = stored(answers(probes(rows, segments), segments), "answers")
    distinct = replies.where("group = -1").agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0]
    found = scores(rows, replies, total + 0.5 * (distinct + 1), max(8, -(-many // TASK_GROUPS)))
    # Texts of several parts are summed; their rows are told apart by key.
    sums = found.groupBy("key").agg(F.first("id").alias("id"), F.first("held_out").alias("held_out"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return sums.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
