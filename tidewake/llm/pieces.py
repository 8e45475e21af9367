"""Sampled SentencePiece encoding, and decoding without loss.

A segmentation is drawn from all of the piece lattice: forward sums of path
weights are filtered from left to right, then pieces are drawn from the end
backwards. Draws (of 32 bits) come from a hash of the seed, the row's key, and the place, so
they do not depend on partitions, order or retries. Pieces are found by walking a trie, one code point
after the other, so what is found is in the text. No piece of a supported model
goes on over a space or a line feed, so the lattice falls apart into words, and
the sums of equal words of a batch are worked out once, all words together. A word of over LONG
code points is filtered CHUNK at a time, keeping only the sums that the next chunk needs; going back, each chunk's sums are
worked out again from those. So memory is bounded for words and texts of any length, but for the result itself.

A unigram model's piece weighs exp(alpha * score). A BPE model's scores only rank
its pieces, which weigh (2 + rank) ** -alpha. Characters without a piece, and the
sign that stands for a space where it is itself in the text, become byte pieces,
so decoding gives every text back.

Null texts have null pieces, empty ones none. Rows equal in key and text get equal
pieces; a null key is a key like others. An empty table stays empty. Other columns pass through, the added ones
(pieces, n_pieces, and lossless or the decoded text) replace any of the same name; there are no others that could clash.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm.common import mix, slices

SPACE = 0x2581
#: What the sign for a space is in the lattice if the text has it; no piece has this.
LITERAL = 0x110000
SEGMENT = re.compile(r" *[^ \n]+| +|\n+")
#: Code points of words whose sums are worked out together; to a chunk of longer ones.
LONG = 48
CHUNK = 1 << 14
BYTES_AT_ONCE = 2_000_000
#: Words whose pieces are drawn together.
SEGMENTS_AT_ONCE = 1 << 19
_G = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a code point in a trie's key.
CODE_BITS = 21


@dataclass
class Model:
    """A model's pieces, as tables."""

    pieces: list[str]
    weights: np.ndarray
    byte_ids: np.ndarray
    #: The trie, for each depth: sorted keys (number of the node above, code point), and the piece that ends there, or -1. A node's number is its place.
    prefixes: list[tuple[np.ndarray, np.ndarray]]
    bytes_of: list[bytes] = field(default_factory=list)

    @property
    def fallback(self) -> int:
        return len(self.pieces)


def load_model(path: str, alpha: float = 1.0) -> Model:
    """Reads a .model file."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces or not proto.normalizer_spec.add_dummy_prefix:
        raise ValueError("only models that leave texts as they are, after a dummy prefix, can give them back")
    ranked = proto.trainer_spec.model_type == 2
    pieces = [p.piece for p in proto.pieces]
    weights = np.zeros(len(pieces) + 2)
    weights[len(pieces)] = 1.0
    byte_ids = np.full(256, -1, np.int64)
    known: dict[str, int] = {}
    bytes_of = []
    for i, p in enumerate(proto.pieces):
        bytes_of.append(b"")
        if p.type == 6:
            byte_ids[int(p.piece[1:-1], 16)] = i
            bytes_of[i] = bytes([int(p.piece[1:-1], 16)])
        elif p.type in (1, 4):
            if "\n" in p.piece or "▁" in p.piece.lstrip("▁"):
                raise ValueError("pieces that go on over white space aren't supported")
            weights[i] = (2 - p.score) ** -alpha if ranked else math.exp(alpha * p.score)
            bytes_of[i] = p.piece.replace("▁", " ").encode()
            known[p.piece] = i
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces")
    prefixes, above = [], {"": 0}
    for k in range(1, max(map(len, known), default=0) + 1):
        made = {p[:k] for p in known if len(p) >= k}
        keys = sorted((above[p[:-1]] << CODE_BITS | ord(p[-1]), p) for p in made)
        above = {p: at for at, (_, p) in enumerate(keys)}
        prefixes.append((np.array([x for x, _ in keys], np.int64), np.array([known.get(p, -1) for _, p in keys], np.int32)))
    return Model(pieces, weights, byte_ids, prefixes, bytes_of)


def codes_of(text: str) -> np.ndarray:
    """Code points, as the lattice has them."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where(codes == SPACE, LITERAL, np.where(codes == 0x20, SPACE, codes))


def arcs_of(codes: np.ndarray, left: np.ndarray, model: Model) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length from 1 on: where pieces begin, and which. left: code points to each one's word's end. A code point without a piece gets the fallback."""
    at, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
    for k, (keys, ids) in enumerate(model.prefixes):
        inside = left[at] > k
        at, node = at[inside], node[inside]
        key = node << CODE_BITS | codes[at + k]
        place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        known = keys[place] == key
        piece = ids[place]
        if k == 0:
            own = np.where(known, piece, -1)
            yield at, np.where(own < 0, model.fallback, own)
        else:
            ends = known & (piece >= 0)
            yield at[ends], piece[ends]
        at, node = at[known], place[known]


@dataclass
class Lattice:
    """Of some distinct words: for each node (a word's places 0 to its length) the pieces that end there, by length.

    upto: a node's number and the share of its pieces up to this one; what stands behind a node's last piece is larger.
    """

    codes: np.ndarray
    first: np.ndarray
    lengths: np.ndarray
    begin: np.ndarray
    piece: np.ndarray
    size: np.ndarray
    upto: np.ndarray


def lattice(words: list[str], model: Model) -> Lattice:
    """Of words of up to LONG code points."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = codes_of("".join(words))
    starts = np.cumsum(lengths) - lengths
    first = starts + np.arange(len(words))
    left = np.repeat(starts + lengths, lengths) - np.arange(len(codes))
    node = np.arange(len(codes)) + np.repeat(np.arange(len(words)), lengths)
    n = len(codes) + len(words)
    found = [(node[at] + k + 1, ids) for k, (at, ids) in enumerate(arcs_of(codes, left, model))]
    many = np.zeros(n, np.int64)
    for nodes, _ in found:
        many[nodes] += 1
    begin = np.concatenate([[0], np.cumsum(many)])
    piece, size, filled = np.zeros(begin[-1], np.int32), np.zeros(begin[-1], np.int8), begin[:-1].copy()
    for k, (nodes, ids) in enumerate(found):
        place = filled[nodes]
        piece[place], size[place] = ids, k + 1
        filled[nodes] += 1
    weight, upto, alpha = model.weights[piece], np.zeros(begin[-1]), np.zeros(n)
    alpha[first] = 1.0
    order = np.argsort(-lengths, kind="stable")
    ends = np.searchsorted(-lengths[order], -np.arange(1, LONG + 1), "right")
    for t in range(1, LONG + 1):
        nodes = first[order[: ends[t - 1]]] + t
        if not len(nodes):
            break
        place, stop, sums = begin[nodes], begin[nodes + 1], np.zeros(len(nodes))
        live = np.arange(len(nodes))
        while len(live):
            p = place[live]
            sums[live] += alpha[nodes[live] - size[p]] * weight[p]
            upto[p] = sums[live]
            place[live] += 1
            live = live[place[live] < stop[live]]
        alpha[nodes] = sums
    owner = np.repeat(np.arange(n), many)
    return Lattice(codes, first, lengths, begin, piece, size, np.append(owner + upto / alpha[owner], np.inf))


def draws(seeds: np.ndarray, step: int | np.ndarray) -> np.ndarray:
    """Numbers from 0 to under 1 for the step-th pieces from the end."""
    return (mix(seeds + np.asarray(step).astype(np.uint64) * _G) >> np.uint64(32)).astype(np.float64) / (1 << 32)


def sample(lat: Lattice, word: np.ndarray, seeds: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all the occurrences of words, in a row, and how many each has. Drawn from the end of each backwards."""
    n = len(word)
    at, first = lat.first[word] + lat.lengths[word], lat.first[word]
    who = np.arange(n)
    steps = []
    s = 0
    while len(who):
        s += 1
        hit, target, more = lat.begin[at], at + draws(seeds[who], s), np.arange(len(at))
        while len(more := more[lat.upto[hit[more]] <= target[more]]):  # the last piece's share is all there is
            hit[more] += 1
        hit = np.minimum(hit, lat.begin[at + 1] - 1)
        steps.append((who, lat.piece[hit].astype(np.int64), at))
        at = at - lat.size[hit]
        go_on = at > first[who]
        who, at = who[go_on], at[go_on]
    if not steps:
        return np.zeros(0, np.int64), np.zeros(n, np.int64)
    many = np.bincount(np.concatenate([w for w, _, _ in steps]), minlength=n)
    begin = np.cumsum(many) - many
    ids, nodes = np.zeros(int(many.sum()), np.int64), np.zeros(int(many.sum()), np.int64)
    for s, (w, i, p) in enumerate(steps):
        place = begin[w] + many[w] - 1 - s
        ids[place], nodes[place] = i, p
    bare = np.flatnonzero(ids == model.fallback)
    if not len(bare):
        return ids, many
    owner = np.repeat(np.arange(n), many)
    ids, wide = spelled_out(ids, bare, lat.codes[nodes[bare] - 1 - word[owner[bare]]], model)
    return ids, np.bincount(np.repeat(owner, wide), minlength=n)


def spelled_out(ids: np.ndarray, bare: np.ndarray, codes: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """ids with byte pieces in the places bare, whose code points are given; and how many pieces stand for each."""
    raw = [chr(c).encode("utf-8", "surrogatepass") for c in np.where(codes == LITERAL, SPACE, codes).tolist()]
    wide = np.ones(len(ids), np.int64)
    wide[bare] = [len(r) for r in raw]
    out = np.repeat(ids, wide)
    ends = np.cumsum(wide)
    fill = np.concatenate([np.arange(e - k, e) for e, k in zip(ends[bare], wide[bare], strict=True)]) if len(bare) else bare
    out[fill] = model.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
    return out, wide


def _chunk(codes: np.ndarray, start: int, end: int, before: list[float], model: Model) -> tuple[list[int], list[int], list[int], list[float], list[float]]:
    """Of the nodes start + 1 to end of a long word: where each one's pieces begin in the lists, the pieces, their sizes, their summed weights; and the last nodes' sums for the next chunk."""
    longest = len(model.prefixes)
    low = max(0, start - longest + 1)
    near = codes[low:end]
    found = [(low + at + k + 1, ids) for k, (at, ids) in enumerate(arcs_of(near, len(near) - np.arange(len(near)), model))]
    nodes, pieces, sizes = np.concatenate([n for n, _ in found]), np.concatenate([i for _, i in found]), np.repeat(np.arange(1, len(found) + 1), [len(i) for _, i in found])
    order = np.flatnonzero(nodes > start)
    order = order[np.argsort(nodes[order], kind="stable")]
    begin = np.searchsorted(nodes[order], np.arange(start + 1, end + 2)).tolist()
    pieces, sizes = pieces[order], sizes[order].tolist()
    weight, upto, a = model.weights[pieces].tolist(), [], list(before)
    for t in range(end - start):
        s = 0.0
        for p in range(begin[t], begin[t + 1]):
            s += a[-sizes[p]] * weight[p]
            upto.append(s)
        a.append(s)
        if t % 16 == 15:
            a = [x / s for x in a[-longest:]]
    s = a[-1]
    return begin, pieces.tolist(), sizes, upto, [x / s for x in a[-longest:]]


def sample_long(word: str, seed: int, model: Model) -> np.ndarray:
    """Piece ids of one word of any length."""
    codes = codes_of(word)
    starts = list(range(0, len(codes), CHUNK))
    sums = [[0.0] * (len(model.prefixes) - 1) + [1.0]]
    for start in starts[:-1]:
        sums.append(_chunk(codes, start, start + CHUNK, sums[-1], model)[-1])
    seeds, at, ids, places, step, u = np.array([seed], np.uint64), len(codes), [], [], 0, []
    for start, before in zip(reversed(starts), reversed(sums), strict=True):
        begin, pieces, sizes, upto, _ = _chunk(codes, start, min(start + CHUNK, len(codes)), before, model)
        while at > start:
            if not u:
                u = draws(seeds, np.arange(step + 1, step + 4097))[::-1].tolist()
                step += 4096
            i, j = begin[at - start - 1], begin[at - start]
            hit = min(bisect_right(upto, u.pop() * upto[j - 1], i, j), j - 1)
            ids.append(pieces[hit])
            places.append(at - 1)
            at -= sizes[hit]
    ids, places = np.array(ids[::-1], np.int64), np.array(places[::-1], np.int64)
    bare = np.flatnonzero(ids == model.fallback)
    return spelled_out(ids, bare, codes[places[bare]], model)[0] if len(bare) else ids


class Places(dict):
    """word -> its number, by first use."""

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        return at


def drawn(flat: list[str], seeds: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of words in a row, and how many each has."""
    places = Places()
    number = np.fromiter(map(places.__getitem__, flat), np.int64, len(flat))
    words = list(places)
    short = np.fromiter((len(w) <= LONG for w in words), bool, len(words))
    if short.all():
        return sample(lattice(words, model), number, seeds, model)
    own = np.cumsum(short) - 1
    long = ~short[number]
    ids, many = sample(lattice([w for w in words if len(w) <= LONG], model), own[number[~long]], seeds[~long], model)
    alone = [sample_long(flat[i], int(seeds[i]), model) for i in np.flatnonzero(long)]
    each = np.zeros(len(flat), np.int64)
    each[~long], each[long] = many, [len(x) for x in alone]
    out, of_long = np.zeros(int(each.sum()), np.int64), np.repeat(long, each)
    out[~of_long], out[of_long] = ids, np.concatenate(alone)
    return out, each


def encode_texts(texts: list[str | None], keys: list[object], model: Model, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts in a row, and how many each has."""
    from xxhash import xxh64_intdigest

    flat, doc, turn, out = [], [], [], [np.zeros(0, np.int64)]
    each = np.zeros(len(texts), np.int64)
    own = np.array([xxh64_intdigest(repr((seed, k)).encode()) for k in keys], np.uint64)

    def flush() -> None:
        if flat:
            d, t = np.concatenate(doc), np.concatenate(turn)
            ids, many = drawn(flat, mix(own[d] + t.astype(np.uint64) * _G), model)
            np.add.at(each, d, many)
            out.append(ids.astype(np.int32))
            flat.clear(), doc.clear(), turn.clear()

    for i, t in enumerate(texts):
        if t:
            found, begun = (m.group() for m in SEGMENT.finditer(" " + t)) if len(t) > BYTES_AT_ONCE else SEGMENT.findall(" " + t), 0
            while some := list(islice(found, SEGMENTS_AT_ONCE)) if len(t) > BYTES_AT_ONCE else found:
                flat.extend(some)
                doc.append(np.full(len(some), i))
                turn.append(np.arange(begun, begun + len(some)))
                begun += len(some)
                if len(flat) >= SEGMENTS_AT_ONCE:
                    flush()
                if len(t) <= BYTES_AT_ONCE:
                    break
    flush()
    return np.concatenate(out), each


def _list(ids: np.ndarray, each: np.ndarray, null: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(each)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, mask=np.append(null, False)), pa.array(ids.astype(np.int32)))


def decode_ids(ids: pa.Array, table: pa.Array) -> pa.Array:
    """Texts in UTF-8 of lists of piece ids."""
    return pa.array([x[1:] if x else x for x in spelled(ids, table).to_pylist()], pa.binary())


def spelled(ids: pa.Array, table: pa.Array) -> pa.Array:
    """The pieces' bytes in a row, with the dummy prefix."""
    import pyarrow.compute as pc

    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, table.take(ids.values), mask=ids.is_null()), pa.scalar(b"", pa.binary()))


def _schema(df: DataFrame, **more: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in more] + [f"{k} {v}" for k, v in more.items()])


def encode(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", seed: int = 0) -> DataFrame:
    """df with pieces (array of ids) and n_pieces, drawn for each row."""
    df = df.drop("pieces", "n_pieces")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, text, BYTES_AT_ONCE):
            texts = b.column(text).to_pylist()
            ids, each = encode_texts(texts, b.column(key).to_pylist(), m, seed)
            null = np.array([t is None for t in texts], bool)
            yield pa.RecordBatch.from_arrays([*b.columns, _list(ids, each, null), pa.array(each, mask=null)], names=[*b.schema.names, "pieces", "n_pieces"])

    return df.mapInArrow(run, _schema(df, pieces="array<int>", n_pieces="bigint"))


def decode(df: DataFrame, model: Model, pieces: str = "pieces", into: str = "decoded") -> DataFrame:
    """df with the texts that its pieces spell."""
    df = df.drop(into)
    shared = df.sparkSession.sparkContext.broadcast(model.bytes_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(shared.value, pa.binary())
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                c = b.slice(at, 1000)
                ids = pa.array(c.column(pieces).to_pylist(), pa.list_(pa.int32())) if c.column(pieces).offset else c.column(pieces)
                yield pa.RecordBatch.from_arrays([*c.columns, decode_ids(ids, table)], names=[*c.schema.names, into])

    out = df.mapInArrow(run, _schema(df, **{into: "binary"}))
    return out.withColumn(into, F.col(into).cast("string"))


def encode_and_verify(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", seed: int = 0) -> DataFrame:
    """encode(), and lossless: whether decoding gives the text back (null for null). Both in one pass."""
    df = df.drop("pieces", "n_pieces", "lossless")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        m = shared.value
        table = pa.array(m.bytes_of, pa.binary())
        for b in slices(batches, text, BYTES_AT_ONCE):
            texts = b.column(text).to_pylist()
            ids, each = encode_texts(texts, b.column(key).to_pylist(), m, seed)
            null = np.array([t is None for t in texts], bool)
            pieces = _list(ids, each, null)
            prefixed = pa.array([None if t is None else b" " * bool(t) + t.encode() for t in texts], pa.binary())
            same = pc.equal(spelled(pieces, table), prefixed)
            yield pa.RecordBatch.from_arrays([*b.columns, pieces, pa.array(each, mask=null), same], names=[*b.schema.names, "pieces", "n_pieces", "lossless"])

    return df.mapInArrow(run, _schema(df, pieces="array<int>", n_pieces="bigint", lossless="boolean"))
