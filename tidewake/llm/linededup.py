"""Deletion of repeated runs of lines, found by winnowing.

Blank lines don't count, and lines are equal if they are so without white space around them. A
run of lines with least_words words or more is repeated if an equal run stands earlier, in the order of
(id, text hash, line); null ids come last. All lines that are in some repeated run are deleted, so
that the first occurrence stays.

1. Winnowing: a window is the shortest run from some line on that has least_words words, and its least line
   hash (the last, of ties) is its fingerprint; likewise for the shortest run back from
   some line. Equal runs of least_words words or more so have a fingerprint in common. One row is written for
   each text: the digests of its lines, their sizes, and its fingerprints.
2. Only fingerprints are joined first. Those that occur once are dropped, and with them all texts
   that have no others, that is, the greater part of most corpora.
3. At each place of a shared fingerprint the match is extended both ways from the fingerprint, line digest by line
   digest: forwards by the windows that end behind it, back by those that begin before it. A window that equals an
   earlier one is repeated. Since a run's ends are the ends of such windows, their union is just the lines
   of the longest runs that repeat any earlier run, not of the first match alone. Equality of windows is
   transitive, so each is held against the first of its kind and no pairs within a group are made.

Windows are compared by 128-bit digests of 128-bit line digests, never by fingerprints, so a shared
fingerprint deletes nothing by itself. Where a window overlaps its first occurrence in the same text, only what lies
behind that is deleted.

Null texts stay null, empty ones empty. A text may become empty. Rows equal in id and text are one document and
get one answer. A text is held by one task, however long. An empty table stays empty. Other columns pass through,
whatever their names; removed_lines replaces a column of that name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.llm.common import attach, key_of, numbered, packed, slices, spread, stored, unpacked

LEAST_WORDS = 50
BYTES_AT_ONCE = 4_000_000
DIGEST = 16


def fingerprint_of(digest: bytes) -> int:
    """The 64-bit hash that windows are winnowed by."""
    return int.from_bytes(digest[:8], "little", signed=True)


def digests(text: bytes) -> tuple[list[int], list[bytes], list[int]]:
    """Numbers, digests and words of the lines that aren't blank."""
    from xxhash import xxh3_128_digest

    lines = [(i, s) for i, x in enumerate(text.split(b"\n")) if (s := x.strip())]
    return [i for i, _ in lines], [xxh3_128_digest(s) for _, s in lines], [len(s.split()) for _, s in lines]


def windows(hashes: list[int], sizes: list[int], least_words: int) -> list[tuple[int, int, int]]:
    """(place of the fingerprint, first, last) of each window: from each line on, and back from each line."""
    out = set()
    n = len(sizes)
    for step in (1, -1):
        own, hs = (sizes, hashes) if step == 1 else (sizes[::-1], hashes[::-1])
        # The last of ties, seen forwards: the first one when the lines are reversed.
        beaten = (lambda a, b: a >= b) if step == 1 else (lambda a, b: a > b)
        queue: list[int] = []  # places inside the window, hashes rising
        head = end = have = 0
        for i in range(n):
            while have < least_words and end < n:
                while len(queue) > head and beaten(hs[queue[-1]], hs[end]):
                    queue.pop()
                queue.append(end)
                have += own[end]
                end += 1
            if have < least_words:
                break
            while queue[head] < i:
                head += 1
            at = queue[head]
            out.add((at, i, end - 1) if step == 1 else (n - 1 - at, n - end, n - 1 - i))
            have -= own[i]
    return sorted(out)


_LINES = "key struct<none:boolean,id:{kind},sum:bigint>, numbers binary, digests binary, sizes binary, fps array<bigint>"


def lines_of(docs: DataFrame, least_words: int) -> DataFrame:
    """Digests and fingerprints of each text of docs (key, t) that has least_words words."""
    kind = docs.schema["key"].dataType["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t", BYTES_AT_ONCE):
            keep, rows = [], []
            for k, t in enumerate(b.column("t").to_pylist()):
                numbers, ds, sizes = digests(t or b"")
                if sum(sizes) >= least_words:
                    hs = [fingerprint_of(d) for d in ds]
                    keep.append(k)
                    rows.append((np.array(numbers, np.int32).tobytes(), b"".join(ds), np.array(sizes, np.int32).tobytes(), [hs[p] for p in sorted({p for p, _, _ in windows(hs, sizes, least_words)})]))
            kinds = (pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(keep, pa.int64())), *columns], names=["key", "numbers", "digests", "sizes", "fps"])

    return docs.mapInArrow(run, _LINES.format(kind=kind))


def windows_at(lines: DataFrame, least_words: int) -> DataFrame:
    """(key, hash, start, end) of the windows whose fingerprint is in shared. lines: key, numbers, digests, sizes, shared."""
    kind = lines.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for b in slices(batches, "digests", BYTES_AT_ONCE):
            owner, hashes, starts, ends = [], [], [], []
            for k, (numbers, ds, sizes, shared) in enumerate(zip(*(b.column(c).to_pylist() for c in ("numbers", "digests", "sizes", "shared")), strict=True)):
                at, known = np.frombuffer(numbers, np.int32), set(shared)
                hs = [fingerprint_of(ds[i : i + DIGEST]) for i in range(0, len(ds), DIGEST)]
                for p, i, j in windows(hs, np.frombuffer(sizes, np.int32).tolist(), least_words):
                    if hs[p] in known:
                        owner.append(k)
                        hashes.append(xxh3_128_digest(ds[DIGEST * i : DIGEST * (j + 1)]))
                        starts.append(int(at[i]))
                        ends.append(int(at[j]))
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(owner, pa.int64())), pa.array(hashes, pa.binary()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=["key", "hash", "start", "end"])

    return lines.select("key", "numbers", "digests", "sizes", "shared").mapInArrow(run, f"key {kind}, hash binary, start int, end int")


def repeated(docs: DataFrame, least_words: int) -> DataFrame:
    """(key, ranges) of the texts with repeated lines: first and last lines, merged, in order. docs: key, t."""
    lines = stored(lines_of(docs, least_words), "lines", compression="zstd")
    places = lines.select("key", F.explode("fps").alias("fp"))
    salt = spread(F.col("key"))
    again = places.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").withColumn("again", F.lit(True))
    total = lines.agg(F.coalesce(F.sum(F.size("fps")), F.lit(0))).first()[0]
    # A text's shared fingerprints are no more than its lines.
    shared = attach(places, again, "fp", salt, total).where("again").distinct().groupBy("key").agg(F.collect_list("fp").alias("shared"))
    copies = lines.groupBy("key").agg(F.count("*").alias("n")).join(shared, "key")
    distinct = lines.dropDuplicates(["key"]).select("key", "numbers", "digests", "sizes")
    found = stored(windows_at(distinct.join(shared, "key"), least_words), "windows")
    order = F.struct("key", "start", "end")
    first = found.groupBy("hash").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    found = attach(found, first, "hash", salt, found.count()).where("first IS NOT NULL")
    same_text = F.col("first.key") == F.col("key")
    found = found.where(~(same_text & (F.col("first.start") == F.col("start"))))
    start = F.when(same_text, F.greatest("start", F.col("first.end") + 1)).otherwise(F.col("start"))
    ranges = merged(found.select("key", start.alias("start"), "end").where("start <= end").distinct())
    return ranges.join(copies.select("key", "n"), "key")


def merged(ranges: DataFrame) -> DataFrame:
    """(key, ranges): overlapping and adjoining ranges of lines as one."""
    kind = ranges.schema["key"].dataType.simpleString()
    one = ranges.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for rs in b.column("ranges").to_pylist():
                own: list[dict] = []
                for r in rs:
                    if own and r["start"] <= own[-1]["end"] + 1:
                        own[-1]["end"] = max(own[-1]["end"], r["end"])
                    else:
                        own.append(dict(r))
                out.append(own)
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], names=["key", "ranges"])

    return one.mapInArrow(run, f"key {kind}, ranges array<struct<start:int,end:int>>")


def delete_lines(text: str, ranges: list[tuple[int, int]]) -> tuple[str, int]:
    """text without the lines of the ranges, and how many these are."""
    lines, kept, at, gone = text.split("\n"), [], 0, 0
    for start, end in ranges:
        kept += lines[at:start]
        at, gone = end + 1, gone + end + 1 - start
    return "\n".join(kept + lines[at:]), gone


def line_dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """df without lines that repeat earlier runs, and removed_lines."""
    key = key_of(F.col(id_col), F.col(text))
    docs = df.where(F.col(text) != "").select(key.alias("key"), F.col(text).cast("binary").alias("t"))
    ranges = repeated(docs, least_words)
    # Texts without a word need no answer; their keys, which many rows may share, are dealt out like null.
    rows = packed(df, F.when(F.col(text) != "", key).alias("key"))
    salt = spread(numbered(id_col, df.columns), numbered(text, df.columns))
    out = attach(rows, ranges, "key", salt, df.count())
    names = [c for c in df.columns if c.lower() != "removed_lines"]
    at = [c.lower() for c in names].index(text.lower())
    out = out.select(*unpacked("removed_lines", columns=df.columns), F.col("ranges").alias("removed_lines"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema[:-1]) + ", removed_lines bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, names[at], BYTES_AT_ONCE):
            texts, removed = b.column(at), [0] * b.num_rows
            hit = [i for i, r in enumerate(b.column(len(names)).to_pylist()) if r]
            if hit:
                texts = texts.to_pylist()
                for i in hit:
                    texts[i], removed[i] = delete_lines(texts[i], [(x["start"], x["end"]) for x in b.column(len(names))[i].as_py()])
                texts = pa.array(texts, pa.string())
            columns = [texts if i == at else b.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.int64())], names=[*names, "removed_lines"])

    return out.mapInArrow(run, schema)
