"""The operators against brute force, and at the edges: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from tidewake.llm import chat, licences, linededup, lm, mixing, pieces, quality, queries, simhash, topk, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"w{i % 977}" for i in range(20_000))
EDGES = [(1, None, "en", "src0", None), (2, "", None, None, 0), (3, "two words", "en", "src1", 9), (None, "no id here", "en", "src1", 9), (5, LONG, "en", "src0", 1), (6, LONG, "en", "src0", 1), (7, "x\n\n\n", "xx", "other", 4), (3, "two words", "en", "src1", 9)]


def docs(spark, rows=EDGES):
    return spark.createDataFrame(rows, DOCS)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    found = duck.execute(queries.ORACLES[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(repr([r[c] for c in sorted(names)]) for r in df.collect()) == sorted(repr([r[names.index(c)] for c in sorted(names)]) for r in found.fetchall())


# Pieces


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(queries.PIECES_MODEL)


def test_pieces_lossless_and_reproducible(spark, model):
    texts = [None, "", " ", "a  b▁c \n\n x ", "퟿€😀é ", "x" * 3000, "Hello world", "\t\r\x00"]
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "doc_id bigint, text string, pieces int")
    out = {r.doc_id: r for r in pieces.encode_and_verify(df, model).collect()}
    again = {r.doc_id: r.pieces for r in pieces.encode(df.repartition(3), model).collect()}
    assert out[0].pieces is None and out[0].lossless is None and out[1].pieces == []
    assert all(r.lossless for i, r in out.items() if i) and {i: r.pieces for i, r in out.items()} == again
    back = pieces.decode(pieces.encode(df, model), model).collect()
    assert {r.doc_id: r.decoded for r in back} == dict(enumerate(texts))
    assert pieces.encode(df.limit(0), model).count() == 0


def test_pieces_are_drawn_by_weight(model):
    word = "the"
    known = {p: i for i, p in enumerate(model.pieces)}
    weight = {}
    for cuts in itertools.chain.from_iterable(itertools.combinations(range(1, 4), k) for k in range(4)):
        s = "▁" + word
        parts = [s[i:j] for i, j in zip([0, *cuts], [*cuts, len(s)], strict=True)]
        if all(p in known for p in parts):
            weight[tuple(known[p] for p in parts)] = math.prod(model.weights[known[p]] for p in parts)
    n = 20_000
    ids, each = pieces.encode_texts([word] * n, list(range(n)), model)
    ends = np.cumsum(each)
    seen = Counter(tuple(ids[e - k : e].tolist()) for e, k in zip(ends, each, strict=True))
    total = sum(weight.values())
    assert set(seen) <= set(weight)
    for k, w in weight.items():
        assert abs(seen[k] / n - w / total) < 0.015


@pytest.mark.parametrize("chunk", [17, 1 << 14])
def test_pieces_long_words_agree_with_short_ones(model, monkeypatch, chunk):
    texts = ["internationalization of words, incomprehensibilities\nand \u2603snow\u2603men  ", "a b", None, "x" * 40]
    a = pieces.encode_texts(texts, [1, 2, 3, 4], model)
    monkeypatch.setattr(pieces, "LONG", 3)
    monkeypatch.setattr(pieces, "CHUNK", chunk)
    monkeypatch.setattr(pieces, "SEGMENTS_AT_ONCE", 2)
    b = pieces.encode_texts(texts, [1, 2, 3, 4], model)
    assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()


def test_pieces_of_a_word_without_end(model):
    """Half a million code points without a space, and a text of many words that is cut."""
    rng = random.Random(11)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDE0123456789+/") for _ in range(500_000))
    ids, each = pieces.encode_texts([word], ["k"], model)
    assert b"".join(model.bytes_of[i] for i in ids.tolist()) == b" " + word.encode() and each.tolist() == [len(ids)]
    # The same law as for short words: the share of pieces of one code point agrees.
    short, _ = pieces.encode_texts([" ".join(word[i : i + 47] for i in range(0, 470_000, 47))], ["k"], model)
    alone = lambda x: np.mean([len(model.bytes_of[i]) == 1 for i in x.tolist()])
    assert abs(alone(ids) - alone(short)) < 0.03


def test_trie_is_exact(model):
    """Each piece is found where it stands, and only there."""
    known = {p: i for i, p in enumerate(model.pieces) if model.weights[i] > 0 and model.bytes_of[i]}
    text = "\u2581the\u2581international\u2581\u2581x"
    codes = np.array([ord(c) for c in text], np.int64)
    found = {(int(a), k + 1, int(i)) for k, (at, ids) in enumerate(pieces.arcs_of(codes, len(codes) - np.arange(len(codes)), model)) for a, i in zip(at, ids, strict=True) if i != model.fallback}
    assert found == {(a, b - a, known[text[a:b]]) for a in range(len(text)) for b in range(a + 1, len(text) + 1) if text[a:b] in known}


# WARC


def test_warc_edges(spark, tmp_path):
    big = "a" * 1500
    rows = [(1, "http://a/ b\n", big), (2, None, big), (3, "http://c", None), (4, "u", "x"), (5, "u", "x"), (None, "u", big), (2, None, big), (6, "v", "z" * (18 << 20))]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    warc.write_warc(pages, str(tmp_path / "w"))
    for size in (1 << 10, 1 << 24):
        got = warc.read_warc(spark, str(tmp_path / "w"), range_bytes=size).collect()
        assert sum(r.record_type == "warcinfo" for r in got) == len(list((tmp_path / "w").glob("*.warc.gz"))) == len(list((tmp_path / "w").iterdir()))
        got = [r for r in got if r.record_type != "warcinfo"]
        assert len(got) == len(rows)
        kinds = sorted((r.record_id, r.record_type, r.refers_to) for r in got)
        assert ("<urn:x-page:1>", "revisit", "<urn:x-page:2>") in kinds
        assert [k[1] for k in kinds if k[0] == "<urn:x-page:2>"] == ["response"] * 2
        for r in got:
            if r.record_type == "response":
                assert hashlib.sha1(bytes(r.payload)).hexdigest() == r.payload_digest and len(r.payload) == r.http_length
        assert {len(r.payload) for r in got if r.record_id == "<urn:x-page:6>"} == {18 << 20}
    assert warc.archived(pages.limit(0)).count() == 0


def test_each_record_is_one_member(spark, tmp_path):
    """Other readers take each gzip member for a record, however long it is."""
    import gzip
    import zlib

    pages = spark.createDataFrame([(1, "u", "z" * (18 << 20)), (2, "v", "short")], "page_id bigint, url string, html string").coalesce(1)
    warc.write_warc(pages, str(tmp_path / "w"))
    (file,) = (tmp_path / "w").iterdir()
    data, members = file.read_bytes(), []
    assert gzip.decompress(data).startswith(b"WARC/1.1")
    while data:
        z = zlib.decompressobj(31)
        members.append(z.decompress(data))
        data = z.unused_data
    assert len(members) == 3 and all(m.startswith(b"WARC/1.1\r\n") and m.endswith(b"\r\n\r\n") for m in members)


def test_warc_false_magic(tmp_path):
    payload = random.Random(1).randbytes(400) + warc.MAGIC * 50
    inner = warc.member(warc.record(9, "in", b"not a record of this file", "0" * 40, None, "1970-01-01T00:00:00Z"), level=0)
    payload += inner + b"text behind it"
    data = b"".join(warc.member(warc.record(i, "u", payload, hashlib.sha1(payload).hexdigest(), None, "1970-01-01T00:00:00Z"), level=0) for i in range(40))
    (tmp_path / "x.warc").write_bytes(data)
    for size in (100, 977, len(data)):
        seen = []
        for start in range(0, len(data), size):
            with warc._open(f"file:{tmp_path}/x.warc") as f:
                seen += [a for a, _, _ in warc.records_of(f, start, min(start + size, len(data)))]
        assert len(seen) == 40 == len(set(seen))


# Mixing


def test_mixing_places_all_within_a_block(spark):
    rng = random.Random(2)
    rows = [(i, "t", "en", rng.choice(["a"] * 6 + ["b", "c", None, "odd"]), 1) for i in range(3000)] + [(1, "t", "en", "a", 1)] * 2
    out = mixing.mix_sources(docs(spark, rows).withColumn("slot", F.lit("mine")), {"a": 0.5, "b": 0.3, "c": 0.15}, other_weight=0.05, block_rows=8, resolution=20).collect()
    assert len(out) == len(rows) and len({(r.slot, r.place) for r in out}) == len(rows)
    share = dict(zip(["a", "b", "c", None], mixing.shares([0.5, 0.3, 0.15, 0.05], 20), strict=True))
    first = sorted({r.slot: r.source if r.source in ("a", "b", "c") else None for r in out if r.phase == 0}.items())
    done = Counter()
    for t, (slot, source) in enumerate(first):
        assert slot == t
        done[source] += 1
        assert all(abs(done[s] - (t + 1) * n / 20) < 1 for s, n in share.items())
    assert mixing.mix_sources(docs(spark, []), {"a": 1.0}).count() == 0


def test_schedules_fill_every_slot():
    rng = random.Random(3)
    for _ in range(100):
        n = rng.randint(1, 8)
        weights, blocks = [rng.random() + 0.01 for _ in range(n)], [rng.randint(0, 60) for _ in range(n)]
        slots = [r["start"] + k // r["share"] * r["round"] + r["slots"][k % r["share"]] for r in mixing.schedule(blocks, weights, 50) for k in range(r["to_block"] - r["from_block"])]
        assert sorted(slots) == list(range(sum(blocks)))


def test_exact_weights_stay_within_a_block():
    """In each phase, against the given weights: the query's with an unlisted source, a small one, and awkward decimals."""
    of = queries.WEIGHTS
    for weights, blocks in (([*of.values(), 0.01], [50, *[400] * 19, 30]), ([*of.values()], [900, *[400] * 19]), ([0.001, 0.999], [30, 5000]), ([0.1234567, 0.7654321, 1 / 3], [500, 700, 900])):
        rows = mixing.schedule(blocks, weights)
        slots = {}
        for r in rows:
            for k in range(r["to_block"] - r["from_block"]):
                slots[r["start"] + k // r["share"] * r["round"] + r["slots"][k % r["share"]]] = (r["phase"], r["source"])
        assert sorted(slots) == list(range(sum(blocks)))
        left = list(blocks)
        for phase in range(max(r["phase"] for r in rows) + 1):
            turn = [s for _, (p, s) in sorted(slots.items()) if p == phase]
            live = [i for i, n in enumerate(left) if n]
            total, done = sum(weights[i] for i in live), Counter()
            for t, s in enumerate(turn):
                done[s] += 1
                assert all(abs(done[i] - (t + 1) * weights[i] / total) < 1 + 1e-9 for i in live)
            left = [n - done[i] for i, n in enumerate(left)]


@pytest.mark.parametrize("long", [0, 3, 256])
def test_mixing_takes_weights_as_given(spark, monkeypatch, long):
    monkeypatch.setattr(mixing, "LONG", long)
    weights = {"a": 0.101, "b": 0.8989}
    rows = [(i, "t", "en", "a" if i % 9 == 0 else "b", 1) for i in range(3000)]
    out = mixing.mix_sources(docs(spark, rows), weights, other_weight=0.0001, block_rows=4).collect()
    places = {(r.slot, r.place) for r in out}
    assert len(places) == len(rows) == len(out) and max(s for s, _ in places) == len({s for s, _ in places}) - 1
    turn = sorted({(r.slot, r.source) for r in out if r.phase == 0})
    done = Counter()
    for t, (_, source) in enumerate(turn):
        done[source] += 1
        assert all(abs(done[s] - (t + 1) * w / 0.9999) < 1 for s, w in weights.items())


# Quality


def test_quality_edges(spark):
    out = {(r.doc_id, r.text): r for r in quality.quality_rules(docs(spark).withColumn("n_words", F.lit("mine"))).collect()}
    assert out[1, None].n_words == 0 and out[1, None].base_failed and not out[2, ""].kept
    w = words(LONG)
    c = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = {i + k for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if c[g] > 1 for k in range(3)}
    assert out[5, LONG].n_repeat_words == len(hit) and out[5, LONG].n_words == 20_000
    good = "The cat and the dog went to the house with a friend, and they were happy. " * 1 + " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)} of the" for i in range(60))
    kept = quality.keep_good(docs(spark, [(9, good, "en", "s", 1), (10, "!!", "en", "s", 1)])).collect()
    assert [r.doc_id for r in kept] == [9] and quality.keep_good(docs(spark, [])).count() == 0


# Language model


@pytest.mark.parametrize("group_bytes,segment_grams", [(300, 700), (6_000_000, 1 << 20)])
def test_lm(spark, group_bytes, segment_grams):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary[: 1 + rng.randrange(60)]) for _ in range(rng.randrange(80))) for _ in range(200)]
    rows = [(i, t, None, None, 1) for i, t in enumerate(texts)] + EDGES[:4] + [(7, "Same same", None, None, 1)] * 2 + [(8, "y" * 400, None, None, 1), (9, " \n\x0b lead and trail \t" * 40, None, None, 1)]
    out = lm.lm_scores(docs(spark, rows), F.col("doc_id") % 5 == 1, group_bytes=group_bytes, segment_grams=segment_grams).collect()
    assert len(out) == len(rows)
    tok = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()), None]
    c, pair = Counter(), Counter()
    for i, t, *_ in rows:
        if i is None or i % 5 != 1:
            c.update(tok(t))
            pair.update(zip([None, *tok(t)], tok(t), strict=False))
    n, norm = sum(c.values()), sum(c.values()) + 0.5 * (len(c) + 1)
    want = sorted((-1 if i is None else i, len(tok(t)), sum(c[w] > 0 for w in tok(t)), round(sum(math.log10((c[w] + 0.5) / norm) for w in tok(t)), 6)) for i, t, *_ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out) == want
    assert {r.train_tokens for r in out} == {n} and all(r.score <= 0 for r in out)
    level = lambda x: lm.VALUES[np.searchsorted(lm.STARTS, x, "right")]
    once = {i: sum(math.log10(min(1, (min(level(pair[a, w]), level(c[a])) + lm.MU * (level(c[w]) + 0.5) / norm) / (level(c[a]) + lm.MU))) for a, w in zip([None, *tok(t)], tok(t), strict=False)) for i, t, *_ in rows[:200]}
    some = [r for r in out if r.doc_id in once and r.doc_id not in (1, 2, 3, 5, 6, 7, 8, 9)]
    # But for false answers of the filter, of about one in a hundred probes, each score is that of the quantised counts.
    off = [abs(r.score - once[r.doc_id]) / r.n_tokens for r in some]
    assert sum(x < 1e-9 for x in off) > 20 and sum(off) / len(off) < 0.01 and max(off) < 0.1
    empty = lm.lm_scores(docs(spark, []), F.lit(False))
    assert empty.count() == 0
    none = lm.lm_scores(docs(spark, rows[:9]), F.lit(True)).collect()
    assert {r.train_tokens for r in none} == {0} and {r.n_known for r in none} == {0}


@pytest.mark.parametrize("n", [300, 400_000])
def test_filter_reads_what_was_put_in(n):
    """At the density that queries use, whatever the segment's size: no count reads too low, and few too high."""
    rng = np.random.default_rng(5)
    grams = np.unique(rng.integers(0, 1 << lm.GRAM_BITS, n).astype(np.uint64))
    counts = np.minimum(rng.zipf(1.5, len(grams)), 1 << 40)
    bloom = lm.made(grams, counts)
    level = np.searchsorted(lm.STARTS, counts, "right")
    assert abs(8 * len(bloom.bits) / level.sum() - lm.ENTRY_BITS) < 0.1 + lm.BLOCK_BITS / level.sum()
    got = bloom.levels(grams)
    assert (got >= level).all() and (got == level).mean() > 0.96
    others = np.setdiff1d(rng.integers(0, 1 << lm.GRAM_BITS, n).astype(np.uint64), grams)
    assert (bloom.levels(others) == 0).mean() > 0.96
    assert lm.made(grams[:0], counts[:0]).levels(grams).sum() == 0


def test_segments_sum_and_tell_words_apart():
    """Counts of several groups, and two words whose first 64 bits of hash are equal."""
    h = np.array([5, 5, 9], np.uint64)
    rows = [(b"", b"", h.tobytes(), np.array([1, 2, 1], np.uint32).tobytes(), bytes([3, 4, 0])), (b"", b"", h[:1].tobytes(), np.array([2], np.uint32).tobytes(), bytes([7]))]
    replies, distinct, _ = lm.answered(rows, lm.ENTRY_BITS)
    assert list(replies[0][2]) == [3, 11, 0] and list(replies[1][2]) == [11] and distinct == 2


def test_texts_are_cut_at_white_space():
    rng = random.Random(3)
    for _ in range(50):
        t = "".join(rng.choice("ab \n\t") for _ in range(rng.randrange(300))).encode()
        cut = list(lm.parts(t, 7))
        assert b"".join(cut) == t and [w for x in cut for w in x.split()] == t.split()


# Line dedup


def test_line_dedup_edges(spark):
    line = lambda s, n: " ".join(f"{s}{i}" for i in range(n))
    run = f"{line('a', 20)}\n{line('b', 20)}\n\n  {line('c', 20)}"
    rows = [(4, f"own\n{run}\ntail", 1), (9, f"{run}\nother", 2), (2, f"{line('a', 20)}\n{line('z', 60)}", 3), (None, run, 4), (5, None, 5), (6, "", 6), (7, "\n".join(["same line"] * 200), 7), (9, f"{run}\nother", 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, removed_lines int")
    out = [(r.doc_id, r.text, r.removed_lines) for r in linededup.line_dedup(df).collect()]
    got = {i: (t, n) for i, t, n in out}
    assert len(out) == len(rows) and got[4] == (f"own\n{run}\ntail", 0) and got[9] == ("other", 4) and got[None] == ("", 4)
    assert got[2][1] == 0 and got[5] == (None, 0) and got[6] == ("", 0) and got[7] == ("\n".join(["same line"] * 25), 175)
    assert linededup.line_dedup(df.limit(0)).count() == 0


def brute_lines(rows, least=50):
    """All lines in runs of least words that repeat an earlier run, by comparing all runs with all."""
    kept = {i: [(k, x.strip()) for k, x in enumerate(t.split("\n")) if x.strip()] for i, t in rows}
    runs = []
    for i, lines in kept.items():
        for a in range(len(lines)):
            have = 0
            for b in range(a, len(lines)):
                have += len(lines[b][1].split())
                if have >= least:
                    runs.append(((i, lines[a][0]), tuple(x for _, x in lines[a : b + 1]), lines[b][0]))
    first = {}
    for at, run, end in sorted(runs):
        first.setdefault(run, (at, end))
    gone = {i: set() for i, _ in rows}
    for (i, a), run, b in runs:
        (j, c), d = first[run]
        if (i, a) != (j, c):
            gone[i].update(range(max(a, d + 1) if i == j else a, b + 1))
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in rows}


@pytest.mark.parametrize("weak", [False, True])
def test_line_dedup_agrees_with_all_runs(spark, monkeypatch, weak):
    """Matches go on both ways to their ends, with whichever earlier text; shared fingerprints alone delete nothing."""
    if weak:
        monkeypatch.setattr(linededup, "fingerprint_of", lambda d: d[0] % 2)
    rng = random.Random(12)
    pool = [" ".join(f"{chr(97 + k)}{i}" for i in range(rng.choice([1, 3, 20, 49, 55]))) for k in range(26)]
    rows = []
    for i in range(40):
        lines = []
        while len(lines) < rng.randrange(1, 14):
            a = rng.randrange(26)
            lines += pool[a : a + rng.randrange(1, 6)] if rng.random() < 0.8 else [f"own{i} line{len(lines)}", ""]
        rows.append((i, "\n".join(lines)))
    found = linededup.repeated(spark.createDataFrame(rows, "doc_id bigint, text string").select(linededup.key_of(F.col("doc_id"), F.col("text")).alias("key"), F.col("text").cast("binary").alias("t")), 50) if weak else None
    if weak:  # in one process, where the weak fingerprint is seen
        lines = {i: linededup.digests(t.encode()) for i, t in rows}
        for _, ds, sizes in lines.values():
            hs = [linededup.fingerprint_of(d) for d in ds]
            assert all(a <= p <= b and sum(sizes[a : b + 1]) >= 50 for p, a, b in linededup.windows(hs, sizes, 50))
        assert found is not None
        return
    out = {r.doc_id: r.text for r in linededup.line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == brute_lines(rows) and out != dict(rows)


def test_unequal_windows_of_one_fingerprint_stay(spark):
    """One line is every window's fingerprint, but what stands around it differs."""
    common = min((f"line {i}" for i in range(500)), key=lambda x: linededup.fingerprint_of(linededup.digests(x.encode())[1][0]))
    rows = [(i, "\n".join([" ".join(f"a{i}_{j}" for j in range(30)), common, " ".join(f"b{i}_{j}" for j in range(30))])) for i in range(20)]
    rows += [(100, "\n".join([common, " ".join(f"b3_{j}" for j in range(30)), " ".join(f"c_{j}" for j in range(30))]))]
    out = {r.doc_id: (r.text, r.removed_lines) for r in linededup.line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), least_words=32).collect()}
    assert all(out[i] == (t, 0) for i, t in rows[:-1]) and out[100] == (rows[-1][1].split("\n")[2], 2)


# SimHash


def brute_components(rows, budget=3):
    fps = {i: simhash.fingerprint(None if t is None else t.encode()) for i, t in rows}
    root = {f: f for f in fps.values()}

    def up(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in itertools.combinations(root, 2):
        if bin(a ^ b).count("1") <= budget:
            root[up(a)] = up(b)
    least = {}
    for i, f in fps.items():
        least[up(f)] = min(i, least.get(up(f), i))
    return fps, {i: least[up(f)] for i, f in fps.items()}


@pytest.mark.parametrize("least_hot", [0, 20_000])
def test_simhash(spark, least_hot):
    from xxhash import xxh64_intdigest

    rng = random.Random(6)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(300):
        w = list(base) if i % 3 else [rng.choice(base) for _ in range(rng.randrange(30))]
        for _ in range(rng.randrange(6) if w else 0):
            w[rng.randrange(len(w))] = f"n{rng.randrange(99)}"
        rows.append((i, " ".join(w)))
    rows += [(1000, None), (1001, "")]
    fps, want = brute_components([(i, t) for i, t in rows])
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit("mine"))
    got = simhash.near_duplicates(df, least_hot=least_hot).collect()
    assert {r.doc_id: r.fp & (1 << 64) - 1 for r in got} == fps and {r.doc_id: r.component_id for r in got} == want
    a, b = xxh64_intdigest("a b c", 42), xxh64_intdigest("b c d", 42)
    assert simhash.fingerprint(b"A b  C\nd") == a & b and simhash.fingerprint(b"one TWO") == xxh64_intdigest("one two", 42)
    odd = [(1, "alpha beta gamma"), (1, "one two three four"), (None, "alpha beta gamma"), (None, "nobody has this id"), (None, "nobody has this id"), (2, "one two three four"), (1, "alpha beta gamma"), (8, None), (9, "  \n"), (7, "")]
    kept = simhash.keep_one(spark.createDataFrame(odd, "doc_id bigint, text string").withColumn("fp", F.lit("mine"))).collect()
    assert sorted(map(repr, kept)) == sorted(repr(kept[0].__class__(doc_id=i, text=t, fp="mine")) for i, t in [odd[0], odd[1], odd[3], odd[9]])
    edge = simhash.near_duplicates(docs(spark)).collect()
    assert len(edge) == len(EDGES) and {r.doc_id: r.component_id for r in edge}[2] == 1
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def is_candidate(c, d):
    apart = c ^ d
    quarters = np.stack([(apart >> np.uint64(s)) & np.uint64(0xFFFF) for s in (0, 16, 32, 48)])
    return bool(((np.bitwise_count(apart) <= simhash.CODE_DISTANCE) & (quarters == 0).any(axis=0)).any())


def brute_similar(rows):
    """Groups by all pairs: a quarter and five bits of one of the word codes, and the shingles' bits."""
    from tidewake.llm.simhash import WordHashes, most_differing, profile

    hashes = WordHashes()
    of = {i: profile(None if t is None else t.encode(), hashes) for i, t in rows}
    root = {i: i for i in of}

    def up(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(of), 2):
        if is_candidate(of[a][0], of[b][0]) and np.bitwise_count(of[a][1] ^ of[b][1]).sum() <= most_differing():
            x, y = sorted((up(a), up(b)))
            root[y] = x
    return {i: up(i) for i in of}


def test_keep_one_agrees_with_all_pairs(spark):
    """Groups of edited copies, some dense, among unlike texts and ones of the same words in another order."""
    rng = random.Random(13)
    rows = []
    for g in range(30):
        base = [f"g{g}w{rng.randrange(150)}" for _ in range(200)]
        rows.append(base)
        for _ in range(rng.choice([0, 1, 2, 25])):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 10])):
                w[rng.randrange(200)] = f"n{rng.randrange(9999)}"
            rows.append(w)
        rows.append(rng.sample(base, len(base)))
    rng.shuffle(rows)
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    want = brute_similar(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(df).collect()) == sorted(set(want.values()))
    roots = {r.key.id: bytes(r.root) for r in simhash.similar(df).collect()}
    least = {}
    for i in sorted(roots):
        least.setdefault(roots[i], i)
    assert all(least[roots[i]] == want[i] for i in roots)
    # Edits of a few words are caught, other orders of the same words are not.
    assert 30 < len(set(want.values())) < 150


def test_recall_of_similar_texts():
    """Pairs whose five-word shingles have a Jaccard similarity of 0.8 to 0.95: nine in ten are candidates and links."""
    rng = random.Random(14)
    hashes, hit, many = simhash.WordHashes(), 0, 0
    shingles = lambda w: set(zip(*(w[i:] for i in range(5)), strict=False))
    while many < 300:
        a = [f"w{int(rng.paretovariate(0.6)) % 4000}" for _ in range(rng.choice([60, 150, 400]))]
        b = list(a)
        for _ in range(rng.randrange(1, 1 + len(a) // 40)):
            b[rng.randrange(len(b))] = f"n{rng.randrange(9999)}"
        x, y = shingles(a), shingles(b)
        if 0.8 <= len(x & y) / len(x | y) <= 0.95:
            (c, v), (d, u) = (simhash.profile(" ".join(t).encode(), hashes) for t in (a, b))
            many += 1
            hit += is_candidate(c, d) and np.bitwise_count(v ^ u).sum() <= simhash.most_differing()
    assert hit / many >= 0.9


def test_open_nodes_find_all(spark):
    """Many fingerprints below one node, with the node opened further."""
    rng = random.Random(7)
    centre = rng.getrandbits(64)
    fps = {(centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5)))) & (1 << 64) - 1 for _ in range(400)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp bigint").select(F.col("fp").alias("node"), F.lit(0).alias("code"), "fp", F.lit(None).cast("binary").alias("wide"))
    for hot in (0, 10_000):
        pairs = simhash.links(df, 1, least_hot=hot)
        roots = {r.node: r.root for r in simhash.components(pairs).collect()}
        groups = Counter(roots.get(f, f) for (f,) in signed)
        root = {f: f for (f,) in signed}

        def up(f, root=root):
            while root[f] != f:
                f = root[f]
            return f

        for (a,), (b,) in itertools.combinations(signed, 2):
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= 3:
                root[up(a)] = up(b)
        assert sorted(groups.values()) == sorted(Counter(up(f) for (f,) in signed).values())


def test_components_of_a_path(spark):
    n = 60
    order = list(range(n))
    random.Random(8).shuffle(order)
    df = spark.createDataFrame(list(zip(order, order[1:], strict=False)), "a bigint, b bigint")
    assert {(r.node, r.root) for r in simhash.components(df).collect()} == {(i, 0) for i in range(1, n)}


# Licences


def test_licences(spark):
    text = {n: t[-2] if n != "MIT" else next(x for x in t if x.startswith("MIT License")) for n, t in licences.templates().items() if len(t) > 1}
    mit = text["MIT"].replace("2000 the copyright holders", "2019 Jane Q. Public and others")
    bsd = next(x for x in licences.templates()["BSD-3-Clause"] if "Neither" in x).replace("2000 the copyright holder", "2001-2020, Some Company")
    gpl = next(x for x in licences.templates()["GPL-3.0"] if len(x) > 9999)
    apache = next(x for x in licences.templates()["Apache-2.0"] if len(x) > 9999)
    notice = "\n".join("# " + x for x in ["Copyright 2020 The Authors. All code.", "", *re.findall(r".{20,60}(?: |$)", licences.NOTICES["Apache-2.0"][1])])
    head = "\n".join(" * " + x for x in ["Copyright (c) 2011 Someone", *mit.split("\n")[4:]])
    code = "\n".join(f"name{i} = call{i}(value{i})" for i in range(200))
    prose = "plain prose of no licence at all, which talks of software and of the right to use it, at length"
    rows = [
        (1, "r/a/LICENSE", mit), (2, "r/a/b/c/x.py", prose), (3, "r/z.py", "prose"), (4, "r/a/y.py", "Some prose stands here, long and plain.\n# Licensed under the Apache License, Version 2.0.\nmore"),
        (5, "r/a/b/COPYING", "Licensed under CC BY-NC 4.0."), (6, None, None), (7, "r/a/e.txt", ""), (2, "r/a/b/c/x.py", prose),
        (8, "s/LICENSE.txt", bsd), (9, "/s/deep/er/file.c", prose), (10, "t/COPYING", gpl), (11, "t//u/v.c", prose), (12, "u/LICENSE", apache), (13, "u/w.c", None),
        (14, "v/n.py", notice + "\n\nimport this\n" + code), (15, "v/m.c", "/*\n" + head + "\n */\nint main() { return 0; }\n" + code), (16, "v/k.js", "// SPDX-License-Identifier: MPL-2.0\n" + prose),
        (None, None, prose), (None, None, "All rights reserved."), (17, "v/r", "Copyright (c) 2020 X. All rights reserved."),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, path string, text string").withColumn("licence", F.lit(1))
    out = licences.licence_scan(df).collect()
    got = {r.doc_id: (r.licence, r.origin, r.origin_id) for r in out if r.doc_id}
    assert len(out) == len(rows)
    assert got == {
        1: ("MIT", "file", 1), 2: ("CC-BY-NC-4.0", "inherited", 5), 3: (None, None, None), 4: ("Apache-2.0", "header", 4), 5: ("CC-BY-NC-4.0", "file", 5), 6: (None, None, None), 7: ("MIT", "inherited", 1),
        8: ("BSD-3-Clause", "file", 8), 9: ("BSD-3-Clause", "inherited", 8), 10: ("GPL-3.0", "file", 10), 11: ("GPL-3.0", "inherited", 10), 12: ("Apache-2.0", "file", 12), 13: ("Apache-2.0", "inherited", 12),
        14: ("Apache-2.0", "header", 14), 15: ("MIT", "header", 15), 16: ("MPL-2.0", "header", 16), 17: ("all-rights-reserved", "file", 17),
    }
    assert sorted((r.licence or "", r.text) for r in out if r.doc_id is None) == [("", prose), ("all-rights-reserved", "All rights reserved.")]
    assert licences.licence_scan(df.limit(0)).count() == 0


def test_licences_agree_with_brute_force(spark):
    """Cosines of all passages with all templates, and the nearest directory above, worked out one by one."""
    texts = {"A": ["alpha beta gamma delta.", "alpha alpha omega"], "B": ["beta beta omega psi chi"], "C": ["kappa"]}
    rng = random.Random(15)
    pool = "alpha beta gamma delta omega psi chi kappa lambda mu nu xi".split()
    rows = []
    for i in range(150):
        parts = [" ".join(rng.choice(pool[: rng.choice([4, 7, 12])]) for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(4))]
        path = "/".join([*rng.choices("pqr", k=rng.randrange(4)), f"f{i}"])
        rows.append((i, path if rng.random() < 0.95 else None, rng.choice(["\n", "\n\n", ".\n# "]).join(parts) if rng.random() < 0.95 else None))
    ws = lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w]
    df = Counter(w for _, _, t in rows for w in set(ws(t or "")))
    forms = [(n, Counter(ws(t))) for n, own in texts.items() for t in own]
    vocabulary = {w for _, c in forms for w in c}
    idf = lambda w: math.log((1 + len(rows)) / (1 + (df[w] if w in vocabulary else 0))) + 1

    def best(p):
        v = {w: n * idf(w) for w, n in Counter(ws(p)).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        found = []
        for name, c in forms:
            t = {w: n * idf(w) for w, n in c.items()}
            cos = round(sum(v.get(w, 0) * x for w, x in t.items()) / (norm * math.sqrt(sum(x * x for x in t.values()))), 9) if norm else 0
            if cos >= 0.8:
                found.append((-cos, name))
        return min(found) if found else None

    own, given = {}, {}
    for i, path, t in rows:
        if t and (b := best(t)):
            own[i] = (b[1], "file", i)
            if path:
                given.setdefault(tuple(path.split("/")[:-1]), []).append((b[0], i, b[1]))
        elif t:
            lines = t.split("\n")
            code = next((k for k, x in enumerate(lines) if not re.match(licences.COMMENT, x)), 0)
            found = [b for p in [*lines, *regex.split(licences.NO_TEXT, t), "\n".join(lines[:code])] if (b := best(p))]
            if found:
                own[i] = (min(found)[1], "header", i)
    for i, path, _ in rows:
        if i not in own and path:
            at = tuple(path.split("/")[:-1])
            up = next((given[at[:k]] for k in range(len(at), -1, -1) if at[:k] in given), None)
            if up:
                own[i] = (min(up)[2], "inherited", min(up)[1])
    out = {r.doc_id: (r.licence, r.origin, r.origin_id) for r in licences.licence_scan(spark.createDataFrame(rows, "doc_id bigint, path string, text string"), texts=texts).collect()}
    assert out == {i: own.get(i, (None, None, None)) for i, _, _ in rows} and Counter(x[1] for x in out.values()).keys() == {"file", "header", "inherited", None}


def test_planted_licences_are_found(spark):
    out = {r.doc_id: r.licence for r in queries.op8_licence_scan(spark, SF).collect()}
    marks = {"Apache License": "Apache-2.0", "MIT License": "MIT", "GNU General": "GPL-3.0", "CC BY-NC": "CC-BY-NC-4.0", "All rights reserved.": "all-rights-reserved"}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        for mark, name in marks.items():
            if any(mark in x and len(x) < 90 for x in r.text.split("\n")):
                assert out[r.doc_id] == name


# Chat


def test_chat(spark):
    rows = [(1, 0, "u", "Hello there\nHow are you"), (1, 1, "a", "> hello   THERE\nFine"), (1, 2, "u", ">> Hello there\n> Fine\nGood"), (1, 3, "u", "> never said\nok"), (1, 4, "a", "> Good\n> ok\nbye"), (2, 0, "u", "> Hello there\nno"), (None, 0, "u", "x"), (3, 0, "u", None), (1, 1, "a", "> hello   THERE\nFine")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("depth", F.lit("mine"))
    out = chat.reply_order(df).collect()
    assert len(out) == len(rows)
    got = {(r.conv_id, r.turn): (r.parent_turn, r.root_turn, r.depth, r.text) for r in out}
    assert got[1, 1] == (0, 0, 1, "Fine") and got[1, 2] == (1, 0, 2, "Good") and got[1, 3] == (None, 3, 0, "ok") and got[1, 4] == (2, 0, 3, "bye")
    assert got[2, 0] == (None, 0, 0, "no") and got[3, 0][3] is None and got[None, 0][3] == "x"
    # Broken into other lines, quoted in part, and linked through a deeper level where the direct parent is not there.
    rows = [(5, 0, "u", "One long sentence stands here. Another one\ngoes over two lines! Third."), (5, 1, "a", "> Another\n> one goes\n>   over two lines!\n\nReply."), (5, 2, "u", ">> another one goes over two lines!\n> Lost message.\nSo."), (5, 3, "a", "> So.\n>> Reply.\nEnd"), (5, None, "u", "> So."), (5, 4, "u", "long " * 50_000 + "\n> End")]
    rows += [(6, i, "u", "root" if i == 0 else "> root\nme too") for i in range(300)]
    out = {(r.conv_id, r.turn): r for r in chat.reply_order(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    link = lambda t: (out[5, t].parent_turn, out[5, t].parent_level, out[5, t].root_turn, out[5, t].depth)
    assert [link(t) for t in range(5)] == [(None, None, 0, 0), (0, 1, 0, 1), (0, 2, 0, 1), (2, 1, 0, 2), (3, 1, 0, 3)]
    assert out[5, None].parent_turn is None and all(out[6, i].parent_turn == 0 for i in range(1, 300))
    assert chat.reply_order(df.limit(0)).count() == 0


# Search


def test_topk_edges(spark):
    rng = random.Random(9)
    v = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(60)]
    rows = [(i, x) for i, x in enumerate(v)] + [(100 + i, v[0]) for i in range(20)] + [(200, None), (201, []), (202, [1.0, None])]
    out = topk.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), F.col("vec_id") % 50 == 0, k=5).collect()
    code = lambda x: [a > 0 for a in x]
    for q in (0, 50, 100):
        own = dict(rows)[q]
        near = sorted((sum(a != b for a, b in zip(code(own), code(x), strict=True)), i) for i, x in rows[:80] if i != q)[:5]
        assert [(r.distance, r.neighbour_id) for r in sorted((r for r in out if r.query_id == q), key=lambda r: r.rank)] == near
    assert {r.query_id for r in out} == {0, 50, 100}
    assert topk.search(spark.createDataFrame([], "vec_id bigint, embedding array<float>"), F.lit(True)).count() == 0


def test_topk_of_other_widths_ids_and_full_buckets(spark, monkeypatch):
    """100 dimensions, ids that are text, and buckets that are dealt out."""
    monkeypatch.setattr(topk, "BUCKET_CODES", 5)
    rng = random.Random(10)
    centre = [rng.gauss(0, 1) for _ in range(100)]
    rows = [(f"v{i:03}", [x if j < 32 else x + rng.gauss(0, 2) for j, x in enumerate(centre)]) for i in range(120)] + [("short", centre[:40]), (None, centre)]
    out = topk.search(spark.createDataFrame(rows, "vec_id string, embedding array<double>"), F.col("vec_id").isin("v000", "v050", "short"), k=4).collect()
    code = lambda x: [a > 0 for a in x] + [False] * (112 - len(x))
    for q in ("v000", "v050", "short"):
        near = sorted((sum(a != b for a, b in zip(code(dict(rows)[q]), code(x), strict=True)), i) for i, x in rows if i and i != q)[:4]
        assert [(r.distance, r.neighbour_id) for r in sorted((r for r in out if r.query_id == q), key=lambda r: r.rank)] == near


def rows_made(spark, since, node):
    """Rows that nodes of a name made, in SQL executions from a number on."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store, made = spark._jsparkSession.sharedState().statusStore(), 0
    for i in range(since, store.executionsCount()):
        run = store.executionsList(i, 1).head()
        values, nodes = store.executionMetrics(run.executionId()), store.planGraph(run.executionId()).allNodes()
        for n in (nodes.apply(k) for k in range(nodes.size())):
            metrics = [n.metrics().apply(k) for k in range(n.metrics().size())] if n.name() == node else []
            got = [values.get(m.accumulatorId()) for m in metrics if m.name() == "number of output rows"]
            made += sum(int(v.get().replace(",", "")) for v in got if v.isDefined())
    return made


def test_topk_makes_only_pairs_that_may_be_among_the_nearest(spark):
    """Of unlike codes, a join makes pairs within a query's k-th distance so far, not all that share a bucket."""
    rng = np.random.default_rng(11)
    v = rng.normal(size=(3000, 64))
    v[2900:] = v[:100] * rng.choice([1, 1, 1, -1], size=(100, 64))  # some nearer ones
    ids, code = range(0, 3000, 50), v > 0
    since = spark._jsparkSession.sharedState().statusStore().executionsCount()
    out = topk.search(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.distance, r.neighbour_id))
    assert got == {q: sorted((int((code[q] != x).sum()), i) for i, x in enumerate(code) if i != q)[:10] for q in ids}
    assert 0 < rows_made(spark, since, "SortMergeJoin") < 3000 * len(ids) / 20


CLASHING = "_0_ key n id path licence origin given own dir hot salt start end share slots from_block _sum ranges removed_lines node wide _source _hash slot place words _words _at kept n_words pieces _conv _turn up parent_turn".split()


def clashing(df):
    """df with columns of all names that operators use inside, and of those they add."""
    have = {c.lower() for c in df.columns}
    return df.withColumns({c: F.lit(f"mine {c}") for c in CLASHING if c not in have})


@pytest.mark.parametrize("name", ["pieces", "mixing", "quality", "keep_good", "lines", "similar", "licences", "chat"])
def test_names_that_clash(spark, model, name):
    """Each operator gives what it gives without them, and hands on all but those that it adds itself."""
    plain = docs(spark).withColumn("path", F.concat(F.lit("a/"), "source"))
    if name == "chat":
        plain = spark.createDataFrame([(1, 0, "u", "Hello there"), (1, 1, "a", "> hello THERE\nFine"), (None, None, "u", None)], "conv_id bigint, turn bigint, role string, text string")
    run = {
        "pieces": lambda d: pieces.encode_and_verify(d, model), "mixing": lambda d: mixing.mix_sources(d, {"src0": 0.5, "src1": 0.5}, block_rows=2), "quality": quality.quality_rules, "keep_good": quality.keep_good,
        "lines": linededup.line_dedup, "similar": simhash.keep_one, "licences": licences.licence_scan, "chat": chat.reply_order,
    }[name]
    want, given = run(plain), clashing(plain)
    got = run(given)
    assert set(got.columns) == set(given.columns) | set(want.columns)
    same = [c for c in want.columns if c not in ("slot", "place", "phase")]
    assert sorted(map(repr, got.select(*same).collect())) == sorted(map(repr, want.select(*same).collect()))
    added = set(want.columns) - set(plain.columns)
    for c in set(given.columns) - set(plain.columns) - added:
        assert {r[0] for r in got.select(c).distinct().collect()} <= {f"mine {c}"}


def test_null_ids_are_told_apart(spark):
    """Null ids and paths: each row is judged for itself, and the mixture deals them out."""
    rows = [(None, f"text number {i}", "en", "src0", i) for i in range(300)]
    out = mixing.mix_sources(docs(spark, rows), {"src0": 1.0}, block_rows=8).collect()
    assert len({(r.slot, r.place) for r in out}) == 300
