"""Operators of ``fileflow.llm`` against brute force, round trips, held-out accuracy and planted cases."""

import base64
import hashlib
import itertools
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
import xxhash
import zstandard
from pyspark.sql import functions as F

from conftest import SF
from fileflow.llm import (decontaminate, langid, linededup, mixing, pseudonyms, rollup, simhash, sketch, toxicity, warc)
from fileflow.llm.common import held_out
from fileflow.session import scratch_path, ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "one", "en", None, 3), (3, "one", "en", None, 3),
       (None, "two words", None, "b", 9), (5, "x " * 30_000, "de", "a", 60_000), (6, "!!! 123", "fr", "c", 7)]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(rng, n, vocabulary=None):
    vocabulary = vocabulary or ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    return [rng.choice(vocabulary) for _ in range(n)]


# --- 1 language id -------------------------------------------------------------------------------

def test_forward_sums_all_segmentations():
    pieces = [b"a", b"b", b"ab", b"ba", b"aba"]
    index = langid.Pieces(pieces)
    p = np.random.default_rng(1).random((5, 2))
    for word in (b"ababa", b"b", b"aabba"):
        want = np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            parts, last = [], 0
            for i, c in enumerate([*cuts, 1], 1):
                if c:
                    parts.append(word[last:i])
                    last = i
            if all(x in pieces for x in parts):
                want += np.prod([p[pieces.index(x)] for x in parts], axis=0)
        row = np.frombuffer(word, np.uint8)[None]
        assert np.allclose(langid.forward(index.lattice(row), 1, len(word), p)[-1][0], want)


def test_expected_uses_add_up_to_the_words():
    pieces = [b"a", b"b", b"ab"]
    p = np.array([[0.3], [0.3], [0.4]])
    uses = langid.expected([b"ab"], np.array([2.0]), np.array([0]), langid.Pieces(pieces), p)
    share = 0.4 / (0.4 + 0.09)  # "ab" whole against a + b
    assert np.allclose(uses[:, 0], [2 * (1 - share), 2 * (1 - share), 2 * share])


def test_long_words_sum_over_all_segmentations():
    rng = np.random.default_rng(4)
    letters = [bytes([c]) for c in b"abc"]
    long_piece = bytes(rng.choice(list(b"abc"), 60).tolist())  # longer than a run
    pieces = [*letters, b"ab", b"bca", b"ccab", long_piece]
    index, p = langid.Pieces(pieces), rng.random((7, 2)) / 4
    for n in (49, 96, 500, langid.WINDOW + 30):
        word = bytes(rng.choice(list(b"abc"), n).tolist())
        word = (word[:20] + long_piece + word[20:])[: max(n, 80)]
        # the whole lattice at once, in logs
        alpha = np.full((len(word) + 1, 2), -np.inf)
        alpha[0] = 0
        for i in range(len(word)):
            for piece, q in zip(pieces, p):
                if word.startswith(piece, i):
                    alpha[i + len(piece)] = np.logaddexp(alpha[i + len(piece)], alpha[i] + np.log(q))
        steps = langid.long_steps(word, index, p)
        assert len(steps) == -(-len(word) // langid.RUN) and np.allclose(steps.sum(axis=0), alpha[-1])


@pytest.mark.parametrize("window", [langid.RUN, langid.WINDOW])
def test_expected_uses_of_long_words(monkeypatch, window):
    monkeypatch.setattr(langid, "WINDOW", window)
    pieces = [b"a", b"b", b"ab", b"ba", b"aba", b"ab" * 30]
    index, p = langid.Pieces(pieces), np.random.default_rng(2).random((6, 1))
    words = [bytes(np.random.default_rng(n).choice(list(b"ab"), n).tolist()) for n in (50, 144, 201)]
    words[1] = words[1][:30] + b"ab" * 35 + words[1][100:]
    got = langid.expected(words, np.array([1.0, 2.0, 1.0]), np.zeros(3, np.int64), index, p)
    monkeypatch.setattr(langid, "RUN", 1000)  # the short words' pass, unsplit
    want = langid.expected(words, np.array([1.0, 2.0, 1.0]), np.zeros(3, np.int64), index, p)
    assert np.allclose(got, want) and got[5].sum() > 0
    assert np.isclose((got[:, 0] * [*map(len, pieces)]).sum(), 50 + 2 * len(words[1]) + 201)


def test_a_word_without_an_end():
    word = ("été" * 120_000).encode()
    pieces = langid.Pieces([bytes([b]) for b in range(256)] + ["été".encode(), "té".encode()])
    p = np.full((258, 2), 1e-4)
    p[256, 0] = 0.5
    scores = langid.word_scores([word, b" a"], pieces, p)
    assert np.isfinite(scores).all() and scores[0, 0] > scores[0, 1] and scores[1, 0] == scores[1, 1]


def test_langid_held_out(spark):
    got = langid.op1_langid(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert got.count() == docs.count()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_langid_odd_rows(spark, odd, empty):
    model = langid.train(odd.where("lang is not null"), rounds=1)
    rows = langid.predict(odd.withColumn("score", F.lit("clash")), model).collect()
    assert len(rows) == len(ODD)
    by = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert by[1] == by[2] == by[6] == "und" and by[3] in ("de", "en", "fr")
    assert langid.predict(empty, langid.train(empty)).count() == 0
    assert {r["lang_pred"] for r in langid.predict(odd, langid.train(empty)).collect()} == {"und"}


# --- 2 toxicity ----------------------------------------------------------------------------------

def test_counterfactual_penalty_evens_out_groups(spark):
    rng = random.Random(3)
    texts, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        group = "muslims" if rng.random() < (0.8 if bad else 0.1) else "christians"
        texts.append((i, " ".join([*words(rng, 12), group, *(["scumbag"] if bad and rng.random() < 0.7 else [])])))
        labels.append((i, int(bad)))
    docs, known = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    gap = []
    for penalty in (0.0, 20.0):
        m = toxicity.train(docs, known, penalty=penalty)
        s = toxicity.Scorer(m)
        gap.append(abs(s("here are muslims") - s("here are christians")))
        assert s("such a scumbag of a text") > 0.7
    assert gap[1] < 0.3 * gap[0]


def test_counterfactuals_swap_and_insert():
    assert set(toxicity.counterfactuals({"die", "Frauen".lower(), "blinde"})) == {
        *(("frauen", b) for b in ("männer", "mädchen", "jungen")), *(("blinde", b) for b in ("behinderte", "gehörlose"))}
    assert toxicity.counterfactuals({"men", "women"}) == [(a, b) for a in ("men", "women") for b in ("girls", "boys")]
    assert toxicity.counterfactuals({"no", "group"}) == toxicity.counterfactuals(set()) == [("", b) for b in toxicity.SWAPS]


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(5)
    place = {f: i for i, f in enumerate(["=women", "=men", "^wome", "=idiot", "$omen"])}
    pairs = {("women", "men"): 3, ("men", "women"): 1, ("", "women"): 2, ("", "boys"): 6}
    d, n = toxicity.changes(pairs, place)
    # every changed copy on its own: swaps and insertions are averaged apart, the place behind the features is the bias
    vector = {("women", "men"): [-1, 1, -1, 0, -1, 0], ("men", "women"): [1, -1, 1, 0, 1, 0],
              ("", "women"): [1, 0, 1, 0, 1, 0], ("", "boys"): [0] * 6}
    assert d.tolist() == [vector[p] for p in pairs]
    x, y = rng.integers(0, 2, (7, 6)).astype(float), rng.integers(0, 2, 7).astype(float)
    x[:, -1] = 1
    share, decay, w = np.full(7, 1 / 7), np.full(6, 0.01), rng.normal(size=6)

    def loss(w):
        z = [float(row @ w) for row in x]
        data = sum(s * (np.log1p(np.exp(a)) - b * a) for s, a, b in zip(share, z, y))
        kinds = [[p for p in pairs if bool(p[0]) is swap for _ in range(pairs[p])] for swap in (True, False)]
        change = sum(np.mean([float(np.dot(vector[p], w)) ** 2 for p in copies]) for copies in kinds)
        return data + 1.7 * change + float((decay * w * w).sum() / 2)

    steps = np.eye(6) * 1e-5
    want = [(loss(w + e) - loss(w - e)) / 2e-5 for e in steps]
    assert np.allclose(toxicity.gradient(w, x, y, share, d, n, 1.7, decay), want, atol=1e-5)


def test_penalty_on_the_given_tables(spark):
    """Terms planted in given documents, mostly toxic ones: the fit with the penalty moves little when one is named."""
    sf = SF.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    toxic = F.broadcast(labels.groupBy("doc_id").agg(F.max("toxic").alias("_t")))
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(10))
    named = F.when(((F.col("_t") == 1) & (pick < 8)) | (pick == 9), F.concat("text", F.lit(" Ausländer immigrants")))
    docs = (spark.read.parquet(f"{sf}/documents.parquet").join(toxic, "doc_id", "left")
            .withColumn("text", F.coalesce(named, "text")).drop("_t"))
    change = []
    for penalty in (0.0, 1.0):
        m = toxicity.train(docs, labels, penalty=penalty)
        assert m.swapped > 0 and m.inserted > 0
        of = {w: sum(m.weights.get(f, 0.0) for f in toxicity.features(w)) for w in toxicity.SWAPS}
        change.append(abs(of["ausländer"]) + abs(of["immigrants"]))
    assert change[0] > 0.5 and change[1] < 0.5 * change[0]  # measured: 5.05 and 1.61


def test_toxicity_takes_one_text_an_id(spark, monkeypatch):
    docs = spark.createDataFrame([(k % 4, f"some text {k}") for k in range(200)] + [(4, None), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(5)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda rows, y, n, *_: (seen.append(sorted(y)), (np.zeros(n), 0.0))[1])
    assert toxicity.train(docs, labels) is not None and seen == [[0, 0, 0, 1, 1]]


def test_toxicity_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1), (3, None), (5, 0), (None, 1), (2, 0)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels, min_rows=1, min_chi2=0.0)
    rows = toxicity.score(odd.withColumn("predicted", F.lit("clash")), model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.train(odd, labels.where("toxic = 0")) is None
    assert {r["score"] for r in toxicity.score(odd, None).collect()} == {0.0}
    assert toxicity.score(empty, model).count() == 0


# --- 3 mixing ------------------------------------------------------------------------------------

def heap_seats(votes, seats, caps):
    got = [0] * len(votes)
    for _ in range(seats):
        best = max((i for i in range(len(votes)) if got[i] < caps[i] and votes[i] > 0), key=lambda i: (votes[i] / (2 * got[i] + 1), -i), default=None)
        if best is None:
            break
        got[best] += 1
    return got


def test_sainte_lague_equals_single_seats():
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randint(1, 8)
        votes, caps = [rng.randint(0, 50) for _ in range(n)], [rng.randint(0, 40) for _ in range(n)]
        seats = rng.randint(0, 90)
        assert mixing.sainte_lague(votes, seats, caps).tolist() == heap_seats(votes, seats, caps)


def test_targets_share_the_excess():
    t = mixing.targets([10, 1000, 1000], [5, 2, 1])
    assert t[0] == 30 and math.isclose(t.sum(), 2010) and math.isclose(t[1] / t[2], 2)
    assert mixing.targets([0, 0], [5, 2]).tolist() == [0, 0]


def test_taken_words_against_single_blocks():
    rng = random.Random(2)
    for _ in range(30):
        sizes, block = np.array([rng.randint(0, 40) for _ in range(rng.randint(1, 9))]), rng.randint(1, 12)
        often = np.array([rng.randint(0, 3) for _ in range(-(-sizes.sum() // block))], np.int64)
        stream = np.repeat(often, block)[: sizes.sum()] if len(often) else np.zeros(0, int)
        ends = np.cumsum(sizes)
        want = [int(stream[e - s: e].sum()) for s, e in zip(sizes, ends)]
        assert mixing.taken_words(sizes, often, block).tolist() == want
        for s, e, w in zip(sizes, ends, want):
            assert sum((b - a) * k for a, b, k in mixing.spans_of(int(e - s), int(s), often, block)) == w


def test_mix_meets_targets_and_reruns(spark):
    rows = mixing.op3_mixing(spark, SF).collect()
    again = mixing.op3_mixing(spark, SF).repartition(3).collect()
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    taken, target = Counter(), {}
    for r in rows:
        taken[r["source_size"], r["target"]] += r["taken"]
        target[r["source_size"], r["target"]] = r["target"]
    n_same = Counter((r["source_size"], r["target"]) for r in mixing.op3_mixing(spark, SF).select("source_size", "target").distinct().collect())
    for k, t in target.items():
        assert abs(taken[k] - t * n_same[k]) <= max(128, 0.02 * t)


def test_shard_quotas_are_highest_quotients():
    rng = random.Random(8)
    for _ in range(400):
        block = rng.choice([1, 3, 10])
        shard_words, repeats = block * rng.randint(1, 6), rng.choice([1, 3])
        words = rng.randint(1, shard_words * 5)
        votes = [min(shard_words, words - at) for at in range(0, words, shard_words)]
        caps = [repeats * -(-v // block) for v in votes]
        seats = rng.randint(0, sum(caps) + 1)
        got = [mixing.shard_quota(i, words, shard_words, seats, block, repeats) for i in range(len(votes))]
        assert got == mixing.sainte_lague(votes, seats, caps).tolist()


def brute_mix(rows, block, shard_words, repeats=3, seed=20):
    """taken and its spans of (id, size, source) rows, word by word."""
    rows = sorted(rows, key=lambda r: (r[2] is None, r[2] or "", r[0] is not None, r[0] or 0, r[1]))
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(n for _, n, s in rows if s == x) for x in sources]
    aim = mixing.targets(sizes, [(5.0, 2.0, 1.0)[i % 3] for i in range(len(sources))], repeats)
    full = [a >= repeats * n for a, n in zip(aim, sizes)]
    caps = [repeats * -(-n // block) for n in sizes]
    seats = mixing.sainte_lague([0 if f else a for a, f in zip(aim, full)], int(sum(a for a, f in zip(aim, full) if not f) / block + 0.5), caps)
    out = []
    for x, n, f, cap, got in zip(sources, sizes, full, caps, seats):
        code = zlib.crc32((x or "").encode()) + (x is None)
        votes = [min(shard_words, n - at) for at in range(0, n, shard_words)]
        shards = mixing.sainte_lague(votes, cap if f else int(got), [repeats * -(-v // block) for v in votes])
        often = [k for i, (v, q) in enumerate(zip(votes, shards)) for k in mixing.drawn(-(-v // block), int(q), [seed, code, i])]
        at = 0
        for r in (r for r in rows if r[2] == x):
            out.append((r, [int(often[w // block]) for w in range(at, at + r[1])]))
            at += r[1]
    return out


@pytest.mark.parametrize("block,shard_words", [(4, 12), (7, 7), (64, 1 << 20)])
def test_mix_equals_word_by_word(spark, block, shard_words):
    rng = random.Random(block)
    rows = [(rng.choice([None, *range(40)]), rng.choice([0, 1, 3, 30]), rng.choice(["a", "a", "b", None, "c"])) for _ in range(120)]
    rows += [(5, 9, "a")] * 40  # a third of them the same row
    docs = spark.createDataFrame([(i, "w " * n, s, "extra") for i, n, s in rows], "doc_id long, text string, source string, size string").repartition(5)
    got = mixing.mix(docs, keep=docs.columns, block_words=block, shard_words=shard_words, spans=True).collect()
    flat = lambda r: [k for k in r["taken_spans"]]
    times = []
    for r in got:
        of = [0] * r["size"]
        for first, past, k in flat(r):
            of[first:past] = [k] * (past - first)
        times.append(((r["doc_id"], r["size"], r["source"]), of))
        assert sum(of) == r["taken"] and len(r["text"].split()) == r["size"]
    assert sorted(map(str, times)) == sorted(map(str, brute_mix(rows, block, shard_words)))
    light = mixing.mix(docs, block_words=block, shard_words=shard_words).collect()
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in light) == Counter((r["doc_id"], r["size"], r["taken"]) for r in got)


def test_mix_odd_rows(spark, odd, empty):
    clash = odd.withColumn("taken", F.lit("x")).withColumn("shard", F.lit(1))
    rows = mixing.mix(clash, keep=clash.columns, spans=True).collect()
    assert len(rows) == len(ODD) and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert mixing.mix(empty).count() == 0


# --- 4 WARC --------------------------------------------------------------------------------------

def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(i, f"http://e/{i}\r\nX: y", f"<p>{i % 5} ünï</p>" * (i % 7 + 1)) for i in range(60)]
                                  + [(100, None, None), (101, "u", ""), (None, "v", "alone"), (102, "w", "z" * 300_000), (102, "w", "z" * 300_000)],
                                  "page_id long, url string, html string").repartition(3)
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages, path)
    got = warc.read_archives(spark, path).collect()
    assert len(got) == pages.count() and all(r["error"] is None for r in got)
    html = {r["page_id"]: (r["html"] or "").encode() for r in pages.collect()}
    last = {}
    for k, v in html.items():
        last[v] = max(last.get(v, -1), -1 if k is None else k)
    for r in got:
        k = re.match(r"<urn:page:(\d*)>", r["record_id"])[1]
        v = html[int(k) if k else None]
        assert r["payload_bytes"] == len(v)
        assert r["payload_digest"] == __import__("base64").b32encode(hashlib.sha1(v).digest()).decode()
        if r["warc_type"] == "revisit":
            assert r["refers_to"] == f"<urn:page:{last[v]}>" and last[v] != int(k)
        else:
            assert r["payload"] == v
    assert sum(r["warc_type"] == "revisit" for r in got) == 60 - len({html[i] for i in range(60)}) + 1


def test_frames_and_bad_records():
    dictionary = zstandard.train_dictionary(2048, [f"WARC/1.1 record {i} ".encode() * 9 for i in range(300)])
    encode = zstandard.ZstdCompressor(dict_data=dictionary).compress
    good = warc.record(1, "u", b"abc", 3, warc.base64.b32encode(hashlib.sha1(b"abc").digest()).decode(), None)
    packed = zstandard.ZstdCompressor().compress(dictionary.as_bytes())  # a dictionary may be compressed itself
    for lead in (dictionary.as_bytes(), packed):
        data = warc.skippable(lead) + encode(good) + warc.SEPARATOR.encode() + encode(good.replace(b"abc", b"abd")) + encode(good)[:-3]
        got = list(warc.frames(data))
        assert [e is None for _, _, e in got] == [True, True, False]
        assert warc.http_payload(warc.parse(got[0][1])[""]) == (3, b"abc")
        with pytest.raises(warc.BadRecord, match="digest"):
            warc.parse(got[1][1])
    for broken, why in ((good.replace(b"WARC/1.1", b"HTTP/1.1"), "version"), (good[:-2], "length"), (good + b"x", "length"),
                        (good.replace(b"WARC-Date", b"X-Date"), "warc-date"), (b"WARC/1.1", "end of headers")):
        with pytest.raises(warc.BadRecord, match=why):
            warc.parse(broken)
    assert list(warc.frames(b"")) == [] and list(warc.frames(b"no archive"))[0][2]


# --- 5 fingerprints ------------------------------------------------------------------------------

def test_sketch_estimates_and_merges():
    rng = random.Random(4)
    a, b = words(rng, 3000), words(rng, 3000)
    text = {"a": " ".join(a), "b": " ".join(a[:1500] + b[:1500])}
    sets = {k: {tuple(t.split()[i: i + 5]) for i in range(len(t.split()) - 4)} for k, t in text.items()}
    s = {k: sketch.sketch(t) for k, t in text.items()}
    true = len(sets["a"] & sets["b"]) / len(sets["a"] | sets["b"])
    assert abs(sketch.resemblance(s["a"], s["b"]) - true) < 0.13
    assert abs(sketch.containment(s["a"], s["b"]) - len(sets["a"] & sets["b"]) / len(sets["a"])) < 0.2
    assert abs(sketch.distinct_shingles(s["a"]) / len(sets["a"]) - 1) < 0.3
    assert (sketch.merge(s["a"], s["a"]) == s["a"]).all()
    assert (sketch.decode(sketch.encode(s["a"])) == s["a"]).all()
    assert sketch.encode(sketch.sketch(None)) == sketch.encode(sketch.sketch(" \n")) == ""


def test_merged_is_the_sketch_of_all(spark):
    rng = random.Random(5)
    texts = [" ".join(words(rng, 80)) for _ in range(12)]
    rows = spark.createDataFrame([(i % 2, sketch.encode(sketch.sketch(t))) for i, t in enumerate(texts)] + [(0, None)], "k int, fingerprint string")
    got = {r["k"]: r["fingerprint"] for r in sketch.merged(rows, "k").collect()}
    for k in (0, 1):
        want = np.unique(np.concatenate([sketch.sketch(t) for t in texts[k::2]]))[: sketch.K]
        assert got[k] == sketch.encode(want)


def test_neighbours_against_a_plain_loop(spark):
    rng = random.Random(6)
    rows = [(i * 3, " ".join(words(rng, rng.randint(0, 60))) + "é" * (i % 3)) for i in range(200)] + [(None, "null id"), (30, "again"), (900, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for per_range in (7, 50, 10_000):
        got = sketch.edited_likeness(docs, rows_per_range=per_range).collect()
        order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        want = []
        for (d, t), (_, n) in zip(order, [*order[1:], order[0]]):
            e = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
            want.append((str(d), len(t), hashlib.sha256(e.encode()).hexdigest(), sketch.encode(sketch.sketch(t)),
                         sketch.resemblance(sketch.sketch(t), sketch.sketch(n))))
        assert sorted((str(r[0]), r[1], r[2], r[3], r[6]) for r in got) == sorted(want)
    assert sketch.edited_likeness(docs.limit(0)).count() == 0


# --- 6 decontamination ---------------------------------------------------------------------------

def test_decontaminate_against_brute_force(spark):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abc") for _ in range(2)) for _ in range(6)]
    bench = [(i, " ".join(words(rng, rng.choice([0, 1, 3, 5, 9]), vocabulary))) for i in range(8)] + [(None, "zz yy"), (9, None), (0, "Q q")]
    docs = [(i, " ".join(words(rng, rng.randint(0, 60), vocabulary)).upper()) for i in range(60)] + [(70, None), (71, "ZZ-yy, zz"), (71, "é q Q")]
    item = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({k: k + 32 for k in range(65, 91)}))
    want = []
    for d, t in docs:
        w, hit, found = item(t), set(), set()
        for k, b in bench:
            b = item(b)
            n = min(5, len(b))
            wins = {tuple(b[i: i + n]) for i in range(len(b) - n + 1)} if b else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i: i + n]) in wins:
                    hit |= set(range(i, i + n))
                    found |= {str(k)} if k is not None else set()
        want.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    df, bf = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    for block in (4_000_000, 20):  # one block, and many
        got = decontaminate.decontaminate(df.withColumn("n_hit", F.lit("clash")), bf, n=5, block_words=block)
        assert sorted(map(tuple, got.select("doc_id", *decontaminate.ADDED).collect())) == sorted(want)
    assert decontaminate.decontaminate(df, bf.limit(0)).where("contaminated").count() == 0


def test_removed_spans(spark):
    docs = spark.createDataFrame([(1, "Keep this. ONE two, three! And é that."), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    rows = {r["doc_id"]: r["clean_text"] for r in decontaminate.decontaminate(docs, bench, remove_spans=True).collect()}
    assert rows == {1: "Keep this. ! And é that.", 2: None}


# --- 7 pseudonyms --------------------------------------------------------------------------------

def plain_feistel(x, a, b, kind, key):
    u, v = x // b, x % b
    h = lambda r, half: int(hashlib.sha256(f"{key}|{kind}|{r}|{half}".encode()).hexdigest()[:15], 16)
    for r in range(1, pseudonyms.ROUNDS + 1):
        if r % 2:
            u = (u + h(r, v) % a) % a
        else:
            v = (v + h(r, u) % b) % b
    return u * b + v


def test_feistel_is_the_plain_one_and_a_permutation(spark):
    got = spark.range(60).select(F.expr(pseudonyms.feistel("id", "6L", "10L", "'t'", "k'ey"))).collect()
    assert [r[0] for r in got] == [plain_feistel(x, 6, 10, "t", "k'ey") for x in range(60)]
    assert sorted(r[0] for r in got) == list(range(60))


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def test_pseudonyms_keep_formats_and_links(spark, odd, empty):
    text = ("card 4539 1488 0343 6467 or 4539148803436467, bad 4539148803436468; on 2024-02-29 and 29.02.2024, never 2023-02-29; "
            "ip 10.0.0.255 not 10.0.0.256; tel +1 (743) 555-3824; ssn 123-45-6789 not 666-12-1234; "
            "iban GB82 WEST 1234 5698 7654 32; mail Ann.b-7@mail.example.org")
    docs = spark.createDataFrame([(1, text), (2, "see 4539-1488-0343-6467 and Ann.b-7@mail.example.org")], "doc_id long, text string")
    one, two = (r.asDict() for r in pseudonymised(docs))
    t = one["text"]
    cards = re.findall(r"(\d{4} \d{4} \d{4} \d{4}) or (\d{16})", t)[0]
    assert cards[0].replace(" ", "") == cards[1] != "4539148803436467" and luhn(cards[1]) and cards[1][0] == "4"
    assert "-".join(cards[0].split()) in two["text"]
    assert "bad 4539148803436468" in t and "never 2023-02-29" in t and "not 10.0.0.256" in t and "not 666-12-1234" in t
    iso, dot = re.search(r"on (\S+) and (\S+),", t).groups()
    assert iso == "-".join(reversed(dot.split("."))) != "2024-02-29"
    assert all(int(x) < 256 for x in re.search(r"ip (\S+) not", t)[1].split("."))
    assert re.search(r"tel \+1 \(\d{3}\) \d{3}-\d{4};", t) and "555-3824" not in t
    iban = re.search(r"iban (\S+ \S+ \S+ \S+ \S+ \S+);", t)[1].replace(" ", "")
    assert iban[:2] == "GB" and iban[4:8] == "WEST" and int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    mail = re.search(r"mail (\S+@mail.example.org)$", t)[1]
    assert re.fullmatch(r"[A-Z][a-z]{2}\.[a-z]-\d@mail\.example\.org", mail) and mail in two["text"]
    assert (one["n_card"], one["n_date"], one["n_ipv4"], one["n_phone"], one["n_ssn"], one["n_iban"], one["n_mail"]) == (2, 2, 1, 1, 1, 1, 1)
    rows = {r["doc_id"]: r for r in pseudonymised(odd.withColumn("n_card", F.lit("clash")))}
    assert rows[1]["text"] is None and rows[1]["n_card"] == 0 and rows[5]["text"] == "x " * 30_000
    assert pseudonymised(empty) == []


def test_pseudonyms_next_to_other_digits(spark):
    card, iban = "4111 1111 1111 1111", "ES91 2100 0418 4502 0005 1332"
    texts = [f"pay {card} 12/27", "card 4111111111111111 5 items", f"card {card} 123", f"{iban} USD", f"ref 12345 {card} paid",
             f"{card} 4539 1488 0343 6467", f"{card}-77 on 2024-02-29", "call +1 415 555 2671 2024", "call +1 415 555 2671", f"{card}", f"{iban}",
             "1-123-45-6789 1234", "4111 1111 1111 1112 12"]
    rows = pseudonymised(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    new = [r["text"] for r in rows]
    p, q = new[9], new[10]
    assert p != card and luhn(p.replace(" ", "")) and q != iban
    assert new[:4] == [f"pay {p} 12/27", f"card {p.replace(' ', '')} 5 items", f"card {p} 123", f"{q} USD"]
    assert card not in new[4] and "1111 1111 1111" not in new[4] and new[5].startswith(p) and "4539 1488" not in new[5]
    assert new[6].startswith(f"{p}-77 on ") and "2024-02-29" not in new[6]
    assert new[7] == f"{new[8]} 2024" and "555" not in new[8]
    assert [(r["n_card"], r["n_iban"], r["n_phone"], r["n_date"], r["n_ssn"]) for r in rows][3:9] == [
        (0, 1, 0, 0, 0), (1, 0, 0, 0, 0), (2, 0, 0, 0, 0), (1, 0, 0, 1, 0), (0, 0, 1, 0, 0), (0, 0, 1, 0, 0)]
    assert rows[11]["n_ssn"] == 0


def test_pseudonyms_of_very_long_texts(spark):
    """Tens of thousands of values in one text get what each gets alone; digit groups overlap in nearly every place."""
    dates = [f"{1900 + i % 190}-{1 + i % 12:02d}-{1 + i % 28:02d}" for i in range(20_000)]
    alone = {r["text"]: p["text"] for r, p in zip(*(pseudonymised_pairs(spark, sorted(set(dates)))))}
    groups = " ".join(f"{i * 7919 % 10000:04d}" for i in range(20_000))
    long, table_ = pseudonymised(spark.createDataFrame([(0, " ".join(dates)), (1, groups)], "doc_id long, text string"))
    assert long["n_date"] == 20_000 and long["text"] == " ".join(alone[d] for d in dates)
    assert table_["n_card"] > 100 and len(table_["text"]) == len(groups)
    assert [len(x) for x in table_["text"].split(" ")] == [4] * 20_000


def pseudonymised_pairs(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").orderBy("doc_id")
    return docs.collect(), pseudonymised(docs)


def pseudonymised(df):
    return pseudonyms.pseudonymise(df, "test key").orderBy("doc_id").collect()


# --- 8 SimHash -----------------------------------------------------------------------------------

def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i: i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_is_the_contracts():
    rng = random.Random(8)
    for n in (0, 1, 2, 3, 4, 40, 300):
        t = "\t ".join(words(rng, n)).title() + " É \x0b"
        assert simhash.fingerprint(t) & (1 << 64) - 1 == plain_fingerprint(t)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def roots(fps, max_bits):
    parent = {f: f for f in fps}
    find = lambda x: x if parent[x] == x else find(parent[x])
    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= max_bits:
            parent[find(a)] = find(b)
    groups = {}
    for f in fps:
        groups.setdefault(find(f), set()).add(f)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


@pytest.mark.parametrize("max_bits,hot", [(2, 64), (2, 3), (1, 64), (3, 64)])
def test_links_lose_no_component(spark, max_bits, hot):
    rng = random.Random(9)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:12]:
        for _ in range(rng.randint(1, 25)):  # clusters and chains
            f ^= 1 << rng.randrange(64)
            f ^= (1 << rng.randrange(64)) * rng.randint(0, 1)
            fps.add(f)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    links = simhash.linked(df, max_bits, hot=hot)
    assert links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > max_bits).count() == 0
    got = {}
    for r in simhash.components(links).collect():
        got.setdefault(r["root"], set()).add(r["node"] & (1 << 64) - 1)
    assert {frozenset(g) for g in got.values()} == roots(sorted(fps), max_bits)


def test_thresholds_obey_the_pigeonhole():
    rng = random.Random(10)
    sample = np.array([rng.getrandbits(63) for _ in range(300)], np.int64)
    for total in (1000, 10**8, 10**11):
        parts = simhash.choose_parts(sample, total, 2)
        assert sum(t + 1 for _, t in parts) == 3  # differing bits 0..2 can't avoid all parts
        bits = [b for g, _ in parts for b in g]
        assert len(bits) == len(set(bits))
    cost, t = simhash.allocate([[0, 5, 50, 500], [0, 1, 90, 900], [0, 7, 8, 9]], 2)
    assert (cost, t) == (min((sum(c[x + 1] for c, x in zip([[0, 5, 50, 500], [0, 1, 90, 900], [0, 7, 8, 9]], p)), list(p))
                             for p in itertools.product(range(-1, 3), repeat=3) if sum(p) == 0))


def test_near_duplicates_on_documents(spark, documents):
    rows = simhash.near_duplicates(documents).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    fps = {d: plain_fingerprint(t) for d, t in texts.items()}
    first = {}
    for d in sorted(fps):
        first.setdefault(fps[d], d)
    near = {}
    for g in roots(sorted(first), 2):
        for f in g:
            near[f] = min(first[x] for x in g)
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows} == {
        (d, f"{f:016x}", near.get(f, first[f])) for d, f in fps.items()}


def test_keep_one_odd_rows(spark, odd, empty):
    rows = simhash.keep_one(odd.withColumn("_fp", F.lit("clash"))).collect()
    # null and empty texts share a fingerprint; repeated and null ids stay
    assert sorted(str(r["doc_id"]) for r in rows) == ["1", "3", "3", "5", "6", "None"]
    assert simhash.near_duplicates(empty).count() == 0


# --- 9 line dedup --------------------------------------------------------------------------------

def xxh64(text):
    """Spark's xxhash64 of a string: seed 42, signed; of a null the seed."""
    return 42 if text is None else (xxhash.xxh64_intdigest(text.encode(), 42) + (1 << 63)) % (1 << 64) - (1 << 63)



def plain_removed(rows, t, least):
    """(row, line) of the lines that go; rows of one doc_id follow one another by the hash of their text."""
    order = sorted(range(len(rows)), key=lambda k: (math.inf if rows[k][0] is None else rows[k][0], xxh64(rows[k][1]), k))
    place = {k: n for n, k in enumerate(order)}
    lines = [(place[k], i, frozenset(l.encode().lower().split()), k)
             for k, (d, x) in enumerate(rows) if x for i, l in enumerate(x.split("\n"))]
    lines = [l for l in lines if len(l[2]) >= least]
    return {(k, i) for d, i, s, k in lines for e, j, r, _ in lines if (e, j) < (d, i) and len(s & r) / len(s | r) >= t - 1e-12}


@pytest.mark.parametrize("threshold,common", [(0.8, 20_000), (0.6, 20_000), (0.8, 3), (1.0, 20_000)])
def test_line_dedup_against_all_pairs(spark, monkeypatch, threshold, common):
    monkeypatch.setattr(linededup, "COMMON_LEAST", common)  # 3: nearly all words are common, keys are pairs
    monkeypatch.setattr(linededup, "COMMON_SHARE", 0)
    rng = random.Random(11)
    vocabulary = words(rng, 90)
    base = [words(rng, rng.randint(3, 70), vocabulary) for _ in range(25)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(rng.randint(0, 8)):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rng.shuffle(w)
            lines.append(("  " if rng.random() < 0.3 else " ").join(w).replace("a", rng.choice("aA")))
        rows.append((d, "\n".join(lines)))
    rows += [(None, rows[3][1]), (7, rows[5][1]), (90, None), (91, ""), (92, "\n\n")]
    df = spark.createDataFrame([(d, x, k) for k, (d, x) in enumerate(rows)], "doc_id long, text string, place int").repartition(4)
    want = plain_removed(rows, threshold, 5)
    got = linededup.without_repeated_lines(df, threshold, count="place_lost").collect()
    kept = [(d, None if x is None else "\n".join(l for i, l in enumerate(x.split("\n")) if (k, i) not in want), sum(a == k for a, _ in want))
            for k, (d, x) in enumerate(rows)]
    assert sorted(map(str, ((r["doc_id"], r["text"], r["place_lost"]) for r in got))) == sorted(map(str, kept))


@pytest.mark.parametrize("threshold,common", [(0.8, 20_000), (0.6, 20_000), (0.8, 3), (0.6, 3), (1.0, 20_000), (0.5, 20_000), (0.5, 3)])
def test_line_dedup_short_lines(spark, monkeypatch, threshold, common):
    monkeypatch.setattr(linededup, "COMMON_LEAST", common)
    monkeypatch.setattr(linededup, "COMMON_SHARE", 0)
    monkeypatch.setattr(linededup, "HELD", 3)
    rng = random.Random(12)
    few = "red green blue grey black white pink".split()
    rows = [(d, "\n".join(" ".join(rng.choices(few, k=rng.randint(0, 7))) for _ in range(4))) for d in range(80)]
    # 4 of 5 words are 0.8; 3 of 4 are less; a long line of one word; a script without spaces
    rows += [(200, "a1 b1 c1 d1"), (201, "a1 b1 c1 d1 e1"), (202, "a2 b2 c2 d2\na2 b2 c2"), (203, "x " * 60 + "\nX"), (None, "x"),
             (204, "\u7248\u6743\u6240\u6709"), (205, "\u7248\u6743\u6240\u6709\nAll rights reserved"), (206, "reserved all Rights"),
             (206, "All rights"), (206, "All rights")]
    df = spark.createDataFrame([(d, x, k) for k, (d, x) in enumerate(rows)], "doc_id long, text string, place int").repartition(4)
    want = plain_removed(rows, threshold, 1)
    counts = linededup.without_repeated_lines(df, threshold, count="gone").collect()
    kept = [(d, "\n".join(l for i, l in enumerate(x.split("\n")) if (k, i) not in want), sum(a == k for a, _ in want)) for k, (d, x) in enumerate(rows)]
    assert sorted(map(str, ((r["doc_id"], r["text"], r["gone"]) for r in counts))) == sorted(map(str, kept))


def test_line_dedup_long_lines_at_half(spark):
    line = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    rows = [(0, line(0, 400)), (1, line(120, 520)), (2, line(280, 680))]  # 280 of 520 words; 240 of 560 and 120 of 680
    got = linededup.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), 0.5, count="gone").collect()
    assert {r["doc_id"]: r["gone"] for r in got} == {d: sum(k == d for k, _ in plain_removed(rows, 0.5, 1)) for d, _ in rows} == {0: 0, 1: 1, 2: 0}


@pytest.mark.parametrize("odd_ids", [False, True])
def test_op9_equals_all_pairs(spark, tmp_path, odd_ids):
    rng = random.Random(21)
    vocabulary = words(rng, 60)
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(2, 9))) for _ in range(40)]
    rows = [(d, "\n".join(rng.choice(base) for _ in range(rng.randint(0, 5)))) for d in range(50)] + [(70, None), (71, "")]
    if odd_ids:
        rows += [(None, base[0]), (None, base[0] + "\n" + base[1]), (None, base[0]), (2, "fresh line of two\nunlike the others"), (2, base[3]),
                 (2, "fresh line of two\nits own"), (2, "fresh line of two\nits own"), (None, None), (None, None)]
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, line string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    want = plain_removed(rows, 0.8, 1)
    lost = [(d, 0 if x is None else len(x.split("\n")), sorted(i for a, i in want if a == k)) for k, (d, x) in enumerate(rows)]
    got = linededup.op9_line_dedup(spark, str(tmp_path)).collect()
    assert sorted(map(str, ((r["doc_id"], r["n_lines"], r["removed"]) for r in got))) == sorted(map(str, lost))
    assert all(r["n_removed"] == len(r["removed"]) for r in got)


def test_word_hashes_on_bytes():
    texts = ["", "Ab cd\nEF\n\n x", None, "é y\tab", "end", "cd"]
    h, doc, line = linededup.word_hashes(pa.array(texts))
    want = [(d, i, w) for d, t in enumerate(texts) for i, l in enumerate((t or "").encode().lower().split(b"\n")) for w in l.split()]
    assert list(zip(doc.tolist(), line.tolist())) == [(d, i) for d, i, _ in want]
    same = {}
    for x, (_, _, w) in zip(h.tolist(), want):
        assert same.setdefault(w, x) == x
    assert len(set(same.values())) == len(same)
    part = pa.array(["zz", *texts]).slice(1)
    assert (linededup.word_hashes(part)[0] == h).all()


def test_line_dedup_odd_rows(spark, odd, empty):
    rows = linededup.without_repeated_lines(odd.withColumn("_lost", F.lit(1)).withColumn("lines", F.lit("x"))).collect()
    want = [(d, x) for d, x, *_ in ODD]
    want[want.index((3, "one"))] = (3, "")  # one of two equal rows keeps its line
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in rows))) == sorted(map(str, want))
    assert linededup.without_repeated_lines(empty).count() == 0


# --- 10 token counts -----------------------------------------------------------------------------

def test_counts_are_the_tokenizers(spark, odd):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(rollup.VOCABULARY, "rb"))}
    encode = tiktoken.Encoding("t", pat_str=rollup.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    for r in rollup.counted(odd).collect():
        assert r["tokens"] == len(encode(r["text"] or ""))
    long = "word and 12 more, don't  stop\n" * 300
    assert "".join(rollup.pieces(long, 100)) == long
    assert sum(len(encode(p)) for p in rollup.pieces(long, 100)) == len(encode(long))


def test_rollup_batches_are_idempotent(spark):
    state = lambda rows: spark.createDataFrame(rows, "doc_id long, tokenizer string, source string, lang string, tokens long, chars long")
    old = state([(1, "t", "a", "en", 5, 50), (2, "t", "a", None, 7, 70), (3, "t", None, "de", 1, 10)])
    new = state([(1, "t", "a", "en", 6, 60), (2, "t", "b", None, 7, 70), (4, "t", "a", "en", 2, 20)])
    r = rollup.Rollup(spark, scratch_path(spark, "rollup-test"))
    assert r.totals().count() == 0
    assert r.commit(1, rollup.signed(old, 1)) and not r.commit(1, rollup.signed(old, 1))
    delta = rollup.changes(old, new)
    assert r.commit(2, delta) and not r.commit(2, delta)
    want = {("a", "en"): (2, 8, 80), ("b", None): (1, 7, 70)}
    totals = lambda: {(x["source"], x["lang"]): (x["docs"], x["tokens"], x["chars"]) for x in r.totals().collect()}
    assert totals() == want
    with pytest.raises(ValueError, match="other counts"):
        r.commit(2, rollup.signed(new, 1))
    r.compact(2)
    r.compact(2)
    assert totals() == want and not r.commit(1, rollup.signed(old, 1))
    assert r.commit(3, rollup.signed(new, -1)) and totals() == {}
    # a half-written batch, without its marker, does not count and can be written again
    r._summed = None
    rollup._summed(rollup.signed(old, 1)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{r.path}/batches/4")
    assert totals() == {}
    assert r.commit(4, rollup.signed(old, 1)) and sum(v[0] for v in totals().values()) == 3


def test_rollup_adds_late_batches(spark):
    rows = lambda n: spark.createDataFrame([("a", "en", "t", n, n, n)], rollup.Rollup.SCHEMA)
    r = rollup.Rollup(spark, scratch_path(spark, "rollup-late"))
    docs = lambda: [x["docs"] for x in r.totals().collect()]
    assert r.commit(1, rows(1)) and r.commit(3, rows(100))
    r.compact(3)
    assert docs() == [101]
    assert r.commit(2, rows(10)) and not r.commit(2, rows(10)) and docs() == [111]
    r.compact(3)
    assert docs() == [111]
    with pytest.raises(ValueError, match="other counts"):
        r.commit(1, rows(5))
    assert r.commit(5, rows(1000))
    r.compact(5)
    assert docs() == [1111] and r._folded(5) == {1, 2, 3, 5}
    assert r.commit(4, rows(10_000)) and not r.commit(3, rows(100)) and docs() == [11_111]


def test_op10_equals_a_recount(spark, documents):
    got = {(r["source"], r["lang"]): (r["docs"], r["tokens"], r["chars"]) for r in rollup.op10_token_counts(spark, SF).collect()}
    first = {}
    for r in documents.orderBy("doc_id").collect():
        first.setdefault(r["text"], r)
    kept = spark.createDataFrame([(r["source"], r["lang"], re.sub(r"\n?Licensed under [^\n]*", "", r["text"])) for r in first.values()],
                                 "source string, lang string, text string")
    want = rollup.counted(kept).groupBy("source", "lang").agg(F.count("*").alias("d"), F.sum("tokens").alias("t"), F.sum(F.length("text")).alias("c")).collect()
    assert got == {(r["source"], r["lang"]): (r["d"], r["t"], r["c"]) for r in want}


def test_op10_recounts_null_and_repeated_ids(spark, tmp_path):
    licence = "a b c\nLicensed under the X licence\nd"
    rows = [(1, licence, "en", "s"), (1, licence, "en", "s"), (None, licence, "en", "s"), (None, licence, "en", "s"), (None, "q r", None, "s"),
            (2, licence, "en", "t"), (2, "other text", "en", "t"), (2, "other text", "de", None), (3, None, "en", "s"), (4, "", "en", "s"),
            (5, "other text", "en", "s"), (6, None, None, None)] + [(i, "hot " * 5, "fr", "h") for i in range(10, 60)] + [(10, "hot " * 5, "fr", "h")] * 9
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, tokens long").repartition(3).write.parquet(
        str(tmp_path / "documents.parquet"))
    kept = [r for r in rows if r[0] is None or r[0] <= min(x[0] for x in rows if x[0] is not None and x[1] == r[1])]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(rollup.VOCABULARY, "rb"))}
    encode = tiktoken.Encoding("t", pat_str=rollup.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    want = {}
    for _, text, lang, source in kept:
        text = re.sub(r"\n?Licensed under [^\n]*", "", text or "")
        d, n, c = want.get((source, lang), (0, 0, 0))
        want[source, lang] = (d + 1, n + len(encode(text)), c + len(text))
    got = rollup.op10_token_counts(spark, str(tmp_path)).collect()
    assert {(r["source"], r["lang"]): (r["docs"], r["tokens"], r["chars"]) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_first_of_hot_and_other_keys(spark, hot):
    rows = [(i if i % 5 else None, k) for i, k in enumerate("aaaaaaaabbbbccd")]
    got = rollup.with_first(spark.createDataFrame(rows, "doc_id long, key string"), hot).collect()
    first = {k: min((i for i, x in rows if x == k and i is not None), default=None) for _, k in rows}
    alone = {k for k, n in Counter(k for _, k in rows).items() if n == 1}
    assert sorted(map(str, ((r["doc_id"], r["key"], r["first"]) for r in got))) == sorted(
        map(str, ((i, k, None if k in alone else first[k]) for i, k in rows)))


def test_op10_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    assert rollup.op10_token_counts(spark, str(tmp_path)).count() == 0


def test_held_out_is_crc32_of_the_text(spark):
    import zlib

    rows = spark.range(50).select("id", held_out("id", 5, 0).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)
    assert struct.calcsize("<II") == 8


def test_short_words_lose_no_pair():
    """Sets of words cut to two bytes, which then repeat, share at least what the whole words share."""
    rng = np.random.default_rng(5)
    pool = (rng.integers(0, 1 << 28, 400).astype(np.uint64) << np.uint64(16)) | rng.integers(0, 60, 400).astype(np.uint64)
    a, b = ([np.sort(rng.choice(pool, rng.integers(1, 120), replace=False)) for _ in range(300)] for _ in range(2))
    a, b = a + a[:20], b + a[:20]
    x, y = (linededup.packed(np.concatenate(s), np.array([len(w) for w in s])) for s in (a, b))
    shared, union = linededup.shared_words(x, y)
    assert shared.tolist() == [len(np.intersect1d(p, q)) for p, q in zip(a, b)]
    assert union.tolist() == [len(np.union1d(p, q)) for p, q in zip(a, b)]
    short = [linededup.shortened(s, linededup.SHORT) for s in (x, y)]
    most, _ = linededup.shared_words(*short, linededup.SHORT)
    assert (most >= shared).all() and (most[-20:] == [len(w) for w in a[-20:]]).all()
    assert 3 * sum(map(len, short[0].to_pylist())) == sum(map(len, x.to_pylist()))
