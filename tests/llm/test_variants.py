"""Spelling variants: the trie against all pairs, the query against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF
from fileflow.llm import variants
from fileflow.session import ship_package


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def neighbours(word, letters):
    """All texts one edit from ``word``."""
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in letters} | {a + c + b[1:] for a, b in cuts if b for c in letters}
    return out - {word}


def brute_words(rows):
    """Occurrences of each word of (doc_id, text) rows, letters deleted as the contract says."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def brute(words):
    letters = sorted({c for w in words for c in w})
    near = {w: [v for v in neighbours(w, letters) if v in words] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def made_words(seed, n=1500):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcdeàéÿ") for _ in range(rng.randint(1, 9))) for _ in range(n)}
    words |= {w[:-1] + "z" for w in list(words)[:300]} | {w + "q" for w in list(words)[:300]} | {"a" * k for k in range(1, 30)}
    words |= {"a" * 3000, "a" * 3001, "a" * 1500 + "b" + "a" * 1499}
    return sorted(w for w in words if w)


def test_search_finds_all_pairs_one_edit_apart():
    words = made_words(1)
    vecs, letters, (first, last) = variants.vectors(pa.array(words)), variants.Letters(pa.array(words)), variants.both_ends(pa.array(words))
    found, place = Counter(), {w: i for i, w in enumerate(words)}
    for q, o, same in variants.Trie(vecs, first, last).search(vecs, first, last, block=97):
        assert len(q) <= 97
        d = vecs[o] - vecs[q]
        assert (np.maximum(d, 0).sum(1) <= 1).all() and (np.maximum(-d, 0).sum(1) <= 1).all() and (~d.any(1) == same).all()
        ok = letters.one_edit(q, o)
        assert [variants.one_edit(words[a], words[b]) for a, b in zip(q, o)] == ok.tolist()
        found.update(zip(q[ok].tolist(), o[ok].tolist()))
        if not same:
            found.update(zip(o[ok].tolist(), q[ok].tolist()))
    letters = sorted({c for w in words for c in w})
    want = {(place[w], place[v]) for w in words if len(w) < 100 for v in neighbours(w, letters) if v in place}
    assert {p for p in found if len(words[p[0]]) < 100} == want and set(found.values()) == {1}
    assert {(words[a], words[b]) for a, b in found if len(words[a]) > 100} == {
        (a, b) for a in words for b in words if len(a) > 100 and len(b) > 100 and variants.one_edit(a, b)}


def test_one_edit():
    letters = "abc"
    words = sorted({"".join(w) for k in range(5) for w in itertools.product(letters, repeat=k)})
    for a in words:
        near = neighbours(a, letters)
        assert {b for b in words if variants.one_edit(a, b)} == {b for b in near if b in set(words)}


@pytest.mark.parametrize("shard_words", [3, 60, 100_000])
def test_shards_give_the_same_words(spark, shard_words):
    rng = random.Random(5)
    words = {w: rng.choice([2, 2, 3, 30, 400, 5000]) for w in made_words(2, 700)}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    got = rows_of(variants.grouped(df, shard_words=shard_words, block=500))
    assert got == brute(words)


def test_roots_follow_long_chains(spark):
    words = {"kkkkkkk" + "m" * i: 2 * 10**i for i in range(9)} | {"zzzzzzz": 2}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = variants.grouped(df).collect()
    assert {r["word"]: r["root"] for r in got} == {w: "kkkkkkk" + "m" * 8 if w[0] == "k" else w for w in words}
    assert rows_of(spark.createDataFrame(got, "word string, n long, form string, root string, n_near long, form_n long")) == brute(words)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(variants.op13_spelling_variants(spark, SF)) == brute(brute_words([tuple(r) for r in docs]))


def test_odd_rows(spark, tmp_path):
    base = "Spelling variants gathered Variants variantes VARIANTS spellings spelling ÀÉÎõüÿ× straße123straßen écriture écritures "
    rows = [(i % 9 if i % 4 else None, base * (1 + i % 3), "s") for i in range(80)] + [(1, None, "s"), (2, "", None), (None, "1234 !!", "s")]
    rows += [(3, "x" * 50_000 + " " + "x" * 50_001, "s")] * 2 + [(4, "x" * 50_000 + " " + "x" * 50_001, "s")] * 20
    spark.createDataFrame(rows, "doc_id long, text string, word string").withColumn("n", F.lit(1)).write.parquet(str(tmp_path / "documents.parquet"))
    got = rows_of(variants.op13_spelling_variants(spark, str(tmp_path)))
    words = brute_words([r[:2] for r in rows])
    small = {w: n for w, n in words.items() if len(w) < 1000}
    assert [r for r in got if len(r[0]) < 1000] == brute(small)
    assert {r[0]: r[3] for r in got} == words and any(r[1] for r in got)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = variants.op13_spelling_variants(spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and got.count() == 0
