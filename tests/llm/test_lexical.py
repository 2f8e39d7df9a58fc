"""Ranked lexical search: intervals against scoring everything, the query against brute force and SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from conftest import SF
from fileflow.llm import lexical
from fileflow.session import ship_package


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def terms(text):
    fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", fold)


def brute(docs, items, k=10):
    """(item_id, rank, doc_id, score) of rows (id, text)."""
    held = [(d, Counter(t), len(t)) for d, text in docs if (t := terms(text))]
    n, total, df = len(held), sum(h[2] for h in held), Counter(w for _, c, _ in held for w in c)
    out = []
    for item_id, text in items:
        asked, found = Counter(terms(text)), []
        for doc_id, tf, size in held:
            m = 25 + 75 * size * n // total
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                        for t, q in asked.items() if tf[t])
            if score > 0:
                found.append((-score, doc_id is not None, doc_id or 0))
        for rank, (score, there, doc_id) in enumerate(sorted(found)[:k], 1):
            out.append((item_id, rank, doc_id if there else None, -score))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("leaf,per_round", [(1, 1), (1, 64), (4, 200), (64, 1 << 15)])
def test_a_shards_best_are_those_of_scoring_everything(leaf, per_round):
    rng = np.random.default_rng(leaf + per_round)
    n = 300
    lists = [np.sort(rng.choice(n, rng.integers(1, n), replace=False)) for _ in range(12)]
    places, ends = np.concatenate(lists), np.cumsum([len(x) for x in lists])
    tfs, sizes = rng.integers(1, 4, len(places)).astype(np.int32), rng.integers(5, 9, n)
    shard = lexical.Shard(sizes, np.arange(0, 24, 2), ends, places, tfs, n, int(sizes.sum()))
    ids = [None, None, *sorted(rng.integers(-50, 50, n - 2).tolist())]
    for _ in range(20):
        wanted = {int(t): int(rng.integers(1, 4)) for t in rng.choice(26, 6, replace=False)}
        full = np.zeros(n, np.int64)
        for i, t in enumerate(range(0, 24, 2)):
            cut = slice(ends[i] - len(lists[i]), ends[i])
            np.add.at(full, places[cut], wanted.get(t, 0) * shard.impact[cut])
        want = sorted((-int(s), d is not None, d or 0) for s, d in zip(full, ids) if s > 0)[:10]
        best = lexical.Best(10)
        lexical.search(shard, ids, wanted, best, leaf, per_round)
        assert best.rows == want


def test_intervals_are_cut():
    """A shard with few good documents is not scored whole."""
    rng = np.random.default_rng(2)
    n = 5000
    lists = [np.sort(rng.choice(n, 1500, replace=False)) for _ in range(6)]
    good = np.arange(100, n, 400)
    lists = [np.union1d(x, good) for x in lists]
    places, ends = np.concatenate(lists), np.cumsum([len(x) for x in lists])
    tfs = np.where(np.isin(places, good), 30, 1).astype(np.int32)
    shard = lexical.Shard(np.full(n, 50), np.arange(6), ends, places, tfs, n, 50 * n)
    best = lexical.Best(10)
    assert lexical.search(shard, range(n), dict.fromkeys(range(6), 5), best, leaf=1) < n / 10
    assert [r[2] for r in best.rows] == good[:10].tolist()


def test_range_maxima():
    rng = np.random.default_rng(7)
    ends = np.array([1, 200, 333])
    shard = lexical.Shard(np.full(400, 9), np.arange(3), ends, np.concatenate([[3], np.arange(199), np.arange(133)]),
                          rng.integers(1, 50, 333).astype(np.int32), 400, 3600)
    for _ in range(300):
        lo = int(rng.integers(1, 199))
        hi = int(rng.integers(lo + 1, 201))
        assert shard.impact[shard.best(np.array([lo]), np.array([hi]))[0]] == shard.impact[lo:hi].max()


def test_long_documents_leave_64_bits():
    sizes = np.array([10, 10**9])
    assert lexical.lengths_part(sizes, 10**12, 10**13).tolist() == [25 + 75 * int(n) * 10**12 // 10**13 for n in sizes]


def test_query_equals_brute_force_and_sql(spark):
    read = lambda t, c: [tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(c, "text").collect()]
    got = rows_of(lexical.op11_lexical_search(spark, SF))
    assert got == brute(read("documents", "doc_id"), read("benchmark", "item_id"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert got == sorted(con.sql(lexical.ORACLE).fetchall(), key=str)


def odd_docs():
    rng = random.Random(4)
    docs = [(i if i % 7 else None, " ".join(rng.choice("Ab c1 déf ÉF ghi J k_l m-n 日本 zz".split()) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    docs += [(3, "ab ab c1"), (3, "ab ab c1"), (-5, "ab ab c1"), (None, "ab ab c1"), (9, None), (10, ""), (11, "!!! \x00 \x7f"), (12, "ghi " * 60_000)]
    docs += [(i, "same words here") for i in range(100, 140)]
    return docs


@pytest.mark.parametrize("options", [{}, {"shard_docs": 5, "k": 3}, {"shard_postings": 9, "block_bytes": 40}])
def test_odd_rows_shards_and_blocks(spark, options):
    docs, k = odd_docs(), options.get("k", 10)
    items = [(1, "AB c1 zz zz"), (2, "SAME words"), (None, "same here k"), (4, None), (5, ""), (6, "unknown"), (7, "日本 déf ÉF éf"), (1, "ghi")]
    df = spark.createDataFrame([(d, t, 1.0, [2]) for d, t in docs], "doc_id long, text string, score double, terms array<int>").repartition(4)
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    assert rows_of(lexical.ranked(df, asked, **options)) == brute(docs, items, k)


def test_empty_tables(spark):
    docs = spark.createDataFrame(odd_docs(), "doc_id long, text string")
    items = spark.createDataFrame([(1, "ab")], "item_id long, text string")
    assert lexical.ranked(docs.limit(0), items).count() == 0
    assert lexical.ranked(docs, items.limit(0)).count() == 0
    assert lexical.ranked(docs.limit(0), items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
