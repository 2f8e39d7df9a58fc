"""Ranked lexical search: best-first document intervals over range-maximum sparse tables.

Documents are dealt into shards of consecutive rows; a shard holds a posting
list (places of its documents, term frequencies) for every term that is asked
for.  A search of a shard turns frequencies into impacts, builds a sparse
table of range maxima over every posting list, and keeps a queue of document
intervals.  The bound of an interval is the sum over the item's terms of weight
times the largest impact in it, a range-maximum answer of two table looks.  Each
round takes the intervals of largest bounds, scores the document of the
largest weighted impact in each, and puts the two remaining parts back with their
own bounds.  Intervals of at most ``LEAF`` documents are scored posting by
posting.  The search ends when no bound beats the item's k-th score so far;
a tied interval stays only if a document before the k-th can be in it.

Scale: the index is built in one map-only pass and saved, as rows of at most
``shard_docs`` documents and about ``shard_postings`` postings.  Document
frequencies and lengths are sums over its rows.  A task searches its shards one
after another and carries each item's best scores from shard to shard, so later
shards are cut sooner; it returns at most k rows an item, and the k best of
those are chosen by a window that cuts on the map side.  Items (the stated
query set) go to the tasks in blocks of at most ``block_bytes`` of text, made
by running sums; a block is one pass over the documents.

Defined results: a null text has no term and is never a result; rows that
repeat are documents, or items, of their own, with equal doc_ids in any order;
a null doc_id comes first among ties; an item without a known term has no row;
empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fileflow.llm.common import saved, table
from fileflow.operators.ordered import indexed_running_sums

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of terms as they are, A-Z lower-cased; all others are blanks (fixed values of the contract).
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
LEAF = 16
#: Interval and term pairs of a round.
ROUND = 1 << 15
INDEX = ("doc_ids array<long>, sizes array<long>, terms array<int>, ends array<int>, places array<int>, tfs array<int>, "
         "n_docs long, n_terms long")


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return (text or b"").translate(FOLD).split()


# ------------------------------------------------------------------ the index

def index(docs: DataFrame, vocabulary: dict[bytes, int], text: str = "text", shard_docs: int = 8192,
          shard_postings: int = 2_000_000) -> DataFrame:
    """Shards of posting lists of the terms of ``vocabulary`` (term -> number) over every row of ``docs``; map-only.

    A row: its documents with a term in ascending doc_id order, their sizes, and
    per term found the end of its postings among ``places`` and ``tfs``;
    ``n_docs`` and ``n_terms`` count all documents with a term and all their terms.
    """
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def build(batches):
        numbers = known.value
        ids, sizes, rows, found, tfs, n_terms, n_docs = [], [], [], [], [], 0, 0

        def shard():
            order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0)), np.int64)
            place = np.empty(len(ids), np.int64)
            place[order] = np.arange(len(ids))
            term, doc, tf = np.array(found, np.int32), place[np.array(rows, np.int64)], np.array(tfs, np.int32)
            by = np.lexsort((doc, term))
            term, doc, tf = term[by], doc[by], tf[by]
            cuts = np.nonzero(np.diff(term, append=-1))[0]
            one = lambda a, kind: pa.array([a], pa.list_(kind))
            return pa.RecordBatch.from_arrays(
                [one([ids[i] for i in order], pa.int64()), one(np.array(sizes, np.int64)[order], pa.int64()), one(term[cuts], pa.int32()),
                 one((cuts + 1).astype(np.int32), pa.int32()), one(doc.astype(np.int32), pa.int32()), one(tf, pa.int32()),
                 pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64())],
                names=[c.split()[0] for c in INDEX.split(", ")])

        for batch in batches:
            for i in range(batch.num_rows):
                words = terms_of(batch.column(1)[i].as_py())
                if words:
                    n_terms, n_docs = n_terms + len(words), n_docs + 1
                    held = [(numbers[w], n) for w, n in Counter(words).items() if w in numbers]
                    if held:
                        rows += [len(ids)] * len(held)
                        found += [t for t, _ in held]
                        tfs += [n for _, n in held]
                        ids.append(batch.column(0)[i].as_py())
                        sizes.append(len(words))
                if len(ids) >= shard_docs or len(rows) >= shard_postings:
                    yield shard()
                    ids, sizes, rows, found, tfs, n_terms, n_docs = [], [], [], [], [], 0, 0
        if n_docs:
            yield shard()

    return docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string").cast("binary")).mapInArrow(build, INDEX)


# ------------------------------------------------------------------ the search of a shard

def lengths_part(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of each size: 100 - 75 + (75 * size * n_docs) div n_terms, also where the product leaves 64 bits."""
    if len(sizes) and int(sizes.max()) * 75 * n_docs >= 1 << 62:
        return np.array([25 + 75 * int(n) * n_docs // n_terms for n in sizes], np.int64)
    return 25 + 75 * sizes * n_docs // max(n_terms, 1)


class Shard:
    """Posting lists of a shard with sparse tables of the places of range maxima."""

    def __init__(self, sizes, terms, ends, places, tfs, n_docs: int, n_terms: int):
        self.n = len(sizes)
        self.terms, self.places = terms, places.astype(np.int64)
        self.starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
        # one sorted array of (list, place): the rank of a place in a list is a binary search
        self.keys = np.repeat(np.arange(len(terms), dtype=np.int64), np.diff(ends, prepend=0)) * (self.n + 1) + self.places
        m = lengths_part(sizes, n_docs, n_terms)[self.places]
        self.impact = 1_000_000_000 * tfs.astype(np.int64) // (1000 * tfs.astype(np.int64) + 8 * m)
        longest = int(np.diff(ends, prepend=0).max())
        self.table = [np.arange(len(places), dtype=np.int32)]
        for j in range(1, longest.bit_length()):
            a, b = self.table[-1][: -(1 << (j - 1))], self.table[-1][1 << (j - 1) :]
            self.table.append(np.where(self.impact[a] >= self.impact[b], a, b))
        # levels as one array; those above the first are shorter
        self.base = np.cumsum([0] + [len(t) for t in self.table])
        self.flat = np.concatenate(self.table)

    def rank(self, lists: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Index of the first posting of each list at ``place`` or behind, one row a place."""
        return np.searchsorted(self.keys, lists * (self.n + 1) + place[:, None])

    def best(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Index of the largest impact in each range of postings; ranges must not be empty."""
        j = np.frexp((hi - lo).astype(np.float64))[1] - 1
        a = self.flat[self.base[j] + lo]
        b = self.flat[self.base[j] + hi - (np.int64(1) << j)]
        return np.where(self.impact[a] >= self.impact[b], a, b)


class Best:
    """The k best (score, doc_id) so far; a null doc_id comes before others, smaller ones before larger."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def add(self, rows):
        """Rows (-score, doc_id is not null, doc_id)."""
        self.rows = sorted(self.rows + rows)[: self.k]

    def last(self):
        """The k-th row, or one that every result beats."""
        return self.rows[-1] if len(self.rows) == self.k else (0, False, -(1 << 63))


def search(shard: Shard, ids, wanted: dict[int, int], best: Best, leaf: int = LEAF, per_round: int = ROUND) -> int:
    """Put the shard's documents among the ``best`` of an item; ``wanted`` is term -> weight times its times in the item.

    Returns how many documents were scored.
    """
    lists = np.nonzero(np.isin(shard.terms, np.array(list(wanted), np.int64)))[0]
    if not len(lists):
        return 0
    weight = np.array([wanted[t] for t in shard.terms[lists].tolist()], np.int64)
    lists, scored = lists.astype(np.int64), 0
    step = max(1, per_round // len(lists))
    queue = (np.array([0]), np.array([shard.n]), np.array([np.iinfo(np.int64).max]))

    def offer(places, scores):
        least = -best.last()[0]
        can = np.nonzero((scores >= least) & (scores > 0))[0]
        if len(can) > best.k:  # equal scores stay: their ids decide
            can = can[scores[can] >= np.partition(scores[can], len(can) - best.k)[len(can) - best.k]]
        if len(can):
            best.add([(-s, (d := ids[p]) is not None, d or 0) for s, p in zip(scores[can].tolist(), places[can].tolist())])

    while len(queue[0]):
        start, past, bound = queue
        least, known, tied_id = best.last()
        live = bound > -least
        tied = np.nonzero(bound == -least)[0] if least else []
        for i in tied:  # documents are in id order: the first of an interval decides
            d = ids[start[i]]
            live[i] = (d is not None, d or 0) < (known, tied_id)
        start, past, bound = start[live], past[live], bound[live]
        if not len(start):
            break
        if len(start) > step:
            top = np.argpartition(-bound, step)
            rest, top = top[step:], top[:step]
        else:
            rest, top = np.arange(0), np.arange(len(start))
        queue = (start[rest], past[rest], bound[rest])
        a, b = start[top], past[top]
        small = b - a <= leaf
        if small.any():
            at, to = a[small], b[small]
            lo, hi = shard.rank(lists, at), shard.rank(lists, to)
            n = (hi - lo).ravel()
            ends = np.cumsum(n)
            post = np.repeat(lo.ravel() - ends + n, n) + np.arange(ends[-1])
            row = np.repeat(np.arange(n.size), n)
            where, which = np.divmod(row, len(lists))
            scores = np.zeros((len(at), leaf), np.int64)
            np.add.at(scores, (where, shard.places[post] - at[where]), weight[which] * shard.impact[post])
            places = at[:, None] + np.arange(leaf)
            inside = places < to[:, None]
            scored += int(inside.sum())
            offer(places[inside], scores[inside])
        a, b = a[~small], b[~small]
        if not len(a):
            continue
        lo, hi = shard.rank(lists, a), shard.rank(lists, b)
        split, _ = _split(shard, lo, hi, weight)
        at = shard.rank(lists, split)
        here = (at < hi) & (shard.places[np.minimum(at, len(shard.places) - 1)] == split[:, None])
        offer(split, np.where(here, weight * shard.impact[np.minimum(at, len(shard.places) - 1)], 0).sum(axis=1))
        scored += len(split)
        bounds = np.concatenate((_bound(shard, lo, at, weight), _bound(shard, at + here, hi, weight)))
        begins, ends = np.concatenate((a, split + 1)), np.concatenate((split, b))
        live = bounds > 0
        queue = tuple(np.concatenate(c) for c in zip(queue, (begins[live], ends[live], bounds[live])))
    return scored


def _maxima(shard, lo, hi):
    """Index of the best posting of every range that is not empty, and which those are."""
    full = hi > lo
    return shard.best(lo[full], hi[full]), full


def _bound(shard, lo, hi, weight):
    """Sum of the lists' weighted range maxima, one a row."""
    got, full = _maxima(shard, lo, hi)
    value = np.zeros(lo.shape, np.int64)
    value[full] = shard.impact[got]
    return (value * weight).sum(axis=1)


def _split(shard, lo, hi, weight):
    """Place of the document of the largest weighted impact in each row's ranges."""
    got, full = _maxima(shard, lo, hi)
    value, where = np.full(lo.shape, -1, np.int64), np.zeros(lo.shape, np.int64)
    value[full] = shard.impact[got]
    where[full] = got
    value *= weight
    most = value.argmax(axis=1)
    return shard.places[where[np.arange(len(most)), most]], value


# ------------------------------------------------------------------ all shards

def weight_of(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _blocks(items: DataFrame, text: str, block_bytes: int) -> list[DataFrame]:
    """The items in blocks of at most ``block_bytes`` of text, or one item."""
    total = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    if total <= block_bytes:
        return [items]
    rows = items.select("*", F.coalesce(F.octet_length(text), F.lit(0)).alias("_bytes"))
    at = saved(indexed_running_sums(rows, [], ["item_id", text], {"_at": "_bytes"}).withColumn("_block", F.expr(f"_at div {int(block_bytes)}")), "items")
    return [at.where(F.col("_block") == r["_block"]) for r in at.select("_block").distinct().orderBy("_block").collect()]


def _ranked(docs: DataFrame, items, k: int, text: str, shard_docs: int, shard_postings: int) -> DataFrame:
    """Results of a block of items, rows (item_id, terms) on the driver: _item, item_id, doc_id, score."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    shards = saved(index(docs, vocabulary, text, shard_docs, shard_postings), "lexical-index")
    n_docs, n_terms = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    each = shards.select(F.explode(F.arrays_zip("terms", F.transform("ends", lambda e, i: e - F.when(i > 0, F.col("ends")[i - 1]).otherwise(0)).alias("df"))).alias("t"))
    # a row a term that the items name
    dfs = {r[0]: r[1] for r in each.groupBy("t.terms").agg(F.sum("t.df")).collect()}
    asked = []
    for item_id, terms in items:
        times = Counter(vocabulary[t] for t in terms)
        asked.append((item_id, {t: n * w for t, n in times.items() if (w := weight_of(dfs.get(t, 0), n_docs or 0)) > 0 and t in dfs}))
    known = spark.sparkContext.broadcast(asked)

    def look(batches):
        best = [Best(k) for _ in known.value]
        for batch in batches:
            for i in range(batch.num_rows):
                ids, *arrays = (batch.column(c)[i].values for c in range(6))
                if not len(arrays[1]):
                    continue
                shard = Shard(*(a.to_numpy() for a in arrays), n_docs, n_terms)
                ids = ids.to_pylist()
                for (_, wanted), b in zip(known.value, best):
                    search(shard, ids, wanted, b)
        out = [(i, item, d if there else None, -s) for i, ((item, _), b) in enumerate(zip(known.value, best)) for s, there, d in b.rows]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                             names=["_item", "item_id", "doc_id", "score"])

    return shards.select([c.split()[0] for c in INDEX.split(", ")[:6]]).mapInArrow(look, "_item int, item_id long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text", item_text: str = "text", shard_docs: int = 8192,
           shard_postings: int = 2_000_000, block_bytes: int = 4 << 20) -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank, doc_id, score."""
    out = None
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col(item_text).cast("string").alias("_text"))
    for b, block in enumerate(_blocks(items, "_text", block_bytes)):
        rows = [(r[0], terms_of(bytes(r[1]) if r[1] is not None else None)) for r in block.select("item_id", F.col("_text").cast("binary")).collect()]
        got = _ranked(docs, rows, k, text, shard_docs, shard_postings).withColumn("_block", F.lit(b))
        out = got if out is None else out.unionByName(got)
    w = Window.partitionBy("_block", "_item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best of all ``documents`` for each ``benchmark`` item: item_id, rank, doc_id, score."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '" + TERM + "')"
ORACLE = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS t FROM documents),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
p AS (SELECT doc_id, any_value(len(t))::BIGINT AS n, term, count(*)::BIGINT AS tf
      FROM (SELECT doc_id, t, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
f AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, n_docs),
r AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM p JOIN f USING (term) JOIN q USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 10
"""
