"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source's words are laid end to end, in ascending doc_id order, and cut
into blocks of ``block_words`` words and shards of ``shard_words``.  The seats
(blocks to take) are apportioned to the sources by highest quotients
``v / (2 s + 1)``, then each source's seats to its shards in the same way; all
shards but the last hold the same words, so a shard's quota is a closed form.
Inside a shard a seeded draw picks the blocks; when a shard has more seats than
blocks, all its blocks are taken once, twice, ... and the draw decides the rest.
No block is taken more than ``max_repeats`` times, so no document is either.

Sources take the weights 5, 2, 1, repeating, in the order of their code
points, null last.  A source's target stops at ``max_repeats`` times its size;
the excess is shared again by weight until none is above.

Scale: one pass over the texts counts words and is saved.  Only (id, size, row)
are shuffled, by ranges of (source, id, size, row), whose carried running sums give
each document's place among its source's words; a source with a third of all rows
is many ranges, and rows that repeat are told apart by their row.  What is
taken follows from the place alone, shard by shard, in the same pass.  Where the
caller keeps texts, they meet the results in a join by row.  The driver sees one
row per source; a mix lists its sources, and ``max_sources`` is checked.

Defined results: a null text has size 0; rows of size 0 take 0; equal rows are
separate entries; an empty table gives an empty result.  Reruns agree.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fileflow.llm.common import saved, table
from fileflow.operators.ordered import indexed_running_sums

#: Weights of the sources in code point order, repeating (fixed values of the contract).
WEIGHTS = (5.0, 2.0, 1.0)
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text):
    """Number of words of a text column; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes, weights, max_repeats: int = 3) -> np.ndarray:
    """Words per source: shares of all words by weight, none above ``max_repeats`` times its size."""
    size, weight = np.asarray(sizes, float), np.asarray(weights, float)
    cap, out = size * max_repeats, np.zeros(len(size))
    open_, left = np.ones(len(size), bool), size.sum()
    while open_.any():
        share = np.where(open_, left * weight / weight[open_].sum(), 0.0)
        over = open_ & (share > cap)
        if not over.any():
            out[open_] = share[open_]
            break
        out[over] = cap[over]
        left -= cap[over].sum()
        open_ &= ~over
    return out


def sainte_lague(votes, seats: int, caps) -> np.ndarray:
    """Seats by highest quotients ``v / (2 s + 1)``, at most ``caps`` each; ties go to the first.

    A bisected divisor gives nearly all seats at once; the last few are dealt
    out singly from a heap of the next quotients.
    """
    v, caps = np.asarray(votes, float), np.asarray(caps, np.int64)
    caps = np.where(v > 0, caps, 0)
    seats = int(min(seats, caps.sum()))
    got = np.zeros(len(v), np.int64)
    if seats <= 0:
        return got

    def at(divisor):
        return np.minimum(np.floor(v / divisor + 0.5), caps).astype(np.int64)

    low, high = 0.0, 2 * v.max() + 1  # too many or just enough seats at low, too few or enough at high
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        if at(mid).sum() > seats:
            low = mid
        else:
            high = mid
    got = at(high)
    heap = [(-v[i] / (2 * got[i] + 1), i) for i in range(len(v)) if got[i] < caps[i]]
    heapq.heapify(heap)
    for _ in range(seats - int(got.sum())):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < caps[i]:
            heapq.heappush(heap, (-v[i] / (2 * got[i] + 1), i))
    return got


def drawn(n_blocks: int, seats: int, seed) -> np.ndarray:
    """How often each of ``n_blocks`` blocks is taken, ``seats`` in all, by a seeded draw."""
    often = np.full(n_blocks, seats // n_blocks if n_blocks else 0, np.int64)
    if n_blocks:
        often[np.random.default_rng(seed).permutation(n_blocks)[: seats % n_blocks]] += 1
    return often


def taken_words(sizes: np.ndarray, often: np.ndarray, block: int) -> np.ndarray:
    """Words taken of each document when block k of the end-to-end stream is taken ``often[k]`` times."""
    ends = np.cumsum(sizes)
    return taken_between(ends - sizes, ends, often, block)


def taken_between(first: np.ndarray, past: np.ndarray, often: np.ndarray, block: int) -> np.ndarray:
    """Words taken of each range of places when block k is taken ``often[k]`` times."""
    before = np.concatenate(([0], np.cumsum(often) * block))  # words taken up to each block's start

    def upto(x):
        k = np.minimum(x // block, len(often))
        return before[k] + np.where(k < len(often), (x - k * block) * often[np.minimum(k, len(often) - 1)], 0)

    return upto(past) - upto(first) if len(often) else np.zeros(len(first), np.int64)


def spans_of(start: int, size: int, often: np.ndarray, block: int):
    """Word ranges of one document that the mix takes: (first word, past the last, times), merged."""
    out = []
    for k in range(start // block, -(-(start + size) // block)):
        if often[k]:
            a, b = max(k * block, start) - start, min((k + 1) * block, start + size) - start
            if out and out[-1][1] == a and out[-1][2] == often[k]:
                out[-1][1] = b
            else:
                out.append([a, b, int(often[k])])
    return out


def shard_quota(shard: int, words: int, shard_words: int, seats: int, block: int, max_repeats: int) -> int:
    """Seats of a shard of a source of ``words`` words: highest quotients over shards that are equal but for the last.

    The last shard's j-th seat comes behind the seats of the others whose quotient is as large or larger.
    """
    full, rest = divmod(words, shard_words)
    cap, last_cap = max_repeats * -(-shard_words // block), max_repeats * -(-rest // block)
    seats = min(seats, full * cap + last_cap)
    low, high = max(0, seats - full * cap), min(last_cap, seats)  # seats of the last shard
    while low < high:
        j = (low + high) // 2
        ahead = min((shard_words * (2 * j + 1) // rest - 1) // 2 + 1, cap)
        if full * ahead + j < seats:
            low = j + 1
        else:
            high = j
    if shard == full:
        return low
    each, more = divmod(seats - low, full)
    return each + (shard < more)


class _Plan:
    """What is taken of a source: its target, its seats, and the draws of its shards."""

    def __init__(self, size, target, seats, code, block, shard_words, max_repeats, seed):
        self.size, self.target, self.seats, self.code = size, target, seats, code
        self.block, self.shard_words, self.max_repeats, self.seed = block, shard_words, max_repeats, seed
        self.shard = self.often = None

    def draw(self, shard: int) -> np.ndarray:
        if shard != self.shard:
            n = -(-min(self.shard_words, self.size - shard * self.shard_words) // self.block)
            quota = shard_quota(shard, self.size, self.shard_words, self.seats, self.block, self.max_repeats)
            self.shard, self.often = shard, drawn(n, quota, [self.seed, self.code, shard])
        return self.often

    def taken(self, first: np.ndarray, past: np.ndarray) -> np.ndarray:
        out = np.zeros(len(first), np.int64)
        if self.size:
            for shard in range(int(first.min()) // self.shard_words, -(-int(past.max()) // self.shard_words)):
                start = shard * self.shard_words
                lo, hi = (np.clip(x - start, 0, self.shard_words) for x in (first, past))
                some = np.nonzero(hi > lo)[0]
                if len(some):
                    out[some] += taken_between(lo[some], hi[some], self.draw(shard), self.block)
        return out

    def spans(self, first: int, past: int) -> list:
        """Word ranges taken of a document: [first word, past the last, times], merged."""
        out, at = [], first
        while at < past:
            start = at // self.shard_words * self.shard_words
            to = min(past, start + self.shard_words)
            for a, b, k in spans_of(at - start, to - at, self.draw(at // self.shard_words), self.block):
                a, b = a + at - first, b + at - first
                if out and out[-1][1] == a and out[-1][2] == k:
                    out[-1][1] = b
                else:
                    out.append([a, b, k])
            at = to
        return out


def mix(docs: DataFrame, keep=("doc_id",), source: str = "source", text: str = "text", block_words: int = 64,
        shard_words: int = 1 << 20, max_repeats: int = 3, seed: int = 20, max_sources: int = 100_000,
        spans: bool = False) -> DataFrame:
    """The columns ``keep`` of every document with ``size``, ``source_size``, ``target`` and ``taken``.

    ``target`` is the source's.  With ``spans``, ``taken_spans`` lists the word
    ranges taken and how often, enough to write the mixed text.  Columns of
    ``keep`` with these names are replaced.  ``shard_words`` is a multiple of
    ``block_words``.
    """
    if shard_words % block_words:
        raise ValueError("shard_words must be a multiple of block_words")
    added = ["size", "source_size", "target", "taken"] + ["taken_spans"] * spans
    keep = [c for c in keep if c.lower() not in added]
    kept = {c: f"c{i}" for i, c in enumerate(keep)}
    rows = saved(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in kept.items()], F.col(source).cast("string").alias("_source"),
                             F.col("doc_id").alias("_id"), words_of(F.col(text)).alias("_size"),
                             F.monotonically_increasing_id().alias("_row")), "mix-rows")
    totals = rows.groupBy("_source").agg(F.sum("_size").alias("size")).limit(max_sources + 1).collect()
    if len(totals) > max_sources:
        raise ValueError(f"a mix names its sources; more than {max_sources} were found")
    totals.sort(key=lambda r: (r["_source"] is None, r["_source"] or ""))
    sizes = [r["size"] for r in totals]
    aim = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))], max_repeats)
    # sources at their cap take all they have; the others share the rest of the seats
    full = np.array([a >= max_repeats * s for a, s in zip(aim, sizes)], bool)
    caps = max_repeats * np.array([-(-s // block_words) for s in sizes], np.int64)
    seats = np.where(full, caps, sainte_lague(np.where(full, 0.0, aim), int(np.where(full, 0, aim).sum() / block_words + 0.5), caps))
    plans = {r["_source"]: (int(r["size"]), float(aim[i]), int(seats[i]), zlib.crc32((r["_source"] or "").encode()) + (r["_source"] is None))
             for i, r in enumerate(totals)}
    # texts stay where they are and meet the results by row
    light = [] if text in keep else list(kept.values())
    placed = indexed_running_sums(rows.select("_source", "_id", "_size", "_row", *light), ["_source"], ["_id", "_size", "_row"],
                                  {"_place": "_size"})
    types = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType([T.StructField(n, types[n]) for n in ["_row", *light]] + [
        T.StructField("size", T.LongType()), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()),
        T.StructField("taken", T.LongType())])
    if spans:
        span = T.StructType([T.StructField(c, T.LongType()) for c in ("first", "past", "times")])
        schema.add("taken_spans", T.ArrayType(span))

    def take(batches):
        known = {}
        for batch in batches:
            of = batch.column("_source").to_pylist()
            first = batch.column("_place").to_numpy()
            past = first + batch.column("_size").to_numpy()
            taken, per = np.zeros(len(of), np.int64), []
            cuts = [i for i in range(len(of)) if not i or of[i] != of[i - 1]] + [len(of)]
            for a, b in zip(cuts, cuts[1:]):
                if of[a] not in known:
                    known = {of[a]: _Plan(*plans[of[a]], block_words, shard_words, max_repeats, seed)}
                plan = known[of[a]]
                taken[a:b] = plan.taken(first[a:b], past[a:b])
                if spans:
                    per += [plan.spans(x, y) if n else [] for x, y, n in zip(first[a:b].tolist(), past[a:b].tolist(), taken[a:b].tolist())]
            cols = [batch.column(n) for n in ["_row", *light]] + [
                batch.column("_size"), pa.array([plans[x][0] for x in of], pa.int64()), pa.array([plans[x][1] for x in of], pa.float64()),
                pa.array(taken, pa.int64())]
            if spans:
                flat = np.array([x for p in per for x in p], np.int64).reshape(-1, 3)
                ends = np.cumsum([0] + [len(p) for p in per])
                cols.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(flat[:, i]) for i in range(3)], ["first", "past", "times"])))
            yield pa.RecordBatch.from_arrays(cols, names=["_row", *light, *added])

    out = placed.select("_source", "_place", "_size", "_row", *light).mapInArrow(take, schema)
    if not light:
        out = rows.select("_row", *kept.values()).join(out, "_row")
    return out.select(*[F.col(n).alias(c) for c, n in kept.items()], *added)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all ``documents``: doc_id, size, source_size, target, taken."""
    return mix(table(spark, sf_dir, "documents"))
