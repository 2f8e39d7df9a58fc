"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprint: text lower-cased (A-Z), words without ASCII space, shingles of
three words joined by one space (repeats included; a shorter text is one
shingle), XXH64 with seed 42 of each; a bit is 1 if it is set in over half of
the hashes.  A text without words has fingerprint zero.

Join: fingerprints within ``max_bits`` differing bits are linked.  The 64 bits
are grouped into m parts, correlated bits together.  Part i gets a threshold
t_i >= -1 with sum(t_i) = max_bits - m + 1; then two fingerprints within
``max_bits`` differ in at most t_i bits of some part i (-1: the part is not
used).  Dynamic programming picks the thresholds with the least estimated work
(probes and candidates), for every m, from a bounded sample of the distinct
fingerprints.  Each fingerprint is indexed by its value of each part and probes
all values within t_i; a candidate is verified by its bit distance.

Hot buckets: a value that more than ``hot`` distinct fingerprints share is not
paired within itself.  All fingerprints that probe or fill such a bucket are
linked through their neighbours at distance 1 instead: two fingerprints are
within 2 bits exactly if they have a common neighbour within one bit of each,
so linking every member of a neighbour's group with its smallest one keeps the
components and needs 65 rows a fingerprint, however large the bucket.  (For
``max_bits`` other than 2 that shortcut does not hold, and all buckets are
paired.)  The work is on distinct fingerprints; copies join at the end.

Components: alternating large-star and small-star steps until nothing changes,
each step written to the shared folder.

Defined results: null and empty texts have fingerprint zero and are linked like
any other; a null doc_id takes part but names no component unless its whole
component has none; equal rows stay separate rows; an empty table gives an
empty result.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.llm.common import chunks, saved, table, without

BITS = 64
#: Shingles whose hash bits are unpacked at once.
BLOCK = 16384


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text, as a signed 64-bit integer."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        joined = b" ".join(words)
        ends = list(itertools.accumulate(map(len, words), lambda a, n: a + n + 1))
        starts = [0, *(e + 1 for e in ends)]
        h = xxhash.xxh64_intdigest
        hashes = [h(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1:])]
    count = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = np.array(hashes[at: at + BLOCK], "<u8")
        count += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * count > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = 3, text: str = "text", column: str = "_fp") -> DataFrame:
    """``docs`` without its text column and with the fingerprint as a long."""
    schema = docs.drop(text).withColumn(column, F.lit(0).cast("long")).schema
    names, keep = schema.names, [c for c in docs.columns if c != text]

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                fps = [fingerprint(t, shingle) for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(fps, pa.int64())], names=names)

    return docs.select(*[F.col(f"`{c}`") for c in docs.columns]).mapInArrow(run, schema)


# --- choosing parts and thresholds -----------------------------------------------------------------

def bits_of(fps: np.ndarray) -> np.ndarray:
    """One row of 64 bits (lowest first) for each fingerprint."""
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def grouped_bits(bits: np.ndarray, m: int) -> list[list[int]]:
    """``m`` groups of nearly equal size; each grows by the bit most correlated with it."""
    x = bits.astype(float) - bits.mean(axis=0)
    norm = np.sqrt((x * x).sum(axis=0))
    tie = np.abs(x.T @ x) / np.maximum(np.outer(norm, norm), 1e-9)
    np.fill_diagonal(tie, 0)
    left, out = set(range(BITS)), []
    for k in range(m):
        size = BITS // m + (k < BITS % m)
        group = [max(left, key=lambda b: (tie[b, list(left)].max(), -b))]
        left.discard(group[0])
        while len(group) < size:
            b = max(left, key=lambda b: (tie[b, group].mean(), -b))
            group.append(b)
            left.discard(b)
        out.append(sorted(group))
    return out


def work(bits: np.ndarray, group: list[int], total: int, most: int) -> list[float]:
    """Estimated probes and candidates of a part at thresholds -1, 0, ... ``most``.

    Candidates: the share of sample pairs that agree but for t bits of the
    part, or at least what independent bits would give, times all pairs.
    """
    part = bits[:, group].astype(np.float32)
    p = bits[:, group].mean(axis=0)
    differ = 2 * p * (1 - p)
    exact = np.array([1.0])  # distribution of the number of differing bits, bits taken as independent
    for d in differ:
        exact = np.convolve(exact, [1 - d, d])
    n, out, seen = len(part), [0.0], np.zeros(most + 1)
    ones = part.sum(axis=1)
    for at in range(0, n, 512):
        block = part[at: at + 512]
        apart = block.sum(axis=1)[:, None] + ones[None, :] - 2 * block @ part.T
        for t in range(most + 1):
            seen[t] += (apart <= t + 0.5).sum()
    for t in range(most + 1):
        share = max(exact[: t + 1].sum(), (seen[t] - n) / max(1, n * (n - 1)))
        probes = sum(math.comb(len(group), e) for e in range(t + 1))
        out.append(total * probes + total * total * share)
    return out


def allocate(costs: list[list[float]], max_bits: int) -> tuple[float, list[int]]:
    """Thresholds (one per part, at least -1) of the least summed cost with sum = max_bits - parts + 1."""
    budget = max_bits + 1  # thresholds plus one, summed
    best: list[tuple[float, list[int]] | None] = [(0.0, [])] + [None] * budget
    for cost in costs:
        new: list[tuple[float, list[int]] | None] = [None] * (budget + 1)
        for used, old in enumerate(best):
            for give in range(budget - used + 1) if old else ():
                if give < len(cost):
                    c = old[0] + cost[give]
                    if new[used + give] is None or c < new[used + give][0]:
                        new[used + give] = (c, [*old[1], give - 1])
        best = new
    return best[budget]


def choose_parts(sample: np.ndarray, total: int, max_bits: int) -> list[tuple[list[int], int]]:
    """The parts that are used, each as (bit numbers, threshold), with the least estimated work."""
    bits = bits_of(sample) if len(sample) else np.zeros((1, BITS), np.uint8)
    best = None
    for m in range(1, max_bits + 3):
        groups = grouped_bits(bits, m)
        cost, thresholds = allocate([work(bits, g, total, max_bits) for g in groups], max_bits)
        if best is None or cost < best[0]:
            best = cost, [(g, t) for g, t in zip(groups, thresholds) if t >= 0]
    return best[1]


# --- the join ------------------------------------------------------------------------------------

def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _mask(bits) -> int:
    return _signed(sum(1 << b for b in bits))


def linked(fps: DataFrame, max_bits: int = 2, sample: int = 4096, hot: int = 64) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct fingerprints ``fp`` that connect all within ``max_bits``.

    Every link is a true one.  Outside hot buckets these are all links; in hot
    buckets enough of them to connect the same fingerprints.
    """
    total = fps.count()
    # a bounded sample in hash order, for the estimates only
    rows = fps.orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()
    parts = choose_parts(np.array([r["fp"] for r in rows], np.int64), total, max_bits)
    index, probes = [], []
    for k, (group, t) in enumerate(parts):
        mask = F.lit(_mask(group))
        value = F.col("fp").bitwiseAND(mask)
        index.append(F.struct(F.lit(k).alias("part"), value.alias("value")))
        flips = [F.lit(_mask(c)) for e in range(t + 1) for c in itertools.combinations(group, e)]
        probes += [F.struct(F.lit(k).alias("part"), value.bitwiseXOR(x).alias("value")) for x in flips]
    filled = fps.select("fp", F.explode(F.array(*index)).alias("s")).select("fp", "s.*")
    probing = fps.select("fp", F.explode(F.array(*probes)).alias("s")).select("fp", "s.*")
    if max_bits != 2:
        return _verified(probing, filled, max_bits)
    buckets = filled.groupBy("part", "value").agg(F.count("*").alias("n"))
    hot_ones = buckets.where(F.col("n") > hot).select("part", "value")
    hot_ones = saved(hot_ones, "simhash-hot")
    if hot_ones.isEmpty():
        return _verified(probing, filled, max_bits)
    cool = _verified(probing.join(hot_ones, ["part", "value"], "left_anti"),
                     filled.join(hot_ones, ["part", "value"], "left_anti"), max_bits)
    touched = (probing.join(hot_ones, ["part", "value"], "left_semi").select("fp")
               .union(filled.join(hot_ones, ["part", "value"], "left_semi").select("fp")).distinct())
    near = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << b)) for b in range(BITS)])
    around = touched.select("fp", F.explode(near).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"))
    least = around.groupBy("at").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("at", "a")
    stars = (around.join(least, "at").where("a <> fp").select("a", F.col("fp").alias("b"))
             .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
    return cool.union(stars).distinct()


def _verified(probing: DataFrame, filled: DataFrame, max_bits: int) -> DataFrame:
    """Candidates of equal part values, verified by their distance; each pair once."""
    other = filled.select(F.col("fp").alias("other"), "part", "value")
    return (probing.join(other, ["part", "value"])
            .where((F.col("fp") < F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits))
            .select(F.col("fp").alias("a"), F.col("other").alias("b")).distinct())


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is its component's smallest node.

    Alternating star steps: every node tells its larger neighbours (then its
    smaller neighbours) the smallest node it sees.  Rows stay one per link.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = saved(links.select("a", "b").where("a <> b"), "links")
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    state = None
    for _ in range(rounds):
        # large star: u's larger neighbours point to the smallest of u and its neighbours
        around = both(edges)
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = around.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # small star: u and its smaller neighbours point to the smallest of them
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b")
                 .union(low.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct())
        edges = saved(small, "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    nodes = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return nodes.union(nodes.select(F.col("root").alias("node"), "root").distinct())


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    prints = saved(with_fingerprint(docs.select("doc_id", text), shingle, text), "fingerprints")
    firsts = saved(prints.groupBy(F.col("_fp").alias("fp")).agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(linked(firsts.select("fp"), max_bits))
    groups = (firsts.join(roots, firsts.fp == roots.node, "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    ids = groups.groupBy("root").agg(F.min("first").alias("component_id"))
    named = groups.join(ids, "root").select("fp", "component_id")
    return (prints.join(named, prints._fp == named.fp)
            .select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The documents of ``docs`` but for those that share a component with a smaller doc_id.

    Rows that repeat the smallest doc_id of their component all stay, and so do
    rows without a doc_id, which no decision can name.
    """
    found = near_duplicates(docs, shingle, max_bits)
    drop = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(drop, docs["doc_id"] == drop["_gone"], "left_anti")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents``: doc_id, fingerprint, component_id."""
    return near_duplicates(without(table(spark, sf_dir, "documents"), ["_fp"]))
