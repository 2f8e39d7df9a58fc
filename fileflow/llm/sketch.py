"""Document fingerprints: bottom-k sketches of shingle hashes.

Text is lower-cased (A-Z), split into words at ASCII space, and every run of
five words (a shorter text: all its words) is hashed to 64 bits.  The sketch is
the ``k`` smallest distinct hashes, written as base64 of big-endian numbers.
Sketches of parts merge to the sketch of the whole (the k smallest of both),
natively in Spark too (``merged``), salted so that one key may hold any share
of the rows.  From two sketches follow resemblance (shared part of the k
smallest of the union), containment, and the number of distinct shingles.

Defined results: a null text is an empty one; a text without words has the
empty sketch ''; two empty sketches resemble each other fully, an empty and a
non-empty one not at all.

The neighbours query (``edited_likeness``) needs each document's successor by
doc_id.  Ids are cut into ranges at approximate percentiles, which are ids of
the table; each range is streamed in order, with a copy of the next range's
first document behind it (the first document's behind the last range).  Texts
are shuffled once and no task holds more than two documents at a time.
Equal doc_ids follow each other in the order of their texts; null ids come
first.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.llm.common import chunks, mix64, table

K = 128
SHINGLE = 5
#: Hashes of words that a worker remembers before it starts afresh.
REMEMBERED = 400_000


class Words(dict):
    """64-bit hash of a word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def sketch(text: str | None, words: Words | None = None, k: int = K, shingle: int = SHINGLE) -> np.ndarray:
    """The ``k`` smallest distinct shingle hashes of a text, ascending (uint64)."""
    words = Words() if words is None else words
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    size = min(shingle, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):  # the order of the words counts
            out = (out + h[j: j + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
    return np.unique(mix64(out))[:k]


def encode(s: np.ndarray) -> str:
    return base64.b64encode(s.astype(">u8").tobytes()).decode()


def decode(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), ">u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def distinct_shingles(s: np.ndarray, k: int = K) -> float:
    """Exact below ``k`` shingles, else (k - 1) over the k-th smallest hash as a share of all."""
    return float(len(s)) if len(s) < k else (k - 1) / (float(s[-1]) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity of the shingle sets."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = merge(a, b, k)
    shared = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(both, shared, assume_unique=True).sum() / len(both))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    union = distinct_shingles(merge(a, b, k), k)
    return min(1.0, resemblance(a, b, k) * union / distinct_shingles(a, k))


def merged(rows: DataFrame, keys, column: str = "fingerprint", k: int = K, salts: int = 64) -> DataFrame:
    """``keys`` and the merged fingerprint of each key's rows.

    Native: hashes are 16 hex digits inside the arrays, which sort like the
    numbers; every step keeps at most k of them for a key and salt.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    digits = F.hex(F.unbase64(F.coalesce(F.col(column), F.lit(""))))
    each = F.expr("transform(sequence(0, length(_hex) div 16), i -> substr(_hex, i * 16 + 1, 16))")
    rows = rows.select(*keys, digits.alias("_hex")).select(*keys, F.explode(F.filter(each, lambda x: x != "")).alias("_h"))
    # the salt follows from the hash: duplicates meet, and a hot key is many groups
    one = (rows.distinct().groupBy(*keys, F.pmod(F.xxhash64("_h"), F.lit(salts)).alias("_salt"))
           .agg(F.slice(F.array_sort(F.collect_set("_h")), 1, k).alias("_hs")))
    all_ = one.groupBy(*keys).agg(F.slice(F.array_sort(F.flatten(F.collect_list("_hs"))), 1, k).alias("_hs"))
    # Spark breaks the lines of base64
    return all_.select(*keys, F.translate(F.base64(F.unhex(F.array_join("_hs", ""))), "\r\n", "").alias(column))


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double, distinct_shingles double")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the first as many code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _ranges(ids: DataFrame, rows_per_range: int, most: int = 8192) -> list[int]:
    """Ids that start the second, third, ... range; approximate percentiles are ids of the table."""
    n = min(most, ids.count() // rows_per_range)
    if n < 1:
        return []
    found = ids.agg(F.percentile_approx("doc_id", [k / (n + 1) for k in range(1, n + 1)], 20 * (n + 1))).first()[0]
    return sorted({x for x in found or [] if x is not None})


def edited_likeness(docs: DataFrame, k: int = K, shingle: int = SHINGLE, rows_per_range: int = 1000) -> DataFrame:
    """Fingerprint of every document and of its edited text, and the likeness to that and to the next document's."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    low, nulls = ids.agg(F.min("doc_id"), F.coalesce(F.sum(F.col("doc_id").isNull().cast("int")), F.lit(0))).first()
    starts = [x for x in _ranges(ids, rows_per_range) if nulls or x != low]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if starts:
        at = F.array(*[F.lit(x) for x in starts])
        # binary search: how many ranges start at or before the id
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(starts).bit_length()))])
        here = F.aggregate(steps, F.lit(0), lambda n, s: F.when(
            (n + s <= len(starts)) & (F.element_at(at, F.least(n + s, F.lit(len(starts)))) <= F.col("doc_id")), n + s).otherwise(n))
        here = F.when(F.col("doc_id").isNull(), 0).otherwise(here)
        first = F.array_contains(at, F.col("doc_id")) & F.col("doc_id").isNotNull()
    else:
        here, first = F.lit(0), F.lit(False)
    opening = F.col("doc_id").isNull() if nulls else F.col("doc_id") == low
    places = F.array(F.struct(here.alias("range"), F.lit(False).alias("copy")),
                     F.when(first, F.struct((here - 1).alias("range"), F.lit(True).alias("copy"))),
                     F.when(opening, F.struct(F.lit(len(starts)).alias("range"), F.lit(True).alias("copy"))))
    placed = (rows.withColumn("place", F.explode(F.filter(places, lambda x: x.isNotNull())))
              .select("place.range", "place.copy", "doc_id", "text"))
    ordered = placed.repartition(F.col("range")).sortWithinPartitions("range", "copy", F.asc_nulls_first("doc_id"), "text")
    return ordered.mapInArrow(_pairs(k, shingle), OUT)


def _pairs(k: int, shingle: int):
    def run(batches):
        words = Words()
        last = None  # range, copy, doc_id, text, sketch
        out = []
        for batch in batches:
            for part in chunks(batch):
                for r in part.to_pylist():
                    same = last is not None and last[0] == r["range"]
                    if same and last[1]:  # copies behind the first one
                        continue
                    mine = sketch(r["text"], words, k, shingle)
                    if same:
                        out.append(_row(last, r["text"], mine, words, k, shingle))
                    last = r["range"], r["copy"], r["doc_id"], r["text"], mine
                if out:
                    yield _table(out)
                    out = []

    return run


def _row(doc, following: str, following_sketch, words: Words, k: int, shingle: int):
    _, _, doc_id, text, mine = doc
    changed = edited(text, following)
    theirs = sketch(changed, words, k, shingle)
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), encode(mine),
            encode(theirs), resemblance(mine, theirs, k), resemblance(mine, following_sketch, k), distinct_shingles(mine, k))


def _table(rows) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64()]
    names = [c.split()[0] for c in OUT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and of their edited texts."""
    return edited_likeness(table(spark, sf_dir, "documents"))
