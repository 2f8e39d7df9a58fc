"""Benchmark decontamination with a broadcast hash set of test n-grams.

Text is lower-cased (A-Z only) and cut into words of ASCII letters and digits
and all characters beyond ASCII.  Every window of ``n`` consecutive words of a
benchmark item goes into the set (an item with fewer words is one window).
Documents are scanned once, map-only: each task looks their words up in the
benchmark's vocabulary, hashes the windows whose words are all known, probes
the sorted hash set, and verifies every hit word by word.  A document's words
inside a verified window are hit.

What is broadcast has a checked size: the benchmark goes out in blocks of at
most ``block_words`` words.  With more than one block the documents are
scanned once per block, the hits so far travelling with the rows through a
table in the shared folder.  An item longer than a block makes a block of its
own and is refused beyond ``max_item_words``.

Defined results: null text has no words, no hits and is clean; an item with a
null or wordless text has no window; rows whose item_id is null hit words but
are not counted as items; equal item ids count once; an empty benchmark hits
nothing.  Columns that the operator adds replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fileflow.llm.common import chunks, fresh_name, mix64, saved, table, without

#: A word in lower-cased UTF-8: ASCII letters and digits, and all bytes beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
ADDED = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def words(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def window_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every window of ``size`` consecutive ids."""
    h = np.zeros(len(ids) - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            h = (h + ids[j: j + len(h)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return mix64(h)


class Index:
    """Windows of benchmark items, ready to probe."""

    def __init__(self, items, n: int):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text))
            size = min(n, len(ids))
            for at in range(len(ids) - size + 1 if ids else 0):
                windows[size][ids[at: at + size]].add(item)
        self.windows = {size: {k: frozenset(v) for k, v in own.items()} for size, own in windows.items()}
        self.hashes = {size: np.unique(np.concatenate([window_hashes(np.array(k), size) for k in own]))
                       for size, own in self.windows.items()}

    def scan(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit word ranges (start, past the end) of a text's words, and the items found."""
        spans, found = [], set()
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in ws), np.int64, len(ws))
        unknown = np.concatenate(([0], np.cumsum(ids == 0)))
        for size, hashes in self.hashes.items():
            if len(ids) < size:
                continue
            at = np.flatnonzero(unknown[size:] == unknown[:-size])  # windows of known words only
            if not len(at):
                continue
            h = window_hashes(ids, size)[at]
            near = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            for i in at[hashes[near] == h].tolist():
                items = self.windows[size].get(tuple(ids[i: i + size].tolist()))  # verifies the hit
                if items:
                    spans.append((i, i + size))
                    found |= items
        return merged(spans), found


def merged(spans) -> list[tuple[int, int]]:
    """Sorted disjoint ranges that cover the same words."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _blocks(benchmark: DataFrame, block_words: int, max_item_words: int) -> list[list[tuple]]:
    """The benchmark's items in blocks of a bounded number of words (the driver holds one at a time)."""
    sized = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text"),
                             F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"))
    total, longest = sized.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.max("bytes"), F.lit(0))).first()
    if longest > 2 * max_item_words:  # a word and its separator take two bytes at least
        if any(len(words(r["text"])) > max_item_words for r in sized.where(F.col("bytes") > 2 * max_item_words).toLocalIterator()):
            raise ValueError(f"a benchmark item has more than {max_item_words} words")
    n = max(1, -(-total // (2 * block_words)))
    blocked = sized.where("bytes > 0").withColumn("block", F.expr(f"pmod(xxhash64(item, text), {n})"))
    for k in range(n):
        yield [(r["item"], r["text"]) for r in blocked.where(F.col("block") == k).select("item", "text").collect()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 13, block_words: int = 4_000_000,
                  max_item_words: int = 4_000_000, share: int = 20, text: str = "text",
                  remove_spans: bool = False) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated.

    ``contaminated``: some word is hit and ``share * n_hit >= n_words``.  With
    ``remove_spans``, ``clean_text`` is the text without its hit ranges (from
    the first to the last byte of each run of hit words).
    """
    added = [*ADDED, *(["clean_text"] if remove_spans else [])]
    docs = without(docs, added)
    spans, items = fresh_name(docs, "_spans"), fresh_name(docs, "_items")
    kind = "array<int>", "array<string>"
    rows = docs.withColumn(spans, F.lit(None).cast(kind[0])).withColumn(items, F.lit(None).cast(kind[1]))
    schema, at = rows.schema, rows.columns.index(text)
    first = True
    for block in _blocks(benchmark, block_words, max_item_words):
        if not block:
            continue
        if not first:
            rows = saved(rows, "decontaminate")
        first = False
        rows = rows.mapInArrow(_scanner(docs.sparkSession.sparkContext.broadcast(Index(block, n)), at), schema)
    out = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                        T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()),
                        T.StructField("contaminated", T.BooleanType())])
    if remove_spans:
        out.add("clean_text", "string")
    return rows.mapInArrow(_judge(at, share, remove_spans), out)


def _scanner(index, at: int):
    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                old_spans, old_items = part.column(part.num_columns - 2).to_pylist(), part.column(part.num_columns - 1).to_pylist()
                spans, items = [], []
                for t, s, i in zip(part.column(at).to_pylist(), old_spans, old_items):
                    new, found = index.value.scan(words(t))
                    s = s or []
                    new = merged([*zip(s[::2], s[1::2]), *new])
                    spans.append([x for ab in new for x in ab])
                    items.append(sorted({*(i or []), *(x for x in found if x is not None)}))
                cols = part.columns[:-2] + [pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, names=part.schema.names)

    return run


def _judge(at: int, share: int, remove_spans: bool):
    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                texts = part.column(at).to_pylist()
                spans = [s or [] for s in part.column(part.num_columns - 2).to_pylist()]
                items = [i or [] for i in part.column(part.num_columns - 1).to_pylist()]
                n_words = [len(words(t)) for t in texts]
                n_hit = [sum(s[1::2]) - sum(s[::2]) for s in spans]
                cols = [*part.columns[:-2], pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                        pa.array([len(i) for i in items], pa.int64()),
                        pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]),
                        pa.array([0 < h and share * h >= n for h, n in zip(n_hit, n_words)])]
                names = [*part.schema.names[:-2], *ADDED]
                if remove_spans:
                    cols.append(pa.array([cut(t, s) for t, s in zip(texts, spans)], pa.string()))
                    names.append("clean_text")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def cut(text: str | None, spans: list[int]) -> str | None:
    """``text`` without the words of the flat list of ranges ``spans``."""
    if not text or not spans:
        return text
    data = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in WORD.finditer(data.lower())]
    out, last = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        out.append(data[last: at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, data[last:]]).decode("utf-8", "surrogatepass")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).select("doc_id", *ADDED)


def _windows_sql(name: str, key: str) -> str:
    return f"""SELECT {key} AS k, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {name}"""


ORACLE = f"""
WITH d AS ({_windows_sql('documents', 'doc_id')}),
b AS ({_windows_sql('benchmark', 'item_id')}),
bw AS (SELECT DISTINCT k, least(13, len(w)) AS m, w[i:i + least(13, len(w)) - 1] AS win
       FROM (SELECT k, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT k, i, m, w[i:i + m - 1] AS win
       FROM (SELECT k, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)),
hits AS (SELECT dw.k, dw.i, dw.m, bw.k AS item FROM dw JOIN bw ON dw.m = bw.m AND dw.win = bw.win),
words AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + m)) AS p FROM hits) GROUP BY k),
items AS (SELECT k, count(DISTINCT item) AS n_items, string_agg(DISTINCT item::VARCHAR, ',' ORDER BY item::VARCHAR) AS list
          FROM hits GROUP BY k)
SELECT d.k AS doc_id, coalesce(len(d.w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(d.w), 0) AS contaminated
FROM d LEFT JOIN words USING (k) LEFT JOIN items USING (k)
"""
