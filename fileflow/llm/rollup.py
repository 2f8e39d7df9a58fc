"""Token counts: delta-maintained rollups with idempotent batch commits.

A change batch lists documents with their counts before and after: an insert
has no before, a delete no after, a revision both.  It becomes signed rows
(+1 document and its tokens, -1 document and minus its tokens), which are
summed by source, language and tokenizer version before anything is kept.
Totals are the sums over all committed batches, so they never need the old
documents again.

Commit: a batch's sums are written once, to the folder of its number, by
Spark's file commit; readers take only folders whose _SUCCESS marker is there.
Committing the same number again is a no-op if it is there and a fresh write
if a lost driver left it half done, so a batch counts exactly once however
often it is retried.  A retry whose contents differ from what was committed is
an error.  ``compact`` folds the batches committed up to a number into one
snapshot and lists them beside it, so a batch that comes later, whatever its
number, is still added.  The batches stay; retries are held against them.

The counts come from a fixed public vocabulary; documents are tokenised where
they are, whole, map-only.

Defined results: null texts have 0 tokens; null sources and languages are
groups of their own; a group whose documents are all gone has no row; doc_ids
may be null or repeat, a revision is the difference of two multisets of rows; an
empty table gives no row.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fileflow.llm.common import chunks, saved, table
from fileflow.session import scratch_path

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's byte-level BPE cuts text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
KEYS = ("source", "lang", "tokenizer")
SUMS = ("docs", "tokens", "chars")


def version(path: str) -> str:
    """Name of a tokenizer version: the vocabulary's file name and the hash of its bytes."""
    with open(path, "rb") as f:
        return f"{path.rsplit('/', 1)[-1]}@{hashlib.sha256(f.read()).hexdigest()[:12]}"


def counted(docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text", column: str = "tokens") -> DataFrame:
    """``docs`` with the number of tokens of each whole text; map-only.

    The vocabulary is a bounded file of the driver and is broadcast.
    """
    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    docs = docs.drop(column)
    at, names = docs.columns.index(text), [*docs.columns, column]

    def run(batches):
        import tiktoken

        encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=shared.value, special_tokens={}).encode_ordinary
        for batch in batches:
            for part in chunks(batch):
                n = [sum(len(encode(piece)) for piece in pieces(t)) for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64())], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.LongType())]))


def pieces(text: str | None, most: int = 1 << 18):
    """A text in parts of bounded length that end before a space between two words, where no token crosses."""
    text = text or ""
    at = 0
    while len(text) - at > most:
        cut = at + most
        while cut < len(text) - 1 and not (text[cut] == " " and text[cut - 1].isalpha() and text[cut + 1].isalpha()):
            cut += 1
        if cut >= len(text) - 1:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def signed(counts: DataFrame, sign: int) -> DataFrame:
    """Rows of ``counts`` (source, lang, tokenizer, tokens, chars) as additions or removals of one document each."""
    return counts.select(*KEYS, F.lit(sign).cast("long").alias("docs"), (F.col("tokens") * sign).alias("tokens"),
                         (F.col("chars") * sign).alias("chars"))


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Signed rows that turn the counts ``before`` into ``after``, two states of a table: the difference of two multisets.

    Rows that both have, equal in doc_id, group and counts, give none; doc_ids may be null or repeat.
    """
    fields = ["doc_id", *KEYS, "tokens", "chars"]
    sides = before.select(*fields, F.lit(-1).alias("sign")).union(after.select(*fields, F.lit(1).alias("sign")))
    rows = sides.groupBy(*fields).agg(F.sum("sign").alias("sign")).where("sign <> 0")
    return rows.select(*KEYS, F.col("sign").cast("long").alias("docs"), (F.col("tokens") * F.col("sign")).alias("tokens"),
                       (F.col("chars") * F.col("sign")).alias("chars"))


def with_first(counts: DataFrame, hot: int = 1000, most: int = 100_000) -> DataFrame:
    """``counts`` (doc_id, key) with ``first``, the smallest doc_id of the key; keys of one row keep their own.

    Keys of more than ``hot`` rows, or more than one row in ``most``, so that they are at most ``most``, go to the
    tasks; the others meet their rows in a shuffle.
    """
    hot = max(hot, counts.count() // most)
    of = counts.groupBy(F.col("key").alias("_key")).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    firsts = saved(of.withColumn("_hot", F.col("_n") > hot), "rollup-firsts", "_hot")
    few, many = (firsts.where(F.col("_hot") == h).drop("_hot", "_n") for h in (True, False))
    near = counts.join(F.broadcast(few), F.col("key") == F.col("_key"))
    rest = counts.join(F.broadcast(few), F.col("key") == F.col("_key"), "left_anti").join(many, F.col("key") == F.col("_key"), "left")
    return near.drop("_key").unionByName(rest.drop("_key"))


class Rollup:
    """Committed batches below a folder that all executors share."""

    SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long, chars long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _done(self, path: str) -> bool:
        fs, p = self._fs(f"{path}/_SUCCESS")
        return fs.exists(p)

    def _numbers(self, kind: str) -> list[int]:
        fs, p = self._fs(f"{self.path}/{kind}")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n) for n in names if n.isdigit() and self._done(f"{self.path}/{kind}/{n}"))

    def _read(self, kind: str, n: int) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/{kind}/{n}")

    def _snapshots(self) -> list[int]:
        """Complete snapshots; one without its list doesn't count, as the batches are all there."""
        return [n for n in self._numbers("snapshots") if self._done(f"{self.path}/folded/{n}")]

    def _folded(self, snapshot: int) -> set[int]:
        """The numbers of the batches in a snapshot."""
        return {r[0] for r in self.spark.read.schema("batch long").parquet(f"{self.path}/folded/{snapshot}").collect()}

    def commit(self, batch: int, rows: DataFrame) -> bool:
        """Add the signed ``rows`` as batch number ``batch``; False if it was committed before (nothing happens).

        A retry is held against what was committed: other sums are an error.
        """
        sums = _summed(rows)
        at = f"{self.path}/batches/{batch}"
        if self._done(at):
            old = self._read("batches", batch)
            if sums.exceptAll(old).head(1) or old.exceptAll(sums).head(1):
                raise ValueError(f"batch {batch} was committed with other counts")
            return False
        sums.write.mode("overwrite").parquet(at)
        return True

    def compact(self, upto: int) -> None:
        """Fold the snapshot and all batches up to ``upto`` into a new snapshot; repeating it changes nothing."""
        if upto in self._snapshots():
            return
        base, more = self._parts(upto)
        folded = sorted({*more, *(self._folded(base) if base is not None else ())})
        self._sum(base, more).write.mode("overwrite").parquet(f"{self.path}/snapshots/{upto}")
        # written last: the marker of the list makes both count
        self.spark.createDataFrame([(n,) for n in folded], "batch long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/folded/{upto}")

    def _parts(self, upto: int | None = None) -> tuple[int | None, list[int]]:
        """The last snapshot, and the committed batches that it doesn't hold."""
        snapshots = [n for n in self._snapshots() if upto is None or n <= upto]
        base = snapshots[-1] if snapshots else None
        folded = self._folded(base) if snapshots else set()
        return base, [n for n in self._numbers("batches") if n not in folded and (upto is None or n <= upto)]

    def _sum(self, base: int | None, batches: list[int]) -> DataFrame:
        rows = self.spark.createDataFrame([], self.SCHEMA) if base is None else self._read("snapshots", base)
        for n in batches:
            rows = rows.union(self._read("batches", n))
        return _summed(rows)

    def totals(self) -> DataFrame:
        """docs, tokens and chars by source, lang and tokenizer, of the documents that are there now."""
        return self._sum(*self._parts()).where("docs <> 0")


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])


def op10_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Rollup of all ``documents`` after three batches: source, lang, tokenizer, docs, tokens, chars.

    Batch 1 inserts every row; batch 2 deletes those whose text a smaller doc_id
    has too; batch 3 revises the other texts with a licence line to those without
    it.  Rows with a null doc_id, or equal in doc_id and text, are nobody's copies.
    Batches 1 and 2 are committed twice, as a restarted job would.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    name = version(vocabulary)
    where = scratch_path(spark, "rollup")
    size = lambda c: F.coalesce(F.length(c), F.lit(0)).cast("long")
    marked = F.coalesce(F.col("text").rlike(LICENCE), F.lit(False))
    both = counted(docs.withColumn("marked", marked).withColumn("revised", F.when(marked, F.regexp_replace("text", LICENCE, ""))), vocabulary)
    both = counted(both, vocabulary, "revised", "new_tokens")
    # counts by row, before and after, without texts; the batches read them
    counts = saved(both.select("doc_id", "source", "lang", F.lit(name).alias("tokenizer"), "tokens", size("text").alias("chars"), "marked",
                               "new_tokens", size("revised").alias("new_chars"),
                               F.struct(F.xxhash64("text"), F.sha2(F.col("text"), 256)).alias("key")), "rollup-counts")
    rows = saved(with_first(counts).withColumn("copy", F.coalesce(F.expr("doc_id > first"), F.lit(False))).drop("key", "first"), "rollup-rows")
    old = rows.where("marked and not copy")
    new = old.drop("tokens", "chars").withColumnsRenamed({"new_tokens": "tokens", "new_chars": "chars"})
    rollup = Rollup(spark, f"{where}/rollup")
    batches = [(1, signed(rows, 1)), (2, signed(rows.where("copy"), -1)), (3, changes(old, new))]
    for n, delta in [*batches[:2], *batches]:
        rollup.commit(n, delta)
    return rollup.totals()


#: A line that names a licence, with the line break before it.
LICENCE = r"\n?Licensed under [^\n]*"
