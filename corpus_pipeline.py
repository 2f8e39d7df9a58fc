"""A cleaning and mixing pipeline over ``documents``: five stages, each one operator of ``fileflow.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet to the shared folder and
reads back as the next stage's documents.  All stages but the last return the
columns of ``documents``, in their order; columns beyond these five travel
along.  Null texts count as empty; an empty table gives an empty result.

1. toxicity: documents predicted toxic go.
2. line dedup: lines that repeat or nearly repeat an earlier line go; the
   document stays, with what is left of its text and ``n_chars`` to match.
3. SimHash near-dedup: of each component the document of the smallest doc_id
   stays.
4. benchmark decontamination: contaminated documents go.
5. mixing: documents of which the mix takes no word go; the others get their
   size, source_size, target, taken and the word ranges taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.llm import decontaminate, linededup, mixing, simhash, toxicity
from fileflow.llm.common import fresh_name, saved, table


def _renamed(docs: DataFrame, names) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with extra columns called like an operator's output put out of its way, and how to name them back."""
    back = {}
    for c in docs.columns:
        if c.lower() in names:
            back[new := fresh_name(docs, f"_own_{c}")] = c
            docs = docs.withColumnRenamed(c, new)
    return docs, back


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, back = _renamed(docs, {"score", "predicted"})
    kept = toxicity.score(rows, toxicity.trained_on(spark, sf_dir)).where("predicted = 0").drop("score", "predicted")
    return kept.withColumnsRenamed(back)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = linededup.without_repeated_lines(docs)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, back = _renamed(docs, set(decontaminate.ADDED))
    out = decontaminate.decontaminate(rows, table(spark, sf_dir, "benchmark")).where("not contaminated").drop(*decontaminate.ADDED)
    return out.withColumnsRenamed(back)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, keep=docs.columns, spans=True).where("taken > 0")


STAGES = [("toxicity", toxic), ("line dedup", lines), ("SimHash near-dedup", near_copies),
          ("benchmark decontamination", benchmark), ("mixing", mix)]

#: Training, line similarity joins and components are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
