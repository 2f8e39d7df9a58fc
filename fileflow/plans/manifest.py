"""Manifest view M: a file listing derived from ``documents``.

It stands in for a large file inventory so that range planning runs over a
table that grows with the data.  Built identically in Spark and in the DuckDB
oracle:

    path   = '/' || source || '/' || lang || '/' || doc_id || ext
    ext    = '.csv.gz' for every fifth doc_id, else '.csv'
    length = 0 for every seventeenth doc_id, else the text's byte length
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def manifest(documents: DataFrame) -> DataFrame:
    doc = F.col("doc_id")
    ext = F.when(doc % 5 == 0, F.lit(".csv.gz")).otherwise(F.lit(".csv"))
    path = F.concat(F.lit("/"), F.col("source"), F.lit("/"), F.col("lang"), F.lit("/"),
                    doc.cast("string"), ext)
    length = F.when(doc % 17 == 0, F.lit(0)).otherwise(F.octet_length("text")).cast("long")
    return documents.select(path.alias("path"), length.alias("length"))


MANIFEST_SQL = """
m AS (
  SELECT '/' || source || '/' || lang || '/' || CAST(doc_id AS VARCHAR)
           || CASE WHEN doc_id % 5 = 0 THEN '.csv.gz' ELSE '.csv' END AS path,
         CAST(CASE WHEN doc_id % 17 = 0 THEN 0 ELSE strlen(text) END AS BIGINT) AS length
  FROM documents)"""
