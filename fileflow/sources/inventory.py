"""File inventory.

The listing is Spark's own (the ``binaryFile`` source with ``content`` pruned):
globs are expanded, directories descended when ``recursive``, and Spark lists
many paths in parallel.  As with every Spark file source, names starting with
``_`` or ``.`` are ignored (the reference has no such rule).
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.options import IngestOptions, apply_hadoop_conf
from fileflow.session import few_listing_tasks


def listed_path() -> Column:
    """A scan's file path, spelled as ``list_files`` spells it."""
    return spelled_path(F.col("_metadata.file_path"))


def spelled_path(path: Column) -> Column:
    """A path of the file metadata, which is a URL, as ``list_files`` spells it."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def spelled(path: str) -> str:
    """``spelled_path`` of one path, for functions that run in Python workers."""
    return re.sub("^file:/+", "file:/", unquote(path))


def list_files(spark: SparkSession, paths, recursive: bool = True, path_regex: str | None = None,
               skip_empty: bool = True, opts: IngestOptions | None = None) -> DataFrame:
    """path, length, modificationTime of every file under ``paths`` (glob allowed).

    No match raises Spark's PATH_NOT_FOUND (F3).  The regex is an unanchored
    find on the full path string (F1); empty files are dropped (F2).
    """
    if isinstance(paths, str):
        paths = [paths]
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", bool(recursive))
    if opts is not None:
        reader = apply_hadoop_conf(reader, opts)
    with few_listing_tasks(spark):
        inv = reader.load(list(paths)).select("path", "length", "modificationTime")
    if path_regex:
        inv = inv.where(F.col("path").rlike(path_regex))
    if skip_empty:
        inv = inv.where(F.col("length") > 0)
    return inv


def require_nonempty(inventory: DataFrame, length_col: str = "length") -> DataFrame:
    """Fail at execution when every listed file is empty (F4), lazily."""
    total = F.coalesce(F.sum(length_col), F.lit(0))
    ok = inventory.agg(F.when(total <= 0, F.raise_error(F.lit("all files are empty")))
                         .otherwise(F.lit(True))).scalar()
    return inventory.where(ok)
