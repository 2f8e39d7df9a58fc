"""Byte-range planning as table operators.

Input is any DataFrame with a path and a byte length (a file inventory, or a
manifest of documents).  Output rows are byte ranges:

    path_string, start, end, is_decompressible, is_partitionable,
    num_header_lines, size

Everything is one lazy plan: the job-wide unit is a scalar subquery (one small
aggregate, inlined as a literal), the explode is map-only, and no step
shuffles the inventory.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fileflow.functions.text import idiv
from fileflow.operators.selection import IN_TASK, first_rows, kth_key
from fileflow.options import DEFAULT_CODEC_SUFFIXES
from fileflow.session import written

RANGE_COLUMNS = ["path_string", "start", "end", "is_decompressible", "is_partitionable",
                 "num_header_lines", "size"]


def codec_suffix_regex(suffixes=DEFAULT_CODEC_SUFFIXES) -> str:
    return "(?:" + "|".join(re.escape(s) for s in suffixes) + ")$"


def codec_flags(df: DataFrame, path_col: str = "path", decompression: bool = True,
                splittable: bool = True, codec_suffixes=DEFAULT_CODEC_SUFFIXES) -> DataFrame:
    """Add is_decompressible (wanted and the suffix has a codec) and
    is_partitionable (wanted and not decompressible)."""
    has_codec = F.col(path_col).rlike(codec_suffix_regex(codec_suffixes))
    dec = F.lit(bool(decompression)) & has_codec
    return (df.withColumn("is_decompressible", dec)
              .withColumn("is_partitionable", F.lit(bool(splittable)) & ~dec))


def total_size(df: DataFrame, length_col: str = "length") -> DataFrame:
    """One row: total bytes of the listing (empties count as 0)."""
    return df.agg(F.coalesce(F.sum(length_col), F.lit(0)).cast("long").alias("total_bytes"))


def unit_size(df: DataFrame, target_ranges: int, length_col: str = "length") -> DataFrame:
    """One row: total bytes and the range unit max(total div n, 1)."""
    n = int(target_ranges)
    if n <= 0:
        raise ValueError("target_ranges must be > 0 (resolve defaults with IngestOptions)")
    t = total_size(df, length_col)
    return t.select("total_bytes", F.greatest(idiv(F.col("total_bytes"), F.lit(n)),
                                              F.lit(1)).cast("long").alias("unit"))


def unit_column(df: DataFrame, target_ranges: int, length_col: str = "length") -> Column:
    """The unit as a scalar subquery: evaluated once, inlined as a literal."""
    return unit_size(df, target_ranges, length_col).select("unit").scalar()


def range_count(df: DataFrame, unit: Column, length_col: str = "length") -> DataFrame:
    """Ranges per item: (len-1) div unit + 1 when partitionable, else 1."""
    n = F.when(F.col("is_partitionable"), idiv(F.col(length_col) - 1, unit) + 1).otherwise(F.lit(1))
    return df.withColumn("n_ranges", n.cast("long"))


def explode_ranges(df: DataFrame, path_col: str = "path", length_col: str = "length",
                   header_lines: int = 0) -> DataFrame:
    """start = len*i div n, end = len*(i+1) div n for i in [0, n).  Map-only.

    Computed as i * (len div n) + (i * (len mod n)) div n, which is the same
    number and does not overflow for long inputs.
    """
    ln = F.col(length_col)
    g = df.select(
        F.col(path_col).alias("path_string"), ln.alias("_len"), "n_ranges",
        "is_decompressible", "is_partitionable",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_ranges") - 1)).alias("range_no"))
    n = F.col("n_ranges")

    def cut(i):
        return i * idiv(F.col("_len"), n) + idiv(i * (F.col("_len") % n), n)

    start, end = cut(F.col("range_no")), cut(F.col("range_no") + 1)
    return g.select(
        "path_string", start.alias("start"), end.alias("end"),
        "is_decompressible", "is_partitionable",
        F.lit(int(header_lines)).cast("int").alias("num_header_lines"),
        (end - start).alias("size"))


def range_plan(inventory: DataFrame, target_ranges: int, path_col: str = "path",
               length_col: str = "length", splittable: bool = True, decompression: bool = True,
               header_lines: int = 0, path_regex: str | None = None,
               filter_before_sizing: bool = False, fail_if_empty: bool = False,
               codec_suffixes=DEFAULT_CODEC_SUFFIXES) -> DataFrame:
    """Whole plan: skip empties, size, flag, count, explode, then the regex.

    The reference sizes the unit over every listed file and filters by regex
    afterwards; ``filter_before_sizing`` sizes over the matching files only.
    """
    inv = inventory
    if path_regex and filter_before_sizing:
        inv = inv.where(F.col(path_col).rlike(path_regex))
    sized = unit_size(inv, target_ranges, length_col)
    if fail_if_empty:
        # inside the scalar subquery: it runs once before the plan, even when
        # no row is left to evaluate a row-level check
        sized = sized.withColumn("unit", F.when(F.col("total_bytes") <= 0,
                                                F.raise_error(F.lit("all files are empty")))
                                          .otherwise(F.col("unit")))
    unit = sized.select("unit").scalar()
    live = inv.where(F.col(length_col) > 0)
    flagged = codec_flags(live, path_col, decompression, splittable, codec_suffixes)
    counted = range_count(flagged, unit, length_col)
    plan = explode_ranges(counted, path_col, length_col, header_lines)
    if path_regex and not filter_before_sizing:
        plan = plan.where(F.col("path_string").rlike(path_regex))
    return plan


def range_invariants(plan: DataFrame) -> DataFrame:
    """One row per violated rule: a field absent; decompressible and partitionable;
    decompressible with start != 0."""
    fields = ["path_string", "start", "end", "is_decompressible", "is_partitionable",
              "num_header_lines"]
    absent = F.exists(F.array(*[F.col(c).isNull() for c in fields]), lambda x: x)
    rules = F.array(
        F.when(absent, F.lit("field_absent")),
        F.when(F.col("is_decompressible") & F.col("is_partitionable"),
               F.lit("decompressible_and_partitionable")),
        F.when(F.col("is_decompressible") & (F.col("start") != 0),
               F.lit("decompressible_with_nonzero_start")),
    )
    return (plan.select(*fields, F.explode(F.array_compact(rules)).alias("rule"))
                .select("path_string", "start", "end", "rule"))


def last_range(plan: DataFrame, order=("path_string", "start")) -> DataFrame:
    """The last range in (path, start) order, in one aggregate pass (no sort)."""
    cols = plan.columns
    best = F.max_by(F.struct(*cols), F.struct(*order)).alias("_last")
    return plan.agg(best).select("_last.*")


def range_limit(plan: DataFrame, k: int, order=("path_string", "start")) -> DataFrame:
    """First K ranges in order (reference: total_file_count_limit), selected without a full sort."""
    return first_rows(plan, list(order), int(k))


def file_limit(plan: DataFrame, k: int, path_col: str = "path_string") -> DataFrame:
    """Ranges of the first K files by path (what max_files says).

    The first K files are exactly those whose path is <= the K-th smallest
    distinct path, so this is a filter on one scalar: no join, nothing
    broadcast.
    """
    k = int(k)
    if k <= 0:
        return plan.where(F.lit(False))
    paths = plan.select(F.col(path_col).alias("_p")).where(F.col("_p").isNotNull()).distinct()
    if k <= IN_TASK:
        return plan.where(F.col(path_col) <= paths.orderBy("_p").limit(k).agg(F.max("_p")).scalar())
    found = kth_key(written(paths, "paths"), ["_p"], k)
    return plan.where(F.col(path_col).isNotNull()) if found is None else plan.where(F.col(path_col) <= F.lit(found[0]["_p"]))
