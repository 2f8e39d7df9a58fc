"""Quarantine (L8, L9): good rows typed, bad rows as they were with their reason and place, in one pass.

``write_rows`` parses lines and writes good and bad rows of a batch by one
write, split into folders by the row's status; an ``Observation`` counts them
in the same pass.  A batch has a folder of its own, which a retry replaces
whole, so a batch written twice is there once; readers take finished batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fileflow.sources.delimited import parse_delimited
from fileflow.sources.splits import lines_with_offsets

#: Reasons a row can be bad for.
REASONS = ("missing_columns", "extra_columns", "bad_value")
PLACE = ("path", "line_start", "line_bytes", "line_no")
#: Columns of the written rows beside those declared.
WRITTEN = ("_line", "_reason", *("_" + c for c in PLACE), "_kind")


def placed_lines(spark: SparkSession, paths, header_lines: int = 0, **scan) -> DataFrame:
    """Lines of a split scan with their place, without the first ``header_lines`` of each file."""
    return lines_with_offsets(spark, paths, **scan).where(F.col("line_no") >= header_lines)


def write_rows(lines: DataFrame, columns, path: str, batch: int, allow_extra_columns: bool = False,
               allow_optional_columns: bool = False, **parse) -> dict[str, int]:
    """Write the rows of ``lines`` (column ``value``, places optional) as batch ``batch`` under ``path``.

    Returns how many rows are ``good``, ``bad`` and bad for each reason.  Empty lines are no rows.  The rows of a
    batch replace those of an earlier try.  ``parse`` goes to ``parse_delimited``.
    """
    if int(batch) < 0:
        raise ValueError("batch must be >= 0")
    place = [c for c in PLACE if c in lines.columns]
    kept = lines.select("value", F.col("value").alias("_line"), *[F.col(c).alias("_" + c) for c in place])
    own = ["_line", *("_" + c for c in place)]
    rows = parse_delimited(kept, columns, allow_extra_columns=allow_extra_columns, allow_optional_columns=allow_optional_columns,
                           on_bad_row="null", with_status=True, keep=own, **parse)
    declared = [c for c in rows.columns if c not in (*own, "row_status")]
    if clash := {c.lower() for c in declared} & {*WRITTEN, "row_status"}:
        raise ValueError(f"column names taken by the quarantine: {sorted(clash)}")
    allowed = ["ok"] + ["extra_columns"] * allow_extra_columns + ["missing_columns"] * allow_optional_columns
    good = F.col("row_status").isin(allowed)
    rows = rows.select(*[F.when(good, F.col(c)).alias(c) for c in declared], *[F.when(~good, F.col(c)).alias(c) for c in own],
                       F.when(~good, F.col("row_status")).alias("_reason"), F.when(good, "good").otherwise("bad").alias("_kind"))
    counts = Observation()
    rows = rows.observe(counts, F.count_if(F.col("_kind") == "good").alias("good"), F.count_if(F.col("_kind") == "bad").alias("bad"),
                        *[F.count_if(F.col("_reason") == r).alias(r) for r in REASONS])
    rows.write.mode("overwrite").partitionBy("_kind").parquet(f"{path.rstrip('/')}/batch={int(batch)}")
    return dict(counts.get)


def _read(spark: SparkSession, path: str, schema: str, kind: str) -> DataFrame:
    # the written types, and the folders' columns
    rows = spark.read.schema(f"{schema}, _kind string, batch long").option("basePath", path).parquet(f"{path.rstrip('/')}/batch=*")
    return rows.where(F.col("_kind") == kind).drop("_kind")


def good_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Good rows of all batches, with their batch; ``schema`` is the declared columns' DDL."""
    return _read(spark, path, schema, "good")


def bad_rows(spark: SparkSession, path: str) -> DataFrame:
    """Bad rows of all batches: line, reason, batch, and path, line_start, line_bytes, line_no where lines had them."""
    rows = _read(spark, path, "_line string, _reason string, _path string, _line_start long, _line_bytes long, _line_no long", "bad")
    return rows.withColumnsRenamed({"_line": "line", "_reason": "reason", **{"_" + c: c for c in PLACE}})
