"""Delimited text with typed columns.

Plan: line scan -> drop N header lines per file -> ``from_csv`` into strings
(one spare column) -> per-column casts, each timestamp with its own format ->
row status (ok / missing_columns / extra_columns / bad_value) -> policy.

Everything but the header drop is native.  The header drop is map-only: lines of
a file's first split arrive in order in one task, so each task drops the first
N lines of every first split it reads, in one pass and without a shuffle.  A
header longer than a split (N lines not inside the first split of a file that
goes on) fails loudly instead of guessing; ``header_mode='exact'`` is for such
files: it counts the lines of every split in a pass of its own, from which
follows how many lines each split drops, wherever the header ends.

Reads with quoted newlines or another charset get whole records from the CSV
source, and go through the same parse and row policy.
"""

from __future__ import annotations

import dataclasses
import re

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fileflow.functions.strftime import strftime_to_java
from fileflow.options import IngestOptions, apply_hadoop_conf
from fileflow.session import scratch_path
from fileflow.sources.inventory import listed_path
from fileflow.sources.splits import read_records
from fileflow.sources.wide import read_wide_lines

SIMPLE_TYPES = {"long": "bigint", "int": "int", "double": "double", "boolean": "boolean",
                "string": "string", "timestamp": "timestamp"}


@dataclasses.dataclass(frozen=True)
class Col:
    name: str
    type: str = "string"
    format: str | None = None      # strftime format for timestamp columns

    def __post_init__(self):
        if self.type not in SIMPLE_TYPES:
            raise ValueError(f"unsupported column type {self.type!r}")


def _cols(columns) -> list[Col]:
    out = []
    for c in columns:
        if isinstance(c, Col):
            out.append(c)
        elif isinstance(c, dict):
            out.append(Col(c["name"], c.get("type", "string"), c.get("format")))
        else:
            out.append(Col(*c))
    return out


# ------------------------------------------------------------ header drop

def _head_dropper(n: int):
    import numpy as np
    import pyarrow as pa

    def drop(batches):
        seen: dict = {}        # file -> lines of its first split seen in this task
        whole: dict = {}       # file -> does its first split reach the end of the file
        for rb in batches:
            bs = rb.column("_bs").to_numpy(zero_copy_only=False)
            head = np.nonzero(bs == 0)[0]
            if not head.size:             # no first-split line: pass through, no copy
                yield rb.select(["value"])
                continue
            keep = np.ones(rb.num_rows, dtype=bool)
            if head.size:
                sub = rb.take(pa.array(head))
                files = sub.column("_fp").to_pandas()
                prior = files.map(lambda f: seen.get(f, 0)).to_numpy()
                rank = files.groupby(files, sort=False).cumcount().to_numpy() + prior
                keep[head] = rank >= n
                counts = files.value_counts()
                ends = (sub.column("_bl").to_numpy(zero_copy_only=False)
                        >= sub.column("_fs").to_numpy(zero_copy_only=False))
                for f, c in counts.items():
                    seen[f] = seen.get(f, 0) + int(c)
                first = ~files.duplicated().to_numpy()
                for f, e in zip(files[first], ends[first]):
                    whole[f] = bool(e)
            out = rb.filter(pa.array(keep)).select(["value"])
            yield out
        short = [f for f, c in seen.items() if c < n and not whole.get(f, True)]
        if short:
            raise ValueError(
                f"header of {n} lines does not fit in the first split of {short[0]}; "
                "raise spark.sql.files.maxPartitionBytes or use header_mode='exact'")

    return drop


def _header_cuts(tagged: DataFrame, n: int) -> DataFrame:
    """Splits that hold header lines: file, start, and the id of their first line that is data.

    One row per split, from its line count and first id; the running total of
    lines before a split, over the splits of its file, tells what it drops.
    """
    splits = tagged.groupBy("_fp", "_bs").agg(F.count("*").alias("_lines"), F.min("_mid").alias("_first"))
    w = Window.partitionBy("_fp").orderBy("_bs").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("_lines").over(w) - F.col("_lines")
    return (splits.withColumn("_before", before).where(F.col("_before") < n)
            .select("_fp", "_bs", (F.col("_first") + F.least(F.col("_lines"), n - F.col("_before"))).alias("_cut")))


def drop_header_lines(lines: DataFrame, n: int, mode: str = "fast") -> DataFrame:
    """Drop the first ``n`` physical lines of every file of a text scan.

    ``lines`` must come straight from a text scan (column ``value``).  ``exact``
    counts lines when it is called and writes the cuts, about a row a file, to
    the shared folder; their size is then known, and Spark broadcasts them or not.
    """
    if n <= 0:
        return lines.select("value")
    where = [F.col("_metadata.file_path").alias("_fp"), F.col("_metadata.file_block_start").alias("_bs")]
    if mode == "fast":
        tagged = lines.select("value", *where, F.col("_metadata.file_block_length").alias("_bl"),
                              F.col("_metadata.file_size").alias("_fs"))
        return tagged.mapInArrow(_head_dropper(n), "value string")
    if mode != "exact":
        raise ValueError("header_mode must be 'fast' or 'exact'")
    # the id is taken in the scan's projection; the lines of a split follow one another
    tagged = lines.select("value", *where, F.monotonically_increasing_id().alias("_mid"))
    path = scratch_path(lines.sparkSession, "header-cuts")
    cuts = _header_cuts(tagged, n)
    cuts.write.parquet(path)
    cuts = lines.sparkSession.read.schema(cuts.schema).parquet(path)
    return (tagged.join(cuts, ["_fp", "_bs"], "left")
            .where(F.col("_cut").isNull() | (F.col("_mid") >= F.col("_cut"))).select("value"))


# ------------------------------------------------------------ parsing

#: Closes every line behind one more separator; where the parser finds it tells how many fields a line has.
END = "\u2404 end of line \u2404"


def _fields(parsed: str, k: int, sep: str):
    """Columns of ``k`` raw fields and the number of fields (k + 1: more than k) of a line parsed with ``END``.

    A quote that is not closed takes ``END`` into its field; it is cut off again.
    """
    raw = [F.col(f"{parsed}._c{i}") for i in range(k + 1)]
    count = F.lit(k + 1)
    for i, c in reversed(list(enumerate(raw))):
        count = (F.when(c == END, F.lit(i)).when(F.endswith(c, F.lit(sep + END)), F.lit(i + 1)).otherwise(count))
    cut = len(sep + END)
    values = [F.when(c == END, F.lit(None)).when(F.endswith(c, F.lit(sep + END)), F.substring(c, F.lit(1), F.length(c) - cut)).otherwise(c)
              for c in raw[:k]]
    return values, count


def _typed(c: Col, raw: SparkColumn, timestamp_ntz: bool) -> SparkColumn:
    if c.type == "string":
        return raw
    if c.type == "timestamp":
        if timestamp_ntz and c.format:
            # a one-column record: the only parse with a format that keeps out of the session zone and gives
            # null for what does not fit
            whole = {"sep": "\u0001", "quote": "\u0000", "timestampNTZFormat": strftime_to_java(c.format)}
            return F.from_csv(raw, "t timestamp_ntz", whole)["t"]
        if timestamp_ntz:
            return raw.try_cast("timestamp_ntz")
        if c.format:
            ts = F.try_to_timestamp(raw, F.lit(strftime_to_java(c.format)))
        else:
            ts = raw.try_cast("timestamp")
        return ts
    return F.trim(raw).try_cast(SIMPLE_TYPES[c.type])


def parse_delimited(lines: DataFrame, columns, sep: str = ",", quote: str = '"', escape: str = '"',
                    trim_if_not_quoted: bool = False, allow_extra_columns: bool = False,
                    allow_optional_columns: bool = False, on_bad_row: str = "fail",
                    timestamp_ntz: bool = False, with_status: bool = False, keep=()) -> DataFrame:
    """Parse a ``value`` line column into declared typed columns; columns ``keep`` of ``lines`` follow as they are."""
    cols = _cols(columns)
    k = len(cols)
    raw_schema = ", ".join(f"`_c{i}` STRING" for i in range(k + 1))
    options = {"sep": sep, "quote": quote if quote else "\u0000", "escape": escape or "\\",
               "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": str(bool(trim_if_not_quoted)).lower(),
               "ignoreTrailingWhiteSpace": str(bool(trim_if_not_quoted)).lower()}
    src = lines.where(F.col("value") != "")
    line = F.concat(F.col("value"), F.lit(sep + END))
    parsed = src.select(F.col("value"), *keep, F.from_csv(line, raw_schema, options).alias("_r"))
    values, count = _fields("_r", k, sep)
    # an explicit projection of the fields, which the typed columns and the status share
    parsed = parsed.select("value", *keep, count.alias("_n"), *[v.alias(f"_c{i}") for i, v in enumerate(values)])
    nf = F.col("_n")
    typed = [_typed(c, F.col(f"_c{i}"), timestamp_ntz).alias(c.name) for i, c in enumerate(cols)]
    failed = [F.col(f"_c{i}").isNotNull() & _typed(c, F.col(f"_c{i}"), timestamp_ntz).isNull()
              for i, c in enumerate(cols) if c.type != "string"]
    any_failed = F.lit(False)
    for f in failed:
        any_failed = any_failed | f
    status = (F.when(nf < k, F.lit("missing_columns"))
               .when(nf > k, F.lit("extra_columns"))
               .when(any_failed, F.lit("bad_value"))
               .otherwise(F.lit("ok")))
    out = parsed.select("value", *keep, *typed, status.alias("_status"))
    allowed = ((F.col("_status") == "ok")
               | ((F.col("_status") == "missing_columns") & F.lit(bool(allow_optional_columns)))
               | ((F.col("_status") == "extra_columns") & F.lit(bool(allow_extra_columns))))
    # The policy is a 0/1-row generator, not a Filter: Catalyst would push a
    # Filter below the projection and inline every typed cast into it (each row
    # parsed twice).  A generator is never collapsed into its child, and never
    # pruned either, since it sets the row count, so "fail" cannot be skipped.
    if on_bad_row in ("fail", "drop"):
        if on_bad_row == "fail":
            reject = F.array(F.raise_error(F.concat(F.lit("bad row ("), F.col("_status"), F.lit("): "),
                                                    F.col("value"))).cast("boolean"))
        else:
            reject = F.array().cast("array<boolean>")
        once = F.when(allowed, F.array(F.lit(True))).otherwise(reject)
        out = out.select("*", F.explode(once).alias("_keep")).drop("_keep")
    elif on_bad_row != "null":
        raise ValueError("on_bad_row must be fail, drop or null")
    names = [c.name for c in cols]
    return out.select(*names, *keep, *([F.col("_status").alias("row_status")] if with_status else []))


def read_delimited(spark: SparkSession, paths, columns, sep: str = ",", quote: str = '"',
                   escape: str = '"', header_lines: int = 0, header_mode: str = "fast",
                   trim_if_not_quoted: bool = False, allow_extra_columns: bool = False,
                   allow_optional_columns: bool = False, on_bad_row: str = "fail",
                   encoding: str = "UTF-8", multi_line: bool | str = False, recursive: bool = True,
                   timestamp_ntz: bool = False, with_status: bool = False,
                   path_regex: str | None = None, last_path: str | None = None,
                   opts: IngestOptions | None = None, split_bytes: int | None = None) -> DataFrame:
    """Typed delimited read of files (globs, trees, codecs by suffix).

    ``multi_line`` lets quoted fields hold line ends: True leaves files whole, "split" reads them in splits of
    ``split_bytes`` (two passes, run when called; ``header_lines`` then counts records).
    UTF-16 and UTF-32 files are one split each, unless ``split_bytes`` is given: then a line is a record, and
    any number of header lines goes (two passes, run when called).
    ``path_regex`` keeps files whose full path matches (unanchored), and
    ``last_path`` those up to that path, as filters on the scan's file metadata."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    utf8 = encoding.replace("-", "").lower() == "utf8"
    if multi_line not in (False, True, "split"):
        raise ValueError("multi_line must be False, True or 'split'")
    if multi_line == "split" and not utf8:
        raise ValueError("multi_line='split' reads UTF-8 files")
    records = multi_line or not utf8
    wide = split_bytes is not None and not multi_line and encoding.replace("-", "").lower().startswith(("utf16", "utf32"))
    wanted = F.lit(True)
    if path_regex:
        wanted = wanted & listed_path().rlike(path_regex)
    if last_path is not None:
        wanted = wanted & (listed_path() <= last_path)
    reader = spark.read.option("recursiveFileLookup", bool(recursive))
    if opts is not None:
        reader = apply_hadoop_conf(reader, opts)
    if multi_line == "split":
        lines = read_records(spark, paths, sep, quote, escape, int(header_lines), recursive, trim_if_not_quoted, wanted, opts,
                             split_bytes=split_bytes)
    elif wide:
        lines = read_wide_lines(spark, paths, encoding, recursive, wanted, opts, split_bytes, int(header_lines)).select("value")
    elif records:
        lines = _records(reader, paths, len(_cols(columns)), sep, quote, escape, int(header_lines), encoding,
                         multi_line, wanted)
    else:
        lines = reader.text(paths).where(wanted)
        lines = drop_header_lines(lines, int(header_lines), header_mode)
    return parse_delimited(lines, columns, sep, quote, escape, trim_if_not_quoted,
                           allow_extra_columns, allow_optional_columns, on_bad_row,
                           timestamp_ntz, with_status)


def _records(reader, paths, k: int, sep: str, quote: str, escape: str, header_lines: int, encoding: str,
             multi_line: bool, wanted: SparkColumn) -> DataFrame:
    """Whole records as the CSV source cuts them (column ``value``): for quoted newlines (``multi_line``) and for
    charsets other than UTF-8.  At most one header line.  UTF-16 and UTF-32 files are never split.

    The source keeps the text of a record whose fields do not match its schema.  With two fields more than wanted
    only records of exactly as many match; these are put together again.
    """
    if header_lines > 1:
        raise ValueError("header_lines > 1 needs a UTF-8, line-based read")
    wide = encoding.replace("-", "").lower().startswith(("utf16", "utf32"))
    names = [f"_c{i}" for i in range(k + 2)]
    df = (reader.schema(", ".join(f"`{c}` STRING" for c in names) + ", _raw STRING")
          .option("sep", sep).option("quote", quote if quote else "\u0000")
          .option("escape", escape or "\\").option("header", header_lines == 1)
          .option("encoding", encoding).option("multiLine", bool(multi_line or wide))
          .option("columnNameOfCorruptRecord", "_raw").csv(paths).where(wanted))
    fields = [F.coalesce(F.col(c), F.lit("")) for c in names]
    if quote:
        inner = [F.replace(F.replace(c, F.lit(escape), F.lit(escape * 2)) if escape and escape != quote else c,
                           F.lit(quote), F.lit((escape or "\\") + quote)) for c in fields]
        fields = [F.when(c == "", c).otherwise(F.concat(F.lit(quote), i, F.lit(quote))) for c, i in zip(fields, inner)]
    return df.select(F.coalesce("_raw", F.concat_ws(sep, *fields)).alias("value"))
