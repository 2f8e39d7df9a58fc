"""Line scans over files.

Spark's text and CSV sources already cut plain files into line-aligned splits
(each line read once), decompress by file suffix (gzip and other whole-file
codecs in one split; bzip2 splittable), expand globs and descend directories.
These helpers only choose the options.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.functions.strftime import (expand_template, path_time, resolve_template, template_glob, template_regex,
                                         truncated)
from fileflow.functions.text import split_lines
from fileflow.options import IngestOptions, apply_hadoop_conf


def _as_list(paths):
    return [paths] if isinstance(paths, str) else list(paths)


def read_lines(spark: SparkSession, paths, recursive: bool = True, with_file: bool = False,
               opts: IngestOptions | None = None) -> DataFrame:
    """One row per line (column ``value``); splits are line-aligned (S6), codecs
    by suffix (S7), globs expanded and trees descended (S1, S2)."""
    reader = spark.read.option("recursiveFileLookup", bool(recursive))
    if opts is not None:
        reader = apply_hadoop_conf(reader, opts)
    df = reader.text(_as_list(paths))
    if with_file:
        df = df.select("value", F.col("_metadata.file_path").alias("file_path"))
    return df


def read_whole_files(spark: SparkSession, paths, recursive: bool = True) -> DataFrame:
    """Unsplit read (S5): one row per file, its lines exploded in order.

    Each file is one task and one row, so this is for files that fit in a task;
    for large unsplittable inputs prefer the CSV reader with ``multiLine``,
    which streams the file.
    """
    # the keyword, not .option(): text() would reset the option to its default
    df = spark.read.option("recursiveFileLookup", bool(recursive)).text(_as_list(paths), wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("file_path"),
                     F.posexplode(split_lines(F.col("value"))).alias("line_no", "line"))


def templated_paths(template: str, now: _dt.datetime, rewind_seconds: int = 0,
                    span_seconds: int = 0, step_seconds: int = 86400) -> list[str]:
    """Paths of a date template (S4): strftime(now - rewind); with a span, every
    distinct path from now - rewind - span up to now - rewind."""
    end = now - _dt.timedelta(seconds=int(rewind_seconds))
    if span_seconds <= 0:
        return [resolve_template(template, end)]
    start = end - _dt.timedelta(seconds=int(span_seconds))
    return expand_template(template, start, end, step_seconds)


def existing_paths(spark: SparkSession, template: str, start: _dt.datetime, end: _dt.datetime,
                   opts: IngestOptions | None = None) -> list[str]:
    """The paths of a template that are there, with a time from ``start``'s to ``end``'s (S4); gaps are no error.

    One listing of a glob, pruned by the time parsed from each path: a row per path of the span comes back.
    """
    regex, letters = template_regex(template)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if opts is not None:
        reader = apply_hadoop_conf(reader, opts)
    path = F.col("path")
    files = reader.load(template_glob(template, start, end)).select("path")
    time = path_time(path, template)
    named = files.where(time.between(F.lit(truncated(start, template)).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))
    found = named.select(F.regexp_extract(path, f"^(.*?{regex})(?=/|$)", 1).alias("p")).distinct().orderBy("p").collect()
    # a path is a glob to the reader
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", r["p"]) for r in found]


def session_now(spark: SparkSession) -> _dt.datetime:
    """Wall clock in the session time zone (the default ``now``)."""
    from zoneinfo import ZoneInfo

    tz = ZoneInfo(spark.conf.get("spark.sql.session.timeZone", "UTC"))
    return _dt.datetime.now(tz).replace(tzinfo=None)


def read_gzip_any_name(spark: SparkSession, paths, recursive: bool = True) -> DataFrame:
    """Gzip files whose names carry no codec suffix (L12): decoded per file in
    Arrow batches, then split into lines.  Every file is one row in one task."""
    import pyarrow as pa

    def members(data):
        """Text of all members of a gzip file, one after another."""
        out = []
        while data:
            decoder = zlib.decompressobj(16 + zlib.MAX_WBITS)
            out.append(decoder.decompress(data) + decoder.flush())
            if not decoder.eof:
                raise ValueError("gzip file is cut off")
            data = decoder.unused_data
            if not data.strip(b"\0"):  # padding behind the last member
                break
        return b"".join(out).decode("utf-8")

    def gunzip(batches):
        for rb in batches:
            content = rb.column("content").to_pylist()
            text = [members(c) for c in content]
            yield pa.RecordBatch.from_arrays([rb.column("path"), pa.array(text, pa.string())],
                                             names=["file_path", "text"])

    raw = (spark.read.format("binaryFile").option("recursiveFileLookup", bool(recursive))
           .load(_as_list(paths)).select("path", "content"))
    dec = raw.mapInArrow(gunzip, "file_path string, text string")
    return dec.select("file_path", F.posexplode(split_lines(F.col("text"))).alias("line_no", "line"))


def read_csv(spark: SparkSession, paths, schema: str, recursive: bool = True,
             opts: IngestOptions | None = None, **options) -> DataFrame:
    """Native typed CSV scan with a declared schema (never inferred)."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", bool(recursive)).options(**options)
    if opts is not None:
        reader = apply_hadoop_conf(reader, opts)
    return reader.csv(_as_list(paths))


@contextlib.contextmanager
def approximate_ranges(spark: SparkSession, paths, target_ranges: int, recursive: bool = True):
    """Scope in which file scans are cut in about ``target_ranges`` splits.

    The split size is the reference unit max(total bytes div n, 1); Spark
    still packs small files and never splits a gzip, so the count is
    approximate, as in the reference.  Split sizes are read when a scan is
    planned, so run the action inside the block.
    """
    from fileflow.options import split_bytes_for
    from fileflow.session import session_conf
    from fileflow.sources.inventory import list_files

    total = list_files(spark, paths, recursive=recursive).agg(F.sum("length")).first()[0] or 0
    unit = split_bytes_for(total, target_ranges)
    with session_conf(spark, spark__sql__files__maxPartitionBytes=unit):
        yield unit
