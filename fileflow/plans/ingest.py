"""The whole ingest as two calls, from the same options as the reference job.

``plan_ingest``: template -> listing -> empties -> unit -> flags -> ranges ->
regex -> limit -> index -> greedy tasks.  A DataFrame of ranges with
``range_index`` and ``task_id``: the plan a user inspects or hands to another
system.  Building it runs jobs: the index and the packing checkpoint what they
sort.

``read_ingest``: the rows.  Spark plans its own splits over the same files
(line-aligned, codecs by suffix), so rows do not depend on the range plan or
on ``splittable``; ``target_ranges`` only sizes the splits when the action runs
inside ``scans.approximate_ranges``.  Options that would change the rows are
honoured or refused, never ignored.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.operators.packing import task_pack
from fileflow.operators.ranges import codec_suffix_regex, file_limit, range_limit, range_plan
from fileflow.operators.selection import kth_key
from fileflow.options import IngestOptions
from fileflow.sources.delimited import parse_delimited, read_delimited
from fileflow.sources.inventory import list_files, listed_path
from fileflow.sources.scans import existing_paths, session_now, templated_paths
from fileflow.sources.splits import lines_with_offsets


def resolved_paths(spark: SparkSession, opts: IngestOptions, now: _dt.datetime | None = None) -> list[str]:
    now = now or session_now(spark)
    if opts.span_seconds > 0:
        end = now - _dt.timedelta(seconds=opts.rewind_seconds)
        found = existing_paths(spark, opts.path, end - _dt.timedelta(seconds=opts.span_seconds), end, opts)
        if found:
            return found
    return templated_paths(opts.path, now, opts.rewind_seconds, opts.span_seconds, opts.span_step_seconds)


def _ranges(spark: SparkSession, opts: IngestOptions, paths) -> DataFrame:
    """The ranges of the files that the options select, up to ``max_files``; ``max_ranges`` is not applied."""
    inv = list_files(spark, paths, recursive=True, skip_empty=False, opts=opts)
    regex = opts.path_regex if opts.path_regex not in (None, "", ".*") else None
    plan = range_plan(inv, opts.resolved_target(spark), splittable=opts.splittable,
                      decompression=opts.decompression, header_lines=opts.header_lines,
                      path_regex=regex, filter_before_sizing=opts.filter_before_sizing,
                      fail_if_empty=opts.fail_if_empty, codec_suffixes=opts.codec_suffixes)
    return plan if opts.max_files is None else file_limit(plan, opts.max_files)


def plan_ingest(spark: SparkSession, opts: IngestOptions, now: _dt.datetime | None = None) -> DataFrame:
    plan = _ranges(spark, opts, resolved_paths(spark, opts, now))
    if opts.max_ranges < 2147483647:
        plan = range_limit(plan, opts.max_ranges)
    plan = plan.withColumn("_job", F.lit(0))
    packed = task_pack(plan, ["_job"], ["path_string", "start"], "size", opts.min_task_size)
    return packed.drop("_job")


def read_ingest(spark: SparkSession, opts: IngestOptions, columns, now: _dt.datetime | None = None,
                **parse_options) -> DataFrame:
    """Typed rows of every file the options select (header lines dropped once per file).

    The path regex and the K-th path of ``max_files`` filter on the scan's file
    metadata, so other files are not opened.  ``max_ranges`` ends where the K-th range of the plan does: files
    before its file are read whole, of its file the lines whose first byte lies before the range's end.
    ``fail_if_empty`` fails when all listed files are empty.  Spark always decompresses by suffix, so
    ``decompression=False`` where a selected file has a codec's suffix is an error.
    """
    paths = resolved_paths(spark, opts, now)
    regex = opts.path_regex if opts.path_regex not in (None, "", ".*") else None
    if opts.fail_if_empty and list_files(spark, paths, opts=opts).isEmpty():
        raise ValueError("all files are empty")
    chosen = list_files(spark, paths, path_regex=regex, opts=opts)
    last, cut = None, None
    if opts.max_files is not None:
        first = range_limit(chosen.select("path"), int(opts.max_files), order=("path",))
        last = first.agg(F.max("path")).first()[0]
        if last is None:
            raise ValueError("no file matches the options")
        chosen = chosen.where(F.col("path") <= last)
    if opts.max_ranges < 2147483647:
        end = _last_range(_ranges(spark, opts, paths), int(opts.max_ranges))
        if end is not None:
            last, chosen = end["path_string"], chosen.where(F.col("path") <= end["path_string"])
            cut = end["end"] if end["is_partitionable"] and chosen.where(
                (F.col("path") == last) & (F.col("length") > end["end"])).head(1) else None
    if not opts.decompression and not chosen.where(F.col("path").rlike(codec_suffix_regex(opts.codec_suffixes))).isEmpty():
        raise ValueError("Spark decompresses by suffix; decompression=False cannot read files with a codec's suffix")
    if cut is None:
        return read_delimited(spark, paths, columns, header_lines=opts.header_lines, path_regex=regex, last_path=last,
                              opts=opts, **parse_options)
    if not set(parse_options) <= PARSE_OPTIONS:
        raise ValueError(f"max_ranges cuts files between lines; not with {sorted(set(parse_options) - PARSE_OPTIONS)}")
    part = lines_with_offsets(spark, paths, wanted=listed_path() == last, opts=opts)
    rows = parse_delimited(part.where((F.col("line_start") < cut) & (F.col("line_no") >= opts.header_lines)).select("value"),
                           columns, **parse_options)
    whole = chosen.where(F.col("path") < last).agg(F.max("path")).first()[0]
    if whole is None:
        return rows
    return read_delimited(spark, paths, columns, header_lines=opts.header_lines, path_regex=regex, last_path=whole,
                          opts=opts, **parse_options).unionByName(rows)


#: Options of a read that a cut between lines allows.
PARSE_OPTIONS = {"sep", "quote", "escape", "trim_if_not_quoted", "allow_extra_columns", "allow_optional_columns", "on_bad_row",
                 "timestamp_ntz", "with_status"}


def _last_range(plan: DataFrame, k: int):
    """The K-th range of a plan, or None if it has no more than K."""
    order = ["path_string", "start"]
    if k <= 0:
        raise ValueError("max_ranges must be positive in a read")
    found = kth_key(plan, order, k)
    if found is None:
        return None
    return plan.where((F.col("path_string") == found[0]["path_string"]) & (F.col("start") == found[0]["start"])).first()
