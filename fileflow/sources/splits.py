"""Scans whose splits carry a state from one to the next: line offsets, records with quoted line ends.

Spark cuts a file into splits of whole lines; what a line means may depend on
the lines before it, in other splits.  Such reads take two passes over the same
splits.  The first gives one small row a split (a byte total, an effect on the
quote state), and a running composition of those rows over each file's splits
gives every split the state that it starts in.  The second pass streams each
split from that state, so no file is read as one task.

Both passes must see the same splits.  Split sizes normally depend on the
number of cores; ``fixed_splits`` takes that out, so files are cut every
``split_bytes``; both passes run inside it and the
result is written to the shared folder.  A split that the first pass
did not see is an error, never a guess.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fileflow.options import IngestOptions, apply_hadoop_conf
from fileflow.session import few_listing_tasks, session_conf, written
from fileflow.sources.inventory import spelled

SPLIT_BYTES = 128 << 20
#: Bytes of small splits that share a task, where all cores have some.
TASK_BYTES = 32 << 20


@contextlib.contextmanager
def fixed_splits(spark: SparkSession, split_bytes: int | None):
    """Scope in which files are cut every ``split_bytes``, whatever the cluster: run the action inside it."""
    size = int(split_bytes or SPLIT_BYTES)
    # one wanted partition takes the number of cores out of the rule; small files share a task
    with session_conf(spark, spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes=max(size // 32, 1),
                      spark__sql__files__minPartitionNum=1):
        yield size


def scan(spark: SparkSession, paths, recursive: bool = True, wanted: Column | None = None, opts: IngestOptions | None = None,
         line_sep: str | None = None) -> DataFrame:
    """Lines (``value``) with the file's path as text and as a hash, and the split's start."""
    reader = spark.read.option("recursiveFileLookup", bool(recursive))
    if opts is not None:
        reader = apply_hadoop_conf(reader, opts)
    with few_listing_tasks(spark):
        lines = reader.text([paths] if isinstance(paths, str) else list(paths), lineSep=line_sep)
    if wanted is not None:
        lines = lines.where(wanted)
    return lines.select("value", F.col("_metadata.file_path").alias("_path"), F.xxhash64("_metadata.file_path").alias("_file"),
                        F.col("_metadata.file_block_start").alias("_start"))


def in_fewer_tasks(lines: DataFrame, split_bytes: int) -> DataFrame:
    """``lines`` of a scan with splits so small that a task each costs more than they hold: tasks of about ``TASK_BYTES``.

    The splits stay as they are and follow one another in a task.
    """
    spark, n = lines.sparkSession, lines.rdd.getNumPartitions()
    return lines.coalesce(max(min(n, max(spark.sparkContext.defaultParallelism, -(-n * split_bytes // TASK_BYTES))), 1))


def no_clash(spark: SparkSession, paths, recursive: bool, opts: IngestOptions | None) -> None:
    """Files are told apart by a hash of their path: make sure that it does."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", bool(recursive))
    if opts is not None:
        reader = apply_hadoop_conf(reader, opts)
    with few_listing_tasks(spark):
        files = reader.load([paths] if isinstance(paths, str) else list(paths)).select(F.col("_metadata.file_path").alias("p")).distinct()
    n, hashes = files.agg(F.count("p"), F.count_distinct(F.xxhash64("p"))).first()
    if n != hashes:
        raise ValueError("two files share the hash of their path; read them apart")


def runs_of(file, start):
    """(first, past) of the runs of rows of one split in a batch."""
    import numpy as np

    cuts = np.nonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1]))[0] + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(file)]))


def before():
    """The rows before the current one of a file's splits."""
    return Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)


# ------------------------------------------------------------------ byte offsets of lines

def lines_with_offsets(spark: SparkSession, paths, recursive: bool = True, wanted: Column | None = None,
                       opts: IngestOptions | None = None, split_bytes: int | None = None) -> DataFrame:
    """Every line with the place of its first byte in its file: value, path, line_start, line_bytes, line_no.

    Lines end at any of the three terminators, which ``line_bytes`` counts and
    ``value`` leaves out.  A file's last line counts one byte more where it has no
    terminator.  Offsets are of the decompressed bytes.  Runs jobs when called.
    """
    import numpy as np
    import pyarrow as pa

    no_clash(spark, paths, recursive, opts)
    with fixed_splits(spark, split_bytes) as size_:
        # cut at line feeds alone, so that the bytes of a line are known; carriage returns are cut below
        raw = in_fewer_tasks(scan(spark, paths, recursive, wanted, opts, "\n"), size_)
        some = F.contains("value", F.lit("\r"))
        sized = raw.select("value", "_path", "_file", "_start", (F.octet_length("value") + 1).cast("long").alias("bytes"),
                           F.when(some, F.regexp_count("value", F.lit(r"\r(?!\z)")) + 1).otherwise(1).cast("long").alias("lines"),
                           some.alias("returns"))
        totals = sized.groupBy("_file", "_start").agg(F.sum("bytes").alias("bytes"), F.sum("lines").alias("lines"))
        places = totals.select("_file", "_start", F.coalesce(F.sum("bytes").over(before()), F.lit(0)).alias("at"),
                               F.coalesce(F.sum("lines").over(before()), F.lit(0)).alias("no"))
        # one row a split
        known = spark.sparkContext.broadcast({(r["_file"], r["_start"]): (r["at"], r["no"]) for r in places.collect()})

        def stream(batches):
            now, at, no, path = None, 0, 0, None
            for batch in batches:
                if not batch.num_rows:
                    continue
                file, start = (batch.column(c).to_numpy() for c in ("_file", "_start"))
                size = batch.column("bytes").to_numpy().astype(np.int64)
                lines = batch.column("lines").to_numpy().astype(np.int64)
                returns = batch.column("returns").to_numpy(zero_copy_only=False)
                for a, b in runs_of(file, start):
                    split = (int(file[a]), int(start[a]))
                    if split != now:
                        if split not in known.value:
                            raise ValueError("the splits of a scan changed between its passes; read again")
                        now, (at, no), path = split, known.value[split], spelled(batch.column("_path")[a].as_py())
                    values, own = batch.column("value").slice(a, b - a), size[a:b]
                    if returns[a:b].any():
                        values, own = cut_at_returns(values, lines[a:b])
                    ends, n = np.cumsum(own), len(own)
                    yield pa.RecordBatch.from_arrays([values, pa.repeat(pa.scalar(path, pa.string()), n), pa.array(at + ends - own), pa.array(own),
                                                      pa.array(no + np.arange(n))], names=["value", "path", "line_start", "line_bytes", "line_no"])
                    at, no = at + int(ends[-1]), no + n

        return written(sized.mapInArrow(stream, "value string, path string, line_start long, line_bytes long, line_no long"), "line-offsets")


def cut_at_returns(values, lines):
    """Texts between line feeds cut behind carriage returns that no line feed follows, ``lines`` pieces each: texts without
    the line end, and bytes with it."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    # "a\rb\r" + "\n" is two lines
    pieces = pc.split_pattern(values, "\r")
    count = pc.list_value_length(pieces).to_numpy(zero_copy_only=False)
    texts = pc.list_flatten(pieces)
    behind = np.zeros(len(texts), bool)
    behind[np.cumsum(count)[count > lines] - 1] = True  # nothing stands behind the last carriage return
    last = np.cumsum(lines) - 1
    texts = texts.filter(pa.array(~behind))
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    size[last[count > lines]] += 1
    return texts, size


# ------------------------------------------------------------------ records with quoted line ends

def open_pattern(sep: str, quote: str, escape: str, blanks: bool = False) -> str:
    """Regex of texts that begin outside quotes and end inside a quoted field.

    Quotes count only where a field begins; what follows a closing quote up to the separator is taken as it is.
    """
    if len(sep) != 1 or len(quote) != 1 or len(escape or "x") != 1:
        raise ValueError("sep, quote and escape must be single characters")
    s, q = (_in_class(c) for c in (sep, quote))
    if escape == quote:
        inside, tail = f"[^{q}]*+(?:[{q}][{q}][^{q}]*+)*+", ""
    elif escape:
        e = _in_class(escape)
        inside, tail = f"[^{q}{e}]*+(?:[{e}](?s:.)[^{q}{e}]*+)*+", f"[{e}]?+"
    else:
        inside, tail = f"[^{q}]*+", ""
    lead = "[ \\t]*+" if blanks else ""
    field = f"{lead}(?:[{q}]{inside}[{q}][^{s}]*+|(?![{q}])[^{s}]*+)"
    return f"^(?:{field}[{s}])*+{lead}[{q}]{inside}{tail}\\z"


def _in_class(c: str) -> str:
    """A character inside the brackets of a regex class."""
    return "\\" + c if not c.isalnum() and ord(c) > 32 else f"\\x{{{ord(c):x}}}"


#: What a line does to the quote state: keeps it, turns it, ends outside or inside whatever it was.
KEEP, TURN, OUTSIDE, INSIDE = range(4)


def line_effect(value: Column, sep: str, quote: str, escape: str, blanks: bool = False) -> Column:
    """A line's effect on the state (0 outside quotes, 1 inside), a native expression."""
    pattern, some = open_pattern(sep, quote, escape, blanks), F.contains(value, F.lit(quote))
    # a line inside quotes reads like one that begins with a quote
    from_out = some & value.rlike(pattern)
    from_in = ~some | F.concat(F.lit(quote), value).rlike(pattern)
    return (F.when(from_out & from_in, INSIDE).when(from_out, TURN).when(from_in, KEEP).otherwise(OUTSIDE)).cast("tinyint")


def states(effects, state: int):
    """State before each line of a run that begins in ``state``, and the state behind it."""
    import numpy as np

    fixed = effects >= OUTSIDE
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(effects)), -1))
    turns = np.cumsum(effects == TURN)
    base = np.where(last >= 0, effects[last] - OUTSIDE, state)
    after = (base + turns - np.where(last >= 0, turns[last], 0)) & 1
    return np.concatenate(([state], after[:-1])), int(after[-1])


def _effects_of_splits(batches):
    """One row a split: the state behind it and the records that begin in it, from either state before it."""
    import pyarrow as pa

    def row():
        return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (*now, *ends, *begun)],
                                          names=["_file", "_start", "out_to", "in_to", "out_begun", "in_begun"])

    now, ends, begun = None, [0, 1], [0, 0]
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start, effect = (batch.column(c).to_numpy() for c in range(3))
        for a, b in runs_of(file, start):
            split = (int(file[a]), int(start[a]))
            if split != now:
                if now is not None:
                    yield row()
                now, ends, begun = split, [0, 1], [0, 0]
            for h in (0, 1):
                before_, ends[h] = states(effect[a:b], ends[h])
                begun[h] += int((before_ == 0).sum())
    if now is not None:
        yield row()


def split_states(effects: DataFrame) -> DataFrame:
    """Per split the state it starts in and the records that began before it in its file.

    The effects of splits are composed along each file: the last split that ends in one state whatever came
    before decides, and the splits behind it that turn the state.
    """
    fixed = F.col("out_to") == F.col("in_to")
    turns = F.sum(F.when(~fixed & (F.col("out_to") == 1), 1).otherwise(0))
    upto = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = effects.withColumn("_turns", turns.over(upto))
    base = F.last(F.when(fixed, F.struct("out_to", "_turns")), ignorenulls=True).over(before())
    so_far = F.coalesce(F.last("_turns").over(before()), F.lit(0))
    state = F.pmod(F.coalesce(base["out_to"], F.lit(0)) + so_far - F.coalesce(base["_turns"], F.lit(0)), F.lit(2)).cast("int")
    placed = summed.withColumn("state", state)
    begun = F.when(F.col("state") == 0, F.col("out_begun")).otherwise(F.col("in_begun"))
    return placed.select("_file", "_start", "state", F.coalesce(F.sum(begun).over(before()), F.lit(0)).alias("first"))


def read_records(spark: SparkSession, paths, sep: str = ",", quote: str = '"', escape: str = '"', header_records: int = 0,
                 recursive: bool = True, blanks: bool = False, wanted: Column | None = None, opts: IngestOptions | None = None,
                 line_sep: str | None = None, split_bytes: int | None = None, max_record_bytes: int = 256 << 20) -> DataFrame:
    """One row per record (``value``) of delimited files whose quoted fields may hold line ends, read in splits.

    The first ``header_records`` records of every file are dropped.  Line ends
    inside quotes become line feeds; with ``line_sep`` "\\n" lines end there alone and
    carriage returns inside quotes stay.  A record that crosses splits leaves a
    piece in each, put together by file and record number.  A record of over
    ``max_record_bytes`` (a quote that is never closed) is an error.  Runs jobs when called.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    no_clash(spark, paths, recursive, opts)
    with fixed_splits(spark, split_bytes):
        lines = scan(spark, paths, recursive, wanted, opts, line_sep).withColumn(
            "_effect", line_effect(F.col("value"), sep, quote, escape, blanks))
        effects = lines.select("_file", "_start", "_effect").mapInArrow(
            _effects_of_splits, "_file long, _start long, out_to long, in_to long, out_begun long, in_begun long")
        # one row a split
        known = {(r["_file"], r["_start"]): (r["state"], r["first"]) for r in split_states(written(effects, "quote-effects")).collect()}

        def joined(values, cuts):
            """Texts of runs of lines between ``cuts``, joined by line feeds."""
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values)
            return pc.binary_join(lists, "\n")

        def assemble(batches):
            now, state, number = None, 0, 0
            held, size, begun = [], 0, False  # lines of the open record, and whether it began in this split

            def out(texts, pieces=None):
                n = len(texts)
                none = pa.nulls(n, pa.int64())
                if pieces is None:
                    return pa.RecordBatch.from_arrays([texts, pa.nulls(n, pa.string()), none, none, none],
                                                      names=["value", "piece", "_file", "_no", "_start"])
                return pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), texts, *[pa.array([p], pa.int64()) for p in pieces]],
                                                  names=["value", "piece", "_file", "_no", "_start"])

            def checked(n):
                if n > max_record_bytes:
                    raise ValueError(f"a record of over {max_record_bytes} bytes; is a quote never closed?")
                return n

            def piece():
                return out(pa.array(["\n".join(held)]), (now[0], number - 1, now[1]))

            for batch in batches:
                if not batch.num_rows:
                    continue
                value = batch.column("value")
                file, start, effect = (batch.column(c).to_numpy() for c in ("_file", "_start", "_effect"))
                for a, b in runs_of(file, start):
                    split = (int(file[a]), int(start[a]))
                    if split != now:
                        if held:
                            yield piece()
                        if split not in known:
                            raise ValueError("the splits of a scan changed between its passes; read again")
                        now, (state, number), held, size, begun = split, known[split], [], 0, False
                    before_, after = states(effect[a:b], state)
                    starts = np.nonzero(before_ == 0)[0]
                    head = int(starts[0]) if len(starts) else b - a
                    if head:  # the record that is open goes on
                        more = value.slice(a, head).to_pylist()
                        held += more
                        size = checked(size + sum(map(len, more)))
                    if not len(starts):
                        state = after
                        continue
                    if held:
                        if not begun:
                            yield piece()
                        elif number - 1 >= header_records:
                            yield out(pa.array(["\n".join(held)]))
                        held, size, begun = [], 0, False
                    cuts = np.append(starts, b - a)
                    whole = len(starts) - (after == 1)
                    skip = min(max(header_records - number, 0), whole)
                    if whole > skip:
                        yield out(joined(value.slice(a, b - a), cuts[skip : whole + 1]))
                    number += len(starts)
                    if after == 1:
                        held, begun = value.slice(a + int(starts[-1]), b - a - int(starts[-1])).to_pylist(), True
                        size = checked(sum(map(len, held)))
                    state = after
            if held:
                yield piece()

        rows = written(lines.select("value", "_file", "_start", "_effect").mapInArrow(
            assemble, "value string, piece string, _file long, _no long, _start long"), "quoted-records")
    pieces = (rows.where(F.col("_file").isNotNull() & (F.col("_no") >= header_records)).groupBy("_file", "_no")
              .agg(F.array_sort(F.collect_list(F.struct("_start", "piece"))).alias("p"))
              .select(F.concat_ws("\n", F.transform("p", lambda p: p["piece"])).alias("value")))
    records = rows.where(F.col("_file").isNull()).select("value").unionByName(pieces)
    return records.select(F.regexp_replace("value", r"\r\z", "").alias("value")) if line_sep else records
