"""Gzip files of many members as many tasks.

A gzip file may be members one behind the other (joined files, blocked gzip).
One task finds in a file's compressed bytes where members may start and cuts
them there into groups; the groups are shuffled, and every group is decoded in
a task of its own.  Members end where they like, so lines go over the cuts:

1. every group is decoded once for its number of line ends, what stands before
   its first and behind its last one, and whether it ends where its last member
   ends (checksum and length right).  By induction from the first group a file
   whose groups all do is cut at true members only.
2. sums over a file's groups give the number of each group's first line, and
   the pieces at the cuts are joined to lines (two short rows a group).
3. every group is decoded again for the lines inside it.

Files cut where no member starts (a gzip stored in another one, say) are read
again, whole, by one task each, as are damaged ones, which fail there with
their name.  Files of one member or another codec are one group.

Defined results: lines end at a line feed, a carriage return or both, also
where a cut parts the two; an empty file, and a file of empty members, has no
lines; text that isn't UTF-8 is an error.  A file has at most 2 GB, compressed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fileflow.session import written
from fileflow.sources.codecs import codec_of, decoded, lines_of, read_by_content

#: Start of a member (fixed values of the format): magic, deflate, flags, time, extra flags, system.
START = re.compile(rb"\x1f\x8b\x08[\x00-\x1f].{4}[\x00\x02\x04][\x00-\x0d\xff]", re.S)
#: Compressed bytes of a group, at least, and of a task where there are many groups.
GROUP, TASK = 16 << 20, 512 << 20
ROW = "file_path string, group_no long"


def groups_of(data, group_bytes: int):
    """(from, to) of runs of members of at least ``group_bytes``; one run for other codecs."""
    at = 0
    if codec_of(bytes(data[:8])) == "gzip":
        for m in START.finditer(data):
            if m.start() - at >= group_bytes:
                yield at, m.start()
                at = m.start()
    yield at, len(data)


def ends_of(pieces):
    """(line ends, bytes before the first one, bytes behind the last, starts with a line feed, ends with a carriage return, any bytes).

    A line feed at the start isn't counted: it may be half of a line end.
    """
    count, head, rest, last, lead = 0, None, bytearray(), b"", None
    for piece in pieces:
        if not piece:
            continue
        lead, skip = (piece[:1] == b"\n", piece[:1] == b"\n") if lead is None else (lead, last == b"\r" and piece[:1] == b"\n")
        last = piece[-1:]
        lines = piece[skip:].splitlines(keepends=True)
        if not lines:
            continue
        unended = not lines[-1].endswith((b"\n", b"\r"))
        if len(lines) == unended:
            rest += lines[0]
            continue
        if head is None:
            head = bytes(rest) + (lines[0][:-2] if lines[0].endswith(b"\r\n") else lines[0][:-1])
        rest = bytearray(lines[-1] if unended else b"")
        count += len(lines) - unended
    return count, bytes(rest) if head is None else head, bytes(rest), bool(lead), last == b"\r", lead is not None


def _without_lead(pieces):
    first = True
    for piece in pieces:
        if first and piece:
            piece, first = piece.removeprefix(b"\n"), False
        yield piece


def _groups(spark: SparkSession, paths, recursive: bool, group_bytes: int, partitions: int | None) -> DataFrame:
    """file_path, group_no and the compressed bytes of each group, dealt over tasks."""
    import pyarrow as pa

    def cut(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(1)[i].as_buffer()
                for no, (a, b) in enumerate(groups_of(memoryview(data), group_bytes)):
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1).cast(pa.string()), pa.array([no], pa.int64()),
                                                      pa.array([data[a:b].to_pybytes()], pa.binary())], names=["file_path", "group_no", "data"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", bool(recursive)).load(paths)
    if partitions is None:
        total = files.agg(F.sum("length")).first()[0] or 0
        partitions = max(1, min(-(-total // group_bytes), max(4 * spark.sparkContext.defaultParallelism, -(-total // TASK))))
    return files.select("path", "content").mapInArrow(cut, f"{ROW}, data binary").repartition(partitions, "file_path", "group_no")


def _summary(groups: DataFrame) -> DataFrame:
    """For each group what ``ends_of`` says and whether its members are whole."""
    import pyarrow as pa

    schema = f"{ROW}, ends long, head binary, tail binary, lead boolean, cr boolean, bytes boolean, whole boolean"

    def summarise(batches):
        import zlib

        names = [c.split()[0] for c in schema.split(", ")]
        types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.bool_()] * 4]
        for batch in batches:
            for i in range(batch.num_rows):
                try:
                    row = (*ends_of(decoded(batch.column(2)[i].as_buffer())), True)
                except (ValueError, OSError, EOFError, zlib.error):
                    row = (0, b"", b"", False, False, False, False)
                row = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), *row)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    return groups.mapInArrow(summarise, schema)


def _placed(summary: DataFrame) -> DataFrame:
    """The summary of whole files' groups with ``first``, the number of the group's first line, and the file's line ends."""
    file, order = Window.partitionBy("file_path"), Window.partitionBy("file_path").orderBy("group_no")
    before = F.last(F.when(F.col("bytes"), F.col("cr")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = summary.withColumn("sound", F.min("whole").over(file)).where("sound").drop("sound")
    rows = rows.withColumn("extra", (F.col("lead") & ~F.coalesce(before, F.lit(False))).cast("long"))
    total = F.col("ends") + F.col("extra")
    return rows.withColumn("first", F.sum(total).over(order) - F.col("ends")).withColumn("in_file", F.sum(total).over(file))


def _at_cuts(placed: DataFrame) -> DataFrame:
    """Lines that touch a group's start or end: the pieces of a line in order of their groups."""
    def piece(keep, line_no, text):
        return F.when(keep, F.struct(line_no.alias("line_no"), text.cast("string").alias("text")))

    ends = F.col("ends")
    pieces = F.array(piece(F.col("extra") == 1, F.col("first") - 1, F.lit(b"")), piece(F.lit(True), F.col("first"), F.col("head")),
                     piece(ends > 0, F.col("first") + ends, F.col("tail")))
    rows = (placed.select("file_path", "in_file", "group_no", F.explode(F.filter(pieces, lambda p: p.isNotNull())).alias("p"))
                  .groupBy("file_path", "in_file", "p.line_no")
                  .agg(F.array_sort(F.collect_list(F.struct("group_no", "p.text"))).alias("parts")))
    rows = rows.withColumn("line", F.array_join(F.col("parts.text"), ""))
    # what stands behind the last line end is a line unless nothing does
    return rows.where("line_no < in_file or line <> ''").select("file_path", "line_no", F.validate_utf8("line").alias("line"))


def _inside(groups: DataFrame) -> DataFrame:
    """The lines between a group's first and last line end."""
    import pyarrow as pa

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                name, first, ends = (batch.column(k)[i].as_py() for k in (0, 2, 3))
                if ends < 2:
                    continue
                no = 0
                for lines in lines_of(_without_lead(decoded(batch.column(1)[i].as_buffer()))):
                    a, b = max(1 - no, 0), max(min(ends - no, len(lines)), 0)
                    if a < b:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * (b - a)), pa.array(range(first + no + a, first + no + b), pa.int64()),
                             pa.array(lines[a:b], pa.binary()).cast(pa.string())], names=["file_path", "line_no", "line"])
                    no += len(lines)
                if no < ends:
                    raise ValueError(f"{name}: changed while it was read")

    return groups.mapInArrow(read, "file_path string, line_no long, line string")


def read_gzip_members(spark: SparkSession, paths, recursive: bool = True, group_bytes: int = GROUP, partitions: int | None = None) -> DataFrame:
    """Lines of files, gzip files of many members in many tasks: file_path, line_no, line.

    ``group_bytes``: a group's compressed bytes, at least.  ``partitions``: tasks; by default a group each, up to
    four a core or ``TASK`` bytes each.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    groups = _groups(spark, paths, recursive, group_bytes, partitions)
    summary = written(_summary(groups), "gzip-members")
    placed = written(_placed(summary), "gzip-members-placed")
    # where the placed rows are few Spark broadcasts them; the groups stay where they are otherwise, too
    inside = _inside(groups.join(placed.select("file_path", "group_no", "first", "ends"), ["file_path", "group_no"])
                           .select("file_path", "data", "first", "ends"))
    lines = inside.unionByName(_at_cuts(placed))
    unsound = summary.where("not whole").select("file_path").distinct()
    if unsound.isEmpty():
        return lines
    return lines.unionByName(read_by_content(spark, paths, recursive, only=unsound))
