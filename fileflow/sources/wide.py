"""Lines of UTF-16 and UTF-32 files in splits.

Spark cuts text at the byte 0A, which in these charsets may be half of another
character, and a line end is 0A with zeros before or behind it, at a whole code
unit.  So a file's bytes are read as pieces between 0A bytes, and pieces are put
together again up to a true line end:

1. a row a split: its bytes, and the first bytes of each file, which tell the
   byte order.  Sums over a file's splits give every piece its place, so whether
   its 0A is at a whole unit is known in every split.
2. every split puts its pieces together.  What stands before its first true line
   end and behind its last one is joined with the neighbours' (two rows a split,
   pieces of one line in order of the splits), then the lines are decoded.

Line ends are a line feed, a carriage return or both.  Defined results: a file
without a byte order mark and without an order in ``encoding`` is big-endian;
marks are no part of the text; an empty file has no lines; bytes that aren't of
the charset are an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fileflow.options import IngestOptions
from fileflow.session import written
from fileflow.sources.inventory import spelled_path
from fileflow.sources.splits import before, fixed_splits, in_fewer_tasks, no_clash, runs_of, scan

#: Byte order marks (fixed values of the charsets).
MARKS = {"utf-16": {b"\xff\xfe": "le", b"\xfe\xff": "be"}, "utf-32": {b"\xff\xfe\0\0": "le", b"\0\0\xfe\xff": "be"}}
#: Bytes of lines of a batch.
BATCH = 4 << 20


def charset(encoding: str) -> tuple[str, str | None]:
    """(utf-16 or utf-32, le or be or None for the file's own order)."""
    name = encoding.lower().replace("-", "").replace("_", "")
    kind, order = f"utf-{name[3:5]}", name[5:]
    if not name.startswith("utf") or kind not in MARKS or order not in ("", "le", "be"):
        raise ValueError(f"not UTF-16 or UTF-32: {encoding}")
    return kind, order or None


def line_cuts(data: bytes, at: int, unit: int, order: str) -> list[int]:
    """Places behind the line ends in ``data``, which begins at byte ``at`` of the file and ends behind a 0A byte.

    In little-endian bytes the zeros stand behind 0A, so a line end at the last byte is for the data that follow to tell.
    """
    import numpy as np

    raw = np.frombuffer(data, np.uint8)
    feeds = np.flatnonzero(raw == 10)
    if order == "be":
        feeds = feeds[((at + feeds) % unit == unit - 1) & (feeds >= unit - 1)]
        others = [feeds - k for k in range(1, unit)]
    else:
        feeds = feeds[((at + feeds) % unit == 0) & (feeds + unit <= len(raw))]
        others = [feeds + k for k in range(1, unit)]
    ends = feeds[np.all([raw[o] == 0 for o in others], axis=0)]
    return (ends + (1 if order == "be" else unit)).tolist()


def _heads(batches):
    """One row a split: its bytes (0A behind every piece) and its first four."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def row():
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), pa.array([size], pa.int64()),
                                           pa.array([head[:4]], pa.binary())], names=["_file", "_start", "bytes", "head"])

    now, size, head = None, 0, b""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        upto = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        for a, b in runs_of(file, start):
            split = (int(file[a]), int(start[a]))
            if split != now:
                if now is not None:
                    yield row()
                now, size, head = split, 0, b""
            size += int(upto[b - 1] - (upto[a - 1] if a else 0))
            for i in range(a, b):
                if len(head) >= 4:
                    break
                head += batch.column(2)[i].as_py() + b"\n"
    if now is not None:
        yield row()


def _joined(known, kind: str):
    """A function of batches that puts a split's pieces together: rows with their number in the split; the first and last are open."""
    import pyarrow as pa

    unit = int(kind[4:]) // 8
    names = ["_file", "_start", "_path", "own", "seq", "open", "data"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.binary()]

    def run(batches):
        now, out, size = None, [], 0

        def row(data, is_open):
            return (*now, path, order, seq, is_open, data)

        for batch in batches:
            if not batch.num_rows:
                continue
            file, start = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, b in runs_of(file, start):
                split = (int(file[a]), int(start[a]))
                if split != now:
                    if now is not None:
                        # the split's last bytes: their line end, if any, is the next split's to tell
                        out.append(row(b"".join(held) + last, True))
                    if split not in known.value:
                        raise ValueError("the splits of a scan changed between its passes; read again")
                    now, path, seq, held = split, batch.column(2)[a].as_py(), 0, []
                    at, order = known.value[split]
                    # 0A before the split, whose zeros may stand in it; it is none of its bytes
                    last = b"\n" if at and order == "le" else b""
                    begin = len(last)
                data = b"\n".join([last + batch.column(3)[a].as_py(), *batch.column(3).slice(a + 1, b - a - 1).to_pylist(), b""])
                cuts = line_cuts(data, at - len(last), unit, order)
                at, size = at + len(data) - len(last), size + len(data)
                for cut in cuts:
                    held.append(data[begin:cut])
                    out.append(row(b"".join(held) if len(held) > 1 else held[0], seq == 0))
                    seq, held, begin = seq + 1, [], cut
                # the last 0A may be the next batch's to tell
                past = len(data) - (order == "le")
                held.append(data[begin:past])
                last, begin = data[past:], 0
                if size > BATCH and out:
                    yield batch_of(out)
                    out, size = [], 0
        if now is not None:
            out.append(row(b"".join(held) + last, True))
        if out:
            yield batch_of(out)

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return run


def _decoded(kind: str, order: str | None):
    """A function of batches: bytes of lines with their line ends to text, several rows where a carriage return alone ends lines."""
    import pyarrow as pa

    unit = int(kind[4:]) // 8

    def run(batches):
        for batch in batches:
            paths, numbers, parts, values = [], [], [], []
            for path, no, own, data in zip(*(c.to_pylist() for c in batch.columns)):
                # behind a file's end the scan can't tell whether 0A stood there: half a unit didn't
                data = data[: len(data) // unit * unit]
                if no == 0 and (mark := next((m for m, o in MARKS[kind].items() if o == own and data.startswith(m)), None)):
                    data = data[len(mark):]
                if not data:
                    continue
                text = data.decode(f"{kind}-{own}")
                text = text[:-1] if text.endswith("\n") else text
                text = text[:-1] if text.endswith("\r") else text
                found = text.split("\r")
                paths += [path] * len(found)
                numbers += [no] * len(found)
                parts += range(len(found))
                values += found
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(numbers, pa.int64()), pa.array(parts, pa.int32()),
                                              pa.array(values, pa.string())], names=["_path", "feed_no", "part_no", "value"])

    return run


def read_wide_lines(spark: SparkSession, paths, encoding: str, recursive: bool = True, wanted: Column | None = None,
                    opts: IngestOptions | None = None, split_bytes: int | None = None, header_lines: int = 0) -> DataFrame:
    """Lines of UTF-16 or UTF-32 files: value, path, feed_no (line feeds before the line in its file) and part_no (carriage returns alone behind those).

    The first ``header_lines`` lines of every file are dropped.  Runs jobs when called.
    """
    kind, order = charset(encoding)
    no_clash(spark, paths, recursive, opts)
    with fixed_splits(spark, split_bytes) as size:
        raw = in_fewer_tasks(scan(spark, paths, recursive, wanted, opts, "\n"), size).withColumn("value", F.col("value").cast("binary"))
        heads = raw.select("_file", "_start", "value").mapInArrow(_heads, "_file long, _start long, bytes long, head binary")
        places = heads.select("_file", "_start", F.coalesce(F.sum("bytes").over(before()), F.lit(0)).alias("at"),
                              F.coalesce(F.first("head").over(before()), F.col("head")).alias("head"))
        # one row a split
        known = {}
        for r in places.collect():
            mark = next((o for m, o in MARKS[kind].items() if bytes(r["head"]).startswith(m)), None)
            known[r["_file"], r["_start"]] = (r["at"], order or mark or "be")
        rows = written(raw.select("_file", "_start", "_path", "value").mapInArrow(
            _joined(spark.sparkContext.broadcast(known), kind),
            "_file long, _start long, _path string, own string, seq long, open boolean, data binary"), "wide-lines", "open")
        # the last row of a split is open
        ends = rows.where("open").groupBy("_file", "_start").agg(F.max("seq").alias("n"))
        first = ends.select("_file", "_start", F.coalesce(F.sum("n").over(before()), F.lit(0)).alias("first"))
        # again one row a split
        placed = rows.join(F.broadcast(written(first, "wide-places")), ["_file", "_start"]).withColumn("no", F.col("first") + F.col("seq"))
        whole = placed.where("not open").select("_path", "no", "own", "data")
        pieces = placed.where("open").groupBy("_path", "no", "own").agg(F.array_sort(F.collect_list(F.struct("_start", "seq", "data"))).alias("p"))
        glued = pieces.select("_path", "no", "own", F.array_join(F.transform("p.data", lambda d: d.cast("string")), "").cast("binary").alias("data"))
        found = whole.unionByName(glued)

        def decoded(some):
            lines = some.mapInArrow(_decoded(kind, order), "_path string, feed_no long, part_no int, value string")
            return lines.select(spelled_path(F.col("_path")).alias("path"), "feed_no", "part_no", "value")

        n = int(header_lines)
        if not n:
            return decoded(found)
        # these lie behind less than n line feeds
        by_file = Window.partitionBy("path").orderBy("feed_no", "part_no")
        early = decoded(found.where(F.col("no") < n)).withColumn("_n", F.row_number().over(by_file)).where(F.col("_n") > n).drop("_n")
        return early.unionByName(decoded(found.where(F.col("no") >= n)))
