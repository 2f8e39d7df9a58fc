"""Line expressions over text columns.

Lines end with any of the three terminators ``\\r\\n``, ``\\r``, ``\\n``; a final
line without terminator is still a line.  Offsets are *bytes* of the UTF-8
text, as in file ranges: ``octet_length``, never ``length``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One line = content plus its terminator (\r\n, \r or \n), or a
# final unterminated run.
LINE_PATTERN = r"[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+"
# First N terminated lines; {0,N} so that a \r\n is never counted as two lines.
HEADER_PATTERN = r"^(?:[^\r\n]*(?:\r\n|\r|\n)){0,%d}"

def idiv(a, b) -> Column:
    """Exact integral division of longs (SQL ``div``)."""
    return F.call_function("div", a, b)


def split_lines(text: Column) -> Column:
    """array<string> of the lines of ``text``, terminators kept."""
    return F.regexp_extract_all(text, F.lit(LINE_PATTERN), 0)


def header_block(text: Column, n: int) -> Column:
    """The first ``n`` terminated lines of ``text`` (fewer if it has fewer)."""
    return F.regexp_extract(text, HEADER_PATTERN % int(n), 0)


def _past_terminator(s: Column) -> Column:
    """Bytes of ``s`` up to and including its first terminator; its length + 1 without one."""
    a = F.octet_length(F.substring_index(s, "\n", 1))
    c = F.octet_length(F.substring_index(s, "\r", 1))
    return F.when(c + 1 < a, c + 1).otherwise(a + 1)


def chunk_starts(data: Column, size: Column, n: Column, header: Column) -> Column:
    """array<long>: where the line-aligned chunks of a text start (0-based byte offsets).

    The text's ``size`` bytes are cut in ``n`` raw ranges, and a line belongs to
    the range holding its first byte, so a chunk starts at the first line start
    inside its range; a range without one has no chunk.  Each range looks only
    at its own bytes and the one before them (where a terminator may stand), so
    the work is linear in the text however long its lines are.  Behind the
    first chunk, no chunk starts inside the first ``header`` bytes.
    """
    ranges = F.transform(
        F.sequence(F.lit(1).cast("long"), n - 1),
        lambda i: F.struct(idiv(size * i, n).alias("lo"), idiv(size * (i + 1), n).alias("hi")))
    # the text as a lambda variable: read from its row once, not once per range
    windows = F.flatten(F.transform(F.array(data), lambda text: F.transform(ranges, lambda r: F.struct(
        r["lo"].alias("lo"), r["hi"].alias("hi"),
        F.substring(text, r["lo"].cast("int"), (r["hi"] - r["lo"] + 1).cast("int")).cast("string").alias("win")))))
    found = F.transform(windows, lambda w: F.struct(
        w["lo"].alias("lo"), w["hi"].alias("hi"), (w["lo"] - 1 + _past_terminator(w["win"])).alias("at")))
    starts = F.transform(found, lambda f: F.when(
        f["hi"] > header, F.when(f["lo"] <= header, header).when(f["at"] < f["hi"], f["at"])))
    first = F.array(F.lit(0).cast("long"))
    return F.when(n > 1, F.concat(first, F.array_compact(starts))).otherwise(first)
