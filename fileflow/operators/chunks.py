"""Line operators over text columns (L1-L4): the table form of split reads.

A text of ``len`` bytes is cut in ``n = (len-1) div unit + 1`` raw ranges
``[len*i div n, len*(i+1) div n)``; each raw boundary moves forward to the next
line start (the line belongs to the range holding its first byte), so chunks
tile the text and concatenate back to it.  Map-only: one explode, native
expressions, no shuffle and no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fileflow.functions.text import chunk_starts, header_block, idiv, split_lines
from fileflow.operators.ranges import unit_size


def lines(df: DataFrame, text_col: str = "text", keys=("doc_id",)) -> DataFrame:
    """One row per line (terminator kept), with its 0-based number (L1)."""
    return df.select(*keys, F.posexplode(split_lines(F.col(text_col))).alias("line_no", "line"))


def text_unit(df: DataFrame, target_ranges: int, text_col: str = "text") -> Column:
    """Job-wide unit over all texts, as a scalar subquery (reads the texts once more;
    pass ``unit_bytes`` to line_chunks to avoid that pass)."""
    sized = df.select(F.octet_length(F.col(text_col)).cast("long").alias("length"))
    return unit_size(sized, target_ranges).select("unit").scalar()


def line_chunks(df: DataFrame, text_col: str = "text", keys=("doc_id",),
                target_ranges: int | None = None, unit_bytes: int | None = None,
                header_lines: int = 0) -> DataFrame:
    """Line-aligned chunks of each text (L2, L3), optionally with the header
    carried in front of every chunk after the first (L4).

    Output: keys, chunk_index, start, end (byte offsets in the text), chunk.
    Empty chunks (a long line swallowing whole ranges) are dropped.
    """
    if unit_bytes is not None:
        unit = F.lit(max(int(unit_bytes), 1)).cast("long")
    elif target_ranges:
        unit = text_unit(df, target_ranges, text_col)
    else:
        raise ValueError("give target_ranges or unit_bytes")
    t = F.col(text_col)
    base = df.select(*keys, t.cast("binary").alias("_b"),
                     F.octet_length(t).cast("long").alias("_len"),
                     *( [header_block(t, header_lines).alias("_hdr")] if header_lines > 0 else []))
    base = base.where(F.col("_len") > 0).withColumn("_n", idiv(F.col("_len") - 1, unit) + 1)
    header = F.octet_length("_hdr").cast("long") if header_lines > 0 else F.lit(0).cast("long")
    b, ln, n = F.col("_b"), F.col("_len"), F.col("_n")
    cut = base.withColumn("_at", chunk_starts(b, ln, n, header))
    at = F.col("_at")
    # the range of the line that starts at byte x is ((x + 1) * n - 1) div len
    pieces = F.transform(at, lambda x, k: F.struct(
        idiv((x + 1) * n - 1, ln).alias("i"), x.alias("start"), F.coalesce(F.get(at, k + 1), ln).alias("end")))
    # pieces as a column first: the explode of a column is generated code, which holds each text once;
    # outer, though no list is empty: Catalyst would filter by the size of a list it computes for that
    cut = cut.withColumn("_ps", pieces)
    sel = cut.select("*", F.explode_outer("_ps").alias("_p")).select(
        *keys, F.col("_p.i").alias("chunk_index"), F.col("_p.start").alias("start"), F.col("_p.end").alias("end"),
        "_b", *(["_hdr"] if header_lines > 0 else []))
    body = F.substring(F.col("_b"), (F.col("start") + 1).cast("int"),
                       (F.col("end") - F.col("start")).cast("int")).cast("string")
    if header_lines > 0:
        body = F.when(F.col("chunk_index") > 0, F.concat(F.col("_hdr"), body)).otherwise(body)
    return sel.select(*keys, "chunk_index", "start", "end", body.alias("chunk"))
