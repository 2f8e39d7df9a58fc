"""Lines of compressed files whatever their names: the codec is read off the first bytes.

gzip, bzip2, xz and zstd, of any number of members, and plain text.  A file is
one row and one task (its compressed bytes, at most 2 GB); it is decoded a
piece at a time and its lines go out in batches, so memory is bounded by the
compressed file, however far it expands.  Prefer names with suffixes where the
files are yours: Spark then streams them, and splits bzip2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: First bytes of each codec's files (fixed values of the formats).
MAGIC = {"gzip": b"\x1f\x8b", "bzip2": b"BZh", "xz": b"\xfd7zXZ\x00", "zstd": b"\x28\xb5\x2f\xfd"}
#: Compressed bytes decoded at once, and bytes of lines of a batch.
PIECE, BATCH = 1 << 16, 4 << 20


def codec_of(head: bytes) -> str | None:
    """The codec that a file's first bytes name; None for plain text."""
    return next((name for name, magic in MAGIC.items() if head.startswith(magic)), None)


def _decoder(codec: str):
    if codec == "gzip":
        import zlib

        return zlib.decompressobj(16 + zlib.MAX_WBITS)
    if codec == "bzip2":
        import bz2

        return bz2.BZ2Decompressor()
    if codec == "xz":
        import lzma

        return lzma.LZMADecompressor()
    try:
        import zstandard
    except ImportError as e:
        raise ValueError("a zstd file needs the zstandard package") from e
    return zstandard.ZstdDecompressor().decompressobj()


def decoded(data):
    """The decoded bytes of a file in pieces; members follow one another, zeros may pad them."""
    data = memoryview(data)
    codec = codec_of(bytes(data[:8]))
    if codec is None:
        for at in range(0, len(data), PIECE):
            yield bytes(data[at : at + PIECE])
        return
    at, decoder = 0, None
    while at < len(data):
        if decoder is None:
            while at < len(data) and data[at] == 0:
                at += 1
            if at == len(data):
                return
            decoder = _decoder(codec)
        piece = data[at : at + PIECE]
        out = decoder.decompress(piece)
        if out:
            yield out
        at += len(piece)
        if decoder.eof:
            at -= len(decoder.unused_data)
            decoder = None
    if decoder is not None:
        raise ValueError(f"{codec} file is cut off")


def lines_of(pieces):
    """Lists of lines, without their terminators (line feed, carriage return or both), of about ``BATCH`` bytes."""
    rest, out, size = b"", [], 0
    for piece in pieces:
        if b"\n" not in piece and b"\r" not in piece and not rest.endswith(b"\r"):
            rest += piece
            continue
        found = (rest + piece).splitlines(keepends=True)
        # a line may go on, and a line feed may follow a carriage return
        rest = b"" if found[-1].endswith(b"\n") else found.pop()
        out += [line[:-2] if line.endswith(b"\r\n") else line[:-1] for line in found]
        size += sum(map(len, found))
        if size > BATCH:
            yield out
            out, size = [], 0
    if rest:
        out.append(rest[:-1] if rest.endswith(b"\r") else rest)
    if out:
        yield out


def read_by_content(spark: SparkSession, paths, recursive: bool = True, only: DataFrame | None = None) -> DataFrame:
    """Lines of files whose codec is told by their content: file_path, line_no, line.

    ``only``: distinct file_path of the files to read, if not all.
    """
    import pyarrow as pa

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                name, no = batch.column(0)[i].as_py(), 0
                try:
                    for lines in lines_of(decoded(batch.column(1)[i].as_buffer())):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(lines)), pa.array(range(no, no + len(lines)), pa.int64()),
                             pa.array(lines, pa.binary()).cast(pa.string())], names=["file_path", "line_no", "line"])
                        no += len(lines)
                except (ValueError, OSError, EOFError) as e:
                    raise ValueError(f"{name}: {e}") from e

    paths = [paths] if isinstance(paths, str) else list(paths)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", bool(recursive)).load(paths)
    if only is not None:
        files = files.join(only.withColumnRenamed("file_path", "path"), "path", "left_semi")
    return files.select("path", "content").mapInArrow(read, "file_path string, line_no long, line string")
