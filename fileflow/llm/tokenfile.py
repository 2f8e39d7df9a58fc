"""Token ids on disk as directly addressable codes: any token is read without decoding the ones before it.

An id is split into chunks of ``WIDTHS`` bits, lowest first.  Level k holds
chunk k of every id that has one, bit-packed, and a continuation bitmap that
says which of them go on at level k + 1.  A rank directory over the bitmap (a
running count every ``RANK_BITS`` bits) gives the place of an id's next chunk,
so an id costs one look at each of its levels.

A file holds whole documents in ascending doc_id order (null first, then equal
ids by a hash of their text): a header, per document its doc_id and the
end of its ids, then per level the chunks, the bitmap and the directory, and a
crc32 of it all.  A file is closed at ``ids_per_file`` ids, so a writer holds
that many and one document; a file's place in the order (slice, sequence) is
in its header, and the first global position of each file is a prefix sum over
one small row a file.

Tokenising is map-only.  The vocabulary lower-cases and cuts at white space and
between letters and marks, and no rule of it looks across such a cut.  So a
batch's distinct words are encoded once by the tokenizers library and put
together again; texts with ``<|`` (special tokens) are encoded as they are.  Ranges of documents are known before (a range
partitioning of the keys alone; rows count too, so a doc_id that repeats is no
hot key).  Ids are shuffled once, 16 bits each where they fit, to their range,
whose task writes its files.

Defined results: a null text is empty; every document ends with ``END``, so an
empty one has one id; rows that repeat are documents of their own; an empty
table gives no file and no row.
"""

from __future__ import annotations

import bisect
import functools
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.llm.common import saved, table
from fileflow.operators.ordered import first_target_at_or_above, indexed_running_sums
from fileflow.session import scratch_path

#: Bits of each chunk, lowest first; together 32 or more.  Frequent pieces of a public vocabulary have low ids.
WIDTHS = (10, 6, 16)
RANK_BITS = 256
END = 2
MAGIC = b"DACTOK1\0"
#: Words whose ids a worker keeps between batches; beyond that it starts anew.
CACHED_WORDS = 1_000_000


# ------------------------------------------------------------------ the code of one file

def packed(values: np.ndarray, width: int) -> bytes:
    """``values`` in ``width`` bits each, lowest bit first, with 8 bytes to spare behind."""
    if width in (8, 16, 32):
        return values.astype(f"<u{width // 8}").tobytes() + bytes(8)
    out, step = [], 1 << 16
    shifts = np.arange(width, dtype=np.uint32)
    for at in range(0, len(values), step):
        bits = (values[at : at + step, None].astype(np.uint32) >> shifts) & 1
        out.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(out) + bytes(8)


def unpacked(data: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    """Values at the places ``at`` of a packed array."""
    if width in (8, 16, 32):
        size = width // 8
        return data[: len(data) // size * size].view(f"<u{size}")[at].astype(np.uint32)
    bit = at * width
    first, got = bit >> 3, np.zeros(len(at), np.uint64)
    for k in range((width + 14) // 8):
        got |= data[first + k].astype(np.uint64) << np.uint64(8 * k)
    return ((got >> (bit & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.uint32)


def ranked(bitmap: np.ndarray) -> np.ndarray:
    """Set bits before every ``RANK_BITS`` bits of a bitmap of 64-bit words."""
    per = np.bitwise_count(bitmap.reshape(-1, RANK_BITS // 64)).sum(axis=1, dtype=np.uint64)
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(per)))[:-1].astype("<u4")


def encoded(ids: np.ndarray, docs, ends: np.ndarray, place: tuple[int, int], widths=WIDTHS) -> bytes:
    """The bytes of a file: ``ids`` of the documents ``docs`` (None: no id), which end at ``ends``."""
    rest, sections, levels = ids.astype(np.uint32), [], []
    for width in widths:
        more = (rest >> np.uint32(width)) > 0 if width < 32 else np.zeros(len(rest), bool)
        bits = np.zeros(-(-max(len(rest), 1) // RANK_BITS) * RANK_BITS, bool)
        bits[: len(rest)] = more
        bitmap = np.packbits(bits, bitorder="little").view("<u8")
        levels.append((width, len(rest)))
        sections += [packed(rest & np.uint32((1 << width) - 1), width), bitmap.tobytes(), ranked(bitmap).tobytes()]
        rest = rest[more] >> np.uint32(width) if width < 32 else rest[:0]
    if len(rest):
        raise ValueError(f"ids beyond {sum(widths)} bits")
    head = MAGIC + struct.pack("<IIQQI", *place, len(ids), len(docs), len(levels))
    head += b"".join(struct.pack("<IQ", *level) for level in levels)
    sections = [np.array([d is None for d in docs], np.uint8).tobytes(), np.array([d or 0 for d in docs], "<i8").tobytes(),
                ends.astype("<u8").tobytes()] + sections
    parts = [head, struct.pack(f"<{len(sections)}Q", *map(len, sections)), *sections]
    crc = 0
    for p in parts:
        crc = zlib.crc32(p, crc)
    return b"".join([*parts, struct.pack("<I", crc)])


class TokenFile:
    """A file as a random-access array: ``at`` gives ids by position; ``docs`` and ``ends`` tell whose they are."""

    def __init__(self, data, check: bool = True):
        view = memoryview(data)
        if bytes(view[:8]) != MAGIC:
            raise ValueError("not a token file")
        self.slice, self.seq, self.n_ids, n_docs, n_levels = struct.unpack_from("<IIQQI", view, 8)
        at = 8 + struct.calcsize("<IIQQI")
        levels = [struct.unpack_from("<IQ", view, at + 12 * k) for k in range(n_levels)]
        at += 12 * n_levels
        sizes = struct.unpack_from(f"<{3 + 3 * n_levels}Q", view, at)
        at += 8 * len(sizes)
        if len(view) < at + sum(sizes) + 4:
            raise ValueError("token file is cut off")
        raw = []
        for n in sizes:
            raw.append(np.frombuffer(view[at : at + n], np.uint8))
            at += n
        if check and zlib.crc32(view[:at]) != struct.unpack_from("<I", view, at)[0]:
            raise ValueError("token file is damaged")
        self.null = raw[0].astype(bool)
        self.docs, self.ends = np.frombuffer(raw[1], "<i8"), np.frombuffer(raw[2], "<u8").astype(np.int64)
        self.levels = [(w, raw[3 + 3 * k], np.frombuffer(raw[4 + 3 * k], "<u8"), np.frombuffer(raw[5 + 3 * k], "<u4"))
                       for k, (w, _) in enumerate(levels)]

    def at(self, positions) -> np.ndarray:
        """The ids at ``positions``, in any order."""
        where = np.asarray(positions, np.int64)
        if len(where) and (where.min() < 0 or where.max() >= self.n_ids):
            raise IndexError("position outside the file")
        out, live, shift = np.zeros(len(where), np.uint32), np.arange(len(where)), 0
        for width, data, bitmap, directory in self.levels:
            out[live] |= unpacked(data, width, where) << np.uint32(shift)
            word = bitmap[where >> 6]
            go = ((word >> (where & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
            live, where, shift = live[go], rank(bitmap, directory, where[go]), shift + width
            if not len(live):
                break
        return out


def rank(bitmap: np.ndarray, directory: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Set bits before each of the places ``where``."""
    block, word = where // RANK_BITS, where >> 6
    got = directory[block].astype(np.int64)
    first = block * (RANK_BITS // 64)
    for k in range(RANK_BITS // 64 - 1):
        whole = first + k < word
        got += np.where(whole, np.bitwise_count(bitmap[np.where(whole, first + k, 0)]), 0)
    below = (np.uint64(1) << (where & 63).astype(np.uint64)) - np.uint64(1)
    return got + np.bitwise_count(bitmap[word] & below)


# ------------------------------------------------------------------ tokens

class Words:
    """Ids of the words met so far, one after another, as a tokenizer encodes each by itself."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self):
        self.place, self.ends, self.ids = {}, np.zeros(1, np.int64), np.zeros(0, "<u4")

    def places(self, words: list) -> np.ndarray:
        """The place of every word, new ones encoded first: lists of them, as texts."""
        if len(self.place) > CACHED_WORDS:
            self.clear()
        new = [w for w in words if w not in self.place]
        lists = [new[at : at + 1000] for at in range(0, len(new), 1000)]
        ends, ids, base = [self.ends], [self.ids], len(self.ids)
        for part, coded in zip(lists, self.tokenizer.encode_batch([" ".join(p) for p in lists], add_special_tokens=False)):
            # a token belongs to the word that its first character is in
            begins = np.cumsum([0] + [len(w) + 1 for w in part])
            firsts = np.fromiter((a for a, _ in coded.offsets), np.int64, len(coded.ids))
            ends.append(base + np.searchsorted(firsts, begins[1:]))
            ids.append(np.array(coded.ids, "<u4"))
            base += len(coded.ids)
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.ends, self.ids = np.concatenate(ends), np.concatenate(ids)
        return np.fromiter((self.place[w] for w in words), np.int64, len(words))


_words = functools.lru_cache(maxsize=2)(Words)


def ids_of(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and each text's number of ids; without end ids."""
    known = _words(path)
    special = pc.fill_null(pc.match_substring(texts, "<|"), False)
    plain = pc.ascii_lower(pc.if_else(special, "", pc.fill_null(texts, "")))
    # a letter and a mark behind it are never one piece
    words = pc.ascii_split_whitespace(pc.replace_substring_regex(plain, r"([a-z])([,.;:!?])", r"\1 \2"))
    offsets = np.asarray(words.offsets)
    coded = words.flatten().dictionary_encode()
    which = known.places(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
    starts, n = known.ends[which], np.diff(known.ends)[which]
    ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(n)))
    got = known.ids[np.repeat(starts - ends[:-1], n) + np.arange(ends[-1])]
    count = np.diff(ends[offsets - offsets[0]])
    if pc.any(special).as_py():
        cuts = np.cumsum(count) - count
        pieces = np.split(got, cuts[1:])
        for i in np.nonzero(np.asarray(special))[0]:
            pieces[i] = np.array(known.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids, "<u4")
        got, count = np.concatenate(pieces), np.array([len(p) for p in pieces], np.int64)
    return got.astype("<u4"), count


def _by_bytes(batch: pa.RecordBatch, column: int, most: int = 8 << 20):
    """The batch in slices of about ``most`` bytes of a text column, or a row."""
    total = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64))
    at = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def _bytes_of(ids: np.ndarray) -> bytes:
    """Ids on their way to a file: 16 bits each where they fit, 32 where not, behind a byte that says which."""
    return b"\x02" + ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 1 << 16 else b"\x04" + ids.tobytes()


def _ids_from(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1)


ORDER = ("doc_id", "_hash", "_row")


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("_hash"),
                       F.monotonically_increasing_id().alias("_row"), F.col(text).cast("string").alias("_text"))


def _bounds(keyed: DataFrame, slices: int) -> list[tuple]:
    """First keys of at most ``slices`` balanced ranges of the order: one row a range."""
    order = [F.col(c).asc_nulls_first() for c in ORDER]
    parted = keyed.select(*ORDER).repartitionByRange(slices, *order)
    firsts = parted.groupBy(F.spark_partition_id().alias("_pid")).agg(F.min(F.struct(F.col("doc_id").isNotNull(), *ORDER)).alias("_first"))
    return sorted(_key(*r["_first"][1:]) for r in firsts.collect())


def _key(doc_id, hash_, row):
    return (doc_id is not None, doc_id or 0, hash_, row)


def tokenised(docs: DataFrame, vocabulary: str, text: str = "text", end: int | None = END, slices: int | None = None) -> DataFrame:
    """doc_id, the order's other keys, ``slice`` and ``ids`` (as bytes) of every row; map-only but for the slices' bounds.

    ``vocabulary`` is a path that the executors can read.  ``slices`` is the
    number of ranges, by default the session's number of shuffle partitions.
    """
    keyed = _keyed(docs, text)
    bounds = _bounds(keyed, slices or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tail = np.array([] if end is None else [end], "<u4")

    def encode(batches):
        for batch in batches:
            for part in _by_bytes(batch, 3):
                ids, count = ids_of(part.column(3), vocabulary)
                ends = np.cumsum(count)
                each = [_bytes_of(np.concatenate((ids[e - n : e], tail))) for e, n in zip(ends.tolist(), count.tolist())]
                keys = [part.column(i).to_pylist() for i in range(3)]
                place = [max(bisect.bisect_right(bounds, _key(*k)) - 1, 0) for k in zip(*keys)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(place, pa.int32()), pa.array(each, pa.binary())],
                                                 names=[*ORDER, "slice", "ids"])

    return keyed.mapInArrow(encode, "doc_id long, _hash long, _row long, slice int, ids binary")


# ------------------------------------------------------------------ files

def write_files(tokens: DataFrame, path: str, ids_per_file: int = 4_000_000, widths=WIDTHS) -> None:
    """Write the rows of ``tokenised`` to files in the folder ``path``, in ascending doc_id order: one shuffle, by slice."""
    def files(batches):
        at, seq, docs, ids, held = None, 0, [], [], 0

        def file():
            ends = np.cumsum([len(i) for i in ids])
            return pa.RecordBatch.from_arrays(
                [pa.array([encoded(np.concatenate(ids), docs, ends, (at, seq), widths)], pa.binary())], names=["file"])

        for batch in batches:
            for i in range(batch.num_rows):
                place = batch.column(1)[i].as_py()
                if docs and (place != at or held >= ids_per_file):
                    yield file()
                    docs, ids, held, seq = [], [], 0, seq + 1
                if place != at:
                    at, seq = place, 0
                docs.append(batch.column(0)[i].as_py())
                ids.append(_ids_from(batch.column(2)[i].as_py()))
                held += len(ids[-1])
        if docs:
            yield file()

    slices = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["slice", *[F.col(c).asc_nulls_first() for c in ORDER]]
    # the writer puts down the bytes of a string as they are; one row is one file
    (tokens.repartitionById(slices, F.col("slice") % slices).sortWithinPartitions(*order).select("doc_id", "slice", "ids")
     .mapInArrow(files, "file binary").select(F.col("file").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("compression", "none").text(path))


def _per_file(spark: SparkSession, path: str, rows_of, schema: str) -> DataFrame:
    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield from rows_of(batch.column(0)[i].as_py(), batch.column(1)[i].as_buffer())

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, schema)


def read_documents(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """A row per document of the files: doc_id, file_slice, file_seq, at (its place in the file), n_tokens, ids_crc32.

    With ``ids`` the ids as an array too.  Every id is read through ``TokenFile.at``.
    """
    def rows_of(_, data):
        f, done = TokenFile(data), 0
        while done < len(f.ends):
            start = int(f.ends[done - 1]) if done else 0
            upto = max(done + 1, int(np.searchsorted(f.ends, start + (1 << 20), "right")))
            ends = f.ends[done:upto]
            got = f.at(np.arange(start, ends[-1])).astype("<u4")
            raw, begins = got.tobytes(), np.concatenate(([start], ends[:-1]))
            cols = [pa.array(f.docs[done:upto], pa.int64(), mask=f.null[done:upto]), pa.array([f.slice] * len(ends), pa.int32()),
                    pa.array([f.seq] * len(ends), pa.int32()), pa.array(begins, pa.int64()), pa.array(ends - begins, pa.int64()),
                    pa.array([zlib.crc32(raw[4 * (a - start) : 4 * (b - start)]) for a, b in zip(begins.tolist(), ends.tolist())], pa.int64())]
            names = ["doc_id", "file_slice", "file_seq", "at", "n_tokens", "ids_crc32"]
            if ids:
                cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate((begins, ends[-1:])) - start, pa.int32()), pa.array(got.astype(np.int64))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)
            done = upto

    schema = "doc_id long, file_slice int, file_seq int, at long, n_tokens long, ids_crc32 long"
    return _per_file(spark, path, rows_of, schema + (", ids array<long>" if ids else ""))


def catalogue_of(documents: DataFrame) -> DataFrame:
    """One row a file of ``read_documents``: its place, first global position and number of ids."""
    n = documents.groupBy("file_slice", "file_seq").agg(F.sum("n_tokens").alias("n_ids"))
    return indexed_running_sums(n, [], ["file_slice", "file_seq"], {"first": "n_ids"}).select(
        "file_slice", "file_seq", "first", "n_ids")


def with_starts(documents: DataFrame) -> DataFrame:
    """``documents`` with ``start``, the ids of all documents before each."""
    files = catalogue_of(documents)
    return (documents.join(files.select("file_slice", "file_seq", "first"), ["file_slice", "file_seq"])
            .withColumn("start", F.col("first") + F.col("at")).drop("first"))


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """The ids at global positions (column ``position``): position, id (null outside the files).

    An as-of search finds each position's file; files meet their positions in
    lists of at most 65,536, and only those chunks are read.
    """
    files = saved(catalogue_of(read_documents(spark, path)), "token-files")
    known = saved(positions.select(F.col("position").cast("long").alias("position")).distinct(), "token-positions")
    last = files.select((F.col("first") + F.col("n_ids") - 1).alias("value"), "first")
    found = first_target_at_or_above(known.select("position", F.col("position").alias("value")), last, [], "position", "first")
    wanted = (found.where("first is not null and position >= 0").join(files, "first")
              .groupBy("file_slice", "file_seq", "first", F.expr("(position - first) div 65536").alias("_part"))
              .agg(F.collect_list("position").alias("positions")))

    def places(name, data):
        f = TokenFile(data)
        yield pa.RecordBatch.from_arrays([pa.array([f.slice], pa.int32()), pa.array([f.seq], pa.int32()), pa.array([name])],
                                         names=["file_slice", "file_seq", "path"])

    def look(batches):
        for batch in batches:
            for r in batch.to_pylist():
                at = np.array(r["positions"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(TokenFile(r["content"], check=False).at(at - r["first"]).astype(np.int64))],
                                                 names=["position", "id"])

    named = wanted.join(_per_file(spark, path, places, "file_slice int, file_seq int, path string"), ["file_slice", "file_seq"])
    content = spark.read.format("binaryFile").load(path).select("path", "content")
    got = named.join(content, "path").select("first", "positions", "content").mapInArrow(look, "position long, id long")
    return positions.select(F.col("position").cast("long").alias("position")).join(got, "position", "left")


def op12_token_files(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Encode all ``documents``, write the files, read them back: doc_id, start, n_tokens, ids_crc32."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    path = scratch_path(spark, "token-files")
    write_files(tokenised(table(spark, sf_dir, "documents"), vocabulary), path)
    if not spark.read.format("binaryFile").load(path).select("path").head(1):
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    documents = saved(read_documents(spark, path), "token-documents")
    return with_starts(documents).select("doc_id", "start", "n_tokens", "ids_crc32")
