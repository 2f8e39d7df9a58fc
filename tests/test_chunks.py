import random
import time

from pyspark.sql import functions as F

from brute import chunks as brute_chunks
from brute import lines as brute_lines
from fileflow.operators.chunks import line_chunks, lines

PIECES = ["a", "bc", "é", "€", "𝄞", " ", "\n", "\r", "\r\n", "xyz" * 5]


def random_texts(seed, count=60):
    rnd = random.Random(seed)
    out = []
    for i in range(count):
        k = rnd.randint(0, 60)
        out.append((i, "".join(rnd.choice(PIECES) for _ in range(k))))
    # fixture edge cases
    out += [(1000, "a\nb\rc\r\nd\n\ne"), (1001, "h1\nh2\n" + "r\n" * 9), (1002, "h1\n"),
            (1003, "a\r\nb"), (1004, "x" * 1024 + "\nshort\n"), (1005, "\r\n\r\n\r"),
            (1006, "é€𝄞\n" * 7)]
    return out


def _check(spark, texts, unit, header=0):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted(tuple(r) for r in line_chunks(df, unit_bytes=unit, header_lines=header).collect())
    want = sorted((d, *c) for d, t in texts for c in brute_chunks(t.encode(), unit, header))
    assert got == want


def test_chunks_match_byte_reader(spark):
    texts = random_texts(1)
    for unit in (1, 2, 3, 7, 40, 10_000):
        _check(spark, texts, unit)


def test_header_carry(spark):
    texts = random_texts(2)
    for header in (1, 2, 3):
        for unit in (2, 5, 33):
            _check(spark, texts, unit, header)


def test_chunks_concatenate_to_text(spark):
    texts = random_texts(3)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    ch = line_chunks(df, unit_bytes=4)
    joined = (ch.groupBy("doc_id")
                .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "chunk"))),
                                              lambda x: x["chunk"]), "").alias("t")))
    got = {r.doc_id: r.t for r in joined.collect()}
    for d, t in texts:
        if t:
            assert got[d] == t


def test_lines_longer_than_ranges(spark):
    text = "y" * 70_000 + "\r" + "z" * 10 + "\n" + "w"
    _check(spark, [(1, text)], 1000)
    # a carriage return and its line feed on both sides of a raw boundary
    _check(spark, [(i, "a" * i + "\r\nbb\r\n\r" + "c" * 3) for i in range(9)], 3)


def test_one_huge_line_takes_linear_time(spark):
    df = spark.createDataFrame([(1, "x" * 800_000)], "doc_id long, text string")
    line_chunks(df, unit_bytes=100).count()
    began = time.perf_counter()
    got = line_chunks(df, unit_bytes=100).selectExpr("chunk_index", "start", "end", "length(chunk)").collect()
    assert [tuple(r) for r in got] == [(0, 0, 800_000, 800_000)]
    assert time.perf_counter() - began < 10


def test_split_lines(spark):
    texts = random_texts(4)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted((r.doc_id, r.line_no, r.line) for r in lines(df).collect())
    want = sorted((d, i, ln.decode()) for d, t in texts for i, ln in enumerate(brute_lines(t.encode())))
    assert got == want


def test_target_ranges_unit(spark):
    texts = random_texts(5)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    total = sum(len(t.encode()) for _, t in texts)
    target = 50
    unit = max(total // target, 1)
    got = sorted(tuple(r) for r in line_chunks(df, target_ranges=target).collect())
    want = sorted((d, *c) for d, t in texts for c in brute_chunks(t.encode(), unit))
    assert got == want
