"""Directly addressable token files: random access, round trips, the query against the tokenizer itself."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF
from fileflow.llm import tokenfile
from fileflow.session import scratch_path, ship_package

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD_TEXTS = ["a<|endoftext|>b", "x́ Σας ΣΑΣ", " it's 'sound' don't\x1c\x0b z", "", None, "a,,b).x \"Hello,\" IT'S. A.b,C!?",
             "İstanbul ﬁ 𝔘𝔫 中文，。 é ͅ ͅ", "Å,x a.́b ʼn.S", "word " * 40_000, "y" * 20_000, "tab\tnew\nline 12345 1.5e-3"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def plain(texts):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("widths", [(8, 8, 16), (10, 6, 16), (4, 4, 4, 4, 16), (5, 7, 20), (8, 8, 8, 8), (1, 2, 3, 26), (32,)])
def test_any_id_is_read_by_its_position(widths):
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 1 << k, 400, dtype=np.uint64) for k in range(1, 33)]).astype(np.uint32)
    rng.shuffle(ids)
    file = tokenfile.TokenFile(tokenfile.encoded(ids, [4, None], np.array([9, len(ids)]), (2, 5), widths) + b"\n")
    where = rng.integers(0, len(ids), 3000)
    assert (file.at(where) == ids[where]).all() and (file.at(np.arange(len(ids))) == ids).all()
    assert (file.slice, file.seq, file.null.tolist(), file.docs.tolist()) == (2, 5, [False, True], [4, 0])
    with pytest.raises(IndexError):
        file.at([len(ids)])


def test_rank_counts_the_bits_before():
    bits = np.random.default_rng(5).random(1024) < 0.4
    bitmap = np.packbits(bits, bitorder="little").view("<u8")
    where = np.arange(1024)
    assert (tokenfile.rank(bitmap, tokenfile.ranked(bitmap), where) == np.cumsum(bits) - bits).all()


def test_damage_is_found():
    data = bytearray(tokenfile.encoded(np.arange(1000, dtype=np.uint32), [1], np.array([1000]), (0, 0)))
    data[-300] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        tokenfile.TokenFile(bytes(data))
    with pytest.raises(ValueError, match="cut off"):
        tokenfile.TokenFile(bytes(data[:-200]))
    with pytest.raises(ValueError, match="beyond 8 bits"):
        tokenfile.encoded(np.array([256], np.uint32), [1], np.array([1]), (0, 0), (8,))


def test_ids_are_the_tokenizers_own(spark):
    texts = ODD_TEXTS + [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    got, count = tokenfile.ids_of(pa.array(texts), VOCABULARY)
    want = plain(texts)
    assert count.tolist() == [len(w) for w in want]
    assert got.tolist() == [i for w in want for i in w]


def brute(spark, rows):
    """doc_id, start, n_tokens, ids_crc32 in the files' order."""
    hashes = [r[0] for r in spark.createDataFrame([(i, r[1]) for i, r in enumerate(rows)], "i int, t string")
              .orderBy("i").select(F.xxhash64("t")).collect()]
    out = []
    for (doc_id, *_), ids, h in zip(rows, plain([r[1] for r in rows]), hashes):
        data = np.array(ids + [2], "<u4").tobytes()
        out.append((doc_id, h, len(ids) + 1, zlib.crc32(data)))
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    starts = np.cumsum([0] + [r[2] for r in out])
    return [(d, int(s), n, c) for (d, _, n, c), s in zip(out, starts)]


def test_query_equals_the_tokenizer(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in tokenfile.op12_token_files(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got) == sorted(brute(spark, rows))


def odd_rows(spark):
    rows = [(i // 2, t, "s") for i, t in enumerate(ODD_TEXTS)] + [(None, "null id", "s"), (None, "null id", "s"), (7, None, None)]
    return rows, spark.createDataFrame([(d, t, s, 1, "x") for d, t, s in rows], "doc_id long, text string, source string, ids long, slice string")


def test_odd_rows_repeats_and_small_files(spark, tmp_path):
    rows, docs = odd_rows(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = tokenfile.op12_token_files(spark, str(tmp_path), VOCABULARY).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(spark, rows)))
    path = scratch_path(spark, "small-token-files")
    tokenfile.write_files(tokenfile.tokenised(docs, VOCABULARY), path, ids_per_file=50)
    documents = tokenfile.with_starts(tokenfile.read_documents(spark, path, ids=True)).collect()
    assert len({(r["file_slice"], r["file_seq"]) for r in documents}) >= 3
    assert sorted(map(str, ((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in documents))) == sorted(map(str, brute(spark, rows)))
    stream = [i for r in sorted(documents, key=lambda r: r["start"]) for i in r["ids"]]
    where = [0, 5, 5, len(stream) - 1, len(stream), -1, None, 20_000, 33_333]
    got = tokenfile.tokens_at(spark, path, spark.createDataFrame([(w, 0) for w in where], "position long, id int")).collect()
    assert sorted(map(str, ((r["position"], r["id"]) for r in got))) == sorted(
        map(str, ((w, stream[w] if w is not None and 0 <= w < len(stream) else None) for w in where)))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = tokenfile.op12_token_files(spark, str(tmp_path), VOCABULARY)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() == 0
