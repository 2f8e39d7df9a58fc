"""Codecs told by content."""

import bz2
import gzip
import lzma
import os
import random

import pytest
import zstandard

from fileflow.sources import codecs

PACK = {"gzip": gzip.compress, "bzip2": bz2.compress, "xz": lzma.compress, "zstd": zstandard.ZstdCompressor().compress, None: lambda b: b}


@pytest.mark.parametrize("codec", list(PACK))
def test_decodes_any_member_in_pieces(codec, monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(codecs, "PIECE", 50)
    parts = [bytes(rng.choices(b"abcd\n", k=rng.randint(1, 900))) for _ in range(5)]
    data = b"".join(PACK[codec](p) for p in parts)
    assert codecs.codec_of(data[:8]) == codec
    assert b"".join(codecs.decoded(data)) == b"".join(parts)
    if codec:
        padded = b"\0\0\0\0".join(PACK[codec](p) for p in parts) + b"\0"
        assert b"".join(codecs.decoded(padded)) == b"".join(parts)
        with pytest.raises(ValueError, match="cut off"):
            list(codecs.decoded(data[:-9]))


def test_lines_end_at_three_terminators(monkeypatch):
    monkeypatch.setattr(codecs, "BATCH", 10)
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice(["a", "é", "\n", "\r", "\r\n", "bc"]) for _ in range(rng.randint(0, 30))).encode()
        cuts = sorted(rng.choices(range(len(text) + 1), k=4))
        pieces = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        assert [x for lines in codecs.lines_of(pieces) for x in lines] == text.splitlines()


def test_names_do_not_matter(spark, tmp_path):
    want = []
    for i, (codec, pack) in enumerate(PACK.items()):
        lines = [f"{codec} é {k}" for k in range(300)]
        name = ["data", "wrong.gz", "x.bz2", "part-0.txt", "noext"][i]
        os.makedirs(f"{tmp_path}/d{i}")
        with open(f"{tmp_path}/d{i}/{name}", "wb") as f:
            f.write(pack("\n".join(lines[:100]).encode() + b"\r\n") + pack("\n".join(lines[100:]).encode()))
        want += [(name, k, line) for k, line in enumerate(lines)]
    got = codecs.read_by_content(spark, str(tmp_path)).collect()
    assert sorted((r["file_path"].rsplit("/", 1)[1], r["line_no"], r["line"]) for r in got) == sorted(want)
    with open(f"{tmp_path}/d0/data", "wb") as f:
        f.write(gzip.compress(b"x" * 1000)[:-4])
    with pytest.raises(Exception, match="cut off"):
        codecs.read_by_content(spark, f"{tmp_path}/d0").collect()
