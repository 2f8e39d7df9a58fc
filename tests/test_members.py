"""Gzip files of many members."""

import bz2
import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from fileflow.sources import members


def texts(rng, n):
    return "".join(rng.choice(["a", "é", "\n", "\r", "\r\n", "bc", ""]) for _ in range(n)).encode()


def test_ends_of_any_pieces():
    rng = random.Random(1)
    for _ in range(2000):
        text = texts(rng, rng.randint(0, 12))
        cuts = sorted(rng.choices(range(len(text) + 1), k=3))
        ends, head, tail, lead, cr, some = members.ends_of(text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)]))
        body = text[1:] if text[:1] == b"\n" else text
        lines = body.splitlines(keepends=True) + ([b""] if not body or body[-1:] in b"\r\n" else [])
        assert ends == len(lines) - 1 and head == lines[0].rstrip(b"\r\n") and tail == lines[-1]
        assert (lead, cr, some) == (text[:1] == b"\n", text[-1:] == b"\r", bool(text))


def test_groups_start_at_members():
    parts = [gzip.compress(bytes([i]) * 500) for i in range(9)]
    data = b"".join(parts)
    spans = list(members.groups_of(memoryview(data), 2 * len(parts[0])))
    assert len(spans) > 3 and spans[0][0] == 0 and spans[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert all(b"".join(members.decoded(data[a:b])) for a, b in spans)
    assert list(members.groups_of(memoryview(data), len(data))) == [(0, len(data))]
    assert list(members.groups_of(memoryview(bz2.compress(data)), 1)) == [(0, len(bz2.compress(data)))]


def test_lines_over_cuts(spark, tmp_path):
    """Members of no, one or some bytes, cut inside line ends and characters; other codecs."""
    rng, want = random.Random(2), []

    def add(name, data, text):
        with open(f"{tmp_path}/{name}", "wb") as f:
            f.write(data)
        want.extend((name, i, line) for i, line in enumerate(text.decode().replace("\r\n", "\n").replace("\r", "\n").split("\n")))
        if not want[-1][2]:
            want.pop()

    for k in range(12):
        text = texts(rng, 150)
        cuts = sorted(rng.choices(range(len(text) + 1), k=40))
        pieces = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        add(f"f{k}.gz" if k % 2 else f"f{k}", b"\0\0".join(gzip.compress(p) for p in pieces), text)
    add("empty", b"", b"")
    add("none", gzip.compress(b"") * 5, b"")
    add("plain", b"x\r\ny", b"x\r\ny")
    add("bz", bz2.compress(b"x\ny\n"), b"x\ny\n")
    got = members.read_gzip_members(spark, str(tmp_path), group_bytes=1, partitions=5)
    assert sorted((r["file_path"].rsplit("/", 1)[1], r["line_no"], r["line"]) for r in got.collect()) == sorted(want)


def test_false_starts_go_by_one_task_and_damage_is_an_error(spark, tmp_path):
    """Start bytes inside a member; a file cut off."""
    os.makedirs(f"{tmp_path}/a")
    whole = gzip.compress(b"one\ntwo\n") * 3
    with open(f"{tmp_path}/a/stored", "wb") as f:
        # the start bytes stand in the member's name, where any may
        named = bytearray(gzip.compress(b"x\ny\n"))
        named[3] |= 8
        f.write(bytes(named[:10]) + b"\x1f\x8b\x08\x01\x01\x01\x01\x01\x02\x03\0" + bytes(named[10:]) + whole)
    got = members.read_gzip_members(spark, f"{tmp_path}/a", group_bytes=1, partitions=3)
    lines = {}
    for r in sorted(got.collect(), key=lambda r: (r["file_path"], r["line_no"])):
        lines.setdefault(r["file_path"].rsplit("/", 1)[1], []).append(r["line"])
    assert lines["stored"] == ["x", "y"] + ["one", "two"] * 3
    os.makedirs(f"{tmp_path}/b")
    with open(f"{tmp_path}/b/cut", "wb") as f:
        f.write((gzip.compress(b"x" * 1000) * 3)[:-4])
    with pytest.raises(Exception, match="cut off"):
        members.read_gzip_members(spark, f"{tmp_path}/b", group_bytes=1, partitions=2).collect()


def test_one_file_is_many_tasks(spark, tmp_path):
    with open(f"{tmp_path}/many.gz", "wb") as f:
        f.writelines(gzip.compress(f"line {i}\nrest {i}".encode()) for i in range(200))
    os.makedirs(f"{tmp_path}/one")
    with open(f"{tmp_path}/one/single.gz", "wb") as f:
        f.write(gzip.compress("".join(f"line {i}\n" for i in range(20_000)).encode()))

    def tasks(path):
        groups = members._groups(spark, path, False, 100, None)
        return groups.select(F.spark_partition_id().alias("p")).distinct().count()

    assert tasks(f"{tmp_path}/many.gz") > 4 and tasks(f"{tmp_path}/one") == 1
    got = members.read_gzip_members(spark, f"{tmp_path}/many.gz", group_bytes=100).orderBy("line_no").collect()
    assert [r["line"] for r in got] == ["line 0"] + [f"rest {i}line {i + 1}" for i in range(199)] + ["rest 199"]
