"""Lines of UTF-16 and UTF-32 files over splits."""

import os
import random

import pytest

from fileflow.sources import wide


@pytest.mark.parametrize("name", ["utf-16-le", "utf-16-be", "utf-32-le", "utf-32-be"])
def test_lines_over_splits(spark, tmp_path, name):
    """Characters whose bytes are those of a line end, in any place; all line ends; with and without a byte order mark."""
    rng, want = random.Random(name), []
    marked = {"utf-16-le": b"\xff\xfe", "utf-16-be": b"\xfe\xff", "utf-32-le": b"\xff\xfe\0\0", "utf-32-be": b"\0\0\xfe\xff"}[name]
    for k in range(4):
        alphabet = ["a", "ੁ", "ਊ", "Ċ", "Ā", "\u000a", "\r\n", "\r", "\U0001f60a", "਀" if k % 2 else "z", "long text"]
        text = "".join(rng.choice(alphabet) for _ in range(400))
        with open(f"{tmp_path}/f{k}.txt", "wb") as f:
            f.write((marked if k < 3 else b"") + text.encode(name))
        lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        want += [(f"f{k}.txt", line) for line in (lines if lines[-1] else lines[:-1])]
    open(f"{tmp_path}/empty", "wb").close()
    # files without a mark need the order in the encoding, or are big-endian
    for encoding in [name] + (["UTF-16" if "16" in name else "UTF-32"] if name.endswith("be") else []):
        for split in (64, 301):
            rows = wide.read_wide_lines(spark, str(tmp_path), encoding, split_bytes=split).collect()
            got = [(os.path.basename(r["path"]), r["value"]) for r in sorted(rows, key=lambda r: (r["path"], r["feed_no"], r["part_no"]))]
            assert got == want, (encoding, split)


def test_order_by_the_mark_and_errors(spark, tmp_path):
    os.makedirs(f"{tmp_path}/a")
    for i, (mark, name) in enumerate([(b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be")]):
        with open(f"{tmp_path}/a/{i}", "wb") as f:
            f.write(mark + "\n".join(f"é{k}" for k in range(500)).encode(name))
    got = wide.read_wide_lines(spark, f"{tmp_path}/a", "UTF-16", split_bytes=200).orderBy("path", "feed_no").collect()
    assert [r["value"] for r in got] == [f"é{k}" for k in range(500)] * 2
    for bad in ("UTF-8", "UTF-16XE", "latin1"):
        with pytest.raises(ValueError, match="not UTF-16"):
            wide.charset(bad)
    with open(f"{tmp_path}/bad", "wb") as f:
        f.write(b"\x00\xd8" * 3 + "\n".encode("utf-16-le"))
    with pytest.raises(Exception, match="decode"):
        wide.read_wide_lines(spark, f"{tmp_path}/bad", "UTF-16LE").collect()


def test_header_lines_and_columns(spark, tmp_path):
    from fileflow.sources.delimited import Col, read_delimited

    for k in range(2):
        with open(f"{tmp_path}/f{k}", "wb") as f:
            f.write(("head\rhead two\n" + "".join(f"{i},ਊ{k}\n" for i in range(200))).encode("utf-16-be"))
    got = read_delimited(spark, str(tmp_path), [Col("i", "long"), Col("t")], encoding="UTF-16", header_lines=2, split_bytes=300)
    assert sorted(map(tuple, got.collect())) == sorted((i, f"ਊ{k}") for i in range(200) for k in range(2))


def test_small_splits_share_tasks(spark, tmp_path, tasks_of):
    """A file of hundreds of splits is not hundreds of tasks a pass; the lines and their numbers stay."""
    with open(f"{tmp_path}/f", "wb") as f:
        f.write("".join(f"line ਊ {k}\n" for k in range(3000)).encode("utf-16-le"))
    rows, tasks = tasks_of(lambda: wide.read_wide_lines(spark, str(tmp_path), "UTF-16LE", split_bytes=200).collect())
    assert [r["value"] for r in sorted(rows, key=lambda r: r["feed_no"])] == [f"line ਊ {k}" for k in range(3000)]
    assert tasks < 200  # 347 splits, three passes
