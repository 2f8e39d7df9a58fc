"""Reads with a state carried over splits: records with quoted line ends, byte offsets of lines."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from fileflow.sources import splits
from fileflow.sources.delimited import Col, read_delimited


def fields(rng):
    part = lambda: "".join(rng.choice(["a", "b", '"', ",", "\n", " ", "é", "", "x" * 9]) for _ in range(rng.randint(0, 8)))
    return [str(rng.randint(0, 99)), part(), part() if rng.random() < 0.7 else "plain"]


def write(path, rows, quoting=csv.QUOTE_MINIMAL):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    buf = io.StringIO()
    csv.writer(buf, quoting=quoting, lineterminator="\n").writerows(rows)
    with open(path, "wb") as f:
        f.write(buf.getvalue().encode())


@pytest.mark.parametrize("split_bytes", [13, 120, 1 << 20])
def test_records_with_quoted_line_ends_at_any_split(spark, tmp_path, split_bytes):
    rng, want = random.Random(split_bytes), []
    for f in range(3):
        rows = [fields(rng) for _ in range((1, 30, 12)[f])]
        write(f"{tmp_path}/d{f % 2}/f{f}.csv", rows, rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
        want += rows
    got = [next(csv.reader([r["value"]], strict=True)) if "\n" not in r["value"] else next(csv.reader(io.StringIO(r["value"])))
           for r in splits.read_records(spark, str(tmp_path), split_bytes=split_bytes).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("n", [0, 2])
def test_header_records_are_whole_records(spark, tmp_path, n):
    head = [['first\n"head"', "x"], ["second", "y\n\nz"]]
    rows = [[[f"{f}-{i}", "line\nend" * (i % 3)] for i in range(6)] for f in range(2)]
    for f in range(2):
        write(f"{tmp_path}/f{f}.csv", head + rows[f])
    got = read_delimited(spark, str(tmp_path), [Col("a"), Col("b")], header_lines=n, multi_line="split", split_bytes=19)
    want = sorted((a, b) for f in range(2) for a, b in (head + rows[f])[n:])
    assert sorted((r["a"], r["b"] or "") for r in got.collect()) == want


def test_a_record_over_many_splits_and_a_file_that_is_one(spark, tmp_path):
    long = "\n".join(f"line {i}" for i in range(60))
    write(f"{tmp_path}/a.csv", [["1", long], ["2", "b"], ["3", long]])
    write(f"{tmp_path}/b.csv", [["4", long]])
    got = read_delimited(spark, str(tmp_path), [Col("a", "long"), Col("b")], multi_line="split", split_bytes=50)
    assert sorted(map(tuple, got.collect())) == [(1, long), (2, "b"), (3, long), (4, long)]


def test_escapes_and_stray_quotes(spark, tmp_path):
    with open(f"{tmp_path}/f.csv", "w") as f:
        f.write('1;"a\\";\nb"\n2;5" disk\n3;"c"x\n4;"d\\\\"\n5;"e\n\\"\n"\n')
    got = [r["value"] for r in splits.read_records(spark, str(tmp_path), sep=";", escape="\\", split_bytes=19).collect()]
    assert sorted(got) == ['1;"a\\";\nb"', '2;5" disk', '3;"c"x', '4;"d\\\\"', '5;"e\n\\"\n"']


def test_carriage_returns(spark, tmp_path):
    with open(f"{tmp_path}/f.csv", "wb") as f:
        f.write(b'1,"a\r\nb"\r\n2,"c\rd"\r\n3,e\r\n')
    read = lambda **o: sorted(r["value"] for r in splits.read_records(spark, str(tmp_path), split_bytes=6, **o).collect())
    assert read() == ['1,"a\nb"', '2,"c\nd"', "3,e"]
    assert read(line_sep="\n") == ['1,"a\r\nb"', '2,"c\rd"', "3,e"]


def test_a_quote_that_is_never_closed(spark, tmp_path):
    with open(f"{tmp_path}/f.csv", "w") as f:
        f.write('1,a\n2,"b\n' + "long line\n" * 50)
    got = sorted(r["value"] for r in splits.read_records(spark, str(tmp_path), split_bytes=30).collect())
    assert got[0] == "1,a" and len(got) == 2 and got[1].startswith('2,"b\nlong line')
    with pytest.raises(Exception, match="never closed"):
        splits.read_records(spark, str(tmp_path), max_record_bytes=100)
    with pytest.raises(ValueError, match="single characters"):
        splits.read_records(spark, str(tmp_path), sep="||")


def test_effects_compose():
    import itertools

    import numpy as np

    effect = {splits.KEEP: (0, 1), splits.TURN: (1, 0), splits.OUTSIDE: (0, 0), splits.INSIDE: (1, 1)}
    for n in range(1, 6):
        for run in itertools.product(range(4), repeat=n):
            for state in (0, 1):
                want, s = [], state
                for e in run:
                    want.append(s)
                    s = effect[e][s]
                before, after = splits.states(np.array(run, np.int8), state)
                assert (before.tolist(), after) == (want, s)


@pytest.mark.parametrize("split_bytes", [17, 1 << 20])
def test_line_offsets(spark, tmp_path, split_bytes):
    rng, want = random.Random(split_bytes), []
    for f in range(3):
        lines, end = [], "\n"
        for _ in range(25):  # no empty line behind a carriage return: its line feed would join it
            line, end = "".join(rng.choice("abcé日 ") for _ in range(rng.randint(end == "\r", 12))), rng.choice(["\n", "\n", "\r\n", "\r"])
            lines.append((line, end))
        lines.append(("end", "\n"))
        data, path = b"", f"{tmp_path}/sub {f % 2}/f+{f}.txt"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        for no, (line, end) in enumerate(lines):
            want.append((f"file:{path}", no, len(data), len((line + end).encode()), line))
            data += (line + end).encode()
        with open(path, "wb") as out:
            out.write(data)
    got = splits.lines_with_offsets(spark, str(tmp_path), split_bytes=split_bytes).collect()
    assert sorted((r["path"], r["line_no"], r["line_start"], r["line_bytes"], r["value"]) for r in got) == sorted(want)


def test_splits_do_not_depend_on_the_cluster(spark, tmp_path):
    write(f"{tmp_path}/f.csv", [["x" * 50]] * 40)
    with splits.fixed_splits(spark, 100):
        n = splits.scan(spark, str(tmp_path)).select("_start").distinct().count()
    assert n == -(-40 * 51 // 100) or n == 20
    with splits.fixed_splits(spark, None):
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() == 1


def test_many_small_files_in_few_tasks(spark, tmp_path, tasks_of):
    """Neither the listings nor the passes have a task a folder; paths are spelled as listed, carriage returns cut lines."""
    folders = 40 * spark.sparkContext.defaultParallelism
    want = []
    for k in range(folders):
        path = f"{tmp_path}/a+b %41 é={k}"
        os.makedirs(path)
        with open(f"{path}/f", "wb") as out:
            out.write(f"\r{k}\rb\r\r\né\n\n".encode())
        want += [(f"file:{path}/f", *x) for x in [(0, 0, 1, ""), (1, 1, len(str(k)) + 1, str(k)), (2, len(str(k)) + 2, 2, "b"),
                                                  (3, len(str(k)) + 4, 2, ""), (4, len(str(k)) + 6, 3, "é"), (5, len(str(k)) + 9, 1, "")]]
    got, tasks = tasks_of(lambda: splits.lines_with_offsets(spark, str(tmp_path), split_bytes=1 << 16).collect())
    assert sorted((r["path"], r["line_no"], r["line_start"], r["line_bytes"], r["value"]) for r in got) == sorted(want)
    assert tasks < 2 * folders
