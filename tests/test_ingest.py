"""End to end from job options."""

import datetime as dt
import gzip
import os

import pytest

from fileflow.options import IngestOptions
from fileflow.plans.ingest import plan_ingest, read_ingest
from fileflow.sources.delimited import Col
from fileflow.sources.scans import approximate_ranges

COLS = [Col("ticket", "long"), Col("seat", "long"), Col("opened", "timestamp", "%d/%m/%Y %H.%M.%S"),
        Col("due", "timestamp", "%Y%m%d"), Col("remark", "string")]
SAMPLE = ('ticket,seat,opened,due,remark\n'
          '1,500,06/05/2020 07.08.09,20200506,first\n'
          '2,600,06/05/2020 08.00.00,20200506,"second, quoted"\n'
          '3,700,07/05/2020 01.02.03,20200507,third\n'
          '4,800,08/05/2020 04.05.06,20200508,none\n')


def _dir(root):
    d = os.path.join(root, "in")
    os.makedirs(d)
    for n in ("s1.csv", "s2.csv"):
        with open(os.path.join(d, n), "w") as f:
            f.write(SAMPLE)
    with open(os.path.join(d, "s3.csv.gz"), "wb") as f:
        f.write(gzip.compress(SAMPLE.encode()))
    return d


def test_directory_twelve_records(spark, tmpdir_path):
    d = _dir(tmpdir_path)
    opts = IngestOptions(path=d, target_ranges=10, header_lines=1)
    plan = plan_ingest(spark, opts).collect()
    assert {os.path.basename(r.path_string) for r in plan} == {"s1.csv", "s2.csv", "s3.csv.gz"}
    gz = [r for r in plan if r.path_string.endswith(".gz")]
    assert len(gz) == 1 and gz[0].is_decompressible and not gz[0].is_partitionable
    assert sorted(r.task_id for r in plan) == list(range(len(plan)))   # min_task_size 0
    from fileflow.sources.scans import read_lines

    assert read_lines(spark, d).rdd.getNumPartitions() <= 3      # one split per file
    with approximate_ranges(spark, d, 10) as unit:
        assert unit == max(sum(os.path.getsize(os.path.join(d, f)) for f in os.listdir(d)) // 10, 1)
        assert read_lines(spark, d).rdd.getNumPartitions() >= 5
        rows = sorted(tuple(r) for r in read_ingest(spark, opts, COLS).collect())
    assert len(rows) == 12
    assert rows[0] == (1, 500, dt.datetime(2020, 5, 6, 7, 8, 9), dt.datetime(2020, 5, 6), "first")
    assert rows[3] == (2, 600, dt.datetime(2020, 5, 6, 8, 0, 0), dt.datetime(2020, 5, 6), "second, quoted")


def test_unsplit_and_single_file(spark, tmpdir_path):
    d = _dir(tmpdir_path)
    opts = IngestOptions(path=d, splittable=False, header_lines=1)
    assert all(not r.is_partitionable for r in plan_ingest(spark, opts).collect())
    assert read_ingest(spark, opts, COLS).count() == 12
    one = IngestOptions(path=os.path.join(d, "s1.csv"), splittable=False, header_lines=1)
    assert read_ingest(spark, one, COLS).count() == 4


def test_regex_limits_packing_and_template(spark, tmpdir_path):
    d = _dir(tmpdir_path)
    opts = IngestOptions(path=d, header_lines=1, path_regex=r"s[12]\.csv$", target_ranges=7, min_task_size=100)
    plan = plan_ingest(spark, opts).collect()
    assert {os.path.basename(r.path_string) for r in plan} == {"s1.csv", "s2.csv"}
    assert read_ingest(spark, opts, COLS).count() == 8
    assert read_ingest(spark, IngestOptions(path=d, header_lines=1, max_files=1), COLS).count() == 4
    assert len(plan_ingest(spark, IngestOptions(path=d, max_ranges=2)).collect()) == 2
    day = os.path.join(tmpdir_path, "2020-05-06")
    os.makedirs(day)
    with open(os.path.join(day, "x.csv"), "w") as f:
        f.write(SAMPLE)
    t = IngestOptions(path=os.path.join(tmpdir_path, "%Y-%m-%d"), rewind_seconds=86400, header_lines=1)
    assert read_ingest(spark, t, COLS, now=dt.datetime(2020, 5, 7, 3, 0)).count() == 4
    # the day before as well, as a span of the template
    span = IngestOptions(path=os.path.join(tmpdir_path, "%Y-%m-%d"), span_seconds=86400, header_lines=1)
    os.makedirs(os.path.join(tmpdir_path, "2020-05-07"))
    with open(os.path.join(tmpdir_path, "2020-05-07", "y.csv"), "w") as f:
        f.write(SAMPLE)
    assert read_ingest(spark, span, COLS, now=dt.datetime(2020, 5, 7, 3, 0)).count() == 8


def test_plan_and_read_select_the_same_files(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "odd")
    os.makedirs(d)
    for i, n in enumerate(("a b.csv", "a[1].csv", "a+b%20.csv", "z.csv")):
        with open(os.path.join(d, n), "w") as f:
            f.write(f"{i}\n")
    cols = [Col("id", "long")]

    def both(**options):
        opts = IngestOptions(path=d, **options)
        names = {os.path.basename(r.path_string) for r in plan_ingest(spark, opts).collect()}
        return names, sorted(r.id for r in read_ingest(spark, opts, cols).collect())

    assert both(path_regex="a b") == ({"a b.csv"}, [0])
    assert both(path_regex=r"^file:/[^/].*a\+b%20") == ({"a+b%20.csv"}, [2])
    assert both(max_files=1) == ({"a b.csv"}, [0])
    assert both(max_files=3) == ({"a b.csv", "a[1].csv", "a+b%20.csv"}, [0, 1, 2])
    assert both(path_regex=r"\[1\]|/z\.csv$", max_files=1) == ({"a[1].csv"}, [1])


def test_options_a_read_cannot_follow_are_errors(spark, tmpdir_path):
    d = _dir(tmpdir_path)
    with pytest.raises(ValueError, match="not with"):
        read_ingest(spark, IngestOptions(path=d, max_ranges=1, target_ranges=9, header_lines=1), COLS, multi_line=True)
    with pytest.raises(ValueError, match="suffix"):
        read_ingest(spark, IngestOptions(path=d, decompression=False, header_lines=1), COLS)
    plain = IngestOptions(path=d, decompression=False, header_lines=1, path_regex=r"csv$")
    assert read_ingest(spark, plain, COLS).count() == 8
    e = os.path.join(tmpdir_path, "empty")
    os.makedirs(e)
    open(os.path.join(e, "x.csv"), "w").close()
    with pytest.raises(ValueError, match="all files are empty"):
        read_ingest(spark, IngestOptions(path=e, fail_if_empty=True), COLS)
    assert read_ingest(spark, IngestOptions(path=e), COLS).count() == 0


def _range_rows(files, target, k, header):
    """Ids of the lines whose first byte lies in the first ``k`` ranges of plain files (name, bytes); the plain plan."""
    unit = max(sum(len(b) for _, b in files) // target, 1)
    ranges = [(name, len(b) * i // n, len(b) * (i + 1) // n) for name, b in sorted(files) if b for n in [(len(b) - 1) // unit + 1]
              for i in range(n)][:k]
    out = []
    for name, data in files:
        at = 0
        for no, line in enumerate(data.splitlines(keepends=True)):
            if no >= header and any(f == name and a <= at < z for f, a, z in ranges):
                out.append(int(line.split(b",")[0]))
            at += len(line)
    return sorted(out)


@pytest.mark.parametrize("header", [0, 2])
def test_max_ranges_cuts_the_rows_of_a_read(spark, tmpdir_path, header):
    files, key = [], 0
    for f in range(3):
        data = b"".join(b"h,\xc3\xa9\n" for _ in range(header))
        for _ in range(15):
            data += f"{key},{'x' * (key * 7 % 11)}".encode() + (b"\r\n" if key % 3 else b"\n")
            key += 1
        files.append((f"f{f}.csv", data))
        with open(os.path.join(tmpdir_path, f"f{f}.csv"), "wb") as out:
            out.write(data)
    cols = [Col("id", "long"), Col("x")]
    for k in (1, 3, 8, 11, 500):
        opts = IngestOptions(path=tmpdir_path, target_ranges=10, max_ranges=k, header_lines=header)
        got = sorted(r["id"] for r in read_ingest(spark, opts, cols).collect())
        assert got == _range_rows(files, 10, k, header)
        assert len(plan_ingest(spark, opts).collect()) == min(k, len(plan_ingest(spark, IngestOptions(
            path=tmpdir_path, target_ranges=10, header_lines=header)).collect()))


def test_max_ranges_of_files_that_are_one_range(spark, tmpdir_path):
    d = _dir(tmpdir_path)
    for k, n in ((1, 4), (2, 8), (3, 12)):
        opts = IngestOptions(path=d, splittable=False, target_ranges=50, max_ranges=k, header_lines=1, decompression=True)
        assert read_ingest(spark, opts, COLS).count() == n


def test_a_span_passes_over_missing_folders(spark, tmpdir_path):
    for day in ("2023-12-30", "2024-01-01", "2024-01-02", "2024-01-05", "2024-02-01"):
        os.makedirs(os.path.join(tmpdir_path, day))
        with open(os.path.join(tmpdir_path, day, "f.csv"), "w") as f:
            f.write(day.replace("-", "") + ",x\n")
    now = dt.datetime(2024, 1, 4, 10, 30)
    opts = IngestOptions(path=os.path.join(tmpdir_path, "%Y-%m-%d"), span_seconds=5 * 86400)
    rows = read_ingest(spark, opts, [Col("id", "long"), Col("x")], now=now)
    assert sorted(r["id"] for r in rows.collect()) == [20231230, 20240101, 20240102]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_ingest(spark, opts, [Col("id", "long"), Col("x")], now=dt.datetime(2030, 1, 1)).collect()
