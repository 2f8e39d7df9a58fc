import bz2
import datetime as dt
import gzip
import os

import pytest
from pyspark.sql.utils import AnalysisException

from fileflow.session import session_conf
from fileflow.sources import inventory as INV
from fileflow.sources import scans as SC


def _write(root, rel, data: bytes, codec=None):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    if codec == "gz":
        data = gzip.compress(data)
    elif codec == "bz2":
        data = bz2.compress(data)
    with open(p, "wb") as f:
        f.write(data)
    return p


def rows(prefix, n):
    return "".join(f"{prefix}{i},v{i}\n" for i in range(n)).encode()


@pytest.fixture()
def tree(tmpdir_path):
    r = tmpdir_path
    _write(r, "d1/a.csv", rows("a", 5))
    _write(r, "d1/sub/b.csv", rows("b", 6))
    _write(r, "d1/sub/deep/c.csv.gz", rows("c", 7), "gz")
    _write(r, "d2/e.csv.bz2", rows("e", 8), "bz2")
    _write(r, "d2/_hidden.csv", rows("h", 3))
    _write(r, "d2/.dot.csv", rows("h", 3))
    _write(r, "d2/empty.csv", b"")
    return r


def test_recursive_glob_and_codecs(spark, tree):
    got = sorted(r.value for r in SC.read_lines(spark, f"{tree}/d*").collect())
    want = sorted(rows("a", 5).decode().split("\n")[:-1] + rows("b", 6).decode().split("\n")[:-1]
                  + rows("c", 7).decode().split("\n")[:-1] + rows("e", 8).decode().split("\n")[:-1])
    assert got == want            # hidden files ignored, empty file adds nothing


def test_inventory(spark, tree):
    inv = INV.list_files(spark, tree).collect()
    names = sorted(os.path.basename(r.path) for r in inv)
    assert names == ["a.csv", "b.csv", "c.csv.gz", "e.csv.bz2"]
    sizes = {os.path.basename(r.path): r.length for r in inv}
    assert sizes["a.csv"] == len(rows("a", 5))
    only = INV.list_files(spark, tree, path_regex=r"/sub/").collect()
    assert sorted(os.path.basename(r.path) for r in only) == ["b.csv", "c.csv.gz"]


def test_no_match_raises(spark, tree):
    with pytest.raises(AnalysisException):
        SC.read_lines(spark, f"{tree}/nothing-*").collect()


def test_all_empty_check(spark, tmpdir_path):
    _write(tmpdir_path, "e.csv", b"")
    _write(tmpdir_path, "f.csv", b"x\n")
    inv = INV.list_files(spark, tmpdir_path, skip_empty=False)
    # Spark's file sources hide empty files already
    assert INV.require_nonempty(inv).count() == 1
    with pytest.raises(Exception, match="all files are empty"):
        INV.require_nonempty(inv.where("length = 0")).collect()


def test_split_reads_each_line_once(spark, tmpdir_path):
    data = "".join(f"{i},{'é' * (i % 4)}x\r\n" if i % 3 else f"{i},y\r" for i in range(300)).encode()
    _write(tmpdir_path, "big.txt", data)
    with session_conf(spark, spark__sql__files__maxPartitionBytes=40, spark__sql__files__openCostInBytes=1):
        df = SC.read_lines(spark, tmpdir_path)
        assert df.rdd.getNumPartitions() > 10
        got = sorted(r.value for r in df.collect())
    assert got == sorted(data.decode().replace("\r\n", "\n").replace("\r", "\n").split("\n")[:-1])


def test_whole_file_and_misnamed_gzip(spark, tmpdir_path):
    _write(tmpdir_path, "w/one.txt", b"a\nb\r\nc")
    _write(tmpdir_path, "g/data.bin", b"l1\nl2\n", "gz")
    whole = SC.read_whole_files(spark, f"{tmpdir_path}/w").collect()
    assert [(r.line_no, r.line) for r in sorted(whole, key=lambda r: r.line_no)] == [(0, "a\n"), (1, "b\r\n"), (2, "c")]
    gz = SC.read_gzip_any_name(spark, f"{tmpdir_path}/g").collect()
    assert sorted(r.line for r in gz) == ["l1\n", "l2\n"]


def test_templated_paths(spark, tmpdir_path):
    for day in ("2024-01-30", "2024-01-31", "2024-02-01"):
        _write(tmpdir_path, f"day={day}/p.csv", f"{day}\n".encode())
    now = dt.datetime(2024, 2, 1, 0, 30)
    paths = SC.templated_paths(f"{tmpdir_path}/day=%Y-%m-%d", now, 86400)
    assert [r.value for r in SC.read_lines(spark, paths).collect()] == ["2024-01-31"]
    span = SC.templated_paths(f"{tmpdir_path}/day=%Y-%m-%d", now, 0, span_seconds=2 * 86400)
    assert sorted(r.value for r in SC.read_lines(spark, span).collect()) == ["2024-01-30", "2024-01-31", "2024-02-01"]


def test_gzip_members_are_all_read(spark, tmpdir_path):
    import gzip

    data = gzip.compress(b"a b\n") + gzip.compress(b"c d\ne")
    with open(f"{tmpdir_path}/part", "wb") as f:
        f.write(data)
    from fileflow.sources.scans import read_gzip_any_name
    assert [r["line"] for r in read_gzip_any_name(spark, tmpdir_path).orderBy("line_no").collect()] == ["a b\n", "c d\n", "e"]
