import datetime as dt
import os

import pytest

from fileflow.session import session_conf
from fileflow.sources.delimited import Col, parse_delimited, read_delimited

COLS = [Col("ticket", "long"), Col("seat", "long"), Col("opened", "timestamp", "%d/%m/%Y %H.%M.%S"),
        Col("due", "timestamp", "%Y%m%d"), Col("remark", "string")]
SAMPLE = ('ticket,seat,opened,due,remark\n'
          '7,4100,04/03/2019 05.06.07,20190304,plain\n'
          '8,4200,04/03/2019 06.00.00,20190305,two words\n'
          '9,4300,05/03/2019 23.59.59,20190306,"with ""quotes"" and, comma"\n'
          '10,4400,06/03/2019 00.00.01,20190307,none\n')


def _file(root, rel, text, enc="utf-8"):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as f:
        f.write(text.encode(enc))
    return p


def test_typed_rows(spark, tmpdir_path):
    _file(tmpdir_path, "s1.csv", SAMPLE)
    _file(tmpdir_path, "s2.csv", SAMPLE)
    df = read_delimited(spark, tmpdir_path, COLS, header_lines=1)
    got = sorted(tuple(r) for r in df.collect())
    assert len(got) == 8
    assert got[0] == (7, 4100, dt.datetime(2019, 3, 4, 5, 6, 7), dt.datetime(2019, 3, 4), "plain")
    assert ('with "quotes" and, comma') in {r[4] for r in got}
    assert "none" in {r[4] for r in got}


def test_two_header_lines_tiny_splits(spark, tmpdir_path):
    body = "".join(f"{i},n{i}\n" for i in range(40))
    for k in range(3):
        _file(tmpdir_path, f"f{k}.csv", "h1,x\nh2,y\n" + body)
    _file(tmpdir_path, "short.csv", "only\n")
    cols = [Col("id", "long"), Col("name")]
    assert read_delimited(spark, tmpdir_path, cols, header_lines=2).count() == 120
    with session_conf(spark, spark__sql__files__maxPartitionBytes=7, spark__sql__files__openCostInBytes=1):
        # a 7-byte first split still owns both 5-byte header lines
        assert read_delimited(spark, tmpdir_path, cols, header_lines=2).count() == 120
    with session_conf(spark, spark__sql__files__maxPartitionBytes=3, spark__sql__files__openCostInBytes=1):
        with pytest.raises(Exception, match="does not fit in the first split|bad row"):
            read_delimited(spark, tmpdir_path, cols, header_lines=2).collect()
        exact = read_delimited(spark, tmpdir_path, cols, header_lines=2, header_mode="exact").collect()
    assert sorted(r.id for r in exact) == sorted(list(range(40)) * 3)


def test_ragged_and_trim(spark, tmpdir_path):
    _file(tmpdir_path, "r.csv", '2\n3,c,x\n3,c,\nx,d\n4,e\n9,  p \n10,"  p "\n')
    cols = [Col("id", "long"), Col("name")]
    got = read_delimited(spark, tmpdir_path, cols, allow_extra_columns=True, allow_optional_columns=True,
                         on_bad_row="null", with_status=True, trim_if_not_quoted=True).collect()
    st = sorted((r.id if r.id is not None else -1, r.name or "", r.row_status) for r in got)
    assert st == sorted([(2, "", "missing_columns"), (3, "c", "extra_columns"), (3, "c", "extra_columns"),
                         (-1, "d", "bad_value"), (4, "e", "ok"), (9, "p", "ok"), (10, "  p ", "ok")])
    with pytest.raises(Exception, match="bad row"):
        read_delimited(spark, tmpdir_path, cols).collect()
    dropped = read_delimited(spark, tmpdir_path, cols, on_bad_row="drop", trim_if_not_quoted=True)
    assert dropped.count() == 3


def test_multiline_and_charset(spark, tmpdir_path):
    _file(tmpdir_path, "m/q.csv", '1,"x\ny"\n2,z\n')
    cols = [Col("id", "long"), Col("v")]
    ml = read_delimited(spark, f"{tmpdir_path}/m", cols, multi_line=True).collect()
    assert sorted((r.id, r.v) for r in ml) == [(1, "x\ny"), (2, "z")]
    _file(tmpdir_path, "l/latin.csv", "1,café\n", enc="iso-8859-1")
    lat = read_delimited(spark, f"{tmpdir_path}/l", cols, encoding="ISO-8859-1").collect()
    assert lat[0].v == "café"
    _file(tmpdir_path, "u/u16.csv", "1,über\n2,b\n", enc="utf-16")
    u16 = read_delimited(spark, f"{tmpdir_path}/u", cols, encoding="UTF-16", multi_line=True).collect()
    assert sorted((r.id, r.v) for r in u16) == [(1, "über"), (2, "b")]


def test_tab_separated_unquoted_example(spark, tmpdir_path):
    # tab separated, quoting off, trim, ragged rows allowed
    _file(tmpdir_path, "t/a.tsv", 'x\t y \t"z"\t12\n' "p\tq\n" "a\tb\tc\t7\textra\n")
    cols = [Col("c0"), Col("c1"), Col("c2"), Col("c3", "long")]
    got = read_delimited(spark, f"{tmpdir_path}/t", cols, sep="\t", quote="", escape="",
                         trim_if_not_quoted=True, allow_extra_columns=True,
                         allow_optional_columns=True).collect()
    assert sorted(tuple(r) for r in got) == sorted([("x", "y", '"z"', 12), ("p", "q", None, None),
                                                    ("a", "b", "c", 7)])


def test_backslash_escape_field_count(spark, tmpdir_path):
    _file(tmpdir_path, "e/x.csv", '1,"a\\"b,c"\n2,"plain"\n')
    cols = [Col("id", "long"), Col("v")]
    got = read_delimited(spark, f"{tmpdir_path}/e", cols, escape="\\", with_status=True).collect()
    assert sorted((r.id, r.v, r.row_status) for r in got) == [(1, 'a"b,c', "ok"), (2, "plain", "ok")]


def test_quotes_inside_fields_and_long_quoted_fields(spark):
    long = "x" * 100_000
    rows = [('1,5" pipe,6" pipe',), ('2,"a ""q"" b",c',), (f'3,"{long}",z',), ('4,"open,rest',), ("6,a,b,",), ('8,"a,b",c',)]
    df = spark.createDataFrame(rows, "value string")
    got = {r["id"]: tuple(r)[1:] for r in
           parse_delimited(df, [Col("id", "long"), Col("a"), Col("b")], on_bad_row="null", with_status=True).collect()}
    assert got == {1: ('5" pipe', '6" pipe', "ok"), 2: ('a "q" b', "c", "ok"), 3: (long, "z", "ok"),
                   4: ("open,rest", None, "missing_columns"), 6: ("a", "b", "extra_columns"), 8: ("a,b", "c", "ok")}


def test_header_longer_than_many_splits(spark, tmpdir_path):
    heads = "".join("h" * 600_000 + "\n" for _ in range(3))
    _file(tmpdir_path, "big/a.csv", heads + "1,a\n2,b\n")
    _file(tmpdir_path, "big/b.csv", "x\ny\nz\n3,c\n")
    _file(tmpdir_path, "big/short.csv", "x\ny\n")
    cols = [Col("id", "long"), Col("name")]
    with session_conf(spark, spark__sql__files__maxPartitionBytes=300_000, spark__sql__files__openCostInBytes=1):
        got = read_delimited(spark, f"{tmpdir_path}/big", cols, header_lines=3, header_mode="exact").collect()
    assert sorted((r.id, r.name) for r in got) == [(1, "a"), (2, "b"), (3, "c")]


@pytest.mark.parametrize("read", [{"multi_line": True}, {"encoding": "ISO-8859-1"}, {}])
def test_one_row_policy_for_all_reads(spark, tmpdir_path, read):
    _file(tmpdir_path, "p/x.csv", 'zz,b\n1,a\n3,c,EXTRA\n5,e,\n6,f,1,2\n7,"q ""r"", s",1\n8,"g ""h""",x,y\n4\n')
    cols = [Col("id", "long"), Col("v")]
    got = read_delimited(spark, f"{tmpdir_path}/p", cols, on_bad_row="null", with_status=True, **read).collect()
    assert sorted((r.id or 0, r.v, r.row_status) for r in got if r.v) == [
        (0, "b", "bad_value"), (1, "a", "ok"), (3, "c", "extra_columns"), (5, "e", "extra_columns"),
        (6, "f", "extra_columns"), (7, 'q "r", s', "extra_columns"), (8, 'g "h"', "extra_columns")]
    assert [(r.id, r.row_status) for r in got if not r.v] == [(4, "missing_columns")]
    assert read_delimited(spark, f"{tmpdir_path}/p", cols, on_bad_row="drop", **read).count() == 1
    with pytest.raises(Exception, match="bad row"):
        read_delimited(spark, f"{tmpdir_path}/p", cols, **read).collect()


def test_utf16_is_read_whole(spark, tmpdir_path):
    _file(tmpdir_path, "w/u16.csv", "1,über\n2,b\n", enc="utf-16")
    got = read_delimited(spark, f"{tmpdir_path}/w", [Col("id", "long"), Col("v")], encoding="UTF-16").collect()
    assert sorted((r.id, r.v) for r in got) == [(1, "über"), (2, "b")]


def test_ntz_times_stay_out_of_the_session_zone(spark):
    df = spark.createDataFrame([("1,2024-03-10 02:30:00",), ("2,2024-03-10 02:70:00",), ("3,",)], "value string")
    with session_conf(spark, spark__sql__session__timeZone="America/New_York"):
        out = parse_delimited(df, [Col("id", "long"), Col("t", "timestamp", "%Y-%m-%d %H:%M:%S")], on_bad_row="null",
                              timestamp_ntz=True, with_status=True)
        got = {r.id: (r.t, r.row_status) for r in out.collect()}
    assert got == {1: (dt.datetime(2024, 3, 10, 2, 30), "ok"), 2: (None, "bad_value"), 3: (None, "ok")}
