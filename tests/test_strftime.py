import datetime as dt

import pytest
from pyspark.sql import functions as F

from fileflow.functions.strftime import (expand_template, resolve_template, strftime_col,
                                          strftime_to_java, templated_path_column)
from fileflow.session import session_conf

TEMPLATE = "/x/%Y/%y/%m/%d %H:%M:%S.%L %I%p %j %a %A %b %B %u %w %U %W %V %s %% %F %T"
TIMES = [dt.datetime(2018, 8, 14, 16, 41, 7, 250000), dt.datetime(2021, 1, 3, 0, 0, 0),
         dt.datetime(2024, 12, 30, 12, 5, 9), dt.datetime(2020, 2, 29, 23, 59, 59),
         dt.datetime(2016, 1, 1, 7, 0, 0)]


def test_column_matches_resolver(spark):
    df = spark.createDataFrame([(t,) for t in TIMES], "ts timestamp_ntz")
    got = [r.p for r in df.select(strftime_col(F.col("ts"), TEMPLATE).alias("p")).collect()]
    assert got == [resolve_template(TEMPLATE, t) for t in TIMES]


def test_rewind(spark):
    df = spark.createDataFrame([(TIMES[0],)], "ts timestamp_ntz")
    p = df.select(templated_path_column(F.col("ts"), "/in/%Y/%j", 86400).alias("p")).first().p
    assert p == "/in/2018/225"
    assert resolve_template("/in/%Y/%j", TIMES[0], 86400) == "/in/2018/225"
    assert resolve_template("/in/%Y/%j", TIMES[0], -86400) == "/in/2018/227"


def test_python_agrees_with_libc():
    for t in TIMES:
        for d in "YymdHIMSjaAbBpuwUWV":
            assert resolve_template("%" + d, t) == t.strftime("%" + d), d


def test_unknown_directive_rejected():
    with pytest.raises(ValueError):
        resolve_template("/a/%Q", TIMES[0])
    with pytest.raises(ValueError):
        strftime_col(F.col("x"), "%Q")


def test_span_and_parse_pattern():
    paths = expand_template("/d/%Y%m%d", dt.datetime(2024, 1, 30), dt.datetime(2024, 2, 2))
    assert paths == ["/d/20240130", "/d/20240131", "/d/20240201", "/d/20240202"]
    assert strftime_to_java("%Y-%m-%d %H:%M:%S") == "yyyy'-'MM'-'dd' 'HH':'mm':'ss"
    with pytest.raises(ValueError):
        strftime_to_java("%s")


def test_percent_and_dangling_percent(spark):
    df = spark.createDataFrame([(TIMES[1],)], "ts timestamp_ntz")
    assert df.select(strftime_col(F.col("ts"), "x%%F%%%F").alias("p")).first().p == "x%F%2021-01-03"
    assert resolve_template("x%%F%%%F", TIMES[1]) == "x%F%2021-01-03"
    for bad in ("abc%", "abc%%%"):
        with pytest.raises(ValueError, match="dangling"):
            resolve_template(bad, TIMES[0])
        with pytest.raises(ValueError, match="dangling"):
            strftime_col(F.col("ts"), bad)


def test_other_zones(spark):
    gap = dt.datetime(2024, 3, 10, 2, 30, 5)  # a local time that New York skips
    with session_conf(spark, spark__sql__session__timeZone="America/New_York"):
        df = spark.createDataFrame([(gap,)], "ts timestamp_ntz")
        assert df.select(strftime_col(F.col("ts"), "%F %T %I%p %s").alias("p")).first().p == resolve_template(
            "%F %T %I%p %s", gap)
        ts = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS ts")
        assert ts.select(strftime_col(F.col("ts"), "%s %H").alias("p")).first().p == "1704085200 00"


FLAGGED = {
    "%-d/%-m/%-y/%-H/%-I/%-M/%-S/%-j": "4/7/9/5/5/3/9/185", "%e|%k|%l|%_m|%_3d|%0e|%-e|%4e": " 4| 5| 5| 7|  4|04|4|   4",
    "%^a %^B %#b %#p %P %^h": "SAT JULY JUL am am JUL", "%6Y|%06d|%_6Y|%10A|%010b": "002009|000004|  2009|  Saturday|0000000Jul",
    "%3N %6N %9N %N %1L %L %12N": "120 120034 120034000 120034000 1 120 120034000000", "%C%y %G-%V %g": "2009 2009-27 09",
    "%D %R %r %x %X": "07/04/09 05:03 05:03:09 AM 07/04/09 05:03:09", "%c|%v|%^c": "Sat Jul  4 05:03:09 2009| 4-JUL-2009|SAT JUL  4 05:03:09 2009",
    "a%nb%tc %:z %::z": "a\nb\tc +00:00 +00:00:00", "%s %-u %02w": "1246683789 6 06",
}


def test_flags_and_widths(spark):
    t = dt.datetime(2009, 7, 4, 5, 3, 9, 120034)
    assert {f: resolve_template(f, t) for f in FLAGGED} == FLAGGED
    with session_conf(spark, spark__sql__session__timeZone="UTC"):
        df = spark.createDataFrame([(t,), *((x,) for x in TIMES)], "ts timestamp_ntz")
        rows = df.select("ts", *[strftime_col(F.col("ts"), f).alias(str(i)) for i, f in enumerate(FLAGGED)]).collect()
    for r in rows:
        assert list(r)[1:] == [resolve_template(f, r["ts"]) for f in FLAGGED]
    for x in TIMES:
        for d in ("-d", "-m", "-H", "-I", "-j", "e", "k", "l", "^a", "^B", "G", "g", "C", "D", "R"):
            assert resolve_template("%" + d, x) == x.strftime("%" + d), d
    for bad in ("%-z", "%:Y", "%5F", "%:::z", "%_N", "%-Q", "%5%", "%03s", "%-F"):
        with pytest.raises(ValueError, match="unsupported"):
            resolve_template(bad, t)


TEMPLATES = ["/a/%-d.%-m.%Y/%k-%-M", "/a/%e-%^b-%6Y/%l%P", "/a/%C%y/%#B/%_3d/%T.%6N", "/a/%-j-%Y/%-I-%#p/%2N", "/a/%v/%R", "/a/%Y-%m-%d", "/a/%Y/%j/%H%M%S", "/a/%y%m%d-%I%p/%M", "/a/%B %d, %Y/%T", "/a/%s", "/a/%F/%H-%L", "/x{1,2}/%Y*/%b", "/%A/%Y-W%V/%m"]


@pytest.mark.parametrize("template", TEMPLATES)
def test_path_time_is_the_inverse_of_the_template(spark, template):
    import fnmatch
    import random
    import re

    from fileflow.functions.strftime import path_time, template_glob, template_regex, truncated

    rng = random.Random(len(template))
    times = [dt.datetime(1995, 1, 1) + dt.timedelta(seconds=rng.randint(0, 10**9), milliseconds=rng.randint(0, 999)) for _ in range(60)]
    paths = [resolve_template(template, t).replace("{1,2}", "2").replace("*", "-any") for t in times]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate([*paths, "/a/2020-13-45", "/else", None])], "i int, p string")
    got = {r["i"]: r["t"] for r in rows.select("i", path_time(F.concat("p", F.lit("/part-1.csv")), template).alias("t")).collect()}
    assert [got[i] for i in range(60)] == [truncated(t, template) for t in times]
    assert [got[i] for i in range(60, 63)] == [None] * 3
    assert all(re.search(template_regex(template)[0], p) for p in paths)
    if "{" not in template:
        assert all(fnmatch.fnmatch(p, template_glob(template)) for p in paths)


def test_globs_are_narrow_where_a_span_is():
    from fileflow.functions.strftime import path_time, template_glob

    day = lambda *a: dt.datetime(*a)
    assert template_glob("/%Y/%m/%d", day(2024, 5, 1), day(2024, 5, 9)) == "/2024/05/[0-9][0-9]"
    assert template_glob("/%Y/%m", day(2023, 5, 1), day(2024, 5, 9)) == "/{2023,2024}/[0-9][0-9]"
    assert template_glob("/%F/%H", day(2024, 5, 1), day(2024, 5, 1, 5)) == "/2024-05-01/[0-9][0-9]"
    with pytest.raises(ValueError, match="no year"):
        path_time(F.lit("/05"), "/%m")
