import pytest
from pyspark.sql import functions as F

from fileflow.operators import ranges as R
from fileflow.operators.ordered import with_global_index

INV = [("/a/x.csv", 1000), ("/a/y.csv.gz", 500), ("/b/z.csv", 0), ("/b/w.txt", 7), ("/c/v.bz2", 90)]


def _inv(spark, rows=INV):
    return spark.createDataFrame(rows, "path string, length long")


def test_plan_tiles_each_file(spark):
    plan = R.range_plan(_inv(spark), 10).collect()
    unit = max(sum(l for _, l in INV) // 10, 1)
    for path, length in INV:
        rs = sorted((r.start, r.end) for r in plan if r.path_string == path)
        if length == 0:
            assert rs == []
            continue
        compressed = path.endswith((".gz", ".bz2"))
        n = 1 if compressed else (length - 1) // unit + 1
        assert len(rs) == n
        assert rs[0][0] == 0 and rs[-1][1] == length
        assert all(a[1] == b[0] for a, b in zip(rs, rs[1:]))
    for r in plan:
        assert r.size == r.end - r.start
        assert not (r.is_decompressible and r.is_partitionable)


def test_flags_options(spark):
    inv = _inv(spark)
    rows = {r.path: r for r in R.codec_flags(inv, decompression=False).collect()}
    assert rows["/a/y.csv.gz"].is_partitionable and not rows["/a/y.csv.gz"].is_decompressible
    rows = {r.path: r for r in R.codec_flags(inv, splittable=False).collect()}
    assert not any(r.is_partitionable for r in rows.values())


def test_regex_after_sizing(spark):
    inv = _inv(spark, INV + [("/b/big.csv", 10_000)])
    a = R.range_plan(inv, 10, path_regex="^/a/").collect()
    b = R.range_plan(inv, 10, path_regex="^/a/", filter_before_sizing=True).collect()
    assert {r.path_string for r in a} == {"/a/x.csv", "/a/y.csv.gz"}
    # sizing over matches only gives a smaller unit, so more ranges
    assert len(b) > len(a)
    assert R.range_plan(inv, 10, path_regex="nomatch").count() == 0


def test_all_empty_fails_when_asked(spark):
    inv = _inv(spark, [("/e1", 0), ("/e2", 0)])
    assert R.range_plan(inv, 4).count() == 0
    with pytest.raises(Exception, match="all files are empty"):
        R.range_plan(inv, 4, fail_if_empty=True).collect()


def test_invariants(spark):
    rows = [("/p", 0, 5, True, True, 0), ("/q", 3, 5, True, False, 0), (None, 0, 1, False, True, 0),
            ("/ok", 0, 9, False, True, 1)]
    df = spark.createDataFrame(rows, "path_string string, start long, end long, is_decompressible boolean, "
                                     "is_partitionable boolean, num_header_lines int")
    got = sorted((r.path_string or "", r.rule) for r in R.range_invariants(df).collect())
    assert got == [("", "field_absent"), ("/p", "decompressible_and_partitionable"),
                   ("/q", "decompressible_with_nonzero_start")]


def test_limits_index_last(spark):
    plan = R.range_plan(_inv(spark), 40)
    allr = sorted((r.path_string, r.start) for r in plan.collect())
    assert [(r.path_string, r.start) for r in R.range_limit(plan, 5).collect()] == allr[:5]
    big = R.range_limit(plan, 5)
    assert sorted((r.path_string, r.start) for r in big.collect()) == allr[:5]
    files = sorted({p for p, _ in allr})[:2]
    assert {r.path_string for r in R.file_limit(plan, 2).collect()} == set(files)
    assert {r.path_string for r in R.file_limit(plan, 2).collect()} == set(files)
    assert R.file_limit(plan, 0).count() == 0
    idx = with_global_index(plan, ["path_string", "start"], "i", num_partitions=3).collect()
    assert sorted((r.i, r.path_string, r.start) for r in idx) == [(i, p, s) for i, (p, s) in enumerate(allr)]
    last = R.last_range(plan).collect()
    assert (last[0].path_string, last[0].start) == allr[-1]


def test_unit_and_total(spark):
    u = R.unit_size(_inv(spark), 1000).first()
    assert u.total_bytes == 1597 and u.unit == 1
    assert R.total_size(_inv(spark)).first().total_bytes == 1597
    with pytest.raises(ValueError):
        R.unit_size(_inv(spark), 0)


def test_plan_explain_has_no_shuffle_of_inventory(spark):
    plan = R.range_plan(_inv(spark), 10)
    text = plan._jdf.queryExecution().executedPlan().toString()
    # the only exchange is inside the scalar subquery that sums the sizes
    main = text.split("Subquery")[0]
    assert "Exchange" not in main
    assert F is not None


def test_codec_list_per_deployment(spark):
    rows = {r.path: r for r in R.codec_flags(_inv(spark), codec_suffixes=(".gz",)).collect()}
    assert rows["/a/y.csv.gz"].is_decompressible
    assert not rows["/c/v.bz2"].is_decompressible and rows["/c/v.bz2"].is_partitionable


def test_ranges_of_a_long_input_do_not_overflow(spark):
    n, length = 200_000, 10**14 + 7
    rows = spark.createDataFrame([("f", length)], "path string, length long")
    g = R.explode_ranges(rows.selectExpr("path", "length", "200000L as n_ranges", "false as is_decompressible", "true as is_partitionable"))
    got = g.agg(F.count("*"), F.min("start"), F.max("end"), F.sum("size")).first()
    assert tuple(got) == (n, 0, length, length)
    k = 123_456
    r = g.where(F.col("start") == length * k // n).first()
    assert r["end"] == length * (k + 1) // n
