"""Selection of the first K rows against sorting."""

import random

import pytest
from pyspark.sql import functions as F

from fileflow.operators.ranges import file_limit, range_limit
from fileflow.operators.selection import first_rows, kth_key


def rows_of(seed, n, paths):
    rng = random.Random(seed)
    return [(rng.choice(paths), rng.choice([None, *range(6)]), i) for i in range(n)]


def key(r):
    return [(x is not None, x if x is not None else 0) for x in r[:2]]


@pytest.mark.parametrize("k", [1, 40, 41, 700, 1500, 2999, 3000, 3001])
def test_first_rows_without_a_sort(spark, k):
    # a third of all rows have one key; some have null parts
    rows = rows_of(3, 2000, [f"p{i}" for i in range(50)]) + [("p2", 3, 9)] * 1000
    df = spark.createDataFrame(rows, "path string, start int, x int").repartition(6)
    got = [tuple(r) for r in first_rows(df, ["path", "start"], k, in_task=40).collect()]
    want = sorted(map(key, rows))[:k]
    assert sorted(map(key, got)) == want
    found = kth_key(df, ["path", "start"], k, in_task=40)
    if k > len(rows):
        assert found is None
    else:
        row, before, equal = found
        assert key(tuple(row)) == want[-1] and before == sum(x < want[-1] for x in map(key, rows)) and before < k <= before + equal


def test_far_more_rows_than_a_task_sorts(spark):
    df = spark.range(300_000).select(F.concat(F.lit("f"), F.lpad((F.col("id") * 7919 % 300_000).cast("string"), 6, "0")).alias("path_string"),
                                     (F.col("id") % 3).alias("start"))
    got = range_limit(df, 250_000)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()  # a filter on one key
    assert got.agg(F.count("*"), F.max("path_string")).first() == (250_000, "f249999")
    assert file_limit(df, 200_000).agg(F.count("*"), F.max("path_string")).first() == (200_000, "f199999")


def test_limits_have_no_full_sort(spark):
    df = spark.createDataFrame([(f"p{i}", i % 4) for i in range(100)], "path_string string, start int")
    assert range_limit(df, 0).count() == 0 and file_limit(df, 0).count() == 0
    assert range_limit(df, 1000).count() == 100 and file_limit(df, 1000).count() == 100
    plan = range_limit(df, 7)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
    assert [r["path_string"] for r in range_limit(df, 3).collect()] == ["p0", "p1", "p10"]
    assert {r["path_string"] for r in file_limit(df, 3).collect()} == {"p0", "p1", "p10"}
