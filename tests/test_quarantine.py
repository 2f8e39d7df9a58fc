"""Good and bad rows of a batch: one write, counts, places, retries."""

import pytest

from fileflow.sources import quarantine as Q
from fileflow.sources.delimited import Col

COLS = [Col("id", "long"), Col("name")]


def test_rows_places_counts_and_retries(spark, tmpdir_path):
    texts = {"a.csv": "id,name\n1,x\noops,y\n\n2\n3,z,more\r\n4,w", "b.csv": "id,name\n5,é\nfive,ü"}
    for name, text in texts.items():
        with open(f"{tmpdir_path}/{name}", "w", newline="", encoding="utf-8") as f:
            f.write(text)
    out = tmpdir_path + "-out"
    lines = Q.placed_lines(spark, tmpdir_path, header_lines=1)
    want = {"good": 3, "bad": 4, "missing_columns": 1, "extra_columns": 1, "bad_value": 2}
    for _ in range(2):
        assert Q.write_rows(lines, COLS, out, 7) == want
    good = Q.good_rows(spark, out, "id long, name string").collect()
    assert sorted((r["id"], r["name"], r["batch"]) for r in good) == [(1, "x", 7), (4, "w", 7), (5, "é", 7)]
    bad = Q.bad_rows(spark, out).collect()
    assert sorted((r["line"], r["reason"]) for r in bad) == [
        ("2", "missing_columns"), ("3,z,more", "extra_columns"), ("five,ü", "bad_value"), ("oops,y", "bad_value")]
    for r in bad:  # the place leads back to the line
        data = texts[r["path"].rsplit("/", 1)[1]].encode()
        assert data[r["line_start"]: r["line_start"] + r["line_bytes"]].decode().rstrip("\r\n") == r["line"]
    # another try without bad rows leaves none behind; another batch stands beside it
    assert Q.write_rows(lines.where("value like '%,x'"), COLS, out, 7)["good"] == 1
    Q.write_rows(lines, COLS, out, 8, allow_optional_columns=True, allow_extra_columns=True)
    assert Q.bad_rows(spark, out).where("batch = 7").count() == 0
    assert Q.bad_rows(spark, out).where("batch = 8").count() == 2
    assert Q.good_rows(spark, out, "id long, name string").count() == 1 + 5


def test_no_rows_no_places_and_names(spark, tmpdir_path):
    empty = spark.createDataFrame([], "value string")
    assert set(Q.write_rows(empty, COLS, tmpdir_path + "/e", 0).values()) == {0}
    lines = spark.createDataFrame([("x,1",)], "value string")
    assert Q.write_rows(lines, COLS, tmpdir_path + "/n", 0)["bad"] == 1
    assert [(r["line"], r["path"]) for r in Q.bad_rows(spark, tmpdir_path + "/n").collect()] == [("x,1", None)]
    with pytest.raises(ValueError, match="taken"):
        Q.write_rows(lines, [Col("_reason")], tmpdir_path + "/c", 0)
