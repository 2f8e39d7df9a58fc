import os

from fileflow.session import scratch_path
from fileflow.sources.delimited import Col
from fileflow.streaming import ingest_new_files


def _put(d, name, text):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


def test_second_run_reads_only_new_files(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    out = scratch_path(spark, "ingest-out")
    ck = scratch_path(spark, "ingest-ck")
    cols = [Col("id", "long"), Col("name")]
    _put(src, "a.csv", "1,a\n2,b\n")
    ingest_new_files(spark, src, cols, out, ck)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2]
    _put(src, "b.csv", "3,c\n")
    ingest_new_files(spark, src, cols, out, ck)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]
