"""The catalogue, and the pipeline's stages on planted and odd documents."""

import importlib
import random

from pyspark.sql import functions as F

import corpus_pipeline as C
from conftest import SF
from fileflow.llm.common import saved

ORDER = ["toxicity", "line dedup", "SimHash near-dedup", "benchmark decontamination", "mixing"]


def test_catalogue_has_all_queries():
    e = importlib.import_module("__spark_entry__")
    names = [n for n in e.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in e.queries() and set(e.oracle_sql()) <= set(e.queries())


def _planted(spark):
    """Documents of the smoke table, with an exact copy, a near copy, a benchmark passage, a shared passage and toxic words."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    base, shared = text(900), text(60)
    rows = [(10_000, base), (10_001, base), (10_002, base.replace(" ", "  ")), (10_003, base + " " + word()), (10_004, f"{text(40)} {item} {text(40)}"),
            (10_005, text(80) + "\n" + shared + "\n" + text(80)), (10_006, text(70) + "\n" + shared + "\n" + text(90)), (10_007, text(200)),
            (None, None), (10_008, ""), (10_007, text(150)), (10_007, "x y z")]
    new = spark.createDataFrame([(d, t, "en", "planted", 0) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return spark.read.parquet(f"{SF}/documents.parquet").union(new).withColumn("score", F.lit("own")).withColumn("n_hit", F.lit(1))


def test_stages_on_planted_documents(spark):
    assert [n for n, _ in C.STAGES] == ORDER
    docs, kept = _planted(spark), {}
    columns = docs.columns
    for name, stage in C.STAGES:
        docs = saved(stage(spark, docs, SF), "test-stage")
        kept[name] = {}
        for r in docs.collect():
            kept[name].setdefault(r["doc_id"], []).append(r)
        if name != "mixing":
            assert docs.columns == columns
    lines = kept["line dedup"]
    assert lines[10_001][0]["text"] == "" == lines[10_002][0]["text"] and lines[10_000][0]["n_chars"] == len(lines[10_000][0]["text"]) > 0
    assert lines[10_005][0]["text"].count("\n") == 2 and lines[10_006][0]["text"].count("\n") == 1  # the later passage goes
    near = kept["SimHash near-dedup"]
    assert 10_000 in near and len({10_001, 10_002, 10_003, 10_008} & set(near)) <= 1
    clean = kept["benchmark decontamination"]
    assert 10_004 in near and 10_004 not in clean
    assert {10_005, 10_006, 10_007} <= set(clean) and len(clean[10_007]) == len(lines[10_007])
    assert all(0 < r["taken"] <= 3 * r["size"] for rs in kept["mixing"].values() for r in rs)


def test_stages_on_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        docs = saved(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0


def test_run_is_the_stages_one_after_another(spark):
    rows = C.run(spark, SF)
    again = C.run(spark, SF)
    key = lambda df: sorted((r["doc_id"], r["taken"]) for r in df.collect())
    assert key(rows) == key(again) != []
