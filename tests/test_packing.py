import random

from brute import greedy_pack
from fileflow.operators.ordered import grouped_prefix_sums, with_global_index
from fileflow.operators.packing import task_concat, task_entries, task_pack, task_summary


def _entries(seed):
    rnd = random.Random(seed)
    rows = []
    for g, count in (("hot", 400), ("b", 37), ("c", 1), ("d", 120)):
        for i in range(count):
            rows.append((g, f"p{rnd.randint(0, 10**6):07d}", i, rnd.choice([0, 1, 5, 50, 300, 999])))
    return rows


def test_pack_matches_greedy(spark):
    rows = _entries(7)
    df = spark.createDataFrame(rows, "g string, path string, start long, size long")
    for m, block in ((0, 65536), (1, 65536), (250, 65536), (5000, 65536), (1, 7), (250, 16), (5000, 3)):
        packed = task_pack(df, ["g"], ["path", "start"], "size", m, num_partitions=5, block=block).collect()
        got = {(r.g, r.path, r.start): (r.range_index, r.task_id) for r in packed}
        for g in {r[0] for r in rows}:
            items = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
            want = greedy_pack([r[3] for r in items], m)
            for i, (r, t) in enumerate(zip(items, want)):
                assert got[(r[0], r[1], r[2])] == (i, t), (m, g, i)


def test_task_views(spark):
    rows = _entries(8)
    df = spark.createDataFrame(rows, "g string, path string, start long, size long")
    packed = task_pack(df, ["g"], ["path", "start"], "size", 1000)
    summ = {(r.g, r.task_id): r for r in task_summary(packed, ["g"]).collect()}
    last_task = {}
    for (g, t), r in summ.items():
        assert r.last_index - r.first_index + 1 == r.n_entries
        last_task[g] = max(last_task.get(g, -1), t)
    # every task but a group's last reaches the minimum; tasks follow the order
    for (g, t), r in summ.items():
        if t < last_task[g]:
            assert r.task_size >= 1000
    firsts = sorted((g, r.first_index, t) for (g, t), r in summ.items())
    for a, b in zip(firsts, firsts[1:]):
        if a[0] == b[0]:
            assert a[2] < b[2]
    ent = task_entries(packed, ["g"], task_id=0).collect()
    assert all(r.task_id == 0 for r in ent)
    assert sorted(r.position_in_task for r in ent if r.g == "hot") == list(range(summ[("hot", 0)].n_entries))
    txt = packed.withColumn("t", packed.path)
    cat = {(r.g, r.task_id): r.t for r in task_concat(txt, ["g"], "t").collect()}
    for g in {r[0] for r in rows}:
        items = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        tasks = greedy_pack([r[3] for r in items], 1000)
        for t in set(tasks):
            assert cat[(g, t)] == "".join(r[1] for r, tt in zip(items, tasks) if tt == t)


def test_global_index_and_prefix(spark):
    rows = [(f"k{i % 13}", (i * 7919) % 1000, i % 3) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    idx = with_global_index(df, ["k", "o"], "ix", num_partitions=7)
    got = sorted((r.k, r.o, r.ix) for r in idx.collect())
    want = sorted(rows, key=lambda r: (r[0], r[1]))
    assert [g[2] for g in got] == list(range(len(rows)))
    assert [(g[0], g[1]) for g in got] == [(w[0], w[1]) for w in want]
    ps = grouped_prefix_sums(idx, ["k"], "ix", {"cum": "v"}, inclusive=True, totals={"tot": "cum"}, block=16)
    res = sorted((r.k, r.ix, r.v, r.cum, r.tot) for r in ps.collect())
    run, tot = {}, {}
    for k, o, v in want:
        tot[k] = tot.get(k, 0) + v
    for k, ix, v, cum, t in res:
        run[k] = run.get(k, 0) + v
        assert cum == run[k] and t == tot[k]


def test_indexed_running_sums_across_slices(spark):
    import random

    from pyspark.sql import functions as F

    from fileflow.operators.ordered import indexed_running_sums

    rnd = random.Random(3)
    rows = []
    for g, cnt in (("hot", 1500), ("b", 37), ("c", 1), ("d", 600), ("e", 2)):
        for i in range(cnt):
            rows.append((g, i, rnd.choice([0, 1, 5, 50, 300, None])))
    df = spark.createDataFrame(rows, "g string, o long, size long")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        for parts in (None, 1, 3, 17):
            res = indexed_running_sums(df, ["g"], ["o"], {"_p": F.coalesce("size", F.lit(0))}, parts).collect()
            assert sorted(r._gi for r in res) == list(range(len(rows)))
            got = {(r.g, r.o): (r.range_index, r._p, r.is_last, r.size) for r in res}
            for g in {r[0] for r in rows}:
                items = sorted((r for r in rows if r[0] == g), key=lambda r: r[1])
                acc = 0
                for i, r in enumerate(items):
                    assert got[(g, r[1])] == (i, acc, i == len(items) - 1, r[2])
                    acc += r[2] or 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_empty_inputs(spark):
    df = spark.createDataFrame([], "g string, path string, start long, size long")
    assert task_pack(df, ["g"], ["path", "start"], "size", 100).count() == 0
    assert task_pack(df, ["g"], ["path", "start"], "size", 0).count() == 0
    assert with_global_index(df, ["g", "path"], "i").count() == 0


def test_position_in_task(spark):
    rows = _entries(9)
    df = spark.createDataFrame(rows, "g string, path string, start long, size long")
    for m, block in ((700, 65536), (700, 5), (0, 65536)):
        a = task_pack(df, ["g"], ["path", "start"], "size", m, with_position=True, block=block)
        b = task_entries(task_pack(df, ["g"], ["path", "start"], "size", m), ["g"])
        ga = sorted((r.g, r.range_index, r.task_id, r.position_in_task) for r in a.collect())
        gb = sorted((r.g, r.range_index, r.task_id, r.position_in_task) for r in b.collect())
        assert ga == gb


def test_null_and_microsecond_group_keys(spark):
    import datetime as dt

    rows = [("a" if i < 5 else None, i, 10) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, i long, size long")
    got = task_pack(df, ["g"], ["i"], "size", 20).collect()
    assert len(got) == 10 and sum(r["g"] is None for r in got) == 5
    base = dt.datetime(2024, 1, 1)
    ts = spark.createDataFrame([(base + dt.timedelta(microseconds=100 * (i // 3)), i, 10) for i in range(6)], "g timestamp_ntz, i long, size long")
    assert sorted((r["i"], r["range_index"]) for r in task_pack(ts, ["g"], ["i"], "size", 20).collect()) == [
        (0, 0), (1, 1), (2, 2), (3, 0), (4, 1), (5, 2)]
