"""Order-dependent primitives that stay distributed.

None of these puts a whole group in one task: a group (a source, a path) may
hold a third of all rows.  They rely on range partitioning (contiguous, balanced
slices of one global order) and on bounded blocks of that order:

* ``with_global_index``   dense 0-based index in an order (A6)
* ``grouped_prefix_sum``  running sums per group, windows bounded by a block size
* ``first_target_at_or_above``  as-of search: first target >= a query value

Only tables with at most one row per partition ever meet in one task (the
partition offsets), and those are broadcast: their size is bounded by the
partition count, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fileflow.functions.text import idiv

#: Group keys as text keep every microsecond and tell null from a missing field.
EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
         "ignoreNullFields": "false"}
BLOCK_ROWS = 65536


def sorted_slices(df: DataFrame, order: list, num_partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by ``order``; tag rows with ``_pid`` (slice id)
    and ``_pos`` (position inside the slice); checkpoint so that both tags are
    fixed for every later use and the lineage is cut (reliable storage under
    spark.checkpoint.dir, so lost executors do not change the result)."""
    from fileflow.session import shared_dir

    shared_dir(df.sparkSession)
    # Without a count AQE sizes the slices: adjacent ranges are merged in order
    # up to the advisory partition size, so a slice is bounded by that size
    # and small inputs do not pay for hundreds of empty slices.
    parted = df.repartitionByRange(int(num_partitions), *order) if num_partitions \
        else df.repartitionByRange(*order)
    s = (parted.sortWithinPartitions(*order)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_pos", F.monotonically_increasing_id()
                       - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    return s.checkpoint(eager=True)


def _offsets(counts: DataFrame, value: str, out: str) -> DataFrame:
    """Exclusive running total over at most one row per slice."""
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_pid", F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long").alias(out))


def with_global_index(df: DataFrame, order: list, name: str = "index",
                      num_partitions: int | None = None) -> DataFrame:
    """Append a dense 0-based index in ``order`` without an unpartitioned window."""
    s = sorted_slices(df, order, num_partitions)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    off = F.broadcast(_offsets(counts, "_n", "_off"))
    return (s.join(off, "_pid")
             .select(*df.columns, (F.col("_off") + F.col("_pos")).alias(name)))


def grouped_prefix_sums(df: DataFrame, group: list, idx: str, values: dict,
                        inclusive: bool = False, totals: dict | None = None,
                        block: int = BLOCK_ROWS, maxima: dict | None = None) -> DataFrame:
    """Running sums per group in ``idx`` order, several columns in one pass.

    ``values`` maps output name -> column (or name).  Rows are cut into blocks
    of ``block`` consecutive indexes: block totals get their offsets from a
    window over blocks (a group of N rows has N/block of them), rows get the
    rest from a window inside their block (at most ``block`` rows).  One
    shuffle of the rows, on (group, block); the block table is small.
    ``totals`` maps output name -> value name for whole-group sums.
    ``maxima`` maps output name -> column for running maxima (always
    inclusive), computed in the same pass.
    """
    names, mnames = list(values), list(maxima or {})
    x = df.withColumn("_blk", idiv(F.col(idx), F.lit(int(block))))
    for i, n in enumerate(names):
        v = values[n]
        x = x.withColumn(f"_v{i}", (F.col(v) if isinstance(v, str) else v).cast("long"))
    for i, n in enumerate(mnames):
        v = maxima[n]
        x = x.withColumn(f"_m{i}", (F.col(v) if isinstance(v, str) else v).cast("long"))
    t = x.groupBy(*group, "_blk").agg(*[F.sum(f"_v{i}").alias(f"_bt{i}") for i in range(len(names))],
                                      *[F.max(f"_m{i}").alias(f"_bm{i}") for i in range(len(mnames))])
    wb = Window.partitionBy(*group).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    wall = Window.partitionBy(*group)
    tot_cols = [F.sum(f"_bt{names.index(v)}").over(wall).cast("long").alias(o)
                for o, v in (totals or {}).items()]
    boff = t.select(*group, "_blk",
                    *[F.coalesce(F.sum(f"_bt{i}").over(wb), F.lit(0)).alias(f"_bo{i}")
                      for i in range(len(names))],
                    *[F.max(f"_bm{i}").over(wb).alias(f"_bx{i}") for i in range(len(mnames))],
                    *tot_cols)
    wr = Window.partitionBy(*group, "_blk").orderBy(idx).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    wm = Window.partitionBy(*group, "_blk").orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    # null-safe: rows without a group key are a group too
    keys = [*group, "_blk"]
    boff = boff.withColumnsRenamed({g: f"_b_{g}" for g in keys})
    same = F.lit(True)
    for g in keys:
        same = same & x[g].eqNullSafe(boff[f"_b_{g}"])
    out = x.join(boff, same).drop(*[f"_b_{g}" for g in keys])
    for i, n in enumerate(names):
        out = out.withColumn(n, (F.col(f"_bo{i}") + F.coalesce(F.sum(f"_v{i}").over(wr), F.lit(0)))
                             .cast("long"))
    for i, n in enumerate(mnames):
        out = out.withColumn(n, F.greatest(F.col(f"_bx{i}"), F.max(f"_m{i}").over(wm)).cast("long"))
    drop = (["_blk"] + [f"_v{i}" for i in range(len(names))] + [f"_bo{i}" for i in range(len(names))]
            + [f"_m{i}" for i in range(len(mnames))] + [f"_bx{i}" for i in range(len(mnames))])
    return out.drop(*drop)


def grouped_prefix_sum(df: DataFrame, group: list, idx: str, value, out: str,
                       inclusive: bool = False, block: int = BLOCK_ROWS) -> DataFrame:
    """Running sum of one column per group (see ``grouped_prefix_sums``)."""
    return grouped_prefix_sums(df, group, idx, {out: value}, inclusive, None, block)


def first_target_at_or_above(queries: DataFrame, targets: DataFrame, group: list,
                             qid: str, payload: str, tiebreak: str | None = None,
                             num_partitions: int | None = None) -> DataFrame:
    """As-of search.  ``queries``: group cols, ``qid``, ``value``.  ``targets``:
    group cols, ``value``, ``payload``.  Returns (qid, payload) where payload
    belongs to the first target of the same group with value >= the query's
    value (ties: the target; among targets of equal value, the smallest
    ``tiebreak``), or null when there is none.

    Queries and targets are merged in one global (group, value) order cut in
    balanced slices.  Inside a slice a window finds the next target; a query
    with none left in its slice takes the first target of the following slices,
    from a table with one row per slice.
    """
    q = queries.select(*group, "value", F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_tb"),
                       F.col(qid).alias("_qid"), F.lit(None).cast("long").alias("_pay"))
    tb = F.col(tiebreak).cast("long") if tiebreak else F.lit(0).cast("long")
    t = targets.select(*group, "value", F.lit(1).alias("_kind"), tb.alias("_tb"),
                       F.lit(None).cast("long").alias("_qid"), F.col(payload).cast("long").alias("_pay"))
    order = [*group, "value", "_kind", "_tb"]
    s = sorted_slices(q.unionByName(t), order, num_partitions)
    # first target of each slice, then the first one in any later slice
    firsts = (s.where(F.col("_kind") == 1).groupBy("_pid")
               .agg(F.min_by(F.struct(*[F.col(g).alias("_c_" + g) for g in group], F.col("_pay").alias("_c_pay")),
                             F.struct(*order)).alias("_f")))
    slices = s.select("_pid").distinct()
    # "first non-null at or after" is computed as "last non-null up to here" in
    # descending order: frames that start at UNBOUNDED PRECEDING are
    # incremental, frames that end at UNBOUNDED FOLLOWING are recomputed per row
    wl = Window.orderBy(F.col("_pid").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = (slices.join(firsts, "_pid", "left")
             .select("_pid", F.last("_f", ignorenulls=True).over(wl).alias("_carry")))
    carry = F.broadcast(carry)
    wf = Window.partitionBy("_pid", *group).orderBy(F.col("_pos").desc()).rowsBetween(
        Window.unboundedPreceding, 0)
    local = s.withColumn("_next", F.last("_pay", ignorenulls=True).over(wf)).where(F.col("_kind") == 0)
    same = F.lit(True)
    for g in group:
        same = same & F.col("_carry._c_" + g).eqNullSafe(F.col(g))
    res = local.join(carry, "_pid", "left").select(
        F.col("_qid").alias(qid),
        F.coalesce(F.col("_next"), F.when(same, F.col("_carry._c_pay"))).alias(payload))
    return res


# ---------------------------------------------------------------- ordered scan with carries

def _segments(keys):
    """Start flags of runs of equal keys (null-safe, keys are strings)."""
    import numpy as np

    k = keys.to_numpy(dtype=object)
    start = np.ones(len(k), dtype=bool)
    if len(k) > 1:
        start[1:] = k[1:] != k[:-1]
    return start


def _summarize(nv: int):
    """Pass 1: one row per slice with its row count and its first and last
    group runs (key, rows, sums)."""
    import numpy as np
    import pyarrow as pa

    def fn(batches):
        pid, n = None, 0
        first = None            # [key, rows, sums] of the slice's first run
        last = None             # the run open at the end of what was seen
        first_closed = False
        for rb in batches:
            if rb.num_rows == 0:
                continue
            pdf = rb.to_pandas()
            pid = int(pdf["_pid"].iloc[0])
            n += len(pdf)
            start = _segments(pdf["_gk"])
            seg = np.cumsum(start) - 1
            vals = pdf[[f"_v{i}" for i in range(nv)]].to_numpy(dtype=np.int64).reshape(len(pdf), nv)
            sums = np.zeros((seg[-1] + 1, nv), dtype=np.int64)
            np.add.at(sums, seg, vals)
            cnt = np.bincount(seg)
            keys = pdf["_gk"].to_numpy(dtype=object)[start]
            for j in (0, len(cnt) - 1) if len(cnt) > 1 else (0,):
                run = [keys[j], int(cnt[j]), sums[j].copy()]
                if j == 0 and last is not None and last[0] == run[0]:
                    last[1] += run[1]
                    last[2] += run[2]
                    continue
                if last is not None and not first_closed:
                    first_closed = True
                last = run
                if first is None:
                    first = last
            if len(cnt) > 1 and not first_closed:
                first_closed = True
        if pid is None:
            return
        yield pa.RecordBatch.from_pylist([{
            "_pid": pid, "n": n, "fk": first[0], "fn": first[1], "fs": [int(x) for x in first[2]],
            "lk": last[0], "ln": last[1], "ls": [int(x) for x in last[2]],
            "single": (not first_closed) and first is last}],
            schema=pa.schema([("_pid", pa.int32()), ("n", pa.int64()), ("fk", pa.string()),
                              ("fn", pa.int64()), ("fs", pa.list_(pa.int64())), ("lk", pa.string()),
                              ("ln", pa.int64()), ("ls", pa.list_(pa.int64())), ("single", pa.bool_())]))

    return fn


def _carries(rows: list, nv: int) -> dict:
    """Per slice: global row offset, the carried (rows, sums) of its first
    group from earlier slices, and whether its last group goes on after it.
    ``rows`` has one entry per non-empty slice (bounded by the slice count);
    one forward pass keeps the run open at the end of each slice."""
    rows = sorted(rows, key=lambda r: r["_pid"])
    out, off = {}, 0
    open_key, open_n, open_s = None, 0, [0] * nv
    for i, r in enumerate(rows):
        if open_key is not None and open_key == r["fk"]:
            cn, cs = open_n, list(open_s)
        else:
            cn, cs = 0, [0] * nv
        goes_on = i + 1 < len(rows) and rows[i + 1]["fk"] == r["lk"]
        out[r["_pid"]] = (off, cn, cs, goes_on)
        off += r["n"]
        if r["single"]:
            open_key, open_n, open_s = r["fk"], cn + r["fn"], [a + b for a, b in zip(cs, r["fs"])]
        else:
            open_key, open_n, open_s = r["lk"], r["ln"], list(r["ls"])
    return out


def _scan_with_carries(carry: dict, nv: int, names: list):
    """Pass 2: dense index, index in group, exclusive running sums and last-row
    flag, streaming through the slice with the carries of pass 1.  Input
    columns pass through as Arrow arrays, untouched."""
    import numpy as np
    import pyarrow as pa

    vcols = [f"_v{i}" for i in range(nv)]

    def emit(batch, last_flags):
        return batch.append_column("is_last", pa.array(last_flags, pa.bool_()))

    def fn(batches):
        run_key, run_n, run_s = None, 0, np.zeros(nv, dtype=np.int64)
        pending = None              # last row of the previous batch, flag not known yet
        goes_on = False
        for rb in batches:
            if rb.num_rows == 0:
                continue
            pid = rb.column("_pid")[0].as_py()
            off, cn, cs, goes_on = carry[pid]
            keys = rb.column("_gk").to_numpy(zero_copy_only=False)
            if run_key is None:     # first batch of the slice: carry of earlier slices
                run_key, run_n, run_s = keys[0], cn, np.array(cs, dtype=np.int64)
            m = rb.num_rows
            start = np.ones(m, dtype=bool)
            start[1:] = keys[1:] != keys[:-1]
            seg = np.cumsum(start) - 1
            idx = np.arange(m)
            seg_first = np.maximum.accumulate(np.where(start, idx, 0))
            cont = keys[0] == run_key
            first_seg = seg == 0
            rank = (idx - seg_first).astype(np.int64)
            if cont:
                rank[first_seg] += run_n
            out = rb.drop_columns(vcols)
            out = out.append_column("_gi", pa.array(off + rb.column("_pos").to_numpy().astype(np.int64)))
            out = out.append_column("range_index", pa.array(rank))
            tail = seg == seg[-1]
            tail_sums = np.zeros(nv, dtype=np.int64)
            for i, name in enumerate(names):
                v = rb.column(vcols[i]).to_numpy().astype(np.int64)
                cum = np.cumsum(v)
                ex = cum - v
                ex = ex - ex[seg_first]
                if cont:
                    ex[first_seg] += run_s[i]
                out = out.append_column(name, pa.array(ex))
                tail_sums[i] = v[tail].sum()
            if seg[-1] == 0 and cont:
                run_n, run_s = run_n + int(tail.sum()), run_s + tail_sums
            else:
                run_n, run_s = int(tail.sum()), tail_sums
            run_key = keys[-1]
            flags = np.zeros(m, dtype=bool)
            flags[:-1] = keys[1:] != keys[:-1]
            if pending is not None:
                yield emit(pending, [pending_key != keys[0]])
            pending, pending_key = out.slice(m - 1, 1), keys[-1]
            if m > 1:
                yield emit(out.slice(0, m - 1), flags[:-1])
        if pending is not None:
            yield emit(pending, [not goes_on])

    return fn


def indexed_running_sums(df: DataFrame, group: list, order: list, sums: dict,
                         num_partitions: int | None = None, with_count: bool = False):
    """One range-partitioned sort and two map passes, no further shuffle.

    Adds ``_gi`` (dense index in (group, order)), ``range_index`` (index inside
    the group), exclusive running sums per group for each ``sums`` entry
    (name -> column) and ``is_last`` (last row of its group).  Groups may span
    any number of slices: the first pass summarises each slice's first and last
    runs (one row per slice), the carries between slices follow from those
    rows, and the second pass streams every slice with its carry.
    With ``with_count`` returns ``(df, total rows)``, known from pass 1.
    """
    names = list(sums)
    nv = len(names)
    cols = df.columns
    base = df.select(*cols, F.to_json(F.struct(*[F.col(g) for g in group]), EXACT).alias("_gk"),
                     *[(F.col(v) if isinstance(v, str) else v).cast("long").alias(f"_v{i}")
                       for i, v in enumerate(sums.values())])
    s = sorted_slices(base, [*group, *order], num_partitions)
    summ = s.select("_pid", "_gk", *[f"_v{i}" for i in range(nv)]).mapInArrow(
        _summarize(nv), "_pid int, n long, fk string, fn long, fs array<long>, lk string, ln long, "
                        "ls array<long>, single boolean")
    summary = [r.asDict() for r in summ.collect()]
    carry = _carries(summary, nv)
    out_schema = s.select(*cols, "_gk", "_pid", "_pos").schema
    from pyspark.sql.types import BooleanType, LongType, StructField, StructType
    out_schema = StructType(list(out_schema.fields)
                            + [StructField("_gi", LongType()), StructField("range_index", LongType())]
                            + [StructField(n, LongType()) for n in names]
                            + [StructField("is_last", BooleanType())])
    res = s.select(*cols, "_gk", "_pid", "_pos", *[f"_v{i}" for i in range(nv)]).mapInArrow(
        _scan_with_carries(carry, nv, names), out_schema)
    res = res.drop("_gk", "_pid", "_pos")
    return (res, sum(r["n"] for r in summary)) if with_count else res
