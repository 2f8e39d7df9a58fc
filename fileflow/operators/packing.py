"""Greedy packing of ordered items into tasks, and the task views.

Rule: walk the items of a group in order, add each to the open task; close the
task as soon as its running size reaches ``min_task_size``; a short tail is a
task of its own.  ``min_task_size`` <= 0 gives one item per task.

Distributed form (no group ever sits in one task):

1-2. one range-partitioned sort, then a streaming pass per slice with carries
   between slices (one summary row per slice): dense index, index in group,
   P = running size before each item, and each group's last row;
3. next(i) = 1 + first j >= i of the group with P_j + size_j >= P_i + m
   (an as-of search), or "end";
4. task starts = the chain first -> next -> next ... of every group: pointers
   are first compressed inside blocks of consecutive ids (numpy, one bounded
   block per group-by key), then pointer doubling on the compressed pointers
   (log2(blocks a chain crosses) rounds of balanced equi-joins, each round
   checkpointed; none when chains stay inside one block), then each block
   marks its chains from the reached entry nodes;
5. task id = number of starts up to the item, minus one (prefix count).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fileflow.operators.ordered import (
    BLOCK_ROWS,
    first_target_at_or_above,
    grouped_prefix_sums,
    indexed_running_sums,
)

END = -1


def _chain_starts(nodes: DataFrame, heads: DataFrame, rounds: int) -> DataFrame:
    """Nodes reachable from ``heads`` by following ``next`` (pointer doubling).

    ``nodes``: (node, next) with next = END at the tail; next(i) > i, so a
    chain never revisits a node.  S_0 = heads, S_{k+1} = S_k + J_k(S_k) with
    J_0 = next and J_{k+1} = J_k o J_k: after k rounds S_k holds the first 2^k
    links of every chain, so ``rounds`` >= log2(longest chain) suffices.  All
    joins are equi-joins on a unique node id; each round writes its new links
    and the next jump table in one checkpoint.
    """
    jump = nodes.select("node", F.col("next").alias("jump"))   # checkpointed by the caller
    reached = heads.select("node")          # a filter over a checkpointed table
    for k in range(rounds):
        step = (reached.join(jump, "node").where(F.col("jump") != END)
                       .select(F.col("jump").alias("node"), F.lit(None).cast("long").alias("jump"),
                               F.lit(0).alias("_kind")))
        if k + 1 < rounds:
            a, b = jump.alias("a"), jump.alias("b")
            j2 = (a.join(b, F.col("a.jump") == F.col("b.node"), "left")
                   .select(F.col("a.node").alias("node"),
                           F.when(F.col("a.jump") == END, F.lit(END)).otherwise(F.col("b.jump")).alias("jump"),
                           F.lit(1).alias("_kind")))
            step = step.unionByName(j2)
        both = step.checkpoint(eager=True)
        # a flat union of checkpointed pieces: the lineage stays one level deep
        reached = reached.unionByName(both.where(F.col("_kind") == 0).select("node"))
        jump = both.where(F.col("_kind") == 1).select("node", "jump")
    return reached


def _block_exit(table):
    """One block of consecutive node ids: keep ``next`` and add ``exit``, each
    node's first chain node outside the block (or END), by pointer doubling
    over numpy arrays (log2(block) vector steps)."""
    import numpy as np
    import pyarrow as pa

    node = table.column("node").to_numpy()
    nxt = table.column("next").to_numpy()
    order = np.argsort(node, kind="stable")
    node, nxt = node[order], nxt[order]
    f = nxt.copy()
    for _ in range(64):
        pos = np.minimum(np.searchsorted(node, f), len(node) - 1)
        inside = (f != END) & (node[pos] == f)
        if not inside.any():
            break
        f[inside] = f[pos[inside]]
    return pa.table({"node": pa.array(node, pa.int64()), "next": pa.array(nxt, pa.int64()),
                     "exit": pa.array(f, pa.int64())})


def _block_mark(table):
    """One block: every node on a chain from one of the block's sources, one
    step per task start (bounded by the block)."""
    import numpy as np
    import pyarrow as pa

    node = table.column("node").to_numpy()
    nxt = table.column("next").to_numpy()
    src = table.column("_src").to_numpy(zero_copy_only=False)
    order = np.argsort(node, kind="stable")
    node, nxt, src = node[order], nxt[order], src[order]
    mark = np.zeros(len(node), dtype=bool)
    for x in np.nonzero(src)[0]:
        while not mark[x]:
            mark[x] = True
            nx = nxt[x]
            p = int(np.searchsorted(node, nx))
            if nx == END or p >= len(node) or node[p] != nx:
                break
            x = p
    return pa.table({"node": pa.array(node[mark], pa.int64())})


def _rounds_needed(pre: DataFrame, group: list, size_col: str, m: int, block: int) -> int:
    """Doubling rounds for the compressed chains.  A chain has at most one
    node per block its group crosses, and at most one per task: a group of
    total size T has at most T div m + 1 tasks, and no more than items."""
    b = F.lit(int(block))
    per_group = (pre.groupBy(*group)
                    .agg(F.least(F.count(F.lit(1)),
                                 F.call_function("div", F.sum(size_col), F.lit(m)) + 1,
                                 F.call_function("div", F.max("_gi"), b)
                                 - F.call_function("div", F.min("_gi"), b) + 1).alias("_t")))
    bound = per_group.agg(F.max("_t")).first()[0] or 1
    return int(bound - 1).bit_length()


def task_pack(entries: DataFrame, group: list, order: list, size_col: str = "size",
              min_task_size: int = 0, num_partitions: int | None = None,
              block: int = BLOCK_ROWS, with_position: bool = False) -> DataFrame:
    """Add ``range_index`` (0-based position in its group) and ``task_id``
    (0-based per group) to every entry; with ``with_position`` also
    ``position_in_task`` (0-based position inside its task)."""
    group = list(group)
    cols = entries.columns
    extra = ["position_in_task"] if with_position else []
    m = int(min_task_size)
    if m <= 0:
        idx = indexed_running_sums(entries, group, order, {}, num_partitions)
        return (idx.withColumn("task_id", F.col("range_index"))
                   .withColumn("position_in_task", F.lit(0).cast("long"))
                   .select(*cols, "range_index", "task_id", *extra))
    pre, total = indexed_running_sums(entries, group, order, {"_p": size_col}, num_partitions,
                                      with_count=True)
    pre = pre.checkpoint(eager=True)
    queries = pre.select(*group, "_gi", (F.col("_p") + F.lit(m)).alias("value"))
    last = F.col("is_last")
    targets = pre.select(*group, "_gi", (F.col("_p") + F.col(size_col)).alias("value"),
                         F.when(last, F.lit(END)).otherwise(F.col("_gi") + 1).alias("_succ"))
    nxt = first_target_at_or_above(queries, targets, group, "_gi", "_succ", "_gi", num_partitions)
    nodes = nxt.select(F.col("_gi").alias("node"),
                       F.coalesce(F.col("_succ"), F.lit(END)).alias("next"))
    heads = pre.where(F.col("range_index") == 0).select(F.col("_gi").alias("node"))
    # blocks of consecutive ids (bounded, whatever the data's groups): compress
    # pointers inside each block, double on the compressed pointers only,
    # then mark the chains inside each block from its reached entry nodes
    blk = F.call_function("div", F.col("node"), F.lit(int(block))).alias("_blk")
    comp = (nodes.select("node", "next", blk).groupBy("_blk")
                 .applyInArrow(_block_exit, "node long, next long, exit long")).checkpoint(eager=True)
    # every id in one block: chains never leave it, no doubling round needed
    rounds = 0 if total <= block else _rounds_needed(pre, group, size_col, m, block)
    reached = _chain_starts(comp.select("node", F.col("exit").alias("next")), heads, rounds)
    tagged = (comp.join(reached.select("node", F.lit(True).alias("_src")), "node", "left")
                  .select("node", "next", F.coalesce("_src", F.lit(False)).alias("_src"), blk))
    starts = (tagged.groupBy("_blk").applyInArrow(_block_mark, "node long")
                    .select(F.col("node").alias("_gi"), F.lit(1).alias("_start")))
    marked = pre.join(starts, "_gi", "left").withColumn("_start", F.coalesce("_start", F.lit(0)))
    # task id = starts so far - 1; position = index - index of the task's start
    # (a running max of the start indexes), both in the same block-bounded pass
    first = F.when(F.col("_start") == 1, F.col("range_index")).otherwise(F.lit(-1))
    out = grouped_prefix_sums(marked, group, "_gi", {"task_id": "_start"}, inclusive=True,
                              maxima={"_task_first": first} if with_position else None)
    out = out.withColumn("task_id", F.col("task_id") - 1)
    if with_position:
        out = out.withColumn("position_in_task", F.col("range_index") - F.col("_task_first"))
    return out.select(*cols, "range_index", "task_id", *extra)


def task_summary(packed: DataFrame, group: list, size_col: str = "size") -> DataFrame:
    """Per task: entry count, total size, first and last range index (A3)."""
    return (packed.groupBy(*group, "task_id")
                  .agg(F.count(F.lit(1)).alias("n_entries"),
                       F.sum(size_col).cast("long").alias("task_size"),
                       F.min("range_index").alias("first_index"),
                       F.max("range_index").alias("last_index")))


def task_entries(packed: DataFrame, group: list, task_id: int | None = None) -> DataFrame:
    """Flat view of the task list: entries with their position inside the task.

    With ``task_id`` it is the lookup of one task (T5); order by
    ``position_in_task`` to read it in sequence.  Pack with
    ``with_position=True`` to get the position from the packing pass itself;
    otherwise it is the distance to the task's first index (a window per task,
    which is bounded by the minimum task size plus one piece).
    """
    out = packed
    if "position_in_task" not in packed.columns:
        w = Window.partitionBy(*group, "task_id")
        out = packed.withColumn("position_in_task", F.col("range_index") - F.min("range_index").over(w))
    if task_id is not None:
        out = out.where(F.col("task_id") == int(task_id))
    return out


def task_concat(packed: DataFrame, group: list, text_col: str) -> DataFrame:
    """One row per task: its pieces concatenated in order.

    A task closes once it reaches ``min_task_size``, so its text is bounded by
    that threshold plus one piece.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col("range_index"), F.col(text_col).alias("t"))))
    return (packed.groupBy(*group, "task_id")
                  .agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "").alias(text_col),
                       F.count(F.lit(1)).alias("n_pieces")))
