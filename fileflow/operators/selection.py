"""The first K rows of an order without sorting them (A5).

Up to ``IN_TASK`` rows Spark's own top-K does it: every task keeps its K
smallest.  Beyond that the K-th key is selected: a sample of keys gives
splitters, one aggregate counts the rows up to each, and the slice between
two splitters that holds the K-th row is looked at again, until it fits a task
and is sorted there.  The first K rows are then a filter on one key, map-only.
No pass shuffles the rows, and none sorts more than a slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that one task may sort.
IN_TASK = 100_000
SPLITTERS = 24


def _key(order) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _literal(df: DataFrame, order, row) -> Column:
    types = {f.name: f.dataType for f in df.schema}
    return F.struct(*[F.lit(row[c]).cast(types[c]).alias(c) for c in order])


def kth_key(df: DataFrame, order, k: int, in_task: int = IN_TASK, seed: int = 17):
    """(key, rows before it, rows equal to it) of the K-th row by ``order`` (column names, ascending), or None if there are fewer."""
    order = list(order)
    keys = df.select(*order)
    n, before = keys.count(), 0
    if k <= 0 or n < k:
        return None
    part = keys
    while n > in_task:
        rows = part.sample(fraction=min(1.0, 40 * SPLITTERS / n), seed=seed).collect()
        rows.sort(key=lambda r: [(r[c] is not None, r[c]) if r[c] is not None else (False,) for c in order])
        seed += 1
        picked = []
        for i in range(1, SPLITTERS + 1):
            if rows and (row := rows[len(rows) * i // (SPLITTERS + 1)]) not in picked[-1:]:
                picked.append(row)
        if not picked:  # an empty sample: draw again
            continue
        at = [_literal(part, order, row) for row in picked]
        counts = part.agg(*[F.count_if(_key(order) < x).alias(f"l{i}") for i, x in enumerate(at)],
                          *[F.count_if(_key(order) <= x).alias(f"u{i}") for i, x in enumerate(at)]).first()
        low, taken, narrowed = None, 0, part
        for i, row in enumerate(picked):
            less, upto = counts[f"l{i}"], counts[f"u{i}"]
            if before + less < k <= before + upto:
                return row, before + less, upto - less
            if before + less >= k:
                narrowed, n = narrowed.where(_key(order) < at[i]), less - taken
                break
            low, taken = at[i], upto
        else:
            n -= taken
        if low is not None:
            narrowed = narrowed.where(_key(order) > low)
        part, before = narrowed, before + taken
    row = part.orderBy(*order).limit(k - before).agg(F.max(_key(order)).alias("k")).first()["k"]
    counts = part.agg(F.count_if(_key(order) < _literal(part, order, row)).alias("l"),
                      F.count_if(_key(order) <= _literal(part, order, row)).alias("u")).first()
    return row, before + counts["l"], counts["u"] - counts["l"]


def first_rows(df: DataFrame, order, k: int, in_task: int = IN_TASK) -> DataFrame:
    """The first ``k`` rows of ``df`` by ``order`` (column names, ascending); of rows with equal keys any."""
    if k <= in_task:
        return df.orderBy(*order).limit(max(int(k), 0))
    found = kth_key(df, order, k, in_task)
    if found is None:
        return df
    row, before, equal = found
    key = _literal(df, order, row)
    if before + equal == k:
        return df.where(_key(order) <= key)
    # more rows than wanted have the K-th key: they are numbered
    from fileflow.operators.ordered import with_global_index

    tied = with_global_index(df.where(_key(order).eqNullSafe(key)), list(order), "_idx").where(F.col("_idx") < k - before).drop("_idx")
    return df.where(_key(order) < key).unionByName(tied)
