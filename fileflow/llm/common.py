"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.session import scratch_path, ship_package

#: Rows of a batch that Python code holds as objects at once (texts may be long).
STEP = 512

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of the folder, read by Spark (any file system)."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser of a uint64 array (wraps by design)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def without(df: DataFrame, names) -> DataFrame:
    """``df`` without the columns that an operator is about to add."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def chunks(batch: pa.RecordBatch, step: int = STEP):
    """The batch in slices of at most ``step`` rows."""
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def saved(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors.

    ``by`` names columns whose values get folders of their own, so that readers of one skip the others.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id, mod: int, rest: int):
    """Whether crc32 of the id as text leaves ``rest`` modulo ``mod``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod == rest, F.lit(False))
