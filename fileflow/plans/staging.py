"""Files derived from the driver's tables, written by Spark for the scan queries.

Scans need files; test data is parquet and read-only.  Each staging step is a
distributed write into the shared checkpoint folder (``spark.checkpoint.dir``),
done once per application and table set.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import SparkSession

from fileflow.session import shared_dir

_DONE: dict = {}


def staged(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Path of ``name`` staged from ``sf_dir``; ``write(path)`` runs once."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), name)
    if key not in _DONE:
        tag = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:8]
        path = f"{shared_dir(spark)}/fileflow-stage/{name}-{tag}"
        write(path)
        _DONE[key] = path
    return _DONE[key]
