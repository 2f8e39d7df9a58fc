"""fileflow: file ingest and range planning expressed as Spark DataFrame operators.

Sub-packages
------------
functions   column expressions (strftime templates, line splitting, byte alignment)
sources     file listing and scans (glob, recursive, compressed, delimited, header skip)
operators   table operators (range planning, ordered scans, packing, line chunks)
plans       the manifest view, the catalogue of registered queries, options -> plan / rows
streaming   incremental ingest with the Structured Streaming file source
"""

from fileflow.operators.chunks import line_chunks, lines  # noqa: F401
from fileflow.operators.ordered import grouped_prefix_sums, with_global_index  # noqa: F401
from fileflow.operators.packing import task_concat, task_entries, task_pack, task_summary  # noqa: F401
from fileflow.operators.ranges import (  # noqa: F401
    codec_flags,
    file_limit,
    last_range,
    range_count,
    range_invariants,
    range_limit,
    range_plan,
    total_size,
    unit_size,
)
from fileflow.options import IngestOptions  # noqa: F401
from fileflow.session import build_session, shared_dir  # noqa: F401
from fileflow.sources.delimited import Col, read_delimited  # noqa: F401
from fileflow.sources.inventory import list_files  # noqa: F401
from fileflow.sources.scans import read_lines, read_whole_files, templated_paths  # noqa: F401

__all__ = [n for n in dir() if not n.startswith("_")]
