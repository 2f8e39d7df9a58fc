"""Job options (the whole option surface of the ingest) and the Hadoop overlay.

Defaults follow the reference job config; names are ours.  ``target_ranges``
<= 0 means "one per core of the cluster" (``defaultParallelism``).
"""

from __future__ import annotations

import dataclasses
import xml.etree.ElementTree as ET

# File suffixes of Hadoop's built-in compression codecs
# (gzip, bzip2, deflate, lz4, snappy, zstandard).
DEFAULT_CODEC_SUFFIXES = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst")


@dataclasses.dataclass(frozen=True)
class IngestOptions:
    path: str
    rewind_seconds: int = 0
    span_seconds: int = 0                # also the template's paths of that long before
    span_step_seconds: int = 86400
    splittable: bool = True              # reference: partition
    target_ranges: int = -1              # reference: num_partitions (approximate)
    header_lines: int = 0                # reference: skip_header_lines
    decompression: bool = True           # codec chosen by file suffix
    path_regex: str = ".*"               # reference: path_match_pattern (unanchored find)
    max_ranges: int = 2147483647         # reference: total_file_count_limit (counts ranges)
    max_files: int | None = None         # what that name says: first K files
    min_task_size: int = 0               # greedy packing threshold in bytes
    codec_suffixes: tuple = DEFAULT_CODEC_SUFFIXES
    hadoop_conf_files: tuple = ()
    hadoop_conf: dict = dataclasses.field(default_factory=dict)
    filter_before_sizing: bool = False   # reference sizes before the regex filter
    fail_if_empty: bool = False          # reference errors when all files are empty

    def __post_init__(self):
        if not self.path:
            raise ValueError("option 'path' is required")
        if self.header_lines < 0:
            raise ValueError("header_lines must be >= 0")

    def resolved_target(self, spark) -> int:
        if self.target_ranges > 0:
            return int(self.target_ranges)
        return int(spark.sparkContext.defaultParallelism)


def load_hadoop_xml(path: str) -> dict:
    """Parse one Hadoop ``*-site.xml`` file into a {name: value} dict."""
    out = {}
    root = ET.parse(path).getroot()
    for prop in root.iter("property"):
        name = prop.findtext("name")
        if name:
            out[name.strip()] = (prop.findtext("value") or "").strip()
    return out


def hadoop_overlay(conf_files=(), conf: dict | None = None) -> dict:
    """XML files in order, then the explicit map; later settings win."""
    merged: dict = {}
    for f in conf_files:
        merged.update(load_hadoop_xml(f))
    merged.update({k: str(v) for k, v in (conf or {}).items()})
    return merged


def apply_hadoop_conf(reader, opts: IngestOptions):
    """Pass the overlay as per-read options: they reach listing and the line reader."""
    overlay = hadoop_overlay(opts.hadoop_conf_files, opts.hadoop_conf)
    return reader.options(**overlay) if overlay else reader


def split_bytes_for(total_bytes: int, target_ranges: int) -> int:
    """Reference unit: max(total div n, 1); usable as spark.sql.files.maxPartitionBytes."""
    return max(int(total_bytes) // max(int(target_ranges), 1), 1)
