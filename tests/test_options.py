import os

import pytest

from fileflow.options import IngestOptions, apply_hadoop_conf, hadoop_overlay, split_bytes_for

XML = """<?xml version="1.0"?>
<configuration>
  <property><name>fs.defaultFS</name><value>file:///</value></property>
  <property><name>io.compression.codecs</name><value>a,b</value></property>
</configuration>
"""


def test_defaults_and_required():
    o = IngestOptions(path="/x/%Y")
    assert (o.rewind_seconds, o.splittable, o.target_ranges, o.header_lines) == (0, True, -1, 0)
    assert (o.path_regex, o.max_ranges, o.min_task_size) == (".*", 2147483647, 0)
    assert o.hadoop_conf == {} and o.hadoop_conf_files == ()
    with pytest.raises(ValueError):
        IngestOptions(path="")


def test_overlay_order(tmpdir_path):
    a = os.path.join(tmpdir_path, "core-site.xml")
    b = os.path.join(tmpdir_path, "hdfs-site.xml")
    with open(a, "w") as f:
        f.write(XML)
    with open(b, "w") as f:
        f.write(XML.replace("a,b", "c"))
    merged = hadoop_overlay([a, b], {"fs.defaultFS": "file:///data"})
    assert merged == {"fs.defaultFS": "file:///data", "io.compression.codecs": "c"}


def test_overlay_reaches_reader(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "t.txt")
    with open(p, "w") as f:
        f.write("x\n")
    o = IngestOptions(path=p, hadoop_conf={"fs.defaultFS": "file:///"})
    assert apply_hadoop_conf(spark.read, o).text(p).count() == 1


def test_split_bytes_and_default_target(spark):
    assert split_bytes_for(1000, 3) == 333 and split_bytes_for(2, 10) == 1
    assert IngestOptions(path="p").resolved_target(spark) == spark.sparkContext.defaultParallelism
