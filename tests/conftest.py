import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from fileflow.session import shared_dir

    shared_dir(s)
    yield s


@pytest.fixture()
def tasks_of(spark):
    """A function that calls another one: its result and the number of tasks that it ran."""
    import uuid

    def run(fn):
        sc, group = spark.sparkContext, uuid.uuid4().hex
        sc.setJobGroup(group, "counted")
        try:
            out = fn()
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        tracker = sc.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
        infos = [tracker.getStageInfo(s) for s in stages]
        return out, sum(i.numCompletedTasks for i in infos if i is not None)

    return run


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="fileflow-test-")


SF = "/root/testdata/sf0.001"
