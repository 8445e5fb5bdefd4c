"""Scratch folders: where they lie, and that a scope deletes what it made."""

import os

import pytest

from snapmart.sources import scratch


class FakeSession:
    """Settings of a session, without Spark."""

    def __init__(self, master, settings):
        self.sparkContext, self.conf, self.master, self.settings = self, self, master, settings

    def get(self, key, default=None):
        return self.settings.get(key, "file:/somewhere/spark-warehouse" if "warehouse" in key else default)

    def getConf(self):
        return self

    def contains(self, key):
        return key in self.settings


def test_a_machine_local_folder_is_refused_on_a_cluster():
    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        scratch.shared_folder(FakeSession("spark://host:7077", {}))
    with pytest.raises(RuntimeError):
        scratch.shared_folder(FakeSession("local-cluster[3,2,1000]", {}))
    assert scratch.shared_folder(FakeSession("yarn", {"spark.checkpoint.dir": "s3a://b/cp/"})) == "s3a://b/cp"
    assert scratch.shared_folder(FakeSession("yarn", {"spark.sql.warehouse.dir": "s3a://b/wh"})) == "s3a://b/wh/_scratch"
    assert scratch.shared_folder(FakeSession("local[4]", {})) == "file:/somewhere/spark-warehouse/_scratch"


def test_a_scope_deletes_its_paths_but_those_taken_off(spark):
    with scratch.scratch_scope(spark) as made:
        kept, gone = (scratch.scratch_path(spark, "t") for _ in range(2))
        for p in (kept, gone):
            spark.range(2).write.parquet(p)
        made.remove(kept)
    assert spark.read.parquet(kept).count() == 2
    assert not os.path.exists(gone.removeprefix("file:"))
    scratch.remove(spark, kept)
    assert not os.path.exists(kept.removeprefix("file:"))


def test_the_library_is_shipped_once(spark):
    import __spark_entry__ as e

    for _ in range(2):
        e.queries()["q_topk_nulls_last"](spark, "/root/testdata/sf0.001")
    assert sum("library-" in f for f in spark.sparkContext.listFiles) == 1
