"""Source/sink helpers: materialised folders, catalog tables."""
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from contactlane import session
from contactlane.sources import tables


def test_materialized_folder_can_be_removed(spark):
    out, path = tables.materialize_at(spark.range(5), "gone")
    assert out.count() == 5
    tables.remove(spark, path)
    assert not os.path.exists(path.replace("file:", ""))


def test_catalog_table(spark, tmpdir_path):
    tables.save_table(spark.range(3).selectExpr("id", "id % 2 AS p"), "snap_t", f"{tmpdir_path}/one", partition_by=["p"])
    tables.save_table(spark.range(7).selectExpr("id", "id % 2 AS p"), "snap_t", f"{tmpdir_path}/two", partition_by=["p"])
    assert spark.table("snap_t").count() == 7
    spark.sql("DROP TABLE snap_t")


def test_only_local_sessions_get_a_folder_of_their_own():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "local-cluster[2,1,1024]"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_materialize_writes_under_checkpoint_dir(spark):
    base = spark.sparkContext.getCheckpointDir()
    out = tables.materialize(spark.range(10), "probe")
    paths = out.inputFiles()
    assert paths and all(base.replace("file:", "") in p for p in paths)
    assert out.count() == 10


def test_save_table_keeps_the_old_table_until_the_new_is_written(spark, tmpdir_path):
    rows = spark.range(5).selectExpr("id", "id % 2 AS p")
    for by, name in ((None, "swap_a"), (["p"], "swap_b")):
        tables.save_table(rows, name, f"{tmpdir_path}/{name}1", partition_by=by)
        before = spark.table(name)
        with pytest.raises(PySparkException):
            tables.save_table(rows.withColumn("id", F.raise_error(F.lit("no")).cast("long")), name,
                              f"{tmpdir_path}/{name}2", partition_by=by)
        assert spark.table(name).count() == 5
        tables.save_table(rows.where("id < 2"), name, f"{tmpdir_path}/{name}3", partition_by=by)
        assert spark.table(name).count() == 2 and (by or before.count() == 5)
        tables.save_table(spark.range(1).selectExpr("'x' AS other"), name, f"{tmpdir_path}/{name}4")
        assert spark.table(name).columns == ["other"]
