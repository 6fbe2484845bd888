from __future__ import annotations

import glob

from deskloom import session


def test_shuffles_start_with_enough_partitions(spark, tmp_path, monkeypatch):
    (tmp_path / "data").write_bytes(b"x" * 10_000)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.scale_to(spark, str(tmp_path)) == least
    monkeypatch.setattr(session, "PARTITION_BYTES", 1000)
    assert session.scale_to(spark, str(tmp_path)) == 10
    assert session.scale_to(spark, str(tmp_path), str(tmp_path / "data")) == 20
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


class Stub:
    """A session as far as the shared folder is concerned."""

    def __init__(self, master, **settings):
        self.conf = type("Conf", (), {"get": staticmethod(lambda name, default=None: settings.get(name.replace(".", "_"), default))})
        self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": staticmethod(lambda: settings.get("context"))})


def test_shared_folder_is_the_one_the_session_names(spark):
    cluster = "spark://host:7077"
    assert session.shared_folder(Stub(cluster, spark_checkpoint_dir="/shared/run/")) == "/shared/run"
    assert session.shared_folder(Stub(cluster, context="hdfs://x/ck")) == "hdfs://x/ck"
    assert session.shared_folder(Stub(cluster, spark_sql_warehouse_dir="s3://b/tables/")) == "s3://b/tables/_runs"


def test_run_folders_are_deleted(spark):
    folder = session.run_folder(spark)
    spark.range(1).write.parquet(f"{folder}/x")
    assert folder != session.run_folder(spark)
    session._delete(spark, folder)
    assert not glob.glob(f"{folder.removeprefix('file:')}*")
