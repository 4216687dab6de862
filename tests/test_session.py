from __future__ import annotations

import os

import pytest

from lodewatch import session


class Cluster:
    """Just enough of a session of a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "spark://host:7077"
        applicationId = "app"

        class _jsc:
            @staticmethod
            def sc():
                class Context:
                    @staticmethod
                    def getCheckpointDir():
                        class Nothing:
                            @staticmethod
                            def isDefined():
                                return False

                        return Nothing

                return Context


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(Cluster, "x")
    assert not session.one_machine(Cluster)


def test_work_folders_are_deleted(spark):
    assert session.one_machine(spark)
    session.clear_work(spark)
    path = session.work_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path)
    assert session.clear_work(spark) == 1
    assert not os.path.isdir(path)
