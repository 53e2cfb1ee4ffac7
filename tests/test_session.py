"""The shared folder and what is left in it."""

from pathlib import Path

import pytest

from riskweave.session import scratch, shared_dir, temporary, written


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "a") != scratch(spark, "a")


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_temporary_removes_only_its_own_tables(spark):
    kept = written(spark.range(3), "kept")
    with temporary(spark):
        gone = written(spark.range(3), "gone")
        path = Path(gone.inputFiles()[0].removeprefix("file:")).parent
        assert gone.count() == 3
    assert not path.exists()
    assert kept.count() == 3
