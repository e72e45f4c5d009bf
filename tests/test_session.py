import pytest

from tripflow.session import shared_folder, shared_path, write_aside


class Unset:
    """A session without ``spark.checkpoint.dir``."""

    def __init__(self, master):
        self.conf, self.sparkContext, self.master, self.applicationId = self, self, master, "app"

    def get(self, name, default):
        return default


def test_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_path(spark, "x").startswith(shared_folder(spark) + "/x-")


def test_only_a_local_session_falls_back(tmp_path):
    assert shared_folder(Unset("local[2]")) == shared_folder(Unset("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Unset("spark://host:7077"))


def test_written_aside_rows_are_the_same(spark):
    rows = spark.range(10).selectExpr("id", "named_struct('a', id) AS nested", "CAST(NULL AS STRING) AS nothing")
    assert sorted(write_aside(rows, "t").collect()) == sorted(rows.collect())
