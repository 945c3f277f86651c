"""Scratch space."""

import pytest
from pyspark.sql import functions as F

from rowloom.session import scratch_dir, stage


class Conf:
    def __init__(self, values):
        self.values = values

    def get(self, name, default=None):
        return self.values.get(name, default)

    def set(self, name, value):
        self.values[name] = value


class Session:
    """Just what ``scratch_dir`` asks of a session."""

    def __init__(self, master, **settings):
        self.conf = Conf(settings)
        self.sparkContext = self
        self.master = master

    def getConf(self):
        return self.conf


def test_scratch_is_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(f"{root}/x-") and first != second


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        scratch_dir(Session("spark://host:7077"), "x")
    shared = Session("spark://host:7077", **{"spark.checkpoint.dir": "s3a://bucket/scratch/"})
    assert scratch_dir(shared, "x").startswith("s3a://bucket/scratch/x-")
    with pytest.raises(RuntimeError):
        scratch_dir(Session("local[2]"), "x")


def test_stage_keeps_types_and_fixes_values(spark, tmp_path):
    rows = spark.range(50).select("id", F.rand().alias("r"))
    staged = stage(rows, "x", f"{tmp_path}/staged")
    assert staged.dtypes == rows.dtypes
    assert sorted(staged.collect()) == sorted(staged.collect())
