from types import SimpleNamespace

import pytest

from lakelog.sources import workdir


def session(master, setting=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: setting or default),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"))


def test_the_setting_of_the_cluster_is_used():
    assert workdir.shared_root(session("yarn", "hdfs://nn/tmp/")) == "hdfs://nn/tmp"
    assert workdir.new_folder(session("yarn", "s3a://b/x"), "a").startswith("s3a://b/x/lakelog/app-1/a-")


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        workdir.shared_root(session("spark://host:7077"))


def test_local_mode_keeps_one_temporary_folder():
    first = workdir.shared_root(session("local[2]"))
    assert first == workdir.shared_root(session("local[2]"))


def test_folders_are_new(spark):
    assert workdir.new_folder(spark, "x") != workdir.new_folder(spark, "x")
