from types import SimpleNamespace

import pytest

from tidegauge import session


def fake(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(sparkContext=SimpleNamespace(master=master, applicationId="app", getConf=lambda: conf))


def test_the_configured_folder_is_used():
    assert session.shared_dir(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake("yarn"))


def test_paths_are_fresh():
    spark = fake("yarn", "/shared")
    assert session.work_path(spark, "x") != session.work_path(spark, "x")


def test_query_names_are_unique():
    from tidegauge.registry import query

    with pytest.raises(ValueError, match="registered twice"):
        import tidegauge.plans  # noqa: F401

        query("T1")(lambda spark, folder: None)
