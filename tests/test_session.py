"""The shared folder for intermediate tables."""

from types import SimpleNamespace

import pytest

from trendlens.session import NoSharedFolder, checkpoint_dir, materialize, release_scratch


def stub(master, folder=None, conf=None):
    set_to = []
    conf = {"spark.sql.warehouse.dir": "file:/w/", **(conf or {})}
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: folder, setCheckpointDir=set_to.append)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=sc), set_to


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(NoSharedFolder):
            checkpoint_dir(stub(master)[0])


def test_the_named_folder_is_used_and_a_local_master_has_its_own():
    spark, set_to = stub("yarn", conf={"spark.checkpoint.dir": "hdfs://n/c"})
    assert checkpoint_dir(spark) == "hdfs://n/c" and set_to == ["hdfs://n/c"]
    assert checkpoint_dir(stub("yarn", folder="hdfs://n/d")[0]) == "hdfs://n/d"
    assert checkpoint_dir(stub("local[4]")[0]) == "file:/w/_scratch"


def test_intermediate_tables_are_released(spark):
    df = materialize(spark.range(10), "numbers")
    assert df.count() == 10 and df.inputFiles()
    path = df.inputFiles()[0]
    release_scratch(spark)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    assert not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
