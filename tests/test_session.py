import os
from types import SimpleNamespace

import pytest

from splitsight import session


def fake(master, conf=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: conf or default))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake(master))
    assert session.shared_dir(fake(master, "hdfs://x/shared")) == "hdfs://x/shared"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_one_machine_may_use_its_own(master):
    assert os.path.isdir(session.shared_dir(fake(master)))


def test_scratch_leaves_no_files(spark):
    outside = session.stored(spark.range(3), "outside")
    root = session.shared_dir(spark)
    before = set(os.listdir(root))
    with session.scratch(spark):
        assert session.stored(spark.range(5), "inside").count() == 5
        assert set(os.listdir(root)) > before
    assert set(os.listdir(root)) == before and outside.count() == 3
