from types import SimpleNamespace

import pytest

from weirflow.session import scratch_dir


def session(**settings):
    conf = {name.replace("_", "."): value for name, value in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: conf.get(name, default)))


def test_scratch_folder_is_shared_or_local():
    shared = session(spark_master="spark://host:7077", spark_checkpoint_dir="hdfs:///scratch/")
    assert scratch_dir(shared, "x").startswith("hdfs:///scratch/x-")
    assert scratch_dir(session(spark_master="local[4]"), "x") != scratch_dir(session(spark_master="local"), "x")
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="share"):
            scratch_dir(session(spark_master=master), "x")
