import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest

from shelfcast.llm.columns import ship
from shelfcast.session import shared_dir, ship_package


def cluster(folder):
    context = SimpleNamespace(master="spark://head:7077", getCheckpointDir=lambda: "set")
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: folder))


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="each machine"):
        shared_dir(cluster("file:/tmp/x"))
    assert shared_dir(cluster("hdfs://store/x/")) == "hdfs://store/x"


def test_the_package_is_sent_once_whoever_asks():
    sent = []

    def add(path):
        time.sleep(0.2)  # as others ask meanwhile; a cluster refuses a second file of this name
        sent.append(path)

    context = SimpleNamespace(applicationId="test-sent-once", addPyFile=add)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(set=lambda key, value: None))
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda send: send(session), [ship_package, ship] * 3))
    assert len(sent) == 1
