"""Where working tables go."""

import pytest

from quarrylight.jobs import shared


class Told:
    """A session's settings, as much as the folder depends on."""

    def __init__(self, master, warehouse, named=None):
        self.sparkContext = self
        self.master, self.conf, self.named, self.warehouse = master, self, named, warehouse

    def getConf(self):
        return self

    def get(self, key, default=None):
        return self.named if key == "spark.checkpoint.dir" else self.warehouse


def test_working_tables_never_go_to_a_disk_of_one_machine():
    for master in ("spark://host:7077", "yarn", "k8s://https://host", "local-cluster[2,1,1024]"):
        for warehouse in ("file:/tmp/warehouse", "/tmp/warehouse", "spark-warehouse"):
            with pytest.raises(ValueError, match="checkpoint"):
                shared.root_folder(Told(master, warehouse))
        assert shared.root_folder(Told(master, "s3a://bucket/warehouse")) == "s3a://bucket/warehouse"
        assert shared.root_folder(Told(master, "file:/tmp/x", "hdfs://host/tmp")) == "hdfs://host/tmp"


def test_local_sessions_take_a_folder_of_their_own():
    for master in ("local", "local[8]", "local[*]"):
        assert shared.root_folder(Told(master, "file:/tmp/x")).startswith("file://")
