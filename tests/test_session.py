"""Session helpers: the shared folder."""

import pytest

from rankforge import session as S


class _Fake:
    """A session on a cluster whose checkpoint folder is not set."""

    def __init__(self, master):
        self.sparkContext = self
        self.master = master
        self.conf = self

    def get(self, key, default=None):
        return default

    def getConf(self):
        return self

    def getCheckpointDir(self):
        return None


@pytest.mark.parametrize("master", ["yarn", "k8s://x", "spark://h:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        S.checkpoint_root(_Fake(master))


def test_shared_path_is_unique_and_below_the_root(spark):
    p = S.shared_path(spark, "x", "y")
    assert p.startswith(S.checkpoint_root(spark).rstrip("/")) and S.shared_path(spark, "x", "y") != p


def test_reading_a_table_changes_no_setting(spark, sf_small):
    from rankforge.sources import fixtures

    before = spark.conf.get("spark.sql.shuffle.partitions")
    fixtures.table(spark, sf_small, "events")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
