import pytest

from carestar.session import scratch_dir


class Conf:
    def __init__(self, **values):
        self.values = values

    def get(self, name, default=None):
        return self.values.get(name, default)

    def set(self, name, value):
        self.values[name] = value


class Session:
    def __init__(self, **values):
        self.conf = Conf(**{k.replace("_", "."): v for k, v in values.items()})


def test_shared_storage_is_used_where_it_is_named():
    session = Session(spark_master="spark://host:7077", spark_checkpoint_dir="/shared/")
    assert scratch_dir(session, "x").startswith("/shared/carestar/x-")


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_without_shared_storage_is_refused(master):
    with pytest.raises(ValueError, match="shared storage"):
        scratch_dir(Session(spark_master=master), "x")


def test_a_local_session_gets_a_folder_once():
    session = Session(spark_master="local[8]")
    first, second = scratch_dir(session, "x"), scratch_dir(session, "x")
    assert first != second
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
