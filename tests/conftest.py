import pytest

from windrow.session import local_session


@pytest.fixture(scope="session")
def shared(tmp_path_factory):
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def spark(shared):
    settings = {"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": shared + "/"}
    session = local_session(8, "windrow-tests", **settings)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


def rows(df, *order):
    """Collected rows as plain tuples, ordered."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
