import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rowloom.session import build_session, release_all, scratch  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("rowloom-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
        "spark.sql.warehouse.dir": f"file://{tmp_path_factory.mktemp('warehouse')}",
        "spark.sql.maxMetadataStringLength": "2000"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release_all(session)
    left = leftovers(session)
    session.stop()
    assert left == []


def leftovers(session):
    """Databases, and files and folders below the shared folder, of open or lost scratches."""
    shared = session.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/rowloom"
    return ([r[0] for r in session.sql("SHOW DATABASES LIKE 'rowloom_*'").collect()]
            + (os.listdir(shared) if os.path.isdir(shared) else []))


@pytest.fixture(autouse=True)
def own_scratch(request):
    """What a test stores goes with it; nothing of it may be left."""
    if "spark" not in request.fixturenames:
        yield
        return
    session = request.getfixturevalue("spark")
    for name in request.fixturenames:  # module fixtures write to the session's scratch
        request.getfixturevalue(name) if name != "own_scratch" else None
    before = leftovers(session)
    with scratch(session):
        yield
    assert leftovers(session) == before


@pytest.fixture(scope="session")
def tables(spark):
    from rowloom.plans.registry import Tables
    return Tables(spark, SMALL)
