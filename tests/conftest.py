import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from quarrymill.session import local_session  # noqa: E402
from quarrymill.sinks.store import scratch_store  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="quarrymill-tests-")
    session = local_session(
        **{"spark.sql.warehouse.dir": f"{scratch}/warehouse", "spark.checkpoint.dir": f"{scratch}/shared"}
    )
    yield session
    session.stop()


@pytest.fixture
def store(spark):
    return scratch_store(spark, "test")


@pytest.fixture
def frame(spark):
    """Rows of a small DataFrame: `frame("id int, name string", (1, "a"))`."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


@pytest.fixture
def rows():
    return lambda df, *columns: sorted(
        (tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr
    )


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
