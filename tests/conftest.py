import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from orderloom.session import local_session
    session = local_session("4", "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def t(spark):
    from orderloom.plans.bindings import Tables
    return Tables(spark, DATA)


def rows(df, *order):
    """Collected rows as plain tuples, sorted by all or the given columns."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=repr) if not order else sorted(
        found, key=lambda r: tuple(repr(r[df.columns.index(c)]) for c in order))
