import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from flowloom.session import local_session

    session = local_session(4, memory="6g", app="tests")
    session.conf.set("spark.sql.shuffle.partitions", "3")
    return session


@pytest.fixture
def values(spark):
    """Value of one expression over single rows: ``values(schema, rows, expression)``."""

    def run(schema, rows, expression):
        return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(expression).collect()]

    return run
