import os

import pytest

import __spark_entry__ as entry
from tallyforge.llm import queries

pytestmark = pytest.mark.skipif(not os.path.isdir(entry.SMOKE_DIR), reason="no test tables here")


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    assert name in entry.queries()
    df = queries.QUERIES[name](spark, entry.SMOKE_DIR)
    rows = df.collect()
    assert len(rows) == df.count()
    if name.endswith("_found"):
        assert len(set(map(tuple, rows))) == len(rows)
