"""Every query of the reference operators against its SQL on the smallest tables."""

import pytest

from sluice.plans import queries
from tests import oracle


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, sf_dir, con, name):
    df = queries.queries()[name](spark, sf_dir)
    if name in queries.oracle_sql():
        oracle.compare(df, con, queries.oracle_sql()[name])
    else:
        df.collect()


def test_entry(spark):
    import __spark_entry__ as entry

    got = entry.entry(spark)
    assert got.columns == ["id", "day", "user_id", "value", "first_id"] and got.count() == 100
    assert set(entry.oracle_sql()) <= set(entry.queries())
