import pytest

from sparkloom.plans import general_queries, graph_queries
from tests.compare import oracle, same

SF = "/root/testdata/sf0.001"
QUERIES = {**general_queries.QUERIES, **graph_queries.QUERIES}
SQL = {**general_queries.SQL, **graph_queries.SQL}


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, con, name):
    equal, *_, diff = same(QUERIES[name](spark, SF), con, SQL[name])
    assert equal, diff


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    q = entry.queries()
    assert set(entry.oracle_sql()) <= set(q) and all(f"p{n}_" in " ".join(q) for n in (1, 5))
