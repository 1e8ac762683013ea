import pytest
from oracle_harness import compare, duck

from starweave.llm.oracle import ORACLE
from starweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    ok, msg = compare(QUERIES[name](spark, SF), duck(SF), ORACLE[name])
    assert ok, msg
