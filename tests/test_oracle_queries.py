"""Every registered query against its DuckDB oracle on the smallest supplied tables."""

import pytest

from tools.compare import digest, duck

SF = "/root/testdata/sf0.001"


def _names():
    import __spark_entry__ as E
    return sorted(set(E.oracle_sql()) - set(E.TEXT_ORACLE))  # the text operators have their own tests


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, ocols)[0]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "proportion" in df.columns


def test_every_query_registered_runs_rows_only(spark):
    import __spark_entry__ as E
    missing = set(E.queries()) - set(E.oracle_sql()) - set(E.TEXT_QUERIES)
    assert missing == {"gbt_scores", "importance", "stuff_plus_model"}
