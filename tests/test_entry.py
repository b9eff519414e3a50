"""Driver contract: entry(), the catalogue, and a sample of queries against their DuckDB oracle at sf0.001."""
import duckdb
import pytest

import __spark_entry__ as E
from cleanspark.plans import catalog
from tools.check_oracle import TABLES, rows_of

from .conftest import SF001


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "customer_id" in df.columns


def test_catalogue_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 77
    # models and sampled checks; their properties are checked by pair_model_properties and anomaly_properties
    assert set(catalog.QUERIES) - set(o) == {"anomaly_scores", "dup_model_train", "dup_pairs_model", "pipeline_model",
                                             "blocking_recall", "profile_report"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


# the models' properties have tests of their own (test_models_io_stream)
@pytest.mark.parametrize("name", sorted(set(catalog.ORACLE) - {"pair_model_properties", "anomaly_properties", "stream_score"}))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF001)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    srows = [tuple(r) for r in sdf.collect()]
    assert sorted(sdf.columns) == sorted(ocols)
    assert orows or name in ("rule_date_order",)  # no query is green on nothing
    assert rows_of(sdf.columns, srows, 9) == rows_of(ocols, orows, 9)
