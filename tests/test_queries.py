"""Every registered query against its SQL, on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    found = duckdb.connect()
    for t in check.TABLES:
        found.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return found


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, sf_dir, name):
    verdict, _, _, detail = check.compare(spark, con, sf_dir, name, QUERIES[name])
    assert verdict == "same", detail


@pytest.mark.parametrize("name, columns, rows", [
    ("forest_train_eval", {"accuracy", "roc_auc", "test_samples"}, 1),
    ("forest_importance_top10", {"feature", "importance"}, 10),
    ("batch_inference", {"customer_id", "prediction", "prediction_probability"}, 30),
    ("search_candidates", {"candidate", "metric_value"}, 7),
])
def test_model_queries(spark, sf_dir, name, columns, rows):
    out = QUERIES[name](spark, sf_dir)
    assert columns <= set(out.columns) and len(out.collect()) == rows
