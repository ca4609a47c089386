"""Plans: what reaches the scan, what is shuffled, what is never there."""

import pytest

import __spark_entry__ as entry
from larkspur.operators import clean
from larkspur.session import new_path, shared_dir
from larkspur.sources import fixtures as fx


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "features_as_of", "latest_features", "infer_without_train", "unseen_report", "roc_auc", "evaluation_report",
    "class_report", "split_rows", "registry_versions", "clean_all", "confusion_multi", "align_by_key",
])
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "ExistingRDD"):
        assert word not in plan


def test_cleaning_adds_no_shuffle(spark, sf_dir):
    path = new_path(spark, "raw")
    fx.churn_raw(spark, sf_dir).write.parquet(path)
    plan = plan_of(clean.clean_raw(spark.read.parquet(path)).select("customer_id", "age"))
    assert "Exchange" not in plan and "WholeStageCodegen" in plan or "*(1)" in plan
    assert "payment_method" not in plan.split("ReadSchema")[1]


def test_newest_records_shuffle_once_after_a_partial_aggregate(spark, sf_dir):
    plan = plan_of(entry.queries()["latest_features"](spark, sf_dir))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max_by" in plan


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    assert new_path(spark, "x") != new_path(spark, "x")


def test_batch_inference_cleans_the_customers_once(spark, sf_dir, monkeypatch):
    from larkspur.plans import queries

    made, clean_raw = [], queries.clean.clean_raw
    monkeypatch.setattr(queries.clean, "clean_raw", lambda df: (made.append(1), clean_raw(df))[1])
    got = queries.batch_inference(spark, sf_dir)
    assert len(made) == 1
    want = queries.part_of(spark, sf_dir, "infer").select(queries.ID)
    assert sorted(r[0] for r in got.select(queries.ID).collect()) == sorted(r[0] for r in want.collect())
