import itertools
import time

import pytest
from pyspark.sql import functions as F

from larkspur.operators import models, requests as rq
from larkspur.plans import infer, search, train
from larkspur.session import new_path
from larkspur.sources import bundle, registry
from larkspur.streaming import scoring

RUN = "2024-06-01T00:00:00Z"


@pytest.fixture(scope="module")
def customers(spark):
    """A label that follows from the features, with missing values in all of them."""
    k = F.col("id")
    noise = F.pmod(F.xxhash64("id"), F.lit(100))
    return spark.range(1200).select(
        F.format_string("CUST_%06d", k).alias("customer_id"),
        F.when(k % 17 != 0, noise.cast("double")).alias("age"),
        (k % 13).cast("double").alias("tenure_months"),
        F.when(k % 5 != 0, F.element_at(F.array(F.lit("Monthly"), F.lit("Yearly")), (k % 2 + 1).cast("int"))).alias("contract_type"),
        F.when(k % 50 != 0, ((noise > 50) | (k % 13 == 3)).cast("int")).alias("churn"),
    ).persist()


@pytest.fixture(scope="module")
def trained(customers):
    return train.train(customers, "churn", classifier=models.forest("churn", 10, 5), unique_key=True)


def test_training(trained):
    report = trained.evaluation().first()
    assert report.accuracy > 0.8 and report.roc_auc > 0.8 and report.n_classes == 2
    fitted = trained.training_metrics().first().asDict()
    sizes = fitted["n_train_samples"], fitted["n_val_samples"], report.test_samples
    # 1176 labelled rows: 236 test rows, then 188 of the 940 others.
    assert sizes == (752, 188, 236) and fitted["n_features"] == 3
    assert {"accuracy", "precision", "recall", "f1_score", "train_accuracy", "n_classes", "roc_auc"} <= set(fitted)
    assert trained.metadata["n_train_samples"] == 940 and trained.metadata["n_test_samples"] == 236


def test_importances(trained):
    rows = trained.importances(2).collect()
    assert rows[0].feature == "age" and len(rows) == 2 and rows[0].importance >= rows[1].importance
    assert trained.metadata["feature_importance"][0]["feature"] == "age"


def test_same_seed_gives_the_same_model(customers, trained):
    again = train.train(customers, "churn", classifier=models.forest("churn", 10, 5), unique_key=True)
    assert again.evaluation().collect() == trained.evaluation().collect()


def test_save_register_score_publish(spark, customers, trained):
    entries = registry.Registry(new_path(spark, "registry"))
    assert train.register(trained, entries, "g", new_path(spark, "m0"), RUN, threshold=1.01) is None
    path = new_path(spark, "model")
    assert train.register(trained, entries, "g", path, RUN) == registry.APPROVED
    scored, report = infer.batch_inference(spark, customers, entries, "g", "scored_customers", new_path(spark, "out"))
    assert scored.columns == [*customers.columns, "prediction", "prediction_probability"]
    assert scored.count() == 1200 and report.first().n == 1176 and report.first().accuracy > 0.8
    assert spark.table("scored_customers").where("prediction = 1").count() > 0
    compact, _ = infer.batch_inference(spark, customers, entries, "g", compact=True)
    assert compact.columns == ["customer_id", "prediction", "prediction_probability"]
    both = scored.select("customer_id", "prediction").join(compact.withColumnRenamed("prediction", "p"), "customer_id")
    assert both.where("prediction <> p").isEmpty()


def test_text_target_is_scored_as_text(spark, customers):
    named = customers.withColumn("churn", F.when(F.col("churn") == 1, "gone").when(F.col("churn") == 0, "stays"))
    t = train.train(named, "churn", classifier=models.forest("churn", 5, 4), unique_key=True)
    scored = infer.score(named, t.model, t.preprocess)
    assert {r[0] for r in scored.select("prediction").distinct().collect()} == {"gone", "stays"}
    report = infer.metrics.batch_report(scored, "churn").first()
    assert report.accuracy > 0.7


def test_bundle_parts_may_be_absent(spark, trained):
    path = new_path(spark, "bare")
    trained.model.write().save(f"{path}/model")
    model, preprocess, metadata = bundle.load(spark, path)
    assert preprocess is None and metadata == {} and len(model.stages) == 2


def test_missing_feature_is_an_error(customers, trained):
    with pytest.raises(ValueError):
        infer.score(customers.drop("age"), trained.model, trained.preprocess)


def test_search(spark, customers):
    fitted, parts, _ = train.prepare(customers, "churn", unique_key=True)
    tried = [
        ("logistic", "", models.logistic("churn"), False),
        ("forest", "", models.forest("churn", 5, 4), False),
        ("boosted trees", "", models.boosted_trees("churn", 3, 3), False),
        ("linear svc", "", models.linear_svc("churn", rounds=5), True),
        ("perceptron", "", models.perceptron("churn", 3, 2, rounds=10), True),
    ]
    found = search.search(parts["train"], parts["validation"], fitted.features, "churn", tried, "AUC")
    assert len(found) == 5 and all(0 <= c.value <= 1 for c in found)
    top = search.best(found)
    assert top.value == max(c.value for c in found) == search.candidates_table(spark, found).agg(F.max("metric_value")).first()[0]
    info = search.best_info(spark, found, "churn", "job", RUN).first()
    assert (info.candidate_name, info.metric, info.model_name) == (top.name, "AUC", "churn-1717200000")
    voted = search.soft_vote(found, parts["test"], 3)
    assert voted.count() == parts["test"].count() and voted.where("probability not between 0 and 1").isEmpty()
    for metric in search.METRICS:
        assert search.metric_value(voted, "churn", metric) >= 0
    assert search.ranked([search.Candidate(n, "", "", "RMSE", v, 0, None) for n, v in (("a", 2.0), ("b", 1.0))])[0].name == "b"
    with pytest.raises(LookupError):
        search.best([])
    with pytest.raises(ValueError):
        search.search(parts["train"], parts["validation"], fitted.features, "churn", tried, "Luck")


def test_search_starts_nothing_after_its_time(customers):
    fitted, parts, _ = train.prepare(customers, "churn", unique_key=True)
    clock = itertools.count(0, 10).__next__
    tried = [("forest", "", models.forest("churn", 2, 2), False)] * 4
    found = search.search(parts["train"], parts["validation"], fitted.features, "churn", tried, max_seconds=25,
                          parallelism=1, clock=clock)
    assert 1 <= len(found) < 4


def test_requests_scored_like_rows(spark, customers, trained):
    p = trained.preprocess
    sent = rq.replay(customers, "customer_id", p.features)
    answered = rq.score_requests(sent, trained.model, p)
    rows = infer.score(customers, trained.model, p, compact=True).withColumnRenamed("prediction", "row_prediction")
    both = answered.join(rows, answered.request_id == rows.customer_id)
    assert both.count() == 1200 and both.where("prediction <> row_prediction").isEmpty()
    bare = p.apply(customers.limit(5), keep=["customer_id"]).select(
        F.col("customer_id").alias("request_id"), F.lit(rq.JSON).alias("content_type"),
        F.to_json(F.struct(F.array(F.array(*p.features)).alias("instances"))).alias("body"))
    got = rq.score_requests(bare, trained.model, p).join(rows, F.col("request_id") == F.col("customer_id"))
    assert got.count() == 5 and got.where("prediction <> row_prediction").isEmpty()


def test_stream_scores_like_a_table(spark, customers, trained):
    source, out = new_path(spark, "in"), new_path(spark, "out")
    customers.repartition(6).write.parquet(source)
    stream = spark.readStream.schema(customers.schema).option("maxFilesPerTrigger", 2).parquet(source)
    scoring.score_rows(stream, trained.model, trained.preprocess, out, new_path(spark, "state")).awaitTermination()
    table = infer.score(customers, trained.model, trained.preprocess)
    assert spark.read.parquet(out).exceptAll(table).isEmpty() and spark.read.parquet(out).count() == 1200
    requests, answers = new_path(spark, "requests"), new_path(spark, "answers")
    rq.replay(customers, "customer_id", trained.preprocess.features).write.parquet(requests)
    asked = spark.readStream.schema(rq.REQUEST).parquet(requests)
    bad = spark.createDataFrame([("bad", "text/plain", "x")], rq.REQUEST)
    for part in (None, bad):
        if part is not None:
            part.write.mode("append").parquet(requests)
        scoring.score_request_stream(asked, trained.model, trained.preprocess, answers, f"{answers}-state").awaitTermination()
        assert scoring.scored_requests(spark, answers).count() == 1200
    assert [tuple(r) for r in scoring.rejected_requests(spark, answers).collect()] == [("bad", "unsupported content type")]


def test_vote_over_three_classes(spark):
    df = spark.range(600).select((F.col("id") % 30).cast("double").alias("v"), F.floor(F.col("id") % 30 / 10).cast("double").alias("y"))
    tried = [("forest", "", models.forest("y", 5, 4), False), ("logistic", "", models.logistic("y"), False)]
    found = search.search(df, df, ["v"], "y", tried, "Accuracy")
    voted = search.soft_vote([c for c in found if c.algorithm == "forest"], df)
    assert voted.where("prediction <> y").isEmpty()
    with pytest.raises(ValueError):
        search.search(df, df, ["v"], "y", tried, "AUC")


def test_forest_does_not_depend_on_the_files(spark, customers):
    fitted, parts, _ = train.prepare(customers, "churn", unique_key=True)
    forests = [models.pipeline(fitted.features, models.forest("churn", 5, 4)).fit(models.spread(parts["train"].repartition(n)))
               for n in (1, 7)]
    assert forests[0].stages[-1].toDebugString.split("\n")[1:] == forests[1].stages[-1].toDebugString.split("\n")[1:]


def halving_rows(spark):
    return spark.range(4000).select((F.col("id") % 8).cast("double").alias("a"), "id", (F.col("id") % 8 > 3).cast("double").alias("y"))


def test_halving_keeps_the_one_that_finds_the_rule(spark):
    rows = halving_rows(spark).withColumn("b", F.when(F.col("a").between(2, 5), 1.0).otherwise(0.0)).drop("y")
    tried = [("forest", f"depth={d}", models.forest("b", 1, d), False) for d in (0, 0, 3, 0)]
    found = search.halving(rows, rows, ["a"], "b", tried, first_share=0.25, max_seconds=600)
    assert search.survivor(found).name == "candidate-03" and search.survivor(found).value == 1.0
    assert [(n, r, s) for n, r, s, _ in found.rungs] == [
        *[(f"candidate-0{i}", 0, 0.25) for i in (1, 2, 3, 4)], ("candidate-01", 1, 0.5), ("candidate-03", 1, 0.5), ("candidate-03", 2, 1.0)]
    assert not found.out_of_time and not found.not_tried
    parts = [search.sample_rows(rows, s) for s in (0.25, 0.5, 1.0)]
    assert all(a.exceptAll(b).isEmpty() for a, b in zip(parts, parts[1:])) and 800 < parts[0].count() < 1200


class Slow:
    """A classifier whose fit is a job of minutes."""

    def fit(self, rows):
        return rows.crossJoin(rows.toDF("a2", "id2", "y2")).crossJoin(rows.toDF("a3", "id3", "y3")).coalesce(1).agg(
            F.sum(F.xxhash64("id", "id2", "id3") % 7)).collect()


def test_halving_cancels_what_runs_at_the_limit(spark, monkeypatch):
    rows = halving_rows(spark)
    real = models.pipeline
    monkeypatch.setattr(models, "pipeline", lambda f, c, s=False: c if isinstance(c, Slow) else real(f, c, s))
    tried = [("forest", "depth=2", models.forest("y", 1, 2), False), ("slow", "", Slow(), False), ("slow", "", Slow(), False)]
    # Time is over once the first candidate is measured.
    measured, measure = [], search.metric_value
    monkeypatch.setattr(search, "metric_value", lambda *a: measured.append(measure(*a)) or measured[-1])
    found = search.halving(rows, rows, ["a"], "y", tried, first_share=0.5, max_seconds=100, tick=0.2,
                           clock=lambda: 200.0 if measured else 0.0)
    assert found.out_of_time
    assert [c.name for c in found] == ["candidate-01"] and {n for n, *_ in found.not_tried} == {"candidate-02", "candidate-03"}
    deadline = time.monotonic() + 20
    while spark.sparkContext.statusTracker().getActiveJobsIds() and time.monotonic() < deadline:
        time.sleep(0.2)
    assert not spark.sparkContext.statusTracker().getActiveJobsIds(), "nothing runs on"


def test_partitions_of_a_fit_grow_with_its_rows(spark, monkeypatch):
    monkeypatch.setattr(models, "PARTITION_ROWS", 10)
    rows = spark.range(1000).selectExpr("id", "id % 7 AS x")
    dealt = models.spread(rows)
    assert dealt.rdd.getNumPartitions() == 100
    assert max(dealt.rdd.glom().map(len).collect()) < 40
    assert models.spread(rows.limit(50)).rdd.getNumPartitions() == models.PARTITIONS
