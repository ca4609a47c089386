"""Batch scoring: newest approved model, preprocessing, prediction, report, published table."""

from pyspark.sql import functions as F

from larkspur.operators import metrics, models
from larkspur.schema import RECORD_ID
from larkspur.sources import bundle
from larkspur.sources.tables import publish, write_report


def score(df, model, preprocess, compact=False, record_id=RECORD_ID, scope="saved"):
    """Every input row with its prediction; ``compact`` keeps only id, prediction and probability."""
    row = df.select(F.struct(*df.columns).alias("_row"), "*")
    ready = preprocess.apply(row.drop(preprocess.target), keep=["_row"], scope=scope)
    scored = models.predict(model, ready, "prediction_probability")
    if preprocess.target_classes:
        names = F.array(*[F.lit(c) for c in preprocess.target_classes])
        scored = scored.withColumn("prediction", F.get(names, F.col("prediction").cast("int")))
    else:
        scored = scored.withColumn("prediction", F.col("prediction").cast("int"))
    if compact:
        return scored.select(f"_row.{record_id}", "prediction", "prediction_probability")
    return scored.select("_row.*", "prediction", "prediction_probability")


def batch_inference(spark, df, registry, group, table=None, path=None, compact=False, mode="overwrite"):
    """(scored rows, report row) with the group's newest approved model; published if a table is named.

    A second run on the same table replaces the first one's rows and report.
    """
    entry = registry.latest(spark, group)
    model, preprocess, _ = bundle.load(spark, entry["model_path"])
    scored = score(df, model, preprocess, compact)
    if table:
        scored = publish(scored, table, f"{path}/predictions", mode=mode)
    report = metrics.batch_report(scored, preprocess.target)
    if table:
        write_report(report, f"{path}/evaluation", mode=mode)
    return scored, report
