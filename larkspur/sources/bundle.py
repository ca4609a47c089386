"""A saved model with what scoring needs: model, preprocessing and metadata in one folder."""

import json

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel

from larkspur.plans.preprocess import Preprocess
from larkspur.session import small_table


def save(spark, path, model, preprocess, metadata):
    model.write().overwrite().save(f"{path}/model")
    preprocess.save(spark, f"{path}/preprocess")
    text = small_table(spark, [(json.dumps(metadata),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
    return path


def load(spark, path):
    """(model, preprocessing, metadata); the last two may be absent."""
    model = PipelineModel.load(f"{path}/model")
    try:
        preprocess = Preprocess.load(spark, f"{path}/preprocess")
    except AnalysisException:
        preprocess = None
    try:
        metadata = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    except AnalysisException:
        metadata = {}
    return model, preprocess, metadata
