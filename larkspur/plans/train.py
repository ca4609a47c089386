"""Training: range read, split, preprocess, fit, evaluate, gate, register."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from larkspur.operators import metrics, models
from larkspur.operators.split import mark_parts, written
from larkspur.plans.preprocess import Preprocess, fit_preprocess, labelled_rows
from larkspur.schema import RECORD_ID, TARGET
from larkspur.sources import bundle


@dataclass
class Trained:
    model: PipelineModel
    preprocess: Preprocess
    train: DataFrame
    validation: DataFrame
    test: DataFrame
    metadata: dict

    def score(self, df, keep=()):
        """Preprocessed rows with prediction and probability."""
        return models.predict(self.model, self.preprocess.apply(df, keep))

    def evaluation(self, df=None):
        """The evaluation row of the test rows, or of other labelled rows."""
        target = self.preprocess.target
        rows = self.test if df is None else df
        return metrics.evaluation_report(models.predict(self.model, rows), target, "prediction",
                                         "probability", 1.0)

    def training_metrics(self):
        """Validation metrics, train accuracy and sizes as one row."""
        target = self.preprocess.target
        fitted = metrics.averages(metrics.class_scores(
            metrics.confusion(models.predict(self.model, self.train), target)))
        out = self.evaluation(self.validation).drop("class_distribution").drop(
            *[metrics.per_class_name(m) for m in ("precision", "recall", "f1_score")])
        return out.withColumnRenamed("test_samples", "n_val_samples").withColumns({
            "_fitted": fitted.select(F.struct("accuracy", "n")).scalar(),
            "n_features": F.lit(len(self.preprocess.features)),
        }).select(
            "*", F.col("_fitted.accuracy").alias("train_accuracy"), F.col("_fitted.n").alias("n_train_samples")
        ).drop("_fitted")

    def importances(self, top=10):
        spark = self.train.sparkSession
        return models.importances(spark, self.model, self.preprocess.features, top)

    def save(self, path):
        return bundle.save(self.train.sparkSession, path, self.model, self.preprocess, self.metadata)


def prepare(df, target=TARGET, key=(RECORD_ID,), test_size=0.2, seed=42, fill_target=False,
            unique_key=False):
    """(preprocess, parts, class counts): parts are the preprocessed 64/16/20 shares by name.

    The split runs on the raw rows, and medians and codes come from those that are not test rows.
    The marked rows are written once to the shared folder, because fitting and the model read them many
    times.
    """
    key = [c for c in key if c in df.columns]
    known = df if fill_target else df.where(df[target].isNotNull())
    marked, sizes = mark_parts(known, target, test_size, seed, key, unique_key)
    marked = written(marked, "marked")
    fitted = fit_preprocess(marked.where("part <> 'test'").drop("part"), target, fill_target)
    ready = labelled_rows(marked, fitted, fill_target)
    parts = {
        name: fitted.apply(ready.where(ready["part"] == name).drop("part"))
        for name in ("train", "validation", "test")
    }
    return fitted, parts, sizes


def train(df, target=TARGET, key=(RECORD_ID,), test_size=0.2, seed=42, classifier=None,
          unique_key=False, partitions=None):
    """Fit the forest (or another ``classifier``) on the training part of ``df``, dealt into ``partitions``, by default as
    many as its rows need."""
    fitted, parts, sizes = prepare(df, target, key, test_size, seed, unique_key=unique_key)
    partitions = partitions or models.partitions_for(sum(sizes["train"].values()))
    classifier = classifier or models.forest(target)
    model = models.pipeline(fitted.features, classifier).fit(models.spread(parts["train"], partitions))
    learned = {c: n + sizes["validation"].get(c, 0) for c, n in sizes["train"].items()}
    metadata = fitted.metadata(learned, sizes["test"]) | {
        "fit_partitions": partitions,
        "feature_columns": fitted.features,
        "class_names": fitted.target_classes or [str(c) for c in learned],
        "seed": seed,
    }
    if hasattr(model.stages[-1], "featureImportances"):
        weights = zip(fitted.features, model.stages[-1].featureImportances.toArray())
        best = sorted(weights, key=lambda e: -e[1])[:20]
        metadata["feature_importance"] = [{"feature": f, "importance": float(w)} for f, w in best]
    return Trained(model, fitted, parts["train"], parts["validation"], parts["test"], metadata)


def register(trained, registry, group, path, created_at, threshold=0.5, gate=True):
    """Save the bundle and record it; returns the status, or None when the gate kept it out."""
    spark = trained.train.sparkSession
    report = trained.evaluation().first().asDict()
    if gate and report["accuracy"] < threshold:
        return None
    trained.save(path)
    return registry.register(spark, group, path, report, created_at, threshold, gate)
