"""Classifiers from pyspark.ml, their predictions and feature importances."""

from pyspark.ml import Pipeline
from pyspark.ml import classification as ml
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from larkspur.session import small_table

# The forest's settings.
TREES, DEPTH, MIN_LEAF, SEED = 100, 10, 1, 42

# Partitions a fit's rows are dealt into, at least, and rows of one on average, at most: a tree fit holds about half a
# kilobyte a row, for its counts per tree.
PARTITIONS, PARTITION_ROWS = 16, 100_000

VECTOR = "_features"
PROBABILITY = "_probability"
RAW = "_raw"


def _columns(label):
    return {"labelCol": label, "featuresCol": VECTOR, "predictionCol": "prediction"}


def pipeline(features, classifier, scaled=False):
    stages = [VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="error")]
    if scaled:
        stages[0].setOutputCol("_unscaled")
        stages.append(StandardScaler(inputCol="_unscaled", outputCol=VECTOR, withMean=False))
    return Pipeline(stages=[*stages, classifier])


def partitions_for(rows):
    """Partitions for a fit on so many rows."""
    return max(PARTITIONS, -(-rows // PARTITION_ROWS))


def spread(df, partitions=None):
    """Rows for a fit, dealt by a hash of all values into a number of partitions that follows from their count, or that
    the caller names, and put in order there: bagging draws by partition and place, so the model depends on neither
    cores nor files."""
    partitions = partitions or partitions_for(df.count())
    return df.repartition(partitions, F.xxhash64(*df.columns)).sortWithinPartitions(*df.columns)


def has_probability(model):
    """Whether the model gives class probabilities; a margin is none."""
    return model.stages[-1].hasParam("probabilityCol")


def probabilities(model, df, name):
    """Input columns and an array of the probabilities of the classes."""
    return model.transform(df).select(*df.columns, vector_to_array(PROBABILITY).alias(name))


def forest(label, trees=TREES, depth=DEPTH, min_leaf=MIN_LEAF, seed=SEED):
    """A node with two rows may be split, which is Spark's rule too and needs no setting."""
    return ml.RandomForestClassifier(
        **_columns(label), probabilityCol=PROBABILITY, rawPredictionCol=RAW,
        numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed,
    )


def boosted_trees(label, rounds=20, depth=5, seed=SEED):
    trees = ml.GBTClassifier(**_columns(label), maxIter=rounds, maxDepth=depth, seed=seed)
    return trees.setRawPredictionCol(RAW).setProbabilityCol(PROBABILITY)


def logistic(label, penalty=0.0, rounds=100):
    return ml.LogisticRegression(
        **_columns(label), probabilityCol=PROBABILITY, rawPredictionCol=RAW,
        regParam=penalty, maxIter=rounds,
    )


def linear_svc(label, penalty=0.01, rounds=100):
    return ml.LinearSVC(**_columns(label), rawPredictionCol=RAW, regParam=penalty, maxIter=rounds)


def perceptron(label, n_features, n_classes, hidden=(8,), rounds=100, seed=SEED):
    return ml.MultilayerPerceptronClassifier(
        **_columns(label), probabilityCol=PROBABILITY, rawPredictionCol=RAW,
        layers=[n_features, *hidden, n_classes], maxIter=rounds, seed=seed,
    )


def predict(model, df, probability="probability"):
    """Input columns with ``prediction`` and, where the model has one, the probability of class 1."""
    scored = model.transform(df)
    names = [*df.columns, "prediction"]
    if PROBABILITY in scored.columns:
        scored = scored.withColumn(probability, F.get(vector_to_array(PROBABILITY), F.lit(1)))
    elif RAW in scored.columns:
        # A margin grows with the class-1 chance; the logistic curve brings it to 0..1.
        margin = F.get(vector_to_array(RAW), F.lit(1))
        scored = scored.withColumn(probability, 1 / (1 + F.exp(-margin)))
    else:
        scored = scored.withColumn(probability, F.lit(None).cast("double"))
    return scored.select(*names, probability)


def importances(spark, model, features, top=None):
    """(feature, importance), most important first."""
    weights = [float(x) for x in model.stages[-1].featureImportances.toArray()]
    rows = small_table(spark, list(zip(features, weights)), "feature string, importance double")
    ordered = rows.orderBy(F.desc("importance"), "feature")
    return ordered if top is None else ordered.limit(top)
