"""Classification metrics, all from one count per (label, prediction) pair."""

from pyspark.sql import Window, functions as F

from larkspur.session import small_table


def confusion(df, label="label", prediction="prediction"):
    """(label, prediction, n) of the pairs that occur."""
    kind = df.schema[label].dataType
    return df.groupBy(
        F.col(label).alias("label"), F.col(prediction).cast(kind).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def dense_confusion(pairs):
    """Every label against every label, absent pairs as 0."""
    ends = F.explode(F.array("label", "prediction"))
    names = pairs.select(ends.alias("c")).agg(F.array_sort(F.collect_set("c")).alias("c")).scalar()
    grid = pairs.groupBy("label").agg(
        F.map_from_entries(F.collect_list(F.struct("prediction", "n"))).alias("counts")
    )
    missing = pairs.select(F.col("prediction").alias("label")).distinct().join(grid, "label", "left_anti")
    rows = grid.unionByName(missing, allowMissingColumns=True)
    return rows.select("label", "counts", F.explode(names).alias("prediction")).select(
        "label",
        "prediction",
        F.coalesce(F.try_element_at("counts", F.col("prediction")), F.lit(0)).alias("n"),
    )


def class_scores(pairs):
    """Per class: support, predicted, true positives, precision, recall, f1; 0 where undefined."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    ends = F.explode(
        F.array(
            F.struct(F.col("label").alias("class"), F.col("n").alias("support"),
                     F.lit(0).cast("long").alias("predicted"), hit.alias("tp")),
            F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"),
                     F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")),
        )
    )
    sums = pairs.select(ends.alias("e")).select("e.*").groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    )
    return sums.select(
        "*",
        _share(F.col("tp"), F.col("predicted")).alias("precision"),
        _share(F.col("tp"), F.col("support")).alias("recall"),
        _share(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1_score"),
    )


def _share(a, b):
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def _ordered_sum(term):
    """Sum over the classes in class order, so that the last digit does not depend on the shuffle."""
    terms = F.array_sort(F.collect_list(F.struct(F.col("class"), term.alias("t"))))
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x["t"])


def averages(scores):
    """One row: sample count, classes, accuracy, weighted and macro averages."""
    return scores.agg(*_averages())


def _averages():
    weighted = [
        (_ordered_sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m)
        for m in ("precision", "recall", "f1_score")
    ]
    macro = [
        (_ordered_sum(F.col(m)) / F.count(F.lit(1))).alias(f"macro_{m}")
        for m in ("precision", "recall", "f1_score")
    ]
    return [
        F.sum("support").alias("n"),
        F.count_if(F.col("support") > 0).alias("n_classes"),
        (F.sum("tp").cast("double") / F.sum("support")).alias("accuracy"),
        *weighted,
        *macro,
    ]


def classification_report(pairs):
    """Per-class rows, then accuracy, macro and weighted averages, each with its support."""
    scores = class_scores(pairs)
    per_class = scores.select(
        F.col("class").cast("string").alias("row"), "precision", "recall", "f1_score", "support"
    )
    lines = F.explode(
        F.array(
            F.struct(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), F.col("accuracy").alias("f1_score")),
            F.struct(F.lit("macro avg").alias("row"), F.col("macro_precision").alias("precision"),
                     F.col("macro_recall").alias("recall"), F.col("macro_f1_score").alias("f1_score")),
            F.struct(F.lit("weighted avg").alias("row"), "precision", "recall", "f1_score"),
        )
    )
    totals = averages(scores).select(lines.alias("l"), F.col("n").alias("support"))
    return per_class.unionByName(totals.select("l.*", "support"))


def roc_auc(df, label="label", score="score", positive=1):
    """One row: area under the ROC curve with ties counted half, NULL unless both classes occur."""
    counts = df.groupBy(F.col(label).alias("label"), F.col(score).alias("s")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return _area(counts, positive)


def _area(counts, positive):
    """Area from (label, s, n) rows.

    The counted scores are range-partitioned, each partition sums its own pairs, and only one row
    per partition meets to add the pairs between partitions. Whole numbers keep the sums exact.
    """
    big = "decimal(19,0)"
    is_pos = F.col("label") == F.lit(positive)
    zero = F.lit(0).cast("long")
    sided = counts.select(
        "s", F.when(is_pos, F.col("n")).otherwise(zero).alias("pos"),
        F.when(~is_pos, F.col("n")).otherwise(zero).alias("neg"),
    )
    ranged = sided.repartitionByRange("s").withColumn("part", F.spark_partition_id())
    upto = F.sum("neg").over(Window.partitionBy("part").orderBy("s").rangeBetween(
        Window.unboundedPreceding, Window.currentRow))
    tied = F.sum("neg").over(Window.partitionBy("part", "s"))
    twice = F.col("pos").cast(big) * (2 * upto - tied).cast(big)
    parts = ranged.withColumn("pairs", twice).groupBy("part").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("pairs").alias("pairs")
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("neg").over(earlier), F.lit(0))
    joined = parts.withColumn("pairs", F.col("pairs") + 2 * F.col("pos").cast(big) * before.cast(big))
    all_pairs = 2 * F.sum("pos").cast("double") * F.sum("neg")
    area = F.sum("pairs").cast("double") / F.nullif(all_pairs, F.lit(0.0))
    return joined.agg(area.alias("roc_auc"))


def class_distribution(df, target):
    return df.groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def per_class_name(measure):
    """The report's name for a measure's list: that of F1 is ``f1_per_class``."""
    return "f1_per_class" if measure == "f1_score" else f"{measure}_per_class"


def evaluation_report(df, label="label", prediction="prediction", score=None, positive=1):
    """One row of evaluation results; per-class lists only for more than two classes.

    The rows are counted once, per label, prediction and score; all results come from those counts.
    """
    if score is None:
        pairs = confusion(df, label, prediction)
    else:
        kind = df.schema[label].dataType
        counts = df.groupBy(
            F.col(label).alias("label"), F.col(prediction).cast(kind).alias("prediction"), F.col(score).alias("s")
        ).agg(F.count(F.lit(1)).alias("n"))
        pairs = counts.groupBy("label", "prediction").agg(F.sum("n").alias("n"))
    scores = class_scores(pairs)
    seen = F.col("support") > 0
    entry = F.struct(F.col("class").cast("string").alias("class"), "support")
    distribution = F.map_from_entries(F.array_sort(F.collect_list(F.when(seen, entry))))

    def listed(m):
        ordered = F.array_sort(F.collect_list(F.struct("class", F.col(m).alias("v"))))
        return F.transform(ordered, lambda x: x["v"])

    measures = ("precision", "recall", "f1_score")
    found = scores.agg(
        *_averages(), distribution.alias("class_distribution"),
        *[listed(m).alias(per_class_name(m)) for m in measures],
    )
    out = found.select(
        "accuracy", *measures, F.col("n").alias("test_samples"), "n_classes", "class_distribution",
        *[F.when(F.col("n_classes") > 2, F.col(per_class_name(m))).alias(per_class_name(m)) for m in measures],
    )
    if score is None:
        return out
    area = _area(counts, positive).scalar()
    return out.withColumn("roc_auc", F.when(F.col("n_classes") == 2, area))


def batch_report(df, target, prediction="prediction"):
    """One row with the keys of a scoring run; no row when there is no target."""
    if target not in df.columns:
        return small_table(
            df.sparkSession, [], "accuracy double, precision double, recall double, f1 double, n long"
        )
    found = averages(class_scores(confusion(df.where(F.col(target).isNotNull()), target, prediction)))
    return found.where("n > 0").select("accuracy", "precision", "recall", F.col("f1_score").alias("f1"), "n")


def regression_report(df, label="label", prediction="prediction"):
    gap = F.col(label).cast("double") - F.col(prediction).cast("double")
    return df.agg(F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(F.abs(gap)).alias("mae"))
