"""Fit preprocessing once, apply the same to training, batch and streaming rows."""

import json
from dataclasses import dataclass, field

from pyspark.sql import functions as F

from larkspur.operators.columns import (
    detect_target, drop_meta, number_columns, require_rows, select_features, text_columns,
)
from larkspur.operators.encode import Codes, apply_codes, fit_codes
from larkspur.operators.impute import fill_medians, fill_unknown, fit_medians
from larkspur.session import small_table


@dataclass
class Preprocess:
    target: str
    categorical: list
    numeric: list
    medians: dict
    codes: Codes
    target_classes: list = field(default_factory=list)

    @property
    def features(self):
        return [*self.numeric, *self.categorical]

    def encode_target(self, df):
        """Text classes as codes 0, 1, 2, ...; a numeric target stays, as a double."""
        if self.target not in df.columns:
            return df
        if not self.target_classes:
            return df.withColumn(self.target, F.col(self.target).cast("double"))
        pairs = [F.lit(x) for i, v in enumerate(self.target_classes) for x in (v, float(i))]
        return df.withColumn(
            self.target, F.try_element_at(F.create_map(*pairs), F.col(self.target).cast("string"))
        )

    def apply(self, df, keep=(), scope="saved", encode_target=True):
        """``keep`` columns, then the target if present, then the features as doubles.

        ``scope="batch"`` takes the medians of the rows at hand instead of the saved ones; it needs
        a pass over them and cannot be used on a stream.
        """
        kept = [F.col(c).alias(f"_keep_{c}") for c in keep]
        has_target = [self.target] if self.target in df.columns else []
        slim = select_features(df, self.features, keep=[*kept, *has_target])
        medians = fit_medians(slim, self.numeric) if scope == "batch" else self.medians
        out = fill_unknown(fill_medians(slim, medians), self.categorical)
        out = apply_codes(out, self.codes)
        if encode_target:
            out = self.encode_target(out)
        return out.withColumnsRenamed({f"_keep_{c}": c for c in keep})

    def metadata(self, train_counts, test_counts):
        """Row counts, class count and class distribution of a finished split."""
        both = {c: train_counts.get(c, 0) + test_counts.get(c, 0) for c in {*train_counts, *test_counts}}
        return {
            "target_column": self.target,
            "categorical_columns": self.categorical,
            "n_train_samples": sum(train_counts.values()),
            "n_test_samples": sum(test_counts.values()),
            "n_classes": len(both),
            "class_distribution": {str(c): n for c, n in sorted(both.items())},
        }

    def save(self, spark, path):
        head = {
            "target": self.target, "categorical": self.categorical, "numeric": self.numeric,
            "medians": self.medians, "target_classes": self.target_classes, "wide": self.codes.wide,
        }
        text = small_table(spark, [(json.dumps(head),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(f"{path}/head")
        self.codes.to_table(spark).write.mode("overwrite").parquet(f"{path}/codes")

    @classmethod
    def load(cls, spark, path):
        head = json.loads(spark.read.text(f"{path}/head").first()["value"])
        table = spark.read.parquet(f"{path}/codes")
        wide = head.pop("wide")
        lists = {c: [] for c in head["categorical"] if c not in wide}
        small = table.where(~F.col("column").isin(*wide)) if wide else table
        for r in small.orderBy("column", "code").collect():
            lists[r["column"]].append(r["value"])
        large = table.where(F.col("column").isin(*wide)) if wide else None
        return cls(codes=Codes(lists, large, wide), **head)


def fit_preprocess(df, target=None, fill_target=False):
    """Learn medians, category codes and target classes.

    Rows without a target teach nothing and are left out; ``fill_target`` keeps them.
    """
    target = target or detect_target(df)
    if target not in df.columns:
        raise ValueError(f"no target column {target}")
    rows = drop_meta(df, target)
    if not fill_target:
        rows = rows.where(F.col(target).isNotNull())
    categorical, numeric = text_columns(rows, target), number_columns(rows, target)
    medians = fit_medians(rows, numeric) if numeric else {}
    if not numeric:
        require_rows(rows, "training rows")
    filled = fill_unknown(rows.select(*categorical, target), categorical)
    classes = []
    if target in text_columns(rows):
        classes = fit_codes(fill_unknown(filled, [target]), [target]).lists[target]
    return Preprocess(target, categorical, numeric, medians, fit_codes(filled, categorical), classes)


def labelled_rows(df, preprocess, fill_target=False):
    """Rows fit for training: with a target, or with the target filled like a feature."""
    target = preprocess.target
    if not fill_target:
        return df.where(F.col(target).isNotNull())
    if preprocess.target_classes:
        return fill_unknown(df, [target])
    return fill_medians(df, fit_medians(df, [target]))
