"""Model registry: an append-only table of model versions with status and metrics."""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from larkspur.operators.ranking import row_number_by_bucket
from larkspur.session import small_table

APPROVED = "Approved"
PENDING = "PendingManualApproval"

SCHEMA = (
    "`group` string, model_path string, status string, accuracy double, "
    "metrics map<string,double>, created_at timestamp"
)


def status_by_accuracy(accuracy, threshold):
    return F.when(accuracy >= threshold, APPROVED).otherwise(PENDING)


def passes_gate(df, threshold, accuracy="accuracy"):
    """Evaluations good enough to register."""
    return df.where(F.col(accuracy) >= threshold)


def newest_with_status(df, group, status=APPROVED, created="created_at", tie=()):
    """The newest entry per group with a status, one row per group."""
    rest = [c for c in df.columns if c != group]
    newest = F.max_by(F.struct(*rest), F.struct(created, *tie)).alias("_e")
    return df.where(F.col("status") == status).groupBy(group).agg(newest).select(group, "_e.*")


def with_versions(df, group, order, bucket, name="version"):
    """Version numbers 1, 2, 3, ... per group in creation order."""
    return row_number_by_bucket(df, [group], bucket, order, name)


@dataclass(frozen=True)
class Registry:
    path: str

    def entries(self, spark):
        try:
            return spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException:
            return small_table(spark, [], SCHEMA)

    def register(self, spark, group, model_path, metrics, created_at, threshold=0.5, gate=False,
                 status=None):
        """Append one version; with ``gate`` a model below the threshold is not registered at all."""
        accuracy = metrics["accuracy"]
        if gate and accuracy < threshold:
            return None
        status = status or (APPROVED if accuracy >= threshold else PENDING)
        numbers = {k: float(v) for k, v in metrics.items() if isinstance(v, (int, float))}
        row = small_table(
            spark, [(group, model_path, status, float(accuracy), numbers, created_at)],
            "g string, p string, s string, a double, m map<string,double>, t string",
        ).select(
            F.col("g").alias("group"), F.col("p").alias("model_path"), F.col("s").alias("status"),
            F.col("a").alias("accuracy"), F.col("m").alias("metrics"),
            F.col("t").cast("timestamp").alias("created_at"),
        )
        row.coalesce(1).write.mode("append").parquet(self.path)
        return status

    def latest(self, spark, group, status=APPROVED):
        """The newest entry of a group with a status; an error when there is none."""
        entries = self.entries(spark).where(F.col("group") == group)
        found = newest_with_status(entries, "group", status, tie=["model_path"]).first()
        if found is None:
            raise LookupError(f"no {status} model in group {group}")
        return found
