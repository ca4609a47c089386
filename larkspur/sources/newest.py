"""The newest record of every key, kept as a table: appended rows are merged into the buckets that they touch."""

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from larkspur.operators.versions import latest_records
from larkspur.sources.feature_group import FeatureGroup

BUCKETS = 256
LOG = "number long, noted string, folder string, buckets array<int>"


@dataclass(frozen=True)
class NewestTable:
    """Newest records of a feature group below ``path``, by hash of the key in ``buckets`` parts.

    A merge collapses the new rows to one per key before it shuffles them, reads the stored records of the buckets that
    they touch, and writes these buckets anew into a folder of the merge. Only then the merge is noted in ``<path>/log``, by number;
    a reader takes each bucket from the newest merge that wrote it. So a merge that breaks off changes nothing, rows that are
    merged twice change nothing, readers keep the folders they have opened, and rows may come in any order. Deleted records stay
    stored, so that an older version that comes late does not revive them.

    One writer at a time: a second one that has noted a merge in between is found out before this one is noted. Choose
    ``buckets`` so that one of them fits a few tasks; it can't be changed later. The driver holds one folder name per bucket.
    """

    group: FeatureGroup
    path: str
    buckets: int = BUCKETS

    def merges(self, spark):
        """What is noted: number, time, folder and buckets of every merge."""
        try:
            return spark.read.schema(LOG).json(f"{self.path}/log")
        except AnalysisException:
            return spark.createDataFrame([], LOG)

    def places(self, spark):
        """{bucket: folder} as of the newest merges, and the number of the last one."""
        log = self.merges(spark)
        last = log.agg(F.max("number")).first()[0]
        newest = log.select("number", "folder", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
            F.max_by("folder", "number").alias("folder"))
        return {r["bucket"]: r["folder"] for r in newest.collect()}, last or 0

    def schema(self, spark):
        own = self.group.read(spark).schema
        return T.StructType([f for f in own if f.name != "event_date"])

    def bucket(self):
        return F.pmod(F.xxhash64(self.group.record_id), F.lit(self.buckets)).cast("int")

    def stored(self, spark, places):
        """The records of these buckets, deleted ones included."""
        own = self.schema(spark)
        if not places:
            return spark.createDataFrame([], own)
        return spark.read.schema(own).parquet(*[f"{self.path}/{folder}/_bucket={b}" for b, folder in sorted(places.items())])

    def newest(self, rows):
        """One row per key, the choice the same as in ``FeatureGroup.latest``."""
        first = [self.group.event_time, "write_time", "is_deleted"]
        rest = sorted(c for c in rows.columns if c not in (self.group.record_id, *first))
        return latest_records(rows, self.group.record_id, [*first, *rest])

    def merge(self, rows):
        """Merge stored versions (rows of the group), each key against its record so far."""
        spark = rows.sparkSession
        own, key = self.schema(spark), self.group.record_id
        places, last = self.places(spark)
        folder = f"merge-{uuid.uuid4().hex}"
        # The delta is written once: its buckets are looked up and its rows merged.
        delta_path = f"{self.path}/delta-{folder}"
        self.newest(rows.select(*own.names)).withColumn("_bucket", self.bucket()).write.parquet(delta_path)
        delta = spark.read.parquet(delta_path)
        touched = sorted(r["_bucket"] for r in delta.select("_bucket").distinct().collect())
        if not touched:
            return self
        former = self.stored(spark, {b: places[b] for b in touched if b in places})
        merged = self.newest(former.unionByName(delta.select(*own.names)))
        merged.select(*own.names, self.bucket().alias("_bucket")).hint("rebalance", "_bucket").sortWithinPartitions(
            "_bucket", key).write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        if self.places(spark)[1] != last:
            raise RuntimeError(f"another merge into {self.path} was noted meanwhile")
        now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        spark.range(1).select(
            F.lit(last + 1).cast("long").alias("number"), now.alias("noted"), F.lit(folder).alias("folder"),
            F.array(*[F.lit(b) for b in touched]).alias("buckets")).coalesce(1).write.mode("append").json(f"{self.path}/log")
        return self

    def append(self, df, run_ts, **how):
        """Append to the group, then merge the same rows. What a run leaves unmerged that breaks off in between,
        ``catch_up`` merges."""
        self.group.append(df, run_ts, **how)
        return self.merge(self.group.matched(self.group.stamp(df, run_ts), how.get("missing", "error")))

    def catch_up(self, spark, since):
        """Merge what the group has stored at or after ``since``; of its files, those with older write times are skipped by
        their statistics."""
        return self.merge(self.group.read(spark).where(F.col("write_time") >= F.lit(since).cast("timestamp")))

    def latest(self, spark):
        """The newest, not deleted record of every key: the stored records, without any shuffle."""
        return self.stored(spark, self.places(spark)[0]).where(~F.col("is_deleted")).drop("is_deleted")
