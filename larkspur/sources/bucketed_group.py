"""A feature table in key buckets: newest and as-of reads take the versions where they lie, without a shuffle."""

from dataclasses import dataclass

from pyspark.sql import Window, functions as F, types as T

from larkspur.operators import versions
from larkspur.sources.feature_group import FeatureGroup

BUCKETS = 64
#: Versions and spine rows of one bucket, at most on average: a task gathers and sorts them.
BUCKET_ROWS = 400_000


def buckets_for(rows, least=1):
    """Buckets for so many versions and spine rows."""
    return max(least, -(-rows // BUCKET_ROWS))


@dataclass(frozen=True)
class BucketedGroup(FeatureGroup):
    """Like a feature group, but stored by hash of the key, sorted by key and event time inside a bucket.

    Every append adds files to the buckets. A key that holds a large part of all versions makes its bucket large: it is
    written by many tasks, its as-of reads go over the general way, which cuts its line into periods, and its
    newest version is an aggregate. Choose ``buckets`` so that one bucket fits a task (``buckets_for``).
    """

    buckets: int = BUCKETS

    def features(self, df):
        return T.StructType([f for f in super().features(df) if f.name != "event_date"])

    def ensure(self, df):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.features(df))
        df.sparkSession.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet "
            f"CLUSTERED BY (`{self.record_id}`) SORTED BY (`{self.record_id}`, `{self.event_time}`) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'")
        return self

    def append(self, df, run_ts, missing="error"):
        """Append rows, stamped with the run's time. Rows are dealt by key, and a hot key to several tasks."""
        self.ensure(df)
        rows = self.matched(self.stamp(df, run_ts), missing)
        rows.hint("rebalance", self.record_id).write.insertInto(self.name)
        df.sparkSession.catalog.refreshTable(self.name)
        return self

    def append_new(self, df, run_ts):
        """Append those rows whose key and event time are not stored yet; the stored versions stay in their buckets."""
        self.ensure(df)
        rows = self.matched(self.stamp(df, run_ts), "null").dropDuplicates([self.record_id, self.event_time])
        known = self.read(df.sparkSession).groupBy(self.record_id, self.event_time).agg(F.lit(True).alias("_known"))
        # Keys and times of a bucket are compared with the batch's keys only; the join's key is the buckets'.
        times = known.groupBy(F.col(self.record_id).alias("_id")).agg(F.collect_list(self.event_time).alias("_times"))
        new = rows.join(times, F.col(self.record_id).eqNullSafe(F.col("_id")), "left").where(
            ~F.coalesce(F.array_contains("_times", F.col(self.event_time)), F.lit(False))).drop("_id", "_times")
        new.hint("rebalance", self.record_id).write.insertInto(self.name)
        df.sparkSession.catalog.refreshTable(self.name)
        return self

    def as_of(self, spine, at, values, order=("write_time",), hot_rows=versions.HOT_ROWS):
        """Every spine row with the newest version, not deleted, whose event time is not after ``at``; of versions with equal
        times the one that is larger by ``order``, then by its values.

        Rows of the spine are gathered by key and laid on the line of the key's versions, which are already together and
        sorted; only the spine is shuffled. Keys with more than ``hot_rows`` spine rows or versions take the general way.
        """
        spark, key, time = spine.sparkSession, self.record_id, self.event_time
        stored = self.read(spark)
        hot = self._hot(stored, hot_rows).unionByName(self._hot(spine, hot_rows)).distinct()
        found = [r[key] for r in hot.limit(versions.HOT_KEYS + 1).collect()]
        order = list(dict.fromkeys([*order, "is_deleted", *sorted(values)]))
        if not found:
            return self._on_lines(spine, stored, at, values, order)
        rest = spine.where(~F.coalesce(F.col(key).isin(found), F.lit(False))) if len(found) <= versions.HOT_KEYS else spine.limit(0)
        large = spine.where(F.col(key).isin(found)) if len(found) <= versions.HOT_KEYS else spine
        general = versions.as_of(large, stored, key, at, time, values, order, "is_deleted", hot_rows=hot_rows)
        return self._on_lines(rest, stored, at, values, order).unionByName(general)

    def _hot(self, rows, limit):
        return rows.groupBy(self.record_id).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select(self.record_id)

    def _on_lines(self, spine, stored, at, values, order):
        key, time = self.record_id, self.event_time
        version = F.struct(F.col(time), "is_deleted", *values)
        line = stored.where(F.col(key).isNotNull()).groupBy(key, F.col(time).alias("_t")).agg(F.max_by(version, F.struct(*order)).alias("_v"))
        by_key = Window.partitionBy(key).orderBy("_t")
        line = line.withColumn("_first", F.row_number().over(by_key) == 1)
        # Dealt into as many parts as there are buckets, so that the versions can stay where they are.
        dealt = spine.repartition(self.buckets, key)
        asked = dealt.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
            F.collect_list(F.struct(*spine.columns)).alias("_rows"))
        # The key's spine rows are hung onto its first version.
        both = line.join(asked, F.col(key) == F.col("_key"), "left")
        times, state = line.schema["_t"].dataType, line.schema["_v"].dataType
        place = lambda t, kind, v, row: F.struct(t.alias("t"), F.lit(kind).alias("kind"), v.alias("v"), row.alias("row"))
        own = F.array(place(F.col("_t"), 1, F.col("_v"), F.lit(None).cast(spine.schema)))
        hung = F.transform("_rows", lambda r: place(r[at].cast(times), 2, F.lit(None).cast(state), r))
        places = both.select(key, F.explode(F.when(F.col("_first") & F.col("_rows").isNotNull(), F.concat(own, hung)).otherwise(own)).alias("x"))
        along = Window.partitionBy(key).orderBy("x.t", "x.kind").rowsBetween(Window.unboundedPreceding, 0)
        last = places.withColumn("_last", F.last("x.v", ignorenulls=True).over(along)).where("x.kind = 2")
        shown = F.when(~F.col("_last.is_deleted"), F.col("_last"))
        answered = last.select(*[F.col(f"x.row.{c}").alias(c) for c in spine.columns], shown[time].alias(f"feature_{time}"),
                               *[shown[v].alias(v) for v in values])
        keys = stored.groupBy(F.col(key).alias("_key")).agg(F.lit(1).alias("_one")).drop("_one")
        alone = dealt.join(keys, F.col(key) == F.col("_key"), "left_anti")
        absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in answered.schema[len(spine.columns):]]
        return answered.unionByName(alone.select(*spine.columns, *absent))
