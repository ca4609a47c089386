"""Append-only feature table: records keyed by an identifier, versioned by event time."""

from dataclasses import dataclass

from pyspark.sql import functions as F, types as T

from larkspur.functions.keys import key_between
from larkspur.operators.clean import set_event_time
from larkspur.operators.columns import require_rows
from larkspur.operators.versions import latest_records
from larkspur.schema import EVENT_TIME, RECORD_ID
from larkspur.sources.tables import resolve


#: Dates that are named in the plan when rows are compared with the table; more are joined.
NAMED_DATES = 1_000


def feature_kind(kind):
    """bigint, double or string, the three kinds a feature can have."""
    if isinstance(kind, T.IntegralType):
        return T.LongType()
    return T.DoubleType() if isinstance(kind, T.NumericType) else T.StringType()


@dataclass(frozen=True)
class FeatureGroup:
    name: str
    path: str
    record_id: str = RECORD_ID
    event_time: str = EVENT_TIME

    def features(self, df):
        """The table's schema from the rows' types, with event time and the store's own columns."""
        own = (self.event_time, "write_time", "is_deleted", "event_date")
        fields = [T.StructField(f.name, feature_kind(f.dataType)) for f in df.schema if f.name not in own]
        return T.StructType(
            [
                *fields,
                T.StructField(self.event_time, T.TimestampType()),
                T.StructField("write_time", T.TimestampType()),
                T.StructField("is_deleted", T.BooleanType()),
                T.StructField("event_date", T.DateType()),
            ]
        )

    def ensure(self, df):
        """Create the table if it is absent."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.features(df))
        df.sparkSession.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet "
            f"PARTITIONED BY (event_date) LOCATION '{self.path}'"
        )
        return self

    def stamp(self, df, run_ts):
        """Rows as they are stored: typed features, event time, store columns, event date."""
        timed = set_event_time(df, run_ts, self.event_time)
        defaults = {"write_time": F.lit(run_ts).cast("timestamp"), "is_deleted": F.lit(False)}
        timed = timed.withColumns({c: v for c, v in defaults.items() if c not in timed.columns})
        timed = timed.withColumn("event_date", F.to_date(self.event_time))
        return timed.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.features(timed)]
        )

    def matched(self, rows, missing="error"):
        """Rows with the table's own columns, in its order and types. A column that the table lacks is an
        error; one that the rows lack is an error too, or NULL with ``missing="null"``."""
        own = rows.sparkSession.table(self.name).schema
        unknown = [c for c in rows.columns if c not in own.names]
        absent = [c for c in own.names if c not in rows.columns]
        if unknown or (absent and missing != "null"):
            raise ValueError(f"{self.name}: unknown columns {unknown}, missing columns {absent}")
        return rows.select(*[
            (F.col(f.name) if f.name not in absent else F.lit(None)).cast(f.dataType).alias(f.name) for f in own])

    def append(self, df, run_ts, by_key=True, missing="error"):
        """Append rows, stamped with the run's time, column by column of the same name.

        ``by_key`` gives every file its own range of dates and keys, so that a key range reads few
        files; finding the ranges takes a second pass over the rows. The random last part of the
        range divides a date, a key or a set of copies that holds a large part of all rows. Without
        ``by_key`` dates are only spread evenly over the writing tasks.
        """
        self.ensure(df)
        rows = self.matched(self.stamp(df, run_ts), missing)
        if by_key:
            placed = rows.repartitionByRange("event_date", self.record_id, F.rand(7))
        else:
            placed = rows.hint("rebalance", "event_date")
        placed.sortWithinPartitions("event_date", self.record_id).write.insertInto(self.name)
        df.sparkSession.catalog.refreshTable(self.name)
        return self

    def append_new(self, df, run_ts):
        """Append those rows whose key and event time the table does not have yet, one for each. Doing it
        again changes nothing, so a batch that is delivered twice is stored once. Only the dates that
        occur in the rows are read."""
        self.ensure(df)
        rows = self.matched(self.stamp(df, run_ts), "null").dropDuplicates([self.record_id, self.event_time])
        self._insert(self.unknown(rows))
        return self

    def unknown(self, rows):
        """Stamped rows without those whose key and event time are stored; of the table, only the dates that
        the rows name, and of these only key and time, are read."""
        dates = rows.select("event_date").distinct()
        named = [r["event_date"] for r in dates.limit(NAMED_DATES + 1).collect()]
        known = self.read(rows.sparkSession).select(
            F.col("event_date").alias("_date"), F.col(self.record_id).alias("_id"), F.col(self.event_time).alias("_time"))
        if len(named) <= NAMED_DATES:
            known = known.where(F.col("_date").isin([d for d in named if d is not None]) | (
                F.col("_date").isNull() if None in named else F.lit(False)))
        else:
            known = known.join(dates.withColumnRenamed("event_date", "_named"), F.col("_date").eqNullSafe(F.col("_named")), "left_semi")
        return rows.join(known, F.col(self.record_id).eqNullSafe(F.col("_id"))
                         & F.col(self.event_time).eqNullSafe(F.col("_time")), "left_anti")

    def store(self, rows, compare, fresh):
        """Append the stamped ``fresh`` rows and those of ``compare`` that are not stored yet, both out of ``rows``, by one
        write."""
        rows.persist()
        try:
            new = fresh if compare.isEmpty() else fresh.unionByName(self.unknown(compare))
            self._insert(self.matched(new, "null"))
        finally:
            rows.unpersist()

    def _insert(self, rows):
        placed = rows.hint("rebalance", "event_date").sortWithinPartitions("event_date", self.record_id)
        placed.write.insertInto(self.name)
        rows.sparkSession.catalog.refreshTable(self.name)

    def read(self, spark):
        return spark.table(resolve(spark, self.name))

    def read_range(self, spark, start, end, by_text=False):
        """All versions whose key lies in the range, both ends included; an error when there are none."""
        rows = self.read(spark).where(key_between(F.col(self.record_id), start, end, by_text))
        return require_rows(rows, f"{self.name} from {start} to {end}")

    def latest(self, spark):
        """The newest, not deleted record of every key. Of versions with equal times the one with the
        larger values stays, column by column, so that the choice does not depend on the shuffle."""
        rows = self.read(spark).drop("event_date")
        first = [self.event_time, "write_time", "is_deleted"]
        rest = sorted(c for c in rows.columns if c not in (self.record_id, *first))
        return latest_records(rows, self.record_id, [*first, *rest], "is_deleted")
