"""Reads over event-time versions: newest record per key, value as of a time, shared keys."""

from pyspark.sql import Window, functions as F, types as T

from larkspur.session import small_table

# A key with more rows than the first is cut into periods; with more such keys than the second, all are.
HOT_ROWS = 1_000_000
HOT_KEYS = 100_000


def latest_records(df, key, order, deleted=None):
    """Newest version of every key by ``order``; a key whose newest version is deleted is left out.

    An aggregate, not a window: versions collapse before the shuffle, so a key with a large part of
    all versions costs no more than another.
    """
    rest = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_v")
    out = df.groupBy(key).agg(newest).select(key, "_v.*")
    return out.where(~F.col(deleted)).drop(deleted) if deleted else out


def as_of(spine, versions, key, at, event_time, values, order=(), deleted=None, period="hour",
          hot_rows=HOT_ROWS):
    """Every spine row with the newest version whose event time is not after ``at``.

    No pairs are formed. Versions and asked times are laid on one line per key, and a window along
    the line takes the last version. Keys with more than ``hot_rows`` rows are counted out first:
    their lines are cut into calendar periods, one window each, and a period starts with the version
    carried over from the periods before it. Equal times count once on both sides before the shuffle.
    """
    rank = F.struct(*order) if order else F.struct(F.lit(0))
    fields = [*values, *([deleted] if deleted else [])]
    collapsed = versions.groupBy(key, F.col(event_time).alias("_t")).agg(
        F.max_by(F.struct(F.col(event_time).alias("_since"), *fields), rank).alias("_v")
    )
    asked = spine.select(key, F.col(at).alias("_t")).distinct()
    line = collapsed.withColumn("_kind", F.lit(1)).unionByName(
        asked.withColumn("_kind", F.lit(2)), allowMissingColumns=True
    )
    answers = _last_versions(_in_periods(line, spine, versions, key, period, hot_rows), key, at)
    value = F.when(~F.col("_v")[deleted], F.col("_v")) if deleted else F.col("_v")
    return spine.join(answers, [key, at], "left").withColumn("_v", value).select(
        *spine.columns,
        F.col("_v._since").alias(f"feature_{event_time}"),
        *[F.col("_v")[c].alias(c) for c in values],
    )


def _in_periods(line, spine, versions, key, period, hot_rows):
    """Add ``_period``, the calendar period for rows of hot keys; without hot keys there is none."""
    rows = versions.select(key).unionAll(spine.select(key)).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    hot = rows.where(F.col("n") > hot_rows).select(key).limit(HOT_KEYS + 1).collect()
    if not hot:
        return line
    cut = F.date_trunc(period, "_t")
    if len(hot) > HOT_KEYS:
        return line.withColumn("_period", cut)
    schema = T.StructType([T.StructField("_hot", line.schema[key].dataType)])
    side = F.broadcast(small_table(line.sparkSession, [(r[0],) for r in hot], schema))
    near = line.join(side, F.col(key) == F.col("_hot"), "left")
    return near.withColumn("_period", F.when(F.col("_hot").isNotNull(), cut)).drop("_hot")


def _last_versions(line, key, at):
    group = [key]
    if "_period" in line.columns:
        group = [key, "_period"]
        cut = line.where("_period is not null")
        ends = cut.groupBy(key, "_period").agg(
            F.max_by("_v", F.when(F.col("_kind") == 1, F.col("_t"))).alias("_v")
        )
        earlier = Window.partitionBy(key).orderBy("_period").rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.select(
            key, F.col("_period").alias("_t"), F.last("_v", ignorenulls=True).over(earlier).alias("_v"),
            F.lit(0).alias("_kind"), "_period",
        ).where("_v is not null")
        line = line.unionByName(carried)
    so_far = Window.partitionBy(*group).orderBy("_t", "_kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        line.withColumn("_v", F.last("_v", ignorenulls=True).over(so_far))
        .where("_kind = 2")
        .select(key, F.col("_t").alias(at), "_v")
    )


def shared_keys(left, right, key):
    return left.select(key).join(right.select(key), key, "left_semi").distinct()


def without_keys(left, right, key):
    return left.join(right.select(key), key, "left_anti")


def attach(left, right, key, how="left"):
    """Line up rows by key: predictions beside truth or customers."""
    return left.join(right, key, how)
