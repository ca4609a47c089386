"""Requests per minute and the instances they call for."""

from pyspark.sql import functions as F

from larkspur.streaming.batches import read_batches, write_batch

# Calls per instance and minute, fewest and most instances.
CALLS_PER_INSTANCE, MIN_INSTANCES, MAX_INSTANCES = 1000, 1, 5


def requests_per_minute(df, ts="ts", endpoint="endpoint", per_instance=CALLS_PER_INSTANCE,
                        fewest=MIN_INSTANCES, most=MAX_INSTANCES):
    """(endpoint, minute, n_requests, instances); the same on a table and on a stream."""
    counted = df.groupBy(F.window(ts, "1 minute"), endpoint).agg(F.count(F.lit(1)).alias("n_requests"))
    return _with_instances(counted.select(endpoint, F.col("window.start").alias("minute"), "n_requests"),
                           per_instance, fewest, most)


def _with_instances(counted, per_instance, fewest, most):
    wanted = F.ceil(F.col("n_requests") / F.lit(float(per_instance)))
    return counted.withColumn("instances", F.least(F.greatest(wanted, F.lit(fewest)), F.lit(most)).cast("int"))


def count_minutes(stream, path, checkpoint, ts="ts", endpoint="endpoint"):
    """Counts of each batch by endpoint and minute, kept per batch. No request is dropped, however late: it adds to its
    minute when the counts are read. No state is held."""

    def store(batch, batch_id):
        minute = F.date_trunc("minute", F.col(ts).cast("timestamp"))
        counted = batch.groupBy(F.col(endpoint).cast("string").alias("endpoint"), minute.alias("minute")).agg(
            F.count(F.lit(1)).alias("n_requests"))
        write_batch(counted, path, batch_id)

    return (
        stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def minute_counts(spark, path, per_instance=CALLS_PER_INSTANCE, fewest=MIN_INSTANCES, most=MAX_INSTANCES):
    """(endpoint, minute, n_requests, instances) as they stand now, late requests included."""
    parts = read_batches(spark, path, "endpoint string, minute timestamp, n_requests long")
    summed = parts.groupBy("endpoint", "minute").agg(F.sum("n_requests").alias("n_requests"))
    return _with_instances(summed, per_instance, fewest, most)


def stream_requests_per_minute(stream, path, checkpoint, ts="ts", endpoint="endpoint",
                               delay="10 minutes", **limits):
    """Closed minutes only: a minute is written once the watermark has passed its end."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return (
        requests_per_minute(timed, ts, endpoint, **limits)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
