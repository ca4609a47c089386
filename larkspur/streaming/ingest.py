"""Raw rows as a stream into the feature table."""

from pyspark.sql import functions as F

from larkspur.operators.clean import clean_raw
from larkspur.session import small_table

#: How long the state remembers the keys and event times that have arrived.
MEMORY = "7 days"


def ingest(stream, group, checkpoint, run_ts, memory=MEMORY):
    """Append everything that is available now to the feature group, each key and event time once; a restart goes on from
    the checkpoint.

    Two ways keep copies out. The state store holds what has arrived within ``memory``; no row of an event time within it can have
    come earlier, so such rows are stored without a look at the table. Late rows, with an event time before that or after
    their arrival, are compared with the stored rows of the dates that they name. The watermark is on the time of
    arrival, which only rises, so no row is ever dropped for being late.

    Compared as well are all rows of a process's first batch, which may be a batch that was stored just before a
    failure, and rows that may have been stored before the checkpoint was begun. Recent rows should
    come through one stream only; other writers append what is older than ``memory``, or the memory is "0 seconds".
    """
    rows = group.stamp(clean_raw(stream), run_ts)
    group.ensure(rows)
    began = _began(stream.sparkSession, group, checkpoint)
    arrived = rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", memory)
    single = arrived.dropDuplicatesWithinWatermark([group.record_id, group.event_time])
    first = [True]

    def store(batch, batch_id):
        time, here = F.col(group.event_time), F.col("_arrived")
        known = (time >= here - F.expr(f"interval {memory}")) & (time <= here)
        if began:
            known = known & (time >= F.lit(began).cast("timestamp"))
        known = F.lit(False) if first[0] else F.coalesce(known, F.lit(False))
        group.store(batch, compare=batch.where(~known).drop("_arrived"), fresh=batch.where(known).drop("_arrived"))
        # A batch has a session of its own; the stream's session has to forget its list of files too.
        stream.sparkSession.catalog.refreshTable(group.name)
        first[0] = False

    return (
        single.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _began(spark, group, checkpoint):
    """When this checkpoint's state began, as text; empty where the table had no rows then. Kept beside the checkpoint."""
    path = f"{checkpoint.rstrip('/')}-began"
    now = "" if group.read(spark).isEmpty() else str(spark.sql("SELECT CAST(current_timestamp() AS string)").first()[0])
    small_table(spark, [(now,)], "value string").coalesce(1).write.mode("ignore").text(path)
    row = spark.read.text(path).first()
    return row["value"] if row else ""
