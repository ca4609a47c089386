"""Output of a stream kept batch by batch, so that a batch that comes twice replaces itself."""


def batch_path(spark, path, batch_id):
    """The folder of a batch. The query's id stays the same as long as its checkpoint, so a new checkpoint, whose
    batches are counted from 0 again, writes elsewhere."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{path}/query={query}/batch={batch_id}"


def write_batch(rows, path, batch_id):
    rows.write.mode("overwrite").parquet(batch_path(rows.sparkSession, path, batch_id))


def read_batches(spark, path, schema):
    """The rows of all batches, without the columns of the folders."""
    return spark.read.schema(schema + ", query string, batch long").parquet(path).drop("query", "batch")
