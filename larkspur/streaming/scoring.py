"""Rows or requests as a stream through a saved model; no state, so nothing to keep or to lose."""

from larkspur.operators.requests import bad_requests, score_requests
from larkspur.plans.infer import score
from larkspur.streaming.batches import read_batches, write_batch


def append_to(rows, path, checkpoint):
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def score_rows(stream, model, preprocess, path, checkpoint, clean=None):
    """Score raw rows with the saved medians and codes; a batch's own medians do not exist here."""
    rows = clean(stream) if clean else stream
    return append_to(score(rows, model, preprocess), path, checkpoint)


def score_request_stream(stream, model, preprocess, path, checkpoint, clean=None):
    """One stream, read once: answers below ``<path>/scored``, the other requests with reasons below ``<path>/rejected``.

    Both are kept per batch, and a batch that comes again after a failure replaces what it wrote, so each request is in
    one of the two once.
    """

    def store(batch, batch_id):
        batch.persist()
        try:
            write_batch(score_requests(batch, model, preprocess, clean), f"{path}/scored", batch_id)
            write_batch(bad_requests(batch, preprocess.features), f"{path}/rejected", batch_id)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def scored_requests(spark, path):
    return read_batches(spark, f"{path}/scored", "request_id string, row_no int, prediction int, probability double")


def rejected_requests(spark, path):
    return read_batches(spark, f"{path}/rejected", "request_id string, reason string")
