import pathlib
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from larkspur.operators.clean import clean_raw
from larkspur.schema import RAW
from larkspur.session import new_path
from larkspur.sources.feature_group import FeatureGroup
from larkspur.streaming import ingest, load

RUN = "2024-06-01T00:00:00Z"
START = datetime(2024, 1, 1)


def test_ingest_into_the_feature_group(spark):
    """Copies are stored once, late rows and rows without a time push nothing out, a restart goes on, and batch
    and stream rows are read back together."""
    source, state = new_path(spark, "raw"), new_path(spark, "state")
    group = FeatureGroup("streamed_features", new_path(spark, "features"))
    fields = [f"{n} string" for n in RAW.names]
    schema = ", ".join([*fields, "event_time string"])

    def rows(ids, day):
        time = f"2024-01-{day:02d}T00:00:00Z" if day else None
        return spark.createDataFrame([(f" CUST_{i:06d} ", "40", *["x"] * 12, time) for i in ids], schema)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        ingest.ingest(stream, group, state, RUN).awaitTermination()
        return group.read(spark)

    for ids, day in (([9], None), ([1, 2, 2, 3], 5), ([3, 4], 6)):
        rows(ids, day).coalesce(1).write.mode("append").parquet(source)
        run()
    assert run().count() == 6
    rows([3, 4], 6).coalesce(1).write.mode("append").parquet(source)
    rows([4], 4).coalesce(1).write.mode("append").parquet(source)
    got = run()
    assert got.count() == 7 and got.select("customer_id").distinct().count() == 5
    assert got.where("age = 40.0 and churn = 0 and not is_deleted").count() == 7
    group.append(clean_raw(rows([7], 8)), RUN)
    assert group.read(spark).count() == 8 and group.latest(spark).count() == 6


def test_minutes_are_written_when_closed(spark):
    source, out = new_path(spark, "calls"), new_path(spark, "minutes")
    rows = [(START + timedelta(seconds=10 * i), "a" if i % 3 else "b") for i in range(360)]
    calls = spark.createDataFrame(rows, "ts timestamp, endpoint string")
    calls.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(calls.schema).parquet(source)
    load.stream_requests_per_minute(stream, out, new_path(spark, "state"), per_instance=2, delay="5 minutes").awaitTermination()
    table = load.requests_per_minute(calls, per_instance=2)
    written = spark.read.parquet(out)
    assert written.exceptAll(table).isEmpty()
    # The watermark stands 5 minutes before the last call, 00:59:50.
    assert written.agg(F.max("minute")).first()[0] == START + timedelta(minutes=53)
    assert table.count() == 120


def test_instances_stay_within_bounds(spark):
    rows = [(START, "busy")] * 9000 + [(START, "calm")]
    calls = spark.createDataFrame(rows, "ts timestamp, endpoint string")
    got = {r.endpoint: (r.n_requests, r.instances) for r in load.requests_per_minute(calls).collect()}
    assert got == {"busy": (9000, 5), "calm": (1, 1)}


def test_only_late_rows_are_compared_with_stored_dates(spark, monkeypatch):
    """Recent copies are kept out by the state, across batches and a restart; only the dates of late rows are read."""
    source, state = new_path(spark, "raw"), new_path(spark, "state")
    group = FeatureGroup("remembered_features", new_path(spark, "features"))
    schema = ", ".join([*[f"{n} string" for n in RAW.names], "event_time string"])
    today = datetime.now(timezone.utc)
    compared = []
    plain = FeatureGroup.unknown

    def watched(self, rows):
        compared.append(sorted({r.event_date.isoformat() for r in rows.select("event_date").collect()}))
        return plain(self, rows)

    monkeypatch.setattr(FeatureGroup, "unknown", watched)

    def send(*rows):
        stamped = [(f"CUST_{i:06d}", "40", *["x"] * 12, (today - timedelta(days=d)).isoformat()) for i, d in rows]
        spark.createDataFrame(stamped, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        ingest.ingest(stream, group, state, RUN, "7 days").awaitTermination()
        return group.read(spark).count()

    day = lambda n: (today - timedelta(days=n)).date().isoformat()
    send((1, 1))
    send((1, 1), (2, 1), (3, 30))
    send((2, 1), (3, 30), (3, 31), (4, 2))
    send((1, 1), (4, 2))
    assert run() == 5
    # The first batch of the process, then late rows that the state has not met, and in the last batch nothing.
    assert compared == [[day(1)], [day(30)], [day(31)]]
    compared.clear()
    send((5, 1), (1, 1))
    send((6, 1), (5, 1), (7, -2))
    assert run() == 8
    assert compared == [[day(1)], [day(-2)]]
    # A new checkpoint on a table with rows: its state does not know them, so they are compared.
    compared.clear()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    ingest.ingest(stream, group, new_path(spark, "other"), RUN, "7 days").awaitTermination()
    assert group.read(spark).count() == 8 and len(compared) >= 3


def test_a_batch_that_comes_twice_counts_once(spark):
    """The commit of the last batch is lost, so that it runs again."""
    source, out, state = (new_path(spark, x) for x in ("calls", "minutes", "state"))
    calls = spark.createDataFrame([(START + timedelta(seconds=s), "a") for s in (0, 30, 59, 60)], "ts timestamp, endpoint string")

    def run():
        stream = spark.readStream.schema(calls.schema).parquet(source)
        load.count_minutes(stream, out, state).awaitTermination()
        return sorted((r.minute, r.n_requests, r.instances) for r in load.minute_counts(spark, out, per_instance=2).collect())

    calls.write.parquet(source)
    once = [(START, 3, 2), (START + timedelta(minutes=1), 1, 1)]
    assert run() == once
    calls.where("second(ts) = 59").write.mode("append").parquet(source)
    late = [(START, 4, 2), once[1]]
    assert run() == late
    commits = sorted(pathlib.Path(state, "commits").glob("[0-9]*"))
    for f in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        f.unlink(missing_ok=True)
    assert run() == late


def test_a_large_feed_is_cleaned_by_several_tasks(spark, sf_dir, monkeypatch):
    from larkspur.plans import queries

    def rows():
        return sorted(map(str, queries.stream_ingest_late(spark, sf_dir).collect()))

    want, made, add = rows(), [], queries.add_files
    monkeypatch.setattr(queries, "FILE_ROWS", 100)
    monkeypatch.setattr(queries, "add_files", lambda part, path, files: (made.append((path, files)), add(part, path, files)))
    assert rows() == want
    assert len(made) == 4 and made[0][1] > 1
    # Each part is as many files, so it is a batch of its own.
    assert len(spark.read.parquet(made[0][0]).inputFiles()) == sum(files for _, files in made)
