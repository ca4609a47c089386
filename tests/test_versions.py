import bisect
import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from larkspur.operators import ranking, versions
from larkspur.session import new_path
from larkspur.sources.bucketed_group import BucketedGroup
from larkspur.sources import registry
from larkspur.sources.newest import NewestTable

DAY = datetime(2024, 1, 1)


def test_latest_drops_deleted_and_breaks_ties(spark):
    rows = [("a", 1, 1, False, "old"), ("a", 2, 1, False, "new"), ("b", 1, 1, False, "live"), ("b", 2, 1, True, "gone"),
            ("c", 1, 1, False, "first"), ("c", 1, 2, False, "rewritten")]
    df = spark.createDataFrame(rows, "k string, t int, w int, d boolean, v string")
    got = versions.latest_records(df, "k", ["t", "w"], "d").collect()
    assert {(r.k, r.v) for r in got} == {("a", "new"), ("c", "rewritten")} and "d" not in got[0]


def test_as_of_equals_brute_force(spark):
    """One key holds half of the versions and questions; many fall on equal times."""
    rnd = random.Random(3)

    def key():
        return "hot" if rnd.random() < 0.5 else f"k{rnd.randrange(20)}"

    def moment():
        return DAY + timedelta(minutes=rnd.randrange(60 * 24 * 40) // 7 * 7)

    facts = [(key(), moment(), i, i % 11 == 0, i * 1.0) for i in range(3000)]
    asked = [(key(), moment()) for _ in range(3000)] + [("nobody", DAY)]
    best = {}
    for k, t, w, d, v in facts:
        best[(k, t)] = max(best.get((k, t), (-1,)), (w, d, v))
    line = {}
    for k, t in sorted(best):
        line.setdefault(k, []).append(t)

    def answer(k, at):
        i = bisect.bisect_right(line.get(k, []), at)
        if i == 0:
            return None, None
        t = line[k][i - 1]
        _, deleted, value = best[(k, t)]
        return (None, None) if deleted else (t, value)

    left = spark.createDataFrame(asked, "k string, at timestamp")
    right = spark.createDataFrame(facts, "k string, t timestamp, w int, d boolean, v double")
    for period, hot_rows in (("hour", 500), ("month", 500), ("day", 0), ("hour", 1_000_000)):
        out = versions.as_of(left, right, "k", "at", "t", ["v"], ["w"], "d", period, hot_rows).collect()
        got = sorted(repr((r.k, r["at"], r.feature_t, r.v)) for r in out)
        assert got == sorted(repr((k, at, *answer(k, at))) for k, at in asked)


def test_as_of_with_too_many_hot_keys_to_list(spark, monkeypatch):
    monkeypatch.setattr(versions, "HOT_KEYS", 2)
    right = spark.range(50).select(
        (F.col("id") % 5).alias("k"), F.timestamp_seconds(F.col("id") * 3000).alias("t"), F.col("id").alias("v"))
    left = spark.range(5).select(F.col("id").alias("k"), F.timestamp_seconds(F.lit(100000)).alias("at"))
    got = {r.k: r.v for r in versions.as_of(left, right, "k", "at", "t", ["v"], hot_rows=1).collect()}
    assert got == {0: 30, 1: 31, 2: 32, 3: 33, 4: 29}


def test_as_of_forms_no_pairs(spark):
    left = spark.range(10).select(F.lit("k").alias("k"), F.current_timestamp().alias("at"))
    right = spark.range(10).select(F.lit("k").alias("k"), F.current_timestamp().alias("t"), F.col("id").alias("v"))
    plan = versions.as_of(left, right, "k", "at", "t", ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and plan.count("Join") == 1


def test_keys_shared_and_left_out(spark):
    a, b = spark.range(0, 6), spark.range(5, 9)
    assert [r.id for r in versions.shared_keys(a, b, "id").collect()] == [5]
    assert {r.id for r in versions.without_keys(b, a, "id").collect()} == {6, 7, 8}


def test_row_numbers_agree(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 9).cast("string")).alias("g"),
        F.pmod(F.hash("id"), F.lit(500)).alias("o"), "id",
    )
    expected, place = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r.g, r.o, r.id)):
        place[r.g] = place.get(r.g, 0) + 1
        expected[r.id] = place[r.g]
    by_bucket = ranking.row_number_by_bucket(df, ["g"], F.floor(F.col("o") / 50), ["o", "id"], "n")
    by_range = ranking.row_number_by_range(df, ["g"], ["o", "id"], "n")
    assert {r.id: r.n for r in by_bucket.collect()} == expected
    assert {r.id: r.n for r in by_range.collect()} == expected


def test_newest_with_status(spark):
    rows = [("g", "m1", "Approved", 1), ("g", "m2", "Approved", 2), ("g", "m3", "PendingManualApproval", 3),
            ("h", "m4", "PendingManualApproval", 1), ("e", "m5", "Approved", 1), ("e", "m6", "Approved", 1)]
    df = spark.createDataFrame(rows, "group string, model_path string, status string, created_at int")
    got = {r["group"]: r.model_path for r in registry.newest_with_status(df, "group", tie=["model_path"]).collect()}
    assert got == {"g": "m2", "e": "m6"}


def exchanges_above_scan(df, table_marker):
    """Exchanges on the paths from the plan's root to the scans of the bucketed table."""
    counts, above = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        above = [(d, x) for d, x in above if d < depth]
        if "FileScan" in line and table_marker in line:
            counts.append(sum("Exchange" in x for _, x in above))
        above.append((depth, line.split("(")[0] if "Exchange" in line.split("(")[0] else line.split("[")[0]))
    return counts


def test_bucketed_versions_are_read_where_they_lie(spark):
    group = BucketedGroup("bucketed_features", new_path(spark, "bucketed"), buckets=4)
    k = F.col("id")
    rows = spark.range(400).select(
        F.when(k % 37 != 0, F.format_string("CUST_%06d", k % 23)).alias("customer_id"),
        (F.lit("2024-01-01T00:00:00Z").cast("timestamp") + F.make_dt_interval(hours=F.pmod(F.xxhash64("id"), F.lit(90)).cast("int"))).alias("event_time"),
        (k % 11).cast("double").alias("x"), (k % 29 == 0).alias("is_deleted"))
    group.append(rows.where("x < 5"), "2024-02-01T00:00:00Z").append(rows.where("x >= 5"), "2024-02-02T00:00:00Z")
    group.append_new(rows.withColumn("x", F.lit(99.0)), "2024-02-03T00:00:00Z")
    assert group.read(spark).count() == 400 and group.read(spark).where("x = 99").isEmpty()
    spine = rows.where("x % 2 = 0").select("customer_id", F.col("event_time").alias("at"), F.col("x").cast("long").alias("note")).unionByName(
        spark.createDataFrame([("nobody", None, 1), ("CUST_000001", None, 2)], "customer_id string, at timestamp, note long"))
    plain = versions.as_of(spine, group.read(spark), "customer_id", "at", "event_time", ["x"], ["write_time", "is_deleted", "x"], "is_deleted")
    for hot in (1_000_000, 17, 0):
        got = group.as_of(spine, "at", ["x"], hot_rows=hot)
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    joins = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert exchanges_above_scan(group.latest(spark), "bucketed_features") == [0]
        assert set(exchanges_above_scan(group.as_of(spine, "at", ["x"]), "bucketed_features")) == {0}
        assert exchanges_above_scan(group.read(spark).groupBy("x").count(), "bucketed_features") == [1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", joins)


def kept_newest(spark, buckets=8):
    group = BucketedGroup(f"kept_{uuid.uuid4().hex}", new_path(spark, "kept"), buckets=2)
    return NewestTable(group, new_path(spark, "kept-newest"), buckets)


def kept_rows(spark, n, seed):
    k = F.xxhash64(F.lit(seed), "id")
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 41 != 0, F.format_string("k%d", F.pmod(k, F.lit(60)))).alias("customer_id"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(50)) * 3600).alias("event_time"),
        (k % 7).cast("double").alias("x"), (k % 5 == 0).alias("is_deleted"))


def test_merged_newest_equals_the_full_aggregate(spark):
    """Batches in no order of time, a third of the rows on one key, keys that are NULL, deleted records, and a batch merged twice."""
    kept = kept_newest(spark)
    for i in range(4):
        kept.append(kept_rows(spark, 150, i), f"2024-02-0{4 - i}T00:00:00Z")
        assert sorted(map(str, kept.latest(spark).collect())) == sorted(map(str, kept.group.latest(spark).select(
            *kept.latest(spark).columns).collect()))
    before = sorted(map(str, kept.latest(spark).collect()))
    kept.catch_up(spark, "2024-02-02T00:00:00Z")
    assert sorted(map(str, kept.latest(spark).collect())) == before
    assert kept.merge(kept.group.read(spark).limit(0)).places(spark)[1] == 5, "an empty batch notes no merge"
    assert "Exchange" not in kept.latest(spark)._jdf.queryExecution().executedPlan().toString()


def test_a_merge_reads_and_writes_touched_buckets_only(spark, monkeypatch):
    kept = kept_newest(spark)
    kept.append(kept_rows(spark, 200, 1), "2024-02-01T00:00:00Z")
    assert len(kept.places(spark)[0]) == 8
    read, plain = [], NewestTable.stored
    monkeypatch.setattr(NewestTable, "stored", lambda self, s, places: read.append(sorted(places)) or plain(self, s, places))
    kept.append(kept_rows(spark, 1, 1), "2024-02-02T00:00:00Z")
    places, last = kept.places(spark)
    newest = kept.merges(spark).where(F.col("number") == last).first()
    assert last == 2 and len(newest.buckets) == 1 and read == [list(newest.buckets)]
    assert [b for b, folder in places.items() if folder == newest.folder] == list(newest.buckets)


def test_a_broken_or_rival_merge_changes_nothing(spark, monkeypatch):
    kept = kept_newest(spark)
    kept.append(kept_rows(spark, 50, 1), "2024-02-01T00:00:00Z")
    before = sorted(map(str, kept.latest(spark).collect()))
    lost = kept.group.read(spark).withColumn("x", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        kept.merge(lost)
    plain, calls = NewestTable.places, []

    def rival(self, s):
        calls.append(1)
        found, last = plain(self, s)
        return found, last + (len(calls) > 1)

    monkeypatch.setattr(NewestTable, "places", rival)
    with pytest.raises(RuntimeError, match="another merge"):
        kept.merge(kept.group.read(spark).withColumn("x", F.lit(9.0)))
    monkeypatch.undo()
    assert sorted(map(str, kept.latest(spark).collect())) == before


def test_buckets_grow_with_the_rows(spark, sf_dir, monkeypatch):
    from larkspur.plans import queries
    from larkspur.sources import bucketed_group

    monkeypatch.setattr(bucketed_group, "BUCKET_ROWS", 500)
    asked = queries.fx.table(spark, sf_dir, "lineitem").count()
    group = queries.versions_in_buckets(spark, sf_dir, asked)
    versions = group.read(spark).count()
    assert group.buckets == -(-(asked + versions) // 500) > 8
    got = queries.bucketed_as_of(spark, sf_dir)
    monkeypatch.setattr(bucketed_group, "BUCKET_ROWS", 10**9)
    assert sorted(map(str, got.collect())) == sorted(map(str, queries.bucketed_as_of(spark, sf_dir).collect()))
