import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larkspur.operators import split


def brute(rows, test_size, seed):
    """First rows of each class by digest, with largest-remainder quotas."""
    counts = Counter(c for _, c in rows)
    total = len(rows)
    want = math.ceil(test_size * total)
    quota = {c: want * n // total for c, n in counts.items()}
    for c in sorted(counts, key=lambda c: (-(want * counts[c] % total), c))[: want - sum(quota.values())]:
        quota[c] += 1
    out = set()
    for c in counts:
        ids = sorted((k for k, x in rows if x == c), key=lambda k: hashlib.md5(f"{k}|{seed}".encode()).hexdigest())
        out |= set(ids[: quota[c]])
    return out


@pytest.mark.parametrize("sort_limit", [3, 50, 100_000])
@pytest.mark.parametrize("test_size", [0.0, 0.2, 0.5, 1.0])
def test_split_equals_brute_force(spark, sort_limit, test_size):
    rows = [(f"k{i}", "abc"[i % 7 % 3]) for i in range(997)] + [("single", "z")]
    df = spark.createDataFrame(rows, "id string, y string")
    out = split.mark_test(df, "y", test_size, 42, ["id"], True, sort_limit=sort_limit).collect()
    assert len(out) == len(rows)
    assert {r.id for r in out if r.is_test} == brute(rows, test_size, 42)


def test_split_ignores_partitioning(spark):
    df = spark.range(500).select("id", (F.col("id") % 2).alias("y"))
    one = split.mark_test(df.coalesce(1), "y", key=["id"], unique_key=True)
    many = split.mark_test(df.repartition(7), "y", key=["id"], unique_key=True)
    assert set(map(tuple, one.collect())) == set(map(tuple, many.collect()))


@pytest.mark.parametrize("sort_limit", [2, 100_000])
def test_one_key_with_a_third_of_the_rows(spark, sort_limit):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") % 2).alias("y"),
        F.col("id").alias("v"),
    )
    out = split.mark_test(df, "y", 0.2, 1, ["k"], sort_limit=sort_limit)
    counts = {(r.y, r.is_test): r["count"] for r in out.groupBy("y", "is_test").count().collect()}
    assert counts == {(0, True): 300, (0, False): 1200, (1, True): 300, (1, False): 1200}
    assert out.select("v").distinct().count() == 3000


def test_copies_are_divided_by_number(spark, monkeypatch):
    monkeypatch.setattr(split, "COPY_CHUNK", 7)
    rows = [("x", 0)] * 100 + [("y", 0)] * 3 + [("x", 1)] * 51
    df = spark.createDataFrame(rows, "c string, y int")
    out = split.mark_test(df, "y")
    assert Counter((r.c, r.y) for r in out.collect()) == Counter(rows)
    counts = {(r.y, r.is_test): r["count"] for r in out.groupBy("y", "is_test").count().collect()}
    # 31 test rows of 154: shares 20.7 and 10.3.
    assert counts == {(0, True): 21, (0, False): 82, (1, True): 10, (1, False): 41}


def test_null_class_and_empty_input(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(20)], "id int, y string")
    assert split.mark_test(df, "y", 0.5, key=["id"]).where("is_test").count() == 10
    assert split.mark_test(df.where("false"), "y").isEmpty()


def test_quotas_with_equal_remainders():
    assert split.quotas({"a": 5, "b": 5}, 0.3) == {"a": 2, "b": 1}
    assert split.quotas({"a": 841, "b": 659}, 0.2) == {"a": 168, "b": 132}


def test_three_parts(spark):
    df = spark.range(1000).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    parts, sizes = split.mark_parts(df, "y", key=["id"], unique_key=True)
    counted = {(r.part, r.y): r["count"] for r in parts.groupBy("part", "y").count().collect()}
    assert counted == {(p, y): n for p, by in sizes.items() for y, n in by.items()}
    assert counted == {("test", 0): 150, ("test", 1): 50, ("validation", 0): 120, ("validation", 1): 40,
                       ("train", 0): 480, ("train", 1): 160}
    assert parts.select("id").distinct().count() == 1000


def test_three_parts_of_copies(spark):
    rows = [("x", 0)] * 100 + [("y", 0)] * 3 + [("x", 1)] * 51
    df = spark.createDataFrame(rows, "c string, y int")
    parts, sizes = split.mark_parts(df, "y")
    counted = Counter((r.part, r.y) for r in parts.collect())
    assert counted == {(p, y): n for p, by in sizes.items() for y, n in by.items() if n}
    assert Counter((r.c, r.y) for r in parts.collect()) == Counter(rows)


def test_a_split_is_one_pass_without_a_shuffle(spark):
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("y"))
    plan = split.mark_parts(df, "y", key=["id"], unique_key=True)[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in plan and plan.count("Range (") == 1


def test_rows_that_differ_below_a_millisecond_stay_three(spark):
    rows = spark.sql("""SELECT 'k' AS k, 0 AS y, timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id / 1e6) AS t
                        FROM range(3)""")
    out = split.mark_test(rows, "y", 0.5, 1, ["k"]).collect()
    assert len(out) == 3 and len({r.t for r in out}) == 3 and sum(r.is_test for r in out) == 2


@pytest.mark.parametrize("sort_limit", [5, 100_000])
def test_more_classes_than_the_driver_takes(spark, monkeypatch, sort_limit):
    rows = [(f"k{i}", f"c{i % 40}" if i % 3 else "hot") for i in range(600)]
    df = spark.createDataFrame(rows, "id string, y string")
    want = {tuple(r) for r in split.mark_test(df, "y", 0.2, 42, ["id"], True).collect()}
    monkeypatch.setattr(split, "CLASS_LIMIT", 3)
    got = split.mark_test(df, "y", 0.2, 42, ["id"], True, sort_limit=sort_limit)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    parts, sizes = split.mark_parts(df, "y", key=["id"], unique_key=True)
    assert sizes is None and Counter(r.part for r in parts.collect()) == {"test": 120, "validation": 96, "train": 384}
