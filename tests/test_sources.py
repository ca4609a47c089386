import pathlib

import pytest
from pyspark.sql import functions as F, types as T

from larkspur.functions.keys import format_key
from larkspur.plans import ingest
from larkspur.session import new_path
from larkspur.sources import registry, tables
from larkspur.sources.feature_group import FeatureGroup

RUN = "2024-06-01T00:00:00Z"


def write_lines(spark, lines, name="lines"):
    path = new_path(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_csv_with_unlike_headers(spark):
    a = write_lines(spark, ["id,x", "1,one", "2,"])
    b = write_lines(spark, ["y,id", "why,3"])
    got = tables.read_csv_tables(spark, [a, b])
    assert {tuple(r) for r in got.collect()} == {("1", "one", None), ("2", None, None), ("3", None, "why")}


def test_many_csv_files_of_three_headers(spark):
    """Small files in one folder, a data line that equals a header, quoted and doubled names, short and long lines, a file without
    rows. What reaches the driver is one number and the names."""
    path = new_path(spark, "headers")
    heads = ["id,x", '"y, z",id', "id,x,x,,w"]
    folder = pathlib.Path(path.removeprefix("file:"))
    folder.mkdir(parents=True)
    for i in range(90):
        body = {0: f"{i},one\nid,x\n", 1: f'"a, ""b""",{i}\n', 2: f"{i},p,q,r,s,t,u\n{i}\n"}[i % 3]
        (folder / f"{i}.csv").write_text(heads[i % 3] + "\n" + body)
    (folder / "none.csv").write_text("")
    spark.createDataFrame([(heads[0],)], "value string").coalesce(1).write.mode("append").text(path)
    got = tables.read_csv_tables(spark, [path])
    assert got.columns == ["id", "x", "w", "y, z"]
    rows = sorted(map(tuple, got.collect()), key=str)
    expected = []
    for i in range(90):
        expected += {0: [(str(i), "one", None, None), ("id", "x", None, None)], 1: [(str(i), None, None, 'a, "b"')],
                     2: [(str(i), "p", "s", None), (str(i), None, None, None)]}[i % 3]
    assert rows == sorted(expected, key=str)
    with pytest.raises(ValueError, match="no paths"):
        tables.read_csv_tables(spark, [])


def test_ragged_and_headerless_rows(spark):
    path = write_lines(spark, ["1,a,2.5", "2,b", "3"])
    got = tables.read_csv(spark, path, "id int, t string, x double", header=False)
    assert {tuple(r) for r in got.collect()} == {(1, "a", 2.5), (2, "b", None), (3, None, None)}


def test_csv_keeps_quotes_commas_and_blanks(spark):
    rows = [(1, 'say "hi", you'), (2, "  padded "), (3, None), (4, "tab\there"), (5, "back\\slash")]
    df = spark.createDataFrame(rows, "id int, t string")
    path = tables.write_csv(df, new_path(spark, "csv"))
    assert sorted(map(tuple, tables.read_csv(spark, path, df.schema).collect())) == rows


def test_csv_line_breaks(spark):
    rows = [(1, "two\nlines"), (2, "one")]
    path = tables.write_csv(spark.createDataFrame(rows, "id int, t string"), new_path(spark, "csv"))
    got = tables.read_csv(spark, path, "id int, t string", line_breaks=True)
    assert sorted(map(tuple, got.collect())) == rows


def test_missing_texts_are_an_option(spark):
    path = write_lines(spark, ["NA", "None", "x"])
    assert tables.read_csv(spark, path, "t string", header=False).where("t is null").count() == 2
    assert tables.read_csv(spark, path, "t string", header=False, missing_texts=False).where("t is null").count() == 0


def test_parquet_is_preferred(spark):
    path, df = new_path(spark, "any"), spark.createDataFrame([(1, "a")], "id int, t string")
    tables.write_both(df, path)
    assert tables.read_any(spark, path, df.schema).collect() == df.collect()
    assert tables.read_csv(spark, f"{path}/data.csv", df.schema).collect() == df.collect()
    assert "parquet" in tables.read_any(spark, path, df.schema)._jdf.queryExecution().toString().lower()


def test_empty_directory(spark):
    path = tables.write_csv(spark.createDataFrame([], "id int"), new_path(spark, "none"))
    assert tables.read_csv(spark, path, "id int").isEmpty()


def test_resolve(spark):
    with pytest.raises(LookupError):
        tables.read_table(spark, "no_such_table_at_all")


def test_published_types(spark):
    kinds = [T.ShortType(), T.LongType(), T.FloatType(), T.DecimalType(9, 2), T.BooleanType(), T.StringType(), T.DateType()]
    assert [tables.published_type(k) for k in kinds] == ["bigint"] * 2 + ["double"] * 2 + ["boolean"] + ["string"] * 2


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_publish_appends_and_refuses_other_columns(spark, fmt):
    df = spark.createDataFrame([(1, True, "x, y", 1.5)], "n int, b boolean, t string, d double")
    name, path = f"published_{fmt}", new_path(spark, "pub")
    assert [tuple(r) for r in tables.publish(df, name, path, fmt).collect()] == [(1, True, "x, y", 1.5)]
    with pytest.raises(Exception):
        tables.publish(df, name, path, fmt)
    assert tables.publish(df, name, path, fmt, "append").count() == 2
    with pytest.raises(ValueError):
        tables.publish(df.drop("b"), name, new_path(spark, "pub"), fmt)


def test_run_directory(spark):
    path = new_path(spark, "runs")
    for run in ("r1", "r2"):
        tables.write_run(spark.range(3), path, run)
    assert {(r.run, r["count"]) for r in spark.read.parquet(path).groupBy("run").count().collect()} == {("r1", 3), ("r2", 3)}


def group_of(spark, name):
    return FeatureGroup(name, new_path(spark, name))


def test_feature_group(spark):
    group = group_of(spark, "fg_basic")
    rows = spark.range(1, 21).select(
        format_key(F.col("id")).alias("customer_id"), F.col("id").cast("int").alias("n"), F.lit(True).alias("flag")
    )
    group.append(rows, RUN)
    later = rows.where("n <= 5").withColumn("n", F.lit(100)).withColumn(
        "event_time", F.when(F.col("customer_id") == "CUST_000001", "bad").otherwise("2024-07-01T12:00:00+0000"))
    group.append(later, "2024-06-15T00:00:00Z")
    assert group.read(spark).count() == 25
    assert {f.name: f.dataType.simpleString() for f in group.read(spark).schema}["flag"] == "string"
    assert group.read_range(spark, 4, 6).count() == 5
    newest = {r.customer_id: r.n for r in group.latest(spark).collect()}
    assert len(newest) == 20 and newest["CUST_000001"] == 100 and newest["CUST_000006"] == 6
    with pytest.raises(ValueError):
        group.read_range(spark, 50, 60)


def test_ingest(spark):
    group, none = group_of(spark, "fg_ingest"), group_of(spark, "fg_none")
    raw = spark.createDataFrame([(" CUST_000001", "41", "one year")], "customer_id string, age string, contract_type string")
    raw.createOrReplaceTempView("raw_rows")
    ingest.ingest_table(spark, "raw_rows", group, RUN)
    assert [(r.customer_id, r.age, r.contract_type) for r in group.latest(spark).collect()] == [("CUST_000001", 41.0, "One Year")]
    with pytest.raises(ValueError):
        ingest.ingest(raw.where("false"), none, RUN)


def test_key_range_reaches_the_scan(spark):
    group = group_of(spark, "fg_push")
    group.append(spark.range(1, 9).select(format_key(F.col("id")).alias("customer_id"), "id"), RUN)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = group.read_range(spark, 2, 4).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(customer_id,CUST_000002)" in plan and "LessThanOrEqual(customer_id,CUST_000004)" in plan
    assert "write_time" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("by_key", [True, False])
def test_a_hot_key_is_written_by_many_tasks(spark, by_key):
    group = group_of(spark, f"fg_hot_{by_key}".lower())
    rows = spark.range(30000).select(
        format_key(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).alias("customer_id"), F.lit(1).alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        group.append(rows, RUN, by_key)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = group.read(spark)
    assert stored.count() == 30000
    files = stored.groupBy(F.input_file_name().alias("f")).agg(
        F.count_if(F.col("customer_id") == "CUST_000007").alias("hot"), F.count("*").alias("n")).collect()
    if by_key:
        assert max(r.n for r in files) < 15000 and sum(r.hot > 0 for r in files) > 1


def test_deleted_records_disappear_from_the_latest_read(spark):
    group = group_of(spark, "fg_deleted")
    df = spark.createDataFrame([("CUST_000001", 1), ("CUST_000002", 2)], "customer_id string, n int")
    group.append(df, RUN)
    group.append(df.limit(1).withColumn("is_deleted", F.lit(True)), "2024-06-02T00:00:00Z")
    assert group.latest(spark).count() == 1 and group.read(spark).count() == 3


def test_registry(spark):
    entries = registry.Registry(new_path(spark, "registry"))
    with pytest.raises(LookupError):
        entries.latest(spark, "g")
    good, poor = {"accuracy": 0.9, "f1_score": 0.8}, {"accuracy": 0.3}
    assert entries.register(spark, "g", "m1", good, "2024-01-01T00:00:00Z") == registry.APPROVED
    assert entries.register(spark, "g", "m2", poor, "2024-01-02T00:00:00Z") == registry.PENDING
    assert entries.register(spark, "g", "m3", poor, "2024-01-03T00:00:00Z", gate=True) is None
    assert entries.register(spark, "g", "m4", good, "2024-01-04T00:00:00Z") == registry.APPROVED
    assert entries.latest(spark, "g").model_path == "m4"
    assert entries.latest(spark, "g", registry.PENDING).model_path == "m2"
    numbered = registry.with_versions(entries.entries(spark), "group", ["created_at"], F.date_trunc("day", "created_at"))
    assert {r.model_path: r.version for r in numbered.collect()} == {"m1": 1, "m2": 2, "m4": 3}


def test_publishing_again_shows_the_new_rows(spark):
    name, path = "published_again", new_path(spark, "pub")
    assert tables.publish(spark.range(3), name, path, mode="overwrite").count() == 3
    got = tables.publish(spark.range(100, 105), name, path, mode="overwrite")
    assert sorted(r.id for r in got.collect()) == list(range(100, 105))
    with pytest.raises(ValueError):
        tables.publish(spark.range(3), name, new_path(spark, "elsewhere"))
    with pytest.raises(ValueError):
        tables.publish(spark.range(3).select(F.col("id").cast("string").alias("id")), name, path, mode="overwrite")


def test_appending_in_another_order_keeps_columns(spark):
    group = group_of(spark, "reordered")
    first = spark.createDataFrame([("a", 1, 2)], "customer_id string, age int, tenure_months int")
    group.append(first, "2024-06-01T00:00:00Z")
    other = spark.createDataFrame([("b", 7, 40.0)], "customer_id string, tenure_months int, age double")
    group.append(other, "2024-06-02T00:00:00Z")
    assert {(r.customer_id, r.age, r.tenure_months) for r in group.read(spark).collect()} == {("a", 1, 2), ("b", 40, 7)}
    with pytest.raises(ValueError):
        group.append(first.drop("age"), "2024-06-01T00:00:00Z")
    group.append(first.drop("age"), "2024-06-03T00:00:00Z", missing="null")
    with pytest.raises(ValueError):
        group.append(first.withColumn("more", F.lit(1)), "2024-06-01T00:00:00Z")


def test_latest_of_equal_times_is_always_the_same(spark):
    group = group_of(spark, "tied_versions")
    rows = spark.createDataFrame([("a", i, "2024-01-01T00:00:00Z") for i in range(50)], "customer_id string, age int, event_time string")
    group.append(rows.repartition(7), "2024-06-01T00:00:00Z")
    assert group.latest(spark).first()["age"] == 49


def test_unlike_files_of_one_directory(spark):
    path = new_path(spark, "unlike")
    spark.createDataFrame([(1, "x")], "a int, b string").coalesce(1).write.option("header", True).csv(path)
    spark.createDataFrame([("y", 2)], "c string, a int").coalesce(1).write.mode("append").option("header", True).csv(path)
    got = tables.read_csv_tables(spark, [path])
    assert {(r.a, r.b, r.c) for r in got.collect()} == {("1", "x", None), ("2", None, "y")}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_broken_run_loses_nothing(spark, fmt):
    name, path = f"published_broken_{fmt}", new_path(spark, "pub")
    tables.publish(spark.range(3), name, path, fmt)
    reader = spark.table(name)
    broken = spark.range(0, 100, numPartitions=4).select(F.when(F.col("id") < 90, F.col("id")).otherwise(
        F.raise_error(F.lit("lost")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        tables.publish(broken, name, path, fmt, "overwrite").count()
    assert spark.table(name).count() == 3
    # From its own rows, twice; who has read the former table still can.
    tables.publish(spark.table(name).where("id > 0"), name, path, fmt, "overwrite")
    assert tables.publish(spark.table(name), name, path, fmt, "append").count() == 4
    assert reader.count() == 3
    # Another catalog, which has no such table, finds the newest run.
    spark.sql(f"DROP TABLE {name}")
    with pytest.raises(FileExistsError):
        tables.publish(spark.range(1), name, path, fmt)
    assert spark.table(name).count() == 4
    assert tables.publish(spark.range(7), name, path, fmt, "overwrite").count() == 7
    assert tables.newest_run_folder(spark, new_path(spark, "nothing")) is None
