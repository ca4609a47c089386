import statistics

import pytest
from pyspark.sql import functions as F

from larkspur.operators import columns, encode, impute
from larkspur.plans.preprocess import Preprocess, fit_preprocess, labelled_rows
from larkspur.session import new_path


def test_medians(spark):
    rows = [(1.0, None, 5, 2.0), (2.0, None, 5, float("nan")), (4.0, None, 6, 1.0), (None, None, 7, None)]
    df = spark.createDataFrame(rows, "odd double, none double, n int, nan double")
    assert impute.fit_medians(df) == {"odd": 2.0, "none": None, "n": 5.5, "nan": 1.5}
    assert impute.fit_medians(df.limit(1).coalesce(1))["odd"] is not None


@pytest.mark.parametrize("n", [1, 2, 1000, 4001])
def test_wide_medians_equal_plain_ones(spark, n):
    df = spark.range(n).select(
        (F.pmod(F.xxhash64("id"), F.lit(1000003)) / 7).alias("spread"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pmod(F.hash("id"), F.lit(9973)) / 3).alias("hot"),
        F.when(F.col("id") % 5 == 0, 1e300 * F.rand(1)).otherwise(F.col("id") * 1.0).alias("outliers"),
    ).persist()
    expected = {c: statistics.median(r[c] for r in df.collect()) for c in df.columns}
    assert impute.fit_medians(df, bins=5) == pytest.approx(expected, rel=1e-15)


def test_medians_of_nothing(spark):
    with pytest.raises(ValueError):
        impute.fit_medians(spark.createDataFrame([], "x double"))


def test_fill(spark):
    df = spark.createDataFrame([(None, None, 1), ("a", 2, None)], "t string, n int, m int")
    got = impute.fill_medians(impute.fill_unknown(df), {"n": 2.5, "m": None}).collect()
    assert [tuple(r) for r in got] == [("Unknown", 2.5, 1), ("a", 2.0, None)]


def test_codes_round_trip_and_unseen(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("10", None), ("2", "x")], "c string, one string")
    codes = encode.fit_codes(df, ["c", "one"])
    assert codes.lists == {"c": ["10", "2", "a", "b"], "one": ["x"]}
    new = spark.createDataFrame([("a", "x"), ("zzz", "y"), (None, None)], "c string, one string")
    assert [tuple(r) for r in encode.apply_codes(new, codes).collect()] == [(2.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


@pytest.mark.parametrize("limit", [5, 150, 100_000])
def test_codes_inline_broadcast_and_joined_agree(spark, limit):
    """Small limit: code table numbered over many tasks; larger ones: value lists."""
    df = spark.range(3000).select(
        "id", F.concat(F.lit("v"), (F.col("id") % 200).cast("string")).alias("many"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("hot"),
    )
    expected = {c: sorted({r[c] for r in df.collect()}) for c in ("many", "hot")}
    codes = encode.fit_codes(df, ["many", "hot"], limit=limit)
    assert {(r["column"], r["value"]): r["code"] for r in codes.to_table(spark).collect()} == {
        (c, v): i for c, texts in expected.items() for i, v in enumerate(texts)
    }
    got = encode.apply_codes(df, codes).join(df.withColumnsRenamed({"many": "m", "hot": "h"}), "id").collect()
    assert len(got) == 3000
    assert all(expected["many"][int(r.many)] == r.m and expected["hot"][int(r.hot)] == r.h for r in got)


def test_unseen_report_and_cardinality(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "c string")
    table = encode.code_table(df.where("c = 'a'"), ["c"])
    assert [tuple(r) for r in encode.unseen_report(df, table, ["c"]).collect()] == [("c", "b", 2)]
    assert [tuple(r) for r in encode.cardinality(df, ["c"]).collect()] == [("c", 2)]


def test_columns(spark):
    df = spark.createDataFrame([("1", 2, 3.0, "t", 0)], "customer_id string, is_deleted int, x double, s string, label int")
    assert columns.detect_target(df) == "label" and columns.detect_scoring_target(df) == "label"
    assert columns.drop_meta(df, "label").columns == ["x", "s", "label"]
    assert "is_deleted" in columns.drop_meta(df, "is_deleted").columns
    assert columns.drop_ids(df).columns == ["is_deleted", "x", "s", "label"]
    assert columns.text_columns(df, "s") == ["customer_id"] and columns.number_columns(df, "label") == ["is_deleted", "x"]
    assert columns.detect_target(df.select("x", "s")) == "s"
    with pytest.raises(ValueError):
        columns.detect_scoring_target(df.select("x"))
    with pytest.raises(ValueError):
        columns.select_features(df, ["x", "gone"])
    assert columns.select_features(df, ["s", "gone", "x"], lenient=True).columns == ["s", "x"]
    assert columns.default_meta(df.select("x"), ["is_deleted", "write_time"]).columns == ["x", "write_time", "is_deleted"]
    with pytest.raises(ValueError):
        columns.require_rows(df.where("false"))


def raw(spark):
    return spark.createDataFrame(
        [("1", 1.0, "a", "yes"), ("2", None, None, "no"), ("3", 5.0, "b", "yes"), ("4", 9.0, "a", None)],
        "customer_id string, x double, c string, label string",
    )


def test_preprocess_fit_apply_save_load(spark):
    df = raw(spark)
    fitted = fit_preprocess(df)
    assert (fitted.target, fitted.numeric, fitted.categorical) == ("label", ["x"], ["c"])
    assert fitted.medians == {"x": 3.0} and fitted.target_classes == ["no", "yes"]
    path = new_path(spark, "prep")
    fitted.save(spark, path)
    loaded = Preprocess.load(spark, path)
    for p in (fitted, loaded):
        out = p.apply(labelled_rows(df, p), keep=["customer_id"]).orderBy("customer_id").collect()
        assert [tuple(r) for r in out] == [("1", 1.0, 1.0, 1.0), ("2", 0.0, 3.0, 0.0), ("3", 1.0, 5.0, 2.0)]


def test_batch_scope_takes_the_rows_own_median(spark):
    fitted = fit_preprocess(raw(spark))
    new = spark.createDataFrame([(None, "a"), (10.0, "b"), (20.0, "b")], "x double, c string")
    assert sorted(r.x for r in fitted.apply(new, scope="batch").collect()) == [10.0, 15.0, 20.0]
    assert sorted(r.x for r in fitted.apply(new).collect()) == [3.0, 10.0, 20.0]


def test_filled_target(spark):
    fitted = fit_preprocess(raw(spark), fill_target=True)
    assert fitted.target_classes == ["Unknown", "no", "yes"]
    assert labelled_rows(raw(spark), fitted, fill_target=True).where("label is null").isEmpty()


@pytest.mark.parametrize("limit", [50_000, 0])
@pytest.mark.parametrize("spread", [8, 0])
def test_medians_by_sketch_are_exact(spark, monkeypatch, limit, spread):
    """Also where the values of the bracket are counted in bins, and where brackets of one value miss."""
    monkeypatch.setattr(impute, "DRIVER_VALUES", limit)
    monkeypatch.setattr(impute, "SPREAD", spread)
    k = F.col("id")
    rows = spark.range(0, 20_001, numPartitions=7).select(
        F.pmod(F.xxhash64(k), F.lit(1_000_000)).cast("double").alias("many"), (k % 3).cast("double").alias("few"),
        F.when(k % 2 == 0, F.lit(5.0)).otherwise(k.cast("double")).alias("half"), F.when(k == 7, F.lit(1.5)).alias("one"),
        F.lit(None).cast("double").alias("none"), F.when(k % 5 == 0, F.lit(float("nan"))).otherwise(-k.cast("double")).alias("nans"),
        F.when(k % 2 == 0, F.lit(-1.7e308)).otherwise(F.lit(1.7e308)).alias("wide"), (k * 3).alias("whole"))
    found = impute.fit_medians(rows, k=64)
    wanted = rows.toPandas()
    for c in wanted:
        values = wanted[c].dropna()
        middle = sorted(values)[(len(values) - 1) // 2:len(values) // 2 + 1]
        assert found[c] == ((middle[0] + middle[-1]) / 2 if middle else None), c


def test_hot_values_do_not_enter_the_join(spark):
    """Half of the rows hold one value, a quarter another without a code; the join's own input is the rest."""
    k = F.col("id")
    rows = spark.range(0, 8_000, numPartitions=4).select(k, F.when(k % 2 == 0, "hot").when(k % 4 == 1, "strange").when(
        k % 8 == 3, k.cast("string")).alias("a"), F.concat(F.lit("v"), k % 700).alias("b"))
    table = encode.wide_code_table(rows.where("a is null or a <> 'strange'"), ["a", "b"])
    codes = encode.Codes({}, table, ["a", "b"])
    assert set(encode.frequent_values(rows, ["a", "b"])["a"]) == {"hot", "strange"}
    codes_of = {(r["column"], r["value"]): float(r["code"]) for r in table.collect()}
    for frequent in (None, {}, {"a": ["hot"], "b": ["v1", "v2"]}):
        got = {r["id"]: (r["a"], r["b"]) for r in encode.apply_codes(rows, codes, frequent=frequent).collect()}
        assert got == {r["id"]: (codes_of.get(("a", r["a"]), 0.0), codes_of.get(("b", r["b"]), 0.0)) for r in rows.collect()}
    one = encode.apply_codes(rows.select("id", "a"), encode.Codes({}, table, ["a"]))
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftOuter") == 1 and plan.startswith("Union")
    joined = rows.where("not coalesce(a in ('hot', 'strange'), false)").count()
    assert joined == 2_000 and encode.apply_codes(rows.limit(0), codes).count() == 0


def test_distinct_whole_numbers(spark):
    k = F.col("id")
    rows = spark.range(0, 70_000, numPartitions=5).select(
        k.alias("each"), (k % 1000 - 500).alias("few"), (k * 10**14).alias("far"), F.when(k % 7 == 0, k * 32_768).alias("steps"),
        F.lit(None).cast("long").alias("none"), F.when(k == 3, F.lit(-(1 << 62))).otherwise(F.lit(1 << 61)).alias("ends"), (k * 0 + 5).cast("int").alias("one"))
    found = {r["column"]: r["n_values"] for r in encode.distinct_whole_numbers(rows, rows.columns).collect()}
    assert found == {"each": 70_000, "few": 1000, "far": 70_000, "steps": 10_000, "none": 0, "ends": 2, "one": 1}
    assert encode.distinct_whole_numbers(rows, []).count() == 0
