from pyspark.sql import functions as F

from larkspur.functions import keys, numbers, text, times
from larkspur.operators import clean

RUN = "2024-06-01T10:20:30Z"


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r[0] for r in df.select(expression(F.col("s")).alias("o"), "i").orderBy("i").select("o").collect()]


def test_strip_takes_all_white_space(spark):
    texts = [None, "", "   ", "\t a b \n", " x ", "\x1fq\x1c", "été", " é", "plain", "a\n"]
    assert values(spark, texts, text.strip) == [t if t is None else t.strip() for t in texts]


def test_title_case_matches_python(spark):
    texts = [
        None, "", "month-to-month", "FIBER OPTIC", "2nd", "don't", "None", "élan vital-été", "a-b-c 1a2b",
        "4-NOT SPECIFIED", "x", " two  blanks", "MiXeD_case.words", "a\tb",
    ]
    assert values(spark, texts, text.title_case) == [t if t is None else t.title() for t in texts]


def test_missing_texts(spark):
    assert values(spark, ["", "NA", "n/a", "None", "0", "none", None], text.missing_to_null) == [
        None, None, None, None, "0", "none", None,
    ]


def test_numbers(spark):
    texts = ["12", "1e3", "-.5", "12.", "+7", "abc", "1,000", "5d", "1_0", "nan", "inf", "1e999", None, ""]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "age string, i int")
    got = [r[0] for r in clean.parse_numbers(df, ["age"]).orderBy("i").select("age").collect()]
    assert got == [12.0, 1000.0, -0.5, 12.0, 7.0] + [None] * 9


def test_target(spark):
    texts = ["1", "0.9", "x", None, "-1.7", "1e30"]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "churn string, i int")
    got = [r[0] for r in clean.parse_target(df).orderBy("i").select("churn").collect()]
    assert got == [1, 0, 0, 0, -1, 0]


def test_keys(spark):
    df = spark.range(1).select(*[keys.format_key(F.lit(n)).alias(f"k{n}") for n in (1, 999999, 1000000)])
    assert tuple(df.first()) == ("CUST_000001", "CUST_999999", "CUST_1000000")


def test_key_range_is_inclusive_and_counts_numbers(spark):
    names = ["CUST_000001", "CUST_000004", "CUST_000005", "CUST_000006", "CUST_0000041"]
    df = spark.createDataFrame([(n,) for n in names], "k string")
    assert {r.k for r in df.where(keys.key_between(F.col("k"), 1, 5)).collect()} == set(names[:3])
    assert "CUST_0000041" in {r.k for r in df.where(keys.key_between(F.col("k"), 1, 5, by_text=True)).collect()}


def test_key_range_over_two_lengths(spark):
    names = ["CUST_999998", "CUST_999999", "CUST_1000000", "CUST_1000001", "CUST_9999999"]
    df = spark.createDataFrame([(n,) for n in names], "k string")
    got = {r.k for r in df.where(keys.key_between(F.col("k"), 999999, 1000000)).collect()}
    assert got == {"CUST_999999", "CUST_1000000"}


def test_event_time(spark):
    texts = [
        "2024-01-02T03:04:05+0200", "2024-01-02T03:04:05.250000+00:00", "2024-01-02 03:04:05", "2024-01-02",
        "2024-01-02T03:04:05Z", "soon", None,
    ]
    got = values(spark, texts, lambda c: times.iso_utc(times.parse_event_time(c, RUN)))
    assert got == [
        "2024-01-02T01:04:05+0000", "2024-01-02T03:04:05+0000", "2024-01-02T03:04:05+0000",
        "2024-01-02T00:00:00+0000", "2024-01-02T03:04:05+0000", "2024-06-01T10:20:30+0000",
        "2024-06-01T10:20:30+0000",
    ]


def test_event_time_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = values(spark, ["2024-01-02T03:04:05+0200", "2024-01-02 03:04:05", None],
                     lambda c: times.iso_utc(times.parse_event_time(c, RUN)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2024-01-02T01:04:05+0000", "2024-01-02T03:04:05+0000", "2024-06-01T10:20:30+0000"]


def test_absent_event_time_is_the_run_time(spark):
    df = clean.event_time_text(clean.set_event_time(spark.range(2), RUN))
    assert {r.event_time for r in df.collect()} == {"2024-06-01T10:20:30+0000"}


def test_null_literal(spark):
    df = spark.createDataFrame([(None, 1), (" a ", 2)], "s string, n int")
    assert [tuple(r) for r in clean.strip_text(df, "None").orderBy("n").collect()] == [("None", 1), ("a", 2)]


def test_hashed_values_stay_in_range(spark):
    df = spark.range(2000).select(
        numbers.hashed_uniform(F.col("id"), 1).alias("u"), numbers.uniform_int(18, 80, F.col("id"), 2).alias("i"),
        numbers.choice(["a", "b", "c"], F.col("id"), 3).alias("c"), numbers.bernoulli(F.lit(0.25), F.col("id"), 4).alias("b"),
    )
    r = df.agg(F.min("u"), F.max("u"), F.min("i"), F.max("i"), F.count_distinct("c"), F.avg("b")).first()
    assert 0 <= r[0] < r[1] < 1 and (r[2], r[3], r[4]) == (18, 79, 3) and 0.2 < r[5] < 0.3
    assert df.collect() == df.collect()


def test_stamped_name(spark):
    assert spark.range(1).select(times.stamped_name("m", RUN)).first()[0] == "m-1717237230"
