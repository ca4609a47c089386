"""Inputs of the registered queries, derived from the given tables (FIXTURES.md)."""

from pyspark.sql import functions as F

from larkspur.functions.keys import format_key

MONEY = "decimal(12,2)"


# The columns that are read, with their types, so that no file is opened to infer them.
TABLES = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_regionkey int",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
    "events": "ts timestamp_ntz, user_id long, event_type string",
    "labels": "doc_id long, quality int, toxic int",
    "documents": "doc_id long, n_chars long",
    "embeddings": "vec_id long, label int",
}


def table(spark, sf_dir, name):
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def churn_raw(spark, sf_dir):
    """One messy text row per customer that has orders."""
    orders = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast(MONEY)
    per_customer = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.max(price).alias("top_price"),
        F.sum(price).alias("all_prices"),
        F.max("o_orderpriority").alias("priority"),
        F.max_by("o_orderstatus", "o_orderkey").alias("last_status"),
    )
    phones = table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey")).distinct()
    rows = (
        table(spark, sf_dir, "customer")
        .join(per_customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(phones.withColumn("has_phone", F.lit(True)), "c_custkey", "left")
    )
    newest = orders.agg(F.max("o_orderdate")).scalar()
    k = F.col("c_custkey")
    segment = F.col("c_mktsegment")

    def text(c):
        return c.cast("string")

    def third(key):
        return (
            F.when(key % 3 == 0, "Yes").when(key % 3 == 1, "No").otherwise("No internet service")
        )

    return rows.select(
        format_key(k).alias("customer_id"),
        F.when(k % 11 == 0, None).when(k % 53 == 0, "n/a")
        .when(k % 5 == 0, F.concat(F.lit("  "), text(18 + k % 62), F.lit(" ")))
        .otherwise(text(18 + k % 62)).alias("age"),
        F.when(k % 19 == 0, None)
        .otherwise(text(F.floor(F.datediff("last_order", "first_order") / 30))).alias("tenure_months"),
        text(F.col("top_price")).alias("monthly_charges"),
        F.when(k % 23 == 0, "").otherwise(text(F.col("all_prices"))).alias("total_charges"),
        F.when(k % 13 == 0, None).when(k % 17 == 0, "")
        .when(k % 4 == 0, F.concat(F.lit("  "), F.lower(segment), F.lit(" ")))
        .when(k % 4 == 1, segment)
        .when(k % 4 == 2, F.concat(segment, F.lit("\t")))
        .otherwise(F.concat(F.substring(segment, 1, 1), F.lower(F.substring(segment, 2, 100))))
        .alias("contract_type"),
        F.col("priority").alias("payment_method"),
        F.col("last_status").alias("internet_service"),
        F.when(F.col("has_phone"), "Yes").otherwise("No").alias("phone_service"),
        F.when(F.col("has_phone").isNull(), "No phone service")
        .when(F.col("n_orders") >= 10, "Yes").otherwise("No").alias("multiple_lines"),
        third(F.col("n_regionkey")).alias("online_security"),
        third(F.col("n_nationkey")).alias("tech_support"),
        F.when(k % 7 == 0, None).when(k % 2 == 0, "Yes").otherwise("No").alias("device_protection"),
        F.when(k % 29 == 0, None).when(k % 31 == 0, "x")
        .when(F.datediff(newest, "last_order") > 180, "1").otherwise("0").alias("churn"),
    )


def ranges(spark, sf_dir):
    """(first, middle, last) key numbers: train is first..middle, scoring is middle..last.

    The middle key lies in both, as in the configured ranges.
    """
    n = table(spark, sf_dir, "customer").count()
    return 1, n * 8 // 10, n


def event_time_texts(spark, sf_dir):
    """Order dates as the texts a feed may carry: zones, fractions, bad and missing ones."""
    date, k = F.col("o_orderdate"), F.col("o_orderkey")
    stamp = F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(k % 6 == 0, None).when(k % 6 == 1, "soon")
        .when(k % 6 == 2, F.concat(stamp, F.lit("+0200")))
        .when(k % 6 == 3, F.concat(stamp, F.lit(".250000+00:00")))
        .when(k % 6 == 4, stamp)
        .otherwise(F.date_format(date, "yyyy-MM-dd")).alias("event_time"),
    )


def feature_versions(spark, sf_dir):
    """One version of a customer's record per order."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        format_key(F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderdate").alias("event_time"),
        F.col("o_totalprice").cast(MONEY).alias("total_charges"),
        (F.col("o_orderdate") + F.make_dt_interval((k % 3).cast("int"))).alias("write_time"),
        (k % 97 == 0).alias("is_deleted"),
        "o_orderkey",
    )


def as_of_spine(spark, sf_dir):
    """A customer and the day a line of their orders was shipped, for every line."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        format_key(F.col("o_custkey")).alias("customer_id"), F.col("l_shipdate").alias("as_of")
    )


def scored_binary(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction")
    )


def scored_auc(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"),
                                                  (1 - F.col("toxic")).alias("prediction"))
    return labels.join(documents, "doc_id").withColumnRenamed("n_chars", "score")


def scored_multi(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", (F.col("vec_id") % 10).cast("int").alias("prediction")
    )


def registry_entries(spark, sf_dir):
    """Parts as model versions of their brand's group, one a minute."""
    size = F.col("p_size")
    minutes = F.col("p_partkey").cast("double") * 60
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("group"),
        F.col("p_partkey").alias("entry_id"),
        F.concat(F.lit("models/"), F.col("p_partkey").cast("string")).alias("model_path"),
        (size.cast("double") / 50).alias("accuracy"),
        F.when(size >= 25, "Approved").otherwise("PendingManualApproval").alias("status"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=minutes)).alias("created_at"),
    )


def requests(spark, sf_dir):
    """Customers as scoring requests: CSV bodies of one or two rows and every JSON shape."""
    rows = churn_raw(spark, sf_dir)
    k = F.substring("customer_id", 6, 20).cast("long")
    names = ["customer_id", "age", "monthly_charges", "contract_type"]
    fields = [F.coalesce(F.col(c), F.lit("")) for c in names]
    quoted = F.concat(F.lit('"'), fields[3], F.lit(', monthly"'))
    head = F.lit(",".join(names) + "\n")
    first = F.concat_ws(",", *fields[:3], quoted)
    second = F.concat_ws(",", *fields[:2])
    months, price = F.coalesce("tenure_months", F.lit("0")), F.col("monthly_charges")
    pair = F.concat(F.lit("["), months, F.lit(", "), price, F.lit("]"))
    body = (
        F.when(k % 7 == 0, F.lit("[1, 2]"))
        .when(k % 7 == 1, F.concat(head, first))
        .when(k % 7 == 2, F.concat(head, first, F.lit("\r\n"), second, F.lit("\n")))
        .when(k % 7 == 3, F.concat(F.lit('{"instances": ['), pair, F.lit(", "), pair, F.lit("]}")))
        .when(k % 7 == 4, F.concat(F.lit('{"data": ['), pair, F.lit("]}")))
        .when(k % 7 == 5, F.concat(F.lit('{"tenure": '), months, F.lit(', "price": '), price, F.lit("}")))
        .otherwise(F.concat(F.lit("["), pair, F.lit("]")))
    )
    kind = (
        F.when(k % 5 == 0, F.lit("text/plain"))
        .when((k % 7 == 1) | (k % 7 == 2), F.lit("text/csv")).otherwise(F.lit("application/json"))
    )
    return rows.select(F.col("customer_id").alias("request_id"), kind.alias("content_type"), body.alias("body"))


def invocations(spark, sf_dir):
    return table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("endpoint"))

