"""The registered queries: every operator over the given tables."""

import uuid
from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from larkspur.functions import numbers, times
from larkspur.functions.keys import format_key, key_between
from larkspur.operators import clean, columns, encode, impute, metrics, models, requests, split, versions
from larkspur.operators.ranking import row_number_by_range
from larkspur.plans import infer, search as searching, train as training
from larkspur.plans.preprocess import Preprocess, fit_preprocess
from larkspur.schema import CATEGORICAL, CLEAN, LABELLED, NUMERIC, RAW
from larkspur.session import new_path, small_table
from larkspur.sources import fixtures as fx, registry, tables
from larkspur.sources.bucketed_group import BucketedGroup, buckets_for
from larkspur.sources.feature_group import FeatureGroup
from larkspur.sources.newest import NewestTable
from larkspur.streaming import ingest, load, scoring

RUN_TS = "2024-06-01T00:00:00Z"
ID = "customer_id"
QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


# ---- inputs shared by several queries


def cleaned(spark, sf_dir):
    return clean.clean_raw(fx.churn_raw(spark, sf_dir))


def in_range(spark, sf_dir, df, which):
    first, middle, last = fx.ranges(spark, sf_dir)
    start, end = (first, middle) if which == "train" else (middle, last)
    return df.where(key_between(F.col(ID), start, end))


def part_of(spark, sf_dir, which):
    return in_range(spark, sf_dir, cleaned(spark, sf_dir), which)


def risk(df):
    """Scaled to the order prices that stand in for monthly charges."""
    return numbers.risk_score(
        F.col("monthly_charges"), F.col("tenure_months"), F.col("contract_type"), 500000.0, 80.0, "Household"
    )


def with_prediction(df):
    known = impute.fill_medians(df, {"tenure_months": 0.0, "monthly_charges": 0.0})
    return known.withColumn("prediction", (risk(known) >= 0.5).cast("int"))


def map_text(c):
    return F.to_json(c)


# ---- scans, keys


@query
def raw_scan(spark, sf_dir):
    return fx.churn_raw(spark, sf_dir)


@query
def range_train(spark, sf_dir):
    return in_range(spark, sf_dir, fx.churn_raw(spark, sf_dir), "train")


@query
def range_infer(spark, sf_dir):
    return in_range(spark, sf_dir, fx.churn_raw(spark, sf_dir), "infer")


@query
def key_format(spark, sf_dir):
    k = F.col("c_custkey")
    return fx.table(spark, sf_dir, "customer").select(
        k, format_key(k).alias(ID), format_key(k + 999000).alias("long_key")
    )


# ---- cleaning


@query
def clean_strip(spark, sf_dir):
    return clean.strip_text(fx.churn_raw(spark, sf_dir))


@query
def clean_null_literal(spark, sf_dir):
    return clean.strip_text(fx.churn_raw(spark, sf_dir), null_literal="None")


@query
def clean_numeric(spark, sf_dir):
    stripped = clean.strip_text(fx.churn_raw(spark, sf_dir))
    return clean.parse_numbers(stripped).select(ID, *NUMERIC)


@query
def clean_target(spark, sf_dir):
    stripped = clean.strip_text(fx.churn_raw(spark, sf_dir))
    return clean.parse_target(stripped).select(ID, "churn")


@query
def clean_titlecase(spark, sf_dir):
    stripped = clean.strip_text(fx.churn_raw(spark, sf_dir))
    return clean.title_categories(stripped).select(ID, *CATEGORICAL)


@query
def clean_event_time(spark, sf_dir):
    return clean.event_time_text(clean.set_event_time(fx.event_time_texts(spark, sf_dir), RUN_TS))


@query
def event_time_formats(spark, sf_dir):
    """Order dates in the formats read besides ISO."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    formats = ["MM/dd/yyyy", "MMM d yyyy", "yyyyMMdd", "yyyy-MM-dd HH:mm", "d MMM yyyy"]
    text = F.element_at(F.array(*[F.date_format(day, f) for f in formats]), (k % len(formats) + 1).cast("int"))
    rows = fx.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("event_time"))
    return clean.event_time_text(clean.set_event_time(rows, RUN_TS))


@query
def clean_all(spark, sf_dir):
    return cleaned(spark, sf_dir)


# ---- missing values


@query
def impute_unknown(spark, sf_dir):
    return impute.fill_unknown(cleaned(spark, sf_dir).select(ID, *CATEGORICAL), CATEGORICAL)


@query
def impute_median(spark, sf_dir):
    rows = part_of(spark, sf_dir, "train").select(ID, *NUMERIC)
    return impute.fill_medians(rows, impute.fit_medians(rows, NUMERIC))


@query
def impute_saved_median(spark, sf_dir):
    saved = impute.fit_medians(part_of(spark, sf_dir, "train"), NUMERIC)
    return impute.fill_medians(part_of(spark, sf_dir, "infer").select(ID, *NUMERIC), saved)


@query
def column_medians(spark, sf_dir):
    """Medians of line item columns by sketches and one count."""
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    lines = fx.table(spark, sf_dir, "lineitem").select(*names)
    found = impute.fit_medians(lines, names)
    return small_table(spark, list(found.items()), "column string, median double")


# ---- category codes


@query
def encode_fit(spark, sf_dir):
    rows = impute.fill_unknown(part_of(spark, sf_dir, "train"), CATEGORICAL)
    return encode.code_table(rows, CATEGORICAL)


@query
def encode_fit_wide(spark, sf_dir):
    """Codes of a column with a value per customer, numbered over many tasks."""
    rows = fx.table(spark, sf_dir, "customer")
    return encode.code_table(rows, ["c_name", "c_mktsegment"], limit=100)


@query
def encode_apply(spark, sf_dir):
    codes = encode.fit_codes(impute.fill_unknown(part_of(spark, sf_dir, "train"), CATEGORICAL), CATEGORICAL)
    rows = impute.fill_unknown(part_of(spark, sf_dir, "infer").select(ID, *CATEGORICAL), CATEGORICAL)
    return encode.apply_codes(rows, codes)


@query
def encode_unseen_first(spark, sf_dir):
    """Rows that skipped cleaning: their odd spellings take the first code."""
    codes = encode.fit_codes(impute.fill_unknown(part_of(spark, sf_dir, "train"), CATEGORICAL), CATEGORICAL)
    raw = fx.churn_raw(spark, sf_dir).select(ID, *CATEGORICAL)
    return encode.apply_codes(impute.fill_unknown(raw, CATEGORICAL), codes)


@query
def encode_by_join(spark, sf_dir):
    """Codes of part names and types from a table join, as for columns with very many values."""
    parts = fx.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    table = encode.wide_code_table(parts, ["p_name", "p_type"])
    return encode.apply_codes(parts, encode.Codes({}, table, ["p_name", "p_type"]))


@query
def distinct_by_bitmaps(spark, sf_dir):
    """Exact distinct counts: a key with a value in every row, a key shared by several, and codes."""
    lines = fx.table(spark, sf_dir, "lineitem")
    own = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    rows = lines.select("l_orderkey", own.alias("line"), "l_linenumber", (F.col("l_orderkey") * 10**12).alias("far_apart"))
    return encode.distinct_whole_numbers(rows, ["l_orderkey", "line", "l_linenumber", "far_apart"])


@query
def encode_hot_value(spark, sf_dir):
    """Codes of order keys of all lines, half of which name one order that is no key, and a hundredth none."""
    orders = fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("ordered"))
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    n = F.col("l_orderkey")
    hot = lines.withColumn("ordered", F.when(n % 2 == 0, "0").when(n % 50 != 1, n.cast("string")))
    codes = encode.Codes({}, encode.wide_code_table(orders, ["ordered"]), ["ordered"])
    return encode.apply_codes(hot, codes, unseen=-1)


@query
def codes_saved(spark, sf_dir):
    """Codes written with the other preprocessing artifacts and read back."""
    fitted = fit_preprocess(part_of(spark, sf_dir, "train"), "churn")
    path = new_path(spark, "preprocess")
    fitted.save(spark, path)
    return Preprocess.load(spark, path).codes.to_table(spark)


@query
def encode_target(spark, sf_dir):
    rows = cleaned(spark, sf_dir).select(ID, "age", "payment_method")
    fitted = fit_preprocess(rows, "payment_method")
    return fitted.encode_target(rows).select(ID, F.col("payment_method").cast("int").alias("code"))


@query
def unseen_report(spark, sf_dir):
    fitted = impute.fill_unknown(part_of(spark, sf_dir, "train"), CATEGORICAL)
    raw = impute.fill_unknown(fx.churn_raw(spark, sf_dir), CATEGORICAL)
    return encode.unseen_report(raw, encode.code_table(fitted, CATEGORICAL), CATEGORICAL)


@query
def encode_cardinality(spark, sf_dir):
    rows = impute.fill_unknown(part_of(spark, sf_dir, "train"), CATEGORICAL)
    return encode.cardinality(rows, CATEGORICAL)


# ---- columns


def stored_rows(spark, sf_dir):
    return FeatureGroup("unused", "unused").stamp(cleaned(spark, sf_dir), RUN_TS)


@query
def drop_meta(spark, sf_dir):
    return columns.drop_meta(stored_rows(spark, sf_dir), "churn").drop("event_date")


@query
def drop_ids(spark, sf_dir):
    return columns.drop_ids(cleaned(spark, sf_dir), "churn")


@query
def select_features(spark, sf_dir):
    wanted = ["total_charges", "age", "contract_type"]
    return columns.select_features(cleaned(spark, sf_dir), wanted, keep=[ID])


@query
def select_features_lenient(spark, sf_dir):
    wanted = ["total_charges", "no_such_feature", "age"]
    return columns.select_features(cleaned(spark, sf_dir), wanted, keep=[ID], lenient=True)


@query
def default_meta(spark, sf_dir):
    rows = cleaned(spark, sf_dir).select(ID, "churn")
    out = columns.default_meta(rows, ["event_time", "is_deleted"], RUN_TS)
    return clean.event_time_text(out)


@query
def detect_target(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    name = columns.detect_target(rows)
    return metrics.class_distribution(rows, name).select(F.lit(name).alias("target"), "class", "n")


@query
def feature_target(spark, sf_dir):
    """Text and number features apart, and the target, each by its type."""
    rows = columns.drop_meta(cleaned(spark, sf_dir), "churn")
    texts, figures = columns.text_columns(rows, "churn"), columns.number_columns(rows, "churn")
    return rows.select(
        F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in texts]).alias("texts"),
        sum((F.coalesce(F.col(c), F.lit(0.0)) for c in figures), F.lit(0.0)).alias("numbers_sum"),
        F.lit(len(texts)).alias("n_texts"),
        F.lit(len(figures)).alias("n_numbers"),
        F.col("churn").alias("target"),
    )


# ---- splits


def marked(spark, sf_dir, **options):
    rows = cleaned(spark, sf_dir).select(ID, "churn")
    return split.mark_test(rows, "churn", key=[ID], unique_key=True, **options)


@query
def split_counts(spark, sf_dir):
    return marked(spark, sf_dir).groupBy("churn", "is_test").agg(F.count(F.lit(1)).alias("n"))


@query
def split_rows(spark, sf_dir):
    return marked(spark, sf_dir)


@query
def split_rows_bucketed(spark, sf_dir):
    """The same rows, found by counting digits of the order text instead of sorting a class."""
    return marked(spark, sf_dir, sort_limit=10)


@query
def split_validation(spark, sf_dir):
    rows = cleaned(spark, sf_dir).select(ID, "churn")
    rest, _ = split.train_test(rows, "churn", key=[ID], unique_key=True)
    return split.mark_test(rest, "churn", seed="42-validation", key=[ID], unique_key=True,
                           name="is_validation")


@query
def split_copies(spark, sf_dir):
    """Line flags, whose rows are copies of a few, split by number: exact shares of every class."""
    rows = fx.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus")
    out = split.mark_test(rows, "l_returnflag")
    return out.groupBy("l_returnflag", "is_test").agg(F.count(F.lit(1)).alias("n"))


def shares_of(marked_rows, target):
    return marked_rows.groupBy(target, "is_test").agg(F.count(F.lit(1)).alias("n"))


@query
def split_ties(spark, sf_dir):
    """Every event and the same a microsecond later, split by user: unlike rows of one key stay what they are."""
    events = fx.table(spark, sf_dir, "events").select("ts", "user_id", "event_type")
    later = events.withColumn("ts", F.col("ts") + F.expr("interval 1 microsecond"))
    both = events.unionByName(later)
    return shares_of(split.mark_test(both, "event_type", key=["user_id"]), "event_type")


@query
def split_many_classes(spark, sf_dir):
    """Order lines split by order: as many classes as there are orders."""
    rows = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return shares_of(split.mark_test(rows, "l_orderkey", key=["l_orderkey", "l_linenumber"]), "l_orderkey")


@query
def prep_metadata(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    fitted = fit_preprocess(rows)
    rest, test = split.train_test(rows.select(ID, "churn"), "churn", key=[ID], unique_key=True)
    m = fitted.metadata(split.class_counts(rest, "churn"), split.class_counts(test, "churn"))
    row = (
        m["target_column"], ",".join(m["categorical_columns"]), m["n_train_samples"],
        m["n_test_samples"], m["n_classes"], m["class_distribution"],
    )
    table = small_table(
        spark,
        [row],
        "target_column string, categorical_columns string, n_train_samples long, "
        "n_test_samples long, n_classes int, class_distribution map<string,long>",
    )
    return table.withColumn("class_distribution", map_text(F.col("class_distribution")))


# ---- aggregates


@query
def class_distribution(spark, sf_dir):
    return metrics.class_distribution(cleaned(spark, sf_dir), "churn")


@query
def churn_rate(spark, sf_dir):
    return cleaned(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"), F.avg("churn").alias("churn_rate"))


@query
def n_classes(spark, sf_dir):
    return cleaned(spark, sf_dir).agg(F.count_distinct("payment_method").alias("n_classes"))


@query
def classes_sorted(spark, sf_dir):
    values = encode.code_table(cleaned(spark, sf_dir), ["payment_method"])
    return values.select(F.col("code").alias("position"), F.col("value").alias("class"))


# ---- metrics


@query
def confusion(spark, sf_dir):
    return metrics.dense_confusion(metrics.confusion(fx.scored_binary(spark, sf_dir)))


@query
def confusion_multi(spark, sf_dir):
    return metrics.dense_confusion(metrics.confusion(fx.scored_multi(spark, sf_dir)))


@query
def accuracy(spark, sf_dir):
    found = metrics.averages(metrics.class_scores(metrics.confusion(fx.scored_binary(spark, sf_dir))))
    return found.select("accuracy", "n")


@query
def weighted_prf(spark, sf_dir):
    found = metrics.averages(metrics.class_scores(metrics.confusion(fx.scored_multi(spark, sf_dir))))
    return found.select("precision", "recall", "f1_score", "n_classes")


@query
def per_class_prf(spark, sf_dir):
    return metrics.class_scores(metrics.confusion(fx.scored_multi(spark, sf_dir)))


@query
def class_report(spark, sf_dir):
    return metrics.classification_report(metrics.confusion(fx.scored_multi(spark, sf_dir)))


@query
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(fx.scored_auc(spark, sf_dir))


def flat_report(report):
    """The report with its map and lists as JSON text."""
    nested = [f.name for f in report.schema if isinstance(f.dataType, (T.MapType, T.ArrayType))]
    return report.withColumns({c: F.to_json(c) for c in nested})


@query
def evaluation_report(spark, sf_dir):
    report = metrics.evaluation_report(fx.scored_auc(spark, sf_dir), score="score")
    return flat_report(report).drop("precision_per_class", "recall_per_class", "f1_per_class")


@query
def evaluation_report_multi(spark, sf_dir):
    report = metrics.evaluation_report(fx.scored_multi(spark, sf_dir))
    lists = ("precision_per_class", "recall_per_class", "f1_per_class")
    sizes = {c: F.size(c) for c in lists}
    return report.withColumns(sizes).withColumn("class_distribution", map_text(F.col("class_distribution")))


@query
def batch_report(spark, sf_dir):
    return metrics.batch_report(fx.scored_binary(spark, sf_dir), "label")


@query
def regression_report(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem")
    return metrics.regression_report(lines, "l_quantity", "l_linenumber")


@query
def metrics_by_name(spark, sf_dir):
    """Every metric a search can be asked to optimise."""
    scored = fx.scored_auc(spark, sf_dir).withColumnRenamed("score", "probability")
    values = [(m, float(searching.metric_value(scored, "label", m))) for m in searching.METRICS]
    return small_table(spark, values, "metric string, value double")


# ---- derived columns


@query
def risk_score(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    return rows.select(ID, risk(rows).alias("risk"))


@query
def bernoulli_label(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    return rows.select(ID, numbers.bernoulli(risk(rows), F.col(ID), 42).alias("label"))


@query
def derived_columns(spark, sf_dir):
    key = F.col("c_custkey")
    return fx.table(spark, sf_dir, "customer").select(
        key,
        numbers.uniform_int(18, 80, key, "age").alias("age"),
        numbers.uniform_real(20, 120, key, "charge").alias("monthly_charges"),
        numbers.choice(["DSL", "Fiber optic", "No"], key, "internet").alias("internet_service"),
    )


@query
def run_names(spark, sf_dir):
    """Unique names of a run's model per group."""
    groups = fx.table(spark, sf_dir, "part").select("p_brand").distinct()
    return groups.select("p_brand", F.concat_ws("-", "p_brand", times.stamped_name("model", RUN_TS)).alias("name"))


@query
def predicted_churners_top100(spark, sf_dir):
    rows = with_prediction(part_of(spark, sf_dir, "infer"))
    return rows.where("prediction = 1").orderBy(ID).limit(100).select(ID, "contract_type", "churn", "prediction")


# ---- versions and keys


@query
def latest_features(spark, sf_dir):
    newest = versions.latest_records(
        fx.feature_versions(spark, sf_dir), ID, ["event_time", "write_time", "o_orderkey"], "is_deleted"
    )
    return newest.withColumn("total_charges", F.col("total_charges").cast("double"))


@query
def features_as_of(spark, sf_dir):
    found = versions.as_of(
        fx.as_of_spine(spark, sf_dir), fx.feature_versions(spark, sf_dir), ID, "as_of", "event_time",
        ["total_charges"], ["write_time", "o_orderkey"], "is_deleted",
    )
    return found.withColumn("total_charges", F.col("total_charges").cast("double"))


@query
def range_overlap(spark, sf_dir):
    return versions.shared_keys(part_of(spark, sf_dir, "train"), part_of(spark, sf_dir, "infer"), ID)


@query
def infer_without_train(spark, sf_dir):
    rows = part_of(spark, sf_dir, "infer").select(ID, "churn")
    return versions.without_keys(rows, part_of(spark, sf_dir, "train"), ID)


@query
def align_by_key(spark, sf_dir):
    scored = with_prediction(part_of(spark, sf_dir, "infer")).select(ID, "prediction")
    return versions.attach(part_of(spark, sf_dir, "infer").select(ID, "churn"), scored, ID, "inner")


@query
def attach_predictions(spark, sf_dir):
    """Every customer record with its prediction, where there is one."""
    scored = with_prediction(part_of(spark, sf_dir, "infer")).select(ID, "prediction")
    return versions.attach(cleaned(spark, sf_dir).select(ID, "contract_type"), scored, ID)


# ---- registry


@query
def registry_latest_approved(spark, sf_dir):
    return registry.newest_with_status(fx.registry_entries(spark, sf_dir), "group", tie=["entry_id"])


@query
def registry_latest_pending(spark, sf_dir):
    entries = fx.registry_entries(spark, sf_dir)
    return registry.newest_with_status(entries, "group", registry.PENDING, tie=["entry_id"]).select("group", "entry_id")


@query
def best_candidate(spark, sf_dir):
    """The best entry of every group by its metric; equal ones go to the earlier entry."""
    return searching.best_rows(fx.registry_entries(spark, sf_dir), "group", "accuracy", "entry_id")


@query
def registry_versions(spark, sf_dir):
    entries = fx.registry_entries(spark, sf_dir)
    numbered = registry.with_versions(
        entries, "group", ["created_at", "entry_id"], F.date_trunc("day", "created_at")
    )
    return numbered.select("group", "entry_id", "version")


@query
def quality_gate(spark, sf_dir):
    return registry.passes_gate(fx.registry_entries(spark, sf_dir), 0.5).select("group", "entry_id", "accuracy")


@query
def registry_status(spark, sf_dir):
    return fx.registry_entries(spark, sf_dir).select(
        "group", "entry_id", registry.status_by_accuracy(F.col("accuracy"), 0.7).alias("status")
    )


@query
def newest_run(spark, sf_dir):
    """The newest entry of all groups: one row, found without a sort of the whole table."""
    entries = fx.registry_entries(spark, sf_dir)
    return entries.orderBy(F.desc("created_at"), F.desc("entry_id")).limit(1).select("group", "entry_id", "model_path")


# ---- files and tables


@query
def csv_roundtrip(spark, sf_dir):
    path = tables.write_csv(fx.churn_raw(spark, sf_dir), new_path(spark, "csv"))
    return tables.read_csv(spark, path, RAW)


@query
def csv_headerless(spark, sf_dir):
    path = tables.write_csv(cleaned(spark, sf_dir), new_path(spark, "csv-bare"), header=False)
    return tables.read_csv(spark, path, CLEAN, header=False)


@query
def csv_ragged(spark, sf_dir):
    """Lines that end early: the fields that are not there become NULL."""
    rows = clean.strip_text(fx.churn_raw(spark, sf_dir), null_literal="")
    number = F.substring(ID, 6, 20).cast("long")
    fields = F.array(*[F.col(c) for c in RAW.names])
    line = F.array_join(F.slice(fields, 1, F.lit(len(RAW)) - (number % 3).cast("int")), ",")
    path = new_path(spark, "csv-ragged")
    rows.select(line.alias("value")).write.text(path)
    return tables.read_csv(spark, path, RAW, header=False)


@query
def parquet_or_csv(spark, sf_dir):
    """Only CSV is there, so CSV is read."""
    path = new_path(spark, "either")
    tables.write_csv(cleaned(spark, sf_dir), f"{path}/data.csv")
    return tables.read_any(spark, path, CLEAN)


@query
def parquet_and_csv(spark, sf_dir):
    """Both copies hold the same rows: each is counted per class."""
    path = tables.write_both(cleaned(spark, sf_dir), new_path(spark, "both"))
    copies = [
        spark.read.schema(CLEAN).parquet(f"{path}/data.parquet").withColumn("copy", F.lit("parquet")),
        tables.read_csv(spark, f"{path}/data.csv", CLEAN).withColumn("copy", F.lit("csv")),
    ]
    return copies[0].unionByName(copies[1]).groupBy("copy", "churn").agg(
        F.count(F.lit(1)).alias("n"), F.count("contract_type").alias("n_contracts")
    )


@query
def union_by_name(spark, sf_dir):
    """Two directories of CSV files whose headers differ."""
    rows = fx.churn_raw(spark, sf_dir).select(ID, "payment_method", "phone_service", "online_security")
    paths = [
        tables.write_csv(in_range(spark, sf_dir, rows, "train").drop("online_security"), new_path(spark, "part")),
        tables.write_csv(in_range(spark, sf_dir, rows, "infer").drop("phone_service"), new_path(spark, "part")),
    ]
    return tables.read_csv_tables(spark, paths)


@query
def union_headers(spark, sf_dir):
    """One folder of CSV files with three headers, one of them quoted and in another order."""
    rows = fx.churn_raw(spark, sf_dir).select(ID, "payment_method", "phone_service", "online_security")
    path, part = new_path(spark, "headers"), F.substring(ID, 6, 20).cast("long") % 3
    for i, names in enumerate(([ID, "payment_method"], ["phone_service", ID, "payment_method"], ["online_security", ID])):
        shown = [F.col(c).alias(c + ", text" if c == "phone_service" else c) for c in names]
        tables.write_csv(rows.where(part == i).repartition(4).select(*shown), path, mode="append")
    return tables.read_csv_tables(spark, [path]).withColumnRenamed("phone_service, text", "phone_service")


@query
def union_parts(spark, sf_dir):
    """Headerless prediction parts read as one table."""
    rows = with_prediction(cleaned(spark, sf_dir)).select(ID, "prediction")
    paths = [
        tables.write_csv(in_range(spark, sf_dir, rows, which), new_path(spark, "pred"), header=False)
        for which in ("train", "infer")
    ]
    return tables.read_csv(spark, paths, "customer_id string, prediction int", header=False)


@query
def published_table(spark, sf_dir):
    scored = with_prediction(part_of(spark, sf_dir, "infer"))
    return tables.publish(scored, f"predictions_{uuid.uuid4().hex}", new_path(spark, "published"))


@query
def published_twice(spark, sf_dir):
    """Two runs on one table: the second one's rows are what it shows."""
    name, path = f"predictions_{uuid.uuid4().hex}", new_path(spark, "published")
    tables.publish(with_prediction(part_of(spark, sf_dir, "train")), name, path, mode="overwrite")
    return tables.publish(with_prediction(part_of(spark, sf_dir, "infer")), name, path, mode="overwrite")


@query
def published_broken_run(spark, sf_dir):
    """A second run that breaks off in the middle: the table shows the first one's rows, and then a third's made from them."""
    name, path = f"predictions_{uuid.uuid4().hex}", new_path(spark, "published")
    rows = with_prediction(cleaned(spark, sf_dir)).select(ID, "contract_type", "prediction")
    tables.publish(rows, name, path)
    number = F.substring(ID, 6, 20).cast("long")
    broken = rows.withColumn("contract_type", F.when(number % 7 == 6, F.raise_error(F.lit("lost"))).otherwise("never"))
    try:
        tables.publish(broken, name, path, mode="overwrite")
        raise AssertionError("the run did not break off")
    except PySparkException:
        pass
    return tables.publish(spark.table(name).where("prediction = 1"), name, path, mode="overwrite")


@query
def published_csv(spark, sf_dir):
    scored = with_prediction(part_of(spark, sf_dir, "infer")).select(ID, "contract_type", "prediction")
    return tables.publish(scored, f"predictions_{uuid.uuid4().hex}", new_path(spark, "published"), "csv")


@query
def labelled_table(spark, sf_dir):
    """External table of fixed types over headerless CSV files."""
    whole = {c: F.col(c).cast("int") for c in ("age", "tenure_months")}
    rows = part_of(spark, sf_dir, "infer").withColumns(whole)
    path = tables.write_csv(rows, new_path(spark, "labelled"), header=False)
    name = f"labelled_{uuid.uuid4().hex}"
    columns_ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LABELLED)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl}) USING csv LOCATION '{path}'")
    return tables.read_table(spark, name)


@query
def run_partition(spark, sf_dir):
    path = new_path(spark, "runs")
    tables.write_run(part_of(spark, sf_dir, "train").select(ID, "churn"), path, "a1")
    tables.write_run(part_of(spark, sf_dir, "infer").select(ID, "churn"), path, "b2")
    return spark.read.schema("customer_id string, churn int, run string").parquet(path)


@query
def json_report(spark, sf_dir):
    report = metrics.evaluation_report(fx.scored_binary(spark, sf_dir)).drop(
        "class_distribution", "precision_per_class", "recall_per_class", "f1_per_class"
    )
    path = tables.write_report(report, new_path(spark, "report"))
    return spark.read.schema(report.schema).json(path)


def new_group(spark):
    return FeatureGroup(f"features_{uuid.uuid4().hex}", new_path(spark, "features"))


@query
def feature_group_append(spark, sf_dir):
    """Two runs appended, then every version in the training range read back."""
    group = new_group(spark)
    rows = cleaned(spark, sf_dir)
    group.append(rows, RUN_TS).append(rows.where("churn = 1"), "2024-06-02T12:00:00Z")
    first, middle, _ = fx.ranges(spark, sf_dir)
    return clean.event_time_text(group.read_range(spark, first, middle)).select(
        ID, "age", "contract_type", "churn", "event_time", "is_deleted",
        F.col("event_date").cast("string").alias("event_date"),
    )


@query
def feature_group_reordered(spark, sf_dir):
    """A second append whose columns come in another order."""
    group, rows = new_group(spark), cleaned(spark, sf_dir)
    group.append(rows, RUN_TS)
    group.append(rows.where("churn = 1").select(*reversed(rows.columns)), "2024-06-02T12:00:00Z")
    return group.read(spark).select(ID, "age", "tenure_months", "churn")


@query
def feature_group_latest(spark, sf_dir):
    group = new_group(spark)
    rows = cleaned(spark, sf_dir)
    group.append(rows, RUN_TS).append(rows.where("churn = 1"), "2024-06-02T12:00:00Z")
    return clean.event_time_text(group.latest(spark)).select(ID, "contract_type", "churn", "event_time")


def versions_in_buckets(spark, sf_dir, asked=0):
    """The orders' records as two appends to a table in key buckets, enough for them and ``asked`` rows of a spine."""
    buckets = buckets_for(fx.table(spark, sf_dir, "orders").count() + asked, least=8)
    group = BucketedGroup(f"bucketed_{uuid.uuid4().hex}", new_path(spark, "bucketed"), buckets=buckets)
    rows = fx.feature_versions(spark, sf_dir).withColumns({
        "event_time": F.col("event_time").cast("timestamp"), "write_time": F.col("write_time").cast("timestamp"),
        "total_charges": F.col("total_charges").cast("double")})
    odd = F.col("o_orderkey") % 2 == 1
    return group.append(rows.where(odd), RUN_TS).append(rows.where(~odd), RUN_TS)


@query
def bucketed_latest(spark, sf_dir):
    """Newest records out of key buckets."""
    newest = versions_in_buckets(spark, sf_dir).latest(spark)
    return newest.select(ID, F.col("event_time").cast("timestamp_ntz").alias("event_time"), "total_charges", "o_orderkey")


@query
def newest_merged(spark, sf_dir):
    """Newest records merged append by append; the appends' versions come in no order of time."""
    rows = fx.feature_versions(spark, sf_dir).withColumns({
        "event_time": F.col("event_time").cast("timestamp"), "write_time": F.col("write_time").cast("timestamp"),
        "total_charges": F.col("total_charges").cast("double")})
    group = BucketedGroup(f"newest_{uuid.uuid4().hex}", new_path(spark, "bucketed"), buckets=8)
    kept, part = NewestTable(group, new_path(spark, "newest"), buckets=8), F.pmod(F.xxhash64("o_orderkey"), F.lit(4))
    for i in range(4):
        kept.append(rows.where(part == i), RUN_TS)
    return kept.latest(spark).select(ID, F.col("event_time").cast("timestamp_ntz").alias("event_time"), "total_charges", "o_orderkey")


@query
def newest_caught_up(spark, sf_dir):
    """Rows that only the group got, as if the run had broken off, are merged afterwards; a second time changes nothing."""
    kept, rows = NewestTable(new_group(spark), new_path(spark, "newest"), buckets=8), cleaned(spark, sf_dir)
    kept.append(rows, RUN_TS)
    kept.group.append(rows.where("churn = 1").withColumn("churn", F.lit(2)), "2024-06-02T12:00:00Z")
    kept.catch_up(spark, "2024-06-02T12:00:00Z").catch_up(spark, "2024-06-02T12:00:00Z")
    return clean.event_time_text(kept.latest(spark)).select(ID, "contract_type", "churn", "event_time")


@query
def bucketed_as_of(spark, sf_dir):
    """Each shipped line with its customer's record as of that day, the versions read where they lie."""
    spine = fx.as_of_spine(spark, sf_dir).withColumn("as_of", F.col("as_of").cast("timestamp"))
    asked = fx.table(spark, sf_dir, "lineitem").count()
    found = versions_in_buckets(spark, sf_dir, asked).as_of(spine, "as_of", ["total_charges"], ["write_time", "o_orderkey"])
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("as_of", "feature_event_time")})


# ---- requests


@query
def parse_csv_requests(spark, sf_dir):
    names = [ID, "age", "monthly_charges", "contract_type"]
    return requests.parse_csv(fx.requests(spark, sf_dir), names)


@query
def parse_json_requests(spark, sf_dir):
    rows = requests.parse_json(fx.requests(spark, sf_dir))
    return rows.select(
        "request_id", "row_no", F.get("features", F.lit(0)).alias("f0"), F.get("features", F.lit(1)).alias("f1"),
        F.size("features").alias("n_features"),
    )


@query
def bad_requests(spark, sf_dir):
    return requests.bad_requests(fx.requests(spark, sf_dir))


@query
def requests_accounted(spark, sf_dir):
    """Every request once, with the reason why it can't be scored on four named columns, or none."""
    asked = fx.requests(spark, sf_dir)
    names = [ID, "age", "monthly_charges", "contract_type"]
    refused = requests.bad_requests(asked, names)
    taken = asked.join(refused, "request_id", "left_anti")
    read = requests.parse_csv(taken, names).select("request_id").union(requests.parse_json(taken).select("request_id"))
    return refused.unionByName(read.distinct().withColumn("reason", F.lit(None).cast("string")))


def rule_predictions(spark, sf_dir):
    """A plain rule in place of a model: prices above a limit."""
    asked = fx.requests(spark, sf_dir)
    named = requests.parse_csv(asked, ["monthly_charges"]).select(
        "request_id", "row_no", F.col("monthly_charges").try_cast("double").alias("price")
    )
    bare = requests.parse_json(asked).select("request_id", "row_no", F.get("features", F.lit(1)).alias("price"))
    both = named.unionByName(bare)
    return both.withColumn("prediction", F.coalesce((F.col("price") > 470000).cast("int"), F.lit(0)))


@query
def csv_answers(spark, sf_dir):
    return requests.answers(rule_predictions(spark, sf_dir), requests.CSV)


@query
def json_answers(spark, sf_dir):
    return requests.answers(rule_predictions(spark, sf_dir), requests.JSON)


@query
def replay_requests(spark, sf_dir):
    rows = cleaned(spark, sf_dir).select(ID, *CATEGORICAL)
    return requests.replay(rows, ID, CATEGORICAL)


@query
def replay_parsed(spark, sf_dir):
    """Rows sent as requests and parsed again are the same rows."""
    rows = clean.strip_text(fx.churn_raw(spark, sf_dir)).select(ID, *CATEGORICAL)
    return requests.parse_csv(requests.replay(rows, ID, CATEGORICAL), CATEGORICAL).drop("row_no")


# ---- load


@query
def requests_per_minute(spark, sf_dir):
    return load.requests_per_minute(fx.invocations(spark, sf_dir), per_instance=2)


def event_stream(spark, sf_dir):
    schema = fx.table(spark, sf_dir, "events").schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
        .select("ts", F.col("event_type").alias("endpoint"))
    )


@query
def stream_requests_per_minute(spark, sf_dir):
    path = new_path(spark, "minutes")
    load.stream_requests_per_minute(
        event_stream(spark, sf_dir), path, new_path(spark, "minutes-state"), per_instance=2
    ).awaitTermination()
    found = spark.read.schema("endpoint string, minute timestamp, n_requests long, instances int").parquet(path)
    return found.withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@query
def stream_minute_counts(spark, sf_dir):
    """Every request counted, whatever its lateness: the newest half arrives first, then the rest, then nothing new."""
    calls = fx.invocations(spark, sf_dir)
    middle = calls.agg(F.percentile_approx("ts", 0.5)).first()[0]
    source, path, state = (new_path(spark, x) for x in ("calls", "minute-parts", "minute-state"))
    for part in (calls.where(F.col("ts") > middle), calls.where(F.col("ts") <= middle)):
        part.coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):
            stream = spark.readStream.schema(calls.schema).parquet(source)
            load.count_minutes(stream, path, state).awaitTermination()
    return load.minute_counts(spark, path, per_instance=2).withColumn("minute", F.col("minute").cast("timestamp_ntz"))


# ---- models


def cleaned_once(spark, sf_dir):
    """Cleaned customers kept in the shared folder: the append's two passes and the scoring range read them there."""
    return split.written(cleaned(spark, sf_dir), "cleaned")


def stored(spark, sf_dir, which, rows=None):
    """A key range read from the feature table, which is filled first."""
    group = new_group(spark).append(cleaned_once(spark, sf_dir) if rows is None else rows, RUN_TS)
    first, middle, last = fx.ranges(spark, sf_dir)
    start, end = (first, middle) if which == "train" else (middle, last)
    return group.read_range(spark, start, end).drop("event_date")


def trained(spark, sf_dir, rows=None):
    return training.train(stored(spark, sf_dir, "train", rows), "churn", [ID], unique_key=True)


@query
def forest_train_eval(spark, sf_dir):
    return flat_report(trained(spark, sf_dir).evaluation())


@query
def forest_training_metrics(spark, sf_dir):
    return trained(spark, sf_dir).training_metrics()


@query
def forest_importance_top10(spark, sf_dir):
    return trained(spark, sf_dir).importances(10)


@query
def batch_inference(spark, sf_dir):
    """Train, register, take the newest approved model, score and publish the scoring range."""
    entries, rows = registry.Registry(new_path(spark, "registry")), cleaned_once(spark, sf_dir)
    training.register(trained(spark, sf_dir, rows), entries, "churn", new_path(spark, "model"), RUN_TS, threshold=0.0)
    scored, _ = infer.batch_inference(
        spark, in_range(spark, sf_dir, rows, "infer"), entries, "churn",
        f"predictions_{uuid.uuid4().hex}", new_path(spark, "scored"),
    )
    return scored


def searched(spark, sf_dir):
    fitted, parts, _ = training.prepare(stored(spark, sf_dir, "train"), "churn", [ID], unique_key=True)
    found = searching.search(
        parts["train"], parts["validation"], fitted.features, "churn", max_seconds=600
    )
    return found, parts["test"]


@query
def search_candidates(spark, sf_dir):
    return searching.candidates_table(spark, searched(spark, sf_dir)[0])


@query
def search_best(spark, sf_dir):
    return searching.best_info(spark, searched(spark, sf_dir)[0], "churn-model", "search", RUN_TS)


@query
def soft_vote(spark, sf_dir):
    found, test = searched(spark, sf_dir)
    return searching.soft_vote(found, test).select("churn", "prediction", "probability")


@query
def score_requests(spark, sf_dir):
    """Every customer sent as a request and scored, named columns first cleaned like stored rows."""
    t = trained(spark, sf_dir)
    rows = fx.churn_raw(spark, sf_dir)
    asked = requests.replay(rows, ID, t.preprocess.features)
    return requests.score_requests(asked, t.model, t.preprocess, clean.clean_raw)


def lines_by_rule(spark, sf_dir):
    """Order lines with labels that follow from their number: two classes and three."""
    n = F.col("l_linenumber")
    return fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", n.cast("double").alias("line"), (F.col("l_orderkey") % 5).cast("double").alias("noise"),
        (n >= 4).cast("int").alias("late"), F.floor((n - 1) / 3).cast("double").alias("third"))


@query
def forest_rule(spark, sf_dir):
    """A forest on a label that follows from one feature: its measures, gate and first feature are exact."""
    rows = lines_by_rule(spark, sf_dir).drop("third")
    t = training.train(rows, "late", ["l_orderkey"])
    first = t.importances(1).select(F.col("feature").alias("first_feature"))
    found = t.evaluation().select("accuracy", "precision", "recall", "f1_score", "roc_auc")
    fitted = t.training_metrics().select("train_accuracy")
    return found.crossJoin(first).crossJoin(fitted).withColumn("status", F.lit(
        training.register(t, registry.Registry(new_path(spark, "registry")), "late", new_path(spark, "model"), RUN_TS, 0.9)))


@query
def soft_vote_multi(spark, sf_dir):
    """A vote over three classes that follow from a feature."""
    rows = lines_by_rule(spark, sf_dir).select("l_orderkey", "line", "noise", "third")
    tried = [("forest", f"depth={d}", searching.models.forest("third", 10, d), False) for d in (3, 5)]
    found = searching.search(rows, rows, ["line"], "third", tried, "F1")
    return searching.soft_vote(found, rows).select("l_orderkey", "line", "prediction", F.round("probability", 6).alias("probability"))


@query
def halving_survivor(spark, sf_dir):
    """Candidates halved on growing samples; the label follows from one feature, so the one that finds it is known."""
    rows = lines_by_rule(spark, sf_dir).select("l_orderkey", "line", "third")
    tried = [("logistic", "penalty=1000", models.logistic("third", 1000.0, 5), False), ("stump", "depth=0", models.forest("third", 1, 0), False),
             ("forest", "depth=4", models.forest("third", 5, 4), False), ("logistic", "penalty=100", models.logistic("third", 100.0, 5), False)]
    found = searching.halving(rows, rows, ["line"], "third", tried, max_seconds=600)
    won = searching.survivor(found)
    # The candidate, the rungs it took, and its predictions.
    return models.predict(won.model, rows).select(
        "l_orderkey", "line", "prediction", F.lit(won.name).alias("candidate"), F.lit(won.value).alias("accuracy"),
        F.lit(sum(name == won.name for name, *_ in found.rungs)).alias("n_rungs"), F.lit(len(found.rungs)).alias("n_fits"))


@query
def bundle_roundtrip(spark, sf_dir):
    """Customers scored by a model in memory, by the same one saved and loaded, and as requests: all agree."""
    t = trained(spark, sf_dir)
    path = new_path(spark, "bundle")
    t.save(path)
    model, preprocess, _ = infer.bundle.load(spark, path)
    rows = cleaned(spark, sf_dir)
    own = infer.score(rows, t.model, t.preprocess, compact=True)
    again = infer.score(rows, model, preprocess, compact=True).toDF(ID, "p2", "q2")
    asked = requests.replay(fx.churn_raw(spark, sf_dir), ID, preprocess.features)
    sent = requests.score_requests(asked, model, preprocess, clean.clean_raw).select(
        F.col("request_id").alias("sent_id"), F.col("prediction").alias("p3"), F.col("probability").alias("q3"))
    # A request's key is the raw one.
    both = own.join(again, ID).join(sent, F.col(ID) == F.trim("sent_id"), "left")
    alike = (F.col("prediction") == F.col("p2")) & (F.col("prediction_probability") == F.col("q2")) & (
        F.col("prediction") == F.col("p3")) & (F.col("prediction_probability") == F.col("q3"))
    return both.select(ID, alike.alias("alike"))


@query
def batch_inference_rows(spark, sf_dir):
    """What batch scoring publishes: the input's columns, and predictions that follow from probabilities."""
    out = batch_inference(spark, sf_dir)
    sure = (F.col("prediction") == (F.col("prediction_probability") > 0.5).cast("int")) & F.col("prediction_probability").between(0, 1)
    return out.select(ID, "age", "contract_type", F.col("churn").cast("long").alias("churn"), (
        sure | (F.col("prediction_probability") == 0.5)).alias("consistent"))


@query
def stream_score_rows(spark, sf_dir):
    """Rows scored as a stream and as a table have the same predictions."""
    t = trained(spark, sf_dir)
    path = new_path(spark, "stream-scored")
    scoring.score_rows(write_feed(spark, sf_dir), t.model, t.preprocess, path, new_path(spark, "score-state"),
                       clean.clean_raw).awaitTermination()
    own = infer.score(cleaned(spark, sf_dir), t.model, t.preprocess, compact=True).toDF(ID, "p", "q")
    both = spark.read.parquet(path).join(own, ID)
    return both.groupBy(ID).agg(F.count("*").alias("n"), F.bool_and(
        (F.col("prediction") == F.col("p")) & (F.col("prediction_probability") == F.col("q"))).alias("alike"))


def written_feed(spark, sf_dir):
    """Raw rows with a text event time, each one sent twice."""
    rows = fx.churn_raw(spark, sf_dir)
    number = F.substring(ID, 6, 20).cast("long")
    sent = F.format_string("2024-01-%02dT00:00:00+0200", number % 28 + 1)
    feed = rows.withColumn("event_time", F.when(number % 3 != 0, sent))
    path = new_path(spark, "feed")
    feed.write.parquet(path)
    feed.write.mode("append").parquet(path)
    return path


#: Rows of a file of a feed, at most on average.
FILE_ROWS = 50_000


def files_for(rows):
    return max(1, -(-rows // FILE_ROWS))


def add_files(part, path, files):
    """Append a part as so many files, so that a batch of a stream is read and cleaned by as many tasks."""
    (part.coalesce(1) if files == 1 else part.repartition(files)).write.mode("append").parquet(path)


def write_feed(spark, sf_dir):
    path = written_feed(spark, sf_dir)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


@query
def stream_ingest(spark, sf_dir):
    """Several batches, rows without an event time first and every row twice, into the feature group."""
    feed = spark.read.parquet(written_feed(spark, sf_dir))
    path, files = new_path(spark, "feed-batches"), files_for(feed.count())
    for part in (feed.where("event_time is null"), feed.where("event_time is not null"), feed):
        add_files(part, path, files)
    stream = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", files).parquet(path)
    group = new_group(spark)
    ingest.ingest(stream, group, new_path(spark, "ingest-state"), RUN_TS).awaitTermination()
    stored = group.read(spark).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CLEAN], "event_time")
    return clean.event_time_text(stored)


@query
def stream_ingest_late(spark, sf_dir):
    """Copies across batches and runs; half of the rows are older than what the state remembers."""
    feed = spark.read.parquet(written_feed(spark, sf_dir))
    number = F.substring(F.trim(ID), 6, 20).cast("long")
    source, state, group = new_path(spark, "late"), new_path(spark, "late-state"), new_group(spark)
    memory, files = f"{(date.today() - date(2024, 1, 15)).days} days", files_for(feed.count())
    for parts in ((feed.where(number % 2 == 0), feed), (feed.where(number % 5 == 0), feed)):
        for part in parts:
            add_files(part, source, files)
        stream = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", files).parquet(source)
        ingest.ingest(stream, group, state, RUN_TS, memory).awaitTermination()
    stored = group.read(spark).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CLEAN], "event_time")
    return clean.event_time_text(stored)


@query
def stream_requests_scored(spark, sf_dir):
    """Each request once, scored or refused, also those that come after a restart."""
    rows = cleaned(spark, sf_dir).select(ID, "age", "monthly_charges", "churn")
    t = training.train(rows, "churn", [ID], classifier=models.forest("churn", 5, 4), unique_key=True)
    asked, half = fx.requests(spark, sf_dir), F.pmod(F.xxhash64("request_id"), F.lit(2))
    source, path, state = (new_path(spark, x) for x in ("asked", "asked-out", "asked-state"))
    for part in (0, 1):
        asked.where(half == part).repartition(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(asked.schema).option("maxFilesPerTrigger", 1).parquet(source)
        scoring.score_request_stream(stream, t.model, t.preprocess, path, state, clean.parse_numbers).awaitTermination()
    answered = scoring.scored_requests(spark, path).groupBy("request_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.bool_and(F.col("prediction").isin(0, 1) & F.col("probability").between(0, 1)).alias("valid"))
    refused = scoring.rejected_requests(spark, path)
    return answered.withColumn("reason", F.lit(None).cast("string")).unionByName(
        refused.select("request_id", F.lit(0).cast("long").alias("n_rows"), F.lit(None).cast("boolean").alias("valid"), "reason"))


@query
def stream_then_batch(spark, sf_dir):
    """Half of the customers by stream, then the others by a batch append, read back from one group."""
    rows, group = fx.churn_raw(spark, sf_dir), new_group(spark)
    even = F.substring(ID, 6, 20).cast("long") % 2 == 0
    path = new_path(spark, "feed-half")
    rows.where(even).write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    ingest.ingest(stream, group, new_path(spark, "ingest-state"), RUN_TS).awaitTermination()
    group.append(clean.clean_raw(rows.where(~even)), RUN_TS)
    return clean.event_time_text(group.read(spark)).select(ID, "churn", "event_time")


@query
def stream_score(spark, sf_dir):
    t = trained(spark, sf_dir)
    path = new_path(spark, "stream-scored")
    stream = write_feed(spark, sf_dir)
    scoring.score_rows(
        stream, t.model, t.preprocess, path, new_path(spark, "score-state"), clean.clean_raw
    ).awaitTermination()
    return spark.read.parquet(path)


@query
def ranked_values(spark, sf_dir):
    """Row numbers per segment over a balance order, numbered range by range."""
    rows = fx.table(spark, sf_dir, "customer").select("c_mktsegment", "c_acctbal", "c_custkey")
    return row_number_by_range(rows, ["c_mktsegment"], ["c_acctbal", "c_custkey"], "place").select(
        "c_mktsegment", "c_custkey", "place"
    )
