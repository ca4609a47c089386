"""The registered queries in SQL for another engine, over the same tables."""

from larkspur.schema import CATEGORICAL, NUMERIC, RAW

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

CHURN_RAW = r"""
per_customer AS (
  SELECT o_custkey, count(*) AS n_orders, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
         max(CAST(o_totalprice AS DECIMAL(12,2))) AS top_price,
         sum(CAST(o_totalprice AS DECIMAL(12,2))) AS all_prices,
         max(o_orderpriority) AS priority, arg_max(o_orderstatus, o_orderkey) AS last_status
  FROM orders GROUP BY o_custkey),
churn_raw AS (
  SELECT printf('CUST_%06d', k) AS customer_id,
    CASE WHEN k % 11 = 0 THEN NULL WHEN k % 53 = 0 THEN 'n/a'
         WHEN k % 5 = 0 THEN '  ' || (18 + k % 62) || ' ' ELSE CAST(18 + k % 62 AS VARCHAR) END AS age,
    CASE WHEN k % 19 = 0 THEN NULL
         ELSE CAST(date_diff('day', first_order, last_order) // 30 AS VARCHAR) END AS tenure_months,
    CAST(top_price AS VARCHAR) AS monthly_charges,
    CASE WHEN k % 23 = 0 THEN '' ELSE CAST(all_prices AS VARCHAR) END AS total_charges,
    CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN ''
         WHEN k % 4 = 0 THEN '  ' || lower(c_mktsegment) || ' '
         WHEN k % 4 = 1 THEN c_mktsegment
         WHEN k % 4 = 2 THEN c_mktsegment || chr(9)
         ELSE substr(c_mktsegment, 1, 1) || lower(substr(c_mktsegment, 2)) END AS contract_type,
    priority AS payment_method,
    last_status AS internet_service,
    CASE WHEN phone THEN 'Yes' ELSE 'No' END AS phone_service,
    CASE WHEN NOT phone THEN 'No phone service' WHEN n_orders >= 10 THEN 'Yes' ELSE 'No' END AS multiple_lines,
    CASE n_regionkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'No internet service' END AS online_security,
    CASE n_nationkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'No internet service' END AS tech_support,
    CASE WHEN k % 7 = 0 THEN NULL WHEN k % 2 = 0 THEN 'Yes' ELSE 'No' END AS device_protection,
    CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN 'x'
         WHEN date_diff('day', last_order, (SELECT max(o_orderdate) FROM orders)) > 180 THEN '1' ELSE '0' END AS churn
  FROM (SELECT *, c_custkey AS k, c_custkey IN (SELECT user_id FROM events) AS phone
        FROM customer JOIN per_customer ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey))"""


def strip(c):
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def number(c):
    return f"CASE WHEN regexp_matches({c}, '{NUMBER}') THEN TRY_CAST({c} AS DOUBLE) END"


def title(c):
    pieces = f"regexp_extract_all({c}, '([A-Za-z]+|[^A-Za-z]+)')"
    return f"array_to_string(list_transform({pieces}, lambda x: upper(x[1]) || lower(x[2:])), '')"


def listing(columns, form="{c}"):
    return ", ".join(f"{form.format(c=c)} AS {c}" for c in columns)


STRIPPED = CHURN_RAW + f",\nstripped AS (SELECT {', '.join(f'{strip(c)} AS {c}' for c in RAW.names)} FROM churn_raw)"
FLAG = f"coalesce(CAST(trunc({number('churn')}) AS INTEGER), 0)"
CLEANED = STRIPPED + f""",
cleaned AS (SELECT customer_id, {', '.join(f'{number(c)} AS {c}' for c in NUMERIC)},
  {', '.join(f"{title(f'nullif({c}, {chr(39)*2})')} AS {c}" for c in CATEGORICAL)}, {FLAG} AS churn FROM stripped)"""
MIDDLE = "printf('CUST_%06d', (SELECT count(*) FROM customer) * 8 // 10)"
TRAIN_IDS = f"customer_id BETWEEN 'CUST_000001' AND {MIDDLE}"
INFER_IDS = f"customer_id BETWEEN {MIDDLE} AND printf('CUST_%06d', (SELECT count(*) FROM customer))"
PARTS = CLEANED + f""",
train AS (SELECT * FROM cleaned WHERE {TRAIN_IDS}),
infer AS (SELECT * FROM cleaned WHERE {INFER_IDS})"""


def with_(ctes, select):
    return f"WITH {ctes}\n{select}"


def unknown(c):
    return f"coalesce({c}, 'Unknown') AS {c}"


def long_form(table, columns, form="coalesce({c}, 'Unknown')"):
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {form.format(c=c)} AS value FROM {table}" for c in columns)


def median(table, c):
    """Mean of the two middle values."""
    return f"""(SELECT (min({c}) + max({c})) / 2 FROM (
      SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS i, count(*) OVER () AS n FROM {table} WHERE {c} IS NOT NULL)
      WHERE i IN ((n - 1) // 2, n // 2))"""


CODES = PARTS + f""",
long_train AS ({long_form('train', CATEGORICAL)}),
codes AS (SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT "column", value FROM long_train))"""


def coded(table):
    cells = ", ".join(
        f"coalesce(CAST((SELECT code FROM codes WHERE \"column\" = '{c}' AND value = coalesce(t.{c}, 'Unknown'))"
        f" AS DOUBLE), 0) AS {c}"
        for c in CATEGORICAL
    )
    return f"SELECT customer_id, {cells} FROM {table} t"


def split_ctes(source, salt, name="is_test"):
    """Largest-remainder quotas, then the first rows of each class in digest order."""
    return f"""
{name}_sizes AS (SELECT churn, count(*) AS n FROM {source} GROUP BY churn),
{name}_want AS (SELECT CAST(ceil(0.2 * (SELECT count(*) FROM {source})) AS BIGINT) AS want,
                (SELECT count(*) FROM {source}) AS total),
{name}_base AS (SELECT churn, want, (want * n) // total AS base, (want * n) % total AS rest FROM {name}_sizes, {name}_want),
{name}_quota AS (SELECT churn, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, churn)
                 <= want - sum(base) OVER () THEN 1 ELSE 0 END AS k FROM {name}_base),
{name}_rows AS (SELECT s.customer_id, s.churn,
   row_number() OVER (PARTITION BY s.churn ORDER BY md5(concat_ws('|', s.customer_id, '{salt}'))) <= q.k AS {name}
   FROM {source} s JOIN {name}_quota q USING (churn))"""


SPLIT = CLEANED + "," + split_ctes("cleaned", "42")

SCORED_BINARY = "scored AS (SELECT quality AS label, 1 - toxic AS prediction FROM labels)"
SCORED_MULTI = "scored AS (SELECT label, CAST(vec_id % 10 AS INTEGER) AS prediction FROM embeddings)"
SCORED_AUC = """scored AS (SELECT quality AS label, 1 - toxic AS prediction, n_chars AS score
  FROM labels JOIN documents USING (doc_id))"""

METRICS = """,
pairs AS (SELECT label, prediction, count(*) AS n FROM scored GROUP BY label, prediction),
names AS (SELECT label AS class FROM pairs UNION SELECT prediction FROM pairs),
counts AS (SELECT class,
    CAST(coalesce((SELECT sum(n) FROM pairs WHERE label = class), 0) AS BIGINT) AS support,
    CAST(coalesce((SELECT sum(n) FROM pairs WHERE prediction = class), 0) AS BIGINT) AS predicted,
    CAST(coalesce((SELECT sum(n) FROM pairs WHERE label = class AND prediction = class), 0) AS BIGINT) AS tp
  FROM names),
scores AS (SELECT *,
    CASE WHEN predicted > 0 THEN tp / CAST(predicted AS DOUBLE) ELSE 0.0::DOUBLE END AS "precision",
    CASE WHEN support > 0 THEN tp / CAST(support AS DOUBLE) ELSE 0.0::DOUBLE END AS recall,
    CASE WHEN support + predicted > 0 THEN (2 * tp) / CAST(support + predicted AS DOUBLE) ELSE 0.0::DOUBLE END AS f1_score
  FROM counts),
totals AS (SELECT CAST(sum(support) AS BIGINT) AS n, count(*) FILTER (support > 0) AS n_classes,
    CAST(sum(tp) AS DOUBLE) / CAST(sum(support) AS DOUBLE) AS accuracy,
    list_reduce(list("precision" * support ORDER BY class), lambda a, b: a + b) / CAST(sum(support) AS DOUBLE) AS "precision",
    list_reduce(list(recall * support ORDER BY class), lambda a, b: a + b) / CAST(sum(support) AS DOUBLE) AS recall,
    list_reduce(list(f1_score * support ORDER BY class), lambda a, b: a + b) / CAST(sum(support) AS DOUBLE) AS f1_score,
    list_reduce(list("precision" ORDER BY class), lambda a, b: a + b) / count(*) AS macro_precision,
    list_reduce(list(recall ORDER BY class), lambda a, b: a + b) / count(*) AS macro_recall,
    list_reduce(list(f1_score ORDER BY class), lambda a, b: a + b) / count(*) AS macro_f1_score
  FROM scores)"""

DISTRIBUTION = """(SELECT '{' || string_agg('"' || label || '":' || n, ',' ORDER BY CAST(label AS VARCHAR)) || '}'
  FROM (SELECT label, count(*) AS n FROM scored GROUP BY label))"""

AUC = """(SELECT CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / (2.0::DOUBLE * sum(pos) * sum(neg)) FROM (
    SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
    FROM (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg FROM scored GROUP BY score)))"""

GRID = """SELECT a.class AS label, b.class AS prediction, CAST(coalesce(p.n, 0) AS BIGINT) AS n
FROM names a CROSS JOIN names b LEFT JOIN pairs p ON p.label = a.class AND p.prediction = b.class"""


def risk(t=""):
    return f"""({t}monthly_charges / 500000.0::DOUBLE * 0.3::DOUBLE
      + (1.0::DOUBLE - {t}tenure_months / 80.0::DOUBLE) * 0.4::DOUBLE
      + coalesce(CAST({t}contract_type = 'Household' AS INTEGER), 0) * 0.3::DOUBLE)"""


PREDICTED = PARTS + f""",
known AS (SELECT * REPLACE (coalesce(tenure_months, 0) AS tenure_months, coalesce(monthly_charges, 0) AS monthly_charges)
          FROM cleaned),
scored_rows AS (SELECT *, CAST({risk()} >= 0.5::DOUBLE AS INTEGER) AS prediction FROM known),
scored_infer AS (SELECT * FROM scored_rows WHERE {INFER_IDS})"""


def uniform(key, salt):
    return f"(CAST('0x' || substr(md5({key} || '|{salt}'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"


VERSIONS = """versions AS (SELECT printf('CUST_%06d', o_custkey) AS customer_id, o_orderdate AS event_time,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS total_charges,
    o_orderdate + to_days(CAST(o_orderkey % 3 AS INTEGER)) AS write_time, o_orderkey % 97 = 0 AS is_deleted, o_orderkey
  FROM orders)"""

REGISTRY = """entries AS (SELECT p_brand AS "group", p_partkey AS entry_id, 'models/' || p_partkey AS model_path,
    p_size / 50.0::DOUBLE AS accuracy, CASE WHEN p_size >= 25 THEN 'Approved' ELSE 'PendingManualApproval' END AS status,
    TIMESTAMP '2024-01-01' + to_minutes(p_partkey) AS created_at FROM part)"""

# What each request holds, from the customer it was made of rather than from its body.
ASKED = CHURN_RAW + """,
asked AS (SELECT customer_id AS request_id, CAST(substr(customer_id, 6) AS BIGINT) AS k, age, monthly_charges,
    coalesce(contract_type, '') || ', monthly' AS contract_type, coalesce(tenure_months, '0') AS months FROM churn_raw),
good AS (SELECT * FROM asked WHERE k % 5 <> 0),
twos AS (SELECT unnest([1, 2]) AS row_no),
csv_rows AS (
  SELECT request_id, row_no, request_id AS customer_id,
    CASE WHEN age NOT IN ('', 'n/a') THEN age END AS age,
    CASE WHEN row_no = 1 THEN monthly_charges END AS monthly_charges,
    CASE WHEN row_no = 1 THEN contract_type END AS contract_type
  FROM good, twos WHERE k % 7 = 2 OR (k % 7 = 1 AND row_no = 1)),
json_rows AS (
  SELECT request_id, row_no, CAST(months AS DOUBLE) AS f0, CAST(monthly_charges AS DOUBLE) AS f1, 2 AS n_features
  FROM good, twos WHERE k % 7 = 3 OR (k % 7 IN (4, 5, 6) AND row_no = 1)),
ruled AS (SELECT request_id, row_no, coalesce(CAST(price > 470000 AS INTEGER), 0) AS prediction FROM (
  SELECT request_id, row_no, CAST(monthly_charges AS DOUBLE) AS price FROM csv_rows
  UNION ALL SELECT request_id, row_no, f1 FROM json_rows))"""

MISSING = "('', 'n/a')"


def present(c):
    return f"CASE WHEN {c} NOT IN {MISSING} THEN {c} END AS {c}"


FEATURES = f"customer_id, {', '.join(CATEGORICAL)}"
NAMES = "customer_id, " + ", ".join([*NUMERIC, *CATEGORICAL]) + ", churn"
RAGGED_LAST = {"churn": "k % 3 = 0", "device_protection": "k % 3 <> 2"}
ISO = "strftime({c}, '%Y-%m-%dT%H:%M:%S') || '+0000'"
CATEGORY_TEXT = " || '|' || ".join(f"coalesce({c}, '')" for c in CATEGORICAL)
NUMBER_SUM = " + ".join(["0.0::DOUBLE", *[f"coalesce({c}, 0.0::DOUBLE)" for c in NUMERIC]])
BODY = "'" + ",".join(CATEGORICAL) + "' || chr(10) || " + " || ',' || ".join(f"coalesce({c}, '')" for c in CATEGORICAL)
APPENDED = CLEANED + """,
appended AS (SELECT *, '2024-06-01T00:00:00+0000' AS event_time, DATE '2024-06-01' AS event_date FROM cleaned
  UNION ALL SELECT *, '2024-06-02T12:00:00+0000', DATE '2024-06-02' FROM cleaned WHERE churn = 1)"""
SENT = """CASE WHEN CAST(substr(customer_id, 6) AS BIGINT) % 3 <> 0
  THEN strftime(TIMESTAMP '2024-01-01' + to_days(CAST(CAST(substr(customer_id, 6) AS BIGINT) % 28 AS INTEGER))
       - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '+0000'
  ELSE '2024-06-01T00:00:00+0000' END"""

SHARES = """WITH sizes AS (SELECT {target}, count(*) AS n, sum(count(*)) OVER () AS total FROM {table} GROUP BY 1),
    base AS (SELECT *, CAST(ceil(0.2 * total) AS BIGINT) AS want FROM sizes),
    shares AS (SELECT *, want * n // total AS k, want * n % total AS rest FROM base),
    quota AS (SELECT {target}, n, CAST(k + CASE WHEN row_number() OVER (ORDER BY rest DESC, {target})
        <= want - sum(k) OVER () THEN 1 ELSE 0 END AS BIGINT) AS k FROM shares)
    SELECT {target}, TRUE AS is_test, k AS n FROM quota WHERE k > 0
    UNION ALL SELECT {target}, FALSE, n - k FROM quota WHERE n > k"""

ORACLES = {
    "raw_scan": with_(CHURN_RAW, "SELECT * FROM churn_raw"),
    "range_train": with_(CHURN_RAW, f"SELECT * FROM churn_raw WHERE {TRAIN_IDS}"),
    "range_infer": with_(CHURN_RAW, f"SELECT * FROM churn_raw WHERE {INFER_IDS}"),
    "key_format": """SELECT c_custkey, printf('CUST_%06d', c_custkey) AS customer_id,
        printf('CUST_%06d', c_custkey + 999000) AS long_key FROM customer""",
    "clean_strip": with_(STRIPPED, "SELECT * FROM stripped"),
    "clean_null_literal": with_(STRIPPED, "SELECT " + listing(RAW.names, "coalesce({c}, 'None')") + " FROM stripped"),
    "clean_numeric": with_(
        STRIPPED, f"SELECT customer_id, {', '.join(f'{number(c)} AS {c}' for c in NUMERIC)} FROM stripped"),
    "clean_target": with_(STRIPPED, f"SELECT customer_id, {FLAG} AS churn FROM stripped"),
    "clean_titlecase": with_(CLEANED, f"SELECT {FEATURES} FROM cleaned"),
    "clean_event_time": """SELECT o_orderkey, CASE
        WHEN o_orderkey % 6 IN (0, 1) THEN '2024-06-01T00:00:00'
        WHEN o_orderkey % 6 = 2 THEN strftime(o_orderdate - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S')
        ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END || '+0000' AS event_time FROM orders""",
    "clean_all": with_(CLEANED, "SELECT * FROM cleaned"),
    "impute_unknown": with_(CLEANED, f"SELECT customer_id, {', '.join(unknown(c) for c in CATEGORICAL)} FROM cleaned"),
    "impute_median": with_(PARTS, "SELECT customer_id, " + ", ".join(
        f"coalesce({c}, {median('train', c)}) AS {c}" for c in NUMERIC) + " FROM train"),
    "impute_saved_median": with_(PARTS, "SELECT customer_id, " + ", ".join(
        f"coalesce({c}, {median('train', c)}) AS {c}" for c in NUMERIC) + " FROM infer"),
    "column_medians": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {median('lineitem', c)} AS median"
        for c in ("l_quantity", "l_extendedprice", "l_discount")),
    "encode_fit": with_(CODES, "SELECT * FROM codes"),
    "encode_fit_wide": f"""SELECT "column", value,
        CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT * FROM ({long_form('customer', ['c_name', 'c_mktsegment'], '{c}')}))""",
    "codes_saved": with_(CODES, "SELECT * FROM codes"),
    "encode_apply": with_(CODES, coded("infer")),
    "encode_unseen_first": with_(CODES, coded("churn_raw")),
    "distinct_by_bitmaps": " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count(DISTINCT {value}) AS n_values FROM lineitem" for name, value in (
            ("l_orderkey", "l_orderkey"), ("line", "(l_orderkey, l_linenumber)"), ("l_linenumber", "l_linenumber"),
            ("far_apart", "l_orderkey"))),
    "encode_hot_value": """SELECT l_orderkey, l_linenumber, coalesce(code, -1.0) AS ordered FROM
        (SELECT *, CASE WHEN l_orderkey % 2 = 0 THEN '0' WHEN l_orderkey % 50 <> 1 THEN CAST(l_orderkey AS VARCHAR) END AS v
         FROM lineitem) LEFT JOIN (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) AS code
         FROM (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS v FROM orders)) USING (v)""",
    "encode_by_join": """SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS DOUBLE) AS p_name,
        CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS DOUBLE) AS p_type FROM part""",
    "encode_target": with_(CLEANED, """SELECT customer_id,
        CAST(dense_rank() OVER (ORDER BY payment_method) - 1 AS INTEGER) AS code FROM cleaned"""),
    "unseen_report": with_(CODES, f"""SELECT r."column", r.value, count(*) AS n_rows
        FROM ({long_form('churn_raw', CATEGORICAL)}) r LEFT JOIN codes c ON r."column" = c."column" AND r.value = c.value
        WHERE c.code IS NULL GROUP BY 1, 2"""),
    "encode_cardinality": with_(CODES, 'SELECT "column", count(*) AS n_values FROM codes GROUP BY 1'),
    "drop_meta": with_(CLEANED, "SELECT * EXCLUDE (customer_id) REPLACE (CAST(churn AS BIGINT) AS churn) FROM cleaned"),
    "drop_ids": with_(CLEANED, "SELECT * EXCLUDE (customer_id) FROM cleaned"),
    "select_features": with_(CLEANED, "SELECT customer_id, total_charges, age, contract_type FROM cleaned"),
    "select_features_lenient": with_(CLEANED, "SELECT customer_id, total_charges, age FROM cleaned"),
    "default_meta": with_(CLEANED, """SELECT customer_id, churn, '2024-06-01T00:00:00+0000' AS event_time,
        0 AS is_deleted FROM cleaned"""),
    "detect_target": with_(CLEANED, "SELECT 'churn' AS target, churn AS class, count(*) AS n FROM cleaned GROUP BY churn"),
    "feature_target": with_(CLEANED, f"""SELECT {CATEGORY_TEXT} AS texts, {NUMBER_SUM} AS numbers_sum,
        {len(CATEGORICAL)} AS n_texts, {len(NUMERIC)} AS n_numbers, churn AS target FROM cleaned"""),
    "split_counts": with_(SPLIT, "SELECT churn, is_test, count(*) AS n FROM is_test_rows GROUP BY 1, 2"),
    "split_rows": with_(SPLIT, "SELECT * FROM is_test_rows"),
    "split_rows_bucketed": with_(SPLIT, "SELECT * FROM is_test_rows"),
    "split_validation": with_(
        SPLIT + ", rest AS (SELECT * FROM is_test_rows WHERE NOT is_test),"
        + split_ctes("rest", "42-validation", "is_validation"), "SELECT * FROM is_validation_rows"),
    "split_copies": """WITH sizes AS (SELECT l_returnflag, count(*) AS n, (SELECT count(*) FROM lineitem) AS total
            FROM lineitem GROUP BY 1),
        base AS (SELECT *, CAST(ceil(0.2 * total) AS BIGINT) AS want FROM sizes),
        shares AS (SELECT *, want * n // total AS k, want * n % total AS rest FROM base),
        quota AS (SELECT l_returnflag, n, CAST(k + CASE WHEN row_number() OVER (ORDER BY rest DESC, l_returnflag)
            <= want - sum(k) OVER () THEN 1 ELSE 0 END AS BIGINT) AS k FROM shares)
        SELECT l_returnflag, TRUE AS is_test, k AS n FROM quota UNION ALL SELECT l_returnflag, FALSE, n - k FROM quota""",
    "prep_metadata": with_(SPLIT, f"""SELECT 'churn' AS target_column, '{",".join(CATEGORICAL)}' AS categorical_columns,
        count(*) FILTER (NOT is_test) AS n_train_samples, count(*) FILTER (is_test) AS n_test_samples,
        CAST(count(DISTINCT churn) AS INTEGER) AS n_classes,
        (SELECT '{{' || string_agg('"' || churn || '":' || n, ',' ORDER BY churn) || '}}' FROM is_test_sizes)
          AS class_distribution FROM is_test_rows"""),
    "class_distribution": with_(CLEANED, "SELECT churn AS class, count(*) AS n FROM cleaned GROUP BY churn"),
    "churn_rate": with_(CLEANED, "SELECT count(*) AS n_rows, avg(churn) AS churn_rate FROM cleaned"),
    "n_classes": with_(CLEANED, "SELECT count(DISTINCT payment_method) AS n_classes FROM cleaned"),
    "classes_sorted": with_(CLEANED, """SELECT CAST(row_number() OVER (ORDER BY class) - 1 AS INTEGER) AS position, class
        FROM (SELECT DISTINCT payment_method AS class FROM cleaned)"""),
    "confusion": with_(SCORED_BINARY + METRICS, GRID),
    "confusion_multi": with_(SCORED_MULTI + METRICS, GRID),
    "accuracy": with_(SCORED_BINARY + METRICS, "SELECT accuracy, n FROM totals"),
    "weighted_prf": with_(SCORED_MULTI + METRICS, 'SELECT "precision", recall, f1_score, n_classes FROM totals'),
    "per_class_prf": with_(SCORED_MULTI + METRICS, "SELECT * FROM scores"),
    "class_report": with_(SCORED_MULTI + METRICS, """
        SELECT CAST(class AS VARCHAR) AS "row", "precision", recall, f1_score, support FROM scores
        UNION ALL SELECT 'accuracy', NULL, NULL, accuracy, n FROM totals
        UNION ALL SELECT 'macro avg', macro_precision, macro_recall, macro_f1_score, n FROM totals
        UNION ALL SELECT 'weighted avg', "precision", recall, f1_score, n FROM totals"""),
    "roc_auc": with_(SCORED_AUC, f"SELECT {AUC} AS roc_auc"),
    "evaluation_report": with_(SCORED_AUC + METRICS, f"""SELECT accuracy, "precision", recall, f1_score, n AS test_samples,
        n_classes, {DISTRIBUTION} AS class_distribution, {AUC} AS roc_auc FROM totals"""),
    "evaluation_report_multi": with_(SCORED_MULTI + METRICS, f"""SELECT accuracy, "precision", recall, f1_score,
        n AS test_samples, n_classes, {DISTRIBUTION} AS class_distribution,
        (SELECT CAST(count(*) AS INTEGER) FROM scores) AS precision_per_class,
        (SELECT CAST(count(*) AS INTEGER) FROM scores) AS recall_per_class,
        (SELECT CAST(count(*) AS INTEGER) FROM scores) AS f1_per_class FROM totals"""),
    "batch_report": with_(
        SCORED_BINARY + METRICS, 'SELECT accuracy, "precision", recall, f1_score AS f1, n FROM totals'),
    "regression_report": """SELECT sqrt(avg((l_quantity - l_linenumber) * (l_quantity - l_linenumber))) AS rmse,
        avg(abs(l_quantity - l_linenumber)) AS mae FROM lineitem""",
    "metrics_by_name": with_(SCORED_AUC + METRICS, f"""SELECT 'Accuracy' AS metric, accuracy AS value FROM totals
        UNION ALL SELECT 'F1', f1_score FROM totals UNION ALL SELECT 'Precision', "precision" FROM totals
        UNION ALL SELECT 'Recall', recall FROM totals UNION ALL SELECT 'AUC', {AUC}
        UNION ALL SELECT 'RMSE', sqrt(avg(CAST((label - prediction) * (label - prediction) AS DOUBLE))) FROM scored
        UNION ALL SELECT 'MAE', avg(CAST(abs(label - prediction) AS DOUBLE)) FROM scored"""),
    "risk_score": with_(CLEANED, f"SELECT customer_id, {risk()} AS risk FROM cleaned"),
    "bernoulli_label": with_(CLEANED, f"""SELECT customer_id,
        CAST({uniform('customer_id', '42')} < {risk()} AS INTEGER) AS label FROM cleaned"""),
    "derived_columns": f"""SELECT c_custkey,
        CAST(18 + floor({uniform('c_custkey', 'age')} * 62.0::DOUBLE) AS INTEGER) AS age,
        round(20.0::DOUBLE + {uniform('c_custkey', 'charge')} * 100.0::DOUBLE, 2) AS monthly_charges,
        ['DSL', 'Fiber optic', 'No'][CAST(floor({uniform('c_custkey', 'internet')} * 3.0::DOUBLE) AS INTEGER) + 1]
          AS internet_service FROM customer""",
    "run_names": "SELECT DISTINCT p_brand, p_brand || '-model-1717200000' AS name FROM part",
    "predicted_churners_top100": with_(PREDICTED, """SELECT customer_id, contract_type, churn, prediction
        FROM scored_infer WHERE prediction = 1 ORDER BY customer_id LIMIT 100"""),
    "latest_features": with_(VERSIONS, """SELECT customer_id, event_time, total_charges, write_time, o_orderkey FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY event_time DESC, write_time DESC, o_orderkey DESC) AS i
        FROM versions) WHERE i = 1 AND NOT is_deleted"""),
    "features_as_of": with_(VERSIONS + """,
        single AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, event_time
            ORDER BY write_time DESC, o_orderkey DESC) AS i FROM versions) WHERE i = 1),
        spine AS (SELECT printf('CUST_%06d', o_custkey) AS customer_id, l_shipdate AS as_of
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
        """SELECT s.customer_id, s.as_of, CASE WHEN NOT v.is_deleted THEN v.event_time END AS feature_event_time,
            CASE WHEN NOT v.is_deleted THEN v.total_charges END AS total_charges
        FROM spine s ASOF LEFT JOIN single v ON s.customer_id = v.customer_id AND s.as_of >= v.event_time"""),
    "bucketed_as_of": with_(VERSIONS + """,
        single AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, event_time
            ORDER BY write_time DESC, o_orderkey DESC) AS i FROM versions) WHERE i = 1),
        spine AS (SELECT printf('CUST_%06d', o_custkey) AS customer_id, l_shipdate AS as_of
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
        """SELECT s.customer_id, s.as_of, CASE WHEN NOT v.is_deleted THEN v.event_time END AS feature_event_time,
            CASE WHEN NOT v.is_deleted THEN v.total_charges END AS total_charges
        FROM spine s ASOF LEFT JOIN single v ON s.customer_id = v.customer_id AND s.as_of >= v.event_time"""),
    "bucketed_latest": with_(VERSIONS, """SELECT customer_id, event_time, total_charges, o_orderkey FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id
            ORDER BY event_time DESC, write_time DESC, is_deleted DESC, o_orderkey DESC) AS i
        FROM versions) WHERE i = 1 AND NOT is_deleted"""),
    "newest_merged": with_(VERSIONS, """SELECT customer_id, event_time, total_charges, o_orderkey FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id
            ORDER BY event_time DESC, write_time DESC, is_deleted DESC, o_orderkey DESC) AS i
        FROM versions) WHERE i = 1 AND NOT is_deleted"""),
    "newest_caught_up": with_(CLEANED, """SELECT customer_id, contract_type, CAST(CASE WHEN churn = 1 THEN 2 ELSE churn END AS BIGINT) AS churn,
        CASE WHEN churn = 1 THEN '2024-06-02T12:00:00+0000' ELSE '2024-06-01T00:00:00+0000' END AS event_time FROM cleaned"""),
    "range_overlap": with_(PARTS, "SELECT customer_id FROM train INTERSECT SELECT customer_id FROM infer"),
    "infer_without_train": with_(
        PARTS, "SELECT customer_id, churn FROM infer WHERE customer_id NOT IN (SELECT customer_id FROM train)"),
    "align_by_key": with_(PREDICTED, "SELECT customer_id, churn, prediction FROM scored_infer"),
    "attach_predictions": with_(PREDICTED, """SELECT c.customer_id, c.contract_type, s.prediction
        FROM cleaned c LEFT JOIN scored_infer s USING (customer_id)"""),
    "registry_latest_approved": with_(REGISTRY, """SELECT "group", entry_id, model_path, accuracy, status, created_at FROM (
        SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY created_at DESC, entry_id DESC) AS i
        FROM entries WHERE status = 'Approved') WHERE i = 1"""),
    "registry_latest_pending": with_(REGISTRY, """SELECT "group", entry_id FROM (
        SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY created_at DESC, entry_id DESC) AS i
        FROM entries WHERE status = 'PendingManualApproval') WHERE i = 1"""),
    "best_candidate": with_(REGISTRY, """SELECT "group", entry_id, accuracy FROM (
        SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY accuracy DESC, entry_id) AS i FROM entries)
        WHERE i = 1"""),
    "registry_versions": with_(REGISTRY, """SELECT "group", entry_id,
        row_number() OVER (PARTITION BY "group" ORDER BY created_at, entry_id) AS version FROM entries"""),
    "quality_gate": with_(REGISTRY, 'SELECT "group", entry_id, accuracy FROM entries WHERE accuracy >= 0.5::DOUBLE'),
    "registry_status": with_(REGISTRY, """SELECT "group", entry_id, CASE WHEN accuracy >= 0.7::DOUBLE THEN 'Approved'
        ELSE 'PendingManualApproval' END AS status FROM entries"""),
    "newest_run": with_(REGISTRY, """SELECT "group", entry_id, model_path FROM entries
        ORDER BY created_at DESC, entry_id DESC LIMIT 1"""),
    "csv_roundtrip": with_(CHURN_RAW, f"SELECT {', '.join(present(c) for c in RAW.names)} FROM churn_raw"),
    "csv_headerless": with_(CLEANED, f"SELECT {NAMES} FROM cleaned"),
    "csv_ragged": with_(
        STRIPPED + ", cut AS (SELECT *, CAST(substr(customer_id, 6) AS BIGINT) AS k FROM stripped)",
        "SELECT " + ", ".join(
            present(c) if c not in RAGGED_LAST
            else f"CASE WHEN {RAGGED_LAST[c]} AND {c} NOT IN {MISSING} THEN {c} END AS {c}"
            for c in RAW.names) + " FROM cut"),
    "parquet_or_csv": with_(CLEANED, f"SELECT {NAMES} FROM cleaned"),
    "parquet_and_csv": with_(CLEANED, """SELECT copy, churn, count(*) AS n, count(contract_type) AS n_contracts
        FROM cleaned, (SELECT unnest(['parquet', 'csv']) AS copy) GROUP BY copy, churn"""),
    "union_by_name": with_(CHURN_RAW, f"""
        SELECT customer_id, payment_method, phone_service, NULL AS online_security FROM churn_raw WHERE {TRAIN_IDS}
        UNION ALL SELECT customer_id, payment_method, NULL, online_security FROM churn_raw WHERE {INFER_IDS}"""),
    "union_headers": with_(CHURN_RAW, """SELECT customer_id,
        CASE WHEN CAST(substr(customer_id, 6) AS BIGINT) % 3 < 2 THEN payment_method END AS payment_method,
        CASE WHEN CAST(substr(customer_id, 6) AS BIGINT) % 3 = 1 THEN phone_service END AS phone_service,
        CASE WHEN CAST(substr(customer_id, 6) AS BIGINT) % 3 = 2 THEN online_security END AS online_security FROM churn_raw"""),
    "union_parts": with_(PREDICTED, f"""SELECT customer_id, prediction FROM scored_rows WHERE {TRAIN_IDS}
        UNION ALL SELECT customer_id, prediction FROM scored_infer"""),
    "published_table": with_(PREDICTED, """SELECT * REPLACE (CAST(churn AS BIGINT) AS churn,
        CAST(prediction AS BIGINT) AS prediction) FROM scored_infer"""),
    "published_broken_run": with_(PREDICTED, """SELECT customer_id, contract_type, CAST(prediction AS BIGINT) AS prediction
        FROM scored_rows WHERE prediction = 1"""),
    "published_csv": with_(PREDICTED, """SELECT customer_id, contract_type, CAST(prediction AS BIGINT) AS prediction
        FROM scored_infer"""),
    "labelled_table": with_(PARTS, """SELECT * REPLACE (CAST(age AS INTEGER) AS age,
        CAST(tenure_months AS INTEGER) AS tenure_months) FROM infer"""),
    "run_partition": with_(PARTS, """SELECT customer_id, churn, 'a1' AS run FROM train
        UNION ALL SELECT customer_id, churn, 'b2' FROM infer"""),
    "json_report": with_(SCORED_BINARY + METRICS, """SELECT accuracy, "precision", recall, f1_score, n AS test_samples,
        n_classes FROM totals"""),
    "feature_group_append": with_(APPENDED, f"""SELECT customer_id, age, contract_type, CAST(churn AS BIGINT) AS churn,
        event_time, FALSE AS is_deleted, CAST(event_date AS VARCHAR) AS event_date FROM appended WHERE {TRAIN_IDS}"""),
    "feature_group_latest": with_(APPENDED, """SELECT customer_id, any_value(contract_type) AS contract_type,
        CAST(any_value(churn) AS BIGINT) AS churn, max(event_time) AS event_time FROM appended GROUP BY customer_id"""),
    "parse_csv_requests": with_(ASKED, "SELECT * FROM csv_rows"),
    "parse_json_requests": with_(ASKED, "SELECT * FROM json_rows"),
    "bad_requests": with_(ASKED, """SELECT request_id, CASE WHEN k % 5 = 0 THEN 'unsupported content type'
        ELSE 'unsupported JSON' END AS reason FROM asked WHERE k % 5 = 0 OR k % 7 = 0"""),
    "csv_answers": with_(ASKED, """SELECT request_id, string_agg(CAST(prediction AS VARCHAR), ',' ORDER BY row_no) AS answer
        FROM ruled GROUP BY request_id"""),
    "json_answers": with_(ASKED, """SELECT request_id, '{"predictions": [' ||
        string_agg(CAST(prediction AS VARCHAR), ', ' ORDER BY row_no) || ']}' AS answer FROM ruled GROUP BY request_id"""),
    "replay_requests": with_(CLEANED, f"""SELECT customer_id AS request_id, 'text/csv' AS content_type,
        {BODY} AS body FROM cleaned"""),
    "replay_parsed": with_(STRIPPED, f"""SELECT customer_id AS request_id, {', '.join(present(c) for c in CATEGORICAL)}
        FROM stripped"""),
    "requests_per_minute": """SELECT event_type AS endpoint, date_trunc('minute', ts) AS minute, count(*) AS n_requests,
        CAST(least(greatest(ceil(count(*) / 2.0), 1), 5) AS INTEGER) AS instances FROM events GROUP BY 1, 2""",
    "stream_requests_per_minute": """SELECT event_type AS endpoint, date_trunc('minute', ts) AS minute,
        count(*) AS n_requests, CAST(least(greatest(ceil(count(*) / 2.0), 1), 5) AS INTEGER) AS instances
        FROM events GROUP BY 1, 2
        HAVING date_trunc('minute', ts) + INTERVAL 1 MINUTE <= date_trunc('millisecond', (SELECT max(ts) FROM events))
          - INTERVAL 10 MINUTE""",
    "published_twice": with_(PREDICTED, """SELECT * REPLACE (CAST(churn AS BIGINT) AS churn,
        CAST(prediction AS BIGINT) AS prediction) FROM scored_infer"""),
    "feature_group_reordered": with_(CLEANED, """SELECT customer_id, age, tenure_months, CAST(churn AS BIGINT) AS churn
        FROM cleaned UNION ALL SELECT customer_id, age, tenure_months, CAST(churn AS BIGINT) FROM cleaned WHERE churn = 1"""),
    "split_ties": SHARES.format(target="event_type", table="(SELECT event_type FROM events UNION ALL SELECT event_type FROM events)"),
    "split_many_classes": SHARES.format(target="l_orderkey", table="lineitem"),
    "event_time_formats": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT00:00:00+0000') AS event_time FROM orders""",
    "requests_accounted": with_(ASKED, """SELECT request_id, CASE WHEN k % 5 = 0 THEN 'unsupported content type'
        WHEN k % 7 = 0 THEN 'unsupported JSON' WHEN k % 7 IN (1, 2) THEN NULL ELSE 'wrong number of features' END AS reason FROM asked"""),
    "forest_rule": """SELECT 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS "precision", 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1_score,
        1.0::DOUBLE AS roc_auc, 'line' AS first_feature, 1.0::DOUBLE AS train_accuracy, 'Approved' AS status""",
    "soft_vote_multi": """SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS line,
        CAST((l_linenumber - 1) // 3 AS DOUBLE) AS prediction, 1.0::DOUBLE AS probability FROM lineitem""",
    "halving_survivor": """SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS line,
        CAST((l_linenumber - 1) // 3 AS DOUBLE) AS prediction, 'candidate-03' AS candidate, 1.0::DOUBLE AS accuracy,
        3 AS n_rungs, 7 AS n_fits FROM lineitem""",
    "bundle_roundtrip": with_(CLEANED, "SELECT customer_id, TRUE AS alike FROM cleaned"),
    "batch_inference_rows": with_(PARTS, """SELECT customer_id, age, contract_type, CAST(churn AS BIGINT) AS churn,
        TRUE AS consistent FROM infer"""),
    "stream_score_rows": with_(CLEANED, "SELECT customer_id, 2 AS n, TRUE AS alike FROM cleaned"),
    "stream_then_batch": with_(CLEANED, """SELECT customer_id, CAST(churn AS BIGINT) AS churn,
        '2024-06-01T00:00:00+0000' AS event_time FROM cleaned"""),
    "stream_minute_counts": """SELECT event_type AS endpoint, date_trunc('minute', ts) AS minute, count(*) AS n_requests,
        CAST(least(greatest(ceil(count(*) / 2.0), 1), 5) AS INTEGER) AS instances FROM events GROUP BY 1, 2""",
    "stream_requests_scored": with_(ASKED, """SELECT request_id,
        CASE WHEN k % 5 = 0 OR k % 7 = 0 THEN 0 WHEN k % 7 IN (2, 3) THEN 2 ELSE 1 END AS n_rows,
        CASE WHEN k % 5 = 0 OR k % 7 = 0 THEN NULL ELSE TRUE END AS valid,
        CASE WHEN k % 5 = 0 THEN 'unsupported content type' WHEN k % 7 = 0 THEN 'unsupported JSON' END AS reason FROM asked"""),
    "stream_ingest_late": with_(CLEANED, f"SELECT *, {SENT} AS event_time FROM cleaned"),
    "stream_ingest": with_(CLEANED, f"SELECT *, {SENT} AS event_time FROM cleaned"),
    "ranked_values": """SELECT c_mktsegment, c_custkey,
        row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS place FROM customer""",
}
