"""Scoring requests as a table: (request_id, content_type, body) in, answers or reasons out."""

from pyspark.sql import functions as F, types as T

from larkspur.functions.text import missing_to_null

CSV, JSON = "text/csv", "application/json"

# A line ends at a line break outside quotes; a field is quoted text or anything without a comma.
LINE_PATTERN = r'((?:[^"\r\n]++|"[^"]*+")*+)\r?\n'
FIELD_PATTERN = r',("[^"]*+(?:""[^"]*+)*+"|[^,]*+)'


def _lines(body):
    found = F.regexp_extract_all(F.concat(body, F.lit("\n")), F.lit(LINE_PATTERN), F.lit(1))
    return F.filter(found, lambda line: F.trim(line) != "")


def _fields(line):
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(FIELD_PATTERN), F.lit(1))
    return F.transform(
        found,
        lambda x: F.when(
            x.startswith('"'), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
        ).otherwise(x),
    )


def parse_csv(requests, names):
    """Rows of the CSV bodies by column name, as text; a field that is not sent is NULL. Bodies with an open
    quote have no rows."""
    quotes = F.length("body") - F.length(F.replace(F.col("body"), F.lit('"'), F.lit("")))
    bodies = requests.where((F.col("content_type") == CSV) & (quotes % 2 == 0)).select(
        "request_id", _lines(F.col("body")).alias("_lines")
    )
    # The header is taken before the lines are spread, so that a row carries it and not the body.
    headed = bodies.select("request_id", "_lines", _fields(F.get("_lines", F.lit(0))).alias("_head"))
    places = headed.select(
        "request_id", "_lines",
        *[F.nullif(F.array_position("_head", F.lit(n)), F.lit(0)).cast("int").alias(f"_at_{n}") for n in names],
    )
    rows = places.select(
        "request_id", *[f"_at_{n}" for n in names], F.posexplode("_lines").alias("row_no", "_line")
    ).where("row_no > 0")
    split = rows.withColumn("_row", _fields(F.col("_line")))
    found = split.select(
        "request_id", "row_no", *[F.get("_row", F.col(f"_at_{n}") - 1).alias(n) for n in names]
    )
    return found.select("request_id", "row_no", *[missing_to_null(F.col(n)).alias(n) for n in names])


def json_rows(body):
    """Rows of numbers in a JSON body, NULL when it has none of the accepted shapes."""
    matrix = "array<array<double>>"
    named = F.from_json(body, f"instances {matrix}, data {matrix}")
    keys = F.json_object_keys(body)
    single = F.array(F.map_values(F.from_json(body, "map<string,double>")))
    return (
        F.when(body.rlike(r"^\s*\["), F.from_json(body, matrix))
        .when(F.array_contains(keys, "instances"), named["instances"])
        .when(F.array_contains(keys, "data"), named["data"])
        .when(F.size(keys) > 0, single)
    )


def _usable(rows):
    """A matrix without holes: every row is there and every value is a number."""
    return F.coalesce(
        (F.size(rows) > 0)
        & F.forall(rows, lambda r: F.coalesce(F.forall(r, lambda v: v.isNotNull()), F.lit(False))),
        F.lit(False),
    )


def parse_json(requests):
    """(request_id, row_no, features) of the JSON bodies."""
    rows = json_rows(F.col("body"))
    found = requests.where(F.col("content_type") == JSON).withColumn("_rows", rows).where(_usable(F.col("_rows")))
    return found.select("request_id", F.posexplode("_rows").alias("_at", "features")).select(
        "request_id", (F.col("_at") + 1).alias("row_no"), "features"
    )


def refusal(features=None):
    """Why a request cannot be answered, or NULL. With ``features`` its columns are looked at as well: a
    CSV body has to name all of them, a JSON row has to have as many values."""
    kind, body = F.col("content_type"), F.col("body")
    lines, rows = _lines(body), json_rows(body)
    quotes = F.length(body) - F.length(F.replace(body, F.lit('"'), F.lit("")))
    reason = (
        F.when(~kind.isin(CSV, JSON) | kind.isNull(), F.lit("unsupported content type"))
        .when((kind == JSON) & ~_usable(rows), F.lit("unsupported JSON"))
        .when((kind == CSV) & (quotes % 2 == 1), F.lit("open quote"))
        .when((kind == CSV) & (F.coalesce(F.size(lines), F.lit(0)) < 2), F.lit("no rows"))
    )
    if features is not None:
        named = F.size(F.array_except(F.array(*[F.lit(c) for c in features]), _fields(F.get(lines, F.lit(0)))))
        wide = F.exists(rows, lambda r: F.size(r) != len(features))
        reason = reason.when((kind == CSV) & (named > 0), F.lit("missing columns"))
        reason = reason.when((kind == JSON) & wide, F.lit("wrong number of features"))
    return reason


def bad_requests(requests, features=None):
    """(request_id, reason) of what cannot be read or, with ``features``, not be scored."""
    return requests.select("request_id", refusal(features).alias("reason")).where("reason is not null")


def answers(predictions, accept=JSON):
    """One answer per request; the predictions of a request go back in row order.

    A request's rows came out of one body, so its answer is never larger than that body's rows.
    """
    if accept not in (CSV, JSON):
        raise ValueError(f"unsupported content type: {accept}")
    pairs = F.array_sort(F.collect_list(F.struct("row_no", F.col("prediction").cast("string").alias("p"))))
    values = F.transform(pairs, lambda x: x["p"])
    text = F.array_join(values, ",") if accept == CSV else F.concat(
        F.lit('{"predictions": ['), F.array_join(values, ", "), F.lit("]}")
    )
    return predictions.groupBy("request_id").agg(text.alias("answer"))


def _quoted(c):
    text = c.cast("string")
    needs = text.rlike(r'[",\r\n]')
    return F.coalesce(
        F.when(needs, F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text),
        F.lit(""),
    )


def csv_body(columns, header=True):
    """One row as a CSV body, with or without its header line."""
    line = F.concat_ws(",", *[_quoted(F.col(c)) for c in columns])
    return F.concat(F.lit(",".join(columns) + "\n"), line) if header else line


def replay(df, request_id, columns, header=True):
    """Every row as one CSV request."""
    return df.select(
        F.col(request_id).alias("request_id"), F.lit(CSV).alias("content_type"),
        csv_body(columns, header).alias("body"),
    )


def score_requests(requests, model, preprocess, clean=None):
    """(request_id, row_no, prediction): named rows are preprocessed, bare numbers go to the model.

    ``clean`` runs on named rows first, so that they look like the rows the codes were fitted on. Requests
    that ``bad_requests`` with the model's features names are the ones left out.
    """
    from larkspur.operators import models

    requests = requests.where(refusal(preprocess.features).isNull())
    named = parse_csv(requests, preprocess.features)
    if clean is not None:
        named = clean(named)
    else:
        named = named.withColumns({c: F.col(c).try_cast("double") for c in preprocess.numeric})
    ready = preprocess.apply(named, keep=["request_id", "row_no"])
    bare = parse_json(requests).select(
        "request_id", "row_no",
        *[F.get("features", F.lit(i)).alias(c) for i, c in enumerate(preprocess.features)],
    )
    both = ready.unionByName(bare)
    return models.predict(model, both).select(
        "request_id", F.col("row_no").cast("int").alias("row_no"),
        F.col("prediction").cast("int").alias("prediction"), "probability",
    )


def wrong_width(requests, n_features):
    """JSON requests whose rows do not have the model's number of features."""
    wide = bad_requests(requests, [f"f{i}" for i in range(n_features)])
    return wide.where(F.col("reason") == "wrong number of features")


REQUEST = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("request_id", "content_type", "body")]
)
