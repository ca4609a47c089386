"""Raw text rows to typed rows."""

from pyspark.sql import functions as F, types as T

from larkspur.functions.numbers import finite, parse_number, whole_or_zero
from larkspur.functions.text import empty_to_null, strip, title_case
from larkspur.functions.times import as_timestamp, iso_utc, parse_event_time
from larkspur.schema import CATEGORICAL, EVENT_TIME, NUMERIC, TARGET


def strip_text(df, null_literal=None):
    """Strip every text column; ``null_literal`` writes missing text as that word instead of NULL."""
    out = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            c = strip(c)
            if null_literal is not None:
                c = F.coalesce(c, F.lit(null_literal))
        out.append(c.alias(field.name))
    return df.select(*out)


def parse_numbers(df, columns=NUMERIC):
    present = [c for c in columns if c in df.columns]
    parsed = df.withColumns({c: parse_number(F.col(c)) for c in present})
    return parsed.withColumns({c: finite(F.col(c)) for c in present})


def parse_target(df, target=TARGET):
    """Target to whole number; bad or missing text gives 0."""
    if target not in df.columns:
        return df
    parsed = df.withColumn(target, parse_number(F.col(target)))
    return parsed.withColumn(target, whole_or_zero(F.col(target)))


def title_categories(df, columns=CATEGORICAL):
    """Empty categories become NULL, the others are title-cased."""
    present = [c for c in columns if c in df.columns]
    known = df.withColumns({c: empty_to_null(F.col(c)) for c in present})
    return known.withColumns({c: title_case(F.col(c)) for c in present})


def clean_raw(df, numeric=NUMERIC, categorical=CATEGORICAL, target=TARGET, null_literal=None):
    """All cleaning steps; they collapse into one projection over the scan."""
    stripped = strip_text(df, null_literal)
    return title_categories(parse_target(parse_numbers(stripped, numeric), target), categorical)


def set_event_time(df, run_ts, column=EVENT_TIME):
    """The record's time as a timestamp: one run time where it is absent, missing or unreadable."""
    if column not in df.columns:
        return df.withColumn(column, as_timestamp(run_ts))
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return df.withColumn(column, parse_event_time(F.col(column), run_ts))
    return df.withColumn(column, F.coalesce(F.col(column).cast("timestamp"), as_timestamp(run_ts)))


def event_time_text(df, column=EVENT_TIME):
    """The record's time in its one output format."""
    return df.withColumn(column, iso_utc(F.col(column)))
