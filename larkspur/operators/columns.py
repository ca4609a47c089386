"""Choosing columns: identifiers, store columns, target and features."""

from pyspark.sql import functions as F, types as T

from larkspur.schema import ID_COLUMNS, SCORING_TARGET_NAMES, STORE_COLUMNS, TARGET_NAMES


def drop_ids(df, target=None):
    return df.drop(*[c for c in ID_COLUMNS if c != target])


def drop_meta(df, target=None):
    """Drop identifier and store columns, never the target."""
    return df.drop(*[c for c in ID_COLUMNS + STORE_COLUMNS if c != target])


def detect_target(df):
    """First of the usual target names, else the last column."""
    return next((c for c in TARGET_NAMES if c in df.columns), df.columns[-1])


def detect_scoring_target(df):
    """Stricter choice on scored data: one of the names or an error."""
    for name in SCORING_TARGET_NAMES:
        if name in df.columns:
            return name
    raise ValueError(f"no target column among {df.columns}")


def text_columns(df, target=None):
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name != target]


def number_columns(df, target=None):
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name != target]


def feature_columns(df, target):
    return [c for c in df.columns if c != target]


def select_features(df, features, keep=(), lenient=False):
    """The features in trained order; a missing one is an error, or left out when ``lenient``."""
    missing = [c for c in features if c not in df.columns]
    if missing and not lenient:
        raise ValueError(f"missing expected feature columns: {missing}")
    return df.select(*keep, *[c for c in features if c not in missing])


def default_meta(df, wanted, run_ts=None):
    """Add wanted store columns that are absent: the run's time, or 0 for the deletion flag."""
    now = F.lit(run_ts).cast("timestamp") if run_ts else F.current_timestamp()
    defaults = {c: F.lit(0) if c == "is_deleted" else now for c in STORE_COLUMNS}
    return df.withColumns({c: v for c, v in defaults.items() if c in wanted and c not in df.columns})


def require_rows(df, what="input"):
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df
