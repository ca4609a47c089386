"""Feature ingest: raw table, cleaning, append to the feature table."""

from larkspur.operators.clean import clean_raw
from larkspur.operators.columns import require_rows
from larkspur.sources.tables import read_table


def ingest(raw, group, run_ts, null_literal=None):
    """Clean raw rows and append them to the group; a raw table without rows is an error."""
    return group.append(clean_raw(require_rows(raw, "raw table"), null_literal=null_literal), run_ts)


def ingest_table(spark, name, group, run_ts, database=None):
    return ingest(read_table(spark, name, database), group, run_ts)
