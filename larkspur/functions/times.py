"""Time expressions."""

import re

from pyspark.sql import functions as F

ZONE_PATTERN = r"(Z|[+-]\d{2}:?\d{2})$"


#: Read besides ISO, in this order; months come before days.
FORMATS = (
    "yyyy-MM-dd HH:mm", "yyyy/MM/dd", "yyyyMMdd", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm", "MM/dd/yyyy", "M/d/yyyy",
    "MMM d yyyy", "MMM d, yyyy", "d MMM yyyy",
)


def parse_event_time(c, run_ts):
    """Text to timestamp; text without a zone is UTC; bad or missing text gives the run's time."""
    return F.coalesce(read_event_time(c), as_timestamp(run_ts))


def read_event_time(c):
    """ISO text, or text in one of ``FORMATS``, as a timestamp; NULL for other text."""
    text = F.trim(c)
    zoned = F.when(text.rlike(ZONE_PATTERN), text).otherwise(F.concat(text, F.lit("Z")))
    # A bare date needs a time part before a zone can follow it.
    dated = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(text, F.lit("T00:00:00Z")))
    # Eight digits alone would pass for a year.
    iso = F.when(~text.rlike(r"^\d{5,}$"), F.coalesce(dated, zoned).try_cast("timestamp"))
    # A text is tried in those formats only whose fixed characters it has.
    others = [F.when(text.rlike(shape_of(f)), F.try_to_timestamp(F.concat(text, F.lit("Z")), F.lit(f"{f}X"))) for f in FORMATS]
    return F.coalesce(iso, *others)


def shape_of(form):
    """A pattern that every text of a format holds: letters for month names, its other characters, digits between."""
    parts = re.split(r"([^A-Za-z]+)", form)
    return ".*".join(re.escape(p) if i % 2 else "[A-Za-z]" if p == "MMM" else r"\d" for i, p in enumerate(parts) if p)


def as_timestamp(run_ts):
    """A run's time, given as ISO text with zone, as a timestamp literal."""
    return F.lit(run_ts).cast("timestamp")


def iso_utc(c):
    """Timestamp to ``2024-01-31T10:20:30+0000`` in any session time zone."""
    local = c.cast("timestamp_ntz")
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0000"))


def stamped_name(base, run_ts):
    """``base-<seconds>``, the unique name of a run's model or job."""
    return F.concat(F.lit(base), F.lit("-"), F.unix_timestamp(as_timestamp(run_ts)).cast("string"))
