"""Record keys: zero-padded numbers behind a prefix."""

from pyspark.sql import functions as F

PREFIX = "CUST_"
WIDTH = 6


def format_key(number):
    """``CUST_000042``; longer numbers keep all their digits (``lpad`` would cut them)."""
    return F.format_string(f"{PREFIX}%0{WIDTH}d", number)


def key_text(number):
    return f"{PREFIX}{number:0{WIDTH}d}"


def key_between(c, start, end, by_text=False):
    """Keys from number ``start`` to number ``end``, both included.

    Text order equals number order only among keys of one length, so each length has its own
    range; all of them compare the bare column and reach the scan. ``by_text`` compares text alone.
    """
    low, high = key_text(start), key_text(end)
    if by_text:
        return c.between(low, high)
    parts = []
    for size in range(len(low), len(high) + 1):
        digits = size - len(PREFIX)
        first = low if size == len(low) else PREFIX + "1" + "0" * (digits - 1)
        last = high if size == len(high) else PREFIX + "9" * digits
        parts.append(c.between(first, last) & (F.length(c) == size))
    found = parts[0]
    for part in parts[1:]:
        found = found | part
    return found
