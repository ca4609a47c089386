"""Text expressions."""

import sys

from pyspark.sql import functions as F

from larkspur.schema import MISSING_TEXTS

WHITESPACE = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())
_MARK = "\u0001 "


def strip(c):
    """Remove all leading and trailing white space, not only blanks.

    Most texts have nothing to remove: white space is a byte below ``!`` or above the ASCII letters,
    so two comparisons of the ends spare them the search. Apply it to a finished column.
    """
    last = F.substring(c, -1, 1)
    suspect = (c < "!") | (c > "\x7e") | (last < "!") | (last > "\x7e")
    return F.when(suspect, F.btrim(c, F.lit(WHITESPACE))).otherwise(c)


def empty_to_null(c):
    return F.nullif(c, F.lit(""))


def missing_to_null(c):
    """NULL for the texts a CSV reader takes as missing."""
    return F.when(~c.isin(*MISSING_TEXTS), c)


def title_case(c):
    """Capitalise every run of letters: ``month-to-month`` gives ``Month-To-Month``.

    ``initcap`` starts words at blanks only, so a marked blank goes in before each letter that
    follows another sign, and comes out again afterwards. Apply it to a finished column.
    """
    marked = F.regexp_replace(c, r"([^\p{L} ])(\p{L})", "$1" + _MARK + "$2")
    inner = F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))
    return F.when(c.rlike(r"[^\p{L} ]\p{L}"), inner).otherwise(F.initcap(c))
