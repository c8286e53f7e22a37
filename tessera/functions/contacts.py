"""U8 extract_emails and U9 extract_phone_numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._util import col
from tessera.functions.text import WS

# E-mail pattern (matched case-insensitively, with word
# boundaries between any letters), then the US and the
# international phone patterns, in that order; "\s" spelled as Python's whitespace set.
EMAIL_RE = r"(?iU)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE_US_RE = rf"\+?1?[-.{WS}]?\(?[0-9]{{3}}\)?[-.{WS}]?[0-9]{{3}}[-.{WS}]?[0-9]{{4}}"
PHONE_INTL_RE = rf"\+?[0-9]{{1,3}}[-.{WS}]?[0-9]{{3,4}}[-.{WS}]?[0-9]{{3,4}}[-.{WS}]?[0-9]{{4}}"


def extract_emails(c) -> Column:
    """U8: every e-mail address in the text, in order."""
    return F.regexp_extract_all(col(c), F.lit(EMAIL_RE), 0)


def extract_phone_numbers(c) -> Column:
    """US-pattern hits followed by international-pattern hits (duplicates kept)."""
    v = col(c)
    return F.concat(F.regexp_extract_all(v, F.lit(PHONE_US_RE), 0),
                    F.regexp_extract_all(v, F.lit(PHONE_INTL_RE), 0))
