"""U5 parse_date and T8 datetime conversion (multi-format, first match wins)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._util import col
from tessera.functions.text import strip_ws

# The twelve default formats of parse_date, in order, as strptime
# patterns, and their Spark datetime-pattern equivalents.
PARSE_DATE_FORMATS = [
    ("%Y-%m-%d %H:%M:%S", "yyyy-M-d H:m:s"),
    ("%Y-%m-%dT%H:%M:%S", "yyyy-M-d'T'H:m:s"),
    ("%Y-%m-%dT%H:%M:%SZ", "yyyy-M-d'T'H:m:s'Z'"),
    ("%Y-%m-%d", "yyyy-M-d"),
    ("%m/%d/%Y", "M/d/yyyy"),
    ("%d/%m/%Y", "d/M/yyyy"),
    ("%m-%d-%Y", "M-d-yyyy"),
    ("%d-%m-%Y", "d-M-yyyy"),
    ("%B %d, %Y", "MMMM d, yyyy"),
    ("%b %d, %Y", "MMM d, yyyy"),
    ("%d %B %Y", "d MMMM yyyy"),
    ("%d %b %Y", "d MMM yyyy"),
]

# The five formats of the datetime type conversion, in order.
CONVERT_DATETIME_FORMATS = [
    ("%Y-%m-%d %H:%M:%S", "yyyy-M-d H:m:s"),
    ("%Y-%m-%dT%H:%M:%S", "yyyy-M-d'T'H:m:s"),
    ("%Y-%m-%d", "yyyy-M-d"),
    ("%m/%d/%Y", "M/d/yyyy"),
    ("%d/%m/%Y", "d/M/yyyy"),
]

_STRPTIME_TO_SPARK = {
    "%Y": "yyyy", "%m": "M", "%d": "d", "%H": "H", "%M": "m", "%S": "s",
    "%B": "MMMM", "%b": "MMM", "%y": "yy", "%j": "D", "%f": "SSSSSS", "%p": "a", "%I": "h",
}


def strptime_to_spark(fmt: str) -> str:
    """Translate a strptime pattern to a Spark datetime pattern (literals quoted)."""
    out, lit, i = [], [], 0

    def flush():
        if lit:
            text = "".join(lit).replace("'", "''")
            out.append(text if all(ch in " -/:,." for ch in text) else f"'{text}'")
            lit.clear()

    while i < len(fmt):
        if fmt[i] == "%" and i + 1 < len(fmt):
            flush()
            out.append(_STRPTIME_TO_SPARK[fmt[i:i + 2]])
            i += 2
        else:
            lit.append(fmt[i])
            i += 1
    flush()
    return "".join(out)


_GUARD_TOKENS = [("yyyy", "[0-9]{4}"), ("MMMM", "[A-Za-z]+"), ("MMM", "[A-Za-z]{3,4}"),
                 ("yy", "[0-9]{2}"), ("SSSSSS", "[0-9]{6}"), ("M", "[0-9]{1,2}"), ("d", "[0-9]{1,2}"),
                 ("H", "[0-9]{1,2}"), ("h", "[0-9]{1,2}"), ("m", "[0-9]{1,2}"), ("s", "[0-9]{1,2}"),
                 ("D", "[0-9]{1,3}"), ("a", "[AaPp][Mm]")]


def shape_regex(pattern: str) -> str:
    """A cheap regular expression that every string the pattern can parse matches.
    Used as a guard so that ``try_to_timestamp`` (which fails through exceptions)
    only sees strings of the right shape."""
    out, i = [], 0
    while i < len(pattern):
        if pattern[i] == "'":
            j = pattern.index("'", i + 1)
            out.append(re.escape(pattern[i + 1:j]))
            i = j + 1
            continue
        for tok, rx in _GUARD_TOKENS:
            if pattern.startswith(tok, i):
                out.append(rx)
                i += len(tok)
                break
        else:
            out.append(re.escape(pattern[i]))
            i += 1
    return "^" + "".join(out) + "$"


def _parse_ntz(v: Column, pattern: str) -> Column:
    """Wall-clock parse independent of the session time zone. ``try_to_timestamp``
    only decides validity (it never raises); the value comes from
    ``to_timestamp_ntz``, which is evaluated only for valid rows, so ANSI mode never
    sees an unparsable value and no DST gap can shift the result."""
    fmt = F.lit(pattern)
    return F.when(v.rlike(shape_regex(pattern)) & F.try_to_timestamp(v, fmt).isNotNull(),
                  F.to_timestamp_ntz(v, fmt))


def _first_match(v: Column, patterns) -> Column:
    return F.coalesce(*[_parse_ntz(v, p) for p in patterns])


def parse_date(c, formats: list[str] | None = None) -> Column:
    """Trimmed string parsed by the first format that matches; else null."""
    pats = ([s for _, s in PARSE_DATE_FORMATS] if formats is None
            else [strptime_to_spark(f) for f in formats])
    v = strip_ws(col(c))
    return F.when(col(c).isNull() | (col(c) == ""), F.lit(None).cast("timestamp_ntz")).otherwise(
        _first_match(v, pats))


def to_datetime(c) -> Column:
    """First of five formats (month-first before day-first), no trimming;
    no match -> null (the caller keeps the original text, see T10)."""
    return _first_match(col(c), [s for _, s in CONVERT_DATETIME_FORMATS])


_TIME_TOKENS = {"HH": ("hour", 2), "mm": ("minute", 2), "ss": ("second", 2), "SSSSSS": ("micros", 6),
                "SSS": ("millis", 3)}


def _time_field(c: Column, name: str) -> Column:
    if name == "hour":
        return F.hour(c)
    if name == "minute":
        return F.minute(c)
    if name == "second":
        return F.second(c)
    frac = F.extract(F.lit("SECOND"), c) - F.second(c)           # decimal fraction of the second
    return (frac * (1_000_000 if name == "micros" else 1_000)).cast("long")


def format_ntz(c, pattern: str) -> Column:
    """Print a TIMESTAMP_NTZ with a Spark datetime pattern without any time-zone
    conversion (``date_format`` goes through the session zone, which moves wall
    times that do not exist there, e.g. midnight on a DST-start day). Date fields
    come from the DATE part, HH/mm/ss/SSS/SSSSSS from the time fields."""
    c = col(c)
    pieces, date_run, i = [], [], 0

    def flush():
        if date_run:
            pieces.append(F.date_format(c.cast("date"), "".join(date_run)))
            date_run.clear()

    while i < len(pattern):
        if pattern[i] == "'":
            j = pattern.index("'", i + 1)
            date_run.append(pattern[i:j + 1])
            i = j + 1
            continue
        tok = next((t for t in ("SSSSSS", "SSS", "HH", "mm", "ss") if pattern.startswith(t, i)), None)
        if tok:
            flush()
            name, width = _TIME_TOKENS[tok]
            pieces.append(F.lpad(_time_field(c, name).cast("string"), width, "0"))
            i += len(tok)
        else:
            date_run.append(pattern[i])
            i += 1
    flush()
    # concat is null when its input is null; apply to a column (or a cheap
    # expression): the input is referenced once per field
    return F.concat(*pieces)
