"""String builders: C7 clean_string, C10 to_text, U1 clean_text, U7 safe_filename,
U10 slugify and the word helpers used by computed columns (T11b, T11e).

All patterns are written with explicit character classes so that Java (Spark) and RE2
(the DuckDB oracle) read them the same way; ``\\s`` differs between the two.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._util import col

# The characters Python's str.strip()/str.split()/re "\s" treat as
# whitespace (str.isspace), written as a regex class body:
# TAB LF VT FF CR, FS GS RS US, SPACE, NEL, NBSP, OGHAM SPACE MARK, EN QUAD..HAIR SPACE,
# LINE SEPARATOR, PARAGRAPH SEPARATOR, NARROW NBSP, MEDIUM MATH SPACE, IDEOGRAPHIC SPACE.
WS = (r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# The same set as a plain character list (for btrim/translate, which are much
# cheaper than a regular expression over long texts).
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
            "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
            "\u2028\u2029\u202f\u205f\u3000")
# Control characters removed by string cleaning: below 0x20 except TAB and LF.
CONTROL = r"[\x{00}-\x{08}\x{0B}-\x{1F}]"
CONTROL_CHARS = "".join(chr(i) for i in range(0x20) if chr(i) not in "\t\n")


def _to_spaces(c) -> Column:
    """Every whitespace character -> ' ' (one code point each, no regex)."""
    return F.translate(col(c), WS_CHARS, " " * len(WS_CHARS))


def strip_ws(c) -> Column:
    """Python ``str.strip()``: leading and trailing Unicode whitespace."""
    return F.btrim(col(c), F.lit(WS_CHARS))


def collapse_ws(c) -> Column:
    """``re.sub(r'\\s+', ' ', text)``: every whitespace run -> one space."""
    return F.regexp_replace(_to_spaces(c), " {2,}", " ")


def split_ws(c) -> Column:
    """Python ``str.split()`` with no argument: array of non-empty tokens."""
    return F.filter(F.split(_to_spaces(c), " +"), lambda x: x != "")


def clean_string(c) -> Column:
    """Strip, runs of 2+ spaces to one (tabs untouched), drop control chars
    except LF and TAB (0x7F stays). No second strip. Null stays null."""
    s = strip_ws(c)
    s = F.regexp_replace(s, " {2,}", " ")
    return F.translate(s, CONTROL_CHARS, "")


def to_text(c) -> Column:
    """Null -> '' and anything else to its string form."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def clean_text(c) -> Column:
    """Null -> '', strip, every whitespace run -> one space, drop control
    characters, straighten curly double and single quotes."""
    s = collapse_ws(strip_ws(to_text(c)))
    s = F.translate(s, CONTROL_CHARS, "")
    # Curly quotes U+201C U+201D U+2018 U+2019 -> ASCII " " ' '
    return F.translate(s, "“”‘’", "\"\"''")


def _with(c: Column, body) -> Column:
    """``body`` over a value that is computed once (copied into an expression it would
    be computed wherever it is named)."""
    return F.element_at(F.transform(F.array(c), body), 1)


def slugify(c) -> Column:
    """Lower, strip, drop characters that are not word/space/hyphen, runs of
    hyphens or whitespace -> '-', trim hyphens, empty -> 'untitled'."""
    s = strip_ws(F.lower(col(c)))
    s = F.regexp_replace(s, rf"[^\p{{L}}\p{{N}}_{WS}-]+", "")
    s = F.regexp_replace(F.translate(s, WS_CHARS, "-" * len(WS_CHARS)), "-{2,}", "-")
    return _with(F.btrim(s, F.lit("-")), lambda x: F.when(x == "", F.lit("untitled")).otherwise(x))


def safe_filename(c) -> Column:
    """Unsafe characters -> '_', drop C0/DEL/C1 controls, cap at 255 characters
    keeping the extension, strip spaces and dots, empty -> 'unnamed'."""
    s = F.regexp_replace(col(c), r'[<>:"/\\|?*]', "_")
    s = F.regexp_replace(s, r"[\x{00}-\x{1F}\x{7F}-\x{9F}]", "")

    # Python slicing name[:k] with a negative k drops |k| characters from the end
    ext = lambda x: F.regexp_extract(x, r"(?s)^.+(\.[^.]+)$", 1)
    stem = lambda x, e: x.substr(F.lit(1), F.length(x) - F.length(e))
    keep = lambda st, e: F.when(F.length(e) <= 255, F.least(F.lit(255) - F.length(e), F.length(st))).otherwise(
        F.greatest(F.length(st) + 255 - F.length(e), F.lit(0)))
    cut = lambda x, e: F.concat(stem(x, e).substr(F.lit(1), keep(stem(x, e), e)), e)
    s = _with(s, lambda x: F.when(F.length(x) > 255, _with(ext(x), lambda e: cut(x, e))).otherwise(x))
    return _with(F.btrim(s, F.lit(" .")), lambda x: F.when(x == "", F.lit("unnamed")).otherwise(x))


def initials(c) -> Column:
    """First character of each whitespace-separated word, upper-cased, joined."""
    return F.array_join(F.transform(split_ws(c), lambda x: F.upper(F.substring(x, 1, 1))), "")


def word_count(c) -> Column:
    """T11e: ``len(text.split())``: runs of non-whitespace, counted in one pass over
    the text with whitespace already mapped to spaces."""
    return F.regexp_count(_to_spaces(c), F.lit("[^ ]+"))
