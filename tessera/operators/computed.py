"""Named computed-column builders (T11a-T11l). Each takes the column names it reads
and returns a Column; an absent input column behaves like the reference's
``item.get(name, default)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import initials, word_count
from tessera.functions.web import extract_domain, url_part


def _get(df: DataFrame | None, name, default) -> Column:
    if isinstance(name, Column):
        return name
    if df is not None and name not in df.columns:
        return F.lit(default)
    return F.col(f"`{name}`")


def text_length(text="text", df=None) -> Column:            # T11a
    return F.length(_get(df, text, "")).cast("long")


def author_initials(author="author", df=None) -> Column:    # T11b
    return initials(_get(df, author, ""))


def tag_count(tags="tags", df=None) -> Column:               # T11c
    c = _get(df, tags, [])
    if df is not None and isinstance(tags, str) and tags not in df.columns:
        return F.lit(0).cast("long")
    return F.when(c.isNull(), F.lit(None)).otherwise(F.size(c)).cast("long")


def upper_text(text="text", df=None) -> Column:              # T11d
    return F.upper(_get(df, text, ""))


def text_word_count(text="text", df=None) -> Column:        # T11e
    return word_count(_get(df, text, "")).cast("long")


def times_two(value="age", df=None) -> Column:               # T11f
    # failure (overflow) -> null, as for every computed column
    return F.try_multiply(_get(df, value, 0), F.lit(2))


def price_clean(price="price", df=None) -> Column:           # T11g
    from tessera.functions.convert import to_float
    return to_float(F.regexp_replace(_get(df, price, "0"), "[$,]", ""))


def url_category(url="url", df=None) -> Column:              # T11h
    return url_part(_get(df, url, ""), 2, "unknown")


def processed_at() -> Column:                                # T11i
    return F.current_timestamp()


def text_hash(text="text", df=None) -> Column:               # T11j
    return F.md5(_get(df, text, ""))


def keyword_category(text="text", keyword="urgent", df=None) -> Column:  # T11k
    return F.when(F.contains(F.lower(_get(df, text, "")), F.lit(keyword)),
                  F.lit("important")).otherwise(F.lit("normal"))


def domain(url="url", df=None) -> Column:                    # T11l
    return extract_domain(_get(df, url, ""))


BUILDERS = {
    "text_length": text_length,
    "author_initials": author_initials,
    "tag_count": tag_count,
    "upper_text": upper_text,
    "word_count": text_word_count,
    "times_two": times_two,
    "price_clean": price_clean,
    "url_category": url_category,
    "processed_at": processed_at,
    "text_hash": text_hash,
    "keyword_category": keyword_category,
    "domain": domain,
}
