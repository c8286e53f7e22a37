"""JSON Lines sink and source."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.dates import format_ntz

_NON_ASCII = re.compile(r"[^\x00-\x7f]")


def _escape_char(m) -> str:
    units = m.group(0).encode("utf-16-be")
    return "".join("\\u%02x%02x" % (units[i], units[i + 1]) for i in range(0, len(units), 2))


@F.pandas_udf(T.StringType())
def _ascii_json(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else _NON_ASCII.sub(_escape_char, x))


def _iso(c: Column, ntz: bool = True) -> Column:
    """``datetime.isoformat()``: microseconds only when non-zero. Naive timestamps
    are printed without any time-zone conversion."""
    if ntz:
        whole = format_ntz(c, "yyyy-MM-dd'T'HH:mm:ss")
        frac = format_ntz(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        micro = format_ntz(c, "SSSSSS")
    else:
        whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        frac = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        micro = F.date_format(c, "SSSSSS")
    return F.when(micro == "000000", whole).otherwise(frac)


def _prepare(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = _iso(c, ntz=isinstance(f.dataType, T.TimestampNTZType))
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_jsonl(df: DataFrame, path: str, *, ensure_ascii: bool = False, mode: str = "overwrite",
                compression: str | None = None) -> str:
    """One compact object per line, explicit nulls kept, datetimes ISO text.
    ``ensure_ascii`` escapes every non-ASCII character as \\uXXXX (surrogate pairs
    above U+FFFF), done on Arrow batches."""
    out = _prepare(df)
    if ensure_ascii:
        line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in out.columns]),
                         {"ignoreNullFields": "false"})
        w = out.select(_ascii_json(line).alias("value")).write.mode(mode)
        if compression:
            w = w.option("compression", compression)
        w.text(path)
        return path
    w = out.write.mode(mode).option("ignoreNullFields", "false")
    if compression:
        w = w.option("compression", compression)
    w.json(path)
    return path


def read_jsonl(spark: SparkSession, path: str, schema=None, *, limit: int | None = None) -> DataFrame:
    """Blank lines skipped, malformed lines dropped. Without a schema the whole
    object is read as one VARIANT column ``value`` (bad line -> null, filtered)."""
    if schema is None:
        df = spark.read.option("singleVariantColumn", "value").json(path)
        df = df.filter(F.col("value").isNotNull())
    else:
        df = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return df.limit(limit) if limit else df


def read_jsonl_with_rejects(spark: SparkSession, path: str, schema) -> tuple[DataFrame, DataFrame]:
    """S7 with the warning count: (parsed rows, malformed lines). Lines are read as
    text (blank ones skipped) and parsed with ``from_json``; a malformed line keeps
    its raw text in ``_corrupt_record``."""
    full = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
    lines = spark.read.text(path).filter(F.trim(F.col("value")) != "")
    parsed = lines.select(F.from_json("value", full, {"mode": "PERMISSIVE",
                                                      "columnNameOfCorruptRecord": "_corrupt_record"}).alias("d"))
    good = parsed.filter(F.col("d._corrupt_record").isNull()).select(
        *[F.col("d").getField(f.name).alias(f.name) for f in schema.fields])
    bad = parsed.filter(F.col("d._corrupt_record").isNotNull()).select(F.col("d._corrupt_record").alias("line"))
    return good, bad


def count_jsonl(spark: SparkSession, path: str) -> int:
    """Non-blank lines (malformed ones included)."""
    return spark.read.text(path).filter(F.trim(F.col("value")) != "").count()
