"""CSV sink and source."""

from __future__ import annotations

import functools
import hashlib
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.convert import py_double
from tessera.sources._json import py_json


def csv_cell(c: Column, dtype: T.DataType) -> Column:
    """S1 cell text: null -> '' (via nullValue), lists/dicts as Python-style JSON,
    booleans as True/False, everything else its string form."""
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return py_json(c, dtype)
    if isinstance(dtype, T.BooleanType):
        return F.when(c.isNull(), F.lit(None).cast("string")).when(c, "True").otherwise("False")
    if isinstance(dtype, T.DoubleType):
        return py_double(c)
    return c.cast("string")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def csv_folders(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(folder, cells hold line breaks) of ``path`` and its sub-folders (hidden from plain
    reads by their underscore): files with other columns, and whole batches with line breaks."""
    fs, p = _fs(spark, path)
    if not fs.exists(p) or fs.getFileStatus(p).isFile():
        return [(path, False)]
    here = fs.listStatus(p)
    names = [x.getPath().getName() for x in here if x.isDirectory()]
    done = [n for n in names if n.startswith("_lines-") and fs.exists(_fs(spark, f"{path}/{n}/_done")[1])]
    more = [(n, False) for n in sorted(names) if n.startswith("_columns-")] + [(n, True) for n in sorted(done)]
    plain = any(x.isFile() and not x.getPath().getName().startswith(("_", ".")) for x in here)
    own = [(path, False)] if plain or not more else []
    return own + [(f"{path.rstrip('/')}/{n}", lines) for n, lines in more]


def _reader(spark: SparkSession, delimiter: str, encoding: str, multiline: bool):
    # enforceSchema off: a file whose header differs from the first one's fails the read
    r = (spark.read.option("header", "true").option("sep", delimiter).option("multiLine", str(multiline).lower())
         .option("quote", '"').option("escape", '"').option("encoding", encoding)
         .option("inferSchema", "false").option("emptyValue", "").option("enforceSchema", "false"))
    # a break within a cell must not be taken for the file's own line end
    return r.option("lineSep", "\n") if multiline else r


def write_csv(df: DataFrame, path: str, *, delimiter: str = ",", quote_all: bool = True,
              encoding: str = "utf-8", header: bool = True, mode: str = "overwrite") -> str:
    """Columns in sorted order, every cell text, quote character doubled.
    ``mode`` 'append' adds files; files with other columns than the first ones go to a
    sub-folder for those columns, so that every folder has one header (D16).

    Whether any cell holds a line break is seen while the rows are written. Such a batch
    stays in a folder of its own, which ``read_csv`` reads as records that span lines; all
    other files can be split by lines when they are read."""
    spark = df.sparkSession
    fs, p = _fs(spark, path)
    if fs.exists(p) and mode in ("error", "errorifexists", "ignore"):
        if mode == "ignore":
            return path
        raise FileExistsError(path)
    if mode == "overwrite" and fs.exists(p) and fs.getFileStatus(p).isFile():
        fs.delete(p, False)
    cols = sorted(df.columns)
    out = df.select(*[csv_cell(F.col(f"`{c}`"), df.schema[c].dataType).alias(c) for c in cols])
    to = path.rstrip("/")
    if mode == "append" and header and fs.exists(p) and any(
            x.isFile() and not x.getPath().getName().startswith(("_", ".")) for x in fs.listStatus(p)):
        if _reader(spark, delimiter, encoding, False).csv(path).columns != cols:
            to = f"{to}/_columns-{hashlib.md5(repr(cols).encode()).hexdigest()[:12]}"
    batch = uuid.uuid4().hex
    own = f"{path.rstrip('/')}/_lines-{batch}"
    seen = Observation(f"csv_{batch}")
    broken = functools.reduce(lambda a, b: a | b, [F.col(f"`{c}`").rlike("[\r\n]") for c in cols], F.lit(False))
    (out.observe(seen, F.max(F.coalesce(broken, F.lit(False)).cast("int")).alias("breaks")).write
        .option("header", str(header).lower()).option("sep", delimiter).option("lineSep", "\n")
        .option("quoteAll", str(quote_all).lower()).option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        .option("emptyValue", "").option("nullValue", "").option("encoding", encoding)
        .csv(own))
    staged = _fs(spark, own)[1]
    if mode == "overwrite":                 # what was there goes once the new rows are written, be they read from it
        for x in fs.listStatus(p):
            if x.getPath().getName() != staged.getName():
                fs.delete(x.getPath(), True)
    if seen.get.get("breaks") or any(set(c) & set("\r\n") for c in cols):
        fs.create(_fs(spark, f"{own}/_done")[1]).close()
        return path
    fs.mkdirs(_fs(spark, to)[1])
    for x in fs.listStatus(staged):
        if x.getPath().getName().startswith("part-"):
            fs.rename(x.getPath(), _fs(spark, f"{to}/{x.getPath().getName()}")[1])
    fs.create(_fs(spark, f"{to}/_SUCCESS")[1], True).close()
    fs.delete(staged, True)
    return path


def read_csv(spark: SparkSession, path: str, *, delimiter: str = ",", encoding: str = "utf-8",
             limit: int | None = None, revive_json: bool = False, multiline: bool = False) -> DataFrame:
    """S3: every column a string; empty cells (written for nulls) read back as ''.
    Files of other columns appended by ``write_csv`` are read by their own header and
    stacked by name (null where a file lacks the column); foreign files that disagree
    with the first header fail the read instead of shifting. Batches that ``write_csv``
    found to hold line breaks are read as such, a file at a time; ``multiline`` says so of
    foreign files. With ``revive_json`` cells starting with '{' or '[' become VARIANT
    values when they parse (``try_parse_json``), the other cells VARIANT strings."""
    df = None
    for folder, lines in csv_folders(spark, path):
        part = _reader(spark, delimiter, encoding, multiline or lines).csv(folder)
        # CSV keeps no null: an empty cell reads back as '' (as the reference does)
        part = part.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in part.columns])
        df = part if df is None else df.unionByName(part, allowMissingColumns=True)
    if revive_json:
        def revive(c):
            starts = c.startswith("{") | c.startswith("[")
            as_text = F.to_json(F.array(c))
            as_text = as_text.substr(F.lit(2), F.length(as_text) - 2)
            return F.coalesce(F.when(starts, F.try_parse_json(c)), F.try_parse_json(as_text))
        df = df.select(*[revive(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return df.limit(limit) if limit else df


def count_csv(spark: SparkSession, path: str, **how) -> int:
    """S4 (D17): number of records, not physical lines (``how`` as for ``read_csv``)."""
    return read_csv(spark, path, **how).count()
