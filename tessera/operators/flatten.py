"""U13 flatten: nested JSON -> one row per leaf with a dotted path (list positions as
path parts, empty containers vanish).

One pass: each row is parsed once in its task and its leaves are walked with a stack of
their own, so the work of a row depends on that row alone, however deep another one is.
Any JSON text gives leaves: numbers keep the text that they are written with (2.50, 1e400),
and escaped halves of a surrogate pair that stand alone, which no UTF-8 can hold, become
U+FFFD in values and paths.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# rows of one batch are turned into leaves this many at a time
_ROWS = 256


_LONE = re.compile("[\ud800-\udfff]")


class Number(str):
    """A JSON number as it is written."""


def _no_constant(name: str):
    raise ValueError(name)          # NaN and Infinity are not JSON


def whole(text: str) -> str:
    """``text`` with U+FFFD for surrogates that stand alone."""
    return text if text.isascii() else _LONE.sub("\ufffd", text)


def parse(text: str | None):
    """(value, True), or (None, False) for null and for what is no JSON text. A text
    nested deeper than the parser goes (some thousand levels) counts as no JSON."""
    if text is None:
        return None, False
    try:
        return json.loads(text, parse_constant=_no_constant, parse_float=Number, parse_int=Number), True
    except (ValueError, RecursionError):
        return None, False


def as_text(v) -> str | None:
    """A leaf's text: strings as they are, null as null, everything else as JSON."""
    if v is None:
        return None
    if isinstance(v, str):
        return whole(v)
    out, stack = [], [v]
    while stack:                    # a stack of its own: lists may be nested deep
        x = stack.pop()
        if isinstance(x, Number):
            out.append(x)
        elif isinstance(x, list):
            stack.append(Number("]"))
            for i in range(len(x) - 1, -1, -1):
                stack += [x[i], Number(",")] if i else [x[i]]
            out.append("[")
        elif isinstance(x, dict):
            stack.append(Number("}"))
            for i, (k, y) in reversed(list(enumerate(x.items()))):
                stack += [y, Number(("," if i else "") + json.dumps(k, ensure_ascii=False) + ":")]
            out.append("{")
        else:
            out.append(json.dumps(x, ensure_ascii=False))
    return whole("".join(out))


def node(parent: bytes, key: str) -> bytes:
    """A name of 128 bits for the place below ``parent`` that ``key`` leads to."""
    return hashlib.blake2b(key.encode(), key=parent, digest_size=16).digest()


def leaves(doc, expand_arrays: bool = True, max_depth: int | None = None,
           empty_objects: bool = False) -> Iterator[tuple[list[str], object]]:
    """(path, value) of every leaf in document order. Containers at ``max_depth`` are
    leaves; empty ones vanish, unless ``empty_objects`` keeps ``{}``."""
    stack: list[tuple[list[str], object]] = [([], doc)]
    while stack:
        path, v = stack.pop()
        opened = max_depth is None or len(path) < max_depth
        if isinstance(v, dict) and opened and (v or not empty_objects):
            stack.extend(([*path, whole(k)], x) for k, x in reversed(v.items()))
        elif isinstance(v, list) and opened and expand_arrays:
            stack.extend(([*path, str(i)], v[i]) for i in range(len(v) - 1, -1, -1))
        else:
            yield path, v


def flatten_json(df: DataFrame, json_col: str | Column, id_cols: list[str],
                 separator: str = ".", max_depth: int | None = None,
                 expand_arrays: bool = True, path_parts: bool = False,
                 empty_objects: bool = False, nodes: bool = False) -> DataFrame:
    """Rows (id_cols..., path, value STRING). Leaf values: strings unquoted, other
    scalars as JSON text, JSON null as null; a scalar at the root has the empty path.
    Rows whose text is no JSON give none. ``path_parts`` returns the path as an array
    (keys that hold the separator stay apart). ``empty_objects`` keeps empty objects as
    leaves and adds the column ``object``, true for them alone; ``nodes`` adds ``above``, the
    names (128 bits) of the root and of the places between it and the leaf, and ``at``,
    the leaf's own."""
    src = F.col(json_col) if isinstance(json_col, str) else json_col
    base = df.select(*id_cols, src.alias("_json"))
    ids = base.schema.fields[:-1]
    kind = T.ArrayType(T.StringType()) if path_parts else T.StringType()
    schema = T.StructType([*ids, T.StructField("path", kind), T.StructField("value", T.StringType())])
    if empty_objects:
        schema = schema.add("object", T.BooleanType())
    if nodes:
        schema = schema.add("above", T.ArrayType(T.BinaryType())).add("at", T.BinaryType())
    arrow = pa.list_(pa.string()) if path_parts else pa.string()

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                at, paths, values, objects, above, own = [], [], [], [], [], []
                for i, text in enumerate(part.column("_json").to_pylist()):
                    doc, ok = parse(text)
                    if ok:
                        for path, v in leaves(doc, expand_arrays, max_depth, empty_objects):
                            at.append(i)
                            paths.append(path if path_parts else separator.join(path))
                            values.append(as_text(v))
                            objects.append(isinstance(v, dict))
                            if nodes:
                                line = [b""]
                                for key in path:
                                    line.append(node(line[-1], key))
                                above.append(line[:-1])
                                own.append(line[-1])
                rows = part.select(range(len(ids))).take(pa.array(at, pa.int32()))
                found = [*rows.columns, pa.array(paths, arrow), pa.array(values, pa.string())]
                if empty_objects:
                    found.append(pa.array(objects, pa.bool_()))
                if nodes:
                    found += [pa.array(above, pa.list_(pa.binary())), pa.array(own, pa.binary())]
                yield pa.RecordBatch.from_arrays(found, names=schema.names)

    return base.mapInArrow(run, schema)


def flatten_struct(df: DataFrame, separator: str = ".") -> DataFrame:
    """U13 for typed struct columns: nested fields become top-level columns named
    by their dotted path (schema walk on the driver, one projection)."""
    out = []

    def walk(c: Column, dtype, path: str):
        if isinstance(dtype, T.StructType) and dtype.fields:
            for f in dtype.fields:
                walk(c.getField(f.name), f.dataType, f"{path}{separator}{f.name}")
        elif not (isinstance(dtype, T.StructType) and not dtype.fields):
            out.append(c.alias(path))

    for f in df.schema.fields:
        walk(F.col(f"`{f.name}`"), f.dataType, f.name)
    return df.select(*out)
