"""U4 generate_hash and row fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions._util import col


def generate_hash(c, algorithm: str = "md5") -> Column:
    """U4: hex digest of the UTF-8 text; struct/map/array values are hashed as JSON."""
    v = col(c)
    if algorithm == "md5":
        return F.md5(v)
    if algorithm == "sha1":
        return F.sha1(v)
    if algorithm == "sha256":
        return F.sha2(v, 256)
    raise ValueError(f"Unsupported hash algorithm: {algorithm}")


def record_hash(df: DataFrame, columns: list[str] | None = None, algorithm: str = "md5") -> Column:
    """Hash of a record: its JSON with sorted keys as ``json.dumps(item, sort_keys=True,
    ensure_ascii=False)`` writes it, nulls included."""
    from tessera.sources._json import py_json
    names = sorted(columns or df.columns)
    kind = T.StructType([df.schema[n] for n in names])
    return generate_hash(py_json(F.struct(*[F.col(f"`{n}`") for n in names]), kind), algorithm)
