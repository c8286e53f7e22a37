"""U11 for many record versions: recursive merge where later versions win.

Every version is flattened to (path, value) leaves (objects are descended into, lists
are leaves: a later list replaces an earlier one whole; an empty object is a leaf of its
own). Merging is associative place by place, so it is done by aggregates with partial
results on the map side and never for a whole id in one task: of each place the newest
value and the newest empty object are kept, and of each place with something below it the
newest version that has anything there. With that

- a value stays if it is newer than every value above it, and no newer version has an
  object in its place;
- an empty object stays if it is newer than the values in its place and above, and nothing
  below it is.

Few places hold both a value and something below them; only these meet the leaves again.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.flatten import flatten_json
from tessera.session import checkpoint_dir

_OBJECT = "{}"


def _same(a: str, b: str, id_cols: list[str], on: str) -> Column:
    ids = [F.col(f"{a}.`{c}`").eqNullSafe(F.col(f"{b}.`{c}`")) for c in id_cols]
    return functools.reduce(lambda x, y: x & y, ids, F.col(f"{a}.{on}") == F.col(f"{b}.{on}"))


def merge_versions(df: DataFrame, id_cols: list[str], json_col: str, order_by: str | list[str],
                   separator: str = ".") -> DataFrame:
    """Rows (id_cols..., path, value) of the merged document of each id. ``order_by``
    names the version columns, the last ones breaking ties; versions equal in all of
    them are ordered by a hash of their text. An empty object has the value ``{}``. A
    version that is no object replaces the document (its path is empty) and is replaced by
    the next object; a document that ends empty has no rows. Keys that hold the separator
    are merged by their own name. Texts that are no JSON count as no version."""
    checkpoint_dir(df.sparkSession)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    ids = [F.col(f"`{c}`") for c in id_cols]
    rows = df.select(*ids, F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(order)],
                                    F.xxhash64(json_col).alias("tie")).alias("_ver"), json_col)
    flat = flatten_json(rows, json_col, [*id_cols, "_ver"], expand_arrays=False, path_parts=True, empty_objects=True, nodes=True)
    value, empty = ~F.col("object"), F.col("object")
    places = flat.groupBy(*ids, "at").agg(
        F.first("path").alias("_path"), F.first("above").alias("_above"),
        F.max(F.when(value, F.col("_ver"))).alias("_value_ver"),
        F.max_by("value", F.when(value, F.col("_ver"))).alias("_value"),
        F.max(F.when(empty, F.col("_ver"))).alias("_empty_ver")).checkpoint()
    newest = F.greatest("_value_ver", "_empty_ver")
    below = places.select(*ids, F.explode("_above").alias("at"), newest.alias("_below"))
    both = (below.withColumn("_value_ver", F.lit(None).cast(places.schema["_value_ver"].dataType))
            .unionByName(places.select(*ids, "at", F.lit(None).cast(places.schema["_value_ver"].dataType).alias("_below"), newest.alias("_value_ver")))
            .groupBy(*ids, "at").agg(F.max("_below").alias("_below"), F.max("_value_ver").alias("_own")))
    # places that are a leaf of some version and have leaves below them in others
    torn = both.where("_below IS NOT NULL AND _own IS NOT NULL").drop("_own").checkpoint()
    met = places.alias("p").join(torn.alias("t"), _same("p", "t", id_cols, "at"), "left").select("p.*", "t._below")
    cuts = met.where("_below IS NOT NULL AND _value_ver IS NOT NULL").select(*ids, "at", F.col("_value_ver").alias("_cut"))
    reached = places.select(*ids, F.col("at").alias("_leaf"), F.explode("_above").alias("at"))
    cut = (reached.alias("r").join(cuts.alias("c"), _same("r", "c", id_cols, "at"))
           .groupBy(*[F.col(f"r.`{c}`") for c in id_cols], F.col("r._leaf").alias("at")).agg(F.max("c._cut").alias("_cut")))
    out = met.alias("m").join(cut.alias("c"), _same("m", "c", id_cols, "at"), "left").select("m.*", "c._cut")
    after = lambda a, b: F.col(b).isNull() | (F.col(a) > F.col(b))
    stays = F.col("_value_ver").isNotNull() & after("_value_ver", "_cut") & after("_value_ver", "_below") & after("_value_ver", "_empty_ver")
    bare = (F.col("_empty_ver").isNotNull() & (F.size("_path") > 0) & after("_empty_ver", "_value_ver") & after("_empty_ver", "_cut")
            & (F.col("_below").isNull() | (F.col("_below") < F.greatest("_value_ver", "_cut"))))
    return out.where(F.coalesce(stays, F.lit(False)) | F.coalesce(bare, F.lit(False))).select(
        *ids, F.array_join("_path", separator).alias("path"),
        F.when(F.coalesce(stays, F.lit(False)), F.col("_value")).otherwise(F.lit(_OBJECT)).alias("value"))
