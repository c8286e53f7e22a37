"""tessera: record cleaning, transformation and extraction as Spark DataFrame operators.

Every operator is a plain function over DataFrames (or a Column -> Column builder),
expressed with Catalyst expressions so that it plans, prunes and scales like any
other Spark query. Python workers are used only for HTML parsing,
JSON walking and ASCII escaping of JSON lines.

Common entry points::

    from tessera import get_spark, extract_items, clean, transform, run_target
"""

from tessera.operators.clean import clean
from tessera.operators.dedupe import dedupe_first
from tessera.operators.extract import extract_items, extract_targets, next_links, pagination_walk
from tessera.operators.transform import transform
from tessera.operators.validate import validate
from tessera.plans.runner import plan_only, run_all_targets, run_target
from tessera.session import get_spark, scratch_path

__all__ = ["clean", "dedupe_first", "extract_items", "extract_targets", "get_spark",
           "next_links", "pagination_walk", "plan_only", "run_all_targets", "run_target",
           "scratch_path", "transform", "validate"]
