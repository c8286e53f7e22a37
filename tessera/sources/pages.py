"""Stored pages as the page source (fetching itself is not built: the
``pages`` table stands in for fetched responses)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def split_fetched(pages: DataFrame, html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """(pages with content, failed fetches: rows whose content is null)."""
    return pages.filter(F.col(html_col).isNotNull()), pages.filter(F.col(html_col).isNull())
