"""Exact dedup against a persistent digest index (operator 4).

The index is a Parquet table, bucketed and sorted by digest, with one row for each
distinct text ever accepted. A batch is reduced to one row per digest before it is
shuffled; a sort-merge anti-join against the index (which reads its buckets where they
lie, without a shuffle) leaves the new digests, and these are appended.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bucket_count, kept_rows, written
from tessera.session import scratch_path

#: White space that does not count when texts are compared.
SPACE = r"[\x20\x09-\x0D]"


def digest(text: Column) -> Column:
    """SHA-256 (binary) of a text without its white space; null counts as empty."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")
    return F.unhex(F.sha2(F.encode(bare, "UTF-8"), 256))


class DigestIndex:
    """Digests of all texts accepted so far, at ``path`` (any store that Spark writes).

    ``dedup(batch)`` may be called batch after batch, also from later sessions. A batch
    that failed half-way can simply be given again: digests that did get in are then
    known ones, whose stored keeper is the row that was accepted. ``buckets`` is the number
    of shuffle partitions where none is given; an index keeps the one that it began with.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        buckets = bucket_count(spark, buckets)
        self.spark = spark
        self.path = path or scratch_path(spark, "digest-index")
        self.table = "digest_index_" + hashlib.md5(self.path.encode()).hexdigest()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT, n_chars BIGINT) "
                  f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
                  f"LOCATION '{self.path}'")
        self.buckets = buckets

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def dedup(self, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Decide every row of ``batch`` and append its new digests to the index.

        Returns _id, _row (a number of the row within the batch), digest, keep_id,
        group_size (rows of this batch with that digest) and kept. Of equal texts in a
        batch the row with the most code points stays, then the smallest id (null ids
        last), then any one of rows that are the same in both. If the index already had
        the digest, none stays and keep_id is the stored one. Null texts count as empty,
        and empty texts are one group. An empty batch gives no rows. Other columns are
        never looked at.
        """
        text = F.col(f"`{text_col}`")
        narrow = written(batch.select(
            F.col(f"`{id_col}`").cast("long").alias("_id"), F.monotonically_increasing_id().alias("_row"),
            digest(text).alias("digest"),
            F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_chars")), "digests")
        best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("_id").isNull().alias("none"), "_id", "_row"))
        # written, so that the aggregate comes before the joins: one row per digest leaves a map task, and either side
        # of a join has one
        groups = written(narrow.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")), "groups")
        known = self.rows().select("digest", F.col("keep_id").alias("known_id"))
        met = written(groups.join(known.hint("merge"), "digest", "left_anti").select(
            "digest", F.col("best._id").alias("keep_id"), (-F.col("best.less")).alias("n_chars"),
            F.col("best._row").alias("keep_row"), "group_size"), "new-digests")
        old = groups.join(known.hint("merge"), "digest").select(
            "digest", F.col("known_id").alias("keep_id"), F.lit(-1).cast("long").alias("keep_row"), "group_size")
        old = written(old, "old-digests")      # read before the append
        (met.select("digest", "keep_id", "n_chars").repartition(self.buckets, "digest")
            .write.insertInto(self.table))
        groups = met.select("digest", "keep_id", "keep_row", "group_size").unionByName(old)
        return narrow.join(groups, "digest").select(
            "_id", "_row", "digest", "keep_id", "group_size", (F.col("_row") == F.col("keep_row")).alias("kept"))


def drop_exact_copies(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the index lets in, with the columns of ``docs``.

    One row stays of each new text (see ``DigestIndex.dedup``).
    """
    keep = index.dedup(docs, id_col, text_col).where("kept").select("_id", F.col("digest").alias("_tag"))
    return kept_rows(docs, keep, id_col, digest(F.col(f"`{text_col}`")))
