"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by the SHA-256 of the text. A batch of
documents is reduced to one row per digest first (map-side combined, so any
number of copies is one row per task), then a sort-merge anti-join against the
index finds the digests not seen before and appends them. The index side needs
no shuffle: its buckets are the partitions of the join.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import doc_texts, shared_path, stored


@dataclass(frozen=True)
class DigestIndex:
    """A digest index: a table over files in a folder that all executors share."""
    spark: SparkSession
    name: str

    @staticmethod
    def open(spark: SparkSession, path: str | None = None, buckets: int = 64) -> DigestIndex:
        """The index kept under ``path``; an empty one where nothing is there yet."""
        name = f"digest_index_{uuid.uuid4().hex}"
        path = path or shared_path(spark, "digests")
        spark.sql(f"""CREATE TABLE {name} (text_sha256 STRING, keep_id BIGINT) USING parquet
                      CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {buckets} BUCKETS
                      LOCATION '{path}'""")
        return DigestIndex(spark, name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def ingest(self, docs: DataFrame) -> DataFrame:
        """One row per document of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

        A text that the index already holds keeps its earlier row, so all its
        new copies go. Of equal new texts the largest doc_id stays. group_size
        counts the rows of this batch with that text.

        Null text counts as empty. A null doc_id loses to any other; where all
        copies have none, keep_id is null and they stay. Rows that repeat a
        doc_id and its text stay or go together. An empty batch gives no rows
        and leaves the index as it is. Other columns are not looked at.
        """
        digests = stored(doc_texts(docs).select(
            F.col("doc_id").cast("bigint").alias("doc_id"), F.sha2("text", 256).alias("text_sha256")), "digests")
        groups = stored(digests.groupBy("text_sha256").agg(
            F.max("doc_id").alias("batch_keep"), F.count("*").alias("group_size")), "groups")
        fresh = groups.hint("merge").join(self.rows().hint("merge"), "text_sha256", "left_anti")
        fresh.select("text_sha256", F.col("batch_keep").alias("keep_id")).write.insertInto(self.name)
        known = groups.hint("merge").join(self.rows().hint("merge"), "text_sha256")
        decided = stored(known.select("text_sha256", "keep_id", "group_size"), "decided")
        return digests.join(decided, "text_sha256").select(
            "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            "text_sha256")


def find_copies(docs: DataFrame, buckets: int = 64) -> DataFrame:
    """``docs`` as one batch against a new index."""
    index = DigestIndex.open(docs.sparkSession, buckets=buckets)
    return index.ingest(docs)


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents without copies, all their columns."""
    gone = find_copies(docs).where(~F.col("kept")).select(
        F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_text"))
    digest = F.sha2(F.coalesce(docs["text"].cast("string"), F.lit("")), 256)
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"]) & (digest == gone["gone_text"]), "left_anti")
