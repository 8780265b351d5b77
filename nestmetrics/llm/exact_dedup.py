"""Exact dedup by a persistent digest index, bucketed and sorted by digest.

The index is a table on shared storage: one row for each text ever seen, with the SHA-256 of its
text, the document that stays and the number of rows. It is bucketed and sorted by digest, so new
data meets it in a sort-merge anti-join that shuffles the new digests only; texts it does not know are
appended. Texts never move: digests and ids do.

Inside a batch the largest id of equal texts stays; a text that the index knows keeps the id it has.
Groups are summed before any shuffle. Where ids go back to the rows, a digest that holds over one in
thousand of all rows is answered by a broadcast of at most a thousand rows; the others meet in a
shuffle where no key is hot.

Defined cases: a null text is an empty one. Rows that share id and text are one document, and each
is marked alike; a pipeline keeps one of them. A null id loses to every other id; a group of null ids
keeps a null id. An empty table gives an empty result. Extra columns play no part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestmetrics.llm.common import attach, col, digest_of, keep_rows, stored, table, text_of
from nestmetrics.session import scratch_path

ROWS_PER_BUCKET = 2_000_000
INDEX_SCHEMA = "digest BINARY, keep_id BIGINT, rows BIGINT"


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row."""
    return docs.select(col(docs, "doc_id").cast("long").alias("doc_id"), digest_of(text_of(docs)).alias("digest"))


class DigestIndex:
    """The table of known texts at a path, the same for every session that opens it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path = spark, path
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} ({INDEX_SCHEMA}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
            f"INTO {buckets} BUCKETS LOCATION '{path}/buckets={buckets}'"
        )
        self.buckets = buckets

    @classmethod
    def create(cls, spark: SparkSession, path: str, expected_rows: int) -> DigestIndex:
        spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return cls(spark, path, max(spread, -(-expected_rows // ROWS_PER_BUCKET)))

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> DigestIndex:
        """An index that an earlier session left; its folder's name holds the number of buckets."""
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        found = [x.getPath().getName() for x in hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)]
        return cls(spark, path, int(next(x for x in found if x.startswith("buckets=")).split("=")[1]))

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append_new(self, batch: DataFrame) -> None:
        """Add the texts of a batch of (doc_id, digest) that the index does not hold yet."""
        # Stored, so that the anti-join is not moved below the sum, where a hot digest is not one row yet.
        grouped = stored(batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("rows")), "digest-batch")
        known = self.rows().select("digest")
        new = grouped.hint("merge").join(known.hint("merge"), "digest", "left_anti")
        # One file for each bucket and append.
        new.select("digest", "keep_id", "rows").repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.table)


def decide(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and digest of every row, by a new or a given index.

    Without an index, one is made and filled in two batches, larger ids first: what the second batch
    shares with the first is found by the anti-join.
    """
    spark = docs.sparkSession
    rows = stored(digests(docs), "digests")
    total, least, most = rows.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    if index is None:
        index = DigestIndex.create(spark, scratch_path(spark, "digest-index"), total)
        middle = (least + most) // 2 if total and least is not None else 0
        index.append_new(rows.where(F.col("doc_id") > middle))
        index.append_new(rows.where(F.coalesce(F.col("doc_id") <= middle, F.lit(True))))
    else:
        index.append_new(rows)
    sizes = rows.groupBy("digest").agg(F.count("*").alias("rows"))
    groups = index.rows().select("digest", "keep_id").hint("merge").join(sizes, "digest")
    return attach(rows, groups, "digest", "rows", total).select(
        "doc_id", "keep_id", F.col("rows").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents, one row for each text: the one with the largest id."""
    return keep_rows(docs, decide(docs).where("kept"))


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return decide(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP2_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
