"""Exact deduplication against a persistent digest index (operator 4).

The index is a Parquet table bucketed and sorted by digest, one row per distinct text ever
accepted. A batch is reduced to one row per digest before it is shuffled, joined by
sort-merge anti-join to the index, which is not shuffled, and what is new is appended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opinara.session import cut_lineage, scratch_path

#: Characters that do not count: space, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\f\r"
INDEX_COLUMNS = "digest STRING, keep_id BIGINT, chars BIGINT, rows BIGINT"


def text_digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the text without blanks."""
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return F.sha2(text, 256)


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, digest, chars)`` per row; null text counts as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       text_digest(text).alias("digest"),
                       F.char_length(text).cast("bigint").alias("chars"))


class DigestIndex:
    """A persistent index at ``location``, which all executors reach.

    Opened again in another session, the table is declared over the files that are there;
    ``buckets`` must be the number it was made with.
    """

    def __init__(self, spark: SparkSession, location: str, buckets: int = 256):
        self.spark, self.location, self.buckets = spark, location, buckets
        self.table = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, location).hex}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({INDEX_COLUMNS}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
                  f"LOCATION '{location}'")

    def known(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, rows: DataFrame) -> None:
        """Append the digests of ``rows`` that the index lacks, with the row that stays.

        Of rows with one digest the longest original text stays, then the smallest id. A
        digest the index has keeps its entry. A repeated call adds nothing.
        """
        # one number orders by length, then by id downwards: the aggregation stays a hash one
        rank = (F.col("chars").cast("decimal(19,0)") * F.lit("10000000000000000000").cast("decimal(20,0)")
                - F.coalesce("doc_id", F.lit(2**63 - 1)).cast("decimal(19,0)"))
        # written first: the optimizer would move the anti-join below the aggregation and
        # shuffle every row of a hot digest
        batch = cut_lineage(rows.groupBy("digest").agg(
            F.max_by("doc_id", rank).alias("keep_id"), F.max("chars").alias("chars"),
            F.count(F.lit(1)).alias("rows")))
        fresh = batch.join(self.known().hint("merge"), "digest", "left_anti")
        (fresh.select("digest", "keep_id", "chars", "rows").repartition(self.buckets, "digest")
         .write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
         .option("path", self.location).saveAsTable(self.table))

    def entries(self) -> DataFrame:
        """The entries by file, without the bucketing: a join may then split a hot digest."""
        self.spark.catalog.refreshTable(self.table)
        return self.spark.read.schema(INDEX_COLUMNS).parquet(self.location)


def dedup_against(index: DigestIndex, docs: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Enter ``docs`` in the index and tell for each row what became of it.

    Returns one row per row of ``docs``: ``doc_id, keep_id`` (id of the row that stays, from
    an earlier batch if the text was known), ``group_size`` (rows of the batch that first had
    the text), ``kept`` (the row's id is the one that stays) and ``text_sha256``.

    Null text counts as empty, so null, empty and blank texts are one group. A null id
    stays only where its group has no other of that length. Repeated rows are counted and
    share their flag. Other columns are ignored whatever their names. No rows, no result,
    and the index stays as it was.
    """
    rows = cut_lineage(digest_rows(docs, id_col, text_col))  # the texts are read once
    index.add(rows)
    known = index.entries().select("digest", "keep_id", F.col("rows").alias("group_size"))
    return rows.join(known.hint("merge"), "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``dedup_against`` an empty index of its own: the duplicates inside ``docs``."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = DigestIndex(spark, scratch_path(spark, "digests"), buckets)
    return dedup_against(index, docs, id_col, text_col)
