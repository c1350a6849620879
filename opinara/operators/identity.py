"""Keys, duplicates, newest rows, upserts, unions.

Keep-one operators use ``row_number() <= k``, which Spark cuts to k rows per key
inside every map task before the shuffle, so a key that owns a third of the table
costs no reducer more than k rows per map task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F


def _total_order(df: DataFrame, order: Iterable[Column]) -> list[Column]:
    """The wanted order with a hash of the row behind it, so that no tie is left for the
    shuffle to decide."""
    return [*order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]


def keep_one(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """First row of each key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column],
                   total: bool = False) -> DataFrame:
    """Canonical row of each key: the newest one. ``total`` says the order has no ties."""
    return keep_one(df, keys, order if total else _total_order(df, order))


def dedup(df: DataFrame, keys: list[str], order: Column, keep: str = "last",
          digest: bool = False) -> DataFrame:
    """One row per key, the first or the last by ``order`` (an expression without ties).

    ``digest`` shuffles a SHA-256 of the keys instead of the keys, for long texts.
    """
    direction = order.desc_nulls_last() if keep == "last" else order.asc_nulls_last()
    by = [F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256)] if digest else keys
    return keep_one(df, by, [direction])


def upsert(new: DataFrame, existing: DataFrame, keys: list[str],
           order: list[str] | None = None, batch: str | None = None) -> DataFrame:
    """Existing rows with the new ones on top: per key the last row stays.

    The new batch beats the existing rows; within one batch the highest ``order``
    wins. Columns only one side has are filled with nulls. ``batch`` names a column of
    ``new`` that numbers several batches: the result, which is without it, is that of one
    upsert after the other.
    """
    numbers = [batch] if batch else []
    tagged = existing.withColumn("_batch", F.lit(0)).unionByName(
        new.withColumn("_batch", F.lit(1)), allowMissingColumns=True)
    ranking = [F.col(c).desc_nulls_last() for c in ["_batch", *numbers, *(order or [])]]
    return keep_one(tagged, list(keys), _total_order(tagged.drop(*numbers), ranking)).drop("_batch", *numbers)


def union_sources(frames: dict[str, DataFrame], name: str = "source_type") -> DataFrame:
    """Union by name, each row tagged with the source it came from."""
    tagged = [df.withColumn(name, F.lit(tag)) for tag, df in frames.items()]
    result = tagged[0]
    for frame in tagged[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def distinct_keys(frames: list[tuple[DataFrame, str]], name: str = "key") -> DataFrame:
    """Distinct non-null values over several tables."""
    parts = [df.select(F.col(c).alias(name)).filter(F.col(c).isNotNull()).distinct()
             for df, c in frames]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.distinct()


def enrich_latest(latest: DataFrame, detail: DataFrame, key: str, text: str,
                  prefix: str = "silver") -> DataFrame:
    """Canonical rows with a per-key summary of the detail rows behind them."""
    missing = F.when(F.length(F.coalesce(F.col(text), F.lit(""))) == 0, 1.0).otherwise(0.0)
    summary = detail.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias(f"{prefix}_rows"), F.avg(missing).alias(f"{prefix}_text_missing"))
    return latest.join(summary, key, "left")


# Names an id may have, in order.
ID_CANDIDATES = ["tweet_id", "tweetid", "tweet_id_str", "tweetid_str", "id"]
# What tells a post without an id from others, of these the columns a table has.
FINGERPRINT_COLUMNS = [
    "tweet_text_raw", "clean_text", "tweet_text", "raw_text", "tweet_createdAt", "tweet_event_date", "event_date",
    "tweet_author_userName", "tweet_author_name", "source_file",
]


def fingerprint(cols: Iterable[str]) -> Column:
    """Digest of trimmed fields; null and blank are alike."""
    return F.md5(F.concat_ws("|", *[F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
                                    for c in cols]))


def ensure_id(df: DataFrame, name: str = "tweet_id",
              candidates: Iterable[str] = ID_CANDIDATES,
              fingerprint_cols: Iterable[str] | None = None) -> DataFrame:
    """A non-blank string id for every row.

    The first known id column is used; rows without one, and tables without such a
    column, get a digest of ``fingerprint_cols``, which unlike a row number survives reruns.
    By default these are the known columns of a post, so that a technical column does not
    change its id, or all columns of a table that has none of them.
    """
    lower = {c.lower(): c for c in df.columns}
    native = next((lower[c] for c in candidates if c in lower), None)
    wanted = FINGERPRINT_COLUMNS if fingerprint_cols is None else list(fingerprint_cols)
    cols = [c for c in wanted if c in df.columns] or df.columns
    surrogate = F.concat(F.lit("surrogate_"), fingerprint(cols))
    if native is None:
        return df.withColumns({name: surrogate, f"{name}_origin": F.lit("surrogate_hash")})
    own = F.trim(F.col(native).cast("string"))
    blank = own.isNull() | (own == "")
    result = df.withColumns({
        "_id": F.when(blank, surrogate).otherwise(own),
        f"{name}_origin": F.when(blank, "surrogate_hash").otherwise("native_column"),
    })
    if native != name:
        result = result.drop(native)
    return result.withColumn(name, F.col("_id")).drop("_id")


def duplicate_ids(df: DataFrame, key: Column | str) -> DataFrame:
    """Keys that occur more than once."""
    value = F.col(key) if isinstance(key, str) else key
    return (df.groupBy(value.alias("key")).agg(F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") > 1))


def duplicate_share(df: DataFrame, key: Column | str) -> DataFrame:
    """How many keys repeat and what share of the rows they hold."""
    value = F.col(key) if isinstance(key, str) else key
    counts = df.groupBy(value.alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    repeated = F.col("rows") > 1
    return counts.agg(
        F.count_if(repeated).alias("duplicate_ids"),
        F.coalesce(F.sum(F.when(repeated, F.col("rows"))), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.try_divide(F.sum(F.when(repeated, F.col("rows"))), F.sum("rows")),
                   F.lit(0.0)).cast("double").alias("duplicate_row_share"),
    )


def snapshot_rank(df: DataFrame, key: str, order: list[Column], bucket: Column,
                  newest_first: bool = True, name: str = "snapshot_rank") -> DataFrame:
    """Rank every capture of an id.

    ``bucket`` is a truncated timestamp that rises with the leading order column. Rows
    are ranked inside (id, bucket) and shifted by the number of rows in the id's
    earlier buckets, which is counted map-side, so the history of one hot id is
    spread over as many tasks as it has buckets: choose the grain so that a bucket of
    the hottest id fits a task. Undated rows rank last. Rows without an id are left out.
    """
    # a value instead of null, so that the join below reuses the window's partitioning
    undated = F.lit("0001-01-01" if newest_first else "9999-12-31").cast("timestamp")
    tagged = df.filter(F.col(key).isNotNull()).withColumn("_bucket", F.coalesce(bucket, undated))
    sizes = tagged.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    first = F.col("_bucket").desc() if newest_first else F.col("_bucket").asc()
    before = F.sum("_rows").over(Window.partitionBy(key).orderBy(first)) - F.col("_rows")
    offsets = sizes.select(key, "_bucket", before.alias("_before"))
    inner = Window.partitionBy(key, "_bucket").orderBy(*order)
    ranked = tagged.withColumn("_rn", F.row_number().over(inner))
    joined = ranked.join(offsets, [key, "_bucket"])
    return (joined.withColumn(name, (F.col("_before") + F.col("_rn")).cast("bigint"))
            .select(*df.columns, name))
