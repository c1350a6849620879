"""Incremental jobs. Each runs over the files not seen before and stops.

The checkpoint of a query plays the part of a list of processed files: a file is
taken once, also when a run is interrupted and started again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from opinara import schemas
from opinara.operators.identity import latest_per_key
from opinara.operators.partials import Partial, store_partials
from opinara.operators.trends import sentiment_alerts
from opinara.session import cut_lineage, delete_folder, mark, names_in
from opinara.sources.readers import silver_news, silver_tweets
from opinara.sources.writers import stored_table, of_weeks, upsert_weekly, write_weekly

SILVER = {"twitter": silver_tweets, "webscraping": silver_news}


def run_available(df: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None],
                  mode: str = "append") -> StreamingQuery:
    """Hand every new micro-batch to ``each`` and stop when there is nothing left."""
    query = (df.writeStream.outputMode(mode).trigger(availableNow=True)
             .option("checkpointLocation", checkpoint).foreachBatch(each).start())
    query.awaitTermination()
    return query


def land_batches(path: str, **options: str) -> Callable[[DataFrame, int], None]:
    """Sink for ``run_available``: one partition per batch, so a repeated batch replaces itself."""
    def land(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").options(**options).parquet(f"{path}/batch={batch_id}")
    return land


def merge_landed(spark: SparkSession, checkpoint: str, merge: Callable[[DataFrame], None]) -> None:
    """Hand batches landed in ``checkpoint/landed`` to ``merge``, all at once, numbered by ``batch``, and delete them.

    These are the ones the checkpoint has committed, which are whole, and which are not marked as merged: a
    batch that is interrupted here or in ``merge`` takes part again, so repeating it must change nothing; one
    that is only left from an interrupted deletion does not.
    """
    newest = lambda folder: max((int(n) for n in names_in(f"{checkpoint}/{folder}") if n.isdigit()), default=-1)
    merged, committed = newest("merged"), newest("commits")
    if committed > merged:
        landed = stored_table(spark, f"{checkpoint}/landed")
        if landed is not None:
            merge(landed.filter(F.col("batch").between(merged + 1, committed)))
        mark(f"{checkpoint}/merged", str(committed))
    for name in names_in(f"{checkpoint}/landed"):
        number = name.removeprefix("batch=")
        if number.isdigit() and int(number) <= committed:
            delete_folder(f"{checkpoint}/landed/{name}")


def stream_files(spark: SparkSession, path: str, schema, pattern: str = "*.parquet",
                 file_format: str = "parquet", per_batch: int | None = None, **options) -> DataFrame:
    reader = spark.readStream.format(file_format).schema(schema).option("pathGlobFilter", pattern)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def stream_silver(spark: SparkSession, source: str, bronze: str, silver: str, checkpoint: str,
                  keys: list[str], date: Callable[[DataFrame], Column],
                  per_batch: int | None = None, lines: bool = False) -> StreamingQuery:
    """Bronze snapshots to the weekly Silver table, new files only, last row per key.

    A file named ``source_*.json`` holds one document or a list; with ``lines`` the folders
    that ``write_snapshot`` lands are read, one document per line, gzipped or not.

    A batch is parsed and lands below the checkpoint. When there is nothing left, or a batch fails, what
    has landed is cleaned and merged at once, a later batch over an earlier one: the weeks are rewritten once a
    run and not once a batch, by all cores and not by those that can read a batch's files.
    """
    snapshots = stream_files(spark, bronze, schemas.SNAPSHOTS[source], "*.json*" if lines else f"{source}_*.json",
                             "json", per_batch, multiLine=str(not lines).lower())
    # written by the few tasks that read a batch's files, so cheaply: texts hardly repeat, a dictionary would be built in vain
    land = land_batches(f"{checkpoint}/landed", **{
        "compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary": "false"})

    def merge(landed: DataFrame) -> None:
        rows = SILVER[source](landed, keep=["batch"])
        dated = rows.withColumn("event_date", date(rows))
        upsert_weekly(dated, silver, keys, ["snapshot_date"], date_col="event_date", batch="batch")

    try:
        return run_available(snapshots, checkpoint, land)
    finally:
        merge_landed(spark, checkpoint, merge)


def stream_dedup(df: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """First row per key; copies are recognised up to ``delay`` late, so state is bounded.

    The batch rule keeps the last row. A stream that needs it merges with an upsert
    inside ``foreachBatch``.
    """
    return (df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
            .dropDuplicatesWithinWatermark(keys))


def stream_trend(df: DataFrame, ts: str, by: str, width: str = "1 day", slide: str | None = None,
                 delay: str = "2 days", score: str | None = None, start: bool = False) -> DataFrame:
    """Volume (and mean score) per window and group; with ``start`` also when the window begins,
    which tells windows of one day apart."""
    windowed = (df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
                .groupBy(F.window(ts, width, slide) if slide else F.window(ts, width), by))
    measures = [F.count(F.lit(1)).alias("n_records")]
    if score:
        measures += [F.sum(score).alias("score_sum"), F.avg(score).alias("avg_score")]
    return windowed.agg(*measures).select(
        *([F.col("window.start").alias("start")] if start else []),
        F.col("window.start").cast("date").alias("period"), by, *[
            c for c in ("n_records", "score_sum", "avg_score")[: len(measures)]])


def write_trend(trend: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Land each period when the watermark has closed it; state holds the open ones only."""
    return run_available(trend, checkpoint, land_batches(path))


def write_open_trend(trend: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Land the periods a batch changes, open ones too, as they stand after it; state holds the
    open ones only. ``read_open_trend`` gives each period's latest value."""
    return run_available(trend, checkpoint, land_batches(path), "update")


def read_open_trend(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The latest landed row per ``keys``, which name a window and group of the trend."""
    return latest_per_key(spark.read.parquet(path), keys, [F.col("batch").desc()], total=True).drop("batch")


def stream_alerts(trend: DataFrame, path: str, checkpoint: str, threshold: float = 15.0) -> StreamingQuery:
    """All alerts over a streamed daily sentiment trend, below ``path/alerts``.

    A batch of closed days is compared with the last day of each group before it, which the
    batch before has left behind: one row per group, however long the history. Days and
    alerts land per batch, so a repeated batch replaces itself.
    """
    spark = trend.sparkSession

    def detect(batch: DataFrame, batch_id: int) -> None:
        batch = cut_lineage(batch)
        before = stored_table(spark, f"{path}/last/batch={batch_id - 1}") if batch_id else None
        days = batch if before is None else batch.unionByName(before)
        first = batch.groupBy("brand", "source").agg(F.min("date_day").alias("first"))
        alerts = sentiment_alerts(days, threshold).join(first, ["brand", "source"]).filter(
            F.col("date") >= F.col("first")).drop("first")
        alerts.write.mode("overwrite").parquet(f"{path}/alerts/batch={batch_id}")
        latest_per_key(days, ["brand", "source"], [F.col("date_day").desc()], total=True).write.mode(
            "overwrite").parquet(f"{path}/last/batch={batch_id}")

    return run_available(trend, checkpoint, detect)


def refresh_weeks(rows: DataFrame, path: str, checkpoint: str,
                  build: Callable[[DataFrame], DataFrame], silver: str) -> StreamingQuery:
    """Rebuild the Gold weeks a batch touches from Silver, and only those; undated rows
    are a week."""
    spark = rows.sparkSession

    def refresh(batch: DataFrame, _: int) -> None:
        write_weekly(build(of_weeks(spark.read.parquet(silver), batch)), path)

    return run_available(rows, checkpoint, refresh)


def keep_rollup(rows: DataFrame, path: str, checkpoint: str, keys: list[str], measures: Mapping[str, Partial],
                date_col: str) -> StreamingQuery:
    """Add each batch's partial measures to a weekly roll-up; neither Silver nor older batches are read.

    ``partials.added`` gives the roll-up as it stands.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        store_partials(batch, path, batch_id, keys, measures, date_col)

    return run_available(rows, checkpoint, add)
