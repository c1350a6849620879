"""Writing snapshots, weekly tables and CSV."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DateType, StructType, TimestampType

from opinara.functions.dates import with_iso_week
from opinara.operators.identity import upsert
from opinara.operators.quality import is_missing, required_fields_ok
from opinara.session import staged

def write_weekly(df: DataFrame, path: str, week: tuple[int, int] | None = None,
                 watch: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """Replace weeks of a partitioned table and leave the others alone.

    With ``week`` the whole frame is that week, and an empty frame empties it. Without,
    the weeks are those found in the columns ``iso_year`` and ``iso_week``; rows are
    rebalanced by week first, so that a task does not open a file for every week and a
    week that holds most of the rows is still written by many tasks. ``watch`` is applied to the
    rows as the writing tasks get them, behind every shuffle.
    """
    if week is not None:
        (watch(df).drop("iso_year", "iso_week").write.mode("overwrite")
         .parquet(f"{path}/iso_year={week[0]}/iso_week={week[1]}"))
        return
    (watch(df.hint("rebalance", F.col("iso_year"), F.col("iso_week")))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy("iso_year", "iso_week").parquet(path))


def write_weekly_observed(df: DataFrame, path: str, fields: list[str], required: list[str],
                          week: tuple[int, int] | None = None) -> DataFrame:
    """``write_weekly``, with rows, nulls and compliance measured by the job that writes.

    Returns ``measure, field, hits, rate, rows_written``: one row ``null_rate`` for each of ``fields``
    (null or blank, as in ``null_rates``) and one ``row_compliance`` for ``required``. The counts
    are taken by the tasks that write, where Spark counts each partition once however often
    a task is repeated. The driver gets one number a field. No rows give counts and rates of 0.
    """
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(required_fields_ok(required)).alias("ok"),
              *[F.count_if(is_missing(f"`{f}`")).alias(f"null_{i}") for i, f in enumerate(fields)]]
    write_weekly(df, path, week, lambda rows: rows.observe(seen, *counts))
    got = seen.get
    n = got.get("rows", 0)
    hits = [("null_rate", f, got.get(f"null_{i}", 0)) for i, f in enumerate(fields)]
    hits.append(("row_compliance", None, got.get("ok", 0)))
    return df.sparkSession.createDataFrame(
        [(measure, field, k, 100.0 * k / n if n else 0.0, n) for measure, field, k in hits],
        "measure string, field string, hits long, rate double, rows_written long")


def encode_values(df: DataFrame) -> DataFrame:
    """Values JSON has no form for: bytes as hex, dates and times as ISO strings."""
    encoded = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, BinaryType):
            encoded[field.name] = F.lower(F.hex(field.name))
        elif isinstance(field.dataType, DateType):
            encoded[field.name] = F.date_format(field.name, "yyyy-MM-dd")
        elif isinstance(field.dataType, TimestampType):
            encoded[field.name] = F.date_format(field.name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return df.withColumns(encoded) if encoded else df


def write_snapshot(df: DataFrame, root: str, source: str, topic: str,
                   at: datetime | None = None) -> str:
    """Land documents as gzipped JSON lines, a file a task, under a time-stamped name, which is returned."""
    stamp = (at or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")
    path = f"{root}/{source}_{topic}_{stamp}.json"
    (encode_values(df).write.mode("error").option("ignoreNullFields", False)
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").json(path))
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; nested values go out as JSON."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (ArrayType, StructType))]
    flat = df.withColumns({c: F.to_json(c) for c in nested}) if nested else df
    (flat.write.mode(mode).option("header", True).option("escape", '"')
     .option("quoteAll", True).csv(path))


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A weekly table, None where nothing has been written yet."""
    from pyspark.errors import AnalysisException
    try:
        table = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    # a table of undated rows alone has weeks of no type
    untyped = [c for c, kind in table.dtypes if c in ("iso_year", "iso_week") and kind != "int"]
    return table.withColumns({c: F.col(c).cast("int") for c in untyped}) if untyped else table


def of_weeks(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of ``table`` in the weeks of ``rows``. Undated rows are a week of their own.

    As many weeks are broadcast as the calendar has in ``rows``.
    """
    weeks = rows.select(F.col("iso_year").alias("_year"), F.col("iso_week").alias("_week")).distinct()
    return table.join(F.broadcast(weeks), F.col("iso_year").eqNullSafe(F.col("_year"))
                      & F.col("iso_week").eqNullSafe(F.col("_week")), "left_semi")


def upsert_weekly(new: DataFrame, path: str, keys: list[str], order: list[str],
                  date_col: str | None = None, week: tuple[int, int] | None = None, batch: str | None = None) -> None:
    """Merge a batch into its weeks of a partitioned table; per key the last row stays.

    Several batches can be merged at once where the column ``batch`` numbers them (see ``upsert``).

    Only the weeks the batch touches are read and replaced; undated rows are a week. The merged rows are
    written to the shared folder before the weeks they were read from are replaced,
    so a lost executor cannot make Spark read a half-replaced table; that copy goes afterwards.
    """
    if week is not None:
        new = new.withColumns({"iso_year": F.lit(week[0]), "iso_week": F.lit(week[1])})
    elif date_col is not None:
        new = with_iso_week(new, date_col)
    stored = stored_table(new.sparkSession, path)
    existing = new.limit(0) if stored is None else of_weeks(stored, new)
    merged = upsert(new, existing, [*keys, "iso_year", "iso_week"], order, batch)
    with staged(merged) as rows:
        write_weekly(rows, path)
