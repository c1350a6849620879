"""Column profiles, describes, correlations, cross-tabs, null structure, cleaning report."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opinara.functions.text import word_tokens
from opinara.operators.quality import pct
from opinara.operators.quantiles import quantile_columns
from opinara.session import cut_wide_lineage


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def column_audit(df: DataFrame, approx: bool = False) -> DataFrame:
    """Type, missing ratio, non-null and distinct count of every column, in one aggregation.

    Exact distinct counts of k columns send every distinct value through a shuffle;
    ``approx`` counts with sketches instead.
    """
    kinds = dict(df.dtypes)

    def distinct(c: str) -> Column:
        value = F.col(f"`{c}`")
        if approx:
            return F.approx_count_distinct(value)
        if kinds[c] == "string":  # texts are told apart by their digest
            value = F.sha2(value, 256)
        return F.count_distinct(value)

    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[
        F.struct(F.count(f"`{c}`").alias("present"), distinct(c).alias("distinct")).alias(f"c{i}")
        for i, c in enumerate(df.columns)])
    rows = [F.struct(
        F.lit(c).alias("column"), F.lit(kinds[c]).alias("dtype"),
        (1.0 - _ratio(F.col(f"c{i}.present"), F.col("_n"))).alias("missing_ratio"),
        F.col(f"c{i}.present").alias("non_null_count"),
        F.col(f"c{i}.distinct").alias("nunique"),
    ) for i, c in enumerate(df.columns)]
    return counts.select(F.inline(F.array(*rows)))


def candidate_columns(audit: DataFrame, max_missing: float = 0.35) -> DataFrame:
    """Columns filled well enough to be used."""
    return audit.filter(F.col("missing_ratio") <= max_missing)


def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, deviation, extremes and interpolated quartiles per column."""
    from opinara.operators.quantiles import long_values
    quartiles = quantile_columns(df, cols, {"q1": 0.25, "median": 0.5, "q3": 0.75}).drop("n")
    moments = long_values(df, cols).groupBy("metric").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    return moments.join(quartiles, "metric")


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a whole row, so that distinct rows are counted without shuffling them."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]),
                            {"ignoreNullFields": "false"}), 256)


def quality_summary(df: DataFrame, id_col: str, text_col: str, date_col: str) -> DataFrame:
    """Rows, duplicates, id, text and date quality as ``(metric, value)``.

    Distinct rows are counted in their own aggregation: beside a second distinct
    count Spark would expand every row once per count.
    """
    n = F.count(F.lit(1))
    length = F.length(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    base = df.agg(
        n.alias("rows"), F.count(id_col).alias("ids"), F.count_distinct(id_col).alias("unique_ids"),
        F.count_if(length == 0).alias("no_text"), F.avg(length).alias("avg_length"),
        F.count_if(F.col(date_col).isNull()).alias("no_date"))
    distinct_rows = df.select(row_digest(df).alias("d")).agg(F.count_distinct("d")).scalar()
    rows, dup = F.col("rows"), F.col("rows") - distinct_rows
    lines = {
        "rows": rows, "columns": F.lit(len(df.columns)), "duplicate_rows": dup,
        "duplicate_rate": _ratio(dup, rows), "id_null_rate": 1.0 - _ratio(F.col("ids"), rows),
        "id_unique_rate": _ratio(F.col("unique_ids"), rows),
        "text_missing_rate": _ratio(F.col("no_text"), rows),
        "avg_text_length": F.coalesce("avg_length", F.lit(0.0)),
        "date_missing_rate": _ratio(F.col("no_date"), rows),
    }
    return base.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value"))
        for k, v in lines.items()])))


def top_values(df: DataFrame, col: str, n: int = 10, missing: str = "Unknown") -> DataFrame:
    """Most frequent values; ties go by value."""
    value = F.coalesce(F.col(col).cast("string"), F.lit(missing))
    return (df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.col("rows").desc(), "value").limit(n))


# Name rules of the column catalogue, tried in this order.
# kind of test, names or name parts, family, recommendation
CATALOG_RULES = [
    ("is", ["_id"], "lineage", "Keep as lineage"),
    ("is", ["source_file", "source_group"], "lineage", "Keep as lineage"),
    ("is", ["record_type"], "grain", "Keep"),
    ("is", ["createdAt", "updatedAt", "parsed_datetime", "event_date", "date"], "time", "Keep"),
    ("is", ["raw_text", "clean_text", "text_length", "detected_lang", "has_text", "tweet_text",
            "comment_text", "news_comments", "news_newsLink"], "text_nlp", "Keep"),
    ("starts", "tweet_author_", "author", "Keep"),
    ("starts", "tweet_quoted_tweet_quoted_tweet_", "deep_quote", "Drop for Gold"),
    ("starts", "tweet_quoted_tweet_", "quote", "Review"),
    ("starts", "tweet_", "tweet", "Review"),
    ("starts", "news_", "news", "Review"),
]
# Name parts that change the recommendation inside a family.
AUTHOR_BLOBS = ["profile_bio_entities", "pinnedtweetids", "coverpicture", "profilepicture"]
TWEET_CORE = ["id", "createdat", "lang", "source", "likecount", "replycount", "retweetcount",
              "quotecount", "viewcount", "isreply", "conversationid"]
NEWS_CORE = ["id", "newslink", "comments", "createdat"]
SPARSE_FAMILIES = ["quote", "deep_quote", "news", "author"]


def _any_part(lowered: Column, parts: Sequence[str]) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | lowered.contains(part)
    return found


def classify_columns(audit: DataFrame) -> DataFrame:
    """Family and recommendation of each audited column, by name and missing ratio."""
    name, lowered, missing = F.col("column"), F.lower("column"), F.col("missing_ratio")
    family, advice = F.lit("other"), F.lit("Review")
    for kind, names, fam, rec in reversed(CATALOG_RULES):
        test = name.isin(names) if kind == "is" else lowered.startswith(names)
        family = F.when(test, fam).otherwise(family)
        advice = F.when(test, rec).otherwise(advice)
    tagged = audit.withColumns({"family": family, "recommendation": advice})
    fam = F.col("family")
    adjusted = (
        F.when((fam == "author") & _any_part(lowered, AUTHOR_BLOBS), "Review")
        .when((fam == "tweet") & _any_part(lowered, TWEET_CORE), "Keep")
        .when((fam == "news") & _any_part(lowered, NEWS_CORE), "Keep")
        .otherwise(F.col("recommendation")))
    demoted = F.when((missing > 0.9) & (F.col("recommendation") == "Keep"), "Review").otherwise(
        F.col("recommendation"))
    dropped = F.when((missing > 0.95) & (F.col("recommendation") == "Review")
                     & fam.isin(SPARSE_FAMILIES), "Drop for Gold").otherwise(F.col("recommendation"))
    return (tagged.withColumn("recommendation", adjusted)
            .withColumn("recommendation", demoted).withColumn("recommendation", dropped))


def family_summary(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("family", "recommendation").agg(F.count(F.lit(1)).alias("columns"))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise correlations, each pair over the rows where both are known, in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{i}")
                   for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"p{i}").alias("corr"))
             for i, (a, b) in enumerate(pairs) for x, y in dict.fromkeys([(a, b), (b, a)])]
    return one.select(F.inline(F.array(*cells)))


def corr_matrix_wide(df: DataFrame, cols: list[str]) -> DataFrame:
    """``corr_matrix`` for hundreds of columns.

    Sums, squares and products of all pairs are matrix products of a batch's columns, shifted by
    their means and with nulls as zeros, so a task keeps six numbers a pair, whatever its rows, and
    one aggregation over the tasks' pairs adds them. Two reads of ``cols``: means, then products. Each pair is
    taken over the rows where both are known; no such rows, or no variation, give null.
    """
    import numpy as np
    import pyarrow as pa

    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    means = cut_wide_lineage(numbers.agg(*[F.avg(c).alias(c) for c in numbers.columns])).first()
    shift = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])
    k, names = len(cols), ["n", "sa", "sb", "saa", "sbb", "sab"]

    def products(batches):
        total = np.zeros((6, k, k))
        for batch in batches:
            values = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1)
            known = np.array([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]).T.astype(float)
            values = np.where(known > 0, values - shift, 0.0)
            sums, squares = values.T @ known, (values * values).T @ known
            total += [known.T @ known, sums, sums.T, squares, squares.T, values.T @ values]
        a, b = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), *map(pa.array, total[:, a, b])],
                                         names=["a", "b", *names])

    added = cut_wide_lineage(numbers.mapInArrow(products, "a int, b int, " + ", ".join(f"{c} double" for c in names)).groupBy(
        "a", "b").agg(*[F.sum(c).alias(c) for c in names]))
    spread = [F.col(f"s{x}{x}") - F.try_divide(F.col(f"s{x}") * F.col(f"s{x}"), F.col("n")) for x in "ab"]
    joint = F.col("sab") - F.try_divide(F.col("sa") * F.col("sb"), F.col("n"))
    corr = F.when((spread[0] > 0) & (spread[1] > 0), joint / F.sqrt(spread[0] * spread[1]))
    name = F.array(*[F.lit(c) for c in cols])
    cell = lambda x, y: F.struct(F.get(name, F.col(x)).alias("a"), F.get(name, F.col(y)).alias("b"), corr.alias("corr"))
    return added.select(F.inline(F.when(F.col("a") == F.col("b"), F.array(cell("a", "b"))).otherwise(
        F.array(cell("a", "b"), cell("b", "a")))))


def engagement_summary(df: DataFrame, cols: list[str], log: bool = False) -> DataFrame:
    """Missing ratio, mean, median, 95th and 99th percentile per metric."""
    tails = quantile_columns(df, cols, {"median": 0.5, "p95": 0.95, "p99": 0.99}).drop("n")
    measures = {c: [F.count(c), F.avg(F.col(c).cast("double")),
                    F.avg(F.log1p(F.col(c).cast("double")))] for c in cols}
    base = df.agg(F.count(F.lit(1)).alias("_n"), *[
        F.struct(p.alias("present"), m.alias("mean"), lg.alias("log")).alias(c)
        for c, (p, m, lg) in measures.items()])
    rows = [F.struct(F.lit(c).alias("metric"),
                     (1.0 - _ratio(F.col(f"{c}.present"), F.col("_n"))).alias("missing_ratio"),
                     F.col(f"{c}.mean").alias("mean"), F.col(f"{c}.log").alias("mean_log1p"))
            for c in cols]
    wide = base.select(F.inline(F.array(*rows))).join(tails, "metric", "left")
    return wide if log else wide.drop("mean_log1p")


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of every value of ``a`` with every value of ``b`` as rows ``(a, b, n)``."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("Unknown")).alias(c)
    return df.groupBy(named(a), named(b)).agg(F.count(F.lit(1)).alias("n"))


def null_structure(df: DataFrame, by: str, text: str, date: str, core: list[str]) -> DataFrame:
    """Per record type: text coverage, and which core fields are empty by design."""
    null = lambda c: F.avg(F.col(c).isNull().cast("double"))
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg((F.length(F.coalesce(F.col(text), F.lit(""))) > 0).cast("double")).alias("has_text_ratio"),
        F.avg((F.length(F.coalesce(F.col(text), F.lit(""))) == 0).cast("double")).alias("null_text_ratio"),
        null(date).alias("null_datetime_ratio"),
        *[null(c).alias(f"{c}_null_ratio") for c in core])


def rows_per_file(df: DataFrame, present: list[str] = ()) -> DataFrame:
    """Rows of each file, and how many carry each of the named columns."""
    return df.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"non_null_{c}") for c in present if c in df.columns])


def entity_mix(df: DataFrame, entity: str, text: str, date: str) -> DataFrame:
    """Records, share, text coverage and date range per entity."""
    from opinara.operators.rollups import row_total, with_share
    counts = df.groupBy(F.coalesce(F.col(entity), F.lit("Unknown")).alias("entity")).agg(
        F.count(F.lit(1)).alias("records"),
        F.avg((F.length(F.coalesce(F.col(text), F.lit(""))) > 0).cast("double")).alias("text_coverage"),
        F.min(date).alias("first_date"), F.max(date).alias("last_date"),
        F.count(date).alias("dated"))
    return with_share(counts, "records", row_total(df), "share_pct")


def snapshot_multiplicity(df: DataFrame, key: str) -> DataFrame:
    """How many ids have how many captures, with the share of ids at each count."""
    from opinara.operators.rollups import with_share
    captures = df.groupBy(key).agg(F.count(F.lit(1)).alias("captures"))
    dist = captures.groupBy("captures").agg(F.count(F.lit(1)).alias("ids"))
    ids = dist.agg(F.sum("ids")).scalar()
    return with_share(dist, "ids", ids, "share_pct")


def multiplicity_summary(df: DataFrame, key: str) -> DataFrame:
    captures = df.groupBy(key).agg(F.count(F.lit(1)).alias("captures"))
    return captures.agg(
        F.count(F.lit(1)).alias("ids"), F.count_if(F.col("captures") > 1).alias("repeated_ids"),
        pct(F.count_if(F.col("captures") > 1), F.count(F.lit(1))).alias("repeated_pct"),
        F.max("captures").alias("max_captures"))


def text_agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """Share of rows where two texts agree, and how often each is missing."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    share = lambda flag: F.coalesce(F.avg(flag.cast("double")), F.lit(0.0))
    return df.agg(
        share(blank(a) == blank(b)).alias("equal_ratio"),
        share(F.col(a).isNull()).alias("a_null_rate"),
        share(F.length(blank(b)) == 0).alias("b_missing_rate"))


def cleaning_report(raw: DataFrame, text: str, key: list[str], lang: str,
                    order: str, target: str = "en") -> DataFrame:
    """What cleaning did: rows in, rows without text, duplicates removed, rows kept,
    duplicate rate before and after, language share, mean characters and tokens.

    Of copies the row of the greatest ``order`` stays, and its language counts. Rows are
    counted per digest of the key, so the texts themselves never cross the network; the rate
    after is measured over the rows that stay.
    """
    digest = F.sha2(F.to_json(F.struct(*key), {"ignoreNullFields": "false"}), 256)
    blank = F.trim(F.coalesce(F.col(text), F.lit(""))) == ""
    rows = raw.select(
        blank.alias("blank"), digest.alias("digest"), F.col(order).alias("order"),
        (F.col(lang) == target).cast("double").alias("target"),
        F.length(text).cast("double").alias("chars"), F.size(word_tokens(text)).cast("double").alias("tokens"))
    groups = rows.groupBy("digest", "blank").agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by("target", "order").alias("target"), F.max("chars").alias("chars"), F.max("tokens").alias("tokens"))
    kept = ~F.col("blank")
    total = groups.agg(
        F.sum("n").alias("rows_in"),
        F.coalesce(F.sum(F.when(F.col("blank"), F.col("n"))), F.lit(0)).alias("null_text_dropped"),
        F.coalesce(F.sum(F.when(kept, F.col("n") - 1)), F.lit(0)).alias("duplicates_removed"),
        F.count_if(kept).alias("valid_records"),
        F.count_distinct(F.when(kept, F.col("digest"))).alias("distinct_kept"),
        F.avg(F.when(kept, F.col("target"))).alias("target_language_share"),
        F.avg(F.when(kept, F.col("chars"))).alias("avg_chars"),
        F.avg(F.when(kept, F.col("tokens"))).alias("avg_tokens"))
    with_text = F.col("rows_in") - F.col("null_text_dropped")
    lines = {
        **{c: F.col(c) for c in ("rows_in", "null_text_dropped", "duplicates_removed", "valid_records")},
        "duplicate_rate_before": pct(F.col("duplicates_removed"), with_text),
        "duplicate_rate_after": pct(F.col("valid_records") - F.col("distinct_kept"), F.col("valid_records")),
        **{c: F.col(c) for c in ("target_language_share", "avg_chars", "avg_tokens")},
    }
    return total.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value"))
        for k, v in lines.items()])))


def language_flags(df: DataFrame, declared: str, detected: str) -> DataFrame:
    """Whether a text is English by either account, and whether the accounts agree."""
    english = F.coalesce(F.col(declared) == "en", F.lit(False)) | F.coalesce(
        F.col(detected) == "en", F.lit(False))
    unknown = lambda c: F.coalesce(F.col(c), F.lit("unknown"))
    return df.withColumns({"is_english": english, "lang_match": unknown(declared) == unknown(detected)})


def language_confusion(df: DataFrame, declared: str, detected: str) -> DataFrame:
    flagged = language_flags(df, declared, detected)
    return flagged.groupBy(
        F.coalesce(F.col(declared), F.lit("unknown")).alias("declared"),
        F.col(detected).alias("detected"), "is_english", "lang_match",
    ).agg(F.count(F.lit(1)).alias("rows"))


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Row and column count of every table."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"))
        for name, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
