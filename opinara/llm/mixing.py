"""Mixing sources to target weights (operator 1).

A source with share p of all tokens gets the weight p^a / sum(p^a): a = 1 keeps the natural
mix, a = 0 gives every source the same. The exponent is found by bisection, the weights are
turned into token budgets, and each budget is spent by reading the source's blocks in one
random order per epoch until it is used up.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, Window

from opinara.session import cut_lineage

#: Bisection steps made by one pass over the sources' totals, and passes.
STEPS, PASSES = 6, 5


def word_count(text: Column) -> Column:
    """Words between white space; the tokens of a document unless a column has them."""
    return F.size(F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"),
                           lambda w: w != "")).cast("bigint")


def _unit(*parts) -> Column:
    """A number in [0, 2^32) fixed by the parts."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def find_exponent(totals: DataFrame, target_entropy: float | None = None,
                  max_repeats: float | None = None) -> float:
    """Exponent for ``totals`` (one row per source, ``tokens`` > 0), found by bisection.

    With ``target_entropy``, a share of the entropy of the uniform mix, the largest exponent
    whose weights have at least that entropy. With ``max_repeats``, the smallest exponent at
    which no source is read more often than that while every document is read once. With
    both, the repeats win. Between 0 and 1, exact to 2^-30; 1 where the natural mix already
    meets the entropy or there are no sources.
    """
    total = totals.agg(F.sum("tokens").alias("all"), F.count(F.lit(1)).alias("k")).first()
    if not total["k"]:
        return 1.0
    shares = totals.select((F.col("tokens") / F.lit(float(total["all"]))).alias("p"))

    def bisect(holds, low: float, high: float, rising: bool) -> float:
        """Border of ``holds`` in [low, high]: it holds above the border if rising, else below."""
        for _ in range(PASSES):
            step = (high - low) / 2**STEPS
            grid = [low + step * i for i in range(1, 2**STEPS)]
            power = F.pow("p", F.col("a"))
            rows = (shares.withColumn("a", F.explode(F.array(*[F.lit(a) for a in grid])))
                    .groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.ln("p")).alias("l"),
                                      F.min("p").alias("least"), F.max("p").alias("most"))
                    .withColumn("holds", holds).collect())  # 63 rows
            good = {r["a"] for r in rows if r["holds"]}
            if rising:
                high = min(good, default=high)
                low = high - step
            else:
                low = max(good, default=low)
                high = low + step
        return high if rising else low

    found = 1.0 if target_entropy is not None or max_repeats is None else 0.0
    if target_entropy is not None and total["k"] > 1:
        wanted = F.lit(target_entropy) * F.ln(F.lit(float(total["k"])))
        # entropy of the weights: ln z - a * sum(p^a ln p) / z
        found = bisect(F.ln("z") - F.col("a") * F.col("l") / F.col("z") >= wanted, 0.0, 1.0, False)
        natural = shares.agg(F.sum(F.col("p") * F.ln("p")).alias("l")).first()["l"]
        if -natural >= target_entropy * math.log(total["k"]):
            found = 1.0
    if max_repeats is not None:
        repeats = F.pow(F.col("most") / F.col("least"), 1 - F.col("a"))
        extreme = shares.agg((F.max("p") / F.min("p")).alias("r")).first()["r"]
        least = 0.0 if extreme <= max_repeats else bisect(repeats <= max_repeats, 0.0, 1.0, True)
        found = max(found, least)
    return found


def mix(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = 2.0,
        budget: int | None = None, block_tokens: int = 1 << 18, seed: int = 17,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        tokens_col: str | None = None) -> DataFrame:
    """The reading plan: one row per use of a document.

    Returns ``doc_id, source, n_tokens, epoch, block, block_rank`` (place of the block in its
    epoch). ``budget`` is the number of tokens to read; by default the least with which every
    document is read at least once. Documents are dealt to blocks by a hash of their id;
    a source's last epoch reads whole blocks while they fit and part of the next one, so a
    source misses its budget by less than one document.

    Null text counts as empty; a document without tokens is read with its block in full
    epochs, and a source without any tokens once. A null source is a source of its own.
    Repeated rows are read each. Rows with a null id share a block. Other columns are
    ignored whatever their names. No rows, no plan.
    """
    tokens = F.col(tokens_col).cast("bigint") if tokens_col else word_count(F.col(text_col))
    rows = cut_lineage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n")).alias("key"),
        F.coalesce(tokens, F.lit(0)).alias("n_tokens")))
    totals = cut_lineage(rows.groupBy("key").agg(F.sum("n_tokens").alias("tokens")))
    mixed = totals.filter("tokens > 0")
    a = find_exponent(mixed, target_entropy, max_repeats)
    weighed = mixed.withColumn("power", F.pow(F.col("tokens").cast("double"), F.lit(a)))
    one = weighed.agg(F.sum("power").alias("z"), F.max(F.col("tokens") / F.col("power")).alias("once")).first()
    reads = F.lit(float(budget) / one["z"] if budget is not None and one["z"] else one["once"] or 0.0)
    budgets = totals.join(weighed.select("key", "power"), "key", "left").select(
        "key", "tokens",
        F.coalesce(F.round(F.col("power") * reads).cast("bigint"), F.lit(0)).alias("budget"),
        F.greatest(F.ceil(F.col("tokens") / block_tokens), F.lit(1)).alias("blocks"))

    # sources are few next to documents; the planner broadcasts their totals if they are small
    dealt = cut_lineage(rows.join(budgets.select("key", "blocks"), "key").select(
        "doc_id", "source", "key", "n_tokens",
        F.pmod(_unit(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.col("blocks")).alias("block")))
    blocks = dealt.groupBy("key", "block").agg(F.sum("n_tokens").alias("block_tokens"))

    # whole epochs, and what is left for the last one; its blocks in order until it is spent
    whole = F.when(F.col("tokens") == 0, 1).otherwise(F.floor(F.col("budget") / F.greatest("tokens", F.lit(1))))
    spent = budgets.withColumns({"whole": whole.cast("bigint")}).withColumn(
        "rest", F.when(F.col("tokens") == 0, 0).otherwise(F.col("budget") - F.col("whole") * F.col("tokens")))
    epochs = blocks.join(spent.select("key", "whole", "rest"), "key").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("whole"))))
    order = Window.partitionBy("key", "epoch").orderBy(
        _unit(F.lit(seed + 1), F.col("epoch"), F.col("block"), F.col("key")), "block")
    ranked = epochs.withColumns({
        "block_rank": F.row_number().over(order),
        "before": F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))
        - F.col("block_tokens")})
    left = F.when(F.col("epoch") < F.col("whole"), F.col("block_tokens")).otherwise(
        F.least(F.col("rest") - F.col("before"), F.col("block_tokens")))
    used = ranked.withColumns({"left": left, "full": F.col("epoch") < F.col("whole")}).filter(
        F.col("full") | (F.col("left") > 0)).select(
        "key", "block", "epoch", "block_rank", "left", (F.col("full") | (F.col("left") >= F.col("block_tokens"))).alias("full"))
    plan = dealt.join(used, ["key", "block"])
    # only one block per source is cut; its documents are read in a random order while they fit
    cut = plan.filter(~F.col("full"))
    inside = Window.partitionBy("key", "block", "epoch").orderBy(
        _unit(F.lit(seed + 2), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), "doc_id")
    begun = cut.withColumn("_sum", F.sum("n_tokens").over(
        inside.rowsBetween(Window.unboundedPreceding, 0))).filter(F.col("_sum") <= F.col("left"))
    return plan.filter("full").unionByName(begun.drop("_sum")).select(
        "doc_id", "source", "n_tokens", "epoch", "block", F.col("block_rank").cast("bigint").alias("block_rank"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with each row as often as its reading plan has it, all columns kept.

    Rows without an id, and ids that occur more than once, are read once.
    """
    plan = mix(docs, id_col=id_col, **options)
    uses = plan.groupBy(F.col("doc_id").alias("doc")).agg(
        F.count(F.lit(1)).alias("reads"), F.max("epoch").alias("epochs"))
    # the row is one column, so that no name of its own can clash
    held = docs.select(docs[id_col].alias("doc"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    # an id that occurs n times has n plans; one row then stands for one of them
    times = F.greatest(F.least(F.coalesce("reads", F.lit(1)), F.coalesce(F.col("epochs") + 1, F.lit(1))), F.lit(1))
    return held.join(uses, "doc", "left").select("row", F.explode(F.sequence(F.lit(1), times))).select("row.*")
