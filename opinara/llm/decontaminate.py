"""Benchmark decontamination by spaced-seed hashing (operator 3).

A seed hashes the words of a text at the positions a mask keeps and ignores those between, so
a substituted word hides only the seeds that look at it. Seeds of the texts meet seeds of the
benchmark in one equi-join; around each hit the texts are laid over each other and compared
word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Word offsets a seed looks at. Together the masks hit every alignment of 13 words with at
#: most two substitutions, wherever these are (tests/llm checks all of them).
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 4, 6, 9, 10))
#: An overlap counts when some window of so many words has at most so many substitutions. Items of
#: fewer words must occur whole, with substitutions in proportion: one in 7 to 12 words, none in 5 or 6.
WINDOW, SUBSTITUTIONS = 13, 2
#: Items of fewer words than this are found only where they are the whole document.
SHORTEST = 5
#: Letters of scripts that put no spaces between words (Thai and Lao, Myanmar, Khmer, Kana, Han); each counts as a word.
UNSPACED = r"[฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿\x{20000}-\x{3FFFF}]"
#: Up to so many seeds (16 bytes each) the benchmark side is broadcast; beyond, both shuffle.
BROADCAST_SEEDS = 1_000_000


def words(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits of a text, and of each letter of
    the scripts without spaces."""
    lower = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    spaced = F.when(lower.rlike(UNSPACED), F.regexp_replace(lower, UNSPACED, " $0 ")).otherwise(lower)
    split = F.split(spaced, r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(split, lambda w: w != ""), lambda w: F.xxhash64(w))


def allowance(size: int) -> int:
    """Substitutions allowed in the window of an item of ``size`` words."""
    return min(size, WINDOW) * SUBSTITUTIONS // WINDOW


def masks_for(sizes: list[int]) -> list[tuple[int, ...]]:
    """Masks that see every allowed alignment of items of these sizes (13 stands for all beyond).

    Where one word in n may differ, every other word of the even places or of the odd ones is
    unchanged, so one mask of n // 2 words with gaps, laid on the first and the second word, is enough.
    """
    short = sorted({n for n in sizes if SHORTEST <= n < WINDOW})
    gapped = sorted({n // 2 for n in short if allowance(n)})
    return ((list(MASKS) if WINDOW in sizes else []) + [tuple(range(n)) for n in short if not allowance(n)]
            + [tuple(range(0, 2 * h, 2)) for h in gapped])


def seeds(hashes: Column, number: int, mask: tuple[int, ...]) -> Column:
    """One hash per position at which the whole mask fits, in order."""
    last = F.size(hashes) - mask[-1]
    return F.when(last >= 1, F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.xxhash64(F.lit(number), *[F.element_at(hashes, i + o) for o in mask]))
    ).otherwise(F.array().cast("array<bigint>"))


def _seed_rows(rows: DataFrame, masks: list[tuple[int, ...]], place: str) -> DataFrame:
    """``rows`` (with ``hashes``) times their seeds: ``seed`` and its word position ``place``.

    All masks' seeds are one array and one generator, so that the generator and the join above
    it run in one generated stage and ``hashes`` is passed on, not copied per position.
    """
    n = F.size("hashes")
    # outer: for the inner generator the optimizer adds a filter that computes the lists again
    listed = rows.withColumn("_all", F.concat(*[seeds(F.col("hashes"), k, m) for k, m in enumerate(masks)]))
    place_at, begun = F.col("_at"), F.lit(0)
    where = F.lit(None).cast("int")
    for mask in masks:  # the last mask that has begun at this place of the array
        where = F.when(place_at >= begun, place_at - begun).otherwise(where)
        begun = begun + F.greatest(n - mask[-1], F.lit(0))
    return listed.select(*rows.columns, F.posexplode_outer("_all").alias("_at", "seed")).select(
        *rows.columns, "seed", where.alias(place)).filter(F.col("seed").isNotNull())


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, item)``: word hashes of the items that have words."""
    return benchmark.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("item")).filter(
        F.size("item") > 0)


def _whole(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that are an item of fewer than ``SHORTEST`` words, word for word."""
    short = items.filter(F.size("item") < SHORTEST)
    return docs.filter(F.size("hashes").between(1, SHORTEST - 1)).join(
        short, F.col("hashes") == F.col("item")).select(
        "doc_id", "item_id", F.lit(0).alias("start"),
        *[F.size("item").alias(c) for c in ("n_words", "n_same", "best_window")])


def _same(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: (a == b).cast("int"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, v: total + v)


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Benchmark items found in documents, one row per document and item.

    Returns ``doc_id, item_id, start`` (word of the document on which the item's first word
    falls, negative if it begins before), ``n_words`` (words laid over each other),
    ``n_same`` and ``best_window`` (equal words in the best window) of the alignment with the
    most equal words. An item of 13 words or more is found when 13 of its words in a row
    occur with at most two of them substituted; one of 7 to 12 words when it occurs whole with
    at most one substituted, one of 5 or 6 when it occurs whole. An item of fewer words is found
    where it is the whole document, since inside a text it cannot be told from chance. Case,
    punctuation and white space do not count; letters of scripts without spaces are words.

    Null and empty texts match nothing, on either side. Repeated documents or items give what
    one of them gives; different texts under one id are compared each for itself and the best
    alignment is returned; null is an id like another. Other columns are ignored whatever their
    names. No documents or no items, no rows.
    """
    items = benchmark_items(benchmark, item_id_col, item_text_col)
    sizes = [r["n"] for r in items.select(F.least(F.size("item"), F.lit(WINDOW)).alias("n"))
             .distinct().collect()]  # at most thirteen numbers
    listed = docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("hashes"))
    whole = _whole(listed, items)
    masks = masks_for(sizes)
    if not masks:
        return whole.distinct()
    item_seeds = _seed_rows(items.filter(F.size("item") >= SHORTEST).withColumnRenamed("item", "hashes"), masks, "item_at").select(
        "seed", "item_id", "item_at", F.col("hashes").alias("item"))
    if item_seeds.count() <= BROADCAST_SEEDS:
        item_seeds = F.broadcast(item_seeds)
    hits = _seed_rows(listed, masks, "doc_at").join(item_seeds, "seed").withColumn("start", F.col("doc_at") - F.col("item_at"))
    # the part of the item that lies over the document; one row per alignment, and the
    # comparison above that aggregation, where the optimizer cannot move it into the join
    first = F.greatest(F.lit(0), -F.col("start"))
    n = F.least(F.size("item"), F.size("hashes") - F.col("start")) - first
    texts = F.struct(F.xxhash64("hashes").alias("doc"), F.xxhash64("item").alias("item")).alias("texts")
    laid = hits.select("doc_id", "item_id", "start", texts, F.size("item").alias("size"),
                       F.slice("hashes", F.col("start") + first + 1, n).alias("over"),
                       F.slice("item", first + 1, n).alias("under")).groupBy(
        "doc_id", "item_id", "start", "texts").agg(*[F.first(c).alias(c) for c in ("size", "over", "under")])
    compared = laid.select("doc_id", "item_id", "start", "size", F.size("over").alias("n_words"),
                           _same(F.col("over"), F.col("under")).alias("same"))
    n_same = _sum(F.col("same"))
    window = F.least(F.col("size"), F.lit(WINDOW))
    need = window - F.floor(window * SUBSTITUTIONS / WINDOW).cast("int")
    # most chance hits share no more than their seed: windows are looked at only beyond that
    best = F.when((F.col("n_words") >= window) & (n_same >= need), F.array_max(F.transform(
        F.sequence(F.lit(1), F.col("n_words") - window + 1), lambda i: _sum(F.slice("same", i, window)))))
    found = compared.withColumns({"n_same": n_same, "best_window": best}).filter(
        F.col("best_window") >= need)
    by = F.struct("n_same", "best_window", -F.col("start"), "n_words")
    best_of = found.groupBy("doc_id", "item_id").agg(F.max(by).alias("m")).select(
        "doc_id", "item_id", (-F.col("m.col3")).alias("start"), "m.n_words", "m.n_same", "m.best_window")
    if min(sizes) >= SHORTEST:
        return best_of
    return best_of.unionByName(whole.distinct()).groupBy("doc_id", "item_id").agg(
        F.max(F.struct("n_same", "best_window", -F.col("start"), "n_words")).alias("m")).select(
        "doc_id", "item_id", (-F.col("m.col3")).alias("start"), "m.n_words", "m.n_same", "m.best_window")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage, all columns kept.

    Decided for each text by itself, so rows with a null or repeated id are treated like any
    other. A null text stays. No documents, no rows; no items, all rows.
    """
    key = "_text"
    while key in docs.columns:
        key += "_"
    keyed = docs.withColumn(key, F.md5(F.col(text_col).cast("string")))
    found = overlaps(keyed, benchmark, key, text_col).select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(found, key, "left_anti").select(*[f"`{c}`" for c in docs.columns])
