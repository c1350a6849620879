"""Taxonomies held in tables: a join on rare substrings.

A keyword is filed under one of its substrings of three letters, the one that is rarest in the
texts. The substrings of a text meet the filed keywords by an equi-join, and what meets
is verified by looking for the whole keyword. No text is compared with every keyword.

Where the filed keywords are broadcast, the substrings are taken from the text's bytes at every place,
joined by checksum and verified at that place: numbers of a place, not copies of a text or lists of
its letters, are what a task goes through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opinara.session import cut_lineage

#: Letters of the substrings keywords are filed under; shorter keywords are filed whole.
GRAM = 3
#: Up to so many keywords, or substrings of keywords, (at most about 100 bytes each) are broadcast;
#: beyond, substrings and digests are shuffled.
BROADCAST_ROWS = 200_000


def keyword_rows(keywords: DataFrame) -> DataFrame:
    """``key, number, keyword`` in lower case, once each; a key has the least of its numbers."""
    rows = keywords.select("key", "number", F.lower(F.col("keyword").cast("string")).alias("keyword")).filter(
        F.col("key").isNotNull() & F.col("keyword").isNotNull())
    numbers = rows.groupBy("key").agg(F.min("number").alias("number"))
    return rows.select("key", "keyword").distinct().join(numbers, "key").select("key", "number", "keyword")


def _grams(letters: Column, size: int) -> Column:
    """Substrings of a size from a list of letters, in linear time."""
    if size == 0:
        return F.array(F.lit(""))
    last = F.size(letters) - size
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.concat(
        *[F.get(letters, i + k) for k in range(size)]))).otherwise(F.array().cast("array<string>"))


def _lowered(text: Column | str) -> Column:
    return F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def _text_grams(df: DataFrame, text: Column | str, sizes: list[int]) -> DataFrame:
    """``digest, lowered, gram``: the distinct substrings of each text."""
    lowered = df.select(_lowered(text).alias("lowered"))
    letters = lowered.select("lowered", F.sha2("lowered", 256).alias("digest"), F.split("lowered", "").alias("letters"))
    every = F.array_distinct(F.concat(*[_grams(F.col("letters"), s) for s in sizes]))
    return letters.select("digest", "lowered", F.explode(every).alias("gram"))


def _places(df: DataFrame, text: Column | str, sizes: list[int]) -> DataFrame:
    """``digest, bytes, at, sum``: checksums of the substrings of so many bytes at every place of each text.

    The empty substring is at the first place only. Substrings cut off by the end are there, too.
    """
    own = df.select(_lowered(text).alias("lowered")).select(F.sha2("lowered", 256).alias("digest"), F.col("lowered").cast("binary").alias("bytes"))
    last = F.greatest(F.octet_length("bytes") - (max(1, min(sizes)) - 1), F.lit(1))
    spots = own.select("digest", "bytes", F.explode(F.sequence(F.lit(1), last, F.lit(1))).alias("at"))
    sums = [F.crc32(F.substring("bytes", F.col("at"), F.lit(s))) for s in sizes if s]
    if 0 in sizes:
        sums.append(F.when(F.col("at") == 1, F.crc32(F.lit(b""))))
    return spots.select("digest", "bytes", "at", sums[0].alias("sum") if len(sums) == 1 else F.explode(F.array(*sums)).alias("sum"))


def _is_at(at: Column, word: str) -> Column:
    """Whether the bytes of the column ``word`` stand in ``bytes`` at a place."""
    return (at > 0) & (F.substring("bytes", at, F.octet_length(word)) == F.col(word).cast("binary"))


def _byte_sizes(grams: DataFrame) -> list[int]:
    """Lengths of substrings in bytes: thirteen at most."""
    return sorted(r[0] for r in grams.select(F.octet_length("gram")).distinct().collect())


def _checked(df: DataFrame) -> tuple[DataFrame, bool]:
    """A written frame, marked for broadcast if it is small enough, and whether it is."""
    small = df.count() <= BROADCAST_ROWS
    return (F.broadcast(df) if small else df), small


def file_keywords(df: DataFrame, text: Column | str, rows: DataFrame, sizes: list[int]) -> DataFrame:
    """``gram, key, number, keyword``: each keyword under the substring that is rarest in the texts: that stands
    at fewest places, or, of too many substrings to be broadcast, in fewest texts."""
    letters = F.split("keyword", "")
    size = F.length("keyword")
    own = F.when(size == 0, F.array(F.lit("")))
    for s in range(1, GRAM):
        own = own.when(size == s, _grams(letters, s))
    each = cut_lineage(rows.withColumn("gram", F.explode(F.array_distinct(own.otherwise(_grams(letters, GRAM))))))
    grams = cut_lineage(each.select("gram").distinct())
    wanted, small = _checked(grams)
    if small and (of_bytes := _byte_sizes(grams)):
        wanted = F.broadcast(grams.withColumn("sum", F.crc32(F.col("gram").cast("binary"))))
        met = _places(df, text, of_bytes).join(wanted, "sum").filter(_is_at(F.col("at"), "gram"))
    else:
        met = _text_grams(df, text, sizes).select("gram").join(wanted, "gram")
    counts = met.groupBy("gram").agg(F.count(F.lit(1)).alias("times"))
    rarest = F.min(F.struct(F.coalesce("times", F.lit(0)), "gram")).alias("rarest")
    return each.join(counts, "gram", "left").groupBy("key", "number", "keyword").agg(rarest).select(
        F.col("rarest.gram").alias("gram"), "key", "number", "keyword")


def _bounded_word(keyword: Column) -> Column:
    quoted = F.regexp_replace(keyword, r"([^\p{L}\p{N} _])", r"\\$1")
    return F.concat(F.lit(r"(?<![\p{L}\p{N}_])(?:"), quoted, F.lit(r")(?![\p{L}\p{N}_])"))


def keyword_hits(df: DataFrame, text: Column | str, keywords: DataFrame, match: str = "substring") -> DataFrame:
    """``digest, key, number``: the keys whose keywords occur, for the digest of each lower-cased text."""
    if match not in ("substring", "word"):
        raise ValueError(f"unknown match {match!r}")
    rows = cut_lineage(keyword_rows(keywords))
    sizes = sorted(r[0] for r in rows.select(F.least(F.length("keyword"), F.lit(GRAM))).distinct().collect())  # four at most
    if not sizes:
        return rows.select(F.lit("").alias("digest"), "key", "number")  # no keywords, no rows
    filed = cut_lineage(file_keywords(df, text, rows, sizes))
    marked, small = _checked(filed)
    if small:  # the text stays where it is
        before = F.octet_length(F.substring("keyword", F.lit(1), F.position(F.col("gram"), F.col("keyword")) - 1))
        summed = marked.select("key", "number", "keyword", before.alias("before"), F.crc32(F.col("gram").cast("binary")).alias("sum"))
        hits = _places(df, text, _byte_sizes(filed)).join(F.broadcast(summed), "sum").filter(
            _is_at(F.col("at") - F.col("before"), "keyword"))
        if match == "word":
            hits = hits.filter(F.rlike(F.col("bytes").cast("string"), _bounded_word(F.col("keyword"))))
    else:      # only digests and substrings are shuffled; each distinct text meets its candidates once
        found = F.col("lowered").contains(F.col("keyword"))
        if match == "word":
            found = found & F.rlike("lowered", _bounded_word(F.col("keyword")))
        candidates = _text_grams(df, text, sizes).select("digest", "gram").join(marked, "gram").groupBy("digest", "key", "number", "keyword").agg(F.lit(1))
        texts = df.select(_lowered(text).alias("lowered")).select(F.sha2("lowered", 256).alias("digest"), "lowered")
        hits = candidates.join(texts.dropDuplicates(["digest"]), "digest").filter(found)
    return hits.select("digest", "key", "number")


def match_first_table(df: DataFrame, text: str, keywords: DataFrame, name: str = "tag", default: str | None = None,
                      match: str = "substring") -> DataFrame:
    """``df`` with the key of the first taxonomy entry, by number and then key, that occurs in the text.

    ``keywords`` has ``key, number, keyword``; what counts is what ``taxonomy.match_first`` counts for the same
    lists. Rows of ``keywords`` with a null key or keyword say nothing, an empty keyword is in every text, null texts are
    empty. Every row of ``df`` is returned once, repeated ones too.
    """
    tags = keyword_hits(df, text, keywords, match).groupBy("digest").agg(F.min(F.struct("number", "key")).alias("best")).select(
        F.col("digest").alias("_digest"), F.col("best.key").alias("_tag"))
    joined = df.join(tags, F.sha2(_lowered(df[text]), 256) == tags["_digest"], "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce(tags["_tag"].cast("string"), F.lit(default).cast("string")).alias(name))


def match_all_table(df: DataFrame, text: str, keywords: DataFrame, name: str = "tags", match: str = "substring") -> DataFrame:
    """``df`` with all keys that occur in the text, by number and then key, as ``taxonomy.match_all`` finds them."""
    tags = keyword_hits(df, text, keywords, match).groupBy("digest").agg(
        F.transform(F.array_sort(F.collect_set(F.struct("number", "key"))), lambda e: e["key"].cast("string")).alias("_tags")).withColumnRenamed(
        "digest", "_digest")
    joined = df.join(tags, F.sha2(_lowered(df[text]), 256) == tags["_digest"], "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce(tags["_tags"], F.array().cast("array<string>")).alias(name))
