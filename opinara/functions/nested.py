"""Structs, arrays and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _leaves(schema: StructType, path: tuple[str, ...] = ()):
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every struct leaf as a top-level column, names joined by ``sep``."""
    return df.select(*[
        F.col(".".join(f"`{part}`" for part in path)).alias(sep.join(path))
        for path in _leaves(df.schema)
    ])


def nested_to_json(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON strings; null fields stay visible."""
    return df.withColumns({
        f.name: F.to_json(f.name, {"ignoreNullFields": "false"})
        for f in df.schema.fields if isinstance(f.dataType, (ArrayType, StructType, MapType))
    })


def parse_json_array(col: Column | str) -> Column:
    return F.from_json(_col(col), "array<string>")


def parse_comments(col: Column | str) -> Column:
    """List literal to array of strings; malformed or null gives an empty array."""
    empty = F.array().cast("array<string>")
    parsed = parse_json_array(col)
    return F.coalesce(F.filter(parsed, lambda c: c.isNotNull()), empty)


def explode_json_array(df: DataFrame, col: str, name: str, keep: list[str] | None = None,
                       outer: bool = False) -> DataFrame:
    """One row per element of a JSON array string. ``outer`` keeps childless parents."""
    keep = keep if keep is not None else [c for c in df.columns if c != col]
    arrays = parse_comments(col) if outer else parse_json_array(col)
    spread = F.explode_outer(arrays) if outer else F.explode(arrays)
    return df.select(*keep, spread.alias(name))


def explode_children(df: DataFrame, array: str, parents: dict[str, str],
                     outer: bool = False) -> DataFrame:
    """One row per child struct, its fields first, then the parent's attributes
    under new names."""
    spread = F.explode_outer(array) if outer else F.explode(array)
    child = df.select(*[F.col(c).alias(n) for c, n in parents.items()], spread.alias("_child"))
    return child.select("_child.*", *parents.values())


def array_size(col: Column | str) -> Column:
    """Number of elements; a missing array has none."""
    return F.coalesce(F.array_size(_col(col)), F.lit(0)).cast("bigint")


def expand_entities(df: DataFrame) -> DataFrame:
    """Snapshots as entity rows: tweets, news articles and their comments, each tagged
    with ``record_type``. A snapshot whose lists are all missing or empty stays as one
    ``snapshot`` row."""
    lists = [c for c in ("tweets", "news") if c in df.columns]
    parents = [c for c in df.columns if c not in ("tweets", "news")]
    if not lists:
        return df.withColumn("record_type", F.lit("snapshot"))
    parts = []
    if "tweets" in lists:
        rows = df.select(*parents, F.explode("tweets").alias("tweet"))
        parts.append(flatten(rows).withColumn("record_type", F.lit("tweet")))
    if "news" in lists:
        articles = df.select(*parents, F.explode("news").alias("news"))
        parts.append(nested_to_json(flatten(articles)).withColumn("record_type", F.lit("news")))
        comments = articles.select(
            "*", F.explode_outer("news.comments").alias("comment_text")
        ).withColumn("news", F.col("news").dropFields("comments"))
        parts.append(flatten(comments).withColumn("record_type", F.lit("news_comment")))
    empty = F.lit(True)
    for c in lists:
        empty = empty & (F.coalesce(F.size(c), F.lit(0)) < 1)
    parts.append(flatten(df.filter(empty).select(*parents)).withColumn("record_type", F.lit("snapshot")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def records_json(df: DataFrame, cols: list[str], order: list[Column], name: str) -> DataFrame:
    """A bounded frame (one row per taxonomy key) as one JSON list of records.

    The order columns travel in front of each record, so sorting the collected
    structs restores them whatever order the shuffle delivered.
    """
    keyed = df.select(
        F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)],
                 F.struct(*cols).alias("rec")).alias("item"))
    return keyed.agg(F.to_json(
        F.transform(F.sort_array(F.collect_list("item")), lambda i: i["rec"]),
        {"ignoreNullFields": "false"}).alias(name))
