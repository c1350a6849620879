"""Conversation prefix trie, built as a z-fast trie (operator 13).

Conversations are sequences of turns. A compacted trie has a node where conversations branch or
end; the turns between two nodes are the edge above the lower one. A node is filed under
its handle: the prefix whose length is, of the lengths on its edge, divisible by the largest
power of two (the two-fattest). The deepest node on a conversation's way is then found by binary search over
lengths that are two-fattest themselves, one equi-join a step, and its exit edge by the first turn
below. Conversations are inserted in batches: of those that leave the trie at the same
place with the same turn, one brings a new edge, the others look again from there in the next
batch. At the end edges are expanded to one node per turn.

Prefixes are compared by chained digests of 16 bytes; texts are read once and never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from opinara.session import cut_lineage

#: Conversations of one family begin with turns of its first one; at most so many.
FAMILY, BORROWED = 20, 4
#: Bytes of a digest, and of joined ids that are put together at once.
DIGEST, CHUNK = 16, 1 << 18
ROOT = b""
WORD = r"[^\x20\x09-\x0D]+"


def turn_rows(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv_id, turn, role, digest, words``: one narrow pass over the texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, DIGEST).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def in_order(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns' digests and words, null turns first, ties by role and digest."""
    listed = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("dated"), "turn", "role", "digest", "words")))
    return turns.groupBy("conv_id").agg(listed.alias("all")).select(
        "conv_id", F.transform("all", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: the first turns of the family's first conversation, then the own ones behind as many."""
    borrowed = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(BORROWED)).cast("int")
    first = conversations.select(F.col("conv_id").alias("first_id"), F.slice("turns", 1, BORROWED - 1).alias("first")).filter(
        F.col("first_id") % FAMILY == 0)
    own = conversations.withColumns({"h": borrowed, "first_id": F.col("conv_id") - F.col("conv_id") % FAMILY})
    none = F.slice("turns", 1, 0)
    return own.join(first, "first_id", "left").select("conv_id", F.concat(
        F.slice(F.coalesce("first", none), F.lit(1), F.col("h")),
        F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def with_paths(conversations: DataFrame) -> DataFrame:
    """``conv_id, path, words``: ``path[d]`` is the digest of the first d + 1 turns."""
    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, words = [], []
            for turns in batch.column("turns").to_pylist():
                digest, path = ROOT, []
                for turn in turns:
                    digest = hashlib.blake2b(digest + turn["digest"], digest_size=DIGEST).digest()
                    path.append(digest)
                paths.append(path)
                words.append([t["words"] for t in turns])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(paths, pa.list_(pa.binary())), pa.array(words, pa.list_(pa.int64()))],
                names=["conv_id", "path", "words"])
    return conversations.mapInArrow(chain, "conv_id long, path array<binary>, words array<long>")


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] with most trailing zero bits: high without the bits behind the first in which the two differ."""
    bits = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return high - F.pmod(high, F.call_function("shiftleft", F.lit(1), bits))


def _at(path: str | Column, depth: Column) -> Column:
    """The digest at a depth, that of the root at 0."""
    return F.when(depth > 0, F.get(path, depth - 1)).otherwise(F.lit(ROOT))


def _common(left: Column, right: Column, low: Column, high: Column) -> Column:
    """The greatest depth in [low, high] up to which two paths are the same; they are up to ``low``."""
    same = F.filter(F.when(high > low, F.sequence(low + 1, high)).otherwise(F.array().cast("array<int>")),
                    lambda d: F.get(left, d - 1) == F.get(right, d - 1))
    return low + F.size(same)


def _handles(nodes: DataFrame) -> DataFrame:
    return nodes.select(_at("path", two_fattest(F.col("above"), F.col("depth"))).alias("handle"), F.col("depth").alias("found"),
                        F.col("id").alias("found_id"))


def locate(waiting: DataFrame, nodes: DataFrame, steps: int) -> DataFrame:
    """Where each conversation leaves the trie.

    ``waiting`` has ``end, path, words, low``: its first ``low`` turns are a node. Fat binary search
    between ``low`` and the length, of as many steps as the longest open part needs: a handle that is found moves the lower end to its node, if
    the node's turns are the conversation's; one that is not found moves the upper end. Added are
    ``low``, the depth of the deepest node on the way; ``exit_id`` and ``exit_depth``, the edge that is left, if it
    is left inside an edge, and ``leaves``, how many turns it has in common with the trie.
    """
    size = F.size("path")
    now = waiting.withColumn("high", size)
    handles = _handles(nodes)
    for _ in range(steps):
        probe = F.when(F.col("low") < F.col("high"), _at("path", two_fattest(F.col("low"), F.col("high"))))
        hit = now.withColumn("handle", probe).join(handles, "handle", "left")
        fits = (F.col("found") <= size) & (_at("path", F.col("found")) == F.col("found_id"))
        now = hit.select(
            "end", "path", "words",
            F.when(F.col("found").isNotNull() & fits, F.col("found")).otherwise(F.col("low")).alias("low"),
            F.when(F.col("low") >= F.col("high"), F.col("high"))
            .when(F.col("found").isNull(), two_fattest(F.col("low"), F.col("high")) - 1)
            .when(fits, F.col("high")).otherwise(F.col("low")).alias("high"))
    below = nodes.select(F.get("path", F.col("above")).alias("first"), F.col("id").alias("exit_id"),
                         F.col("depth").alias("exit_depth"), F.col("path").alias("exit_path"))
    out = now.withColumn("first", F.when(F.col("low") < size, F.get("path", F.col("low")))).join(below, "first", "left")
    common = _common(F.col("path"), F.col("exit_path"), F.col("low"), F.least(size, F.col("exit_depth")))
    return out.select("end", "path", "words", "low", "exit_id", "exit_depth",
                      F.when(F.col("exit_id").isNull(), F.col("low")).otherwise(common).alias("leaves"))


def insert(nodes: DataFrame, places: DataFrame) -> DataFrame:
    """The trie with edges split where conversations leave or end in them, and with an edge for
    the least conversation of each place and next turn."""
    cuts = places.filter(F.col("exit_id").isNotNull() & (F.col("leaves") > F.col("low"))
                         & (F.col("leaves") < F.col("exit_depth"))).groupBy(F.col("exit_id").alias("id")).agg(
        F.sort_array(F.collect_set("leaves")).alias("cuts"))
    bounds = F.concat(F.array("above"), F.coalesce("cuts", F.array().cast("array<int>")), F.array("depth"))
    pieces = nodes.join(cuts, "id", "left").withColumn("bounds", bounds).select(
        "path", "words", "bounds", F.explode(F.sequence(F.lit(1), F.size("bounds") - 1)).alias("k")).select(
        F.get("bounds", F.col("k") - 1).alias("above"), F.get("bounds", F.col("k")).alias("depth"), "path", "words")
    edges = places.filter(F.size("path") > F.col("leaves")).groupBy(F.get("path", F.col("leaves")).alias("turn")).agg(
        F.min(F.struct("end", "leaves", "path", "words")).alias("least")).select(
        F.col("least.leaves").alias("above"), F.size("least.path").alias("depth"), "least.path", "least.words")
    return pieces.unionByName(edges).select(
        F.get("path", F.col("depth") - 1).alias("id"), "above", "depth",
        F.slice("path", F.lit(1), F.col("depth")).alias("path"), F.slice("words", F.lit(1), F.col("depth")).alias("words"))


def build(contents: DataFrame) -> DataFrame:
    """``id, above, depth, path, words``: the nodes below the root, each with the edge above it.

    ``contents`` has ``end, path, words``, each distinct conversation once. Every batch lengthens the
    known way of each waiting conversation by a turn at least, so there are no more batches than
    nodes on the longest way.
    """
    waiting = cut_lineage(contents.filter(F.size("path") > 0).select("end", "path", "words").withColumn("low", F.lit(0)))
    nodes = waiting.sparkSession.createDataFrame(
        [], "id binary, above int, depth int, path array<binary>, words array<long>")
    steps = 0
    while (most := waiting.agg(F.max(F.size("path") - F.col("low"))).first()[0]) is not None:
        places = cut_lineage(locate(waiting, nodes, steps and (most - 1).bit_length() + 1))
        nodes = cut_lineage(insert(nodes, places))
        # the bringers of new edges are nodes now
        waiting = cut_lineage(places.filter(F.size("path") > F.col("leaves")).select(
            "end", "path", "words", F.col("leaves").alias("low")).join(nodes.select(F.col("id").alias("end")), "end", "left_anti"))
        steps = 1
    return nodes


def joined_digests(members: DataFrame) -> DataFrame:
    """``id, ends_sha256`` of ``id, conv_id``: the SHA-256 of the ids in ascending order with commas between.

    The rows are ordered by range, so many ids of one node spread over tasks, which put runs
    of them together; only the joined runs of a node meet in one task, which reads them one by one.
    """
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, held, size = None, None, [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([node], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(held)])], names=["id", "first", "ids"])

        for batch in batches:
            for own, conv in zip(batch.column("id").to_pylist(), batch.column("conv_id").to_pylist()):
                if held and (own != node or size > CHUNK):
                    yield out()
                    held, size = [], 0
                if not held:
                    node, first = own, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
        if held:
            yield out()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            ids, digests = [], []
            for own, part in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist()):
                if digest is not None and own == node:
                    digest.update(b"," + part.encode())
                    continue
                if digest is not None:
                    ids.append(node)
                    digests.append(digest.hexdigest())
                node, digest = own, hashlib.sha256(part.encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(digests, pa.string())], names=["id", "ends_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["id", "ends_sha256"])

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = cut_lineage(members.select("id", "conv_id").repartitionByRange(parts, "id", "conv_id")
                         .sortWithinPartitions("id", "conv_id").mapInArrow(runs, "id binary, first long, ids string"))
    return joined.repartition(parts, "id").sortWithinPartitions("id", "first").mapInArrow(whole, "id binary, ends_sha256 string")


def node_totals(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """``id, n_convs, conv_id, n_leaves, saved_tokens`` of each node and of the root (``b""``), subtrees included.

    ``ends`` has ``id, n, conv_id``. Each node tells every node above it, and itself, what it adds; the sums
    are taken before the shuffle, so the top of the trie is no hot key.
    """
    parents = nodes.select(_at("path", F.col("above")).alias("id")).distinct().withColumn("inner", F.lit(True))
    own = nodes.join(ends, "id", "left").join(parents, "id", "left").select(
        "path", "words", "above", "depth", F.coalesce("n", F.lit(0)).alias("n"), "conv_id",
        F.col("inner").isNull().cast("long").alias("leaf"))
    until = F.transform(F.sequence(F.lit(0), F.col("depth")), lambda d: F.aggregate(
        F.slice("words", F.lit(1), d), F.lit(0).cast("long"), lambda total, w: total + w))
    # a node at depth d saves, with its subtree, (words from d on) for each conversation that ends
    # in the subtree, less the words of each edge once
    depths = F.concat(F.sequence(F.lit(0), F.col("above")), F.array("depth"))
    each = own.withColumn("until", until).select("path", "above", "depth", "n", "conv_id", "leaf", "until", F.explode(depths).alias("d"))
    since = F.col("until")[F.greatest(F.col("d") - 1, F.lit(0))]
    edge = F.col("until")[F.col("depth")] - F.col("until")[F.least(F.greatest(F.col("above"), F.col("d") - 1), F.col("depth"))]
    added = each.select(_at("path", F.col("d")).alias("id"), "n", "conv_id", "leaf",
                        (F.col("n") * (F.col("until")[F.col("depth")] - since) - edge).alias("saved"))
    at_root = ends.filter(F.length("id") == 0).select("id", "n", "conv_id", F.lit(0).cast("long").alias("leaf"), F.lit(0).cast("long").alias("saved"))
    sums = added.unionByName(at_root).groupBy("id").agg(
        F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    kept = nodes.select("id").unionByName(nodes.sparkSession.range(1).select(F.lit(ROOT).alias("id")))
    return sums.join(kept, "id")


def prefix_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", families: bool = True) -> DataFrame:
    """The trie of all conversations, one row per node, that is per distinct sequence of first turns:
    ``node`` (digest of the sequence, empty for the root), ``depth, conv_id`` (smallest member),
    ``parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    With ``families`` each conversation c is rebuilt first: crc32(c) mod 4 turns of conversation c - c mod 20, then
    its own turns behind as many. Null roles and texts are empty, null turns come first, and turns of one
    number are in the order of role and digest; a repeated row is a repeated turn. Rows without a conversation id belong
    to no conversation and are left out. Equal conversations are inserted once and counted each. A conversation without
    turns is a member of the root. Other columns are ignored whatever their names. No rows, no result.
    The turns of one conversation (40 bytes each) must fit a task.
    """
    convs = in_order(turn_rows(conversations, id_col, turn_col, role_col, text_col))
    if families:
        convs = rebuilt(cut_lineage(convs))
    paths = with_paths(convs)
    end = F.coalesce(F.element_at("path", F.when(F.size("path") > 0, -1)), F.lit(ROOT))
    rows = cut_lineage(paths.withColumn("end", end))
    contents = rows.groupBy("end").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.min(F.struct("path", "words")).alias("c"))
    contents = cut_lineage(contents.select("end", "n", "conv_id", "c.path", "c.words"))
    nodes = build(contents)
    totals = cut_lineage(node_totals(nodes, contents.select(F.col("end").alias("id"), "n", "conv_id")))
    parent = nodes.select("id", "above", "depth", "words", "path", _at("path", F.col("above")).alias("parent"))
    children = parent.groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    above = totals.select(F.col("id").alias("parent"), F.col("conv_id").alias("above_conv_id"))
    # expand the edges: the nodes inside one have its members, one child and no end
    each = parent.join(totals, "id").join(children, "id", "left").join(above, "parent").withColumn(
        "d", F.explode(F.sequence(F.col("above") + 1, F.col("depth"))))
    behind = F.aggregate(F.slice("words", F.col("d"), F.col("depth") - F.col("d")), F.lit(0).cast("long"), lambda t, w: t + w)
    inside = F.col("d") < F.col("depth")
    below_root = each.select(
        F.get("path", F.col("d") - 1).alias("node"), F.col("d").cast("long").alias("depth"), "conv_id",
        F.when(F.col("d") > F.col("above") + 1, F.col("conv_id")).otherwise(F.col("above_conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(inside, 1).otherwise(F.coalesce("n_children", F.lit(0))).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * behind).alias("saved_tokens"))
    none = F.lit(None).cast("long")
    root = totals.filter(F.length("id") == 0).join(children, "id", "left").select(
        F.col("id").alias("node"), F.lit(0).cast("long").alias("depth"), "conv_id", none.alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), F.when(F.col("n_children").isNull(), 1).otherwise(F.col("n_leaves")).alias("n_leaves"),
        "saved_tokens")
    digests = joined_digests(rows.select(F.col("end").alias("id"), "conv_id")).withColumnRenamed("id", "node")
    return below_root.unionByName(root).join(digests, "node", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
