"""Exact similarity join of texts by the Jaccard distance of their word shingles (operator 5).

The distance of shingle sets is a metric. Almost all sets are at distance one from each
other and from any few pivots, so regions around sampled documents would not separate them;
the pivots have to lie among the documents. This is done in three exact steps:

* Every shingle is a pivot, and a document's nearest pivots are its own shingles. In one global
  order, two sets within the threshold have a common shingle among their first
  ``size - ceil(t * size) + 1``: a document is replicated to the regions of these, and no
  further. Shingles that many documents share come last in the order, so that
  a passage found everywhere is hardly ever a region.
* Inside a region, sets whose sizes are too far apart cannot be near: a chain of near sizes is
  a cell, its smallest document the pivot. Cells of one pivot are one cell, to which a
  document's text goes once.
* A cell first compares short vectors: how many shingles of a set fall into each of some classes.
  Their L1 distance is at most the sets' symmetric difference, so a document whose vector is
  too far from all others of the cell has no link there, and its text is not fetched.
* What is left of a cell is joined by its pivots and the triangle inequality (``join_cell``). A
  cell too large for one task is split into pairs of blocks.

What leaves a cell is a spanning forest of the links found; the classes are their connected
components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opinara.llm.components import components
from opinara.llm.tokenization import ragged
from opinara.llm.words import LOWER, Sums, buffers, mix64, spans
from opinara.session import cut_lineage

#: Words of a shingle; two sets link when 100 * common >= PERCENT * all.
WORDS, PERCENT = 4, 85
#: A shingle is common when it is in this share of the documents, and in so many. Bounded: at
#: most (average shingles of a document) / COMMON_SHARE shingles are.
COMMON_SHARE, COMMON_LEAST = 1 / 8000, 16
#: Classes of shingles, a power of two, and the largest count that is told apart. In large sets
#: chance fills few classes evenly: sets from ``LARGE`` on are also told apart by finer classes.
CLASSES, FINE, LARGE, MOST = 128, 2048, 3000, (1 << 16) - 1
#: Documents of a cell that one task joins; a larger cell is split into pairs of blocks.
CELL_DOCS = 4_000
#: Up to so many copies or candidates (at most 32 bytes each) are broadcast.
BROADCAST_IDS = 1_000_000
BATCH_BYTES = 1 << 20
#: Shingles a task counts before it folds them, and distinct ones it keeps before it drops those met once.
FOLD, KEEP = 500_000, 1_000_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle, offsets): the distinct shingle hashes of each text in ascending order."""
    data = LOWER[data]
    start, end, text = spans(data, offsets)
    h = Sums(data).hash(start, end)
    n = len(offsets) - 1
    last = max(len(h) - words + 1, 0)
    z = np.zeros(last, np.uint64)
    for k in range(words):
        z = mix64(z + h[k:last + k] + np.uint64(k + 1))
    own = text[:last]
    whole = own == text[words - 1:words - 1 + last]
    z, own = z[whole], own[whole]
    # fewer words: the whole sequence is one shingle
    count = np.bincount(text, minlength=n)
    few = np.flatnonzero((count > 0) & (count < words))
    first = np.searchsorted(text, few)
    short = count[few].astype(np.uint64) + np.uint64(1000)
    for k in range(words - 1):
        more = count[few] > k
        short[more] = mix64(short[more] + h[first[more] + k])
    z, own = np.concatenate([z, short]), np.concatenate([own, few])
    order = np.lexsort((z, own))
    z, own = z[order], own[order]
    fresh = np.ones(len(z), bool)
    fresh[1:] = (z[1:] != z[:-1]) | (own[1:] != own[:-1])
    z, own = z[fresh], own[fresh]
    return z, np.searchsorted(own, np.arange(n + 1))


def common_shingles(rows: DataFrame, words: int) -> np.ndarray:
    """Shingles of many documents, ascending; counted in tasks, summed over all documents.

    Only the order of the regions rests on it, never the result.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs = [], 0
        keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def fold() -> None:
            nonlocal keys, n
            k, c = np.unique(np.concatenate(held), return_counts=True) if held else (keys[:0], n[:0])
            k, inverse = np.unique(np.concatenate([keys, k]), return_inverse=True)
            n, keys = np.bincount(inverse, np.concatenate([n, c]), len(k)).astype(np.int64), k
            held.clear()

        for batch in batches:
            docs += len(batch)
            for _, data, offsets in buffers(batch.column("text"), BATCH_BYTES):
                held.append(shingle_sets(data, offsets, words)[0])
                if sum(map(len, held)) > FOLD:
                    fold()
                    if len(keys) > KEEP:  # the order may miss a shingle that is common elsewhere
                        keys, n = keys[n > 1], n[n > 1]
        fold()
        often = n >= max(2, docs * COMMON_SHARE / 2)
        yield pa.RecordBatch.from_arrays([pa.array(keys[often].astype(np.int64)), pa.array(n[often])], names=["s", "n"])

    least = max(COMMON_LEAST, rows.count() * COMMON_SHARE)
    found = rows.select("text").mapInArrow(count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    table = found.filter(F.col("n") >= least).select("s").toArrow()["s"]
    return np.sort(np.asarray(table.combine_chunks(), np.int64).astype(np.uint64))


def class_counts(shingles: np.ndarray) -> np.ndarray:
    """Shingles per class by their first bits: ``FINE`` classes of a large set, else ``CLASSES``."""
    classes = FINE if len(shingles) >= LARGE else CLASSES
    shift = np.uint64(64 - (classes - 1).bit_length())
    return np.minimum(np.bincount((shingles >> shift).astype(np.int64), minlength=classes), MOST).astype("<u2")


def features(rows: DataFrame, common: np.ndarray, words: int, percent: int) -> DataFrame:
    """``doc_id, n, key_a, key_b, regions, counts``: the set's size and digest, its regions,
    and its shingles per class."""
    shared = rows.sparkSession.sparkContext.broadcast(common)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        for batch in batches:
            for first, data, offsets in buffers(batch.column("text"), BATCH_BYTES):
                z, at = shingle_sets(data, offsets, words)
                n = np.diff(at)
                text = np.repeat(np.arange(len(n)), n)
                # sums over the set: order does not matter, every shingle does
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix64(z + np.uint64(salt)))]) for salt in (1, 2)]
                keys = [(s[at[1:]] - s[at[:-1]]).astype(np.int64) for s in sums]
                counts = [class_counts(z[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])]
                if len(common):
                    place = np.searchsorted(common, z)
                    place[place == len(common)] = 0
                    order = np.lexsort((z, common[place] == z, text))
                    z = z[order]
                window = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
                chosen = z[ragged(at[:-1], window)].astype(np.int64)
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(window)]).astype(np.int32), chosen)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(n)), pa.array(n), *map(pa.array, keys), lists,
                     pa.array(counts, pa.binary())], names=["doc_id", "n", "key_a", "key_b", "regions", "counts"])

    return rows.mapInArrow(
        make, "doc_id long, n long, key_a long, key_b long, regions array<long>, counts binary")


def cells(entries: DataFrame, percent: int) -> DataFrame:
    """``(cell, doc)`` from ``(region, doc, n)``: documents that may be near the cell's pivot."""

    def chains(region: np.ndarray, doc: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((n, region))
        region, doc, n = region[order], doc[order], n[order]
        begins = np.ones(len(doc), bool)
        begins[1:] = (region[1:] != region[:-1]) | (100 * n[:-1] < percent * n[1:])
        first = np.flatnonzero(begins)
        size = np.diff(np.append(first, len(doc)))
        cell = np.repeat(np.minimum.reduceat(doc, first), size) if len(doc) else doc
        several = np.repeat(size > 1, size)
        pairs = np.unique(np.column_stack([cell[several], doc[several]]), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["cell", "doc"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            now = [np.asarray(batch.column(c), np.int64) for c in ("region", "doc", "n")]
            if not len(now[0]):
                continue
            held.append(now)
            if now[0][0] == now[0][-1] and held[0][0][0] == now[0][0]:
                continue  # still one region
            region, doc, n = (np.concatenate(parts) for parts in zip(*held))
            open_from = np.searchsorted(region, region[-1])  # the last region may go on
            held = [[region[open_from:], doc[open_from:], n[open_from:]]]
            yield chains(region[:open_from], doc[:open_from], n[:open_from])
        if held:
            yield chains(*(np.concatenate(parts) for parts in zip(*held)))

    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (entries.repartition(parts, "region").sortWithinPartitions("region")
            .mapInArrow(make, "cell long, doc long").distinct())


def may_link(n: np.ndarray, counts: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of a cell may link with another by size and by counts per class.

    ``100 * common >= percent * all`` is the same as
    ``(100 + percent) * difference <= (100 - percent) * (size + size)`` for the symmetric
    difference, which is at least the L1 distance of the counts.
    """
    order = np.argsort(n, kind="stable")
    n, counts = n[order], [counts[i].astype(np.int32) for i in order]
    coarse = np.array([np.minimum(c.reshape(CLASSES, -1).sum(axis=1), MOST) for c in counts])
    last = np.searchsorted(n, n * 100 // percent, side="right")
    out = np.zeros(len(n), bool)
    for i in range(len(n) - 1):
        j = slice(i + 1, last[i])
        near = (100 + percent) * np.abs(coarse[j] - coarse[i]).sum(axis=1) <= (100 - percent) * (n[j] + n[i])
        if len(counts[i]) == FINE:  # and so are the larger ones behind it
            for k in np.flatnonzero(near):
                apart = int(np.abs(counts[i + 1 + k] - counts[i]).sum())
                near[k] = (100 + percent) * apart <= (100 - percent) * (n[i] + n[i + 1 + k])
        if near.any():
            out[i] = True
            out[j] |= near
    back = np.empty(len(n), bool)
    back[order] = out
    return back


def prune_cells(members: DataFrame, percent: int) -> DataFrame:
    """``(cell, part, doc)`` of those of ``(cell, part, doc, n, counts)`` that may link."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close(rows: pa.Table) -> pa.RecordBatch:
            cell, part, doc, n = (np.asarray(rows[c].combine_chunks(), np.int64) for c in ("cell", "part", "doc", "n"))
            counts = [np.frombuffer(c, "<u2") for c in rows["counts"].to_pylist()]
            begins = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (part[1:] != part[:-1])])
            keep = np.zeros(len(doc), bool)
            for a, b in zip(begins, [*begins[1:], len(doc)]):
                keep[a:b] = may_link(n[a:b], counts[a:b], percent)
            return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (cell, part, doc)], names=["cell", "part", "doc"])

        def ends(batch: pa.RecordBatch, i: int) -> tuple:
            return batch.column("cell")[i].as_py(), batch.column("part")[i].as_py()

        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            if ends(batch, 0) == ends(batch, -1) == ends(held[0], 0):
                continue  # still one cell
            rows = pa.Table.from_batches(held)
            cells, parts = (np.asarray(rows[c].combine_chunks(), np.int64) for c in ("cell", "part"))
            open_from = int(np.flatnonzero((cells == cells[-1]) & (parts == parts[-1]))[0])  # may go on
            yield close(rows.slice(0, open_from))
            held = rows.slice(open_from).combine_chunks().to_batches()
        if held:
            yield close(pa.Table.from_batches(held))

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (members.repartition(parts, "cell", "part").sortWithinPartitions("cell", "part", "doc")
            .mapInArrow(make, "cell long, part long, doc long"))


def join_cell(sets: list[np.ndarray], labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Spanning links (label, label) of all links between the sets of one cell.

    A set that is expanded is compared with all others. What lies within the threshold r of an
    expanded pivot is linked to it and need not be expanded itself: by the triangle inequality
    its links outside that ball lie within 2r of the pivot, so only the sets between r and 2r
    are expanded as well, unless they have joined the pivot's class by then.
    """
    m = len(sets)
    root = list(range(m))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []

    def link(i: int, j: int) -> None:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            if labels[i] != labels[j]:
                links.append((int(labels[i]), int(labels[j])))

    sizes = np.array([len(s) for s in sets], np.int64)
    if m == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        if 100 * common >= percent * (sizes.sum() - common):
            link(0, 1)
        return links
    ids, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), sizes)
    at = np.cumsum(sizes) - sizes
    by_id = np.argsort(inverse, kind="stable")
    postings, df = owner[by_id], np.bincount(inverse, minlength=len(ids))
    begin = np.cumsum(df) - df
    retired = np.zeros(m, bool)
    expanded = np.zeros(m, bool)
    wanted: dict[int, list[int]] = {}

    def expand(i: int) -> None:
        expanded[i] = retired[i] = True
        own = inverse[at[i]:at[i] + sizes[i]]
        common = np.bincount(postings[ragged(begin[own], df[own])], minlength=m)
        union = sizes + sizes[i] - common
        near = 100 * common >= percent * union
        near[i] = False
        ball = np.flatnonzero(near)
        for j in ball:
            link(i, j)
        if len(ball):
            # distance at most 2r: common / union >= 2 * percent / 100 - 1
            shell = ~near & (100 * common >= (2 * percent - 100) * union) & ~expanded
            for j in np.flatnonzero(shell):
                wanted.setdefault(int(j), []).append(i)
            retired[ball] = True

    for i in range(m):
        if not retired[i]:
            expand(i)
    while wanted:
        j, pivots = wanted.popitem()
        if not expanded[j] and any(find(p) != find(j) for p in pivots):
            expand(j)
    return links


def links_in_cells(members: DataFrame, words: int, percent: int) -> DataFrame:
    """``(a, b)`` from ``(cell, part, doc, text)``; a cell's parts are joined one by one."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, docs, sets = None, [], []

        def close() -> list[tuple[int, int]]:
            order = sorted(range(len(docs)), key=lambda i: (docs[i], len(sets[i])))
            return join_cell([sets[i] for i in order], np.array(docs)[order], percent) if len(docs) > 1 else []

        for batch in batches:
            found: list[tuple[int, int]] = []
            keys = list(zip(batch.column("cell").to_pylist(), batch.column("part").to_pylist()))
            doc = batch.column("doc").to_pylist()
            for first, data, offsets in buffers(batch.column("text"), BATCH_BYTES):
                z, at = shingle_sets(data, offsets, words)
                for i in range(len(offsets) - 1):
                    if keys[first + i] != key:
                        found += close()
                        key, docs, sets = keys[first + i], [], []
                    docs.append(doc[first + i])
                    sets.append(z[at[i]:at[i + 1]].copy())
            if found:
                yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found])
        if last := close():
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in last])

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (members.repartition(parts, "cell", "part").sortWithinPartitions("cell", "part", "doc")
            .mapInArrow(make, "a long, b long"))


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``.

    A document's set are its distinct shingles of ``words`` lower-cased (A-Z) words between
    ASCII white space; a text of fewer words is one shingle. Two documents link when
    ``100 * common >= percent * all``; ``component_id`` is the smallest id reachable.

    Null, empty and blank texts have no shingle and stand alone. Rows of one id are one
    document. A null id names no class: such a row gets the class of the documents with the
    same set, null if there is none, and links no others. Other columns are ignored whatever
    their names. No rows, no result.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    made = cut_lineage(features(rows, common_shingles(rows, words), words, percent))
    sets = made.filter("n > 0")
    key = ["key_a", "key_b", "n"]
    # one document stands for all with the same set
    reps = cut_lineage(sets.groupBy(*key).agg(F.min("doc_id").alias("rep")).filter("rep IS NOT NULL"))
    # the others leave; few copies are broadcast, so that the regions stay where they are
    copies = cut_lineage(sets.select("doc_id", *key).join(reps, key).filter("doc_id <> rep").select("doc_id", *key).distinct())
    standing = sets.filter("doc_id IS NOT NULL").join(
        F.broadcast(copies) if copies.count() <= BROADCAST_IDS else copies, ["doc_id", *key], "left_anti")
    entries = standing.select(F.explode("regions").alias("region"), F.col("doc_id").alias("doc"), "n")
    member = cut_lineage(cells(entries, percent))
    # a large cell is split into blocks; each pair of blocks is joined, with the pivot in both
    size = member.groupBy("cell").agg(F.count(F.lit(1)).alias("m")).withColumn(
        "g", F.ceil(F.col("m") * 2 / CELL_DOCS))
    large = cut_lineage(size.filter(F.col("m") > CELL_DOCS).select("cell", "g"))
    block = F.pmod(F.xxhash64("doc"), F.col("g"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("g") - 1))
    split = member.join(large, "cell").withColumn("b", block).withColumn("o", other).select(
        "cell", (F.least("b", "o") * F.col("g") + F.greatest("b", "o")).alias("part"), "doc")
    placed = member.join(large, "cell", "left_anti").select("cell", F.lit(0).cast("bigint").alias("part"), "doc").unionByName(split)
    vectors = standing.select(F.col("doc_id").alias("doc"), "n", "counts")
    placed = cut_lineage(prune_cells(placed.join(vectors, "doc"), percent))
    wanted = placed.select(F.col("doc").alias("doc_id")).distinct()
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = rows.join(wanted, "doc_id", "left_semi").select(F.col("doc_id").alias("doc"), "text").filter("text <> ''")
    found = links_in_cells(placed.join(texts, "doc"), words, percent)
    roots = components(found)
    classes = reps.join(roots, F.col("rep") == F.col("node"), "left").select(
        *key, F.coalesce("root", "rep").alias("component_id"))
    known = sets.select("doc_id", *key).join(classes, key, "left").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = made.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return known.unionByName(alone)


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class, the one of the smallest id; all columns kept.

    Documents without a shingle and rows with a null id stay, as do all rows of an id that
    stays.
    """
    gone = jaccard_components(docs, words, percent, id_col, text_col).filter("doc_id <> component_id")
    gone = gone.select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
