"""Toxicity by a chain of classifiers (operator 8).

Categories are predicted one after the other. Each has a linear model over the words and word
beginnings that tell its labels apart, and over the probabilities of the categories before
it. Those are out-of-fold in training: a model learns from predictions as uncertain as the
ones it will get.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from opinara.llm.words import LOWER, NOT_WORD, Sums, buffers, spans
from opinara.session import cut_lineage

#: Labelled documents that are learned from, about (chosen by a hash of their id).
MAX_TRAINING = 12_000
#: Documents a feature must occur in, folds.
MIN_DOCS, FOLDS = 5, 5
#: Least log-likelihood ratio of a feature: one in 10,000 that tells nothing reaches it.
MIN_RATIO = 7.6
#: Bytes of the word beginnings that are features beside whole words.
BEGINNINGS = (4, 5, 6)
RIDGE = 0.1
#: A fit ends when no entry of the gradient is larger; Newton steps, and inner steps of each, at most.
FLAT, STEPS, INNER_STEPS = 1e-2, 50, 200
BATCH_BYTES = 1 << 20
#: Documents of the sample whose entries are numbers of eight bytes at once.
BLOCK = 1024
_SPACE = 1 << 30


@dataclass
class Link:
    """One category: feature hashes in ascending order, weights, those of earlier ones, bias."""

    name: str
    features: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    earlier: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    threshold: float = 2.0  # above every probability: nothing is rejected

    def score(self, has: Sparse, before: np.ndarray) -> np.ndarray:
        return _sigmoid(has.times(self.weights) + _logit(before) @ self.earlier + self.bias)


@dataclass
class Sparse:
    """Which feature each text has: text i has ``at[begins[i]:begins[i + 1]]``, each once."""

    width: int
    begins: np.ndarray
    at: np.ndarray

    @property
    def n(self) -> int:
        return len(self.begins) - 1

    def blocks(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """(texts, text of each entry, its feature) some texts at a time: what is wide is short-lived."""
        for first in range(0, self.n, BLOCK):
            own = self.begins[first:first + BLOCK + 1]
            yield (slice(first, first + len(own) - 1), np.repeat(np.arange(len(own) - 1), np.diff(own)),
                   self.at[own[0]:own[-1]].astype(np.int64))

    def times(self, weights: np.ndarray) -> np.ndarray:
        """The sum of the weights of each text's features."""
        out = np.zeros(self.n)
        for texts, text, at in self.blocks():
            out[texts] = np.bincount(text, weights[at], texts.stop - texts.start)
        return out

    def back(self, values: np.ndarray) -> np.ndarray:
        """The sum of the values of each feature's texts."""
        out = np.zeros(self.width)
        for texts, text, at in self.blocks():
            out += np.bincount(at, values[texts][text], self.width)
        return out

    def columns(self, which: np.ndarray) -> Sparse:
        """The features at the ascending places ``which``."""
        place = np.full(self.width, -1, np.int32)
        place[which] = np.arange(len(which))
        kept = place[self.at]
        begins = np.concatenate([[0], np.cumsum(kept >= 0)])[self.begins]
        return Sparse(len(which), begins, kept[kept >= 0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def features_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text) of every word and word beginning; a text may repeat them."""
    data = LOWER[data]
    start, end, text = spans(data, offsets, NOT_WORD)
    sums = Sums(data)
    found, texts = [sums.hash(start, end)], [text]
    for length in BEGINNINGS:
        long = end - start > length
        # a beginning is another feature than a word of the same letters
        found.append(sums.hash(start[long], start[long] + length) + np.uint64(length))
        texts.append(text[long])
    return np.concatenate(found), np.concatenate(texts)


def _distinct(features: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((features, texts))
    features, texts = features[order], texts[order]
    first = np.ones(len(features), bool)
    first[1:] = (features[1:] != features[:-1]) | (texts[1:] != texts[:-1])
    return features[first], texts[first]


def _presence(data: np.ndarray, offsets: np.ndarray, features: np.ndarray) -> Sparse:
    """Which of the features each text has."""
    n = len(offsets) - 1
    if not len(features):
        return Sparse(0, np.zeros(n + 1, np.int64), np.zeros(0, np.int32))
    found, texts = features_of(data, offsets)
    at = np.searchsorted(features, found)
    at[at == len(features)] = 0
    known = features[at] == found
    pairs = np.unique(texts[known].astype(np.int64) * len(features) + at[known])
    begins = np.searchsorted(pairs, np.arange(n + 1) * len(features))
    return Sparse(len(features), begins, (pairs % len(features)).astype(np.int32))


def _fit(has: Sparse | np.ndarray, label: np.ndarray, more: np.ndarray | None = None,
         start: np.ndarray | None = None, part: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on the columns of both, of the texts of ``part`` if given; (weights, bias).

    Newton steps whose equations are solved by conjugate gradients: what is held is the entries
    and a few vectors, never features times features. ``start`` is a guess (weights and bias).
    """
    if isinstance(has, np.ndarray):
        has = Sparse(has.shape[1], np.concatenate([[0], np.cumsum((has != 0).sum(axis=1))]), np.nonzero(has)[1].astype(np.int32))
    part = np.ones(has.n) if part is None else part.astype(float)  # leaving texts out copies nothing
    more = np.column_stack([np.zeros((has.n, 0)) if more is None else more, np.ones(has.n)])
    width = has.width
    penalty = np.full(width + more.shape[1], RIDGE)
    penalty[-1] = 1e-6

    def linear(w: np.ndarray) -> np.ndarray:
        return has.times(w[:width]) + more @ w[width:]

    def back(r: np.ndarray) -> np.ndarray:
        return np.concatenate([has.back(r), more.T @ r])

    def loss(w: np.ndarray, z: np.ndarray) -> float:
        return float(part @ np.logaddexp(0, z) - (part * label) @ z + 0.5 * (penalty * w * w).sum())

    w = np.zeros(len(penalty)) if start is None else start.copy()
    if start is None:
        w[-1] = _logit(np.array([part @ label / part.sum()]))[0]
    z = linear(w)
    now = loss(w, z)
    for _ in range(STEPS):
        p = _sigmoid(z)
        gradient = back(part * (p - label)) + penalty * w
        steepest = np.abs(gradient).max()
        if steepest < FLAT:
            break
        curve = part * p * (1 - p)
        diagonal = np.concatenate([has.back(curve), np.square(more).T @ curve]) + penalty
        # step solves (X' curve X + penalty) step = gradient, as well as the gradient is small
        step, rest = np.zeros(len(w)), gradient.copy()
        scaled = rest / diagonal
        way, size = scaled.copy(), rest @ scaled
        for _ in range(INNER_STEPS):
            bent = back(curve * linear(way)) + penalty * way
            length = size / (way @ bent)
            step += length * way
            rest -= length * bent
            if np.abs(rest).max() < min(0.1, steepest) * steepest:
                break
            scaled = rest / diagonal
            before, size = size, rest @ scaled
            way = scaled + size / before * way
        moved = linear(step)
        scale = 1.0
        while scale > 1e-3 and loss(w - scale * step, z - scale * moved) > now:  # a full step may go too far
            scale /= 2
        w, z = w - scale * step, z - scale * moved
        before, now = now, loss(w, z)
        if before - now < 1e-9 * abs(before):
            break
    return w[:-1], float(w[-1])


def _best_threshold(p: np.ndarray, label: np.ndarray) -> float:
    """The middle of the gap below the probabilities that give the best F1."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(label[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + label.sum())
    last = np.ones(len(p), bool)
    last[:-1] = p[order][:-1] != p[order][1:]  # equal probabilities fall on one side
    best = int(np.argmax(np.where(last, f1, -1)))
    below = p[order][best + 1] if best + 1 < len(p) else 0.0
    return float((p[order][best] + below) / 2)


def training_sample(docs: DataFrame, labels: DataFrame, categories: dict[str, Column],
                    id_col: str, text_col: str) -> DataFrame:
    """``text, fold, y0, y1, ...`` of a bounded sample of the labelled documents."""
    named = labels.select(F.col(id_col).alias("_id"), *[c.cast("int").alias(f"y{k}")
                                                        for k, c in enumerate(categories.values())])
    ys = [c for c in named.columns if c != "_id"]
    named = named.na.drop().groupBy("_id").agg(*[F.max(y).alias(y) for y in ys])
    share = min(_SPACE, _SPACE * MAX_TRAINING // max(named.count(), 1))
    chosen = named.filter(F.pmod(F.xxhash64("_id"), F.lit(_SPACE)) < share).limit(2 * MAX_TRAINING)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # at most twice MAX_TRAINING rows of a few numbers
    return cut_lineage(rows.join(F.broadcast(chosen), "_id").select(
        "text", F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(FOLDS)).cast("int").alias("fold"), *ys))


def _choose_features(sample: DataFrame, n_categories: int) -> list[np.ndarray]:
    """Per category the features that most surely depend on its label."""
    ys = [f"y{k}" for k in range(n_categories)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = [np.asarray(batch.column(y), np.int64) for y in ys]
            for first, data, offsets in buffers(batch.column("text"), BATCH_BYTES):
                found, texts = _distinct(*features_of(data, offsets))
                keys, inverse = np.unique(found, return_inverse=True)
                sums = [np.bincount(inverse, None if y is None else y[first + texts], len(keys)).astype(np.int64)
                        for y in (None, *label)]
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), *map(pa.array, sums)],
                                                 names=["feature", "n", *ys])

    counts = cut_lineage(sample.mapInArrow(count, ", ".join(["feature long", "n long", *[f"{y} long" for y in ys]]))
                         .groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("n", *ys)]).filter(F.col("n") >= MIN_DOCS))
    total = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(y).alias(y) for y in ys]).first()
    chosen = []
    n = F.lit(float(total["n"] or 0))
    for y in ys:
        # log-likelihood ratio of the two-by-two table of feature and label
        ones, has = F.lit(float(total[y] or 0)), F.col("n").cast("double")
        both = F.col(y).cast("double")
        cells = ((both, has * ones), (has - both, has * (n - ones)), (ones - both, (n - has) * ones),
                 (n - has - ones + both, (n - has) * (n - ones)))
        sure = F.lit(0.0)
        for seen, expected in cells:
            sure = sure + F.when((seen > 0) & (expected > 0), seen * F.ln(seen * n / expected)).otherwise(0.0)
        top = counts.select("feature", F.round(sure, 6).alias("sure")).filter(F.col("sure") >= MIN_RATIO)
        chosen.append(np.sort(np.asarray(top.select("feature").toArrow()["feature"].combine_chunks(),
                                         np.int64).astype(np.uint64)))
    return chosen


def train_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, Column],
                id_col: str = "doc_id", text_col: str = "text") -> list[Link]:
    """Models of ``categories`` (name to a 0/1 column of ``labels``), in their order.

    Learned from about ``MAX_TRAINING`` labelled documents; what reaches the driver is, per
    document of that sample, the list of the chosen features it has. Labels with a null in a category
    are left out, repeated ones count as 1 if one of them is. A category whose sample has one
    label only gets that rate as its constant probability and rejects nothing.
    """
    sample = training_sample(docs, labels, categories, id_col, text_col)
    chosen = _choose_features(sample, len(categories))
    ys = [f"y{k}" for k in range(len(categories))]
    every = np.unique(np.concatenate(chosen)) if chosen else np.zeros(0, np.uint64)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in buffers(batch.column("text"), BATCH_BYTES):
                n = len(offsets) - 1
                has = _presence(data, offsets, every)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(has.begins.astype(np.int32), has.at), *[batch.column(c).slice(first, n) for c in ("fold", *ys)]],
                    names=["has", "fold", *ys])

    table = sample.mapInArrow(vectors, ", ".join(["has array<int>", "fold int", *[f"{y} int" for y in ys]])).toArrow()
    size = len(table)
    # in one order whatever the partitions were: the fit sums in it
    lists = [np.asarray(x.values, np.int32) for x in table["has"]]
    others = [table[c].to_pylist() for c in ("fold", *ys)]
    order = sorted(range(size), key=lambda i: (lists[i].tobytes(), *[o[i] for o in others]))
    lists = [lists[i] for i in order]
    has = Sparse(len(every), np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64),
                 np.concatenate([np.zeros(0, np.int32), *lists]))
    del lists
    table = table.drop(["has"])
    fold = np.asarray(table["fold"].combine_chunks(), np.int64)[order] if size else np.zeros(0, np.int64)
    before = np.zeros((size, 0))
    chain = []
    for k, name in enumerate(categories):
        link = Link(name, chosen[k], np.zeros(len(chosen[k])), np.zeros(k))
        label = np.asarray(table[ys[k]].combine_chunks(), float)[order] if size else np.zeros(0)
        held = np.full(len(label), label.mean() if len(label) else 0.0)
        if 0 < label.sum() < len(label):
            x, more = has.columns(np.searchsorted(every, link.features)), _logit(before)
            w, link.bias = _fit(x, label, more)
            link.weights, link.earlier = w[:len(link.features)], w[len(link.features):]
            for f in range(FOLDS):
                rest = fold != f
                if rest.any() and not rest.all() and 0 < label[rest].sum() < rest.sum():
                    # the whole fit is where the search starts, not what it finds
                    w, bias = _fit(x, label, more, np.append(w, link.bias), rest)
                    own = Link(name, link.features, w[:len(link.features)], w[len(link.features):], bias)
                    held[~rest] = own.score(x, before)[~rest]
            link.threshold = _best_threshold(held, label)
        elif len(label):
            link.bias = float(_logit(label[:1])[0])
        else:
            link.bias = -30.0
        before = np.column_stack([before, held])
        chain.append(link)
    return chain


def predict_chain(docs: DataFrame, chain: list[Link], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, p_<category>..., rejected)`` per row, from the whole text.

    A row is rejected when the last category's probability is above the threshold that was
    best in training; one that meets it is not. No rows, no result. Null text counts as empty and has no feature. Repeated rows and null
    ids are judged row by row; other columns are ignored whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = [f"p_{link.name}" for link in chain]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.unique(np.concatenate([link.features for link in chain]))
        columns = [np.searchsorted(every, link.features) for link in chain]
        for batch in batches:
            for first, data, offsets in buffers(batch.column("text"), BATCH_BYTES):
                n = len(offsets) - 1
                has = _presence(data, offsets, every)
                before = np.zeros((n, 0))
                for link, own in zip(chain, columns):
                    before = np.column_stack([before, link.score(has.columns(own), before)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, n), *[pa.array(before[:, k].copy()) for k in range(len(chain))],
                     pa.array(before[:, -1] > chain[-1].threshold)], names=["doc_id", *names, "rejected"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predict, ", ".join([f"doc_id {kind}", *[f"{n} double" for n in names], "rejected boolean"]))


#: The chain over the columns of the label table: doubtful quality first, then toxicity.
def label_categories() -> dict[str, Column]:
    return {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train the chain on ``labels`` and judge every row of ``docs``."""
    return predict_chain(docs, train_chain(docs, labels, label_categories()))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rejected documents, all columns kept; null ids stay."""
    judged = toxicity(docs, labels).filter("rejected").select(F.col("doc_id").alias("_toxic")).distinct()
    return docs.join(judged, docs["doc_id"] == judged["_toxic"], "left_anti")
