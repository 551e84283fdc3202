"""Pseudo-likelihood of documents under a bidirectional window network.

Every word is predicted from the words on both of its sides, as if it were masked. The network (numpy) has an embedding for each place
in the window and word, a tanh layer of their sum, and a two-level softmax: over classes of words, then over the
words of the class. Frequent words are words of their own, the others share buckets by hash; a word of a bucket gets
its own exact share of the bucket's probability, its count over the bucket's. Counts of the next ``HELD`` words go to every task,
those of all others are joined to the documents' words.

Word counts cover the corpus and are added up by Spark. Training is data-parallel: each task starts from the same
network, makes one pass over its own documents, and the networks are averaged by the tokens they saw, block by
block of parameters.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.llm import arrowtext
from waterline.sources.storage import materialise


#: Words of the buckets, most frequent first, whose counts every task holds.
HELD = 1 << 16
#: Logarithms of joined counts are added up in whole parts of this size, so that their order does not matter.
SHARE_UNIT = 1e9


@dataclass(frozen=True)
class Window:
    """``classes`` times ``per_class`` words, of which ``rare`` are buckets; ``side`` words of context on each side."""

    classes: int = 16
    per_class: int = 32
    rare: int = 128
    side: int = 2
    width: int = 16
    batch: int = 4096
    rate: float = 2.0
    block: int = 4096
    seed: int = 5

    @property
    def size(self) -> int:
        return self.classes * self.per_class


@dataclass
class Vocabulary:
    """Frequent words by descending count (hashes), log number of distinct words of each id, and smoothed counts.

    ``held`` are the next words (hashes, ascending) with the log of their counts; ``beyond`` is the number of all other words.
    """

    frequent: np.ndarray
    log_types: np.ndarray
    counts: np.ndarray
    held: np.ndarray
    held_log: np.ndarray
    beyond: int

    def __post_init__(self) -> None:
        self.order = np.argsort(self.frequent)
        self.sorted = self.frequent[self.order]

    def ids(self, hashes: np.ndarray, how: Window) -> np.ndarray:
        own = how.size - how.rare
        ids = own + (hashes % np.uint64(how.rare)).astype(np.int64)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
            ids = np.where(self.sorted[at] == hashes, self.order[at], ids)
        return ids

    def shares(self, hashes: np.ndarray, ids: np.ndarray, how: Window) -> tuple[np.ndarray, np.ndarray]:
        """Log share of each word in its bucket, and which of them still lack the log of their own count."""
        own = how.size - how.rare
        shared, held = ids >= own, np.zeros(len(ids), dtype=bool)
        logs = np.where(shared, -np.log(np.maximum(self.counts[ids] - 1, 1)), 0.0)
        if len(self.held):
            at = np.minimum(np.searchsorted(self.held, hashes), len(self.held) - 1)
            held = shared & (self.held[at] == hashes)
            logs[held] += self.held_log[at[held]]
        return logs, shared & ~held


class Network:
    """Parameters as one flat vector, with named views into it."""

    def __init__(self, how: Window, flat: np.ndarray | None = None):
        shapes = {
            "embed": (2 * how.side, how.size + 1, how.width),
            "class_w": (how.width, how.classes),
            "class_b": (how.classes,),
            "word_w": (how.classes, how.width, how.per_class),
            "word_b": (how.classes, how.per_class),
        }
        total = sum(int(np.prod(s)) for s in shapes.values())
        self.how = how
        self.flat = np.zeros(total, dtype=np.float32) if flat is None else flat.astype(np.float32)
        at = 0
        for name, shape in shapes.items():
            n = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + n].reshape(shape))
            at += n

    @staticmethod
    def initial(how: Window, counts: np.ndarray) -> Network:
        """Small random weights, and biases that predict each word by its count alone."""
        net, draw = Network(how), np.random.default_rng(how.seed)
        net.embed[:] = draw.normal(0, 0.1, net.embed.shape)
        net.class_w[:] = draw.normal(0, 0.1, net.class_w.shape)
        net.word_w[:] = draw.normal(0, 0.1, net.word_w.shape)
        table = counts.reshape(how.classes, how.per_class)
        net.class_b[:] = np.log(table.sum(axis=1) / table.sum())
        net.word_b[:] = np.log(table / table.sum(axis=1, keepdims=True))
        return net

    def hidden(self, context: np.ndarray) -> np.ndarray:
        h = self.embed[0][context[0]]
        for k in range(1, len(context)):
            h += self.embed[k][context[k]]
        return np.tanh(h)

    def log_probabilities(self, context: np.ndarray, target: np.ndarray, learn: float = 0.0) -> np.ndarray:
        """log p(target | context) of each token; with ``learn`` a gradient step is taken as well."""
        how, n = self.how, len(target)
        h = self.hidden(context)
        cls, word = np.divmod(target, how.per_class)
        here = np.arange(n)
        p = _softmax(h @ self.class_w + self.class_b)
        out = np.log(np.maximum(p[here, cls], _LEAST))
        order = _order(cls)
        bounds = np.searchsorted(cls[order], np.arange(how.classes + 1))
        back = np.zeros_like(h) if learn else None
        for c in range(how.classes):
            rows = order[bounds[c] : bounds[c + 1]]
            if not len(rows):
                continue
            hc = h[rows]
            q = _softmax(hc @ self.word_w[c] + self.word_b[c])
            some = np.arange(len(rows))
            out[rows] += np.log(np.maximum(q[some, word[rows]], _LEAST))
            if learn:
                q[some, word[rows]] -= 1
                back[rows] = q @ self.word_w[c].T
                # Steps are means over the batch, scaled up for what only part of it touches.
                scale = learn / np.sqrt(n * len(rows))
                self.word_w[c] -= scale * (hc.T @ q)
                self.word_b[c] -= scale * q.sum(axis=0)
        if learn:
            p[here, cls] -= 1
            back += p @ self.class_w.T
            self.class_w -= learn / n * (h.T @ p)
            self.class_b -= learn / n * p.sum(axis=0)
            back *= 1 - h * h
            for k in range(len(context)):
                order = _order(context[k])
                ids = context[k][order]
                heads = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
                sizes = np.diff(heads, append=n)
                sums = np.add.reduceat(back[order], heads, axis=0)
                self.embed[k][ids[heads]] -= (learn / np.sqrt(n * sizes)).astype(np.float32)[:, None] * sums
        return out


_LEAST = np.float32(1e-30)


def _order(ids: np.ndarray) -> np.ndarray:
    """A stable order; short integers are sorted by radix."""
    return np.argsort(ids.astype(np.int16) if len(ids) and ids.max() < 1 << 15 else ids, kind="stable")


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def text_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words, and each row's first word (one more at the end)."""
    data, offsets = arrowtext.utf8(pc.utf8_lower(column))
    starts, _, first = arrowtext.word_bounds(data, offsets, arrowtext.PUNCTUATION)
    return arrowtext.word_hashes(data, starts, arrowtext.PUNCTUATION), first


def windows(ids: np.ndarray, first: np.ndarray, how: Window) -> np.ndarray:
    """The ids around every word, one row for each place; places outside the text have the id ``size``."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    here, low, high = np.arange(len(ids)), first[row], first[row + 1]
    places = [k for k in range(-how.side, how.side + 1) if k]
    around = np.full((len(places), len(ids)), how.size, dtype=np.int64)
    for k, place in enumerate(places):
        at = here + place
        inside = (at >= low) & (at < high)
        around[k, inside] = ids[at[inside]]
    return around


def word_counts(documents: DataFrame, text: str) -> DataFrame:
    """(word, n): how often each word, by its hash, stands in all texts."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrowtext.slices(batches, "text"):
            words, n = np.unique(text_words(batch.column("text"))[0].view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(n)], names=["word", "n"])

    texts = documents.select(F.col(text).alias("text"))
    return texts.mapInArrow(counted, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(documents: DataFrame, how: Window, text: str, counts: DataFrame | None = None) -> Vocabulary:
    """The most frequent words and the sums of the buckets of all others; ties go by hash. ``counts`` are written word counts."""
    counts = materialise(word_counts(documents, text)) if counts is None else counts
    own = how.size - how.rare
    first = counts.orderBy(F.col("n").desc(), "word").limit(own + HELD).collect()
    top, held = first[:own], sorted((np.uint64(r["word"] % (1 << 64)), r["n"]) for r in first[own:])
    frequent = np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64)
    # Buckets of unsigned hashes: 2**64 is a multiple of any bucket number that is a power of two.
    bucket = F.pmod(F.col("word"), F.lit(how.rare))
    rest = counts if not len(top) else counts.filter(~F.col("word").isin([r["word"] for r in top]))
    types, totals = np.ones(how.size), np.ones(how.size)
    totals[: len(top)] += [r["n"] for r in top]
    for r in rest.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("types"), F.sum("n").alias("n")).collect():
        types[own + r["b"]], totals[own + r["b"]] = r["types"], 1 + r["n"]
    beyond = int(types[own:].sum()) - int((totals[own:] == 1).sum()) - len(held)
    logs = np.log(np.array([n for _, n in held], dtype=float))
    return Vocabulary(frequent, np.log(types), totals, np.array([w for w, _ in held], dtype=np.uint64), logs, beyond)


def _listed(row: np.ndarray, words: np.ndarray, rows: int) -> pa.Array:
    """The distinct words of each row with how often they stand in it."""
    order = np.lexsort((words, row))
    row, words = row[order], words[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (words[1:] != words[:-1])
    heads = np.flatnonzero(new)
    times = np.diff(heads, append=len(row))
    parts = [pa.array(words[heads].view(np.int64)), pa.array(times, pa.int64())]
    offsets = pa.array(np.searchsorted(row[heads], np.arange(rows + 1)), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(parts, names=["word", "times"]))


def train(documents: DataFrame, words: Vocabulary, how: Window, text: str) -> Network:
    """One pass of every task over its documents from the same start, and the mean of the results."""
    start = Network.initial(how, words.counts)

    def trained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, seen = Network(how, start.flat.copy()), 0
        for batch in arrowtext.slices(batches, "text"):
            hashes, first = text_words(batch.column("text"))
            ids = words.ids(hashes, how)
            around = windows(ids, first, how)
            # Batches mix distant words of the slice.
            mix = np.random.default_rng(how.seed).permutation(len(ids))
            for at in range(0, len(ids), how.batch):
                some = mix[at : at + how.batch]
                net.log_probabilities(around[:, some], ids[some], how.rate * min(1.0, len(some) / 256))
            seen += len(ids)
        if seen:
            blocks = range(0, len(net.flat), how.block)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(blocks)), pa.int32()),
                    pa.array([seen] * len(blocks), pa.int64()),
                    pa.array([net.flat[b : b + how.block] for b in blocks], pa.list_(pa.float32())),
                ],
                names=["block", "seen", "values"],
            )

    def averaged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for block, seen, values in zip(*(batch.column(k) for k in ("block", "seen", "values")), strict=True):
                held = sums.setdefault(block.as_py(), [0, 0.0])
                held[0] += seen.as_py()
                held[1] = held[1] + seen.as_py() * values.values.to_numpy().astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s / n for n, s in sums.values()], pa.list_(pa.float64()))],
            names=["block", "values"],
        )

    schema = "block int, seen bigint, values array<float>"
    parts = documents.select(F.col(text).alias("text")).mapInArrow(trained, schema).repartition("block")
    # The order of a shuffle's rows may change, so sums are taken in a fixed order of what they add.
    parts = parts.sortWithinPartitions("block", "seen", "values")
    means = {r["block"]: r["values"] for r in parts.mapInArrow(averaged, "block int, values array<double>").collect()}
    return Network(how, np.concatenate([means[b] for b in sorted(means)])) if means else start


def score_documents(documents: DataFrame, how: Window = Window(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, per_token) of every row, under a network trained on all of ``documents``.

    log_likelihood is the sum over words of log p(word | the words around it). Null and empty texts have no tokens, sum 0
    and a null per_token. Repeated rows are trained on and scored as often as they come; other columns
    are ignored; an empty table gives an empty result.
    """
    counts = materialise(word_counts(documents, text))
    words = vocabulary(documents, how, text, counts)
    net = train(documents, words, how, text)
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrowtext.slices(batches, "text"):
            hashes, first = text_words(batch.column("text"))
            ids = words.ids(hashes, how)
            around = windows(ids, first, how)
            parts = [
                net.log_probabilities(around[:, at : at + how.batch], ids[at : at + how.batch])
                for at in range(0, len(ids), how.batch)
            ]
            shares, lacking = words.shares(hashes, ids, how)
            each = np.concatenate([np.zeros(0), *parts]) + shares
            n = np.diff(first)
            row = np.repeat(np.arange(len(n)), n)
            sums = np.bincount(row, each, minlength=len(n)).astype(float)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(sums), _listed(row[lacking], hashes[lacking], len(n))],
                names=["doc_id", "n_tokens", "log_likelihood", "rest"],
            )

    schema = f"doc_id {kind}, n_tokens bigint, log_likelihood double, rest array<struct<word: bigint, times: bigint>>"
    found = rows.mapInArrow(scored, schema)
    if words.beyond:
        # Written once: the words and the rows they come back to are read from the same file.
        found = materialise(found.withColumn("_row", F.monotonically_increasing_id()))
        units = F.round(F.log("n") * SHARE_UNIT).cast("bigint") * F.col("times")
        # The log of a count of one is nothing.
        listed = found.select("_row", F.inline("rest")).join(counts.filter("n > 1"), "word")
        added = listed.groupBy("_row").agg(F.sum(units).alias("_units"))
        total = F.col("log_likelihood") + F.coalesce(F.col("_units"), F.lit(0)) / SHARE_UNIT
        found = found.drop("rest").join(added, "_row", "left").withColumn("log_likelihood", total)
    mean = F.try_divide("log_likelihood", "n_tokens").alias("per_token")
    return found.select("doc_id", "n_tokens", "log_likelihood", mean)
