"""Benchmark decontamination with a BM25 index of the test items, searched by block-max WAND.

The index holds the test items, cut into segments of at most half a passage. Weights are BM25 impacts divided by the segment's
own total, so a score is the share of the segment that a passage covers and one threshold serves all.
Every training text is cut into overlapping passages; each passage is a query of its distinct words, and all segments at
or above the threshold are retrieved. A hit counts only if runs of words of both the item's question and its answer stand
in the text around the passage.

Search is safe at every step: sums of largest impacts by term, then by block of segments, are upper bounds that rule out almost
all passages for a whole batch at once; what is left is traversed document at a time with block-max WAND.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.llm import arrowtext

#: Block entries whose upper bounds are worked on together.
ENTRIES = 1 << 20


@dataclass(frozen=True)
class Search:
    """``stride`` words start a new passage of twice as many; ``overlap`` is the least share of runs of ``run`` words."""

    stride: int = 64
    threshold: float = 0.6
    overlap: float = 0.6
    run: int = 3
    k1: float = 1.2
    b: float = 0.75
    block: int = 4
    # Words of one index; a longer benchmark is searched in several passes.
    index_words: int = 500_000


@dataclass
class Index:
    how: Search
    item_ids: list
    segment_item: np.ndarray
    vocabulary: np.ndarray
    begin: np.ndarray  # of each term's postings, one more at the end
    segments: np.ndarray
    impacts: np.ndarray
    item_words: list[int]
    questions: list[np.ndarray] = field(default_factory=list)
    answers: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self) -> None:
        terms = np.repeat(np.arange(len(self.vocabulary)), np.diff(self.begin))
        self.most = np.zeros(len(self.vocabulary))
        np.maximum.at(self.most, terms, self.impacts)
        # The largest impact of each term in each block of neighbouring segments.
        self.n_blocks = int(len(self.segment_item) // self.how.block + 1)
        keys = terms * self.n_blocks + self.segments // self.how.block
        self.block_keys, at = np.unique(keys, return_index=True)
        self.block_most = np.maximum.reduceat(self.impacts, at) if len(at) else self.impacts
        self.block_begin = np.searchsorted(self.block_keys, np.arange(len(self.vocabulary) + 1) * self.n_blocks)

    @cached_property
    def lists(self) -> tuple[list[list[int]], list[list[float]], list[dict[int, float]]]:
        """Postings, their impacts and the largest impact by block, of every term, for the traversal."""
        ends = list(zip(self.begin[:-1], self.begin[1:], strict=True))
        blocks = zip(self.block_begin[:-1], self.block_begin[1:], strict=True)
        return (
            [self.segments[a:b].tolist() for a, b in ends],
            [self.impacts[a:b].tolist() for a, b in ends],
            [dict(zip((self.block_keys[a:b] % self.n_blocks).tolist(), self.block_most[a:b].tolist(), strict=True)) for a, b in blocks],
        )


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of lower-case words without punctuation, and each row's first word (one more at the end)."""
    data, offsets = arrowtext.utf8(pc.utf8_lower(column))
    starts, _, first = arrowtext.word_bounds(data, offsets, arrowtext.PUNCTUATION)
    return arrowtext.word_hashes(data, starts, arrowtext.PUNCTUATION), first


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item given as one text: the last sentence answers, or the last third of the only one."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text) if re.search(r"\w", p)]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    cut = len(words) - max(1, len(words) // 3)
    return " ".join(words[:cut]), " ".join(words[cut:])


def _runs(words: np.ndarray, run: int) -> np.ndarray:
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    return np.unique(arrowtext.shingle_hashes(words, np.array([0, len(words)]), run)[0])


def build_index(items: list[tuple], how: Search) -> Index:
    """Index of (item id, question, answer) rows."""
    texts = [[q or "", a or ""] for _, q, a in items]
    words, first = hashed_words(pa.array([t for pair in texts for t in pair], pa.string()))
    segments, owner, questions, answers, lengths = [], [], [], [], []
    for k in range(len(items)):
        start, middle, stop = first[2 * k], first[2 * k + 1], first[2 * k + 2]
        questions.append(_runs(words[start:middle], how.run))
        answers.append(_runs(words[middle:stop], how.run))
        lengths.append(int(stop - start))
        for at in range(start, stop, how.stride):
            segments.append(words[at : min(at + how.stride, stop)])
            owner.append(k)
    mean = np.mean([len(s) for s in segments]) if segments else 1.0
    vocabulary = np.unique(words)
    counted = [np.unique(s, return_counts=True) for s in segments]
    terms = np.searchsorted(vocabulary, np.concatenate([np.zeros(0, np.uint64), *[c[0] for c in counted]]))
    holder = np.repeat(np.arange(len(segments)), [len(c[0]) for c in counted])
    tf = np.concatenate([np.zeros(0), *[c[1] for c in counted]])
    size = np.array([len(s) for s in segments])[holder] if len(segments) else np.zeros(0)
    df = np.bincount(terms, minlength=len(vocabulary))
    idf = np.log1p((len(segments) - df + 0.5) / (df + 0.5))
    impact = idf[terms] * tf * (how.k1 + 1) / (tf + how.k1 * (1 - how.b + how.b * size / mean))
    impact /= np.bincount(holder, impact, minlength=len(segments))[holder] if len(segments) else 1
    order = np.lexsort((holder, terms))
    begin = np.searchsorted(terms[order], np.arange(len(vocabulary) + 1))
    return Index(
        how, [i for i, _, _ in items], np.array(owner, dtype=np.int64), vocabulary, begin, holder[order], impact[order], lengths,
        questions, answers,
    )


def block_max_wand(index: Index, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
    """All (segment, score) with score at or above ``threshold`` for a query of distinct terms."""
    postings, impacts, block_most = index.lists
    n_segments, width, least = len(index.segment_item), index.how.block, threshold - 1e-9
    # A cursor: [current segment, term, place in its postings, largest impact].
    cursors = [[postings[t][0], t, 0, float(index.most[t])] for t in terms.tolist()]
    found = []

    def seek(cursor: list, segment: int) -> None:
        own = postings[cursor[1]]
        cursor[2] = bisect_left(own, segment, cursor[2])
        cursor[0] = own[cursor[2]] if cursor[2] < len(own) else n_segments

    while True:
        cursors = [c for c in cursors if c[0] < n_segments]
        cursors.sort()
        bound, pivot = 0.0, None
        for k, c in enumerate(cursors):
            bound += c[3]
            if bound >= least:
                pivot = k
                break
        if pivot is None:
            return found
        segment = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == segment:
            pivot += 1
        ahead, block = cursors[: pivot + 1], segment // width
        if sum(block_most[c[1]].get(block, 0.0) for c in ahead) < least:
            # No segment of this block will do with these terms; another term may join before its end.
            target = (block + 1) * width
            if pivot + 1 < len(cursors):
                target = min(target, cursors[pivot + 1][0])
            for c in ahead:
                seek(c, target)
        elif cursors[0][0] == segment:
            score = sum(impacts[c[1]][c[2]] for c in ahead)
            if score >= least:
                found.append((segment, score))
            for c in ahead:
                seek(c, segment + 1)
        else:
            for c in ahead:
                seek(c, segment)


def _candidates(index: Index, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, first word, distinct terms) of every passage that the upper bounds don't rule out."""
    how, n_terms = index.how, len(index.vocabulary)
    counts = np.diff(first)
    n_cells = -(-counts // how.stride)
    base = np.concatenate([[0], np.cumsum(n_cells)])
    term = np.minimum(np.searchsorted(index.vocabulary, words), n_terms - 1)
    known = np.flatnonzero(index.vocabulary[term] == words)
    row = np.repeat(np.arange(len(counts)), counts)[known]
    cell = base[row] + (known - first[row]) // how.stride
    pairs = np.unique(cell * n_terms + term[known])
    cell, term = pairs // n_terms, pairs % n_terms
    upper = np.bincount(cell, index.most[term], minlength=base[-1] + 1)
    # A passage is a cell and the next one of its row; a row of a single cell is one passage.
    row = np.repeat(np.arange(len(counts)), n_cells)
    here = np.arange(base[-1])
    last = here + 1 == base[row + 1]
    alive = np.where(last, upper[here], upper[here] + upper[here + 1]) >= how.threshold - 1e-9
    alive &= ~last | (n_cells[row] == 1)
    passages = here[alive]
    bounds = np.searchsorted(cell, np.arange(base[-1] + 1))
    # Terms of a cell have so many entries in the index of blocks; passages are taken together while they have
    # about ``ENTRIES`` of them, at most 512.
    held = np.concatenate([[0], np.cumsum(index.block_begin[term + 1] - index.block_begin[term])])
    weight = held[bounds[np.minimum(passages + 2 - last[passages], base[-1])]] - held[bounds[passages]]
    group = np.cumsum(np.maximum(weight, ENTRIES // 512)) // ENTRIES
    cuts = np.append(np.unique(group, return_index=True)[1], len(passages)).tolist()
    for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
        some = passages[start:stop]
        queries = [
            np.unique(term[bounds[c] : bounds[c + (1 if last[c] else 2)]]) for c in some
        ]
        sizes = [len(q) for q in queries]
        asked = np.concatenate(queries)
        entries = index.block_begin[asked + 1] - index.block_begin[asked]
        which = np.repeat(np.repeat(np.arange(len(some)), sizes), entries)
        at = np.arange(len(which)) - np.repeat(np.cumsum(entries) - entries - index.block_begin[asked], entries)
        place = which * index.n_blocks + index.block_keys[at] % index.n_blocks
        if len(some) * index.n_blocks <= 1 << 22:
            most = np.bincount(place, index.block_most[at], minlength=len(some) * index.n_blocks)
            likely = most.reshape(len(some), -1).max(axis=1) >= how.threshold - 1e-9
        else:
            likely = np.ones(len(some), dtype=bool)
        for k in np.flatnonzero(likely):
            c = some[k]
            yield int(row[c]), int(first[row[c]] + (c - base[row[c]]) * how.stride), queries[k]


def search(index: Index, column: pa.Array) -> dict[tuple[int, int], tuple[float, float, float]]:
    """(row, item number) of every confirmed leak: best score, question and answer overlap."""
    found: dict[tuple[int, int], tuple[float, float, float]] = {}
    if not len(index.vocabulary):
        return found
    how = index.how
    words, first = hashed_words(column)
    for row, start, terms in _candidates(index, words, first):
        for segment, score in block_max_wand(index, terms, how.threshold):
            item = int(index.segment_item[segment])
            around = index.item_words[item]
            low = max(first[row], start - around)
            near = words[low : min(first[row + 1], start + 2 * how.stride + around)]
            # Runs of every length up to ``run``: a part shorter than that is one run of its own length.
            runs = np.concatenate([_runs(near, n) for n in range(1, how.run + 1)])
            parts = (index.questions[item], index.answers[item])
            shares = [float(np.isin(part, runs).mean()) if len(part) else 1.0 for part in parts]
            if min(shares) >= how.overlap:
                old = found.get((row, item))
                found[row, item] = (score, *shares) if old is None or score > old[0] else old
    return found


def _indexes(benchmark: DataFrame, how: Search, item_id: str, text: str, question: str | None, answer: str | None) -> list[Index]:
    """Indexes of at most about ``index_words`` words each; the items come to the driver one index at a time."""
    if question is not None and answer is not None:
        items = benchmark.select(F.col(item_id).alias("i"), F.col(question).alias("q"), F.col(answer).alias("a"))
    else:
        items = benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("q"), F.lit(None).cast("string").alias("a"))
    chars = items.agg(F.sum(F.length(F.concat_ws(" ", "q", "a")))).first()[0] or 0
    parts = 1 + chars // (5 * how.index_words)
    made = []
    for part in range(parts):
        mine = items.filter(F.pmod(F.xxhash64("i", "q", "a"), F.lit(parts)) == part) if parts > 1 else items
        rows = sorted(((r.i, r.q or "", r.a) for r in mine.collect()), key=lambda r: (r[0] is not None, r[0], r[1]))
        rows = [(i, *split_item(q)) if a is None else (i, q, a) for i, q, a in rows]
        made.append(build_index(rows, how))
    return made


def leaks(
    documents: DataFrame, benchmark: DataFrame, how: Search = Search(), doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", question: str | None = None, answer: str | None = None,
) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) of every document and test item that it contains.

    Without ``question`` and ``answer`` columns the item's last sentence is its answer. Null and empty texts and items without
    words give nothing. Each row of ``documents`` is searched by itself, so repeated rows repeat their leaks; repeated items are reported
    each. Other columns are ignored. No exchange takes place: a document is searched where it is read.
    """
    id_kind = documents.schema[doc_id].dataType.simpleString()
    item_field = benchmark.schema[item_id]
    schema = f"doc_id {id_kind}, item_id {item_field.dataType.simpleString()}, score double, question_overlap double, answer_overlap double"
    item_kind = pa.string() if item_field.dataType.simpleString() == "string" else pa.int64()
    if item_field.dataType.simpleString() == "int":
        item_kind = pa.int32()
    rows, found = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), None
    for index in _indexes(benchmark, how, item_id, item_text, question, answer):

        def searched(batches: Iterable[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in arrowtext.slices(batches, "text"):
                hits = sorted(search(index, batch.column("text")).items())
                if hits:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(pa.array([r for (r, _), _ in hits])),
                            pa.array([index.item_ids[i] for (_, i), _ in hits], item_kind),
                            *[pa.array([h[k] for _, h in hits], pa.float64()) for k in range(3)],
                        ],
                        names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                    )

        part = rows.mapInArrow(searched, schema)
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(
    documents: DataFrame, benchmark: DataFrame, how: Search = Search(), text: str = "text", item_id: str = "item_id",
    item_text: str = "text", question: str | None = None, answer: str | None = None,
) -> DataFrame:
    """The rows of ``documents``, with all their columns, that contain no test item; found as in ``leaks``."""
    kept = documents
    for index in _indexes(benchmark, how, item_id, item_text, question, answer):

        def clean(batches: Iterable[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in arrowtext.slices(batches, text):
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[row for row, _ in search(index, batch.column(text))]] = False
                yield batch.filter(pa.array(keep))

        kept = kept.mapInArrow(clean, documents.schema)
    return kept
