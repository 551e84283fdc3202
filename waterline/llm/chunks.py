"""Repeated passages by content-defined chunking.

Texts are cut where a rolling gear hash of the last 32 bytes has its top bits zero, so an insertion moves only the cuts next
to it. From every chunk a window reaches over as many chunks as it takes to hold enough words, and windows are compared by
digest over the whole corpus. A window that another document holds is a repeat; windows of neighbouring chunks that the same
smallest document holds form a passage, which is reported wherever it stands.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waterline.llm import arrowtext
from waterline.sources.storage import materialise

_GEAR = np.random.default_rng(77).integers(0, 2**32, 256, dtype=np.uint32)
_REACH = 32


@dataclass(frozen=True)
class Chunking:
    """Cuts come every 2**bits bytes beyond ``least`` on average and after ``most`` bytes at the latest.

    ``min_words`` is the length from which a repeated row of chunks counts. It misses the parts of a passage outside
    its first and last cut, about 20 words in all, so passages of 50 words and more are found.
    """

    bits: int = 5
    least: int = 16
    most: int = 128
    min_words: int = 22


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash of the 32 bytes up to each byte, by doubling the reach five times."""
    h = _GEAR[data]
    for k in range(5):
        reach = 1 << k
        h[reach:] += h[:-reach] << np.uint32(reach) if len(h) > reach else h[reach:]
    return h


def cut_rows(data: np.ndarray, offsets: np.ndarray, how: Chunking) -> tuple[np.ndarray, np.ndarray]:
    """End of every chunk of every row, and each row's number of chunks.

    The first 32 bytes of a row have no cut, since their hash would reach into another row. A chunk ends
    before the first byte of a character, never inside one.
    """
    ends: list[int] = []
    counts = np.zeros(len(offsets) - 1, dtype=np.int64)
    if not len(data):
        return np.zeros(0, dtype=np.int64), counts
    free = np.ones(len(data), dtype=bool)
    free[:-1] = (data[1:] & 0xC0) != 0x80
    places = np.flatnonzero((gear_hashes(data) >> np.uint32(32 - how.bits) == 0) & free) + 1
    bounds = np.searchsorted(places, offsets, side="right")
    for row, (start, stop) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if start == stop:
            continue
        before, last = len(ends), start
        for place in (*places[bounds[row] : bounds[row + 1]].tolist(), stop):
            while place - last > how.most:
                last += how.most
                while not free[last - 1]:
                    last -= 1
                ends.append(last)
            if place == stop or (place - last >= how.least and place - start > _REACH):
                ends.append(place)
                last = place
                if place == stop:
                    break
        counts[row] = len(ends) - before
    return np.array(ends, dtype=np.int64), counts


def chunk_rows(documents: DataFrame, how: Chunking, doc_id: str, text: str) -> DataFrame:
    """(doc_id, digest, pos, start, stop, word, words) of every chunk's window, the least chunks from it on with ``min_words`` words.

    start and stop are its place in bytes, word and words the words before and in it. A word cut by the start counts as
    in it, so equal windows have equal words. Where the text ends too soon, digest is null and the rest is the chunk's.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter("doc_id IS NOT NULL")
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "digest", "pos", "start", "stop", "word", "words"]

    def chunked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrowtext.slices(batches, "text"):
            data, offsets = arrowtext.utf8(batch.column("text"))
            ends, counts = cut_rows(data, offsets, how)
            row = np.repeat(np.arange(len(counts)), counts)
            first = np.cumsum(counts) - counts
            pos = np.arange(len(ends)) - first[row]
            starts = np.where(pos == 0, offsets[row], np.concatenate([[0], ends[:-1]])[: len(ends)])
            raw = data.tobytes()
            words, _, first_word = arrowtext.word_bounds(data, offsets, arrowtext.BLANK)
            upto = np.searchsorted(words, ends)
            before = np.searchsorted(words, starts)
            cut = ~arrowtext.BLANK[data[starts]] & (np.searchsorted(words, starts, side="right") == before)
            before = before - cut
            own = np.arange(len(ends))
            last = np.maximum(np.searchsorted(upto, before + how.min_words), own)
            full = last < len(ends)
            last = np.where(full, last, own)
            full &= row[last] == row
            last = np.where(full, last, own)
            stops, upto = ends[last], upto[last]
            digests = [
                xxhash.xxh3_64_intdigest(raw[a:b]) - 2**63 if whole else None
                for a, b, whole in zip(starts.tolist(), stops.tolist(), full.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(digests, pa.int64()),
                    *[
                        pa.array(v.astype(np.int32))
                        for v in (pos, starts - offsets[row], stops - offsets[row], before - first_word[row], upto - before)
                    ],
                ],
                names=names,
            )

    return rows.mapInArrow(chunked, f"doc_id {kind}, digest bigint, pos int, start int, stop int, word int, words int")


def repeated_passages(
    documents: DataFrame, how: Chunking = Chunking(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, start, stop, n_words, first_doc_id, is_first) of every passage that stands in several documents.

    start and stop are byte offsets in the UTF-8 text. Every window of a passage stands in another document, and
    first_doc_id is the smallest document that holds it; is_first tells that it is this one, the occurrence to keep.
    Passages of different first_doc_id may overlap; one that goes less than ``min_words`` words beyond a neighbour
    of a smaller first_doc_id is left out, and its text stays. Text cut from the others still stands in a kept one, since a
    document's own cuts lie in documents of smaller ids. Repeats inside one document alone do not
    count. Rows that share an id are one document, rows without one are left out; null and empty texts
    have no chunks; other columns are ignored; an empty table gives an empty result.
    """
    chunks = materialise(chunk_rows(documents, how, doc_id, text)).filter("digest IS NOT NULL")
    holders = chunks.groupBy("digest").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last_doc_id"))
    shared = holders.filter("first_doc_id < last_doc_id").select("digest", "first_doc_id")
    # One row a shared digest, so the join keeps the number of windows; a hot digest is split by adaptive execution.
    found = chunks.join(shared, "digest").select("doc_id", "pos", "start", "stop", "word", "words", "first_doc_id")
    # Neighbouring chunks have the same difference of place and rank; the window holds one document at a time.
    rank = F.dense_rank().over(Window.partitionBy("doc_id", "first_doc_id").orderBy("pos"))
    runs = found.withColumn("run", F.col("pos") - rank).groupBy("doc_id", "first_doc_id", "run").agg(
        F.min("start").alias("start"),
        F.max("stop").alias("stop"),
        F.min("word").alias("word"),
        F.max(F.col("word") + F.col("words")).alias("past"),
    )
    # Where the smallest document lacks the first cut or two of a passage, a larger one leads it by a stub.
    near = Window.partitionBy("doc_id").orderBy("start", "first_doc_id")
    before, after = F.lag("first_doc_id").over(near), F.lead("first_doc_id").over(near)
    least = F.coalesce(F.col("first_doc_id") <= before, F.lit(True)) & F.coalesce(F.col("first_doc_id") <= after, F.lit(True))
    runs = runs.withColumns({"_before": before, "_after": after, "_least": least})
    low = F.when(F.lag("_least").over(near) & (F.col("_before") < F.col("first_doc_id")), F.lag("past").over(near))
    high = F.when(F.lead("_least").over(near) & (F.col("_after") < F.col("first_doc_id")), F.lead("word").over(near))
    runs = runs.withColumn("own", F.least("past", high) - F.greatest("word", low)).withColumn("n_words", F.col("past") - F.col("word"))
    return runs.filter(f"own >= {how.min_words}").select(
        "doc_id", "start", "stop", "n_words", "first_doc_id", (F.col("first_doc_id") == F.col("doc_id")).alias("is_first")
    )
