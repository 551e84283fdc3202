"""Phrases whose words stand together more often than chance, by prefix-free parsing.

A text is cut where a hash of four words in a row is divisible by ``every``: content decides, so copies are cut alike wherever
they stand. A chunk ends with these four words and the next begins with them; a phrase of up to five words therefore lies
whole in some chunk, and is counted in the one in which its last word is not among the four leading ones. The distinct
chunks are the dictionary, how often each occurs are its parse frequencies. Phrases are counted inside distinct chunks only,
weighted by these.

Phrases are counted by length. A longer one can be frequent only if its first and its last words are, so shorter frequent
phrases go to the tasks as a Bloom filter of bounded size. What the filter lets through by mistake costs work; every count is exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.llm import arrowtext
from waterline.operators.ranking import best_rows
from waterline.sources.storage import materialise, small

LONGEST = 5
OVERLAP = LONGEST - 1
#: One place in so many ends a chunk.
EVERY = 48
#: A chunk ends after so many words at the latest.
MOST_WORDS = 512
LEAST_COUNT = 100
BEST = 2000
NO_LANG = "und"
SLICE = 2 << 20
#: The filter has about 16 bits a phrase, and never more than 16 MB.
MOST_BITS = 1 << 27
_HASHES = 4

_ENDS_PIECE = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
_APART = _ENDS_PIECE | np.isin(np.arange(256), [0x20, 0x09])
_IN_CHUNK = np.isin(np.arange(256), [0x20, 0x0A])
_LOWER = np.where((np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
_ORDER = np.uint64(0xA24BAED4963EE407)


def chain(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of all but its last word."""
    return arrowtext.mixed(h * _ORDER + word)


def row_words(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray, ends_piece: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start and end of every word, each row's first word, and whether a word begins a piece."""
    starts, ends, first = arrowtext.word_bounds(data, offsets, apart)
    begins = np.ones(len(starts), dtype=bool)
    if len(starts):
        upto = np.concatenate([[0], np.cumsum(ends_piece[data], dtype=np.int64)])
        begins[1:] = upto[starts[1:]] > upto[ends[:-1]]
        begins[first[:-1][first[:-1] < len(starts)]] = True
    return starts, ends, first, begins


def chunk_bounds(hashes: np.ndarray, first: np.ndarray, every: int, most: int) -> tuple[np.ndarray, ...]:
    """Row, first word, end word of every chunk, and the words it shares with the one before: ``OVERLAP``, but none in a row's first."""
    h = np.zeros(max(len(hashes) - OVERLAP + 1, 0), dtype=np.uint64)
    for k in range(OVERLAP):
        h = chain(h, hashes[k : k + len(h)])
    cuts = np.flatnonzero(h % np.uint64(every) == 0) + OVERLAP  # a chunk may end before this word
    rows, starts, stops, leads = [], [], [], []
    low, high = np.searchsorted(cuts, first[:-1] + OVERLAP), np.searchsorted(cuts, first[1:])
    for row, (begin, end) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        at = begin
        for stop in (*cuts[low[row] : high[row]].tolist(), end):
            while stop > at:
                upto = min(stop, at + most)
                lead = 0 if at == begin else OVERLAP
                rows.append(row)
                starts.append(at - lead)
                stops.append(upto)
                leads.append(lead)
                at = upto
    return tuple(np.array(x, dtype=np.int64) for x in (rows, starts, stops, leads))


def parse(documents: DataFrame, text: str = "text", lang: str = "lang", every: int = EVERY, most: int = MOST_WORDS) -> DataFrame:
    """(lang, fresh, chunk, n): the dictionary of distinct chunks of all texts with their parse frequencies.

    Words in a chunk are set apart by a space, or a line feed where a piece ends. fresh tells a text's first chunk, which has no
    overlap before it. A chunk is as long as ``most`` words at most, and four more.
    """
    rows = documents.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text).alias("text"))

    def chunked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrowtext.slices(batches, "text", SLICE):
            data, offsets = arrowtext.utf8(batch.column("text"))
            data = _LOWER[data]
            starts, ends, first, begins = row_words(data, offsets, _APART, _ENDS_PIECE)
            row, begin, stop, lead = chunk_bounds(arrowtext.word_hashes(data, starts, _APART), first, every, max(most, OVERLAP))
            # All words again, each after one byte that sets it apart.
            places = np.concatenate([[0], np.cumsum(ends - starts + 1)])
            tidy = np.zeros(places[-1], dtype=np.uint8)
            letters = np.ones(len(tidy), dtype=bool)
            letters[places[:-1]] = False
            tidy[places[:-1]] = np.where(begins, 0x0A, 0x20)
            tidy[letters] = data[~_APART[data]]
            raw = tidy.tobytes()
            chunks = [raw[a:b] for a, b in zip((places[begin] + 1).tolist(), places[stop].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(pa.array(row)), pa.array(lead == 0), pa.array(chunks, pa.binary()).cast(pa.string())],
                names=["lang", "fresh", "chunk"],
            )

    chunks = rows.mapInArrow(chunked, "lang string, fresh boolean, chunk string")
    return chunks.groupBy("lang", "fresh", "chunk").agg(F.count(F.lit(1)).alias("n"))


def lang_seeds(langs: pa.Array) -> np.ndarray:
    coded = langs.dictionary_encode()
    seeds = np.array([xxhash.xxh3_64_intdigest(x.as_py().encode()) for x in coded.dictionary] or [0], dtype=np.uint64)
    return seeds[coded.indices.to_numpy()]


def filter_places(h: np.ndarray, bits: int) -> np.ndarray:
    """The ``_HASHES`` bits of each hash, one column each."""
    step = arrowtext.mixed(h) | np.uint64(1)
    return np.stack([(h + np.uint64(k) * step) & np.uint64(bits - 1) for k in range(_HASHES)], axis=-1)


def passes(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = filter_places(h, 64 * len(table))
    found = np.ones(len(h), dtype=bool)
    for k in range(_HASHES):
        found &= (table[at[:, k] >> np.uint64(6)] >> (at[:, k] & np.uint64(63))) & np.uint64(1) == 1
    return found


def bloom_filter(phrases: DataFrame, n: int) -> np.ndarray:
    """The filter of (lang, phrase) rows, which ``n`` counts. Its words are or-ed together in Spark; at most 16 MB come back."""
    bits = min(max(1 << 16, 1 << (16 * n - 1).bit_length()), MOST_BITS)

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrowtext.utf8(batch.column("phrase"))
            starts, _, first = arrowtext.word_bounds(data, offsets, _IN_CHUNK)
            words = arrowtext.word_hashes(data, starts, _IN_CHUNK)
            h, counts = lang_seeds(batch.column("lang")), np.diff(first)
            for k in range(int(counts.max(initial=0))):
                has = counts > k
                h[has] = chain(h[has], words[first[:-1][has] + k])
            at = filter_places(h, bits).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> np.uint64(6)).astype(np.int32)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))],
                names=["word", "bits"],
            )

    found = phrases.select("lang", "phrase").mapInArrow(places, "word int, bits bigint").groupBy("word").agg(F.expr("bit_or(bits) AS bits"))
    table = np.zeros(bits // 64, dtype=np.uint64)
    got = found.toArrow()
    table[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return table


def count_phrases(dictionary: DataFrame, size: int, shorter: Broadcast[np.ndarray] | None = None) -> DataFrame:
    """(lang, phrase, n): how often phrases of ``size`` words occur in the texts behind the dictionary.

    With ``shorter``, the filter of frequent phrases of one word less, those are left out whose first or last part cannot be frequent.
    """

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrowtext.slices(batches, "chunk", SLICE):
            data, offsets = arrowtext.utf8(batch.column("chunk"))
            starts, ends, first, begins = row_words(data, offsets, _IN_CHUNK, _IN_CHUNK & (np.arange(256) == 0x0A))
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            place = np.arange(len(starts))
            run = place - np.maximum.accumulate(np.where(begins, place, 0)) + 1
            lead = np.where(batch.column("fresh").to_numpy(zero_copy_only=False), 0, OVERLAP)
            last = np.flatnonzero((run >= size) & (place - first[:-1][row] >= lead[row]))
            if shorter is not None:
                words = arrowtext.word_hashes(data, starts, _IN_CHUNK)
                seeds = lang_seeds(batch.column("lang"))
                for skip in (0, 1):  # all but the last word, all but the first
                    h = seeds[row[last]]
                    for k in range(size - 1):
                        h = chain(h, words[last - size + 1 + skip + k])
                    last = last[passes(h, shorter.value)]
            begin, end = starts[last - size + 1], ends[last]
            length = end - begin
            ends_at = np.concatenate([[0], np.cumsum(length)])
            taken = data[np.repeat(begin - ends_at[:-1], length) + np.arange(ends_at[-1])]
            phrases = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(last), [None, pa.py_buffer(ends_at.astype(np.int64)), pa.py_buffer(taken)]
            ).dictionary_encode()
            langs = batch.column("lang").dictionary_encode()
            width = max(len(phrases.dictionary), 1)
            keys, inverse = np.unique(
                langs.indices.to_numpy()[row[last]].astype(np.int64) * width + phrases.indices.to_numpy(), return_inverse=True
            )
            n = np.zeros(len(keys), dtype=np.int64)
            np.add.at(n, inverse, batch.column("n").to_numpy()[row[last]])
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(keys // width)),
                    phrases.dictionary.take(pa.array(keys % width)).cast(pa.binary()).cast(pa.string()),
                    pa.array(n),
                ],
                names=["lang", "phrase", "n"],
            )

    found = dictionary.mapInArrow(counted, "lang string, phrase string, n bigint")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def frequent_phrases(dictionary: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases with f >= ``least``, and (lang, n): all word occurrences of each language."""
    spark = dictionary.sparkSession
    words = materialise(count_phrases(dictionary, 1))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    level = words.filter(F.col("n") >= least)
    found = level.withColumn("size", F.lit(1))
    for size in range(2, longest + 1):
        n = level.count()
        if not n:
            break
        shorter = spark.sparkContext.broadcast(bloom_filter(level, n))
        level = materialise(count_phrases(dictionary, size, shorter).filter(F.col("n") >= least))
        found = found.unionByName(level.withColumn("size", F.lit(size)))
    return found.withColumnRenamed("n", "f"), totals


def scored(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of phrases of two words and more that no equally frequent longer one contains.

    score is floor(1000 * a * n / (l * r)) of the lowest-scoring cut, in exact decimals.
    """
    longer = frequent.filter("size > 2").select(
        "lang",
        "f",
        F.explode(F.array(F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring(phrase, locate(' ', phrase) + 1)"))).alias("phrase"),
    )
    # If a longer phrase of more words contains it as often, so does one of one word more.
    inside = longer.groupBy("lang", "phrase").agg(F.max("f").alias("within"))
    kept = frequent.filter("size > 1").join(inside, ["lang", "phrase"], "left").filter("within IS NULL OR within < f")
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("rest", F.expr("substring(phrase, char_length(first) + 2)"))
    left = frequent.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    parts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    parts = parts.join(small(totals, totals.count()), "lang")
    wide = {c: f"CAST({c} AS DECIMAL(38, 0))" for c in ("a", "n", "l", "r")}
    parts = parts.withColumn("score", F.expr(f"(1000BD * {wide['a']} * {wide['n']}) DIV ({wide['l']} * {wide['r']})"))
    lowest = parts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score"))


def collocations(
    documents: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, best: int = BEST, every: int = EVERY
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two to five words of each language.

    A-Z are lower-cased, texts are split into pieces at `[.,;:!?\\x0A-\\x0D]` and those into words `[^\\x20\\x09]+`. a is how often
    the phrase occurs inside pieces, at least ``least`` times; n counts the language's words; l and r are the
    counts of the two parts of its lowest-scoring cut. Ranks go by score and a descending, then phrase. Null texts are
    empty; a null language is `und`; repeated rows count each; other columns are ignored; an empty table gives an empty result.
    """
    dictionary = materialise(parse(documents, text, lang, every))
    found = scored(*frequent_phrases(dictionary, least))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Numbered in range partitions, so that no language is one task's.
    ranked = best_rows(found, order, best, ["lang"], "rank")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
