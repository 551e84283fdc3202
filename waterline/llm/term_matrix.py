"""A sparse document-term matrix in shards, with one dictionary for the whole corpus.

A task cuts its documents into shards and encodes their words by a dictionary of the shard. Only the distinct words of
each shard, not those of each document, then meet over the corpus, and they travel as arrays: a row holds the shard's words
of one hash bucket. Where a bucket's rows meet, equal words get one number, and the numbers go back to the shards, whose
local indices become global ones. So a frequent word is exchanged once a shard however many documents hold it, and no
bucket has more rows than there are shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waterline.llm import arrowtext
from waterline.sources.storage import materialise, scratch_path

# Documents of about this many bytes make a shard; a longer text is a shard of its own.
SHARD_BYTES = 4 << 20
# The stored shards are long rows; a reader or writer holds so many at a time.
ROW_GROUP = 4
# A task of the exchange gets the words of so many buckets.
BUCKETS_A_TASK = 2
MARKS = b"#$%&*|"

_IS_MARK = np.isin(np.arange(256), list(MARKS))
_IS_UPPER = (np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A)
_STARTS_CHARACTER = (np.arange(256) & 0xC0) != 0x80
_MEASURES = [("n_chars", pa.int64()), ("n_upper", pa.int64()), ("n_marks", pa.int64()), ("digest", pa.binary())]


@dataclass(frozen=True)
class TermMatrix:
    """shards: (shard, documents array, indptr, indices, counts), a row of the matrix each document; dictionary: (term, word)."""

    shards: DataFrame
    dictionary: DataFrame


def row_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def shard_terms(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The shard's words by bucket, each one's bucket, and the matrix over them: indptr, indices and counts."""
    starts, ends, first = arrowtext.word_bounds(data, offsets, arrowtext.BLANK)
    letters = data[~arrowtext.BLANK[data]]
    places = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(letters)]
    ).dictionary_encode()
    width = max(len(words.dictionary), 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    cells, counts = np.unique(row * width + words.indices.to_numpy(), return_counts=True)
    indptr = np.searchsorted(cells, np.arange(len(offsets)) * width)
    vocabulary = words.dictionary.cast(pa.binary())
    distinct, at = arrowtext.utf8(vocabulary.cast(pa.string()))
    bucket = (arrowtext.word_hashes(distinct, at[:-1], np.zeros(256, dtype=bool)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(width, dtype=np.int64)
    place[order] = np.arange(len(order))
    return vocabulary.take(pa.array(order)), bucket[order], indptr, place[cells % width], counts


def _listed(values: np.ndarray | pa.Array) -> pa.Array:
    """One row that holds all ``values``."""
    inner = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array([0, len(inner)], pa.int32()), inner)


def term_matrix(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), shard_bytes: int = SHARD_BYTES
) -> TermMatrix:
    """The matrix of all rows of ``documents`` over all words `[^\\x20\\x09-\\x0D]+` of their whole texts, case-sensitive.

    A shard's ``documents`` tell doc_id, the columns ``keep``, and of the text: n_chars (code points), n_upper (`[A-Z]`),
    n_marks (of `#$%&*|`) and digest (128 bits). Row k of the shard has ``indices[indptr[k]:indptr[k + 1]]`` and as many
    counts. Terms are numbered gapless from 0 in no particular order. Null and empty texts have rows without
    entries; repeated rows and ids are rows each; an empty table gives no shards; other columns are ignored.
    """
    spark = documents.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = width * BUCKETS_A_TASK
    rows = documents.select(F.col(doc_id).alias("doc_id"), *[F.col(f"`{c}`") for c in keep], F.col(text).alias("_text"))
    own = [f for f in rows.schema.fields if f.name != "_text"]
    measured = [T.StructField(n, T.BinaryType() if n == "digest" else T.LongType()) for n, _ in _MEASURES]
    described = T.ArrayType(T.StructType([*own, *measured]))

    def local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = (TaskContext.get().partitionId() << 32) - 1
        for batch in arrowtext.slices(batches, "_text", shard_bytes):
            shard += 1
            texts = batch.column("_text")
            data, offsets = arrowtext.utf8(texts)
            vocabulary, bucket, indptr, indices, counts = shard_terms(data, offsets, buckets)
            held, begin = np.unique(bucket, return_index=True)
            cuts = pa.array(np.append(begin, len(bucket)), pa.int32())
            parts = pa.StructArray.from_arrays(
                [pa.array(held), pa.array(begin, pa.int32()), pa.ListArray.from_arrays(cuts, vocabulary)], names=["bucket", "start", "words"]
            )
            raw = data.tobytes()
            digests = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            sums = [row_sums(table[data], offsets) for table in (_STARTS_CHARACTER, _IS_UPPER, _IS_MARK)]
            found = [*[pa.array(s, pa.int64()) for s in sums], pa.array(digests, pa.binary())]
            about = pa.StructArray.from_arrays([*[batch.column(f.name) for f in own], *found], names=[*[f.name for f in own], *[n for n, _ in _MEASURES]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int64()),
                    _listed(about),
                    _listed(parts),
                    *[_listed(v.astype(np.int32)) for v in (indptr, indices, counts)],
                ],
                names=["shard", "documents", "parts", "indptr", "indices", "counts"],
            )

    numbers = T.ArrayType(T.IntegerType())
    parts = T.StructType().add("bucket", T.IntegerType()).add("start", T.IntegerType()).add("words", T.ArrayType(T.BinaryType()))
    schema = T.StructType().add("shard", T.LongType()).add("documents", described).add("parts", T.ArrayType(parts))
    schema = schema.add("indptr", numbers).add("indices", numbers).add("counts", numbers)
    path = scratch_path(spark, "shards")
    rows.mapInArrow(local, schema).write.option("parquet.block.row.count.limit", ROW_GROUP).parquet(path)
    stored = spark.read.schema(schema).parquet(path)

    numbered, before = _numbered(stored.select("shard", F.inline("parts")), width)
    named = numbered.join(before, "piece")
    new = named.select("before", "first", F.posexplode("words").alias("at", "word"))
    dictionary = new.select((F.col("before") + F.col("first") + F.col("at")).alias("term"), F.col("word").cast("string").alias("word"))
    # A shard's own words meet in its row again.
    terms = named.groupBy("shard").agg(F.collect_list(F.struct("start", "before", "numbers")).alias("terms"))
    joined = stored.drop("parts").join(terms, "shard", "left")

    def globally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                start, low, lists = pc.list_flatten(one.column("terms")).flatten() or ([], [], [])
                table = np.zeros(len(pc.list_flatten(lists)), dtype=np.int64)
                for begin, offset, own in zip(start.to_pylist(), low.to_pylist(), lists, strict=True):
                    table[begin : begin + len(own.values)] = own.values.to_numpy() + offset
                indices = table[pc.list_flatten(one.column("indices")).to_numpy()]
                yield pa.RecordBatch.from_arrays(
                    [*[one.column(c) for c in ("shard", "documents", "indptr")], _listed(indices), one.column("counts")],
                    names=["shard", "documents", "indptr", "indices", "counts"],
                )

    wide = T.StructType().add("shard", T.LongType()).add("documents", described).add("indptr", numbers)
    wide = wide.add("indices", T.ArrayType(T.LongType())).add("counts", numbers)
    return TermMatrix(joined.mapInArrow(globally, wide), dictionary)


def _numbered(parts: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(shard, start, piece, numbers, first, words) and (piece, before): a number for every distinct word.

    A piece is a task of the exchange by bucket, which holds the distinct words of its buckets; numbers are those of a shard's
    words from ``start`` on, words are the ones that come up in this row, numbered from ``first``. The pieces' totals,
    one row each, give the offsets.
    """

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId()
        known: dict[bytes, int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("words")
            sizes = pc.list_value_length(lists).to_numpy()
            cuts = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            words = pc.list_flatten(lists).dictionary_encode()
            first = len(known)
            ids = np.array([known.setdefault(w, len(known)) for w in words.dictionary.to_pylist()], dtype=np.int64)
            new = words.dictionary.filter(pa.array(ids >= first))
            # The new words of the batch stand in its first row.
            held = pa.ListArray.from_arrays(pa.array(np.minimum(np.arange(len(lists) + 1), 1) * len(new), pa.int32()), new)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("shard"),
                    batch.column("start"),
                    pa.array(np.full(len(lists), piece, dtype=np.int32)),
                    pa.ListArray.from_arrays(cuts, pa.array(ids[words.indices.to_numpy()])),
                    pa.array(np.full(len(lists), first)),
                    held,
                ],
                names=["shard", "start", "piece", "numbers", "first", "words"],
            )

    schema = "shard bigint, start int, piece int, numbers array<bigint>, first bigint, words array<binary>"
    numbered = materialise(parts.repartition(width, "bucket").mapInArrow(number, schema))
    totals = numbered.groupBy("piece").agg(F.max(F.col("first") + F.size("words")).alias("n"))
    before = totals.selectExpr("piece", "coalesce(sum(n) OVER (ORDER BY piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS before")
    return numbered, F.broadcast(before)  # a row for each task of one exchange


def row_totals(shards: DataFrame) -> DataFrame:
    """A row each document: its description, n_words (the row's sum) and n_distinct (its nonzero entries)."""
    fields = shards.schema["documents"].dataType.elementType.fields

    def totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                about, indptr, counts = (pc.list_flatten(batch.column(c).slice(k, 1)) for c in ("documents", "indptr", "counts"))
                upto = np.concatenate([[0], np.cumsum(counts.to_numpy(), dtype=np.int64)])
                cuts = indptr.to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [*about.flatten(), pa.array(np.diff(upto[cuts]), pa.int64()), pa.array(np.diff(cuts), pa.int64())],
                    names=[*[f.name for f in fields], "n_words", "n_distinct"],
                )

    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("n_distinct", T.LongType())])
    return shards.select("documents", "indptr", "counts").mapInArrow(totals, schema)
