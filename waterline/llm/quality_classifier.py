"""Quality scores from text statistics by an additive model with pairwise interactions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.llm import arrowtext
from waterline.llm.additive import Additive, Boosting, fit

#: About so many labelled rows are fitted at most; the sample is drawn by a hash of the id.
MAX_ROWS = 20_000
#: Byte classes that are counted; every other byte falls in the last one.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".,;:?",
    "bang": b"!",
    "pipe": b"|",
    "symbol": b"#*$%&<>@^~_=+\\/{}[]",
    "newline": b"\n",
    "blank": b" \t\r\x0b\x0c",
    "wide": bytes(range(128, 256)),
}
_CLASS = np.full(256, len(CLASSES), dtype=np.uint8)
for _k, _members in enumerate(CLASSES.values()):
    _CLASS[list(_members)] = _k
FEATURES = (
    "log_bytes", "log_words", "word_bytes", "longest_word", "distinct", "top_word", "adjacent", "line_words", "repeated_lines",
    "upper", "digit", "stop", "bang", "pipe", "symbol", "wide", "other",
)


def _largest_run(same_row_and_value: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct values and size of the largest group by row, from sorted values."""
    heads = np.flatnonzero(~same_row_and_value)
    sizes = np.diff(heads, append=len(rows))
    distinct = np.bincount(rows[heads], minlength=n)
    most = np.zeros(n, dtype=np.int64)
    np.maximum.at(most, rows[heads], sizes)
    return distinct, most


def _sorted_groups(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (r[1:] == r[:-1])
    return _largest_run(same, r, n)


_NEWLINE = np.zeros(256, dtype=bool)
_NEWLINE[10] = True


def text_features(column: pa.Array) -> np.ndarray:
    """One row of FEATURES per text, over the whole text; null and empty texts are all zeros."""
    data, offsets = arrowtext.utf8(column)
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    row_of_byte = np.repeat(np.arange(n), sizes)
    kinds = np.bincount(row_of_byte * 16 + _CLASS[data], minlength=n * 16).reshape(n, 16)[:, : len(CLASSES) + 1]
    counts = dict(zip([*CLASSES, "other"], kinds.T, strict=True))
    starts, ends, first = arrowtext.word_bounds(data, offsets, arrowtext.BLANK)
    words = np.diff(first)
    rows = np.repeat(np.arange(n), words)
    hashes = arrowtext.word_hashes(data, starts, arrowtext.BLANK)
    distinct, most = _sorted_groups(hashes, rows, n)
    same = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    adjacent = np.bincount(rows[1:][same], minlength=n)
    longest = np.zeros(n, dtype=np.int64)
    np.maximum.at(longest, rows, ends - starts)
    line_starts, _, first_line = arrowtext.word_bounds(data, offsets, _NEWLINE)
    lines = np.diff(first_line)
    distinct_lines, _ = _sorted_groups(arrowtext.word_hashes(data, line_starts, _NEWLINE), np.repeat(np.arange(n), lines), n)
    w, b = np.maximum(words, 1), np.maximum(sizes, 1)
    return np.stack(
        [
            np.log1p(sizes), np.log1p(words), (sizes - counts["blank"] - counts["newline"]) / w, np.log1p(longest),
            distinct / w, most / w, adjacent / w, words / np.maximum(lines, 1), (lines - distinct_lines) / np.maximum(lines, 1),
            counts["upper"] / b, counts["digit"] / b, counts["stop"] / w, counts["bang"] / w, counts["pipe"] / w,
            counts["symbol"] / w, counts["wide"] / b, counts["other"] / b,
        ],
        axis=1,
    )


def held_out(doc_id) -> F.Column:
    """Rows kept for testing: crc32 of the id as text leaves 1 when divided by 3. A null id is not one."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def one_row_each(rows: DataFrame) -> DataFrame:
    """One row a doc_id, with the mean statistics of its rows, so that an id in many rows comes to the driver once.

    Means are of decimals, whose sums do not hang on the order of rows; statistics that agree are kept as they are.
    """
    means = [
        F.when(F.min(c) == F.max(c), F.max(c)).otherwise(F.avg(F.col(c).cast("decimal(28,9)")).cast("double")).alias(c)
        for c in FEATURES
    ]
    return rows.groupBy("doc_id", "label").agg(*means)


def fit_quality(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    max_rows: int = MAX_ROWS, how: Boosting = Boosting(),
) -> Additive:
    """A model of ``label`` from the statistics of about ``max_rows`` labelled texts at most, none of them held out.

    Null labels and ids are left out; a document labelled more than once gets the majority, ties counting as 1. Rows that share an id are one row of mean statistics. The sample
    depends on ids alone, so it is the same whenever and wherever it is drawn.
    """
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("label")).dropna()
    known = known.filter(~held_out("doc_id")).groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    n = known.count()
    if n > max_rows:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # The sample's size is bounded by the parameter, so its ids are broadcast.
    chosen = texts.join(F.broadcast(known), "doc_id")

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrowtext.slices(batches, "text"):
            values = text_features(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(values[:, k]) for k in range(len(FEATURES))], batch.column("label"), batch.column("doc_id").cast(pa.string())],
                names=[*FEATURES, "label", "doc_id"],
            )

    schema = ", ".join([*[f"{name} double" for name in FEATURES], "label int", "doc_id string"])
    sample = one_row_each(chosen.mapInArrow(measured, schema)).toPandas().sort_values(["doc_id", *FEATURES, "label"])
    return fit(sample[list(FEATURES)].to_numpy(float), sample["label"].to_numpy(float), how)


def score_quality(documents: DataFrame, model: Additive, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row: score is the probability of label 1 from the whole text.

    Null and empty texts get the score of a text whose statistics are all zero. Repeated rows are scored each;
    other columns are ignored; an empty table gives an empty result.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrowtext.slices(batches, "text"):
            scores = model.scores(text_features(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return rows.mapInArrow(scored, f"doc_id {kind}, held_out boolean, score double, predicted int")
