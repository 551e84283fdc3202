"""Byte-level BPE: whole texts to token ids with offsets, and ids back to bytes.

The merge engine is the tokenizers library, fed one Arrow batch at a time. It works on characters, so every byte is
mapped to a printable character first; a rank file lists tokens as bytes without the merges that make them, so the merges are
read off the ranks. Decoding needs no library: the byte table of the tokens is indexed by id.

Merges from ranks: splitting a token's own bytes, always joining the pair of lowest rank, ends in two parts, and these
are the only two parts that ever make it, since what is joined inside a token before it exists does not depend on the
text around it. So one merge a token, in order of rank, gives the same ids as joining by ranks. A piece that is itself a
token is taken whole.

A slice of texts is cut before spaces, where a piece always ends, and the library sees each distinct part once.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waterline.llm import arrowtext

# A vocabulary goes to every worker; larger files than this are not vocabularies.
MOST_BYTES = 64 << 20
# Texts of about so many bytes are cut into parts together, and so many parts are handed to the library at a time.
SLICE = 4 << 20
PARTS = 1 << 13
_PLAIN = (np.arange(256) > 0x20) & (np.arange(256) < 0x7F)
#: First bytes of two-byte characters of which none is white space.
_LEADS = (np.arange(256) >= 0xC3) & (np.arange(256) < 0xE0)


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else the next free one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in printable}
    rest = (b for b in range(256) if b not in table)
    return [c for _, c in sorted((table | {b: chr(0x100 + k) for k, b in enumerate(rest)}).items())]


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: a line holds the token in base 64 and its rank."""
    if os.path.getsize(path) > MOST_BYTES:
        raise ValueError(f"{path} is larger than {MOST_BYTES} bytes")
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def last_parts(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts from which the merges make a token; None if they never do."""
    parts = [token[k : k + 1] for k in range(len(token))]
    while len(parts) > 2:
        joined = [ranks.get(a + b, -1) for a, b in zip(parts[:-1], parts[1:], strict=True)]
        usable = [r for r in joined if r >= 0]
        if not usable:
            return None
        k = joined.index(min(usable))
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


@dataclass(frozen=True)
class Vocabulary:
    """What workers need: the library's own serialised tokenizer, and the bytes of each id with their offsets."""

    serialised: str
    data: bytes
    offsets: np.ndarray

    @classmethod
    def from_ranks(cls, ranks: dict[bytes, int], pattern: str) -> Vocabulary:
        """``pattern`` splits a text before the merges. Ids that no token has decode to nothing known and are rejected."""
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the ranks lack single bytes: {missing}")
        letters = byte_characters()
        spelt = {token: "".join(letters[b] for b in token) for token in ranks}
        ordered = sorted(ranks, key=ranks.__getitem__)
        halves = [last_parts(token, ranks) for token in ordered if len(token) > 1]
        merges = [(spelt[pair[0]], spelt[pair[1]]) for pair in halves if pair]
        engine = Tokenizer(models.BPE(vocab={spelt[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
        engine.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        sizes = np.full(max(ranks.values()) + 1, -1, dtype=np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        offsets = np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))])
        offsets[:-1][sizes < 0] = -1  # an id without a token
        return cls(engine.to_str(), b"".join(ordered), offsets)

    @classmethod
    def from_file(cls, path: str, pattern: str) -> Vocabulary:
        return cls.from_ranks(read_ranks(path), pattern)

    def share(self, spark: SparkSession) -> Broadcast[Vocabulary]:
        """To every executor, once; its size is that of the vocabulary file, not of the data."""
        return spark.sparkContext.broadcast(self)


@lru_cache(maxsize=2)
def _engine(serialised: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    from tokenizers import Tokenizer

    return Tokenizer.from_str(serialised)


def part_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First byte of every part of the rows: each row's first, and every space after a character that is none.

    No piece of the pattern holds a space after another character, or looks beyond one, so the ids of the parts, one
    after the other, are the row's. A row without such a place is one part.
    """
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[1:-1] = (data[1:] == 0x20) & _PLAIN[data[:-1]]
    cut[2:-1] |= (data[2:] == 0x20) & (data[1:-1] >= 0x80) & _LEADS[data[:-2]]
    cut[offsets] = True
    return np.flatnonzero(cut[:-1])


def encode_texts(texts: pa.Array, serialised: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and each text's first id (one more at the end)."""
    engine = _engine(serialised)
    data, offsets = arrowtext.utf8(texts)
    starts = part_starts(data, offsets)
    places = np.append(starts, len(data))
    parts = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(data)).dictionary_encode()
    found = [np.zeros(0, dtype=np.int32)]
    sizes = np.zeros(len(parts.dictionary), dtype=np.int64)
    for begin in range(0, len(parts.dictionary), PARTS):
        some = parts.dictionary.slice(begin, PARTS).to_pylist()
        ids = [one.ids for one in engine.encode_batch_fast(some, add_special_tokens=False)]
        sizes[begin : begin + len(ids)] = [len(i) for i in ids]
        found.append(np.fromiter((i for own in ids for i in own), dtype=np.int32))
    table, firsts = np.concatenate(found), np.cumsum(sizes) - sizes
    at = parts.indices.to_numpy()
    upto = np.concatenate([[0], np.cumsum(sizes[at])])
    ids = table[np.repeat(firsts[at] - upto[:-1], sizes[at]) + np.arange(upto[-1])]
    return ids, upto[np.searchsorted(starts, offsets)]


def token_bytes(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bytes of each id; -1 where no token has it."""
    known = (ids >= 0) & (ids < len(offsets) - 1)
    at = np.where(known, ids, 0)
    ends = np.maximum.accumulate(np.maximum(offsets, 0))[1:]
    return np.where(known & (offsets[at] >= 0), ends[at] - offsets[at], -1)


def decode_lists(lists: pa.Array, vocabulary: Vocabulary) -> tuple[list[bytes | None], list[np.ndarray | None]]:
    """The bytes of each row's tokens, one after the other, and the tokens' sizes; None where an id is null or has no token."""
    values = pc.fill_null(pc.list_flatten(lists), -1).to_numpy().astype(np.int64)
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    cuts = np.concatenate([[0], np.cumsum(counts)])
    sizes = token_bytes(values, vocabulary.offsets)
    ends = np.maximum.accumulate(np.maximum(vocabulary.offsets, 0))
    table = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(vocabulary.data)])
    taken = table.take(pa.array(np.where(sizes < 0, 0, values)))
    # The taken tokens stand one after the other.
    places, raw = np.frombuffer(taken.buffers()[1], dtype=np.int64)[: len(taken) + 1], memoryview(taken.buffers()[2] or b"")
    bad = np.concatenate([[0], np.cumsum(sizes < 0)])
    usable = lists.is_valid().to_numpy(zero_copy_only=False) & (bad[cuts[1:]] == bad[cuts[:-1]])
    rows = list(zip(usable.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
    return [bytes(raw[places[a] : places[b]]) if u else None for u, a, b in rows], [sizes[a:b] if u else None for u, a, b in rows]


def character_offsets(texts: pa.Array, sizes: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end character of every token in its text: a character split over tokens belongs to each.

    ``sizes`` are the tokens' bytes, ``cuts`` each text's first token.
    """
    data, offsets = arrowtext.utf8(texts)
    upto = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    ends = np.cumsum(sizes)
    before = np.repeat(upto[offsets[:-1]], np.diff(cuts))
    return upto[ends - sizes + 1] - 1 - before, upto[ends] - before


def token_texts(data: bytes, sizes: np.ndarray) -> list[str]:
    """The text that each token adds: a character split over tokens comes with the one that completes it.

    Bytes that are no UTF-8 come as U+FFFD. One after the other the texts are the whole text.
    """
    held = np.append((np.frombuffer(data, dtype=np.uint8) & 0xC0) == 0x80, False)
    # A place inside a character moves back to the character's first byte.
    starts = np.maximum.accumulate(np.where(held, 0, np.arange(len(data) + 1)))
    cuts = starts[np.concatenate([[0], np.cumsum(sizes)])].tolist()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _lists(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, pa.int32()))


def encode(
    documents: DataFrame, vocabulary: Broadcast[Vocabulary], text: str = "text", offsets: bool = False, keep_text: bool = False
) -> DataFrame:
    """All rows and columns of ``documents`` (with ``keep_text``: and the text) with ids, and with ``offsets`` starts and ends.

    ids are the text's token ids, special tokens' strings being ordinary text. starts and ends are the tokens' places in
    characters. A null text counts as empty and has no ids; repeated rows are encoded each for itself; columns of the
    names ids, starts and ends are replaced; an empty table gives an empty result. One pass without an exchange; a
    worker holds one slice of texts, or one longer text.
    """
    added = ("ids", "starts", "ends") if offsets else ("ids",)
    rows = documents.drop(*[n for n in ("ids", "starts", "ends") if n != text])
    rows = rows.withColumn(text, F.make_valid_utf8(F.col(text)))
    kept = [f for f in rows.schema.fields if keep_text or f.name != text]
    schema = T.StructType([*kept, *[T.StructField(n, T.ArrayType(T.IntegerType(), False)) for n in added]])

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = vocabulary.value
        for batch in arrowtext.slices(batches, text, SLICE):
            ids, cuts = encode_texts(batch.column(text), shared.serialised)
            new = [ids]
            if offsets:
                new += character_offsets(batch.column(text), token_bytes(ids, shared.offsets), cuts)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], *[_lists(v, cuts) for v in new]], names=[*[f.name for f in kept], *added]
            )

    return rows.mapInArrow(encoded, schema)


def decode(encoded: DataFrame, vocabulary: Broadcast[Vocabulary], ids: str = "ids", pieces: bool = False) -> DataFrame:
    """All rows and columns with decoded (the bytes) and decoded_text, and with ``pieces`` the text that each token adds.

    decoded_text is null-safe text: bytes that are no UTF-8, as single tokens may be, come as U+FFFD. Null ids, a null among
    them, and ids without a token give null. Columns of the names of results are replaced.
    """
    rows = encoded.drop(*[n for n in ("decoded", "decoded_text", "pieces") if n != ids])
    added = [T.StructField("decoded", T.BinaryType()), T.StructField("decoded_text", T.StringType())]
    if pieces:
        added.append(T.StructField("pieces", T.ArrayType(T.StringType(), False)))

    def decoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = vocabulary.value
        for batch in batches:
            data, sizes = decode_lists(batch.column(ids), shared)
            new = [pa.array(data, pa.binary()), pa.array([None if d is None else d.decode("utf-8", "replace") for d in data], pa.string())]
            if pieces:
                split = [None if d is None else token_texts(d, n) for d, n in zip(data, sizes, strict=True)]
                new.append(pa.array(split, pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *[f.name for f in added]])

    return rows.mapInArrow(decoded, T.StructType([*rows.schema.fields, *added]))


def round_trip_digests(encoded: DataFrame, vocabulary: Broadcast[Vocabulary], ids: str = "ids") -> DataFrame:
    """The other columns with n_tokens, ids_sha256 (of the ids as little-endian 32-bit integers) and decoded_sha256.

    Both digests read the ids back: the second is of the bytes they decode to. Both are null where ids are, or an id has no token.
    """
    rest = [f for f in encoded.drop("n_tokens", "ids_sha256", "decoded_sha256").schema.fields if f.name != ids]
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]

    def digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = vocabulary.value
        for batch in batches:
            lists = batch.column(ids)
            data, _ = decode_lists(lists, shared)
            raw = memoryview(pc.list_flatten(lists).cast(pa.int32()).to_numpy(zero_copy_only=False).astype("<u4").tobytes())
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy()).tolist()
            digests = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(f.name) for f in rest],
                    pc.list_value_length(lists).cast(pa.int64()),
                    pa.array([None if d is None else i for i, d in zip(digests, data, strict=True)], pa.string()),
                    pa.array([None if d is None else hashlib.sha256(d).hexdigest() for d in data], pa.string()),
                ],
                names=[*[f.name for f in rest], *[f.name for f in added]],
            )

    return encoded.mapInArrow(digested, T.StructType([*rest, *added]))
