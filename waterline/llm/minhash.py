"""Near duplicates by b-bit MinHash, confirmed on the full shingle sets.

1. One pass over the texts makes each document's set of word shingles, its MinHash minima, the
   packed low bits of these (the b-bit signature) and a key per band of minima.
2. Documents of one set (exact copies, whatever their case and spacing) are linked to the smallest of
   them and take no further part.
3. Documents that share a band key are candidates. Each bucket links its members to its smallest one, so a
   bucket of any size costs one row a member; the components of these links are candidate families,
   outside of which no two documents share a bucket.
4. Families are compared in blocks: a task gets the sets of one or two blocks of a family, passes over pairs of
   large sets whose collision-corrected similarity, estimated from the bit counts of their signatures, is far too low,
   and confirms links on the full sets; small sets are always compared in full. It returns a spanning forest of the links, never all pairs.
5. The components of the confirmed links and of the copies are the groups.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.llm import arrowtext
from waterline.llm.components import components
from waterline.sources.storage import materialise


@dataclass(frozen=True)
class MinHash:
    """Parameters. With 48 bands of 5 minima a pair of similarity 0.75 shares no bucket once in 400,000 times."""

    bands: int = 48
    rows: int = 5
    bits: int = 2
    width: int = arrowtext.WIDTH
    per_cent: int = 75
    block: int = 192
    seed: int = 1
    # Estimates this many standard deviations below the threshold need no look at the sets.
    slack: float = 6.0
    # Pairs with a set of fewer shingles than this are never judged by their estimate.
    exact: int = 64

    @property
    def size(self) -> int:
        return self.bands * self.rows

    def hashing(self) -> tuple[np.ndarray, np.ndarray]:
        draw = np.random.default_rng(self.seed)
        a, b = draw.integers(0, 2**32, (2, self.size, 1), dtype=np.uint32)
        return a | np.uint32(1), b

    def cutoff(self) -> float:
        """Smallest estimated similarity that may belong to a link."""
        floor = 0.5**self.bits
        match = self.per_cent / 100 * (1 - floor) + floor
        return (match - self.slack * (match * (1 - match) / self.size) ** 0.5 - floor) / (1 - floor)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minimum of every hash function over a set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(x), 512):
        h = a * x[None, start : start + 512]
        h += b
        np.minimum(least, h.min(axis=1), out=least)
    return least


def mixed(h: np.ndarray) -> np.ndarray:
    """Minima with all bits mixed (the finalizer of MurmurHash3).

    The low bits of a * x + b depend on those of x alone: without this, two shingles would agree in them for every
    function or for none.
    """
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def packed(least: np.ndarray, bits: int) -> np.ndarray:
    """The low bits of mixed minima, one row a document, packed into 64-bit words plane by plane."""
    least = mixed(least)
    planes = [np.packbits((least >> np.uint32(k)).astype(np.uint8) & 1, axis=-1) for k in range(bits)]
    pad = -planes[0].shape[-1] % 8
    return np.concatenate([np.pad(p, [(0, 0), (0, pad)]) for p in planes], axis=-1).view(np.uint64)


def estimated(one: np.ndarray, two: np.ndarray, bits: int, size: int) -> np.ndarray:
    """Similarity of each packed signature of ``one`` with each of ``two``, corrected for chance collisions."""
    width = one.shape[1] // bits
    differing = np.zeros((len(one), len(two)), dtype=np.uint16)
    for word in range(width):
        unlike = np.zeros((len(one), len(two)), dtype=np.uint64)
        for plane in range(bits):
            unlike |= one[:, None, plane * width + word] ^ two[None, :, plane * width + word]
        differing += np.bitwise_count(unlike)
    match = 1 - differing / size
    chance = 0.5**bits
    return (match - chance) / (1 - chance)


def row_sets(batch: pa.RecordBatch, text: str, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row: A-Z in lower case, words split at ASCII blanks."""
    data, offsets = arrowtext.utf8(batch.column(text))
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    starts, _, first = arrowtext.word_bounds(data, offsets, arrowtext.BLANK)
    hashes, at = arrowtext.shingle_hashes(arrowtext.word_hashes(data, starts, arrowtext.BLANK), first, width)
    for start, stop in zip(at[:-1], at[1:], strict=True):
        yield np.unique(hashes[start:stop])


def shingle_features(documents: DataFrame, how: MinHash, doc_id: str, text: str) -> DataFrame:
    """Per row: doc_id, n_shingles, set_key (digest of the set; null if empty) and the band keys."""
    kind = documents.schema[doc_id].dataType.simpleString()

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = how.hashing()
        for batch in arrowtext.slices(batches, text):
            sizes, keys, bands = [], [], []
            for shingles in row_sets(batch, text, how.width):
                sizes.append(len(shingles))
                if not len(shingles):
                    keys.append(None)
                    bands.append(None)
                    continue
                keys.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                least = minima(shingles, a, b).reshape(how.bands, how.rows)
                bands.append([xxhash.xxh3_64_intdigest(r.tobytes(), k) - 2**63 for k, r in enumerate(least)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(doc_id), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_key", "bands"],
            )

    return documents.select(doc_id, text).mapInArrow(
        features, f"doc_id {kind}, n_shingles bigint, set_key binary, bands array<bigint>"
    )


def _shared(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between the sets of two lists, as one matrix."""
    values = np.concatenate([*one, *two])
    owners = np.repeat(np.arange(len(one) + len(two)), [len(s) for s in (*one, *two)])
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    codes = np.cumsum(new) - 1
    often = np.bincount(codes) > 1
    keep = often[codes]
    owners, codes = owners[keep], (np.cumsum(often) - 1)[codes[keep]]
    total = np.zeros((len(one), len(two)), dtype=np.float32)
    # Shingles in sets of both sides only, a few thousand columns at a time.
    for start in range(0, int(codes[-1]) + 1 if len(codes) else 0, 4096):
        low, high = np.searchsorted(codes, [start, start + 4096])
        table = np.zeros((len(one) + len(two), 4096), dtype=np.float32)
        table[owners[low:high], codes[low:high] - start] = 1
        total += table[: len(one)] @ table[len(one) :].T
    return total.astype(np.int64)


def _forest(n: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the graph with ``n`` nodes and these links."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in pairs.tolist():
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            kept.append((x, y))
    return kept


def confirmed_links(ids: list, sets: list[np.ndarray], blocks: list[int], how: MinHash) -> list[tuple]:
    """A spanning forest of the links among the sets of one block, or between two blocks."""
    parts = sorted(set(blocks))
    sides = [[k for k, b in enumerate(blocks) if b == part] for part in parts]
    one, two = sides[0], sides[-1]
    a, b = how.hashing()
    signatures = packed(np.stack([minima(s, a, b) for s in sets]), how.bits)
    likely = estimated(signatures[one], signatures[two], how.bits, how.size) >= how.cutoff()
    sizes = np.array([len(s) for s in sets])
    left, right = sizes[one][:, None], sizes[two][None, :]
    likely |= np.minimum(left, right) < how.exact
    # The intersection is no larger than the smaller set, the union no smaller than the larger one.
    likely &= 100 * np.minimum(left, right) >= how.per_cent * np.maximum(left, right)
    if len(parts) == 1:
        likely &= np.tri(len(one), k=-1, dtype=bool)
    if not likely.any():
        return []
    rows, cols = np.flatnonzero(likely.any(axis=1)), np.flatnonzero(likely.any(axis=0))
    one, two = np.array(one)[rows], np.array(two)[cols]
    shared = _shared([sets[k] for k in one], [sets[k] for k in two])
    union = sizes[one][:, None] + sizes[two][None, :] - shared
    linked = likely[np.ix_(rows, cols)] & (100 * shared >= how.per_cent * union)
    x, y = np.nonzero(linked)
    return [(ids[p], ids[q]) for p, q in _forest(len(ids), np.stack([one[x], two[y]], axis=1))]


def near_duplicates(documents: DataFrame, how: MinHash = MinHash(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles, component_id and kept, the smallest id of its group.

    Rows whose shingle sets have 100 * intersection >= per_cent * union are linked, and groups are the
    connected components. Null and empty texts and texts of blanks have no shingles and are linked with nothing. Rows
    that share an id are one document: their groups are joined. A row without an id is kept and linked
    with nothing (component_id null). An empty table gives an empty result; other columns are ignored.
    """
    kind = documents.schema[doc_id].dataType.simpleString()
    features = materialise(shingle_features(documents, how, doc_id, text))
    filled = features.filter("set_key IS NOT NULL AND doc_id IS NOT NULL")
    leaders = filled.groupBy("set_key").agg(F.min("doc_id").alias("leader"), F.count(F.lit(1)).alias("n"))
    leaders = materialise(leaders)
    copies = filled.join(leaders.filter("n > 1"), "set_key").select("doc_id", "leader")

    # One row a set from here on: the row of its leader (any of them, should the row repeat).
    banded = filled.join(leaders.select(F.col("leader").alias("doc_id"), "set_key"), ["doc_id", "set_key"])
    banded = materialise(banded.select("doc_id", F.explode("bands").alias("key")))
    pivots = banded.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("last")).filter("pivot < last")
    stars = banded.join(pivots.select("key", "pivot"), "key").filter("doc_id <> pivot").select("doc_id", "pivot").distinct()
    families = materialise(components(stars, "doc_id", "pivot"))

    sizes = families.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / how.block).cast("int").alias("blocks"))
    members = families.join(sizes, "component").select(
        F.col("node").alias("doc_id"), F.col("component").alias("family"), "blocks",
        F.expr("int(pmod(xxhash64(node), blocks))").alias("block"),
    )
    # Block b of a family meets every block, itself included, in a task of its own.
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select(
        "doc_id", "family", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")
    )
    members = members.withColumn("task", F.xxhash64("family", "left", "right"))

    def shingled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrowtext.slices(batches, "text"):
            sets = list(row_sets(batch, "text", how.width))
            bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(bounds, values)], names=["doc_id", "shingles"]
            )

    texts = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    texts = texts.join(families.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    sets = texts.mapInArrow(shingled, f"doc_id {kind}, shingles array<bigint>").filter(F.size("shingles") > 0)
    arrow_kind = pa.string() if kind == "string" else pa.int64() if kind == "bigint" else pa.int32()

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in arrowtext.groups(batches, "task"):
            ids = group.column("doc_id").to_pylist()
            values = group.column("shingles").combine_chunks()
            values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
            flat, at = values.values.to_numpy(zero_copy_only=False).view(np.uint64), values.offsets.to_numpy()
            sets = [flat[s:e] for s, e in zip(at[:-1], at[1:], strict=True)]
            links = confirmed_links(ids, sets, group.column("block").to_pylist(), how) if len(ids) > 1 else []
            if links:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in links], arrow_kind), pa.array([q for _, q in links], arrow_kind)],
                    names=["doc_id", "leader"],
                )

    laid = members.join(sets, "doc_id").select("task", "doc_id", "block", "shingles")
    laid = laid.repartition("task").sortWithinPartitions("task")
    links = laid.mapInArrow(compared, f"doc_id {kind}, leader {kind}")
    groups = components(copies.unionByName(links), "doc_id", "leader")
    placed = features.select("doc_id", "n_shingles").join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return placed.select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component", "doc_id")).alias("kept"),
    )
