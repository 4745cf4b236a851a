"""SimHash near-duplicates, found through tables of distances to reference fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.functions.checkpoints import checkpointed
from ratelens.llm.common import id_field, map_texts, texts_of
from ratelens.llm.components import connected_components

#: Reference fingerprints, drawn once for all.
PIVOTS = np.random.default_rng(64).integers(0, 2**64, 16, np.uint64)

# Bits of a fingerprint in blocks of 13, 13, 13, 13 and 12. A block's row of the
# distance table has its distance to the same block of each reference.
BLOCKS = [range(start, min(start + 13, 64)) for start in range(0, 64, 13)]

# Fingerprints of a bucket that are compared with one another. Larger buckets
# are split by finer blocks, until no more than 2**8 fingerprints can share one.
BUCKET = 256
FINE_BLOCKS = 8

# Shingles whose bits are counted at once.
SHINGLES_AT_ONCE = 50_000


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """Majority of the bits of the XXH64 of all word shingles; 0 without a word."""
    words = text.encode().lower().split()  # of bytes: only A-Z, and only ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends - 1).tolist()[min(shingle, len(words)) - 1 :]
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(stops), SHINGLES_AT_ONCE):
        part = zip(starts[at:], stops[at : at + SHINGLES_AT_ONCE])  # noqa: B905  fewer stops than starts
        hashes = np.array([hashed(joined[a:b], seed) for a, b in part], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(stops), bitorder="little")
    return int(majority.view("<i8")[0])  # as a signed long


def distance_rows(fingerprints: np.ndarray, block: range) -> np.ndarray:
    """Distances to all references within a block, four bits each, as one number."""
    mask = np.uint64(sum(1 << bit for bit in block))
    row = np.zeros(len(fingerprints), np.uint64)
    for pivot in PIVOTS:
        row = row << np.uint64(4) | np.bitwise_count((fingerprints ^ pivot) & mask)
    return row


def _mixed(rows: list[np.ndarray], name: int) -> np.ndarray:
    """One join key of several rows of the table; a chance equality only costs a comparison."""
    key = np.full(len(rows[0]), name, np.uint64)
    for row in rows:
        key = (key ^ row) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def agreeing_keys(fingerprints: np.ndarray, blocks: list[range], distance: int, name: int = 0) -> list[np.ndarray]:
    """Keys of which two fingerprints share one if they differ in at most ``distance`` bits.

    The differing bits lie in ``distance`` blocks at most. In all others the
    rows of the distance table are equal, their greatest difference being 0.
    """
    rows = [distance_rows(fingerprints, block) for block in blocks]
    chosen = combinations(range(len(blocks)), len(blocks) - distance)
    return [_mixed([rows[b] for b in at], name * 1000 + n) for n, at in enumerate(chosen)]


def _free_blocks(choice: int, distance: int) -> list[range]:
    """Finer blocks of the bits that a bucket's key leaves open."""
    fixed = list(combinations(range(len(BLOCKS)), len(BLOCKS) - distance))[choice]
    bits = [bit for b, block in enumerate(BLOCKS) if b not in fixed for bit in block]
    return [bits[n::FINE_BLOCKS] for n in range(FINE_BLOCKS)]


def linked(fingerprints: np.ndarray, distance: int) -> np.ndarray:
    """For each of a few fingerprints the smallest index that it reaches within them."""
    table = np.bitwise_count(fingerprints[:, None] ^ PIVOTS[None, :]).astype(np.int16)
    near = np.ones((len(fingerprints),) * 2, bool)
    for column in table.T:  # a pair whose distances to a reference differ by more is discarded
        near &= np.abs(column[:, None] - column[None, :]) <= distance
    at, to = np.nonzero(near)
    close = np.bitwise_count(fingerprints[at] ^ fingerprints[to]) <= distance
    at, to = at[close], to[close]
    root = np.arange(len(fingerprints))
    while True:
        least = root.copy()
        np.minimum.at(least, at, root[to])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def links(fingerprints: DataFrame, distance: int = 2) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that join all within ``distance`` bits of one another.

    ``fingerprints`` has distinct longs ``fp``. Buckets of equal rows of the
    distance table hold every close pair. Each bucket gives a star for each of
    its components, not all its pairs: as many rows as fingerprints at most.
    """
    if not 0 <= distance < len(BLOCKS):
        raise ValueError(f"distance is a number of bits from 0 to {len(BLOCKS) - 1}")
    keyed_type = T.StructType(
        [T.StructField("key", T.LongType()), T.StructField("choice", T.IntegerType()), T.StructField("fp", T.LongType())]
    )
    names = ["key", "choice", "fp"]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for choice, key in enumerate(agreeing_keys(fp.view(np.uint64), BLOCKS, distance)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.full(len(fp), choice, np.int32)), pa.array(fp)], names
                )

    def finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, choice, fp = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
            for one in np.unique(choice):
                own = choice == one
                part = fp[own].view(np.uint64)
                for fine in agreeing_keys(part, _free_blocks(one, distance), distance, 1 + int(one)):
                    both = _mixed([key[own].view(np.uint64), fine], 7)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(both.view(np.int64)), pa.array(choice[own]), pa.array(part.view(np.int64))], names
                    )

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for bucket in batch.column(0):
                fp = bucket.values.to_numpy()
                root = linked(fp.view(np.uint64), distance)
                off = root != np.arange(len(fp))
                a.append(fp[off])
                b.append(fp[root[off]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x or [np.empty(0, np.int64)])) for x in (a, b)], ["a", "b"])

    rows = fingerprints.select("fp").mapInArrow(keyed, keyed_type)
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    shared = checkpointed(rows.join(sizes, "key"))
    crowded = shared.filter(F.col("size") > BUCKET).select(names).mapInArrow(finer, keyed_type)
    buckets = (
        shared.filter(F.col("size") <= BUCKET)
        .select(names)
        .union(crowded)
        .groupBy("key")
        .agg(F.collect_list("fp").alias("fps"))
        .filter(F.size("fps") > 1)
        .select("fps")
    )
    return buckets.mapInArrow(stars, "a long, b long").distinct()


def simhash_components(
    docs: DataFrame,
    shingle: int = 3,
    distance: int = 2,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Fingerprints of whole texts and the groups they link into.

    One row for each row of ``docs``: doc_id, fp (long), fingerprint (16 hex
    digits) and component_id, the smallest doc_id reachable over fingerprints
    that differ in at most ``distance`` bits. Texts without a word, NULL among
    them, have fingerprint zero and are linked like any other. Repeated rows
    fall into one group; a NULL doc_id is never a component_id unless a group
    has no other. Copies meet by fingerprint before anything is compared.
    """
    schema = T.StructType([id_field(docs, id_col), T.StructField("fp", T.LongType())])
    start = lambda: lambda ids, texts: (ids, [fingerprint(text or "", shingle, seed) for text in texts])
    marked = checkpointed(map_texts(texts_of(docs, id_col, text_col), start, schema, "text"))
    distinct = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    grouped = connected_components(links(distinct, distance))
    firsts = distinct.join(grouped, distinct["fp"] == grouped["node"], "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    smallest = firsts.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_fp = firsts.join(smallest, "component").select("fp", "component_id")
    return marked.join(of_fp, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """The row of the smallest doc_id of each group; all columns of ``docs``.

    Rows that share an id are one document and stay together if their texts are
    in a group. Rows without an id can't be told apart and stay.
    """
    groups = simhash_components(docs, **settings)
    dropped = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti")
